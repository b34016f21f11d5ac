"""Streams whose open windows count too, restarts that write nothing twice, and tables that follow their newest rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from dispatchlens.operators import service
from dispatchlens.sources import files as stored
from dispatchlens.streaming import opslog as stream_log, service as streams
from dispatchlens.streaming.arrivals import Arrivals
from dispatchlens.streaming.ledger import KeyedTable, Ledger

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_id BIGINT, endpoint STRING, latency_ms DOUBLE, ts TIMESTAMP"
BATCHES = [[(1, "/a", 5.0, 1), (2, "/a", 9.0, 2), (3, "/b", 80.0, 6)],
           [(4, "/a", 30.0, 11), (5, "/b", 2.0, 31), (8, None, 2.0, 31)], [(6, "/a", 3.0, 60), (7, None, 1.0, 61)]]


def deliver(spark, folder, name, rows):
    stamped = [(i, e, ms, None if m is None else T0 + dt.timedelta(minutes=m)) for i, e, ms, m in rows]
    spark.createDataFrame(stamped, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def source(spark, folder, max_files=1):
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", True)
            .parquet(str(folder)))


def batches(spark, folder, *groups):
    """One file per batch, read one per micro-batch."""
    for n, rows in enumerate(groups):
        deliver(spark, folder, f"{n:02d}", rows)
    return source(spark, folder)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


KEEP = ["endpoint", "window_start", "events", "per_second"]


@pytest.mark.parametrize("slide", [1, 5])
def test_open_windows_are_counted(spark, tmp_path, slide):
    events = batches(spark, tmp_path / "in", *BATCHES)
    rows = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    got = streams.whole_rates(events, ["endpoint"], str(tmp_path / "out"), str(tmp_path / "state"), slide_minutes=slide, delay="5 minutes")
    assert rows_of(got.select(KEEP)) == rows_of(service.rates(rows, ["endpoint"], slide_minutes=slide).select(KEEP))


def test_a_table_shorter_than_the_delay_is_kept(spark, tmp_path):
    events = batches(spark, tmp_path / "in", [(1, "/a", 5.0, 1), (2, "/a", 9.0, 2)])
    rows = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    got = streams.whole_latency(events, ["endpoint"], str(tmp_path / "out"), str(tmp_path / "state"))
    assert rows_of(got) == rows_of(service.latency_quantiles(service.latency_histogram(rows, ["endpoint"])).select(got.columns))


class Broken(KeyedTable):
    """Breaks off in one batch, before or after the batch is entered in the ledger."""
    at, when, tries = 1, "before", 0

    def write(self, rows, batch):
        if batch != self.at or self.tries:
            return super().write(rows, batch)
        self.tries += 1
        if self.when == "after":
            super().write(rows, batch)
        else:  # the rows are there, the entry isn't
            enter, Ledger.enter = Ledger.enter, lambda *a, **b: (_ for _ in ()).throw(RuntimeError("executor lost"))
            try:
                super().write(rows, batch)
            finally:
                Ledger.enter = enter
        raise RuntimeError("stopped")


@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("at", [0, 1, 2])
def test_a_restart_writes_nothing_twice(spark, tmp_path, when, at):
    steps = service.step_counts(batches(spark, tmp_path / "in", *BATCHES).withWatermark("ts", "5 minutes"), ["endpoint"], slide_minutes=5)
    table = Broken(str(tmp_path / "out"), steps.schema, ["endpoint", "at"], "until")
    table.at, table.when = at, when
    with pytest.raises(Exception, match="stopped|executor lost"):
        table.drained(steps, str(tmp_path / "state"), "update")
    middle = table.read(spark).agg(F.sum("n")).first()[0] or 0
    whole = KeyedTable(table.path, steps.schema, table.keys, "until").drained(steps, str(tmp_path / "state"), "update")
    rows = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    assert rows_of(whole) == rows_of(service.step_counts(rows, ["endpoint"], slide_minutes=5).select(whole.columns))
    assert middle == sum(len(b) for b in BATCHES[:at + (when == "after")])


def test_closed_windows_are_written_once_and_open_ones_replaced(spark, tmp_path):
    groups = [[(n, "/a", 1.0, 10 * n)] for n in range(8)] + [[(99, "/a", 1.0, 1)]]  # the last is far behind the watermark
    steps = service.step_counts(batches(spark, tmp_path / "in", *groups).withWatermark("ts", "5 minutes"), ["endpoint"], slide_minutes=5)
    table = KeyedTable(str(tmp_path / "out"), steps.schema, ["endpoint", "at"], "until")
    assert [r.n for r in table.drained(steps, str(tmp_path / "state"), "update").collect()] == [1] * 8
    folders = stored.names(spark, table.path + "/rows")
    still_open = [f for f in folders if "closed=false" in stored.names(spark, f"{table.path}/rows/{f}")]
    assert len(still_open) == 1 and len(stored.names(spark, table.path + "/_ledger")) <= 3
    closed = spark.read.parquet(table.path + "/rows").where("closed = 'true'")
    assert 5 <= closed.count() == closed.select("at").distinct().count()


def test_an_empty_stream_gives_an_empty_table(spark, tmp_path):
    steps = service.step_counts(batches(spark, tmp_path / "in", []).withWatermark("ts", "5 minutes"), ["endpoint"])
    table = KeyedTable(str(tmp_path / "out"), steps.schema, ["endpoint", "at"], "until")
    assert table.read(spark).collect() == []
    assert table.drained(steps, str(tmp_path / "state"), "update").collect() == []


# Runs and outcomes ---------------------------------------------------------------------------

def test_runs_are_running_until_an_outcome_arrives(spark, tmp_path):
    def lines(kind, name, *records):
        folder = tmp_path / kind
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("\n".join(json.dumps(r) for r in records) + "\n")

    def run(i, minute, dag):
        return {"run_id": f"r{i}", "run_at": f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00Z", "status": "success", "dag_run_id": dag}

    def outcome(dag, minute, state):
        return {"dag_run_id": dag, "outcome_at": f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00Z", "state": state}

    def now():
        runs = spark.readStream.schema("run_id STRING, run_at TIMESTAMP, status STRING, dag_run_id STRING").json(str(tmp_path / "runs"))
        outcomes = spark.readStream.schema("dag_run_id STRING, outcome_at TIMESTAMP, state STRING").json(str(tmp_path / "outcomes"))
        stream = stream_log.reconciled(runs, outcomes, within="60 minutes")
        table = stream_log.reconciled_table(stream, str(tmp_path / "out"))
        rows = table.drained(stream, str(tmp_path / "state"), "append").collect()
        assert len({r.run_id for r in rows}) == len(rows)
        return {r.run_id: r.retrain_state for r in rows}

    lines("runs", "0.json", run(1, 0, "a"), run(2, 1, None), run(3, 2, ""), run(4, 3, "b"), run(5, 4, "c"))
    lines("outcomes", "0.json", outcome(None, 5, "failed"))
    assert now() == {"r1": "running", "r2": None, "r3": None, "r4": "running", "r5": "running"}
    lines("outcomes", "1.json", outcome("a", 10, "failed"), outcome("zz", 10, "failed"))
    assert now()["r1"] == "failed"
    lines("outcomes", "2.json", outcome("a", 12, "success"), outcome("b", 11, "timeout"))
    assert now() == {"r1": "success", "r2": None, "r3": None, "r4": "timeout", "r5": "running"}
    # far later both sides' state is gone; an outcome beyond the bound changes nothing
    lines("runs", "3.json", run(6, 600, "d"))
    lines("outcomes", "3.json", outcome("d", 601, "success"))
    now()
    lines("outcomes", "4.json", outcome("c", 602, "success"))
    lines("runs", "4.json", run(7, 700, None))
    assert now() == {"r1": "success", "r2": None, "r3": None, "r4": "timeout", "r5": "running", "r6": "success", "r7": None}
    state = spark.read.format("statestore").option("joinSide", "left").load(str(tmp_path / "state"))
    assert "c" not in {r.value["dag_run_id"] for r in state.collect()}


# Late records --------------------------------------------------------------------------------

SENT = [[(1, "/a", 1.0, 0), (2, "/a", 1.0, 30), (2, "/a", 1.0, 30), (None, "/n", 1.0, 30), (None, "/n", 1.0, 30), (9, "/t", 1.0, None)],
        [(2, "/a", 1.0, 30), (3, "/a", 1.0, 19), (4, "/a", 1.0, 20), (5, "/b", 1.0, 55)],
        [(6, "/b", 1.0, 44), (5, "/b", 1.0, 56), (7, "/b", 1.0, 45), (2, "/a", 1.0, 58)]]
FATE = {(1, 0): ["kept"], (2, 0): ["kept", "repeat"], (None, 0): ["kept", "kept"], (9, 0): ["late"], (2, 1): ["repeat"], (3, 1): ["late"], (4, 1): ["kept"],
        (5, 1): ["kept"], (6, 2): ["late"], (5, 2): ["repeat"], (7, 2): ["kept"], (2, 2): ["kept"]}


class BrokenArrivals(Arrivals):
    tries = 0

    def write(self, rows, batch):
        super().write(rows, batch)
        if batch == 1 and not self.tries:
            self.tries = 1
            raise RuntimeError("stopped")


@pytest.mark.parametrize("broken", [False, True])
def test_every_record_sent_is_kept_a_repeat_or_late(spark, tmp_path, broken):
    for n, rows in enumerate(SENT):
        deliver(spark, tmp_path / "in", f"{n}", rows)
    events = source(spark, tmp_path / "in").withColumn("sent_in", F.regexp_extract(F.col("_metadata.file_path"), "/([0-9])/part", 1).cast("int"))
    table = (BrokenArrivals if broken else Arrivals)(str(tmp_path / "out"), events.schema, "event_id")
    if broken:
        with pytest.raises(Exception, match="stopped"):
            table.start(events, str(tmp_path / "state")).awaitTermination()
    table.start(events, str(tmp_path / "state")).awaitTermination()
    got = {}
    for r in table.read(spark).collect():
        got.setdefault((r.event_id, r.sent_in), []).append(r.fate)
    assert {k: sorted(v) for k, v in got.items()} == FATE
    counts = table.counts(spark)
    assert counts["sent"] == sum(map(len, SENT)) == counts["kept"] + counts["repeat"] + counts["late"] and counts["late"] == 3


def test_no_arrivals(spark, tmp_path):
    table = Arrivals(str(tmp_path / "out"), batches(spark, tmp_path / "in", []).schema, "event_id")
    assert table.read(spark).collect() == [] and table.counts(spark)["sent"] == 0
    table.start(source(spark, tmp_path / "in"), str(tmp_path / "state")).awaitTermination()
    assert table.read(spark).collect() == [] and table.counts(spark)["sent"] == 0
