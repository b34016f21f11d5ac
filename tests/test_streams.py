"""Streams give what batch gives; late and repeated records are handled."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from dispatchlens import schemas
from dispatchlens.operators import service
from dispatchlens.sources import files as sources, jsonl
from dispatchlens.streaming import service as streams
from test_logs import record

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_id BIGINT, endpoint STRING, latency_ms DOUBLE, ts TIMESTAMP"


def files(spark, folder, *batches):
    """One file per batch, read one per micro-batch."""
    for n, rows in enumerate(batches):
        stamped = [(i, e, ms, T0 + dt.timedelta(minutes=m)) for i, e, ms, m in rows]
        spark.createDataFrame(stamped, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{n:02d}")
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
            .parquet(str(folder)))


def drained(stream, tmp_path):
    return streams.drain(stream, str(tmp_path / "out"), str(tmp_path / "state"))


BATCHES = [[(1, "/a", 5.0, 1), (2, "/a", 9.0, 2), (3, "/b", 80.0, 6)],
           [(4, "/a", 30.0, 11), (5, "/b", 2.0, 31)], [(6, "/a", 3.0, 60)]]


def test_rates_equal_batch_for_closed_windows(spark, tmp_path):
    stream = streams.windowed_rates(files(spark, tmp_path / "in", *BATCHES), ["endpoint"], delay="5 minutes")
    got = drained(stream, tmp_path).select("endpoint", "window_start", "events", "per_second")
    rows = spark.createDataFrame([(i, e, ms, T0 + dt.timedelta(minutes=m)) for b in BATCHES for i, e, ms, m in b], SCHEMA)
    batch = service.rates(rows, ["endpoint"], slide_minutes=5).where(
        F.col("window_end") <= F.lit(T0 + dt.timedelta(minutes=55)))
    assert sorted(map(tuple, got.collect())) == sorted(
        map(tuple, batch.select("endpoint", "window_start", "events", "per_second").collect()))
    assert got.count() == 4


def test_records_behind_the_watermark_are_left_out(spark, tmp_path):
    batches = [[(1, "/a", 1.0, 1)], [(2, "/a", 1.0, 60)], [(3, "/a", 1.0, 90)], [(4, "/a", 1.0, 2)], [(5, "/a", 1.0, 120)]]
    stream = streams.windowed_rates(files(spark, tmp_path / "in", *batches), ["endpoint"], delay="10 minutes")
    got = {r.window_start: r.events for r in drained(stream, tmp_path).collect()}
    assert got[T0] == 1


def test_repeated_source_ids_count_once(spark, tmp_path):
    batches = [[(1, "/a", 1.0, 1), (1, "/a", 1.0, 1), (2, "/a", 1.0, 2)], [(2, "/a", 1.0, 2), (3, "/a", 1.0, 3)]]
    got = drained(streams.deduplicated(files(spark, tmp_path / "in", *batches), "event_id"), tmp_path)
    assert sorted(r.event_id for r in got.collect()) == [1, 2, 3]


def test_latency_stream_equals_batch(spark, tmp_path):
    stream = streams.windowed_latency(files(spark, tmp_path / "in", *BATCHES), ["endpoint"], delay="5 minutes")
    rows = spark.createDataFrame([(i, e, ms, T0 + dt.timedelta(minutes=m)) for b in BATCHES for i, e, ms, m in b], SCHEMA)
    batch = service.latency_quantiles(service.latency_histogram(rows, ["endpoint"])).where(
        F.col("window_end") <= F.lit(T0 + dt.timedelta(minutes=55)))
    assert sorted(map(tuple, drained(stream, tmp_path).collect())) == sorted(map(tuple, batch.collect()))


def test_stream_scoring_routes_records(spark, tmp_path):
    (tmp_path / "in").mkdir()
    own = record(estimated_delivery_days=17, freight_sum=40.0, purchase_hour=21)  # 0.06 + 0.306 + 0.048 + 0.012
    lines = [json.dumps(own), json.dumps(own), json.dumps(own | {"is_late_delivery": 1}), "broken{"]
    (tmp_path / "in" / "a.txt").write_text("\n".join(lines) + "\n")
    records = spark.readStream.text(str(tmp_path / "in")).withColumnRenamed("value", "payload")
    query = streams.to_parquet(streams.scored_records(records), str(tmp_path / "out"), str(tmp_path / "state"), ["outcome"])
    query.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    good = out.where("outcome = 'accepted'").collect()
    assert [(r.late_delivery_probability, r.risk_level) for r in good] == [(0.426, "medium")] * 2
    bad = out.where("outcome = 'quarantined'").collect()
    assert sorted(r.violations[0] for r in bad) == ["unknown:is_late_delivery", "unreadable"]
    assert all(r.late_delivery_probability is None and r.risk_level is None for r in bad)


def test_log_stream_skips_bad_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"method": "POST", "status": 200}\n\n{"method": "PO\n{"status": 500}\n')
    stream = jsonl.stream_log(spark, str(tmp_path / "in"), schemas.REQUEST_LOG, max_files=1)
    assert sorted(r.status for r in drained(stream, tmp_path).collect()) == [200, 500]


@pytest.mark.parametrize("runs", [2])
def test_stream_resumes_from_its_checkpoint(spark, tmp_path, runs):
    for n in range(runs):
        files(spark, tmp_path / "in", [(n, "/a", 1.0, n)])
        stream = (spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(str(tmp_path / "in")))
        got = drained(stream, tmp_path)
    assert sorted(r.event_id for r in got.collect()) == list(range(runs))


@pytest.mark.parametrize("name", ["a folder", "one file", "odd [name]"])
def test_a_stream_reads_a_folder_or_one_file(spark, tmp_path, name):
    rows = spark.createDataFrame([(n, "/a", 1.0, T0) for n in range(50)], SCHEMA).coalesce(1)
    path = tmp_path / name
    rows.write.parquet(str(path if name == "a folder" else tmp_path / "made"))
    if name != "a folder":
        (tmp_path / "other").write_text("not part of the stream")
        next((tmp_path / "made").glob("*.parquet")).rename(path)
    stream = sources.stream_parquet(spark, str(path), SCHEMA)
    assert sorted(r.event_id for r in drained(stream, tmp_path).collect()) == list(range(50))


def test_an_absent_stream_source_is_refused(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.stream_parquet(spark, str(tmp_path / "none"), SCHEMA)
