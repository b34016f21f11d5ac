"""Multi-line CSV in byte ranges, and null markers."""

import csv
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from dispatchlens import schemas
from dispatchlens.sources import records, tables
from dispatchlens.sources.tables import REGISTRY, read_csv

PLAIN = ["", "word", "two words", "a,b", "é ü"]
NASTY = ['said "ok"', '"', '""', "line\nbreak", "\n", "\n\n\n", 'x"\n"y', ',"\n,"', "tail\n", " \n lead"]


def written(path, rows, crlf=False):
    text = io.StringIO()
    out = csv.writer(text, lineterminator="\r\n" if crlf else "\n")
    out.writerow(["id", "a", "b"])
    out.writerows(rows)
    path.write_bytes(text.getvalue().encode())


def read(spark, path):
    got = records.csv_records(spark, str(path)).select(F.from_csv("record", F.lit("id INT, a STRING, b STRING"), {"escape": '"', "mode": "FAILFAST", "multiLine": "true"}).alias("r"))
    return sorted((r.id, r.a or "", r.b or "") for r in got.select("r.*").collect())


@pytest.mark.parametrize("block", [16, 61, 500, 1 << 20])
@pytest.mark.parametrize("crlf", [False, True])
def test_records_over_the_ends_of_byte_ranges(spark, tmp_path, block, crlf):
    rng = random.Random(block)
    rows = [(i, rng.choice(PLAIN + NASTY), rng.choice(PLAIN + NASTY)) for i in range(120)] + [(500, "line\n" * 60, "q"), (501, 'x"' * 90 + "\n" * 40, "z")]
    written(tmp_path / "t.csv", rows, crlf)
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        lines = records._lines(spark, str(tmp_path / "t.csv"))
        if block < 1000:
            assert lines.select("block").distinct().count() > 5
        assert read(spark, tmp_path / "t.csv") == sorted(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_many_files_each_with_a_header(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for n in range(3):
        written(tmp_path / "d" / f"{n}.csv", [(10 * n + i, "x\ny", 'q"') for i in range(4)])
    (tmp_path / "d" / "empty.csv").write_text("id,a,b\n")
    assert len(read(spark, tmp_path / "d")) == 12
    (tmp_path / "no.csv").write_text("")
    assert read(spark, tmp_path / "no.csv") == []


def test_reviews_are_read_by_many_tasks(spark, tmp_path):
    rows = [[f"r{i}", f"o{i}", i % 5 + 1, "t, i", 'said "ok"\nline' if i % 3 else "", "2024-01-02 03:04:05", ""] for i in range(2000)]
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows([schemas.ORDER_REVIEWS.names, *rows])
    (tmp_path / REGISTRY["order_reviews"].filename).write_text(text.getvalue())
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        table = read_csv(spark, REGISTRY["order_reviews"], str(tmp_path), multi_line=True)
        assert table.rdd.getNumPartitions() > 4
        got = sorted(map(tuple, table.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got == sorted((i, o, score, title, message or None, at, None) for i, o, score, title, message, _, _ in rows)


def test_null_markers_are_null_in_every_type(spark, tmp_path):
    table = tables.CsvTable(schemas._struct("name STRING, n INT, x DOUBLE, at TIMESTAMP_NTZ"), "t.csv")
    lines = ["name,n,x,at", "NA,1,2.5,2024-01-01 00:00:00", "nan,NaN,NA,N/A", "NAN,null,None,", '"NULL",#N/A,<NA>,nan', ",,,"]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    for multi_line in (False, True):
        got = [tuple(r) for r in read_csv(spark, table, str(tmp_path), multi_line).collect()]
        assert sum(r[0] is not None for r in got) == 1 and sum(r[1] is not None for r in got) == sum(r[2] is not None for r in got) == 1
    (tmp_path / "t.csv").write_text("name,n,x,at\na,many,1,\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_csv(spark, table, str(tmp_path)).collect()
