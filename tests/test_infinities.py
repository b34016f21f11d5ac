"""Quantiles of columns with infinities, runs without a retrain id, and stored models that can't be read."""

import math
import statistics
import time

import pytest
from pyspark.sql import functions as F

from dispatchlens.functions.quantiles import exact_quantiles
from dispatchlens.operators import scoring

VALUES = [-math.inf, *map(float, range(997)), math.inf, math.inf]


@pytest.mark.parametrize("max_rows", [50, 1_000_000])
def test_infinities_have_their_rank(spark, max_rows):
    rows = [(v,) for v in VALUES] + [(None,), (math.nan,)]
    table = spark.createDataFrame(rows, "v double")
    probs = [0.0, 0.0005, 0.25, 0.5, 0.998, 1.0]
    got = exact_quantiles(table, ["v"], probs, max_rows=max_rows, accuracy=100)["v"]
    at = [p * (len(VALUES) - 1) for p in probs]
    assert got[0] == got[1] == -math.inf and got[4] == got[5] == math.inf
    for k in (2, 3):
        low = VALUES[math.floor(at[k])]
        assert got[k] == pytest.approx(low + at[k] - math.floor(at[k]))


def test_only_an_absent_model_gives_way_to_the_formula(spark, tmp_path):
    assert scoring.load_model(None) is None and scoring.load_model(str(tmp_path / "absent")) is None
    (tmp_path / "broken" / "metadata").mkdir(parents=True)
    (tmp_path / "broken" / "metadata" / "part-00000").write_text("no json")
    with pytest.raises(Exception):
        scoring.load_model(str(tmp_path / "broken"))


def test_many_columns_are_planned_quickly(spark):
    """45 columns of 500 rows: planning grows with the columns, not with a tree for each of them."""
    wide = spark.range(500).select(*[((F.col("id") * (i + 1)) % 97 * 1.5).alias(f"c{i}") for i in range(45)])
    start = time.monotonic()
    got = exact_quantiles(wide, wide.columns, [0.5])
    assert time.monotonic() - start < 30  # about 2 s; minutes before
    assert got["c0"] == [statistics.median(i % 97 * 1.5 for i in range(500))]
