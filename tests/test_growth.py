"""Steps whose work must not grow faster than their input."""

import re

import numpy as np

from dispatchlens import policy, session
from dispatchlens.functions import quantiles
from dispatchlens.operators import contract, order_features as features_op, training, trees
from dispatchlens.plans import queries
from dispatchlens.sources import adapter


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_field_of_a_record_is_looked_up_once(spark):
    """Rules name a field many times; each mention used to search the record, and the filter on top once more."""
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    records = spark.createDataFrame([(1, "{}")], "record_id LONG, payload STRING")
    for made in (contract.accepted, contract.quarantined, contract.violation_counts):
        plan = optimized(made(contract.check_records(records)))
        for c in ("price_sum", "purchase_hour", "seller_count"):
            assert len(re.findall(rf"\[{c}\]", plan)) == 1, (made.__name__, c)


def test_lines_are_dealt_out_by_order_before_they_are_copied(spark, sf_dir):
    """One exchange of the lines per branch: the copies per dimension and the sums' states used to be shuffled, six rows and 40 numbers a line."""
    raw = adapter.feature_inputs(spark, sf_dir)
    values = features_op.item_values(raw["items"], raw["products"], raw["sellers"])
    measures = features_op.item_measures(raw["items"], raw["products"])
    payments = features_op.payment_profile(raw["payments"])
    for table, groupings in ((values, 2), (measures, 1), (payments, 2)):
        plan = table._jdf.queryExecution().sparkPlan().toString()
        above, _, below = plan.partition("REPARTITION_BY_COL")
        assert below and above.count("Aggregate") >= groupings and "Expand" not in plan
        executed = table._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_COL" in executed
        # no exchange between the groupings
        assert "Exchange" not in executed.partition("REPARTITION_BY_COL")[0].rpartition("Exchange")[0]


def test_order_with_unknown_values_only_stays(spark):
    items = spark.createDataFrame([("a", None, "x"), ("b", "p", None), ("b", "p", "x")], "order_id STRING, product_id STRING, seller_id STRING")
    products = spark.createDataFrame([], "product_id STRING, product_category_name STRING")
    sellers = spark.createDataFrame([("x", "7", None, 5)], "seller_id STRING, seller_state STRING, seller_city STRING, seller_zip_code_prefix INT")
    got = {r.order_id: r for r in features_op.item_values(items, products, sellers).collect()}
    assert (got["a"].product_count, got["a"].seller_count, got["a"].seller_city_count, got["a"].seller_zip_mode) == (0, 1, 0, 5)
    assert (got["b"].product_count, got["b"].seller_count, got["b"].product_category_mode, got["b"].seller_state_mode) == (1, 1, None, "7")


def test_counting_cells_copies_narrow_rows(spark):
    """Grouping sets used to copy all cell columns once per column, so that the work grew with the square of their number."""
    df = spark.createDataFrame([(1, None, "x"), (1, 3, "x"), (2, 3, "y")], "a INT, b INT, side STRING")
    counted = quantiles.long_counts(df, {"first": "a", "second": "b"}, ["side"])
    assert "Expand" not in optimized(counted)
    assert sorted(tuple(r) for r in counted.select("side", "name", "cell", "n").collect()) == [
        ("x", "first", 1, 2), ("x", "second", 3, 1), ("y", "first", 2, 1), ("y", "second", 3, 1)]


def test_few_cells_are_summed_without_sorting(monkeypatch):
    rng = np.random.default_rng(1)
    cell = trees._cell(rng.integers(0, 3, 500), rng.integers(0, 2, 500), rng.integers(0, 200, 500), 2)
    g, h, n = rng.normal(size=500), rng.random(500), np.ones(500)

    def summed():
        cells = trees._Cells(3, 2)
        cells.add(cell[:300], g[:300], h[:300], n[:300])
        cells.add(cell[300:], g[300:], h[300:], n[300:])
        return [r for batch in cells.rows() for r in batch.to_pylist()]

    plain = summed()
    monkeypatch.setattr(trees, "CELLS", 10)  # beyond it cells are sorted, as all were
    assert summed() == plain and sum(r["n"] for r in plain) == 500
    monkeypatch.setattr(trees, "CELLS", 10_000)
    monkeypatch.setattr(np, "unique", None)
    assert summed() == plain


def test_candidates_share_one_preparation(spark, sf_dir, monkeypatch):
    fits = []
    monkeypatch.setattr(queries.prep, "fit", lambda train, approximate=False, fit=queries.prep.fit: fits.append(1) or fit(train, approximate))
    monkeypatch.setitem(queries.QUICK_TREES, "histogram_boosting", lambda rows: trees.HistogramBoosting(maxIter=1, labelCol=policy.LABEL))
    monkeypatch.setitem(queries.QUICK_TREES, "logistic_regression", lambda rows: training.logistic_regression(rows).setMaxIter(2))
    monkeypatch.setattr(session, "_written", {})
    models = queries._all_fitted(spark, sf_dir, ["logistic_regression", "histogram_boosting"])
    assert list(models) == ["logistic_regression", "histogram_boosting"] and len(fits) == 1
