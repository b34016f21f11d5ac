"""Stored sketches stand for the reference window; incremental builds equal full ones."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dispatchlens import policy
from dispatchlens.operators import drift, order_features, sketches
from dispatchlens.operators.scoring import SCORE
from dispatchlens.plans import incremental
from dispatchlens.sources import adapter
from dispatchlens.sources.layers import Layers


def rows_of(spark, window, values, late):
    return spark.createDataFrame([(window, v, int(y)) for v, y in zip(values, late)], f"window STRING, v DOUBLE, {policy.LABEL} INT")


@pytest.mark.parametrize("k, parts", [(200, 1), (200, 9), (4096, 5)])
def test_edges_have_their_ranks(spark, k, parts):
    rng = np.random.default_rng(k)
    values = np.concatenate([rng.normal(size=20_000), rng.integers(0, 3, 20_000)])
    df = rows_of(spark, "reference", map(float, values), rng.random(40_000) < 0.3).withColumn("part", F.pmod(F.hash("v"), F.lit(parts)))
    made = sketches.merged(sketches.sketched(df, {"m": "v"}, by=["part"], k=k))
    assert made.first().rows == 40_000 and made.first().late == df.agg(F.sum(policy.LABEL)).first()[0]
    for place, edge in enumerate(made.select(F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / 10) for i in range(11)]))).first()[0]):
        low, high = (values < edge).mean(), (values <= edge).mean()
        assert low - 2 * sketches.rank_error(k) <= place / 10 <= high + 2 * sketches.rank_error(k)
    assert all(r.within for r in sketches.rank_check(df, made, {"m": "v"}, k=k).collect())


def test_psi_from_sketches_is_near_the_exact_one(spark):
    rng = np.random.default_rng(1)
    past = rows_of(spark, "reference", [*map(float, rng.normal(size=8000)), None, math.nan], [0, 1] * 4001)
    now = rows_of(spark, "current", map(float, rng.normal(0.6, 1.2, size=3000)), [1, 0, 0] * 1000)
    exact = drift.psi(past.unionByName(now), {"m": "v"}).first()
    got = sketches.psi(now, sketches.sketched(past, {"m": "v"}), {"m": "v"}).first()
    assert got.psi == pytest.approx(exact.psi, abs=0.02) and not got.psi_undefined


@pytest.mark.parametrize("past, now, undefined, psi", [
    ([None], [1.0], False, 0.0), ([2.0] * 9, [2.0, 3.0], False, 0.0), ([1.0, 2.0], [None], False, 0.0), ([1.0, 2.0], [7.0], True, math.nan)])
def test_edge_cases_of_sketched_psi(spark, past, now, undefined, psi):
    made = sketches.sketched(rows_of(spark, "reference", past, [0] * len(past)), {"m": "v"})
    got = sketches.psi(rows_of(spark, "current", now, [0] * len(now)), made, {"m": "v"}).first()
    assert got.psi_undefined == undefined and (math.isnan(got.psi) if undefined else got.psi == psi)


def test_monitor_row_without_the_reference_window(spark):
    """Only sketches and the current rows are read; the verdict is that of the full computation."""
    rng = np.random.default_rng(2)
    n = 4000
    table = spark.createDataFrame([(float(a), float(b), int(b > 0.5), "current" if i % 4 == 0 else "reference", i) for i, (a, b) in enumerate(rng.random((n, 2)))],
                                  f"x DOUBLE, {SCORE} DOUBLE, {policy.LABEL} INT, window STRING, i INT")
    table = table.withColumns({f: F.when((F.col("window") == "current") & F.lit(f == policy.DRIFT_FEATURES[0]), F.pow("x", F.lit(0.5))).otherwise(F.col("x")) for f in policy.DRIFT_FEATURES})
    exact = drift.decide(drift.monitor_row(table)).first()
    made = sketches.sketched(table.where("window = 'reference'"))
    got = drift.decide(sketches.monitor_row(table.where("window = 'current'"), made)).first()
    assert got.reasons == exact.reasons == ["feature_psi>threshold"] and got.label_drift == pytest.approx(exact.label_drift)
    assert got.max_feature_psi == pytest.approx(exact.max_feature_psi, rel=0.05) and got.current_auc == exact.current_auc


# Incremental build ---------------------------------------------------------------------------

def state(spark, layers):
    """Files of each month with their names, which a rewritten month changes."""
    return {r.month: r.files for r in layers.read("features", incremental.TABLE).withColumn("file", F.input_file_name()).groupBy("month").agg(
        F.array_sort(F.collect_set("file")).alias("files")).collect()}


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.select(a.columns).collect()))


def test_only_changed_months_are_built(spark, sf_dir, tmp_path):
    raw = {k: v.persist() for k, v in adapter.feature_inputs(spark, sf_dir).items()}
    layers = Layers(spark, str(tmp_path))
    months = incremental.build(layers, **raw)
    assert len(months) > 12 and same(incremental.read(layers), order_features.order_features(**raw))
    before = state(spark, layers)
    assert incremental.build(layers, **raw) == [] and state(spark, layers) == before

    month = months[5]
    of_month = F.date_format("order_purchase_timestamp", "yyyy-MM") == month
    one = raw["orders"].where(of_month & (F.col("order_status") == "delivered") & F.col("order_approved_at").isNotNull()).select("order_id").join(
        raw["items"], "order_id", "left_semi").first().order_id
    later = raw | {"items": raw["items"].withColumn("price", F.when(F.col("order_id") == one, F.col("price") + 5).otherwise(F.col("price")))}
    assert incremental.build(layers, **later) == [month]
    after = state(spark, layers)
    assert {m for m in after if after[m] != before[m]} == {month}
    assert same(incremental.read(layers), order_features.order_features(**later))

    # an order moves to another month, and a month vanishes
    gone, to = months[7], months[3]
    moved = raw["orders"].where(F.date_format("order_purchase_timestamp", "yyyy-MM") != gone).withColumn(
        "order_purchase_timestamp", F.when(F.col("order_id") == one, F.to_timestamp_ntz(F.lit(f"{to}-03 00:00:00"))).otherwise(F.col("order_purchase_timestamp")))
    last = raw | {"orders": moved}
    assert incremental.build(layers, **last) == sorted({month, to})
    assert gone not in state(spark, layers) and same(incremental.read(layers), order_features.order_features(**last))
    # a month without delivered orders keeps no old rows
    none = last | {"orders": moved.withColumn("order_status", F.when(F.date_format("order_purchase_timestamp", "yyyy-MM") == to, "shipped").otherwise(F.col("order_status")))}
    assert incremental.build(layers, **none) == [to]
    assert to not in state(spark, layers) and same(incremental.read(layers), order_features.order_features(**none))


def test_a_changed_seller_or_payment_changes_its_months(spark, sf_dir, tmp_path):
    raw = {k: v.persist() for k, v in adapter.feature_inputs(spark, sf_dir).items()}
    layers = Layers(spark, str(tmp_path))
    incremental.build(layers, **raw)
    order = raw["payments"].first().order_id
    paid = raw["payments"].withColumn("payment_type", F.when(F.col("order_id") == order, "cash").otherwise(F.col("payment_type")))
    month = raw["orders"].where(F.col("order_id") == order).select(F.date_format("order_purchase_timestamp", "yyyy-MM")).first()[0]
    assert incremental.build(layers, **raw | {"payments": paid}) == [month]
    seller = raw["items"].first().seller_id
    sold = raw["sellers"].withColumn("seller_state", F.when(F.col("seller_id") == seller, "ELSEWHERE").otherwise(F.col("seller_state")))
    touched = {r[0] for r in raw["items"].where(F.col("seller_id") == seller).join(raw["orders"], "order_id").select(
        F.date_format("order_purchase_timestamp", "yyyy-MM")).distinct().collect()}
    assert set(incremental.build(layers, **raw | {"payments": paid, "sellers": sold})) == touched
