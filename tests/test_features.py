"""Hand-computed feature cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dispatchlens import policy, schemas
from dispatchlens.functions import expressions as X
from dispatchlens.operators import contract, order_features as O

T0 = dt.datetime(2018, 2, 26, 10, 0)


def frames(spark, orders=None, items=None, products=None, sellers=None, payments=None):
    def make(rows, schema):
        return spark.createDataFrame(rows or [], schema)

    return {"orders": make(orders, schemas.ORDERS), "items": make(items, schemas.ORDER_ITEMS),
            "products": make(products, schemas.PRODUCTS), "sellers": make(sellers, schemas.SELLERS),
            "payments": make(payments, schemas.ORDER_PAYMENTS)}


def order(key, status="delivered", bought=T0, approved=dt.timedelta(hours=3), arrived=dt.timedelta(days=9),
          promised=dt.timedelta(days=8)):
    def at(d):
        return None if d is None else bought + d
    return (key, "c", status, bought, at(approved), None, at(arrived), at(promised))


def item(key, n, product="p1", seller="s1", price=10.0, freight=2.0, days=3):
    return (key, n, product, seller, T0 + dt.timedelta(days=days), price, freight)


PRODUCTS = [("p1", "toys", 1, 1, 1, 100.0, 1.0, 2.0, 3.0), ("p2", "art", 1, 1, 1, None, 2.0, 2.0, 2.0),
            ("p3", None, 1, 1, 1, 300.0, None, 2.0, 2.0)]
SELLERS = [("s1", 200, "x", "SP"), ("s2", 30, "y", "RJ"), ("s3", 1000, "x", "RJ")]


def one(spark, **tables):
    rows = O.order_features(**frames(spark, products=PRODUCTS, sellers=SELLERS, **tables)).collect()
    assert len(rows) == 1
    return rows[0]


def test_item_aggregates_and_modes(spark):
    row = one(spark, orders=[order("a")], items=[
        item("a", 1, "p1", "s1", 10.0, 1.0), item("a", 2, "p2", "s2", 20.0, 2.0, days=5),
        item("a", 3, "p2", "s3", 30.0, 3.0, days=2)])
    assert (row.order_item_count, row.product_count, row.seller_count) == (3, 2, 3)
    assert (row.price_sum, row.price_mean, row.price_max, row.price_std) == (60.0, 20.0, 30.0, 10.0)
    assert row.total_cost_sum == 66.0
    assert (row.product_category_count, row.product_category_mode, row.is_multi_category) == (2, "art", True)
    assert (row.seller_state_mode, row.seller_state_count, row.seller_city_count) == ("RJ", 2, 2)
    assert row.seller_zip_mode == 30  # a three-way tie takes the smallest number, not the smallest text
    assert (row.product_weight_g_mean, row.product_volume_max) == (100.0, 8.0)
    assert (row.shipping_limit_min_days, row.shipping_window_days, row.seller_margin_days) == (2, 6, 3)


def test_mode_tie_takes_first_in_sort_order(spark):
    row = one(spark, orders=[order("a")], items=[item("a", 1, "p1"), item("a", 2, "p2")],
              payments=[("a", 1, "voucher", 1, 1.0), ("a", 2, "boleto", 4, 1.0)])
    assert row.product_category_mode == "art"
    assert (row.payment_type_mode, row.payment_count, row.max_installments) == ("boleto", 2, 4.0)


def test_single_line_has_no_deviation_and_defaults_fill_in(spark):
    row = one(spark, orders=[order("a")], items=[item("a", 1, "p3", "none")])
    assert row.price_std is None and row.freight_std is None
    assert (row.payment_count, row.payment_type_mode, row.max_installments) == (0, "unknown", 0.0)
    assert (row.product_category_mode, row.product_category_count) == ("unknown", 0)
    assert (row.seller_state_mode, row.seller_zip_mode, row.seller_state_count) == ("unknown", 0, 0)
    assert row.product_volume_mean is None and row.is_multi_category is False


def test_only_complete_delivered_orders_with_items_stay(spark):
    tables = frames(spark, orders=[
        order("a"), order("b", status="shipped"), order("c", approved=None), order("d", arrived=None),
        order("e", promised=None), order("no items")],
        items=[item(k, 1) for k in "abcde"], products=PRODUCTS, sellers=SELLERS)
    assert [r.order_id for r in O.order_features(**tables).collect()] == ["a"]


def test_windows_round_part_days_up_and_keep_whole_days(spark):
    def windows(approved, promised):
        row = one(spark, orders=[order("a", approved=approved, promised=promised)], items=[item("a", 1, days=3)])
        return row.estimated_delivery_days, row.approval_delay_hours, row.shipping_window_days

    day, second = dt.timedelta(days=1), dt.timedelta(seconds=1)
    assert windows(1.5 * day / 24, 8 * day) == (8, 1.5, 5)
    assert windows(-day, 8 * day + second) == (9, 0.0, 6)
    assert windows(day, -2 * day) == (1, 24.0, -5)


@pytest.mark.parametrize("day, expected", [
    (dt.datetime(2016, 2, 27), (6, 1, 2, 1, 1)), (dt.datetime(2016, 2, 26), (5, 0, 2, 1, 0)),
    (dt.datetime(2018, 2, 26, 23), (1, 0, 2, 1, 1)), (dt.datetime(2018, 12, 30), (0, 1, 12, 4, 1)),
    (dt.datetime(2018, 4, 27), (5, 0, 4, 2, 0))])
def test_calendar(spark, day, expected):
    df = spark.createDataFrame([(day,)], "ts TIMESTAMP_NTZ").select(*O.calendar_columns("ts"))
    r = df.first()
    assert (r.purchase_dayofweek, r.is_weekend_purchase, r.purchase_month, r.purchase_quarter,
            r.is_month_end) == expected


def test_label_is_strictly_later(spark):
    d = dt.timedelta(days=8)
    assert one(spark, orders=[order("a", arrived=d, promised=d)], items=[item("a", 1)]).is_late_delivery == 0
    assert one(spark, orders=[order("a", arrived=d + dt.timedelta(seconds=1), promised=d)],
               items=[item("a", 1)]).is_late_delivery == 1


def test_hot_order_is_exact(spark):
    """One order with most lines: counts and modes agree with plain grouping."""
    lines = spark.range(30_000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("o"), F.col("id") % 500)).alias("order_id"),
        F.lit(1).alias("order_item_id"), (F.col("id") % 7919).cast("string").alias("product_id"),
        (F.col("id") % 1009).cast("string").alias("seller_id"), F.lit(T0).cast("timestamp_ntz").alias("shipping_limit_date"),
        (F.col("id") % 100).cast("double").alias("price"), F.lit(1.0).alias("freight_value"))
    products = spark.range(7919).select(F.col("id").cast("string").alias("product_id"),
                                        F.concat(F.lit("c"), F.col("id") % 13).alias("product_category_name"),
                                        *[F.lit(1.0).alias(c) for c in O.SIZES])
    sellers = spark.range(1009).select(F.col("id").cast("string").alias("seller_id"),
                                       (F.col("id") % 300).cast("int").alias("seller_zip_code_prefix"),
                                       (F.col("id") % 5).cast("string").alias("seller_city"),
                                       (F.col("id") % 3).cast("string").alias("seller_state"))
    pdf = lines.toPandas().merge(products.toPandas(), on="product_id").merge(sellers.toPandas(), on="seller_id")
    groups = pdf.groupby("order_id")
    got = {r.order_id: r for r in O.item_values(lines, products, sellers).collect()}
    assert set(got) == set(groups.groups)
    for key, g in groups:
        r = got[key]
        assert (r.product_count, r.seller_count, r.seller_city_count) == (
            g.product_id.nunique(), g.seller_id.nunique(), g.seller_city.nunique())
        assert (r.product_category_mode, r.seller_zip_mode) == (
            g.product_category_name.mode()[0], g.seller_zip_code_prefix.mode()[0])


def test_hot_order_takes_no_gathering_operator(spark):
    plan = O.item_values(*[frames(spark, products=PRODUCTS, sellers=SELLERS, items=[item("a", 1)])[k]
                           for k in ("items", "products", "sellers")])._jdf.queryExecution().toString()
    assert "collect_" not in plan and "Window" not in plan


def test_contract_reports_both_directions(spark):
    table = O.order_features(**frames(spark))
    with pytest.raises(contract.ContractError, match=r"missing: \['price_sum'\].*\['extra'\]"):
        contract.check_feature_columns(table.drop("price_sum").withColumn("extra", F.lit(1)))
    with pytest.raises(contract.ContractError, match="outcome fields"):
        contract.reject_unknown_columns(table)
    with pytest.raises(contract.ContractError, match="unknown"):
        contract.reject_unknown_columns(table.drop(policy.LABEL).withColumn("extra", F.lit(1)))


@pytest.mark.parametrize("text, seconds", [
    ("2026-07-07T18:00:00Z", 1783447200.0), ("2026-07-07T18:00:00+02:00", 1783440000.0),
    ("2026-07-07T18:00:00.5Z", 1783447200.5), ("2026-07-07", 1783382400.0), ("", 0.0), (None, 0.0),
    ("not a time", 0.0), ("2026", 0.0), ("2026-13-07T18:00:00Z", 0.0)])
def test_iso_epoch(spark, text, seconds):
    df = spark.createDataFrame([(text,)], "t STRING").select(X.iso_epoch("t").alias("s"))
    assert df.first().s == seconds


def test_round_half_even_and_clip(spark):
    df = spark.createDataFrame([(0.5, 1.7), (1.5, -0.2), (2.5, 0.3)], "a DOUBLE, p DOUBLE").select(
        X.round_half_even(F.col("a"), 0).alias("a"), X.clip_unit(F.col("p")).alias("p"))
    assert [tuple(r) for r in df.collect()] == [(0.0, 1.0), (2.0, 0.0), (2.0, 0.3)]
