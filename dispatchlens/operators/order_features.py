"""One row per delivered order: 45 purchase-time features, the label and the split key.

Every aggregation state has a fixed size. Lines are dealt out by order once, before they are copied per dimension or
summed, so that all groupings and the joins with the orders find them in place. Distinct counts and modes first count
(order, dimension, value) and only then roll up to the order; an order with a huge share of all lines runs
through one task, but is never gathered into one buffer.
"""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from dispatchlens import policy
from dispatchlens.functions import expressions as X

SIZES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")

EVENT_FIELDS = ("order_purchase_timestamp", "order_approved_at",
                "order_delivered_customer_date", "order_estimated_delivery_date")


def delivered_orders(orders: DataFrame) -> DataFrame:
    """Delivered orders with all four times known."""
    keep = F.col("order_status") == "delivered"
    for field in EVENT_FIELDS:
        keep = keep & F.col(field).isNotNull()
    return orders.where(keep).select(policy.ORDER_ID, *EVENT_FIELDS)


def priced_lines(items: DataFrame, products: DataFrame) -> DataFrame:
    """Item lines with their total cost and the product's sizes and volume."""
    return _derived_lines(_sized_lines(items, products))


def _sized_lines(items: DataFrame, products: DataFrame) -> DataFrame:
    return items.join(products.select("product_id", *SIZES), "product_id", "left").select(
        policy.ORDER_ID, "price", "freight_value", "shipping_limit_date", *SIZES)


def _derived_lines(lines: DataFrame) -> DataFrame:
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return lines.select(
        policy.ORDER_ID, "price", "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_cost"),
        "shipping_limit_date", *SIZES, volume.alias("product_volume"))


def item_measures(items: DataFrame, products: DataFrame) -> DataFrame:
    """Counts, sums, means, maxima, sample deviations and deadline bounds per order."""
    aggs = [F.count("*").alias("order_item_count")]
    for source, name in (("price", "price"), ("freight_value", "freight"), ("total_cost", "total_cost")):
        aggs += [F.sum(source).alias(f"{name}_sum"), F.avg(source).alias(f"{name}_mean"),
                 F.max(source).alias(f"{name}_max")]
    for source, name in (("price", "price"), ("freight_value", "freight")):
        aggs.append(F.stddev_samp(source).alias(f"{name}_std"))
    for size in (*SIZES, "product_volume"):
        aggs += [F.avg(size).alias(f"{size}_mean"), F.max(size).alias(f"{size}_max")]
    aggs += [F.min("shipping_limit_date").alias("shipping_limit_min"),
             F.max("shipping_limit_date").alias("shipping_limit_max")]
    # An order has few lines, and one line takes less room than the states of all these sums.
    return _derived_lines(_sized_lines(items, products).repartition(policy.ORDER_ID)).groupBy(policy.ORDER_ID).agg(*aggs)


def _most_frequent(is_candidate: Column, value: str) -> Column:
    """Value with the largest count, the smallest value on a tie; null without candidates."""
    best = F.min(F.when(is_candidate, F.struct((-F.col("n")).alias("rank"), F.col(value).alias("value"))))
    return best["value"]


def item_values(items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Distinct counts and most frequent values of products, sellers and their attributes."""
    columns = {"product": "product_id", "seller": "seller_id", "category": "product_category_name",
               "state": "seller_state", "city": "seller_city", "zip": "seller_zip_code_prefix"}
    lines = (items.select(policy.ORDER_ID, "product_id", "seller_id")
             .join(products.select("product_id", "product_category_name"), "product_id", "left")
             .join(sellers.select("seller_id", "seller_state", "seller_city", "seller_zip_code_prefix"),
                   "seller_id", "left")
             .select(policy.ORDER_ID, *columns.values()).repartition(policy.ORDER_ID))
    kinds = {dim: lines.schema[c].dataType for dim, c in columns.items()}
    number = {dim: isinstance(kind, T.IntegralType) for dim, kind in kinds.items()}
    # A line becomes a narrow row per dimension where it lies already.
    cells = F.array(*[F.struct(F.lit(i).alias("dim"), (F.col(c) if number[dim] else F.lit(None)).cast("bigint").alias("number"),
                               (F.lit(None) if number[dim] else F.col(c)).cast("string").alias("text"))
                      for i, (dim, c) in enumerate(columns.items())])
    counted = (lines.select(policy.ORDER_ID, F.inline(cells))
               .groupBy(policy.ORDER_ID, "dim", "number", "text").agg(F.count("*").alias("n")))

    def value(dim):
        return "number" if number[dim] else "text"

    def known(dim):
        # A null value does not count.
        return (F.col("dim") == list(columns).index(dim)) & F.col(value(dim)).isNotNull()

    def mode(dim):
        return _most_frequent(known(dim), value(dim)).cast(kinds[dim])

    return counted.groupBy(policy.ORDER_ID).agg(
        F.count_if(known("product")).alias("product_count"),
        F.count_if(known("seller")).alias("seller_count"),
        F.count_if(known("category")).alias("product_category_count"),
        F.count_if(known("state")).alias("seller_state_count"),
        F.count_if(known("city")).alias("seller_city_count"),
        mode("category").alias("product_category_mode"),
        mode("state").alias("seller_state_mode"),
        mode("zip").alias("seller_zip_mode"))


def payment_profile(payments: DataFrame) -> DataFrame:
    """Row count, most frequent type and largest number of instalments per order."""
    by_type = payments.repartition(policy.ORDER_ID).groupBy(policy.ORDER_ID, "payment_type").agg(
        F.count("*").alias("n"), F.max("payment_installments").alias("installments"))
    return by_type.groupBy(policy.ORDER_ID).agg(
        F.sum("n").alias("payment_count"),
        _most_frequent(F.col("payment_type").isNotNull(), "payment_type").alias("payment_type_mode"),
        F.max("installments").alias("max_installments"))


def calendar_columns(ts: str) -> list[Column]:
    return [F.hour(ts).alias("purchase_hour"),
            X.day_of_week(ts).alias("purchase_dayofweek"),
            X.is_weekend(ts).alias("is_weekend_purchase"),
            F.month(ts).alias("purchase_month"),
            F.quarter(ts).alias("purchase_quarter"),
            X.is_month_end(ts).alias("is_month_end")]


def window_columns() -> list[Column]:
    """Promise, approval and deadline windows; all fixed at the time of purchase."""
    bought, promised = "order_purchase_timestamp", "order_estimated_delivery_date"
    return [F.greatest(X.ceil_days(bought, promised), F.lit(1)).alias("estimated_delivery_days"),
            F.greatest(X.elapsed_hours(bought, "order_approved_at"), F.lit(0.0)).alias("approval_delay_hours"),
            X.ceil_days(bought, "shipping_limit_min").alias("shipping_limit_min_days"),
            X.ceil_days("shipping_limit_min", promised).alias("shipping_window_days"),
            X.ceil_days("shipping_limit_max", promised).alias("seller_margin_days")]


def late_label() -> Column:
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    return late.cast("int").alias(policy.LABEL)


def order_features(orders: DataFrame, items: DataFrame, products: DataFrame, sellers: DataFrame,
                   payments: DataFrame) -> DataFrame:
    """The contract's 45 features in order, then order_id, label and purchase time.

    Orders without item lines drop out; orders without payments keep defaults.
    """
    joined = (delivered_orders(orders)
              .join(item_measures(items, products), policy.ORDER_ID)
              .join(item_values(items, products, sellers), policy.ORDER_ID, "left")
              .join(payment_profile(payments), policy.ORDER_ID, "left"))
    derived = joined.select(
        "*", *calendar_columns("order_purchase_timestamp"), *window_columns(), late_label(),
        F.col("order_purchase_timestamp").alias(policy.PURCHASE_TS),
        (F.coalesce("product_category_count", F.lit(0)) > 1).alias("is_multi_category"))
    filled = derived.withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("payment_count", "product_count", "seller_count",
                                              "product_category_count", "seller_state_count",
                                              "seller_city_count", "seller_zip_mode")}
        | {c: F.coalesce(c, F.lit("unknown")) for c in policy.CATEGORICAL}
        | {"max_installments": F.coalesce("max_installments", F.lit(0)).cast("double")})
    return filled.select(*policy.FEATURES, policy.ORDER_ID, policy.LABEL, policy.PURCHASE_TS)


def label_balance(features: DataFrame) -> DataFrame:
    return features.agg(F.avg(policy.LABEL).alias("late_rate"),
                        F.coalesce(F.sum(policy.LABEL), F.lit(0)).cast("bigint").alias("late"),
                        F.count("*").alias("total"))
