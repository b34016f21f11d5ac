"""Feature build by purchase month: only months whose orders, lines, payments, products or sellers changed are built anew."""

from pyspark.sql import Column, DataFrame, functions as F

from dispatchlens import policy, session
from dispatchlens.operators import contract, order_features
from dispatchlens.sources import files
from dispatchlens.sources.layers import Layers

TABLE, DIGESTS, MONTH = "featureset_v1_by_month", "featureset_v1_digests", "month"
NO_MONTH = "none"


def _month(column: str) -> Column:
    return F.coalesce(F.date_format(column, "yyyy-MM"), F.lit(NO_MONTH))


def _hash(df: DataFrame) -> Column:
    # Nulls are left out by the hash, so that each value gets its place.
    return F.xxhash64(*[F.struct(F.lit(i), F.col(c)) for i, c in enumerate(df.columns)])


def _sum(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(38,0)"))


def month_digests(orders: DataFrame, items: DataFrame, products: DataFrame, sellers: DataFrame, payments: DataFrame) -> DataFrame:
    """(month, orders, digest): a sum of hashes over all that a month's features are made of, the same in any order of rows."""
    p = products.select("product_id", _hash(products).alias("_p"))
    s = sellers.select("seller_id", _hash(sellers).alias("_s"))
    # Hashed before they are dealt out by product and by seller: a line is three ids and a number there.
    lines = items.select(policy.ORDER_ID, "product_id", "seller_id", _hash(items).alias("_item")).join(p, "product_id", "left").join(s, "seller_id", "left")
    lines = lines.select(policy.ORDER_ID, F.xxhash64("_item", F.coalesce("_p", F.lit(0)), F.coalesce("_s", F.lit(0))).alias("_line"))
    of_lines = lines.groupBy(policy.ORDER_ID).agg(_sum("_line").alias("_lines"))
    of_payments = payments.select(policy.ORDER_ID, _hash(payments).alias("_paid")).groupBy(policy.ORDER_ID).agg(_sum("_paid").alias("_payments"))
    own = orders.select(policy.ORDER_ID, _month("order_purchase_timestamp").alias(MONTH), _hash(orders).alias("_own"))
    whole = own.join(of_lines, policy.ORDER_ID, "left").join(of_payments, policy.ORDER_ID, "left")
    whole = whole.withColumn("_order", F.xxhash64("_own", F.coalesce(F.col("_lines").cast("string"), F.lit("-")), F.coalesce(F.col("_payments").cast("string"), F.lit("-"))))
    return whole.groupBy(MONTH).agg(F.count("*").alias("orders"), _sum("_order").alias("digest"))


def changed_months(layers: Layers, digests: DataFrame) -> tuple[list[str], list[str], bool]:
    """(months that are new or differ from the stored digests, months that are gone, whether no month is as it was). A row per month
    comes to the driver."""
    now = {r[MONTH]: (r["orders"], r["digest"]) for r in digests.collect()}
    was = {}
    if files.exists(layers.spark, layers.path("features", DIGESTS)):
        was = {r[MONTH]: (r["orders"], r["digest"]) for r in layers.read("features", DIGESTS).collect()}
    changed = sorted(m for m in now if was.get(m) != now[m])
    return changed, sorted(set(was) - set(now)), len(changed) == len(now)


def build(layers: Layers, orders: DataFrame, items: DataFrame, products: DataFrame, sellers: DataFrame, payments: DataFrame) -> list[str]:
    """Bring the feature table up to date; returns the months that were built.

    Partitions are overwritten one by one, the digests afterwards: a build that breaks off is made up for by the next one.
    """
    with session.shuffles_deleted(layers.spark):
        return _build(layers, orders, items, products, sellers, payments)


def _build(layers: Layers, orders: DataFrame, items: DataFrame, products: DataFrame, sellers: DataFrame, payments: DataFrame) -> list[str]:
    spark = layers.spark
    digests = month_digests(orders, items, products, sellers, payments)
    path = layers.path("features", f"{DIGESTS}.next")
    digests.write.mode("overwrite").parquet(path)
    digests = spark.read.parquet(path)
    changed, gone, all_changed = changed_months(layers, digests)
    if changed:
        own = orders
        if not all_changed:
            own = orders.where(_month("order_purchase_timestamp").isin(changed))
            ids = own.select(policy.ORDER_ID)
            items, payments = (t.join(ids, policy.ORDER_ID, "left_semi") for t in (items, payments))
        table = order_features.order_features(own, items, products, sellers, payments)
        rows = contract.check_feature_columns(table).withColumn(MONTH, _month(policy.PURCHASE_TS))
        before = _stored_files(layers, changed)
        (rows.repartition(MONTH, F.pmod(F.xxhash64(policy.ORDER_ID), F.lit(_files_per_month(own, len(changed)))))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(layers.path("features", TABLE)))
        # A month that has no feature rows any more writes nothing over its old ones: its files are the ones from before.
        after = _stored_files(layers, changed)
        gone = sorted({*gone, *(m for m in changed if after[m] == before[m])})
    for month in gone:
        files.delete(spark, f"{layers.path('features', TABLE)}/{MONTH}={month}")
    layers.replace("features", DIGESTS, digests)
    files.delete(spark, path)
    return changed


def _stored_files(layers: Layers, months: list[str]) -> dict[str, list[str]]:
    """Names of the files of each month, which a write replaces by others."""
    folder = layers.path("features", TABLE)
    return {m: files.names(layers.spark, f"{folder}/{MONTH}={m}") for m in months}


def _files_per_month(orders: DataFrame, months: int, rows_per_file: int = 2_000_000) -> int:
    return max(1, -(-orders.count() // (months * rows_per_file)))


def read(layers: Layers) -> DataFrame:
    """The feature table in contract order."""
    return contract.check_feature_columns(layers.read("features", TABLE).drop(MONTH))
