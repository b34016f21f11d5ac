"""The test tables (orders, lineitem, part, ...) in the shape of the raw order tables.

All columns are arithmetic on existing columns.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

# Payment types by (order key + sequence) modulo four.
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")


SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table by its declared schema, so no job reads footers first."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table stored in fewer splits than there are cores, dealt out over them evenly, whatever its keys.

    Tables with enough splits stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _plus(unit: str, amount, ts):
    return F.timestamp_add(unit, amount.cast("int"), ts)


def _purchase():
    k = F.col("o_orderkey")
    return _plus("SECOND", k % 3600, _plus("HOUR", k % 24, F.col("o_orderdate")))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    delivered = F.col("o_orderstatus") != "P"
    return table(spark, sf_dir, "orders").select(
        k.alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.when(delivered, "delivered").otherwise("shipped").alias("order_status"),
        _purchase().alias("order_purchase_timestamp"),
        F.when(k % 97 != 0, _plus("HOUR", k % 20, _purchase())).alias("order_approved_at"),
        _plus("DAY", 2 + k % 5, F.col("o_orderdate")).alias("order_delivered_carrier_date"),
        F.when(delivered, _plus("DAY", 3 + (k * 7) % 40, F.col("o_orderdate")))
        .alias("order_delivered_customer_date"),
        _plus("DAY", 8 + k % 33, F.col("o_orderdate")).alias("order_estimated_delivery_date"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), _purchase().alias("bought"))
    lines = spread(table(spark, sf_dir, "lineitem"))
    return lines.join(bought, "l_orderkey").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
        _plus("DAY", 2 + F.col("l_linenumber") % 7, F.col("bought")).alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"), (F.col("l_quantity") * 0.5).alias("freight_value"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        k.alias("product_id"), F.when(k % 50 != 0, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        (F.length("p_name") * 10).alias("product_description_lenght"),
        (1 + k % 6).cast("int").alias("product_photos_qty"),
        F.when(k % 53 != 0, size * 100.0).alias("product_weight_g"),
        (15.0 + size).alias("product_length_cm"),
        (5.0 + size % 20).alias("product_height_cm"),
        (10.0 + size % 30).alias("product_width_cm"))


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("seller_state"))
    return table(spark, sf_dir, "supplier").join(nation, "s_nationkey").select(
        k.alias("seller_id"), (1000 + k * 7).cast("int").alias("seller_zip_code_prefix"),
        (k % 12).cast("string").alias("seller_city"), "seller_state")


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, seq = F.col("o_orderkey"), F.col("payment_sequential")
    kind = F.element_at(F.array(*[F.lit(t) for t in PAYMENT_TYPES]), ((k + seq) % 4 + 1).cast("int"))
    return (table(spark, sf_dir, "orders").where(k % 61 != 0)
            .select(k, "o_totalprice",
                    F.explode(F.sequence(F.lit(1), (1 + k % 2).cast("int"))).alias("payment_sequential"))
            .select(k.alias("order_id"), seq, kind.alias("payment_type"),
                    F.when(kind == "credit_card", 1 + k % 10).otherwise(1).cast("int")
                    .alias("payment_installments"),
                    (F.col("o_totalprice") / (1 + k % 2)).alias("payment_value")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_state"))
    return table(spark, sf_dir, "customer").join(nation, "c_nationkey").select(
        k.alias("customer_id"), F.col("c_name").alias("customer_unique_id"),
        (1000 + k * 3).cast("int").alias("customer_zip_code_prefix"),
        (k % 12).cast("string").alias("customer_city"), "customer_state")


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per order that arrived, in the order table's own words."""
    arrived = orders(spark, sf_dir).where("order_delivered_customer_date IS NOT NULL")
    k, day = F.col("order_id"), F.col("order_delivered_customer_date")
    return arrived.select(
        F.concat(F.lit("r"), k.cast("string")).alias("review_id"), k.alias("order_id"),
        (1 + k % 5).cast("int").alias("review_score"),
        F.when(k % 3 == 0, F.concat(F.lit("title, "), k.cast("string"))).alias("review_comment_title"),
        F.when(k % 4 == 0, F.concat(F.lit("said \"ok\"\nline "), k.cast("string")))
        .alias("review_comment_message"),
        _plus("DAY", F.lit(1), day).alias("review_creation_date"),
        _plus("DAY", 2 + k % 3, day).alias("review_answer_timestamp"))


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "part").select("p_type").distinct()
            .select(F.col("p_type").alias("product_category_name"),
                    F.lower("p_type").alias("product_category_name_english")))


RAW = {"orders": orders, "order_items": order_items, "customers": customers, "sellers": sellers,
       "products": products, "order_payments": order_payments, "order_reviews": order_reviews,
       "product_category_name_translation": category_translation}


def feature_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Keyword arguments for order_features."""
    return {"orders": orders(spark, sf_dir), "items": order_items(spark, sf_dir),
            "products": products(spark, sf_dir), "sellers": sellers(spark, sf_dir),
            "payments": order_payments(spark, sf_dir)}


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service request log; event_id is the source's own record id."""
    return as_request_log(table(spark, sf_dir, "events"))


def as_request_log(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        "event_id", F.col("user_id").cast("string").alias("request_id"),
        F.lit("POST").alias("method"), kind.alias("endpoint"),
        F.when(kind == "error", 500).otherwise(200).alias("status"),
        F.col("value").alias("latency_ms"), "ts")


def _pick(number, *values):
    """The value at position number modulo their count."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def deploy_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One deploy attempt per event, in the words of a deploy hook."""
    e = F.col("event_id")

    def commit(number):
        return F.md5(number.cast("string"))

    return table(spark, sf_dir, "events").select(
        e, commit(e).alias("new_commit"), commit(e - 1).alias("old_commit"),
        F.date_format(_plus("SECOND", -(e % 120), F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("started_at"),
        F.when(e % 29 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("not a time")
        .alias("finished_at"),
        F.when(e % 31 != 0, (e % 120).cast("string")).otherwise("n/a").alias("duration_seconds"),
        F.lit("main").alias("branch"),
        F.concat(F.lit("app/m"), (e % 7).cast("string"), F.lit(".py\n\ntests/t"), (e % 3).cast("string"),
                 F.lit(".py")).alias("changed_paths"),
        _pick(e, "success", "tests_failed", "success", "ff_failed", "error", "fetch_failed").alias("status"),
        _pick(e, "ok", "no", "failed", "unconfirmed").alias("restart"),
        F.when(e % 3 == 0, "queued").alias("trigger"), _pick(e, "ok", "no", "no", "FAILED").alias("import"),
        F.when(e % 3 == 0, F.concat(F.lit("retrain__"), e.cast("string"))).otherwise("").alias("dag_run_id"),
        F.concat(F.lit("host"), (e % 4).cast("string")).alias("host"))


def retrain_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """None, one or two outcomes per queued retrain, some without an id; `position` is the append order."""
    e = F.col("event_id")
    states = F.array(_pick(e, "success", "failed", "timeout"), F.lit("success"))
    return (table(spark, sf_dir, "events").where((e % 3 == 0) & (e % 9 != 0))
            .select(e, F.posexplode(F.slice(states, 1, (1 + e % 2).cast("int"))).alias("nth", "state"))
            .select((e * 2 + F.col("nth")).alias("position"),
                    F.when(e % 11 != 0, F.concat(F.lit("retrain__"), e.cast("string"))).alias("dag_run_id"),
                    "state", F.md5(e.cast("string")).alias("deploy_commit")))


def timed_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcomes with the time they were recorded at, half an hour after the run and then after each other."""
    return (retrain_outcomes(spark, sf_dir).join(
        table(spark, sf_dir, "events").select(F.md5(F.col("event_id").cast("string")).alias("deploy_commit"), "ts"), "deploy_commit")
        .withColumn("recorded_at", iso(_plus("MINUTE", 30 * (1 + F.col("position") % 2), F.col("ts")))).drop("ts"))


def iso(ts):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def log_lines(events: DataFrame, ts: str, logger: str, message: str, request_id) -> DataFrame:
    """Log records: the envelope in front of the event's own fields."""
    return events.select(iso(ts).alias("timestamp"), F.lit("INFO").alias("level"), F.lit(logger).alias("logger"), F.lit(message).alias("message"),
                         request_id.alias("request_id"), *[c for c in events.columns if c not in (ts, "request_id")])


def arrivals(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    """One of three deliveries of the events: a third of the days each; every 50th event comes a delivery late, every 10th twice."""
    e = F.col("event_id")
    at = F.floor((F.dayofmonth("ts") - 1) / 10) + F.when(e % 50 == 7, 1).otherwise(0)
    once = F.least(at, F.lit(2))
    sent = F.array_compact(F.array(once, F.when(e % 10 == 3, F.least(once + 1, F.lit(2))))).cast("array<int>")
    return (table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.explode(sent).alias("delivery"))
            .where(F.col("delivery") == batch))


def write_json_lines(records: DataFrame, order: str, path: str) -> None:
    """Records as JSON lines in append order, with a blank line now and then and cut-off lines."""
    line, at = F.to_json(F.struct(*[c for c in records.columns if c != order])), F.col(order)
    lines = F.array_compact(F.array(F.when(at % 13 == 0, line.substr(F.lit(1), F.length(line) - 4)), line,
                                    F.when(at % 17 == 0, F.lit(""))))
    (records.repartitionByRange(order).sortWithinPartitions(order)
     .select(F.explode(lines).alias("value")).write.text(path))
