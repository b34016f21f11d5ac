"""The registered queries: every operator over the whole test tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dispatchlens import policy, schemas, session
from dispatchlens.functions import expressions as X
from dispatchlens.operators import (contract, drift, evaluation, importance, opslog, order_features as features_op,
                                    prep, scoring, service, sketches, split, training)
from dispatchlens.plans import incremental
from dispatchlens.sources import adapter, files, jsonl, tables
from dispatchlens.sources.layers import Layers, write_csv, write_report
from dispatchlens.streaming import opslog as stream_log, service as streams
from dispatchlens.streaming.arrivals import FATES, Arrivals
from dispatchlens.streaming.models import ModelPointer, ScoredTable

QUERIES = {}


def query(fn):
    """Register a query under its function name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(fn(session.tune(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return run


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded and times as text, so results compare across engines."""
    def cell(f):
        if isinstance(f.dataType, T.DoubleType):
            return F.round(f.name, places).alias(f.name)
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            return F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        return F.col(f.name)

    return df.select([cell(f) for f in df.schema])


# Shared inputs -------------------------------------------------------------------------------

def features(spark, sf_dir) -> DataFrame:
    return session.written(spark, ("features", sf_dir), lambda: features_op.order_features(
        **adapter.feature_inputs(spark, sf_dir)))


def scored(spark, sf_dir) -> DataFrame:
    return scoring.with_baseline(features(spark, sf_dir))


def cut(spark, sf_dir):
    return split.temporal_cut(features(spark, sf_dir))


def windowed(spark, sf_dir) -> DataFrame:
    return split.with_window(scored(spark, sf_dir), cut(spark, sf_dir))


def with_stand_in_model(spark, sf_dir) -> DataFrame:
    """Features scored by a stand-in for a model: it gives no score for one-line orders."""
    p = F.col("price_std") / (F.col("price_std") + F.col("price_mean"))
    return scoring.with_fallback(features(spark, sf_dir).withColumn("model_p", p), "model_p", "model")


def records(spark, sf_dir) -> DataFrame:
    """Scoring records as JSON, some of them broken in a known way."""
    k = F.col(policy.ORDER_ID)
    fields = {c: F.col(c) for c in policy.FEATURES}
    fields["purchase_hour"] = F.when(k % 89 == 0, 24).otherwise(F.col("purchase_hour"))
    fields["price_sum"] = F.when(k % 83 != 0, F.col("price_sum"))
    fields["payment_count"] = F.when(k % 79 == 0, "many").otherwise(F.col("payment_count").cast("string"))
    fields["order_id"] = k.cast("string")
    fields["is_late_delivery"] = F.when(k % 97 == 1, 1)
    fields["coupon"] = F.when(k % 73 == 0, "yes")
    text = F.to_json(F.struct(*[v.alias(c) for c, v in fields.items()]))
    sent = F.when(k % 71 == 0, text.substr(F.lit(1), F.length(text) - 9)).otherwise(text)
    return spark.read.parquet(session.written_path(
        spark, ("records", sf_dir), lambda path: features(spark, sf_dir).select(
            k.alias("record_id"), sent.alias("payload")).write.parquet(path)))


def runs(spark, sf_dir) -> DataFrame:
    path = session.written_path(spark, ("deploy_runs", sf_dir), lambda p: adapter.write_json_lines(
        opslog.run_records(adapter.deploy_facts(spark, sf_dir), "event_id"), "event_id", p))
    return jsonl.read_log(spark, path, schemas.DEPLOY_RUN)


def outcomes(spark, sf_dir) -> DataFrame:
    path = session.written_path(spark, ("outcomes", sf_dir), lambda p: adapter.write_json_lines(
        adapter.retrain_outcomes(spark, sf_dir), "position", p))
    return jsonl.read_log(spark, path, schemas.RETRAIN_OUTCOME)


def timed_outcomes_path(spark, sf_dir) -> str:
    return session.written_path(spark, ("timed_outcomes", sf_dir), lambda p: adapter.write_json_lines(
        adapter.timed_outcomes(spark, sf_dir), "position", p))


def request_lines_path(spark, sf_dir) -> str:
    """The request log as JSON lines, blank and cut-off ones among them."""
    log = adapter.request_log(spark, sf_dir)
    return session.written_path(spark, ("request_lines", sf_dir), lambda p: adapter.write_json_lines(
        adapter.log_lines(log, "ts", "service.requests", "request", F.col("request_id")), "event_id", p))


def prediction_lines_path(spark, sf_dir) -> str:
    log = prediction_log(spark, sf_dir).join(features(spark, sf_dir).select(policy.ORDER_ID, policy.PURCHASE_TS), policy.ORDER_ID)
    log = log.select(F.col(policy.ORDER_ID).alias("place"), F.col(policy.ORDER_ID).cast("string").alias(policy.ORDER_ID),
                     *[c for c in log.columns if c != policy.ORDER_ID])
    return session.written_path(spark, ("prediction_lines", sf_dir), lambda p: adapter.write_json_lines(
        adapter.log_lines(log, policy.PURCHASE_TS, "service.predictions", "prediction", F.lit(None).cast("string")), "place", p))


def logged_requests(spark, sf_dir) -> DataFrame:
    """Request records parsed from their lines, in time."""
    return jsonl.read_log(spark, request_lines_path(spark, sf_dir), schemas.REQUEST_LOG).withColumn("ts", jsonl.event_time())


def logged_predictions(spark, sf_dir) -> DataFrame:
    return jsonl.read_log(spark, prediction_lines_path(spark, sf_dir), schemas.PREDICTION_LOG).withColumn("ts", jsonl.event_time())


def prediction_log(spark, sf_dir) -> DataFrame:
    p = F.col(scoring.SCORE)
    return with_stand_in_model(spark, sf_dir).select(
        policy.ORDER_ID, X.round_half_even(p, 4).alias("late_delivery_probability"),
        scoring.risk_level(p).alias("risk_level"), F.lit("model").alias("model_version"), scoring.SCORED_BY)


# Sources, sinks and load ---------------------------------------------------------------------

def _csv_dir(spark, sf_dir, names=tuple(adapter.RAW)) -> str:
    """The folder of the raw CSV files; the named ones stand in it."""
    folder = session.written_path(spark, ("csv", sf_dir), lambda path: None)
    for name in names:
        session.written_path(spark, (f"csv_{name}", sf_dir), lambda _, name=name: write_csv(
            adapter.RAW[name](spark, sf_dir), f"{folder}/{tables.REGISTRY[name].filename}"))
    return folder


def _layers(spark, sf_dir) -> Layers:
    return Layers(spark, session.written_path(spark, ("layers", sf_dir), lambda path: None))


@query
def raw_load(spark, sf_dir):
    """All raw tables written as CSV and loaded twice through the registry: the same rows remain."""
    layers, data = _layers(spark, sf_dir), _csv_dir(spark, sf_dir)
    tables.load_raw(layers, data, clear=True)
    counts = tables.load_raw(layers, data)
    return spark.createDataFrame(sorted(counts.items()), "table_name STRING, rows BIGINT")


@query
def csv_orders(spark, sf_dir):
    return tables.read_csv(spark, tables.REGISTRY["orders"], _csv_dir(spark, sf_dir, ["orders"]))


@query
def csv_reviews(spark, sf_dir):
    return tables.read_csv(spark, tables.REGISTRY["order_reviews"], _csv_dir(spark, sf_dir, ["order_reviews"]), multi_line=True)


@query
def features_from_csv(spark, sf_dir):
    """The whole feature build from typed CSV files; ids are text there."""
    names = ("orders", "order_items", "products", "sellers", "order_payments")
    data = _csv_dir(spark, sf_dir, names)
    raw = {n: tables.read_csv(spark, tables.REGISTRY[n], data) for n in names}
    built = features_op.order_features(raw["orders"], raw["order_items"], raw["products"], raw["sellers"],
                                       raw["order_payments"])
    return built.select(*policy.FEATURES, "order_id", policy.LABEL)


@query
def feature_snapshot(spark, sf_dir):
    """The feature table as a CSV snapshot in contract order, read back."""
    table = contract.check_feature_columns(features(spark, sf_dir))
    path = session.written_path(spark, ("snapshot", sf_dir), lambda p: write_csv(table, p))
    return (spark.read.schema(table.schema).option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path))


@query
def first_feature_rows(spark, sf_dir):
    """Projection of the feature layer with a limit, in a fixed order."""
    layers = _layers(spark, sf_dir)
    layers.replace("features", "featureset_v1", features(spark, sf_dir))
    return layers.read("features", "featureset_v1", [policy.ORDER_ID, *policy.FEATURES], 100, policy.ORDER_ID)


@query
def deploy_log(spark, sf_dir):
    """The run log read back from JSON lines without its blank and cut-off lines."""
    return runs(spark, sf_dir).select(
        "run_id", "started_at", "finished_at", "duration_seconds", "branch", "old_commit", "new_commit",
        F.array_join("changed_paths", ",").alias("changed_paths"), "status", "actions.restart", "actions.trigger",
        "actions.import", "dag_run_id", "host")


# Features ------------------------------------------------------------------------------------

@query
def order_features(spark, sf_dir):
    return features_op.order_features(**adapter.feature_inputs(spark, sf_dir))


@query
def incremental_features(spark, sf_dir):
    """The feature table after a build on older orders and one on the present ones that touches the changed months only."""
    layers, raw = _layers(spark, sf_dir), adapter.feature_inputs(spark, sf_dir)
    at = F.col("order_purchase_timestamp")
    # Before: one month had other delivery dates, one later month didn't exist yet.
    moved = F.when(F.date_format(at, "yyyy-MM") == "1996-03", F.col("order_delivered_customer_date") + F.expr("INTERVAL 3 DAYS")).otherwise(
        F.col("order_delivered_customer_date"))
    before = raw["orders"].where(F.date_format(at, "yyyy-MM") != "1997-05").withColumn("order_delivered_customer_date", moved)
    incremental.build(layers, **raw | {"orders": before})
    built = incremental.build(layers, **raw)
    if not set(built) <= {"1996-03", "1997-05"}:
        raise AssertionError(f"months built without a change: {built}")
    return incremental.read(layers)


@query
def delivered_orders(spark, sf_dir):
    return features_op.delivered_orders(adapter.orders(spark, sf_dir))


@query
def priced_lines(spark, sf_dir):
    return features_op.priced_lines(adapter.order_items(spark, sf_dir), adapter.products(spark, sf_dir))


@query
def item_measures(spark, sf_dir):
    return features_op.item_measures(adapter.order_items(spark, sf_dir), adapter.products(spark, sf_dir))


@query
def item_values(spark, sf_dir):
    return features_op.item_values(adapter.order_items(spark, sf_dir), adapter.products(spark, sf_dir),
                                   adapter.sellers(spark, sf_dir))


@query
def payment_profile(spark, sf_dir):
    return features_op.payment_profile(adapter.order_payments(spark, sf_dir))


@query
def purchase_calendar(spark, sf_dir):
    return adapter.orders(spark, sf_dir).select(
        "order_id", *features_op.calendar_columns("order_purchase_timestamp"))


@query
def delivery_windows(spark, sf_dir):
    kept = features_op.delivered_orders(adapter.orders(spark, sf_dir))
    deadlines = adapter.order_items(spark, sf_dir).groupBy("order_id").agg(
        F.min("shipping_limit_date").alias("shipping_limit_min"),
        F.max("shipping_limit_date").alias("shipping_limit_max"))
    return kept.join(deadlines, "order_id").select("order_id", *features_op.window_columns(), features_op.late_label())


@query
def category_mix(spark, sf_dir):
    """Orders and late rate by number of categories."""
    return features(spark, sf_dir).groupBy("is_multi_category").agg(
        F.count("*").alias("orders"), F.avg(policy.LABEL).alias("late_rate"))


@query
def label_balance(spark, sf_dir):
    return features_op.label_balance(features(spark, sf_dir))


# Contract ------------------------------------------------------------------------------------

@query
def contract_columns(spark, sf_dir):
    """Columns of the checked table with how many rows hold a value, in contract order."""
    table = contract.check_feature_columns(features(spark, sf_dir))
    contract.reject_unknown_columns(table.drop(policy.LABEL, policy.PURCHASE_TS))
    counts = table.agg(*[F.count(c).alias(c) for c in table.columns])
    cells = [F.struct(F.lit(i).alias("place"), F.lit(c).alias("column_name"), F.col(c).alias("present"))
             for i, c in enumerate(table.columns)]
    return counts.select(F.inline(F.array(*cells)))


@query
def quarantined_records(spark, sf_dir):
    bad = contract.quarantined(contract.check_records(records(spark, sf_dir)))
    return bad.select("record_id", F.array_join(F.array_sort("violations"), ",").alias("violations"),
                      F.array_join("outcome_fields", ",").alias("outcome_fields"))


@query
def accepted_records(spark, sf_dir):
    return contract.accepted(contract.check_records(records(spark, sf_dir)))


@query
def violation_counts(spark, sf_dir):
    return contract.violation_counts(contract.check_records(records(spark, sf_dir)))


@query
def feature_row_checks(spark, sf_dir):
    """Required values and ranges checked on the typed feature table."""
    checked = contract.check_rows(features(spark, sf_dir))
    return checked.agg(F.count("*").alias("rows"), F.count_if(F.size("violations") > 0).alias("rejected"))


# Split and preparation -----------------------------------------------------------------------

@query
def temporal_cut(spark, sf_dir):
    at = cut(spark, sf_dir)
    train, valid = split.temporal_split(features(spark, sf_dir), at)
    return train.agg(F.count("*").alias("train")).select(
        split.cut_literal(at).alias("split_ts"), "train", valid.agg(F.count("*")).scalar().alias("valid"))


@query
def temporal_split(spark, sf_dir):
    table = split.with_window(features(spark, sf_dir), cut(spark, sf_dir))
    return table.select(policy.ORDER_ID, policy.PURCHASE_TS, "window")


@query
def numeric_medians(spark, sf_dir):
    found = prep.medians(features(spark, sf_dir))
    return spark.createDataFrame(list(found.items()), "feature STRING, median DOUBLE")


@query
def feature_scales(spark, sf_dir):
    """Mean and population deviation after imputation; what standardising uses."""
    table = features(spark, sf_dir)
    return prep.scales(table, prep.medians(table))


@query
def category_folding(spark, sf_dir):
    """Seen categories and the name they are encoded under: rare ones share one."""
    sizes = prep.category_counts(features(spark, sf_dir), [*policy.CATEGORICAL, "seller_zip_mode"])
    return prep.folded_categories(sizes)


@query
def class_weights(spark, sf_dir):
    return prep.class_weights(features(spark, sf_dir))


# Scoring -------------------------------------------------------------------------------------

@query
def baseline_predictions(spark, sf_dir):
    return scoring.predictions(scored(spark, sf_dir)).drop("scored_at")


@query
def fallback_predictions(spark, sf_dir):
    by = with_stand_in_model(spark, sf_dir)
    return scoring.predictions(by, "model").drop("scored_at").join(by.select(policy.ORDER_ID, "scored_by"),
                                                                   policy.ORDER_ID)


@query
def risk_distribution(spark, sf_dir):
    return scoring.risk_distribution(scored(spark, sf_dir))


@query
def score_overview(spark, sf_dir):
    return scoring.score_overview(scored(spark, sf_dir))


# Evaluation and drift ------------------------------------------------------------------------

@query
def window_metrics(spark, sf_dir):
    return evaluation.evaluate(windowed(spark, sf_dir), by=["window"])


@query
def category_metrics(spark, sf_dir):
    return evaluation.evaluate(scored(spark, sf_dir), by=["product_category_mode"], rows_per_bucket=1_000)


CANDIDATE_SCORES = {"baseline": scoring.baseline_probability,
                    "short_promise": lambda: 1 / F.col("estimated_delivery_days"),
                    "constant": lambda: F.lit(0.5)}


@query
def score_leaderboard(spark, sf_dir):
    """Formula scores compared on the newest orders; the winner has the best average precision."""
    _, valid = split.temporal_split(features(spark, sf_dir), cut(spark, sf_dir))
    cells = [F.struct(F.lit(n).alias("candidate"), s().cast("double").alias(scoring.SCORE))
             for n, s in CANDIDATE_SCORES.items()]
    table = valid.select(policy.LABEL, F.inline(F.array(*cells)))
    return evaluation.leaderboard(evaluation.evaluate(table, by=["candidate"]), list(CANDIDATE_SCORES))


@query
def psi_edges(spark, sf_dir):
    reference = windowed(spark, sf_dir).where("window = 'reference'")
    return drift.edge_table(spark, drift.quantile_edges(reference, drift.COLUMNS))


@query
def psi_histogram(spark, sf_dir):
    table = windowed(spark, sf_dir)
    edges = drift.quantile_edges(table.where("window = 'reference'"), drift.COLUMNS)
    return drift.full_histogram(drift.histogram(table, drift.COLUMNS, edges), edges).where("bin >= 0")


@query
def psi_by_metric(spark, sf_dir):
    return drift.psi(windowed(spark, sf_dir))


@query
def label_drift(spark, sf_dir):
    return drift.label_drift(windowed(spark, sf_dir))


@query
def retrain_decision(spark, sf_dir):
    decided = drift.decide(drift.monitor_row(windowed(spark, sf_dir)))
    return decided.select("score_psi", "max_feature_psi", "current_auc", "drift_detected", "performance_low",
                          "retrain_recommended", F.array_join("reasons", ",").alias("reasons"))


@query
def monitoring_metrics(spark, sf_dir):
    """The run's metrics appended to the monitoring layer and read back."""
    layers = _layers(spark, sf_dir)
    tall = drift.tall_metrics(drift.decide(drift.monitor_row(windowed(spark, sf_dir))))
    layers.append("monitoring", "monitoring_metrics", tall)
    newest = layers.read("monitoring", "monitoring_metrics")
    at = newest.agg(F.max("computed_at").alias("computed_at"))
    return newest.join(F.broadcast(at), "computed_at").drop("computed_at")


@query
def monitor_report(spark, sf_dir):
    """The nested report of a monitoring run as its JSON document."""
    at = cut(spark, sf_dir)
    table = split.with_window(scored(spark, sf_dir), at)
    document = drift.report(drift.decide(drift.monitor_row(table)), policy.BASELINE_VERSION, at)
    return document.select("model_version", "split_ts", F.col("thresholds.psi").alias("psi_limit"),
                           F.col("thresholds.min_auc").alias("min_auc"),
                           F.size("metrics").alias("metric_count"),
                           F.array_join("decision.reasons", ",").alias("reasons"))


@query
def written_report(spark, sf_dir):
    """The report's JSON document, written and read back: one row per metric with the verdict."""
    def write(path):
        at = cut(spark, sf_dir)
        row = drift.decide(drift.monitor_row(split.with_window(scored(spark, sf_dir), at)))
        write_report(drift.report(row, policy.BASELINE_VERSION, at), path)

    path = session.written_path(spark, ("report", sf_dir), write)
    document = spark.read.schema(drift.REPORT).json(path)
    return document.select("model_version", F.col("thresholds.psi").alias("psi_limit"), "decision.drift_detected", "decision.performance_low",
                           "decision.retrain_recommended", F.array_join("decision.reasons", ",").alias("reasons"),
                           F.explode("metrics").alias("metric", "value"))


def _reference_sketches(spark, sf_dir) -> DataFrame:
    """Sketches of the reference window by month, stored, and merged on reading."""
    past = windowed(spark, sf_dir).where("window = 'reference'").withColumn("month", F.date_format(policy.PURCHASE_TS, "yyyy-MM"))
    return sketches.merged(session.written(spark, ("sketches", sf_dir), lambda: sketches.sketched(past, by=["month"])))


@query
def sketch_ranks(spark, sf_dir):
    """Whether the stored sketches' quantiles have their ranks in the reference window, within the stated error."""
    return sketches.rank_check(windowed(spark, sf_dir).where("window = 'reference'"), _reference_sketches(spark, sf_dir))


@query
def sketched_decision(spark, sf_dir):
    """The retrain verdict from the stored sketches and the current window alone."""
    current = windowed(spark, sf_dir).where("window = 'current'")
    decided = drift.decide(sketches.monitor_row(current, _reference_sketches(spark, sf_dir)))
    return decided.select("drift_detected", "performance_low", "retrain_recommended", F.array_join("reasons", ",").alias("reasons"))


@query
def feature_importance(spark, sf_dir):
    """AUC drop per shuffled feature of the baseline score on the newest orders."""
    _, valid = split.temporal_split(features(spark, sf_dir), cut(spark, sf_dir))
    return importance.permutation_importance(valid, scoring.with_baseline)


# Operations log ------------------------------------------------------------------------------

@query
def last_outcomes(spark, sf_dir):
    return opslog.last_outcomes(outcomes(spark, sf_dir))


@query
def reconciled_runs(spark, sf_dir):
    return opslog.with_retrain_state(runs(spark, sf_dir), outcomes(spark, sf_dir)).select(
        "new_commit", "status", "dag_run_id", "retrain_state")


@query
def recent_runs(spark, sf_dir):
    return opslog.recent_runs(runs(spark, sf_dir)).select("new_commit", "finished_at", "status", "dag_run_id")


@query
def all_runs_newest_first(spark, sf_dir):
    return opslog.recent_runs(runs(spark, sf_dir), 0).select("new_commit", "finished_at", "status", "dag_run_id")


@query
def deploy_snapshot(spark, sf_dir):
    return opslog.snapshot(runs(spark, sf_dir), outcomes(spark, sf_dir)).select(
        "status", "message", "new_commit", "finished_at", "dag_run_id", "retrain_state", "total_recorded")


@query
def latest_retrain(spark, sf_dir):
    return opslog.latest_retrain(runs(spark, sf_dir), outcomes(spark, sf_dir))


@query
def deploy_steps(spark, sf_dir):
    steps = opslog.step_states(opslog.with_retrain_state(runs(spark, sf_dir), outcomes(spark, sf_dir)))
    return steps.select("new_commit", F.inline(F.concat("gate", "action_steps", F.array("retrain"))))


@query
def deploy_gauges(spark, sf_dir):
    return opslog.deploy_gauges(runs(spark, sf_dir), outcomes(spark, sf_dir), now=F.lit(1_800_000_000.0))


@query
def run_times(spark, sf_dir):
    """ISO finish times as Unix seconds, unreadable ones as 0; short commit names."""
    return runs(spark, sf_dir).select("new_commit", X.short_commit("new_commit").alias("short_commit"),
                                      X.iso_epoch("finished_at").alias("finished_s"))


# Service roll-ups ----------------------------------------------------------------------------

@query
def request_totals(spark, sf_dir):
    return service.request_totals(adapter.request_log(spark, sf_dir))


@query
def error_totals(spark, sf_dir):
    return service.error_totals(adapter.request_log(spark, sf_dir))


@query
def latency_stats(spark, sf_dir):
    return service.latency_stats(adapter.request_log(spark, sf_dir), ["endpoint"])


@query
def risk_counts(spark, sf_dir):
    return service.risk_counts(prediction_log(spark, sf_dir))


@query
def scoring_errors(spark, sf_dir):
    return service.scoring_errors(prediction_log(spark, sf_dir))


@query
def prediction_requests(spark, sf_dir):
    return service.prediction_requests(adapter.request_log(spark, sf_dir), ("purchase", "click"))


@query
def service_summary(spark, sf_dir):
    return service.summary(adapter.request_log(spark, sf_dir), prediction_log(spark, sf_dir), ("purchase", "click"))


@query
def logged_request_totals(spark, sf_dir):
    """From JSON lines to totals; blank and cut-off lines are left out."""
    return service.request_totals(logged_requests(spark, sf_dir))


@query
def logged_error_totals(spark, sf_dir):
    return service.error_totals(logged_requests(spark, sf_dir))


@query
def logged_summary(spark, sf_dir):
    """The whole roll-up from both logs' JSON lines."""
    return service.summary(logged_requests(spark, sf_dir), logged_predictions(spark, sf_dir), ("purchase", "click"))


@query
def logged_latency_quantiles(spark, sf_dir):
    return service.latency_quantiles(service.latency_histogram(logged_requests(spark, sf_dir), []))


@query
def logged_risk_rates(spark, sf_dir):
    return service.rates(logged_predictions(spark, sf_dir), ["risk_level"])


@query
def endpoint_rates(spark, sf_dir):
    return service.rates(adapter.request_log(spark, sf_dir), ["endpoint"])


@query
def error_rates(spark, sf_dir):
    return service.rates(adapter.request_log(spark, sf_dir).where("status >= 400"), ["status"])


@query
def risk_rates(spark, sf_dir):
    """Rate of predictions per band, placed in time by the purchase."""
    log = with_stand_in_model(spark, sf_dir).select(
        scoring.risk_level(F.col(scoring.SCORE)).alias("risk_level"), policy.PURCHASE_TS)
    return service.rates(log, ["risk_level"], policy.PURCHASE_TS)


@query
def latency_quantiles(spark, sf_dir):
    return service.latency_quantiles(service.latency_histogram(adapter.request_log(spark, sf_dir), []))


@query
def approximate_latency(spark, sf_dir):
    return service.approximate_latency_quantiles(adapter.request_log(spark, sf_dir), [])


# Streams -------------------------------------------------------------------------------------

def _event_stream(spark, sf_dir) -> DataFrame:
    events = files.stream_parquet(spark, f"{sf_dir}/events.parquet", adapter.SCHEMAS["events"])
    return adapter.as_request_log(events).withColumn("ts", F.col("ts").cast("timestamp"))


def _drained(spark, sf_dir, name: str, build) -> DataFrame:
    """Result of running a stream over all its input."""
    def run(path):
        streams.drain(build(), path + "/out", path + "/state")

    path = session.written_path(spark, (name, sf_dir), run)
    return spark.read.parquet(path + "/out")


@query
def stream_deduplicated(spark, sf_dir):
    return _drained(spark, sf_dir, "stream_dedup", lambda: streams.deduplicated(
        _event_stream(spark, sf_dir).unionByName(_event_stream(spark, sf_dir)), "event_id")).select(
        "event_id", "endpoint", "status", "latency_ms")


def _whole(spark, sf_dir, name: str, build) -> DataFrame:
    """build(path, checkpoint) over all input of a stream, its open windows among the rows; run once."""
    path = session.written_path(spark, (name, sf_dir), lambda p: build(p + "/table", p + "/state").write.parquet(p + "/out"))
    return spark.read.parquet(path + "/out")


@query
def stream_rates(spark, sf_dir):
    return _whole(spark, sf_dir, "stream_rates", lambda path, state: streams.whole_rates(
        _event_stream(spark, sf_dir), ["endpoint"], path, state, slide_minutes=5))


@query
def stream_latency(spark, sf_dir):
    return _whole(spark, sf_dir, "stream_latency", lambda path, state: streams.whole_latency(
        _event_stream(spark, sf_dir), [], path, state))


@query
def stream_error_rates(spark, sf_dir):
    """Sliding rates of failed requests by status."""
    return _whole(spark, sf_dir, "stream_error_rates", lambda path, state: streams.whole_rates(
        _event_stream(spark, sf_dir).where("status >= 400"), ["status"], path, state))


@query
def stream_risk_rates(spark, sf_dir):
    """Sliding rates of predictions by band, from the prediction log's JSON lines as they arrive."""
    lines = prediction_lines_path(spark, sf_dir)
    return _whole(spark, sf_dir, "stream_risk_rates", lambda path, state: streams.whole_rates(
        jsonl.stream_log(spark, lines, schemas.PREDICTION_LOG).withColumn("ts", jsonl.event_time()), ["risk_level"], path, state))


@query
def stream_reconciled_runs(spark, sf_dir):
    """Runs joined with the outcomes of their retrains while both logs are read as streams."""
    runs(spark, sf_dir)
    log = jsonl.stream_log(spark, session.written_path(spark, ("deploy_runs", sf_dir), None), schemas.DEPLOY_RUN).withColumn(
        "run_at", F.coalesce(F.try_to_timestamp("finished_at"), F.try_to_timestamp("started_at")))
    ended = jsonl.stream_log(spark, timed_outcomes_path(spark, sf_dir), schemas.TIMED_OUTCOME).withColumn("outcome_at", F.try_to_timestamp("recorded_at"))
    stream = stream_log.reconciled(log, ended)
    return _whole(spark, sf_dir, "stream_reconciled", lambda path, state: stream_log.reconciled_table(
        stream, path, "new_commit").drained(stream, state, "append").select("new_commit", "status", "dag_run_id", "retrain_state"))


@query
def stream_arrivals(spark, sf_dir):
    """Three deliveries of the events, some late, some twice: every record sent is kept, a repeat or late."""
    def build(path, state):
        schema = adapter.arrivals(spark, sf_dir, 0).schema
        table = Arrivals(path, schema, "event_id")
        for n in range(3):  # the stream stops between deliveries and goes on where it was
            adapter.arrivals(spark, sf_dir, n).write.parquet(f"{path}-in/{n}")
            source = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{path}-in")
            table.start(source, state).awaitTermination()
        counts = table.counts(spark)
        if counts["sent"] != sum(counts[f] for f in FATES):
            raise AssertionError(f"records went missing: {counts}")
        return table.read(spark)

    return _whole(spark, sf_dir, "stream_arrivals", build).select("event_id", "delivery", "fate")


@query
def stream_scoring(spark, sf_dir):
    sent = records(spark, sf_dir)
    folder = session.written_path(spark, ("records", sf_dir), None)
    out = _drained(spark, sf_dir, "stream_scoring", lambda: streams.scored_records(
        spark.readStream.schema(sent.schema).parquet(folder)))
    return out.select("record_id", "order_id", "late_delivery_probability", "risk_level", "recommended_action",
                      "model_version", "scored_by", "outcome",
                      F.array_join(F.array_sort("violations"), ",").alias("violations"))


# Models --------------------------------------------------------------------------------------

#: Builders instead of the production ones; none here, tests put theirs.
QUICK_TREES = {}


def _fitted(spark, sf_dir, name: str):
    """A candidate fitted on the past, stored, and loaded again."""
    return _all_fitted(spark, sf_dir, [name])[name]


def _all_fitted(spark, sf_dir, names) -> dict:
    """Candidates fitted on the past, stored, and loaded again; those not stored yet share one preparation of the rows."""
    missing = [n for n in names if not session.is_written(spark, (n, sf_dir))]
    if missing:
        train, _ = split.temporal_split(features(spark, sf_dir), cut(spark, sf_dir))
        models = training.fit_candidates(train, missing, QUICK_TREES)
        for n in missing:
            session.written_path(spark, (n, sf_dir), lambda path, n=n: models[n].write().overwrite().save(path))
    return {n: scoring.load_model(session.written_path(spark, (n, sf_dir), None)) for n in names}


def _board(spark, sf_dir, names) -> DataFrame:
    _, valid = split.temporal_split(features(spark, sf_dir), cut(spark, sf_dir))
    return training.compare(_all_fitted(spark, sf_dir, names), valid)


@query
def logistic_regression(spark, sf_dir):
    return _board(spark, sf_dir, ["logistic_regression"])


@query
def model_predictions(spark, sf_dir):
    """Scores of the stored logistic regression for all orders."""
    scored_rows = scoring.score(features(spark, sf_dir), _fitted(spark, sf_dir, "logistic_regression"))
    return scoring.predictions(scored_rows, "logistic_regression").drop("scored_at")


@query
def stream_model_change(spark, sf_dir):
    """Records scored while the current model changes: the first half by the model fitted on the past, the second by one fitted on all
    orders. One row per record: which version scored it, whether its score and band are sound."""
    sent = records(spark, sf_dir)

    def fit_all(path):
        training.fit_candidates(features(spark, sf_dir), ["logistic_regression"])["logistic_regression"].write().overwrite().save(path)

    def build(path, state):
        pointer = ModelPointer(path + "-current.json")
        table = ScoredTable(path, pointer)
        _fitted(spark, sf_dir, "logistic_regression")
        versions = {"late:past": session.written_path(spark, ("logistic_regression", sf_dir), None),
                    "late:all": session.written_path(spark, ("logistic_regression_all", sf_dir), fit_all)}
        for half, (version, stored) in enumerate(versions.items()):
            sent.where(F.col("record_id") % 2 == half).write.parquet(f"{path}-in/{half}")
            pointer.publish(spark, version, stored)
            source = spark.readStream.schema(sent.schema).option("recursiveFileLookup", True).parquet(f"{path}-in")
            table.start(source, state).awaitTermination()
        return table.read(spark, streams.scored_records(sent).schema)

    p = F.col("late_delivery_probability")
    out = _whole(spark, sf_dir, "stream_model_change", build)
    return out.select("record_id", "model_version", "scored_by", "outcome", F.coalesce(p.between(0, 1), F.lit(False)).alias("has_score"),
                      # the band comes from the score before it is rounded to 4 places
                      (F.col("risk_level").isin(scoring.risk_level(p - 5e-5), scoring.risk_level(p + 5e-5))).alias("band_agrees"))


@query
def random_forest(spark, sf_dir):
    return _board(spark, sf_dir, ["random_forest"])


@query
def gradient_boosting(spark, sf_dir):
    return _board(spark, sf_dir, ["hist_gradient_boosting"])


@query
def model_leaderboard(spark, sf_dir):
    """All three classifiers, fitted on the past, compared on the newest orders."""
    return _board(spark, sf_dir, training.CANDIDATES)


@query
def histogram_boosting(spark, sf_dir):
    return _board(spark, sf_dir, ["histogram_boosting"])


@query
def balanced_forest(spark, sf_dir):
    return _board(spark, sf_dir, ["balanced_forest"])


@query
def model_board_checks(spark, sf_dir):
    """What must hold for any fitted candidate on the newest orders: rows, late rate, metrics in their range, one winner."""
    board = _board(spark, sf_dir, ["logistic_regression", "histogram_boosting", "balanced_forest"])
    inside = F.lit(True)
    for c in ("pr_auc", "roc_auc", "brier", "f1_at_0_5"):
        inside = inside & F.col(c).between(0, 1)
    best = board.agg(F.max("pr_auc")).scalar()
    return board.select("candidate", "rows", "val_positive_rate", inside.alias("in_range"), ((F.col("pr_auc") == best) | ~F.col("winner")).alias("winner_is_best"))


@query
def model_prediction_checks(spark, sf_dir):
    """One sound score per order from each stored model: within [0, 1], its band and action agreeing with it."""
    parts = None
    for name, model in _all_fitted(spark, sf_dir, ["logistic_regression", "histogram_boosting", "balanced_forest"]).items():
        rows = scoring.score(features(spark, sf_dir), model)
        p = F.col(scoring.SCORE)
        part = scoring.predictions(rows.select(policy.ORDER_ID, scoring.SCORE), name).join(rows.select(policy.ORDER_ID, scoring.SCORE, "scored_by"), policy.ORDER_ID)
        part = part.select(policy.ORDER_ID, "model_version", "scored_by", p.between(0, 1).alias("in_range"),
                           (F.col("risk_level") == scoring.risk_level(p)).alias("band_agrees"),
                           (F.col("recommended_action") == scoring.recommended_action(scoring.risk_level(p))).alias("action_agrees"))
        parts = part if parts is None else parts.unionByName(part)
    return parts
