"""Service roll-ups over the request and prediction logs."""

from pyspark.sql import Column, DataFrame, functions as F

from dispatchlens import policy


def request_totals(requests: DataFrame) -> DataFrame:
    return requests.groupBy("method", "endpoint", "status").agg(F.count("*").alias("requests"))


def error_totals(requests: DataFrame) -> DataFrame:
    return (requests.where(F.col("status") >= 400).groupBy("endpoint", "status")
            .agg(F.count("*").alias("errors")))


def latency_stats(requests: DataFrame, by=()) -> DataFrame:
    """Count, sum and mean latency in seconds, 6 places; 0 when there is nothing."""
    total = F.sum("latency_ms") / 1000
    n = F.count("latency_ms")
    return requests.groupBy(*by).agg(
        n.alias("count"), F.coalesce(F.round(total, 6), F.lit(0.0)).alias("sum_seconds"),
        F.when(n > 0, F.round(total / n, 6)).otherwise(0.0).alias("avg_seconds"))


def risk_counts(predictions: DataFrame) -> DataFrame:
    """Predictions per band; all three bands are present."""
    levels = predictions.sparkSession.createDataFrame([(x,) for x in policy.RISK_LEVELS], "risk_level STRING")
    counts = predictions.groupBy("risk_level").agg(F.count("*").alias("n"))
    return levels.join(counts, "risk_level", "left").select(
        "risk_level", F.coalesce("n", F.lit(0)).alias("predictions"))


def scoring_errors(predictions: DataFrame) -> DataFrame:
    """Predictions that fell back to the baseline."""
    return predictions.agg(F.count_if(F.col("scored_by") == "baseline_fallback").alias("scoring_errors"))


def prediction_requests(requests: DataFrame, endpoints=policy.PREDICTION_ENDPOINTS) -> DataFrame:
    """Accepted prediction requests per endpoint; a batch is one request."""
    return (requests.where(F.col("endpoint").isin(*endpoints) & (F.col("status") != 422))
            .groupBy("endpoint").agg(F.count("*").alias("requests")))


def step_counts(events: DataFrame, by: list[str], ts: str = "ts", slide_minutes: int = 1) -> DataFrame:
    """Events per step of a slide's length: `at`, its end `until`, and `n`."""
    return (events.groupBy(*by, F.window(ts, f"{slide_minutes} minutes").alias("step")).agg(F.count("*").alias("n"))
            .select(*by, F.col("step.start").alias("at"), F.col("step.end").alias("until"), "n"))


def sliding(steps: DataFrame, by: list[str], width_minutes: int = 5, slide_minutes: int = 1) -> DataFrame:
    """Events per second in sliding windows, from counts per step."""
    width, slide = f"{width_minutes} minutes", f"{slide_minutes} minutes"
    return (steps.groupBy(*by, F.window("at", width, slide).alias("w")).agg(F.sum("n").alias("events"))
            .select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events",
                    (F.col("events") / (60.0 * width_minutes)).alias("per_second")))


def rates(events: DataFrame, by: list[str], ts: str = "ts", width_minutes: int = 5,
          slide_minutes: int = 1) -> DataFrame:
    """Events per second in sliding windows.

    Events are counted per slide first; only those few counts are copied into every window.
    """
    return sliding(step_counts(events, by, ts, slide_minutes), by, width_minutes, slide_minutes)


def latency_histogram(requests: DataFrame, by: list, ts: str = "ts", width_minutes: int = 5) -> DataFrame:
    """Cumulative counts at fixed latency bounds per tumbling window."""
    seconds = F.col("latency_ms") / 1000
    upto = [F.count_if(seconds <= b).alias(f"le_{i}") for i, b in enumerate(policy.LATENCY_BOUNDS_SECONDS)]
    return (requests.where("latency_ms IS NOT NULL")
            .groupBy(*by, F.window(ts, f"{width_minutes} minutes").alias("w"))
            .agg(F.count("*").alias("n"), *upto)
            .select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n",
                    *[f"le_{i}" for i in range(len(policy.LATENCY_BOUNDS_SECONDS))]))


def bucket_quantile(q: float) -> Column:
    """Quantile by linear interpolation inside the bound that holds its rank; the last bound beyond."""
    bounds = policy.LATENCY_BOUNDS_SECONDS
    rank = F.col("n") * q
    value = F.lit(bounds[-1])
    for i in reversed(range(len(bounds))):
        low = bounds[i - 1] if i else 0.0
        before = F.col(f"le_{i - 1}") if i else F.lit(0)
        inside = F.col(f"le_{i}") - before
        at = F.when(inside > 0, low + (bounds[i] - low) * (rank - before) / inside).otherwise(low)
        value = F.when(F.col(f"le_{i}") >= rank, at).otherwise(value)
    return value


def latency_quantiles(histogram: DataFrame, qs=(0.5, 0.95, 0.99)) -> DataFrame:
    """p50, p95, p99 per window from the histogram."""
    keys = [c for c in histogram.columns if c != "n" and not c.startswith("le_")]
    return histogram.select(*keys, "n", *[bucket_quantile(q).alias(f"p{round(q * 100)}") for q in qs])


def approximate_latency_quantiles(requests: DataFrame, by: list, ts: str = "ts", width_minutes: int = 5,
                                  qs=(0.5, 0.95, 0.99), accuracy: int = 10_000) -> DataFrame:
    """p50, p95, p99 in seconds per window from a bounded sketch."""
    q = F.percentile_approx(F.col("latency_ms") / 1000, list(qs), accuracy).alias("q")
    return (requests.groupBy(*by, F.window(ts, f"{width_minutes} minutes").alias("w")).agg(q)
            .select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *[F.col("q")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(qs)]))


def summary(requests: DataFrame, predictions: DataFrame, endpoints=policy.PREDICTION_ENDPOINTS) -> DataFrame:
    """Tall roll-up of both logs: section, key, value."""
    def one(df, section, pairs):
        cells = [F.struct(F.lit(k).alias("key"), v.cast("double").alias("value")) for k, v in pairs.items()]
        return df.select(F.lit(section).alias("section"), F.inline(F.array(*cells)))

    def keyed(df, section, key, value):
        return df.select(F.lit(section).alias("section"), F.col(key).alias("key"),
                         F.col(value).cast("double").alias("value"))

    predicted = predictions.agg(
        F.count("*").alias("total_predictions"),
        F.count_if(F.col("scored_by") == "baseline_fallback").alias("scoring_errors"))
    http = requests.agg(F.count("*").alias("total"), F.count_if(F.col("status") >= 400).alias("errors"))
    stats = {k: F.col(k) for k in ("count", "sum_seconds", "avg_seconds")}
    served = requests.where(F.col("endpoint").isin(*endpoints) & (F.col("status") < 400))
    parts = [
        one(predicted, "totals", {c: F.col(c) for c in ("total_predictions", "scoring_errors")}),
        keyed(risk_counts(predictions), "risk_distribution", "risk_level", "predictions"),
        keyed(prediction_requests(requests, endpoints), "requests_by_endpoint", "endpoint", "requests"),
        one(http, "http", {"requests_total": F.col("total"), "errors_total": F.col("errors")}),
        one(latency_stats(served), "prediction_latency", stats),
        one(latency_stats(requests), "http_latency", stats)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
