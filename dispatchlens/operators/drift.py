"""Population stability, label drift and the retrain verdict."""

import math

from pyspark.sql import DataFrame, functions as F

from dispatchlens import policy
from dispatchlens.functions.quantiles import approximate_quantiles, bucketed, exact_quantiles, long_counts
from dispatchlens.operators.evaluation import evaluate
from dispatchlens.operators.scoring import SCORE

SCORE_METRIC = "score"
COLUMNS = {SCORE_METRIC: SCORE} | {f: f for f in policy.DRIFT_FEATURES}


def quantile_edges(reference: DataFrame, columns: dict[str, str], bins: int = policy.PSI_BINS,
                   approximate: bool = False) -> dict[str, list[float]]:
    """{metric: distinct quantile edges of the reference}; empty for a metric without values."""
    find = approximate_quantiles if approximate else exact_quantiles
    found = find(reference, columns.values(), [i / bins for i in range(bins + 1)])
    return {metric: sorted(set(found[column] or [])) for metric, column in columns.items()}


def edge_table(spark, edges: dict[str, list[float]]) -> DataFrame:
    rows = [(m, i, e) for m, es in edges.items() for i, e in enumerate(es)]
    return spark.createDataFrame(rows, "metric STRING, position INT, edge DOUBLE")


def histogram(windowed: DataFrame, columns: dict[str, str], edges: dict[str, list[float]]) -> DataFrame:
    """Rows per metric, window and bin, bins left-closed and the last one closed; -1 is outside the edges."""
    values = {m: F.col(c).cast("double") for m, c in columns.items()}
    numbers = windowed.select("window", *[F.when(~F.isnan(v), v).alias(m) for m, v in values.items()])
    cut = bucketed(numbers, {m: edges[m] for m in columns if len(edges[m]) > 1}, "upto_")

    def bin_of(metric: str):
        v, at = F.col(metric), edges[metric]
        if len(at) < 2:
            return F.when(v.isNotNull(), -1)
        return (F.when((v < at[0]) | (v > at[-1]), -1).when(v == at[-1], len(at) - 2)
                .otherwise(F.col(f"upto_{metric}").cast("int") - 1))

    binned = cut.select("window", *[bin_of(m).alias(m) for m in columns])
    return long_counts(binned, {m: m for m in columns}, ["window"]).select(
        F.col("name").alias("metric"), "window", F.col("cell").alias("bin"), "n")


def full_histogram(counts: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Every metric and bin with its reference and current count, empty bins as 0."""
    rows = [(m, b) for m, es in edges.items() for b in range(-1, max(len(es) - 1, 0))]
    grid = counts.sparkSession.createDataFrame(rows, "metric STRING, bin INT")
    sides = counts.groupBy("metric", "bin").agg(*[
        F.sum(F.when(F.col("window") == w, F.col("n")).otherwise(0)).alias(f"{w}_n")
        for w in ("reference", "current")])
    return grid.join(sides, ["metric", "bin"], "left").select(
        "metric", "bin", *[F.coalesce(f"{w}_n", F.lit(0)).alias(f"{w}_n") for w in ("reference", "current")])


def psi_by_metric(filled: DataFrame) -> DataFrame:
    """Stability index per metric.

    0 when a window has no values or the edges span nothing. When every current value lies outside
    the edges the index is undefined: psi is NaN and psi_undefined is true.
    """
    inside = F.col("bin") >= 0
    totals = filled.groupBy("metric").agg(
        *[F.sum(f"{w}_n").alias(f"{w}_values") for w in ("reference", "current")],
        *[F.sum(F.when(inside, F.col(f"{w}_n")).otherwise(0)).alias(f"{w}_inside")
          for w in ("reference", "current")],
        F.count_if(inside).alias("bins"))

    def share(w):
        return F.greatest(F.col(f"{w}_n") / F.nullif(F.col(f"{w}_inside"), F.lit(0)), F.lit(policy.PSI_FLOOR))

    ref, cur = share("reference"), share("current")
    term = F.when(inside & (F.col("current_inside") > 0) & (F.col("reference_inside") > 0),
                  (cur - ref) * F.ln(cur / ref))
    scored = filled.join(totals, "metric").groupBy("metric").agg(
        F.coalesce(F.sum(term), F.lit(0.0)).alias("total"),
        F.max("bins").alias("bins"), F.max("reference_values").alias("rv"),
        F.max("current_values").alias("cv"), F.max("current_inside").alias("ci"))
    undefined = (F.col("bins") > 0) & (F.col("rv") > 0) & (F.col("cv") > 0) & (F.col("ci") == 0)
    return scored.select("metric", F.when(undefined, F.lit(math.nan)).otherwise(F.col("total")).alias("psi"),
                         undefined.alias("psi_undefined"))


def psi(windowed: DataFrame, columns: dict[str, str] = COLUMNS, bins: int = policy.PSI_BINS,
        approximate: bool = False) -> DataFrame:
    edges = quantile_edges(windowed.where("window = 'reference'"), columns, bins, approximate)
    return psi_by_metric(full_histogram(histogram(windowed, columns, edges), edges))


def label_drift(windowed: DataFrame) -> DataFrame:
    def rate(w):
        return F.avg(F.when(F.col("window") == w, F.col(policy.LABEL)))

    return windowed.agg(rate("reference").alias("reference_late_rate"),
                        rate("current").alias("current_late_rate")).withColumn(
        "label_drift", F.abs(F.col("current_late_rate") - F.col("reference_late_rate")))


def widened(index: DataFrame) -> DataFrame:
    """Stability per metric as one row: score_psi, max_feature_psi, psi_<feature>, psi_undefined."""
    feature = F.col("metric") != SCORE_METRIC
    defined = F.when(~F.col("psi_undefined"), F.col("psi"))
    return index.agg(
        F.max(F.when(~feature, F.col("psi"))).alias("score_psi"),
        F.max(F.when(feature, defined)).alias("max_feature_psi"),
        *[F.max(F.when(F.col("metric") == f, F.col("psi"))).alias(f"psi_{f}") for f in policy.DRIFT_FEATURES],
        F.bool_or("psi_undefined").alias("psi_undefined"))


def monitor_row(windowed: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: stability per metric, the worst feature, recent AUC and label drift."""
    wide = widened(psi(windowed, approximate=approximate))
    auc = evaluate(windowed.where("window = 'current'")).select(F.col("roc_auc").alias("current_auc"))
    rates = label_drift(windowed)
    return (wide.withColumns({"current_auc": auc.scalar(), "rates": rates.select(F.struct(*rates.columns)).scalar()})
            .select("*", "rates.*").drop("rates"))


def decide(row: DataFrame, psi_limit: float = policy.PSI_LIMIT, min_auc: float = policy.MIN_AUC) -> DataFrame:
    """The monitor row plus drift_detected, performance_low, retrain_recommended and reasons."""
    def over(c):
        return F.coalesce(~F.isnan(c) & (F.col(c) > psi_limit), F.lit(False))

    low = F.coalesce(F.col("current_auc") < min_auc, F.lit(False))
    drift = over("score_psi") | over("max_feature_psi")
    reasons = F.array_compact(F.array(F.when(over("score_psi"), "score_psi>threshold"),
                                      F.when(over("max_feature_psi"), "feature_psi>threshold"),
                                      F.when(low, "auc<min")))
    return row.withColumns({
        "drift_detected": drift, "performance_low": low, "retrain_recommended": drift | low,
        "reasons": F.when(F.size(reasons) == 0, F.array(F.lit("within_thresholds"))).otherwise(reasons)})


METRICS = ("score_psi", "max_feature_psi", "current_auc", "reference_late_rate", "current_late_rate",
           "label_drift", *[f"psi_{f}" for f in policy.DRIFT_FEATURES],
           "drift_detected", "performance_low", "retrain_recommended")


def tall_metrics(decided: DataFrame) -> DataFrame:
    """One row per metric, flags as 0 or 1."""
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in METRICS]
    return decided.select(F.inline(F.array(*cells))).withColumn("computed_at", F.current_timestamp())


#: The report document as it is read back.
REPORT = ("generated_at STRING, model_version STRING, split_ts STRING, thresholds STRUCT<psi: DOUBLE, min_auc: DOUBLE>, metrics MAP<STRING, DOUBLE>, "
          "decision STRUCT<drift_detected: BOOLEAN, performance_low: BOOLEAN, retrain_recommended: BOOLEAN, reasons: ARRAY<STRING>>")


def report(decided: DataFrame, version: str, split_ts, psi_limit: float = policy.PSI_LIMIT,
           min_auc: float = policy.MIN_AUC) -> DataFrame:
    """One nested row: what was measured, the limits in force, and the verdict with its reasons."""
    metrics = F.create_map(*[x for m in METRICS for x in (F.lit(m), F.col(m).cast("double"))])
    return decided.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generated_at"),
        F.lit(version).alias("model_version"), F.lit(str(split_ts)).alias("split_ts"),
        F.struct(F.lit(psi_limit).alias("psi"), F.lit(min_auc).alias("min_auc")).alias("thresholds"),
        metrics.alias("metrics"),
        F.struct("drift_detected", "performance_low", "retrain_recommended", "reasons").alias("decision"))
