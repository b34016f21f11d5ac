"""The reference window as stored, mergeable sketches: monitoring reads them instead of that window.

One KLL sketch per metric has a fixed size, whatever the number of rows; sketches of parts (months, runs) merge into one. What a
sketch says of a value's rank is off by at most `rank_error(k)` of the rows, with 99 % confidence.
"""

import math

from pyspark.sql import DataFrame, functions as F

from dispatchlens import policy
from dispatchlens.operators import drift
from dispatchlens.operators.evaluation import evaluate
from dispatchlens.operators.scoring import SCORE

K = 4_096


def rank_error(k: int = K) -> float:
    """Normalised rank error of a KLL sketch, for one rank; its published fit."""
    return 2.296 / k**0.9021


def sketched(rows: DataFrame, columns: dict[str, str] = drift.COLUMNS, by=(), k: int = K) -> DataFrame:
    """(by..., metric, rows, late, sketch): one row per metric, in one pass. Nulls and NaN are left out of a sketch; rows and
    late count all rows."""
    values = {m: F.col(c).cast("double") for m, c in columns.items()}
    numbers = rows.select(*by, policy.LABEL, *[F.when(~F.isnan(v), v).alias(f"v_{m}") for m, v in values.items()])
    wide = numbers.groupBy(*by).agg(F.count("*").alias("rows"), F.sum(policy.LABEL).cast("bigint").alias("late"),
                                    *[F.kll_sketch_agg_double(f"v_{m}", F.lit(k)).alias(f"s_{m}") for m in columns])
    cells = [F.struct(F.lit(m).alias("metric"), F.col(f"s_{m}").alias("sketch")) for m in columns]
    return wide.select(*by, "rows", "late", F.inline(F.array(*cells))).select(*by, "metric", "rows", "late", "sketch")


def merged(sketches: DataFrame) -> DataFrame:
    """One sketch per metric from sketches of parts of the rows."""
    return sketches.groupBy("metric").agg(F.sum("rows").alias("rows"), F.sum("late").alias("late"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantile_edges(sketches: DataFrame, bins: int = policy.PSI_BINS) -> dict[str, list[float]]:
    """{metric: distinct quantile edges}; empty for a metric without values. A row per metric comes to the driver."""
    probs = F.array(*[F.lit(i / bins) for i in range(bins + 1)])
    filled = F.kll_sketch_get_n_double("sketch") > 0
    rows = sketches.select("metric", F.when(filled, F.kll_sketch_get_quantile_double("sketch", probs)).alias("edges")).collect()
    return {r["metric"]: sorted(set(r["edges"] or [])) for r in rows}


def reference_histogram(sketches: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """(metric, bin, n) of the sketched window: differences of the ranks at the edges, bins left-closed, the last one closed."""
    bounded = {m: es for m, es in edges.items() if len(es) > 1}
    if not bounded:
        return sketches.select("metric", F.lit(0).alias("bin"), F.lit(0).cast("bigint").alias("n")).where(F.lit(False))

    def ranks(es: list[float]):
        """Shares of values below each edge, and up to the last one. The values looked up must be literals."""
        points = [*(math.nextafter(e, -math.inf) for e in es[:-1]), es[-1]]
        return F.kll_sketch_get_rank_double("sketch", F.array(*[F.lit(p) for p in points]))

    share = F.coalesce(*[F.when(F.col("metric") == m, ranks(es)) for m, es in bounded.items()])
    found = sketches.where(F.col("metric").isin(*bounded)).select("metric", F.kll_sketch_get_n_double("sketch").alias("all"), share.alias("upto"))
    return found.select("metric", "all", "upto", F.posexplode(F.slice("upto", 2, F.size("upto") - 1)).alias("bin", "high")).select(
        "metric", "bin", F.round((F.col("high") - F.get("upto", F.col("bin"))) * F.col("all")).cast("bigint").alias("n"))


def psi(current: DataFrame, sketches: DataFrame, columns: dict[str, str] = drift.COLUMNS, bins: int = policy.PSI_BINS) -> DataFrame:
    """Stability index per metric of the current rows against the sketched window."""
    edges = {m: [] for m in columns} | quantile_edges(sketches, bins)
    counts = drift.histogram(current.withColumn("window", F.lit("current")), columns, edges)
    past = reference_histogram(sketches, edges).select("metric", F.lit("reference").alias("window"), "bin", "n")
    # A column of one value has no bins; its values still count as there.
    flat = [(m, "reference", -1, 1) for m, es in edges.items() if len(es) == 1]
    alone = current.sparkSession.createDataFrame(flat, "metric STRING, window STRING, bin INT, n BIGINT")
    return drift.psi_by_metric(drift.full_histogram(counts.unionByName(past).unionByName(alone), edges))


def monitor_row(current: DataFrame, sketches: DataFrame) -> DataFrame:
    """The monitor row of drift.monitor_row(), without reading the reference window."""
    index = psi(current, sketches)
    auc = evaluate(current).select(F.col("roc_auc").alias("current_auc"))
    was = sketches.where(F.col("metric") == drift.SCORE_METRIC).select((F.col("late") / F.col("rows")).alias("reference_late_rate"))
    now = current.agg(F.avg(policy.LABEL).alias("current_late_rate"))
    return drift.widened(index).withColumns({"current_auc": auc.scalar(), "reference_late_rate": was.scalar(), "current_late_rate": now.scalar()}).withColumn(
        "label_drift", F.abs(F.col("current_late_rate") - F.col("reference_late_rate")))


def rank_check(reference: DataFrame, sketches: DataFrame, columns: dict[str, str] = drift.COLUMNS, bins: int = policy.PSI_BINS, k: int = K) -> DataFrame:
    """(metric, position, within): whether each quantile of the sketch has its rank in the rows, up to twice the stated error."""
    probs = [i / bins for i in range(bins + 1)]
    wide = sketches.select("metric", F.kll_sketch_get_n_double("sketch").alias("n"), F.posexplode(
        F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(p) for p in probs]))).alias("position", "edge"))
    # A row per metric and quantile.
    edges = {m: [] for m in columns}
    for r in wide.orderBy("metric", "position").collect():
        edges[r["metric"]].append(r["edge"])
    values = {m: F.col(c).cast("double") for m, c in columns.items()}
    numbers = reference.select(*[F.when(~F.isnan(v), v).alias(m) for m, v in values.items()])
    aggs = [F.count(m).alias(f"n_{m}") for m in columns]
    aggs += [F.count_if(F.col(m) < e).alias(f"lt_{m}_{i}") for m, es in edges.items() for i, e in enumerate(es)]
    aggs += [F.count_if(F.col(m) <= e).alias(f"le_{m}_{i}") for m, es in edges.items() for i, e in enumerate(es)]
    counted = numbers.agg(*aggs)
    slack = 2 * rank_error(k)
    cells = [F.struct(F.lit(m).alias("metric"), F.lit(i).alias("position"),
                      ((F.col(f"lt_{m}_{i}") <= (p + slack) * F.col(f"n_{m}")) & (F.col(f"le_{m}_{i}") >= (p - slack) * F.col(f"n_{m}"))).alias("within"))
             for m, es in edges.items() for i, p in enumerate(probs) if es]
    return counted.select(F.inline(F.array(*cells)))
