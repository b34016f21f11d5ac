"""Ranking and calibration metrics from cumulative counts over distinct scores.

Rows are counted per distinct score first and the counts are stored, so that the scores are made once. Where there are many,
Spark's range partitioning deals them out into as many buckets as the rows ask for; running sums stay inside a bucket,
a bucket starts at the sums of its block of buckets so far, and a block at the sums of the blocks before. No task sorts the
whole score column, and no list of buckets is bounded or held by the driver.
"""

import math

from pyspark.sql import DataFrame, Window as W, functions as F

from dispatchlens import policy, session
from dispatchlens.operators.scoring import SCORE

#: Distinct scores that one task ranks.
ROWS_PER_BUCKET = 500_000


def _stored(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = session.scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _matched(left: DataFrame, right: DataFrame, columns) -> DataFrame:
    """Inner join of equal columns, nulls among them; left's columns, then what right has besides."""
    renamed = right.withColumnsRenamed({c: f"_of_{c}" for c in columns})
    on = F.lit(True)
    for c in columns:
        on = on & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return left.join(renamed, on).drop(*[f"_of_{c}" for c in columns])


def _starts(placed: DataFrame, by: list[str], buckets: int) -> DataFrame:
    """(by, bucket, positives_above, negatives_above): sums of all buckets before, by blocks of buckets."""
    side = math.isqrt(max(buckets - 1, 0)) + 1
    totals = placed.groupBy(*by, "bucket").agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
    totals = totals.withColumn("block", F.floor(F.col("bucket") / side))

    def before(column, window):
        return F.coalesce(F.sum(column).over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))

    blocks = totals.groupBy(*by, "block").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    upto = W.partitionBy(*by).orderBy("block")
    blocks = blocks.select(*by, "block", before("p", upto).alias("block_p"), before("n", upto).alias("block_n"))
    inside = W.partitionBy(*by, "block").orderBy("bucket")
    totals = totals.select(*by, "block", "bucket", before("p", inside).alias("own_p"), before("n", inside).alias("own_n"))
    return _matched(totals, blocks, [*by, "block"]).select(
        *by, "bucket", (F.col("block_p") + F.col("own_p")).alias("positives_above"),
        (F.col("block_n") + F.col("own_n")).alias("negatives_above"))


def score_steps(scored: DataFrame, score: str = SCORE, label: str = policy.LABEL, by=(),
                rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Per distinct score: positives, negatives, and both summed from the top score down."""
    by = list(by)
    rows = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(*by, score, label)
    counts = _stored(rows.groupBy(*by, score).agg(
        F.sum(label).cast("bigint").alias("positives"),
        F.sum(1 - F.col(label)).cast("bigint").alias("negatives")), "scores")
    buckets = -(-counts.count() // rows_per_bucket)
    if buckets < 2:
        down = W.partitionBy(*by).orderBy(F.desc(score)).rowsBetween(W.unboundedPreceding, 0)
        return counts.withColumns({"true_positives": F.sum("positives").over(down),
                                   "false_positives": F.sum("negatives").over(down)})
    # Stored, so that a bucket's number holds for its rows and for its start alike.
    placed = _stored(counts.repartitionByRange(buckets, F.desc(score)).withColumn("bucket", F.spark_partition_id()), "buckets")
    starts = _starts(placed, by, buckets)
    inside = W.partitionBy(*by, "bucket").orderBy(F.desc(score)).rowsBetween(W.unboundedPreceding, 0)
    return _matched(placed, starts, [*by, "bucket"]).withColumns({
            "true_positives": F.col("positives_above") + F.sum("positives").over(inside),
            "false_positives": F.col("negatives_above") + F.sum("negatives").over(inside)})


def evaluate(scored: DataFrame, score: str = SCORE, label: str = policy.LABEL, by=(),
             threshold: float = 0.5, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """pr_auc (average precision), roc_auc, brier, f1_at_0_5, val_positive_rate, rows per group.

    roc_auc is null when only one class is present; f1 is 0 when undefined.
    """
    steps = score_steps(scored, score, label, by, rows_per_bucket)
    p, s = F.col("positives").cast("double"), F.col(score)
    n = F.col("negatives").cast("double")
    tp, fp = F.col("true_positives").cast("double"), F.col("false_positives").cast("double")
    flagged = s >= threshold
    sums = steps.groupBy(*by).agg(
        F.sum(p).alias("pos"), F.sum(n).alias("neg"),
        F.sum(p * tp / (tp + fp)).alias("precision_sum"),
        F.sum(n * (tp - p / 2)).alias("ordered_pairs"),
        F.sum(p * (s - 1) * (s - 1) + n * s * s).alias("squared"),
        F.sum(F.when(flagged, p).otherwise(0.0)).alias("hit"),
        F.sum(F.when(flagged, p + n).otherwise(0.0)).alias("called"))
    pos, neg = F.col("pos"), F.col("neg")
    rows = pos + neg
    return sums.select(
        *by,
        F.when(pos > 0, F.col("precision_sum") / pos).otherwise(F.when(rows > 0, 0.0)).alias("pr_auc"),
        F.when((pos > 0) & (neg > 0), F.col("ordered_pairs") / (pos * neg)).alias("roc_auc"),
        F.when(rows > 0, F.col("squared") / rows).alias("brier"),
        F.when(pos + F.col("called") > 0, 2 * F.col("hit") / (pos + F.col("called"))).otherwise(0.0)
        .alias("f1_at_0_5"),
        F.when(rows > 0, pos / rows).alias("val_positive_rate"),
        F.coalesce(rows, F.lit(0.0)).cast("bigint").alias("rows"))


def leaderboard(metrics: DataFrame, order: list[str]) -> DataFrame:
    """Candidates' metrics plus `winner`: the largest pr_auc, the first in `order` on a tie."""
    place = F.array_position(F.array(*[F.lit(c) for c in order]), F.col("candidate"))
    best = metrics.agg(F.max_by("candidate", F.struct("pr_auc", -place)).alias("best"))
    return metrics.select(*metrics.columns, (F.col("candidate") == best.scalar()).alias("winner"))
