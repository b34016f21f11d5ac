"""Permutation importance: how much the AUC falls when one feature's values are shuffled.

A feature that the score doesn't read can't change it: its drop is the AUC less itself, and no row is moved for it.

Rows are put in random order inside random blocks of bounded size, and each row takes the next
row's value, the last row the first one's. Every value is used exactly once, and no task orders
more than a block.
"""

import math

from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from dispatchlens import policy
from dispatchlens.operators.evaluation import evaluate
from dispatchlens.operators.scoring import SCORE

ROWS_PER_BLOCK = 100_000


def shuffled(rows: DataFrame, seed: int, digits: int, columns) -> DataFrame:
    """The rows plus `other`: the named columns of another row. 16 ** digits blocks."""
    token = F.md5(F.concat_ws("|", F.col(policy.ORDER_ID).cast("string"), F.lit(str(seed))))
    block = W.partitionBy("block").orderBy("token", policy.ORDER_ID)
    whole = block.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    values = F.struct(*columns)
    return (rows.withColumn("token", token).withColumn("block", F.substring("token", 1, digits))
            .withColumn("other", F.coalesce(F.lead(values).over(block), F.first(values).over(whole)))
            .drop("token", "block"))


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, T.StringType)


def _reads(score, table: DataFrame, feature: str) -> bool:
    """Whether the score needs the feature: on a table without it Spark, or the model, finds a column missing."""
    try:
        return not score(table.drop(feature)).schema
    except (AnalysisException, IllegalArgumentException):
        return True


def permutation_importance(validation: DataFrame, score, features=policy.FEATURES, repeats: int = 5,
                           seed: int = policy.SEED, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Mean and deviation of the AUC drop per feature.

    `score` adds the score column to a feature table, and fails on one that lacks a column it reads. Every shuffled row is copied
    once per feature that is read, with only that feature exchanged, so all features and repeats are scored and ranked in one job.
    """
    given = list(features)
    features = [f for f in given if _reads(score, validation, f)]
    rows = validation.count()
    digits = max(0, math.ceil(math.log(max(rows, 1) / rows_per_block, 16)))
    plain = score(validation).select(SCORE, policy.LABEL)
    base = evaluate(plain).select(F.col("roc_auc").alias("base_auc"))
    unread = [f for f in given if f not in features]
    same = F.col("base_auc") - F.col("base_auc")  # null where there is no AUC
    still = base.select(F.explode(F.array(*map(F.lit, unread)).cast("array<string>")).alias("feature"), same.alias("auc_drop"), same.alias("auc_drop_std"))
    if not features:
        return still
    mixed = None
    for r in range(repeats):
        part = shuffled(validation, seed + r, digits, features).withColumn("repeat", F.lit(r))
        mixed = part if mixed is None else mixed.unionByName(part)
    kinds = {f: validation.schema[f].dataType for f in features}
    # A copy carries its one exchanged value, as a number or as text, not the other row.
    cells = F.array(*[F.struct(F.lit(f).alias("feature"),
                               (F.lit(None) if _is_text(kinds[f]) else F.col("other")[f]).cast("double").alias("number"),
                               (F.col("other")[f] if _is_text(kinds[f]) else F.lit(None)).cast("string").alias("text")) for f in features])
    keep = [c for c in mixed.columns if c != "other"]
    copies = mixed.select(*keep, F.inline(cells))
    swapped = copies.withColumns({f: F.when(F.col("feature") == f, F.col("text" if _is_text(kinds[f]) else "number").cast(kinds[f]))
                                  .otherwise(F.col(f)) for f in features}).drop("number", "text")
    auc = evaluate(score(swapped), by=["feature", "repeat"]).withColumn("base_auc", base.scalar())
    drop = F.col("base_auc") - F.col("roc_auc")
    return auc.groupBy("feature").agg(F.avg(drop).alias("auc_drop"), F.stddev_pop(drop).alias("auc_drop_std")).unionByName(still)
