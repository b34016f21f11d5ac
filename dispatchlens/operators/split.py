"""Time-ordered split: the past trains, the newest part validates."""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from dispatchlens import policy
from dispatchlens.functions.quantiles import approximate_quantiles, exact_quantiles

EPOCH = dt.datetime(1970, 1, 1)


def temporal_cut(features: DataFrame, quantile: float = policy.SPLIT_QUANTILE,
                 fixed: dt.datetime | str | None = None, approximate: bool = False) -> dt.datetime:
    """The purchase time at the quantile (interpolated), or the given fixed time."""
    if fixed is not None:
        return dt.datetime.fromisoformat(fixed) if isinstance(fixed, str) else fixed
    micros = features.select(
        F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(policy.PURCHASE_TS))
        .alias("micros"))
    find = approximate_quantiles if approximate else exact_quantiles
    values = find(micros, ["micros"], [quantile])["micros"]
    if values is None:
        raise ValueError("no rows to split")
    return EPOCH + dt.timedelta(microseconds=round(values[0]))


def cut_literal(cut: dt.datetime):
    return F.lit(cut.isoformat(sep=" ")).cast("timestamp_ntz")


def temporal_split(features: DataFrame, cut: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Rows before the cut, and rows at or after it."""
    bought = F.col(policy.PURCHASE_TS)
    return features.where(bought < cut_literal(cut)), features.where(bought >= cut_literal(cut))


def with_window(features: DataFrame, cut: dt.datetime) -> DataFrame:
    """The input plus `window`: reference before the cut, current from it on."""
    current = F.col(policy.PURCHASE_TS) >= cut_literal(cut)
    return features.withColumn("window", F.when(current, "current").otherwise("reference"))
