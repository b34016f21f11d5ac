"""Column expressions: elapsed time, calendar, rounding, clipping, text forms."""

from pyspark.sql import Column, functions as F

DAY_MICROS = 86_400_000_000
HOUR_MICROS = 3_600_000_000


def elapsed_micros(start, end) -> Column:
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end))


def ceil_days(start, end) -> Column:
    """Whole days from start to end, any part of a day counting as one; may be negative."""
    return F.ceil(elapsed_micros(start, end) / F.lit(float(DAY_MICROS))).cast("int")


def elapsed_hours(start, end) -> Column:
    return elapsed_micros(start, end) / F.lit(float(HOUR_MICROS))


def day_of_week(ts) -> Column:
    """0 is Sunday."""
    return F.dayofweek(ts) - 1


def is_weekend(ts) -> Column:
    return F.dayofweek(ts).isin(1, 7).cast("int")


def is_month_end(ts) -> Column:
    """1 on the last three days of a month."""
    return (F.dayofmonth(F.last_day(ts)) - F.dayofmonth(ts) <= 2).cast("int")


def clip_unit(p: Column) -> Column:
    return F.greatest(F.least(p, F.lit(1.0)), F.lit(0.0))


def round_half_even(value: Column, places: int) -> Column:
    """Scale, round ties to even, scale back (built-in round() takes ties up)."""
    scale = F.lit(float(10 ** places))
    return F.rint(value * scale) / scale


def short_commit(commit) -> Column:
    return F.substring(F.coalesce(F.col(commit), F.lit("")), 1, 7)


def iso_epoch(text) -> Column:
    """ISO-8601 text to Unix seconds; empty, null or unreadable text gives 0.0."""
    text = F.col(text)
    iso = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    stamp = F.try_to_timestamp(F.when(iso, text))
    return F.coalesce(F.unix_micros(stamp) / F.lit(1e6), F.lit(0.0))


def path_list(text) -> Column:
    """Newline-separated paths to an array without blank entries."""
    return F.filter(F.split(F.col(text), r"\r\n|\r|\n"), lambda p: F.trim(p) != "")
