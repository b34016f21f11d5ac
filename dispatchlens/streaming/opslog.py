"""Deploy runs reconciled with retrain outcomes while both logs grow."""

from pyspark.sql import DataFrame, functions as F

from dispatchlens.streaming.ledger import KeyedTable


def _given(column: str):
    return F.coalesce(F.col(column) != "", F.lit(False))


def reconciled(runs: DataFrame, outcomes: DataFrame, key: str = "run_id", run_ts: str = "run_at", outcome_ts: str = "outcome_at",
               within: str = "2 hours", delay: str = "10 minutes") -> DataFrame:
    """Streams of runs and outcomes to rows (the run's columns, retrain_state, outcome_at, until) for a KeyedTable.

    Every run comes at once, as running if it queued a retrain, and once more for each outcome that arrives within the time bound; a run
    whose bound passes without one comes as running for the last time. Both sides' state ends with the bound. Runs that queued
    nothing take no part in the join, so that they neither meet under one key nor take up state.
    """
    columns = runs.columns
    until = (F.col(run_ts) + F.expr(f"INTERVAL {within}")).alias("until")
    at_once = runs.withWatermark(run_ts, delay).select(
        *columns, F.when(_given("dag_run_id"), "running").alias("retrain_state"), F.lit(None).cast("timestamp").alias("outcome_at"), until)
    queued = runs.where(_given("dag_run_id")).withWatermark(run_ts, delay)
    known = outcomes.where(_given("dag_run_id")).withWatermark(outcome_ts, delay).select(
        F.col("dag_run_id").alias("_id"), F.col("state").alias("_state"), F.col(outcome_ts).alias("_at"))
    in_time = (F.col("_at") >= F.col(run_ts)) & (F.col("_at") <= F.col(run_ts) + F.expr(f"INTERVAL {within}"))
    joined = queued.join(known, (F.col("dag_run_id") == F.col("_id")) & in_time, "left_outer").select(
        *columns, F.coalesce("_state", F.lit("running")).alias("retrain_state"), F.col("_at").alias("outcome_at"), until)
    return at_once.unionByName(joined)


def reconciled_table(stream: DataFrame, path: str, key: str = "run_id") -> KeyedTable:
    """The newest state of every run: the last outcome wins."""
    return KeyedTable(path, stream.schema, [key], "until", "outcome_at")
