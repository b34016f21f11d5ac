"""Operations log: deploy runs reconciled with the outcomes of the retrains they queued."""

from pyspark.sql import Column, DataFrame, functions as F

from dispatchlens import policy, session
from dispatchlens.functions import expressions as X
from dispatchlens.sources.jsonl import SEQUENCE

# Step names, the record keys behind them, and what a step shows for a run's status or an action's result.
GATES = {"New commit": {}, "Fast-forward": {"ff_failed": "failed"}, "Test gate": {"ff_failed": "skipped", "tests_failed": "failed"}}
ACTION_STEPS = {"Restart API": "restart", "Trigger Airflow": "trigger", "Import Grafana": "import"}
RESULTS = {"no": "skipped", "ok": "ok", "queued": "queued"}
RETRAIN_NODES = {"success": "ok", "failed": "failed", "timeout": "warn", "running": "running"}
STOPPED = ("ff_failed", "tests_failed")


def _given(column: str) -> Column:
    return F.coalesce(F.col(column) != "", F.lit(False))


def last_outcomes(outcomes: DataFrame) -> DataFrame:
    """The last appended outcome per dag_run_id; records without an id are skipped."""
    last = F.max_by(F.struct("state", "deploy_commit"), F.col(SEQUENCE))
    return (outcomes.where(_given("dag_run_id")).groupBy("dag_run_id").agg(last.alias("last"))
            .select("dag_run_id", "last.state", "last.deploy_commit"))


def with_retrain_state(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Runs plus retrain_state: null without an id, running until an outcome is known."""
    known = last_outcomes(outcomes).select(F.col("dag_run_id").alias("_id"), "state", F.lit(True).alias("known"))
    state = F.when(_given("dag_run_id"), F.when(F.col("known"), F.col("state")).otherwise("running"))
    # Runs without an id get keys of their own, so that they don't meet in one partition.
    own = F.concat(F.lit("\0"), F.xxhash64(SEQUENCE).cast("string"))
    key = F.when(_given("dag_run_id"), F.col("dag_run_id")).otherwise(own)
    return runs.join(known, key == F.col("_id"), "left").select(
        *[runs[c] for c in runs.columns], state.alias("retrain_state"))


def recent_runs(runs: DataFrame, limit: int = policy.HISTORY_LIMIT) -> DataFrame:
    """The last `limit` runs in append order, newest first; all of them when limit <= 0."""
    newest = runs.orderBy(F.desc(SEQUENCE))
    return newest.limit(limit) if limit > 0 else newest


def _recent(runs: DataFrame, limit: int) -> DataFrame:
    """recent_runs() without an order; a limited number of them stored, so that the log is read and parsed once for all views."""
    if limit <= 0:
        return runs
    spark = runs.sparkSession
    path = session.scratch_path(spark, "recent")
    recent_runs(runs, limit).write.parquet(path)
    return spark.read.schema(runs.schema).parquet(path)


def _known_of(queued: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The outcomes of one run; the others needn't be grouped."""
    wanted = queued.select(F.col("dag_run_id").alias("_wanted"))
    return outcomes.join(F.broadcast(wanted), F.col("dag_run_id") == F.col("_wanted"), "left_semi")


def _one_row(spark, **rows: DataFrame) -> DataFrame:
    """One row with a struct per frame of at most one row; a struct is null when its frame is empty."""
    return spark.range(1).select(*[df.select(F.struct("*")).scalar().alias(name) for name, df in rows.items()])


def snapshot(runs: DataFrame, outcomes: DataFrame, limit: int = policy.HISTORY_LIMIT) -> DataFrame:
    """One row: status and details of the latest run, and how many runs the view covers."""
    recent = _recent(runs, limit)
    last = recent_runs(recent, 1)
    latest = with_retrain_state(last, _known_of(last, outcomes)).drop(SEQUENCE)
    total = recent.agg(F.count("*").alias("recorded"))
    details = [c for c in latest.columns if c != "status"]
    return _one_row(runs.sparkSession, latest=latest, total=total).select(
        F.coalesce("latest.status", F.lit("unknown")).alias("status"),
        F.when(F.col("latest").isNull(), "no deploys recorded yet").alias("message"),
        *[F.col("latest")[c].alias(c) for c in details], F.col("total.recorded").alias("total_recorded"))


def latest_retrain(runs: DataFrame, outcomes: DataFrame, limit: int = policy.HISTORY_LIMIT) -> DataFrame:
    """The newest run among the last `limit` that queued a retrain; no row when none did."""
    return _latest_retrain(_recent(runs, limit), outcomes)


def _latest_retrain(recent: DataFrame, outcomes: DataFrame) -> DataFrame:
    queued = recent_runs(recent.where(_given("dag_run_id")), 1)
    return with_retrain_state(queued, _known_of(queued, outcomes)).select(
        "dag_run_id", F.col("retrain_state").alias("state"),
        F.coalesce("new_commit", F.lit("")).alias("deploy_commit"))


def _node(name: str, state: Column, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), state.alias("state"), detail.alias("detail"))


def _looked_up(table: dict[str, str], key: Column, default: str) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[key], F.lit(default)) if pairs else F.lit(default)


def step_states(reconciled: DataFrame) -> DataFrame:
    """Runs (with retrain_state) plus the state of every gate, action and retrain step.

    Gates and actions read their tables above; an action behind a closed gate is skipped, one whose result tells of a failure has failed.
    """
    status = F.coalesce("status", F.lit(""))
    retrain = F.col("retrain_state")
    actions = []
    for name, key in ACTION_STEPS.items():
        result = F.lower(F.coalesce(F.nullif(F.col("actions")[key], F.lit("")), F.lit("no")))
        shown = F.when(result.contains("fail"), "failed").otherwise(_looked_up(RESULTS, result, "warn"))
        actions.append(_node(name, F.when(status.isin(*STOPPED), "skipped").otherwise(shown), F.coalesce(F.col("actions")[key], F.lit("no"))))
    return reconciled.withColumns({
        "gate": F.array(*[_node(name, _looked_up(table, status, "ok"), F.lit("")) for name, table in GATES.items()]),
        "action_steps": F.array(*actions),
        "retrain": _node("Retrain", _looked_up(RETRAIN_NODES, retrain, "skipped"), F.coalesce(retrain, F.lit("not run")))})


def deploy_gauges(runs: DataFrame, outcomes: DataFrame, now: Column | None = None,
                  limit: int = policy.HISTORY_LIMIT) -> DataFrame:
    """One row of gauges on the latest run and the latest retrain; defaults when none is recorded."""
    now = F.unix_micros(F.current_timestamp()) / F.lit(1e6) if now is None else now
    finished, recent = X.iso_epoch("finished_at"), _recent(runs, limit)
    latest = recent_runs(recent, 1).select(
        (F.col("status") == "success").cast("int").alias("last_status"),
        finished.alias("last_timestamp_seconds"), (now - finished).alias("last_age_seconds"),
        F.coalesce("duration_seconds", F.lit(0)).cast("double").alias("last_duration_seconds"),
        X.short_commit("new_commit").alias("last_commit"),
        F.coalesce("status", F.lit("unknown")).alias("last_status_label"))
    row = _one_row(runs.sparkSession, latest=latest, retrain=_latest_retrain(recent, outcomes),
                   total=recent.agg(F.count("*").alias("runs")))
    state = F.coalesce("retrain.state", F.lit("none"))
    return row.select(
        F.coalesce("latest.last_status", F.lit(0)).alias("last_status"),
        *[F.col("latest")[c].alias(c) for c in latest.columns if c != "last_status"],
        F.col("total.runs").alias("runs_total"), (state == "success").cast("int").alias("last_retrain_status"),
        state.alias("retrain_state"), F.coalesce("retrain.dag_run_id", F.lit("none")).alias("retrain_run_id"))


def run_records(facts: DataFrame, *keep: str) -> DataFrame:
    """Deploy facts with newline-separated paths to log records with id and defaults."""
    return facts.select(
        *keep,
        F.concat(X.short_commit("new_commit"), F.lit("-"), F.col("finished_at")).alias("run_id"),
        "started_at", "finished_at",
        F.coalesce(F.col("duration_seconds").try_cast("int"), F.lit(0)).alias("duration_seconds"),
        "branch", "old_commit", "new_commit", X.path_list("changed_paths").alias("changed_paths"),
        F.coalesce("status", F.lit("error")).alias("status"),
        F.struct(*[F.coalesce(k, F.lit("no")).alias(k) for k in ACTION_STEPS.values()]).alias("actions"),
        F.nullif("dag_run_id", F.lit("")).alias("dag_run_id"), "host")
