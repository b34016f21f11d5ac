"""Queries make and move only what they read."""

import json
import shutil

from pyspark.sql import functions as F

from dispatchlens import policy, schemas, session
from dispatchlens.operators import importance, opslog
from dispatchlens.plans import queries
from dispatchlens.sources import files, jsonl


def test_a_csv_query_writes_its_own_file_only(spark, tmp_path):
    folder = f"{tmp_path}/sf"
    shutil.copytree("/root/testdata/sf0.001", folder)  # a folder no other test has used
    rows = queries.QUERIES["csv_reviews"](spark, folder).count()
    data = session.written_path(spark, ("csv", folder), None)
    assert files.names(spark, data) == ["olist_order_reviews_dataset.csv"]
    assert queries.QUERIES["raw_load"](spark, folder).where("table_name = 'order_reviews'").first()["rows"] == rows > 0
    assert len(files.names(spark, data)) == len(queries.adapter.RAW)


def test_importance_copies_rows_for_features_the_score_reads(spark, monkeypatch):
    """A score of two features: the others' drops are 0 as before, without a copy of any row."""
    table = spark.range(400).select(F.col("id").alias("order_id"), *[F.rand(k).alias(c) for k, c in enumerate("abcd")])
    table = table.withColumn(policy.LABEL, (F.col("a") + F.col("c") > 1).cast("int"))
    seen, evaluate = set(), importance.evaluate

    def noted(scored, by=(), **more):
        if by:
            seen.update(r[0] for r in scored.select("feature").distinct().collect())
        return evaluate(scored, by=by, **more)

    monkeypatch.setattr(importance, "evaluate", noted)
    got = {r["feature"]: (r["auc_drop"], r["auc_drop_std"]) for r in importance.permutation_importance(
        table, lambda t: t.withColumn(importance.SCORE, F.col("a") + F.col("c")), list("abcd"), 2).collect()}
    assert seen == {"a", "c"}
    assert got["b"] == got["d"] == (0.0, 0.0) and got["a"][0] > 0.1 and got["c"][0] > 0.1
    one_class = table.withColumn(policy.LABEL, F.lit(1))
    found = importance.permutation_importance(one_class, lambda t: t.withColumn(importance.SCORE, F.col("a")), ["a", "b"], 2).collect()
    assert {(r["feature"], r["auc_drop"]) for r in found} == {("a", None), ("b", None)}


def test_the_run_log_is_read_once_for_all_gauges(spark, tmp_path, capsys):
    """Gauges, snapshot and latest retrain come from the recent runs as stored, not from the log anew for each of them."""
    lines = [json.dumps({"new_commit": f"{i:07d}", "status": "success", "finished_at": "2024-01-01T00:00:00Z", "dag_run_id": f"q{i}" if i % 5 == 0 else ""}) for i in range(90)]
    (tmp_path / "runs.jsonl").write_text("\n".join(lines) + "\n")
    told = [json.dumps({"dag_run_id": f"q{i}", "state": s}) for i in range(90) for s in ("failed", f"s{i}")]
    (tmp_path / "outcomes.jsonl").write_text("\n".join(told) + "\n")
    runs = jsonl.read_log(spark, f"{tmp_path}/runs.jsonl", schemas.DEPLOY_RUN)
    outcomes = jsonl.read_log(spark, f"{tmp_path}/outcomes.jsonl", schemas.RETRAIN_OUTCOME)
    gauges, snap = opslog.deploy_gauges(runs, outcomes, F.lit(2e9)), opslog.snapshot(runs, outcomes, 7)
    retrain = opslog.latest_retrain(runs, outcomes, 7)
    for table in (gauges, snap, retrain):
        table.explain("formatted")
        shown = capsys.readouterr().out
        assert "outcomes.jsonl" in shown and "runs.jsonl" not in shown
    got = gauges.first()
    assert (got.last_commit, got.runs_total, got.retrain_state, got.retrain_run_id) == ("0000089", min(90, policy.HISTORY_LIMIT), "s85", "q85")
    assert (snap.first().new_commit, snap.first().total_recorded) == ("0000089", 7)
    assert retrain.first().dag_run_id == "q85" and opslog.latest_retrain(runs, outcomes, 4).count() == 0
    assert opslog.deploy_gauges(runs, outcomes, F.lit(2e9), 0).first().runs_total == 90
