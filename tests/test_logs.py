"""Contract records, JSON-lines logs, operations log and service roll-ups."""

import json
import statistics
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from dispatchlens import policy, schemas
from dispatchlens.operators import contract, opslog, scoring, service
from dispatchlens.sources import jsonl
from dispatchlens.sources.layers import empty

#: One order, from which a scoring record is worked out: price, freight, weight, length, height and width of each line.
LINES = [(19.5, 4.25, 310.0, 21.0, 6.0, 14.0), (19.5, 4.25, 310.0, 21.0, 6.0, 14.0), (249.0, 31.5, 5400.0, 62.0, 40.0, 35.0)]
BOUGHT = datetime(2031, 8, 31, 21, 40, tzinfo=UTC)
DAYS = 17


def measures(name, values, kinds=("mean", "max")):
    made = {"sum": sum, "mean": statistics.mean, "max": max, "std": statistics.stdev}
    return {f"{name}_{kind}": made[kind](values) for kind in kinds}


def record(**changes):
    """The record of LINES, with fields changed or added."""
    price, freight, weight, length, height, width = map(list, zip(*LINES, strict=True))
    money = ("sum", "mean", "max", "std")
    own = {"order_id": "k-9041", "payment_count": 1, "payment_type_mode": "boleto", "max_installments": 1.0,
           "order_item_count": len(LINES), "product_count": len(set(LINES)), "seller_count": 2}
    own |= measures("price", price, money) | measures("freight", freight, money)
    own |= measures("total_cost", [p + f for p, f in zip(price, freight, strict=True)], money[:3])
    own |= {"product_category_count": 2, "product_category_mode": "garden", "is_multi_category": True}
    for name, values in {"product_weight_g": weight, "product_length_cm": length, "product_height_cm": height,
                         "product_width_cm": width, "product_volume": [a * b * c for *_, a, b, c in LINES]}.items():
        own |= measures(name, values)
    own |= {"seller_state_mode": "AM", "seller_state_count": 2, "seller_city_count": 2, "seller_zip_mode": 69005}
    own |= {"purchase_hour": BOUGHT.hour, "purchase_dayofweek": BOUGHT.weekday(), "is_weekend_purchase": int(BOUGHT.weekday() > 4),
            "purchase_month": BOUGHT.month, "purchase_quarter": (BOUGHT.month + 2) // 3, "is_month_end": 1}
    own |= {"estimated_delivery_days": DAYS, "approval_delay_hours": 0.25, "shipping_limit_min_days": 4,
            "shipping_window_days": 9, "seller_margin_days": DAYS - 4}
    return own | changes


def without(*names):
    return {k: v for k, v in record().items() if k not in names}


ACCEPTED = [record(), without(*policy.OPTIONAL), record(**dict.fromkeys(policy.OPTIONAL)), record(seller_margin_days=-40),
            record(estimated_delivery_days=1), record(purchase_hour=0), record(order_item_count="3"), record(seller_count=2.0),
            record(price_sum=0), record(freight_max="1e2")]
REJECTED = [
    (record(is_late_delivery=0), ["unknown:is_late_delivery"]),
    (record(review_score=5, colour="red"), ["unknown:colour", "unknown:review_score"]),
    (without("order_id"), ["missing:order_id"]), (without("freight_mean", "seller_count"), ["missing:freight_mean", "missing:seller_count"]),
    (record(purchase_month=None), ["missing:purchase_month"]),
    (record(purchase_hour=-1), ["range:purchase_hour"]), (record(purchase_dayofweek=7), ["range:purchase_dayofweek"]),
    (record(freight_sum=-1e-9), ["range:freight_sum"]), (record(freight_sum="NaN"), ["range:freight_sum"]),
    (record(purchase_month=13, purchase_quarter=0, is_month_end=2), ["range:is_month_end", "range:purchase_month", "range:purchase_quarter"]),
    (record(seller_count=0.5), ["type:seller_count"]), (record(total_cost_max="much"), ["type:total_cost_max"]),
    (record(is_multi_category="perhaps"), ["type:is_multi_category"]), ("{\"order_id\": ", ["unreadable"])]


def checked_records(spark, records):
    rows = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    return contract.check_records(spark.createDataFrame(rows, "record_id INT, payload STRING"))


def test_bare_nan_and_infinity_are_no_numbers(spark):
    sent = json.dumps(record(price_sum=float("nan"), freight_mean=float("inf")))
    assert "NaN" in sent and "Infinity" in sent
    assert checked_records(spark, [sent]).first().violations == ["type:price_sum", "type:freight_mean"]
    quoted = json.dumps(record(price_sum="NaN", freight_mean="Infinity"))
    assert checked_records(spark, [quoted]).first().violations == ["range:price_sum"]


def test_records_that_meet_the_contract(spark):
    checked = checked_records(spark, ACCEPTED)
    got = {r.record_id: r for r in contract.accepted(checked).collect()}
    assert len(got) == len(ACCEPTED) and contract.quarantined(checked).count() == 0
    assert got[0].is_multi_category is True and got[6].order_item_count == 3 and got[9].freight_max == 100.0


def test_records_that_break_it_say_how(spark):
    checked = checked_records(spark, [r for r, _ in REJECTED])
    got = {r.record_id: r for r in checked.collect()}
    for i, (sent, want) in enumerate(REJECTED):
        assert sorted(got[i].violations) == want, sent
    assert [got[i].outcome_fields for i in range(2)] == [["is_late_delivery"], ["review_score"]]
    assert contract.accepted(checked).count() == 0 and contract.quarantined(checked).count() == len(REJECTED)


def test_bands_follow_the_formula(spark):
    sent = [record(order_id=f"d{days}", estimated_delivery_days=days) for days in (1, DAYS, 30)]
    table = scoring.predictions(scoring.score(contract.accepted(checked_records(spark, sent)), None), places=4)
    assert set(table.columns) == {"order_id", "late_delivery_probability", "risk_level", "recommended_action",
                                  "model_version", "scored_at"}
    rule, freight = policy.BASELINE, sum(line[1] for line in LINES)
    for r in table.collect():
        p = rule["base"] + rule["per_day"] * int(r.order_id[1:]) + rule["per_freight"] * freight + rule["evening"]
        assert r.late_delivery_probability == pytest.approx(p, abs=1e-4)
        assert r.risk_level == ("high" if p >= policy.HIGH_RISK else "medium" if p >= policy.MEDIUM_RISK else "low")
        assert r.recommended_action == policy.ACTIONS[r.risk_level] and r.model_version == policy.BASELINE_VERSION


ENDED = 1_930_000_000
RETRAIN = "nightly-4"


def run(commit, minute, status="success", retrain=None, **actions):
    """A deploy run that ended so many minutes after ENDED and took as many seconds as its minute, and one."""
    out = {"run_id": f"r{minute}", "new_commit": commit * 10, "status": status, "duration_seconds": minute + 1, "actions": actions,
           "finished_at": datetime.fromtimestamp(ENDED + 60 * minute, UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), "changed_paths": ["lib/a.py", "doc/b.md"]}
    return out | ({"dag_run_id": retrain} if retrain else {})


BROKEN, SHIPPED = run("1f", 3, "tests_failed", restart="no"), run("2e", 8, restart="ok")
WAITING = run("3d", 20, retrain=RETRAIN, restart="ok", trigger="queued")


def log(spark, tmp_path, name, schema, *lines):
    path = tmp_path / name
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return jsonl.read_log(spark, str(path), schema)


def test_absent_log_is_unknown(spark, tmp_path):
    runs = jsonl.read_log(spark, str(tmp_path / "absent.jsonl"), schemas.DEPLOY_RUN)
    outcomes = jsonl.read_log(spark, str(tmp_path / "absent2.jsonl"), schemas.RETRAIN_OUTCOME)
    snap = opslog.snapshot(runs, outcomes).collect()
    assert len(snap) == 1
    assert (snap[0].status, snap[0].message, snap[0].total_recorded) == ("unknown", "no deploys recorded yet", 0)
    gauges = opslog.deploy_gauges(runs, outcomes).first()
    assert (gauges.last_status, gauges.runs_total, gauges.retrain_state, gauges.last_retrain_status) == (0, 0, "none", 0)
    assert opslog.latest_retrain(runs, outcomes).count() == 0


def test_last_line_is_the_newest_run(spark, tmp_path):
    # the order of lines decides, not the times in them; what isn't a whole JSON object is skipped
    lines = [SHIPPED, "", " \t", json.dumps(WAITING)[:-9], "7", "[{}]", "\t" + json.dumps(BROKEN), SHIPPED | {"duration_seconds": "8.5", "actions": "none"}]
    runs = log(spark, tmp_path, "runs.jsonl", schemas.DEPLOY_RUN, *lines)
    none = empty(spark, log(spark, tmp_path, "o.jsonl", schemas.RETRAIN_OUTCOME).schema)
    assert [r.new_commit[:2] for r in opslog.recent_runs(runs).collect()] == ["2e", "1f", "2e"]
    assert [r.new_commit[:2] for r in opslog.recent_runs(runs, 2).collect()] == ["2e", "1f"]
    assert opslog.recent_runs(runs, 0).count() == opslog.recent_runs(runs, -1).count() == 3
    snap = opslog.snapshot(runs, none, 1).first()
    assert (snap.status, snap.new_commit[:2], snap.retrain_state, snap.total_recorded) == ("success", "2e", None, 1)


def test_gauges_tell_age_and_duration(spark, tmp_path):
    runs = log(spark, tmp_path, "runs.jsonl", schemas.DEPLOY_RUN, SHIPPED, BROKEN)
    none = empty(spark, log(spark, tmp_path, "o.jsonl", schemas.RETRAIN_OUTCOME).schema)
    gauges = opslog.deploy_gauges(runs, none, F.lit(float(ENDED + 200))).first()
    assert (gauges.last_commit, gauges.last_status_label, gauges.runs_total) == ("1f1f1f1", "tests_failed", 2)
    assert (gauges.last_duration_seconds, gauges.last_age_seconds) == (4.0, 20.0)


def test_last_outcome_of_a_retrain_holds(spark, tmp_path):
    runs = log(spark, tmp_path, "runs.jsonl", schemas.DEPLOY_RUN, BROKEN, WAITING, SHIPPED)
    none = log(spark, tmp_path, "o1.jsonl", schemas.RETRAIN_OUTCOME)
    assert opslog.latest_retrain(runs, none).first().state == "running"
    told = [{"dag_run_id": RETRAIN, "state": s, "deploy_commit": c} for s, c in (("success", "p"), ("timeout", "q"), ("failed", "r"))]
    some = log(spark, tmp_path, "o2.jsonl", schemas.RETRAIN_OUTCOME, *told, {"state": "success"}, {"dag_run_id": "", "state": "success"})
    assert [tuple(r) for r in opslog.last_outcomes(some).collect()] == [(RETRAIN, "failed", "r")]
    assert opslog.latest_retrain(runs, some).first().state == "failed"
    assert opslog.latest_retrain(runs, some, 1).count() == 0  # limit first, then look for a queued run
    states = {r.new_commit[:2]: r.retrain_state for r in opslog.with_retrain_state(runs, some).collect()}
    assert states == {"1f": None, "2e": None, "3d": "failed"}


@pytest.mark.parametrize("sent, retrain, gate, actions, node", [
    (BROKEN, None, ["ok", "ok", "failed"], ["skipped"] * 3, "skipped"),
    (SHIPPED, None, ["ok"] * 3, ["ok", "skipped", "skipped"], "skipped"),
    (WAITING, "running", ["ok"] * 3, ["ok", "queued", "skipped"], "running"),
    (run("4c", 1, "ff_failed", restart="ok"), None, ["ok", "failed", "skipped"], ["skipped"] * 3, "skipped"),
    (run("5b", 1, "error", trigger="queued"), "timeout", ["ok"] * 3, ["skipped", "queued", "skipped"], "warn"),
    (run("6a", 1, restart="FAILED (exit 3)", trigger="later"), None, ["ok"] * 3, ["failed", "warn", "skipped"], "skipped")])
def test_step_states(spark, tmp_path, sent, retrain, gate, actions, node):
    runs = log(spark, tmp_path, "r.jsonl", schemas.DEPLOY_RUN, sent)
    steps = opslog.step_states(runs.withColumn("retrain_state", F.lit(retrain).cast("string"))).first()
    assert [s.state for s in steps.gate] == gate
    assert [s.state for s in steps.action_steps] == actions
    assert (steps.retrain.state, steps.retrain.detail) == (node, retrain or "not run")


def test_many_files_keep_append_order(spark, tmp_path):
    for part in range(3):
        (tmp_path / f"log-{part}.jsonl").write_text(
            "".join(json.dumps({"dag_run_id": "x", "state": f"{part}-{i}"}) + "\n" for i in range(500)))
    outcomes = jsonl.read_log(spark, str(tmp_path), schemas.RETRAIN_OUTCOME)
    assert opslog.last_outcomes(outcomes).first().state == "2-499"


REQUESTS = [("POST", "/predict", 200, 10.0, 0), ("POST", "/predict", 422, 2.0, 30), ("POST", "/predict", 500, 700.0, 61),
            ("POST", "/batch-predict", 200, 40.0, 299), ("GET", "/health", 200, None, 301)]


@pytest.fixture
def requests(spark):
    rows = spark.createDataFrame(REQUESTS, "method STRING, endpoint STRING, status INT, latency_ms DOUBLE, s INT")
    return rows.withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_100))


def test_roll_ups(spark, requests):
    assert {tuple(r) for r in service.error_totals(requests).collect()} == {("/predict", 422, 1), ("/predict", 500, 1)}
    assert {tuple(r) for r in service.prediction_requests(requests).collect()} == {("/predict", 2), ("/batch-predict", 1)}
    assert tuple(service.latency_stats(requests).first()) == (4, 0.752, 0.188)
    nothing = requests.where("false")
    assert tuple(service.latency_stats(nothing).first()) == (0, 0.0, 0.0)
    log_rows = spark.createDataFrame([("low", "model"), ("low", "baseline_fallback")], "risk_level STRING, scored_by STRING")
    assert {tuple(r) for r in service.risk_counts(log_rows).collect()} == {("low", 2), ("medium", 0), ("high", 0)}
    total = {(r.section, r.key): r.value for r in service.summary(requests, log_rows).collect()}
    assert total[("totals", "total_predictions")] == 2 and total[("totals", "scoring_errors")] == 1
    assert total[("risk_distribution", "high")] == 0 and total[("http", "errors_total")] == 2
    assert total[("prediction_latency", "count")] == 2


def test_latency_quantiles_interpolate_inside_bounds(spark, requests):
    got = service.latency_quantiles(service.latency_histogram(requests.where("s < 300"), [])).first()
    # Four values: 2, 10, 40 and 700 ms; rank 2 ends the bound that holds 10 ms.
    assert got.n == 4 and got.p50 == pytest.approx(0.01)
    assert got.p95 == pytest.approx(0.5 + 0.25 * 0.8)
    far = requests.where("s = 0").withColumn("latency_ms", F.lit(60_000.0))
    assert service.latency_quantiles(service.latency_histogram(far, [])).first().p50 == 10.0


def test_sliding_rates_agree_with_direct_windows(spark, requests):
    direct = requests.groupBy("endpoint", F.window("ts", "5 minutes", "1 minute").alias("w")).count().select(
        "endpoint", "w.start", "count")
    ours = service.rates(requests, ["endpoint"]).select("endpoint", "window_start", "events")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, direct.collect()))
