"""Wall time of the headline queries; prints one JSON line, and each query's time on the standard error as it ends."""

import json
import os
import sys
import threading
import time

from dispatchlens import session
from dispatchlens.plans.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
#: Seconds for one query, and for all; a query that runs out of them is cancelled and the others still count.
LIMIT, WHOLE = 120, 1_500
HEADLINE = ("order_features", "item_measures", "item_values", "payment_profile", "delivery_windows",
            "label_balance", "temporal_cut", "numeric_medians", "baseline_predictions", "risk_distribution",
            "window_metrics", "psi_by_metric", "retrain_decision", "feature_importance", "quarantined_records",
            "reconciled_runs", "deploy_snapshot", "service_summary", "endpoint_rates", "latency_quantiles",
            "stream_rates", "stream_scoring")
#: Tables that several queries share are made before, and timed apart.
SHARED = {"shared_features": "label_balance", "shared_records": "violation_counts", "shared_runs": "recent_runs"}


def timed(spark, name: str, limit: float) -> float | None:
    """Seconds of a query, None if it was cancelled or failed."""
    alarm = threading.Timer(limit, spark.sparkContext.cancelAllJobs)
    alarm.start()
    start = time.perf_counter()
    try:
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)
    except Exception as problem:  # the next query is measured all the same
        print(f"{name}: {type(problem).__name__} {str(problem)[:300]}", file=sys.stderr, flush=True)
        return None
    finally:
        alarm.cancel()


def main():
    spark = session.session("bench", **{
        "spark.master": f"local[{CPUS}]", "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    begun, seconds, shared, failed = time.perf_counter(), {}, {}, []
    spark.range(1_000_000).selectExpr("sum(id)").collect()
    for key, name in [*SHARED.items(), *zip(HEADLINE, HEADLINE, strict=True)]:
        left = WHOLE - (time.perf_counter() - begun)
        took = timed(spark, name, min(LIMIT, left)) if left > 0 else None
        print(f"{key}: {took}", file=sys.stderr, flush=True)
        if key in SHARED:
            shared[key] = took
        elif took is None:
            failed.append(key)
        else:
            seconds[key] = took
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "shared": shared, "failed": failed, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}), flush=True)
    session.clear(spark)
    spark.stop()


if __name__ == "__main__":
    main()
