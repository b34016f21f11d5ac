"""Command line: one sub-command per batch step.

    python -m dispatchlens load-raw --root R --data-dir D [--tables t ...] [--clear]
    python -m dispatchlens features --root R [--csv PATH]
    python -m dispatchlens train --root R [--split-quantile Q | --split-date T] [--candidates c ...]
    python -m dispatchlens score --root R [--limit N]
    python -m dispatchlens monitor --root R [--report PATH]
    python -m dispatchlens deploy-status --runs PATH --outcomes PATH [--history N]
"""

import argparse
import json

from dispatchlens import policy, schemas, session
from dispatchlens.operators import opslog, order_features, scoring, training
from dispatchlens.plans import pipeline
from dispatchlens.sources import jsonl, tables
from dispatchlens.sources.layers import Layers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dispatchlens")
    steps = top.add_subparsers(dest="step", required=True)

    def step(name, *arguments):
        sub = steps.add_parser(name)
        for flags, options in arguments:
            sub.add_argument(*flags, **options)

    root = (("--root",), {"required": True})
    quantile = (("--split-quantile",), {"type": float, "default": policy.SPLIT_QUANTILE})
    date = (("--split-date",), {"default": None})
    approximate = (("--approximate",), {"action": "store_true"})
    step("load-raw", root, (("--data-dir",), {"required": True}), (("--tables",), {"nargs": "*", "default": None}),
         (("--clear",), {"action": "store_true"}))
    step("features", root, (("--csv",), {"default": None}))
    step("train", root, quantile, date, approximate,
         (("--candidates",), {"nargs": "*", "default": None, "choices": list(training.BUILDERS)}))
    step("score", root, (("--limit",), {"type": int, "default": None}))
    step("monitor", root, quantile, date, approximate, (("--report",), {"default": None}))
    step("deploy-status", (("--runs",), {"required": True}), (("--outcomes",), {"required": True}),
         (("--history",), {"type": int, "default": policy.HISTORY_LIMIT}))
    return top


def run(spark, args) -> None:
    layers = Layers(spark, args.root) if "root" in args else None
    if args.step == "load-raw":
        print(json.dumps(tables.load_raw(layers, args.data_dir, args.tables, args.clear)))
    elif args.step == "features":
        order_features.label_balance(pipeline.build_features(layers, args.csv)).show()
    elif args.step == "train":
        result = pipeline.train(layers, args.split_quantile, args.split_date, tuple(args.candidates or training.CANDIDATES),
                                approximate=args.approximate)
        result.board.show(truncate=False)
        print(f"winner: {result.winner}")
    elif args.step == "score":
        table = pipeline.score(layers, args.limit)
        scores = table.withColumnRenamed("late_delivery_probability", scoring.SCORE)
        scoring.score_overview(scores).show()
    elif args.step == "monitor":
        decided = pipeline.monitor(layers, args.report, args.split_quantile, args.split_date, args.approximate)
        print(str(pipeline.retrain_recommended(decided)).lower())
    else:
        runs = jsonl.read_log(spark, args.runs, schemas.DEPLOY_RUN)
        outcomes = jsonl.read_log(spark, args.outcomes, schemas.RETRAIN_OUTCOME)
        opslog.snapshot(runs, outcomes, args.history).show(truncate=False, vertical=True)
        opslog.recent_runs(runs, args.history).drop(jsonl.SEQUENCE).show(truncate=False)


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    spark = session.session("dispatchlens")
    try:
        run(spark, args)
    finally:
        session.clear(spark)


if __name__ == "__main__":
    main()
