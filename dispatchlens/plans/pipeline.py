"""The batch steps end to end: load, features, train, score, monitor."""

import os

from pyspark.sql import DataFrame, functions as F

from dispatchlens import policy, session
from dispatchlens.operators import contract, drift, order_features, scoring, split, training
from dispatchlens.sources import files
from dispatchlens.sources.layers import Layers, write_csv, write_report

FEATURE_TABLE = "featureset_v1"
RAW_INPUTS = {"orders": "orders", "items": "order_items", "products": "products", "sellers": "sellers",
              "payments": "order_payments"}


def model_path(layers: Layers) -> str:
    return f"{layers.root}/models/current"


def stored_model(layers: Layers):
    """The stored model and its version name; the baseline formula when none is stored."""
    path = model_path(layers)
    model = scoring.load_model(path) if files.exists(layers.spark, path) else None
    return model, "late-delivery:current" if model else policy.BASELINE_VERSION


def build_features(layers: Layers, csv_path: str | None = None) -> DataFrame:
    """Rebuild the feature table from the raw layer, check its contract, optionally snapshot it."""
    raw = {key: layers.read("raw", name) for key, name in RAW_INPUTS.items()}
    table = contract.check_feature_columns(order_features.order_features(**raw))
    table = layers.replace("features", FEATURE_TABLE, table)
    if csv_path:
        write_csv(table, csv_path)
    return table


def train(layers: Layers, quantile: float = policy.SPLIT_QUANTILE, split_date: str | None = None,
          names=training.CANDIDATES, builders=None, approximate: bool = False) -> training.Training:
    """Fit and compare the candidates, store the winner and append the run to the monitoring layer."""
    table = layers.read("features", FEATURE_TABLE)
    cut = split.temporal_cut(table, quantile, split_date, approximate)
    past, newest = split.temporal_split(table, cut)
    result = training.train_candidates(past, newest, names, builders, approximate)
    result.best.write().overwrite().save(model_path(layers))
    layers.append("monitoring", "training_runs",
                  training.run_rows(result.board, past.count(), newest.count(), cut))
    return result


def score(layers: Layers, limit: int | None = None) -> DataFrame:
    """Rebuild the prediction table from the feature table."""
    model, version = stored_model(layers)
    table = layers.read("features", FEATURE_TABLE, [policy.ORDER_ID, *policy.FEATURES], limit, policy.ORDER_ID)
    return layers.replace("predictions", "predictions",
                          scoring.predictions(scoring.score(table, model), version))


def monitor(layers: Layers, report_path: str | None = None, quantile: float = policy.SPLIT_QUANTILE,
            split_date: str | None = None, approximate: bool = False) -> DataFrame:
    """Compare the newest window with the past, append the metrics, return the decided row."""
    model, version = stored_model(layers)
    table = layers.read("features", FEATURE_TABLE)
    cut = split.temporal_cut(table, quantile, split_date, approximate)
    scored = split.with_window(scoring.score(table, model), cut).select(
        "window", policy.LABEL, scoring.SCORE, *policy.DRIFT_FEATURES)
    # Scored once; edges, histograms, AUC and rates read the written scores.
    path = session.run_path(layers.spark, f"monitor-{os.urandom(6).hex()}")
    scored.write.parquet(path)
    row = drift.decide(drift.monitor_row(layers.spark.read.parquet(path), approximate))
    decided = layers.spark.createDataFrame(row.collect(), row.schema)
    layers.append("monitoring", "monitoring_metrics", drift.tall_metrics(decided))
    if report_path:
        write_report(drift.report(decided, version, cut), report_path)
    return decided


def retrain_recommended(decided: DataFrame) -> bool:
    return decided.select(F.col("retrain_recommended")).first()[0]
