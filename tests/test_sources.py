"""Raw CSV load, layers, and the batch steps over them."""

import json

import pytest
from pyspark.sql import functions as F

from dispatchlens import __main__ as cli, policy, schemas
from dispatchlens.operators import drift
from dispatchlens.plans import pipeline
from dispatchlens.sources import adapter, tables
from dispatchlens.sources.layers import Layers, bucketed, write_csv


def write_all(folder, **text):
    for name, table in tables.REGISTRY.items():
        header = ",".join(table.schema.names)
        (folder / table.filename).write_text(text.get(name, header + "\n"), encoding="utf-8")


ORDERS = ("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
          "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
          "a,c,delivered,2018-02-26 10:00:00,2018-02-26 13:00:00,,2018-03-01 00:00:00,2018-03-06 00:00:00\n"
          "b,c,shipped,2018-02-26 10:00:00,,,,2018-03-06 00:00:00\n")


def test_typed_load_is_repeatable(spark, tmp_path):
    write_all(tmp_path, orders=ORDERS, product_category_name_translation="﻿product_category_name,"
              "product_category_name_english\ncama_mesa_banho,bed_bath_table\n")
    layers = Layers(spark, str(tmp_path / "store"))
    for _ in range(2):
        counts = tables.load_raw(layers, str(tmp_path))
    assert counts["orders"] == 2 and counts["product_category_name_translation"] == 1 and len(counts) == 8
    loaded = layers.read("raw", "orders")
    assert loaded.schema["order_approved_at"].dataType.simpleString() == "timestamp_ntz"
    assert loaded.where("order_approved_at IS NULL").select("order_id").first()[0] == "b"
    first = layers.read("raw", "product_category_name_translation").first()
    assert first.product_category_name == "cama_mesa_banho"


def test_unknown_and_missing_tables_change_nothing(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "store"))
    write_all(tmp_path)
    assert tables.load_raw(layers, str(tmp_path), ["orders"]) == {"orders": 0}
    with pytest.raises(ValueError, match="nonsense"):
        tables.load_raw(layers, str(tmp_path), ["orders", "nonsense"], clear=True)
    with pytest.raises(FileNotFoundError, match="olist_orders"):
        tables.load_raw(layers, str(tmp_path / "elsewhere"), clear=True)
    assert layers.tables("raw") == ["orders"]


def test_clear_drops_only_its_layer(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    for layer in ("raw", "features"):
        layers.replace(layer, "old", spark.range(3))
    assert layers.clear("raw") == 1
    assert layers.tables("raw") == [] and layers.tables("features") == ["old"]
    with pytest.raises(ValueError):
        layers.clear("other")


def test_replace_append_and_ordered_limit(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    for _ in range(2):
        layers.replace("features", "t", spark.range(100).repartition(4))
        layers.append("monitoring", "m", spark.range(2))
    assert layers.read("features", "t").count() == 100
    assert layers.read("monitoring", "m").count() == 4
    assert [r.id for r in layers.read("features", "t", ["id"], 3, "id").collect()] == [0, 1, 2]


def test_csv_round_trip_keeps_quotes_breaks_and_nulls(spark, tmp_path):
    rows = [("r1", "o1", 5, 'a "quoted", title', "two\nlines", None, None), ("r2", "o2", 1, None, None, None, None)]
    write_csv(spark.createDataFrame(rows, schemas.ORDER_REVIEWS), f"{tmp_path}/olist_order_reviews_dataset.csv")
    back = tables.read_csv(spark, tables.REGISTRY["order_reviews"], str(tmp_path), multi_line=True)
    assert sorted(map(tuple, back.collect())) == rows


def test_bad_csv_value_fails_the_load(spark, tmp_path):
    write_all(tmp_path, sellers="seller_id,seller_zip_code_prefix,seller_city,seller_state\ns,notanumber,x,SP\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.load_raw(Layers(spark, str(tmp_path / "store")), str(tmp_path), ["sellers"])


def test_bucketed_tables_join_without_exchange(spark):
    for name in ("bucketed_items", "bucketed_orders"):
        bucketed(spark.range(1000).select((F.col("id") % 100).alias("order_id")), name, "order_id", 4)
    items, orders = spark.table("bucketed_items"), spark.table("bucketed_orders")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = items.groupBy("order_id").count().join(orders, "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_command_line_runs_the_whole_pipeline(spark, sf_dir, tmp_path, capsys, monkeypatch):
    data, root = f"{tmp_path}/data", f"{tmp_path}/root"
    for name, build in adapter.RAW.items():
        write_csv(build(spark, sf_dir), f"{data}/{tables.REGISTRY[name].filename}")
    monkeypatch.setattr(pipeline.training, "CANDIDATES", ("logistic_regression",))

    def step(*argv):
        cli.run(spark, cli.parser().parse_args([*argv]))
        return capsys.readouterr().out

    counts = json.loads(step("load-raw", "--root", root, "--data-dir", data))
    assert counts["orders"] == spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    step("features", "--root", root, "--csv", f"{tmp_path}/snapshot")
    step("score", "--root", root)
    layers = Layers(spark, root)
    table = layers.read("predictions", "predictions")
    assert {r[0] for r in table.select("model_version").distinct().collect()} == {policy.BASELINE_VERSION}
    assert step("monitor", "--root", root, "--report", f"{tmp_path}/report").strip().endswith("true")

    small = {"logistic_regression": lambda rows: pipeline.training.logistic_regression(rows).setMaxIter(20)}
    result = pipeline.train(layers, names=["logistic_regression"], builders=small)
    assert result.winner == "logistic_regression"
    step("score", "--root", root, "--limit", "10")
    scored = layers.read("predictions", "predictions")
    assert scored.count() == 10 and scored.first().model_version == "late-delivery:current"
    assert scored.where("late_delivery_probability NOT BETWEEN 0 AND 1").count() == 0
    step("monitor", "--root", root)
    assert layers.read("monitoring", "monitoring_metrics").count() == 2 * len(drift.METRICS)
    run = layers.read("monitoring", "training_runs").first()
    assert run.candidate == "logistic_regression" and run.n_train > run.n_valid > 0
    report = spark.read.json(f"{tmp_path}/report").first()
    assert report.decision.reasons == ["auc<min"] and report.thresholds.psi == 0.2
    snapshot = spark.read.option("header", True).csv(f"{tmp_path}/snapshot")
    assert snapshot.columns == [*policy.FEATURES, policy.ORDER_ID, policy.LABEL, policy.PURCHASE_TS]
