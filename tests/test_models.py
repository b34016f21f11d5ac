"""Preparation stages and the three candidates."""

import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from dispatchlens import policy
from dispatchlens.operators import prep, scoring, training
from dispatchlens.operators.evaluation import evaluate


@pytest.fixture(scope="module")
def table(spark):
    """Rows with a planted signal: short windows are late; other features are constant or noise."""
    noise = {c: F.lit(1.0) for c in policy.NUMERIC}
    cats = {c: F.when(F.col("id") % 40 == 0, "rare").when(F.col("id") % 2 == 0, "a").otherwise("b's")
            for c in policy.CATEGORICAL}
    df = spark.range(800).withColumn("r", F.rand(7)).withColumns(noise | cats)
    df = df.withColumns({"shipping_window_days": (F.col("r") * 10).cast("int"), "is_multi_category": F.col("id") % 3 == 0,
                         "price_std": F.when(F.col("id") % 5 > 0, F.col("id") * 1.0)})
    late = (F.col("shipping_window_days") + F.rand(8) * 3 < 4).cast("int")
    return df.withColumn(policy.LABEL, late).withColumnRenamed("id", policy.ORDER_ID).drop("r")


def test_medians_weights_and_folding(spark, table):
    fitted = prep.fit(table)
    assert fitted.medians["price_std"] == 400.0 and fitted.medians["is_multi_category"] == 0.0
    assert fitted.folding.mapping().collect() == []
    rare = prep.category_folding(table, 30).mapping().collect()
    assert sorted(tuple(r) for r in rare) == sorted((c, "rare", prep.RARE) for c in policy.CATEGORICAL)
    mean, std = fitted.scales["shipping_window_days"]
    r = table.agg(F.avg("shipping_window_days"), F.stddev_pop("shipping_window_days")).first()
    assert (mean, std) == (pytest.approx(r[0]), pytest.approx(r[1]))
    weights = {r[policy.LABEL]: r for r in prep.class_weights(table).collect()}
    assert sum(r["rows"] * r.weight for r in weights.values()) == pytest.approx(800)
    assert weights[0]["rows"] * weights[0].weight == pytest.approx(400)


def test_unseen_categories_encode_as_zeros_and_rare_ones_share_a_column(spark, table):
    fitted = prep.Fitted(prep.medians(table), {}, prep.category_folding(table, 30))
    model = prep.preparation(fitted).fit(table)
    cat = policy.CATEGORICAL[0]
    probe = table.limit(1).withColumn(cat, F.explode(F.lit(["a", "b's", "rare", "never seen"])))
    got = {r[cat]: r[f"hot_{cat}"].toArray().tolist() for r in model.transform(probe).collect()}
    assert got["never seen"] == [0.0, 0.0, 0.0]
    assert sorted(got[v].index(1.0) for v in ("a", "b's", "rare")) == [0, 1, 2]


def test_nulls_become_medians_and_numbers_are_standardised(spark, table):
    fitted = prep.fit(table)
    out = prep.preparation(fitted, standardise=True).fit(table).transform(table)
    row = out.agg(F.avg("num_price_std"), F.stddev_pop("num_price_std"), F.count("num_price_std"),
                  F.max("num_price_sum")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1) and row[2] == 800
    assert row[3] == 0.0  # a constant column is centred, not divided by zero


def test_column_without_values_is_left_out(spark, table):
    assert "price_mean" not in prep.medians(table.withColumn("price_mean", F.lit(None).cast("double")))


def test_twenty_thousand_categories_are_folded_by_a_join(spark, table, tmp_path):
    """No list of categories in the plan, and the stored stage folds as the fitted one does."""
    cat = policy.CATEGORICAL[1]
    wide = table.select(*[c for c in table.columns if c != cat], F.explode(F.sequence(F.lit(0), F.lit(49))).alias("n"))
    wide = wide.withColumn(cat, F.when(F.col("n") < 25, F.concat(F.lit("own "), F.col("order_id") * 25 + F.col("n"))).otherwise("common")).drop("n")
    folding = prep.category_folding(wide)
    assert folding.mapping().where(F.col("feature") == cat).count() == 20_000
    folding.write().overwrite().save(str(tmp_path / "stage"))
    for stage in (folding, prep.CategoryFolding.load(str(tmp_path / "stage"))):
        out = stage.transform(wide.union(wide.limit(1).withColumn(cat, F.lit("never seen"))))
        assert "own 7" not in out._jdf.queryExecution().executedPlan().toString()
        got = {r[0]: r[1] for r in out.groupBy(f"cat_{cat}").count().collect()}
        assert got == {prep.RARE: 20_000, "common": 20_000, "never seen": 1} and out.columns == [*wide.columns, *[f"cat_{c}" for c in policy.CATEGORICAL]]


SMALL = {"logistic_regression": lambda n: training.logistic_regression(n).setMaxIter(30),
         "random_forest": lambda n: training.random_forest(n).setNumTrees(5).setMaxDepth(5),
         "hist_gradient_boosting": lambda n: training.gradient_boosting(n).setMaxIter(5).setMaxBins(32)}


def test_candidates_find_the_signal_and_survive_storage(spark, table, tmp_path):
    train, valid = table.where("order_id < 600"), table.where("order_id >= 600")
    result = training.train_candidates(train, valid, builders=SMALL)
    rows = {r.candidate: r for r in result.board.collect()}
    assert set(rows) == set(training.CANDIDATES) and all(r.roc_auc > 0.85 for r in rows.values())
    assert rows[result.winner].pr_auc == max(r.pr_auc for r in rows.values())
    path = str(tmp_path / "model")
    result.best.write().overwrite().save(path)
    features = valid.select(policy.ORDER_ID, *policy.FEATURES)
    before = scoring.model_probability(result.best, features)
    after = scoring.model_probability(PipelineModel.load(path), features)
    a = {r.order_id: r[scoring.SCORE] for r in before.collect()}
    b = {r.order_id: r[scoring.SCORE] for r in after.collect()}
    assert a == b and all(0 <= p <= 1 and not math.isnan(p) for p in a.values())
    assert set(scoring.score(features, result.best, "model").select("scored_by").distinct().first()) == {"model"}


def test_settings_of_the_candidates(spark):
    lr, rf, gbt = (training.BUILDERS[n](500) for n in training.CANDIDATES)
    assert (lr.getMaxIter(), lr.getRegParam(), lr.getStandardization()) == (1000, 1 / 500, False)
    assert (rf.getNumTrees(), rf.getMinInstancesPerNode(), rf.getMaxDepth()) == (300, 20, 30)
    assert (gbt.getMaxIter(), gbt.getStepSize()) == (400, 0.06)


def test_penalty_matches_summed_loss(spark):
    """regParam 1/n on the mean loss is unit penalty on the summed loss: check the gradient is zero."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(float(x), float(x > 1 or x == -2)) for x in (-3, -2, -1, 0, 1, 2, 3)], "x DOUBLE, y DOUBLE")
    df = VectorAssembler(inputCols=["x"], outputCol="f").transform(df)
    m = LogisticRegression(featuresCol="f", labelCol="y", regParam=1 / 7, standardization=False, maxIter=1000,
                           tol=1e-12).fit(df)
    w, b = m.coefficients[0], m.intercept
    gradient = sum((1 / (1 + math.exp(-(w * r.x + b))) - r.y) * r.x for r in df.collect()) + w
    assert gradient == pytest.approx(0, abs=1e-5)


def test_fitted_scores_evaluate(spark, table):
    model = training.fit_candidates(table, ["logistic_regression"], SMALL)["logistic_regression"]
    metrics = evaluate(scoring.model_probability(model, table)).first()
    assert metrics["rows"] == 800 and 0 < metrics.brier < 0.25


class _Watched:
    """A classifier that notes the plan of the rows it is given."""

    def __init__(self, classifier, plans):
        self.classifier, self.plans = classifier, plans

    def fit(self, rows):
        self.plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return self.classifier.fit(rows)


def test_candidates_are_fitted_on_checkpointed_rows(spark, table):
    """No task of a round carries the joins and expressions of the preparation."""
    plans = []
    watched = {n: lambda rows, n=n: _Watched(SMALL[n](rows), plans) for n in ("random_forest", "hist_gradient_boosting")}
    models = training.fit_candidates(table, list(watched), watched)
    assert list(models) == list(watched) and len(plans) == 2
    assert all(p.startswith("LogicalRDD") for p in plans)
    assert all(evaluate(scoring.model_probability(m, table)).first()["roc_auc"] > 0.85 for m in models.values())
