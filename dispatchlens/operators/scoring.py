"""Late-delivery scores, risk bands and the prediction table."""

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dispatchlens import policy
from dispatchlens.functions import expressions as X
from dispatchlens.sources import files

SCORE = "probability_late"
SCORED_BY = "scored_by"


def baseline_probability() -> Column:
    """Fixed formula used when no model is at hand."""
    b = policy.BASELINE
    raw = (F.lit(b["base"]) + b["per_day"] * F.col("estimated_delivery_days")
           + b["per_freight"] * F.col("freight_sum")
           + b["evening"] * (F.col("purchase_hour") >= b["evening_from"]).cast("int"))
    return F.least(F.greatest(raw, F.lit(b["low"])), F.lit(b["high"]))


def with_baseline(features: DataFrame) -> DataFrame:
    return features.withColumns({SCORE: baseline_probability(), SCORED_BY: F.lit("baseline")})


def model_probability(model: PipelineModel, features: DataFrame, name: str = SCORE) -> DataFrame:
    """The input with P(late) in [0, 1] from a fitted pipeline, without the pipeline's own columns; null where it gives none."""
    scored = model.transform(features)
    probability = vector_to_array("probability")[1]
    # NaN is greater than 1 to Spark, so clipping alone would make it a certain delay
    return scored.select(*features.columns, F.when(~F.isnan(probability), X.clip_unit(probability)).alias(name))


def with_fallback(scored: DataFrame, model_column: str, source: str) -> DataFrame:
    """The model's score where it gave one, else the baseline; records which one it was."""
    p = F.col(model_column)
    usable = p.isNotNull() & ~F.isnan(p)
    return scored.withColumns({
        SCORE: F.when(usable, X.clip_unit(p)).otherwise(baseline_probability()),
        SCORED_BY: F.when(usable, source).otherwise("baseline_fallback")})


def score(features: DataFrame, model: PipelineModel | None, source: str = "model") -> DataFrame:
    """Score by the model if there is one, else by the baseline formula."""
    if model is None:
        return with_baseline(features)
    return with_fallback(model_probability(model, features, "model_p"), "model_p", source).drop("model_p")


def load_model(path: str | None) -> PipelineModel | None:
    """The stored pipeline, or None when none is stored there; one that can't be read raises."""
    if path is None or not files.exists(SparkSession.active(), f"{path}/metadata"):
        return None
    return PipelineModel.load(path)


def risk_level(p: Column, high: float = policy.HIGH_RISK, medium: float = policy.MEDIUM_RISK) -> Column:
    return F.when(p >= high, "high").when(p >= medium, "medium").otherwise("low")


def recommended_action(level: Column) -> Column:
    actions = F.create_map(*[F.lit(x) for pair in policy.ACTIONS.items() for x in pair])
    return actions[level]


def predictions(scored: DataFrame, version: str = policy.BASELINE_VERSION, places: int = 6,
                high: float = policy.HIGH_RISK, medium: float = policy.MEDIUM_RISK) -> DataFrame:
    """The prediction table: bands come from the unrounded score."""
    level = risk_level(F.col(SCORE), high, medium)
    return scored.select(
        policy.ORDER_ID, X.round_half_even(F.col(SCORE), places).alias("late_delivery_probability"),
        level.alias("risk_level"), recommended_action(level).alias("recommended_action"),
        F.lit(version).alias("model_version"), F.current_timestamp().alias("scored_at"))


def risk_distribution(scored: DataFrame) -> DataFrame:
    """Rows and mean score per band, absent bands with zero rows."""
    spark = scored.sparkSession
    levels = spark.createDataFrame([(level,) for level in policy.RISK_LEVELS], "risk_level STRING")
    counts = scored.groupBy(risk_level(F.col(SCORE)).alias("risk_level")).agg(
        F.count("*").alias("orders"), F.avg(SCORE).alias("mean_score"))
    return levels.join(counts, "risk_level", "left").select(
        "risk_level", F.coalesce("orders", F.lit(0)).alias("orders"), "mean_score")


def score_overview(scored: DataFrame) -> DataFrame:
    """One row: orders scored, their mean score (null without any), and how many are in each band."""
    level = risk_level(F.col(SCORE))
    return scored.agg(F.count("*").alias("orders"), F.avg(SCORE).alias("mean_score"),
                      *[F.count_if(level == name).alias(name) for name in policy.RISK_LEVELS])
