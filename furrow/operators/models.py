"""Feature vectors, splits, random forests, scoring and evaluation on MLlib."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions.columns import round2
from furrow.functions.rules import MEASURES, PREDICTED_IRRIGATION
from furrow.operators import bagging
from furrow.operators.bagging import BaggedForest
from furrow.operators.features import MOISTURE_TARGET

# ---- Fixed values: model settings ----
FOREST = {"numTrees": 100, "maxDepth": 10, "seed": 42}
TRAIN_SHARE = 0.8


def assemble(df: DataFrame, features: Sequence[str], invalid: str = "error") -> DataFrame:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid=invalid)
    return assembler.transform(df)


def hashed_split(df: DataFrame, key: str, train_share: float = TRAIN_SHARE, seed: int = 42) -> DataFrame:
    """Add ``split`` from a hash of the key.

    A row lands on the same side on every run and partitioning; ``randomSplit`` depends on how
    the rows are partitioned, so a retried or re-planned job could move rows between the sides.
    """
    limit = f"{math.ceil(train_share * 16**4):04x}"
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("split", F.when(digest.substr(1, 4) < limit, "train").otherwise("test"))


def fit_classifier(
    train: DataFrame, label: str, features: Sequence[str], key: str = "reading_id", **settings: int
) -> BaggedForest:
    return bagging.fit_classifier(train, label, features, key, **FOREST | settings)


def fit_regressor(
    train: DataFrame, label: str, features: Sequence[str], key: str = "reading_id", **settings: int
) -> BaggedForest:
    return bagging.fit_regressor(train, label, features, key, **FOREST | settings)


def classification_metrics(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Accuracy and label-weighted precision, recall and F1, all from one confusion count."""
    cells = scored.groupBy(
        F.col(label).cast("double").alias("truth"), F.col(prediction).alias("guess")
    ).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("bigint")
    hit = F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(none)

    def side(label: str, actual: Column, claimed: Column, hit: Column) -> Column:
        return F.struct(
            F.col(label).alias("label"), actual.alias("actual"), claimed.alias("claimed"), hit.alias("hit")
        )

    sides = F.array(side("truth", F.col("n"), none, hit), side("guess", none, F.col("n"), none))
    per_label = cells.select(F.inline(sides)).groupBy("label").agg(
        *(F.sum(name).alias(name) for name in ("actual", "claimed", "hit"))
    )
    precision = F.coalesce(F.try_divide("hit", "claimed"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hit", "actual"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    weighted = lambda score: F.sum(score * F.col("actual")) / F.sum("actual")
    return per_label.agg(
        (F.sum("hit") / F.sum("actual")).alias("accuracy"),
        weighted(precision).alias("weighted_precision"),
        weighted(recall).alias("weighted_recall"),
        weighted(f1).alias("f1"),
    )


def regression_metrics(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """MAE, RMSE and R2 from one aggregate."""
    error = F.col(label) - F.col(prediction)
    squares = F.avg(error * error)
    return scored.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(squares).alias("rmse"),
        (1 - squares / F.var_pop(label)).alias("r2"),
    )


def feature_importance(spark: SparkSession, model: BaggedForest, features: Sequence[str]) -> DataFrame:
    """One row per feature, most important first."""
    scores = [(name, float(score)) for name, score in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(scores, "feature_name string, importance_score double").orderBy(
        F.desc("importance_score"), "feature_name"
    )


def strongest(df: DataFrame, features: Sequence[str], label: str, k: int) -> DataFrame:
    """The k features that go with the label most: feature_name and the size of their correlation, largest first.

    All correlations come from one aggregate; what is ordered is one row a feature. Features without any
    spread have none and come last; equal ones go by name.
    """
    truth = F.col(label).cast("double")

    def strength(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.abs(F.try_divide(F.covar_pop(value, truth), F.stddev_pop(value) * F.stddev_pop(truth)))

    entries = (F.struct(F.lit(name).alias("feature_name"), strength(name).alias("strength")) for name in features)
    sizes = df.agg(F.array(*entries).alias("sizes")).select(F.inline("sizes"))
    known = F.round(F.nanvl("strength", F.lit(None).cast("double")), 9)
    return sizes.withColumn("strength", known).orderBy(F.desc_nulls_last("strength"), "feature_name").limit(k)


def save_model(model: BaggedForest, path: str) -> None:
    model.save(path)


def moisture_predictions(scored: DataFrame) -> DataFrame:
    """The published forecast table."""
    return scored.select(
        "farm_id", "reading_hour", *MEASURES, MOISTURE_TARGET,
        round2(F.col("prediction")).alias("predicted_next_hour_soil_moisture"),
        PREDICTED_IRRIGATION.named(),
    )


def training_summary(split: DataFrame, metrics: DataFrame, facts: Mapping[str, str | int]) -> DataFrame:
    """One row: record counts per side, fixed facts about the model, and its metrics."""
    counts = split.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("split") == "train").alias("train_records"),
        F.count_if(F.col("split") == "test").alias("test_records"),
    )
    described = counts.select("*", *(F.lit(value).alias(name) for name, value in facts.items()))
    measured = metrics.select(F.struct(*metrics.columns).alias("_m"))
    return described.withColumn("_m", measured.scalar()).select("*", "_m.*").drop("_m")
