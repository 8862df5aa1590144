"""The layered flow: landing files -> raw -> trusted + quarantine -> marts, features, models.

Layers meet only in catalog tables, so every step can be run and repeated alone.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions import rules
from furrow.operators import dedup, enrich, features, marts, models, ordinal, quality, series
from furrow.operators.clean import clean_readings, with_time_parts
from furrow.sources import files, shared, tables

MARTS = {
    "farm_daily_metrics": marts.farm_daily_metrics,
    "sensor_health": marts.sensor_health,
    "irrigation_alerts": marts.irrigation_alerts,
    "crop_conditions": marts.crop_conditions,
    "environment_trend": marts.environment_trend,
}


@dataclass(frozen=True)
class Lake:
    """Schemas of the layers; all tables live below ``location``, which is kept, unlike staging folders."""

    spark: SparkSession
    location: str
    prefix: str = "furrow"

    def schema(self, layer: str) -> str:
        return tables.ensure_schema(self.spark, f"{self.prefix}_{layer}", f"{self.location}/{layer}")

    def name(self, layer: str, table: str) -> str:
        return f"{self.schema(layer)}.{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))


def ingest(lake: Lake, sources: Mapping[str, str], schemas: Mapping[str, str] | None = None) -> None:
    """Load landing files into raw tables: entity -> CSV path, optionally entity -> schema."""
    for entity, path in sources.items():
        scanned = files.scan_csv(lake.spark, path, (schemas or {}).get(entity))
        tables.replace_table(files.with_audit(scanned), lake.name("bronze", entity))


def ingest_new(lake: Lake, entity: str, path: str, schema: str | None = None) -> int:
    """Append the landing files that the raw table does not hold yet, and read no others; returns how many.

    A file is known by its name, so files must not be changed in place. The first load makes the table.
    A later load reads by the table's own columns unless a schema is given, and may leave columns out.
    """
    spark, table = lake.spark, lake.name("bronze", entity)
    if not spark.catalog.tableExists(table):
        ingest(lake, {entity: path}, {entity: schema} if schema else None)
        return len(files.scan_csv(spark, path, lake.read("bronze", entity).schema).inputFiles())
    stored = spark.table(table)
    audit = [name for name in stored.columns if name in files.AUDIT]
    kind = schema or stored.drop(*audit).schema
    fresh = files.not_landed(files.scan_csv(spark, path, kind), stored)
    if fresh:
        rows = files.with_audit(files.scan_csv(spark, fresh, kind))
        stored.limit(0).unionByName(rows, allowMissingColumns=True).write.insertInto(table)
    return len(fresh)


def trusted_rows(validated: DataFrame, ingested: str = "_ingestion_timestamp") -> DataFrame:
    """Valid rows, the latest of each sensor, farm and time."""
    return dedup.latest_reading(quality.valid_rows(validated), ingested=ingested)


def refine(lake: Lake) -> DataFrame:
    """Raw readings to the trusted table and the quarantine; returns the counts of both sides in one row.

    The raw table is scanned and checked once. The checked rows go to one table with a folder for each side,
    and the counts are observed while they are written. The quarantine is the folder of the invalid rows under a
    name of its own, without another copy; the trusted table is made from the folder of the valid ones.

    Both are rebuilt, so that a corrected registry also takes rows out of the quarantine. Feeds that
    only ever add rows can use ``tables.append_new`` instead.
    """
    spark = lake.spark
    cleaned = clean_readings(lake.read("bronze", "sensor_readings"))
    sided = quality.sided(quality.validate(cleaned, lake.read("bronze", "sensor_master")))
    name = lake.name("silver", "checked_sensor")
    checked, counts = tables.replace_table_measured(sided, name, quality.summary_columns(), [quality.SIDE])
    own = [c for c in checked.columns if c not in (quality.SIDE, *quality.STAMPS)]
    valid = checked.where(F.col(quality.SIDE) == quality.VALID).select(*own)
    tables.replace_table(
        trusted_rows(valid).withColumn("reading_date", F.to_date("timestamp")), lake.name("silver", "valid_sensor"),
        ["reading_date"],
    )
    schema = checked.drop(quality.SIDE).schema
    folder = f"{tables.location(spark, name)}/{quality.SIDE}={quality.INVALID}"
    if counts["invalid_records"]:
        tables.register_folder(spark, lake.name("silver", "invalid_sensor"), folder, schema)
    else:  # no folder was written
        tables.replace_table(spark.createDataFrame([], schema), lake.name("silver", "invalid_sensor"))
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} long" for name in counts))


def describe_readings(readings: DataFrame, farms: DataFrame) -> DataFrame:
    """Trusted readings with statuses, trends, daily statistics and farm columns."""
    timed = with_time_parts(readings)
    stated = timed.withColumns({ladder.name: ladder.column() for ladder in rules.READING_STATUSES})
    cut = series.fitting_cut(readings, ["sensor_id"])
    trend = series.temperature_trend(stated, ["sensor_id"], cut=cut)
    daily = series.daily_temperature(trend, "sensor_id")
    return enrich.enrich(daily, farms, "farm_id").withColumn(
        "_silver_processed_timestamp", F.current_timestamp()
    )


def publish_marts(lake: Lake) -> DataFrame:
    """Write the five marts and return their census."""
    readings = lake.read("silver", "valid_sensor")
    for name, mart in MARTS.items():
        options = {}
        if name == "environment_trend":
            options["cut"] = series.fitting_cut(readings, ["farm_id", "sensor_id"])
        tables.replace_table(mart(readings, **options), lake.name("gold", name))
    return tables.census(lake.spark, [lake.name("gold", name) for name in MARTS])


def publish_features(lake: Lake) -> DataFrame:
    readings = lake.read("silver", "valid_sensor")
    built = features.irrigation_features(readings, series.fitting_cut(readings, ["sensor_id"]))
    return tables.replace_table(built, lake.name("features", "irrigation_features"))


def train_irrigation(lake: Lake, model_path: str, **settings: int) -> DataFrame:
    """Fit, save and summarise the irrigation classifier.

    Importances, label distribution and missing values of the features go to tables of their own.
    """
    table = lake.read("features", "irrigation_features")
    split = models.hashed_split(table, "reading_id")
    vectors = models.assemble(split, features.IRRIGATION_FEATURES)
    target = features.IRRIGATION_TARGET
    model = models.fit_classifier(
        vectors.filter("split = 'train'"), target, features.IRRIGATION_FEATURES, **settings
    )
    models.save_model(model, model_path)
    scored = model.transform(vectors.filter("split = 'test'"))
    reports = {
        "irrigation_importance": models.feature_importance(lake.spark, model, features.IRRIGATION_FEATURES),
        "irrigation_label_distribution": quality.value_counts(table, target),
        "irrigation_null_profile": quality.null_profile(table),
    }
    for name, report in reports.items():
        tables.replace_table(report, lake.name("gold", name))
    return models.training_summary(split, models.classification_metrics(scored, target), {
        "algorithm": model.algorithm,
        "feature_count": len(features.IRRIGATION_FEATURES),
        "tree_count": model.getNumTrees,
        "draw_count": len(model.members),
        "model_path": model_path,
    })


def forecast_moisture(lake: Lake, **settings: int) -> DataFrame:
    """Fit the soil moisture regressor on the earlier readings and publish the later forecasts.

    Its record counts and errors go to the table ``moisture_training_summary``.
    """
    readings = lake.read("silver", "valid_sensor")
    built = features.next_moisture_features(readings, series.fitting_cut(readings, ["farm_id"]))
    dataset = tables.replace_table(
        features.next_moisture_dataset(built), lake.name("features", "moisture_features")
    )
    split = ordinal.chronological_split(dataset, shared.fresh_path(lake.spark, "border"))
    vectors = models.assemble(split, features.MOISTURE_FEATURES, invalid="skip")
    model = models.fit_regressor(
        vectors.filter("split = 'train'"), features.MOISTURE_TARGET, features.MOISTURE_FEATURES, **settings
    )
    scored = model.transform(vectors.filter("split = 'test'"))
    errors = models.regression_metrics(scored, features.MOISTURE_TARGET)
    tables.replace_table(models.training_summary(split, errors, {
        "algorithm": model.algorithm,
        "feature_count": len(features.MOISTURE_FEATURES),
        "tree_count": model.getNumTrees,
        "draw_count": len(model.members),
    }), lake.name("gold", "moisture_training_summary"))
    return tables.replace_table(
        models.moisture_predictions(scored), lake.name("gold", "future_soil_moisture_predictions")
    )
