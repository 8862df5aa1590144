"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the test tables."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.functions import rules
from furrow.functions.columns import reading_date
from furrow.operators import bagging, clean, dedup, enrich, features, marts, models, ordinal, quality, series
from furrow.operators.bagging import BaggedForest
from furrow.plans import medallion
from furrow.sources import files, sensor_views, shared, tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

KEY = ("reading_id", "sensor_id", "farm_id")
FLAGS = (rules.SENSOR_CHECK.flag, *(check.flag for check in rules.VALUE_CHECKS))


def plain_times(df: DataFrame) -> DataFrame:
    """Times without a zone, which compare alike in every session."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = lambda spark, sf_dir: plain_times(build(spark, str(sf_dir).rstrip("/")))
    return build


# ---- shared inputs -------------------------------------------------------------------------


def checked(spark: SparkSession, sf: str) -> DataFrame:
    return quality.validate(sensor_views.readings(spark, sf), sensor_views.sensor_registry(spark, sf))


def trusted(spark: SparkSession, sf: str) -> DataFrame:
    """The trusted table; written at its first use, as marts and features read a table."""

    def build() -> DataFrame:
        loaded = checked(spark, sf).withColumn("_loaded", F.current_timestamp())
        rows = medallion.trusted_rows(loaded, ingested="_loaded").drop("_loaded")
        return rows.withColumn("reading_date", reading_date())

    return shared.written_once(spark, f"trusted{sf}", build, ["reading_date"])


_building = threading.RLock()
_cuts: dict[tuple[str, str, tuple[str, ...]], series.Cut | None] = {}


def cut(spark: SparkSession, sf: str, *entity: str) -> series.Cut | None:
    """How to cut the trusted table's histories, counted once."""
    key = (spark.sparkContext.applicationId, sf, entity)
    with _building:
        if key not in _cuts:
            _cuts[key] = series.fitting_cut(trusted(spark, sf), entity)
        return _cuts[key]


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """The raw table of text columns; written at its first use, as cleaning reads a table."""
    return shared.written_once(spark, f"raw{sf}", lambda: sensor_views.raw_readings(spark, sf))


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_readings(raw(spark, sf))


def _schema(spark: SparkSession, name: str) -> str:
    path = shared.fresh_path(spark, name)
    return tables.ensure_schema(spark, f"furrow_{path[-12:]}", path)


# ---- sources and sinks ---------------------------------------------------------------------


def _landing(spark: SparkSession, sf: str) -> DataFrame:
    def write(path: str) -> None:
        raw(spark, sf).write.options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)

    path = shared.written_path(spark, f"landing{sf}", write)
    return files.scan_csv(spark, path, sensor_views.RAW_SCHEMA)


@query
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _landing(spark, sf)


@query
def csv_scan_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """Master data with types found by a pass over the file."""

    def write(path: str) -> None:
        sensor_views.table(spark, sf, "customer").select(
            F.col("c_custkey").alias("sensor_id"), F.col("c_name").alias("sensor_name"),
            F.col("c_nationkey").alias("farm_id"),
        ).write.csv(path, header=True)

    path = shared.written_path(spark, f"masters{sf}", write)
    inferred = files.scan_csv(spark, path)
    return inferred.withColumn("sensor_id", F.col("sensor_id").cast("bigint"))


@query
def bronze_audit(spark: SparkSession, sf: str) -> DataFrame:
    audited = files.with_audit(_landing(spark, sf))
    return audited.select(
        "reading_id",
        F.col("_ingestion_timestamp").isNotNull().alias("has_load_time"),
        F.col("_source_file").endswith(".csv").alias("has_source_file"),
    )


@query
def incremental_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Landing files that arrive in two deliveries, each loaded once though the folder is read three times."""
    path = shared.fresh_path(spark, "arriving")
    lake = medallion.Lake(spark, f"{path}-lake", f"furrow_{path[-12:]}")
    keep = dict(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    odd = F.col("reading_id") % 2 == 1
    for delivery in (raw(spark, sf).where(odd), raw(spark, sf).where(~odd)):
        delivery.write.options(**keep).mode("append").csv(path)
        medallion.ingest_new(lake, "sensor_readings", path, sensor_views.RAW_SCHEMA)
    again = medallion.ingest_new(lake, "sensor_readings", path, sensor_views.RAW_SCHEMA)
    return lake.read("bronze", "sensor_readings").drop(*files.AUDIT).withColumn("files_in_last_load", F.lit(again))


@query
def table_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """A full refresh, then one that also changes the schema."""
    table = f"{_schema(spark, 'overwrite')}.readings"
    readings = sensor_views.readings(spark, sf)
    tables.replace_table(readings.select(*KEY, "timestamp"), table)
    return tables.replace_table(readings.select("reading_id", "timestamp", *rules.MEASURES), table)


@query
def table_rewrite_fill(spark: SparkSession, sf: str) -> DataFrame:
    table = f"{_schema(spark, 'rewrite')}.readings"
    tables.replace_table(sensor_views.readings(spark, sf).select(*KEY, *rules.MEASURES), table)
    return tables.rewrite_table(spark, table, lambda df: quality.fill_columns(df, {"temperature": 0.0}))


@query
def quarantine_append(spark: SparkSession, sf: str) -> DataFrame:
    """Stamped rejected rows, delivered again with a further column, and rows missing a field."""
    table = f"{_schema(spark, 'quarantine')}.invalid_sensor"
    rows = checked(spark, sf).select(*rules.REQUIRED_FIELDS, "is_valid", "invalid_reason")
    rejected = quality.invalid_rows(rows)
    identity = rules.QUARANTINE_IDENTITY
    tables.append_new(rejected.drop("is_valid"), table, identity, "timestamp")
    tables.append_new(rejected, table, identity, "timestamp")
    tables.append_new(quality.null_quarantine(rows), table, identity, "timestamp")
    return spark.table(table).drop("quarantine_timestamp", f"timestamp{tables.DAY}")


@query
def quarantine_append_day(spark: SparkSession, sf: str) -> DataFrame:
    """A day that is delivered again, with more rows than before, onto the history of all days."""
    table = f"{_schema(spark, 'feed')}.readings"
    readings = sensor_views.readings(spark, sf).select(*KEY, "timestamp")
    latest = readings.agg(F.max(F.to_date("timestamp"))).scalar()
    today = F.to_date("timestamp") == latest
    identity = ["reading_id", "timestamp"]
    tables.append_new(readings.where(~today | (F.col("reading_id") % 3 > 0)), table, identity, "timestamp")
    tables.append_new(readings.where(today), table, identity, "timestamp")
    return spark.table(table).drop(f"timestamp{tables.DAY}")


@query
def refine_in_one_pass(spark: SparkSession, sf: str) -> DataFrame:
    """The layered flow's counts, observed while the checked rows are written, and the tables made of them."""
    path = shared.fresh_path(spark, "lake")
    lake = medallion.Lake(spark, path, f"furrow_{path[-12:]}")
    tables.replace_table(sensor_views.readings(spark, sf).withColumn("_ingestion_timestamp", F.current_timestamp()), lake.name("bronze", "sensor_readings"))
    tables.replace_table(sensor_views.sensor_registry(spark, sf), lake.name("bronze", "sensor_master"))
    counted = medallion.refine(lake).select(F.struct("*").alias("_c")).scalar()
    sides = [lake.read("silver", name) for name in ("valid_sensor", "invalid_sensor")]
    shown = ("reading_id", "invalid_reason", "quarantine_status")
    valid = sides[0].withColumn("quarantine_status", F.lit(None).cast("string")).select(*shown)
    both = valid.unionByName(sides[1].select(*shown))
    return both.withColumn("_c", counted).select(*shown, "_c.*")


@query
def quarantine_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Valid rows and the quarantine, which is rebuilt after the registry was corrected."""
    table = f"{_schema(spark, 'refresh')}.invalid_sensor"
    registry = sensor_views.sensor_registry(spark, sf)
    for known in (registry.filter("sensor_id % 3 > 0"), registry):
        rows = quality.validate(sensor_views.readings(spark, sf), known)
        tables.replace_table(quality.invalid_rows(rows), table)
    valid = quality.valid_rows(rows).withColumn("quarantine_status", F.lit(None).cast("string"))
    shown = ("reading_id", "invalid_reason", "quarantine_status")
    return spark.table(table).select(*shown).unionByName(valid.select(*shown))


@query
def layer_census(spark: SparkSession, sf: str) -> DataFrame:
    schema = _schema(spark, "gold")
    for name in medallion.MARTS:
        tables.replace_table(REGISTRY[name](spark, sf), f"{schema}.{name}")
    return tables.census(spark, [f"{schema}.{name}" for name in (*medallion.MARTS, "never_written")])


@query
def table_list(spark: SparkSession, sf: str) -> DataFrame:
    schema = _schema(spark, "listing")
    tables.replace_table(trusted(spark, sf).select(*KEY), f"{schema}.valid_sensor")
    tables.replace_table(sensor_views.farms(spark, sf), f"{schema}.farm_master")
    listed = sorted(row.tableName for row in tables.list_tables(spark, schema).collect())
    return tables.census(spark, [f"{schema}.{name}" for name in listed]).drop("error")


@query
def schema_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Every column of the trusted table; the estimate of distinct values is shown as how near it is."""
    profile = files.schema_profile(trusted(spark, sf))
    return profile.withColumn("about_distinct", F.col("about_distinct") > 0)


@query
def schema_profile_raw(spark: SparkSession, sf: str) -> DataFrame:
    return files.schema_profile(cleaned(spark, sf)).drop("about_distinct", "nullable")


def _damaged_landing(spark: SparkSession, sf: str) -> str:
    """Landing files in which some lines have a field less, a field more or text for a number."""

    def write(path: str) -> None:
        names = ("reading_id", "sensor_id", "farm_id", "soil_moisture")
        fields = [F.col(name).cast("string") for name in names]
        line = F.when(F.col("reading_id") % 50 == 7, F.concat_ws(",", *fields[:3]))
        line = line.when(F.col("reading_id") % 50 == 8, F.concat_ws(",", *fields, F.lit("extra")))
        line = line.when(F.col("reading_id") % 50 == 9, F.concat_ws(",", *fields[:3], F.lit("wet")))
        # the header is the only column's name, and no field holds the separator
        lines = sensor_views.readings(spark, sf).select(line.otherwise(F.concat_ws(",", *fields)).alias(",".join(names)))
        lines.write.csv(path, header=True, sep="\x01", quote="")

    return shared.written_path(spark, f"damaged{sf}", write)


DAMAGED = "reading_id BIGINT, sensor_id BIGINT, farm_id BIGINT, soil_moisture DOUBLE"


@query
def csv_scan_checked(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that fit and, in a table of their own, those that do not."""
    accepted, rejected = files.scan_checked(spark, _damaged_landing(spark, sf), DAMAGED)
    table = f"{_schema(spark, 'rejects')}.rejected_lines"
    stored = tables.replace_table(rejected, table)
    return accepted.withColumn("rejected_line", F.lit(None).cast("string")).unionByName(
        stored.select(F.col("_line").alias("rejected_line")), allowMissingColumns=True
    )


@query
def table_refresh_day(spark: SparkSession, sf: str) -> DataFrame:
    """A table by day, in which the last day is corrected; other days' files stay."""
    table = f"{_schema(spark, 'days')}.readings"
    readings = sensor_views.readings(spark, sf).select(*KEY, "timestamp", "temperature").withColumn("reading_date", reading_date())
    tables.replace_table(readings, table, ["reading_date"])
    stored = spark.table(table)
    latest = stored.agg(F.max("reading_date")).scalar()
    fixed = stored.where(F.col("reading_date") == latest).withColumn("temperature", F.coalesce("temperature", F.lit(0.0)) + 1)
    return tables.refresh_partitions(fixed, table)


# ---- cleaning ------------------------------------------------------------------------------


@query
def clean_readings(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(spark, sf)


@query
def parse_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    parsed = F.try_to_timestamp(F.col("timestamp"), F.lit(rules.TIMESTAMP_FORMAT))
    return raw(spark, sf).select("reading_id", F.col("timestamp").alias("text"), parsed.alias("timestamp"))


@query
def time_parts(spark: SparkSession, sf: str) -> DataFrame:
    timed = clean.with_time_parts(trusted(spark, sf)).withColumnRenamed("reading_hour", "hour_start")
    parted = clean.with_calendar(timed, "timestamp", month_day=True)
    return parted.select(
        "reading_id", "timestamp", "reading_date", "hour_start",
        "hour", "day_of_week", "month", "day_of_month",
    )


# ---- validation and quarantine -------------------------------------------------------------


@query
def distinct_sensors(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.distinct_keys(sensor_views.readings(spark, sf), ["sensor_id"])


@query
def sensor_membership(spark: SparkSession, sf: str) -> DataFrame:
    registry = sensor_views.sensor_registry(spark, sf)
    return quality.mark_known_sensors(sensor_views.readings(spark, sf), registry)


@query
def membership_mixed_types(spark: SparkSession, sf: str) -> DataFrame:
    """Text ids, some malformed or missing, against the whole numbers of the registry."""
    text = F.expr(
        "CASE WHEN reading_id % 11 = 0 THEN concat('x', CAST(sensor_id AS STRING))"
        " WHEN reading_id % 13 = 0 THEN NULL ELSE CAST(sensor_id AS STRING) END"
    )
    rows = sensor_views.readings(spark, sf).select("reading_id", text.alias("sensor_id"))
    return quality.mark_known_sensors(rows, sensor_views.sensor_registry(spark, sf))


@query
def missing_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Each reading, some with NULL and some with NaN, on exactly one side."""
    nan = F.when(F.col("reading_id") % 17 == 0, F.lit(float("nan"))).otherwise(F.col("rainfall"))
    rows = sensor_views.readings(spark, sf).withColumn("rainfall", nan)
    kept = quality.required_present(rows).select("reading_id", F.lit("kept").alias("side"))
    return kept.unionByName(quality.null_quarantine(rows).select("reading_id", F.lit("quarantined").alias("side")))


@query
def validation_flags(spark: SparkSession, sf: str) -> DataFrame:
    return checked(spark, sf).select(*KEY, *FLAGS, "is_valid")


@query
def invalid_reason(spark: SparkSession, sf: str) -> DataFrame:
    return checked(spark, sf).select("reading_id", "is_valid", "invalid_reason")


@query
def valid_readings(spark: SparkSession, sf: str) -> DataFrame:
    return quality.valid_rows(checked(spark, sf))


@query
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return quality.invalid_rows(checked(spark, sf)).drop("quarantine_timestamp")


@query
def required_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.required_present(cleaned(spark, sf))


@query
def null_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_quarantine(cleaned(spark, sf)).drop("quarantine_timestamp")


@query
def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_summary(checked(spark, sf))


@query
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_profile(cleaned(spark, sf))


@query
def fill_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """Missing numbers, texts and times; field_id is missing where it did not rain."""
    fixed = F.lit("1970-01-01 00:00:00").cast("timestamp")
    unplaced = F.when(F.col("rainfall") > 0, F.col("field_id"))
    return quality.fill_by_type(cleaned(spark, sf).withColumn("field_id", unplaced), time=fixed)


@query
def fill_subset(spark: SparkSession, sf: str) -> DataFrame:
    zeros = dict.fromkeys(("temperature", "rainfall"), 0.0)
    return quality.fill_columns(cleaned(spark, sf), zeros).select("reading_id", *rules.MEASURES)


# ---- rules, duplicates, enrichment ---------------------------------------------------------


@query
def status_rules(spark: SparkSession, sf: str) -> DataFrame:
    yes_no = rules.IRRIGATION_YES_NO.column().alias("irrigation_call")
    return trusted(spark, sf).select(
        "reading_id", *(ladder.named() for ladder in rules.READING_STATUSES), yes_no
    )


@query
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.latest_reading(sensor_views.resent_readings(spark, sf), ingested="ingest_seq")


@query
def dedup_keys(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.distinct_keys(sensor_views.resent_readings(spark, sf), dedup.READING_KEY)


def _with_farm(spark: SparkSession, sf: str, on_collision: str, times: int = 1) -> DataFrame:
    rows = trusted(spark, sf).select(*KEY, F.lit("readings").alias("_source_file"))
    farms = sensor_views.farms(spark, sf).withColumn("_source_file", F.lit("farms"))
    for _ in range(times):
        rows = enrich.enrich(rows, farms, "farm_id", on_collision)
    return rows


@query
def farm_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return _with_farm(spark, sf, "prefix")


@query
def farm_enrich_skip(spark: SparkSession, sf: str) -> DataFrame:
    return _with_farm(spark, sf, "skip", times=2)


@query
def farm_enrich_mixed_types(spark: SparkSession, sf: str) -> DataFrame:
    """Text farm ids, some malformed, against the whole numbers of the farm table."""
    text = F.expr("CASE WHEN reading_id % 11 = 0 THEN 'n/a' ELSE CAST(farm_id AS STRING) END")
    rows = trusted(spark, sf).select("reading_id", text.alias("farm_id"))
    return enrich.enrich(rows, sensor_views.farms(spark, sf), "farm_id")


@query
def limit_n(spark: SparkSession, sf: str) -> DataFrame:
    """A preview of the first readings."""
    return trusted(spark, sf).select(*KEY, "timestamp").orderBy("timestamp", "reading_id").limit(20)


# ---- series --------------------------------------------------------------------------------


def _trend(spark: SparkSession, sf: str, *entity: str, rounded: bool = False) -> DataFrame:
    rows = trusted(spark, sf).select(*KEY, "timestamp", "temperature")
    return series.temperature_trend(rows, entity, rounded, cut(spark, sf, *entity))


@query
def lag_delta_sensor(spark: SparkSession, sf: str) -> DataFrame:
    trend = _trend(spark, sf, "sensor_id")
    return trend.select(*KEY, "temperature", "previous_temperature", "temperature_change")


@query
def lag_delta_farm_sensor(spark: SparkSession, sf: str) -> DataFrame:
    trend = _trend(spark, sf, "farm_id", "sensor_id", rounded=True)
    return trend.select(*KEY, "temperature", "previous_temperature", "temperature_change")


@query
def rolling_avg_3(spark: SparkSession, sf: str) -> DataFrame:
    per_sensor = _trend(spark, sf, "sensor_id").select(*KEY, "3_reading_average")
    return per_sensor.withColumnRenamed("3_reading_average", "three_reading_average")


@query
def rolling_avg_3_farm_sensor(spark: SparkSession, sf: str) -> DataFrame:
    per_pair = _trend(spark, sf, "farm_id", "sensor_id", rounded=True).select(*KEY, "3_reading_average")
    return per_pair.withColumnRenamed("3_reading_average", "three_reading_average")


@query
def rolling_features(spark: SparkSession, sf: str) -> DataFrame:
    trends = features.sensor_trends(
        trusted(spark, sf).select(*KEY, "timestamp", *rules.MEASURES), cut(spark, sf, "sensor_id")
    )
    return trends.select(
        *KEY, "temperature_change", "soil_moisture_change",
        *(f"{name}_rolling_avg" for name in features.ROLLING),
    )


@query
def daily_stats_sensor(spark: SparkSession, sf: str) -> DataFrame:
    rows = trusted(spark, sf).select(*KEY, "reading_date", "temperature")
    return series.daily_temperature(rows, "sensor_id")


@query
def daily_stats_farm(spark: SparkSession, sf: str) -> DataFrame:
    rows = trusted(spark, sf).select(*KEY, "reading_date", "temperature")
    return series.daily_temperature(rows, "farm_id", rounded=True)


def _moisture_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.next_moisture_features(trusted(spark, sf), cut(spark, sf, "farm_id"))


@query
def moisture_lags(spark: SparkSession, sf: str) -> DataFrame:
    lags = [f"soil_moisture_lag_{n}" for n in (1, 2, 3)]
    return _moisture_features(spark, sf).select("reading_id", "farm_id", "soil_moisture", *lags)


@query
def lagged_rolling_avg(spark: SparkSession, sf: str) -> DataFrame:
    means = [f"{name}_rolling_avg_3" for name in features.LAGGED_ROLLING]
    return _moisture_features(spark, sf).select("reading_id", "farm_id", *means)


@query
def next_moisture_target(spark: SparkSession, sf: str) -> DataFrame:
    return _moisture_features(spark, sf).select(
        "reading_id", "farm_id", "reading_hour", "soil_moisture", features.MOISTURE_TARGET
    )


@query
def next_hour_target(spark: SparkSession, sf: str) -> DataFrame:
    """The target over one row per farm and hour."""
    hourly = features.farm_hour_means(trusted(spark, sf))
    return features.next_moisture_features(hourly).select(
        "farm_id", "reading_hour", "soil_moisture", "soil_moisture_lag_1", features.MOISTURE_TARGET
    )


@query
def next_hour_by_time(spark: SparkSession, sf: str) -> DataFrame:
    """Farm hours with the hours before and after by the clock, histories cut by day."""
    return features.next_hour_features(trusted(spark, sf)).drop("reading_id", "temperature", "humidity", "rainfall", "battery")


@query
def next_hour_by_time_plain(spark: SparkSession, sf: str) -> DataFrame:
    return features.next_hour_features(trusted(spark, sf), segment=None).drop("reading_id", "temperature", "humidity", "rainfall", "battery")


@query
def hour_around_sensor(spark: SparkSession, sf: str) -> DataFrame:
    """Each reading with the mean temperature of its sensor's day before and hour after, cut at the shortest length."""
    rows = trusted(spark, sf).select(*KEY, "timestamp", "temperature")
    return series.by_distance(rows, ["sensor_id"], {
        "day_before": series.mean_within("temperature", -86_400, -1), "hour_after": series.mean_within("temperature", 1, 3600),
    }, segment=1)


# ---- marts ---------------------------------------------------------------------------------


def _mart(spark: SparkSession, sf: str, name: str, **options: series.Cut | None) -> DataFrame:
    return medallion.MARTS[name](trusted(spark, sf), **options).drop(marts.PROCESSED)


@query
def farm_daily_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _mart(spark, sf, "farm_daily_metrics")


@query
def sensor_health(spark: SparkSession, sf: str) -> DataFrame:
    return _mart(spark, sf, "sensor_health")


@query
def crop_conditions(spark: SparkSession, sf: str) -> DataFrame:
    return _mart(spark, sf, "crop_conditions")


@query
def irrigation_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return _mart(spark, sf, "irrigation_alerts")


@query
def environment_trend(spark: SparkSession, sf: str) -> DataFrame:
    return _mart(
        spark, sf, "environment_trend", cut=cut(spark, sf, "farm_id", "sensor_id")
    )


@query
def enriched_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Every derived column of the trusted layer together."""
    described = medallion.describe_readings(
        trusted(spark, sf).select(*rules.REQUIRED_FIELDS), sensor_views.farms(spark, sf)
    )
    return described.withColumnRenamed("3_reading_average", "three_reading_average").drop(
        "_silver_processed_timestamp"
    )


# ---- features ------------------------------------------------------------------------------


@query
def interaction_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.interactions(trusted(spark, sf)).select(
        "reading_id", "temperature_humidity_interaction", "soil_rainfall_interaction",
        "temperature_humidity_difference", "soil_moisture_deficit",
    )


@query
def irrigation_label(spark: SparkSession, sf: str) -> DataFrame:
    return trusted(spark, sf).select("reading_id", rules.IRRIGATION_LABEL.named())


@query
def label_distribution(spark: SparkSession, sf: str) -> DataFrame:
    labelled = trusted(spark, sf).select(rules.IRRIGATION_LABEL.named())
    return quality.value_counts(labelled, features.IRRIGATION_TARGET)


@query
def irrigation_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.irrigation_features(trusted(spark, sf), cut(spark, sf, "sensor_id"))


@query
def next_moisture_features(spark: SparkSession, sf: str) -> DataFrame:
    return _moisture_features(spark, sf)


@query
def next_moisture_features_cut(spark: SparkSession, sf: str) -> DataFrame:
    """The plan for very large farms: every history cut by day."""
    return features.next_moisture_features(trusted(spark, sf), series.Cut("day"))


@query
def irrigation_features_cut(spark: SparkSession, sf: str) -> DataFrame:
    """The plan for sensors that even time cannot split: histories cut at ranges of the order."""
    return features.irrigation_features(trusted(spark, sf), series.Cut(None))


@query
def next_moisture_features_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Only the farms above a small limit are cut, at the unit that counting finds."""
    return features.next_moisture_features(trusted(spark, sf), 200)


@query
def irrigation_features_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Only the sensors above a small limit are cut; so small that ranges of the order must do it."""
    return features.irrigation_features(trusted(spark, sf), 40)


@query
def next_moisture_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return features.next_moisture_dataset(_moisture_features(spark, sf))


# ---- splits --------------------------------------------------------------------------------


@query
def global_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    rows = trusted(spark, sf).select("reading_id", "farm_id", "timestamp")
    return ordinal.with_ordinal(rows, ["timestamp", "reading_id"], shared.fresh_path(spark, "ordinal"))


def _irrigation_split(spark: SparkSession, sf: str) -> DataFrame:
    table = shared.written_once(
        spark, f"irrigation{sf}", lambda: irrigation_features(spark, sf)
    )
    return models.hashed_split(table, "reading_id")


_splits: dict[tuple[str, str], DataFrame] = {}


def _moisture_split(spark: SparkSession, sf: str) -> DataFrame:
    """The written forecast table with its split, whose border is found once."""
    key = (spark.sparkContext.applicationId, sf)
    with _building:
        if key not in _splits:
            table = shared.written_once(
                spark, f"moisture{sf}", lambda: next_moisture_dataset(spark, sf)
            )
            _splits[key] = ordinal.chronological_split(table, shared.fresh_path(spark, "border"))
        return _splits[key]


@query
def random_split(spark: SparkSession, sf: str) -> DataFrame:
    return models.hashed_split(trusted(spark, sf).select(*KEY), "reading_id")


@query
def chrono_split(spark: SparkSession, sf: str) -> DataFrame:
    return _moisture_split(spark, sf).select("reading_id", "farm_id", "timestamp", "split")


# ---- models --------------------------------------------------------------------------------

_models: dict[tuple[str, str, str], BaggedForest] = {}
_fitting = threading.RLock()


def _fitted(spark: SparkSession, sf: str, name: str, fit: Callable[[], BaggedForest]) -> BaggedForest:
    key = (spark.sparkContext.applicationId, sf, name)
    with _fitting:
        if key not in _models:
            _models[key] = fit()
        return _models[key]


def _irrigation_vectors(spark: SparkSession, sf: str, side: str) -> DataFrame:
    rows = _irrigation_split(spark, sf).filter(F.col("split") == side)
    return models.assemble(rows, features.IRRIGATION_FEATURES)


def _moisture_vectors(spark: SparkSession, sf: str, side: str) -> DataFrame:
    rows = _moisture_split(spark, sf).filter(F.col("split") == side)
    return models.assemble(rows, features.MOISTURE_FEATURES, invalid="skip")


def _irrigation_model(spark: SparkSession, sf: str) -> BaggedForest:
    return _fitted(spark, sf, "irrigation", lambda: models.fit_classifier(
        _irrigation_vectors(spark, sf, "train"), features.IRRIGATION_TARGET, features.IRRIGATION_FEATURES
    ))


def _moisture_model(spark: SparkSession, sf: str) -> BaggedForest:
    return _fitted(spark, sf, "moisture", lambda: models.fit_regressor(
        _moisture_vectors(spark, sf, "train"), features.MOISTURE_TARGET, features.MOISTURE_FEATURES
    ))


def _irrigation_scored(spark: SparkSession, sf: str) -> DataFrame:
    return _irrigation_model(spark, sf).transform(_irrigation_vectors(spark, sf, "test"))


def _moisture_scored(spark: SparkSession, sf: str) -> DataFrame:
    return _moisture_model(spark, sf).transform(_moisture_vectors(spark, sf, "test"))


def _unpacked(vectors: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Vector entries as columns, so that SQL can check the assembly."""
    entries = vectors.withColumn("_v", vector_to_array("features"))
    return entries.select(
        "reading_id", F.size("_v").alias("n_features"),
        *(F.col("_v")[i].alias(f"v_{name}") for i, name in enumerate(names)),
    )


@query
def irrigation_vectors(spark: SparkSession, sf: str) -> DataFrame:
    names = features.IRRIGATION_FEATURES
    return _unpacked(models.assemble(_irrigation_split(spark, sf), names), names)


@query
def moisture_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Incomplete rows are skipped by the assembler, so no rows are dropped before it."""
    names = features.MOISTURE_FEATURES
    return _unpacked(models.assemble(_moisture_features(spark, sf), names, invalid="skip"), names)


@query
def irrigation_classifier(spark: SparkSession, sf: str) -> DataFrame:
    model = _irrigation_model(spark, sf)
    return _irrigation_split(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("records")).select(
        "split", "records", F.lit(model.getNumTrees).alias("tree_count"),
        F.lit(model.numFeatures).alias("feature_count"),
    )


@query
def moisture_regressor(spark: SparkSession, sf: str) -> DataFrame:
    model = _moisture_model(spark, sf)
    return _moisture_split(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("records")).select(
        "split", "records", F.lit(model.getNumTrees).alias("tree_count"),
        F.lit(model.numFeatures).alias("feature_count"),
    )


@query
def irrigation_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return _irrigation_scored(spark, sf).select(
        "reading_id", features.IRRIGATION_TARGET, "prediction",
        vector_to_array("probability").alias("probability"),
        vector_to_array("rawPrediction").alias("raw_prediction"),
    )


@query
def classifier_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return models.classification_metrics(_irrigation_scored(spark, sf), features.IRRIGATION_TARGET)


@query
def regressor_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return models.regression_metrics(_moisture_scored(spark, sf), features.MOISTURE_TARGET)


def _threshold_guess(spark: SparkSession, sf: str) -> DataFrame:
    """A prediction SQL can state as well: dry soil calls for water, whatever the rain."""
    dry = F.when(F.col("soil_moisture") < rules.DRY_SOIL, 1.0).otherwise(0.0)
    return _irrigation_split(spark, sf).withColumn("prediction", dry)


def _same_again(spark: SparkSession, sf: str) -> DataFrame:
    """A forecast SQL can state as well: the mean of the three earlier readings."""
    return _moisture_split(spark, sf).withColumn("prediction", F.col("soil_moisture_rolling_avg_3"))


@query
def classifier_metrics_of_rule(spark: SparkSession, sf: str) -> DataFrame:
    return models.classification_metrics(_threshold_guess(spark, sf), features.IRRIGATION_TARGET).select(
        *(F.round(name, 9).alias(name) for name in ("accuracy", "weighted_precision", "weighted_recall", "f1"))
    )


@query
def regressor_metrics_of_mean(spark: SparkSession, sf: str) -> DataFrame:
    return models.regression_metrics(_same_again(spark, sf), features.MOISTURE_TARGET).select(
        *(F.round(name, 6).alias(name) for name in ("mae", "rmse", "r2"))
    )


@query
def moisture_predictions_of_mean(spark: SparkSession, sf: str) -> DataFrame:
    return models.moisture_predictions(_same_again(spark, sf))


@query
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    return models.feature_importance(spark, _irrigation_model(spark, sf), features.IRRIGATION_FEATURES)


@query
def feature_importance_top5(spark: SparkSession, sf: str) -> DataFrame:
    return feature_importance(spark, sf).limit(5)


@query
def strongest_features(spark: SparkSession, sf: str) -> DataFrame:
    """The five features that go with the irrigation label most."""
    return models.strongest(_irrigation_split(spark, sf), features.IRRIGATION_FEATURES, features.IRRIGATION_TARGET, 5)


@query
def moisture_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return models.moisture_predictions(_moisture_scored(spark, sf))


@query
def predictions_preview(spark: SparkSession, sf: str) -> DataFrame:
    """The first 50 forecasts by farm and hour."""
    first = _moisture_scored(spark, sf).orderBy("farm_id", "reading_hour", "reading_id").limit(50)
    return models.moisture_predictions(first)


@query
def predictions_preview_of_mean(spark: SparkSession, sf: str) -> DataFrame:
    first = _same_again(spark, sf).orderBy("farm_id", "reading_hour", "reading_id").limit(50)
    return models.moisture_predictions(first)


@query
def column_guard(spark: SparkSession, sf: str) -> DataFrame:
    """The columns that forecasts need are there; a frame without one of them is refused by name."""
    required = ["reading_id", "farm_id", "timestamp", *rules.MEASURES]
    rows = files.require_columns(trusted(spark, sf), required).select("reading_id")
    try:
        files.require_columns(trusted(spark, sf).drop("battery", "rainfall"), required)
        refusal = None
    except ValueError as problem:
        refusal = str(problem)
    return rows.withColumn("refusal", F.lit(refusal))


@query
def too_few_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A chronological split that asks for one row more than there are is refused."""
    table = _moisture_split(spark, sf).drop("split")
    needed = table.count() + 1
    try:
        ordinal.chronological_split(table, shared.fresh_path(spark, "border"), min_rows=needed)
        refusal = None
    except ValueError as problem:
        refusal = str(problem)
    return table.agg(F.count(F.lit(1)).alias("records"), F.lit(refusal).alias("refusal"))


@query
def training_summary(spark: SparkSession, sf: str) -> DataFrame:
    return models.training_summary(_irrigation_split(spark, sf), classifier_metrics(spark, sf), {
        "algorithm": "RandomForestClassifier",
        "feature_count": len(features.IRRIGATION_FEATURES),
        "tree_count": _irrigation_model(spark, sf).getNumTrees,
        "draw_count": len(_irrigation_model(spark, sf).members),
    })


@query
def moisture_training_summary(spark: SparkSession, sf: str) -> DataFrame:
    return models.training_summary(_moisture_split(spark, sf), regressor_metrics(spark, sf), {
        "algorithm": "RandomForestRegressor",
        "feature_count": len(features.MOISTURE_FEATURES),
        "tree_count": _moisture_model(spark, sf).getNumTrees,
        "draw_count": len(_moisture_model(spark, sf).members),
    })


# What SQL can state about learned results: rows, ranges, and that something was learned.


@query
def forest_repartition_check(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows on which forests of the same rows in 1, 9 and 64 partitions differ, and their trees that do.

    Beyond ``bagging.ROWS_OF_TASK`` training rows there are that many times as many, so that no task gets the whole table.
    """
    train = _irrigation_vectors(spark, sf, "train")
    times = bagging.tasks_for(train)
    fitted = [
        models.fit_classifier(
            train.repartition(n * times), features.IRRIGATION_TARGET, features.IRRIGATION_FEATURES, numTrees=6, draws=3
        ) for n in (1, 9, 64)
    ]
    scored = _irrigation_vectors(spark, sf, "test")
    for n, model in enumerate(fitted):
        scored = model.transform(scored).withColumnRenamed("prediction", f"prediction_{n}").drop("rawPrediction", "probability")
    differ = (F.col("prediction_0") != F.col("prediction_1")) | (F.col("prediction_0") != F.col("prediction_2"))
    trees = sum(a != b or a != c for a, b, c in zip(*(model.trees for model in fitted)))
    return scored.agg(
        F.count(F.lit(1)).alias("records"), F.count_if(differ).alias("differing"),
        F.lit(trees).cast("bigint").alias("differing_trees"),
    )


@query
def bootstrap_weights(spark: SparkSession, sf: str) -> DataFrame:
    """A draw's weights: about a Poisson number of mean 1 for every training row, other ones in another draw."""
    first, second = (bagging.poisson_weight(42, draw, "reading_id") for draw in (0, 1))
    rows = _irrigation_split(spark, sf).filter("split = 'train'").select(first.alias("one"), second.alias("other"))
    near = lambda value, aim: F.abs(value - aim) < 0.2
    return rows.agg(
        F.count(F.lit(1)).alias("records"), near(F.avg("one"), 1).alias("mean_is_one"),
        near(F.var_pop("one"), 1).alias("variance_is_one"), near(F.corr("one", "other"), 0).alias("draws_differ"),
    )


@query
def irrigation_predictions_check(spark: SparkSession, sf: str) -> DataFrame:
    chance = F.col("probability")
    return irrigation_predictions(spark, sf).select(
        "reading_id", F.size(chance).alias("n_labels"), (F.abs(chance[0] + chance[1] - 1) < 1e-9).alias("sums_to_one"),
        (F.col("prediction") == F.when(chance[1] > chance[0], 1.0).otherwise(0.0)).alias("is_most_likely"),
    )


@query
def irrigation_classifier_check(spark: SparkSession, sf: str) -> DataFrame:
    """On both sides the forest is right more often than the more frequent label."""
    vectors = models.assemble(_irrigation_split(spark, sf), features.IRRIGATION_FEATURES)
    label = F.col(features.IRRIGATION_TARGET).cast("double")
    share = F.avg(label)
    return _irrigation_model(spark, sf).transform(vectors).groupBy("split").agg(
        F.count(F.lit(1)).alias("records"),
        (F.avg((F.col("prediction") == label).cast("double")) > F.greatest(share, 1 - share)).alias("beats_majority"),
    )


@query
def feature_importance_check(spark: SparkSession, sf: str) -> DataFrame:
    return feature_importance(spark, sf).agg(
        F.count(F.lit(1)).alias("features"), F.count_if(F.col("importance_score") < 0).alias("negative"),
        F.round(F.sum("importance_score"), 9).alias("total"),
    )


@query
def training_summary_check(spark: SparkSession, sf: str) -> DataFrame:
    right = (F.col("prediction") == F.col(features.IRRIGATION_TARGET)).cast("double")
    plain = _irrigation_scored(spark, sf).agg(F.avg(right).alias("share_right"))
    return training_summary(spark, sf).withColumn("share_right", plain.scalar()).select(
        "total_records", "train_records", "test_records",
        (F.abs(F.col("accuracy") - F.col("share_right")) < 1e-9).alias("same_accuracy"),
    )


@query
def moisture_predictions_check(spark: SparkSession, sf: str) -> DataFrame:
    """The call reads the unrounded forecast; means of targets lie among the targets."""
    said = rules.PREDICTED_IRRIGATION.column() == "YES"
    return _moisture_scored(spark, sf).select(
        "reading_id", (said == (F.col("prediction") < rules.DRY_SOIL)).alias("call_agrees"),
        F.col("prediction").between(0, 100).alias("within_targets"),
    )


@query
def moisture_training_summary_check(spark: SparkSession, sf: str) -> DataFrame:
    """The summary's error is the mean one, and on the training rows the forest beats their mean."""
    error = F.avg(F.abs(F.col(features.MOISTURE_TARGET) - F.col("prediction")))
    plain = _moisture_scored(spark, sf).agg(error.alias("mean_error"))
    fitted = models.regression_metrics(
        _moisture_model(spark, sf).transform(_moisture_vectors(spark, sf, "train")), features.MOISTURE_TARGET
    ).select(F.col("r2").alias("fitted_r2"))
    summary = moisture_training_summary(spark, sf).withColumns({"mean_error": plain.scalar(), "fitted_r2": fitted.scalar()})
    return summary.select(
        "total_records", "train_records", "test_records",
        (F.abs(F.col("mae") - F.col("mean_error")) < 1e-6).alias("same_mae"), (F.col("fitted_r2") > 0).alias("learned"),
    )


@query
def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows scored by the fitted and by the reloaded model, with the rows that differ."""
    path = shared.written_path(
        spark, f"model{sf}",
        lambda path: models.save_model(_irrigation_model(spark, sf), path),
    )
    fitted = _irrigation_scored(spark, sf).withColumnRenamed("prediction", "first").drop("rawPrediction", "probability")
    both = BaggedForest.load(path).transform(fitted)
    return both.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("first") != F.col("prediction")).alias("differing"),
    )
