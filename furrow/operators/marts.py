"""Reporting marts over trusted readings (typed, valid, deduplicated)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.functions import rules
from furrow.functions.columns import mean_of_rounded, reading_date, reading_hour, round2
from furrow.operators.quality import fill_by_type
from furrow.operators.series import ROWS_OF_TASK, Cut, temperature_trend

PROCESSED = "_gold_processed_timestamp"

_ON_DAILY = {
    "temperature": "avg_temperature",
    "humidity": "avg_humidity",
    "soil_moisture": "avg_soil_moisture",
    "rainfall": "total_rainfall",
}


def _summary(df: DataFrame, keys: list[Column | str], measures: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*(column.alias(name) for name, column in measures.items()))


def _publish(df: DataFrame, *ladders: rules.Ladder) -> DataFrame:
    """Statuses read the published, rounded values."""
    return df.withColumns(
        {ladder.name: ladder.column() for ladder in ladders} | {PROCESSED: F.current_timestamp()}
    )


def farm_daily_metrics(readings: DataFrame) -> DataFrame:
    daily = _summary(readings, ["farm_id", reading_date()], {
        "total_readings": F.count("reading_id"),
        "active_sensors": F.countDistinct("sensor_id"),
        "avg_temperature": round2(F.avg("temperature")),
        "min_temperature": round2(F.min("temperature")),
        "max_temperature": round2(F.max("temperature")),
        "avg_humidity": round2(F.avg("humidity")),
        "avg_soil_moisture": round2(F.avg("soil_moisture")),
        "total_rainfall": round2(F.sum("rainfall")),
        "avg_battery": round2(F.avg("battery")),
    })
    on_daily = (rules.TEMPERATURE_STATUS, rules.SOIL_STATUS, rules.IRRIGATION_YES_NO)
    return _publish(daily, *(ladder.over(**_ON_DAILY) for ladder in on_daily))


def sensor_health(readings: DataFrame) -> DataFrame:
    per_sensor = _summary(readings, ["farm_id", "sensor_id"], {
        "total_readings": F.count("reading_id"),
        "first_reading_timestamp": F.min("timestamp"),
        "last_reading_timestamp": F.max("timestamp"),
        "avg_battery": round2(F.avg("battery")),
        "min_battery": round2(F.min("battery")),
        "avg_temperature": round2(F.avg("temperature")),
    })
    return _publish(per_sensor, rules.SENSOR_HEALTH_SUMMARY)


def crop_conditions(readings: DataFrame) -> DataFrame:
    daily = _summary(readings, ["farm_id", reading_date()], {
        "avg_temperature": round2(F.avg("temperature")),
        "avg_humidity": round2(F.avg("humidity")),
        "avg_soil_moisture": round2(F.avg("soil_moisture")),
        "total_rainfall": round2(F.sum("rainfall")),
    })
    on_daily = (rules.TEMPERATURE_STATUS, rules.HUMIDITY_STATUS, rules.SOIL_STATUS)
    return _publish(daily, *(ladder.over(**_ON_DAILY) for ladder in on_daily))


def irrigation_alerts(readings: DataFrame) -> DataFrame:
    """Readings that call for water; the rule's own conditions are filtered, so scans can skip."""
    (call,) = rules.IRRIGATION_YES_NO.rungs
    alerts = readings.filter(call.column()).select(
        "farm_id", "sensor_id", "timestamp", reading_date(), reading_hour(), *rules.MEASURES,
        rules.SOIL_STATUS.named(), rules.IRRIGATION_YES_NO.named(),
        F.lit(rules.ALERT).alias("alert_status"),
    )
    return _publish(alerts)


def environment_trend(readings: DataFrame, cut: Cut | int | None = ROWS_OF_TASK) -> DataFrame:
    """Hourly means per farm and sensor beside the farm's temperatures of that day.

    Missing values count as 0 in the means. The farm's daily figures are equal for every reading
    of a day, so they join the hourly rows after these are aggregated, not the raw readings.
    """
    or_zero = lambda column: F.coalesce(column, F.lit(0))
    trend = temperature_trend(
        readings.select("reading_id", "farm_id", "sensor_id", "timestamp", *rules.MEASURES),
        ["farm_id", "sensor_id"], rounded=True, cut=cut,
    )
    hourly = _summary(trend, ["farm_id", "sensor_id", reading_hour()], {
        **{f"avg_{name}": round2(F.avg(or_zero(F.col(name)))) for name in rules.MEASURES},
        "avg_temperature_change": round2(mean_of_rounded(or_zero(F.col("temperature_change")))),
        "three_reading_temperature_avg": round2(mean_of_rounded(or_zero(F.col("3_reading_average")))),
    }).withColumn("_day", F.to_date("reading_hour"))
    daily = _summary(
        readings, [F.col("farm_id").alias("_farm"), reading_date().alias("_date")], {
            "daily_temperature_avg": or_zero(round2(F.avg("temperature"))),
            "daily_temperature_min": or_zero(round2(F.min("temperature"))),
            "daily_temperature_max": or_zero(round2(F.max("temperature"))),
        }
    )
    same_day = hourly["farm_id"].eqNullSafe(daily["_farm"]) & hourly["_day"].eqNullSafe(daily["_date"])
    joined = hourly.join(daily, same_day, "left").withColumn(
        "reading_date", F.coalesce("_day", F.lit(rules.MISSING_DATE).cast("date"))
    )
    return _publish(fill_by_type(joined.drop("_day", "_farm", "_date")))
