"""Feature tables for the irrigation classifier and the soil moisture forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions.columns import reading_hour
from furrow.functions.rules import DRY_SOIL, IRRIGATION_LABEL, MEASURES
from furrow.operators.clean import strict_measures, with_calendar
from furrow.operators.series import ROWS_OF_TASK, Cut, along, at_distance, by_distance, lag, lead, mean_within, trailing_mean
from furrow.sources.files import require_columns

# ---- Fixed values: feature names in model order ----

IRRIGATION_FEATURES = (
    "temperature", "humidity", "soil_moisture", "rainfall", "battery",
    "reading_hour", "day_of_week", "month", "day_of_month",
    "temperature_humidity_interaction", "soil_rainfall_interaction",
    "temperature_humidity_difference", "soil_moisture_deficit",
    "temperature_change", "soil_moisture_change",
    "temperature_rolling_avg", "humidity_rolling_avg",
    "soil_moisture_rolling_avg", "rainfall_rolling_avg",
)
IRRIGATION_TARGET = "irrigation_label"

MOISTURE_FEATURES = (
    "temperature", "humidity", "rainfall", "battery",
    "soil_moisture_lag_1", "soil_moisture_lag_2", "soil_moisture_lag_3",
    "soil_moisture_rolling_avg_3", "temperature_rolling_avg_3", "humidity_rolling_avg_3",
    "hour", "day_of_week", "month",
)
MOISTURE_TARGET = "next_hour_soil_moisture"

ROLLING = ("temperature", "humidity", "soil_moisture", "rainfall")
LAGGED_ROLLING = ("soil_moisture", "temperature", "humidity")


def interactions(readings: DataFrame) -> DataFrame:
    temperature, humidity = F.col("temperature"), F.col("humidity")
    soil = F.col("soil_moisture")
    return readings.withColumns({
        "temperature_humidity_interaction": temperature * humidity,
        "soil_rainfall_interaction": soil * F.col("rainfall"),
        "temperature_humidity_difference": F.abs(temperature - humidity),
        "soil_moisture_deficit": F.when(soil < DRY_SOIL, DRY_SOIL - soil).otherwise(0.0),
    })


def sensor_trends(readings: DataFrame, cut: Cut | int | None = ROWS_OF_TASK) -> DataFrame:
    """Changes since the sensor's previous reading and means of its last three."""
    trended = along(readings, ["sensor_id"], {
        "previous_temperature": lag("temperature"),
        "previous_soil_moisture": lag("soil_moisture"),
        **{f"{name}_rolling_avg": trailing_mean(name) for name in ROLLING},
    }, cut=cut)
    return trended.withColumns({
        f"{name}_change": F.col(name) - F.col(f"previous_{name}")
        for name in ("temperature", "soil_moisture")
    })


def irrigation_features(readings: DataFrame, cut: Cut | int | None = ROWS_OF_TASK) -> DataFrame:
    """Ids, 19 features without NULLs, and the 0/1 label.

    The label is a rule over two of the features, so a model on it re-learns that rule; read its
    accuracy as a check of the wiring, not as forecasting skill.
    """
    columns = ["reading_id", "sensor_id", "farm_id", "timestamp"]
    trended = sensor_trends(readings.select(*columns, *MEASURES), cut)
    built = with_calendar(interactions(trended), "timestamp", hour="reading_hour", month_day=True)
    labelled = built.withColumn(IRRIGATION_TARGET, IRRIGATION_LABEL.column())
    filled = labelled.fillna(0, list(IRRIGATION_FEATURES))
    return filled.select(*columns, *IRRIGATION_FEATURES, IRRIGATION_TARGET)


def farm_hour_means(readings: DataFrame) -> DataFrame:
    """One row per farm and hour, so that the next row is a later hour of the farm."""
    return readings.groupBy("farm_id", reading_hour().alias("timestamp")).agg(
        F.min("reading_id").alias("reading_id"), *(F.avg(name).alias(name) for name in MEASURES)
    )


def next_moisture_features(readings: DataFrame, cut: Cut | int | None = ROWS_OF_TASK) -> DataFrame:
    """13 features and the soil moisture of the farm's next reading.

    Rows follow (timestamp, reading_id) per farm. The next reading may be another sensor in the
    same hour; pass ``farm_hour_means(readings)`` for one row per hour.
    """
    required = ["reading_id", "farm_id", "timestamp", *MEASURES]
    narrow = require_columns(readings, required).select(*required)
    series = along(strict_measures(narrow), ["farm_id"], {
        **{f"soil_moisture_lag_{n}": lag("soil_moisture", n) for n in (1, 2, 3)},
        **{f"{name}_rolling_avg_3": trailing_mean(name, -3, -1) for name in LAGGED_ROLLING},
        MOISTURE_TARGET: lead("soil_moisture"),
    }, cut=cut)
    return with_calendar(series.withColumn("reading_hour", reading_hour()), "reading_hour")


HOUR = 3600


def next_hour_features(readings: DataFrame, segment: int | None = 86_400) -> DataFrame:
    """One row per farm and hour with the soil moisture one to three hours before and one hour after.

    Unlike the next row of ``next_moisture_features``, which may lie in the same hour or days ahead, every
    column keeps its distance in time: where that hour has no reading it is NULL. The rolling means take the
    readings of the three hours before.
    """
    hourly = farm_hour_means(readings)
    return with_calendar(by_distance(hourly, ["farm_id"], {
        **{f"soil_moisture_lag_{n}": at_distance("soil_moisture", -n * HOUR) for n in (1, 2, 3)},
        **{f"{name}_rolling_avg_3": mean_within(name, -3 * HOUR, -HOUR) for name in LAGGED_ROLLING},
        MOISTURE_TARGET: at_distance("soil_moisture", HOUR),
    }, segment=segment).withColumnRenamed("timestamp", "reading_hour"), "reading_hour")


def next_moisture_dataset(features: DataFrame) -> DataFrame:
    """Rows with every feature and the target."""
    return features.dropna(subset=[*MOISTURE_FEATURES, MOISTURE_TARGET])
