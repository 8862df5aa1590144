"""Sensor feed and master data derived from the test tables (whole tables, no subsets).

``events`` stands in for the reading feed, ``customer`` for the sensor registry and ``nation``
for the farms. The projections are plain SQL, so the SQL checks start from the same input.
Measures are multiples of 1/16, which keeps sums exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

READINGS = (
    "event_id AS reading_id",
    "user_id AS sensor_id",
    "event_id % 27 AS farm_id",
    "event_id % 9 AS field_id",
    "CAST(ts AS TIMESTAMP) AS timestamp",
    "CASE WHEN event_id % 97 = 0 THEN NULL ELSE floor(value * 4) / 4 - 10.0e0 END AS temperature",
    "CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS DOUBLE) * 1.0625e0 AS humidity",
    "CAST((event_id * 7 + user_id) % 105 AS DOUBLE) AS soil_moisture",
    "CAST(event_id % 13 AS DOUBLE) - 0.5e0 AS rainfall",
    "CAST((event_id + user_id * 3) % 104 AS DOUBLE) AS battery",
)

_PADDED = "lpad(CAST({part}(ts) AS STRING), 2, '0')"

RAW_READINGS = (
    "event_id AS reading_id",
    "concat(CASE WHEN event_id % 5 = 0 THEN ' ' ELSE '' END, 'S', CAST(user_id AS STRING),"
    " CASE WHEN event_id % 7 = 0 THEN '  ' ELSE '' END) AS sensor_id",
    "concat('F', CAST(event_id % 27 AS STRING), CASE WHEN event_id % 6 = 0 THEN ' ' ELSE '' END)"
    " AS farm_id",
    "concat('P', CAST(event_id % 9 AS STRING)) AS field_id",
    "CASE WHEN event_id % 41 = 0 THEN 'bad-date' ELSE concat("
    + _PADDED.format(part="day") + ", '-', " + _PADDED.format(part="month")
    + ", '-', CAST(year(ts) AS STRING), ' ', " + _PADDED.format(part="hour") + ", ':', "
    + _PADDED.format(part="minute") + ") END AS timestamp",
    "CASE WHEN event_id % 97 = 0 THEN 'ERR' WHEN event_id % 89 = 0 THEN ''"
    " ELSE CAST(floor(value * 4) / 4 - 10.0e0 AS STRING) END AS temperature",
    "CAST(CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS DOUBLE) * 1.0625e0 AS STRING)"
    " AS humidity",
    "CAST((event_id * 7 + user_id) % 105 AS STRING) AS soil_moisture",
    "CASE WHEN event_id % 83 = 0 THEN NULL ELSE CAST(CAST(event_id % 13 AS DOUBLE) - 0.5e0 AS STRING)"
    " END AS rainfall",
    "CAST((event_id + user_id * 3) % 104 AS STRING) AS battery",
)

RAW_SCHEMA = (
    "reading_id BIGINT, sensor_id STRING, farm_id STRING, field_id STRING, timestamp STRING,"
    " temperature STRING, humidity STRING, soil_moisture STRING, rainfall STRING, battery STRING"
)

# Customers in good standing have a registered sensor; the others' readings fail the check.
REGISTERED = "c_acctbal >= 0"

# Sensors in an error state send a reading twice, the second time with a corrected temperature.
RESENT = "event_type = 'error'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*READINGS)


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*RAW_READINGS)


def sensor_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").filter(REGISTERED).selectExpr("c_custkey AS sensor_id")


def farms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS farm_id", "n_name AS farm_name", "n_regionkey AS region_id"
    )


def resent_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings once, and those sent again a second time."""
    columns = ["reading_id", "sensor_id", "farm_id", "timestamp", "temperature"]
    events = table(spark, sf_dir, "events")
    first = events.selectExpr(*READINGS).select(*columns, F.lit(1).alias("ingest_seq"))
    second = events.filter(RESENT).selectExpr(*READINGS).select(
        *columns[:-1], (F.col("temperature") + 0.25).alias("temperature"), F.lit(2).alias("ingest_seq")
    )
    return first.unionAll(second)
