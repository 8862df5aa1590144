import datetime as dt

import pytest
from pyspark.errors import PySparkException

from furrow.functions.columns import round2, safe_double
from furrow.operators.clean import clean_readings, strict_measures, with_calendar
from pyspark.sql import functions as F

SCHEMA = (
    "reading_id int, sensor_id string, farm_id string, timestamp string, temperature string,"
    " humidity string, soil_moisture string, rainfall string, battery string"
)


def raw(spark, *texts, times=None):
    stamps = times or ["05-01-2024 10:30"] * len(texts)
    data = [(i, " s ", "f  ", ts, t, t, t, t, t) for i, (t, ts) in enumerate(zip(texts, stamps))]
    return spark.createDataFrame(data, SCHEMA)


def test_numbers(spark):
    texts = [" 12.5 ", "1e3", "12,5", "", "abc", "NaN", None]
    cleaned = clean_readings(raw(spark, *texts)).orderBy("reading_id").collect()
    assert [r.temperature for r in cleaned] == [12.5, 1000.0, None, None, None, None, None]
    assert all(r.temperature == r.battery for r in cleaned)


def test_ids_are_trimmed(spark):
    (row,) = clean_readings(raw(spark, "1")).collect()
    assert (row.sensor_id, row.farm_id) == ("s", "f")


def test_times(spark):
    good = "05-01-2024 10:30"
    bad = ["5-1-2024 10:30", "05-01-2024 10:30:15", "2024-01-05 10:30", "31-02-2024 01:00", " " + good, None]
    cleaned = clean_readings(raw(spark, *["1"] * 7, times=[good, *bad])).orderBy("reading_id").collect()
    assert [r.timestamp for r in cleaned] == [dt.datetime(2024, 1, 5, 10, 30), *[None] * 6]


def test_typed_time_passes_unchanged(spark):
    frame = raw(spark, "1").withColumn("timestamp", F.lit("2024-05-06 07:08:09").cast("timestamp"))
    assert clean_readings(frame).first().timestamp == dt.datetime(2024, 5, 6, 7, 8, 9)


def test_strict_cast_raises(spark):
    with pytest.raises(PySparkException):
        strict_measures(raw(spark, "abc")).collect()


def test_rounding_halves_go_away_from_zero(spark):
    data = [(1.005,), (2.675,), (0.285,), (-0.125,)]
    df = spark.createDataFrame(data, "x double").select(round2(F.col("x")))
    assert [r[0] for r in df.collect()] == [1.01, 2.68, 0.29, -0.13]


def test_sunday_is_day_one(spark):
    df = spark.sql("SELECT timestamp'2024-01-07 13:59:00' AS t")
    row = with_calendar(df, "t", month_day=True).first()
    assert (row.hour, row.day_of_week, row.month, row.day_of_month) == (13, 1, 1, 7)


def test_safe_double_keeps_numbers(spark):
    assert spark.sql("SELECT 1.5D AS x").select(safe_double("x")).first()[0] == 1.5
