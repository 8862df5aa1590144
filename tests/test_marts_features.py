import datetime as dt

import pytest

from furrow.operators import features, marts

NOON = dt.datetime(2024, 1, 1, 12)
SCHEMA = (
    "reading_id int, farm_id string, sensor_id string, timestamp timestamp, temperature double,"
    " humidity double, soil_moisture double, rainfall double, battery double"
)


def readings(spark, *changes):
    base = dict(farm_id="f", sensor_id="s", timestamp=NOON, temperature=20.0, humidity=50.0,
                soil_moisture=50.0, rainfall=0.0, battery=90.0)
    data = [(i, *(base | change).values()) for i, change in enumerate(changes)]
    return spark.createDataFrame(data, SCHEMA)


def at(minutes):
    return NOON + dt.timedelta(minutes=minutes)


def test_daily_status_reads_the_rounded_mean(spark):
    (row,) = marts.farm_daily_metrics(readings(spark, dict(temperature=39.996))).collect()
    assert row.avg_temperature == 40.0 and row.temperature_status == "HIGH"


def test_daily_irrigation_reads_mean_soil_and_total_rain(spark):
    dry = dict(soil_moisture=10.0, rainfall=1.0)
    metrics = marts.farm_daily_metrics(readings(spark, dry, dry | {"sensor_id": "t"}))
    (row,) = metrics.collect()
    assert (row.total_rainfall, row.irrigation_required, row.soil_status) == (2.0, "NO", "LOW")
    assert (row.total_readings, row.active_sensors) == (2, 2)
    assert marts.PROCESSED in metrics.columns


def test_sensor_health_prefers_the_minimum(spark):
    (row,) = marts.sensor_health(readings(spark, dict(battery=10.0), dict(battery=90.0))).collect()
    assert (row.sensor_health, row.min_battery, row.avg_battery) == ("LOW_BATTERY", 10.0, 50.0)


def test_alerts_push_the_rule_into_the_scan(spark, tmp_path):
    frame = readings(spark, dict(soil_moisture=29.0, rainfall=1.0), dict(soil_moisture=30.0), dict(soil_moisture=None))
    frame.write.parquet(f"file://{tmp_path}/r")
    alerts = marts.irrigation_alerts(spark.read.parquet(f"file://{tmp_path}/r"))
    (row,) = alerts.collect()
    assert (row.soil_moisture, row.alert_status, row.soil_status) == (29.0, "IRRIGATION_ALERT", "LOW")
    plan = alerts._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(soil_moisture,30.0)" in plan and "LessThan(rainfall,2.0)" in plan


def test_trend_counts_missing_values_as_zero(spark):
    frame = readings(
        spark, dict(temperature=10.0), dict(temperature=20.0, timestamp=at(1)),
        dict(temperature=None, timestamp=at(2)), dict(temperature=50.0, timestamp=at(3), sensor_id="t"),
    )
    s, t = marts.environment_trend(frame).orderBy("sensor_id").collect()
    assert s.avg_temperature == 10.0  # (10 + 20 + 0) / 3
    assert s.avg_temperature_change == 3.33  # (0 + 10 + 0) / 3
    assert s.three_reading_temperature_avg == 13.33  # (10 + 15 + 15) / 3
    assert (s.daily_temperature_avg, s.daily_temperature_min, s.daily_temperature_max) == (26.67, 10.0, 50.0)
    assert t.daily_temperature_avg == 26.67 and t.reading_date == NOON.date()


def test_trend_keeps_rows_without_time_or_farm(spark):
    frame = readings(spark, dict(timestamp=None, farm_id=None, temperature=None))
    (row,) = marts.environment_trend(frame).collect()
    assert (row.farm_id, row.reading_date, row.daily_temperature_avg) == ("UNKNOWN", dt.date(1900, 1, 1), 0.0)


def test_irrigation_features(spark):
    frame = readings(
        spark, dict(temperature=10.0, humidity=40.0, soil_moisture=20.0, rainfall=1.0),
        dict(temperature=16.0, humidity=50.0, soil_moisture=40.0, rainfall=3.0, timestamp=at(60)),
    )
    built = features.irrigation_features(frame)
    assert built.columns == [
        "reading_id", "sensor_id", "farm_id", "timestamp", *features.IRRIGATION_FEATURES, "irrigation_label"]
    assert len(features.IRRIGATION_FEATURES) == 19 and len(features.MOISTURE_FEATURES) == 13
    first, second = built.orderBy("reading_id").collect()
    assert (first.soil_moisture_deficit, first.temperature_change, first.irrigation_label) == (10.0, 0.0, 1)
    assert (second.soil_moisture_deficit, second.temperature_change, second.irrigation_label) == (0.0, 6.0, 0)
    assert second.temperature_humidity_difference == 34.0 and second.temperature_rolling_avg == 13.0
    assert (second.reading_hour, second.day_of_week, second.month, second.day_of_month) == (13, 2, 1, 1)


def test_next_moisture(spark):
    frame = readings(spark, *(dict(soil_moisture=float(i), timestamp=at(30 * i)) for i in range(5)))
    built = features.next_moisture_features(frame)
    (row,) = features.next_moisture_dataset(built).collect()
    assert (row.soil_moisture, row.soil_moisture_lag_3, row.soil_moisture_rolling_avg_3) == (3.0, 0.0, 1.0)
    assert row.next_hour_soil_moisture == 4.0 and row.hour == 13
    hourly = features.next_moisture_features(features.farm_hour_means(frame)).orderBy("timestamp").collect()
    assert [(r.soil_moisture, r.next_hour_soil_moisture) for r in hourly] == [(0.5, 2.5), (2.5, 4.0), (4.0, None)]
    with pytest.raises(ValueError):
        features.next_moisture_features(frame.drop("battery"))
