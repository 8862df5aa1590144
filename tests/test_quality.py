import datetime as dt

from furrow.functions import rules
from furrow.operators import quality
from pyspark.sql import functions as F

SCHEMA = (
    "reading_id int, sensor_id string, farm_id string, field_id string, timestamp timestamp,"
    " temperature double, humidity double, soil_moisture double, rainfall double, battery double"
)
NOW = dt.datetime(2024, 1, 1, 12)
GOOD = ("s1", "f1", "p1", NOW, 20.0, 50.0, 50.0, 0.0, 90.0)


def readings(spark, *changes):
    names = ["sensor_id", "farm_id", "field_id", "timestamp", *rules.MEASURES]
    data = [(i, *(change.get(n, v) for n, v in zip(names, GOOD))) for i, change in enumerate(changes)]
    return spark.createDataFrame(data, SCHEMA)


def registry(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "sensor_id string")


def test_reasons_in_fixed_order(spark):
    broken = dict(sensor_id="s9", timestamp=None, temperature=99.0, humidity=-1.0, soil_moisture=101.0,
                  rainfall=-1.0, battery=None)
    checked = quality.validate(readings(spark, {}, broken), registry(spark, "s1")).orderBy("reading_id")
    good, bad = checked.collect()
    assert good.is_valid and good.invalid_reason == ""
    assert not bad.is_valid
    assert bad.invalid_reason == (
        "INVALID_SENSOR_ID; INVALID_TIMESTAMP; INVALID_TEMPERATURE_RANGE; INVALID_HUMIDITY_RANGE;"
        " INVALID_SOIL_MOISTURE_RANGE; INVALID_RAINFALL; INVALID_BATTERY_RANGE"
    )


def test_split_is_complete_and_repeated_master_rows_do_not_multiply(spark):
    frame = readings(spark, {}, {"sensor_id": None}, {"sensor_id": "s2"}, {"battery": None})
    checked = quality.validate(frame, registry(spark, "s1", "s1", "s1", None))
    valid, invalid = quality.valid_rows(checked), quality.invalid_rows(checked)
    assert checked.count() == 4 and valid.count() == 1 and invalid.count() == 3
    summary = quality.quality_summary(checked).first()
    assert tuple(summary) == (1, 3, 4)
    assert {r.quarantine_status for r in invalid.collect()} == {"QUARANTINED"}


def test_untrimmed_master_id_does_not_match(spark):
    checked = quality.validate(readings(spark, {}), registry(spark, " s1"))
    assert not checked.first().sensor_id_valid


def test_null_handling_covers_all_rows(spark):
    frame = readings(spark, {}, {"field_id": None}, {"rainfall": None, "battery": None})
    kept, missing = quality.required_present(frame), quality.null_quarantine(frame)
    assert kept.count() == 1 and missing.count() == 2
    assert {r.invalid_reason for r in missing.collect()} == {rules.NULL_REASON}


def test_nan_is_missing_everywhere(spark):
    nan = float("nan")
    frame = readings(spark, {}, *({name: nan} for name in rules.MEASURES))
    kept, rejected = quality.required_present(frame), quality.null_quarantine(frame)
    assert kept.count() == 1 and rejected.count() == len(rules.MEASURES)
    assert all(quality.null_profile(frame).first()[name] == 1 for name in rules.MEASURES)
    assert quality.valid_rows(quality.validate(frame, registry(spark, "s1"))).count() == 1


def test_fill_by_type(spark):
    frame = readings(spark, dict.fromkeys(["sensor_id", "timestamp", "rainfall"])).withColumn(
        "flag", F.lit(None).cast("boolean"))
    row = quality.fill_by_type(frame, time=F.lit("2000-01-01").cast("timestamp")).first()
    assert (row.sensor_id, row.rainfall, row.timestamp) == ("UNKNOWN", 0.0, dt.datetime(2000, 1, 1))
    assert row.flag is None
    assert quality.fill_by_type(frame).first().timestamp is None
    assert quality.fill_by_type(frame, time=F.current_timestamp()).first().timestamp is not None


def test_null_profile_and_counts(spark):
    frame = readings(spark, {}, {"humidity": None}, {"humidity": None})
    assert quality.null_profile(frame).first().humidity == 2
    assert [tuple(r) for r in quality.value_counts(frame, "farm_id").collect()] == [("f1", 3)]
