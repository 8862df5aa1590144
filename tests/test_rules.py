import pytest

from furrow.functions import rules


def flags(spark, check, values, kind="double"):
    data = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, f"i int, {check.field} {kind}")
    return [r[0] for r in df.orderBy("i").select(check.column()).collect()]


@pytest.mark.parametrize("field, values, expected", [
    ("temperature", [-10.0, 60.0, -10.01, 60.01, None, float("nan")], [True, True, False, False, False, False]),
    ("humidity", [0.0, 100.0, -0.01, 100.01, None], [True, True, False, False, False]),
    ("soil_moisture", [0.0, 100.0, -0.01, 100.01, None], [True, True, False, False, False]),
    ("battery", [0.0, 100.0, -0.01, 100.01, None], [True, True, False, False, False]),
    ("rainfall", [0.0, -0.01, 1e6, None], [True, False, True, False]),
])
def test_bounds(spark, field, values, expected):
    (check,) = [c for c in rules.VALUE_CHECKS if c.field == field]
    assert flags(spark, check, values) == expected


def test_presence(spark):
    (check,) = [c for c in rules.VALUE_CHECKS if c.field == "timestamp"]
    assert flags(spark, check, ["x", None], "string") == [True, False]


@pytest.mark.parametrize("ladder, values, expected", [
    (rules.TEMPERATURE_STATUS, [5.0, 5.01, 39.99, 40.0, None], ["LOW", "NORMAL", "NORMAL", "HIGH", "NORMAL"]),
    (rules.SOIL_STATUS, [29.99, 30.0, 80.0, 80.01, None], ["LOW", "NORMAL", "NORMAL", "HIGH", "NORMAL"]),
    (rules.HUMIDITY_STATUS, [29.99, 30.0, 80.0, 80.01, None], ["LOW", "NORMAL", "NORMAL", "HIGH", "NORMAL"]),
    (rules.SENSOR_HEALTH, [19.99, 20.0, 49.99, 50.0, None],
     ["LOW_BATTERY", "WARNING", "WARNING", "HEALTHY", "HEALTHY"]),
    (rules.PREDICTED_IRRIGATION, [29.99, 30.0, None], ["YES", "NO", "NO"]),
])
def test_ladders(spark, ladder, values, expected):
    column = ladder.rungs[0].conditions[0][0]
    df = spark.createDataFrame(list(enumerate(values)), f"i int, {column} double").orderBy("i")
    assert [r[0] for r in df.select(ladder.named()).collect()] == expected


def test_irrigation_vocabularies(spark):
    data = [(1, 29.99, 1.99), (2, 30.0, 1.99), (3, 29.99, 2.0), (4, None, 0.0), (5, 0.0, None)]
    df = spark.createDataFrame(data, "i int, soil_moisture double, rainfall double").orderBy("i")
    read = lambda ladder: [r[0] for r in df.select(ladder.column()).collect()]
    assert read(rules.IRRIGATION_YES_NO) == ["YES", "NO", "NO", "NO", "NO"]
    assert read(rules.IRRIGATION_LABEL) == [1, 0, 0, 0, 0]
    assert read(rules.IRRIGATION_TEXT)[:2] == ["IRRIGATION_REQUIRED", "NO_IRRIGATION_REQUIRED"]


def test_summary_health_reads_minimum_then_mean(spark):
    data = [(1, 19.0, 90.0), (2, 20.0, 49.0), (3, 20.0, 50.0)]
    df = spark.createDataFrame(data, "i int, min_battery double, avg_battery double").orderBy("i")
    assert [r[0] for r in df.select(rules.SENSOR_HEALTH_SUMMARY.column()).collect()] == [
        "LOW_BATTERY", "WARNING", "HEALTHY"]
