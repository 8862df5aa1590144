"""Series columns: small cases, and the cut form against the plain window."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from furrow.operators import series
from furrow.operators.series import Cut, along, at_distance, by_distance, lag, lead, mean_within, trailing_mean

START = dt.datetime(2024, 1, 1)
SCHEMA = "reading_id int, sensor_id string, timestamp timestamp, x double"
COLUMNS = {
    "one": lag("x"), "three": lag("x", 3), "next": lead("x"), "incl": trailing_mean("x"),
    "excl": trailing_mean("x", -3, -1),
}


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def in_order(df, *names):
    return [tuple(r) for r in df.orderBy("sensor_id", "timestamp", "reading_id").select(*names).collect()]


def test_small_histories(spark):
    data = [(i, "four", START + dt.timedelta(hours=i), float(i)) for i in range(4)]
    data += [(10 + i, "two", START + dt.timedelta(hours=i), float(i)) for i in range(2)]
    data += [(20, "one", START, 7.0)]
    found = in_order(along(frame(spark, data), ["sensor_id"], COLUMNS), "sensor_id", *COLUMNS)
    assert found == [
        ("four", None, None, 1.0, 0.0, None),
        ("four", 0.0, None, 2.0, 0.5, 0.0),
        ("four", 1.0, None, 3.0, 1.0, 0.5),
        ("four", 2.0, 0.0, None, 2.0, 1.0),
        ("one", None, None, None, 7.0, None),
        ("two", None, None, 1.0, 0.0, None),
        ("two", 0.0, None, None, 0.5, 0.0),
    ]


def test_equal_times_follow_the_tie_break(spark):
    data = [(3, "s", START, 3.0), (1, "s", START, 1.0), (2, "s", START, 2.0)]
    assert in_order(along(frame(spark, data), ["sensor_id"], {"p": lag("x")}), "reading_id", "p") == [
        (1, None), (2, 1.0), (3, 2.0)]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    points=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 6 * 24 * 4)), min_size=1, max_size=60),
    unit=st.sampled_from(["minute", "hour", "day", "month", None]),
    columns=st.sampled_from([
        COLUMNS, {"one": lag("x")}, {"next": lead("x")}, {"excl": trailing_mean("x", -3, -1)},
        {"far": lead("x", 2), "one": lag("x")},
    ]),
    only_a=st.booleans(),
)
def test_cut_equals_plain(spark, points, unit, columns, only_a):
    data = [(i, s, START + dt.timedelta(minutes=15 * m), float(i)) for i, (s, m) in enumerate(points)]
    df = frame(spark, data)
    large = spark.createDataFrame([("a",)], "sensor_id string") if only_a else None
    plain = along(df, ["sensor_id"], columns, cut=None)
    cut = along(df, ["sensor_id"], columns, cut=Cut(unit, large))
    assert cut.columns == plain.columns
    assert in_order(cut, *cut.columns) == in_order(plain, *cut.columns)


def test_cut_keeps_every_row_when_the_order_is_ambiguous(spark):
    """Equal sort keys and missing times: no row may be lost or doubled."""
    data = [(1, "s", START, float(i)) for i in range(50)] + [(1, None, None, float(i)) for i in range(50)]
    data += [(1, "s", START + dt.timedelta(days=1), float(i)) for i in range(50)]
    df = frame(spark, data)
    for unit in ("hour", None):
        cut = along(df, ["sensor_id"], COLUMNS, cut=Cut(unit))
        assert df.exceptAll(cut.select(*df.columns)).isEmpty() and cut.count() == df.count()


def skewed(spark):
    """One sensor holds a third of the rows, over ten days; 200 others share the rest."""
    return spark.range(6000).select(
        F.col("id").cast("int").alias("reading_id"),
        F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 200).cast("string")))
        .alias("sensor_id"),
        F.timestamp_seconds(F.lit(1704067200) + (F.col("id") * 7919 % 14400) * 60).alias("timestamp"),
        (F.col("id") % 97).cast("double").alias("x"),
    )


def test_fitting_cut_finds_the_hot_entity_and_unit(spark):
    df = skewed(spark)
    assert series.fitting_cut(df, ["sensor_id"], limit=2000) is None
    daily = series.fitting_cut(df, ["sensor_id"], limit=300)
    assert daily.unit == "day" and [r.sensor_id for r in daily.large.collect()] == ["hot"]
    hours = F.timestamp_seconds(F.lit(1704067200) + F.col("reading_id") % 3 * 3600 + F.col("reading_id") % 50)
    burst = df.withColumn("timestamp", hours)
    assert series.fitting_cut(burst, ["sensor_id"], limit=900).unit == "hour"


def test_short_units_must_not_leave_too_many_edges(spark):
    """A steady history with one burst: cutting at the burst's unit would make every row an edge."""
    df = spark.range(5000).select(
        F.col("id").alias("reading_id"), F.lit("s").alias("sensor_id"),
        F.timestamp_seconds(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") * 60)).alias("timestamp"))
    assert series.fitting_cut(df, ["sensor_id"], limit=1000).unit is None


def test_hot_entity_is_split_and_equal(spark):
    df = skewed(spark)
    df.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/skewed")
    stored = spark.read.parquet(path)
    cut = along(stored, ["sensor_id"], COLUMNS, cut=series.fitting_cut(stored, ["sensor_id"], limit=300))
    plain = along(stored, ["sensor_id"], COLUMNS)
    assert in_order(cut, *cut.columns) == in_order(plain, *cut.columns)
    cut.collect()
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_one_instant_is_split_as_well(spark):
    """All rows of the large entity share one time; only ranges of the whole order can split it."""
    at = F.when(F.col("sensor_id") == "hot", F.timestamp_seconds(F.lit(0))).otherwise(F.col("timestamp"))
    df = skewed(spark).withColumn("timestamp", at)
    found = series.fitting_cut(df, ["sensor_id"], limit=300)
    assert found.unit is None and found.large.count() == 1
    cut, plain = along(df, ["sensor_id"], COLUMNS, cut=found), along(df, ["sensor_id"], COLUMNS, cut=None)
    assert in_order(cut, *cut.columns) == in_order(plain, *cut.columns)


def test_only_rows_of_large_entities_are_staged(spark, monkeypatch):
    staged = []
    write = series.write_in_order
    monkeypatch.setattr(series, "write_in_order", lambda df, *rest: (staged.append(df.count()), write(df, *rest)))
    df = skewed(spark).withColumn("timestamp", F.timestamp_seconds(F.lit(0)))
    cut = along(df, ["sensor_id"], COLUMNS, cut=300)
    assert staged == [2000] and cut.count() == 6000


def test_empty_frame(spark):
    empty = frame(spark, [])
    assert series.fitting_cut(empty, ["sensor_id"]) is None
    for unit in ("day", None):
        assert along(empty, ["sensor_id"], COLUMNS, cut=Cut(unit)).count() == 0


def test_group_stats_equals_the_window(spark):
    data = [(i, s, START, x) for i, (s, x) in enumerate([("a", 1.0), ("a", None), (None, 2.0), (None, 4.0), ("b", None)])]
    df = frame(spark, data)
    window = Window.partitionBy("sensor_id")
    expected = df.withColumns({"m": F.avg("x").over(window), "n": F.min("x").over(window)})
    found = series.group_stats(df, ["sensor_id"], {"m": F.avg("x"), "n": F.min("x")})
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_rounded_trend(spark):
    data = [(1, "s", START, 1.005), (2, "s", START + dt.timedelta(minutes=1), 2.0)]
    df = frame(spark, data).withColumnRenamed("x", "temperature")
    trend = series.temperature_trend(df, ["sensor_id"], rounded=True)
    assert in_order(trend, "temperature_change", "`3_reading_average`") == [(None, 1.01), (1.0, 1.5)]
    with pytest.raises(Exception):
        along(df, ["sensor_id"], {"p": lag("missing")}).collect()


DISTANT = {"hour_ahead": at_distance("x", 3600), "hour_back": at_distance("x", -3600), "day": mean_within("x", -86400, -1),
           "around": mean_within("x", -900, 900)}


def by_hand(data, columns=((3600, 3600), (-3600, -3600), (-86400, -1), (-900, 900))):
    out = []
    for i, s, t, _ in data:
        means = []
        for first, last in columns:
            seen = [y for _, o, u, y in data if o == s and t and u and first <= (u - t).total_seconds() <= last]
            means.append(pytest.approx(sum(seen) / len(seen)) if seen else None)
        out.append((i, *means))
    return sorted(out, key=lambda row: row[0])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    points=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 4 * 24 * 3)), min_size=1, max_size=40),
    segment=st.sampled_from([None, 1, 86400, 100_000]), missing=st.booleans(),
)
def test_frames_by_time_equal_brute_force(spark, points, segment, missing):
    data = [(i, s, START + dt.timedelta(minutes=15 * m), float(i)) for i, (s, m) in enumerate(points)]
    data += [(900, "a", None, 5.0), (901, "a", None, 6.0)] if missing else []
    found = by_distance(frame(spark, data), ["sensor_id"], DISTANT, segment=segment)
    assert found.columns == ["reading_id", "sensor_id", "timestamp", "x", *DISTANT]
    assert sorted(tuple(r) for r in found.select("reading_id", *DISTANT).collect()) == by_hand(data)


def test_hot_entity_by_time_is_spread(spark):
    """A third of the rows belong to one sensor; its segments go to several tasks and borrow few rows."""
    df = skewed(spark)
    cut, plain = (by_distance(df, ["sensor_id"], DISTANT, segment=s) for s in (86400, None))
    assert in_order(cut, *cut.columns) == in_order(plain, *cut.columns)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "_segment" in plan and plan.count("Window ") == 1


def test_by_time_of_nothing(spark):
    assert by_distance(frame(spark, []), ["sensor_id"], DISTANT).count() == 0
