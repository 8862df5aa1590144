import pytest
from pyspark.sql import functions as F

from furrow.operators import dedup
from furrow.operators.enrich import enrich


def test_latest_wins_and_missing_load_time_loses(spark, rows):
    data = [(1, "s", "f", 1, 10), (2, "s", "f", 1, 20), (3, "s", "f", 1, None), (4, "s", "f", 2, None)]
    df = spark.createDataFrame(data, "reading_id int, sensor_id string, farm_id string, timestamp int, seq int")
    assert rows(dedup.latest_reading(df, ingested="seq"), "reading_id") == [(2,), (4,)]


def test_equal_load_times_keep_the_smallest_id(spark, rows):
    data = [(i, "s", "f", 1, 10) for i in (5, 3, 9)]
    df = spark.createDataFrame(data, "reading_id int, sensor_id string, farm_id string, timestamp int, seq int")
    assert rows(dedup.latest_reading(df, ingested="seq"), "reading_id") == [(3,)]


def test_copies_are_cut_before_the_shuffle(spark):
    """A third of all rows may be copies of one key: the limit must run on the map side too."""
    same = F.floor(F.col("id") / 1000)
    df = spark.range(1000).select(
        F.col("id").alias("reading_id"), same.alias("sensor_id"), same.alias("farm_id"),
        same.alias("timestamp"), F.col("id").alias("seq"))
    latest = dedup.latest_reading(df, ingested="seq")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert [r.reading_id for r in latest.collect()] == [999]


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, None, "x")], "id int, farm_id string, src string")


def test_unmatched_and_repeated_keys_keep_the_row_count(spark, facts, rows):
    farms = spark.createDataFrame([("a", "B"), ("a", "A"), ("z", "Z"), (None, "N")], "farm_id string, name string")
    assert rows(enrich(facts, farms, "farm_id"), "id", "name") == [(1, "A"), (2, None), (3, None)]


def test_collisions(spark, facts):
    farms = spark.createDataFrame([("a", "f", "n")], "farm_id string, src string, name string")
    prefixed = enrich(facts, farms, "farm_id")
    assert prefixed.columns == ["id", "farm_id", "src", "farm_src", "name"]
    skipped = enrich(facts, farms, "farm_id", on_collision="skip")
    assert skipped.columns == ["id", "farm_id", "src", "name"]
    assert enrich(skipped, farms, "farm_id", on_collision="skip") is skipped
    with pytest.raises(ValueError):
        enrich(prefixed.withColumn("farm_name", F.lit(1)), farms, "farm_id")


def test_rows_are_spread_by_the_whole_key_after_a_join(spark):
    """A join partitioned by sensor must not let one sensor's rows all be ranked in one task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).select(
            F.col("id").alias("reading_id"), F.floor(F.col("id") / 100).alias("sensor_id"),
            F.col("id").alias("farm_id"), F.col("id").alias("timestamp"), F.col("id").alias("seq"))
        joined = df.join(df.select("sensor_id").distinct(), "sensor_id")
        latest = dedup.latest_reading(joined, ingested="seq")
        plan = latest._jdf.queryExecution().executedPlan().toString()
        assert latest.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above_join = plan.split("SortMergeJoin")[0]
    assert "Exchange hashpartitioning(_w0" in above_join and above_join.count("WindowGroupLimit") == 2
