import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from furrow.operators.ordinal import chronological_split, with_ordinal
from furrow.sources import shared


def events(spark, n):
    """Half of the rows share one time."""
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") * 7919 % 1000).alias("t")
    ).repartition(7)


def staged(spark, df):
    return with_ordinal(df, ["t", "id"], shared.fresh_path(spark, f"ordinal-{uuid.uuid4().hex}"))


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_equals_the_single_partition_window(spark, n):
    df = events(spark, n)
    expected = df.withColumn("ordinal", F.row_number().over(Window.orderBy("t", "id")).cast("bigint"))
    found = staged(spark, df)
    assert found.columns == ["id", "t", "ordinal"]
    assert found.exceptAll(expected).isEmpty() and found.count() == n


def test_one_value_is_spread_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = shared.fresh_path(spark, "spread")
        with_ordinal(events(spark, 20000).withColumn("t", F.lit(1)), ["t", "id"], path)
        sizes = spark.read.parquet(path).groupBy(F.shiftright("_position", 33)).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * 20000 / 8


def readings(spark, n, missing=0, step=1237, jam=0):
    """``n`` rows at scattered times; some without a time, some jammed into one instant."""
    seconds = F.when(F.col("id") < jam, 5000).otherwise(F.col("id") * step % 86400)
    return spark.range(n).select(
        (F.col("id") * 7919 % 100003).alias("reading_id"),
        F.when(F.col("id") >= missing, F.timestamp_seconds(seconds)).alias("timestamp"),
    ).repartition(5)


@pytest.mark.parametrize("n, missing, jam, share", [
    (101, 0, 0, 0.8), (10, 0, 0, 0.8), (1000, 0, 900, 0.5), (1000, 0, 900, 0.8), (1000, 300, 0, 0.8),
    (1000, 900, 0, 0.5), (997, 1, 331, 0.333), (10, 0, 0, 0.05), (50, 0, 0, 1.0),
])
def test_split_equals_the_ordinal(spark, n, missing, jam, share):
    df = readings(spark, n, missing, jam=jam)
    ordinal = F.row_number().over(Window.orderBy("timestamp", "reading_id"))
    expected = df.withColumn("split", F.when(ordinal <= int(n * share), "train").otherwise("test"))
    found = chronological_split(df, shared.fresh_path(spark, "border"), train_share=share)
    assert found.count() == n and found.exceptAll(expected).isEmpty()
    assert found.filter("split = 'train'").count() == int(n * share)


def test_too_few_rows(spark):
    for n in (0, 9):
        with pytest.raises(ValueError):
            chronological_split(readings(spark, n), shared.fresh_path(spark, "border"))
