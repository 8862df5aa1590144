"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

READING_KEY = ("sensor_id", "farm_id", "timestamp")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key group under ``order``.

    Spark turns the rank filter into a group limit that runs before the shuffle as well, so a
    key with very many copies sends one row per map task. The keys are ranked as one struct:
    given single columns, Spark would reuse a partitioning on a part of them, such as that of
    an earlier join on the sensor, and so keep a large sensor's rows in one task. The hash before
    it makes sorting cheap.
    """
    ranked = Window.partitionBy(F.xxhash64(*keys), F.struct(*keys)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def latest_reading(
    readings: DataFrame,
    keys: Sequence[str] = READING_KEY,
    ingested: str = "_ingestion_timestamp",
    tie_break: str = "reading_id",
) -> DataFrame:
    return keep_first(readings, keys, [F.col(ingested).desc_nulls_last(), F.col(tie_break)])


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).dropDuplicates()
