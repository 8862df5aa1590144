"""Catalog tables over Parquet: full refresh, refresh of partitions, rewrite, evolving append, census.

A full refresh writes a new folder, registers it under a name of its own and then gives it the
table's name. A failed write or a schema that the catalog refuses leaves the old table in place, a
table can be rewritten from itself, and the files of earlier versions stay until the lake's
housekeeping removes them. Dropping the old name and renaming takes two catalog calls, so a reader
can miss the table between them; there is no transaction log here. A refresh of partitions keeps
the name and every file of the other partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.sources import shared

DAY = "_day"  # ending of the column that a table of identities is partitioned by
CENSUS = "table_name string, record_count long, error string"


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> str:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")
    return schema


def _columns(df: DataFrame, without: Sequence[str] = ()) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in without)


def _version(spark: SparkSession, table: str) -> tuple[str, str]:
    """A name and a folder for a new version of the table."""
    schema, name = table.rsplit(".", 1)
    version = uuid.uuid4().hex[:12]
    return f"{schema}.{name}_{version}", f"{spark.catalog.getDatabase(schema).locationUri}/{name}/{version}"


def _renamed(spark: SparkSession, fresh: str, table: str) -> DataFrame:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    return spark.table(table)


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Full refresh; rows and schema of the table become those of the frame.

    Partitioned output is rebalanced first: a large partition value goes to several files, and
    small ones are not scattered over a file per task. The new version is written and registered
    under a name of its own; only when that has worked does it take the table's name.
    """
    return _replaced(df, table, partition_by)


def _replaced(df: DataFrame, table: str, partition_by: Sequence[str], watch: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    fresh, path = _version(df.sparkSession, table)
    frame = watch(df.hint("rebalance", *partition_by) if partition_by else df)
    frame.write.format("parquet").option("path", path).partitionBy(*partition_by).saveAsTable(fresh)
    return _renamed(df.sparkSession, fresh, table)


def replace_table_measured(
    df: DataFrame, table: str, metrics: Mapping[str, Column], partition_by: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, Any]]:
    """``replace_table``, and aggregates of the rows that were written, observed by the same job.

    They are observed in the tasks that write, after any shuffle: the rows of a task count when it has
    ended, so tasks that are tried again do not count twice.
    """
    seen = Observation()
    stored = _replaced(df, table, partition_by, lambda rows: rows.observe(seen, *(m.alias(n) for n, m in metrics.items())))
    return stored, seen.get


def location(spark: SparkSession, table: str) -> str:
    """The folder of a table's files."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first().data_type


def register_folder(spark: SparkSession, table: str, path: str, schema: T.StructType) -> DataFrame:
    """Give Parquet files that are already there the table's name, without copying them."""
    fresh, _ = _version(spark, table)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {fresh} ({columns}) USING parquet LOCATION '{path}'")
    return _renamed(spark, fresh, table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def refresh_partitions(df: DataFrame, table: str) -> DataFrame:
    """Replace the partitions that the frame has rows of, and no others.

    The frame is staged first, so it may be made from the table itself and a failure while it is computed
    changes nothing. The table keeps its name all the time, and the files of other partitions stay as
    they are. Partitions that the frame has no row of are not touched: to empty one, drop it.
    Columns are matched by name; the frame must have those of the table. An empty frame changes nothing.
    """
    spark = df.sparkSession
    columns = spark.table(table).columns
    partition_by = partition_columns(spark, table)
    if not partition_by:
        raise ValueError(f"{table} has no partitions; use replace_table")
    staged = shared.fresh_path(spark, "refresh")
    df.select(*columns).write.parquet(staged)
    rows = spark.read.schema(spark.table(table).schema).parquet(staged)
    into = rows.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    into.partitionBy(*partition_by).parquet(location(spark, table))
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")  # those that are new
    spark.catalog.refreshTable(table)
    return spark.table(table)


def rewrite_table(spark: SparkSession, table: str, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Replace a table by a function of itself."""
    return replace_table(change(spark.table(table)), table)


def day_of(value: Column) -> Column:
    """The day of a time as text; times are what most identities are near to each other in."""
    return F.coalesce(F.to_date(value).cast("string"), F.lit("none"))


def append_new(df: DataFrame, table: str, identity: Sequence[str], time: str | None = None) -> DataFrame:
    """Append the rows a table does not hold yet, adding columns it lacks.

    Rows with equal ``identity`` columns (NULLs too) are the same row, so a batch may be delivered
    again without doubling. Name every column that tells rows apart and no processing times.
    Rows inside one batch are all kept. Only the identity columns of the table are read. They are
    compared as one struct, in which NULLs are equal; the hash before it makes sorting cheap.

    With ``time``, one of the identity columns, the table is created with a partition for each day of it
    (column ``<time>_day``), and only the days that the batch has rows of are read: the cost follows the
    batch and not the history. The driver gets one short text for each day in the batch. A table that
    was created without such partitions is read whole.
    """
    spark = df.sparkSession
    if time is not None and time not in identity:
        raise ValueError(f"{time} is not part of the identity")
    by_day = time is not None
    if by_day:
        df = df.withColumn(f"{time}{DAY}", day_of(F.col(time)))
    if not spark.catalog.tableExists(table):
        return replace_table(df, table, [f"{time}{DAY}"] if by_day else [])
    added = _columns(df, without=spark.table(table).columns)
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    stored = spark.table(table)
    batch = stored.limit(0).unionByName(df, allowMissingColumns=True)
    if by_day and f"{time}{DAY}" in partition_columns(spark, table):
        stored = in_days(stored, f"{time}{DAY}", df)
    present = stored.select(
        F.xxhash64(*identity).alias("_hash"), F.struct(*identity).alias("_row")
    ).distinct()
    sought = [batch[name] for name in identity]
    same = (F.xxhash64(*sought) == present["_hash"]) & (F.struct(*sought) == present["_row"])
    fresh = batch.join(present, same, "left_anti")
    (fresh.hint("rebalance", f"{time}{DAY}") if by_day else fresh).write.insertInto(table)
    return spark.table(table)


def in_days(stored: DataFrame, day: str, batch: DataFrame) -> DataFrame:
    """Rows of the stored table in the days of the batch; a filter that the scan turns into folders to read."""
    days = [row[0] for row in batch.select(day).distinct().collect()]
    return stored.where(F.col(day).isin(days))


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {schema}")


def _problem(problem: Exception) -> str:
    if isinstance(problem, Py4JJavaError):  # failures of tasks that PySpark has no class for
        return problem.java_exception.getClass().getSimpleName()
    return problem.getCondition() or type(problem).__name__


def census(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Row count per table, or the error for a table that cannot be read.

    The catalog tells first which tables cannot be resolved; all others are counted by one plan, the
    union of one aggregate a table, in one job. If files of some table turn out to be unreadable, that
    job fails as a whole, and each table is counted alone to find which. One row a table reaches the driver.
    """
    label = lambda table: table.rsplit(".", 1)[-1]
    counts, errors = {}, {}
    for table in tables:
        try:
            counts[table] = spark.table(table).agg(F.lit(label(table)).alias("table_name"), F.count(F.lit(1)).alias("record_count"))
        except PySparkException as problem:
            errors[table] = _problem(problem)
    found: dict[str, int] = {}
    if counts:
        try:
            together = None
            for position, (table, count) in enumerate(counts.items()):
                numbered = count.withColumn("_position", F.lit(position))
                together = numbered if together is None else together.unionByName(numbered)
            names = list(counts)
            found = {names[row["_position"]]: row.record_count for row in together.collect()}
        except (PySparkException, Py4JJavaError):
            for table, count in counts.items():
                try:
                    found[table] = count.first().record_count
                except (PySparkException, Py4JJavaError) as problem:
                    errors[table] = _problem(problem)
    return spark.createDataFrame([(label(t), found.get(t), errors.get(t)) for t in tables], CENSUS)
