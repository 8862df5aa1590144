"""Helpers of the text operators: tables, written steps, batch sizes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.sources.shared import fresh_path

ROWS_PER_BATCH = 512  # texts handed to Python at once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand few texts at a time to Python workers, so that a batch of long ones fits in memory.

    This is a session setting; a smaller value that the user has set stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    current = int(spark.conf.get(key, "10000"))
    if current <= 0 or current > ROWS_PER_BATCH:
        spark.conf.set(key, str(ROWS_PER_BATCH))


def per_batch(frame: DataFrame, convert: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""
    small_batches(frame.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield convert(batch)

    return frame.mapInArrow(run, schema)


def written(frame: DataFrame, name: str) -> DataFrame:
    """Write to the folder that all executors share and read back; this cuts the lineage."""
    path = fresh_path(frame.sparkSession, f"llm-{name}")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def packed(frame: DataFrame) -> DataFrame:
    """The row as one column ``row``, so that no column of the user can clash with one that an operator adds."""
    return frame.select(F.struct(*(F.col(f"`{name}`") for name in frame.columns)).alias("row"))


def unpacked(frame: DataFrame, names: list[str], **changed: Column) -> DataFrame:
    """The columns of a packed row again, some of them replaced and others added."""
    kept = [changed.pop(name).alias(name) if name in changed else F.col(f"row.`{name}`").alias(name) for name in names]
    return frame.select(*kept, *(value.alias(name) for name, value in changed.items()))


def with_fields(frame: DataFrame, **types: str) -> str:
    """The schema of ``frame`` and further columns, as DDL."""
    own = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    return own + "".join(f", {name} {kind}" for name, kind in types.items())


def fold(doc_id: str = "doc_id", parts: int = 4):
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts
