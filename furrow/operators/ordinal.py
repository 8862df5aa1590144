"""Global row order without a single-partition window, and the chronological split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def write_in_order(df: DataFrame, order: Sequence[str], path: str) -> None:
    """Write the rows in the given order, which must be unique, each with its position.

    Range partitioning on the order itself gives even partitions whatever the skew. The position
    inside the sorted partition is stored, so later readers and retried tasks all see one order.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn("_position", F.monotonically_increasing_id()).write.parquet(path)


def written_part() -> Column:
    """The partition of ``write_in_order`` a row was written in; parts follow the order."""
    return F.shiftright("_position", _LOCAL_BITS)


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``write_in_order`` with ``ordinal`` = 1..n.

    Offsets come from one count per written partition; that side has one row per partition, which
    bounds its single-task running sum and its broadcast.
    """
    written = spark.read.parquet(path)
    rows = written.withColumn("_part", written_part())
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = F.col("_position").bitwiseAND((1 << _LOCAL_BITS) - 1)
    kept = [name for name in written.columns if name != "_position"]
    return rows.join(F.broadcast(offsets), "_part").select(
        *kept, (F.col("_offset") + inside + 1).alias("ordinal")
    )


def with_ordinal(df: DataFrame, order: Sequence[str], staging: str) -> DataFrame:
    """Add ``ordinal`` = 1..n in the given unique order, through files at ``staging``."""
    write_in_order(df, order, staging)
    return read_numbered(df.sparkSession, staging)


def chronological_split(
    df: DataFrame,
    staging: str,
    train_share: float = 0.8,
    min_rows: int = 10,
    time: str = "timestamp",
    tie_break: str = "reading_id",
) -> DataFrame:
    """Add ``split``: ``train`` for the earliest share of the rows, ``test`` for the rest.

    The last training row is found without ordering everything: counts per hour tell the hour it
    falls in, and only that hour is put in order. The running sum has one row per hour.
    """
    hour = F.floor(F.unix_seconds(time) / 3600).alias("hour")
    in_order = Window.orderBy("hour")
    everything = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = df.groupBy(hour).count().withColumns({
        "total": F.sum("count").over(everything), "up_to": F.sum("count").over(in_order),
    })
    last_train = F.floor(F.col("total") * train_share)
    found = counts.filter(F.col("up_to") >= last_train).orderBy("hour").first()
    total = found["total"] if found else 0
    if total < min_rows:
        raise ValueError(f"not enough rows to train: {total}, at least {min_rows} needed")

    if int(total * train_share) == 0:
        return df.withColumn("split", F.lit("test"))
    rank = int(total * train_share) - (found["up_to"] - found["count"])
    same_hour = df.filter(hour.eqNullSafe(F.lit(found["hour"]))).select(time, tie_break)
    numbered = with_ordinal(same_hour, [time, tie_break], staging)
    last = numbered.filter(F.col("ordinal") == rank).select(F.unix_micros(time).alias("at"), tie_break).first()
    last_time = F.timestamp_micros(F.lit(last["at"]).cast("bigint"))
    same_time = F.col(time).eqNullSafe(last_time) & (F.col(tie_break) <= F.lit(last[tie_break]))
    missing_first = F.col(time).isNull() if last["at"] is not None else F.lit(False)
    up_to_last = missing_first | (F.col(time) < last_time) | same_time
    return df.withColumn("split", F.when(up_to_last, "train").otherwise("test"))
