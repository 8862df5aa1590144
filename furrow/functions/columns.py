"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def missing(df: DataFrame, name: str) -> Column:
    """NULL, and NaN in a column that can hold it."""
    absent = F.col(name).isNull()
    return absent | F.isnan(name) if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)) else absent


def round2(value: Column) -> Column:
    return F.round(value, 2)


def safe_double(name: str) -> Column:
    """Text to double; text that is no number, and NaN, become NULL."""
    return F.nanvl(F.col(name).try_cast("double"), F.lit(None).cast("double"))


def mean_of_rounded(value: Column) -> Column:
    """Mean of values already rounded to 2 places, summed as whole hundredths.

    Integer sums do not depend on the order in which partitions merge.
    """
    return F.avg(F.round(value * 100).cast("bigint")) / 100


def reading_date(time: str = "timestamp") -> Column:
    return F.to_date(time).alias("reading_date")


def reading_hour(time: str = "timestamp") -> Column:
    return F.date_trunc("hour", F.col(time)).alias("reading_hour")
