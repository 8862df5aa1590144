"""Row validation, quarantine, null handling and quality profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.functions import rules
from furrow.functions.columns import missing
from furrow.functions.rules import all_of, any_of


def mark_known_sensors(readings: DataFrame, registry: DataFrame, key: str = "sensor_id") -> DataFrame:
    """Flag readings whose sensor is registered; never adds or drops rows.

    The registry may be of any size, so no broadcast is forced: Spark compares its size with
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where the adaptive
    skew-join rule splits a sensor that holds a large share of the readings.

    Keys are compared in the type of the readings' key: a malformed id is one unknown sensor, and a
    registry key that has no value of that type matches nothing.
    """
    kind = readings.schema[key].dataType
    known = registry.select(F.col(key).try_cast(kind).alias(key)).distinct().withColumn("_registered", F.lit(True))
    return readings.join(known, key, "left").select(
        *(readings[name] for name in readings.columns),
        F.col("_registered").isNotNull().alias(rules.SENSOR_CHECK.flag),
    )


def validate(
    readings: DataFrame, registry: DataFrame, checks: Sequence[rules.Check] = rules.VALUE_CHECKS
) -> DataFrame:
    """Add one flag per check, their conjunction and the joined reason codes."""
    flagged = mark_known_sensors(readings, registry).withColumns({c.flag: c.column() for c in checks})
    every = (rules.SENSOR_CHECK, *checks)
    return flagged.withColumns({
        "is_valid": all_of(F.col(c.flag) for c in every),
        "invalid_reason": F.concat_ws(
            rules.REASON_SEPARATOR, *(F.when(~F.col(c.flag), F.lit(c.reason)) for c in every)
        ),
    })


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.filter("is_valid")


def quarantine(rejected: DataFrame) -> DataFrame:
    """Stamp rejected rows."""
    return rejected.withColumns({
        "quarantine_status": F.lit(rules.QUARANTINED),
        "quarantine_timestamp": F.current_timestamp(),
    })


SIDE, VALID, INVALID = "side", "valid", "invalid"
STAMPS = ("quarantine_status", "quarantine_timestamp")


def sided(validated: DataFrame) -> DataFrame:
    """All checked rows with their side; the quarantine's stamps are on the rejected ones only."""
    stamped = quarantine(validated)
    rejected = ~F.col("is_valid")
    return stamped.withColumns({
        **{name: F.when(rejected, F.col(name)) for name in STAMPS},
        SIDE: F.when(rejected, INVALID).otherwise(VALID),
    })


def invalid_rows(validated: DataFrame) -> DataFrame:
    return validated.filter("NOT is_valid").transform(quarantine)


def required_present(df: DataFrame, required: Sequence[str] = rules.REQUIRED_FIELDS) -> DataFrame:
    return df.filter(~any_of(missing(df, name) for name in required))


def null_quarantine(df: DataFrame, required: Sequence[str] = rules.REQUIRED_FIELDS) -> DataFrame:
    """Rows missing any required field (those that ``required_present`` drops), under one reason code."""
    rejected = df.filter(any_of(missing(df, name) for name in required))
    return rejected.withColumn("invalid_reason", F.lit(rules.NULL_REASON)).transform(quarantine)


def fill_by_type(
    df: DataFrame, number: float = 0, text: str = rules.UNKNOWN, time: Column | None = None
) -> DataFrame:
    """Replace NULLs by column type; times are filled only when a value is given."""
    of_type = lambda kind: [f.name for f in df.schema if isinstance(f.dataType, kind)]
    filled = df.fillna(number, of_type(T.NumericType)).fillna(text, of_type(T.StringType))
    times = of_type(T.TimestampType) if time is not None else []
    return filled.withColumns({name: F.coalesce(name, time) for name in times}) if times else filled


def fill_columns(df: DataFrame, values: Mapping[str, float | str]) -> DataFrame:
    return df.fillna(dict(values))


def summary_columns() -> dict[str, Column]:
    return {
        "valid_records": F.count_if("is_valid"), "invalid_records": F.count_if(~F.col("is_valid")),
        "total_records": F.count(F.lit(1)),
    }


def quality_summary(validated: DataFrame) -> DataFrame:
    """Valid, invalid and total rows from one scan."""
    return validated.agg(*(count.alias(name) for name, count in summary_columns().items()))


def null_profile(df: DataFrame) -> DataFrame:
    """One row holding the count of missing values (NULL or NaN) of every column, from one scan."""
    return df.agg(*(F.count_if(missing(df, name)).alias(name) for name in df.columns))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).count().orderBy(column)
