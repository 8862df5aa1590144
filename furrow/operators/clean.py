"""Typing of raw readings: trimmed ids, safe numbers, safe timestamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions.columns import reading_date, reading_hour, safe_double
from furrow.functions.rules import MEASURES, TIMESTAMP_FORMAT


def clean_readings(
    raw: DataFrame,
    ids: Sequence[str] = ("sensor_id", "farm_id"),
    measures: Sequence[str] = MEASURES,
    time: str = "timestamp",
    time_format: str = TIMESTAMP_FORMAT,
) -> DataFrame:
    """Trim ids and convert text; whatever does not convert becomes NULL."""
    typed = {name: F.trim(name) for name in ids}
    typed |= {name: safe_double(name) for name in measures}
    if dict(raw.dtypes)[time] == "string":
        typed[time] = F.try_to_timestamp(F.col(time), F.lit(time_format))
    return raw.withColumns(typed)


def strict_measures(readings: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Cast to double and fail on text that is no number (ANSI mode); doubles stay untouched."""
    other = [name for name in measures if dict(readings.dtypes)[name] != "double"]
    return readings.withColumns({name: F.col(name).cast("double") for name in other})


def with_time_parts(readings: DataFrame, time: str = "timestamp") -> DataFrame:
    """Add the reading's date and its hour as a timestamp."""
    return readings.withColumns({
        time: F.to_timestamp(time),
        "reading_date": reading_date(time),
        "reading_hour": reading_hour(time),
    })


def with_calendar(readings: DataFrame, time: str, hour: str = "hour", month_day: bool = False) -> DataFrame:
    """Add hour, day of week (Sunday is 1) and month, optionally the day of the month."""
    parts = {hour: F.hour(time), "day_of_week": F.dayofweek(time), "month": F.month(time)}
    if month_day:
        parts["day_of_month"] = F.dayofmonth(time)
    return readings.withColumns(parts)
