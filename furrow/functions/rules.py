"""Validation checks and status ladders, held as data and turned into columns."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


@dataclass(frozen=True)
class Check:
    """A field passes when it is present and inside the given closed bounds; NaN is not present."""

    field: str
    reason: str
    low: float | None = None
    high: float | None = None

    @property
    def flag(self) -> str:
        return f"{self.field}_valid"

    def column(self) -> Column:
        value = F.col(self.field)
        bounds = [value >= self.low] if self.low is not None else []
        bounds += [value <= self.high] if self.high is not None else []
        # NaN is larger than any number, so only an upper bound rejects it
        bounds += [~F.isnan(value)] if bounds and self.high is None else []
        return F.coalesce(all_of(bounds), F.lit(False)) if bounds else value.isNotNull()


@dataclass(frozen=True)
class Rung:
    """Label given when every (column, comparison, threshold) holds."""

    label: object
    conditions: tuple[tuple[str, str, float], ...]

    def column(self) -> Column:
        return all_of(_COMPARE[op](F.col(name), limit) for name, op, limit in self.conditions)


@dataclass(frozen=True)
class Ladder:
    """Rungs tried in order; the default also takes NULL inputs."""

    name: str
    rungs: tuple[Rung, ...]
    default: object

    def column(self) -> Column:
        chain = F
        for rung in self.rungs:
            chain = chain.when(rung.column(), F.lit(rung.label))
        return chain.otherwise(F.lit(self.default))

    def named(self) -> Column:
        return self.column().alias(self.name)

    def over(self, **renames: str) -> Ladder:
        """The same ladder reading other columns, for example daily averages."""
        rungs = tuple(
            replace(r, conditions=tuple((renames.get(c, c), op, v) for c, op, v in r.conditions))
            for r in self.rungs
        )
        return replace(self, rungs=rungs)

    def labelled(self, name: str, hit: object, miss: object) -> Ladder:
        """The same conditions under another vocabulary."""
        return Ladder(name, tuple(replace(r, label=hit) for r in self.rungs), miss)


def all_of(columns: Iterable[Column]) -> Column:
    return reduce(operator.and_, columns)


def any_of(columns: Iterable[Column]) -> Column:
    return reduce(operator.or_, columns)


# ---- Fixed values: fields, ranges, thresholds, labels and codes of the domain ----

MEASURES = ("temperature", "humidity", "soil_moisture", "rainfall", "battery")

REQUIRED_FIELDS = ("reading_id", "sensor_id", "farm_id", "field_id", "timestamp", *MEASURES)

TIMESTAMP_FORMAT = "dd-MM-yyyy HH:mm"

SENSOR_CHECK = Check("sensor_id", "INVALID_SENSOR_ID")

VALUE_CHECKS = (
    Check("timestamp", "INVALID_TIMESTAMP"),
    Check("temperature", "INVALID_TEMPERATURE_RANGE", -10, 60),
    Check("humidity", "INVALID_HUMIDITY_RANGE", 0, 100),
    Check("soil_moisture", "INVALID_SOIL_MOISTURE_RANGE", 0, 100),
    Check("rainfall", "INVALID_RAINFALL", 0),
    Check("battery", "INVALID_BATTERY_RANGE", 0, 100),
)

QUARANTINE_IDENTITY = (*REQUIRED_FIELDS, "invalid_reason")

REASON_SEPARATOR = "; "
NULL_REASON = "NULL_OR_MISSING_REQUIRED_FIELD"
QUARANTINED = "QUARANTINED"
ALERT = "IRRIGATION_ALERT"
UNKNOWN = "UNKNOWN"
MISSING_DATE = "1900-01-01"

TEMPERATURE_STATUS = Ladder(
    "temperature_status",
    (Rung("HIGH", (("temperature", ">=", 40),)), Rung("LOW", (("temperature", "<=", 5),))),
    "NORMAL",
)
SOIL_STATUS = Ladder(
    "soil_status",
    (Rung("LOW", (("soil_moisture", "<", 30),)), Rung("HIGH", (("soil_moisture", ">", 80),))),
    "NORMAL",
)
HUMIDITY_STATUS = Ladder(
    "humidity_status",
    (Rung("LOW", (("humidity", "<", 30),)), Rung("HIGH", (("humidity", ">", 80),))),
    "NORMAL",
)
IRRIGATION_YES_NO = Ladder(
    "irrigation_required",
    (Rung("YES", (("soil_moisture", "<", 30), ("rainfall", "<", 2))),),
    "NO",
)
IRRIGATION_TEXT = IRRIGATION_YES_NO.labelled(
    "irrigation_required", "IRRIGATION_REQUIRED", "NO_IRRIGATION_REQUIRED"
)
IRRIGATION_LABEL = IRRIGATION_YES_NO.labelled("irrigation_label", 1, 0)
SENSOR_HEALTH = Ladder(
    "sensor_health",
    (Rung("LOW_BATTERY", (("battery", "<", 20),)), Rung("WARNING", (("battery", "<", 50),))),
    "HEALTHY",
)
SENSOR_HEALTH_SUMMARY = Ladder(
    "sensor_health",
    (Rung("LOW_BATTERY", (("min_battery", "<", 20),)), Rung("WARNING", (("avg_battery", "<", 50),))),
    "HEALTHY",
)
PREDICTED_IRRIGATION = Ladder(
    "predicted_irrigation_required", (Rung("YES", (("prediction", "<", 30),)),), "NO"
)
DRY_SOIL = 30

READING_STATUSES = (
    TEMPERATURE_STATUS, SOIL_STATUS, HUMIDITY_STATUS, IRRIGATION_TEXT, SENSOR_HEALTH,
)
