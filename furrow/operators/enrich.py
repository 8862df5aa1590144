"""Dimension enrichment."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.operators.dedup import keep_first


def enrich(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    on_collision: Literal["prefix", "skip"] = "prefix",
    prefix: str = "farm_",
) -> DataFrame:
    """Left join every non-key dimension column; the row count never changes.

    A column name both sides hold is prefixed or skipped. Repeated dimension keys keep their
    smallest row, so that they cannot multiply the facts. Spark picks the join by size.

    Keys are compared in the type of the facts' key, so that a malformed key of a fact finds nothing
    instead of failing the job; a dimension key that has no value of that type matches nothing.
    """
    taken = set(facts.columns)
    picked = {
        name: prefix + name if name in taken else name
        for name in dimension.columns
        if name != key and not (on_collision == "skip" and name in taken)
    }
    if not picked:
        return facts
    if clash := taken & set(picked.values()):
        raise ValueError(f"prefixed columns already present: {sorted(clash)}")
    typed = dimension.withColumn(key, F.col(key).try_cast(facts.schema[key].dataType))
    order = [F.col(name) for name in dimension.columns if name != key]
    unique = keep_first(typed, [key], order).select(
        F.col(key), *(F.col(old).alias(new) for old, new in picked.items())
    )
    return facts.join(unique, key, "left").select(
        *(facts[name] for name in facts.columns), *(unique[new] for new in picked.values())
    )
