"""Per-entity time series columns that stay distributed when one entity is very large.

A plain ``Window.partitionBy(entity)`` sorts an entity's whole history in one task, and the
adaptive planner cannot split it. All frames here reach a few rows only, so ``along`` can cut the
histories that ``fitting_cut`` found to be large into time segments, and repair the rows next to
each cut.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from furrow.functions.rules import all_of, any_of
from furrow.operators.ordinal import write_in_order, written_part
from furrow.sources import shared


@dataclass(frozen=True)
class Series:
    """A column over an ordered window that reads ``back`` earlier or ``ahead`` later rows."""

    over: Callable[[WindowSpec], Column]
    back: int = 0
    ahead: int = 0


def lag(name: str, rows: int = 1) -> Series:
    return Series(lambda w: F.lag(name, rows).over(w), back=rows)


def lead(name: str, rows: int = 1) -> Series:
    return Series(lambda w: F.lead(name, rows).over(w), ahead=rows)


def trailing_mean(name: str, first: int = -2, last: int = 0) -> Series:
    """Mean of the rows from ``first`` to ``last`` (0 is the current row)."""
    return Series(lambda w: F.avg(name).over(w.rowsBetween(first, last)), back=-first)


@dataclass(frozen=True)
class Cut:
    """Where ``along`` cuts histories: at every ``unit``, for the ``large`` entities or for all.

    Without a unit it cuts at the borders of evenly filled ranges of the whole order of those entities.
    """

    unit: str | None
    large: DataFrame | None = None


ROWS_OF_TASK = 2_000_000  # a longer history is cut
UNITS = ("day", "hour", "minute", "second")


def fitting_cut(
    df: DataFrame,
    entity: Sequence[str],
    time: str = "timestamp",
    limit: int = ROWS_OF_TASK,
    reach: int = 3,
) -> Cut | None:
    """Find the entities with more than ``limit`` rows and the coarsest unit that splits them.

    ``None`` when there is no such entity. The limit rises to a hundred-thousandth of all rows, so
    at most 100,000 entities can exceed it; this bounds what is collected here and broadcast
    later. Rows are counted once per entity, and once per second of the large ones, from which all units follow.

    The cut has no unit when even one second of an entity is too large, or when a unit that is
    short enough for bursts would leave more than ``limit`` rows beside the cuts of an entity.
    """
    per_entity = df.groupBy(*entity).count().persist()  # lost blocks are counted again
    try:
        total, largest = per_entity.agg(F.sum("count"), F.max("count")).first()
        limit = max(limit, (total or 0) // 100_000)
        if (largest or 0) <= limit:
            return None
        rows = per_entity.filter(F.col("count") > limit).select(*entity).collect()
    finally:
        per_entity.unpersist()
    large = df.sparkSession.createDataFrame(rows, df.select(*entity).schema)
    marked = _marked(df.select(*entity, time), entity, large).filter("_large")
    seconds = marked.groupBy(*entity, F.date_trunc("second", F.col(time)).alias("_second")).count()
    starts = F.inline(F.array(*(
        F.struct(F.lit(unit).alias("_unit"), F.date_trunc(unit, F.col("_second")).alias("_segment")) for unit in UNITS
    )))
    segments = seconds.select(*entity, "count", starts).groupBy(*entity, "_unit", "_segment").agg(F.sum("count").alias("rows"))
    per_unit = segments.groupBy(*entity, "_unit").agg(F.max("rows").alias("rows"), F.count(F.lit(1)).alias("segments"))
    found = per_unit.groupBy("_unit").agg(F.max("rows").alias("longest"), F.max("segments").alias("most")).collect()
    sizes = {row["_unit"]: row for row in found}
    for unit in UNITS:
        if sizes[unit].most * 2 * reach > limit:
            break
        if sizes[unit].longest <= limit:
            return Cut(unit, large)
    return Cut(None, large)


def _marked(df: DataFrame, entity: Sequence[str], large: DataFrame | None) -> DataFrame:
    """Add ``_large``: whether the row's entity is cut; all are when no entities are named."""
    if large is None:
        return df.withColumn("_large", F.lit(True))
    named = large.select(*(F.col(key).alias(f"_{key}") for key in entity), F.lit(True).alias("_named"))
    same = all_of(df[key].eqNullSafe(named[f"_{key}"]) for key in entity)
    marked = df.join(F.broadcast(named), same, "left")
    return marked.select(*(df[name] for name in df.columns), F.coalesce("_named", F.lit(False)).alias("_large"))


def _at_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``_segment``: the row's range of the whole order, from rows written in that order."""
    path = shared.fresh_path(df.sparkSession, "in-order")
    write_in_order(df, order, path)
    return df.sparkSession.read.parquet(path).select(*df.columns, written_part().alias("_segment"))


def along(
    df: DataFrame,
    entity: Sequence[str],
    columns: Mapping[str, Series],
    time: str = "timestamp",
    tie_break: str = "reading_id",
    cut: Cut | int | None = ROWS_OF_TASK,
) -> DataFrame:
    """Add series columns per entity, ordered by ``time`` and ``tie_break``.

    ``cut`` is the number of rows above which a history is cut (they are counted here, by a job of
    ``fitting_cut``), a cut that was found before, or None for the plain window. With a cut, columns are
    first computed inside each segment; only the few rows of large entities near a cut, at most
    ``2 * reach`` per segment, go to a second window over the whole entity. Both branches read the same
    shuffle. Other entities keep the plain window. A cut without a unit sorts and writes the
    large entities' rows first, and no others.

    Distances to the cut come from ``rank`` and ``cume_dist``, which rows with equal sort keys
    share, so both branches agree on every row even when the sort keys are not unique.
    """
    order = (time, tie_break)
    whole = Window.partitionBy(*entity).orderBy(*order)
    reach_back = max(s.back for s in columns.values())
    reach_ahead = max(s.ahead for s in columns.values())
    reach = max(reach_back, reach_ahead)
    if isinstance(cut, int):
        cut = fitting_cut(df, entity, time, cut, reach)
    if cut is None:
        return df.withColumns({name: s.over(whole) for name, s in columns.items()})

    marked = _marked(df, entity, cut.large)
    if cut.unit is None and cut.large is not None:
        small = along(marked.filter("NOT _large").drop("_large"), entity, columns, time, tie_break, None)
        large = along(marked.filter("_large").drop("_large"), entity, columns, time, tie_break, Cut(None))
        return small.unionByName(large)
    segmented = (
        marked.withColumn("_segment", F.when(F.col("_large"), F.date_trunc(cut.unit, F.col(time)))) if cut.unit
        else _at_ranges(marked, [*entity, *order])
    )
    inside = Window.partitionBy(*entity, "_segment").orderBy(*order)
    rows = F.count(F.lit(1)).over(
        inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    local = segmented.withColumns({
        "_before": F.rank().over(inside) - 1,
        "_after": rows - F.round(F.cume_dist().over(inside) * rows).cast("bigint"),
        **{name: s.over(inside) for name, s in columns.items()},
    })
    before, after = F.col("_before"), F.col("_after")
    touched = F.col("_large") & any_of(
        ([before < reach_back] if reach_back else []) + ([after < reach_ahead] if reach_ahead else [])
    )
    one_way = not (reach_back and reach_ahead)  # then every touched row needs the wider window
    repaired = {
        name: s.over(whole) if one_way
        else F.when(before < s.back if s.back else after < s.ahead, s.over(whole)).otherwise(F.col(name))
        for name, s in columns.items()
    }
    beside = F.col("_large") & ((before < reach) | (after < reach))
    near_cut = local.filter(beside).withColumns(repaired).filter(touched)
    kept = [*df.columns, *columns]
    return local.filter(~touched).select(*kept).unionByName(near_cut.select(*kept))


@dataclass(frozen=True)
class Within:
    """An aggregate of the rows whose time lies ``first`` to ``last`` seconds from the row's own, both included.

    Negative numbers are earlier. Rows without a time, and the aggregate of none, give NULL.
    """

    over: Callable[[WindowSpec], Column]
    first: int
    last: int

    @property
    def back(self) -> int:
        return max(0, -self.first)

    @property
    def ahead(self) -> int:
        return max(0, self.last)


def mean_within(name: str, first: int, last: int) -> Within:
    return Within(lambda w: F.avg(name).over(w), first, last)


def at_distance(name: str, seconds: int) -> Within:
    """The mean of the rows exactly that far away, so the one value where there is one."""
    return mean_within(name, seconds, seconds)


def by_distance(
    df: DataFrame,
    entity: Sequence[str],
    columns: Mapping[str, Within],
    time: str = "timestamp",
    segment: int | None = 86_400,
) -> DataFrame:
    """Add columns per entity over rows at given distances in time, not numbers of rows.

    "The next hour" is then one hour ahead, or NULL where no row lies there, whatever the gaps. Times
    count in whole seconds. Histories are cut into segments of ``segment`` seconds for every entity, and a
    segment also gets the rows beside its ends that frames of its own rows reach, which is all that those
    can see; the borrowed rows are dropped afterwards. So an entity that holds a third of all rows is
    spread over as many tasks as it has segments, one shuffle does it, and rows near an end
    are sent twice. A segment is at least as long as the longest reach. None uses the plain window.
    """
    seconds = F.unix_seconds(F.date_trunc("second", F.col(time)))

    def framed(rows: DataFrame, *keys: str) -> DataFrame:
        inside = Window.partitionBy(*keys).orderBy("_at")
        known = F.col("_at").isNotNull()
        return rows.withColumns({
            name: F.when(known, c.over(inside.rangeBetween(c.first, c.last))) for name, c in columns.items()
        })

    timed = df.withColumn("_at", seconds)
    if segment is None:
        return framed(timed, *entity).drop("_at")
    back, ahead = max(c.back for c in columns.values()), max(c.ahead for c in columns.values())
    length = max(segment, back, ahead, 1)
    number = F.floor(F.col("_at") / length)
    into = F.col("_at") - number * length
    # a row also belongs to the next segment if rows there look back to it, and to the one before if they look ahead
    segments = F.filter(
        F.array(number, F.when(into >= length - back, number + 1), F.when(into < ahead, number - 1)),
        lambda n: n.isNotNull(),
    )
    spread = timed.withColumn("_own", number).withColumn(
        "_segment", F.explode_outer(F.when(F.col("_at").isNotNull(), segments))
    )
    done = framed(spread, *entity, "_segment")
    return done.where(F.col("_own").eqNullSafe(F.col("_segment"))).select(*df.columns, *columns)


def group_stats(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """Add whole-group aggregates to every row (an unordered window, by aggregate and join).

    The aggregate combines before its shuffle, and a join can be split where one group is large;
    a window would buffer the group in one task. NULL keys form a group, as in a window.
    """
    side = df.groupBy(*(F.col(key).alias(f"_{key}") for key in keys)).agg(
        *(stat.alias(name) for name, stat in stats.items())
    )
    same = all_of(df[key].eqNullSafe(side[f"_{key}"]) for key in keys)
    return df.join(side, same, "left").select(*(df[c] for c in df.columns), *stats)


def daily_temperature(readings: DataFrame, entity: str, rounded: bool = False) -> DataFrame:
    """Add the daily mean, minimum and maximum temperature per entity."""
    shape = (lambda c: F.round(c, 2)) if rounded else (lambda c: c)
    return group_stats(readings, [entity, "reading_date"], {
        "daily_average": shape(F.avg("temperature")),
        "daily_min": shape(F.min("temperature")),
        "daily_max": shape(F.max("temperature")),
    })


def temperature_trend(
    readings: DataFrame, entity: Sequence[str], rounded: bool = False, cut: Cut | int | None = ROWS_OF_TASK
) -> DataFrame:
    """Add the previous temperature, its change and the mean of the last three readings."""
    shape = (lambda c: F.round(c, 2)) if rounded else (lambda c: c)
    trend = along(readings, entity, {
        "previous_temperature": lag("temperature"),
        "3_reading_average": trailing_mean("temperature"),
    }, cut=cut)
    return trend.withColumns({
        "temperature_change": shape(F.col("temperature") - F.col("previous_temperature")),
        "3_reading_average": shape(F.col("3_reading_average")),
    })
