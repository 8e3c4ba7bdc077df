"""Physical layout of station series: exact row-based windows without one task per station.

A window partitioned by station alone puts a whole station into one task, which fails as soon
as one station holds a large share of the rows. Here every series is cut by time into *slots*.
Rows are hash-partitioned once by (station, slot). A row-based frame that reaches ``back`` rows
behind or ``ahead`` rows beyond needs rows of neighbouring slots, so the outermost rows of each
slot (its *halo*) are copied into the slots whose frames reach them, however many short or
missing slots lie between. Only those edge rows are shuffled a second time: the union keeps the
hash partitioning of the main rows, and the exchange below it is reused.

Which slot needs how many rows of which is decided from one summary row per slot; no window ever runs
over the rows of a station, only over its slots, whose number follows the calendar. Slots of a fixed width
suit hourly series and need no look at the data. Where stations differ widely in density, use
``Series(slot_seconds=None)``: then only stations with more than ``rows_per_slot`` rows are cut,
each at quantiles of its own times, and sparse ones stay whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hazecast.operators.lookup import lookup

SLOT = "_slot"
HALO = "_halo"
WHOLE = -(2**62)  # slot of a station that is not cut
GRID = 1024  # slots of a station at most, where they are measured
DAY = 86_400
BEGIN, NOW, END = Window.unboundedPreceding, Window.currentRow, Window.unboundedFollowing


@dataclass(frozen=True)
class Series:
    """Which columns make a series, and how it is cut into time slots.

    ``(key, time)`` must be unique; run :func:`hazecast.operators.append.keep_first` first
    where it may not be.
    """

    key: str = "city"
    time: str = "date"
    slot_seconds: int | None = 365 * DAY
    rows_per_slot: int = 1_000_000

    def micros(self) -> Column:
        return F.unix_micros(F.col(self.time).cast("timestamp"))

    def in_slot(self, reverse: bool = False) -> WindowSpec:
        return Window.partitionBy(self.key, SLOT).orderBy(self._order(reverse))

    def in_key(self, reverse: bool = False) -> WindowSpec:
        """Whole-station window, for rankings that Spark cuts off inside the map tasks only."""
        return Window.partitionBy(self.key).orderBy(self._order(reverse))

    def over_slots(self, reverse: bool = False) -> WindowSpec:
        """Window over one summary row per slot."""
        slot = F.col(SLOT)
        return Window.partitionBy(self.key).orderBy(slot.desc() if reverse else slot.asc())

    def _order(self, reverse: bool) -> Column:
        time = F.col(self.time)
        return time.desc() if reverse else time.asc()


def is_laid_out(df: DataFrame) -> bool:
    return SLOT in df.columns


def with_slot(df: DataFrame, series: Series) -> DataFrame:
    """Add the slot column.

    A row without station or time has no place in any series and is left out. Saying so here
    also keeps the exchange of :func:`lay_out` the same on both sides of a join on (station,
    slot), where Spark would otherwise add the filter to one side only and could not reuse the
    shuffled rows.
    """
    if is_laid_out(df):
        return df
    placed = df.where(F.col(series.key).isNotNull() & F.col(series.time).isNotNull())
    if series.slot_seconds is not None:
        width = F.lit(series.slot_seconds * 1_000_000)
        return placed.withColumn(SLOT, F.floor(series.micros() / width).cast("long"))
    bounds = _bounds_of_large_stations(placed, series)
    cut = lookup(placed, bounds, [series.key], spread=[series.time])
    slot = F.when(F.col("_bounds").isNull(), F.lit(WHOLE)).otherwise(_passed("_bounds", series.micros()))
    return cut.withColumn(SLOT, slot).drop("_bounds")


def _passed(bounds: str, value: Column) -> Column:
    """How many of the ascending ``bounds`` are at most ``value``, by binary search."""
    steps = F.lit([GRID >> i for i in range(GRID.bit_length())])

    def step(at: Column, size: Column) -> Column:
        # beyond the end there is null, which is no bound
        return F.when(F.get(bounds, at + size - 1) <= value, at + size).otherwise(at)

    return F.aggregate(steps, F.lit(0), step).cast("long")


def _bounds_of_large_stations(df: DataFrame, series: Series) -> DataFrame:
    """Times that cut every station with more than ``rows_per_slot`` rows into slots of equal depth.

    They come from a mergeable quantile sketch of the station's times, so that a burst is cut as finely
    as it is dense; a slot is up to twice as deep as asked for. GRID slots are the most a station gets.
    """
    sizes = df.groupBy(series.key).agg(F.count("*").alias("_rows"))
    sizes = sizes.where(F.col("_rows") > series.rows_per_slot)
    own = lookup(df.select(series.key, series.time), sizes, [series.key], spread=[series.time]).where(F.col("_rows").isNotNull())
    shares = [i / GRID for i in range(1, GRID)]
    grid = own.groupBy(series.key, "_rows").agg(F.percentile_approx(series.micros(), shares, 16 * GRID).alias("_grid"))
    every = F.greatest(F.lit(1), F.floor(F.lit(GRID) * series.rows_per_slot / F.col("_rows"))).cast("int")
    chosen = F.array_distinct(F.filter("_grid", lambda b, i: (i + 1) % every == 0))
    return grid.select(series.key, chosen.alias("_bounds"))


def lay_out(df: DataFrame, series: Series) -> DataFrame:
    """Add the slot column and hash-partition by (station, slot); a no-op when done already."""
    if is_laid_out(df):
        return df
    return with_slot(df, series).repartition(series.key, SLOT)


def lift(df: DataFrame) -> DataFrame:
    """Drop the layout column again."""
    return df.drop(SLOT)


def over_series(
    df: DataFrame,
    columns: dict[str, Callable[[WindowSpec], Column]],
    series: Series,
    *,
    back: int = 0,
    ahead: int = 0,
) -> DataFrame:
    """Add columns computed over row frames reaching ``back`` and ``ahead`` rows.

    Each callable receives the ordered window of a slot. The result stays partitioned by
    (station, slot), with the slot column kept, so further series operators need no shuffle.
    """
    base = lay_out(df, series)
    framed = base.withColumn(HALO, F.lit(False))
    if back:
        framed = framed.unionByName(_halo(base, series, back, reverse=False))
    if ahead:
        framed = framed.unionByName(_halo(base, series, ahead, reverse=True))
    window = series.in_slot()
    added = framed.withColumns({name: make(window) for name, make in columns.items()})
    return added.where(~F.col(HALO)).drop(HALO)


def _halo(base: DataFrame, series: Series, reach: int, reverse: bool) -> DataFrame:
    """Edge rows copied into each slot whose frames reach them.

    Every slot ranks its last ``reach`` rows (in reading order, backwards when ``reverse``) where it lies,
    and the list of routes, one row for a pair of slots, says how many of them a later slot needs.
    """
    edges = base.withColumn("_rank", F.row_number().over(series.in_slot(not reverse))).where(F.col("_rank") <= reach)
    routes = _routes(base, series, reach, reverse).withColumnsRenamed({series.key: "_k", SLOT: "_s"})
    # no slot is null, but a plain equation would say so in a filter below the exchange of this branch
    # alone, which could not be shared with the main rows any more
    same = (F.col(series.key) == F.col("_k")) & F.col(SLOT).eqNullSafe(F.col("_s")) & (F.col("_rank") <= F.col("_rows"))
    kept = [c for c in base.columns if c != SLOT]
    return (
        edges.join(routes, same)
        .select(*kept, F.col("_to").alias(SLOT))
        .repartition(series.key, SLOT)
        .withColumn(HALO, F.lit(True))
    )


def _routes(base: DataFrame, series: Series, reach: int, reverse: bool) -> DataFrame:
    """(station, slot, ``_to``, ``_rows``): how many last rows of a slot the slot ``_to`` needs.

    From one summary row per slot. A slot needs the ``reach`` rows before its first one, and at most
    ``reach`` slots hold them.
    """
    # all columns are looked at, and rows not only counted, so that they stay those of the main rows: their
    # exchange is read again then, and the input isn't
    summary = base.groupBy(series.key, SLOT).agg(F.count("*").alias("_count"), F.max(F.xxhash64("*")).alias("_any"))
    summary = summary.where(F.col("_any").isNotNull()).drop("_any")
    along = series.over_slots(reverse)
    upto = summary.withColumn("_upto", F.sum("_count").over(along.rowsBetween(BEGIN, NOW)))
    earlier = F.collect_list(F.struct(SLOT, "_upto")).over(along.rowsBetween(-reach, -1))
    begin = F.col("_upto") - F.col("_count")
    needed = F.transform("_earlier", lambda s: F.struct(s[SLOT].alias(SLOT), (s["_upto"] - begin + reach).alias("_rows")))
    each = upto.withColumn("_earlier", earlier).select(series.key, F.col(SLOT).alias("_to"), F.explode(F.filter(needed, lambda s: s["_rows"] > 0)).alias("_n"))
    return each.select(series.key, f"_n.{SLOT}", "_to", "_n._rows")


def slot_totals(df: DataFrame, series: Series, means: list[str] | None = None) -> DataFrame:
    """One row per (station, slot) of a slotted frame: rows before it, station rows and means.

    Aggregates on the map side before any shuffle; the running sums go over one row per slot.
    """
    means = means or []
    sums = [F.sum(c).alias(f"_sum_{c}") for c in means]
    counts = [F.count(c).alias(f"_cnt_{c}") for c in means]
    per_slot = df.groupBy(series.key, SLOT).agg(
        F.count("*").alias("_rows"), *sums, *counts
    )
    before = F.sum("_rows").over(series.over_slots().rowsBetween(BEGIN, -1))
    whole = Window.partitionBy(series.key)
    return per_slot.select(
        series.key,
        SLOT,
        F.coalesce(before, F.lit(0)).alias("_start"),
        F.sum("_rows").over(whole).alias("_n"),
        *[
            F.try_divide(F.sum(f"_sum_{c}").over(whole), F.sum(f"_cnt_{c}").over(whole)).alias(f"_mean_{c}")
            for c in means
        ],
    )


def row_positions(df: DataFrame, series: Series, means: list[str] | None = None) -> DataFrame:
    """Add ``_pos`` (0-based row number in the station), ``_n`` (its rows), ``_mean_*``."""
    slotted = with_slot(df, series)
    totals = slot_totals(slotted, series, means)
    base = df if is_laid_out(df) else slotted.repartition(series.key, SLOT)
    placed = base.join(totals, [series.key, SLOT], "left")
    rank = F.row_number().over(series.in_slot())
    added = [F.col(f"_mean_{c}") for c in means or []]
    return placed.select(*base.columns, (F.col("_start") + rank - 1).alias("_pos"), "_n", *added)
