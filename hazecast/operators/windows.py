"""Row-based lags, rolling statistics, fills and the feature table built from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from hazecast.functions.columns import calendar_columns, relative_change
from hazecast.operators.layout import (
    BEGIN,
    HALO,
    NOW,
    SLOT,
    Series,
    is_laid_out,
    lay_out,
    lift,
    over_series,
)
from hazecast.schemas import TARGET

WindowColumn = Callable[[WindowSpec], Column]
NULL_POLICIES = ("keep", "drop", "ffill_drop", "ffill_bfill")


def lag_of(column: str, rows: int) -> WindowColumn:
    return lambda w: F.lag(column, rows).over(w)


def lead_of(column: str, rows: int) -> WindowColumn:
    return lambda w: F.lead(column, rows).over(w)


def rolling_mean(column: str, rows: int, shift: int = 0) -> WindowColumn:
    """Mean of ``rows`` rows up to the current one; null unless all of them have a value."""
    return _full_frame(F.avg, column, rows, shift)


def rolling_std(column: str, rows: int, shift: int = 0) -> WindowColumn:
    """Sample standard deviation under the same rule."""
    return _full_frame(F.stddev_samp, column, rows, shift)


def _full_frame(statistic, column: str, rows: int, shift: int) -> WindowColumn:
    def make(w: WindowSpec) -> Column:
        frame = w.rowsBetween(1 - rows - shift, -shift)
        return F.when(F.count(column).over(frame) == rows, statistic(column).over(frame))

    return make


def difference(column: str, rows: int = 1) -> WindowColumn:
    """Change against an earlier row; 0 where it is unknown."""
    return lambda w: F.coalesce(F.col(column) - F.lag(column, rows).over(w), F.lit(0.0))


def with_lags(df: DataFrame, lags: dict[str, int], series: Series = Series(), column: str = TARGET) -> DataFrame:
    made = {name: lag_of(column, k) for name, k in lags.items()}
    return _closed(df, over_series(df, made, series, back=max(lags.values())))


def with_target_ahead(
    df: DataFrame, rows: int = 72, series: Series = Series(), column: str = TARGET, name: str = "target_aqi"
) -> DataFrame:
    """Value ``rows`` rows later, null on the last ``rows`` rows of a station."""
    return _closed(df, over_series(df, {name: lead_of(column, rows)}, series, ahead=rows))


def with_change(
    df: DataFrame, series: Series = Series(), column: str = TARGET, name: str = "aqi_change"
) -> DataFrame:
    return _closed(df, over_series(df, {name: difference(column)}, series, back=1))


def with_rolling(
    df: DataFrame, rows: int = 24, series: Series = Series(), column: str = TARGET, prefix: str = "aqi_rolling"
) -> DataFrame:
    made = {
        f"{prefix}_{rows}_mean": rolling_mean(column, rows),
        f"{prefix}_{rows}_std": rolling_std(column, rows),
    }
    return _closed(df, over_series(df, made, series, back=rows - 1))


def forward_fill(df: DataFrame, columns: list[str] | None = None, series: Series = Series()) -> DataFrame:
    """Replace nulls by the last earlier value of the station."""
    return _closed(df, _fill(df, columns, series, reverse=False))


def backward_fill(df: DataFrame, columns: list[str] | None = None, series: Series = Series()) -> DataFrame:
    """Replace nulls by the next later value of the station."""
    return _closed(df, _fill(df, columns, series, reverse=True))


def _fill(df: DataFrame, columns: list[str] | None, series: Series, reverse: bool) -> DataFrame:
    """Fill inside each slot, then from the nearest earlier slot holding a value.

    A frame open to the end is recomputed for every row, so the backward fill reads the slot in
    reverse order instead.
    """
    base = lay_out(df, series)
    columns = columns or [c for c in base.columns if c not in (series.key, series.time, SLOT, HALO)]
    outermost = F.min_by if reverse else F.max_by
    per_slot = base.groupBy(series.key, SLOT).agg(
        *[
            outermost(F.col(c), F.when(F.col(c).isNotNull(), F.col(series.time))).alias(c)
            for c in columns
        ]
    )
    earlier = series.over_slots(reverse).rowsBetween(BEGIN, -1)
    carried = per_slot.select(
        series.key, SLOT, *[F.last(c, True).over(earlier).alias(f"_from_{c}") for c in columns]
    )
    so_far = series.in_slot(reverse).rowsBetween(BEGIN, NOW)
    names = base.columns
    inside = base.withColumns({f"_in_{c}": F.last(c, True).over(so_far) for c in columns})
    joined = inside.join(carried, [series.key, SLOT], "left")
    filled = {c: F.coalesce(F.col(f"_in_{c}"), F.col(f"_from_{c}")) for c in columns}
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in names])


def _closed(given: DataFrame, result: DataFrame) -> DataFrame:
    """Keep the layout column only for callers that chain series operators themselves."""
    return result if is_laid_out(given) else lift(result)


def memory_columns(target: str = TARGET, shift: int = 0) -> dict[str, WindowColumn]:
    """Lag, rolling and change-rate features of the target.

    With ``shift=0`` the rolling mean and the change rate contain the current target, so a model
    of the target trained on them has seen its answer. ``shift=1`` uses earlier rows only.
    """
    def change_rate(w: WindowSpec) -> Column:
        now = F.lag(target, shift).over(w) if shift else F.col(target)
        return relative_change(now, F.lag(target, 24 + shift).over(w))

    return {
        "aqi_lag_24": lag_of(target, 24),
        "aqi_lag_48": lag_of(target, 48),
        "aqi_rolling_24_mean": rolling_mean(target, 24, shift),
        "aqi_rolling_24_std": rolling_std(target, 24, shift),
        "aqi_change_rate": change_rate,
    }


def station_features(
    df: DataFrame,
    series: Series = Series(),
    *,
    target: str = TARGET,
    nulls: str = "drop",
    shift: int = 0,
    calendar: str | None = None,
) -> DataFrame:
    """Feature table of all stations: calendar, lags, rolling statistics, change rate.

    Rows are ordered by the time of ``series``. ``calendar`` names another column, for instance a
    local time, from which the calendar parts are taken.

    ``nulls`` says what happens to incomplete rows afterwards: ``keep`` them, ``drop`` them,
    fill forward and drop the rest (``ffill_drop``), or fill both ways (``ffill_bfill``).
    """
    if nulls not in NULL_POLICIES:
        raise ValueError(f"nulls must be one of {NULL_POLICIES}")
    featured = over_series(df, memory_columns(target, shift), series, back=48)
    ordered = [*df.columns, *calendar_columns(), *memory_columns()]
    featured = featured.withColumns(calendar_columns(calendar or series.time))
    if nulls.startswith("ffill"):
        featured = _fill(featured, None, series, reverse=False)
    if nulls == "ffill_bfill":
        featured = _fill(featured, None, series, reverse=True)
    if nulls.endswith("drop"):
        featured = featured.dropna(subset=[c for c in ordered if c != SLOT])
    return featured.select(*ordered)


def horizon_features(df: DataFrame, series: Series = Series(), target: str = TARGET, rows: int = 72) -> DataFrame:
    """Feature table of the 72-hours-ahead model."""
    made = {"aqi_change": difference(target), "target_aqi": lead_of(target, rows)}
    featured = over_series(df, made, series, back=1, ahead=rows)
    time = series.time
    return featured.select(
        time,
        F.hour(time).alias("hour"),
        F.dayofmonth(time).alias("day"),
        F.month(time).alias("month"),
        "pm10",
        "pm2_5",
        "aqi_change",
        target,
        "target_aqi",
        series.key,
    )
