"""The wide historical panel: left-join chain, gap rules, history features, outcome."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import AEZ_PREFIX, LAND_SURFACE_BANDS
from ..operators.dedup import keep_one
from ..operators.joins import grouped_left_join, left_join
from ..operators.series import MONTH_ORDER, backward_fill, forward_fill, interpolate, with_history
from .conflict import MEASURES

CONFLICT_COLUMNS = [m + suffix for suffix in ("", "_w5", "_w10") for m in MEASURES]
LAND_SURFACE_COLUMNS = [f"{v}_{s}" for v in LAND_SURFACE_BANDS for s in ("mean", "stdDev")]


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def floor_at(df: DataFrame, columns: Sequence[str], low: float = 0.0) -> DataFrame:
    """Values below ``low`` become ``low``; nulls stay null."""
    return df.withColumns({c: F.when(_col(c) < low, F.lit(low)).otherwise(_col(c)) for c in columns})


def cap_at(df: DataFrame, columns: Sequence[str], high: float = 1000.0) -> DataFrame:
    return df.withColumns({c: F.when(_col(c) > high, F.lit(high)).otherwise(_col(c)) for c in columns})


def flags_to_int(df: DataFrame, prefix: str = AEZ_PREFIX) -> DataFrame:
    """Boolean indicators to 0/1, null to 0."""
    return df.withColumns({c: F.coalesce(_col(c).cast("int"), F.lit(0)) for c in df.columns if c.startswith(prefix)})


def zero_fill(df: DataFrame, columns: Sequence[str], distance: str | None = None, fill_distance: bool = False) -> DataFrame:
    """Nulls to 0. A distance stays null unless asked: no match is not a distance of zero."""
    wanted = [c for c in columns if fill_distance or c != distance]
    return df.na.fill(0, subset=wanted)


def join_chain(scaffold: DataFrame, tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Left-join each ``(table, keys)`` in turn; earlier columns win."""
    rows = scaffold
    for table, keys in tables.values():
        rows = left_join(rows, table, keys)
    return rows


def fill_gaps(
    panel: DataFrame,
    backward: Sequence[str] = (),
    forward: Sequence[str] = (),
    linear: Sequence[str] = (),
    area: Sequence[str] = ("area_id",),
) -> DataFrame:
    """Each column group by its rule; all of them share the partitioning by area."""
    out = panel
    if backward:
        out = backward_fill(out, backward, area)
    if forward:
        out = forward_fill(out, forward, area)
    return interpolate(out, linear, area) if linear else out


def history_panel(
    panel: DataFrame, outcome: DataFrame, time_variants: Sequence[str], order: Sequence[str], keys: Sequence[str] = ("area_id", "year", "month")
) -> DataFrame:
    """History features for every time-variant column, then the outcome; keys made unique first.

    All of it follows the area, so a panel that lies dealt by area is not shuffled.
    """
    area = [k for k in keys if k not in MONTH_ORDER]
    unique = keep_one(panel, keys, order)
    featured = with_history(unique, time_variants, area=area)
    first = keep_one(outcome, keys, [c for c in outcome.columns if c not in keys])
    return grouped_left_join(featured, first, area, MONTH_ORDER)
