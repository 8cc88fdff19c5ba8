"""Per-area time series: lags, rolling means, fills, interpolation, densification.

Windows are partitioned by area and never run across areas. An area-month panel has one
row per area and month, so a window partition is never longer than the calendar; call
:func:`areapanel.operators.quality.require_unique` first where the input may break that.
All derived columns share one window specification, hence one shuffle and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MONTH_ORDER = ("year", "month")


def _forward(area: Sequence[str], order: Sequence[str]):
    return W.partitionBy(*area).orderBy(*[F.col(c).asc() for c in order])


def _backward(area: Sequence[str], order: Sequence[str]):
    # "first after this row" is written as "last so far" over the reversed order: a frame that
    # grows costs one step per row, a frame that ends at the last row is rescanned for each row.
    return W.partitionBy(*area).orderBy(*[F.col(c).desc() for c in order])


def with_history(
    df: DataFrame,
    columns: Sequence[str],
    area: Sequence[str] = ("area_id",),
    order: Sequence[str] = MONTH_ORDER,
    months: int = 12,
    kinds: str = "lmv",
) -> DataFrame:
    """Add ``x_l12`` (lag), ``x_m12`` (rolling mean) and ``x_v12`` (lagged rolling mean).

    The rolling mean includes the current row and skips nulls; the lagged one averages the
    rows ``2*months-1`` to ``months`` back, which is the rolling mean shifted by ``months``.
    """
    w = _forward(area, order)
    recipe = {
        "l": lambda c: F.lag(c, months).over(w),
        "m": lambda c: F.avg(c).over(w.rowsBetween(1 - months, 0)),
        "v": lambda c: F.avg(c).over(w.rowsBetween(1 - 2 * months, -months)),
    }
    added = [recipe[k](F.col(f"`{c}`")).alias(f"{c}_{k}{months}") for k in kinds for c in columns]
    return df.select("*", *added)


def with_calendar_history(
    df: DataFrame,
    columns: Sequence[str],
    area: Sequence[str] = ("area_id",),
    order: Sequence[str] = MONTH_ORDER,
    months: int = 12,
    kinds: str = "lmv",
) -> DataFrame:
    """As :func:`with_history`, counted in calendar months where the panel lacks some.

    ``x_l12`` is the value of exactly ``months`` months earlier, null where that month has no row; of
    several rows of one month the largest. Frames run over a month index, so a month without a row shortens a
    mean and never lets an older one in. Rows without a readable month have null columns.
    """
    year, month = (F.col(f"`{c}`") for c in order)
    index = (year * 12 + month - 1).cast("int")
    w = W.partitionBy(*area).orderBy(index.asc())

    def over(frame: Column) -> Column:
        return F.when(index.isNotNull(), frame)

    recipe = {
        "l": lambda c: over(F.max(c).over(w.rangeBetween(-months, -months))),
        "m": lambda c: over(F.avg(c).over(w.rangeBetween(1 - months, 0))),
        "v": lambda c: over(F.avg(c).over(w.rangeBetween(1 - 2 * months, -months))),
    }
    added = [recipe[k](F.col(f"`{c}`")).alias(f"{c}_{k}{months}") for k in kinds for c in columns]
    return df.select("*", *added)


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns])


def forward_fill(
    df: DataFrame, columns: Sequence[str], area: Sequence[str] = ("area_id",), order: Sequence[str] = MONTH_ORDER
) -> DataFrame:
    w = _forward(area, order).rowsBetween(W.unboundedPreceding, 0)
    return _replace(df, {c: F.last(F.col(f"`{c}`"), ignorenulls=True).over(w) for c in columns})


def backward_fill(
    df: DataFrame, columns: Sequence[str], area: Sequence[str] = ("area_id",), order: Sequence[str] = MONTH_ORDER
) -> DataFrame:
    w = _backward(area, order).rowsBetween(W.unboundedPreceding, 0)
    return _replace(df, {c: F.last(F.col(f"`{c}`"), ignorenulls=True).over(w) for c in columns})


def interpolate(
    df: DataFrame,
    columns: Sequence[str],
    area: Sequence[str] = ("area_id",),
    order: Sequence[str] = MONTH_ORDER,
    trailing: str = "null",
) -> DataFrame:
    """Linear by row position between the nearest present values; leading nulls stay null.

    ``trailing="hold"`` repeats the last value after it, ``"null"`` leaves the tail empty.
    """
    if trailing not in ("null", "hold"):
        raise ValueError(f"trailing must be 'null' or 'hold', got {trailing!r}")
    ahead = _forward(area, order)
    grown = ahead.rowsBetween(W.unboundedPreceding, 0)
    back = _backward(area, order).rowsBetween(W.unboundedPreceding, 0)
    numbered = df.select("*", F.row_number().over(ahead).alias("_pos"))

    def anchor(c: str) -> Column:
        value = F.col(f"`{c}`")
        return F.when(value.isNotNull(), F.struct(F.col("_pos").alias("p"), value.cast("double").alias("v")))

    marked = numbered.select(
        "*",
        *[F.last(anchor(c), ignorenulls=True).over(grown).alias(f"_prev_{i}") for i, c in enumerate(columns)],
        *[F.last(anchor(c), ignorenulls=True).over(back).alias(f"_next_{i}") for i, c in enumerate(columns)],
    )

    def between(i: int, c: str) -> Column:
        prev, nxt = F.col(f"_prev_{i}"), F.col(f"_next_{i}")
        step = (nxt["v"] - prev["v"]) * (F.col("_pos") - prev["p"]) / (nxt["p"] - prev["p"])
        line = F.when(prev["p"] == nxt["p"], prev["v"]).otherwise(prev["v"] + step)
        return F.coalesce(line, prev["v"]) if trailing == "hold" else line

    new = {c: between(i, c) for i, c in enumerate(columns)}
    return marked.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns])


def densify_years(
    df: DataFrame, value: str, area: Sequence[str] = ("country_code_3",), year: str = "year"
) -> DataFrame:
    """Mean per area and year, every year between the first and last, linear in between.

    Missing years are generated from the gap to the following row, so no spine is joined.
    """
    w = W.partitionBy(*area).orderBy(year)
    yearly = (
        df.dropna(subset=[*area, year])
        .groupBy(*area, year)
        .agg(F.avg(value).alias(value))
        .select("*", F.coalesce(F.lead(year).over(w) - 1, F.col(year)).alias("_until"))
    )
    filled = (
        yearly.select(*area, value, F.col(year).alias("_from"), F.explode(F.sequence(year, "_until")).alias(year))
        .withColumn(value, F.when(F.col(year) == F.col("_from"), F.col(value)))
        .select(*area, year, value)
    )
    return interpolate(filled, [value], area, (year,), trailing="hold")
