"""The row universe: which areas exist in which months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import check_target_month, index_month, index_year
from ..operators.aggregates import latest_month
from ..operators.quality import as_int, require_unique

SCAFFOLD_COLUMNS = ["admin_code", "lat", "lon", "year", "month"]


def month_spine(areas: DataFrame, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """Every area once per month from ``first`` to ``last``; rows unfold in place.

    The months are a joined table, not an ``explode``, which Spark takes to leave the size as it is: it would
    broadcast the spine of a small table of areas to every join.
    """
    low, high = first[0] * 12 + first[1] - 1, last[0] * 12 + last[1] - 1
    months = areas.sparkSession.range(low, high + 1, 1, 1).select(F.col("id").cast("int").alias("_i"))
    return (
        areas.crossJoin(F.broadcast(months))
        .withColumns({"year": index_year(F.col("_i")), "month": index_month(F.col("_i"))})
        .drop("_i")
    )


def monthly_scaffold(
    reference: DataFrame, areas: DataFrame, year: int | None = None, month: int | None = None, check: bool = True
) -> DataFrame:
    """One month's scaffold: the reference rows of that month, or every area if it has none."""
    if year is None or month is None:
        top = latest_month(reference.select(*[as_int(reference, c).alias(c) for c in ("year", "month")])).first()
        if top is None or top["year"] is None:
            raise ValueError("reference scaffold has no rows")
        year = top["year"] if year is None else year
        month = top["month"] if month is None else month
    check_target_month(year, month)
    here = reference.where((as_int(reference, "year") == year) & (as_int(reference, "month") == month))
    source = areas.select(F.col("area_id").alias("admin_code"), "lat", "lon") if here.isEmpty() else here
    rows = source.select("admin_code", "lat", "lon", F.lit(year).alias("year"), F.lit(month).alias("month"))
    if check:
        require_unique(rows, SCAFFOLD_COLUMNS, "scaffold")
    return rows


def month_universe(left: DataFrame, right: DataFrame | None = None) -> DataFrame:
    """Months of the left table, or of both tables."""
    months = left.select("year", "month")
    if right is not None:
        months = months.unionByName(right.select("year", "month"))
    return months.distinct()
