"""Wide to long and back, without a shuffle where every row already holds all it needs."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import BAND_COLUMN_PATTERN, LAND_SURFACE_BANDS, MONTH_COLUMN_PATTERN
from ..session import cut_lineage
from .dedup import keep_one
from .joins import mapped_join


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _name(name: str) -> str:
    """A column name in an expression."""
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    """A text in an expression."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def parse_month_column(name: str) -> tuple[int, int, str | None] | None:
    """(year, month, band) of ``YYYY_MM``, ``YYYY.Mmm`` or ``YYYY_MM_Bn``; None for other names."""
    banded = re.match(BAND_COLUMN_PATTERN, name)
    if banded:
        return int(banded[1]), int(banded[2]), "B" + banded[3]
    plain = re.match(MONTH_COLUMN_PATTERN, name)
    return (int(plain[1]), int(plain[2]), None) if plain else None


def wide_to_long(
    df: DataFrame,
    feature: str,
    id_column: str = "region_id",
    mapping: DataFrame | None = None,
    mapping_region: str = "region_id",
    mapping_area: str = "area_id",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """One row per area and month; bands become columns ``feature_Bn``, absent bands null.

    A wide row holds every band of its months, so each row unfolds on its own: no pivot and
    no shuffle. Where ids may repeat, ``order`` says which row is later and so wins.
    """
    slots: dict[tuple[int, int], dict[str | None, str]] = {}
    for name in df.columns:
        parsed = parse_month_column(name)
        if parsed:
            slots.setdefault(parsed[:2], {})[parsed[2]] = name
    if not slots:
        raise ValueError("no supported monthly columns found")
    if id_column not in df.columns:
        raise ValueError(f"missing id column {id_column}")
    bands = sorted({b for s in slots.values() for b in s}, key=lambda b: (b is not None, int(b[1:]) if b else 0))
    if mapping is None:
        keyed = df.withColumn("area_id", _col(id_column))
    else:
        keyed = mapped_join(df, mapping, id_column, mapping_region, mapping_area)
    if order is not None:
        keyed = keep_one(keyed, ["area_id"], order, last=True)
    # One expression as text: hundreds of cells as Column objects cost more time than the query.
    labels = {b: _text(feature if b is None else f"{feature}_{b}") for b in bands}
    months = [
        f"named_struct('year', {year}, 'month', {month}, "
        + ", ".join(f"{labels[b]}, {f'try_cast({_name(names[b])} AS DOUBLE)' if b in names else 'CAST(NULL AS DOUBLE)'}" for b in bands)
        + ")"
        for (year, month), names in sorted(slots.items())
    ]
    return keyed.select("area_id", F.expr(f"inline(array({', '.join(months)}))"))


def bands_to_long(parts: Iterable[DataFrame], feature: str, id_column: str = "region_id") -> DataFrame:
    """Several wide extracts that split the months between them, as one long table."""
    longs = [wide_to_long(part, feature, id_column) for part in parts]
    united = longs[0]
    for part in longs[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    return united


def select_month(df: DataFrame, feature: str, year: int, month: int, id_column: str = "region_id") -> DataFrame:
    """The one month column of a wide table as long rows."""
    name = f"{year}_{month:02d}"
    if name not in df.columns:
        raise ValueError(f"missing selected month column {name}")
    return df.select(
        _col(id_column).alias("area_id"), F.lit(year).alias("year"), F.lit(month).alias("month"), _col(name).alias(feature)
    )


def years_to_long(
    df: DataFrame, id_column: str, value: str, drop: Sequence[str] = (), id_alias: str = "country_code_3"
) -> DataFrame:
    """Year columns (``2019`` or ``2019 [YR2019]``) to rows with an integer year, nulls dropped."""
    years = [c for c in df.columns if c != id_column and c not in drop]
    long = df.select(_col(id_column).alias(id_alias), *[_col(c).try_cast("double").alias(c) for c in years]).unpivot(
        [id_alias], [f"`{c}`" for c in years], "_name", value
    )
    return long.where(F.col(value).isNotNull()).select(
        id_alias, F.split("_name", " ")[0].try_cast("int").alias("year"), value
    )


def slots(df: DataFrame, keys: Sequence[str], slot: Column, value: Column, combine: Callable[[Column], Column] = F.max) -> DataFrame:
    """Per key one map ``slots`` from slot number to the combined value there.

    Values are combined by hash for each key and slot first, so a key brings at most one entry a slot to
    the map, however many rows it has. A key without any slot has an empty map.
    """
    cells = df.groupBy(*[_col(k) for k in keys], slot.alias("_slot")).agg(combine(value).alias("_value"))
    entry = F.when(F.col("_slot").isNotNull(), F.struct("_slot", "_value"))
    return cells.groupBy(*[_col(k) for k in keys]).agg(F.map_from_entries(F.collect_list(entry)).alias("slots"))


def unfold_slots(df: DataFrame, names: Mapping[int, str], others: Sequence[str]) -> DataFrame:
    """One column per named slot beside ``others``; a slot without a value is null."""
    return df.selectExpr(*[_name(c) for c in others], *[f"slots[{n}] AS {_name(name)}" for n, name in names.items()])


def long_to_wide(
    df: DataFrame,
    value: str,
    months: Sequence[tuple[int, int]] | None = None,
    id_column: str = "region_id",
    combine: Callable[[Column], Column] = F.max,
) -> DataFrame:
    """One column ``YYYY_MM`` per month, in calendar order.

    Without ``months`` they are read from the table first: at most one row per calendar month.
    """
    if months is None:
        months = [(r["year"], r["month"]) for r in df.select("year", "month").distinct().collect()]
    month = (F.col("year") * 12 + F.col("month") - 1).cast("int")
    names = {12 * y + m - 1: f"{y}_{m:02d}" for y, m in sorted(months)}
    return unfold_slots(slots(df, [id_column], month, _col(value), combine), names, [id_column])


def bands_to_wide(
    df: DataFrame, value: str, bands: Sequence[int], id_column: str = "region_id", combine: Callable[[Column], Column] = F.max
) -> Callable[[int], DataFrame]:
    """Wide extracts ``YYYY_MM_Bn`` of any year, from rows with year, month and a band number.

    The rows are read once: slots of all years are combined and cut, and each year's extract unfolds its own.
    """
    slot = (F.col("month") * (max(bands) + 1) + F.col("band")).cast("int")
    years = cut_lineage(slots(df, [id_column, "year"], slot, _col(value), combine))

    def extract(year: int) -> DataFrame:
        names = {m * (max(bands) + 1) + b: f"{year}_{m:02d}_B{b}" for m in range(1, 13) for b in bands}
        return unfold_slots(years.where(F.col("year") == year), names, [id_column])

    return extract


def long_bands_to_columns(
    df: DataFrame, value: str, bands: Sequence[str], keys: Sequence[str] = ("area_id", "year", "month")
) -> DataFrame:
    """Band rows to band columns from an explicit band list, one aggregate."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col("band") == b, F.col(value))).alias(b) for b in bands])


def union_columns(parts: Iterable[DataFrame], key: str = "region_id") -> DataFrame:
    """Row union with the sorted union of all columns; what a part lacks is null."""
    frames = list(parts)
    united = frames[0]
    for part in frames[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    return united.select(key, *[_col(c) for c in sorted(c for c in united.columns if c != key)])


def rename_bands(df: DataFrame, mean_suffix: str = "_x", std_suffix: str = "_y") -> DataFrame:
    """``B1_x`` -> first land-surface variable's mean, ``B1_y`` -> its deviation, and so on."""
    names = {}
    for number, variable in enumerate(LAND_SURFACE_BANDS, start=1):
        names[f"B{number}{mean_suffix}"] = f"{variable}_mean"
        names[f"B{number}{std_suffix}"] = f"{variable}_stdDev"
    return df.withColumnsRenamed(names)
