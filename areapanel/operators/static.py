"""Fixed and slowly moving area features taken from a monthly panel."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import (
    AEZ_PREFIX,
    COASTLINE_FAMILY,
    COASTLINE_FEATURE,
    IDENTIFIER_COLUMNS,
    STATIC_FAMILIES,
)
from ..functions.keys import year_month_text
from ..functions.nulls import is_missing, null_if_blank
from .joins import coordinate_lookup
from .quality import as_int


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def ordered_features(columns: Sequence[str]) -> list[tuple[str, str]]:
    """(feature, family) for the families present: zones by number first, then the fixed order."""
    zones = [c for c in columns if re.fullmatch(AEZ_PREFIX + r"\d+", c)]
    zones.sort(key=lambda c: int(c[len(AEZ_PREFIX):]))
    listed = [(c, "aez") for c in zones]
    listed += [(c, family) for family, members in STATIC_FAMILIES.items() for c in members if c in columns]
    return listed


def _present(df: DataFrame, name: str) -> Column:
    return ~is_missing(df.schema[name], "static")


def _date_parts(df: DataFrame) -> tuple[Column, Column]:
    year, month = as_int(df, "year"), as_int(df, "month")
    valid = year.isNotNull() & month.isNotNull()
    return F.when(valid, year).otherwise(-1), F.when(valid, month).otherwise(-1)


def latest_nonmissing(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    identifiers: Sequence[str] = (),
    sequence: str = "seq",
) -> DataFrame:
    """One row per area: latest present value per column, first and last month, row count.

    Features go by date and then by ``sequence``; identifiers by ``sequence`` alone. An
    unreadable date sorts first. Every column is its own aggregate over one grouping, so the
    table is shuffled once and a hot area is reduced before that.
    """
    year, month = _date_parts(df)
    dated = F.struct(year.alias("y"), month.alias("m"), F.col(sequence).alias("s"))
    aggregates = [
        F.count(F.lit(1)).alias("source_row_count"),
        F.min(F.struct(year.alias("y"), month.alias("m"))).alias("_first"),
        F.max(F.struct(year.alias("y"), month.alias("m"))).alias("_last"),
        *[F.max_by(_col(c), F.when(_present(df, c), F.col(sequence))).alias(c) for c in identifiers],
        *[F.max_by(_col(c), F.when(_present(df, c), dated)).alias(c) for c in features],
    ]
    rows = df.where(_present(df, key)).groupBy(_col(key)).agg(*aggregates)
    return rows.select(
        _col(key),
        *[_col(c) for c in identifiers],
        "source_row_count",
        year_month_text(F.col("_first.y"), F.col("_first.m")).alias("first_year_month"),
        year_month_text(F.col("_last.y"), F.col("_last.m")).alias("last_year_month"),
        *[_col(c) for c in features],
    )


def stability(df: DataFrame, key: str, features: Sequence[tuple[str, str]]) -> DataFrame:
    """Per feature: areas, present rows, distinct values per area and the resulting class.

    Values repeat heavily within an area, so they collapse to one row per (feature, area, value)
    on the map side before anything is shuffled.
    """
    names = [name for name, _ in features]
    kept = df.where(_present(df, key)).select(
        _col(key).alias("_area"), *[F.when(_present(df, c), _col(c).cast("string")).alias(c) for c in names]
    )
    long = kept.unpivot(["_area"], [_col(c) for c in names], "feature", "v")
    per_value = long.groupBy("feature", "_area", "v").agg(F.count("v").alias("n"))
    per_area = per_value.groupBy("feature", "_area").agg(F.sum("n").alias("n"), F.count("v").alias("distinct_values"))
    per_feature = per_area.groupBy("feature").agg(
        F.count(F.lit(1)).alias("areas_total"),
        F.count_if(F.col("n") > 0).alias("areas_with_value"),
        F.count_if(F.col("n") == 0).alias("missing_area_count"),
        F.sum("n").alias("source_nonmissing_rows"),
        F.max("distinct_values").alias("max_distinct_values_per_area"),
        F.count_if(F.col("distinct_values") > 1).alias("varying_area_count"),
    )
    family = F.create_map(*[F.lit(x) for pair in features for x in pair])
    label = F.when(F.col("max_distinct_values_per_area") <= 1, "verified_static_in_source_panel").otherwise(
        "slow_or_varying_in_source_panel"
    )
    return per_feature.select("*", family[F.col("feature")].alias("family"), label.alias("classification"))


def build_static_features(
    panel: DataFrame, coastline: DataFrame | None = None, sequence: str = "seq"
) -> tuple[DataFrame, DataFrame]:
    """(one row per area, one summary row per feature) from a historical panel."""
    features = ordered_features(panel.columns)
    names = [name for name, _ in features]
    identifiers = ["lat", "lon", *IDENTIFIER_COLUMNS]
    areas = latest_nonmissing(panel, "admin_code", names, identifiers, sequence)
    table = areas.select(F.col("admin_code").alias("area_id"), "*")
    summary = stability(panel, "admin_code", features)
    if coastline is not None:
        lookup = coastline.withColumn(COASTLINE_FEATURE, null_if_blank(F.col(COASTLINE_FEATURE), "static"))
        table = coordinate_lookup(table, lookup, COASTLINE_FEATURE, [sequence])
        found = F.count(F.col(COASTLINE_FEATURE))
        summary = summary.unionByName(
            table.agg(
                F.lit(COASTLINE_FEATURE).alias("feature"),
                F.lit(COASTLINE_FAMILY).alias("family"),
                F.count(F.lit(1)).alias("areas_total"),
                found.alias("areas_with_value"),
                (F.count(F.lit(1)) - found).alias("missing_area_count"),
                found.alias("source_nonmissing_rows"),
                F.when(found > 0, 1).otherwise(0).cast("bigint").alias("max_distinct_values_per_area"),
                F.lit(0).cast("bigint").alias("varying_area_count"),
                F.lit("verified_static_in_source_panel").alias("classification"),
            )
        )
    return table.orderBy(F.col("area_id").try_cast("bigint"), "area_id"), summary
