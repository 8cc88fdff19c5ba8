"""Left joins that keep every left row, with match counts and cardinality gates.

No broadcast hints: Spark broadcasts a side when its known size is under the threshold, and
adaptive execution re-decides from the measured size; beyond it the join is a sort-merge
join whose hot keys are split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import coordinate_rounded
from .dedup import keep_one
from .quality import require_no_rows, require_unique


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    matched: str | None = None,
    null_keys: str = "drop",
    validate: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """Left join on equal keys; columns the left side already has win.

    ``matched`` names a boolean column that tells a hit from a miss. ``null_keys="match"``
    lets null meet null. ``validate`` is ``"many_to_one"`` or ``"one_to_one"``. ``salts`` spreads
    a left key that holds a large share of the rows over as many tasks, for the price of as many
    copies of the right side; adaptive execution cannot split it when the right side comes
    straight out of a grouping by the same key.
    """
    if validate in ("many_to_one", "one_to_one"):
        require_unique(right, keys, "right side")
    if validate == "one_to_one":
        require_unique(left, keys, "left side")
    taken = set(left.columns)
    wanted = [c for c in (columns if columns is not None else right.columns) if c not in taken and c not in keys]
    side = right.select(
        *[_col(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
        *[_col(c) for c in wanted],
        F.lit(True).alias("_hit"),
    )
    condition = F.lit(True)
    for i, key in enumerate(keys):
        mine, theirs = _col(key), F.col(f"_key_{i}")
        condition = condition & (mine.eqNullSafe(theirs) if null_keys == "match" else mine == theirs)
    rows = left
    if salts > 1:
        spread = F.xxhash64(*[_col(c) for c in left.columns])
        rows = left.withColumn("_left_salt", F.pmod(spread, F.lit(salts)).cast("int"))
        side = side.withColumn("_right_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        condition = condition & (F.col("_left_salt") == F.col("_right_salt"))
    joined = rows.join(side, condition, "left")
    flag = [F.coalesce(F.col("_hit"), F.lit(False)).alias(matched)] if matched else []
    return joined.select(*[_col(c) for c in left.columns], *[_col(c) for c in wanted], *flag)


def grouped_left_join(left: DataFrame, right: DataFrame, group: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """:func:`left_join` on ``group`` and ``keys``, for a right side with one row per key.

    Right rows meet as one map per group, so a left side that lies dealt by ``group`` stays where it is;
    a join on all the keys would shuffle it again. Only for groups that bound their keys, such as the
    months of an area.
    """
    wanted = [c for c in right.columns if c not in left.columns]
    if not wanted or any(left.schema[c].dataType != right.schema[c].dataType for c in keys):
        return left_join(left, right, [*group, *keys])
    key = F.struct(*[_col(c) for c in keys])
    side = right.dropna(subset=[*group, *keys]).groupBy(*[_col(c).alias(f"_group_{i}") for i, c in enumerate(group)]).agg(
        F.map_from_entries(F.collect_list(F.struct(key, F.struct(*[_col(c) for c in wanted])))).alias("_held")
    )
    condition = F.lit(True)
    for i, c in enumerate(group):
        condition = condition & (_col(c) == F.col(f"_group_{i}"))
    met = F.try_element_at("_held", key)
    return left.join(side, condition, "left").select(*[_col(c) for c in left.columns], *[met[c].alias(c) for c in wanted])


def match_counts(joined: DataFrame, matched: str) -> DataFrame:
    """How many rows came from both sides and how many from the left only."""
    side = F.when(_col(matched), "both").otherwise("left_only")
    return joined.groupBy(side.alias("merge")).agg(F.count(F.lit(1)).alias("n_rows"))


def mapped_join(
    df: DataFrame, mapping: DataFrame, id_column: str, mapping_region: str = "region_id", mapping_area: str = "area_id"
) -> DataFrame:
    """Attach ``area_id``; a repeated region in the mapping or a region without one is an error."""
    pairs = mapping.select(_col(mapping_region).alias(id_column), _col(mapping_area).alias("area_id"))
    require_unique(pairs, [id_column], "mapping")
    require_no_rows(df.join(pairs, id_column, "left_anti"), "unmatched regions")
    return df.join(pairs, id_column, "left")


def coordinate_lookup(
    df: DataFrame,
    lookup: DataFrame,
    value: str,
    order: Sequence[str],
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Attach ``value`` by rounded coordinates; of repeated coordinates the last one wins."""
    rounded = [coordinate_rounded(_col(lat)), coordinate_rounded(_col(lon))]
    side = keep_one(
        lookup.where(_col(value).isNotNull())
        .select(rounded[0].alias("_lat"), rounded[1].alias("_lon"), _col(value), *[_col(c).alias(f"_o_{c}") for c in order])
        .dropna(subset=["_lat", "_lon"]),
        ["_lat", "_lon"],
        [f"_o_{c}" for c in order],
        last=True,
    ).select("_lat", "_lon", value)
    keyed = df.drop(value).select("*", rounded[0].alias("_lat"), rounded[1].alias("_lon"))
    return keyed.join(side, ["_lat", "_lon"], "left").drop("_lat", "_lon")


def lookup_country_code(df: DataFrame, names: DataFrame, column: str = "country_name", code: str = "country_code_3") -> DataFrame:
    """Three-letter code by country name, official name or short code; unknown names give null.

    ``names`` has one row per spelling: ``name`` and the code column. Spellings are compared
    trimmed and in lower case.
    """
    side = keep_one(
        names.select(F.lower(F.trim(_col("name"))).alias("_name"), _col(code)), ["_name"], [code]
    )
    return df.withColumn("_name", F.lower(F.trim(_col(column)))).join(side, "_name", "left").drop("_name")


def parent_totals(
    units: DataFrame, parents: Sequence[tuple[DataFrame, Sequence[str]]]
) -> DataFrame:
    """Attach wider-area totals to small units, one left join per level."""
    for totals, keys in parents:
        units = units.join(totals, list(keys), "left")
    return units


def zip_by_sequence(left: DataFrame, right: DataFrame, sequence: str = "seq") -> DataFrame:
    """Row n of one table beside row n of the other, by an explicit row number on both."""
    return left.join(right.select(sequence, *[_col(c) for c in right.columns if c not in left.columns]), sequence, "left")


def join_audit(zones: DataFrame, predictions: DataFrame, key: str = "area_id") -> DataFrame:
    """Rows on both sides, matched and unmatched zones, unmatched predictions, in one pass."""
    tagged = zones.select(_col(key).alias("k"), F.lit(1).alias("z"), F.lit(0).alias("p")).unionByName(
        predictions.select(_col(key).alias("k"), F.lit(0).alias("z"), F.lit(1).alias("p"))
    )
    per_key = tagged.groupBy("k").agg(F.sum("z").alias("z"), F.sum("p").alias("p"))
    return per_key.agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("prediction_rows"),
        F.coalesce(F.sum("z"), F.lit(0)).alias("spatial_rows"),
        F.coalesce(F.sum(F.when(F.col("p") > 0, F.col("z"))), F.lit(0)).alias("matched_rows"),
        F.coalesce(F.sum(F.when(F.col("p") == 0, F.col("z"))), F.lit(0)).alias("unmatched_spatial_rows"),
        F.count_if((F.col("p") > 0) & (F.col("z") == 0)).alias("unmatched_prediction_ids"),
    )
