"""Pixel centres in polygons and zonal statistics.

Pixels and zones meet on a coarse grid cell. Each zone and cell pair carries only the polygon
edges that can cross an eastward ray from inside that cell, so the even-odd test costs the edges
near the cell and not the whole outline. The pixel side is never shuffled when the zone cells are
measured to be small; beyond that both sides are hashed on the cell, salted on the pixel side so
that one dense cell is shared by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import strip
from ..session import cut_lineage, dealt
from .quality import QualityError, require_same_universe, require_unique, require_zero

PIXEL_RULE = "all_touched_false_center_inside"


def check_pixel_rule(rule: str) -> None:
    if rule != PIXEL_RULE:
        raise QualityError(f"pixel inclusion rule must be {PIXEL_RULE}")


def _cell(column: Column, size: float) -> Column:
    return F.floor(column / F.lit(size)).cast("int")


def _ring_edges(ring: Column) -> Column:
    """Consecutive vertices of a ring; the last one connects to the first."""
    n = F.size(ring)
    return F.transform(
        ring,
        lambda p, i: F.struct(
            p["lon"].alias("x1"),
            p["lat"].alias("y1"),
            F.element_at(ring, F.pmod(i + 1, n) + 1)["lon"].alias("x2"),
            F.element_at(ring, F.pmod(i + 1, n) + 1)["lat"].alias("y2"),
        ),
    )


def zone_cells(zones: DataFrame, cell: float = 1.0) -> DataFrame:
    """``area_id, _row, _col, edges``: each zone once per grid cell its bounding box touches.

    Holes and separate parts are just more rings. Edges above, below or wholly west of the cell
    cannot cross a ray that runs east from inside it, and are left out.
    """
    edges = F.flatten(F.transform("rings", _ring_edges))
    outlined = zones.select("area_id", edges.alias("edges")).where(F.size("edges") > 0)
    xs, ys = F.transform("edges", lambda e: e["x1"]), F.transform("edges", lambda e: e["y1"])
    boxed = outlined.select(
        "area_id",
        "edges",
        F.explode(F.sequence(_cell(F.array_min(ys), cell), _cell(F.array_max(ys), cell))).alias("_row"),
        F.sequence(_cell(F.array_min(xs), cell), _cell(F.array_max(xs), cell)).alias("_cols"),
    )
    south, north = F.col("_row") * cell, (F.col("_row") + 1) * cell
    banded = boxed.select(
        "area_id",
        "_row",
        "_cols",
        F.filter(
            "edges",
            lambda e: (F.greatest(e["y1"], e["y2"]) >= south) & (F.least(e["y1"], e["y2"]) <= north) & (e["y1"] != e["y2"]),
        ).alias("edges"),
    )
    west = F.col("_col") * cell
    return (
        banded.select("area_id", "_row", "edges", F.explode("_cols").alias("_col"))
        .select("area_id", "_row", "_col", F.filter("edges", lambda e: F.greatest(e["x1"], e["x2"]) >= west).alias("edges"))
        .where(F.size("edges") > 0)
    )


def _inside(lon: Column, lat: Column, edges: Column) -> Column:
    """Even-odd rule with half-open edges, so a shared border belongs to one neighbour only."""

    def crosses(e: Column) -> Column:
        straddles = (e["y1"] > lat) != (e["y2"] > lat)
        at = (e["x2"] - e["x1"]) * (lat - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        return straddles & (lon < at)

    return F.size(F.filter(edges, crosses)) % 2 == 1


def pixels_in_zones(
    pixels: DataFrame,
    zones: DataFrame,
    cell: float = 1.0,
    broadcast_edges: int = 2_000_000,
    salts: int = 16,
) -> DataFrame:
    """Pixels with the ``area_id`` of every zone that holds their centre."""
    cells = zone_cells(zones, cell)
    keyed = pixels.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select(
        "*", _cell(F.col("lat"), cell).alias("_row"), _cell(F.col("lon"), cell).alias("_col")
    )
    size = cells.agg(F.sum(F.size("edges") + 4).alias("n")).first()["n"] or 0
    if size <= broadcast_edges:
        joined = keyed.join(F.broadcast(cells), ["_row", "_col"])
    else:
        spread = F.pmod(F.xxhash64("lon", "lat", *[f"`{c}`" for c in pixels.columns]), F.lit(salts)).cast("int")
        copies = cells.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = keyed.withColumn("_salt", spread).join(copies.hint("merge"), ["_row", "_col", "_salt"])
    return joined.where(_inside(F.col("lon"), F.col("lat"), F.col("edges"))).select("area_id", *[f"`{c}`" for c in pixels.columns])


def zonal_statistics(
    pixels: DataFrame,
    zones: DataFrame,
    keys: Sequence[str] = ("year", "month"),
    statistics: Sequence[str] = ("mean", "std"),
    value: str = "value",
    nodata: float | None = None,
    scaffold: DataFrame | None = None,
    cell: float = 1.0,
    rule: str = PIXEL_RULE,
) -> DataFrame:
    """Mean, population deviation, sum and pixel count per zone and key.

    Null, NaN and nodata pixels are skipped. With a ``scaffold`` of ``area_id`` and keys, zones
    without any pixel keep a row of nulls.
    """
    check_pixel_rule(rule)
    v = F.col(value)
    usable = v.isNotNull() & ~F.isnan(v.cast("double"))
    if nodata is not None:
        usable = usable & (v != F.lit(nodata))
    found = pixels_in_zones(pixels.where(usable), zones, cell)
    recipe = {"mean": F.avg(v), "std": F.stddev_pop(v), "sum": F.sum(v), "count": F.count(v)}
    stats = found.groupBy("area_id", *keys).agg(*[recipe[s].alias(f"{value}_{s}") for s in statistics])
    return stats if scaffold is None else scaffold.join(stats, ["area_id", *keys], "left")


def zone_counts(stats: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Zones and zones without any pixel, for each of ``keys``."""
    return stats.groupBy(*keys).agg(F.count(F.lit(1)).alias("zone_count"), F.count_if(F.col(column).isNull()).alias("empty_zone_count"))


def merge_tiles(
    tiles: DataFrame, step: float, keys: Sequence[str] = ("year", "month", "band"), tile: str | None = None, broadcast_tiles: int = 100_000
) -> DataFrame:
    """One pixel per grid position and month where tiles overlap.

    With ``tile``, the column that names a pixel's tile, values are blended: a pixel weighs its
    distance to the nearest border of its tile in grid steps, plus one, so a tile fades out towards its
    border. Extents are the tiles' own least and greatest positions, one row a tile. Without it,
    values are averaged. Null values have no weight.

    Few pixels share a place, so pixels are counted and dealt by place before they are grouped: a map-side
    combine would hold a row for almost every pixel of a task and merge little. Extents are found once and
    broadcast, up to ``broadcast_tiles`` of them, as a join by tile would gather a tile's pixels in one task.
    """
    at = [*keys, "_y", "_x"]
    places = [F.round(F.col(c) / step).cast("bigint").alias(n) for c, n in (("lat", "_y"), ("lon", "_x"))]
    if tile is None:
        placed = tiles.select(*keys, *places, "value")
        merged = dealt(placed, tiles.count(), *at).groupBy(*at).agg(F.avg("value").alias("value"))
    else:
        placed = tiles.select(*keys, F.col(f"`{tile}`").alias("_tile"), *places, "value")
        extents = cut_lineage(
            placed.groupBy("_tile").agg(
                F.count(F.lit(1)).alias("_n"), *[f(c).alias(f"{c}{n}") for c in ("_x", "_y") for n, f in ((0, F.min), (1, F.max))]
            )
        )
        size = extents.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("pixels"), F.count(F.lit(1)).alias("tiles")).first()
        side = F.broadcast(extents) if size["tiles"] <= broadcast_tiles else extents
        steps = F.least(*[F.col(c) - F.col(f"{c}0") for c in ("_x", "_y")], *[F.col(f"{c}1") - F.col(c) for c in ("_x", "_y")])
        weighed = placed.join(side, "_tile").select(*at, "value", F.when(F.col("value").isNotNull(), steps + 1).alias("_w"))
        total = F.sum(F.col("_w") * F.col("value")).cast("double") / F.sum("_w").cast("double")
        merged = dealt(weighed, size["pixels"], *at).groupBy(*at).agg(total.alias("value"))
    return merged.select(*keys, (F.col("_y") * step).alias("lat"), (F.col("_x") * step).alias("lon"), "value")


def require_zone_ids(zones: DataFrame, scaffold: DataFrame | None = None) -> None:
    """Zone ids are present and unique, and equal the scaffold's ids where one is given."""
    require_zero(zones, {"blank area_id": F.coalesce(strip(F.col("area_id")) == "", F.lit(True))}, "geometry")
    require_unique(zones, ["area_id"], "geometry")
    if scaffold is not None:
        require_zero(scaffold, {"blank area_id": F.coalesce(strip(F.col("area_id")) == "", F.lit(True))}, "scaffold")
        require_unique(scaffold, ["area_id"], "scaffold")
        require_same_universe(zones, scaffold, ["area_id"], "geometry and scaffold")
