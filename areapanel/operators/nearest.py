"""Nearest right point within a radius, per month, for every left point. Exact at any skew.

Brute force compares every pair of a month. Here both sides are summarised into grid blocks
(bounding box and count of distinct positions), and only block pairs that can hold a nearest
neighbour are kept: the smallest possible distance of the pair must not exceed the radius, nor
the largest possible distance to the block's best alternative. Pairs that are still too big are
split into quarter-size blocks and pruned again, so a month, a city or a single cell with a third
of all points is refined instead of being compared pair by pair. What remains is joined point
by point with the exact distance.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.fixed import MATCH_RADIUS_KM
from ..functions.geo import haversine_term, km_to_term, term_to_km
from ..session import cut_lineage
from .dedup import keep_one

BROADCAST_KEYS = 100_000
"""Distinct match keys that are sent to all executors at most; beyond, Spark decides."""

# Bounds are compared with a little room, so rounding in them can never prune a true neighbour.
_ROOM = 1e-9
_COARSEST = 45.0
_FINEST = 1e-7


def _cell(column: Column, size: float) -> Column:
    return F.floor(column / F.lit(size)).cast("bigint")


def _blocks(points: DataFrame, by: Sequence[str], size: float, side: str) -> DataFrame:
    """Occupied blocks with their bounding box and number of positions."""
    return points.groupBy(
        *by, _cell(F.col("lat"), size).alias(f"{side}_row"), _cell(F.col("lon"), size).alias(f"{side}_col")
    ).agg(
        F.count(F.lit(1)).alias(f"{side}_n"),
        F.min("lat").alias(f"{side}_lat0"),
        F.max("lat").alias(f"{side}_lat1"),
        F.min("lon").alias(f"{side}_lon0"),
        F.max("lon").alias(f"{side}_lon1"),
    )


def _cos_range(lat0: Column, lat1: Column) -> tuple[Column, Column]:
    a, b = F.cos(F.radians(lat0)), F.cos(F.radians(lat1))
    return F.least(a, b), F.when((lat0 <= 0) & (lat1 >= 0), F.lit(1.0)).otherwise(F.greatest(a, b))


def _square_sine(degrees: Column) -> Column:
    return F.pow(F.sin(F.radians(degrees) / 2), F.lit(2))


def _distance_bounds(pairs: DataFrame) -> DataFrame:
    """Add the least and greatest haversine term any two points of the boxes can have."""
    c = F.col
    lat_gap = F.greatest(c("l_lat0") - c("r_lat1"), c("r_lat0") - c("l_lat1"), F.lit(0.0))
    lat_span = F.greatest(c("l_lat1") - c("r_lat0"), c("r_lat1") - c("l_lat0"))
    # Longitude differences run from east_lo to east_hi before wrapping round the globe.
    east_lo, east_hi = c("r_lon0") - c("l_lon1"), c("r_lon1") - c("l_lon0")
    gap = F.greatest(east_lo, -east_hi, F.lit(0.0))
    gap = F.least(gap, F.greatest(F.lit(360.0) - F.greatest(F.abs(east_lo), F.abs(east_hi)), F.lit(0.0)))
    span = F.least(F.greatest(F.abs(east_lo), F.abs(east_hi)), F.lit(180.0))
    l_cos0, l_cos1 = _cos_range(c("l_lat0"), c("l_lat1"))
    r_cos0, r_cos1 = _cos_range(c("r_lat0"), c("r_lat1"))
    least = _square_sine(lat_gap) + l_cos0 * r_cos0 * _square_sine(gap)
    most = _square_sine(F.least(lat_span, F.lit(180.0))) + l_cos1 * r_cos1 * _square_sine(span)
    return pairs.select("*", least.alias("_least"), F.least(most, F.lit(1.0)).alias("_most"))


def _prune(pairs: DataFrame, by: Sequence[str], reach: float) -> DataFrame:
    """Keep pairs within reach that can beat the left block's best guaranteed distance."""
    mine = W.partitionBy(*by, "l_row", "l_col")
    bounded = _distance_bounds(pairs).where(F.col("_least") <= reach * (1 + _ROOM) + 1e-15)
    return (
        bounded.select("*", F.min("_most").over(mine).alias("_best"))
        .where(F.col("_least") <= F.col("_best") * (1 + _ROOM) + 1e-15)
        .drop("_least", "_most", "_best")
    )


def _neighbours(left_blocks: DataFrame, size: float, radius_km: float) -> DataFrame:
    """Each left block once per grid block that can lie within the radius.

    Rows reach as far as the radius in degrees. Columns reach further towards the poles and wrap
    at the date line; a block whose reach covers a pole meets every column. The number of grid
    blocks is fixed by the radius and block size, whatever the number of points.
    """
    degree_reach = radius_km / 111.0
    rows = F.sequence(_cell(F.col("l_lat0") - degree_reach, size), _cell(F.col("l_lat1") + degree_reach, size))
    edge = F.greatest(F.abs("l_lat0"), F.abs("l_lat1")) + degree_reach
    # Half width of a circle of this radius whose centre is at latitude `edge - reach`.
    ratio = F.sin(F.radians(F.lit(degree_reach))) / F.cos(F.radians(edge - degree_reach))
    lon_reach = F.when((edge >= 90.0) | (ratio >= 1.0), F.lit(360.0)).otherwise(F.degrees(F.asin(ratio)) + 0.01)
    columns_round = int(360.0 / size)
    first, last = _cell(F.lit(-180.0), size), _cell(F.lit(-180.0), size) + columns_round - 1
    west = _cell(F.col("l_lon0") - lon_reach, size)
    east = _cell(F.col("l_lon1") + lon_reach, size)
    whole_ring = east - west + 1 >= columns_round
    span = F.when(whole_ring, F.sequence(first, last)).otherwise(F.sequence(west, east))
    wrapped = F.transform(span, lambda k: F.pmod(k - first, F.lit(columns_round)) + first)
    return left_blocks.withColumn("r_row", F.explode(rows)).withColumn("r_col", F.explode(wrapped))


def _wrap_lon(lon: Column) -> Column:
    inside = (lon >= -180.0) & (lon < 180.0)
    return F.when(inside, lon).otherwise(F.pmod(lon + 180.0, F.lit(360.0)) - 180.0)


def _nearest_pairs(
    lefts: DataFrame, rights: DataFrame, by: Sequence[str], max_km: float, pair_limit: int, start: float
) -> DataFrame:
    """``by, l_lat, l_lon, _rid, _term``: the nearest right position of every left one in reach.

    Both inputs hold distinct positions: ``l_lat, l_lon`` or ``r_lat, r_lon, _rid``, and ``lat,
    lon`` with the longitude wrapped for the grid. Of equally distant positions the lowest id wins.
    """
    reach = km_to_term(max_km)
    size = start
    pairs = _prune(
        _neighbours(_blocks(lefts, by, size, "l"), size, max_km).join(
            _blocks(rights, by, size, "r").hint("merge"), [*by, "r_row", "r_col"]
        ),
        by,
        reach,
    )
    settled: list[tuple[float, DataFrame]] = []
    cells = ["l_row", "l_col", "r_row", "r_col"]
    product = F.col("l_n") * F.col("r_n")
    width = F.greatest(*[F.col(f"{s}_{x}1") - F.col(f"{s}_{x}0") for s in "lr" for x in ("lat", "lon")])
    while True:
        pairs = cut_lineage(pairs.select(*by, *cells, product.alias("_pairs"), width.alias("_width")))
        big = F.col("_pairs") > pair_limit
        widest = pairs.agg(F.max(F.when(big, F.col("_width"))).alias("w")).first()["w"]
        if not widest or size < _FINEST:
            settled.append((size, pairs.select(*by, *cells)))
            break
        settled.append((size, pairs.where(~big).select(*by, *cells)))
        # Go straight to blocks that cut the widest of these boxes, skipping sizes that would not.
        parent, size = size, size / 2
        while size > widest:
            size /= 2
        ratio = F.lit(int(parent / size))
        hot = pairs.where(big).select(*by, *[F.col(c).alias(f"{c}_up") for c in cells])
        for side, points in (("l", lefts), ("r", rights)):
            finer = _blocks(points, by, size, side)
            up = [F.floor(F.col(f"{side}_{axis}") / ratio).alias(f"{side}_{axis}_up") for axis in ("row", "col")]
            hot = hot.join(finer.select("*", *up), [*by, f"{side}_row_up", f"{side}_col_up"])
        pairs = _prune(hot, by, reach)

    def closest(size: float, block_pairs: DataFrame) -> DataFrame:
        mine = lefts.select(*by, "l_lat", "l_lon", _cell(F.col("lat"), size).alias("l_row"), _cell(F.col("lon"), size).alias("l_col"))
        theirs = rights.select(*by, "r_lat", "r_lon", "_rid", _cell(F.col("lat"), size).alias("r_row"), _cell(F.col("lon"), size).alias("r_col"))
        term = haversine_term(F.col("l_lat"), F.col("l_lon"), F.col("r_lat"), F.col("r_lon"))
        return (
            mine.join(block_pairs, [*by, "l_row", "l_col"])
            .join(theirs.hint("merge"), [*by, "r_row", "r_col"])
            .select(*by, "l_lat", "l_lon", term.alias("_term"), "_rid")
        )

    candidates = reduce(DataFrame.unionByName, [closest(s, p) for s, p in settled])
    best = candidates.groupBy(*by, "l_lat", "l_lon").agg(F.min(F.struct("_term", "_rid")).alias("_b"))
    return best.select(*by, "l_lat", "l_lon", "_b._rid", "_b._term")


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    right_id: str,
    by: Sequence[str] = ("year", "month"),
    max_km: float = MATCH_RADIUS_KM,
    payload: Sequence[str] | None = None,
    distance: str = "distance_km",
    unmatched_months: str = "keep",
    pair_limit: int = 4096,
    start: float | None = None,
) -> DataFrame:
    """Left rows with the payload of the nearest right row of their month and the distance.

    Payload and distance are null when nothing lies within ``max_km``. A month without right
    rows keeps its left rows (``"keep"``) or loses them (``"drop"``). ``right_id`` is unique
    within a month; of right rows at one position, or equally far, the lowest id wins.

    Distinct positions of both sides are checkpointed, as every refinement reads them again.
    ``start`` is the first block size in degrees, by default one to two and a half times the
    radius. It is 45 divided by a power of two, so that grid lines are exact in binary and
    halving a block never moves a point to another parent.
    """
    if unmatched_months not in ("keep", "drop"):
        raise ValueError(f"unmatched_months must be 'keep' or 'drop', got {unmatched_months!r}")
    by = list(by)
    columns = [c for c in (payload or right.columns) if c not in {*by, "lat", "lon", *left.columns}]
    if start is None:
        start = _COARSEST
        while start > 2.5 * max(max_km / 111.0, 0.01):
            start /= 2
    grid = ["lat", _wrap_lon(F.col("lon")).alias("lon")]
    lefts = cut_lineage(
        left.select(*by, "lat", "lon")
        .dropna()
        .distinct()
        .select(*by, F.col("lat").alias("l_lat"), F.col("lon").alias("l_lon"), *grid)
    )
    rights = cut_lineage(
        keep_one(right.dropna(subset=[*by, "lat", "lon", right_id]), [*by, "lat", "lon"], [right_id]).select(
            *by,
            F.col("lat").alias("r_lat"),
            F.col("lon").alias("r_lon"),
            F.col(right_id).alias("_rid"),
            F.struct(*columns).alias("_payload"),
            *grid,
        )
    )
    found = _nearest_pairs(lefts, rights, by, max_km, pair_limit, start)
    matched = (
        found.select(*by, "l_lat", "l_lon", "_rid", term_to_km(F.col("_term")).alias(distance))
        .where(F.col(distance) <= max_km)
        .join(rights.select(*by, "_rid", "_payload"), [*by, "_rid"])
        .select(*by, F.col("l_lat").alias("lat"), F.col("l_lon").alias("lon"), "_payload.*", distance)
    )
    rows = left
    if unmatched_months == "drop":
        # Each key is hot on the left side. Months are few; other keys are sent to all executors only where they are.
        keys = cut_lineage(rights.select(*by).distinct())
        few = keys.count() <= BROADCAST_KEYS
        rows = left.join(F.broadcast(keys) if few else keys, by, "left_semi")
    return rows.join(matched, [*by, "lat", "lon"], "left").select(*left.columns, *columns, distance)


def match_statistics(matched: DataFrame, distance: str = "distance_km") -> DataFrame:
    """Matches, rate in per cent and the spread of the distance."""
    d = F.col(distance)
    return matched.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(d).alias("n_matched"),
        F.round(F.count(d) / F.count(F.lit(1)) * 100, 2).alias("match_rate"),
        F.avg(d).alias("mean"),
        F.stddev_samp(d).alias("std"),
        F.min(d).alias("min"),
        F.max(d).alias("max"),
    )
