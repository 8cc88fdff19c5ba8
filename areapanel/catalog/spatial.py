"""Nearest matches, coordinate lookups and zonal statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fixed import MATCH_RADIUS_KM
from ..operators import nearest as N
from ..operators import zonal as Z
from ..operators.joins import coordinate_lookup
from ..operators.quality import universe
from ..plans.scaffold import month_spine
from . import Registry
from .views import (
    PIXELS_SQL,
    POINTS_SQL,
    haversine_sql,
    lat_of,
    lat_sql,
    left_points,
    lon_of,
    lon_sql,
    pixels,
    right_points,
    table,
    zones,
)

query = Registry()

_NEAREST_SQL = f"""{POINTS_SQL},
pairs AS (
  SELECT l.area_id, l.year, l.month, r.point_id, r.quantity, {haversine_sql('l.lat', 'l.lon', 'r.lat', 'r.lon')} AS km
  FROM left_points l JOIN {{right}} r ON r.year = l.year AND r.month = l.month),
best AS (
  SELECT area_id, year, month, arg_min({{{{'p': point_id, 'q': quantity, 'km': km}}}}, {{{{'km': km, 'p': point_id}}}}) AS b
  FROM pairs GROUP BY ALL)"""


def _nearest_sql(right: str = "right_points") -> str:
    return _NEAREST_SQL.format(right=right).replace("{{", "{").replace("}}", "}")


_MATCHED = f"""
matched AS (
  SELECT l.*, CASE WHEN b.km <= {MATCH_RADIUS_KM} THEN b.p END AS point_id, CASE WHEN b.km <= {MATCH_RADIUS_KM} THEN b.q END AS quantity,
         CASE WHEN b.km <= {MATCH_RADIUS_KM} THEN round(b.km, 6) END AS distance_km
  FROM left_points l LEFT JOIN best USING (area_id, year, month))"""


def _nearest(spark, sf_dir, right=None, unmatched_months="keep"):
    out = N.nearest_join(
        left_points(spark, sf_dir), right_points(spark, sf_dir) if right is None else right, "point_id", unmatched_months=unmatched_months
    )
    return out.withColumn("distance_km", F.round("distance_km", 6))


@query("j9_nearest_keep", f"WITH {_nearest_sql()}, {_MATCHED} SELECT * FROM matched")
def j9_nearest_keep(spark, sf_dir):
    """Nearest point of the month within 500 km; every left row stays."""
    return _nearest(spark, sf_dir)


_EVEN_MONTHS = "(SELECT * FROM right_points WHERE month % 2 = 0)"


@query(
    "j10_nearest_drop",
    f"WITH {_nearest_sql(_EVEN_MONTHS)}, {_MATCHED} SELECT * FROM matched WHERE month % 2 = 0 AND (year, month) IN (SELECT (year, month) FROM right_points)",
)
def j10_nearest_drop(spark, sf_dir):
    """Left rows of months without any right point drop out."""
    right = right_points(spark, sf_dir).where(F.col("month") % 2 == 0)
    return _nearest(spark, sf_dir, right, "drop")


@query(
    "j12_match_stats",
    f"""
WITH {_nearest_sql()}, {_MATCHED}
SELECT count(*) AS n_rows, count(distance_km) AS n_matched, round(count(distance_km) / count(*) * 100, 2) AS match_rate,
       round(avg(distance_km), 4) AS mean, round(stddev_samp(distance_km), 4) AS std, round(min(distance_km), 4) AS min, round(max(distance_km), 4) AS max
FROM matched""",
)
def j12_match_stats(spark, sf_dir):
    """Match count, rate and spread of the distance."""
    stats = N.match_statistics(_nearest(spark, sf_dir))
    return stats.withColumns({c: F.round(c, 4) for c in ("mean", "std", "min", "max")})


@query(
    "j13_coordinate_lookup",
    f"""
WITH lookup AS (
  SELECT round({lat_sql('s_suppkey')}, 10) AS la, round({lon_sql('s_suppkey')}, 10) AS lo, arg_max(s_acctbal, s_suppkey) AS coast
  FROM supplier WHERE s_suppkey % 5 <> 0 GROUP BY ALL)
SELECT c_custkey, coast FROM customer LEFT JOIN lookup ON la = round({lat_sql('c_custkey')}, 10) AND lo = round({lon_sql('c_custkey')}, 10)""",
)
def j13_coordinate_lookup(spark, sf_dir):
    """Lookup by coordinates that agree to ten decimals; of repeats the last wins."""
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", lat_of(c).alias("lat"), (lon_of(c) + 1e-13).alias("lon"))
    lookup = table(spark, sf_dir, "supplier").select(
        (lat_of(s) - 1e-13).alias("lat"), lon_of(s).alias("lon"), F.when(s % 5 != 0, F.col("s_acctbal")).alias("coast"), s.alias("seq")
    )
    return coordinate_lookup(rows, lookup, "coast", ["seq"]).select("c_custkey", "coast")


@query(
    "j20_point_in_zone",
    f"WITH {PIXELS_SQL} SELECT area_id, band, count(*) AS n_pixels, CAST(sum(value) AS BIGINT) AS total FROM inside GROUP BY ALL",
)
def j20_point_in_zone(spark, sf_dir):
    """Pixel centres inside triangles and holed squares."""
    found = Z.pixels_in_zones(pixels(spark, sf_dir), zones(spark, sf_dir))
    return found.groupBy("area_id", "band").agg(F.count(F.lit(1)).alias("n_pixels"), F.sum("value").alias("total"))


_SCAFFOLD_SQL = """
zone_months AS (
  SELECT CAST(k AS VARCHAR) AS area_id, CAST(mi // 12 AS INTEGER) AS year, CAST(mi % 12 + 1 AS INTEGER) AS month
  FROM boxes CROSS JOIN range(23940, 24023) AS t(mi))"""


@query(
    "a7_zonal",
    f"""
WITH {PIXELS_SQL}, {_SCAFFOLD_SQL}, stats AS (
  SELECT area_id, year, month, round(avg(value), 4) AS value_mean, round(stddev_pop(value), 4) AS value_std, count(*) AS value_count
  FROM inside GROUP BY ALL)
SELECT area_id, year, month, value_mean, value_std, value_count FROM zone_months LEFT JOIN stats USING (area_id, year, month)""",
)
def a7_zonal(spark, sf_dir):
    """Zonal mean and population deviation; zones without pixels keep a row."""
    areas = zones(spark, sf_dir)
    scaffold = month_spine(areas.select("area_id"), (1995, 1), (2001, 11))
    out = Z.zonal_statistics(pixels(spark, sf_dir), areas, statistics=("mean", "std", "count"), scaffold=scaffold)
    return out.withColumns({c: F.round(c, 4) for c in ("value_mean", "value_std")})


@query(
    "a8_zonal_sum",
    f"WITH {PIXELS_SQL} SELECT area_id, year, month, CAST(sum(value) AS BIGINT) AS value_sum, round(stddev_pop(value), 4) AS value_std FROM inside WHERE value <> 25 GROUP BY ALL",
)
def a8_zonal_sum(spark, sf_dir):
    """Zonal sum and deviation, a nodata value skipped."""
    out = Z.zonal_statistics(pixels(spark, sf_dir), zones(spark, sf_dir), statistics=("sum", "std"), nodata=25)
    return out.withColumn("value_std", F.round("value_std", 4))


@query(
    "a9_zonal_bands",
    f"WITH {PIXELS_SQL} SELECT area_id, year, month, band, round(avg(value), 4) AS value_mean, round(stddev_pop(value), 4) AS value_std FROM inside GROUP BY ALL",
)
def a9_zonal_bands(spark, sf_dir):
    """Mean and deviation per band, the band being a grouping column."""
    out = Z.zonal_statistics(pixels(spark, sf_dir), zones(spark, sf_dir), keys=("year", "month", "band"))
    return out.withColumns({c: F.round(c, 4) for c in ("value_mean", "value_std")})


@query(
    "a7_zone_counts",
    f"""
WITH {PIXELS_SQL}, {_SCAFFOLD_SQL}, stats AS (SELECT area_id, year, month, count(*) AS n FROM inside GROUP BY ALL)
SELECT year, month, count(*) AS zone_count, count(*) FILTER (n IS NULL) AS empty_zone_count
FROM zone_months LEFT JOIN stats USING (area_id, year, month) GROUP BY ALL""",
)
def a7_zone_counts(spark, sf_dir):
    """Zones, and zones without pixels, in every month."""
    areas = zones(spark, sf_dir)
    scaffold = month_spine(areas.select("area_id"), (1995, 1), (2001, 11))
    return Z.zone_counts(Z.zonal_statistics(pixels(spark, sf_dir), areas, scaffold=scaffold), "value_mean", ["year", "month"])


@query(
    "s7_tile_merge",
    f"""
WITH {PIXELS_SQL}
SELECT year, month, band, CAST(round(lat / 0.1) AS BIGINT) * 0.1 AS lat, CAST(round(lon / 0.1) AS BIGINT) * 0.1 AS lon, round(avg(value), 6) AS value
FROM pixels GROUP BY year, month, band, CAST(round(lat / 0.1) AS BIGINT), CAST(round(lon / 0.1) AS BIGINT)""".replace("* 0.1", "* CAST(0.1 AS DOUBLE)").replace("/ 0.1", "/ CAST(0.1 AS DOUBLE)"),
)
def s7_tile_merge(spark, sf_dir):
    """Overlapping tiles averaged to one pixel per grid position, month and band."""
    return Z.merge_tiles(pixels(spark, sf_dir), 0.1).withColumn("value", F.round("value", 6))


# Three tiles side by side that overlap by 20 and by 10 degrees.
_TILES = {"west": (0, 50), "middle": (30, 80), "east": (70, 100)}
_TILED_SQL = " UNION ALL ".join(f"SELECT '{t}' AS tile, * FROM cells WHERE x BETWEEN {10 * a} AND {10 * b}" for t, (a, b) in _TILES.items())


@query(
    "s7_blended_tiles",
    f"""
WITH {PIXELS_SQL},
cells AS (SELECT year, month, band, CAST(round(lon / CAST(0.1 AS DOUBLE)) AS BIGINT) AS x, CAST(round(lat / CAST(0.1 AS DOUBLE)) AS BIGINT) AS y, value FROM pixels),
tiled AS ({_TILED_SQL}),
extents AS (SELECT tile, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM tiled GROUP BY tile),
weighed AS (SELECT t.*, least(x - x0, x1 - x, y - y0, y1 - y) + 1 AS w FROM tiled t JOIN extents USING (tile))
SELECT year, month, band, y * CAST(0.1 AS DOUBLE) AS lat, x * CAST(0.1 AS DOUBLE) AS lon,
       round(CAST(sum(w * value) AS DOUBLE) / CAST(sum(w) AS DOUBLE), 6) AS value
FROM weighed GROUP BY year, month, band, y, x""",
)
def s7_blended_tiles(spark, sf_dir):
    """Three overlapping tiles, each pixel weighted by its distance to the border of its tile."""
    cells = pixels(spark, sf_dir)
    x = F.round(F.col("lon") / 0.1).cast("bigint")
    parts = [cells.where(x.between(10 * a, 10 * b)).withColumn("tile", F.lit(t)) for t, (a, b) in _TILES.items()]
    tiles = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return Z.merge_tiles(tiles, 0.1, tile="tile").withColumn("value", F.round("value", 6))


@query(
    "q20_zone_ids",
    """
SELECT count(*) AS common_keys, (SELECT count(*) FROM nation) - count(*) AS left_only_keys, CAST(0 AS BIGINT) AS right_only_keys,
       CAST(0 AS BIGINT) AS left_repeats, CAST((SELECT count(*) FROM customer) - count(*) AS BIGINT) AS right_repeats
FROM (SELECT DISTINCT c_nationkey FROM customer)""",
)
def q20_zone_ids(spark, sf_dir):
    """Q6, Q20: zone ids against the ids in use."""
    used = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("area_id"))
    return universe(zones(spark, sf_dir), used, ["area_id"])
