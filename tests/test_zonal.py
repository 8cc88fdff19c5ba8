import random

import pytest
from pyspark.sql import functions as F

from areapanel.operators import zonal as Z
from areapanel.operators.quality import QualityError
from areapanel.sources.readers import read_zones
from conftest import rows

RINGS = "area_id string, rings array<array<struct<lon: double, lat: double>>>"
PIXELS = "id int, lon double, lat double, value double"


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def make(spark, zones):
    return spark.createDataFrame(list(zones.items()), RINGS)


@pytest.fixture(scope="module")
def shapes():
    rng = random.Random(3)
    star = [(12.0 + (5 if i % 2 else 2) * rng.uniform(0.8, 1.2) * c, 7.0 + (5 if i % 2 else 2) * s) for i, (c, s) in enumerate(
        [(1, 0), (0.8, 0.6), (0.3, 0.95), (-0.3, 0.95), (-0.8, 0.6), (-1, 0), (-0.8, -0.6), (-0.3, -0.95), (0.3, -0.95), (0.8, -0.6)])]
    return {
        "holed": [[(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0), (0.0, 0.0)], [(2.0, 2.0), (6.0, 2.0), (6.0, 6.0), (2.0, 6.0), (2.0, 2.0)]],
        "star": [star],
        "parts": [[(-10.0, -10.0), (-9.0, -10.0), (-9.5, -9.0)], [(-5.5, -5.5), (-4.5, -5.5), (-4.5, -4.5), (-5.5, -4.5)]],
    }


@pytest.mark.parametrize("cell", [0.5, 1.0, 7.0])
@pytest.mark.parametrize("broadcast_edges", [2_000_000, 0])
def test_even_odd_equals_brute_force(spark, shapes, cell, broadcast_edges):
    rng = random.Random(5)
    points = [(i, rng.uniform(-12, 20), rng.uniform(-12, 14), 1.0) for i in range(1500)]
    points += [(2000, 0.0, 4.0, 1.0), (2001, 8.0, 4.0, 1.0), (2002, 4.0, 4.0, 1.0), (2003, 1.0, 0.0, 1.0), (2004, 1.0, 8.0, 1.0)]
    got = Z.pixels_in_zones(spark.createDataFrame(points, PIXELS), make(spark, shapes), cell, broadcast_edges)
    want = sorted((a, i) for i, x, y, _ in points for a, rings in shapes.items() if inside(rings, x, y))
    assert rows(got, "area_id", "id") == want


def test_border_belongs_to_one_neighbour(spark):
    zones = make(spark, {
        "west": [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]],
        "east": [[(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0)]],
    })
    got = Z.pixels_in_zones(spark.createDataFrame([(1, 1.0, 0.5, 1.0)], PIXELS), zones)
    assert rows(got, "area_id", "id") == [("east", 1)]


def test_mean_population_deviation_and_empty_zone(spark):
    zones = make(spark, {"A": [[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]], "B": [[(10.0, 0.0), (12.0, 0.0), (12.0, 2.0), (10.0, 2.0)]]})
    pixels = spark.createDataFrame(
        [(1, 0.5, 0.5, 1000.0), (2, 1.5, 1.5, 3000.0), (3, 1.0, 1.0, float("nan")), (4, 1.2, 1.0, None), (5, 0.7, 0.7, -9999.0)], PIXELS
    ).withColumns({"year": F.lit(2026), "month": F.lit(4)})
    scaffold = zones.select("area_id", F.lit(2026).alias("year"), F.lit(4).alias("month"))
    stats = Z.zonal_statistics(pixels, zones, statistics=("mean", "std", "sum", "count"), nodata=-9999.0, scaffold=scaffold)
    got = {r["area_id"]: r for r in stats.collect()}
    assert (got["A"]["value_mean"], got["A"]["value_std"], got["A"]["value_sum"], got["A"]["value_count"]) == (2000.0, 1000.0, 4000.0, 2)
    assert got["B"]["value_mean"] is None and got["B"]["value_std"] is None
    assert Z.zone_counts(stats, "value_mean").first() == (2, 1)
    with pytest.raises(QualityError):
        Z.zonal_statistics(pixels, zones, rule="all_touched")


def test_tiles_are_averaged(spark):
    tiles = spark.createDataFrame([(0.1, 0.1, 2.0), (0.1, 0.1, 4.0), (0.2, 0.1, 5.0)], "lon double, lat double, value double").withColumns(
        {"year": F.lit(2026), "month": F.lit(4), "band": F.lit("B1")}
    )
    assert sorted(r["value"] for r in Z.merge_tiles(tiles, 0.1).collect()) == [3.0, 5.0]


def test_geojson_zones(spark, tmp_path):
    path = tmp_path / "zones.geojson"
    path.write_text(
        """{"type": "FeatureCollection", "features": [
      {"type": "Feature", "properties": {"area_id": " A "}, "geometry": {"type": "Polygon", "coordinates": [[[0,0],[4,0],[4,4],[0,4],[0,0]],[[1,1],[2,1],[2,2],[1,2],[1,1]]]}},
      {"type": "Feature", "properties": {"area_id": "", "admin_code": "B"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[10,0],[11,0],[11,1],[10,0]]],[[[20,0],[21,0],[21,1],[20,0]]]]}}]}"""
    )
    zones = read_zones(spark, str(path))
    assert [(r["area_id"], [len(g) for g in r["rings"]]) for r in zones.orderBy("area_id").collect()] == [("A", [5, 5]), ("B", [4, 4])]
    points = spark.createDataFrame([(1, 3.0, 3.0, 1.0), (2, 1.5, 1.5, 1.0), (3, 20.9, 0.1, 1.0)], PIXELS)
    assert rows(Z.pixels_in_zones(points, zones), "area_id", "id") == [("A", 1), ("B", 3)]
    Z.require_zone_ids(zones, zones)
    single = tmp_path / "one.geojson"
    single.write_text('{"type": "Feature", "properties": {"area_id": "A"}, "geometry": {"type": "Polygon", "coordinates": [[[0,0],[1,0],[1,1],[0,0]]]}}')
    assert read_zones(spark, str(single)).first()["area_id"] == "A"


def test_zone_id_gate(spark, shapes):
    zones = make(spark, shapes)
    for broken in (zones.unionByName(zones), zones.withColumn("area_id", F.lit(" "))):
        with pytest.raises(QualityError):
            Z.require_zone_ids(broken)
    with pytest.raises(QualityError, match="universe"):
        Z.require_zone_ids(zones, zones.where("area_id <> 'star'"))
