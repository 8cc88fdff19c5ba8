import math
import random

import pytest
from pyspark.sql import functions as F

from areapanel.operators.nearest import match_statistics, nearest_join


def km(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    t = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(min(t, 1.0)))


def brute(left, right, radius):
    out = {}
    for key, y, m, la, lo in left:
        best = min(((km(la, lo, rla, rlo), rid) for rid, ry, rm, rla, rlo in right if (ry, rm) == (y, m)), default=None)
        out[key] = best if best and best[0] <= radius else None
    return out


def run(spark, left, right, radius, **options):
    lf = spark.createDataFrame(left, "key int, year int, month int, lat double, lon double")
    rt = spark.createDataFrame(right, "rid int, year int, month int, lat double, lon double").withColumn("w", F.col("rid") * 10)
    return nearest_join(lf, rt, "rid", max_km=radius, **options)


def check(spark, left, right, radius, **options):
    got = {r["key"]: r for r in run(spark, left, right, radius, **options).collect()}
    want = brute(left, right, radius)
    assert set(got) == set(want)
    for key, best in want.items():
        if best is None:
            assert got[key]["rid"] is None and got[key]["distance_km"] is None
        else:
            assert got[key]["distance_km"] == pytest.approx(best[0], abs=1e-6)
            assert got[key]["w"] == got[key]["rid"] * 10
            tied = [rid for rid, y, m, la, lo in right if rid == got[key]["rid"]]
            assert tied


def test_random_globe_with_poles_and_date_line(spark):
    rng = random.Random(7)

    def spots(n):
        out = []
        for i in range(n):
            band = rng.random()
            lat = rng.uniform(84, 90) * rng.choice((-1, 1)) if band < 0.3 else rng.uniform(-80, 80)
            lon = rng.choice((-180, 180)) + rng.uniform(-3, 3) if band > 0.7 else rng.uniform(-180, 180)
            lon = (lon + 180) % 360 - 180
            out.append((i, 2026, rng.choice((1, 2, 3)), lat, lon))
        return out

    left, right = spots(300), [s for s in spots(200) if s[2] != 3]
    for radius in (50.0, 500.0, 3000.0):
        check(spark, left, right, radius)


def test_hot_clusters_are_refined_not_paired(spark):
    """A third of both sides in two facing clusters, far fewer pairs allowed than brute force needs."""
    rng = random.Random(11)
    left = [(i, 2026, 4, rng.gauss(10, 0.01), rng.gauss(20, 0.01)) for i in range(400)]
    right = [(i, 2026, 4, rng.gauss(10, 0.01), rng.gauss(21, 0.01)) for i in range(400)]
    left += [(400 + i, 2026, 4, rng.uniform(-60, 60), rng.uniform(-180, 180)) for i in range(100)]
    right += [(400 + i, 2026, 4, rng.uniform(-60, 60), rng.uniform(-180, 180)) for i in range(100)]
    check(spark, left, right, 500.0, pair_limit=256)


def test_same_position_held_by_many_rows(spark):
    left = [(i, 2026, 4, 1.0, 1.0) for i in range(200)] + [(999, 2026, 4, 5.0, 5.0)]
    right = [(i, 2026, 4, 1.5, 1.0) for i in range(5, 200)]
    got = run(spark, left, right, 500.0).collect()
    assert len(got) == 201
    assert {r["rid"] for r in got if r["key"] < 200} == {5}


def test_tie_goes_to_lowest_id(spark):
    got = run(spark, [(1, 2026, 4, 0.0, 0.0)], [(9, 2026, 4, 0.0, 1.0), (3, 2026, 4, 0.0, -1.0)], 500.0).first()
    assert got["rid"] == 3


def test_radius_is_inclusive_and_far_points_stay_unmatched(spark):
    exact = km(0.0, 0.0, 0.0, 1.0)
    assert run(spark, [(1, 2026, 4, 0.0, 0.0)], [(1, 2026, 4, 0.0, 1.0)], exact + 1e-9).first()["rid"] == 1
    assert run(spark, [(1, 2026, 4, 0.0, 0.0)], [(1, 2026, 4, 0.0, 1.0)], exact - 1e-6).first()["rid"] is None


def test_months_without_right_rows_and_null_positions(spark):
    left = [(1, 2026, 4, 0.0, 0.0), (2, 2026, 5, 0.0, 0.0), (3, 2026, 4, None, 0.0)]
    right = [(1, 2026, 4, 0.0, 0.5)]
    keep = {r["key"]: r["rid"] for r in run(spark, left, right, 500.0).collect()}
    assert keep == {1: 1, 2: None, 3: None}
    drop = {r["key"]: r["rid"] for r in run(spark, left, right, 500.0, unmatched_months="drop").collect()}
    assert drop == {1: 1, 3: None}


def test_match_statistics(spark):
    out = match_statistics(run(spark, [(1, 2026, 4, 0.0, 0.0), (2, 2026, 4, 50.0, 0.0)], [(1, 2026, 4, 0.0, 0.5)], 500.0)).first()
    assert (out["n_rows"], out["n_matched"], out["match_rate"]) == (2, 1, 50.0)
