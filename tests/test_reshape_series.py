import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from areapanel.operators import dedup, reshape, series
from areapanel.operators.quality import QualityError
from areapanel.plans import history as H
from conftest import rows


def test_wide_to_long_with_mapping(spark):
    wide = spark.createDataFrame([(1, 1.5, 2.5), (2, 3.5, 4.5)], "region_id int, `2026_04` double, `2026_05` double")
    mapping = spark.createDataFrame([(1, "area-a"), (2, "area-b")], "region_id int, area_id string")
    got = reshape.wide_to_long(wide, "EVI", mapping=mapping)
    assert rows(got, "area_id", "month", "EVI") == [("area-a", 4, 1.5), ("area-a", 5, 2.5), ("area-b", 4, 3.5), ("area-b", 5, 4.5)]
    with pytest.raises(QualityError, match="mapping"):
        reshape.wide_to_long(wide, "EVI", mapping=mapping.unionByName(mapping))
    with pytest.raises(QualityError, match="unmatched"):
        reshape.wide_to_long(wide, "EVI", mapping=mapping.where("region_id = 1"))


def test_other_month_spellings_and_bands(spark):
    dotted = spark.createDataFrame([(1, 9.25)], "region_id int, `2026.M04` double")
    assert rows(reshape.wide_to_long(dotted, "gpp")) == [(1, 2026, 4, 9.25)]
    banded = spark.createDataFrame([(1, 11.0, 22.0, 33.0)], "region_id int, `2026_04_B1` double, `2026_04_B2` double, `2026_05_B1` double")
    got = reshape.wide_to_long(banded, "x")
    assert got.columns == ["area_id", "year", "month", "x_B1", "x_B2"]
    assert rows(got) == [(1, 2026, 4, 11.0, 22.0), (1, 2026, 5, 33.0, None)]
    with pytest.raises(ValueError, match="monthly"):
        reshape.wide_to_long(banded.select("region_id"), "x")
    assert reshape.parse_month_column("2026_4") is None and reshape.parse_month_column("note") is None


def test_later_duplicate_row_wins(spark):
    wide = spark.createDataFrame([(1, 1, 1.0), (1, 2, None)], "region_id int, seq int, `2026_04` double")
    assert rows(reshape.wide_to_long(wide, "v", order=["seq"])) == [(1, 2026, 4, None)]


def test_long_to_wide_and_parts(spark):
    long = spark.createDataFrame([(1, 2026, 5, 2.0), (1, 2025, 12, 1.0), (2, 2026, 5, 3.0)], "region_id int, year int, month int, v double")
    wide = reshape.long_to_wide(long, "v")
    assert wide.columns == ["region_id", "2025_12", "2026_05"]
    assert rows(wide) == [(1, 1.0, 2.0), (2, None, 3.0)]
    parts = [wide.select("region_id", "2025_12"), wide.select("region_id", "2026_05")]
    assert reshape.bands_to_long(parts, "v").count() == 4
    assert reshape.union_columns(parts).columns == ["region_id", "2025_12", "2026_05"]
    assert rows(reshape.select_month(wide, "v", 2026, 5)) == [(1, 2026, 5, 2.0), (2, 2026, 5, 3.0)]


def test_band_names(spark):
    renamed = reshape.rename_bands(spark.createDataFrame([(1.0, 2.0, 3.0)], "B1_x double, B12_y double, B28_x double"))
    assert renamed.columns == ["Evap_tavg_mean", "Rainf_f_tavg_stdDev", "Wind_f_tavg_mean"]
    assert len(H.LAND_SURFACE_COLUMNS) == 56 and len(H.CONFLICT_COLUMNS) == 18


@pytest.fixture(scope="module")
def gappy(spark):
    """Two areas whose nulls lead, sit inside and trail; the neighbour is full."""
    rng = random.Random(2)
    data = []
    for area in ("a", "b", "c"):
        for i in range(30):
            v = None if area == "a" and (i < 3 or i in (7, 8, 15) or i > 26) or area == "c" else float(rng.randint(0, 50))
            data.append((area, 2024 + i // 12, i % 12 + 1, v))
    rng.shuffle(data)
    return spark.createDataFrame(data, "area_id string, year int, month int, v double")


def expected(gappy, fn):
    pdf = gappy.toPandas().sort_values(["area_id", "year", "month"])
    return fn(pdf.groupby("area_id")["v"]).tolist()


def series_of(df, column):
    got = df.toPandas().sort_values(["area_id", "year", "month"])[column]
    return [None if pd.isna(x) else x for x in got]


def clean(values):
    return [None if pd.isna(x) else x for x in values]


def test_history_against_pandas(gappy):
    got = series.with_history(gappy, ["v"])
    assert series_of(got, "v_l12") == clean(expected(gappy, lambda g: g.shift(12)))
    mean = expected(gappy, lambda g: g.transform(lambda s: s.rolling(12, min_periods=1).mean()))
    assert series_of(got, "v_m12") == pytest.approx(clean(mean), abs=1e-9)
    late = expected(gappy, lambda g: g.transform(lambda s: s.rolling(12, min_periods=1).mean().shift(12)))
    assert series_of(got, "v_v12") == pytest.approx(clean(late), abs=1e-9)


def test_fills_do_not_leak_between_areas(gappy):
    assert series_of(series.forward_fill(gappy, ["v"]), "v") == clean(expected(gappy, lambda g: g.ffill()))
    assert series_of(series.backward_fill(gappy, ["v"]), "v") == clean(expected(gappy, lambda g: g.bfill()))


def test_interpolation(gappy):
    held = expected(gappy, lambda g: g.transform(lambda s: s.interpolate()))
    inner = expected(gappy, lambda g: g.transform(lambda s: s.interpolate(limit_area="inside")))
    assert series_of(series.interpolate(gappy, ["v"], trailing="hold"), "v") == pytest.approx(clean(held), abs=1e-9)
    assert series_of(series.interpolate(gappy, ["v"]), "v") == pytest.approx(clean(inner), abs=1e-9)
    with pytest.raises(ValueError):
        series.interpolate(gappy, ["v"], trailing="x")


def test_one_shuffle_for_all_history(gappy):
    wide = gappy.select("*", *[(F.col("v") * i).alias(f"v{i}") for i in range(20)])
    plan = series.with_history(wide, [f"v{i}" for i in range(20)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_densify(spark):
    df = spark.createDataFrame(
        [("A", 2000, 10.0), ("A", 2000, 20.0), ("A", 2004, 23.0), ("A", 2006, None), ("B", 2001, 5.0), (None, 2001, 5.0)],
        "country_code_3 string, year int, gini double",
    )
    got = rows(series.densify_years(df, "gini"))
    assert got == [("A", 2000, 15.0), ("A", 2001, 17.0), ("A", 2002, 19.0), ("A", 2003, 21.0), ("A", 2004, 23.0), ("A", 2005, 23.0), ("A", 2006, 23.0), ("B", 2001, 5.0)]


def test_keep_one(spark):
    df = spark.createDataFrame([("x", 2, "b"), ("x", 1, "a"), (None, 1, "n"), (None, 3, "m")], "k string, seq int, v string")
    assert sorted(r["v"] for r in dedup.keep_one(df, ["k"], ["seq"]).collect()) == ["a", "n"]
    assert sorted(r["v"] for r in dedup.keep_one(df, ["k"], ["seq"], last=True).collect()) == ["b", "m"]


def test_keep_one_reduces_before_the_shuffle(spark):
    hot = spark.range(100_000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.keep_one(hot, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Partial")  # printed top down: the partial limit lies below
    assert rows(dedup.keep_one(hot, ["k"], ["id"])) == [(0, 0), (1, 1), (2, 2)]


def test_row_ids(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("area_id"))
    got = [r["area_id"] for r in dedup.with_row_ids(df, ["area_id"]).orderBy("_row_id").collect()]
    assert got == sorted(str(i) for i in range(5000))
    ids = dedup.with_row_ids(df, ["area_id"], start=7).agg(F.min("_row_id"), F.max("_row_id"), F.count_distinct("_row_id")).first()
    assert tuple(ids) == (7, 5006, 5000)
    with pytest.raises(ValueError):
        dedup.with_row_ids(df.withColumn("_row_id", F.lit(1)), ["area_id"])
    assert dedup.with_row_ids(df.limit(0), ["area_id"]).count() == 0


def test_surrogate_ids(spark):
    df = spark.createDataFrame([(5, 1.0, 1.0), (None, 3.0, 1.0), (None, 2.0, 1.0), (None, 3.0, 1.0)], "admin_code int, lat double, lon double")
    assert rows(dedup.with_surrogate_ids(df, "admin_code"), "admin_code", "lat") == [(5, 1.0), (100005, 2.0), (100006, 3.0), (100006, 3.0)]


def test_gap_rules(spark):
    df = spark.createDataFrame([(1, -1.0, None, True, None), (2, 5000.0, 2.0, None, 3.0)], "area_id int, a double, b double, AEZ_1 boolean, distance double")
    assert rows(H.cap_at(H.floor_at(df, ["a", "b"]), ["a"]), "a", "b") == [(0.0, None), (1000.0, 2.0)]
    assert rows(H.flags_to_int(df), "AEZ_1") == [(0,), (1,)]
    assert H.zero_fill(df, ["b", "distance"], "distance").where("area_id = 1").select("b", "distance").first() == (0.0, None)
    assert H.zero_fill(df, ["b", "distance"], "distance", fill_distance=True).where("area_id = 1").first()["distance"] == 0.0


def test_history_panel(spark):
    panel = spark.createDataFrame([("a", 2024 + i // 12, i % 12 + 1, float(i), 1) for i in range(14)] + [("a", 2024, 1, 99.0, 2)], "area_id string, year int, month int, v double, seq int")
    outcome = spark.createDataFrame([("a", 2025, 1, 3), ("a", 2025, 1, 4)], "area_id string, year int, month int, phase int")
    got = H.history_panel(panel, outcome, ["v"], ["seq"])
    assert got.count() == 14
    row = got.where("year = 2025 and month = 1").first()
    assert (row["v_l12"], row["phase"]) == (0.0, 3)
    chained = H.join_chain(panel.select("area_id", "year", "month"), {"o": (outcome, ["area_id", "year", "month"])})
    assert "phase" in chained.columns
    filled = H.fill_gaps(panel.withColumn("w", F.col("v")), backward=["v"], forward=["w"], linear=["v"])
    assert filled.count() == 15
