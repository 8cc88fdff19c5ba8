"""Slot maps and wide columns, calendar lags, blended tiles, chunked writes."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from areapanel.operators import reshape, series
from areapanel.operators import zonal as Z
from areapanel.sources.sinks import read_chunks, write_chunks

KIND = "region_id string, year int, month int, band int, v long"
ROWS = [("a", 2020, 1, 1, 5), ("a", 2020, 1, 1, 7), ("a", 2020, 2, 2, None), ("b", 2021, 12, 1, 3), ("c", None, 4, 1, 9), ("d'`", 2020, 1, 2, 4)]


def test_long_to_wide(spark):
    df = spark.createDataFrame(ROWS, KIND)
    months = [(2020, 2), (2020, 1), (2021, 12)]
    wide = reshape.long_to_wide(df, "v", months, combine=F.sum)
    assert wide.columns == ["region_id", "2020_01", "2020_02", "2021_12"]
    assert rows(wide) == [("a", 12, None, None), ("b", None, None, 3), ("c", None, None, None), ("d'`", 4, None, None)]
    assert rows(reshape.long_to_wide(df, "v", months), "2020_01") == [(None,), (None,), (4,), (7,)]
    assert reshape.long_to_wide(df.limit(0), "v", months).count() == 0


def test_bands_there_and_back(spark):
    df = spark.createDataFrame(ROWS, KIND).where("year IS NOT NULL")
    extract = reshape.bands_to_wide(df, "v", [1, 2], combine=F.sum)
    assert extract(2020).columns[:3] == ["region_id", "2020_01_B1", "2020_01_B2"]
    long = reshape.bands_to_long([extract(2020), extract(2021)], "it's")
    found = long.where("`it's_B1` IS NOT NULL OR `it's_B2` IS NOT NULL")
    assert rows(found, "area_id", "year", "month", "`it's_B1`", "`it's_B2`") == [
        ("a", 2020, 1, 12.0, None), ("b", 2021, 12, 3.0, None), ("d'`", 2020, 1, None, 4.0),
    ]
    assert long.count() == 3 * 12  # an extract has the ids of its year


def test_wide_plan_has_no_case_per_cell(spark):
    df = spark.createDataFrame(ROWS, KIND)
    months = [(y, m) for y in range(2000, 2020) for m in range(1, 13)]
    plan = reshape.long_to_wide(df, "v", months)._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" not in plan.split("Aggregate")[0] and plan.count("LogicalRDD") == 1


def test_calendar_history(spark):
    panel = [("a", 2020, m, 10 * m) for m in (1, 2, 12)] + [("a", 2021, m, 100 * m) for m in (1, 3, 12)] + [("b", 2021, 1, 7), ("b", None, 1, 8)]
    df = spark.createDataFrame(panel, "area_id string, year int, month int, x long")
    got = {r[:3]: r[3:] for r in rows(series.with_calendar_history(df, ["x"]), "area_id", "year", "month", "x_l12", "x_m12", "x_v12")}
    assert got["a", 2021, 1] == (10, pytest.approx((20 + 120 + 100) / 3), 10.0)
    assert got["a", 2021, 3] == (None, pytest.approx((120 + 100 + 300) / 3), 15.0)
    assert got["a", 2021, 12] == (120, pytest.approx((100 + 300 + 1200) / 3), pytest.approx((10 + 20 + 120) / 3))
    assert got["b", 2021, 1] == (None, 7.0, None) and got["b", None, 1] == (None, None, None)
    plain = series.with_history(df.where("area_id = 'a'"), ["x"], months=2, kinds="l")
    assert (2021, 1, 20) in rows(plain, "year", "month", "x_l2")  # rows, not months


def test_blended_tiles(spark):
    kind = "tile string, year int, month int, band string, lat double, lon double, value double"
    left = [("l", 2020, 1, "B1", y / 10, x / 10, 10.0) for x in range(6) for y in range(5)]
    right = [("r", 2020, 1, "B1", y / 10, x / 10, 20.0) for x in range(3, 9) for y in range(5)]
    out = {(round(r["lon"] * 10), round(r["lat"] * 10)): r["value"] for r in Z.merge_tiles(spark.createDataFrame(left + right, kind), 0.1, tile="tile").collect()}
    assert len(out) == 9 * 5 and out[0, 2] == 10.0 and out[8, 2] == 20.0
    assert out[3, 2] == pytest.approx((3 * 10 + 1 * 20) / 4) and out[4, 2] == pytest.approx((2 * 10 + 2 * 20) / 4)
    assert out[3, 2] < out[4, 2] < out[5, 2]
    holed = spark.createDataFrame([*left, ("r", 2020, 1, "B1", 0.2, 0.3, None), *right[7:]], kind)
    assert {r["value"] for r in Z.merge_tiles(holed, 0.1, tile="tile").where("lon < 0.25").collect()} == {10.0}


def test_chunks(spark, tmp_path):
    one = spark.createDataFrame([("a", 1)], "region_id string, `2020_02` long")
    two = spark.createDataFrame([("b", 2, 3.0)], "region_id string, `2020_01` long, `2020_03` double")
    assert write_chunks([one, two], f"{tmp_path}/out") == 2
    back = read_chunks(spark, f"{tmp_path}/out")
    assert back.columns == ["region_id", "2020_01", "2020_02", "2020_03"]
    assert rows(back) == rows(reshape.union_columns([one, two]))
    with pytest.raises(Exception, match="already exists"):
        write_chunks([one], f"{tmp_path}/out")
