import pytest
from pyspark.sql import functions as F

from areapanel.operators.quality import QualityError
from areapanel.plans.monthly import assemble_month, assembly_missingness, assembly_summary, is_engineered, source_columns, validate_base_input, validate_zonal_outputs
from areapanel.plans.scaffold import month_spine, month_universe, monthly_scaffold
from conftest import rows

SCAFFOLD = "admin_code string, lat double, lon double, year int, month int"


@pytest.fixture(scope="module")
def inputs(spark):
    scaffold = spark.createDataFrame([("101.0", 1.0, 2.0, 2026, 4), ("102", 3.0, 4.0, 2026, 4)], SCAFFOLD)
    static = spark.createDataFrame(
        [("101", "101", 1.0, 2.0, 1.0, 500.0), ("102", "102", 3.0, 4.0, 0.0, 750.0)],
        "area_id string, admin_code string, lat double, lon double, crop double, elevation double",
    )
    panel = spark.createDataFrame(
        [("101", 1.0, 2.0, 2026, 4, 3, 0.23, 10.0, 0.1, 99.0), ("102", 3.0, 4.0, 2026, 4, 2, 0.31, 11.0, 0.2, 99.0), ("101", 1.0, 2.0, 2026, 3, 1, 0.5, 9.0, 0.3, 99.0)],
        "admin_code string, lat double, lon double, year int, month int, overall_phase int, EVI_mean double, "
        "Rainf_f_tavg_mean double, EVI_mean__l12 double, crop double",
    )
    return scaffold, static, panel


def test_one_month(inputs):
    scaffold, static, panel = inputs
    done = assemble_month(scaffold, static, panel, 2026, 4)
    base = done.base
    assert base.columns[:6] == ["area_id", "admin_code", "lat", "lon", "year", "month"]
    assert "EVI_mean__l12" not in base.columns and base.columns.count("crop") == 1
    first = base.where("area_id = '101'").first()
    assert (first["admin_code"], first["crop"], first["elevation"], first["overall_phase"], first["EVI_mean"]) == ("101.0", 1.0, 500.0, 3, 0.23)
    s = assembly_summary(done).first()
    assert (s["row_count"], s["column_count"], s["static_matched"], s["source_matched"], s["source_unmatched"]) == (2, 11, 2, 2, 0)
    assert (s["scanned_rows"], s["target_month_rows"], s["duplicate_rows"], s["target_month_present"]) == (3, 2, 0, True)
    assert validate_base_input(base, scaffold, 2026, 4)["common_keys"] == 2


def test_future_month_keeps_rows(spark, inputs):
    _, static, panel = inputs
    future = spark.createDataFrame([("101.0", 1.0, 2.0, 2026, 5)], SCAFFOLD)
    done = assemble_month(future, static, panel, 2026, 5)
    row = done.base.first()
    assert (row["crop"], row["EVI_mean"]) == (1.0, None)
    s = assembly_summary(done).first()
    assert (s["source_matched"], s["source_unmatched"], s["target_month_present"]) == (0, 1, False)
    assert s["static_feature_columns"] + s["source_feature_columns"] + 6 == s["column_count"] == len(done.base.columns)
    missing = {r["column"]: (r["missing_count"], r["missing_rate"]) for r in assembly_missingness(done).collect()}
    assert list(missing) == done.base.columns and missing["EVI_mean"] == (1, 1.0) and missing["crop"] == (0, 0.0)


def test_padded_ids_and_text_months(spark, inputs):
    _, static, _ = inputs
    scaffold = spark.createDataFrame([(" A ", 1.0, 1.0, "2026.0", "4"), ("B", 1.0, 1.0, "2026", "4")], "admin_code string, lat double, lon double, year string, month string")
    panel = spark.createDataFrame([("A", "2026", "3", "5")], "admin_code string, year string, month string, rain string")
    done = assemble_month(scaffold, static, panel, 2026, 4)
    assert rows(done.base, "area_id", "rain") == [("A", None), ("B", None)]
    assert assembly_summary(done).first()["target_month_present"] is False


def test_duplicates(spark, inputs):
    scaffold, static, panel = inputs
    again = panel.where("year = 2026 and month = 4").withColumn("EVI_mean", F.col("EVI_mean") + 1)
    twice = panel.unionByName(again)
    kept = assemble_month(scaffold, static, twice, 2026, 4, order=["EVI_mean"])
    assert rows(kept.base, "area_id", "EVI_mean") == [("101", 0.23), ("102", 0.31)]
    assert assembly_summary(kept).first()["duplicate_rows"] == 2
    blank = panel.where("year = 2026 and month = 4").withColumn("admin_code", F.lit(" "))
    some = assemble_month(scaffold, static, panel.unionByName(blank), 2026, 4, order=["EVI_mean"])
    s = assembly_summary(some).first()
    assert (s["blank_id_rows"], s["duplicate_rows"], s["source_matched"], s["target_month_rows"]) == (2, 1, 2, 4)
    with pytest.raises(QualityError, match="panel slice"):
        assemble_month(scaffold, static, twice, 2026, 4, on_duplicate="fail")
    with pytest.raises(QualityError, match="scaffold"):
        assemble_month(scaffold.unionByName(scaffold), static, panel, 2026, 4)
    with pytest.raises(QualityError, match="static"):
        assemble_month(scaffold, static.unionByName(static), panel, 2026, 4)


def test_extras_and_gates(spark, inputs):
    scaffold, static, panel = inputs
    extra = spark.createDataFrame([("101", 2026, 4, 7.0)], "area_id string, year int, month int, EVI_std double")
    base = assemble_month(scaffold, static, panel, 2026, 4, {"EVI_std": extra}).base
    assert rows(base, "area_id", "EVI_std") == [("101", 7.0), ("102", None)]
    with pytest.raises(QualityError, match="month"):
        assemble_month(scaffold, static, panel, 2026, 5)
    with pytest.raises(QualityError, match="exactly one month"):
        assemble_month(scaffold.unionByName(scaffold.withColumn("month", F.lit(5))), static, panel, 2026, 4)
    with pytest.raises(QualityError, match="blank"):
        assemble_month(scaffold.unionByName(spark.createDataFrame([(" ", 1.0, 1.0, 2026, 4)], SCAFFOLD)), static, panel, 2026, 4)
    with pytest.raises(QualityError, match="universe"):
        validate_base_input(base.where("area_id = '101'"), scaffold, 2026, 4)
    with pytest.raises(QualityError, match="duplicate"):
        validate_base_input(base.unionByName(base), scaffold, 2026, 4)
    with pytest.raises(QualityError, match="id_mismatch"):
        validate_base_input(base.withColumn("admin_code", F.lit("x")), scaffold, 2026, 4)


def test_column_rules():
    assert is_engineered("EVI__L12") and is_engineered("rain_lag1") and is_engineered("x_asof") and not is_engineered("slope")
    assert source_columns(["admin_code", "crop", "EVI_mean__l12", "rain_lag1", "rain"], ["crop"]) == ["rain"]


def test_scaffold(spark):
    reference = spark.createDataFrame([("1", 1.0, 1.0, 2026, 3), ("1", 1.0, 1.0, 2026, 4), ("2", 2.0, 2.0, 2026, 4)], SCAFFOLD)
    areas = spark.createDataFrame([("1", 1.0, 1.0), ("9", 9.0, 9.0)], "area_id string, lat double, lon double")
    assert rows(monthly_scaffold(reference, areas), "admin_code", "month") == [("1", 4), ("2", 4)]
    assert rows(monthly_scaffold(reference, areas, 2026, 5), "admin_code", "month") == [("1", 5), ("9", 5)]
    with pytest.raises(QualityError):
        monthly_scaffold(reference.unionByName(reference), areas)
    assert month_spine(areas, (2025, 11), (2026, 2)).count() == 8
    assert month_universe(reference, reference.withColumn("month", F.lit(1))).count() == 3
    assert month_universe(reference).count() == 2


def test_zonal_output_gate(spark):
    scaffold = spark.createDataFrame([("A",), ("B",)], "area_id string")
    wide = spark.createDataFrame([("A", 1.0), ("B", None)], "region_id string, `2026_04` double")
    long = spark.createDataFrame([("A", 2026, 4, 1.0), ("B", 2026, 4, None)], "area_id string, year int, month int, EVI_mean double")
    assert validate_zonal_outputs({"mean": wide}, {"EVI_mean": long}, scaffold, 2026, 4, "matched") == "passed"
    assert validate_zonal_outputs({"mean": wide}, {"EVI_mean": long}, scaffold, 2026, 4, "zero_matches") == "passed_with_warnings"
    with pytest.raises(QualityError):
        validate_zonal_outputs({"mean": wide.limit(1)}, {"EVI_mean": long}, scaffold, 2026, 4, "matched")
    with pytest.raises(QualityError):
        validate_zonal_outputs({"mean": wide}, {"EVI_mean": long.withColumn("month", F.lit(5))}, scaffold, 2026, 4, "matched")
