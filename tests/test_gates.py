"""Gates as rows of checks: what each rule counts, what fails, and how many jobs a gate takes."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from areapanel.functions.fixed import OUTCOME_COLUMNS, SCHEMAS, STATIC_FEATURE_COLUMNS
from areapanel.operators import gates as G
from areapanel.operators.quality import QualityError
from areapanel.plans.monthly import base_input_gate, zonal_gate

KEY = "admin_code string, lat string, lon string, year string, month string"


def failed(metrics):
    return sorted((r["gate"], r["check"], r["value"]) for r in metrics.collect() if not r["passed"])


def test_schema_modes(spark):
    good = [("1", "1.5", "2", "2020", "4.0"), ("2", "-90", "180", "2020", "12")]
    bad = [("", "91", "east", "x", "13"), ("2", "-90", "180", "2020", "12"), ("3", "", None, "", "0")]
    df = spark.createDataFrame(good + bad, KEY)
    assert failed(G.schema_gates(spark.createDataFrame(good, KEY), ["forecast-scaffold"])) == []
    assert failed(G.schema_gates(df, ["forecast-scaffold"])) == sorted(
        ("forecast-scaffold", c, n)
        for c, n in [
            ("blank_admin_code", 1), ("blank_lat", 1), ("blank_lon", 1), ("blank_year", 1), ("invalid_year", 2),
            ("invalid_month", 2), ("invalid_lat", 1), ("invalid_lon", 1), ("duplicate_rows", 1),
        ]
    )
    missing = {m: len([c for c in SCHEMAS[m]["required"] if c not in df.columns]) for m in SCHEMAS}
    assert {(g, c): v for g, c, v in failed(G.schema_gates(df)) if c == "missing_columns"} == {
        (m, "missing_columns"): n for m, n in missing.items() if n
    }
    empty = G.schema_gates(df.limit(0), ["forecast-scaffold"])
    assert failed(empty) == [("forecast-scaffold", "rows", 0)]


def test_outcomes_and_ids(spark):
    df = spark.createDataFrame([("1", "1", 1.0, 1.0, 2020, 4)], "area_id string, admin_code string, lat double, lon double, year int, month int")
    full = df.select("*", *[F.lit("1").alias(c) for c in OUTCOME_COLUMNS], *[F.lit("1").alias(c) for c in STATIC_FEATURE_COLUMNS])
    assert failed(G.schema_gates(full)) == []
    blank = full.withColumn("phase3_percent", F.lit("")).withColumn("admin_code", F.lit("2"))
    assert failed(G.schema_gates(blank)) == [
        ("fixed-slow-area", "id_mismatch", 1),
        ("historical-panel", "present_phase3_percent", 0),
        ("model-input-training", "blank_phase3_percent", 1),
        ("model-input-training", "present_phase3_percent", 0),
    ]
    with pytest.raises(QualityError, match="present_phase3_percent=0"):
        G.judged(G.schema_gates(blank, ["historical-panel"]), "table")


def test_key_sets(spark):
    kind = "area_id string"
    frame = spark.createDataFrame([("a",), ("b",), (None,)], kind)
    one = spark.createDataFrame([("a",), ("a",), ("c",)], kind)
    two = frame.unionByName(frame.limit(1))
    got = rows(G.key_sets({"one": one, "two": two}, ["area_id"], frame, unique=["one"]))
    assert got == sorted(
        [
            ("one", "universe_missing_keys", 2, False), ("one", "universe_extra_keys", 1, False), ("one", "common_keys", 1, True),
            ("one", "duplicate_rows", 1, False), ("two", "universe_missing_keys", 0, True), ("two", "universe_extra_keys", 0, True),
            ("two", "common_keys", 3, True), ("two", "duplicate_rows", 1, True),
        ]
    )


def test_gates_take_one_job_without_plans_per_check(spark):
    """Every table is scanned twice at most: once for its rules and once for its keys."""
    base = spark.range(100).select(F.col("id").cast("string").alias("area_id"), F.lit(2020).alias("year"), F.lit(4).alias("month"))
    plan = base_input_gate(base, base, 2020, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 100") <= 5  # base: rules, repeats, keys; scaffold: rules, keys
    assert failed(base_input_gate(base, base, 2020, 4)) == []
    july = base.withColumn("month", F.lit(7))
    assert {(c, v) for _, c, v in failed(base_input_gate(july, base, 2020, 4))} == {
        ("other_month", 100), ("universe_missing_keys", 100), ("universe_extra_keys", 100),
    }


def test_zonal_gate(spark):
    scaffold = spark.createDataFrame([("A",), ("B",)], "area_id string")
    wide = spark.createDataFrame([("A", 1.0), ("C", None)], "region_id string, `2026_04` double")
    long = spark.createDataFrame([("A", 2026, 4, 1.0), ("A", 2026, 5, 1.0)], "area_id string, year int, month int, EVI_mean double")
    assert failed(zonal_gate({"mean": wide}, {"EVI_mean": long}, scaffold, 2026, 4)) == [
        ("long EVI_mean", "duplicate_rows", 1), ("long EVI_mean", "other_month", 1), ("long EVI_mean", "universe_missing_keys", 1),
        ("wide mean", "universe_extra_keys", 1), ("wide mean", "universe_missing_keys", 1),
    ]
    with pytest.raises(QualityError, match="missing columns"):
        zonal_gate({"mean": wide}, {}, scaffold, 2026, 5)
