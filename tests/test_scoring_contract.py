from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from areapanel.functions.fixed import PREDICTION_COLUMNS, TARGETS
from areapanel.operators import predictions as P
from areapanel.operators import scoring as M
from areapanel.operators.contract import ContractError, FeatureSpec, apply_contract
from areapanel.operators.quality import QualityError, missing_rate_gate
from conftest import rows


def constant(values):
    """A model that answers by area, or with the same value everywhere."""
    if isinstance(values, dict):
        return SimpleNamespace(predict=lambda f: [values[int(x)] for x in f["feature"]])
    return SimpleNamespace(predict=lambda f: [values] * len(f))


def models(*values):
    return {t: constant(v) for t, v in zip(TARGETS, values)}


@pytest.fixture(scope="module")
def matrix(spark):
    return spark.createDataFrame([("A", "AA", 1.0), ("B", "BB", 2.0), ("C", "CC", 3.0)], "area_id string, admin_code string, feature double")


def test_constant_models_decode(matrix):
    by = models({1: 0.8, 2: 0.8, 3: 0.8}, {1: 0.7, 2: 0.7, 3: 0.1}, {1: 0.6, 2: 0.1, 3: 0.1}, 0.1)
    scored = M.decode(M.score(matrix, by, ["feature"], ["area_id", "admin_code"]), {"default": 0.5}, "fail")
    out = M.enrich(scored, "2026-04", 3, "pkg-001", "input.csv")
    assert rows(out, "area_id", "overall_phase_pred") == [("A", 4), ("B", 3), ("C", 2)]
    row = out.where("area_id = 'A'").first()
    assert (row["feature_period"], row["target_period"], row["scope_months"], row["year"], row["month"]) == ("2026-04", "2026-07", 3, 2026, 4)
    assert (row["phase2_worse_pred"], row["phase5_worse_pred"]) == (1, 0)


def test_scopes_share_one_pass(matrix):
    by = {s: models(0.8, 0.3 + s / 12, 0.1, 0.1) for s in (0, 6)}
    out = M.score_scopes(matrix, by, ["feature"], ["area_id"], "2026-04", "pkg", "in", {"default": 0.5})
    assert rows(out.where("area_id = 'A'"), "scope_months", "target_period", "overall_phase_pred") == [(0, "2026-04", 2), (6, "2026-10", 3)]
    assert out.count() == 6 and "_scope" not in out.columns
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInPandas") == 1


def test_monotonicity(spark):
    scores = spark.createDataFrame([("A", 0.1, 0.8, 0.1, 0.1), ("B", 0.8, 0.8, 0.1, 0.1)], "area_id string, " + ", ".join(f"{t}_score double" for t in TARGETS))
    fixed = M.decode(scores, {"default": 0.5}, "cummax")
    assert rows(fixed, "area_id", "phase2_worse_pred", "phase3_worse_pred", "phase4_worse_pred", "overall_phase_pred") == [("A", 1, 1, 0, 3), ("B", 1, 1, 0, 3)]
    with pytest.raises(QualityError, match="non-monotonic"):
        M.decode(scores, {"default": 0.5}, "fail")
    flagged = scores.select(F.lit(0).alias("scope_months"), *M.flag_columns({"default": 0.5}))
    assert P.non_monotone_counts(flagged).first() == (0, 1)
    with pytest.raises(M.ScoringError):
        M.decode(scores, {"default": 0.5}, "other")


def test_thresholds():
    assert M.threshold_for("phase2_worse", {"phase2_worse": 0.1, "phase2_worse_score": 0.2, "default": 0.3}) == 0.1
    assert M.threshold_for("phase2_worse", {"phase2_worse_score": 0.2, "default": 0.3}) == 0.2
    assert M.threshold_for("phase2_worse", {"default": 0.3}) == 0.3
    for bad in ({}, {"default": float("nan")}):
        with pytest.raises(M.ScoringError):
            M.threshold_for("phase2_worse", bad)


def test_bad_models(matrix):
    with pytest.raises(M.ScoringError, match="phase5_worse"):
        M.score(matrix, {t: constant(0.1) for t in TARGETS[:3]}, ["feature"], ["area_id"])
    with pytest.raises(M.ScoringError, match="predict"):
        M.score(matrix, {t: object() for t in TARGETS}, ["feature"], ["area_id"])
    with pytest.raises(Exception, match="finite"):
        M.score(matrix, models(0.1, float("nan"), 0.1, 0.1), ["feature"], ["area_id"]).collect()
    short = models(0.1, 0.1, 0.1, 0.1) | {"phase3_worse": SimpleNamespace(predict=lambda f: [])}
    with pytest.raises(Exception, match="length"):
        M.score(matrix, short, ["feature"], ["area_id"]).collect()


# ---- contract ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def monthly(spark):
    return spark.createDataFrame([(" a ", "1.5", None), ("b", "2.5", 8.0)], "area_id string, required_src string, impute_src double")


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([("a", 10), ("b ", 20)], "area_id string, static_value int")


CONTRACT = [
    FeatureSpec("static", "static_join", "static_value", lookup="look"),
    FeatureSpec("required", "required", "required_src"),
    FeatureSpec("imputed", "Median-Impute", "impute_src", fill_key="m"),
    FeatureSpec("extra", "derived"),
]


def test_contract_matrix(monthly, lookup):
    out = apply_contract(monthly, CONTRACT, ["static", "required", "imputed"], {"m": 6.5}, {"look": lookup})
    assert out.matrix.columns == ["area_id", "static", "required", "imputed"]
    assert rows(out.matrix, "static", "required", "imputed") == [(10.0, 1.5, 6.5), (20.0, 2.5, 8.0)]
    assert out.ignored == ["extra"]
    assert out.report["imputed"]["pre_fill_missing_rate"] == 0.5 and out.report["imputed"]["post_fill_missing_rate"] == 0.0


def test_absent_optional_source_is_filled(monthly):
    spec = [FeatureSpec("x", "median", "nowhere", fill_key="m")]
    assert rows(apply_contract(monthly, spec, ["x"], {"m": 2.0}).matrix, "x") == [(2.0,), (2.0,)]


@pytest.mark.parametrize(
    ("spec", "match"),
    [
        (FeatureSpec("x", "required", "nowhere"), "missing for feature"),
        (FeatureSpec("x", "derived"), "not supported"),
        (FeatureSpec("x", "excluded"), "excluded"),
        (FeatureSpec("x", "required", "required_src", supported=False), "excluded"),
        (FeatureSpec("x", "mystery"), "category"),
        (FeatureSpec("x", "median", "impute_src", fill_key="none"), "statistic"),
        (FeatureSpec("x", "static_join", "static_value", lookup="other"), "not found"),
        (FeatureSpec("x", "static_join", "no_column", lookup="look"), "lacks column"),
        (FeatureSpec("x", "required", "impute_src"), "exceeds tolerance"),
        (FeatureSpec("x", "required", "required_src", dtype="integer"), "invalid values: 1.5, 2.5"),
        (FeatureSpec("x", "required", "required_src", tolerance=2.0), "between 0 and 1"),
    ],
)
def test_contract_errors(monthly, lookup, spec, match):
    with pytest.raises(ContractError, match=match):
        apply_contract(monthly, [spec], ["x"], {"m": 6.5}, {"look": lookup})


def test_contract_shape_errors(monthly, lookup):
    with pytest.raises(ContractError, match="missing in contract"):
        apply_contract(monthly, CONTRACT, ["unknown"])
    with pytest.raises(ContractError, match="duplicates"):
        apply_contract(monthly, CONTRACT, ["static", "static"])
    with pytest.raises(ContractError, match="duplicate contract"):
        apply_contract(monthly, CONTRACT + CONTRACT, ["static"])
    with pytest.raises(QualityError, match="lookup table look"):
        apply_contract(monthly, CONTRACT, ["static"], lookups={"look": lookup.unionByName(lookup)})


def test_missing_rate_gate(spark):
    before = spark.createDataFrame([(1.0,), (None,)], "x double")
    tolerance = spark.createDataFrame([("x", 0.1)], "feature string, tolerance double")
    assert rows(missing_rate_gate(before, before.na.fill(0), tolerance)) == [("x", 0.1, 0.5, 0.0, True)]


# ---- inference input and predictions -----------------------------------------------------------------


def test_inference_input(spark):
    good = spark.createDataFrame([(" 007 ", "2026", "4", "NA"), ("b", "2026.0", "04", "x")], "area_id string, year string, month string, v string")
    out = P.prepare_inference_input(good, "202604")
    assert rows(out, "_row_id", "area_id", "year", "month", "v") == [(0, "007", 2026, 4, None), (1, "b", 2026, 4, "x")]
    only_code = P.prepare_inference_input(good.withColumnRenamed("area_id", "admin_code"), "2026-04")
    assert rows(only_code, "area_id") == [("007",), ("b",)]
    broken = {
        "reserved": good.withColumn("_row_id", F.lit(1)),
        "area_id or admin_code": good.drop("area_id"),
        "missing area_id": good.withColumn("area_id", F.lit("N/A")),
        "not an integer": good.withColumn("month", F.lit("4.5")),
        "out of range": good.withColumn("month", F.lit("13")),
        "other month": good.withColumn("month", F.lit("5")),
        "mismatch": good.withColumn("admin_code", F.lit("zz")),
        "duplicate": good.withColumn("area_id", F.lit("a")),
        "missing columns": good.drop("year"),
    }
    for reason, df in broken.items():
        with pytest.raises(QualityError, match=reason):
            P.prepare_inference_input(df, "2026-04")


@pytest.fixture(scope="module")
def predicted(matrix):
    keyed = matrix.withColumns({"year": F.lit(2026), "month": F.lit(4), "_row_id": (F.col("feature") - 1).cast("bigint")}).withColumn("admin_code", F.col("area_id"))
    by = {s: models(0.8, 0.3, 0.1, 0.1) for s in (0, 6, 12)}
    return keyed, M.score_scopes(keyed, by, ["feature"], ["area_id", "admin_code", "year", "month", "_row_id"], "2026-04", "model", "base", {"default": 0.5})


def test_prediction_contract_passes(predicted):
    base, table = predicted
    assert set(PREDICTION_COLUMNS) <= set(table.columns)
    metrics = P.require_prediction_contract(table, "2026-04", base, "model")
    assert sorted(m["n_rows"] for m in metrics) == [3, 3, 3]
    P.require_prediction_contract(table.drop("admin_code"), "2026-04", base, "model")


@pytest.mark.parametrize(
    ("column", "value", "match"),
    [
        ("admin_code", "'wrong'", "align"),
        ("_row_id", "99", "bad_row_ids"),
        ("phase2_worse_score", "double('inf')", "bad_phase2_worse_score"),
        ("phase2_worse_pred", "2", "bad_phase2_worse_pred"),
        ("overall_phase_pred", "9", "bad_overall_phase_pred"),
        ("model_package_id", "'wrong'", "bad_model_package_id"),
        ("target_period", "'2026-04'", "bad_target_period"),
        ("feature_period", "'2026-05'", "bad_feature_period"),
        ("area_id", "'A'", "duplicate"),
        ("area_id", "concat(area_id, 'x')", "universe"),
    ],
)
def test_prediction_contract_breaks(predicted, column, value, match):
    base, table = predicted
    with pytest.raises(QualityError, match=match):
        P.require_prediction_contract(table.withColumn(column, F.expr(value)), "2026-04", base, "model")


def test_missing_scope_and_column(predicted):
    base, table = predicted
    with pytest.raises(QualityError, match="missing prediction scopes"):
        P.require_prediction_contract(table.where("scope_months <> 6"), "2026-04")
    with pytest.raises(QualityError, match="missing columns"):
        P.require_prediction_contract(table.drop("source_input"), "2026-04")


def test_regression_diff(predicted):
    _, table = predicted
    assert P.require_no_regression(table, table) == []
    drifted = table.withColumn("phase2_worse_score", F.col("phase2_worse_score") + F.when(F.col("scope_months") == 6, 0.25).otherwise(0.0))
    found = P.require_no_regression(table, drifted)
    assert [(d["scope_months"], d["column"], d["mismatch_count"], d["max_abs_difference"]) for d in found] == [(6, "phase2_worse_score", 3, 0.25)]
    with pytest.raises(QualityError, match="hard gate"):
        P.require_no_regression(table, table.withColumn("overall_phase_pred", F.lit(5)))
    with pytest.raises(QualityError, match="universe"):
        P.require_no_regression(table, table.where("area_id <> 'A'"))
    one_scope = table.where("scope_months = 6")
    with pytest.raises(QualityError, match="missing prediction scopes"):
        P.require_no_regression(one_scope, one_scope)
    broken = table.withColumn("overall_phase_pred", F.lit(9))
    with pytest.raises(QualityError, match="bad_overall_phase_pred"):
        P.require_no_regression(broken, broken)
