"""Contract, scoring, decoding, prediction checks and audits."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from ..functions.fixed import PRED_COLUMNS, SCOPES, SCORE_COLUMNS, TARGETS
from ..operators import predictions as P
from ..operators import scoring as M
from ..operators.contract import FeatureSpec, apply_contract
from ..operators.dedup import with_row_ids
from ..operators.joins import join_audit
from . import Registry
from .views import MONTHLY_SQL, TARGET_MONTH, TARGET_YEAR, monthly_orders, table

query = Registry()

_MONTH = f"{TARGET_YEAR}-{TARGET_MONTH:02d}"
_FEATURES = ["orders", "price", "balance", "segment"]
_MEDIAN = 150000.0
_CONTRACT = [
    FeatureSpec("orders", "required", source="order_cnt", dtype="integer"),
    FeatureSpec("price", "median", source="price_sum", fill_key="price_median"),
    FeatureSpec("balance", "static-join", source="c_acctbal", lookup="customer"),
    FeatureSpec("segment", "carry forward", source="c_mktsegment", dtype="string", lookup="customer"),
    FeatureSpec("unused", "required", source="order_cnt"),
]
# A linear stand-in for the packaged models: weights of orders, price and balance per target.
_WEIGHTS = {
    "phase2_worse": (0.30, 0.000001, 0.00003),
    "phase3_worse": (0.10, 0.000002, 0.00001),
    "phase4_worse": (0.05, 0.000001, 0.00005),
    "phase5_worse": (0.01, 0.0000005, 0.00002),
}
_THRESHOLDS = {"default": 0.2, "phase3_worse": 0.25, "phase4_worse_score": 0.3}

_BASE_SQL = f"""{MONTHLY_SQL},
base AS (
  SELECT CAST(c_custkey AS VARCHAR) AS area_id, CAST(c_custkey AS VARCHAR) AS admin_code, {TARGET_YEAR} AS year, {TARGET_MONTH} AS month,
         coalesce(order_cnt, 0) AS orders, CAST(coalesce(price_sum, {_MEDIAN}) AS DOUBLE) AS price, c_acctbal AS balance, c_mktsegment AS segment,
         row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) - 1 AS _row_id
  FROM customer LEFT JOIN monthly ON area_id = c_custkey AND year = {TARGET_YEAR} AND month = {TARGET_MONTH})"""


def _score_sql(target: str) -> str:
    a, b, c = _WEIGHTS[target]
    return f"CAST({a} AS DOUBLE) * orders + CAST({b} AS DOUBLE) * price + CAST({c} AS DOUBLE) * balance + scope_months / CAST(100 AS DOUBLE)"


_SCORED_SQL = f"""{_BASE_SQL},
scored AS (SELECT b.*, s AS scope_months, {', '.join(f"{_score_sql(t).replace('scope_months', 's')} AS {t}_score" for t in TARGETS)}
  FROM base b CROSS JOIN (VALUES (0), (6), (12)) AS v(s)),
flagged AS (SELECT *, CAST(phase2_worse_score >= 0.2 AS INTEGER) AS f2, CAST(phase3_worse_score >= 0.25 AS INTEGER) AS f3,
  CAST(phase4_worse_score >= 0.3 AS INTEGER) AS f4, CAST(phase5_worse_score >= 0.2 AS INTEGER) AS f5 FROM scored),
predicted AS (
  SELECT area_id, admin_code, year, month, _row_id, {', '.join(f'{t}_score' for t in TARGETS)},
         greatest(f2, f3, f4, f5) AS phase2_worse_pred, greatest(f3, f4, f5) AS phase3_worse_pred, greatest(f4, f5) AS phase4_worse_pred, f5 AS phase5_worse_pred,
         CASE WHEN f5 = 1 THEN 5 WHEN f4 = 1 THEN 4 WHEN f3 = 1 THEN 3 WHEN f2 = 1 THEN 2 ELSE 1 END AS overall_phase_pred,
         '{_MONTH}' AS feature_period, CASE scope_months WHEN 0 THEN '1998-06' WHEN 6 THEN '1998-12' ELSE '1999-06' END AS target_period,
         scope_months, 'pkg-001' AS model_package_id, 'base' AS source_input
  FROM flagged)"""


def _models():
    """Per scope and target, an object with ``predict(frame)``; a closure, so tasks need no imports."""

    def linear(weights, scope):
        a, b, c = weights
        return SimpleNamespace(predict=lambda f: a * f["orders"] + b * f["price"] + c * f["balance"] + scope / 100.0)

    return {s: {t: linear(_WEIGHTS[t], s) for t in TARGETS} for s in SCOPES}


def _base(spark, sf_dir):
    """Every customer in the feature month with that month's orders, if any."""
    here = monthly_orders(spark, sf_dir, (TARGET_YEAR, TARGET_MONTH))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_custkey").cast("string").alias("area_id"))
    joined = rows.join(here.select(F.col("area_id").alias("key"), "order_cnt", "price_sum"), "key", "left")
    return joined.select(
        "area_id",
        F.col("area_id").alias("admin_code"),
        F.lit(TARGET_YEAR).alias("year"),
        F.lit(TARGET_MONTH).alias("month"),
        F.coalesce("order_cnt", F.lit(0)).alias("order_cnt"),
        "price_sum",
    )


def _matrix(spark, sf_dir, rows, keep):
    lookup = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("area_id"), "c_acctbal", "c_mktsegment")
    return apply_contract(rows, _CONTRACT, _FEATURES, {"price_median": _MEDIAN}, {"customer": lookup}, keep=keep, enforce=True)


def _predictions(spark, sf_dir):
    keep = ["area_id", "admin_code", "year", "month", "_row_id"]
    rows = with_row_ids(_base(spark, sf_dir), ["area_id"])
    matrix = _matrix(spark, sf_dir, rows, keep).matrix
    out = M.score_scopes(matrix, _models(), ["orders", "price", "balance"], keep, _MONTH, "pkg-001", "base", _THRESHOLDS)
    return rows, out


def _rounded(df):
    return df.withColumns({c: F.round(c, 8) for c in SCORE_COLUMNS})


@query("m2_contract", f"WITH {_BASE_SQL} SELECT area_id, orders, price, balance, segment FROM base")
def m2_contract(spark, sf_dir):
    """Contract rows compiled to one projection over one lookup join."""
    return _matrix(spark, sf_dir, _base(spark, sf_dir), ["area_id"]).matrix


@query(
    "m7_score_decode",
    f"WITH {_SCORED_SQL} SELECT * REPLACE ({', '.join(f'round({c}, 8) AS {c}' for c in SCORE_COLUMNS)}) FROM predicted",
)
def m7_score_decode(spark, sf_dir):
    """Scores of three scopes, thresholds, monotone flags, decoded class, periods."""
    return _rounded(_predictions(spark, sf_dir)[1])


_BAD = (
    [f"bad_{c}" for c in SCORE_COLUMNS]
    + [f"bad_{c}" for c in PRED_COLUMNS]
    + ["bad_overall_phase_pred", "bad_scope_months", "bad_feature_period", "bad_target_period", "bad_model_package_id", "blank_key", "fractional_row_id"]
)
_BROKEN = {
    "bad_phase2_worse_score": "count(*) FILTER (_row_id % 11 = 1)",
    "bad_phase3_worse_pred": "count(*) FILTER (_row_id % 13 = 1)",
    "bad_overall_phase_pred": "count(*) FILTER (_row_id % 17 = 1)",
    "bad_target_period": "count(*) FILTER (_row_id % 19 = 1)",
    "bad_model_package_id": "count(*) FILTER (_row_id % 23 = 1)",
}


@query(
    "q15_prediction_contract",
    f"WITH {_SCORED_SQL} SELECT scope_months, count(*) AS n_rows, "
    + ", ".join(f"CAST({_BROKEN.get(c, '0')} AS BIGINT) AS {c}" for c in _BAD)
    + ", CASE WHEN scope_months = 6 THEN 1 ELSE 0 END AS bad_row_ids FROM predicted GROUP BY scope_months",
)
def q15_prediction_contract(spark, sf_dir):
    """Q15: violations per scope, on predictions broken in known places."""
    r = F.col("_row_id")
    broken = _predictions(spark, sf_dir)[1].withColumns(
        {
            "phase2_worse_score": F.when(r % 11 != 1, F.col("phase2_worse_score")).otherwise(float("inf")),
            "phase3_worse_pred": F.when(r % 13 != 1, F.col("phase3_worse_pred")).otherwise(2),
            "overall_phase_pred": F.when(r % 17 != 1, F.col("overall_phase_pred")).otherwise(9),
            "target_period": F.when(r % 19 != 1, F.col("target_period")).otherwise("1990-01"),
            "model_package_id": F.when(r % 23 != 1, F.col("model_package_id")).otherwise("other"),
            "_row_id": r + F.when(F.col("scope_months") == 6, 1).otherwise(0),
        }
    )
    return P.contract_metrics(broken, _MONTH, "pkg-001")


_DIFF_ROWS = f"""
SELECT scope_months, 'overall_phase_pred' AS "column", 'hard' AS kind, count(*) FILTER (_row_id % 7 = 2) AS mismatch_count, CAST(NULL AS DOUBLE) AS max_abs_difference FROM predicted GROUP BY ALL
UNION ALL
SELECT scope_months, 'phase4_worse_score', 'advisory', count(*) FILTER (_row_id % 5 = 1), 0.125 FROM predicted GROUP BY ALL"""


@query("q16_prediction_diff", f"WITH {_SCORED_SQL} SELECT * FROM ({_DIFF_ROWS}) WHERE mismatch_count > 0")
def q16_prediction_diff(spark, sf_dir):
    """Q16: predictions against a perturbed copy; exact columns hard, scores advisory."""
    _, predicted = _predictions(spark, sf_dir)
    r = F.col("_row_id")
    reference = predicted.withColumns(
        {
            "overall_phase_pred": F.col("overall_phase_pred") + F.when(r % 7 == 2, 1).otherwise(0),
            "phase4_worse_score": F.col("phase4_worse_score") + F.when(r % 5 == 1, 0.125).otherwise(0.0),
        }
    )
    return P.regression_diff(predicted, reference).withColumn("max_abs_difference", F.round("max_abs_difference", 6))


@query(
    "q17_non_monotone",
    f"WITH {_SCORED_SQL} SELECT scope_months, count(*) FILTER (f3 > f2 OR f4 > f3 OR f5 > f4) AS non_monotone_rows FROM flagged GROUP BY scope_months",
)
def q17_non_monotone(spark, sf_dir):
    """Q17: rows whose raw flags are not monotone."""
    _, predicted = _predictions(spark, sf_dir)
    raw = predicted.select("scope_months", *SCORE_COLUMNS).select("scope_months", *M.flag_columns(_THRESHOLDS))
    return P.non_monotone_counts(raw)


@query(
    "j18_alignment",
    f"WITH {_SCORED_SQL} SELECT count(*) FILTER (_row_id % 29 = 4) AS row_id_mismatches, count(*) FILTER (_row_id % 31 = 4) AS admin_code_mismatches FROM predicted",
)
def j18_alignment(spark, sf_dir):
    """Row id and admin code of predictions against the base rows of the same key."""
    base, predicted = _predictions(spark, sf_dir)
    r = F.col("_row_id")
    moved = predicted.withColumns(
        {"_row_id": r + F.when(r % 29 == 4, 1).otherwise(0), "admin_code": F.when(r % 31 == 4, "x").otherwise(F.col("admin_code"))}
    )
    return P.alignment(moved, base)


@query(
    "j19_join_audit",
    """
WITH z AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 4 <> 0), p AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey % 3 <> 0)
SELECT (SELECT count(*) FROM p) AS prediction_rows, (SELECT count(*) FROM z) AS spatial_rows, (SELECT count(*) FROM z WHERE k IN (SELECT k FROM p)) AS matched_rows,
       (SELECT count(*) FROM z WHERE k NOT IN (SELECT k FROM p)) AS unmatched_spatial_rows, (SELECT count(*) FROM p WHERE k NOT IN (SELECT k FROM z)) AS unmatched_prediction_ids""",
)
def j19_join_audit(spark, sf_dir):
    """Matched and unmatched zones and predictions in one shuffle."""
    zones = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 4 != 0).select(F.col("c_custkey").alias("area_id"))
    found = table(spark, sf_dir, "orders").where(F.col("o_custkey") % 3 != 0).select(F.col("o_custkey").alias("area_id")).distinct()
    return join_audit(zones, found)


