"""Checks on prediction tables: contract, alignment with the base rows, regression diff."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import AREA_MONTH, PRED_COLUMNS, PREDICTION_COLUMNS, SCOPES, SCORE_COLUMNS
from ..functions.keys import parse_feature_month, target_period, to_number, trim_key
from ..functions.nulls import normalize_null_tokens, present
from .dedup import with_row_ids
from .quality import QualityError, require_columns, require_same_universe, require_unique, require_zero
from .scoring import non_monotone

EXACT_COLUMNS = [*PRED_COLUMNS, "overall_phase_pred", "feature_period", "target_period"]


def _not_in(column: Column, allowed: Sequence[int]) -> Column:
    number = column.cast("double")
    return number.isNull() | ~number.isin(*[float(v) for v in allowed])


def contract_metrics(
    predictions: DataFrame, feature_month: str, model_package_id: str | None = None
) -> DataFrame:
    """Violations per scope, one aggregate over all scopes.

    Row ids are 0..n-1 exactly when the least is 0, the greatest n-1 and all n differ.
    """
    row_id = F.col("_row_id").cast("double")
    scores = {f"bad_{c}": F.coalesce(~(F.abs(F.col(c)) < float("inf")) | F.isnan(c), F.lit(True)) for c in SCORE_COLUMNS}
    flags = {f"bad_{c}": _not_in(F.col(c), (0, 1)) for c in PRED_COLUMNS}
    other = {
        "bad_overall_phase_pred": _not_in(F.col("overall_phase_pred"), (1, 2, 3, 4, 5)),
        "bad_scope_months": _not_in(F.col("scope_months"), SCOPES),
        "bad_feature_period": ~F.col("feature_period").eqNullSafe(F.lit(feature_month)),
        "bad_target_period": ~F.col("target_period").eqNullSafe(
            target_period(F.lit(feature_month), F.col("scope_months").cast("int"))
        ),
        "bad_model_package_id": F.lit(False)
        if model_package_id is None
        else ~F.col("model_package_id").eqNullSafe(F.lit(model_package_id)),
        "blank_key": F.col("area_id").isNull() | F.col("year").isNull() | F.col("month").isNull(),
        "fractional_row_id": F.coalesce(row_id != F.floor(row_id), F.lit(True)),
    }
    checks = {**scores, **flags, **other}
    # One row per (scope, row id) first: the distinct count then needs no second expansion.
    per_id = predictions.groupBy("scope_months", row_id.alias("_id")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(c).alias(name) for name, c in checks.items()]
    )
    return per_id.groupBy("scope_months").agg(
        F.sum("_n").alias("n_rows"),
        *[F.sum(name).alias(name) for name in checks],
        (~((F.min("_id") == 0) & (F.max("_id") == F.sum("_n") - 1) & (F.count("_id") == F.sum("_n"))))
        .cast("int")
        .alias("bad_row_ids"),
    )


def require_prediction_contract(
    predictions: DataFrame,
    feature_month: str,
    base: DataFrame | None = None,
    model_package_id: str | None = None,
    scopes: Sequence[int] = SCOPES,
) -> list[dict]:
    """Raise on any violation; returns the per-scope metrics."""
    require_columns(predictions, PREDICTION_COLUMNS, "prediction")
    rows = [r.asDict() for r in contract_metrics(predictions, feature_month, model_package_id).collect()]
    absent = sorted(set(scopes) - {r["scope_months"] for r in rows})
    if absent:
        raise QualityError(f"missing prediction scopes: {absent}")
    for row in rows:
        failed = {k: v for k, v in row.items() if k not in ("scope_months", "n_rows") and v}
        if failed:
            raise QualityError(f"scope {row['scope_months']} prediction: {failed}")
    require_unique(predictions, [*AREA_MONTH, "scope_months"], "prediction")
    if base is not None:
        # All scopes in one comparison: each base key must be there once a scope.
        wanted = base.select(*AREA_MONTH, F.explode(F.array(*[F.lit(s) for s in scopes])).alias("scope_months"))
        asked = predictions.where(F.col("scope_months").isin(*scopes))
        require_same_universe(asked, wanted, [*AREA_MONTH, "scope_months"], "prediction")
        wrong = alignment(predictions, base).first().asDict()
        if any(wrong.values()):
            raise QualityError(f"prediction does not align with base input: {wrong}")
    return rows


def alignment(predictions: DataFrame, base: DataFrame) -> DataFrame:
    """Predictions whose row id or admin code differs from the base row of the same key; both need ``_row_id``."""
    require_columns(base, ["_row_id"], "base input")
    kept = [c for c in ("_row_id", "admin_code") if c in base.columns and c in predictions.columns]
    side = base.select(*AREA_MONTH, *[F.col(c).alias(f"_base_{c}") for c in kept])
    joined = predictions.select(*AREA_MONTH, *kept).join(side, AREA_MONTH, "left")
    checks = []
    if "_row_id" in kept:
        checks.append(F.count_if(~(F.col("_row_id") == F.col("_base__row_id")).eqNullSafe(F.lit(True))).alias("row_id_mismatches"))
    if "admin_code" in kept:
        theirs = F.col("_base_admin_code")
        same = F.col("admin_code").cast("string").eqNullSafe(theirs.cast("string"))
        checks.append(F.count_if(theirs.isNotNull() & ~same).alias("admin_code_mismatches"))
    return joined.agg(*(checks or [F.lit(0).alias("row_id_mismatches")]))


def regression_diff(predictions: DataFrame, reference: DataFrame) -> DataFrame:
    """``scope_months, column, kind, mismatch_count, max_abs_difference`` for columns that differ.

    Flags, class and periods must be equal (``hard``); scores may drift (``advisory``).
    """
    key = [*AREA_MONTH, "scope_months"]
    theirs = reference.select(*key, *[F.col(c).alias(f"_ref_{c}") for c in [*EXACT_COLUMNS, *SCORE_COLUMNS]])
    pairs = predictions.join(theirs, key, "inner")
    counts = [F.count_if(~F.col(c).eqNullSafe(F.col(f"_ref_{c}"))).alias(f"n_{c}") for c in EXACT_COLUMNS]
    for c in SCORE_COLUMNS:
        gap = present(F.abs(F.col(c) - F.col(f"_ref_{c}")))
        counts += [F.count_if(gap > 0).alias(f"n_{c}"), F.max(F.when(gap > 0, gap)).alias(f"g_{c}")]
    summed = pairs.groupBy("scope_months").agg(*counts)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit("hard" if c in EXACT_COLUMNS else "advisory").alias("kind"),
            F.col(f"n_{c}").alias("mismatch_count"),
            (F.lit(None).cast("double") if c in EXACT_COLUMNS else F.col(f"g_{c}")).alias("max_abs_difference"),
        )
        for c in [*EXACT_COLUMNS, *SCORE_COLUMNS]
    ]
    return summed.select("scope_months", F.inline(F.array(*rows))).where(F.col("mismatch_count") > 0)


def require_no_regression(
    predictions: DataFrame, reference: DataFrame, feature_month: str | None = None, scopes: Sequence[int] = SCOPES
) -> list[dict]:
    """Same keys and equal exact columns, or raise; returns the advisory score differences.

    The reference must itself hold the contract with every scope, so two equally incomplete tables
    do not pass. Its month is that of the predictions unless one is named.
    """
    require_columns(reference, PREDICTION_COLUMNS, "reference prediction")
    require_same_universe(predictions, reference, [*AREA_MONTH, "scope_months"], "reference prediction")
    if feature_month is None:
        row = predictions.select("feature_period").first()
        if row is None:
            raise QualityError("prediction has no rows")
        feature_month = row["feature_period"]
    require_prediction_contract(reference, feature_month, scopes=scopes)
    rows = [r.asDict() for r in regression_diff(predictions, reference).collect()]
    hard = [r for r in rows if r["kind"] == "hard"]
    if hard:
        raise QualityError(f"reference prediction hard gate failures: {hard}")
    return rows


def non_monotone_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("scope_months").agg(F.count_if(non_monotone()).alias("non_monotone_rows"))


def prepare_inference_input(df: DataFrame, feature_month: str) -> DataFrame:
    """Monthly input contract: null tokens, ids, one month, unique areas; adds ``_row_id``."""
    year, month = parse_feature_month(feature_month)
    if "_row_id" in df.columns:
        raise QualityError("_row_id is reserved for runtime row identity")
    require_columns(df, ["year", "month"], "input")
    ids = [c for c in ("area_id", "admin_code") if c in df.columns]
    if not ids:
        raise QualityError("input must contain area_id or admin_code")
    clean = normalize_null_tokens(df)
    numbers = {c: to_number(F.col(c)) for c in ("year", "month")}
    checks = {f"{c} not an integer": F.coalesce(n != F.floor(n), F.lit(True)) for c, n in numbers.items()}
    checks["month out of range"] = ~numbers["month"].between(1, 12)
    checks["other month"] = ~((numbers["year"] == year) & (numbers["month"] == month))
    checks |= {f"missing {c}": F.col(c).isNull() for c in ids}
    if len(ids) == 2:
        checks["area_id/admin_code mismatch"] = trim_key(F.col("area_id")) != trim_key(F.col("admin_code"))
    require_zero(clean, checks, "input", non_empty=False)
    keyed = clean.withColumns(
        {**{c: n.cast("int") for c, n in numbers.items()}, **{c: trim_key(F.col(c)) for c in ids}}
    )
    if "area_id" not in ids:
        keyed = keyed.withColumn("area_id", F.col("admin_code"))
    require_unique(keyed, ["area_id"], "input")
    return with_row_ids(keyed, ["area_id"])
