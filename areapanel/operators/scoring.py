"""Distributed scoring of cumulative targets and decoding to an ordered class."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import DEFAULT_THRESHOLD, PRED_COLUMNS, SCORE_COLUMNS, TARGETS
from ..functions.keys import target_period
from .quality import QualityError


class ScoringError(ValueError):
    """Models, thresholds or scores are unusable."""


def score(df: DataFrame, models: Mapping[str, Any], features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns plus one ``<target>_score`` per target.

    ``models`` maps each target to an object with ``predict(frame)``. They travel with the task
    closure and score Arrow batches where the rows already are; nothing is shuffled. A score
    that is not a finite number, or a wrong number of scores, fails the job.
    """
    return score_all(df, {0: models}, features, keep).drop("_scope")


def score_all(df: DataFrame, models: Mapping[int, Mapping[str, Any]], features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """As :func:`score` for several scopes, a row per input row and scope, with the scope as ``_scope``.

    Every Arrow batch is read and shipped once and scored by all scopes' models.
    """
    fitted = {}
    for scope, by_target in models.items():
        missing = [t for t in TARGETS if t not in by_target]
        if missing:
            raise ScoringError(f"missing required models: {', '.join(missing)}")
        bad = [t for t in TARGETS if not hasattr(by_target[t], "predict")]
        if bad:
            raise ScoringError(f"models without predict(): {', '.join(bad)}")
        fitted[int(scope)] = {t: by_target[t] for t in TARGETS}
    names, kept = list(features), list(keep)

    # Nothing of this package is referenced inside, so workers need only the models' own code.
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for scope, by_target in fitted.items():
                out = batch[kept].reset_index(drop=True)
                out["_scope"] = pd.Series([scope] * len(batch), dtype="int32")
                for target, model in by_target.items():
                    raw = pd.Series(model.predict(batch[names])).reset_index(drop=True)
                    if len(raw) != len(batch):
                        raise ValueError(f"model {target} score length {len(raw)} does not match {len(batch)} rows")
                    scores = pd.to_numeric(raw, errors="coerce").astype("float64")
                    if not scores.abs().lt(float("inf")).all():
                        raise ValueError(f"model {target} scores must be numeric and finite")
                    out[target + "_score"] = scores
                yield out

    rows = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, *names])])
    fields = [rows.schema[c] for c in kept] + [T.StructField(c, T.DoubleType()) for c in SCORE_COLUMNS]
    fields.insert(len(kept), T.StructField("_scope", T.IntegerType()))
    return rows.mapInPandas(run, T.StructType(fields))


def threshold_for(target: str, thresholds: Mapping[str, float]) -> float:
    """By target, then by score column, then ``default``."""
    for key in (target, target + "_score", "default"):
        if key in thresholds:
            value = float(thresholds[key])
            if value != value or value in (float("inf"), float("-inf")):
                raise ScoringError(f"threshold for {target} must be finite")
            return value
    raise ScoringError(f"missing threshold for {target}; give {target}, {target}_score or default")


def flag_columns(thresholds: Mapping[str, float]) -> list[Column]:
    return [
        (F.col(s) >= F.lit(threshold_for(t, thresholds))).cast("int").alias(p)
        for t, s, p in zip(TARGETS, SCORE_COLUMNS, PRED_COLUMNS)
    ]


def non_monotone() -> Column:
    """True where a worse class is flagged without the milder one."""
    bad = F.lit(False)
    for milder, worse in zip(PRED_COLUMNS, PRED_COLUMNS[1:]):
        bad = bad | (F.col(worse) > F.col(milder))
    return bad


def decode_phase() -> Column:
    """The worst flagged class, or 1."""
    phase = F.lit(1)
    for number, flag in enumerate(PRED_COLUMNS, start=2):
        phase = F.when(F.col(flag) == 1, number).otherwise(phase)
    return phase


def decode(scored: DataFrame, thresholds: Mapping[str, float] | None = None, policy: str = "cummax") -> DataFrame:
    """Threshold, make monotone (or fail), decode. ``cummax``: a worse flag implies the milder ones."""
    if policy not in ("cummax", "fail"):
        raise ScoringError(f"monotonicity policy must be 'cummax' or 'fail', got {policy!r}")
    flagged = scored.select("*", *flag_columns(thresholds or {"default": DEFAULT_THRESHOLD}))
    if policy == "fail":
        count = flagged.agg(F.count_if(non_monotone()).alias("n")).first()["n"]
        if count:
            raise QualityError(f"non-monotonic cumulative predictions in {count} rows")
    else:
        lifted = {p: F.greatest(*PRED_COLUMNS[i:]) if i < 3 else F.col(p) for i, p in enumerate(PRED_COLUMNS)}
        flagged = flagged.select(*[lifted[c].alias(c) if c in lifted else F.col(f"`{c}`") for c in flagged.columns])
    return flagged.withColumn("overall_phase_pred", decode_phase())


def enrich(
    predictions: DataFrame, feature_month: str, scope_months: int | Column, model_package_id: str, source_input: str
) -> DataFrame:
    """Periods, scope, model and source as columns; year and month from the feature month if absent."""
    year, month = (int(p) for p in feature_month.split("-"))
    extra = {
        "feature_period": F.lit(feature_month),
        "target_period": target_period(F.lit(feature_month), scope_months),
        "scope_months": scope_months if isinstance(scope_months, Column) else F.lit(int(scope_months)),
        "model_package_id": F.lit(model_package_id),
        "source_input": F.lit(source_input),
    }
    if "year" not in predictions.columns:
        extra["year"] = F.lit(year)
    if "month" not in predictions.columns:
        extra["month"] = F.lit(month)
    return predictions.withColumns(extra)


def score_scopes(
    matrix: DataFrame,
    models: Mapping[int, Mapping[str, Any]],
    features: Sequence[str],
    keep: Sequence[str],
    feature_month: str,
    model_package_id: str,
    source_input: str,
    thresholds: Mapping[str, float] | None = None,
    policy: str = "cummax",
) -> DataFrame:
    """Predictions of every scope as one table, from one pass over the matrix."""
    decoded = decode(score_all(matrix, models, features, keep), thresholds, policy)
    return enrich(decoded, feature_month, F.col("_scope"), model_package_id, source_input).drop("_scope")
