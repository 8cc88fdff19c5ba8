"""Feature contracts: contract rows become column expressions over one projection.

The contract itself is a short table on the driver (one row per model feature). The data it
describes never leaves Spark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import coerce, unreadable
from ..functions.keys import trim_key
from .quality import invalid_examples, require_unique

LOOKUP_CATEGORIES = ("static_join", "carry_forward")
_SYNONYMS = {"carryforward": "carry_forward", "median": "median_impute", "medianimpute": "median_impute"}


class ContractError(ValueError):
    """A contract cannot be applied to the given rows."""


@dataclass(frozen=True)
class FeatureSpec:
    """One model feature: where it comes from, its type, and how many gaps it may have."""

    feature: str
    category: str
    source: str = ""
    dtype: str = "float"
    lookup: str = ""
    fill_key: str = ""
    required: bool = False
    tolerance: float = 0.0
    supported: bool = True

    @property
    def kind(self) -> str:
        name = self.category.strip().lower().replace("-", "_").replace(" ", "_")
        return _SYNONYMS.get(name, name)

    @property
    def must_exist(self) -> bool:
        return self.required or self.kind == "required"


@dataclass
class ContractResult:
    matrix: DataFrame
    report: dict[str, dict] = field(default_factory=dict)
    ignored: list[str] = field(default_factory=list)


def _select_specs(contract: Sequence[FeatureSpec], features: Sequence[str]) -> list[FeatureSpec]:
    by_name = {spec.feature: spec for spec in contract}
    if len(by_name) != len(contract):
        raise ContractError("duplicate contract feature rows")
    if len(set(features)) != len(features):
        raise ContractError("requested features contain duplicates")
    missing = [f for f in features if f not in by_name]
    if missing:
        raise ContractError(f"model features missing in contract: {', '.join(missing)}")
    specs = [by_name[f] for f in features]
    for spec in specs:
        if not spec.supported or spec.kind in ("unsupported", "excluded"):
            raise ContractError(f"model feature {spec.feature} is unsupported or excluded")
        if spec.kind == "derived":
            raise ContractError(f"derived feature {spec.feature} is not supported")
        if spec.kind not in ("required", "median_impute", *LOOKUP_CATEGORIES):
            raise ContractError(f"feature {spec.feature} has unsupported category {spec.category}")
        if not 0 <= spec.tolerance <= 1:
            raise ContractError(f"feature {spec.feature}: tolerance must be between 0 and 1")
    return specs


def _lookup_column(spec: FeatureSpec) -> str:
    return f"_lk_{spec.lookup}_{spec.source}"


def _join_lookups(df: DataFrame, specs: Sequence[FeatureSpec], lookups: Mapping[str, DataFrame]) -> DataFrame:
    """One left join per lookup table, with all the columns the contract takes from it."""
    wanted: dict[str, dict[str, None]] = {}
    for spec in specs:
        if spec.kind in LOOKUP_CATEGORIES:
            if not spec.source or not spec.lookup:
                raise ContractError(f"lookup feature {spec.feature} needs a source column and a lookup table")
            if spec.lookup not in lookups:
                raise ContractError(f"lookup table {spec.lookup} not found for feature {spec.feature}")
            if spec.source not in lookups[spec.lookup].columns:
                raise ContractError(f"lookup table {spec.lookup} lacks column {spec.source}")
            wanted.setdefault(spec.lookup, {})[spec.source] = None
    keyed = df.withColumn("_area", trim_key(F.col("area_id"))) if wanted else df
    for name, columns in wanted.items():
        side = lookups[name].select(
            trim_key(F.col("area_id")).alias("_area"), *[F.col(f"`{c}`").alias(f"_lk_{name}_{c}") for c in columns]
        )
        require_unique(side, ["_area"], f"lookup table {name}")
        keyed = keyed.join(side, "_area", "left")
    return keyed.drop("_area")


def apply_contract(
    df: DataFrame,
    contract: Sequence[FeatureSpec],
    features: Sequence[str],
    statistics: Mapping[str, float] | None = None,
    lookups: Mapping[str, DataFrame] | None = None,
    keep: Sequence[str] = ("area_id",),
    enforce: bool = True,
) -> ContractResult:
    """Feature matrix in the requested order, after ``keep`` columns.

    ``enforce`` runs one aggregate over all features: unreadable values and missing rates above
    tolerance raise. Without it the matrix is returned as a plain lazy plan.
    """
    specs = _select_specs(contract, features)
    statistics = statistics or {}
    joined = _join_lookups(df, specs, lookups or {})
    types = {f.name: f.dataType for f in joined.schema.fields}
    raw: dict[str, Column] = {}
    filled: dict[str, Column] = {}
    bad: dict[str, Column] = {}
    names: dict[str, str] = {}
    for spec in specs:
        name = _lookup_column(spec) if spec.kind in LOOKUP_CATEGORIES else spec.source
        if spec.kind == "required" and not name:
            raise ContractError(f"feature {spec.feature} has no source column")
        if spec.must_exist and name not in types:
            raise ContractError(f"required source column {name} missing for feature {spec.feature}")
        present = name in types
        column = F.col(f"`{name}`") if present else F.lit(None).cast("double")
        typed = coerce(column, spec.dtype, types.get(name))
        raw[spec.feature] = filled[spec.feature] = typed
        if spec.kind == "median_impute":
            if spec.fill_key not in statistics:
                raise ContractError(f"missing imputation statistic {spec.fill_key!r} for feature {spec.feature}")
            # A value that cannot be read is an error, not a gap: only true nulls are filled.
            gap = typed.isNull() & ~unreadable(column, spec.dtype, types.get(name))
            filled[spec.feature] = F.when(gap, F.lit(statistics[spec.fill_key]).cast(joined.select(typed.alias("t")).schema["t"].dataType)).otherwise(typed)
        if present:
            bad[spec.feature] = unreadable(column, spec.dtype, types[name])
            names[spec.feature] = name
    result = ContractResult(
        joined.select(*[F.col(f"`{c}`") for c in keep], *[filled[s.feature].alias(s.feature) for s in specs]),
        ignored=sorted({s.feature for s in contract} - set(features)),
    )
    if not enforce:
        return result
    row = joined.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(raw[s.feature].isNull()).alias(f"pre_{i}") for i, s in enumerate(specs)],
        *[F.count_if(filled[s.feature].isNull()).alias(f"post_{i}") for i, s in enumerate(specs)],
        *[F.count_if(bad.get(s.feature, F.lit(False))).alias(f"bad_{i}") for i, s in enumerate(specs)],
    ).first()
    for i, spec in enumerate(specs):
        if row[f"bad_{i}"]:
            shown = [r["value"] for r in invalid_examples(joined, names[spec.feature], bad[spec.feature]).collect()]
            raise ContractError(f"feature {spec.feature} has invalid values: {', '.join(shown)}")
        rate = row[f"post_{i}"] / row["n"] if row["n"] else 0.0
        if rate > spec.tolerance:
            raise ContractError(f"feature {spec.feature} missing rate {rate:.6f} exceeds tolerance {spec.tolerance:.6f}")
        result.report[spec.feature] = {
            "category": spec.kind,
            "pre_fill_missing_rate": row[f"pre_{i}"] / row["n"] if row["n"] else 0.0,
            "post_fill_missing_rate": rate,
        }
    return result
