"""Gates compiled from rule tables.

A rule is a named aggregate and what its value must be. All rules of all gates that read a table become
one aggregate over it, without a shuffle; repeats and key sets become one shuffle of the key columns
for each different key. The result is one row per gate and check, ``gate, check, value, passed``, so a
gate is computed in one job, can be written beside its table, and is judged by reading a few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import OUTCOME_COLUMNS, SCHEMAS
from . import quality as Q


@dataclass(frozen=True, eq=False)
class Rule:
    """``need``: "none" wants 0, "some" wants more than 0, "note" only reports."""

    check: str
    value: Column
    need: str = "none"


def count_rule(check: str, counted: Column, need: str = "none") -> Rule:
    """The number of rows for which ``counted`` is true."""
    return Rule(check, F.count_if(counted), need)


def count_rules(checks: Mapping[str, Column], need: str = "none") -> list[Rule]:
    return [count_rule(name, counted, need) for name, counted in checks.items()]


def _rows(one: DataFrame, rules: Sequence[tuple[str, Rule, Column]]) -> DataFrame:
    """One row per (gate, rule, value) of a one-row table."""
    passed = {"none": lambda v: v == 0, "some": lambda v: v > 0, "note": lambda v: F.lit(True)}
    found = [
        F.struct(
            F.lit(gate).alias("gate"),
            F.lit(rule.check).alias("check"),
            value.cast("bigint").alias("value"),
            passed[rule.need](F.coalesce(value.cast("bigint"), F.lit(0))).alias("passed"),
        )
        for gate, rule, value in rules
    ]
    return one.select(F.inline(F.array(*found)))


def counted(df: DataFrame, gates: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """All rules of all gates in one aggregate; a rule that several gates share is computed once."""
    names: dict[int, str] = {}
    listed = [(gate, rule) for gate, rules in gates.items() for rule in rules]
    for _, rule in listed:
        names.setdefault(id(rule), f"_r{len(names)}")
    unique = {names[id(rule)]: rule.value for _, rule in listed}
    one = df.agg(*[value.alias(name) for name, value in unique.items()])
    return _rows(one, [(gate, rule, F.col(names[id(rule)])) for gate, rule in listed])


def repeats(df: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows too many for each gate's key; gates with the same key share a shuffle."""
    gates: dict[tuple[str, ...], list[str]] = {}
    for gate, key in keys.items():
        gates.setdefault(tuple(key), []).append(gate)
    rule = Rule("duplicate_rows", F.lit(0))
    frames = [
        _rows(Q.duplicate_summary(df, key), [(gate, rule, F.col("duplicate_rows")) for gate in names]) for key, names in gates.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def key_sets(tables: Mapping[str, DataFrame], keys: Sequence[str], reference: DataFrame, unique: Sequence[str] = ()) -> DataFrame:
    """Every table's keys against the reference's, all in one shuffle.

    Gates are named by table: keys it lacks, keys too many, keys in common and repeated rows, which
    count as failures only for tables listed in ``unique``. Null keys are keys like others.
    """
    labels = ["_reference", *[f"_t{i}" for i in range(len(tables))]]
    tagged = [
        table.select(*[F.col(f"`{k}`") for k in keys], *[F.lit(int(other == label)).alias(other) for other in labels])
        for label, table in zip(labels, [reference, *tables.values()])
    ]
    per_key = reduce(DataFrame.unionByName, tagged).groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*[F.sum(c).alias(c) for c in labels])
    here = F.col("_reference") > 0
    values, rules = [], []
    for label, name in zip(labels[1:], tables):
        own, extra = F.col(label) > 0, F.greatest(F.col(label) - 1, F.lit(0))
        found = [
            Rule("universe_missing_keys", F.count_if(here & ~own)),
            Rule("universe_extra_keys", F.count_if(own & ~here)),
            Rule("common_keys", F.count_if(own & here), "note"),
            Rule("duplicate_rows", F.coalesce(F.sum(extra), F.lit(0)), "none" if name in unique else "note"),
        ]
        for rule in found:
            values.append(rule.value.alias(f"_v{len(values)}"))
            rules.append((name, rule, F.col(f"_v{len(values) - 1}")))
    return _rows(per_key.agg(*values), rules)


def schema_rules(df: DataFrame, modes: Sequence[str] = tuple(SCHEMAS)) -> dict[str, list[Rule]]:
    """The rules of named schemas over one table, as far as its columns go; equal rules are shared."""
    shared: dict[tuple, Rule] = {}

    def share(rule: Rule) -> Rule:
        return shared.setdefault((rule.check, rule.need), rule)

    values = [c for c in OUTCOME_COLUMNS if c in df.columns]
    dated = {"year", "month"} <= set(df.columns)
    placed = {"lat", "lon"} <= set(df.columns)
    gates: dict[str, list[Rule]] = {}
    for mode in modes:
        rules = SCHEMAS[mode]
        missing = [c for c in rules["required"] if c not in df.columns]
        listed = [Rule("missing_columns", F.lit(len(missing)))]
        if not missing:
            listed.append(Rule("rows", F.count(F.lit(1)), "some"))
            listed += count_rules(Q.blank_checks(df, rules["nonblank"]))
            listed += count_rules(Q.date_checks(df)) if dated else []
            listed += count_rules(Q.coordinate_checks(df)) if placed else []
            listed += count_rules(Q.id_mismatch_check()) if rules["same_id"] else []
            present = {f"present_{c}": ~Q._blank(df, c) for c in values}
            listed += count_rules(present, "some" if rules["outcomes"] else "note")
            if dated:
                year, month = Q.as_int(df, "year"), Q.as_int(df, "month")
                index = F.when(month.between(1, 12), year * 12 + month - 1)
                listed += [Rule("min_month_index", F.min(index), "note"), Rule("max_month_index", F.max(index), "note")]
        gates[mode] = [listed[0], *[share(r) for r in listed[1:]]]
    return gates


def schema_gates(df: DataFrame, modes: Sequence[str] = tuple(SCHEMAS)) -> DataFrame:
    """Every check of the named schemas over one table: one aggregate, and a shuffle for each different key.

    A table that lacks required columns fails with their number; its other rules are left out.
    """
    rules = schema_rules(df, modes)
    keys = {m: SCHEMAS[m]["key"] for m in modes if len(rules[m]) > 1}
    found = counted(df, rules)
    return found.unionByName(repeats(df, keys)) if keys else found


def judged(metrics: DataFrame, label: str) -> dict[str, dict[str, int]]:
    """The values by gate and check; raises with every failed check. One job over all tables of the gates."""
    found: dict[str, dict[str, int]] = {}
    failed = []
    for row in metrics.collect():
        found.setdefault(row["gate"], {})[row["check"]] = row["value"]
        if not row["passed"]:
            failed.append(f"{row['gate']} {row['check']}={row['value']}")
    if failed:
        raise Q.QualityError(f"{label}: {'; '.join(failed)}")
    return found


def require_schema(df: DataFrame, mode: str) -> dict[str, int]:
    """The values of one schema's checks; raises unless all pass."""
    Q.require_columns(df, SCHEMAS[mode]["required"], mode)
    found = {r["check"]: (r["value"], r["passed"]) for r in schema_gates(df, [mode]).collect()}
    if not found["rows"][1]:
        raise Q.QualityError(f"{mode} has no rows")
    failed = [f"{check}={value}" for check, (value, passed) in found.items() if not passed]
    if failed:
        raise Q.QualityError(f"{mode}: {'; '.join(failed)}")
    return {check: value for check, (value, _) in found.items()}
