"""Monthly base input: scaffold, static features, same-month sources, extras."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import AREA_MONTH, ENGINEERED_MARKERS, ID_COLUMNS, SCHEMAS, STATIC_ID_COLUMNS
from ..functions.keys import check_target_month, normalize_area_id, to_number, trim_key, whole_number_text
from ..functions.nulls import is_missing
from ..operators import gates as G
from ..operators import quality as Q
from ..operators.dedup import keep_one


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def is_engineered(name: str) -> bool:
    return any(marker in name.lower() for marker in ENGINEERED_MARKERS)


def source_columns(panel: Sequence[str], static: Sequence[str]) -> list[str]:
    """Panel columns to carry: not a key, not in the static table, not engineered."""
    return [c for c in panel if c not in ID_COLUMNS and c not in static and not is_engineered(c)]


def with_area_id(df: DataFrame) -> DataFrame:
    """``area_id`` in normal form, taken from ``admin_code`` where it is absent.

    Integer ids are only cast. Text is parsed once per row: the parsed number is a column of its
    own, which Spark does not fold back into the expressions that use it twice.
    """
    name = "area_id" if "area_id" in df.columns else "admin_code"
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return df.withColumn("area_id", F.coalesce(_col(name).cast("string"), F.lit("")))
    parsed = df.withColumns({"_text": trim_key(_col(name)), "_number": to_number(_col(name))})
    return parsed.withColumn("area_id", whole_number_text(F.col("_number"), F.col("_text"))).drop("_text", "_number")


@dataclass
class Assembly:
    """The base rows with two hit markers, and what the summary needs to know."""

    rows: DataFrame
    static_columns: list[str]
    source_columns: list[str]
    panel: DataFrame
    year: int
    month: int

    @property
    def base(self) -> DataFrame:
        return self.rows.drop("_static_hit", "_source_hit")


def assemble_month(
    scaffold: DataFrame,
    static: DataFrame,
    panel: DataFrame,
    year: int,
    month: int,
    extras: Mapping[str, DataFrame] | None = None,
    on_duplicate: str = "first",
    order: Sequence[str] | None = None,
    check: bool = True,
) -> Assembly:
    """Left-join the static table and the month's panel slice (and extras) to the scaffold.

    Every scaffold row of the target month stays, once. Static columns win over panel columns of the same name.
    ``on_duplicate`` is ``"first"`` (by ``order``) or ``"fail"``. With ``check`` the gates run
    first, as small aggregates; without it the result is one lazy plan.
    """
    check_target_month(year, month)
    Q.require_columns(scaffold, ["admin_code", "lat", "lon", "year", "month"], "scaffold")
    Q.require_columns(static, ["area_id"], "static features")
    Q.require_columns(panel, ["admin_code", "year", "month"], "panel")
    static_columns = [c for c in static.columns if c not in STATIC_ID_COLUMNS]
    carried = source_columns(panel.columns, static_columns)

    target = scaffold.where((Q.as_int(scaffold, "year") == year) & (Q.as_int(scaffold, "month") == month))
    rows = with_area_id(target).select(
        "area_id", "admin_code", "lat", "lon", F.lit(year).alias("year"), F.lit(month).alias("month")
    )
    by_area = with_area_id(static).select("area_id", *[_col(c) for c in static_columns], F.lit(True).alias("_static_hit"))
    # On integer columns this is a plain comparison that reaches the scan and its partitions.
    slice_ = panel.where((Q.as_int(panel, "year") == year) & (Q.as_int(panel, "month") == month))
    keyed = with_area_id(slice_ if "area_id" not in panel.columns else slice_.drop("area_id"))
    if check:
        blank = {"blank area_id": F.col("area_id") == ""}
        Q.require_single_month(scaffold, year, month, "scaffold")
        Q.require_zero(rows, blank, "scaffold")
        unreadable = Q.as_int(panel, "year").isNull() | Q.as_int(panel, "month").isNull()
        Q.require_zero(panel, {"unreadable year or month": unreadable}, "panel", non_empty=False)
        Q.require_unique(rows, ["area_id"], "scaffold")
        Q.require_zero(by_area, blank, "static features", non_empty=False)
        Q.require_unique(by_area, ["area_id"], "static features")
        if on_duplicate == "fail":
            Q.require_zero(keyed, blank, "panel", non_empty=False)
            Q.require_unique(keyed, ["area_id"], "panel slice")
    if on_duplicate == "first":
        ordering = list(order or [c for c in keyed.columns if c not in AREA_MONTH])
        keyed = keep_one(keyed.select("area_id", *dict.fromkeys([*carried, *ordering])), ["area_id"], ordering)
    by_key = keyed.select("area_id", *[_col(c) for c in carried], F.lit(True).alias("_source_hit"))

    joined = rows.join(by_area, "area_id", "left").join(by_key, "area_id", "left")
    taken = {*ID_COLUMNS, *static_columns, *carried}
    extra_columns: list[str] = []
    for name, table in (extras or {}).items():
        fresh = [c for c in table.columns if c not in taken]
        side = with_area_id(table).where((F.col("year") == year) & (F.col("month") == month))
        if check:
            Q.require_unique(side, ["area_id"], name)
        joined = joined.join(side.select("area_id", *[_col(c) for c in fresh]), "area_id", "left")
        taken.update(fresh)
        extra_columns += fresh
    hits = [F.coalesce(F.col(h), F.lit(False)).alias(h) for h in ("_static_hit", "_source_hit")]
    ordered = [*ID_COLUMNS, *static_columns, *carried, *extra_columns]
    return Assembly(joined.select(*[_col(c) for c in ordered], *hits), static_columns, carried, panel, year, month)


def assembly_missingness(assembly: Assembly) -> DataFrame:
    """``column, missing_count, missing_rate`` of every base column, in one aggregate."""
    return Q.missingness(assembly.base)


def assembly_summary(assembly: Assembly) -> DataFrame:
    """One row: sizes, feature columns, key hits and value hits per join, and the panel side's counts.

    Blank ids of the panel are one key, as any other id; they match nothing and are counted once more apart.
    """

    def any_value(columns: Sequence[str]) -> Column:
        found = F.lit(False)
        for c in columns:
            found = found | ~is_missing(assembly.rows.schema[c])
        return found

    left = assembly.rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if("_static_hit").alias("static_matched"),
        F.count_if(~F.col("_static_hit")).alias("static_unmatched"),
        F.count_if("_source_hit").alias("source_matched"),
        F.count_if(~F.col("_source_hit")).alias("source_unmatched"),
        F.count_if(any_value(assembly.static_columns)).alias("static_with_values"),
        F.count_if(any_value(assembly.source_columns)).alias("source_with_values"),
    )
    panel = assembly.panel
    in_month = (Q.as_int(panel, "year") == assembly.year) & (Q.as_int(panel, "month") == assembly.month)
    per_area = with_area_id(panel.select("admin_code", "year", "month")).groupBy(
        "area_id", in_month.alias("_here")
    ).agg(F.count(F.lit(1)).alias("n"))
    here = F.when(F.col("_here"), F.col("n"))
    right = per_area.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("scanned_rows"),
        F.coalesce(F.sum(here), F.lit(0)).alias("target_month_rows"),
        F.coalesce(F.sum(here - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(F.col("area_id") == "", here)), F.lit(0)).alias("blank_id_rows"),
    )
    return (
        left.withColumn("_one", F.lit(1))
        .join(right.withColumn("_one", F.lit(1)), "_one")
        .select(
            *left.columns,
            F.lit(len(assembly.base.columns)).alias("column_count"),
            F.lit(len(assembly.static_columns)).alias("static_feature_columns"),
            F.lit(len(assembly.source_columns)).alias("source_feature_columns"),
            *right.columns,
            (F.col("target_month_rows") > 0).alias("target_month_present"),
        )
    )


def base_input_gate(base: DataFrame, scaffold: DataFrame, year: int, month: int) -> DataFrame:
    """Keys present, one month, the scaffold's rows exactly once, forecast schema, as rows of checks.

    One aggregate a table and two shuffles of keys, in one job when the rows are read.
    """
    rows, frame = with_area_id(base), with_area_id(scaffold)
    own = {}
    for label, table in (("base input", rows), ("scaffold", frame)):
        Q.require_columns(table, AREA_MONTH, label)
        own[label] = G.count_rules(Q.blank_checks(table, AREA_MONTH, "builder"))
        if "admin_code" in table.columns:
            same = F.col("area_id").eqNullSafe(normalize_area_id(F.col("admin_code")))
            own[label].append(G.count_rule("id_mismatch", ~same))
    own["base input"] += G.count_rules(Q.month_check(year, month))
    mode = "model-input-forecast"
    keys = [t.select("area_id", *[Q.as_int(t, c).alias(c) for c in ("year", "month")]) for t in (rows, frame)]
    return (
        G.counted(rows, {"base input": own["base input"], **G.schema_rules(rows, [mode])})
        .unionByName(G.counted(frame, {"scaffold": own["scaffold"]}))
        .unionByName(G.repeats(rows, {mode: SCHEMAS[mode]["key"]}))
        .unionByName(G.key_sets({"base input": keys[0]}, AREA_MONTH, keys[1], unique=["base input"]))
    )


def validate_base_input(base: DataFrame, scaffold: DataFrame, year: int, month: int) -> dict:
    """Raise unless every check of :func:`base_input_gate` passes."""
    found = G.judged(base_input_gate(base, scaffold, year, month), "base input gate")
    return {**found["base input"], "schema": found["model-input-forecast"]}


def zonal_gate(wide: Mapping[str, DataFrame], long: Mapping[str, DataFrame], scaffold: DataFrame, year: int, month: int) -> DataFrame:
    """Wide and long zonal tables against the scaffold ids and the month, as rows of checks.

    All tables' ids meet in one shuffle; a long table must have each id once and only the target month.
    """
    name = f"{year}_{month:02d}"
    ids = scaffold.select("area_id").distinct()
    tables: dict[str, DataFrame] = {}
    for label, table in wide.items():
        Q.require_columns(table, ["region_id", name], f"wide {label}")
        tables[f"wide {label}"] = table.select(F.col("region_id").alias("area_id"))
    for label, table in long.items():
        Q.require_columns(table, [*AREA_MONTH, label], f"long {label}")
        tables[f"long {label}"] = table.select("area_id")
    out = G.key_sets(tables, ["area_id"], ids, unique=[f"long {label}" for label in long])
    for label, table in long.items():
        out = out.unionByName(G.counted(table, {f"long {label}": G.count_rules(Q.month_check(year, month))}))
    return out


def validate_zonal_outputs(
    wide: Mapping[str, DataFrame], long: Mapping[str, DataFrame], scaffold: DataFrame, year: int, month: int, comparison: str
) -> str:
    """Raise unless :func:`zonal_gate` passes; the reference comparison only warns."""
    G.judged(zonal_gate(wide, long, scaffold, year, month), "zonal output gate")
    advisory = ("advisory_difference", "malformed_reference", "zero_matches", "insufficient_pairs")
    return "passed_with_warnings" if comparison in advisory else "passed"
