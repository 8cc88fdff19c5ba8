"""Data-quality gates: each is a metrics DataFrame, and a ``require_*`` form that raises.

Counters over one table are compiled into a single aggregate. Only one-row metrics and
short example lists reach the driver.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import OUTCOME_COLUMNS
from ..functions.keys import index_month, index_year, month_index, to_number, year_month_text
from ..functions.nulls import is_blank, is_missing


class QualityError(ValueError):
    """A gate failed."""


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


# ---- columns -------------------------------------------------------------------------------


def require_columns(df: DataFrame, columns: Sequence[str], label: str = "table") -> None:
    """Exact, case-sensitive column names."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise QualityError(f"{label} missing columns: {', '.join(missing)}")


def require_month_columns(df: DataFrame, pattern: str, at_least: int) -> int:
    """At least so many columns whose names match a pattern; returns how many do."""
    found = sum(1 for c in df.columns if re.match(pattern, c))
    if found < at_least:
        raise QualityError(f"monthly column count {found} is less than required {at_least}")
    return found


# ---- counters ------------------------------------------------------------------------------


def counters(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """``n_rows`` and the number of rows for which each check is true, in one aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(check).alias(name) for name, check in checks.items()]
    )


def require_zero(df: DataFrame, checks: Mapping[str, Column], label: str = "table", non_empty: bool = True) -> dict:
    """Fail unless every counter is zero; returns the one-row metrics."""
    row = counters(df, checks).first().asDict()
    if non_empty and row["n_rows"] == 0:
        raise QualityError(f"{label} has no rows")
    failed = {name: row[name] for name in checks if row[name]}
    if failed:
        raise QualityError(f"{label}: {failed}")
    return row


def require_no_rows(df: DataFrame, what: str) -> None:
    """Fail if a difference table has any row."""
    count = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if count:
        raise QualityError(f"{what}: {count}")


def as_number(df: DataFrame, name: str) -> Column:
    """A column as a double, parsed only where it is text."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = _col(name).cast("double")
        return F.when(F.abs(value) < float("inf"), value)
    return _col(name).cast("double") if isinstance(kind, T.NumericType) else to_number(_col(name))


def as_int(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    return _col(name).cast("int") if isinstance(kind, T.IntegralType) else as_number(df, name).try_cast("int")


def date_checks(df: DataFrame, year: str = "year", month: str = "month", bounded_year: bool = False) -> dict[str, Column]:
    y, m = as_int(df, year), as_int(df, month)
    bad_year = y.isNull() | ~y.between(1900, 2100) if bounded_year else y.isNull()
    return {"invalid_year": bad_year, "invalid_month": m.isNull() | ~m.between(1, 12)}


def coordinate_checks(df: DataFrame, lat: str = "lat", lon: str = "lon") -> dict[str, Column]:
    """Present coordinates must be numbers in range."""

    def outside(name: str, limit: float) -> Column:
        value = as_number(df, name)
        present = ~_blank(df, name)
        return present & (value.isNull() | ~value.between(-limit, limit))

    return {"invalid_lat": outside(lat, 90.0), "invalid_lon": outside(lon, 180.0)}


def _blank(df: DataFrame, name: str, vocabulary: str = "validator") -> Column:
    """Blank text; numbers can only be null."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return is_blank(_col(name), vocabulary)
    return _col(name).isNull()


def blank_checks(df: DataFrame, columns: Sequence[str], vocabulary: str = "validator") -> dict[str, Column]:
    return {f"blank_{c}": _blank(df, c, vocabulary) for c in columns}


def id_mismatch_check(left: str = "area_id", right: str = "admin_code") -> dict[str, Column]:
    return {"id_mismatch": ~_col(left).eqNullSafe(_col(right))}


def month_check(year: int, month: int) -> dict[str, Column]:
    return {"other_month": ~((_col("year") == year) & (_col("month") == month)).eqNullSafe(F.lit(True))}


def require_single_month(df: DataFrame, year: int, month: int, label: str = "table") -> None:
    """Exactly one month, and the expected one: min = max = target."""
    index = as_int(df, "year") * 12 + as_int(df, "month") - 1
    row = df.agg(F.min(index).alias("lo"), F.max(index).alias("hi"), F.count_if(index.isNull()).alias("bad")).first()
    if row["bad"] or row["lo"] is None or row["lo"] != row["hi"]:
        raise QualityError(f"{label} must contain exactly one month")
    if row["lo"] != year * 12 + month - 1:
        raise QualityError(f"{label} month does not match {year}-{month:02d}")


# ---- keys ----------------------------------------------------------------------------------


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of extra rows; null keys count too."""
    return (
        df.groupBy(*[_col(k) for k in keys])
        .agg((F.count(F.lit(1)) - 1).alias("extra_rows"))
        .where(F.col("extra_rows") > 0)
    )


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return duplicate_keys(df, keys).agg(
        F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum("extra_rows"), F.lit(0)).alias("duplicate_rows")
    )


def duplicate_examples(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` duplicated keys in key order."""
    return duplicate_keys(df, keys).orderBy(*[_col(k) for k in keys]).limit(n)


def require_unique(df: DataFrame, keys: Sequence[str], label: str = "table") -> None:
    extra = duplicate_summary(df, keys).first()["duplicate_rows"]
    if extra:
        examples = [tuple(r)[: len(keys)] for r in duplicate_examples(df, keys).collect()]
        raise QualityError(f"{label} has {extra} duplicate rows for {list(keys)}; examples {examples}")


def universe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key sets compared both ways in one shuffle: common, left only, right only, repeats."""
    tagged = left.select(*[_col(k) for k in keys], F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*[_col(k) for k in keys], F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_key = tagged.groupBy(*[_col(k) for k in keys]).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    return per_key.agg(
        F.count_if((F.col("l") > 0) & (F.col("r") > 0)).alias("common_keys"),
        F.count_if(F.col("r") == 0).alias("left_only_keys"),
        F.count_if(F.col("l") == 0).alias("right_only_keys"),
        F.coalesce(F.sum(F.greatest(F.col("l") - 1, F.lit(0))), F.lit(0)).alias("left_repeats"),
        F.coalesce(F.sum(F.greatest(F.col("r") - 1, F.lit(0))), F.lit(0)).alias("right_repeats"),
    )


def require_same_universe(left: DataFrame, right: DataFrame, keys: Sequence[str], label: str = "rows") -> dict:
    row = universe(left, right, keys).first().asDict()
    if row["left_only_keys"] or row["right_only_keys"]:
        raise QualityError(f"{label}: row universe must match, got {row}")
    return row


def key_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of left keys that the right side lacks."""
    return left.join(right, list(keys), "left_anti").agg(F.count(F.lit(1)).alias("missing_keys"))


# ---- missingness and profiles ----------------------------------------------------------------


def missingness(
    df: DataFrame, columns: Sequence[str] | None = None, vocabulary: str = "builder"
) -> DataFrame:
    """``column, missing_count, missing_rate``; every column counted in the same pass."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    counted = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(is_missing(f, vocabulary)).alias(f"_m{i}") for i, f in enumerate(fields)]
    )
    rows = F.array(
        *[F.struct(F.lit(f.name).alias("column"), F.col(f"_m{i}").alias("missing_count")) for i, f in enumerate(fields)]
    )
    rate = F.when(F.col("_n") == 0, 0.0).otherwise(F.col("missing_count") / F.col("_n"))
    return counted.select("_n", F.inline(rows)).select("column", "missing_count", rate.alias("missing_rate"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None, top: int | None = None) -> DataFrame:
    """Missing count and per cent (two decimals), most missing first; ``top`` keeps the head."""
    profile = missingness(df, columns).select(
        F.col("column").alias("feature"),
        F.col("missing_count").alias("null_count"),
        F.round(F.col("missing_rate") * 100, 2).alias("null_percentage"),
    )
    ordered = profile.orderBy(F.desc("null_count"), "feature")
    return ordered.limit(top) if top else ordered


def coverage(df: DataFrame, id_column: str = "area_id") -> DataFrame:
    """Unique, present and missing ids."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(_col(id_column)).alias("unique_area_count"),
        F.count(_col(id_column)).alias("area_id_nonmissing"),
        F.count_if(_col(id_column).isNull()).alias("area_id_missing"),
    )


# ---- coverage and rates ----------------------------------------------------------------------
def table_coverage(df: DataFrame, outcomes: Sequence[str] = OUTCOME_COLUMNS) -> DataFrame:
    """First and last valid month and the number of present values per outcome column."""
    year, month = as_int(df, "year"), as_int(df, "month")
    index = F.when(month.between(1, 12), month_index(year, month))
    kept = [f.name for f in df.schema.fields if f.name in outcomes]
    row = df.agg(
        F.min(index).alias("_lo"), F.max(index).alias("_hi"), *[F.count_if(~_blank(df, c)).alias(f"present_{c}") for c in kept]
    )
    texts = [
        year_month_text(index_year(F.col(i)), index_month(F.col(i))).alias(name)
        for i, name in (("_lo", "first_month"), ("_hi", "last_month"))
    ]
    return row.select(*texts, *[f"present_{c}" for c in kept])


def invalid_examples(df: DataFrame, column: str, bad: Column, n: int = 5) -> DataFrame:
    """The first ``n`` distinct offending values in text order."""
    value = _col(column).cast("string").alias("value")
    return df.where(bad).select(value).distinct().orderBy("value").limit(n)


def missing_rate_gate(before: DataFrame, after: DataFrame, tolerances: DataFrame) -> DataFrame:
    """Missing rates before and after filling beside their tolerance: ``feature, …, within``."""
    pre = missingness(before).select(F.col("column").alias("feature"), F.col("missing_rate").alias("rate_before"))
    post = missingness(after).select(F.col("column").alias("feature"), F.col("missing_rate").alias("rate_after"))
    return (
        tolerances.join(pre, "feature", "left")
        .join(post, "feature", "left")
        .select("feature", "tolerance", "rate_before", "rate_after", (F.col("rate_after") <= F.col("tolerance")).alias("within"))
    )


def text_fields(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
