"""Group aggregates, profiles and exact order statistics."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import month_index
from ..functions.nulls import present
from .quality import missingness


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def grouped(df: DataFrame, keys: Sequence[str], null_keys: str = "drop", **aggregates: Column) -> DataFrame:
    """Group and aggregate; ``null_keys="drop"`` leaves out rows with a null in any key."""
    rows = df.dropna(subset=list(keys)) if null_keys == "drop" else df
    return rows.groupBy(*[_col(k) for k in keys]).agg(*[a.alias(n) for n, a in aggregates.items()])


def sum_or_zero(column: str | Column) -> Column:
    """Sum that skips nulls and gives 0 for a group without values."""
    return F.coalesce(F.sum(column), F.lit(0))


def mean_by(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean per group, groups without any value dropped."""
    return grouped(df, keys, **{value: F.avg(_col(value))}).where(_col(value).isNotNull())


def mean_std_by(df: DataFrame, keys: Sequence[str], value: str, mean: str, std: str) -> DataFrame:
    """Mean and sample deviation (null for a single row), groups without any value dropped."""
    return grouped(df, keys, **{mean: F.avg(_col(value)), std: F.stddev_samp(_col(value))}).where(_col(mean).isNotNull())


def latest_month(df: DataFrame) -> DataFrame:
    """The last (year, month) present."""
    top = F.max(F.struct("year", "month")).alias("m")
    return df.agg(top).select("m.year", "m.month")


def country_coverage(
    df: DataFrame, country: str, area: str, state: str, outcome: str, lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Rows, areas, positions, states, first and last month and present outcomes per country.

    Repeats collapse to one row per (country, area, state, position) first, so the distinct
    counts work on that small table and no group of a hot country is held whole.
    """
    index = month_index(F.col("year"), F.col("month"))
    units = df.groupBy(country, area, state, lat, lon).agg(
        F.count(F.lit(1)).alias("n"), F.min(index).alias("lo"), F.max(index).alias("hi"), F.count(_col(outcome)).alias("present")
    )
    return units.groupBy(country).agg(
        F.sum("n").alias("n_rows"),
        F.count_distinct(_col(area)).alias("n_areas"),
        F.count_distinct(_col(lat), _col(lon)).alias("n_positions"),
        F.count_distinct(_col(state)).alias("n_states"),
        F.min("lo").alias("first_month_index"),
        F.max("hi").alias("last_month_index"),
        F.sum("present").alias("n_outcomes"),
    )


def family_profile(panel: DataFrame, codebook: DataFrame, static_columns: Sequence[str] = ()) -> DataFrame:
    """Per codebook family: columns listed, present in the panel, present in the static table,
    and the mean missing rate of those present; unlisted panel columns form one more family."""
    rates = missingness(panel)
    listed = codebook.select(_col("variable").alias("column"), _col("group").alias("family")).distinct()
    static = F.col("column").isin(*static_columns) if static_columns else F.lit(False)
    return (
        rates.join(listed, "column", "full")
        .select(
            F.coalesce("family", F.lit("not_in_codebook")).alias("family"),
            F.col("family").isNotNull().alias("in_codebook"),
            F.col("missing_rate").isNotNull().alias("in_panel"),
            static.alias("in_static"),
            "missing_rate",
        )
        .groupBy("family")
        .agg(
            F.count_if("in_codebook").alias("codebook_columns"),
            F.count_if("in_panel").alias("panel_columns"),
            F.count_if("in_static").alias("static_columns"),
            F.avg("missing_rate").alias("missing_rate"),
        )
    )


def compare_with_reference(
    observed: DataFrame, reference: DataFrame | None, value: str, keys: Sequence[str] = ("area_id", "year", "month")
) -> DataFrame:
    """One row: status, matched pairs, largest absolute difference, correlation."""
    needed = {*keys, value}
    spark = observed.sparkSession
    schema = "status string, matched_observations bigint, max_abs_diff double, correlation double"
    if reference is None:
        return spark.createDataFrame([("not_provided", None, None, None)], schema)
    if not needed <= set(observed.columns) or not needed <= set(reference.columns):
        return spark.createDataFrame([("malformed_reference", None, None, None)], schema)
    theirs = reference.select(*keys, present(_col(value)).alias("_reference"))
    pairs = observed.select(*keys, present(_col(value)).alias("_observed")).join(theirs, list(keys), "inner")
    gap = F.abs(F.col("_observed") - F.col("_reference"))
    both = F.col("_observed").isNotNull() & F.col("_reference").isNotNull()
    stats = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(gap).alias("gap"),
        F.corr(F.when(both, F.col("_observed")), F.when(both, F.col("_reference"))).alias("r"),
    )
    status = (
        F.when(F.col("n") == 0, "zero_matches")
        .when(F.col("n") < 2, "insufficient_pairs")
        .when(F.col("gap") > 0, "advisory_difference")
        .otherwise("matched")
    )
    return stats.select(
        status.alias("status"),
        F.col("n").alias("matched_observations"),
        F.col("gap").alias("max_abs_diff"),
        F.when((F.col("n") >= 2) & ~F.isnan("r"), F.col("r")).alias("correlation"),
    )


_SKETCH = 10_000

# ---- numeric profile ---------------------------------------------------------------------------


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def moments(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, nulls, mean, sample deviation, min and max per column, as long rows, in one pass."""
    names = list(columns or numeric_columns(df))
    row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[a for i, c in enumerate(names) for a in (
            F.count(_col(c)).alias(f"_c{i}"),
            F.avg(_col(c)).alias(f"_a{i}"),
            F.stddev_samp(_col(c)).alias(f"_s{i}"),
            F.min(_col(c)).cast("double").alias(f"_l{i}"),
            F.max(_col(c)).cast("double").alias(f"_h{i}"),
        )],
    )
    long = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_c{i}").alias("count"),
            (F.col("_n") - F.col(f"_c{i}")).alias("null_count"),
            F.col(f"_a{i}").alias("mean"),
            F.col(f"_s{i}").alias("std"),
            F.col(f"_l{i}").alias("min"),
            F.col(f"_h{i}").alias("max"),
        )
        for i, c in enumerate(names)
    ])
    return row.select(F.inline(long))


def _between(low: float, high: float, part: float) -> float:
    """Linear between two neighbours; infinite where one of them is, NaN between opposite infinities."""
    if part == 0 or low == high:
        return low
    return low + (high - low) * part if math.isfinite(high - low) else low * (1 - part) + high * part


def order_statistics(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], most_rows: int = 65_536, group: int = 32
) -> dict[str, list[float | None]]:
    """Exact quantiles (linear between ranks) of whole columns, without sorting or gathering them.

    Infinities are counted apart. A sketch brackets each wanted rank of the finite values and one
    counting pass places the bracket. Each further pass counts values in equal-width buckets of the
    interval that still holds the rank, then narrows the interval to one bucket, whose least and
    greatest value fall apart in the next pass, so it ends. Intervals with few rows, or one value, give
    the exact answer. Columns are taken ``group`` at a time; a pass returns about ``most_rows`` rows
    in all, shared among the open intervals, and hot values only raise a count.
    """
    found: dict[str, list[float | None]] = {}
    for k in range(0, len(columns), group):
        found.update(_order_statistics(df, list(columns[k : k + group]), probabilities, most_rows))
    return found


def _order_statistics(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], most_rows: int) -> dict[str, list[float | None]]:
    given = {c: _col(c).cast("double") for c in columns}
    numbers = {c: F.when(F.abs(x) < F.lit(math.inf), x) for c, x in given.items()}
    slack = 4.0 / _SKETCH
    lows = [max(0.0, p - slack) for p in probabilities]
    highs = [min(1.0, p + slack) for p in probabilities]
    wide = df.agg(
        *[a for i, c in enumerate(columns) for a in (
            F.count(numbers[c]).alias(f"n{i}"),
            F.count_if(given[c] == -math.inf).alias(f"least{i}"),
            F.count_if(given[c] == math.inf).alias(f"most{i}"),
            F.min(numbers[c]).alias(f"lo{i}"),
            F.max(numbers[c]).alias(f"hi{i}"),
            F.percentile_approx(numbers[c], [*lows, *highs], _SKETCH).alias(f"q{i}"),
        )]
    ).first()
    wanted: dict[int, dict[int, dict]] = {}
    brackets: list[Column] = []
    for i, c in enumerate(columns):
        n, wanted[i] = wide[f"n{i}"], {}
        for j, p in enumerate(probabilities):
            if n:
                lo, hi = wide[f"q{i}"][j], wide[f"q{i}"][len(probabilities) + j]
                brackets.append(F.count_if(numbers[c] < lo).alias(f"b{i}_{j}"))
                brackets.append(F.count_if(numbers[c].between(lo, hi)).alias(f"w{i}_{j}"))
    placed = df.agg(*brackets).first() if brackets else None
    for i, _ in enumerate(columns):
        n, least = wide[f"n{i}"], wide[f"least{i}"]
        every = least + n + wide[f"most{i}"]
        for j, p in enumerate(probabilities if every else []):
            for place in {math.floor(p * (every - 1)), math.ceil(p * (every - 1))}:
                rank = place - least
                if not 0 <= rank < n:
                    wanted[i][rank] = {"lo": None, "hi": None, "value": -math.inf if rank < 0 else math.inf}
                    continue
                below, within = placed[f"b{i}_{j}"], placed[f"w{i}_{j}"]
                if below <= rank < below + within:
                    lo, hi = wide[f"q{i}"][j], wide[f"q{i}"][len(probabilities) + j]
                    wanted[i][rank] = {"lo": lo, "hi": hi, "below": below, "rows": within, "value": None}
                else:  # the sketch missed: start from the whole column
                    wanted[i][rank] = {"lo": wide[f"lo{i}"], "hi": wide[f"hi{i}"], "below": 0, "rows": n, "value": None}

    def open_intervals() -> dict[tuple[int, float, float], list[dict]]:
        groups: dict[tuple[int, float, float], list[dict]] = {}
        for i, ranks in wanted.items():
            for rank, s in ranks.items():
                if s["value"] is None and s["lo"] == s["hi"]:
                    s["value"] = s["lo"]
                if s["value"] is None:
                    groups.setdefault((i, s["lo"], s["hi"]), []).append({"rank": rank, "state": s})
        return groups

    while True:
        groups = open_intervals()
        if not groups:
            break
        slots = list(groups)
        share = max(64, most_rows // len(slots))
        entries, touched = [], F.lit(False)
        for k, (i, lo, hi) in enumerate(slots):
            x = numbers[columns[i]]
            # Halves do not overflow; a width that vanishes holds a few values only.
            width = hi / 2 - lo / 2
            small = groups[slots[k]][0]["state"]["rows"] <= share or width == 0
            step = F.floor((x / 2 - F.lit(lo / 2)) / F.lit(width or 1.0) * share)
            bucket = F.least(step, F.lit(share - 1)).cast("int")
            touched = touched | x.between(lo, hi)
            entries.append(
                F.when(
                    x.between(lo, hi),
                    F.struct(F.lit(k).alias("k"), (F.lit(-1) if small else bucket).alias("b"), x.alias("x")),
                )
            )
        found = df.where(touched).select(F.inline(F.array_compact(F.array(*entries))))
        # Small intervals come back value by value with their counts, large ones bucket by bucket.
        counted = (
            found.groupBy("k", "b", F.when(F.col("b") == -1, F.col("x")).alias("v"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
            .collect()
        )
        for k, key in enumerate(slots):
            cells = sorted((c["lo"], c["hi"], c["n"]) for c in counted if c["k"] == k)
            for member in groups[key]:
                s, seen = member["state"], member["state"]["below"]
                for lo, hi, n in cells:
                    if member["rank"] < seen + n:
                        s.update(lo=lo, hi=hi, below=seen, rows=n)
                        break
                    seen += n
    result: dict[str, list[float | None]] = {}
    for i, c in enumerate(columns):
        least, values = wide[f"least{i}"], []
        every = least + wide[f"n{i}"] + wide[f"most{i}"]
        for p in probabilities:
            if not every:
                values.append(None)
                continue
            at = p * (every - 1)
            low, high = (wanted[i][place - least]["value"] for place in (math.floor(at), math.ceil(at)))
            values.append(_between(low, high, at - math.floor(at)))
        result[c] = values
    return result


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """:func:`moments` plus exact quartiles."""
    names = list(columns or numeric_columns(df))
    quartiles = order_statistics(df, names, [0.25, 0.5, 0.75])
    rows = [(c, *quartiles[c]) for c in names]
    side = df.sparkSession.createDataFrame(rows, "column string, q25 double, q50 double, q75 double")
    return moments(df, names).join(F.broadcast(side), "column")


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 1e-9) -> DataFrame:
    """Numeric columns whose deviation or range is below ``threshold``; all-null ones are skipped."""
    flat = (F.col("std") < threshold) | (F.abs(F.col("max") - F.col("min")) < threshold)
    return moments(df, columns).where(F.coalesce(flat, F.lit(False))).select("column", "min", "max")


def drop_constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.drop(*[r["column"] for r in constant_columns(df, columns).collect()])


def medians(df: DataFrame, columns: Sequence[str]) -> Mapping[str, float | None]:
    """Imputation statistics: the exact median of each column."""
    return {c: v[0] for c, v in order_statistics(df, columns, [0.5]).items()}
