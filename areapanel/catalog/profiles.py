"""Profiles, coverage, latest values, exact order statistics and top-n lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import quality as Q
from ..operators import static as S
from . import Registry
from .views import PANEL_SQL, lat_of, lat_sql, lon_of, lon_sql, panel, table

query = Registry()

# ---- A11 to A13: latest values and stability, on text as it comes from a file -----------------------

_RAW_PANEL_SQL = """
raw AS (
  SELECT o_orderkey AS seq, CAST(o_custkey AS VARCHAR) AS admin_code,
         CASE WHEN o_orderkey % 97 = 0 THEN 'bad' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year, CAST(month(o_orderdate) AS VARCHAR) AS month,
         CASE WHEN o_orderkey % 5 = 0 THEN 'NA' ELSE o_orderstatus END AS crop,
         CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_custkey % 7 AS VARCHAR) END AS "AEZ_4000",
         CASE WHEN o_orderkey % 4 = 0 THEN ' nan ' ELSE o_orderpriority END AS country
  FROM orders),
dated AS (
  SELECT *, CASE WHEN try_cast(year AS INTEGER) IS NULL THEN -1 ELSE try_cast(year AS INTEGER) END AS y,
         CASE WHEN try_cast(year AS INTEGER) IS NULL THEN -1 ELSE CAST(month AS INTEGER) END AS m FROM raw)"""

_PRESENT = "trim({c}) NOT IN ('','NA','N/A','NaN','nan','None','null')"


def _raw_panel(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("seq"),
        F.col("o_custkey").cast("string").alias("admin_code"),
        F.when(key % 97 == 0, "bad").otherwise(F.year("o_orderdate").cast("string")).alias("year"),
        F.month("o_orderdate").cast("string").alias("month"),
        F.when(key % 5 == 0, "NA").otherwise(F.col("o_orderstatus")).alias("crop"),
        F.when(key % 3 == 0, "").otherwise((F.col("o_custkey") % 7).cast("string")).alias("AEZ_4000"),
        F.when(key % 4 == 0, " nan ").otherwise(F.col("o_orderpriority")).alias("country"),
    )


@query(
    "a11_latest_nonmissing",
    f"""
WITH {_RAW_PANEL_SQL}
SELECT admin_code, arg_max(country, seq) FILTER ({_PRESENT.format(c='country')}) AS country, count(*) AS source_row_count,
       CASE WHEN min(y * 100 + m) < 0 THEN '' ELSE printf('%04d-%02d', min(y * 100 + m) // 100, min(y * 100 + m) % 100) END AS first_year_month,
       CASE WHEN max(y * 100 + m) < 0 THEN '' ELSE printf('%04d-%02d', max(y * 100 + m) // 100, max(y * 100 + m) % 100) END AS last_year_month,
       arg_max("AEZ_4000", {{'d': y * 100 + m, 's': seq}}) FILTER ({_PRESENT.format(c='"AEZ_4000"')}) AS "AEZ_4000",
       arg_max(crop, {{'d': y * 100 + m, 's': seq}}) FILTER ({_PRESENT.format(c='crop')}) AS crop
FROM dated GROUP BY admin_code""",
)
def a11_latest_nonmissing(spark, sf_dir):
    """Latest present value per area and column, first and last month, row count."""
    return S.latest_nonmissing(_raw_panel(spark, sf_dir), "admin_code", ["AEZ_4000", "crop"], ["country"])


@query(
    "a13_stability",
    f"""
WITH {_RAW_PANEL_SQL},
long AS (
  SELECT admin_code, 'AEZ_4000' AS feature, CASE WHEN {_PRESENT.format(c='"AEZ_4000"')} THEN "AEZ_4000" END AS v FROM raw
  UNION ALL SELECT admin_code, 'crop', CASE WHEN {_PRESENT.format(c='crop')} THEN crop END FROM raw),
per_area AS (SELECT feature, admin_code, count(v) AS n, count(DISTINCT v) AS d FROM long GROUP BY ALL)
SELECT feature, CASE feature WHEN 'crop' THEN 'asap_land_cover' ELSE 'aez' END AS family, count(*) AS areas_total,
       count(*) FILTER (n > 0) AS areas_with_value, count(*) FILTER (n = 0) AS missing_area_count, CAST(sum(n) AS BIGINT) AS source_nonmissing_rows,
       max(d) AS max_distinct_values_per_area, count(*) FILTER (d > 1) AS varying_area_count,
       CASE WHEN max(d) <= 1 THEN 'verified_static_in_source_panel' ELSE 'slow_or_varying_in_source_panel' END AS classification
FROM per_area GROUP BY feature""",
)
def a13_stability(spark, sf_dir):
    """How many values each feature takes within an area, and the class that follows."""
    raw = _raw_panel(spark, sf_dir)
    return S.stability(raw, "admin_code", S.ordered_features(raw.columns))


# ---- missingness and numeric profiles ------------------------------------------------------------------

_PROFILED = ["area_id", "order_cnt", "price_sum", "price_avg"]
_MISSING_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS n FROM panel" for c in _PROFILED
)


@query(
    "a14_missingness",
    f"""WITH {PANEL_SQL} SELECT feature AS "column", null_count AS missing_count, round(null_count / n, 8) AS missing_rate FROM ({_MISSING_SQL})""",
)
def a14_missingness(spark, sf_dir):
    """Missing count and rate of every column in one pass, as long rows."""
    return Q.missingness(panel(spark, sf_dir), _PROFILED).withColumn("missing_rate", F.round("missing_rate", 8))


@query(
    "a15_null_profile",
    f"WITH {PANEL_SQL} SELECT feature, null_count, round(null_count / n * 100, 2) AS null_percentage FROM ({_MISSING_SQL})",
)
def a15_null_profile(spark, sf_dir):
    """Null count and per cent, most missing first."""
    return Q.null_profile(panel(spark, sf_dir), _PROFILED)


@query(
    "o4_top_missing",
    f"WITH {PANEL_SQL} SELECT feature, null_count, round(null_count / n * 100, 2) AS null_percentage FROM ({_MISSING_SQL}) ORDER BY null_count DESC, feature LIMIT 2",
)
def o4_top_missing(spark, sf_dir):
    """The head of the null profile."""
    return Q.null_profile(panel(spark, sf_dir), _PROFILED, top=2)


_NUMERIC = {"l_quantity": "CAST(l_quantity AS BIGINT)", "l_extendedprice": "CAST(round(l_extendedprice) AS BIGINT)", "l_partkey": "l_partkey"}


def _numeric(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").cast("bigint").alias("l_quantity"), F.round("l_extendedprice").cast("bigint").alias("l_extendedprice"), "l_partkey"
    )


@query(
    "a16_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(x) AS count, count(*) - count(x) AS null_count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std,
       CAST(min(x) AS DOUBLE) AS min, CAST(max(x) AS DOUBLE) AS max, CAST(quantile_cont(x, 0.25) AS DOUBLE) AS q25, CAST(quantile_cont(x, 0.5) AS DOUBLE) AS q50,
       CAST(quantile_cont(x, 0.75) AS DOUBLE) AS q75 FROM (SELECT {e} AS x FROM lineitem)"""
        for c, e in _NUMERIC.items()
    ),
)
def a16_describe(spark, sf_dir):
    """Count, nulls, mean, deviation, range and exact quartiles."""
    return A.describe(_numeric(spark, sf_dir)).withColumns({c: F.round(c, 4) for c in ("mean", "std")})


@query(
    "a17_constant_cols",
    f"""WITH {PANEL_SQL} SELECT 'one' AS "column", 1.0::DOUBLE AS min, 1.0::DOUBLE AS max FROM panel HAVING min(1) = max(1)""",
)
def a17_constant_cols(spark, sf_dir):
    """Numeric columns without spread; all-null columns are not reported."""
    rows = panel(spark, sf_dir).select("order_cnt", "price_sum", F.lit(1.0).alias("one"), F.lit(None).cast("double").alias("empty"))
    return A.constant_columns(rows)


@query(
    "m3_medians",
    """
SELECT o_custkey AS area_id, CAST(coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN round(o_totalprice) END,
       (SELECT quantile_cont(CASE WHEN o_orderkey % 3 <> 0 THEN round(o_totalprice) END, 0.5) FROM orders)) AS DOUBLE) AS price, o_orderkey AS order_id
FROM orders""",
)
def m3_medians(spark, sf_dir):
    """M3: gaps filled with the column's exact median."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("area_id"), F.when(F.col("o_orderkey") % 3 != 0, F.round("o_totalprice")).alias("price"), F.col("o_orderkey").alias("order_id")
    )
    return rows.na.fill(A.medians(rows, ["price"]))


# ---- distinct counts, coverage ----------------------------------------------------------------------------


@query(
    "a18_distinct",
    f"SELECT count(DISTINCT ({lat_sql('c_custkey')}, {lon_sql('c_custkey')})) AS n_locations, count(DISTINCT c_nationkey) AS n_countries FROM customer",
)
def a18_distinct(spark, sf_dir):
    """Distinct positions and countries."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(lat_of(k).alias("lat"), lon_of(k).alias("lon"), "c_nationkey")
    return rows.agg(F.count_distinct("lat", "lon").alias("n_locations"), F.count_distinct("c_nationkey").alias("n_countries"))


@query(
    "a19_coverage",
    """
SELECT count(*) AS row_count, count(DISTINCT a) AS unique_area_count, count(a) AS area_id_nonmissing, count(*) - count(a) AS area_id_missing
FROM (SELECT CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END AS a FROM orders)""",
)
def a19_coverage(spark, sf_dir):
    """Unique, present and missing ids."""
    rows = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 13 != 0, F.col("o_custkey")).alias("area_id"))
    return Q.coverage(rows)


_OBSERVED = "CASE WHEN (area_id + month) % 5 <> 0 THEN price_sum END"


@query(
    "a20_reference_compare",
    f"""
WITH {PANEL_SQL},
pairs AS (
  SELECT {_OBSERVED} AS o, price_sum + CASE WHEN area_id % 9 = 0 THEN month ELSE 0 END AS r FROM panel WHERE year < 2001 AND order_cnt > 0)
SELECT CASE WHEN count(*) = 0 THEN 'zero_matches' WHEN count(*) < 2 THEN 'insufficient_pairs' WHEN max(abs(o - r)) > 0 THEN 'advisory_difference' ELSE 'matched' END AS status,
       count(*) AS matched_observations, CAST(max(abs(o - r)) AS DOUBLE) AS max_abs_diff, round(corr(o, r), 6) AS correlation
FROM pairs""",
)
def a20_reference_compare(spark, sf_dir):
    """Observed against reference values, one row of status, gap and correlation."""
    rows = panel(spark, sf_dir).where(F.col("order_cnt") > 0)
    a, m, v = F.col("area_id"), F.col("month"), F.col("price_sum").cast("double")
    observed = rows.select("area_id", "year", "month", F.when((a + m) % 5 != 0, v).alias("price"))
    reference = rows.where(F.col("year") < 2001).select("area_id", "year", "month", (v + F.when(a % 9 == 0, m).otherwise(0)).alias("price"))
    out = A.compare_with_reference(observed, reference, "price")
    return out.withColumn("correlation", F.round("correlation", 6))


@query(
    "a21_family_profile",
    f"""
WITH {PANEL_SQL}, rates AS (SELECT feature, null_count / n AS rate FROM ({_MISSING_SQL})),
book AS (SELECT * FROM (VALUES ('keys', 'area_id'), ('prices', 'price_sum'), ('prices', 'price_avg'), ('prices', 'price_max')) AS t(family, variable))
SELECT coalesce(family, 'not_in_codebook') AS family, count(family) AS codebook_columns, count(feature) AS panel_columns,
       count(*) FILTER (coalesce(feature, variable) = 'price_max') AS static_columns, round(avg(rate), 8) AS missing_rate
FROM rates FULL JOIN book ON feature = variable GROUP BY 1""",
)
def a21_family_profile(spark, sf_dir):
    """Listed, present and static columns per codebook family with their missing rate."""
    book = spark.createDataFrame(
        [("keys", "area_id"), ("prices", "price_sum"), ("prices", "price_avg"), ("prices", "price_max")], "group string, variable string"
    )
    out = A.family_profile(panel(spark, sf_dir).select(*_PROFILED), book, ["price_max"])
    return out.withColumn("missing_rate", F.round("missing_rate", 8))


@query(
    "a23_country_coverage",
    f"""
WITH {PANEL_SQL}
SELECT p.country_id AS country, count(*) AS n_rows, count(DISTINCT p.area_id) AS n_areas,
       count(DISTINCT ({lat_sql('p.area_id')}, {lon_sql('p.area_id')})) AS n_positions, count(DISTINCT c_mktsegment) AS n_states,
       CAST(min(p.year * 12 + p.month - 1) AS INTEGER) AS first_month_index, CAST(max(p.year * 12 + p.month - 1) AS INTEGER) AS last_month_index, count(p.price_sum) AS n_outcomes
FROM panel p JOIN customer ON c_custkey = p.area_id GROUP BY ALL""",
)
def a23_country_coverage(spark, sf_dir):
    """Rows, areas, positions, states, months and outcomes per country."""
    k = F.col("area_id")
    segments = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("area_id"), F.col("c_mktsegment").alias("state"))
    rows = panel(spark, sf_dir).join(segments, "area_id").select("*", lat_of(k).alias("lat"), lon_of(k).alias("lon"))
    return A.country_coverage(rows.withColumnRenamed("country_id", "country"), "country", "area_id", "state", "price_sum")


@query(
    "a24_table_coverage",
    f"""
WITH {PANEL_SQL}
SELECT printf('%04d-%02d', min(year * 100 + month) // 100, min(year * 100 + month) % 100) AS first_month,
       printf('%04d-%02d', max(year * 100 + month) // 100, max(year * 100 + month) % 100) AS last_month,
       count(price_sum) AS present_price_sum, count(order_cnt) AS present_order_cnt
FROM panel""",
)
def a24_table_coverage(spark, sf_dir):
    """First and last month and present values per outcome column."""
    return Q.table_coverage(panel(spark, sf_dir), ["price_sum", "order_cnt"])


# ---- orders and short lists ----------------------------------------------------------------------------------


@query(
    "o5_duplicate_examples",
    """
SELECT l_orderkey, l_linenumber, count(*) - 1 AS extra_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1 ORDER BY l_orderkey, l_linenumber LIMIT 10""",
)
def o5_duplicate_examples(spark, sf_dir):
    """The first ten duplicated keys in key order."""
    return Q.duplicate_examples(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], 10)


@query("o2_numeric_text_order", "SELECT CAST(c_custkey AS VARCHAR) AS area_id, c_name AS name FROM customer")
def o2_numeric_text_order(spark, sf_dir):
    """O1, O2: text ids in numeric order."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("area_id"), F.col("c_name").alias("name"))
    return rows.orderBy(F.col("area_id").cast("bigint"))
