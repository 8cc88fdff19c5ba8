"""Gates, key sets and file facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.coerce import unreadable
from ..functions.fixed import OUTCOME_COLUMNS, SCHEMAS, STATIC_FEATURE_COLUMNS
from ..operators import gates as G
from ..operators import quality as Q
from ..plans.monthly import base_input_gate, zonal_gate
from ..sources.lineage import file_lineage, lineage_with_rows, row_counts
from . import Registry
from .views import MONTHLY_SQL, PANEL_SQL, TARGET_MONTH, TARGET_YEAR, by_area, monthly_orders, panel, spine, table

query = Registry()

_RAW = {
    "year": "CASE WHEN o_orderkey % 101 = 0 THEN 'x' ELSE CAST(year(o_orderdate) AS {t}) END",
    "month": "CASE WHEN o_orderkey % 103 = 0 THEN '13' ELSE CAST(month(o_orderdate) AS {t}) END",
    "lat": "CASE WHEN o_orderkey % 107 = 0 THEN '91.5' WHEN o_orderkey % 109 = 0 THEN '' ELSE CAST(o_custkey % 90 AS {t}) END",
    "lon": "CASE WHEN o_orderkey % 113 = 0 THEN 'east' ELSE CAST(o_custkey % 180 AS {t}) END",
    "admin_code": "CASE WHEN o_orderkey % 127 = 0 THEN '' ELSE CAST(o_custkey AS {t}) END",
}
_RAW_SQL = "raw AS (SELECT " + ", ".join(f"{e.format(t='VARCHAR')} AS {c}" for c, e in _RAW.items()) + " FROM orders)"


def _raw(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*[F.expr(e.format(t="STRING")).alias(c) for c, e in _RAW.items()])


@query(
    "q1_value_checks",
    f"""
WITH {_RAW_SQL}
SELECT count(*) AS n_rows, count(*) FILTER (try_cast(year AS INTEGER) IS NULL) AS invalid_year,
       count(*) FILTER (try_cast(month AS INTEGER) IS NULL OR try_cast(month AS INTEGER) NOT BETWEEN 1 AND 12) AS invalid_month,
       count(*) FILTER (lat <> '' AND (try_cast(lat AS DOUBLE) IS NULL OR abs(try_cast(lat AS DOUBLE)) > 90)) AS invalid_lat,
       count(*) FILTER (lon <> '' AND (try_cast(lon AS DOUBLE) IS NULL OR abs(try_cast(lon AS DOUBLE)) > 180)) AS invalid_lon,
       count(*) FILTER (admin_code = '') AS blank_admin_code, count(*) FILTER (lat = '') AS blank_lat
FROM raw""",
)
def q1_value_checks(spark, sf_dir):
    """Q1, Q2, Q4, Q19: dates, coordinates and blanks in one aggregate."""
    raw = _raw(spark, sf_dir)
    return Q.counters(raw, {**Q.date_checks(raw), **Q.coordinate_checks(raw), **Q.blank_checks(raw, ["admin_code", "lat"])})


@query(
    "q5_duplicates",
    """
SELECT count(*) AS duplicate_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def q5_duplicates(spark, sf_dir):
    """Q5: keys that repeat, and how many rows too many."""
    return Q.duplicate_summary(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---- gates over rows broken in known places ---------------------------------------------------

_BROKEN = {
    "area_id": "CASE WHEN o_orderkey % 127 = 0 THEN '' ELSE CAST(o_custkey AS {t}) END",
    "admin_code": "CASE WHEN o_orderkey % 131 = 0 THEN 'x' WHEN o_orderkey % 127 = 0 THEN '' ELSE CAST(o_custkey AS {t}) END",
    "lat": "CASE WHEN o_orderkey % 107 = 0 THEN '91.5' WHEN o_orderkey % 109 = 0 THEN '' ELSE CAST(o_custkey % 90 AS {t}) END",
    "lon": "CASE WHEN o_orderkey % 113 = 0 THEN 'east' ELSE CAST(o_custkey % 180 AS {t}) END",
    "year": "CASE WHEN o_orderkey % 101 = 0 THEN 'x' WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN concat(CAST(year(o_orderdate) AS {t}), '.0') ELSE CAST(year(o_orderdate) AS {t}) END",
    "month": "CASE WHEN o_orderkey % 103 = 0 THEN '13' WHEN o_orderkey % 83 = 0 THEN '0' ELSE CAST(month(o_orderdate) AS {t}) END",
    **{c: f"CASE WHEN o_orderkey % {i} = 0 THEN '' ELSE CAST(o_orderkey % 5 AS {{t}}) END" for i, c in enumerate(OUTCOME_COLUMNS[:5], 3)},
    "phase5_percent": "CAST(NULL AS {t})",
    "estimated_population": "CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '10' END",
    **{c: "'1'" for c in STATIC_FEATURE_COLUMNS},
}
_BROKEN_SQL = "broken AS (SELECT " + ", ".join(f"""{e.format(t='VARCHAR')} AS "{c}\"""" for c, e in _BROKEN.items()) + " FROM orders)"
_READ_SQL = """
read AS (SELECT *, CAST(trunc(try_cast(year AS DOUBLE)) AS INTEGER) AS y, CAST(trunc(try_cast(month AS DOUBLE)) AS INTEGER) AS m,
                try_cast(lat AS DOUBLE) AS la, try_cast(lon AS DOUBLE) AS lo FROM broken)"""
_GATE_ROW = """SELECT '{gate}' AS gate, '{check}' AS "check", CAST({value} AS BIGINT) AS value, {passed} AS passed FROM read"""


def _mode_sql(mode):
    """The checks of one schema written out, row by row."""
    rules = SCHEMAS[mode]
    found = [("missing_columns", "0 * count(*)", "true"), ("rows", "count(*)", "count(*) > 0")]

    def none(check, bad):
        found.append((check, f"count(*) FILTER ({bad})", f"count(*) FILTER ({bad}) = 0"))

    for c in rules["nonblank"]:
        none(f"blank_{c}", f"coalesce({c}, '') = ''")
    none("invalid_year", "y IS NULL")
    none("invalid_month", "m IS NULL OR m NOT BETWEEN 1 AND 12")
    none("invalid_lat", "lat <> '' AND (la IS NULL OR abs(la) > 90)")
    none("invalid_lon", "lon <> '' AND (lo IS NULL OR abs(lo) > 180)")
    if rules["same_id"]:
        none("id_mismatch", "area_id <> admin_code")
    for c in OUTCOME_COLUMNS:
        have = f"count(*) FILTER (coalesce({c}, '') <> '')"
        found.append((f"present_{c}", have, f"{have} > 0" if rules["outcomes"] else "true"))
    index = "(y * 12 + m - 1) FILTER (m BETWEEN 1 AND 12)"
    found += [("min_month_index", f"min{index}", "true"), ("max_month_index", f"max{index}", "true")]
    extra = f"count(*) - count(DISTINCT ({', '.join(rules['key'])}))"
    found.append(("duplicate_rows", extra, f"{extra} = 0"))
    return [_GATE_ROW.format(gate=mode, check=c, value=v, passed=p) for c, v, p in found]


@query("q10_schema_modes", f"WITH {_BROKEN_SQL}, {_READ_SQL} " + " UNION ALL ".join(r for mode in SCHEMAS for r in _mode_sql(mode)))
def q10_schema_modes(spark, sf_dir):
    """Every check of the five schemas in one aggregate and a shuffle for each of three keys."""
    return G.schema_gates(table(spark, sf_dir, "orders").select(*[F.expr(e.format(t="STRING")).alias(c) for c, e in _BROKEN.items()]))


_BASE = {
    "area_id": "CASE WHEN c_custkey % 19 = 0 THEN ' ' ELSE concat(CAST(c_custkey AS {t}), '.0') END",
    "admin_code": "CASE WHEN c_custkey % 29 = 0 THEN 'x' WHEN c_custkey % 19 = 0 THEN '' ELSE CAST(c_custkey AS {t}) END",
    "year": "1998",
    "month": "CASE WHEN c_custkey % 17 = 0 THEN 7 ELSE 6 END",
}
_BASE_SQL = (
    "base AS (SELECT " + ", ".join(f"{e.format(t='VARCHAR')} AS {c}" for c, e in _BASE.items())
    + ", CASE WHEN c_custkey % 19 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS id FROM customer, range(2) AS t(again)"
    + " WHERE c_custkey % 13 <> 0 AND (again = 0 OR c_custkey % 23 = 0))"
)


@query(
    "q13_base_input_gate",
    f"""
WITH {_BASE_SQL}, frame AS (SELECT CAST(c_custkey AS VARCHAR) AS id, 1998 AS year, 6 AS month FROM customer),
read AS (
  SELECT (SELECT count(*) FROM base WHERE id = '') AS blank_id, (SELECT count(*) FROM base WHERE admin_code = 'x' ) AS bad_id,
         (SELECT count(*) FROM base WHERE month <> 6) AS other, (SELECT count(*) FROM base) AS n,
         (SELECT count(*) FROM (SELECT id, year, month FROM frame EXCEPT SELECT id, year, month FROM base)) AS missing,
         (SELECT count(*) FROM (SELECT id, year, month FROM base EXCEPT SELECT id, year, month FROM frame)) AS extra,
         (SELECT count(*) FROM (SELECT id, year, month FROM base INTERSECT SELECT id, year, month FROM frame)) AS common,
         (SELECT count(*) FROM base) - (SELECT count(*) FROM (SELECT DISTINCT id, year, month FROM base)) AS again)
SELECT gate, "check", CAST(value AS BIGINT) AS value, passed FROM (
  SELECT unnest([
    {{'gate': 'base input', 'check': 'blank_area_id', 'value': blank_id, 'passed': blank_id = 0}},
    {{'gate': 'base input', 'check': 'blank_year', 'value': 0, 'passed': true}},
    {{'gate': 'base input', 'check': 'blank_month', 'value': 0, 'passed': true}},
    {{'gate': 'base input', 'check': 'id_mismatch', 'value': bad_id, 'passed': bad_id = 0}},
    {{'gate': 'base input', 'check': 'other_month', 'value': other, 'passed': other = 0}},
    {{'gate': 'base input', 'check': 'universe_missing_keys', 'value': missing, 'passed': missing = 0}},
    {{'gate': 'base input', 'check': 'universe_extra_keys', 'value': extra, 'passed': extra = 0}},
    {{'gate': 'base input', 'check': 'common_keys', 'value': common, 'passed': true}},
    {{'gate': 'base input', 'check': 'duplicate_rows', 'value': again, 'passed': again = 0}},
    {{'gate': 'scaffold', 'check': 'blank_area_id', 'value': 0, 'passed': true}},
    {{'gate': 'scaffold', 'check': 'blank_year', 'value': 0, 'passed': true}},
    {{'gate': 'scaffold', 'check': 'blank_month', 'value': 0, 'passed': true}},
    {{'gate': 'model-input-forecast', 'check': 'missing_columns', 'value': 0, 'passed': true}},
    {{'gate': 'model-input-forecast', 'check': 'rows', 'value': n, 'passed': n > 0}},
    {{'gate': 'model-input-forecast', 'check': 'blank_area_id', 'value': blank_id, 'passed': blank_id = 0}},
    {{'gate': 'model-input-forecast', 'check': 'blank_year', 'value': 0, 'passed': true}},
    {{'gate': 'model-input-forecast', 'check': 'blank_month', 'value': 0, 'passed': true}},
    {{'gate': 'model-input-forecast', 'check': 'invalid_year', 'value': 0, 'passed': true}},
    {{'gate': 'model-input-forecast', 'check': 'invalid_month', 'value': 0, 'passed': true}},
    {{'gate': 'model-input-forecast', 'check': 'min_month_index', 'value': 23981, 'passed': true}},
    {{'gate': 'model-input-forecast', 'check': 'max_month_index', 'value': 23982, 'passed': true}},
    {{'gate': 'model-input-forecast', 'check': 'duplicate_rows', 'value': again, 'passed': again = 0}}], recursive := true)
  FROM read)""",
)
def q13_base_input_gate(spark, sf_dir):
    """The base-input gate over rows missing, repeated, blank, misnamed and of another month."""
    customers = table(spark, sf_dir, "customer")
    kept = customers.where("c_custkey % 13 <> 0").select("c_custkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("again"))
    base = kept.where("again = 0 OR c_custkey % 23 = 0").select(*[F.expr(e.format(t="STRING")).alias(c) for c, e in _BASE.items()])
    scaffold = customers.select("c_custkey").withColumnsRenamed({"c_custkey": "area_id"}).withColumns({"year": F.lit(1998), "month": F.lit(6)})
    return base_input_gate(base, scaffold, 1998, 6)


def _wide_sql(gate, ids, unique, month):
    """Checks of one zonal table whose ids (and months) are the rows of ``ids``."""
    own, all_ids = f"(SELECT DISTINCT area_id FROM {ids})", "(SELECT c_custkey AS area_id FROM customer)"
    again = f"(SELECT count(*) - count(DISTINCT area_id) FROM {ids})"
    found = [
        ("universe_missing_keys", f"(SELECT count(*) FROM (FROM {all_ids} EXCEPT FROM {own}))", "= 0"),
        ("universe_extra_keys", f"(SELECT count(*) FROM (FROM {own} EXCEPT FROM {all_ids}))", "= 0"),
        ("common_keys", f"(SELECT count(*) FROM (FROM {own} INTERSECT FROM {all_ids}))", ">= 0"),
        ("duplicate_rows", again, "= 0" if unique else ">= 0"),
    ]
    if month:
        found.append(("other_month", f"(SELECT count(*) FROM {ids} WHERE NOT (year = 1998 AND month = 6))", "= 0"))
    return [f"""SELECT '{gate}' AS gate, '{c}' AS "check", CAST({v} AS BIGINT) AS value, {v} {p} AS passed""" for c, v, p in found]


@query(
    "q14_zonal_gate",
    f"""
WITH {MONTHLY_SQL}, june AS (SELECT area_id FROM monthly WHERE year = 1998 AND month = 6 UNION ALL SELECT -1),
summer AS (SELECT area_id, year, month FROM monthly WHERE year = 1998 AND month IN (6, 7)) """
    + " UNION ALL ".join([*_wide_sql("wide mean", "june", False, False), *_wide_sql("long order_cnt", "summer", True, True)]),
)
def q14_zonal_gate(spark, sf_dir):
    """Wide and long zonal tables with ids missing, too many and repeated, and rows of another month."""
    monthly = monthly_orders(spark, sf_dir)
    june = monthly.where("year = 1998 AND month = 6").select(F.col("area_id").alias("region_id"), F.col("price_sum").alias("1998_06"))
    extra = table(spark, sf_dir, "region").where("r_regionkey = 0").select(F.lit(-1).cast("long").alias("region_id"), F.lit(None).cast("long").alias("1998_06"))
    summer = monthly.where("year = 1998 AND month IN (6, 7)").select("area_id", "year", "month", "order_cnt")
    scaffold = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("area_id"))
    return zonal_gate({"mean": june.unionByName(extra)}, {"order_cnt": summer}, scaffold, 1998, 6)


@query(
    "q7_id_mismatch",
    """
SELECT count(*) AS n_rows, count(*) FILTER (o_custkey % 10 = 3) AS id_mismatch, count(*) FILTER (NOT (year(o_orderdate) = 1998 AND month(o_orderdate) = 6)) AS other_month
FROM orders""",
)
def q7_id_mismatch(spark, sf_dir):
    """Q7, Q9: area id against admin code, rows outside the target month."""
    k = F.col("o_custkey")
    rows = table(spark, sf_dir, "orders").select(
        k.cast("string").alias("area_id"),
        F.when(k % 10 != 3, k.cast("string")).alias("admin_code"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )
    return Q.counters(rows, {**Q.id_mismatch_check(), **Q.month_check(TARGET_YEAR, TARGET_MONTH)})


_TEXT_VALUE = "CASE WHEN o_orderkey % 211 = 0 THEN concat('bad', o_orderkey % 9) ELSE CAST(round(o_totalprice) AS {t}) END"


@query(
    "o5_invalid_examples",
    f"""
SELECT DISTINCT v AS value FROM (SELECT {_TEXT_VALUE.format(t='VARCHAR')} AS v FROM orders) WHERE v LIKE 'bad%' ORDER BY v LIMIT 5""",
)
def o5_invalid_examples(spark, sf_dir):
    """The first five values that cannot be read as numbers."""
    rows = table(spark, sf_dir, "orders").select(F.expr(_TEXT_VALUE.format(t="STRING")).alias("v"))
    return Q.invalid_examples(rows, "v", unreadable(F.col("v"), "float"))


@query(
    "u2_universe",
    f"""
WITH {PANEL_SQL}, l AS (SELECT area_id, year, month FROM spine), r AS (SELECT area_id, year, month FROM monthly WHERE year < 2001 UNION ALL SELECT -1, 1999, 1)
SELECT (SELECT count(*) FROM (SELECT * FROM l INTERSECT SELECT * FROM r)) AS common_keys, (SELECT count(*) FROM (SELECT * FROM l EXCEPT SELECT * FROM r)) AS left_only_keys,
       (SELECT count(*) FROM (SELECT * FROM r EXCEPT SELECT * FROM l)) AS right_only_keys, CAST(0 AS BIGINT) AS left_repeats, CAST(0 AS BIGINT) AS right_repeats""",
)
def u2_universe(spark, sf_dir):
    """Key sets compared both ways in one shuffle."""
    keys = ["area_id", "year", "month"]
    extra = table(spark, sf_dir, "region").where(F.col("r_regionkey") == 0).select(
        F.lit(-1).cast("bigint").alias("area_id"), F.lit(1999).alias("year"), F.lit(1).alias("month")
    )
    right = monthly_orders(spark, sf_dir).where(F.col("year") < 2001).select(*keys).unionByName(extra)
    return Q.universe(spine(spark, sf_dir), by_area(right, sf_dir), keys)


@query(
    "u3_key_difference",
    "SELECT count(*) AS missing_keys FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)",
)
def u3_key_difference(spark, sf_dir):
    """Keys of one table that another lacks."""
    parts = table(spark, sf_dir, "part").select("p_partkey")
    sold = table(spark, sf_dir, "lineitem").where(F.col("l_quantity") > 45).select(F.col("l_partkey").alias("p_partkey"))
    return Q.key_difference(parts, sold, ["p_partkey"])


@query(
    "q18_missing_rates",
    f"""
WITH {PANEL_SQL}
SELECT 'price_sum' AS feature, 0.5::DOUBLE AS tolerance, round(count(*) FILTER (price_sum IS NULL) / count(*), 8) AS rate_before, 0.0::DOUBLE AS rate_after, true AS within FROM panel
UNION ALL
SELECT 'price_avg', 0.1::DOUBLE, round(count(*) FILTER (price_avg IS NULL) / count(*), 8), round(count(*) FILTER (price_avg IS NULL) / count(*), 8),
       count(*) FILTER (price_avg IS NULL) / count(*) <= 0.1 FROM panel""",
)
def q18_missing_rates(spark, sf_dir):
    """Q18: missing rate before and after filling against a tolerance."""
    before = panel(spark, sf_dir).select("price_sum", "price_avg")
    tolerances = spark.createDataFrame([("price_sum", 0.5), ("price_avg", 0.1)], "feature string, tolerance double")
    out = Q.missing_rate_gate(before, before.na.fill(0, ["price_sum"]), tolerances)
    return out.withColumns({c: F.round(c, 8) for c in ("rate_before", "rate_after")})


@query("s8_lineage")
def s8_lineage(spark, sf_dir):
    """Name, size and sha256 of every table file; file facts have no SQL."""
    return file_lineage(spark, sf_dir, "*.parquet").select("name", "length", "sha256")


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query(
    "s8_table_rows",
    " UNION ALL ".join(f"SELECT '{t}.parquet' AS table_file, count(*) AS data_rows FROM {t}" for t in _TABLES),
)
def s8_table_rows(spark, sf_dir):
    """File facts joined with the rows of each file by its path, added up by table."""
    counts = [row_counts(table(spark, sf_dir, t)) for t in _TABLES]
    files = file_lineage(spark, sf_dir, "*.parquet", checksum=False).withColumn("table_file", F.regexp_extract("path", r"([^/]+\.parquet)(/[^/]*)?$", 1))
    found = lineage_with_rows(files.where(F.col("table_file").isin([f"{t}.parquet" for t in _TABLES])), *counts)
    return found.groupBy("table_file").agg(F.sum("data_rows").alias("data_rows"))
