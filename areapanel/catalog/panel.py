"""Assembly, joins, reshape and time-series queries on the area-month panel."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.fixed import LAND_SURFACE_BANDS
from ..operators import dedup, joins, reshape, series
from ..operators.aggregates import latest_month
from ..plans.indicators import indicator
from ..plans.monthly import assemble_month, assembly_missingness, assembly_summary
from ..plans.scaffold import month_universe, monthly_scaffold
from ..session import cut_lineage, shared_folder
from ..sources.sinks import read_chunks, write_chunks
from . import Registry
from .views import (
    LAST_MONTH,
    MONTHLY_SQL,
    PANEL_SQL,
    TARGET_MONTH,
    TARGET_YEAR,
    lat_of,
    lat_sql,
    lon_of,
    lon_sql,
    monthly_orders,
    panel,
    table,
)

query = Registry()

# ---- J1, M1: monthly assembly ---------------------------------------------------------------------

_RAW_ADMIN = "CASE WHEN c_custkey % 2 = 0 THEN concat(c_custkey, '.0') ELSE concat(' ', c_custkey, ' ') END"

_ASSEMBLY_SQL = f"""{PANEL_SQL},
scaffold AS (
  SELECT CAST(c_custkey AS VARCHAR) AS area_id, {_RAW_ADMIN} AS admin_code, {lat_sql('c_custkey')} AS lat, {lon_sql('c_custkey')} AS lon,
         {TARGET_YEAR} AS year, {TARGET_MONTH} AS month FROM customer),
per_nation AS (SELECT s_nationkey, count(*) AS n_suppliers FROM supplier GROUP BY ALL),
static AS (
  SELECT CAST(c_custkey AS VARCHAR) AS area_id, n_name AS country, r_name AS region, coalesce(n_suppliers, 0) AS n_suppliers, 7 AS overlap
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN per_nation ON s_nationkey = n_nationkey WHERE c_custkey % 10 <> 9),
slice AS (
  SELECT CAST(area_id AS VARCHAR) AS area_id, order_cnt, price_sum FROM monthly WHERE year = {TARGET_YEAR} AND month = {TARGET_MONTH}),
assembled AS (
  SELECT s.*, t.country, t.region, t.n_suppliers, t.overlap, p.order_cnt, p.price_sum,
         t.area_id IS NOT NULL AS static_hit, p.area_id IS NOT NULL AS source_hit
  FROM scaffold s LEFT JOIN static t USING (area_id) LEFT JOIN slice p USING (area_id))"""


def assembly(spark, sf_dir, only=None, check=False, repeats=False):
    """Scaffold, static and panel inputs from the tables; ids need normalising on the scaffold side.

    With ``repeats`` every 13th area's panel rows stand twice, the second dearer, and every 17th area's once more without id.
    """
    customer = table(spark, sf_dir, "customer")
    scaffold = customer.select(
        F.expr(_RAW_ADMIN).alias("admin_code"),
        lat_of(F.col("c_custkey")).alias("lat"),
        lon_of(F.col("c_custkey")).alias("lon"),
        F.lit(TARGET_YEAR).alias("year"),
        F.lit(TARGET_MONTH).alias("month"),
    )
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    per_nation = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_suppliers"))
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).join(
        per_nation, F.col("n_nationkey") == F.col("s_nationkey"), "left"
    )
    static = (
        customer.where(F.col("c_custkey") % 10 != 9)
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").cast("string").alias("area_id"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            F.coalesce("n_suppliers", F.lit(0)).alias("n_suppliers"),
            F.lit(7).alias("overlap"),
        )
    )
    source = monthly_orders(spark, sf_dir, only).select(
        F.col("area_id").cast("string").alias("admin_code"),
        "year",
        "month",
        "order_cnt",
        "price_sum",
        F.lit(99).alias("overlap"),
        F.col("price_sum").alias("price_sum__l12"),
        F.col("order_cnt").alias("order_lag1"),
    )
    if repeats:
        area = F.col("admin_code").cast("long")
        dearer = source.where(area % 13 == 0).withColumn("price_sum", F.col("price_sum") + 1)
        source = source.unionByName(dearer).unionByName(source.where(area % 17 == 0).withColumn("admin_code", F.lit(" ")))
    return assemble_month(scaffold, static, source, TARGET_YEAR, TARGET_MONTH, order=["price_sum"], check=check)


@query(
    "j1_assemble_month",
    f"""
WITH {_ASSEMBLY_SQL}
SELECT area_id, admin_code, lat, lon, year, month, country, region, n_suppliers, overlap, order_cnt, price_sum FROM assembled""",
)
def j1_assemble_month(spark, sf_dir):
    """Scaffold with static and same-month source columns."""
    return assembly(spark, sf_dir, (TARGET_YEAR, TARGET_MONTH)).base


@query(
    "m1_assembly_summary",
    f"""
WITH {_ASSEMBLY_SQL}
SELECT count(*) AS row_count, count(*) FILTER (static_hit) AS static_matched, count(*) FILTER (NOT static_hit) AS static_unmatched,
       count(*) FILTER (source_hit) AS source_matched, count(*) FILTER (NOT source_hit) AS source_unmatched,
       count(country) AS static_with_values, count(order_cnt) AS source_with_values, CAST(12 AS INTEGER) AS column_count,
       CAST(4 AS INTEGER) AS static_feature_columns, CAST(2 AS INTEGER) AS source_feature_columns,
       (SELECT count(*) FROM monthly) AS scanned_rows,
       (SELECT count(*) FROM slice) AS target_month_rows, CAST(0 AS BIGINT) AS duplicate_rows, CAST(0 AS BIGINT) AS blank_id_rows,
       (SELECT count(*) > 0 FROM slice) AS target_month_present
FROM assembled""",
)
def m1_assembly_summary(spark, sf_dir):
    """M1: sizes, hits and panel-side counts of the assembly."""
    return assembly_summary(assembly(spark, sf_dir))


_REPEATS_SQL = f"""{_ASSEMBLY_SQL},
repeated AS (
  SELECT CAST(area_id AS VARCHAR) AS area_id, year, month FROM monthly
  UNION ALL SELECT CAST(area_id AS VARCHAR), year, month FROM monthly WHERE area_id % 13 = 0
  UNION ALL SELECT '', year, month FROM monthly WHERE area_id % 17 = 0),
here AS (SELECT area_id, count(*) AS n FROM repeated WHERE year = {TARGET_YEAR} AND month = {TARGET_MONTH} GROUP BY ALL)"""


@query(
    "j1_checked_month",
    f"""
WITH {_ASSEMBLY_SQL}
SELECT area_id, admin_code, lat, lon, year, month, country, region, n_suppliers, overlap, order_cnt, price_sum FROM assembled""",
)
def j1_checked_month(spark, sf_dir):
    """The gates run first; the panel has repeated rows, of which the cheapest stays, and rows without id, which match nothing."""
    return assembly(spark, sf_dir, check=True, repeats=True).base


@query(
    "m1_repeated_panel",
    f"""
WITH {_REPEATS_SQL}
SELECT count(*) AS row_count, count(*) FILTER (static_hit) AS static_matched, count(*) FILTER (NOT static_hit) AS static_unmatched,
       count(*) FILTER (source_hit) AS source_matched, count(*) FILTER (NOT source_hit) AS source_unmatched,
       count(country) AS static_with_values, count(order_cnt) AS source_with_values, CAST(12 AS INTEGER) AS column_count,
       CAST(4 AS INTEGER) AS static_feature_columns, CAST(2 AS INTEGER) AS source_feature_columns,
       (SELECT count(*) FROM repeated) AS scanned_rows, (SELECT CAST(sum(n) AS BIGINT) FROM here) AS target_month_rows,
       (SELECT CAST(sum(n - 1) AS BIGINT) FROM here) AS duplicate_rows,
       (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM here WHERE area_id = '') AS blank_id_rows,
       (SELECT count(*) > 0 FROM here) AS target_month_present
FROM assembled""",
)
def m1_repeated_panel(spark, sf_dir):
    """M1: the summary over a panel with repeated rows and rows without id."""
    return assembly_summary(assembly(spark, sf_dir, repeats=True))


_BASE = ["area_id", "admin_code", "lat", "lon", "year", "month", "country", "region", "n_suppliers", "overlap", "order_cnt", "price_sum"]
_BASE_MISSING_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS missing_rate FROM assembled"
    for c in _BASE
)


@query("m1_missingness", f"WITH {_ASSEMBLY_SQL} {_BASE_MISSING_SQL}")
def m1_missingness(spark, sf_dir):
    """M1: missing values of every column of the assembled month."""
    return assembly_missingness(assembly(spark, sf_dir))


# ---- joins ------------------------------------------------------------------------------------------


@query(
    "j7_match_counts",
    f"""
WITH {PANEL_SQL}
SELECT CASE WHEN m.area_id IS NULL THEN 'left_only' ELSE 'both' END AS merge, count(*) AS n_rows
FROM spine s LEFT JOIN monthly m USING (area_id, year, month) GROUP BY ALL""",
)
def j7_match_counts(spark, sf_dir):
    """Left join on area and month with match counts."""
    rows = panel(spark, sf_dir).select("area_id", "year", "month")
    joined = joins.left_join(rows, monthly_orders(spark, sf_dir), ["area_id", "year", "month"], matched="hit")
    return joins.match_counts(joined, "hit")


_YEARLY_SQL = f"""{MONTHLY_SQL},
country_year AS (
  SELECT c_nationkey AS country_id, year, CAST(sum(price_sum) AS BIGINT) AS country_sum FROM monthly JOIN customer ON c_custkey = area_id
  WHERE c_nationkey % 7 <> 0 GROUP BY ALL),
country_month AS (
  SELECT c_nationkey AS country_id, year, month, CAST(sum(order_cnt) AS BIGINT) AS country_orders FROM monthly JOIN customer ON c_custkey = area_id
  WHERE month % 3 = 0 GROUP BY ALL)"""


@query(
    "j4_country_year",
    f"""
WITH {_YEARLY_SQL}
SELECT area_id, m.year, m.month, c_nationkey AS country_id, country_sum, country_orders
FROM monthly m JOIN customer ON c_custkey = area_id
LEFT JOIN country_year y ON y.country_id = c_nationkey AND y.year = m.year
LEFT JOIN country_month k ON k.country_id = c_nationkey AND k.year = m.year AND k.month = m.month""",
)
def j4_country_year(spark, sf_dir):
    """Left joins on country-year and country-year-month."""
    country = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("area_id"), F.col("c_nationkey").alias("country_id"))
    rows = monthly_orders(spark, sf_dir).join(country, "area_id")
    yearly = rows.where(F.col("country_id") % 7 != 0).groupBy("country_id", "year").agg(F.sum("price_sum").alias("country_sum"))
    monthly = rows.where(F.col("month") % 3 == 0).groupBy("country_id", "year", "month").agg(F.sum("order_cnt").alias("country_orders"))
    keyed = rows.select("area_id", "year", "month", "country_id")
    return joins.left_join(joins.left_join(keyed, yearly, ["country_id", "year"]), monthly, ["country_id", "year", "month"])


@query(
    "j6_title_join",
    """
WITH places AS (
  SELECT p_partkey, p_name AS title, p_brand AS brand, p_size AS size, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part)
SELECT p.p_partkey, p.p_name AS title, q.brand AS title_brand, q.size AS title_size
FROM part p LEFT JOIN (SELECT * FROM places WHERE rn = 1 AND size > 10) q ON p.p_name = q.title""",
)
def j6_title_join(spark, sf_dir):
    """Left join on a text title whose right side is first made unique."""
    part = table(spark, sf_dir, "part")
    places = dedup.keep_one(
        part.select("p_partkey", F.col("p_name").alias("title"), F.col("p_brand").alias("title_brand"), F.col("p_size").alias("title_size")),
        ["title"],
        ["p_partkey"],
    ).where(F.col("title_size") > 10)
    rows = part.select("p_partkey", F.col("p_name").alias("title"))
    return joins.left_join(rows, places, ["title"], ["title_brand", "title_size"])


@query(
    "j8_validated_join",
    """
SELECT o_orderkey, o_custkey, c_mktsegment, c_nationkey FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def j8_validated_join(spark, sf_dir):
    """Many-to-one join; a repeated right key would raise."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return joins.left_join(orders, customer, ["o_custkey"], validate="many_to_one")


@query(
    "j14_mapped_regions",
    """
SELECT o_orderkey AS order_id, o_custkey AS region_id, 'area-' || o_custkey AS area_id FROM orders""",
)
def j14_mapped_regions(spark, sf_dir):
    """Region to area mapping in which every region must match."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("region_id"))
    mapping = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("region_id"), F.concat(F.lit("area-"), F.col("c_custkey").cast("string")).alias("area_id")
    )
    return joins.mapped_join(rows, mapping, "region_id").select("order_id", "region_id", "area_id")


@query(
    "j15_outcome_attach",
    """
WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT c_custkey AS area_id, c_mktsegment AS segment, o_orderkey AS order_id, o_orderstatus AS outcome
FROM customer LEFT JOIN (SELECT * FROM o WHERE rn = 1) f ON f.o_custkey = c_custkey""",
)
def j15_outcome_attach(spark, sf_dir):
    """Outcome made unique by key, then attached to every row."""
    outcome = dedup.keep_one(
        table(spark, sf_dir, "orders").select(
            F.col("o_custkey").alias("area_id"), "o_orderdate", F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("outcome")
        ),
        ["area_id"],
        ["o_orderdate", "order_id"],
    )
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("area_id"), F.col("c_mktsegment").alias("segment"))
    return joins.left_join(rows, outcome, ["area_id"], ["order_id", "outcome"])


@query(
    "j21_country_codes",
    """
SELECT c_custkey, n_name AS country_name, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code_3
FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def j21_country_codes(spark, sf_dir):
    """Country name to code, compared trimmed and in lower case."""
    nation = table(spark, sf_dir, "nation")
    code = F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    names = nation.select(F.concat(F.lit(" "), F.lower("n_name")).alias("name"), code.alias("country_code_3"))
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joins.lookup_country_code(rows.select("c_custkey", F.col("n_name").alias("country_name")), names)


@query(
    "j23_row_zip",
    """
WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS seq FROM customer),
     b AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal, s_suppkey) - 1 AS seq FROM supplier)
SELECT seq, c_custkey, s_suppkey FROM a LEFT JOIN b USING (seq)""",
)
def j23_row_zip(spark, sf_dir):
    """N-th row of one table beside the n-th row of another."""
    a = dedup.with_row_ids(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"], "seq")
    b = dedup.with_row_ids(table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), ["s_acctbal", "s_suppkey"], "seq")
    return joins.zip_by_sequence(a.select("seq", "c_custkey"), b.select("seq", "s_suppkey"))


# ---- scaffold, months --------------------------------------------------------------------------------


@query(
    "o3_latest_month",
    """
SELECT CAST(max(year(o_orderdate) * 12 + month(o_orderdate) - 1) // 12 AS INTEGER) AS year,
       CAST(max(year(o_orderdate) * 12 + month(o_orderdate) - 1) % 12 + 1 AS INTEGER) AS month FROM orders""",
)
def o3_latest_month(spark, sf_dir):
    """O3: last month present."""
    return latest_month(table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")))


@query(
    "u6_scaffold",
    f"""
SELECT CAST(c_custkey AS VARCHAR) AS admin_code, {lat_sql('c_custkey')} AS lat, {lon_sql('c_custkey')} AS lon, 2001 AS year, 9 AS month
FROM customer""",
)
def u6_scaffold(spark, sf_dir):
    """A month the reference scaffold lacks is built from the area lookup."""
    k = F.col("c_custkey")
    areas = table(spark, sf_dir, "customer").select(k.cast("string").alias("area_id"), lat_of(k).alias("lat"), lon_of(k).alias("lon"))
    reference = monthly_orders(spark, sf_dir).select(
        F.col("area_id").cast("string").alias("admin_code"), lat_of(F.col("area_id")).alias("lat"), lon_of(F.col("area_id")).alias("lon"), "year", "month"
    )
    return monthly_scaffold(reference, areas, LAST_MONTH[0], LAST_MONTH[1] + 1, check=False)


@query(
    "u4_month_universe",
    """
SELECT DISTINCT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month
FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem)""",
)
def u4_month_universe(spark, sf_dir):
    """U4: months of both tables."""
    def months(name, date):
        return table(spark, sf_dir, name).select(F.year(date).alias("year"), F.month(date).alias("month"))

    return month_universe(months("orders", "o_orderdate"), months("lineitem", "l_shipdate"))


# ---- reshape -------------------------------------------------------------------------------------------

#: Years of the given tables, and the month columns of a wide table.
_YEARS = range(1995, 2002)
_WIDE_MONTHS = [(y, m) for y in _YEARS for m in range(1, 13)]
_WIDE_CELLS_SQL = ", ".join(
    f"CAST(sum(CASE WHEN year = {y} AND month = {m} THEN price_sum END) AS BIGINT) AS \"{y}_{m:02d}\"" for y, m in _WIDE_MONTHS
)


def _wide(spark, sf_dir):
    return reshape.long_to_wide(
        monthly_orders(spark, sf_dir).withColumnRenamed("area_id", "region_id"), "price_sum", _WIDE_MONTHS
    )


@query("r5_long_to_wide", f"WITH {MONTHLY_SQL} SELECT area_id AS region_id, {_WIDE_CELLS_SQL} FROM monthly GROUP BY area_id")
def r5_long_to_wide(spark, sf_dir):
    """One column per month in calendar order."""
    return _wide(spark, sf_dir)


@query(
    "r1_wide_to_long",
    f"""
WITH {MONTHLY_SQL}, ids AS (SELECT DISTINCT area_id FROM monthly),
months AS (SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month FROM range(1995, 2002) AS a(y), range(1, 13) AS t(m))
SELECT i.area_id, k.year, k.month, CAST(m.price_sum AS DOUBLE) AS price
FROM ids i CROSS JOIN months k LEFT JOIN monthly m ON m.area_id = i.area_id AND m.year = k.year AND m.month = k.month""",
)
def r1_wide_to_long(spark, sf_dir):
    """Month columns back to rows, each wide row unfolding on its own."""
    return reshape.wide_to_long(_wide(spark, sf_dir), "price")


@query(
    "r2_selected_month",
    f"""
WITH {MONTHLY_SQL}
SELECT area_id, 1998 AS year, 4 AS month, CAST(sum(CASE WHEN year = 1998 AND month = 4 THEN price_sum END) AS BIGINT) AS price
FROM monthly GROUP BY area_id""",
)
def r2_selected_month(spark, sf_dir):
    """R2: one selected month of a wide table."""
    return reshape.select_month(_wide(spark, sf_dir), "price", 1998, 4)


@query(
    "r3_year_unpivot",
    f"""
WITH {MONTHLY_SQL}
SELECT CAST(area_id AS VARCHAR) AS country_code_3, year, CAST(sum(price_sum) AS DOUBLE) AS "CPI"
FROM monthly GROUP BY ALL""",
)
def r3_year_unpivot(spark, sf_dir):
    """Year columns with a suffix to rows, nulls dropped."""
    cells = [F.sum(F.when(F.col("year") == y, F.col("price_sum"))).alias(f"{y} [YR{y}]") for y in _YEARS]
    wide = monthly_orders(spark, sf_dir).groupBy(F.col("area_id").cast("string").alias("Country Code")).agg(*cells)
    texts = {c: F.lit("x") for c in ("Country Name", "Series Name", "Series Code")}
    return indicator(wide.withColumns(texts), "CPI")


_BANDS_SQL = """
bands AS (
  SELECT l_suppkey AS region_id, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, l_linenumber AS b,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY ALL)"""
_BANDS = range(1, 8)


@query(
    "r4_band_pivot",
    f"""
WITH {_BANDS_SQL}, ids AS (SELECT DISTINCT region_id, year FROM bands), months AS (SELECT CAST(m AS INTEGER) AS month FROM range(1, 13) AS t(m))
SELECT i.region_id AS area_id, i.year, k.month, {", ".join(f"CAST(sum(q) FILTER (b = {b}) AS DOUBLE) AS x_B{b}" for b in _BANDS)}
FROM ids i CROSS JOIN months k LEFT JOIN bands s ON s.region_id = i.region_id AND s.year = i.year AND s.month = k.month
GROUP BY ALL""",
)
def r4_band_pivot(spark, sf_dir):
    """A wide extract a year with month and band columns, united as one long table with band columns."""
    line = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("region_id"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.col("l_linenumber").alias("band"),
        F.col("l_quantity").cast("bigint").alias("q"),
    )
    extract = reshape.bands_to_wide(line, "q", _BANDS, combine=F.sum)
    return reshape.bands_to_long([extract(y) for y in _YEARS], "x")


@query(
    "r4_bands_to_columns",
    f"""
WITH {_BANDS_SQL}
SELECT region_id AS area_id, year, month, {", ".join(f'CAST(max(q) FILTER (b = {b}) AS BIGINT) AS "B{b}"' for b in _BANDS)} FROM bands GROUP BY ALL""",
)
def r4_bands_to_columns(spark, sf_dir):
    """Band rows to band columns from an explicit band list."""
    rows = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_suppkey").alias("area_id"),
            F.year("l_shipdate").alias("year"),
            F.month("l_shipdate").alias("month"),
            F.concat(F.lit("B"), F.col("l_linenumber").cast("string")).alias("band"),
        )
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    )
    return reshape.long_bands_to_columns(rows, "q", [f"B{b}" for b in _BANDS])


_HALVES = [[(y, m) for y, m in _WIDE_MONTHS if (y <= 1998) == first] for first in (True, False)]
_HALVES_SQL = " UNION ALL ".join(
    f"SELECT area_id AS region_id, {_WIDE_CELLS_SQL} FROM monthly WHERE year {sign} 1998 GROUP BY area_id" for sign in ("<=", ">")
)


def _half_extracts(spark, sf_dir):
    """Two wide extracts that split the months between them."""
    rows = monthly_orders(spark, sf_dir).withColumnRenamed("area_id", "region_id")
    early = F.col("year") <= 1998
    return [reshape.long_to_wide(rows.where(part), "price_sum", months) for part, months in zip((early, ~early), _HALVES)]


@query("s10_union_columns", f"WITH {MONTHLY_SQL} {_HALVES_SQL}")
def s10_union_columns(spark, sf_dir):
    """Extracts with different month columns, united by name over all months; what a part lacks is null."""
    return reshape.union_columns(_half_extracts(spark, sf_dir))


@query("s10_chunked_write", f"WITH {MONTHLY_SQL} {_HALVES_SQL}")
def s10_chunked_write(spark, sf_dir):
    """The same extracts written chunk by chunk, and read back under the union of their columns."""
    folder = f"{shared_folder(spark)}/chunks-{uuid.uuid4().hex}"
    write_chunks(_half_extracts(spark, sf_dir), folder)
    return cut_lineage(read_chunks(spark, folder))


# ---- windows -----------------------------------------------------------------------------------------

_W = "OVER (PARTITION BY area_id ORDER BY year, month"


@query(
    "w1_lag12",
    f"WITH {PANEL_SQL} SELECT area_id, year, month, lag(price_sum, 12) {_W}) AS price_sum_l12, lag(order_cnt, 12) {_W}) AS order_cnt_l12 FROM panel",
)
def w1_lag12(spark, sf_dir):
    """Value 12 rows earlier within the area."""
    rows = panel(spark, sf_dir).select("area_id", "year", "month", "price_sum", "order_cnt")
    return series.with_history(rows, ["price_sum", "order_cnt"], kinds="l").drop("price_sum", "order_cnt")


_CALENDAR = "OVER (PARTITION BY m.area_id ORDER BY m.year * 12 + m.month - 1 RANGE BETWEEN"


@query(
    "w1_calendar_lag",
    f"""
WITH {MONTHLY_SQL}
SELECT m.area_id, m.year, m.month, p.price_sum AS price_sum_l12,
       round(avg(m.price_sum) {_CALENDAR} 11 PRECEDING AND CURRENT ROW), 4) AS price_sum_m12,
       round(avg(m.price_sum) {_CALENDAR} 23 PRECEDING AND 12 PRECEDING), 4) AS price_sum_v12
FROM monthly m LEFT JOIN monthly p ON p.area_id = m.area_id AND p.year = m.year - 1 AND p.month = m.month""",
)
def w1_calendar_lag(spark, sf_dir):
    """W1, W2, W3 by the calendar: a panel with missing months, where 12 rows earlier is not 12 months earlier."""
    out = series.with_calendar_history(monthly_orders(spark, sf_dir).select("area_id", "year", "month", "price_sum"), ["price_sum"])
    return out.drop("price_sum").withColumns({c: F.round(c, 4) for c in ("price_sum_m12", "price_sum_v12")})


@query(
    "w2_roll12",
    f"""
WITH {PANEL_SQL}
SELECT area_id, year, month, round(avg(price_sum) {_W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 4) AS price_sum_m12 FROM panel""",
)
def w2_roll12(spark, sf_dir):
    """Mean of the last 12 rows, nulls skipped."""
    rows = panel(spark, sf_dir).select("area_id", "year", "month", "price_sum")
    out = series.with_history(rows, ["price_sum"], kinds="m")
    return out.select("area_id", "year", "month", F.round("price_sum_m12", 4).alias("price_sum_m12"))


@query(
    "w3_lagroll",
    f"""
WITH {PANEL_SQL}
SELECT area_id, year, month, lag(price_sum, 12) {_W}) AS price_sum_l12,
       round(avg(price_sum) {_W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 4) AS price_sum_m12,
       round(avg(price_sum) {_W} ROWS BETWEEN 23 PRECEDING AND 12 PRECEDING), 4) AS price_sum_v12,
       round(avg(order_cnt) {_W} ROWS BETWEEN 23 PRECEDING AND 12 PRECEDING), 4) AS order_cnt_v12
FROM panel""",
)
def w3_lagroll(spark, sf_dir):
    """W1 to W3 together: one window specification, one shuffle, one sort."""
    rows = panel(spark, sf_dir).select("area_id", "year", "month", "price_sum", "order_cnt")
    out = series.with_history(rows, ["price_sum", "order_cnt"])
    rounded = [F.round(c, 4).alias(c) for c in ("price_sum_m12", "price_sum_v12", "order_cnt_v12")]
    return out.select("area_id", "year", "month", "price_sum_l12", *rounded)


@query(
    "w4_ffill",
    f"""
WITH {PANEL_SQL}
SELECT area_id, year, month, last_value(price_sum IGNORE NULLS) {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price_sum FROM panel""",
)
def w4_ffill(spark, sf_dir):
    """Last present value carried forward within the area."""
    return series.forward_fill(panel(spark, sf_dir).select("area_id", "year", "month", "price_sum"), ["price_sum"])


@query(
    "w5_bfill",
    f"""
WITH {PANEL_SQL}
SELECT area_id, year, month, first_value(price_sum IGNORE NULLS) {_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS price_sum FROM panel""",
)
def w5_bfill(spark, sf_dir):
    """Next present value carried backward within the area."""
    return series.backward_fill(panel(spark, sf_dir).select("area_id", "year", "month", "price_sum"), ["price_sum"])


def _interp_sql(trailing: str) -> str:
    tail = "coalesce({e}, pv)" if trailing == "hold" else "{e}"
    line = "CASE WHEN pp = np THEN pv ELSE pv + (nv - pv) * (pos - pp) / (np - pp) END"
    return f"""
WITH {PANEL_SQL},
numbered AS (SELECT *, row_number() {_W}) AS pos FROM panel),
marked AS (
  SELECT *, CAST(last_value(price_sum IGNORE NULLS) {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS pv,
         last_value(CASE WHEN price_sum IS NOT NULL THEN pos END IGNORE NULLS) {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
         CAST(first_value(price_sum IGNORE NULLS) {_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS nv,
         first_value(CASE WHEN price_sum IS NOT NULL THEN pos END IGNORE NULLS) {_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
  FROM numbered)
SELECT area_id, year, month, round({tail.format(e=line)}, 4) AS price_sum FROM marked"""


@query("w6_interp", _interp_sql("null"))
def w6_interp(spark, sf_dir):
    """Linear between present values of the area, tails stay null."""
    out = series.interpolate(panel(spark, sf_dir).select("area_id", "year", "month", "price_sum"), ["price_sum"])
    return out.withColumn("price_sum", F.round("price_sum", 4))


@query("w6_interp_hold", _interp_sql("hold"))
def w6_interp_hold(spark, sf_dir):
    """The same with the last value held."""
    out = series.interpolate(panel(spark, sf_dir).select("area_id", "year", "month", "price_sum"), ["price_sum"], trailing="hold")
    return out.withColumn("price_sum", F.round("price_sum", 4))


@query(
    "w7_densify",
    f"""
WITH {MONTHLY_SQL},
yearly AS (SELECT area_id, year, avg(price_sum) AS v FROM monthly GROUP BY ALL),
bounds AS (SELECT area_id, min(year) AS lo, max(year) AS hi FROM yearly GROUP BY ALL),
grid AS (SELECT area_id, CAST(unnest(generate_series(lo, hi)) AS INTEGER) AS year FROM bounds),
joined AS (SELECT g.area_id, g.year, v FROM grid g LEFT JOIN yearly y ON y.area_id = g.area_id AND y.year = g.year),
marked AS (
  SELECT *, last_value(v IGNORE NULLS) OVER p AS pv, last_value(CASE WHEN v IS NOT NULL THEN year END IGNORE NULLS) OVER p AS pp,
         first_value(v IGNORE NULLS) OVER n AS nv, first_value(CASE WHEN v IS NOT NULL THEN year END IGNORE NULLS) OVER n AS np
  FROM joined
  WINDOW p AS (PARTITION BY area_id ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         n AS (PARTITION BY area_id ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT area_id, year, round(coalesce(CASE WHEN pp = np THEN pv ELSE pv + (nv - pv) * (year - pp) / (np - pp) END, pv), 4) AS price FROM marked""",
)
def w7_densify(spark, sf_dir):
    """Yearly mean per area, every year between first and last filled linearly."""
    rows = monthly_orders(spark, sf_dir).select("area_id", "year", F.col("price_sum").alias("price"))
    return series.densify_years(rows, "price", ["area_id"]).withColumn("price", F.round("price", 4))


@query(
    "w8_dedup",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem)
WHERE rn = 1""",
)
def w8_dedup(spark, sf_dir):
    """First row per key by a stated order."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]
    return dedup.keep_one(rows, ["l_orderkey", "l_linenumber"], order).drop("l_shipdate")


@query(
    "w9_row_ids",
    """
SELECT o_orderkey AS area_id, o_custkey, row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) - 1 AS _row_id FROM orders""",
)
def w9_row_ids(spark, sf_dir):
    """Consecutive ids in text order of the area id, without a one-partition window."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderkey").cast("string").alias("_text"))
    return dedup.with_row_ids(rows, ["_text"]).select(F.col("o_orderkey").alias("area_id"), "o_custkey", "_row_id")


@query(
    "w10_surrogate",
    f"""
WITH rows AS (
  SELECT o_orderkey, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS admin_code, {lat_sql('o_custkey')} AS lat, {lon_sql('o_custkey')} AS lon FROM orders),
places AS (
  SELECT lat, lon, row_number() OVER (ORDER BY lat, lon) - 1 + (SELECT max(admin_code) FROM rows) + 100000 AS new_code
  FROM (SELECT DISTINCT lat, lon FROM rows WHERE admin_code IS NULL))
SELECT o_orderkey, coalesce(admin_code, new_code) AS admin_code, r.lat, r.lon FROM rows r LEFT JOIN places USING (lat, lon)""",
)
def w10_surrogate(spark, sf_dir):
    """One new id per distinct position without an id."""
    k = F.col("o_custkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(k % 3 != 0, k).alias("admin_code"), lat_of(k).alias("lat"), lon_of(k).alias("lon")
    )
    return dedup.with_surrogate_ids(rows, "admin_code")


# ---- band names, base-input gate ------------------------------------------------------------------------


_QUANTITY_SQL = "(CAST(l_quantity AS BIGINT)) FILTER (l_linenumber = {b})"
_NAMED_SQL = ", ".join(
    f'CAST(sum{_QUANTITY_SQL.format(b=b)} AS BIGINT) AS "{name}_mean", round(stddev_pop{_QUANTITY_SQL.format(b=b)}, 4) AS "{name}_stdDev"'
    for b, name in zip(_BANDS, LAND_SURFACE_BANDS)
)


@query("p21_band_names", f"SELECT l_suppkey AS region_id, {_NAMED_SQL} FROM lineitem GROUP BY ALL")
def p21_band_names(spark, sf_dir):
    """Band columns to variable names by position."""
    cells = []
    for b in _BANDS:
        value = F.when(F.col("l_linenumber") == b, F.col("l_quantity").cast("bigint"))
        cells += [F.sum(value).alias(f"B{b}_x"), F.round(F.stddev_pop(value), 4).alias(f"B{b}_y")]
    return reshape.rename_bands(table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("region_id")).agg(*cells))
