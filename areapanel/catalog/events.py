"""Event counts, pivots, administrative roll-ups and point means."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregates import grouped, mean_std_by
from ..plans import conflict as C
from ..plans.prices import price_points
from ..sources.readers import union_extracts
from . import Registry
from .views import CONFLICT_SQL, conflict, lat_of, lat_sql, lon_of, lon_sql, table

query = Registry()

_PLACE = "country, admin1, admin2, admin3, location, latitude, longitude"
_KINDS = {"battles": "Battles", "explosions": "Explosions/Remote violence", "violence": "Violence against civilians"}
_FULL = "admin3 IS NOT NULL"


def _cells() -> str:
    counts = [f"count(*) FILTER (event_type = '{t}') AS event_count_{k}" for k, t in _KINDS.items()]
    sums = [f"CAST(coalesce(sum(fatalities) FILTER (event_type = '{t}'), 0) AS BIGINT) AS sum_fatalities_{k}" for k, t in _KINDS.items()]
    return ", ".join(counts + sums)


def _sums(suffix: str = "") -> str:
    return ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}{suffix}" for m in C.MEASURES)


def _mean(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18, 12))) AS DOUBLE) / count({column})"


_PIVOT_SQL = f"""{CONFLICT_SQL},
pivoted AS (
  SELECT country, admin1, admin2, admin3, location, latitude AS lat, longitude AS lon, year, month, {_cells()}
  FROM conflict WHERE {_FULL} GROUP BY ALL)"""

_UNITS_SQL = f"""{_PIVOT_SQL},
adm3 AS (
  SELECT country, admin1, admin2, admin3, year, month, {_sums()}, {_mean('lat')} AS lat, {_mean('lon')} AS lon FROM pivoted
  GROUP BY country, admin1, admin2, admin3, year, month),
adm2 AS (SELECT country, admin1, admin2, year, month, {_sums('_w5')} FROM pivoted GROUP BY ALL),
adm1 AS (SELECT country, admin1, year, month, {_sums('_w10')} FROM pivoted GROUP BY ALL)"""


@query(
    "a1_event_agg",
    f"""
WITH {CONFLICT_SQL}
SELECT event_type, {_PLACE}, year, month, count(*) AS event_count, CAST(coalesce(sum(fatalities), 0) AS BIGINT) AS sum_fatalities
FROM conflict WHERE {_FULL} GROUP BY ALL""",
)
def a1_event_agg(spark, sf_dir):
    """A1: events and fatalities by ten keys, null keys dropped."""
    return C.event_totals(conflict(spark, sf_dir))


@query("a2_event_pivot", f"WITH {_PIVOT_SQL} SELECT * FROM pivoted")
def a2_event_pivot(spark, sf_dir):
    """A2: one column per measure and kind, straight from the events."""
    return C.event_pivot(conflict(spark, sf_dir))


@query("a2_pivot_of_totals", f"WITH {_PIVOT_SQL} SELECT * FROM pivoted")
def a2_pivot_of_totals(spark, sf_dir):
    """A1 then A2: the same table in two steps."""
    return C.pivot_kinds(C.event_totals(conflict(spark, sf_dir)))


@query(
    "a3_rollup_levels",
    f"""
WITH {_UNITS_SQL}
SELECT 'admin3' AS level, count(*) AS n_units, CAST(sum(event_count_battles) AS BIGINT) AS battles, CAST(sum(sum_fatalities_violence) AS BIGINT) AS violence_deaths FROM adm3
UNION ALL SELECT 'admin2', count(*), CAST(sum(event_count_battles_w5) AS BIGINT), CAST(sum(sum_fatalities_violence_w5) AS BIGINT) FROM adm2
UNION ALL SELECT 'admin1', count(*), CAST(sum(event_count_battles_w10) AS BIGINT), CAST(sum(sum_fatalities_violence_w10) AS BIGINT) FROM adm1""",
)
def a3_rollup_levels(spark, sf_dir):
    """A3: the three administrative groupings, summed up for comparison."""
    pivoted = C.event_pivot(conflict(spark, sf_dir))
    levels = {
        "admin3": (["country", "admin1", "admin2", "admin3"], ""),
        "admin2": (["country", "admin1", "admin2"], "_w5"),
        "admin1": (["country", "admin1"], "_w10"),
    }
    parts = [
        C.level_totals(pivoted, keys, suffix).agg(
            F.lit(level).alias("level"),
            F.count(F.lit(1)).alias("n_units"),
            F.sum("event_count_battles" + suffix).alias("battles"),
            F.sum("sum_fatalities_violence" + suffix).alias("violence_deaths"),
        )
        for level, (keys, suffix) in levels.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "j22_parent_sums",
    f"""
WITH {_UNITS_SQL}
SELECT adm3.* REPLACE (round(lat, 6) AS lat, round(lon, 6) AS lon), adm2.* EXCLUDE (country, admin1, admin2, year, month),
       adm1.* EXCLUDE (country, admin1, year, month)
FROM adm3 LEFT JOIN adm2 USING (country, admin1, admin2, year, month) LEFT JOIN adm1 USING (country, admin1, year, month)""",
)
def j22_parent_sums(spark, sf_dir):
    """Smallest units with mean position and the sums of the two levels above."""
    units = C.admin_units(C.event_pivot(conflict(spark, sf_dir)))
    return units.withColumns({"lat": F.round("lat", 6), "lon": F.round("lon", 6)})


_PRICES_SQL = f"""
extracts AS (
  SELECT CAST(o_orderdate AS DATE) AS date, {lat_sql('o_custkey')} AS lat, {lon_sql('o_custkey')} AS long,
         CASE WHEN o_custkey % 11 <> 0 THEN CAST(round(o_totalprice) AS BIGINT) % 200 - 100 END AS change FROM orders)"""


def _extracts(spark, sf_dir):
    """Two price extracts with the same four columns and one more of their own."""
    k = F.col("o_custkey")
    rows = table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("date"),
        lat_of(k).alias("lat"),
        lon_of(k).alias("long"),
        F.when(k % 11 != 0, F.round("o_totalprice").cast("bigint") % 200 - 100).alias("percentageChangeWRTReferencePrice"),
        "o_orderstatus",
        "o_orderpriority",
    )
    filled = F.col("o_orderstatus") == "F"
    parts = [rows.where(filled).drop("o_orderpriority"), rows.where(~filled).drop("o_orderstatus")]
    return union_extracts(parts, ["date", "lat", "long", "percentageChangeWRTReferencePrice"])


@query("s3_union_extracts", f"WITH {_PRICES_SQL} SELECT date, count(*) AS n_rows, count(change) AS n_values, CAST(sum(change) AS BIGINT) AS total FROM extracts GROUP BY date")
def s3_union_extracts(spark, sf_dir):
    """S3: row union of two extracts, summed per day."""
    change = "percentageChangeWRTReferencePrice"
    return _extracts(spark, sf_dir).groupBy("date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(change).alias("n_values"), F.sum(change).alias("total")
    )


@query(
    "a4_point_mean",
    f"""
WITH {_PRICES_SQL}
SELECT lat, long AS lon, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, round(avg(change + 100), 6) AS "FAO_price"
FROM extracts GROUP BY ALL HAVING avg(change) IS NOT NULL""",
)
def a4_point_mean(spark, sf_dir):
    """Mean price index per position and month, empty ones dropped."""
    return price_points(_extracts(spark, sf_dir)).withColumn("FAO_price", F.round("FAO_price", 6))


@query(
    "a5_mean_std",
    """
SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       round(avg(CAST(l_quantity AS BIGINT)), 4) AS "WFP_Price", round(stddev_samp(CAST(l_quantity AS BIGINT)), 4) AS "WFP_Price_std"
FROM lineitem GROUP BY ALL""",
)
def a5_mean_std(spark, sf_dir):
    """A5: mean and sample deviation; a single row has no deviation."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), F.col("l_quantity").cast("bigint").alias("q")
    )
    out = mean_std_by(rows, ["l_suppkey", "year", "month"], "q", "WFP_Price", "WFP_Price_std")
    return out.withColumns({c: F.round(c, 4) for c in ("WFP_Price", "WFP_Price_std")})


@query(
    "a6_duplicate_mean",
    """
SELECT l_orderkey, l_linenumber, round(avg(CAST(l_quantity AS BIGINT)), 6) AS quantity FROM lineitem GROUP BY ALL""",
)
def a6_duplicate_mean(spark, sf_dir):
    """Repeated keys averaged."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("q"))
    return grouped(rows, ["l_orderkey", "l_linenumber"], quantity=F.round(F.avg("q"), 6))
