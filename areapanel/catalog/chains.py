"""Whole source-to-feature jobs over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fixed import MATCH_RADIUS_KM
from ..operators.dedup import keep_one
from ..operators.predictions import prepare_inference_input
from ..plans import conflict as C
from ..plans import history as H
from ..plans import indicators as I
from ..plans import prices as R
from . import Registry
from .events import _UNITS_SQL, _extracts
from .events import _PRICES_SQL as PRICES_SQL
from .views import (
    MONTHLY_SQL,
    PANEL_SQL,
    POINTS_SQL,
    by_area,
    haversine_sql,
    lat_of,
    lat_sql,
    lon_of,
    lon_sql,
    monthly_orders,
    panel,
    right_points,
    table,
)

query = Registry()


# ---- conflict events to the nearest scaffold rows -----------------------------------------------------

_MEASURES = [m + s for s in ("", "_w5", "_w10") for m in C.MEASURES]
_EVENTS_SQL = _UNITS_SQL.replace("day(ts)", "month(ts)")


@query(
    "j9_conflict_chain",
    f"""
WITH {_EVENTS_SQL},
units AS (
  SELECT * FROM adm3 LEFT JOIN adm2 USING (country, admin1, admin2, year, month) LEFT JOIN adm1 USING (country, admin1, year, month)),
scaffold AS (
  SELECT min(c_custkey) AS area_id, {lat_sql('c_custkey')} AS lat, {lon_sql('c_custkey')} AS lon, 2024 AS year, m AS month
  FROM customer CROSS JOIN (VALUES (1), (2)) AS t(m) GROUP BY ALL),
pairs AS (SELECT s.area_id, u.*, {haversine_sql('s.lat', 's.lon', 'u.lat', 'u.lon')} AS km FROM scaffold s JOIN units u ON u.year = s.year AND u.month = s.month),
best AS (SELECT *, row_number() OVER (PARTITION BY area_id, month ORDER BY km, country, admin1, admin2, admin3) AS rn FROM pairs)
SELECT s.area_id, s.lat, s.lon, s.year, s.month, {', '.join(f'b.{m}' for m in _MEASURES)}, round(b.km, 6) AS distance_to_nearest_acled
FROM scaffold s LEFT JOIN best b ON b.area_id = s.area_id AND b.month = s.month AND b.rn = 1 AND b.km <= {MATCH_RADIUS_KM}""",
)
def j9_conflict_chain(spark, sf_dir):
    """Events to the measures of each area's nearest unit."""
    user, event = F.col("user_id"), F.col("event_id")
    events = table(spark, sf_dir, "events").select(
        F.col("ts").alias("event_date"),
        F.when(F.col("event_type") == "error", "Explosions/Remote violence")
        .when(F.col("event_type") == "purchase", "Battles")
        .when(F.col("event_type") == "view", "Violence against civilians")
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.concat(F.lit("C"), (user % 3).cast("string")).alias("country"),
        F.concat(F.lit("P"), (user % 6).cast("string")).alias("admin1"),
        F.concat(F.lit("D"), (user % 30).cast("string")).alias("admin2"),
        F.when(event % 11 != 0, F.concat(F.lit("U"), user.cast("string"))).alias("admin3"),
        F.concat(F.lit("L"), (event % 4).cast("string")).alias("location"),
        lat_of(user + event % 4).alias("latitude"),
        lon_of(user + event % 4).alias("longitude"),
        F.when(event % 7 != 0, F.floor("value").cast("bigint")).alias("fatalities"),
    )
    k = F.col("c_custkey")
    scaffold = table(spark, sf_dir, "customer").select(
        k.alias("area_id"),
        lat_of(k).alias("lat"),
        lon_of(k).alias("lon"),
        F.lit(2024).alias("year"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("month"),
    )
    out = C.conflict_features(scaffold, events, order=["area_id"])
    return out.withColumn("distance_to_nearest_acled", F.round("distance_to_nearest_acled", 6))


# ---- price points to the nearest market ------------------------------------------------------------------


@query(
    "j10_price_chain",
    f"""
WITH {POINTS_SQL}, {PRICES_SQL},
points AS (
  SELECT lat, long AS lon, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, avg(change + 100) AS price
  FROM extracts GROUP BY ALL HAVING avg(change) IS NOT NULL),
scaffold AS (SELECT lat, lon, year, month, min(point_id) AS point_id FROM right_points GROUP BY ALL),
pairs AS (SELECT s.*, p.price, p.lat AS plat, p.lon AS plon, {haversine_sql('s.lat', 's.lon', 'p.lat', 'p.lon')} AS km FROM scaffold s JOIN points p USING (year, month)),
best AS (SELECT *, row_number() OVER (PARTITION BY point_id, year, month ORDER BY km, plat, plon) AS rn FROM pairs)
SELECT s.point_id, s.lat, s.lon, s.year, s.month, round(b.price, 6) AS "FAO_price", round(b.km, 6) AS market_distance
FROM scaffold s LEFT JOIN best b ON b.point_id = s.point_id AND b.year = s.year AND b.month = s.month AND b.rn = 1 AND b.km <= {MATCH_RADIUS_KM}
WHERE (s.year, s.month) IN (SELECT (year, month) FROM points)""",
)
def j10_price_chain(spark, sf_dir):
    """Price extracts to the nearest price point per place and month."""
    scaffold = right_points(spark, sf_dir).select("point_id", "lat", "lon", "year", "month")
    points = R.price_points(_extracts(spark, sf_dir))
    out = R.price_features(scaffold, points, (1995, 1), (2001, 12), order=["point_id"])
    return out.withColumns({c: F.round(c, 6) for c in ("FAO_price", "market_distance")})


# ---- country-year indicators -------------------------------------------------------------------------------

_YEARS = range(1995, 2002)
_COUNTRY_SQL = f"""{MONTHLY_SQL},
country_year AS (
  SELECT 'N' || c_nationkey AS code, c_nationkey AS k, year, CAST(sum(price_sum) AS BIGINT) AS s, CAST(sum(order_cnt) AS BIGINT) AS n
  FROM monthly JOIN customer ON c_custkey = area_id GROUP BY ALL),
ends AS (SELECT code, max(s % 100) FILTER (year = 1996) AS a, max(s % 100) FILTER (year = 2000) AS b FROM country_year GROUP BY ALL),
gini AS (SELECT code, CAST(y AS INTEGER) AS year, a + (b - a) * (y - 1996) / 4.0::DOUBLE AS gini FROM ends CROSS JOIN range(1996, 2001) AS t(y)),
places AS (SELECT {lat_sql('c_custkey')} AS lat, {lon_sql('c_custkey')} AS lon, min('N' || c_nationkey) AS code FROM customer GROUP BY ALL),
scaffold AS (
  SELECT {lat_sql('area_id')} AS lat, {lon_sql('area_id')} AS lon, year, month, min(area_id) AS area_id FROM monthly GROUP BY ALL)"""


@query(
    "j4_indicator_chain",
    f"""
WITH {_COUNTRY_SQL}
SELECT s.area_id, s.year, s.month, printf('%.12f', s.lat) AS lat, printf('%.12f', s.lon) AS lon, p.code AS "ISO3",
       CAST(CASE WHEN y.k % 7 <> 0 THEN y.s END AS DOUBLE) AS "CPI", CAST(y.n AS DOUBLE) AS "GDP", CAST(CASE WHEN y.k % 5 <> 0 THEN y.n END AS DOUBLE) AS "CC",
       round(g.gini, 6) AS gini
FROM scaffold s LEFT JOIN places p ON p.lat = s.lat AND p.lon = s.lon
LEFT JOIN country_year y ON y.code = p.code AND y.year = s.year LEFT JOIN gini g ON g.code = p.code AND g.year = s.year""",
)
def j4_indicator_chain(spark, sf_dir):
    """Wide indicator tables to yearly values per place."""
    k = F.col("c_custkey")
    customer = table(spark, sf_dir, "customer")
    code = F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    rows = monthly_orders(spark, sf_dir)
    coded = rows.join(customer.select(k.alias("area_id"), code.alias("Country Code"), F.col("c_nationkey").alias("k")), "area_id")

    def wide(value, suffix="", keep=None):
        texts = ("Country Name", "Series Name", "Series Code") if suffix else ("Country Name", "Indicator Name", "Indicator Code")
        cells = [F.sum(F.when(F.col("year") == y, F.col(value))).alias(f"{y}" + (f" [YR{y}]" if suffix else "")) for y in _YEARS]
        kept = coded if keep is None else coded.where(F.col("k") % keep != 0)
        return kept.groupBy("Country Code").agg(*cells).withColumns({t: F.lit("x") for t in texts})

    ends = coded.where(F.col("year").isin(1996, 2000)).groupBy(F.col("Country Code").alias("country_code"), F.col("year").alias("reporting_year"))
    gini = ends.agg((F.sum("price_sum") % 100).alias("gini"))
    scaffold = rows.select("area_id", lat_of(F.col("area_id")).alias("lat"), lon_of(F.col("area_id")).alias("lon"), "year", "month")
    countries = customer.select(F.lit("x").alias("country"), code.alias("ISO3"), lat_of(k).alias("lat"), lon_of(k).alias("lon"))
    out = I.indicator_features(
        scaffold, countries, wide("price_sum", keep=7), wide("order_cnt"), wide("order_cnt", " [YR]", 5), gini, order=["area_id"]
    )
    return out.select("area_id", "year", "month", "lat", "lon", "ISO3", "CPI", "GDP", "CC", F.round("gini", 6).alias("gini"))


# ---- market trends by title and country -----------------------------------------------------------------------


@query(
    "j5_trend_chain",
    """
WITH trends AS (
  SELECT s_nationkey AS k, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         avg(CAST(l_quantity AS BIGINT)) AS price, stddev_samp(CAST(l_quantity AS BIGINT)) AS price_std
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL),
rows AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders)
SELECT o_custkey AS area_id, r.year, r.month, n_name AS title, 'N' || n_nationkey AS "ISO3", round(price, 4) AS "WFP_Price", round(price_std, 4) AS "WFP_Price_std"
FROM rows r JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey LEFT JOIN trends t ON t.k = n_nationkey AND t.year = r.year AND t.month = r.month""",
)
def j5_trend_chain(spark, sf_dir):
    """Mean trend per country and month, found through place titles."""
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), "n_name")
    prices = (
        table(spark, sf_dir, "lineitem")
        .join(supplier, "l_suppkey")
        .select(F.col("n_name").alias("Country"), F.col("l_shipdate").alias("Price Date"), F.col("l_quantity").cast("bigint").alias("Trend"))
    )
    code = F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))
    names = nation.select(F.upper("n_name").alias("name"), code.alias("country_code_3"))
    # Two places per title, as in the source lookups; only the first by order may count.
    key = F.col("n_nationkey").cast("double")
    places = nation.select(
        F.col("n_name").alias("title"),
        code.alias("ISO3"),
        F.col("n_name").alias("country"),
        F.explode(F.array(key, key + 100)).alias("lat"),
        key.alias("lon"),
    )
    home = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    titles = home.select(F.col("c_custkey").alias("area_id"), F.col("n_name").alias("title"))
    scaffold = (
        monthly_orders(spark, sf_dir)
        .join(titles, "area_id")
        .select("area_id", "title", F.col("area_id").cast("double").alias("lat"), F.lit(0.0).alias("lon"), "year", "month")
    )
    out = R.trend_features(scaffold, places, R.market_trends(prices), names, ["area_id"])
    return out.select(
        "area_id", "year", "month", "title", "ISO3", F.round("WFP_Price", 4).alias("WFP_Price"), F.round("WFP_Price_std", 4).alias("WFP_Price_std")
    )


# ---- historical panel: gaps, history, outcome --------------------------------------------------------------------

_A = "OVER (PARTITION BY area_id ORDER BY year, month"


@query(
    "w3_history_chain",
    f"""
WITH {PANEL_SQL},
filled AS (
  SELECT area_id, year, month, order_cnt, last_value(price_sum IGNORE NULLS) {_A} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price_sum FROM panel),
zeroed AS (SELECT area_id, year, month, order_cnt, coalesce(price_sum, 0) AS price_sum FROM filled),
outcome AS (SELECT o_custkey AS area_id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, min(o_orderstatus) AS outcome FROM orders GROUP BY ALL)
SELECT z.area_id, z.year, z.month, z.price_sum, z.order_cnt, lag(price_sum, 12) {_A}) AS price_sum_l12,
       round(avg(price_sum) {_A} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 4) AS price_sum_m12,
       round(avg(price_sum) {_A} ROWS BETWEEN 23 PRECEDING AND 12 PRECEDING), 4) AS price_sum_v12, o.outcome
FROM zeroed z LEFT JOIN outcome o USING (area_id, year, month)""",
)
def w3_history_chain(spark, sf_dir):
    """Fill the panel, add its history, attach the outcome."""
    rows = panel(spark, sf_dir).select("area_id", "year", "month", "price_sum", "order_cnt")
    filled = H.zero_fill(H.fill_gaps(rows, forward=["price_sum"]), ["price_sum"])
    outcome = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("area_id"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), F.col("o_orderstatus").alias("outcome")
    )
    first = by_area(keep_one(outcome, ["area_id", "year", "month"], ["outcome"]), sf_dir)
    out = H.history_panel(filled, first, ["price_sum"], ["price_sum"])
    return out.withColumns({c: F.round(c, 4) for c in ("price_sum_m12", "price_sum_v12")})


# ---- monthly inference input -----------------------------------------------------------------------------------------


@query(
    "q12_inference_input",
    """
SELECT CAST(c_custkey AS VARCHAR) AS area_id, CAST(c_custkey AS VARCHAR) AS admin_code, 1998 AS year, 6 AS month,
       CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment, row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) - 1 AS _row_id
FROM customer""",
)
def q12_inference_input(spark, sf_dir):
    """Checked monthly input with row ids."""
    k = F.col("c_custkey")
    raw = table(spark, sf_dir, "customer").select(
        F.concat(F.lit(" "), k.cast("string")).alias("area_id"),
        F.concat(k.cast("string"), F.lit(" ")).alias("admin_code"),
        F.lit("1998").alias("year"),
        F.lit("6.0").alias("month"),
        F.when(k % 4 != 0, F.col("c_mktsegment")).otherwise("#N/A").alias("segment"),
    )
    return prepare_inference_input(raw, "1998-06")
