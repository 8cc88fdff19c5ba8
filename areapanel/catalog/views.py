"""Views that shape the given tables like the panel, events, points and pixels the operators take.

Each view exists twice: as a DataFrame and as the text of the same SQL common table expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import month_index
from ..plans.scaffold import month_spine
from ..session import dealt

FIRST_MONTH, LAST_MONTH = (1995, 1), (2001, 8)
_SPAN = tuple(y * 12 + m - 1 for y, m in (FIRST_MONTH, LAST_MONTH))
N_MONTHS = _SPAN[1] - _SPAN[0] + 1
TARGET_YEAR, TARGET_MONTH = 1998, 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lat_of(key: Column) -> Column:
    return (key * 37 % 1200).cast("double") / 10.0 - 60.0


def lon_of(key: Column) -> Column:
    return (key * 91 % 3600).cast("double") / 10.0 - 180.0


def lat_sql(key: str) -> str:
    return f"(CAST({key} * 37 % 1200 AS DOUBLE) / 10.0 - 60.0)"


def lon_sql(key: str) -> str:
    return f"(CAST({key} * 91 % 3600 AS DOUBLE) / 10.0 - 180.0)"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    term = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    return f"(12742.0 * asin(sqrt(least({term}, 1.0))))"


# ---- area-month panel: customers by month, measures from their orders --------------------------


def monthly_orders(spark: SparkSession, sf_dir: str, only: tuple[int, int] | None = None) -> DataFrame:
    """Orders reduced to one row per customer and month before anything joins them.

    One month is asked for as a date range, which the scan can skip row groups by.
    """
    orders = table(spark, sf_dir, "orders")
    if only:
        first = f"{only[0]}-{only[1]:02d}-01"
        start = F.lit(first).cast("timestamp_ntz")
        stop = F.add_months(F.lit(first).cast("date"), 1).cast("timestamp_ntz")
        orders = orders.where((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < stop))
    return orders.groupBy(
        F.col("o_custkey").alias("area_id"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    ).agg(
        F.count(F.lit(1)).alias("order_cnt"),
        F.sum(F.round("o_totalprice").cast("bigint")).alias("price_sum"),
    )


def _areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("area_id"), F.col("c_nationkey").alias("country_id")
    )


def by_area(df: DataFrame, sf_dir: str) -> DataFrame:
    """Rows dealt by area into as many partitions as the spine needs, so that what is dealt so meets in place."""
    return dealt(df, N_MONTHS * table(df.sparkSession, sf_dir, "customer").count(), "area_id")


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_spine(by_area(_areas(spark, sf_dir), sf_dir), FIRST_MONTH, LAST_MONTH)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer and month; months without orders have null prices.

    An area's ordered months meet its row before it unfolds, so the spine itself is never shuffled, and the
    panel leaves dealt by area. Both sides lie alike, so they merge in place and nothing is broadcast.
    """
    at = month_index(F.col("year"), F.col("month"))
    ordered = monthly_orders(spark, sf_dir).where(at.between(*_SPAN))
    held = by_area(ordered, sf_dir).groupBy("area_id").agg(
        F.map_from_entries(F.collect_list(F.struct(at, F.struct("order_cnt", "price_sum")))).alias("_held")
    )
    areas = by_area(_areas(spark, sf_dir), sf_dir).join(held.hint("merge"), "area_id", "left")
    met = F.try_element_at("_held", at)
    return month_spine(areas, FIRST_MONTH, LAST_MONTH).select(
        "area_id",
        "country_id",
        "year",
        "month",
        F.coalesce(met["order_cnt"], F.lit(0)).alias("order_cnt"),
        met["price_sum"].alias("price_sum"),
        (met["price_sum"] / met["order_cnt"]).alias("price_avg"),
    )


MONTHLY_SQL = """
monthly AS (
  SELECT o_custkey AS area_id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         count(*) AS order_cnt, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS price_sum
  FROM orders GROUP BY ALL)"""

SPINE_SQL = """
spine AS (
  SELECT c_custkey AS area_id, c_nationkey AS country_id, CAST(mi // 12 AS INTEGER) AS year, CAST(mi % 12 + 1 AS INTEGER) AS month
  FROM customer CROSS JOIN range(23940, 24020) AS t(mi))"""

PANEL_SQL = f"""{MONTHLY_SQL}, {SPINE_SQL},
panel AS (
  SELECT s.area_id, s.country_id, s.year, s.month, coalesce(m.order_cnt, 0) AS order_cnt, m.price_sum,
         m.price_sum / m.order_cnt AS price_avg
  FROM spine s LEFT JOIN monthly m USING (area_id, year, month))"""


# ---- events as conflict events: user = smallest unit, day of month = period ---------------------


def conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    user = F.col("user_id")
    return e.select(
        F.when(F.col("event_type") == "error", "Explosions/Remote violence")
        .when(F.col("event_type") == "purchase", "Battles")
        .when(F.col("event_type") == "view", "Violence against civilians")
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.concat(F.lit("C"), (user % 3).cast("string")).alias("country"),
        F.concat(F.lit("P"), (user % 6).cast("string")).alias("admin1"),
        F.concat(F.lit("D"), (user % 30).cast("string")).alias("admin2"),
        F.when(F.col("event_id") % 11 != 0, F.concat(F.lit("U"), user.cast("string"))).alias("admin3"),
        F.concat(F.lit("L"), (F.col("event_id") % 4).cast("string")).alias("location"),
        lat_of(user + F.col("event_id") % 4).alias("latitude"),
        lon_of(user + F.col("event_id") % 4).alias("longitude"),
        F.when(F.col("event_id") % 7 != 0, F.floor("value").cast("bigint")).alias("fatalities"),
        F.year("ts").alias("year"),
        F.dayofmonth("ts").alias("month"),
    )


CONFLICT_SQL = f"""
conflict AS (
  SELECT CASE event_type WHEN 'error' THEN 'Explosions/Remote violence' WHEN 'purchase' THEN 'Battles'
           WHEN 'view' THEN 'Violence against civilians' ELSE event_type END AS event_type,
         'C' || (user_id % 3) AS country, 'P' || (user_id % 6) AS admin1, 'D' || (user_id % 30) AS admin2,
         CASE WHEN event_id % 11 <> 0 THEN 'U' || user_id END AS admin3, 'L' || (event_id % 4) AS location,
         {lat_sql('(user_id + event_id % 4)')} AS latitude, {lon_sql('(user_id + event_id % 4)')} AS longitude,
         CASE WHEN event_id % 7 <> 0 THEN CAST(floor(value) AS BIGINT) END AS fatalities,
         CAST(year(ts) AS INTEGER) AS year, CAST(day(ts) AS INTEGER) AS month
  FROM events)"""


# ---- points: customers' order months on the left, suppliers' shipping months on the right --------


def left_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_orders(spark, sf_dir).select(
        "area_id", lat_of(F.col("area_id")).alias("lat"), lon_of(F.col("area_id")).alias("lon"), "year", "month"
    )


def right_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_suppkey").alias("point_id"), F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")
        )
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
        .select("point_id", lat_of(F.col("point_id") * 7).alias("lat"), lon_of(F.col("point_id") * 7).alias("lon"), "year", "month", "quantity")
    )


POINTS_SQL = f"""{MONTHLY_SQL},
left_points AS (
  SELECT area_id, {lat_sql('area_id')} AS lat, {lon_sql('area_id')} AS lon, year, month FROM monthly),
right_points AS (
  SELECT point_id, {lat_sql('(point_id * 7)')} AS lat, {lon_sql('(point_id * 7)')} AS lon, year, month, quantity FROM (
    SELECT l_suppkey AS point_id, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY ALL))"""


# Pixel centres are offset so that none lies on a sloping border.
# ---- pixels: one per line item; zones: a triangle and a holed square per nation ------------------


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.concat(F.lit("B"), (F.col("l_linenumber") % 3 + 1).cast("string")).alias("band"),
        ((F.col("l_partkey") * 13 % 1000).cast("double") / 10.0 + 0.05).alias("lon"),
        ((F.col("l_orderkey") * 17 % 500).cast("double") / 10.0 + 0.03).alias("lat"),
        F.col("l_quantity").cast("bigint").alias("value"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation k has a 16 by 8 degree box; even ones are triangles, odd ones squares with a hole."""
    k = F.col("n_nationkey")
    x, y = (k % 5 * 20).cast("double"), (F.floor(k / 5) * 10).cast("double")

    def ring(*points: tuple[float, float]) -> Column:
        return F.array(*[F.struct((x + dx).alias("lon"), (y + dy).alias("lat")) for dx, dy in points])

    triangle = F.array(ring((0.0, 0.0), (16.0, 0.0), (8.0, 8.0), (0.0, 0.0)))
    holed = F.array(
        ring((0.0, 0.0), (16.0, 0.0), (16.0, 8.0), (0.0, 8.0), (0.0, 0.0)),
        ring((4.0, 2.0), (12.0, 2.0), (12.0, 6.0), (4.0, 6.0), (4.0, 2.0)),
    )
    return table(spark, sf_dir, "nation").select(
        k.cast("string").alias("area_id"), F.when(k % 2 == 0, triangle).otherwise(holed).alias("rings")
    )


# Half-plane tests written out: the triangle's slopes are +1 and -1.
PIXELS_SQL = """
pixels AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, 'B' || (l_linenumber % 3 + 1) AS band,
         CAST(l_partkey * 13 % 1000 AS DOUBLE) / 10.0 + 0.05 AS lon, CAST(l_orderkey * 17 % 500 AS DOUBLE) / 10.0 + 0.03 AS lat,
         CAST(l_quantity AS BIGINT) AS value
  FROM lineitem),
boxes AS (
  SELECT n_nationkey AS k, CAST(n_nationkey % 5 * 20 AS DOUBLE) AS x, CAST(n_nationkey // 5 * 10 AS DOUBLE) AS y FROM nation),
inside AS (
  SELECT CAST(k AS VARCHAR) AS area_id, p.* FROM pixels p JOIN boxes b
    ON p.lon > b.x AND p.lon < b.x + 16 AND p.lat > b.y AND p.lat < b.y + 8
   AND CASE WHEN k % 2 = 0 THEN p.lat - b.y < p.lon - b.x AND p.lat - b.y < 16 - (p.lon - b.x)
            ELSE NOT (p.lon - b.x > 4 AND p.lon - b.x < 12 AND p.lat - b.y > 2 AND p.lat - b.y < 6) END)"""
