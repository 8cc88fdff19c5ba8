"""Keys, null tokens, coercion, calendar and other scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions.coerce import coerce, unreadable
from ..functions.fixed import EVENT_RECODES
from ..functions.geo import haversine_km
from ..functions.nulls import is_blank, normalize_null_tokens
from ..plans.conflict import only_kinds, recode_kinds
from ..plans.history import cap_at, flags_to_int, floor_at, zero_fill
from . import Registry
from .views import CONFLICT_SQL, PANEL_SQL, conflict, haversine_sql, lat_of, lat_sql, lon_of, lon_sql, panel, table

query = Registry()

_RAW_ID = (
    "CASE c_custkey % 6 WHEN 0 THEN concat('00', c_custkey) WHEN 1 THEN concat(c_custkey, '.0') "
    "WHEN 2 THEN concat(' ', c_custkey, ' ') WHEN 3 THEN concat('A-', c_custkey) "
    "WHEN 4 THEN concat(c_custkey, '.5') ELSE '' END"
)


@query(
    "p2_calendar",
    """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS month_index,
       strftime(o_orderdate, '%Y-%m') AS ym_text, strftime(o_orderdate, '%Y%m') AS yyyymm,
       strftime(date_trunc('month', o_orderdate) + INTERVAL 6 MONTH, '%Y-%m') AS target_period
FROM orders""",
)
def p2_calendar(spark, sf_dir):
    """Date parts, period texts and calendar-month arithmetic."""
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    dated = table(spark, sf_dir, "orders").select("o_orderkey", y.alias("year"), m.alias("month"))
    y, m = F.col("year"), F.col("month")
    text = K.year_month_text(y, m)
    return dated.select(
        "o_orderkey",
        "year",
        "month",
        K.month_index(y, m).alias("month_index"),
        text.alias("ym_text"),
        K.yyyymm(y, m).alias("yyyymm"),
        K.target_period(text, 6).alias("target_period"),
    )


@query(
    "p4_id_keys",
    f"""
WITH raw AS (SELECT c_custkey, {_RAW_ID} AS raw_id FROM customer)
SELECT c_custkey,
       CASE WHEN trim(raw_id) = '' THEN ''
            WHEN try_cast(trim(raw_id) AS DOUBLE) = floor(try_cast(trim(raw_id) AS DOUBLE))
            THEN CAST(CAST(try_cast(trim(raw_id) AS DOUBLE) AS BIGINT) AS VARCHAR) ELSE trim(raw_id) END AS area_id,
       trim(raw_id) AS trimmed,
       CAST(trunc(try_cast(trim(raw_id) AS DOUBLE)) AS INTEGER) AS as_int
FROM raw""",
)
def p4_id_keys(spark, sf_dir):
    """Integer parsing, normal form of ids, trimmed ids."""
    raw = table(spark, sf_dir, "customer").select("c_custkey", F.expr(_RAW_ID).alias("raw_id"))
    c = F.col("raw_id")
    return raw.select(
        "c_custkey", K.normalize_area_id(c).alias("area_id"), K.trim_key(c).alias("trimmed"), K.parse_int(c).alias("as_int")
    )


_RAW_TOKEN = (
    "CASE c_custkey % 9 WHEN 0 THEN 'NA' WHEN 1 THEN ' N/A ' WHEN 2 THEN 'NULL' WHEN 3 THEN '' WHEN 4 THEN '#N/A' "
    "WHEN 5 THEN 'None' WHEN 6 THEN '   ' ELSE c_mktsegment END"
)


@query(
    "p6_null_tokens",
    f"""
WITH raw AS (SELECT c_custkey, c_name, {_RAW_TOKEN} AS segment FROM customer)
SELECT c_custkey, c_name,
       CASE WHEN trim(segment) NOT IN ('','NA','N/A','NULL','null','NaN','nan','None','#N/A') THEN segment END AS segment,
       trim(segment) = '' AS blank_builder, segment = '' AS blank_validator,
       trim(segment) IN ('','NA','N/A','NaN','nan','None','null') AS blank_static
FROM raw""",
)
def p6_null_tokens(spark, sf_dir):
    """Null tokens removed over all text columns, and the other three vocabularies."""
    raw = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.expr(_RAW_TOKEN).alias("segment"))
    flagged = raw.select(
        "*", *[is_blank(F.col("segment"), v).alias(f"blank_{v}") for v in ("builder", "validator", "static")]
    )
    return normalize_null_tokens(flagged)


@query(
    "p7_coordinate_keys",
    f"""
SELECT c_custkey, printf('%.12f', {lat_sql('c_custkey')} / 7.0) AS lat_text, printf('%.12f', {lon_sql('c_custkey')} / 7.0) AS lon_text,
       round({lat_sql('c_custkey')} / 7.0, 10) AS lat_10, round({lon_sql('c_custkey')} / 7.0, 10) AS lon_10
FROM customer""",
)
def p7_coordinate_keys(spark, sf_dir):
    """Twelve-decimal text keys and ten-decimal rounded keys."""
    k = F.col("c_custkey")
    lat, lon = lat_of(k) / 7.0, lon_of(k) / 7.0
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        K.coordinate_text(lat).alias("lat_text"),
        K.coordinate_text(lon).alias("lon_text"),
        K.coordinate_rounded(lat).alias("lat_10"),
        K.coordinate_rounded(lon).alias("lon_10"),
    )


@query(
    "p12_recode_filter",
    f"""
WITH {CONFLICT_SQL}
SELECT CASE event_type WHEN 'Explosions/Remote violence' THEN 'explosions' WHEN 'Battles' THEN 'battles' ELSE 'violence' END AS event_type,
       country, count(*) AS n_events
FROM conflict WHERE event_type IN ({', '.join(f"'{k}'" for k in EVENT_RECODES)}) GROUP BY ALL""",
)
def p12_recode_filter(spark, sf_dir):
    """Keep three event types, recode them."""
    kept = recode_kinds(only_kinds(conflict(spark, sf_dir)))
    return kept.groupBy("event_type", "country").agg(F.count(F.lit(1)).alias("n_events"))


@query(
    "p14_shift_clip",
    """
SELECT p_partkey, p_retailprice + 100 AS price_index,
       CASE WHEN p_retailprice - 1000 < 0 THEN 0.0 ELSE p_retailprice - 1000 END AS floored,
       CASE WHEN p_retailprice > 1000 THEN 1000.0 ELSE p_retailprice END AS capped
FROM part""",
)
def p14_shift_clip(spark, sf_dir):
    """Affine shift, floor at 0, cap at 1000."""
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        (F.col("p_retailprice") + 100).alias("price_index"),
        (F.col("p_retailprice") - 1000).alias("floored"),
        F.col("p_retailprice").alias("capped"),
    )
    return cap_at(floor_at(part, ["floored"]), ["capped"])


@query(
    "p16_flags_fill",
    f"""
WITH {PANEL_SQL}
SELECT area_id, year, month, CASE WHEN area_id % 4 <> 0 AND area_id % 3 = 0 THEN 1 ELSE 0 END AS "AEZ_4000",
       coalesce(price_sum, 0) AS price_sum, price_sum AS distance
FROM panel""",
)
def p16_flags_fill(spark, sf_dir):
    """Boolean indicators to 0/1, zero fill that leaves a distance alone."""
    rows = panel(spark, sf_dir).select(
        "area_id",
        "year",
        "month",
        F.when(F.col("area_id") % 4 != 0, F.col("area_id") % 3 == 0).alias("AEZ_4000"),
        "price_sum",
        F.col("price_sum").alias("distance"),
    )
    return zero_fill(flags_to_int(rows), ["price_sum", "distance"], distance="distance")


@query(
    "p18_year_from_text",
    """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year_bracket, CAST(year(o_orderdate) AS INTEGER) AS year_dotted,
       CAST(month(o_orderdate) AS INTEGER) AS month_dotted
FROM orders""",
)
def p18_year_from_text(spark, sf_dir):
    """First token of ``2019 [YR2019]``, digits of ``2020.M03``."""
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy '[YR'yyyy']'").alias("bracket"),
        F.date_format("o_orderdate", "yyyy'.M'MM").alias("dotted"),
    )
    return text.select(
        "o_orderkey",
        K.first_token(F.col("bracket")).cast("int").alias("year_bracket"),
        K.digits(F.col("dotted")).cast("int").alias("year_dotted"),
        K.digits(F.split("dotted", r"\.")[1]).cast("int").alias("month_dotted"),
    )


_RAW_VALUE = (
    "CASE c_custkey % 8 WHEN 0 THEN 'yes' WHEN 1 THEN '0' WHEN 2 THEN '1' WHEN 3 THEN '2.5' WHEN 4 THEN 'F' "
    "WHEN 5 THEN concat(c_custkey, '.0') WHEN 6 THEN 'abc' END"
)


@query(
    "p20_coercion",
    f"""
WITH raw AS (SELECT c_custkey, {_RAW_VALUE} AS v FROM customer)
SELECT c_custkey, try_cast(v AS DOUBLE) AS as_float,
       CASE WHEN try_cast(v AS DOUBLE) = floor(try_cast(v AS DOUBLE)) THEN CAST(try_cast(v AS DOUBLE) AS BIGINT) END AS as_int,
       CASE WHEN lower(v) IN ('true','t','yes','y','1') THEN true WHEN lower(v) IN ('false','f','no','n','0') THEN false END AS as_bool,
       v IS NOT NULL AND try_cast(v AS DOUBLE) IS NULL AS bad_float,
       v IS NOT NULL AND coalesce(try_cast(v AS DOUBLE) <> floor(try_cast(v AS DOUBLE)), true) AS bad_int,
       v IS NOT NULL AND lower(v) NOT IN ('true','t','yes','y','1','false','f','no','n','0') AS bad_bool
FROM raw""",
)
def p20_coercion(spark, sf_dir):
    """P20: typed values and the flags of what has no reading."""
    raw = table(spark, sf_dir, "customer").select("c_custkey", F.expr(_RAW_VALUE).alias("v"))
    v = F.col("v")
    kinds = ("float", "int", "bool")
    return raw.select(
        "c_custkey", *[coerce(v, k).alias(f"as_{k}") for k in kinds], *[unreadable(v, k).alias(f"bad_{k}") for k in kinds]
    )


@query(
    "p25_haversine",
    f"""
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
       round({haversine_sql(lat_sql('o_custkey'), lon_sql('o_custkey'), lat_sql('l_suppkey'), lon_sql('l_suppkey'))}, 4) AS km
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def p25_haversine(spark, sf_dir):
    """P25: great-circle distance from each line's customer to its supplier."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c, s = F.col("o_custkey"), F.col("l_suppkey")
    km = F.round(haversine_km(lat_of(c), lon_of(c), lat_of(s), lon_of(s)), 4)
    return lines.join(orders, "l_orderkey").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", km.alias("km"))
