import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from areapanel.plans import conflict as C
from areapanel.plans import indicators as I
from areapanel.plans import prices as R
from conftest import rows


def test_conflict_chain(spark):
    day = dt.date(2026, 4, 2)
    schema = "event_date date, event_type string, country string, admin1 string, admin2 string, admin3 string, location string, latitude double, longitude double, fatalities int"
    events = spark.createDataFrame(
        [
            (day, "Battles", "X", "P", "D", "U", "l1", 1.0, 1.0, 2),
            (day, "Battles", "X", "P", "D", "U", "l1", 1.0, 1.0, None),
            (day, "Explosions/Remote violence", "X", "P", "D", "U", "l2", 3.0, 1.0, 5),
            (day, "Violence against civilians", "X", "P", "D", "V", "l3", 20.0, 20.0, None),
            (day, "Protests", "X", "P", "E", "W", "l4", 40.0, 40.0, 9),
            (day, "Battles", "X", "P", None, "Z", "l5", 1.0, 1.0, 100),
        ],
        schema,
    )
    totals = C.event_totals(C.dated_events(events))
    assert totals.where("event_type = 'Battles'").select("event_count", "sum_fatalities").collect() == [(2, 2)]
    assert C.event_totals(C.dated_events(events), null_keys="keep").count() == totals.count() + 1
    assert rows(C.pivot_kinds(totals).select(*sorted(C.MEASURES))) == rows(C.event_pivot(C.dated_events(events)).select(*sorted(C.MEASURES)))
    units = {r["admin3"]: r for r in C.admin_units(C.event_pivot(C.dated_events(events))).collect()}
    assert set(units) == {"U", "V", "W"}
    assert (units["U"]["event_count_battles"], units["U"]["sum_fatalities_explosions"], units["U"]["lat"]) == (2, 5, 2.0)
    assert (units["U"]["event_count_violence_w5"], units["W"]["event_count_violence_w5"], units["W"]["event_count_violence_w10"]) == (1, 0, 1)
    assert C.only_kinds(events).count() == 5
    scaffold = spark.createDataFrame([("a", 2.0, 1.0, 2026, 4), ("b", 60.0, 60.0, 2026, 4), ("c", 2.0, 1.0, 2026, 5)], "area_id string, lat double, lon double, year int, month int")
    out = {r["area_id"]: r for r in C.conflict_features(scaffold, events).collect()}
    assert (out["a"]["event_count_battles"], out["a"]["event_count_battles_w10"], out["a"]["distance_to_nearest_acled"]) == (2, 2, 0.0)
    assert out["b"]["event_count_battles"] is None and out["b"]["distance_to_nearest_acled"] is None
    assert out["c"]["event_count_battles"] is None


def test_price_chain(spark):
    extract = spark.createDataFrame(
        [(dt.date(2026, 4, 1), 1.0, 1.0, 10.0), (dt.date(2026, 4, 9), 1.0, 1.0, 30.0), (dt.date(2026, 5, 1), 1.0, 1.0, None)],
        "date date, lat double, long double, percentageChangeWRTReferencePrice double",
    )
    points = R.price_points(extract)
    assert rows(points) == [(1.0, 1.0, 2026, 4, 120.0)]
    scaffold = spark.createDataFrame(
        [("a", 1.0, 2.0, 2026, 4), ("b", 50.0, 2.0, 2026, 4), ("c", 1.0, 2.0, 2026, 5), ("d", 1.0, 2.0, 2024, 4)],
        "area_id string, lat double, lon double, year int, month int",
    )
    out = {r["area_id"]: r for r in R.price_features(scaffold, points, (2025, 1), (2026, 12)).collect()}
    assert set(out) == {"a", "b"}  # the month without points and the month outside the range drop out
    want = 2 * 6371 * math.asin(math.cos(math.radians(1)) * math.sin(math.radians(0.5)))
    assert out["a"]["FAO_price"] == 120.0 and out["a"]["market_distance"] == pytest.approx(want, abs=1e-6)
    assert out["b"]["FAO_price"] is None


def test_trend_chain(spark):
    prices = spark.createDataFrame(
        [("Chad", dt.date(2026, 4, 1), 2.0), ("Chad", dt.date(2026, 4, 2), 4.0), ("Chad", dt.date(2026, 5, 1), 7.0), ("Nowhere", dt.date(2026, 4, 1), 1.0), ("Chad", dt.date(2026, 6, 1), None)],
        "Country string, `Price Date` date, Trend double",
    )
    trends = R.market_trends(prices)
    assert rows(trends, "month", "WFP_Price") == [(4, 1.0), (4, 3.0), (5, 7.0)]
    by = {(r["country_name"], r["month"]): r["WFP_Price_std"] for r in trends.collect()}
    assert by[("Chad", 4)] == pytest.approx(math.sqrt(2)) and by[("Chad", 5)] is None
    names = spark.createDataFrame([("chad", "TCD")], "name string, country_code_3 string")
    places = spark.createDataFrame([("t1", "TCD", "Chad", 1.0, 1.0), ("t1", "TCD", "Chad", 2.0, 2.0)], "title string, ISO3 string, country string, lat double, lon double")
    scaffold = spark.createDataFrame([("t1", 1.0, 1.0, 2026, 4), ("t2", 3.0, 3.0, 2026, 4)], "title string, lat double, lon double, year int, month int")
    out = R.trend_features(scaffold, places, trends, names, ["title"])
    assert rows(out, "title", "ISO3", "WFP_Price") == [("t1", "TCD", 3.0), ("t2", None, None)]


def test_indicator_chain(spark):
    wide = spark.createDataFrame([("Chad", "TCD", "i", "c", "1.5", None), ("Mali", "MLI", "i", "c", None, "2")], "`Country Name` string, `Country Code` string, `Indicator Name` string, `Indicator Code` string, `2025` string, `2026` string")
    series = spark.createDataFrame([("Chad", "TCD", "s", "c", 3.0)], "`Country Name` string, `Country Code` string, `Series Name` string, `Series Code` string, `2026 [YR2026]` double")
    assert rows(I.indicator(wide, "CPI")) == [("MLI", 2026, 2.0), ("TCD", 2025, 1.5)]
    assert rows(I.indicator(series, "CC")) == [("TCD", 2026, 3.0)]
    gini = spark.createDataFrame([("TCD", 2024, 30.0), ("TCD", 2026, 40.0)], "country_code string, reporting_year int, gini double")
    countries = spark.createDataFrame([("Chad", "TCD", 1.0, 1.0)], "country string, ISO3 string, lat double, lon double")
    scaffold = spark.createDataFrame([(1.0, 1.0, 2025, 4), (1.0, 1.0, 2026, 4), (9.0, 9.0, 2026, 4)], "lat double, lon double, year int, month int")
    out = I.indicator_features(scaffold, countries, wide, wide, series, gini)
    assert rows(out, "year", "ISO3", "CPI", "GDP", "CC", "gini") == [
        (2025, "TCD", 1.5, 1.5, None, 35.0),
        (2026, None, None, None, None, None),
        (2026, "TCD", None, None, 3.0, 40.0),
    ]
    assert out.select("lat").first()[0].endswith("000000000000")
