"""Conflict events to area-month features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import EVENT_KINDS, EVENT_RECODES, MATCH_RADIUS_KM
from ..operators.aggregates import grouped, sum_or_zero
from ..operators.dedup import keep_one
from ..operators.joins import parent_totals
from ..operators.nearest import nearest_join

LOCATION = ["country", "admin1", "admin2", "admin3", "location", "latitude", "longitude"]
PERIOD = ["year", "month"]
MEASURES = [f"{m}_{k}" for m in ("event_count", "sum_fatalities") for k in EVENT_KINDS]


def dated_events(events: DataFrame, date: str = "event_date") -> DataFrame:
    """Event columns with year and month taken from the date."""
    day = F.to_date(F.col(date))
    kept = [F.col(c) for c in ("event_type", *LOCATION, "fatalities")]
    return events.select(*kept, F.year(day).alias("year"), F.month(day).alias("month"))


def only_kinds(events: DataFrame, kinds: Sequence[str] = tuple(EVENT_RECODES)) -> DataFrame:
    return events.where(F.col("event_type").isin(*kinds))


def event_totals(events: DataFrame, null_keys: str = "drop") -> DataFrame:
    """Events and fatalities per type, place and month; rows with a null key are left out."""
    return grouped(
        events,
        ["event_type", *LOCATION, *PERIOD],
        null_keys,
        event_count=F.count("event_type"),
        sum_fatalities=sum_or_zero("fatalities"),
    )


def recode_kinds(df: DataFrame, column: str = "event_type") -> DataFrame:
    return df.replace(EVENT_RECODES, subset=[column])


def pivot_kinds(totals: DataFrame) -> DataFrame:
    """One row per place and month with a column per measure and kind, absent kinds 0."""

    def cell(measure: str, kind: str) -> Column:
        return sum_or_zero(F.when(F.col("event_type") == kind, F.col(measure))).alias(f"{measure}_{kind}")

    cells = [cell(m, k) for m in ("event_count", "sum_fatalities") for k in EVENT_KINDS]
    wide = recode_kinds(totals).groupBy(*LOCATION, *PERIOD).agg(*cells)
    return wide.withColumnsRenamed({"latitude": "lat", "longitude": "lon"})


def event_pivot(events: DataFrame) -> DataFrame:
    """:func:`pivot_kinds` straight from events: the same table after one shuffle instead of two."""
    keys = [*LOCATION, *PERIOD]
    rows = recode_kinds(events.dropna(subset=["event_type", *keys]))
    of = {k: F.col("event_type") == k for k in EVENT_KINDS}
    cells = [F.count_if(of[k]).alias(f"event_count_{k}") for k in EVENT_KINDS]
    cells += [sum_or_zero(F.when(of[k], F.col("fatalities"))).alias(f"sum_fatalities_{k}") for k in EVENT_KINDS]
    return rows.groupBy(*keys).agg(*cells).withColumnsRenamed({"latitude": "lat", "longitude": "lon"})


def level_totals(df: DataFrame, keys: Sequence[str], suffix: str = "", measures: Sequence[str] = MEASURES) -> DataFrame:
    """Sums per administrative unit and month, measure names ending in ``suffix``."""
    return grouped(df, [*keys, *PERIOD], **{m + suffix: sum_or_zero(m) for m in measures})


def exact_mean(column: str) -> Column:
    """Mean through an exact decimal sum, so that it cannot depend on the order of tasks.

    Mean positions feed the nearest match, where the last bit of a sum could decide a tie.
    """
    return F.sum(F.col(column).cast("decimal(18,12)")).cast("double") / F.count(column)


def admin_units(pivoted: DataFrame) -> DataFrame:
    """Smallest units with their mean position, and the totals of the two levels above beside them.

    Each level is summed from the level below, so the wide levels read small tables; joining
    the totals back keeps a hot province from becoming one window partition.
    """
    measures = {m: sum_or_zero(m) for m in MEASURES}
    unit = grouped(
        pivoted, ["country", "admin1", "admin2", "admin3", *PERIOD], **measures, lat=exact_mean("lat"), lon=exact_mean("lon")
    )
    district = level_totals(unit, ["country", "admin1", "admin2"], "_w5")
    province_in = district.withColumnsRenamed({m + "_w5": m for m in MEASURES})
    province = level_totals(province_in, ["country", "admin1"], "_w10")
    return parent_totals(
        unit, [(district, ["country", "admin1", "admin2", *PERIOD]), (province, ["country", "admin1", *PERIOD])]
    )


def conflict_features(
    scaffold: DataFrame,
    events: DataFrame,
    max_km: float = MATCH_RADIUS_KM,
    distance: str = "distance_to_nearest_acled",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Scaffold rows with the measures of the nearest unit of the same month and its distance."""
    keys = ["lat", "lon", *PERIOD]
    rows = keep_one(scaffold, keys, order or [c for c in scaffold.columns if c not in keys] or keys)
    units = admin_units(event_pivot(dated_events(events)))
    unit = F.struct("country", "admin1", "admin2", "admin3").alias("unit_id")
    measures = [c for c in units.columns if c.startswith(("event_count", "sum_fatalities"))]
    return nearest_join(
        rows, units.select(unit, *PERIOD, "lat", "lon", *measures), "unit_id", PERIOD, max_km, measures, distance
    )
