"""Food price points and market trends to area-month features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import MATCH_RADIUS_KM
from ..functions.keys import coordinate_text, month_index
from ..operators.aggregates import mean_by, mean_std_by
from ..operators.dedup import keep_one
from ..operators.joins import left_join, lookup_country_code
from ..operators.nearest import nearest_join

POINT_MONTH = ["lat", "lon", "year", "month"]


def price_points(extracts: DataFrame, value: str = "FAO_price", change: str = "percentageChangeWRTReferencePrice") -> DataFrame:
    """Mean price index (per cent change + 100) per position and month."""
    day = F.to_date(F.col("date"))
    rows = extracts.select(
        "lat", F.col("long").alias("lon"), F.year(day).alias("year"), F.month(day).alias("month"), (F.col(change) + 100).alias(value)
    )
    return mean_by(rows, POINT_MONTH, value)


def at_twelve_decimals(df: DataFrame) -> DataFrame:
    """Coordinates as they survive a twelve-decimal text."""
    return df.withColumns({c: coordinate_text(F.col(c)).cast("double") for c in ("lat", "lon")})


def price_features(
    scaffold: DataFrame,
    points: DataFrame,
    first: tuple[int, int],
    last: tuple[int, int],
    value: str = "FAO_price",
    max_km: float = MATCH_RADIUS_KM,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Nearest price point per scaffold row of the month range; months without points drop out.

    The range is an argument: nothing depends on the day the job runs.
    """
    index = month_index(F.col("year"), F.col("month"))
    inside = index.between(first[0] * 12 + first[1] - 1, last[0] * 12 + last[1] - 1)
    rest = order or [c for c in scaffold.columns if c not in POINT_MONTH] or POINT_MONTH
    rows = keep_one(at_twelve_decimals(scaffold).where(inside), POINT_MONTH, rest)
    markets = keep_one(at_twelve_decimals(points).where(inside), POINT_MONTH, [value])
    named = markets.withColumn("point_id", F.struct("lat", "lon"))  # of equally near points the lowest wins
    return nearest_join(rows, named, "point_id", ("year", "month"), max_km, [value], "market_distance", "drop")


def market_trends(prices: DataFrame, value: str = "WFP_Price") -> DataFrame:
    """Mean and sample deviation of the trend per country and month."""
    day = F.to_date(F.col("Price Date"))
    rows = prices.select(
        F.col("Country").alias("country_name"), F.year(day).alias("year"), F.month(day).alias("month"), F.col("Trend").alias("trend")
    )
    return mean_std_by(rows, ["country_name", "year", "month"], "trend", value, value + "_std")


def trend_features(
    scaffold: DataFrame,
    places: DataFrame,
    trends: DataFrame,
    country_names: DataFrame,
    order: Sequence[str],
    place_order: Sequence[str] = ("ISO3", "lat", "lon"),
) -> DataFrame:
    """Scaffold rows with their country's price trend of the month.

    Scaffold rows find their place by ``title``. Titles repeat among places, and only the first
    place by ``place_order`` would survive the reduction to one row per position and month; so
    both sides are made unique before the join and nothing fans out.
    """
    unique_places = keep_one(places, ["lat", "lon"], ["title"])
    by_title = keep_one(unique_places, ["title"], place_order).select(
        "title", "ISO3", *[F.col(c).alias(c + "_fixed") for c in ("country", "lat", "lon")]
    )
    coded = lookup_country_code(trends, country_names)
    by_month = coded.where(F.col("country_code_3").isNotNull())
    rows = keep_one(scaffold, POINT_MONTH, order)
    # Titles and countries are few and hot; the tables on the right are no longer than a list of places.
    placed = left_join(rows, by_title, ["title"], salts=16).withColumn("country_code_3", F.col("ISO3"))
    return left_join(placed, by_month, ["country_code_3", "year", "month"]).drop("country_code_3")
