"""Country-year indicators joined to the scaffold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import coordinate_text
from ..operators.dedup import keep_one
from ..operators.joins import left_join
from ..operators.reshape import years_to_long
from ..operators.series import densify_years

COUNTRY_YEAR = ["country_code_3", "year"]
_INDICATOR_TEXT = ("Country Name", "Indicator Name", "Indicator Code")
_SERIES_TEXT = ("Country Name", "Series Name", "Series Code")


def indicator(df: DataFrame, value: str) -> DataFrame:
    """Wide year table to ``country_code_3, year, value``."""
    drop = _SERIES_TEXT if "Series Name" in df.columns else _INDICATOR_TEXT
    return years_to_long(df, "Country Code", value, drop)


def inequality(df: DataFrame) -> DataFrame:
    """Yearly inequality index, gaps between observed years filled linearly."""
    rows = df.select(
        F.col("country_code").alias("country_code_3"), F.col("reporting_year").cast("int").alias("year"), F.col("gini").cast("double")
    )
    return densify_years(rows, "gini")


def indicator_features(
    scaffold: DataFrame,
    countries: DataFrame,
    consumer_prices: DataFrame,
    output: DataFrame,
    corruption: DataFrame,
    gini: DataFrame,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Scaffold rows with their country's yearly indicators.

    The country is found by position, compared as twelve-decimal text. Repeated positions on
    either side are reduced to their first row before the join, so a position shared by many
    rows does not multiply.
    """

    def at_text(df: DataFrame) -> DataFrame:
        return df.withColumns({c: coordinate_text(F.col(c)) for c in ("lat", "lon")})

    keys = ["lat", "lon", "year", "month"]
    rows = keep_one(at_text(scaffold), keys, order or [c for c in scaffold.columns if c not in keys] or keys)
    by_position = keep_one(at_text(countries.select("country", "ISO3", "lat", "lon")), ["lat", "lon"], ["ISO3", "country"])
    rows = left_join(rows, by_position, ["lat", "lon"]).withColumn("country_code_3", F.col("ISO3"))
    for table, value in ((consumer_prices, "CPI"), (output, "GDP"), (corruption, "CC")):
        rows = left_join(rows, indicator(table, value), COUNTRY_YEAR)
    return left_join(rows, inequality(gini), COUNTRY_YEAR)
