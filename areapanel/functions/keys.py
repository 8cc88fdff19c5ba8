"""Area, coordinate and calendar keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import COORDINATE_DIGITS
from .nulls import strip


def to_number(column: Column) -> Column:
    """Text to double; anything that is not a finite decimal number becomes null.

    The cast alone would also read "12d", "3f" and "0x1p3"; their letters are spoilt first.
    """
    number = F.translate(strip(column.cast("string")), "dDfFxX", "zzzzzz").try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def parse_int(column: Column) -> Column:
    """``"4.0"`` -> 4, truncating towards zero; blank and unparsable text -> null."""
    return to_number(column).try_cast("int")


def whole_number_text(number: Column, text: Column) -> Column:
    """The number as integer text where it is whole, else the text; null gives ''."""
    whole = number.try_cast("bigint")
    return F.coalesce(F.when(whole == number, whole.cast("string")), text, F.lit(""))


def normalize_area_id(column: Column) -> Column:
    """Whole numbers lose their decimals and zeros, other text is trimmed, null -> ''."""
    return whole_number_text(to_number(column), trim_key(column))


def trim_key(column: Column) -> Column:
    """Trimmed text; leading zeros stay."""
    return strip(column.cast("string"))


def coordinate_text(column: Column) -> Column:
    return F.format_string("%.12f", column.cast("double"))


def coordinate_rounded(column: Column, digits: int = COORDINATE_DIGITS) -> Column:
    return F.round(column.try_cast("double"), digits)


def month_index(year: Column, month: Column) -> Column:
    return year * 12 + month - 1


def index_year(index: Column) -> Column:
    return F.floor(index / 12).cast("int")


def index_month(index: Column) -> Column:
    return (F.pmod(index, F.lit(12)) + 1).cast("int")


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def year_month_text(year: Column, month: Column) -> Column:
    """``YYYY-MM``; an invalid date, which sorts as -1, gives ''."""
    valid = (year >= 0) & (month >= 0)
    return F.when(valid, F.concat(_padded(year, 4), F.lit("-"), _padded(month, 2))).otherwise("")


def yyyymm(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), _padded(month, 2))


def target_period(period: Column, months: Column | int) -> Column:
    """Calendar month ``months`` after a ``YYYY-MM`` text, by month-index arithmetic."""
    shift = F.lit(months) if isinstance(months, int) else months
    year, month = (F.split(period, "-")[i].try_cast("int") for i in (0, 1))
    index = month_index(year, month) + shift
    return F.concat(_padded(index_year(index), 4), F.lit("-"), _padded(index_month(index), 2))


def parse_feature_month(text: str) -> tuple[int, int]:
    """``YYYY-MM`` or ``YYYYMM`` to (year, month)."""
    match = re.fullmatch(r"(\d{4})-?(\d{2})", text)
    if not match or not 1 <= int(match.group(2)) <= 12:
        raise ValueError(f"feature month must be YYYY-MM or YYYYMM, got {text!r}")
    return int(match.group(1)), int(match.group(2))


def check_target_month(year: int, month: int) -> None:
    if not 1900 <= year <= 2100:
        raise ValueError(f"invalid target year {year}")
    if not 1 <= month <= 12:
        raise ValueError(f"invalid target month {month}")


def first_token(column: Column) -> Column:
    """``"2019 [YR2019]"`` -> ``"2019"``."""
    return F.split(column, " ")[0]


def digits(column: Column) -> Column:
    """First run of digits in a text."""
    return F.regexp_extract(column, r"(\d+)", 1)
