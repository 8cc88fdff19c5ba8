"""Typed coercion that reports what it could not read instead of failing half way."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fixed import FALSE_WORDS, TRUE_WORDS
from .keys import to_number
from .nulls import strip

_ALIASES = {
    "float": ("float", "float64", "double", "numeric"),
    "int": ("int", "integer", "int64"),
    "bool": ("bool", "boolean"),
    "string": ("string", "str", "category", "categorical"),
}


def dtype_family(dtype: str | None) -> str:
    name = (dtype or "float").strip().lower().replace("_", "") or "float"
    for family, names in _ALIASES.items():
        if name in names:
            return family
    raise ValueError(f"unsupported dtype {dtype!r}")


def _number(column: Column, source: T.DataType | None) -> Column:
    if isinstance(source, T.NumericType):
        return F.when(~F.isnan(column.cast("double")), column.cast("double"))
    return to_number(column)


def coerce(column: Column, dtype: str, source: T.DataType | None = None) -> Column:
    """The value as ``dtype``; unreadable values become null (see :func:`unreadable`)."""
    family = dtype_family(dtype)
    if family == "float":
        return _number(column, source)
    if family == "int":
        number = _number(column, source)
        return F.when(number == F.floor(number), number.try_cast("bigint"))
    if family == "bool":
        if isinstance(source, T.BooleanType):
            return column
        if isinstance(source, T.NumericType):
            return F.when(column.isin(0, 1), column == 1)
        word = F.lower(strip(column.cast("string")))
        return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    return column.cast("string")


def unreadable(column: Column, dtype: str, source: T.DataType | None = None) -> Column:
    """True where a present value has no reading as ``dtype``."""
    present = column.isNotNull()
    if isinstance(source, (T.DoubleType, T.FloatType)):
        present = present & ~F.isnan(column)
    return present & coerce(column, dtype, source).isNull()
