"""The four missing-value vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fixed import NULL_TOKENS, UNTRIMMED_VOCABULARIES, WHITESPACE


def strip(column: Column) -> Column:
    return F.trim(column, F.lit(WHITESPACE))


def is_blank(column: Column, vocabulary: str = "builder") -> Column:
    """True where text is null or one of the vocabulary's tokens."""
    text = column.cast("string")
    if vocabulary not in UNTRIMMED_VOCABULARIES:
        text = strip(text)
    return text.isNull() | text.isin(*NULL_TOKENS[vocabulary])


def null_if_blank(column: Column, vocabulary: str = "builder") -> Column:
    return F.when(~is_blank(column, vocabulary), column)


def is_missing(field: T.StructField, vocabulary: str = "builder") -> Column:
    """Missing test by column type: tokens for text, NaN for floats, null for the rest."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return is_blank(column, vocabulary)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def normalize_null_tokens(df: DataFrame, vocabulary: str = "inference") -> DataFrame:
    """Replace null tokens by null in every text column, in one projection."""
    return df.select(
        *[
            null_if_blank(F.col(f"`{f.name}`"), vocabulary).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def present(number: Column) -> Column:
    """A number, or null where it is missing as NaN."""
    return F.when(~F.isnan(number.cast("double")), number)
