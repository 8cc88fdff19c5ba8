"""What several operators share: reading, words, batch sizes and stages written to the shared folder."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import wraps

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import Registry
from ..session import cut_lineage

# The six ASCII white-space characters; bytes.split() without arguments uses the same set.
SPACES = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"

BATCH_BYTES = 4 << 20
"""Bytes of one Arrow batch, so that a worker's memory does not follow the number of rows."""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """Words between ASCII white space; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches by bytes as well as rows, and let tasks carry this folder's functions with them."""
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    return spark


def llm_query(registry: Registry, name: str, sql: str | None = None):
    """Register a query that runs with bounded Arrow batches."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(small_batches(spark), sf_dir)

        registry(name, sql)(run)
        return fn

    return add


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts, to size buckets by."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


__all__ = [
    "BATCH_BYTES", "GAP", "SPACES", "ascii_lower", "cut_lineage", "documents", "llm_query", "n_words", "partitions",
    "small_batches", "text_bytes", "words",
]
