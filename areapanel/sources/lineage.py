"""File facts: path, size, time, checksum, row counts, and what is missing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _hasher(chunk_bytes: int = 8 * 1024 * 1024):
    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            sums = []
            for path in batch["path"]:
                system, inner = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:/", "file:///", 1))
                state = hashlib.sha256()
                with system.open_input_stream(inner) as stream:
                    while chunk := stream.read(chunk_bytes):
                        state.update(chunk)
                sums.append(state.hexdigest())
            yield batch.assign(sha256=sums)

    return digest


def file_lineage(spark: SparkSession, path: str, pattern: str = "*", checksum: bool = True) -> DataFrame:
    """``path, name, length, modified[, sha256]`` of every file below ``path``.

    File listing and sizes come from Spark; contents are streamed through the hash in the tasks,
    a chunk at a time, so file size does not matter.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.col("modificationTime").alias("modified"))
    )
    if not checksum:
        return files
    # Spread the paths: listing packs many small files into one task, hashing should not.
    return files.repartition("path").mapInPandas(
        _hasher(), "path string, name string, length bigint, modified timestamp, sha256 string"
    )


def csv_row_counts(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Data rows per CSV file, header not counted."""
    return row_counts(spark.read.option("header", True).option("multiLine", multi_line).csv(path))


def row_counts(rows: DataFrame) -> DataFrame:
    """``path, data_rows`` of the files that ``rows`` were read from, by any reader; no column is read for it."""
    return rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("data_rows"))


def lineage_with_rows(files: DataFrame, *counts: DataFrame) -> DataFrame:
    """File facts with each file's data rows: 0 where a table was read and the file gave none, null where none of ``counts`` saw its kind."""
    counted = counts[0]
    for more in counts[1:]:
        counted = counted.unionByName(more)
    kinds = counted.select(_suffix("path").alias("_kind")).distinct()
    # Row metadata name a file as a quoted URI, the listing as a plain one.
    unquoted = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    bare = counted.select(_local(unquoted).alias("_plain"), "data_rows")
    met = files.withColumns({"_plain": _local(F.col("path")), "_kind": _suffix("path")}).join(bare, "_plain", "left")
    known = met.join(kinds.withColumn("_read", F.lit(True)), "_kind", "left")
    rows = F.coalesce("data_rows", F.when(F.col("_read"), 0)).cast("long")
    return known.select(*[F.col(f"`{c}`") for c in files.columns], rows.alias("data_rows"))


def _local(path: Column) -> Column:
    """One spelling of file:/x and file:///x."""
    return F.regexp_replace(path, "^file:/+", "/")


def _suffix(path: str) -> Column:
    return F.regexp_extract(path, r"\.([^./]+)$", 1)


def missing_files(expected: DataFrame, found: DataFrame, name: str = "name") -> DataFrame:
    """Expected file names that were not found."""
    return expected.join(found.select(name), name, "left_anti")
