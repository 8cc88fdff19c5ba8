"""Writers with a fixed column order, partition layout and overwrite guard."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    fmt: str = "parquet",
    overwrite: bool = False,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> None:
    """Write with a header and a fixed column order; an existing target is an error by default.

    Partitioned output is first gathered by its partition columns, spread over several tasks
    each, so a large month is not written by one task nor a small one by all of them.
    """
    out = df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df
    if partition_by:
        spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in out.columns if c not in partition_by]), F.lit(32))
        out = out.withColumn("_spread", spread).hint("rebalance", *[F.col(f"`{c}`") for c in partition_by], F.col("_spread")).drop("_spread")
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    writer = out.write.mode("overwrite" if overwrite else "errorifexists").format(fmt).option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_predictions(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """All scopes of a month in one commit, laid out by feature month and scope."""
    write_table(df, path, overwrite=overwrite, partition_by=["feature_period", "scope_months"])


def write_report(report: DataFrame, path: str, overwrite: bool = False) -> None:
    """JSON lines, keys in name order."""
    ordered = report.select(*[F.col(f"`{c}`") for c in sorted(report.columns)])
    ordered.write.mode("overwrite" if overwrite else "errorifexists").json(path)


def write_chunks(parts: Iterable[DataFrame], folder: str, mode: str = "errorifexists") -> int:
    """Each part as a chunk of its own under ``folder``, with the columns it has; returns the number of chunks."""
    count = 0
    for count, part in enumerate(parts, 1):
        part.write.mode(mode).parquet(f"{folder}/chunk={count}")
    return count


def read_chunks(spark: SparkSession, folder: str, key: str = "region_id") -> DataFrame:
    """All chunks under the sorted union of their columns; what a chunk lacks is null."""
    merged = spark.read.option("mergeSchema", "true").parquet(folder).drop("chunk")
    return merged.select(f"`{key}`", *[f"`{c}`" for c in sorted(c for c in merged.columns if c != key)])
