"""Keep-first, keep-last and row numbering with an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """One whole row per key: the first (or last) by ``order``; null keys form one group.

    Spark turns the filter on the row number into a group limit before the shuffle: each input
    partition sends one row per key, so a key with a third of all rows never meets in one task.
    """
    ranked = [_col(c).desc() if last else _col(c).asc() for c in order]
    w = W.partitionBy(*[_col(k) for k in keys]).orderBy(*ranked)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def with_row_ids(df: DataFrame, order: Sequence[str], name: str = "_row_id", start: int = 0) -> DataFrame:
    """Consecutive ids from ``start`` in the order of ``order``.

    Rows are range-partitioned and sorted, the result is checkpointed so that partition
    bounds cannot move, and each partition adds the number of rows before it. Equal rows are told
    apart by their place in the input, so even copies are split between partitions; only one
    count per partition is joined back.
    """
    if name in df.columns:
        raise ValueError(f"{name} is reserved for row identity")
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    by = [*[_col(c) for c in order], F.col("_tie")]
    ranged = cut_lineage(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", position)
    )
    counts = {r["_part"]: r["count"] for r in ranged.groupBy("_part").count().collect()}
    offsets, total = [], start
    for part in sorted(counts):
        offsets.append((part, total))
        total += counts[part]
    if not offsets:
        return ranged.select(*[_col(c) for c in df.columns], F.lit(0).cast("long").alias(name))
    offset = df.sparkSession.createDataFrame(offsets, "_part int, _offset long")
    return ranged.join(F.broadcast(offset), "_part").select(
        *[_col(c) for c in df.columns], (F.col("_offset") + F.col("_pos")).alias(name)
    )


def with_surrogate_ids(
    df: DataFrame, id_column: str, location: Sequence[str] = ("lat", "lon"), gap: int = 100000
) -> DataFrame:
    """Give rows without an id one id per distinct location, counted from max id + ``gap``.

    Rows whose location is incomplete keep a null id, so the two halves add up to the input.
    """
    top = df.agg(F.max(_col(id_column)).alias("top")).first()["top"] or 0
    known = df.where(_col(id_column).isNotNull())
    unknown = df.where(_col(id_column).isNull()).drop(id_column)
    places = with_row_ids(unknown.select(*location).dropna().distinct(), location, id_column, int(top) + gap)
    id_type = df.schema[id_column].dataType
    return known.unionByName(
        unknown.join(places.withColumn(id_column, _col(id_column).cast(id_type)), list(location), "left").select(*df.columns)
    )
