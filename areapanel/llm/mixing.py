"""Mixing sources to target weights: tokens per source, repetition rates, hash-seeded copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import with_row_ids
from .common import cut_lineage, n_words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size and target of each source.

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` times
    all sizes. A target stops at ``most`` times the source's size; what is left is shared again by
    weight among the others until none is above. Sources stay in a distributed table; each round
    brings back one row of sums, and a round is needed only while another source reaches its limit.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = with_row_ids(totals.where("source IS NOT NULL"), ["source"], "_rank")
    count = named.count()
    rest = totals.where("source IS NULL").withColumn("_rank", F.lit(count).cast("long"))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    table = cut_lineage(named.unionByName(rest).withColumn("_weight", weight.cast("long")))
    budget = share * int(table.agg(F.sum("source_size")).first()[0] or 0)
    limit = most * F.col("source_size")
    level = 0.0
    while True:
        over = F.col("_weight") * F.lit(level) >= limit
        sums = table.agg(
            F.sum(F.when(over, limit)).alias("held"), F.sum(F.when(~over, F.col("_weight"))).alias("free")
        ).first()
        if not sums["free"]:
            break
        raised = (budget - (sums["held"] or 0)) / sums["free"]
        if raised <= level:
            break
        level = raised
    target = F.when(F.col("_weight") * F.lit(level) >= limit, limit.cast("double")).otherwise(F.col("_weight") * F.lit(level))
    return table.select("source", "source_size", target.alias("target"))


def chance(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) that the seed and the id decide, or the text where there is no id."""
    own = F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    drawn = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), own))
    return F.conv(F.substring(F.md5(drawn.cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0


def with_copies(docs: DataFrame, seed: int = 0, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The rows of ``docs`` as struct ``row``, with size, source_size, target and copies.

    Rate is target over source size: floor(rate) copies, and one more where the document's chance
    is below the fraction. The table of sources is joined left with the documents on its streamed
    side, so a source with most rows is split by adaptive execution or read in place by a broadcast
    that Spark checks the size of. Rows without a source form a source of their own; an empty or
    null text has size 0 and is taken without adding words. Repeated rows share
    their chance, and rows without id draw by their text. Other columns stay inside the struct, so their names cannot clash.
    """
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), n_words(F.col("text")).alias("size"))
    targets = source_targets(sized.select(F.col("row.source").alias("source"), "size"), weights, share, most)
    joined = sized.join(targets, F.col("row.source").eqNullSafe(F.col("source")), "left").drop("source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    extra = F.when(chance(F.col("row.doc_id"), F.col("row.text"), seed) < rate - whole, 1).otherwise(0)
    return joined.withColumn("copies", (whole + extra).cast("long"))


def mix(docs: DataFrame, seed: int = 0, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mixed documents: every row as often as the mix takes it, with the columns of ``docs``."""
    taken = with_copies(docs, seed, weights, share, most)
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def mixing_report(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target and taken words of every document."""
    return with_copies(docs.select("doc_id", "source", "text"), seed).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


MIXING_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5(coalesce(text, ''))) AS drawn, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         list_extract([5, 2, 1], (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1) AS weight
  FROM sized GROUP BY source),
budget AS (SELECT 1.5 * CAST(sum(source_size) AS DOUBLE) AS b FROM totals),
levels AS (
  SELECT 0 AS step, CAST(0 AS DOUBLE) AS level
  UNION ALL
  SELECT step + 1, CAST(((SELECT b FROM budget)
           - coalesce((SELECT sum(2 * source_size) FROM totals WHERE weight * level >= 2 * source_size), 0))
         / (SELECT sum(weight) FROM totals WHERE NOT weight * level >= 2 * source_size) AS DOUBLE)
  FROM levels WHERE step < 40 AND (SELECT sum(weight) FROM totals WHERE NOT weight * level >= 2 * source_size) IS NOT NULL),
final AS (SELECT max(level) AS level FROM levels),
targets AS (
  SELECT source, source_size, CAST(CASE WHEN weight * level >= 2 * source_size THEN 2 * source_size ELSE weight * level END AS DOUBLE) AS target
  FROM totals, final),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         CAST(('0x' || substr(md5('0:' || drawn), 1, 8)) AS BIGINT) / 4294967296.0 AS chance
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""
