"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 1 marks a word that counts, 0 one that is ignored. Every alignment of an item of LONG words or more that has
#: SHARE per cent or a RUN contains one of these, whichever words were replaced (tests/llm/test_leaks.py).
MASKS = ("1111", "1101001", "1010101")

LONG = 15
"""Words from which on an item is sure to meet one of MASKS; shorter ones can slip through (11011100110111)."""

#: Words of shorter items, from and to, and the masks that they are sure to meet.
SHORT_MASKS = ((1, 1, ("1",)), (2, 2, ("11",)), (3, LONG - 1, ("111", "1101", "1011")))

SHARE = 70
"""Per cent of an item's words that must stand at their places in a document."""

RUN = 13
"""Or so many matching words with no two mismatches in a row."""

BLOCK = 256
"""Words of a block of a document."""

BROADCAST_SEEDS = 1_000_000
"""Benchmark seeds that are sent to all executors at most (24 bytes each); beyond, both sides are shuffled."""

# ASCII white space and punctuation separate words.
BREAK = r"[\x20\x09-\x0D!-/:-@\[-`{-~]+"
EDGE = " \t\n\x0b\x0c\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def plain_words(text: Column) -> Column:
    """Lower-case words without ASCII punctuation."""
    bare = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(EDGE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BREAK))


def seeds(texts: DataFrame, key: str, masks: Sequence[str] = MASKS) -> DataFrame:
    """(key, place, seed) of every place of every text: the hash of the words each mask lets through.

    Shifted copies of the word hashes are zipped and unfolded, so that a seed is hashed from columns
    in generated code instead of a lambda per place.
    """
    span = max(map(len, masks))
    marks = texts.select(key, F.transform(plain_words(F.col("text")), lambda w: F.xxhash64(w)).alias("_w"))
    size = F.size("_w")
    shifted = marks.select(
        key, *[F.when(size > k, F.slice("_w", F.lit(k + 1), size)).otherwise(F.array().cast("array<bigint>")).alias(f"w{k}") for k in range(span)]
    )
    places = shifted.select(key, F.posexplode(F.arrays_zip(*[f"w{k}" for k in range(span)])).alias("place", "_at"))
    hashed = []
    for mask in masks:
        cared = [F.col(f"_at.w{k}") for k, bit in enumerate(mask) if bit == "1"]
        hashed.append(F.when(F.col(f"_at.w{len(mask) - 1}").isNotNull(), F.xxhash64(F.lit(int(mask, 2)), *cared)))
    return places.select(key, "place", F.explode(F.array(*hashed)).alias("seed")).where("seed IS NOT NULL")


def masks_by_size(benchmark: DataFrame, masks: Sequence[str] = MASKS) -> list[tuple[int, int | None, Sequence[str]]]:
    """(least words, most words, masks) of the sizes that the benchmark has items of, so that documents get no other seeds."""
    kinds = [*SHORT_MASKS, (LONG, None, masks)]
    size = F.size(plain_words(F.col("text")))
    has = benchmark.agg(*[F.max(_between(size, low, high)).alias(f"_{k}") for k, (low, high, _) in enumerate(kinds)]).first()
    return [kind for kind, there in zip(kinds, has) if there]


def _between(size: Column, low: int, high: int | None) -> Column:
    return size >= low if high is None else size.between(low, high)


def seed_hits(docs: DataFrame, benchmark: DataFrame, masks: Sequence[str] = MASKS) -> DataFrame:
    """(doc_id, item_id, lag): where seeds meet, and how far the document's place is ahead of the item's."""
    kinds = masks_by_size(benchmark, masks)
    size = F.size(plain_words(F.col("text")))
    parts = [seeds(benchmark.where(_between(size, low, high)).select("item_id", "text"), "item_id", own) for low, high, own in kinds]
    # A benchmark without words has no seeds; its texts stand in for the empty table.
    wanted = reduce(DataFrame.unionAll, parts) if parts else seeds(benchmark.select("item_id", "text"), "item_id", masks)
    wanted = wanted.select("item_id", F.col("place").alias("_place"), "seed").distinct()
    if wanted.count() <= BROADCAST_SEEDS:
        wanted = F.broadcast(wanted)
    every = list(dict.fromkeys(mask for _, _, own in kinds for mask in own)) or masks
    met = seeds(docs.select("doc_id", "text"), "doc_id", every).join(wanted, "seed")
    return met.select("doc_id", "item_id", (F.col("place") - F.col("_place")).alias("lag")).distinct()


def with_own_key(table: DataFrame, key: str) -> DataFrame:
    """(key, text) where the key is a struct of the id and the text's hash, so that rows sharing an id stay apart."""
    return table.select(F.struct(F.col(key).alias("id"), F.xxhash64("text").alias("mark")).alias(key), "text")


def laid_pieces(docs: DataFrame, benchmark: DataFrame, masks: Sequence[str]) -> DataFrame:
    """(doc_id, item_id, lag, _n, _same): per hit, whether each of the item's words stands at its place in the document.

    A text with hits is split once into blocks of BLOCK words; a hit meets only the blocks under its
    item, so its work follows the item and not the document. Places before the first block or beyond the
    last are left out of ``_same``; they match nothing.
    """
    docs, benchmark = with_own_key(docs, "doc_id"), with_own_key(benchmark, "item_id").dropDuplicates(["item_id"])
    hits = seed_hits(docs, benchmark, masks)
    held = docs.join(hits.select("doc_id").distinct(), "doc_id", "left_semi")
    split = held.select("doc_id", plain_words(F.col("text")).alias("_words"))
    count = F.ceil(F.size("_words") / BLOCK).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(F.col("_words"), b * BLOCK + 1, F.lit(BLOCK)))
    blocks = split.where(F.size("_words") > 0).select("doc_id", F.posexplode(cut).alias("_block", "_under"))
    items = benchmark.select("item_id", plain_words(F.col("text")).alias("_item")).withColumn("_n", F.size("_item"))
    lag, base = F.col("lag"), F.col("_block") * BLOCK
    low, high = F.floor(F.greatest(lag, F.lit(0)) / BLOCK).cast("int"), F.floor((lag + F.col("_n") - 1) / BLOCK).cast("int")
    asked = hits.join(items, "item_id").withColumn("_block", F.explode(F.sequence(low, high)))
    first = F.greatest(base - lag, F.lit(0))
    length = F.least(F.col("_n"), base + BLOCK - lag) - first
    asked = asked.select("doc_id", "item_id", "lag", "_n", "_block", F.slice("_item", first + 1, length).alias("_wanted"), (first + lag - base).alias("_from"))
    under = F.slice("_under", F.col("_from") + 1, F.size("_wanted"))
    same = F.zip_with("_wanted", under, lambda w, u: F.coalesce(w == u, F.lit(False)))
    met = asked.join(blocks, ["doc_id", "_block"]).select("doc_id", "item_id", "lag", "_n", F.struct("_block", same.alias("same")).alias("_piece"))
    pieces = met.groupBy("doc_id", "item_id", "lag", "_n").agg(F.array_sort(F.collect_set("_piece")).alias("_pieces"))
    return pieces.select("doc_id", "item_id", "lag", "_n", F.flatten(F.transform("_pieces", lambda p: p["same"])).alias("_same"))


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: Sequence[str] = MASKS, share: int = SHARE, run: int = RUN) -> DataFrame:
    """(doc_id, item_id, n_matched, n_item_words, longest_run, first_word) of each document that holds an item.

    At a hit the whole item is laid along the document and words at equal places are counted; words
    may be replaced in between. One row per document and item, the best alignment, first on ties. MASKS
    for items of LONG words or more, and SHORT_MASKS for the others, miss no alignment with SHARE or a RUN;
    they promise nothing below these bounds. Null and empty texts have no seeds. Rows that share a doc_id
    are judged by their own texts and reported under one id; null ids are one id. Other columns are ignored.
    """
    compared = laid_pieces(docs, benchmark, masks)
    folded = F.aggregate(
        "_same",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("missed"), F.lit(0).alias("best")),
        lambda a, hit: F.when(
            hit, F.struct((a["n"] + 1).alias("n"), F.lit(0).alias("missed"), F.greatest(a["best"], a["n"] + 1).alias("best"))
        ).otherwise(
            F.struct(
                F.when(a["missed"] > 0, 0).otherwise(a["n"]).alias("n"), (a["missed"] + 1).alias("missed"), a["best"].alias("best")
            )
        ),
    )
    counted = compared.select(
        F.col("doc_id.id").alias("doc_id"),
        F.col("item_id.id").alias("item_id"),
        "lag",
        F.size(F.filter("_same", lambda s: s)).alias("n_matched"),
        F.col("_n").alias("n_item_words"),
        folded["best"].alias("longest_run"),
    ).where((100 * F.col("n_matched") >= share * F.col("n_item_words")) | (F.col("longest_run") >= run))
    best = F.max(F.struct("n_matched", (-F.col("lag")).alias("back"), "n_item_words", "longest_run")).alias("_best")
    return counted.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id",
        "item_id",
        F.col("_best.n_matched").cast("long").alias("n_matched"),
        F.col("_best.n_item_words").cast("long").alias("n_item_words"),
        F.col("_best.longest_run").cast("long").alias("longest_run"),
        (-F.col("_best.back")).cast("long").alias("first_word"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item.

    Rows without an id are judged by their texts, so equal texts share a verdict and others keep their own.
    The rows stay inside a struct, so no column of theirs can clash.
    """
    given = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    own = F.concat(F.lit("text "), F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    key = F.when(F.col("doc_id").isNotNull(), F.concat(F.lit("id "), F.col("doc_id").cast("string"))).otherwise(own)
    keyed = docs.select(given, key.alias("doc_id"), F.col("text").alias("text"))
    found = overlaps(keyed.select("doc_id", "text"), benchmark).select("doc_id").distinct()
    return keyed.select("row", "doc_id").join(found, "doc_id", "left_anti").select("row.*")
