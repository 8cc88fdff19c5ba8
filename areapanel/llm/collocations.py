"""Collocation mining by best-first branch-and-bound growth of phrases.

Texts become sequences of word numbers once: words below the support end a stretch, the others are
numbered by language in ascending order of count. A phrase that begins with a word of count f scores
at most 1000 * n / f, so the least frequent first words have the largest bounds and are grown first,
a word longer in each pass and only from phrases that still have the support. A language is settled when
the bound of what was not grown is below the score of its last reported phrase.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.dedup import with_row_ids
from . import spans as sp
from . import tokens as tk
from .common import cut_lineage

SUPPORT = 100
LONGEST = 5
TOP = 2000

BREAK = tk.byte_class((0x0A, 0x0D), *[(c, c) for c in b".,;:!?"])
WORD = ~(BREAK | tk.byte_class((0x09, 0x09), (0x20, 0x20)))

FRONTIER = 1 << 16
"""Phrases grown or counted in one pass: what the driver and each task hold of them."""

SHARES = (0.3, 1.0)
"""Part of a language's frequent word occurrences whose words are first words after each round."""

BLOCK = 12 << 20
"""Bytes of one language's texts that are numbered together."""

HOLD = 24 << 20
"""Bytes of texts of all languages that a task holds for their blocks."""

PART = 1 << 10
"""What a few texts cost a task besides their bytes."""

HELD = 1 << 22
"""Occurrences a task holds before it passes their counts on."""

PAIRS = 1 << 21
"""Places of words a task holds before it passes them on by block."""

WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]
BLOCKS = "block long, lang string, n_words long, words array<binary>, counts array<long>, codes binary"
COUNTED = "size int, key long, a long, prev int"
_BLOCKS = pa.schema(
    [
        ("block", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.list_(pa.binary())),
        ("counts", pa.list_(pa.int64())), ("codes", pa.binary()),
    ]
)
_COUNTED = pa.schema([("size", pa.int32()), ("key", pa.int64()), ("a", pa.int64()), ("prev", pa.int32())])
_CORPUS = pa.schema([("lang", pa.string()), ("ids", pa.binary())])
_PAIRS = pa.schema([("block", pa.int64()), ("pairs", pa.list_(pa.int64()))])


def coded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Word numbers from 1, with a 0 before, between and after pieces, and the words."""
    data = tk.LOWER[data]
    inside = WORD[data]
    starts, ends = tk.word_spans(inside, offsets)
    code, words = tk.numbered(tk.words_array(data, inside, starts, ends))
    piece = np.searchsorted(np.flatnonzero(BREAK[data]), starts)  # breaks before each word, no count a byte
    doc = tk.owners(offsets, starts)
    new = np.concatenate(([True], (piece[1:] != piece[:-1]) | (doc[1:] != doc[:-1])))[: len(starts)]
    out = np.zeros(len(code) + int(new.sum()) + 1, np.int32)
    out[np.arange(len(code)) + np.cumsum(new)] = code + 1
    return out, words


def by_lang(batches) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Texts of one language put together up to about ``BLOCK`` bytes, so that a word is met in as few blocks as can be.

    Where many languages are held, the one with most bytes goes before it is full.
    """
    held: dict[str, list[pa.RecordBatch]] = {}
    size: dict[str, int] = {}

    def whole(lang: str) -> tuple[str, pa.RecordBatch]:
        size.pop(lang)
        return lang, pa.Table.from_batches(held.pop(lang)).combine_chunks().to_batches()[0]

    for batch in batches:
        langs, texts = batch.column(0).dictionary_encode(), batch.select(["text"])
        for at, rows in sp.by_group(langs.indices.to_numpy(zero_copy_only=False)):
            lang, part = langs.dictionary[at].as_py(), texts.take(pa.array(rows))
            held.setdefault(lang, []).append(part)
            size[lang] = size.get(lang, 0) + part.nbytes + PART
            if size[lang] >= BLOCK:
                yield whole(lang)
        while sum(size.values()) >= HOLD:
            yield whole(max(size, key=size.get))
    for lang in list(held):
        yield whole(lang)


def _blocks(batches):
    """A row per block of a language's texts: its words, their counts and its code sequence."""
    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 33
    for lang, batch in by_lang(batches):
        codes, words = coded(*sp.texts_of(batch))
        if len(words):
            counts = np.bincount(codes, minlength=len(words) + 1)[1:]
            yield sp.rows_batch(_BLOCKS, [(number, lang, int(counts.sum()), words.to_pylist(), counts.tolist(), sp.pack(codes))])
            number += 1


def _recoded(batches):
    """Codes of a block as numbers of the whole corpus; words below the support end a stretch."""
    for batch in batches:
        for lang, n, blob, found in zip(*(batch.column(i) for i in range(4))):
            table = np.zeros(n.as_py() + 1, np.int32)
            if found.is_valid:
                pairs = found.values.to_numpy(zero_copy_only=False)
                table[pairs >> 32] = pairs & 0xFFFFFFFF
            out = table[sp.unpack(blob.as_py())[0]]
            kept = np.ones(len(out), bool)
            kept[1:] = (out[1:] != 0) | (out[:-1] != 0)
            yield sp.rows_batch(_CORPUS, [(lang.as_py(), sp.pack(out[kept]))])


def _turned(blocks: list[np.ndarray], pairs: list[np.ndarray]) -> pa.RecordBatch:
    """A row per block with its pairs."""
    block = np.concatenate(blocks)
    order = np.argsort(block, kind="stable")
    block = block[order]
    first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(block)), pa.int32()), pa.array(np.concatenate(pairs)[order]))
    return pa.RecordBatch.from_arrays([pa.array(block[first]), lists], schema=_PAIRS)


def _by_block(batches):
    """Places of words as one long each, the code above the number, put together by block as far as a task holds them."""
    blocks, pairs, held = [], [], 0
    for batch in batches:
        block, code = batch.column("block"), batch.column("code")
        number = batch.column("gid").to_numpy(zero_copy_only=False).astype(np.int64)
        if pa.types.is_list(block.type):
            number = number[pc.list_parent_indices(block).to_numpy()]
            block, code = block.flatten(), code.flatten()
        if not len(block):
            continue
        blocks.append(block.to_numpy(zero_copy_only=False))
        pairs.append((code.to_numpy(zero_copy_only=False).astype(np.int64) << 32) | number)
        held += len(block)
        if held >= PAIRS:
            yield _turned(blocks, pairs)
            blocks, pairs, held = [], [], 0
    if held:
        yield _turned(blocks, pairs)


def numbers_of_blocks(met: DataFrame) -> DataFrame:
    """The frequent words of each block as one long a word, its code above its number: lists of structs take several times the memory.

    A row of ``met`` (block, code, gid) is a place of a word or, with lists of blocks and codes, all its places.
    """
    packed = met.select("block", "code", "gid").mapInArrow(_by_block, "block long, pairs array<long>")
    return packed.groupBy("block").agg(F.flatten(F.collect_list("pairs")).alias("found"))


class Corpus:
    """id sequences, the frequent words (gid, lang, word, f) and word occurrences by language."""

    def __init__(self, docs: DataFrame, support: int) -> None:
        rows = docs.select(
            F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
            F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        )
        blocks = cut_lineage(rows.mapInArrow(_blocks, BLOCKS))
        said = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "word")).select(
            "block", "lang", (F.col("code") + 1).alias("code"), F.col("word.words").alias("word"), F.col("word.counts").alias("count")
        )
        # One shuffle counts the words and keeps their places; rare words, which are most, go no further.
        f = F.sum("count").over(W.partitionBy("word", "lang"))
        places = said.withColumn("f", f).where(F.col("f") >= support).groupBy("word", "lang").agg(
            F.max("f").alias("f"), F.collect_list(F.struct("block", "code")).alias("at")
        )
        frequent = cut_lineage(places.select("lang", "word", "f", F.col("at.block").alias("block"), F.col("at.code").alias("code")))
        numbered = with_row_ids(frequent.select("lang", "word", "f"), ["lang", "f", "word"], "gid", 1)
        self.words = numbered.select(F.col("gid").cast("int").alias("gid"), "lang", "word", "f")
        # One row a word on both sides. The sort above would bring the words of most places into one task.
        found = numbers_of_blocks(frequent.drop("f").join(self.words, ["word", "lang"]))
        met = blocks.select("block", "lang", F.size("words").alias("n"), "codes").join(found, "block", "left")
        self.ids = cut_lineage(met.select("lang", "n", "codes", "found").mapInArrow(_recoded, "lang string, ids binary"))
        self.totals = {r["lang"]: r["n"] for r in blocks.groupBy("lang").agg(F.sum("n_words").alias("n")).collect()}


class Phrases:
    """A bounded set of phrases of one size, found in sequences by a hash and compared number by number."""

    def __init__(self, rows: np.ndarray) -> None:
        self.size, seed = rows.shape[1], 0
        while True:
            self.step = np.uint64(int(sp.STEP) + 2 * seed)
            found = self._hash([rows[:, j] for j in range(self.size)])
            order = np.argsort(found)
            if not (found[order][1:] == found[order][:-1]).any():
                break
            seed += 1
        self.hash, self.rows, self.number = found[order], rows[order], order
        self.some = np.zeros(1 << 20, bool)
        self.some[found >> np.uint64(44)] = True

    def _hash(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(columns[0]), np.uint64)
        for column in columns:
            out = out * self.step + column.astype(np.uint64)
        return sp.mix(out)

    def places(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where phrases of the set begin, and their numbers."""
        n = max(0, len(ids) - self.size + 1)
        found = self._hash([ids[j : j + n] for j in range(self.size)])
        place = np.flatnonzero(self.some[found >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.hash, found[place]), len(self.hash) - 1)
        equal = self.hash[at] == found[place]
        for j in range(self.size):
            equal &= self.rows[at, j] == ids[place + j]
        return place[equal], self.number[at[equal]]


def _sequences(batches) -> Iterator[tuple[str, np.ndarray]]:
    for batch in batches:
        for lang, blob in zip(*(c.to_pylist() for c in batch.columns)):
            yield lang, sp.unpack(blob)[0]


def _summed(size: int, keys: list[np.ndarray], prevs: list[np.ndarray]) -> pa.RecordBatch:
    """Counts of equal keys, and the word before them where it is always the same."""
    key, prev = np.concatenate(keys), np.concatenate(prevs)
    order = np.argsort(key, kind="stable")
    key, prev = key[order], prev[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    low, high = np.minimum.reduceat(prev, first), np.maximum.reduceat(prev, first)
    same = np.where((low == high) & (low > 0), low, -1).astype(np.int32)
    count = np.diff(first, append=len(key))
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(first), size, np.int32)), pa.array(key[first]), pa.array(count), pa.array(same)], schema=_COUNTED)


def _extended(ranges: dict[str, tuple[int, int]], sets: dict[int, Phrases]):
    """Each occurrence of a frontier phrase with the word after it, counted within the task."""

    def run(batches):
        held: dict[int, tuple[list, list]] = {}
        size_held = 0
        for lang, ids in _sequences(batches):
            low, high = ranges.get(lang, (0, 0))
            found = [(1, place, ids[place]) for place in [np.flatnonzero((ids >= low) & (ids < high))] if high > low]
            found += [(size, *phrases.places(ids)) for size, phrases in sets.items()]
            for size, place, number in found:
                after = ids[place + size]
                go = after > 0
                keys, prevs = held.setdefault(size, ([], []))
                keys.append((number[go].astype(np.int64) << 32) | after[go])
                prevs.append(ids[place[go] - 1])
                size_held += int(go.sum())
            if size_held > HELD:
                yield from (_summed(size, *lists) for size, lists in held.items() if any(map(len, lists[0])))
                held, size_held = {}, 0
        yield from (_summed(size, *lists) for size, lists in held.items() if any(map(len, lists[0])))

    return run


def _counted(sets: dict[int, Phrases]):
    """Occurrences of the phrases of some sets, counted within the task."""

    def run(batches):
        totals = {size: np.zeros(len(phrases.number), np.int64) for size, phrases in sets.items()}
        for _, ids in _sequences(batches):
            for size, phrases in sets.items():
                totals[size] += np.bincount(phrases.places(ids)[1], minlength=len(totals[size]))
        for size, counts in totals.items():
            held = np.flatnonzero(counts)
            none = np.full(len(held), -1, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(held), size, np.int32)), pa.array(held.astype(np.int64)), pa.array(counts[held]), pa.array(none)], schema=_COUNTED
            )

    return run


def _prefix(k: int | Column) -> list[Column]:
    """The first k words; 0 stands for none."""
    return [F.when(F.lit(i) <= k, F.col(w)).otherwise(F.lit(0)).alias(w) for i, w in enumerate(WORDS, 1)]


def _rest(k: Column) -> list[Column]:
    """The words after the first k."""
    padded = F.array(*[F.col(w) for w in WORDS], *[F.lit(0)] * LONGEST)
    return [F.element_at(padded, (k + i).cast("int")).alias(w) for i, w in enumerate(WORDS, 1)]


def _sets(rows: list, *others: str) -> tuple[dict[int, Phrases], list[tuple]]:
    """Phrases of each size, and (size, number, words and other columns) of each."""
    by_size: dict[int, list] = {}
    for r in rows:
        by_size.setdefault(r["size"], []).append(r)
    sets = {size: Phrases(np.array([[r[w] for w in WORDS[:size]] for r in found], np.int32)) for size, found in by_size.items()}
    names = [*WORDS, *others]
    return sets, [(size, number, *[r[c] for c in names]) for size, found in by_size.items() for number, r in enumerate(found)]


def _floor_score(a: Column, n: Column, l: Column, r: Column) -> Column:
    """floor(1000 * a * n / (l * r)) in decimals of 38 digits."""
    wide = [c.cast("decimal(38,0)") for c in (a, n, l, r)]
    return F.call_function("div", F.lit(1000).cast("decimal(38,0)") * wide[0] * wide[1], wide[2] * wide[3])


class Miner:
    """Grown phrases, what is still open, and what is known about counts."""

    def __init__(self, docs: DataFrame, support: int, top: int) -> None:
        self.spark, self.support, self.top = docs.sparkSession, support, top
        self.corpus = Corpus(docs, support)
        self.grams: list[DataFrame] = []
        self.rests: list[DataFrame] = []
        words = self.corpus.words
        bucket = F.floor(4 * F.log2(F.col("f"))).cast("int")
        steps = words.groupBy("lang", bucket.alias("bucket")).agg(
            F.sum("f").alias("mass"), F.min("gid").alias("low"), F.max("gid").alias("high"), F.min("f").alias("f")
        )
        self.steps: dict[str, list] = {}
        for r in steps.orderBy("lang", "bucket").collect():
            self.steps.setdefault(r["lang"], []).append(r)
        self.mass = {lang: sum(r["mass"] for r in found) for lang, found in self.steps.items()}
        self.taken = {lang: (0, 0) for lang in self.steps}  # steps and occurrences of words that are first words already
        self.least = {lang: 0 for lang in self.steps}  # a score that the last reported phrase reaches
        self.names = self.spark.createDataFrame(
            [(lang, self.corpus.totals[lang]) for lang in self.steps] or [("und", 0)], "lang string, n long"
        )

    def bound(self, lang: str) -> int:
        """The most that a phrase whose first word is not grown yet can score."""
        at = self.taken[lang][0]
        return 1000 * self.corpus.totals[lang] // self.steps[lang][at]["f"] if at < len(self.steps[lang]) else -1

    def next_words(self) -> dict[str, tuple[int, int]]:
        """The next first words of languages that are not settled, least frequent first, as ranges of numbers."""
        ranges = {}
        for lang, found in self.steps.items():
            if self.bound(lang) < max(self.least[lang], 0):
                continue
            at, mass = self.taken[lang]
            if at >= len(found):
                continue
            goal = min(s for s in SHARES if s * self.mass[lang] > mass) * self.mass[lang]
            low = found[at]["low"]
            while at < len(found) and mass < goal:
                mass, at = mass + found[at]["mass"], at + 1
            ranges[lang] = (low, found[at - 1]["high"] + 1)
            self.taken[lang] = at, mass
        return ranges

    def extend(self, ranges: dict[str, tuple[int, int]], frontier: list) -> DataFrame:
        """Phrases a word longer than the frontier's, with their counts, where they have the support."""
        sets, numbered = _sets(frontier, "lang", "f1")
        counted = self.corpus.ids.mapInArrow(_extended(ranges, sets), COUNTED).groupBy("size", "key")
        sums = counted.agg(F.sum("a").alias("a"), F.min("prev").alias("low"), F.max("prev").alias("high")).where(F.col("a") >= self.support)
        last = F.col("key").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
        grown = sums.select(
            "size", F.shiftright("key", 32).cast("int").alias("number"), last.alias("last"), "a",
            ((F.col("low") == F.col("high")) & (F.col("low") > 0)).alias("left_same"),
        )
        if not frontier:
            words = self.corpus.words.select(F.col("gid").alias("number"), "lang", F.col("f").alias("f1"))
            zero = [F.lit(0).alias(w) for w in WORDS[2:]]
            out = grown.join(words, "number").select(
                "lang", "f1", F.col("number").alias("w1"), F.col("last").alias("w2"), *zero, F.lit(2).alias("size"), "a", "left_same"
            )
        else:
            kind = "size int, number int, " + ", ".join(f"{w} int" for w in WORDS) + ", lang string, f1 long"
            table = self.spark.createDataFrame(numbered, kind)
            words = [F.when(F.col("size") == i - 1, F.col("last")).otherwise(F.col(w)).alias(w) for i, w in enumerate(WORDS, 1)]
            out = grown.join(table, ["size", "number"]).select("lang", "f1", *words, (F.col("size") + 1).alias("size"), "a", "left_same")
        return cut_lineage(out)

    def batches(self, level: DataFrame) -> Iterator[list]:
        """The phrases of a level that can grow, FRONTIER at a time, best bounds first."""
        level = level.where(F.col("size") < LONGEST).select("lang", "f1", "size", *WORDS)
        found = level.limit(FRONTIER + 1).collect()
        if len(found) <= FRONTIER:
            if found:
                yield found
            return
        share = (F.col("f1") / F.col("n")).alias("_share")
        ranked = with_row_ids(level.join(self.names, "lang").select(*level.columns, share), ["_share", *WORDS], "_rank")
        at = 0
        while found := ranked.where((F.col("_rank") >= at) & (F.col("_rank") < at + FRONTIER)).collect():
            yield found
            at += FRONTIER

    def grow(self, ranges: dict[str, tuple[int, int]]) -> None:
        """Grow the words of the ranges, and then what comes of them, best bounds first."""
        waiting = [self.extend(ranges, [])]
        self.rests = []  # a rest may be among what is grown now
        while waiting:
            level = waiting.pop(0)
            self.grams.append(level)
            waiting += [self.extend({}, found) for found in self.batches(level)]

    def _union(self, frames: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, frames)

    def scored(self) -> DataFrame:
        """Surviving phrases with the lowest score of their cuts, or its bound where a rest is not counted."""
        grams = self._union(self.grams)
        longer = grams.select(*_prefix(F.col("size") - 1), "a").groupBy(*WORDS).agg(F.max("a").alias("longer"))
        alive = grams.join(longer, WORDS, "left").where(
            (F.col("size") == LONGEST) | (~F.col("left_same") & (F.coalesce(F.col("longer"), F.lit(0)) < F.col("a")))
        )
        words = self.corpus.words.select(F.col("gid").alias("w1"), *[F.lit(0).alias(w) for w in WORDS[1:]], F.col("f").alias("a"))
        known = self._union([words, *[g.select(*WORDS, "a") for g in self.grams], *self.rests])
        cuts = alive.join(self.names, "lang").select(
            "lang", "n", "a", "size", F.struct(*WORDS).alias("phrase"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), *WORDS
        )
        both = cuts.select(
            "lang", "n", "a", "size", "phrase", "k", F.struct(*_prefix(F.col("k"))).alias("head"), F.struct(*_rest(F.col("k"))).alias("rest")
        )
        count = known.select(F.struct(*WORDS).alias("head"), F.col("a").alias("l"))
        met = both.join(count, "head").join(count.select(F.col("head").alias("rest"), F.col("l").alias("r")), "rest", "left")
        score = _floor_score(F.col("a"), F.col("n"), F.col("l"), F.coalesce(F.col("r"), F.col("a")))
        return met.withColumn("s", score).groupBy("phrase", "lang", "n", "a", "size").agg(
            F.min("s").alias("score"),
            F.max(F.col("r").isNull()).alias("open"),
            F.min_by(F.struct("l", "r"), F.struct("s", "k")).alias("cut"),
            F.collect_set(F.when(F.col("r").isNull(), F.col("rest"))).alias("missing"),
        )

    def settle(self) -> DataFrame:
        """Count the rests that a reported phrase may need, best bounds first, until none is open."""
        while True:
            scored = cut_lineage(self.scored())
            rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score")))
            last = scored.where(~F.col("open")).select("lang", "score").withColumn("rank", rank).where(F.col("rank") <= self.top)
            for r in last.where(F.col("rank") == self.top).collect():
                self.least[r["lang"]] = r["score"]
            limits = self.spark.createDataFrame(list(self.least.items()) or [("und", 0)], "lang string, least long")
            reach = scored.join(limits, "lang").where(F.col("score") >= F.col("least"))
            missing = reach.where("open").select("score", F.explode("missing").alias("rest")).groupBy("rest").agg(F.max("score").alias("score"))
            size = reduce(lambda x, y: x + y, [(F.col(f"rest.{w}") > 0).cast("int") for w in WORDS])
            wanted = missing.orderBy(F.desc("score"), "rest").limit(FRONTIER).select("rest.*", size.alias("size")).collect()
            if not wanted:
                return reach
            sets, numbered = _sets(wanted)
            found = self.corpus.ids.mapInArrow(_counted(sets), COUNTED).groupBy("size", F.col("key").cast("int").alias("number"))
            kind = "size int, number int, " + ", ".join(f"{w} int" for w in WORDS)
            table = self.spark.createDataFrame(numbered, kind)
            self.rests.append(cut_lineage(found.agg(F.sum("a").alias("a")).join(table, ["size", "number"]).select(*WORDS, "a")))

    def mine(self) -> DataFrame:
        reach = None
        while ranges := self.next_words():
            self.grow(ranges)
            reach = self.settle()
        if reach is None:
            return self.spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
        names = self.corpus.words.select(F.col("gid").alias("_gid"), F.col("word").cast("string").alias("_word"))
        said = reach.select(
            "lang", "a", "n", "score", "cut", "phrase",
            F.posexplode(F.filter(F.array(*[F.col(f"phrase.{w}") for w in WORDS]), lambda w: w > 0)).alias("_at", "_gid"),
        )
        spelled = said.join(names, "_gid").groupBy("lang", "a", "n", "score", "cut", "phrase").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_word"))), lambda x: x["_word"]), " ").alias("text")
        )
        rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text"))
        return spelled.withColumn("rank", rank.cast("long")).where(F.col("rank") <= self.top).select(
            "lang", "rank", F.col("text").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", "score"
        )


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases.

    A null language is ``und``; null, blank and empty texts add nothing; every row is a text, repeated
    ones too; other columns are ignored; an empty table gives no rows. A language whose phrases all lie
    below the support has no rows. Words of any length are whole. Equal scores go by count, then by
    the phrase's bytes.
    """
    return Miner(docs, support, top).mine()


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, words
  FROM (SELECT lang, regexp_extract_all(unnest(regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\x0A-\x0D]+')), '[^\x20\x09]+') AS words
        FROM documents)),
starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS p FROM pieces),
totals AS (SELECT lang, CAST(count(*) AS HUGEINT) AS n FROM starts GROUP BY lang),
grams AS (SELECT lang, list_slice(words, p, p + size - 1) AS gram, size FROM starts, range(1, 6) AS sizes(size) WHERE p + size - 1 <= len(words)),
counts AS (SELECT lang, gram, size, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
longer AS (
  SELECT DISTINCT lang, list_slice(gram, s, s + e - 1) AS gram, f
  FROM (SELECT lang, gram, f, size, unnest(range(1, size)) AS e FROM counts WHERE size > 2) parts, range(1, 6) AS places(s)
  WHERE e >= 2 AND s + e - 1 <= size),
inner_best AS (SELECT lang, gram, max(f) AS f FROM longer GROUP BY ALL),
alive AS (
  SELECT c.lang, c.gram, c.size, c.f AS a FROM counts c LEFT JOIN inner_best b USING (lang, gram)
  WHERE c.size >= 2 AND (b.f IS NULL OR 100 * b.f < 100 * c.f)),
cuts AS (SELECT lang, gram, a, size, unnest(range(1, size)) AS k FROM alive),
scored AS (
  SELECT x.lang, x.gram, x.a, k, h.f AS l, t.f AS r, n, (1000 * x.a * n) // (h.f * t.f) AS score
  FROM cuts x JOIN totals USING (lang)
  JOIN counts h ON h.lang = x.lang AND h.gram = list_slice(x.gram, 1, k)
  JOIN counts t ON t.lang = x.lang AND t.gram = list_slice(x.gram, k + 1, x.size)),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, array_to_string(gram, ' ') AS phrase, a, l, r, n, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(gram, ' '))) AS rank FROM lowest)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""
