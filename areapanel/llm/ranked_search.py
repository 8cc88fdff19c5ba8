"""Ranked lexical search over a length-stratified index.

Documents of equal normaliser m form a stratum, so a term's impact depends on tf alone there: postings
lie by tf, and an impact is computed once per tf. Strata are cut into blocks of bounded size. A block's
largest tf of each term bounds what any of its documents can score; the blocks with the largest
bounds are visited first and give each query a threshold, and later visits open a block for a query
only where the bound can still reach that threshold.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import spans as sp
from . import tokens as tk
from .common import cut_lineage, partitions

TERM = tk.byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
"""Bytes of a term: ASCII letters and digits, and all bytes of longer characters."""

LENGTH_SHARE = 75
"""Per cent of the normaliser that follows the length of a document against the mean."""

TOP = 10
BLOCK_BYTES = 8 << 20
BLOCK_DOCS = 1 << 14
"""Text and documents of one block of a stratum; a longer document is a block of its own."""

PART_BYTES = 64 << 20
"""Text of one partition of the index."""

QUERY_TERMS = 1 << 16
"""Different (query, term) pairs handled at once: what the driver and each task hold of the queries."""

SEEDS = 2
"""Blocks that each query visits before its threshold is known."""

CELLS = 1 << 21
"""Scores, and postings added to them, held at once while a block is visited."""

INDEX = "m long, block long, n_docs long, directory binary, postings binary"
HITS = "query long, item_id long, doc_id long, score long"
_STRATA = pa.schema([("n", pa.int64()), ("docs", pa.int64()), ("bytes", pa.int64())])
_SPREAD = pa.schema([("doc_id", pa.int64()), ("m", pa.int64()), ("salt", pa.int64()), ("text", pa.binary())])
_INDEX = pa.schema([("m", pa.int64()), ("block", pa.int64()), ("n_docs", pa.int64()), ("directory", pa.binary()), ("postings", pa.binary())])
_HITS = pa.schema([("query", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def normaliser(n: int, n_docs: int, n_terms: int, share: int = LENGTH_SHARE) -> int:
    """m of a document of n terms, in whole numbers of any size."""
    return 100 - share + share * int(n) * n_docs // n_terms


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    """What one unit of weight adds for tf occurrences."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _lengths(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    starts, _ = tk.word_spans(TERM[data], offsets)
    return np.diff(np.searchsorted(starts, offsets))


def _strata(batches):
    for batch in sp.larger(batches):
        data, offsets = sp.texts_of(batch)
        n, place = np.unique(_lengths(data, offsets), return_inverse=True)
        sizes = np.bincount(place, np.diff(offsets), len(n)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(np.bincount(place, minlength=len(n))), pa.array(sizes)], schema=_STRATA)


def _spread(n_docs: int, n_terms: int, salts: dict[int, int]):
    """Each document with a term, its m, and a salt where its stratum is larger than a partition."""

    def run(batches):
        seen = 0
        for batch in batches:
            data, offsets = sp.texts_of(batch)
            n = _lengths(data, offsets)
            held = np.flatnonzero(n > 0)
            distinct, place = np.unique(n[held], return_inverse=True)
            m = np.array([normaliser(x, n_docs, n_terms) for x in distinct.tolist()], np.int64)[place]
            spread = np.array([salts.get(x, 1) for x in m.tolist()], np.int64)
            salt = (seen + np.arange(len(held))) % spread if len(held) else np.zeros(0, np.int64)
            seen += len(held)
            rows = batch.take(pa.array(held))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(m), pa.array(salt), rows.column(1)], schema=_SPREAD)

    return run


def _stretches(batches) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows of equal m, in blocks of bounded size; rows come sorted by m."""
    held, m, size, count = [], None, 0, 0

    def joined():
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        strata = sp.columns_of(batch, "m")[0]
        cuts = [0, *(np.flatnonzero(strata[1:] != strata[:-1]) + 1).tolist(), len(strata)]
        for first, end in zip(cuts[:-1], cuts[1:]):
            if first == end:
                continue
            if held and (strata[first] != m or size >= BLOCK_BYTES or count >= BLOCK_DOCS):
                yield m, joined()
                held, size, count = [], 0, 0
            m = int(strata[first])
            held.append(batch.slice(first, end - first))
            size += int(np.diff(sp.texts_of(held[-1])[1]).sum())
            count += end - first
    if held:
        yield m, joined()


def _blocks(batches):
    """A row per block: the directory (terms, df, largest tf) and the postings by tf of each term."""
    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 33
    for m, rows in _stretches(batches):
        data, offsets = sp.texts_of(rows)
        data = tk.LOWER[data]
        inside = TERM[data]
        starts, ends = tk.word_spans(inside, offsets)
        code, names = tk.numbered(tk.words_array(data, inside, starts, ends))
        n_docs = len(offsets) - 1
        pair, tf = np.unique(code * n_docs + tk.owners(offsets, starts), return_counts=True)
        code, doc = pair // n_docs, pair % n_docs
        order = np.lexsort((doc, tf, code))
        code, doc, tf = code[order], doc[order], tf[order]
        run = np.flatnonzero(np.concatenate(([True], (code[1:] != code[:-1]) | (tf[1:] != tf[:-1]))))
        last = np.flatnonzero(np.concatenate((code[1:] != code[:-1], [True])))
        text, lengths = tk.buffers_of(names)
        ids = rows.column(0).fill_null(int(sp.LAST)).to_numpy(zero_copy_only=False)
        df = np.bincount(code, minlength=len(names))
        directory = sp.pack(text, lengths.astype(np.uint32), df.astype(np.uint32), tf[last].astype(np.uint32))
        postings = sp.pack(
            ids,
            np.bincount(code[run], minlength=len(names)).astype(np.uint32),
            tf[run].astype(np.uint32),
            np.diff(run, append=len(code)).astype(np.uint32),
            doc.astype(np.uint16 if n_docs <= 1 << 16 else np.uint32),
        )
        yield sp.rows_batch(_INDEX, [(m, number, n_docs, directory, postings)])
        number += 1


class Index:
    """The blocks of an index, the documents with a term and all their terms."""

    def __init__(self, blocks: DataFrame, n_docs: int, n_terms: int) -> None:
        self.blocks, self.n_docs, self.n_terms = blocks, n_docs, n_terms


def build_index(docs: DataFrame) -> Index:
    """Index every document that holds a term.

    One pass counts documents and bytes by length; a second gives each document its m and sends it to its
    stratum. A stratum larger than a partition's share (one length may be that of a third of all rows)
    is salted over as many partitions as it needs; at most one such stratum a partition comes back to
    the driver. Each row is a document of its own, repeated ids too. Null ids are kept as the largest
    number; null and blank texts have no term and are not indexed; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    strata = cut_lineage(
        rows.select("text").mapInArrow(_strata, "n long, docs long, bytes long").where("n > 0").groupBy("n")
        .agg(F.sum("docs").alias("docs"), F.sum("bytes").alias("bytes"))
    )
    sums = strata.agg(F.sum("docs").alias("docs"), F.sum(F.col("n") * F.col("docs")).alias("terms"), F.sum("bytes").alias("bytes")).first()
    n_docs, n_terms, size = (int(v or 0) for v in sums)
    if not n_docs:
        return Index(spark.createDataFrame([], INDEX), 0, 0)
    parts = max(partitions(spark), -(-size // PART_BYTES))
    m = F.expr(f"{100 - LENGTH_SHARE} + ({LENGTH_SHARE} * CAST(n AS DECIMAL(38,0)) * {n_docs}) div {n_terms}").cast("long")
    share = max(1, size // parts)
    large = strata.groupBy(m.alias("m")).agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") > share).collect()
    salts = {r["m"]: -(-r["bytes"] // share) for r in large}
    spread = rows.mapInArrow(_spread(n_docs, n_terms, salts), "doc_id long, m long, salt long, text binary")
    blocks = spread.repartition(parts, "m", "salt").sortWithinPartitions("m").mapInArrow(_blocks, INDEX)
    return Index(cut_lineage(blocks), n_docs, n_terms)


class Queries:
    """A bounded block of queries: their terms once, and (query, term, occurrences) in arrays."""

    def __init__(self, numbers: list[int], items: list, found: list[Counter]) -> None:
        names: dict[bytes, int] = {}
        pairs = [(q, names.setdefault(t, len(names)), n) for q, terms in enumerate(found) for t, n in terms.items()]
        self.numbers, self.items, self.names = numbers, items, list(names)
        self.query, self.term, self.weight = (np.array([p[i] for p in pairs], np.int64) for i in range(3))

    def weighed(self, df: dict[int, int], n_docs: int) -> None:
        """Occurrences become weights; terms that no document holds, or that weigh nothing, go."""
        w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) if t in df else 0 for t in range(len(self.names))], np.int64)
        self.weight = self.weight * w[self.term]
        kept = self.weight > 0
        self.query, self.term, self.weight = self.query[kept], self.term[kept], self.weight[kept]

    def places(self, names: pa.Array) -> np.ndarray:
        """For each of a block's terms its number among the queries' terms, or -1."""
        found = pc.index_in(names, value_set=pa.array(self.names, pa.large_binary()))
        return found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def terms_of(text: str | None) -> Counter:
    data = tk.LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    starts, ends = tk.word_spans(TERM[data], np.array([0, len(data)]))
    return Counter(data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist()))


def _query_blocks(items: DataFrame) -> Iterator[Queries]:
    """Blocks of queries, read by the driver one block after another."""
    numbers, ids, found, size = [], [], [], 0
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    for number, row in enumerate(rows.toLocalIterator()):
        terms = terms_of(row["text"])
        if found and size + len(terms) > QUERY_TERMS:
            yield Queries(numbers, ids, found)
            numbers, ids, found, size = [], [], [], 0
        numbers, ids, found, size = [*numbers, number], [*ids, row["item_id"]], [*found, terms], size + len(terms)
    if found:
        yield Queries(numbers, ids, found)


def _directory(blob: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    text, lengths, df, most = sp.unpack(blob)
    return tk.strings(text, lengths.astype(np.int64)), df.astype(np.int64), most.astype(np.int64)


def _count_documents(queries: Queries):
    def run(batches):
        df = np.zeros(len(queries.names), np.int64)
        for batch in batches:
            for blob in batch.column(0):
                names, counts, _ = _directory(blob.as_py())
                at = queries.places(names)
                df[at[at >= 0]] += counts[at >= 0]
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], names=["term", "df"])

    return run


def _bounds(queries: Queries, m: int, at: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The most that a document of this block can score for each query."""
    best = np.zeros(len(queries.names), np.int64)
    best[at[at >= 0]] = impacts(most[at >= 0], m)
    bounds = np.zeros(len(queries.numbers), np.int64)
    np.add.at(bounds, queries.query, queries.weight * best[queries.term])
    return bounds


def _best_blocks(queries: Queries):
    """Of the blocks of a partition those with the largest bounds, SEEDS a query."""

    def run(batches):
        top = np.zeros((len(queries.numbers), SEEDS), np.int64)
        which = np.full((len(queries.numbers), SEEDS), -1, np.int64)
        for batch in batches:
            for m, block, blob in zip(*(c.to_pylist() for c in batch.columns)):
                names, _, most = _directory(blob)
                bounds = _bounds(queries, m, queries.places(names), most)
                top = np.column_stack((top, bounds))
                which = np.column_stack((which, np.full(len(bounds), block)))
                order = np.argsort(-top, axis=1, kind="stable")[:, :SEEDS]
                top, which = np.take_along_axis(top, order, 1), np.take_along_axis(which, order, 1)
        query, place = np.nonzero(top > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(which[query, place]), pa.array(top[query, place])], names=["query", "block", "bound"]
        )

    return run


def _scores(queries: Queries, wanted: np.ndarray, m: int, at: np.ndarray, postings: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(queries, their scores of every document of the block), some queries at a time."""
    ids, runs, tf, lengths, doc = postings
    n_docs = len(ids)
    impact = np.repeat(impacts(tf.astype(np.int64), m), lengths)
    run_of = np.concatenate(([0], np.cumsum(runs.astype(np.int64))))
    first = np.concatenate(([0], np.cumsum(lengths.astype(np.int64))))[run_of]
    place = np.full(len(queries.names), -1, np.int64)
    place[at[at >= 0]] = np.flatnonzero(at >= 0)
    pairs = np.flatnonzero(wanted[queries.query] & (place[queries.term] >= 0))
    query, term, weight = queries.query[pairs], place[queries.term[pairs]], queries.weight[pairs]
    size = first[term + 1] - first[term]
    begin, load = 0, np.cumsum(size)
    while begin < len(pairs):
        end = max(int(np.searchsorted(load, load[begin] - size[begin] + CELLS, "right")), begin + 1)
        end = min(end, int(np.searchsorted(query, query[begin] + max(1, CELLS // n_docs), "left")))
        if end < len(pairs):  # whole queries only, unless one query alone is more
            whole = int(np.searchsorted(query, query[end], "left"))
            end = whole if whole > begin else int(np.searchsorted(query, query[begin], "right"))
        own, row = np.unique(query[begin:end], return_inverse=True)
        posting = sp.ragged(first[term[begin:end]], size[begin:end])
        cell = np.repeat(row * n_docs, size[begin:end]) + doc[posting]
        out = np.zeros(len(own) * n_docs, np.int64)
        np.add.at(out, cell, impact[posting] * np.repeat(weight[begin:end], size[begin:end]))
        yield own, out.reshape(len(own), n_docs)
        begin = end


def _visit(queries: Queries, least: np.ndarray, top: int):
    """The best ``top`` documents of each query in this partition, none below the query's threshold."""

    def run(batches):
        floor = np.maximum(least, 1)
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            visits = []
            for m, blob, packed in zip(*(c.to_pylist() for c in batch.columns)):
                names, _, most = _directory(blob)
                at = queries.places(names)
                bounds = _bounds(queries, m, at, most)
                visits.append((-int((bounds - floor).max()), len(visits), m, at, bounds, packed))
            for _, _, m, at, bounds, packed in sorted(visits, key=lambda v: v[:2]):
                wanted = bounds >= floor
                if not wanted.any():
                    continue
                postings = sp.unpack(packed)
                for own, scores in _scores(queries, wanted, m, at, postings):
                    reached = np.flatnonzero((scores >= floor[own][:, None]).any(axis=1))
                    for row in reached.tolist():
                        query = int(own[row])
                        hit = np.flatnonzero(scores[row] >= floor[query])
                        score, doc = scores[row][hit], postings[0][hit]
                        if query in best:
                            score, doc = np.concatenate((best[query][0], score)), np.concatenate((best[query][1], doc))
                        order = np.lexsort((doc, -score))[:top]
                        best[query] = score[order], doc[order]
                        if len(order) == top:
                            floor[query] = max(floor[query], best[query][0][-1])
        rows = [(queries.numbers[q], queries.items[q], int(d), int(s)) for q, (ss, dd) in best.items() for s, d in zip(ss, dd)]
        yield sp.rows_batch(_HITS, rows)

    return run


def _ranked(hits: DataFrame, top: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "doc_id"))
    return hits.withColumn("rank", rank.cast("int")).where(F.col("rank") <= top)


def search(index: Index, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` best documents of every row of ``items``.

    Queries come in blocks of bounded size and each block reads the index three times: for document
    frequencies, for the blocks with the best bounds, and for the visits. Only documents with a score above
    0 appear; equal scores go by doc_id, null ids last. An item without a term, or whose terms no
    document holds, has no row; a repeated item is a query of its own.
    """
    spark = items.sparkSession
    results = spark.createDataFrame([], HITS)
    blocks = index.blocks
    for queries in _query_blocks(items) if index.n_docs else ():
        counted = blocks.select("directory").mapInArrow(_count_documents(queries), "term long, df long")
        queries.weighed({r["term"]: r["df"] for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect()}, index.n_docs)
        bounded = blocks.select("m", "block", "directory").mapInArrow(_best_blocks(queries), "query long, block long, bound long")
        order = W.partitionBy("query").orderBy(F.desc("bound"), "block")
        seeds = bounded.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= SEEDS).select("block").distinct()
        columns = ["m", "directory", "postings"]
        none = np.zeros(len(queries.numbers), np.int64)
        # At most SEEDS numbers a query of a bounded block.
        first = blocks.join(F.broadcast(seeds), "block", "left_semi").select(*columns).mapInArrow(_visit(queries, none, top), HITS)
        least = dict(zip(queries.numbers, none.tolist()))
        for r in _ranked(first, top).where(F.col("rank") == top).collect():
            least[r["query"]] = r["score"]
        floors = np.array([least[q] for q in queries.numbers], np.int64)
        results = results.unionByName(blocks.select(*columns).mapInArrow(_visit(queries, floors, top), HITS))
    last = F.lit(int(sp.LAST))
    return _ranked(results, top).select("item_id", "rank", F.when(F.col("doc_id") != last, F.col("doc_id")).alias("doc_id"), "score")


def ranked_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The ten best documents of each item."""
    return search(build_index(docs), items)


SEARCH_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
held AS (SELECT doc, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
totals AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM held),
norm AS (SELECT doc, doc_id, 100 - 75 + ((75 * n * n_docs) // n_terms) AS m FROM held, totals),
postings AS (SELECT doc, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc, unnest(terms) AS term FROM held) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, CAST(count(*) AS BIGINT) AS df FROM postings GROUP BY term), totals),
items AS (
  SELECT row_number() OVER () AS query, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark),
asked AS (SELECT query, item_id, term, CAST(count(*) AS BIGINT) AS times FROM (SELECT query, item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
scored AS (
  SELECT query, item_id, doc, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN norm USING (doc) GROUP BY ALL),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
