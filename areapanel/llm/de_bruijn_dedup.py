"""Substring dedup by De Bruijn compaction: words covered by a long word sequence that came before.

Windows of 20 words are the edges of a De Bruijn graph. Edges are compared where they share an anchor, so
neighbouring edges travel together; equal edges meet, their source words are compared, and every
occurrence but the first is a repeated edge with its own and the first one's coordinates. Repeated
edges that follow one another on both sides form a nonbranching path: Spark joins their ends by
place and lane, and only the outer ends of each path are left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import spans as sp
from .common import cut_lineage, partitions, text_bytes
from .suffix_dedup import BUCKET_BYTES, PACKED, SAMPLE_BYTES, SAMPLE_KEYS, assemble, keyed, pack_documents

WINDOW = 20
LEAD = 4
"""Words of an anchor."""

SLICE = 1 << 16
"""Words handled at once."""

PATHS = "lane long, id long, mark long, start long, end long, gram binary"
REPORT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_PATHS = pa.schema([(n, pa.int64()) for n in "lane id mark start end".split()] + [("gram", pa.binary())])
_PACKED = pa.schema([("group", pa.int32()), ("blob", pa.binary())])


def _word_bytes(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, each followed by one space; where each ends; and the number of words up to each text."""
    column = batch.column(batch.schema.get_field_index("text"))
    lists = [x.as_py().split() for x in column]
    data = np.frombuffer(b"".join(b" ".join(x) + b" " for x in lists if x), np.uint8)
    return data, np.flatnonzero(data == 32), np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)


def word_hashes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word of ``data``; words are followed by one space."""
    if not len(ends):
        return np.zeros(0, np.uint64)
    starts = np.concatenate(([0], ends[:-1] + 1))
    sizes = ends + 1 - starts
    powers = np.cumprod(np.full(int(sizes.max()), sp.STEP | np.uint64(1), np.uint64))
    weights = powers[np.arange(len(data)) - np.repeat(starts, sizes)]
    return sp.mix(np.add.reduceat(data.astype(np.uint64) * weights, starts))


def _slice_hashes(data: np.ndarray, ends: np.ndarray, first: int, last: int) -> np.ndarray:
    low = int(ends[first - 1]) + 1 if first else 0
    return word_hashes(data[low : int(ends[last - 1]) + 1], ends[first:last] - low)


def _slices(data, ends, counts) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(key, anchor, first window, last window), windows by number of their first word."""
    last = counts[1:] - (WINDOW - 1)
    for at in range(0, len(ends) - WINDOW + 1, SLICE):
        grams = sp.gram_hashes(_slice_hashes(data, ends, at, min(len(ends), at + SLICE + WINDOW - 1)), LEAD)
        first = np.maximum(counts[:-1], at)
        valid = sp.ragged(first - at, np.maximum(np.minimum(last, at + SLICE) - first, 0))
        anchor, begin, end = sp.anchored(grams, WINDOW - LEAD + 1, valid)
        yield grams[anchor], anchor + at, begin + at, end + at


def _sampled_keys(batches):
    for batch in batches:
        for keys, _, _, _ in _slices(*_word_bytes(batch)):
            keys = keys[:: max(1, -(-len(keys) // SAMPLE_KEYS))]
            if len(keys):
                yield sp.rows_batch(_PACKED, [(0, sp.pack(keys))])


def _splitters(rows: DataFrame, total: int, parts: int) -> np.ndarray:
    every = max(1, total // SAMPLE_BYTES)
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0)
    found = [sp.unpack(bytes(r["blob"]))[0] for r in sample.mapInArrow(_sampled_keys, PACKED).collect()]
    return sp.quantiles(np.concatenate(found) if found else np.zeros(0, np.uint64), parts)


def _dealer(split: np.ndarray):
    hot = sp.hot_keys(split)

    def deal(batches):
        for batch in sp.larger(batches):
            data, ends, counts = _word_bytes(batch)
            ids, marks = sp.columns_of(batch, "id", "mark")
            parts = list(_slices(data, ends, counts))
            if not parts:
                continue
            keys, _, begin, end = (np.concatenate([p[i] for p in parts]) for i in range(4))
            if not len(keys):
                continue
            doc = np.searchsorted(counts, begin, "right") - 1
            starts = np.concatenate(([0], ends + 1))
            is_hot = np.isin(keys, hot)
            for number, at in sp.by_group(sp.buckets_of(keys, marks[doc], split)):
                used, held = np.unique(doc[at], return_counts=True)
                low = starts[begin[at]]
                size = ends[end[at] + WINDOW - 1] + 1 - low
                blob = sp.pack(
                    ids[used],
                    marks[used],
                    held.astype(np.uint32),
                    sp.gaps(doc[at], begin[at] - counts[doc[at]]),
                    (end[at] - begin[at] + 1).astype(np.uint8),
                    is_hot[at].astype(np.uint8),
                    data[sp.ragged(low, size)],
                )
                yield sp.rows_batch(_PACKED, [(number, blob)])

    return deal


def _same_groups(payload, starts, ends, places, groups) -> np.ndarray:
    """Groups of equal windows from groups of equal fingerprints, by the words at their coordinates."""
    new = np.concatenate(([True], groups[1:] != groups[:-1]))
    numbers = np.cumsum(new) - 1
    low, size = starts[places], ends[places + WINDOW - 1] - starts[places]
    pairs = np.flatnonzero(~new)
    wrong = []
    for at in range(0, len(pairs), 1 << 14):
        p = pairs[at : at + (1 << 14)]
        same = size[p] == size[p - 1]
        wrong.append(p[~same])
        p = p[same]
        if len(p):
            differ = payload[sp.ragged(low[p], size[p])] != payload[sp.ragged(low[p - 1], size[p])]
            wrong.append(p[np.add.reduceat(differ, np.cumsum(size[p]) - size[p]) > 0])
    wrong = np.concatenate(wrong) if wrong else pairs
    if len(wrong):  # different windows with one fingerprint
        seen: dict[bytes, int] = {}
        numbers = numbers.copy()
        for i in np.flatnonzero(np.isin(numbers, np.unique(numbers[wrong]))):
            words = payload[low[i] : low[i] + size[i]].tobytes()
            numbers[i] = len(places) + seen.setdefault(words, len(seen))
    return numbers


def _match(batches):
    """Repeated edges of a bucket, neighbours with neighbouring first occurrences joined already."""
    blobs = [bytes(x) for batch in batches for x in batch.column(1).to_pylist()]
    if not blobs:
        return
    ids, marks, doc, start, windows, hot, payload, seen = [], [], [], [], [], [], [], 0
    for blob in blobs:
        a, b, c, d, e, f, g = sp.unpack(blob)
        ids.append(a), marks.append(b), doc.append(np.repeat(np.arange(seen, seen + len(a)), c)), start.append(sp.places_of(c, d))
        windows.append(e), hot.append(f), payload.append(g)
        seen += len(a)
    del blobs
    ids, marks, doc, start, hot, payload = map(np.concatenate, (ids, marks, doc, start, hot, payload))
    windows = np.concatenate(windows).astype(np.int64)
    ends = np.flatnonzero(payload == 32)
    starts = np.concatenate(([0], ends + 1))
    offset = np.cumsum(windows + WINDOW - 1) - (windows + WINDOW - 1)
    bits = np.uint64(max(22, len(ends).bit_length()))
    marked, at = [], 0
    while at < len(offset):
        stop = max(at + 1, int(np.searchsorted(offset, offset[at] + SLICE)))
        low, high = int(offset[at]), int(offset[stop - 1] + windows[stop - 1] + WINDOW - 1)
        hashes = sp.gram_hashes(_slice_hashes(payload, ends, low, high), WINDOW)
        places = sp.ragged(offset[at:stop], windows[at:stop])
        marked.append(hashes[places - low] >> bits << bits | places.astype(np.uint64))
        at = stop
    marked = np.concatenate(marked)
    marked.sort()
    high = marked >> bits
    twin = high[1:] == high[:-1]
    member = np.concatenate((twin, [False])) | np.concatenate(([False], twin))
    places = (marked[member] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    prints = high[member]
    gone = np.zeros(0, np.int64)
    if len(places):
        numbers = _same_groups(payload, starts, ends, places, prints)
        span = np.searchsorted(offset, places, "right") - 1
        owner, begin = ids[doc[span]], start[span] + places - offset[span]
        order = np.lexsort((begin, owner, numbers))
        places, numbers, span, owner, begin = places[order], numbers[order], span[order], owner[order], begin[order]
        heads = np.flatnonzero(np.concatenate(([True], numbers[1:] != numbers[:-1])))
        head = np.repeat(heads, np.diff(np.append(heads, len(numbers))))
        late = np.flatnonzero((owner != owner[head]) | (begin != begin[head]))
        gone = places[late]
        first_mark = marks[doc[span]]
        table = np.stack(
            [doc[span[late]], begin[late], owner[head[late]], first_mark[head[late]], begin[head[late]]], axis=1
        )
        table = table[np.lexsort((table[:, 1], table[:, 1] - table[:, 4], table[:, 3], table[:, 2], table[:, 0]))]
        if len(table):
            step = table[1:] - table[:-1]
            follows = (step[:, 0] == 0) & (step[:, 2] == 0) & (step[:, 3] == 0) & (step[:, 1] == 1) & (step[:, 4] == 1)
            at = np.flatnonzero(np.concatenate(([True], ~follows)))
            edges = np.diff(np.append(at, len(table)))
            table = table[at]
            for k in range(0, len(table), 1 << 15):
                t = table[k : k + (1 << 15)]
                own, mark = ids[t[:, 0]], marks[t[:, 0]]
                lane = np.zeros(len(t), np.uint64)
                for part in (own, mark, t[:, 2], t[:, 3], t[:, 1] - t[:, 4]):
                    lane = sp.mix(lane * sp.STEP + part.astype(np.uint64))
                values = [lane.view(np.int64), own, mark, t[:, 1], t[:, 1] + edges[k : k + (1 << 15)]]
                yield pa.RecordBatch.from_arrays([*[pa.array(v) for v in values], pa.nulls(len(t), pa.binary())], schema=_PATHS)
    if hot.any():
        chosen = np.flatnonzero(hot)
        left = np.setdiff1d(sp.ragged(offset[chosen], windows[chosen]), gone, assume_unique=True)
        span = np.searchsorted(offset, left, "right") - 1
        for k in range(0, len(left), 4096):
            p, q = left[k : k + 4096], span[k : k + 4096]
            grams = [payload[a:b].tobytes() for a, b in zip(starts[p].tolist(), ends[p + WINDOW - 1].tolist())]
            begin = start[q] + p - offset[q]
            values = [np.zeros(len(p), np.int64), ids[doc[q]], marks[doc[q]], begin, begin + 1]
            yield pa.RecordBatch.from_arrays([*[pa.array(v) for v in values], pa.array(grams, pa.binary())], schema=_PATHS)


def repeated_edges(rows: DataFrame, total: int, parts: int) -> DataFrame:
    """Stretches of repeated edges (lane, id, mark, start, end): edges start to end of a document come earlier elsewhere.

    A lane stands for the document, the place of the first occurrence and the distance between both.
    """
    split = _splitters(rows, total, parts)
    dealt = rows.mapInArrow(_dealer(split), PACKED).repartitionById(parts, "group")
    found = dealt.mapInArrow(_match, PATHS)
    if not len(sp.hot_keys(split)):
        return found.drop("gram")
    found = cut_lineage(found)
    first = F.min(F.struct("id", "start", "mark")).over(W.partitionBy("gram"))
    across = found.where("gram IS NOT NULL").withColumn("first", first)
    lane = F.xxhash64("id", "mark", "first.id", "first.mark", F.col("start") - F.col("first.start"))
    across = across.where((F.col("first.id") != F.col("id")) | (F.col("first.start") != F.col("start"))).withColumn("lane", lane)
    return found.where("gram IS NULL").drop("gram").unionByName(across.select("lane", "id", "mark", "start", "end"))


def compact(edges: DataFrame) -> DataFrame:
    """Nonbranching paths (id, mark, start, end): stretches of a lane joined where one ends and another starts.

    Spark meets the two ends on (lane, place): a start and an end at one place cancel out, as no path
    begins or ends there. What is left of a lane is starts and ends in turn, each start with the
    path's end behind it. One shuffle, by lane; a lane holds no more stretches than its document.
    """
    start = F.struct(F.col("start").alias("at"), F.lit(1).alias("sign"))
    end = F.struct(F.col("end").alias("at"), F.lit(-1).alias("sign"))
    places = edges.repartition("lane").select("lane", "id", "mark", F.explode(F.array(start, end)).alias("p"))
    joined = places.groupBy("lane", F.col("p.at").alias("at")).agg(
        F.first("id").alias("id"), F.first("mark").alias("mark"), F.sum("p.sign").alias("sign")
    )
    behind = F.lead("at").over(W.partitionBy("lane").orderBy("at"))
    return joined.where("sign <> 0").withColumn("end", behind).where("sign > 0").select("id", "mark", F.col("at").alias("start"), "end")


def _packer(groups: int):
    def pack_runs(batches):
        for batch in batches:
            ids, marks, start, end = sp.columns_of(batch, "id", "mark", "start", "end")
            for group, at in sp.by_group((marks.astype(np.uint64) % np.uint64(groups)).astype(np.int64)):
                yield sp.rows_batch(_PACKED, [(group, sp.pack(ids[at], marks[at], start[at], end[at] + WINDOW - 1))])

    return pack_runs


def _finish(batches):
    kind = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    rows = []
    for own, text, start, end in assemble(batches):
        words, kept, at = text.split(), [], 0
        for a, b in zip(start.tolist(), end.tolist()):
            kept += words[at:a]
            at = b
        kept += words[at:]
        digest = hashlib.sha256(b" ".join(kept)).hexdigest()
        rows.append((None if own == sp.LAST else own, len(words), len(words) - len(kept), digest))
        if len(rows) == 4096:
            yield sp.rows_batch(kind, rows)
            rows = []
    if rows:
        yield sp.rows_batch(kind, rows)


def de_bruijn_dedup(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per document: its words, how many are removed, and the sha256 of the rest joined by single spaces.

    Rows without doc_id count as one document after all others and are reported with a null id; rows
    that share an id and a text are equal and never remove one another's words. Null and blank texts
    have no words. Other columns are ignored. Each word joins at most 20 edges, so paths grow with the
    text that repeats, never with the square of a group of copies.
    """
    rows = keyed(docs)
    total = text_bytes(docs)
    parts = max(partitions(docs.sparkSession), -(-total // bucket_bytes), 1)
    paths = compact(repeated_edges(rows, total, parts)).select("id", "mark", "start", "end")
    runs = paths.mapInArrow(_packer(parts), PACKED).withColumn("is_text", F.lit(False))
    texts = rows.mapInArrow(pack_documents(parts), PACKED).withColumn("is_text", F.lit(True))
    together = texts.unionByName(runs).repartitionById(parts, "group").select("is_text", "blob")
    return together.mapInArrow(_finish, REPORT)


SUBSTRING_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
edges AS (
  SELECT doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') AS e
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM split WHERE len(w) >= 20)),
late AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY e ORDER BY doc_id, s) AS k FROM edges) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM late),
listed AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (
  SELECT split.doc_id, len(w) AS n, list_filter(w, lambda x, i: NOT list_contains(coalesce(ps, []), i)) AS k
  FROM split LEFT JOIN listed ON split.doc_id = listed.doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(k) AS BIGINT) AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256
FROM kept
"""
