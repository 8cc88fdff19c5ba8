"""Suffix-array dedup: bytes covered by a long string that an earlier document has too.

Suffixes are taken at the anchors of all windows (a sparse suffix array: every window of 50 bytes
holds the anchor it is compared at). Sampled splitters deal them by leading bytes to tasks; a task
takes its suffixes cell by cell, sorts, and compares neighbours character by character, a character
being eight bytes. Suffixes whose leading bytes are common are dealt by a longer context that each of
their windows holds; those whose context fills several tasks even so are compared once more across them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans as sp
from .common import cut_lineage, partitions, text_bytes

WINDOW = 50
LEAD = 9
"""Leading bytes of a suffix that decide its bucket; seven bits of each make the sort key."""

HALF = (WINDOW - LEAD + 1) // 2
CONTEXT = LEAD + HALF
"""Bytes around an anchor that all windows hold which start HALF or more before it, or all that start later."""

BUCKET_BYTES = 4 << 20
TASK_BUCKETS = 2
"""Buckets of text whose windows one task takes."""
GROUP_BUCKETS = 4
"""Buckets of text whose documents one task puts together."""
CELLS = 8
"""Parts of a task's windows that are matched one after another."""
ACROSS_BYTES = 16 << 20
"""Windows of hot suffixes that one task compares across buckets, in bytes."""

SAMPLE_BYTES = 4 << 20
SAMPLE_PART = 256
"""Of a large input one document in so many is sampled."""
SAMPLE_TASK = 512
"""Suffixes sampled for each task, about."""
COMMON = 4
"""Leading bytes that take more than one part in so many of a task are common."""
SAMPLE_KEYS = 1 << 15
"""Sort keys sampled from one Arrow batch of sampled documents at most."""

SLICE = 1 << 17
"""Windows handled at once, so that a very long text needs no more memory than a short one."""

_PRIMES = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)

MATCHED = "group int, blob binary, across boolean"
PACKED = "group int, blob binary"
REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_MATCHED = pa.schema([("group", pa.int32()), ("blob", pa.binary()), ("across", pa.bool_())])
_PACKED = pa.schema([("group", pa.int32()), ("blob", pa.binary())])


def keyed(docs: DataFrame) -> DataFrame:
    """id (null last), mark of the row and the text's bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(sp.LAST))).alias("id"),
        F.xxhash64("doc_id", text).alias("mark"),
        text.cast("binary").alias("text"),
    )


def ids_differ(docs: DataFrame) -> bool:
    """Whether no id is null and none comes twice."""
    counted = docs.groupBy(F.col("doc_id").cast("long").alias("id")).count()
    return counted.where(F.col("id").isNull() | (F.col("count") > 1)).isEmpty()


def _turned(values: np.ndarray, by: int) -> np.ndarray:
    return values << np.uint64(by) | values >> np.uint64(64 - by)


def id_marks(ids: np.ndarray) -> np.ndarray:
    """xxhash64 of each id, as Spark has it."""
    one, two, three, four, five = map(np.uint64, _PRIMES)
    found = np.full(len(ids), 42 + 8, np.uint64) + five
    found = _turned(found ^ (_turned(ids.astype(np.uint64) * two, 31) * one), 27) * one + four
    found = (found ^ (found >> np.uint64(33))) * two
    found = (found ^ (found >> np.uint64(29))) * three
    return (found ^ (found >> np.uint64(32))).view(np.int64)


def _slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Anchors and their runs of windows, none of which crosses two texts."""
    last = offsets[1:] - (WINDOW - 1)
    for at in range(0, len(data) - WINDOW + 1, SLICE):
        piece = data[at : at + SLICE + WINDOW - 1]
        first = np.maximum(offsets[:-1], at)
        valid = sp.ragged(first - at, np.maximum(np.minimum(last, at + SLICE) - first, 0))
        anchor, begin, end = sp.anchored(sp.gram_hashes(piece.astype(np.uint64) + np.uint64(1), LEAD), WINDOW - LEAD + 1, valid)
        yield anchor + at, begin + at, end + at


def _sort_keys(data: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    keys = np.zeros(len(anchors), np.uint64)
    for j in range(LEAD):
        keys = (keys << np.uint64(7)) | (data[anchors + j] & 127).astype(np.uint64)
    return keys


def _context_keys(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hash of the CONTEXT bytes at each place; of no meaning where the text ends before."""
    keys = np.zeros(len(places), np.uint64)
    for j in range(CONTEXT):
        at = np.clip(places + j, 0, len(data) - 1)
        keys = keys * sp.STEP + data[at].astype(np.uint64) + np.uint64(1)
    return sp.mix(keys) >> np.uint64(1)


def _halves(anchor: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many windows of each stretch start HALF or more before its anchor, and how many later."""
    early = np.clip(anchor - HALF + 1 - begin, 0, end - begin + 1)
    return early, end - begin + 1 - early


def _sampled_keys(stride: int):
    def sampled_keys(batches):
        for batch in batches:
            data, offsets = sp.texts_of(batch)
            for found in _slices(data, offsets):
                anchor, begin, end = (x[::stride] for x in found)
                if len(anchor):
                    early, late = (x.astype(np.uint8) for x in _halves(anchor, begin, end))
                    before, after = _context_keys(data, anchor - HALF), _context_keys(data, anchor)
                    yield sp.rows_batch(_PACKED, [(0, sp.pack(_sort_keys(data, anchor), before, after, early, late))])

    return sampled_keys


class Deal(NamedTuple):
    common: np.ndarray
    """Sort keys that are replaced by keys of a longer context."""
    split: np.ndarray
    """Splitters of all keys; one that repeats is hot."""
    hot_share: float
    """Part of all windows that lie at hot keys."""


def _weighted_splitters(keys: np.ndarray, weights: np.ndarray, parts: int) -> np.ndarray:
    """``parts`` - 1 splitters with equal weights between them."""
    order = np.argsort(keys, kind="stable")
    total = np.cumsum(weights[order])
    return keys[order][np.searchsorted(total, np.arange(1, parts) * (total[-1] / parts))]


def dealing(rows: DataFrame, total: int, parts: int) -> Deal:
    """Splitters by bytes sent, from a sample that grows with the number of tasks and not with their size."""
    every = max(1, min(total // SAMPLE_BYTES, SAMPLE_PART))
    stride = max(1, total // every // HALF // (SAMPLE_TASK * parts))
    sample = rows.where(F.pmod("mark", F.lit(every)) == 0)
    found = [sp.unpack(bytes(r["blob"])) for r in sample.mapInArrow(_sampled_keys(stride), PACKED).collect()]
    if not found:
        return Deal(np.zeros(0, np.uint64), np.zeros(0, np.uint64), 0.0)
    keys, before, after, early, late = (np.concatenate([f[i] for f in found]) for i in range(5))
    early, late = early.astype(np.int64), late.astype(np.int64)
    each, number = np.unique(keys, return_inverse=True)
    weights = np.bincount(number, early + late + WINDOW - 1)
    common = each[weights * (COMMON * parts) > weights.sum()]
    wide = np.isin(keys, common)
    chosen = [(keys, early + late, ~wide), (before, early, wide & (early > 0)), (after, late, wide & (late > 0))]
    keys, windows = (np.concatenate([x[i][x[2]] for x in chosen]) for i in range(2))
    split = _weighted_splitters(keys, windows + WINDOW - 1, parts)
    return Deal(common, split, float(windows[np.isin(keys, sp.hot_keys(split))].sum() / windows.sum()))


def _stretches(data: np.ndarray, offsets: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, first and last window of each stretch; stretches at common keys are cut in two with a key each."""
    parts = [x for x in _slices(data, offsets)]
    anchor, begin, end = (np.concatenate([p[i] for p in parts] or [np.zeros(0, np.int64)]) for i in range(3))
    del parts
    keys = _sort_keys(data, anchor)
    wide = np.isin(keys, common)
    if not wide.any():
        return keys, begin, end
    anchor, first, last = anchor[wide], begin[wide], end[wide]
    early, late = _halves(anchor, first, last)
    one, two = early > 0, late > 0
    keys = np.concatenate((keys[~wide], _context_keys(data, anchor[one] - HALF), _context_keys(data, anchor[two])))
    begin = np.concatenate((begin[~wide], first[one], (first + early)[two]))
    end = np.concatenate((end[~wide], (first + early - 1)[one], last[two]))
    order = np.argsort(begin, kind="stable")
    return keys[order], begin[order], end[order]


def _dealer(common: np.ndarray, split: np.ndarray):
    hot = sp.hot_keys(split)

    def deal(batches):
        for batch in sp.larger(batches):
            data, offsets = sp.texts_of(batch)
            ids, marks = sp.columns_of(batch, "id", "mark")
            keys, begin, end = _stretches(data, offsets, common)
            if not len(keys):
                continue
            doc = np.searchsorted(offsets, begin, "right") - 1
            is_hot = np.isin(keys, hot)
            bucket = sp.buckets_of(keys, marks[doc], split)
            # A cell has all windows of a key, but a hot one's lie in the cells of their documents.
            cell = np.where(is_hot, marks[doc].astype(np.uint64) >> np.uint64(40), sp.mix(keys)) % np.uint64(CELLS)
            flags = cell.astype(np.uint8) * np.uint8(2) + is_hot.astype(np.uint8)
            del keys, is_hot, cell
            for number, at in sp.by_group(bucket):
                used, counts = np.unique(doc[at], return_counts=True)
                windows = end[at] - begin[at] + 1
                blob = sp.pack(
                    ids[used],
                    marks[used] ^ id_marks(ids[used]),  # zeros where ids differ
                    counts.astype(np.uint32),
                    sp.gaps(doc[at], begin[at] - offsets[doc[at]]),
                    windows.astype(np.uint8),
                    flags[at],
                    data[sp.ragged(begin[at], windows + WINDOW - 1)],
                )
                yield sp.rows_batch(_PACKED, [(number, blob)])

    return deal


def _same_groups(payload: np.ndarray, places: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Groups of equal windows, from groups of equal fingerprints: neighbours are compared by characters.

    Characters are the eight-byte words of the window. A group whose neighbours all agree stays; one
    that differs is sorted by its characters, one after another, and cut where they change.
    """
    words = np.ndarray((len(payload) - 7,), np.uint64, payload, 0, (1,))
    steps = [*range(0, WINDOW - 8, 8), WINDOW - 8]
    new = np.concatenate(([True], groups[1:] != groups[:-1]))
    wrong = np.zeros(len(places), bool)
    for at in range(0, len(places), SLICE):
        here = places[at : at + SLICE + 1]
        differ = np.zeros(len(here) - 1, bool)
        for step in steps:
            characters = words[here + step]
            differ |= characters[1:] != characters[:-1]
        wrong[at + 1 : at + len(here)] = differ & ~new[at + 1 : at + len(here)]
    numbers = np.cumsum(new) - 1
    if wrong.any():
        redo = np.isin(numbers, np.unique(numbers[wrong]))
        at = np.flatnonzero(redo)
        order = np.lexsort([words[places[at] + s] for s in reversed(steps)] + [numbers[at]])
        at = at[order]
        cut = np.concatenate(([True], numbers[at][1:] != numbers[at][:-1]))
        for step in steps:
            characters = words[places[at] + step]
            cut[1:] |= characters[1:] != characters[:-1]
        numbers = numbers.copy()
        numbers[at] = len(places) + np.cumsum(cut)
    return numbers


def _gathered(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches one after another, and eight bytes more."""
    ends = np.cumsum(sizes)
    out, at = np.zeros((int(ends[-1]) if len(ends) else 0) + 8, np.uint8), 0
    while at < len(starts):
        low = ends[at] - sizes[at]
        stop = max(at + 1, int(np.searchsorted(ends, low + SLICE)))
        out[low : ends[stop - 1]] = text[sp.ragged(starts[at:stop], sizes[at:stop])]
        at = stop
    return out


def _prints(text: np.ndarray, offset: np.ndarray, windows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Fingerprints of the windows of stretches and their places, a slice at a time."""
    at = 0
    while at < len(offset):
        stop = max(at + 1, int(np.searchsorted(offset, offset[at] + SLICE)))
        low, high = offset[at], offset[stop - 1] + windows[stop - 1] + WINDOW - 1
        places = sp.ragged(offset[at:stop], windows[at:stop])
        yield sp.gram_hashes(text[low:high].astype(np.uint64) + np.uint64(1), WINDOW)[places - low], places
        at = stop


def _late(text: np.ndarray, offset: np.ndarray, windows: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether the window at each place has an equal one whose owner is smaller; ``text`` as ``_gathered`` gives it.

    Takes eight bytes a window and a flag a byte of text; all else is done for about SLICE windows at
    once, and for the windows of one fingerprint together.
    """
    bits = np.uint64(max(24, len(text).bit_length()))
    low_bits = (np.uint64(1) << bits) - np.uint64(1)
    marked, at = np.empty(int(windows.sum()), np.uint64), 0
    for prints, places in _prints(text, offset, windows):
        marked[at : at + len(places)] = prints >> bits << bits | places.astype(np.uint64)
        at += len(places)
    marked.sort()
    late, at = np.zeros(len(text), bool), 0
    while at < len(marked):
        stop = int(np.searchsorted(marked, marked[min(at + SLICE, len(marked)) - 1] | low_bits, "right"))
        part, at = marked[at:stop], stop
        prints = part >> bits
        twin = prints[1:] == prints[:-1]
        member = np.concatenate((twin, [False])) | np.concatenate(([False], twin))
        places = (part[member] & low_bits).astype(np.int64)
        if not len(places):
            continue
        numbers = _same_groups(text, places, prints[member])
        order = np.argsort(numbers, kind="stable")
        places, numbers = places[order], numbers[order]
        own = owner[np.searchsorted(offset, places, "right") - 1]
        starts = np.flatnonzero(np.concatenate(([True], numbers[1:] != numbers[:-1])))
        least = np.repeat(np.minimum.reduceat(own, starts), np.diff(np.append(starts, len(numbers))))
        late[places[own > least]] = True
    return late


def _opened(batches) -> tuple[np.ndarray, ...] | None:
    """Ids and marks of documents; document, start, windows, flags and text of stretches."""
    ids, marks, doc, start, windows, flags, text, seen = [], [], [], [], [], [], bytearray(), 0
    for batch in batches:
        for blob in batch.column(1):
            a, b, c, d, e, f, g = sp.unpack(blob.as_py())
            ids.append(a), marks.append(b ^ id_marks(a)), doc.append(np.repeat(np.arange(seen, seen + len(a), dtype=np.int32), c))
            start.append(sp.places_of(c, d)), windows.append(e.copy()), flags.append(f.copy())
            text.extend(g.data)  # grows in place: the text is never held twice
            seen += len(a)
    return (*map(np.concatenate, (ids, marks, doc, start, windows, flags)), np.frombuffer(text, np.uint8)) if ids else None


def _matcher(groups: int, across: int):
    def match(batches):
        found = _opened(batches)
        if found is None:
            return
        ids, marks, doc, start, windows, flags, text = found
        del found
        sizes = windows.astype(np.int64) + (WINDOW - 1)
        begin = np.cumsum(sizes) - sizes
        runs = []
        for _, at in sp.by_group(flags >> 1):  # cell by cell
            payload, own, place, length = _gathered(text, begin[at], sizes[at]), doc[at], start[at], windows[at].astype(np.int64)
            offset = np.cumsum(sizes[at]) - sizes[at]
            gone = _late(payload, offset, length, ids[own])
            places = np.flatnonzero(gone)
            for k in range(0, len(places), SLICE):
                some = places[k : k + SLICE]
                span = np.searchsorted(offset, some, "right") - 1
                first = place[span] + some - offset[span]
                runs.append(sp.covered_runs(own[span], first, first + WINDOW))
            chosen = np.flatnonzero(flags[at] & 1)
            if not len(chosen):
                continue
            left, goal = [], []
            for prints, some in _prints(payload, offset[chosen], length[chosen]):
                left.append(some[~gone[some]])
                goal.append((prints[~gone[some]] % np.uint64(across)).astype(np.int32))
            left, goal = np.concatenate(left), np.concatenate(goal)
            for group, some in sp.by_group(goal):
                some = left[some]
                span = np.searchsorted(offset, some, "right") - 1
                grams = payload[some[:, None] + np.arange(WINDOW)].reshape(-1)
                first = place[span] + some - offset[span]
                yield sp.rows_batch(_MATCHED, [(group, sp.pack(ids[own[span]], marks[own[span]], first, grams), True)])
        del text
        if runs:
            d, s, e = sp.covered_runs(*(np.concatenate(x) for x in zip(*runs)))
            for group, at in sp.by_group((marks[d].astype(np.uint64) % np.uint64(groups)).astype(np.int64)):
                yield sp.rows_batch(_MATCHED, [(group, sp.pack(ids[d[at]], marks[d[at]], s[at], e[at]), False)])

    return match


def _across(groups: int):
    """The last compare: survivors of hot suffixes from all their buckets, equal windows side by side."""

    def compare(batches):
        found = [sp.unpack(bytes(x)) for batch in batches for x in batch.column(1).to_pylist()]
        if not found:
            return
        ids, marks, start = (np.concatenate([f[i] for f in found]) for i in range(3))
        grams = np.concatenate([f[3] for f in found] + [np.zeros(8, np.uint8)])
        del found
        offset = np.arange(len(ids)) * WINDOW
        late = np.flatnonzero(_late(grams, offset, np.ones(len(ids), np.int64), ids)[offset])
        for group, at in sp.by_group((marks[late].astype(np.uint64) % np.uint64(groups)).astype(np.int64)):
            at = late[at]
            yield sp.rows_batch(_PACKED, [(group, sp.pack(ids[at], marks[at], start[at], start[at] + WINDOW))])

    return compare


def pack_documents(groups: int):
    """Texts packed by group of documents; fewer, larger rows than one per document."""

    def pack_texts(batches):
        for batch in sp.larger(batches):
            data, offsets = sp.texts_of(batch)
            ids, marks = sp.columns_of(batch, "id", "mark")
            for group, at in sp.by_group((marks.astype(np.uint64) % np.uint64(groups)).astype(np.int64)):
                lengths = offsets[at + 1] - offsets[at]
                yield sp.rows_batch(_PACKED, [(group, sp.pack(ids[at], marks[at], lengths, data[sp.ragged(offsets[at], lengths)]))])

    return pack_texts


def assemble(batches) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray]]:
    """(id, text, starts, ends) of each document of a group, from its texts and the runs found in them."""
    texts, runs = [], []
    for batch in batches:
        kinds, blobs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for kind, blob in zip(kinds, blobs):
            (texts if kind else runs).append(blob)
    found = [sp.unpack(b) for b in runs]
    ids, marks, start, end = (
        (np.concatenate([f[i] for f in found]).astype(np.int64) if found else np.zeros(0, np.int64)) for i in range(4)
    )
    order = np.lexsort((marks, ids))
    ids, marks, start, end = ids[order], marks[order], start[order], end[order]
    cut = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])))) if len(ids) else np.zeros(0, np.int64)
    number = np.searchsorted(cut, np.arange(len(ids)), "right") - 1
    g, s, e = sp.covered_runs(number, start, end)
    bounds = np.searchsorted(g, np.arange(len(cut) + 1))
    known = {(int(ids[c]), int(marks[c])): k for k, c in enumerate(cut)}
    for blob in texts:
        own, mark, lengths, data = sp.unpack(blob)
        ends = np.cumsum(lengths)
        for i in range(len(own)):
            k = known.get((int(own[i]), int(mark[i])))
            low, high = (bounds[k], bounds[k + 1]) if k is not None else (0, 0)
            yield int(own[i]), data[ends[i] - lengths[i] : ends[i]].tobytes(), s[low:high], e[low:high]


def _finish(batches):
    rows = []
    kind = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    )
    for own, text, start, end in assemble(batches):
        digest, at = hashlib.sha256(), 0
        for a, b in zip(start.tolist(), end.tolist()):
            digest.update(text[at:a])
            at = b
        digest.update(text[at:])
        rows.append((None if own == sp.LAST else own, len(text), int((end - start).sum()), len(start), digest.hexdigest()))
        if len(rows) == 4096:
            yield sp.rows_batch(kind, rows)
            rows = []
    if rows:
        yield sp.rows_batch(kind, rows)


def duplicate_runs(rows: DataFrame, total: int, parts: int, groups: int) -> DataFrame:
    """(group, blob) of the runs to remove, blobs of ids, marks, starts and ends; ``rows`` as ``keyed`` gives them."""
    deal = dealing(rows, total, parts)
    across = max(parts, int(deal.hot_share * total * WINDOW) // ACROSS_BYTES)
    dealt = rows.mapInArrow(_dealer(deal.common, deal.split), PACKED).repartitionById(parts, "group")
    matched = dealt.mapInArrow(_matcher(groups, across), MATCHED)
    if not len(sp.hot_keys(deal.split)):
        return matched.select("group", "blob")
    matched = cut_lineage(matched)
    left = matched.where("across").select("group", "blob").repartitionById(across, "group").mapInArrow(_across(groups), PACKED)
    return matched.where("not across").select("group", "blob").unionByName(left)


def suffix_dedup(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per document: its bytes, how many are removed, in how many runs, and the sha256 of the rest.

    Rows with one doc_id are one document, which does not repeat itself; documents without id come
    after all others and are reported with a null id. Null and empty texts have no bytes. Other columns
    are ignored. Where all ids differ a row is named by its id alone, else by its text too. Tasks grow in
    number with the input, not in size; a string shared by most documents fills several of them, each of
    which keeps one survivor per string for the last compare.
    """
    rows = keyed(docs)
    if ids_differ(docs):
        rows = rows.withColumn("mark", F.xxhash64("id"))
    total = text_bytes(docs)
    parts, groups = (max(partitions(docs.sparkSession), -(-total // (bucket_bytes * n)), 1) for n in (TASK_BUCKETS, GROUP_BUCKETS))
    runs = duplicate_runs(rows, total, parts, groups).withColumn("is_text", F.lit(False))
    texts = rows.mapInArrow(pack_documents(groups), PACKED).withColumn("is_text", F.lit(True))
    together = texts.unionByName(runs).repartitionById(groups, "group").select("is_text", "blob")
    return together.mapInArrow(_finish, REPORT)
