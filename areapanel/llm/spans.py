"""Packed exchanges for operators that compare every window of every text.

A window is compared in the bucket of its anchor: the k-gram with the least hash inside the window,
leftmost on ties. Equal windows have equal anchors, so each window needs to travel once, and the
windows that share an anchor travel together as one short stretch of text. Stretches go to buckets
by the anchor's leading bytes, between splitters that a sample gives; a splitter that the sample
repeats marks a hot anchor, whose stretches are spread over several buckets by document.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

U64 = np.uint64
MIX = U64(0x9E3779B97F4A7C15)
STEP = U64(0xD6E8FEB86659FD93)
LAST = np.iinfo(np.int64).max
"""Stands for a null id, so that documents without id come after all others."""

BLOB = pa.binary()


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> U64(32))) * MIX
    return values ^ (values >> U64(29))


def chain(first: np.ndarray, second: np.ndarray, ahead: int) -> np.ndarray:
    """Polynomial hash of a sequence from those of its halves, the second ``ahead`` places on."""
    n = max(0, len(second) - ahead)
    out = first[:n] * U64(pow(int(STEP), ahead, 1 << 64))
    out += second[ahead : ahead + n]
    return out


def gram_hashes(units: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive units at every place, built from halves."""
    powers, length, level = [], 1, units
    while length <= size:
        powers.append((length, level))
        level, length = chain(level, level, length), 2 * length
    done, out = 0, None
    for length, level in reversed(powers):
        if size & length:
            out = level if out is None else chain(out, level, done)
            done += length
    return mix(out)


def sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    """Least of ``size`` consecutive values at every place."""
    length, level = 1, values
    while 2 * length <= size:
        level, length = np.minimum(level[:-length], level[length:]), 2 * length
    rest = size - length
    return np.minimum(level[: len(level) - rest], level[rest:]) if rest else level


def anchored(grams: np.ndarray, width: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches (anchor, first window, last window) of the windows listed in ``valid``, in order.

    ``width`` is the number of anchor places in a window.
    """
    if not len(valid):
        none = np.zeros(0, np.int64)
        return none, none, none
    ranked = (grams >> U64(32) << U64(32)) | np.arange(len(grams), dtype=U64)
    anchor = (sliding_least(ranked, width)[valid] & U64(0xFFFFFFFF)).astype(np.int64)
    cuts = np.flatnonzero((anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)) + 1
    first = np.concatenate(([0], cuts))
    last = np.concatenate((cuts, [len(valid)])) - 1
    return anchor[first], valid[first], valid[last]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all stretches one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat((starts - (ends - lengths)).astype(np.int64), lengths)
    return shift + np.arange(total, dtype=np.int64)


def buckets_of(keys: np.ndarray, marks: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """Bucket of each anchor; keys equal to a repeated splitter are spread by document."""
    low, high = np.searchsorted(splitters, keys, "left"), np.searchsorted(splitters, keys, "right")
    spread = np.maximum(high - low, 1)
    return high - (marks.astype(U64) % spread.astype(U64)).astype(np.int64) * (spread > 1)


def hot_keys(splitters: np.ndarray) -> np.ndarray:
    return np.unique(splitters[1:][splitters[1:] == splitters[:-1]]) if len(splitters) > 1 else splitters[:0]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; numbers are stored byte plane by byte plane."""
    parts = [np.ascontiguousarray(a) for a in arrays]
    head = b"".join(struct.pack("<cq", p.dtype.char.encode(), p.nbytes) for p in parts)
    body = b"".join((p.view(np.uint8).reshape(-1, p.itemsize).T if p.itemsize > 1 else p).tobytes() for p in parts)
    return zstandard.ZstdCompressor(level=3).compress(bytes([len(parts)]) + head + body)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 1 + 9 * raw[0], []
    for i in range(raw[0]):
        kind, size = struct.unpack_from("<cq", raw, 1 + 9 * i)
        dtype = np.dtype(kind.decode())
        plain = np.frombuffer(raw, np.uint8, size, at)
        if dtype.itemsize > 1:
            plain = np.ascontiguousarray(plain.reshape(dtype.itemsize, -1).T).reshape(-1)
        out.append(plain.view(dtype))
        at += size
    return out


def larger(batches: Iterator[pa.RecordBatch], most: int = 12 << 20) -> Iterator[pa.RecordBatch]:
    """Batches put together up to about ``most`` bytes, so that what is packed from one compresses well."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def gaps(owners: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Ascending places of each owner as distances to the one before."""
    out = np.diff(places, prepend=0)
    first = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1])))
    out[first] = places[first]
    return out.astype(np.uint32) if not len(out) or out.max() < 1 << 32 else out


def places_of(counts: np.ndarray, distances: np.ndarray) -> np.ndarray:
    """The places behind ``gaps``, from the number of places of each owner."""
    total = np.cumsum(distances.astype(np.int64))
    before = np.concatenate(([0], total))[np.cumsum(counts) - counts]
    return total - np.repeat(before, counts)


def columns_of(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]


def texts_of(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins and the last ends."""
    column = batch.column(batch.schema.get_field_index(name))
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(column) else np.zeros(0, np.uint8)
    return data, (offsets - offsets[0] if len(column) else np.zeros(1, np.int64))


def by_group(groups: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each group with the places of its rows, in their order."""
    if not len(groups):
        return
    order = np.argsort(groups, kind="stable")
    sorted_ = groups[order]
    cuts = np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1
    for part in np.split(order, cuts):
        yield int(groups[part[0]]), part


def rows_batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], type=field.type) for i, field in enumerate(schema)], schema=schema
    )


def quantiles(sample: np.ndarray, parts: int) -> np.ndarray:
    """``parts`` - 1 splitters; fewer distinct keys than parts repeat."""
    sample = np.sort(sample)
    if not len(sample):
        return sample
    return sample[(np.arange(1, parts) * len(sample)) // parts]


def covered_runs(groups: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches merged where they touch or overlap, group by group; ``groups`` are small numbers."""
    order = np.lexsort((starts, groups))
    g, s, e = groups[order], starts[order], ends[order]
    if not len(g):
        return g, s, e
    shift = g.astype(np.int64) << 40  # no text has so many units
    reach = np.maximum.accumulate(e + shift)
    new = np.concatenate(([True], (s + shift)[1:] > reach[:-1]))
    at = np.flatnonzero(new)
    last = np.concatenate((at[1:], [len(g)])) - 1
    return g[at], s[at], reach[last] - shift[at]
