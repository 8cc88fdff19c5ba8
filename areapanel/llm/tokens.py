"""Words of many texts at once: byte classes by table, words as one Arrow array, no loop over characters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import spans as sp


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """256 flags, true inside the given ranges (both ends included)."""
    flags = np.zeros(256, bool)
    for first, last in ranges:
        flags[first : last + 1] = True
    return flags


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
"""Lower-cases A-Z only; bytes of longer characters stay."""


def word_spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each stretch of ``inside`` bytes; none crosses from one text into the next."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.empty(len(inside), bool)
    first[0] = True
    np.logical_not(inside[:-1], out=first[1:])
    first[offsets[:-1][offsets[:-1] < len(inside)]] = True
    starts = np.flatnonzero(first & inside)
    last = np.empty(len(inside), bool)
    last[-1] = True
    np.logical_not(inside[1:], out=last[:-1])
    last[offsets[1:][offsets[1:] > 0] - 1] = True
    return starts, np.flatnonzero(last & inside) + 1


def words_array(data: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as one Arrow array over the bytes inside them."""
    return strings(data[inside], ends - starts)


def strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Byte strings of the given lengths, one after another in ``data``."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )


def buffers_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings and their lengths."""
    data, offsets = sp.texts_of(pa.RecordBatch.from_arrays([array], names=["text"]))
    return data, np.diff(offsets)


def numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of each word, and the distinct words in order of number."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def owners(offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Number of the text that each place lies in."""
    return np.searchsorted(offsets, starts, "right") - 1
