"""Packing token ids into sequences with a bounded number of open windows.

Each input partition keeps a fixed number of windows open. A document's full stretches are sequences
at once; its tail goes whole to the open window it fits best, and when none fits, the fullest
window is emitted. What is open at a partition's end is merged afterwards, some partitions at a time,
until one window is left.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import spans as sp
from . import tokens as tk
from .common import cut_lineage

SEQUENCE = 1024
OPEN = 256
"""Windows a partition keeps open, so that at most OPEN * SEQUENCE ids wait in a task."""

FAN = 32
"""Partitions whose leftovers are merged in one task."""

END = 0
"""Id after each document."""

CHUNKS = 1 << 19
"""Chunks of text whose ids a task remembers; then it begins anew."""

CHUNK_BYTES = 64
"""Longer chunks are not remembered."""

JOINED = 64
"""Chunks given to the tokenizer as one text."""

GRAPH = tk.byte_class((0x21, 0x7E))
SPACE = tk.byte_class((0x09, 0x0D), (0x20, 0x20))
PIECES = "part long, place long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
_PIECES = pa.schema(
    [(name, pa.int64()) for name in ("part", "place", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.binary())]
)
REPORT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts can be cut without changing their ids: before ASCII white space that follows a
    printable ASCII character or one of U+00C0 to U+00FF.

    The tokenizer's pattern never joins white space to a character before it and looks ahead only past
    white space, and no merge crosses a match of the pattern.
    """
    cut = np.zeros(len(data), bool)
    after = GRAPH[data]
    after[1:] |= data[:-1] == 0xC3
    cut[1:] = SPACE[data[1:]] & after[:-1]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Ids of many texts; each different chunk is given to the tokenizer once while it is remembered."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.known = Tokenizer.from_file(vocabulary), {}
        names = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(names.values()) + 1, np.int64)
        self.n_bytes[list(names.values())] = [len(name) for name in names]  # a character of a name is a byte of text

    def encode(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each chunk. Chunks that may follow one another go in one text, whose ids are split by their bytes."""
        texts = [b"".join(chunks[at : at + JOINED]).decode() for at in range(0, len(chunks), JOINED)]
        found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        ids = np.concatenate(found) if found else np.zeros(0, np.uint32)
        ends = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum([len(c) for c in chunks])) + 1 if chunks else []
        packed, cuts = ids.tobytes(), [0, *(4 * np.asarray(ends, np.int64)).tolist()]
        return [packed[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def chunk_ids(self, chunks: list[bytes]) -> list[bytes]:
        if len(self.known) > CHUNKS:
            self.known.clear()
        out = [self.known.get(c) for c in chunks]
        missing = [i for i, ids in enumerate(out) if ids is None]
        inner = [i for i in missing if chunks[i][:1] == b" " and 0x21 <= chunks[i][-1] <= 0x7E]
        for i, ids in zip(inner, self.encode([chunks[i] for i in inner])):
            out[i] = ids
        for i in missing:
            if out[i] is None:
                out[i] = np.array(self.tokenizer.encode(chunks[i].decode(), add_special_tokens=False).ids, np.uint32).tobytes()
            if len(chunks[i]) <= CHUNK_BYTES:
                self.known[chunks[i]] = out[i]
        return out

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each followed by END, and where each begins."""
        starts = chunk_starts(data, offsets)
        code, chunks = tk.numbered(tk.strings(data, np.diff(starts, append=len(data))))
        pool = self.chunk_ids(chunks.to_pylist())
        sizes = np.array([len(ids) >> 2 for ids in pool], np.int64)
        ids = np.frombuffer(b"".join(pool), np.uint32)[sp.ragged((np.cumsum(sizes) - sizes)[code], sizes[code])]
        owner = np.repeat(tk.owners(offsets, starts), sizes[code])
        counts = np.bincount(owner, minlength=len(offsets) - 1) + 1
        out = np.full(len(ids) + len(offsets) - 1, END, np.uint32)
        out[np.arange(len(ids)) + owner] = ids
        return out, np.concatenate(([0], np.cumsum(counts)))


class Windows:
    """Open windows by the room left in them."""

    def __init__(self, size: int, most: int) -> None:
        self.size, self.most = size, most
        self.rooms: list[int] = []  # room of every open window, ascending
        self.held: dict[int, list[list]] = {}  # windows by room

    def _take(self, at: int) -> list:
        room = self.rooms.pop(at)
        window = self.held[room].pop()
        return window

    def place(self, piece: tuple, length: int) -> list[list]:
        """Put a piece where it fits best; gives back the windows that leave."""
        gone = []
        at = bisect_left(self.rooms, length)
        if at < len(self.rooms):
            room = self.rooms[at]
            window = self._take(at)
        else:
            if len(self.rooms) >= self.most:
                gone.append(self._take(0))
            room, window = self.size, []
        window.append(piece)
        if room == length:
            gone.append(window)
        else:
            insort(self.rooms, room - length)
            self.held.setdefault(room - length, []).append(window)
        return gone

    def rest(self) -> Iterator[list]:
        while self.rooms:
            yield self._take(0)


class Rows:
    """Rows of pieces, passed on in batches. A sequence's number holds the round, the partition and a count."""

    def __init__(self, turn: int, part: int) -> None:
        self.base, self.part, self.count, self.rows = (turn << 56) | (part << 32), part, 0, []

    def sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, tokens, ids in pieces:
            length = len(ids) >> 2
            self.rows.append((self.part, None, doc_id, start, length, zlib.crc32(ids), tokens, self.base + self.count, offset, None))
            offset += length
        self.count += 1

    def leftover(self, place: int, piece: tuple) -> None:
        doc_id, start, tokens, ids = piece
        self.rows.append((self.part, place, doc_id, start, len(ids) >> 2, None, tokens, None, None, ids))

    def full(self) -> bool:
        return len(self.rows) >= 4096

    def passed_on(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return sp.rows_batch(_PIECES, rows)


def _pack(vocabulary: str, size: int, most: int):
    def run(batches):
        encoder, windows, rows = Encoder(vocabulary), Windows(size, most), Rows(0, TaskContext.get().partitionId())
        for batch in sp.larger(batches):
            ids, begins = encoder.documents(*sp.texts_of(batch))
            for doc_id, begin, end in zip(batch.column(0).to_pylist(), begins[:-1].tolist(), begins[1:].tolist()):
                tokens = end - begin
                whole = tokens - tokens % size
                for start in range(0, whole, size):
                    rows.sequence([(doc_id, start, tokens, ids[begin + start : begin + start + size].tobytes())])
                    if rows.full():
                        yield rows.passed_on()
                if whole < tokens:
                    for window in windows.place((doc_id, whole, tokens, ids[begin + whole : end].tobytes()), tokens - whole):
                        rows.sequence(window)
                if rows.full():
                    yield rows.passed_on()
        for place, piece in enumerate(p for window in windows.rest() for p in window):
            rows.leftover(place, piece)
        yield rows.passed_on()

    return run


def _merge(turn: int, size: int, last: bool):
    """The leftovers of a group of partitions in a row, cut where a sequence is full."""

    def run(batches):
        rows, held, room = None, [], size

        def ended():
            if last and held:
                rows.sequence(held)
            elif not last:
                for place, piece in enumerate(held):
                    rows.leftover(place, piece)
            return rows.passed_on()

        for batch in batches:
            for group, doc_id, start, tokens, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if rows is None or rows.part != group:
                    if rows is not None:
                        yield ended()
                    rows, held, room = Rows(turn, group), [], size
                while ids:
                    head, ids = ids[: 4 * room], ids[4 * room :]
                    held.append((doc_id, start, tokens, head))
                    start, room = start + (len(head) >> 2), room - (len(head) >> 2)
                    if not room:
                        rows.sequence(held)
                        held, room = [], size
                if rows.full():
                    yield rows.passed_on()
        if rows is not None:
            yield ended()

    return run


def pack(docs: DataFrame, vocabulary: str | None = None, size: int = SEQUENCE, most: int = OPEN) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece.

    A document's ids are those of the tokenizer in file ``vocabulary`` and END; a null text is empty
    and has END alone. Every row is a document, repeated ones too; null ids stay null; other columns
    are ignored; an empty table gives no rows. Full stretches of a document are sequences of
    their own, its tail is one piece, cut only if it is among the leftovers. Of all sequences made
    from leftovers, one is shorter than ``size``.

    The partitions' leftovers, at most ``most`` windows each, go by FAN partitions to a task, where
    they are laid end to end; each round leaves one window a task, so rounds grow with the logarithm
    of the partitions. What a partition packs is written before its leftovers are merged, so a
    task that runs again cannot pair new windows with old leftovers.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    stage = cut_lineage(rows.mapInArrow(_pack(vocabulary, size, most), PIECES))
    closed, turn = stage.where("sequence_id IS NOT NULL").select(*REPORT), 1
    while True:
        waiting = stage.where("sequence_id IS NULL")
        parts = waiting.agg(F.max("part")).first()[0]
        if parts is None:
            return closed
        groups = parts // FAN + 1
        merged = (
            waiting.withColumn("group", F.floor(F.col("part") / FAN).cast("long"))
            .repartition(groups, "group")
            .sortWithinPartitions("group", "part", "place")
            .select("group", "doc_id", "start", "doc_tokens", "ids")
            .mapInArrow(_merge(turn, size, groups == 1), PIECES)
        )
        stage, turn = cut_lineage(merged), turn + 1
        closed = closed.unionByName(stage.where("sequence_id IS NOT NULL").select(*REPORT))
