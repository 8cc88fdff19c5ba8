"""LM scoring by the subword lattice: the likelihood of a text over all segmentations of its words.

The pieces come from an existing vocabulary, whose scores weigh the segmentations of the training words
once; the expected counts of that pass are the pieces' probabilities.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import spans as sp
from .common import cut_lineage, partitions, text_bytes
from .lattice import MARK, STOP, Lattice, Pieces, edges, endings, forward  # noqa: F401
from .suffix_dedup import PACKED, keyed, pack_documents

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
FOLDS, HELD_OUT = 7, 2
BLOCK_BYTES = 16 << 20
"""Text of one block: documents that ask for their words together."""

END = b" "
"""The end of a text among the words; no word holds a space."""

REPORT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)
_REPORT = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)
_COUNTS = pa.schema([("word", pa.binary()), ("n", pa.int64())])
_ASKED = pa.schema([("group", pa.int32()), ("word", pa.binary())])


def held_out(doc_id: int) -> bool:
    return doc_id != sp.LAST and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def read_vocabulary(path: str = VOCABULARY) -> Pieces:
    """Natural logarithms of the weights that an existing vocabulary's scores give its pieces.

    The scores of a merge vocabulary are negative ranks; a rank r weighs 1 / (r + 1). Bytes and the end
    of a text come last. Pieces with an inner word mark are left out, as words are scored one by one.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces: Pieces = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)):
            piece = model.id_to_piece(i)
            if MARK not in piece[1:]:
                pieces[piece] = -math.log(1.0 + abs(model.get_score(i)))
    last = min(pieces.values(), default=0.0)
    pieces |= {f" <0x{b:02X}>": last for b in range(256)} | {STOP: 0.0}
    return pieces


HELD_WORDS = 1 << 17
"""Distinct words a task holds before it passes its counts on."""


def _count_words(batches):
    """Words of all texts, with how often the training texts have them; words and ends."""
    learned: Counter = Counter()

    def passed_on():
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(learned), pa.binary()), pa.array(list(learned.values()), pa.int64())], schema=_COUNTS
        )
        learned.clear()
        return out

    for batch in batches:
        ids, texts = sp.columns_of(batch, "id")[0], batch.column(batch.schema.get_field_index("text"))
        for own, text in zip(ids.tolist(), texts):
            words = text.as_py().lower().split()
            if held_out(own):
                for word in words:
                    learned.setdefault(word, 0)
            else:
                learned.update(words)
                learned[END] += 1
        if len(learned) > HELD_WORDS:
            yield passed_on()
    if learned:
        yield passed_on()


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n): every word of the texts and the end, with its number in the training texts."""
    return rows.select("id", "text").mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def learned_pieces(words: DataFrame, vocabulary: Pieces) -> Pieces:
    """Natural logarithms of the pieces' probabilities from their expected counts in the training words.

    What comes back is bounded by the vocabulary. Each piece starts with a count of one.
    """
    lattice = Lattice(vocabulary)

    def expect(batches):
        counts, others = np.zeros(len(lattice.names)), Counter()
        for batch in batches:
            words, times = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            of_ends = pc.equal(words, pa.scalar(END, words.type)).to_numpy(zero_copy_only=False)
            others[STOP] += float(times[of_ends].sum())
            texts = [w.decode(errors="replace") for w in words.filter(pa.array(~of_ends)).to_pylist()]
            lattice.expected(texts, times[~of_ends], counts, others)
        for at in np.flatnonzero(counts).tolist():
            others[lattice.names[at]] += float(counts[at])
        yield pa.RecordBatch.from_arrays([pa.array(list(others), pa.string()), pa.array(list(others.values()), pa.float64())], names=["piece", "n"])

    found = words.where("n > 0").mapInArrow(expect, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    counts = {piece: 1.0 for piece in vocabulary}
    for row in found.collect():
        counts[row["piece"]] += row["n"]
    total = math.log(math.fsum(counts.values()))
    return {piece: math.log(n) - total for piece, n in counts.items()}


def scored_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(word, n, log10 of its marginal probability)."""
    lattice = Lattice(pieces)

    def score(batches):
        for batch in batches:
            words = batch.column(0)
            logs = lattice.likelihoods([w.decode(errors="replace") for w in words.to_pylist()])
            logs[pc.equal(words, pa.scalar(END, words.type)).to_numpy(zero_copy_only=False)] = pieces[STOP]
            yield pa.RecordBatch.from_arrays([words, batch.column(1), pa.array(logs / math.log(10.0))], names=["word", "n", "log"])

    return words.mapInArrow(score, "word binary, n long, log double")


def _texts(blob: bytes):
    ids, _, lengths, data = sp.unpack(blob)
    ends = np.cumsum(lengths)
    for own, length, end in zip(ids.tolist(), lengths.tolist(), ends.tolist()):
        yield own, data[end - length : end].tobytes().lower().split()


def _ask(batches):
    """The distinct words of each block."""
    wanted: dict[int, set[bytes]] = {}
    for batch in batches:
        for group, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            asked = wanted.setdefault(group, {END})
            for _, words in _texts(blob):
                asked.update(words)
    for group, asked in wanted.items():
        listed = sorted(asked)
        for at in range(0, len(listed), 1 << 15):
            part = listed[at : at + (1 << 15)]
            yield pa.RecordBatch.from_arrays([pa.array([group] * len(part), pa.int32()), pa.array(part, pa.binary())], schema=_ASKED)


def _scorer(tokens: int, distinct: int):
    under = tokens + 1 * (distinct + 1)

    def score(batches):
        number: dict[bytes, int] = {}
        counts, logs, blobs = [], [], []
        for batch in batches:
            blob, word, n, log = batch.columns
            asked = word.is_valid()
            blobs += blob.filter(word.is_null()).to_pylist()
            for w in word.filter(asked).to_pylist():
                number[w] = len(number)
            counts.append(n.filter(asked).to_numpy(zero_copy_only=False).astype(np.int64))
            logs.append(log.filter(asked).to_numpy(zero_copy_only=False).astype(np.float64))
        counts, logs = np.concatenate(counts), np.concatenate(logs)
        base = np.log10((counts + 1) / under)
        for blob in blobs:
            rows = []
            for own, words in _texts(blob):
                words.append(END)
                at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                shown = (None if own == sp.LAST else own, held_out(own))
                rows.append((*shown, len(at), int((counts[at] > 0).sum()), tokens, float(base[at].sum()), float(logs[at].sum())))
            yield sp.rows_batch(_REPORT, rows)

    return score


def lm_scoring(docs: DataFrame, vocabulary: str = VOCABULARY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document its tokens, known tokens, and the log10 probabilities of the word model and the lattice.

    Words, split at ASCII white space with A-Z lowered, are counted over all training documents. Each
    distinct word is scored once, in log space, over all its segmentations into pieces; a text's score
    is the sum over its words and its end, as no piece spans two words. Blocks of documents ask the
    table of words for theirs, so the table is never sent whole to anyone and a frequent word is asked
    for once per block. Documents without an id are training documents; null and empty texts are an
    end only; other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    rows = keyed(docs)
    groups = max(partitions(spark), -(-text_bytes(docs) // block_bytes), 1)
    words = cut_lineage(word_counts(rows))
    sums = words.agg(F.sum("n").alias("tokens"), F.count(F.when(F.col("n") > 0, 1)).alias("distinct")).first()
    tokens, distinct = int(sums["tokens"] or 0), int(sums["distinct"])
    known = words.where(F.col("word") != F.lit(bytearray(END)))
    # With nothing to learn from, the end is still asked for.
    words = known.unionByName(spark.range(1).select(F.lit(bytearray(END)).alias("word"), F.lit(_ends(words)).alias("n")))
    table = scored_words(words, learned_pieces(words, read_vocabulary(vocabulary)))
    packed = rows.mapInArrow(pack_documents(groups), PACKED)
    asked = packed.repartitionById(groups, "group").mapInArrow(_ask, "group int, word binary")
    answers = asked.join(table, "word").select("group", F.lit(None).cast("binary").alias("blob"), "word", "n", "log")
    texts = packed.select(
        "group", "blob", F.lit(None).cast("binary").alias("word"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("double").alias("log")
    )
    together = texts.unionByName(answers).repartitionById(groups, "group").select("blob", "word", "n", "log")
    return together.mapInArrow(_scorer(tokens, distinct), REPORT)


def _ends(words: DataFrame) -> int:
    row = words.where(F.col("word") == F.lit(bytearray(END))).first()
    return int(row["n"]) if row else 0
