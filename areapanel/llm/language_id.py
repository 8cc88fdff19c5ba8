"""Language ID by cross-parsing entropy: the language whose labelled text needs fewest phrases wins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UNKNOWN = "und"
HELD_OUT = 1
FOLDS = 3

SAMPLE_DOCS = 48
SAMPLE_CHARS = 400
"""The bounded sample each language is learned from: so many different texts, so many characters of each."""

CELLS = 48 << 20
"""Cells (four bytes) of the automata that one task holds, about; more languages are dealt into blocks."""

SEGMENT = 1024
"""Characters parsed in one piece. Longer texts are parsed in several, so that pieces run side by side."""

REPORT = "doc_id long, held_out boolean, lang_pred string, score double, phrase_rate double"
_REPORT = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("phrase_rate", pa.float64())]
)


def normal(text: str) -> str:
    """Letters in lower case, everything else one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the smallest automaton of all substrings of ``text``; state 0 is the start."""
    to: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        now = len(to)
        to.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in to[p]:
            to[p][c] = now
            p = link[p]
        if p != -1:
            q = to[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                copy = len(to)
                to.append(dict(to[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and to[p].get(c) == q:
                    to[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return to


def compiled(texts: dict[str, str]) -> tuple[list[str], dict[str, int], np.ndarray]:
    """Languages, codes of characters, and one table of all automata: next state * 2 + 1 if a phrase ended.

    Where a match cannot go on, the table holds the state after the first character of the next
    phrase, so parsing is one lookup per character. The last code stands for unseen characters.
    """
    languages = sorted(texts)
    letters = {c: i for i, c in enumerate(sorted({c for t in texts.values() for c in t} | {" "}))}
    width, tables, base = len(letters) + 1, [], 0
    for language in languages:
        states = suffix_automaton(texts[language])
        start = np.full(width, base * 2 + 1, np.int32)
        for c, q in states[0].items():
            start[letters[c]] = (base + q) * 2 + 1
        table = np.tile(start, (len(states), 1))
        for s, moves in enumerate(states):
            for c, q in moves.items():
                table[s, letters[c]] = (base + q) * 2
        tables.append(table)
        base += len(states)
    return languages, letters, np.concatenate(tables) if tables else np.zeros((0, width), np.int32)


def bases(languages: list[str], texts: dict[str, str]) -> list[int]:
    found, base = [], 0
    for language in languages:
        found.append(base)
        base += len(suffix_automaton(texts[language]))
    return found


def training_text(docs: DataFrame) -> dict[str, str]:
    """Text of each learned language, from documents outside the held-out fold; bounded by the sample's size."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.coalesce(fold != HELD_OUT, F.lit(True)))
    start = F.substring("text", 1, SAMPLE_CHARS)
    starts = labelled.select("lang", F.xxhash64(start).alias("mark"), start.alias("text"))
    # Copies are one text: only hashes are shuffled to rank them, then the few picked texts are read.
    order = W.partitionBy("lang").orderBy("mark")
    ranked = starts.select("lang", "mark").distinct().withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= SAMPLE_DOCS)
    wanted = ranked.select(F.col("lang").alias("_lang"), F.col("mark").alias("_mark"))
    picked = (
        starts.join(F.broadcast(wanted), (F.col("lang") == F.col("_lang")) & (F.col("mark") == F.col("_mark")), "left_semi")
        .groupBy("lang", "mark")
        .agg(F.min("text").alias("text"))
    )
    texts: dict[str, list[str]] = {}
    for row in sorted(picked.collect(), key=lambda r: (r["lang"], r["mark"])):
        texts.setdefault(row["lang"], []).append(normal(row["text"]))
    return {k: " ".join(v) for k, v in texts.items() if any(v)}


def blocks(texts: dict[str, str]) -> list[dict[str, str]]:
    """The texts in blocks whose automata have about CELLS cells at most, or one language; one block where nothing was learned."""
    found: list[dict[str, str]] = [{}]
    letters, size = {" "}, 0
    for language in sorted(texts):
        text = texts[language]
        # An automaton has at most two states a character, and about 1.5 in practice.
        if found[-1] and (size + 1.5 * len(text)) * (len(letters | set(text)) + 1) > CELLS:
            found.append({})
            letters, size = {" "}, 0
        found[-1][language] = text
        letters, size = letters | set(text), size + 1.5 * len(text)
    return found


def _counter(texts: dict[str, str]):
    """A function of normal texts: (languages, phrases each needs for each text, cost of each)."""
    model = compiled(texts)
    languages, letters, table = model
    starts = bases(languages, texts)
    width = table.shape[1]
    size = max([ord(c) for c in letters] + [0]) + 1
    codes = np.full(size + 1, width - 1, np.int32)
    for c, i in letters.items():
        codes[ord(c)] = i
    flat = table.reshape(-1)
    space = letters[" "]

    def phrases(texts: list[str]) -> np.ndarray:
        """Phrases each language needs for each text."""
        points = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
        coded = [codes[np.minimum(p, size)] for p in points]
        pieces = [(n, c[i : i + SEGMENT]) for n, c in enumerate(coded) for i in range(0, len(c), SEGMENT)]
        pieces.sort(key=lambda x: -len(x[1]))
        total = np.zeros((len(languages), len(texts)), np.int64)
        for k in range(0, len(pieces), 2048):
            part = pieces[k : k + 2048]
            lengths = np.array([len(c) for _, c in part])
            grid = np.full((lengths.max(), len(part)), space, np.int32)
            for j, (_, c) in enumerate(part):
                grid[: len(c), j] = c
            active = np.searchsorted(-lengths, -np.arange(len(grid)), "left")
            state = np.tile(np.array(starts, np.int32)[:, None], (1, len(part)))
            count = np.ones((len(languages), len(part)), np.int32)
            for step in range(len(grid)):
                n = active[step]
                found = flat[state[:, :n] * width + grid[step, :n]]
                count[:, :n] += found & 1
                state[:, :n] = found >> 1
            owners = np.array([n for n, _ in part])
            for language in range(len(languages)):
                total[language] += np.bincount(owners, count[language], len(texts)).astype(np.int64)
        return total

    def costs(normals: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        total = phrases(normals) if languages and normals else np.zeros((0, len(normals)), np.int64)
        # Phrases times the bits of a pointer into the labelled text, over the text's length.
        return languages, total, total * weights[:, None]

    sizes = np.diff(np.array([*starts, len(table)])) if languages else np.zeros(0)
    weights = np.log2(np.maximum(sizes, 2))
    return costs


def heat(n_chars):
    """What a difference of cost is divided by before it counts as a power of two."""
    return max(1.0, n_chars / 16.0)


def _best(costs):
    """A function of texts: (language, cost, sum of the odds against it, phrases, characters) of each, None without a letter or a language."""

    def best(given: list[str | None]) -> list[tuple[str, float, float, int, int] | None]:
        normals = [normal(t) if t is not None else "" for t in given]
        languages, total, cost = costs(normals)
        out = []
        for j, text in enumerate(normals):
            if not text or not languages:
                out.append(None)
                continue
            k = int(np.argmin(cost[:, j]))
            odds = np.exp2(-(cost[:, j] - cost[k, j]) / heat(len(text)))
            out.append((languages[k], float(cost[k, j]), float(odds.sum()), int(total[k, j]), len(text)))
        return out

    return best


def _texts_of(batch) -> list[str | None]:
    return batch.column(batch.schema.get_field_index("text")).to_pylist()


def _predictor(texts: dict[str, str]):
    best = _best(_counter(texts))

    def predict(batches):
        for batch in batches:
            said = best(_texts_of(batch))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    batch.column(batch.schema.get_field_index("held_out")),
                    pa.array([x[0] if x else UNKNOWN for x in said], pa.string()),
                    pa.array([1.0 / x[2] if x else 0.0 for x in said], pa.float64()),
                    pa.array([x[3] / x[4] if x else None for x in said], pa.float64()),
                ],
                schema=_REPORT,
            )

    return predict


_SAID = pa.schema(
    [("key", pa.string()), ("lang", pa.string()), ("cost", pa.float64()), ("odds", pa.float64()), ("phrases", pa.int64()), ("n", pa.int64())]
)


def text_key():
    """Equal texts have one prediction."""
    return F.sha2(F.col("text").cast("binary"), 256)


def _block_reader(texts: dict[str, str]):
    best = _best(_counter(texts))

    def read(batches):
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("key")).to_pylist()
            rows = [(key, *x) for key, x in zip(keys, best(_texts_of(batch))) if x]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 6, _SAID)], schema=_SAID)

    return read


def best_of_blocks(docs: DataFrame, parts: list[dict[str, str]]) -> DataFrame:
    """key, lang, odds, phrases and n of each distinct text: the lowest cost in any block, and the odds against it in all."""
    rows = docs.where(F.col("text").isNotNull()).select(text_key().alias("key"), "text")
    said = None
    for number, texts in enumerate(parts):
        one = rows.mapInArrow(_block_reader(texts), "key string, lang string, cost double, odds double, phrases long, n long")
        one = one.groupBy("key").agg(F.min(F.struct("cost", "lang", "phrases", "n", "odds")).alias("said"))
        said = one if said is None else said.unionAll(one)
    every = said.groupBy("key").agg(F.min("said").alias("best"), F.collect_list("said").alias("all"))
    scale = F.greatest(F.lit(1.0), F.col("best.n") / 16.0)
    odds = F.aggregate("all", F.lit(0.0), lambda a, x: a + x["odds"] * F.pow(F.lit(2.0), -(x["cost"] - F.col("best.cost")) / scale))
    return every.select("key", "best.lang", odds.alias("odds"), "best.phrases", "best.n")


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and phrase_rate (phrases per character) of every document.

    A suffix automaton of each language's labelled text gives the longest match at each place; a
    text is cut into such phrases, and the language with the lowest cost, phrases times the bits
    of a pointer into its text, wins; the first in code-point order on ties. Whole texts are
    parsed, in pieces of SEGMENT characters. Texts that are null or hold no letter, and all texts where
    nothing was learned, are ``und`` with score 0. Extra columns and repeated rows do not matter. No shuffle
    where the automata fit CELLS; otherwise each block of languages reads all texts, and the block with the
    lowest cost is joined by the text's hash.
    """
    parts = blocks(training_text(docs.select("doc_id", "lang", "text")))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text")
    if len(parts) == 1:
        return rows.mapInArrow(_predictor(parts[0]), REPORT)
    keyed = rows.select("doc_id", "held_out", text_key().alias("key"))
    return keyed.join(best_of_blocks(docs.select("text"), parts), "key", "left").select(
        "doc_id",
        "held_out",
        F.coalesce("lang", F.lit(UNKNOWN)).alias("lang_pred"),
        F.coalesce(1.0 / F.col("odds"), F.lit(0.0)).alias("score"),
        (F.col("phrases") / F.col("n")).alias("phrase_rate"),
    )


PHRASES_PER_CHAR = 0.6
"""Texts that need more phrases after the first even in the best language are none of the learned ones."""


def keep_known(docs: DataFrame, most: float = PHRASES_PER_CHAR) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or that are far from every learned one. No shuffle for one block of languages."""
    parts = blocks(training_text(docs.select("doc_id", "lang", "text")))
    if len(parts) > 1:
        near = best_of_blocks(docs.select("text"), parts).where(F.col("phrases") - 1 <= most * F.col("n")).select("key")
        # The rows stay inside a struct, so no column of theirs can clash.
        keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_key().alias("key"))
        return keyed.join(near, "key", "left_semi").select("row.*")
    best = _best(_counter(parts[0]))

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array([bool(x) and x[3] - 1 <= most * x[4] for x in best(_texts_of(batch))], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
