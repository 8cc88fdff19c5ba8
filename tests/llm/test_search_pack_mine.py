"""Packing, ranked search and collocations against brute force, on given rows and awkward ones."""

import math
import re
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from areapanel.llm import packing, ranked_search  # noqa: E402
from areapanel.llm.collocations import Phrases, coded, collocations, numbers_of_blocks  # noqa: E402
from areapanel.llm.common import small_batches  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, score long, rank int, m long, sequence_id long"
PASSAGE = " ".join(f"word{i}" for i in range(60))
ODD = [
    (9000, None, None, None),
    (9001, "", "en", "a"),
    (9002, " \n\t ", "en", None),
    (9003, PASSAGE, "en", "a"),
    (9003, PASSAGE, "en", "a"),
    (None, "tail " + PASSAGE, None, "b"),
    (None, None, "und", "b"),
    (9005, "a  B, a b; A\x0bb! a b   café con café", "en", "a"),
    (9006, "<|endoftext|>  x  \n\n y<|endoftext|>it's 12's \U0001f600 ", "en", "a"),
    (9007, "é" * 20000 + " token", "fr", "a"),
    (9008, "zürich ZÜRICH " * 700, "fr", "a"),
    (9009, "x y z w v u, " * 300, "xx", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    small_batches(spark)
    given = []
    if Path(SF_DIR).is_dir():
        given = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60).select("doc_id", "text", "lang", "source").collect()
    rows = [(*r, 1, 2, 3, 4) for r in [*given, *ODD]]
    return spark.createDataFrame(rows, KIND).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


def check_pieces(rows, docs, size):
    """Every id once, in order, no sequence longer than ``size``; only one shorter sequence left over."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, texts = Counter(), {}
    for d in docs.collect():
        ids = np.array([*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        want[d["doc_id"], len(ids), zlib.crc32(ids.tobytes())] += 1
        texts[d["doc_id"], len(ids)] = ids
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for found in sequences.values():
        found.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in found])
        assert [r["offset"] for r in found] == [0, *ends[:-1]] and ends[-1] <= size
    total = Counter()
    for (doc_id, tokens), found in pieces.items():
        copies = [k for k in want if k[:2] == (doc_id, tokens)]
        times = sum(want[k] for k in copies)
        covered = np.zeros(tokens, int)
        for r in found:
            covered[r["start"] : r["start"] + r["length"]] += 1
        assert (covered == times).all()
        total[doc_id, tokens] = times
        if len(copies) == 1:
            ids = texts[doc_id, tokens]
            for r in found:
                assert zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    assert sum(total.values()) == sum(want.values())
    return [sum(r["length"] for r in s) for s in sequences.values()]


def test_packing(docs, empty):
    lengths = check_pieces(packing.pack(docs).collect(), docs, 1024)
    assert 1024 * len(lengths) - sum(lengths) < 1024 * (1 + len(lengths) // 50)
    lengths = check_pieces(packing.pack(docs, size=64, most=3).collect(), docs, 64)
    assert sum(lengths) > 0.8 * 64 * len(lengths)
    assert packing.pack(empty).collect() == []


def test_packing_rounds(spark, docs, monkeypatch):
    """Leftovers of many partitions merge in rounds; one sequence alone may be short of them."""
    monkeypatch.setattr(packing, "FAN", 2)
    many = spark.createDataFrame([(i, f"text number {i}") for i in range(41)], "doc_id long, text string").repartition(9)
    lengths = check_pieces(packing.pack(many, size=16).collect(), many, 16)
    assert sum(n < 16 for n in lengths) == 1


def test_chunks_keep_ids():
    """Texts cut at any white space or sign give the tokenizer's own ids."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    signs = ["a", " ", "\n", "\t", "é", " ", "\u0085", " ", "1", "'s", "<|endoftext|>", "!", "中", "᠎", "\x1c", "ß"]
    texts = [x + y + z + w for x in signs for y in signs for z in signs for w in ("", " b")]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in raw])))
    ids, begins = encoder.documents(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for text, a, b in zip(texts, begins[:-1], begins[1:]):
        assert ids[a : b - 1].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_search(docs, items, top=10):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        asked, found = Counter(terms(text)), []
        for i, c in held:
            m = 100 - 75 + 75 * sum(c.values()) * n_docs // n_terms
            score = sum(n * weight[t] * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t, n in asked.items() if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block,cells,pairs", [(1 << 14, 1 << 21, 1 << 16), (2, 8, 12)])
def test_ranked_search(spark, docs, empty, monkeypatch, block, cells, pairs):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(ranked_search, "CELLS", cells)
    monkeypatch.setattr(ranked_search, "QUERY_TERMS", pairs)
    pairs_of = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(1, "word1 WORD2, word2 nowhere"), (2, None), (None, "Zürich a b"), (3, " ."), (1, "word59")]
    items += [(100 + k, t[:200]) for k, (_, t) in enumerate(pairs_of[:8]) if t]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in ranked_search.ranked_search(docs, table).collect()), key=repr)
    assert got == brute_search(pairs_of, items)
    assert ranked_search.ranked_search(empty, table).collect() == []
    assert ranked_search.ranked_search(docs, table.limit(0)).collect() == []


def test_search_ties(spark):
    """Equal scores by id, null last; a stratum with most rows is salted and loses nothing."""
    rows = [(i, "same words here") for i in range(300, 0, -1)] + [(None, "same words here"), (7000, "other thing")]
    many = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([(5, "words words here")], "item_id long, text string")
    got = ranked_search.search(ranked_search.build_index(many), items, 400).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [*range(1, 301), None]


def brute_phrases(docs, support, top):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = tuple(w for w in re.split(r"[\x20\x09]+", piece) if w)
            n[lang] += len(words)
            for size in range(1, 6):
                counts[lang].update(words[i : i + size] for i in range(len(words) - size + 1))
    out = []
    for lang, found in counts.items():
        kept = {g: a for g, a in found.items() if a >= support}
        dropped = {g[s:e] for g, a in kept.items() for s in range(len(g)) for e in range(s + 2, len(g) + 1) if e - s < len(g) and a >= found[g[s:e]]}
        scored = []
        for g, a in kept.items():
            if len(g) > 1 and g not in dropped:
                score, k = min((1000 * a * n[lang] // (found[g[:k]] * found[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), found[g[:k]], found[g[k:]]))
        out += [(lang, r, p.decode(), -a, le, ri, n[lang], -s) for r, (s, a, p, le, ri) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("support,top", [(100, 2000), (3, 25)])
def test_collocations(docs, support, top):
    got = sorted(tuple(r) for r in collocations(docs, support, top).collect())
    want = brute_phrases([(r["lang"], r["text"]) for r in docs.collect()], support, top)
    assert got == want and want


def test_collocations_of_nothing(empty):
    assert collocations(empty).collect() == []


def test_phrases_are_compared_whole():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 4, 3000).astype(np.int32)
    rows = np.array([[1, 2, 3], [3, 3, 1], [2, 2, 2]], np.int32)
    place, number = Phrases(rows).places(ids)
    want = sorted((i, k) for i in range(2998) for k, r in enumerate(rows.tolist()) if ids[i : i + 3].tolist() == r)
    assert sorted(zip(place.tolist(), number.tolist())) == want


def test_words_of_a_block_are_held_as_one_long_each(spark):
    met = spark.createDataFrame([(5, 1, 7), (5, 3_000_000, 2_147_483_647), (6, 2, 7)], "block long, code int, gid int")
    got = numbers_of_blocks(met)
    assert dict(got.dtypes)["found"] == "array<bigint>"
    pairs = {r["block"]: sorted((x >> 32, x & 0xFFFFFFFF) for x in r["found"]) for r in got.collect()}
    assert pairs == {5: [(1, 7), (3_000_000, 2_147_483_647)], 6: [(2, 7)]}


def test_words_are_numbered_in_little_memory():
    data = np.frombuffer(b"considerable arrangements, concerning international organisations. " * 30_000, np.uint8)
    coded(data[:100], np.array([0, 100]))  # what is imported on the first call
    tracemalloc.start()
    try:
        codes, words = coded(data, np.array([0, len(data)]))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(words) == 5 and (codes > 0).sum() == 150_000 and (codes == 0).sum() == 60_001
    assert most < 18 * len(data)
