"""Each operator against brute force on the smallest tables and awkward rows."""

import math
import sys
import zlib
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
from areapanel.llm import lm_scoring as lm  # noqa: E402
from areapanel.llm.common import small_batches  # noqa: E402
from areapanel.llm.de_bruijn_dedup import de_bruijn_dedup  # noqa: E402
from areapanel.llm.decontamination import decontaminate, overlaps  # noqa: E402
from areapanel.llm.jaccard_join import jaccard_join, keep_one_of_each  # noqa: E402
from areapanel.llm.language_id import language_id  # noqa: E402
from areapanel.llm.lattice import expected_pieces  # noqa: E402
from areapanel.llm.mixing import mix, mixing_report  # noqa: E402
from areapanel.llm.quality_rules import quality_rules  # noqa: E402
from areapanel.llm.secret_scan import RULES, brute_spans, secret_scan  # noqa: E402
from areapanel.llm.sharding import shard_documents, sharding  # noqa: E402
from areapanel.llm.suffix_dedup import suffix_dedup  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long, size long, row string"
PASSAGE = " ".join(f"word{i}" for i in range(60))
ODD = [
    (9000, None, None, None),
    (9001, "", "en", "a"),
    (9002, " \n\t ", "en", None),
    (9003, PASSAGE, "en", "a"),
    (9003, PASSAGE, "en", "a"),
    (None, "tail " + PASSAGE, None, "b"),
    (9004, PASSAGE + " " + PASSAGE, "en", "b"),
    (9005, "a  B", "en", "a"),
    (9006, "A b", "en", "a"),
    (9007, "é" * 20000 + " token=abcdefghijklmnop AKIA12345678901234 0123456789abcdef0", "fr", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    small_batches(spark)
    if not Path(SF_DIR).is_dir():
        pytest.skip("no test tables")
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(120).collect()
    rows = [(*r, 1, "x") for r in given] + [(i, t, la, s, 0, 1, "x") for i, t, la, s in ODD]
    return spark.createDataFrame(rows, KIND)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def tuples(df):
    return sorted(tuple(brute.LAST if i == 0 and v is None else v for i, v in enumerate(r)) for r in df.collect())


@pytest.mark.parametrize("bucket", [4 << 20, 1 << 13])
def test_byte_dedup(docs, bucket):
    assert tuples(suffix_dedup(docs, bucket)) == brute.byte_dedup(pairs(docs))


@pytest.mark.parametrize("bucket", [4 << 20, 1 << 13])
def test_word_dedup(docs, bucket):
    assert tuples(de_bruijn_dedup(docs, bucket)) == brute.word_dedup(pairs(docs))


def test_jaccard(docs):
    got = sorted(tuple(brute.LAST if v is None else v for v in r) for r in jaccard_join(docs).collect())
    assert got == brute.jaccard(pairs(docs))
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted({c for _, n, c in got if n}) == sorted(r["doc_id"] for r in kept.collect() if (r["text"] or "").split())


def test_quality(docs):
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality_rules(docs).collect():
        words = (text[r["doc_id"]] or "").encode().split()
        lines = [x for x in (text[r["doc_id"]] or "").split("\n") if x.encode().split()]
        assert r["n_words"] == len(words)
        assert r["word_chars"] == sum(len(w.decode()) for w in words)
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == brute.repeated_words(text[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_mixing(docs):
    rows = mixing_report(docs).collect()
    assert all(r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] for r in rows)
    by_source = {r["source_size"]: r["target"] for r in rows}
    total = sum(r["size"] for r in rows)
    assert math.isclose(sum(by_source.values()), 1.5 * total, rel_tol=1e-9)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing_report(docs).collect()), key=str)
    assert mix(docs).columns == docs.columns


def test_secrets(docs):
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in secret_scan(docs).collect():
        want = ",".join(f"{RULES[k].kind}:{a}:{b}" for a, k, b in brute_spans(text[r["doc_id"]]))
        assert r["spans"] == want


def test_scores(docs):
    counts, texts = Counter(), []
    for i, t in pairs(docs):
        words = (t or "").encode().lower().split() + [lm.END]
        texts.append((i, words))
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    want = {i: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) for i, words in texts}
    vocabulary = lm.read_vocabulary()
    known, expected = lm.endings(vocabulary), Counter(dict.fromkeys(vocabulary, 1.0))
    expected[lm.STOP] += counts[lm.END]
    for word, times in counts.items():
        if word != lm.END:
            expected_pieces(word.decode(errors="replace"), times, known, expected)
    total = math.fsum(expected.values())
    pieces = {piece: math.log(c / total) for piece, c in expected.items()}
    known, logs = lm.endings(pieces), {lm.END: pieces[lm.STOP]}
    for word in {w for _, words in texts for w in words} - {lm.END}:
        logs[word] = lm.forward(lm.edges(word.decode(errors="replace"), known))[-1]
    score = {i: sum(logs[w] for w in words) / math.log(10) for i, words in texts}
    for r in lm.lm_scoring(docs, block_bytes=1 << 15).collect():
        assert r["train_tokens"] == n
        assert math.isclose(r["base_score"], want[r["doc_id"]], rel_tol=1e-9)
        assert math.isclose(r["score"], score[r["doc_id"]], rel_tol=1e-9)


def test_lattice_sums_all_segmentations():
    pieces = {"▁": -1.0, "▁a": -1.5, "a": -0.5, "b": -0.7, "ab": -2.0, lm.STOP: 0.0} | {f" <0x{b:02X}>": -5.0 for b in range(256)}
    likelihood = lm.forward(lm.edges("ab", lm.endings(pieces)))[-1]
    ways = [-1.0 - 0.5 - 0.7, -1.0 - 2.0, -1.5 - 0.7]
    assert math.isclose(likelihood, math.log(sum(map(math.exp, ways))))


def test_shards(docs):
    rows = sharding(docs).collect()
    slots = Counter(r["shard"] for r in rows)
    assert max(slots.values()) - min(slots.get(s, 0) for s in range(16)) <= 1
    assert {(r["shard"], r["slot"]) for r in rows} == {(s, k) for s, m in slots.items() for k in range(m)}
    placed = shard_documents(docs)
    assert placed.columns == [*docs.columns, "shard", "slot"] and placed.count() == len(rows)


def test_language(docs):
    rows = {r["doc_id"]: r for r in language_id(docs).collect()}
    assert rows[9000]["lang_pred"] == rows[9001]["lang_pred"] == "und"
    known = [r for r in docs.collect() if r["lang"] and r["doc_id"] is not None and r["doc_id"] < 9000]
    right = sum(rows[r["doc_id"]]["lang_pred"] == r["lang"] for r in known)
    assert right >= 0.95 * len(known)


def test_leaks(spark, docs):
    item = " ".join(f"word{i}" for i in range(10, 40))
    changed = item.replace("word20", "other").replace("word33", "other")
    bench = spark.createDataFrame([(1, changed), (2, "nothing of the kind is in here at all today"), (3, None)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in overlaps(docs, bench).collect()}
    assert found == {(9003, 1), (9004, 1), (None, 1)}
    left = {r["doc_id"] for r in decontaminate(docs, bench).collect()}
    assert not left & {9003, 9004, None} and 9000 in left


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    for op in (suffix_dedup, de_bruijn_dedup, jaccard_join, quality_rules, mixing_report, secret_scan, lm.lm_scoring, sharding, language_id):
        assert op(empty).count() == 0, op.__name__
    assert overlaps(empty, bench).count() == 0
