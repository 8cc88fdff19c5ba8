"""Blocks of op13 are filled language by language, with a bound on what a task holds."""

import random
import sys
from collections import Counter
from pathlib import Path

import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from areapanel.llm import collocations as co  # noqa: E402
from areapanel.llm.common import small_batches  # noqa: E402
from llm.test_search_pack_mine import brute_phrases  # noqa: E402


def batch_of(rows):
    return pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.binary())], names=["lang", "text"])


def test_a_block_holds_all_a_task_has_of_a_language():
    """Eighteen MB of three languages in turn are three blocks of six MB, not one for each language and 12 MB of input."""
    batches = [batch_of([(lang, b"word " * 50_000) for lang in "abc"]) for _ in range(24)]
    blocks = [r for b in co._blocks(iter(batches)) for r in b.to_pylist()]
    assert sorted((r["lang"], r["n_words"], r["counts"]) for r in blocks) == [(lang, 1_200_000, [1_200_000]) for lang in "abc"]
    assert len({r["block"] for r in blocks}) == 3


def test_what_is_held_is_bounded_and_whole(monkeypatch):
    monkeypatch.setattr(co, "BLOCK", 20_000)
    monkeypatch.setattr(co, "HOLD", 50_000)
    rng, given, out = random.Random(3), Counter(), Counter()
    held = {"bytes": 0, "most": 0}

    def batches():
        for _ in range(60):
            rows = [(f"l{int(rng.paretovariate(0.7)) % 40}", bytes(rng.choices(b"ab c", k=rng.randrange(900)))) for _ in range(20)]
            given.update(rows)
            held["bytes"] += sum(len(t) for _, t in rows)
            yield batch_of(rows)
            held["most"] = max(held["most"], held["bytes"])

    for lang, batch in co.by_lang(batches()):
        texts = [t.as_py() for t in batch.column(0)]
        held["bytes"] -= sum(map(len, texts))
        out.update((lang, t) for t in texts)
    assert out == given and held["most"] <= 50_000 + 20 * 900


def test_phrases_do_not_depend_on_blocks(spark, monkeypatch):
    monkeypatch.setattr(co, "BLOCK", 2_500)
    monkeypatch.setattr(co, "HOLD", 6_000)
    small_batches(spark)
    rng = random.Random(5)
    rows = [(rng.choice(["en", "fr", None, "xx"]), " ".join(rng.choices(["a", "b", "c", "d", "e.", "f"], k=40))) for _ in range(200)]
    rows += [("en", ""), ("fr", None), (None, " . ")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in co.collocations(docs, 5, 40).collect())
    assert got == brute_phrases(rows, 5, 40)


def test_places_of_words_meet_their_numbers_without_a_join(spark, monkeypatch):
    """Counting keeps a word's places, so no join has a row for each of them."""
    monkeypatch.setattr(co, "BLOCK", 2_500)
    monkeypatch.setattr(co, "HOLD", 6_000)
    small_batches(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    rng = random.Random(9)
    rows = [(rng.choice(["en", "fr"]), " ".join(rng.choices([f"w{i}" for i in range(30)], k=60)) + f" rare{j}") for j in range(300)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    join, made = type(docs).join, []

    def counted(self, *args, **kwargs):
        out = join(self, *args, **kwargs)
        made.append(out.count())
        return out

    monkeypatch.setattr(type(docs), "join", counted)
    corpus = co.Corpus(docs, 20)
    small_batches(spark)
    ids, words = corpus.ids.collect(), corpus.words.collect()
    assert len(words) == 60 and len(ids) > 20
    assert max(made) <= max(len(words), len(ids))
    assert sorted(r["gid"] for r in words) == list(range(1, 61))
    order = sorted(words, key=lambda r: (r["lang"], r["f"], bytes(r["word"])))
    assert [r["gid"] for r in order] == list(range(1, 61))
    said = Counter()
    for r in ids:
        said.update((r["lang"], int(x)) for x in co.sp.unpack(r["ids"])[0] if x)
    assert said == {(r["lang"], r["gid"]): r["f"] for r in words}


def test_places_go_by_block_as_far_as_a_task_holds_them(monkeypatch):
    kind = pa.schema([("block", pa.list_(pa.int64())), ("code", pa.list_(pa.int32())), ("gid", pa.int64())])
    words = [([7, 1 << 40], [1, 2], 5), ([], [], 6), ([7], [3_000_000], 2_147_483_647), ([7, 8, 1 << 40], [4, 9, 6], 8)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(kind.names, w)) for w in part], schema=kind) for part in (words[:2], words[2:])]
    expected = {(b, c, w[2]) for w in words for b, c in zip(w[0], w[1])}
    for most, rows in ((100, 3), (2, 5)):
        monkeypatch.setattr(co, "PAIRS", most)
        out = [r for b in co._by_block(iter(batches)) for r in b.to_pylist()]
        assert len(out) == rows
        got = [(r["block"], x >> 32, x & 0xFFFFFFFF) for r in out for x in r["pairs"]]
        assert len(got) == len(expected) and set(got) == expected
    assert list(co._by_block(iter([batches[0].slice(1)]))) == []
