"""Suffix dedup where some leading bytes are common: what a task holds, how windows are dealt, and the result."""

import sys
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
from areapanel.llm import spans as sp  # noqa: E402
from areapanel.llm import suffix_dedup as S  # noqa: E402
from areapanel.llm.common import small_batches  # noqa: E402

LETTERS = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
NONE = np.zeros(0, np.uint64)


def noise(rng, size):
    return LETTERS[rng.integers(0, 26, size)].tobytes()


def phrase(rng):
    """Leading bytes that are the anchor of nearly all windows that hold them."""
    tried = [noise(rng, S.LEAD) for _ in range(2000)]
    return min(tried, key=lambda x: int(sp.gram_hashes(np.frombuffer(x, np.uint8).astype(np.uint64) + np.uint64(1), S.LEAD)[0]))


def batch(texts):
    ids = pa.array(range(len(texts)), pa.int64())
    return pa.RecordBatch.from_arrays([ids, pa.array(S.id_marks(np.arange(len(texts)))), pa.array(texts, pa.binary())], names=["id", "mark", "text"])


def key_of(leading):
    return S._sort_keys(np.frombuffer(leading, np.uint8), np.zeros(1, np.int64))[0]


@pytest.fixture(scope="module")
def crowded():
    rng = np.random.default_rng(5)
    common = phrase(rng)
    return common, [b"".join(common + noise(rng, 22) for _ in range(200)) for _ in range(40)]


def test_a_full_bucket_of_hot_suffixes_is_matched_in_little_memory(crowded):
    common, texts = crowded
    split = np.repeat(key_of(common), 2)
    dealt = [b for b in S._dealer(NONE, split)([batch(texts)]) if sp.unpack(b.column(1)[0].as_py())[5].any()]
    hot = sum(int((w.astype(int) * (f & 1)).sum()) for b in dealt for w, f in [sp.unpack(b.column(1)[0].as_py())[4:6]])
    assert hot > 0.9 * sum(len(t) - S.WINDOW + 1 for t in texts)
    tracemalloc.start()
    left = 0
    for found in S._matcher(4, 4)(iter(dealt)):
        assert found.column(2)[0].as_py()
        left += len(sp.unpack(found.column(1)[0].as_py())[0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert left == hot  # nothing is repeated, and every window goes on to the last compare
    assert peak < 200 * hot


def test_a_common_anchor_is_dealt_by_its_context(spark, crowded):
    common, texts = crowded
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text binary")
    rows = rows.withColumn("mark", F.xxhash64("id"))
    small_batches(spark)
    deal = S.dealing(rows, sum(map(len, texts)), 16)
    assert key_of(common) in deal.common and not len(sp.hot_keys(deal.split)) and deal.hot_share == 0
    sent, windows = np.zeros(16), 0
    for b in S._dealer(deal.common, deal.split)([batch(texts)]):
        opened = sp.unpack(b.column(1)[0].as_py())
        sent[b.column(0)[0].as_py()] += len(opened[6])
        windows += int(opened[4].sum())
    assert windows == sum(len(t) - S.WINDOW + 1 for t in texts)
    assert sent.max() < 1.5 * sent.mean()


def test_the_mark_of_an_id_is_that_of_spark(spark):
    ids = [0, 1, -1, 7, 1 << 40, -(1 << 63), (1 << 63) - 1]
    rows = spark.createDataFrame([(i,) for i in ids], "id long").select("id", F.xxhash64("id").alias("mark")).collect()
    assert S.id_marks(np.array([r["id"] for r in rows])).tolist() == [r["mark"] for r in rows]


@pytest.mark.parametrize("odd", [[], [(3, "again"), (None, "x" * 90), (None, "y" + "x" * 90), (4, None)]])
def test_common_and_hot_suffixes_give_what_brute_force_gives(spark, odd):
    small_batches(spark)
    rng = np.random.default_rng(9)
    common, line, passage = phrase(rng), noise(rng, 36), noise(rng, 120)
    texts = [b"".join(rng.choice([common, line, noise(rng, 5), noise(rng, 40)]) for _ in range(60)) for _ in range(60)]
    texts = [t + passage + t[:70] if i % 3 else t for i, t in enumerate(texts)] + [b"-" * 400, b"-" * 300, texts[5]]
    rows = [(i * 1000, t.decode()) for i, t in enumerate(texts)] + odd
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert S.ids_differ(docs) == (not odd)
    got = sorted((brute.LAST if r[0] is None else r[0], *r[1:]) for r in map(tuple, S.suffix_dedup(docs, 1 << 10).collect()))
    assert got == brute.byte_dedup(rows)
