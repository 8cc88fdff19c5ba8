"""The coarse bound on long texts: no overlap is counted too low, however many shingles meet in a bucket."""

import sys
from pathlib import Path

import numpy as np
import pyarrow as pa

sys.path[:0] = [str(Path(__file__).resolve().parents[2])]

from areapanel.llm import jaccard_join as J  # noqa: E402


def batch(number, text):
    return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([number]), pa.array([text], pa.binary())], names=["id", "mark", "text"])


def counted(texts, parts=1, groups=3):
    """Shared tokens by node, each text in a batch of its own."""
    dealt = [b for k, t in enumerate(texts) for b in J._deal(parts, groups)([batch(k, t)])]
    passed = []
    for part in range(parts):
        mine = [b for b in dealt if b.column(0)[0].as_py() == part]
        passed += [b for b in J._count(groups)(iter(mine)) if b.column(1)[0].as_py() == J.COUNTS]
    return {k: v for b in J._total(iter(passed)) for k, v in zip(*[c.to_pylist() for c in b.columns])}


def test_many_shingles_in_a_bucket():
    words = [b"w%d" % i for i in range(70_000)]
    texts = [b" ".join(words), b" ".join([*words[:-1], b"other"])]
    sets = [J.shingles(t) for t in texts]
    both = len(np.intersect1d(*sets))
    assert both > 65_535
    got = counted(texts)
    assert set(got) == {J.node_of(s) for s in sets}
    assert all(both <= n <= both + 1 for n in got.values())


def test_equal_cuts_of_different_tokens_do_not_lower_the_count():
    words = [b"w%d" % i for i in range(400_004)]
    texts = [b" ".join(words), b" ".join(words[:300_004])]
    small = J.node_of(J.shingles(texts[1]))
    got = counted(texts)
    assert got[small] == 300_000
    assert min(got.values()) >= 300_000


def test_copies_in_many_batches_count_once_and_rows_are_passed_on():
    texts = [b"a b c d e f g", b"a b c d e f g", b"a b c d e f h", b"k l m n o p", b"k l m n o p", b""]
    got = counted(texts, parts=2)
    names = [J.node_of(J.shingles(t)) for t in texts]
    assert got == {names[0]: 2, names[2]: 2}
    dealt = [b for k, t in enumerate(texts) for b in J._deal(2, 3)([batch(k, t)])]
    rows = [r for b in J._rows(b for b in J._count(3)(iter(dealt)) if b.column(1)[0].as_py() == J.ROWS) for r in b.to_pylist()]
    assert [(r["id"], r["n"], r["node"]) for r in rows] == [(k, len(J.shingles(t)), names[k]) for k, t in enumerate(texts)]
