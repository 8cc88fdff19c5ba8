"""The lattice of many words at once against the recursion of one word."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

lattice = pytest.importorskip("areapanel.llm.lattice")

PIECES = {"▁": -1.0, "▁a": -1.5, "a": -0.5, "b": -0.7, "ab": -2.0, "bab": -2.5, "é": -3.0, "abba": -4.0, lattice.STOP: 0.0} | {
    f" <0x{b:02X}>": -5.0 - b / 100 for b in range(256)
}
rng = random.Random(7)
WORDS = ["", "a", "ab", "é", "日本", "x😀a", "a▁b", "ab" * 40, "z" * 300, "\x00a", "ab", "ab"] + [
    "".join(rng.choices("abéz", k=rng.randint(1, 70))) for _ in range(300)
]


@pytest.mark.parametrize("pieces", [PIECES, {k: v for k, v in PIECES.items() if k[0] == " "}])
def test_likelihoods_of_many_words(pieces):
    known = lattice.endings(pieces)
    got = lattice.Lattice(pieces).likelihoods(WORDS)
    for word, value in zip(WORDS, got):
        assert math.isclose(value, lattice.forward(lattice.edges(word, known))[-1], rel_tol=1e-12), word


def test_expected_pieces_of_many_words():
    own, counts, others = lattice.Lattice(PIECES), np.zeros(sum(k[0] != " " for k in PIECES)), Counter()
    times = np.arange(1.0, len(WORDS) + 1)
    own.expected(WORDS, times, counts, others)
    want: Counter = Counter()
    for word, n in zip(WORDS, times.tolist()):
        lattice.expected_pieces(word, n, lattice.endings(PIECES), want)
    for name, n in zip(own.names, counts.tolist()):
        others[name] += n
    for name in want:
        assert math.isclose(others[name], want[name], rel_tol=1e-9), name
    assert all(others[name] == 0 for name in others if name not in want)


def test_no_words():
    own = lattice.Lattice(PIECES)
    assert len(own.likelihoods([])) == 0
    counts = np.zeros(len(own.names))
    own.expected([], np.zeros(0), counts, Counter())
    assert not counts.any()
