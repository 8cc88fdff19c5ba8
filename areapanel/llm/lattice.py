"""The lattice of many words at once: log-space recursions over columns of equal places.

A word is a row of code points. All pieces that begin at one place are followed together through a
tree of the pieces, one character a step, for all words that are still on some piece.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np

STOP = " </s>"
"""The end among the pieces. Like the bytes it is named with a space, so that no word holds its name."""
MARK = "▁"
Pieces = dict[str, float]

LONGEST = 64
"""Words with more characters are followed one by one, so that one of them does not widen all rows."""

_BITS = 21
"""A code point has no more."""


def endings(pieces: Pieces) -> dict[str, float | None]:
    """Every piece with its weight, and every ending of one that is no piece itself with None.

    A search for the pieces that end at a place stops at the first text that no piece ends with.
    """
    known: dict[str, float | None] = {piece[at:]: None for piece in pieces for at in range(1, len(piece))}
    return known | pieces


def spelled(character: str) -> list[str]:
    """The byte pieces of a character that is no piece."""
    return [f" <0x{b:02X}>" for b in character.encode()]


def edges(word: str, known: dict[str, float | None]) -> list[list[tuple[int, float]]]:
    """For each place of the word, where the pieces that end there begin, and their weights."""
    text = MARK + word
    ending: list[list[tuple[int, float]]] = [[]]
    for end in range(1, len(text) + 1):
        here = []
        for begin in range(end - 1, -1, -1):
            weight = known.get(text[begin:end], STOP)
            if weight.__class__ is float:
                here.append((begin, weight))
            elif begin == end - 1:
                here.append((begin, sum([known[x] for x in spelled(text[begin])])))
            if weight is STOP:
                break
        ending.append(here)
    return ending


def log_sum(terms: list[float]) -> float:
    if len(terms) == 1:
        return terms[0]
    top = max(terms)
    return top + math.log(sum([math.exp(t - top) for t in terms]))


def forward(ending) -> list[float]:
    """Log-likelihood of every beginning of a word, over all its segmentations."""
    alpha = [0.0]
    for here in ending[1:]:
        alpha.append(log_sum([alpha[begin] + weight for begin, weight in here]))
    return alpha


def expected_pieces(word: str, times: float, known: dict[str, float | None], into: Counter) -> None:
    """Adds the expected number of each piece over all segmentations of a word."""
    text = MARK + word
    ending = edges(word, known)
    alpha = forward(ending)
    behind: list[list[float]] = [[] for _ in ending]
    behind[-1].append(0.0)
    for end in range(len(text), 0, -1):
        beta = log_sum(behind[end])
        for begin, weight in ending[end]:
            behind[begin].append(weight + beta)
            share = times * math.exp(alpha[begin] + weight + beta - alpha[-1])
            piece = text[begin:end]
            if end - begin > 1 or known.get(piece) is not None:
                into[piece] += share
            else:
                for name in spelled(piece):
                    into[name] += share


class Lattice:
    """Pieces as a tree of numbered nodes; node 0 is the root, and keys are (node, character)."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.names = [name for name in pieces if name[0] != " "]
        child: dict[int, int] = {}
        ends: list[int] = []
        for name in self.names:
            node = 0
            for character in name:
                node = child.setdefault(node << _BITS | ord(character), len(child) + 1)
            ends.append(node)
        keys = np.fromiter(child, np.int64, len(child))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.child = np.fromiter(child.values(), np.int64, len(child))[order]
        self.weight = np.full(len(child) + 1, -np.inf)
        self.weight[ends] = [pieces[name] for name in self.names]
        self.number = np.full(len(child) + 1, -1, np.int64)
        self.number[ends] = np.arange(len(ends))
        self.known: dict[str, float | None] | None = None

    def one_by_one(self) -> dict[str, float | None]:
        if self.known is None:
            self.known = endings(self.pieces)
        return self.known

    def step(self, node: np.ndarray, character: np.ndarray) -> np.ndarray:
        """The next node, or -1."""
        if not len(self.keys):
            return np.full(len(node), -1, np.int64)
        key = node << _BITS | character
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.child[at], -1)

    def begun(self, characters: np.ndarray, active: int, begin: int):
        """(end, rows, node, weight) of all edges that begin at a place; spelled characters have node -1."""
        rows = np.arange(active)
        node = self.step(np.zeros(active, np.int64), characters[:active, begin])
        weight = np.where(node >= 0, self.weight[node], -np.inf)
        spell = np.isneginf(weight)
        if spell.any():
            kinds, which = np.unique(characters[:active, begin][spell], return_inverse=True)
            weight[spell] = np.array([sum(self.pieces[x] for x in spelled(chr(c))) for c in kinds])[which]
        yield begin + 1, rows, np.where(spell, -1, node), weight
        for end in range(begin + 1, characters.shape[1]):
            on = node >= 0
            rows, node = rows[on], node[on]
            if not len(rows):
                return
            # Places behind a word's end hold 0, which no piece holds.
            node = self.step(node, characters[rows, end])
            is_piece = (node >= 0) & ~np.isneginf(self.weight[node])
            if is_piece.any():
                yield end + 1, rows[is_piece], node[is_piece], self.weight[node[is_piece]]

    def table(self, words: list[str]):
        """Rows of code points, longest word first, their lengths and how many rows reach each place."""
        texts = [MARK + word for word in words]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        flat = np.frombuffer("".join([texts[i] for i in order]).encode("utf-32-le"), np.uint32)
        places = np.arange(lengths[0] if len(lengths) else 0)
        characters = np.zeros((len(texts), len(places)), np.int64)
        characters[places < lengths[:, None]] = flat
        return order, characters, lengths, np.searchsorted(-lengths, -places, side="left")

    def _alpha(self, characters: np.ndarray, active: np.ndarray, kept: list | None = None) -> np.ndarray:
        """Log-likelihood of every beginning of every word; edges are kept by the place they begin at."""
        alpha = np.full((characters.shape[1] + 1, len(characters)), -np.inf)
        alpha[0] = 0.0
        for begin in range(characters.shape[1]):
            here = []
            for end, rows, node, weight in self.begun(characters, active[begin], begin):
                alpha[end, rows] = np.logaddexp(alpha[end, rows], alpha[begin, rows] + weight)
                here.append((end, rows, node, weight))
            if kept is not None:
                kept.append(here)
        return alpha

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """Natural logarithm of each word's probability over all its segmentations."""
        out = np.empty(len(words))
        short = np.array([len(w) <= LONGEST for w in words], bool)
        for i in np.flatnonzero(~short).tolist():
            out[i] = forward(edges(words[i], self.one_by_one()))[-1]
        at = np.flatnonzero(short)
        if len(at):
            order, characters, lengths, active = self.table([words[i] for i in at.tolist()])
            out[at[order]] = self._alpha(characters, active)[lengths, np.arange(len(order))]
        return out

    def expected(self, words: list[str], times: np.ndarray, counts: np.ndarray, others: Counter) -> None:
        """Adds the expected number of each piece: by number to ``counts``, bytes and long words to ``others``."""
        short = np.array([len(w) <= LONGEST for w in words], bool)
        for i in np.flatnonzero(~short).tolist():
            expected_pieces(words[i], float(times[i]), self.one_by_one(), others)
        at = np.flatnonzero(short)
        if not len(at):
            return
        order, characters, lengths, active = self.table([words[i] for i in at.tolist()])
        times = np.asarray(times, np.float64)[at[order]]
        kept: list = []
        alpha = self._alpha(characters, active, kept)
        total = alpha[lengths, np.arange(len(order))]
        beta = np.full_like(alpha, -np.inf)
        beta[lengths, np.arange(len(order))] = 0.0
        numbers, shares = [], []
        for begin in range(len(kept) - 1, -1, -1):
            for end, rows, node, weight in kept[begin]:
                through = weight + beta[end, rows]
                beta[begin, rows] = np.logaddexp(beta[begin, rows], through)
                share = times[rows] * np.exp(alpha[begin, rows] + through - total[rows])
                spell = node < 0
                if spell.any():
                    kinds, which = np.unique(characters[rows[spell], begin], return_inverse=True)
                    for kind, amount in zip(kinds.tolist(), np.bincount(which, share[spell]).tolist()):
                        for name in spelled(chr(kind)):
                            others[name] += amount
                    node, share = node[~spell], share[~spell]
                numbers.append(self.number[node])
                shares.append(share)
        counts += np.bincount(np.concatenate(numbers), np.concatenate(shares), minlength=len(counts))
