"""Spaced seeds miss no leak that the verification accepts: the masks by themselves, and joined, against brute force."""

import random
import re
import sys
from itertools import product
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]

from areapanel.llm import decontamination as D  # noqa: E402


def words(text):
    return re.findall(r"[^\x20\x09-\x0D!-/:-@\[-`{-~]+", (text or "").lower())


def longest_run(same):
    n = missed = best = 0
    for hit in same:
        n, missed = (n + 1, 0) if hit else (0 if missed else n, missed + 1)
        best = max(best, n)
    return best


def brute(docs, bench):
    out = {}
    for (d, text), (i, item) in product(docs, bench):
        have, want = words(text), words(item)
        if not want:
            continue
        for lag in range(1 - len(want), len(have)):
            same = [0 <= j + lag < len(have) and have[j + lag] == w for j, w in enumerate(want)]
            run = longest_run(same)
            if 100 * sum(same) >= D.SHARE * len(want) or run >= D.RUN:
                out[d, i] = max(out.get((d, i), (0, 0, 0, 0)), (sum(same), -lag, len(want), run))
    return sorted((d, i, n, size, run, -back) for (d, i), (n, back, size, run) in out.items())


def found(spark, docs, bench):
    rows = D.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    return sorted(tuple(r) for r in rows.collect())


def most_unseen(masks, length):
    """Most kept words in a pattern of each length that no mask meets."""
    span = max(map(len, masks)) - 1
    best, out = {(0,) * span: 0}, [0]
    for _ in range(length):
        grown = {}
        for state, n in best.items():
            for bit in (0, 1):
                window = (*state, bit)
                if bit and any(all(w for w, m in zip(window[-len(mask) :], mask) if m == "1") for mask in masks):
                    continue
                grown[window[1:]] = max(grown.get(window[1:], -1), n + bit)
        best = grown
        out.append(max(best.values()))
    return out


def test_masks_meet_every_share():
    # most(n + m) <= most(n) + most(m), so what holds from LONG to 2 * LONG - 1 holds for all longer items.
    most = most_unseen(D.MASKS, 2 * D.LONG)
    assert all(100 * most[n] < D.SHARE * n for n in range(D.LONG, 2 * D.LONG))


def test_masks_meet_every_run():
    for gaps in product((1, 2), repeat=D.RUN - 1):
        kept = {sum(gaps[:k]) for k in range(D.RUN)}
        assert any(all(at + k in kept for k, m in enumerate(mask) if m == "1") for mask in D.MASKS for at in kept), gaps


def changed(text, kept):
    return " ".join(w if k else f"new{j}" for j, (w, k) in enumerate(zip(text.split(), kept)))


def test_replaced_words(spark):
    draw = random.Random(5)
    sizes = [15, 16, 20, 27, 40, 60]
    bench = [(i, " ".join(f"i{i}w{j}" for j in range(n))) for i, n in enumerate(sizes)]
    docs = []
    for i, item in bench:
        n = sizes[i]
        patterns = [[j % period != phase for j in range(n)] for period in (2, 3, 4, 5) for phase in range(period)]
        for share in (60, 66, 70, 75, 80):
            for _ in range(8):
                gone = set(draw.sample(range(n), n - -(-share * n // 100)))
                patterns.append([j not in gone for j in range(n)])
        docs += [(1000 * i + k, f"before it {changed(item, kept)} after it") for k, kept in enumerate(patterns)]
        docs += [(1000 * i + 900, " ".join(item.split()[2:])), (1000 * i + 901, " ".join(item.split()[:-2]))]
    right = brute(docs, bench)
    assert found(spark, docs, bench) == right
    assert {d for d, *_ in right} >= {5000 + 5, 5000 + 9}


def test_short_masks_meet_every_share():
    for low, high, masks in D.SHORT_MASKS:
        most = most_unseen(masks, high)
        assert all(100 * most[n] < D.SHARE * n for n in range(low, high + 1))
    assert [kind[0] for kind in D.SHORT_MASKS] == [1, 2, 3] and D.SHORT_MASKS[-1][1] + 1 == D.LONG


def test_short_items(spark):
    bench = [(n, " ".join(f"i{n}w{j}" for j in range(n))) for n in range(1, 17)] + [(99, None), (98, " ,. ")]
    docs = [(1000 * n, item) for n, item in bench if n < 98] + [(7, None), (8, "of nothing")]
    for n, item in bench[:16]:
        docs.append((1000 * n + 500, f"before, {item} after"))
        # Every way to replace one word, and two.
        pairs = [{a, b} for a in range(n) for b in range(a, n)]
        docs += [(1000 * n + 1 + k, "x " + changed(item, [j not in gone for j in range(n)])) for k, gone in enumerate(pairs)]
    right = brute(docs, bench)
    assert found(spark, docs, bench) == right
    assert {(1000 * n, n) for n in range(1, 17)} <= {r[:2] for r in right}


def test_rows_without_id_are_judged_singly(spark):
    item = " ".join(f"leak{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, item, 1, "a"), (None, "a clean text of its own", 2, "b"), (None, None, 3, "c"), (5, item, 4, "d"), (6, "clean", 5, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _leaked int, row string")
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["_leaked"] for r in kept.collect()) == [2, 3, 5]
    assert D.decontaminate(docs.limit(0), bench).count() == 0
    assert D.decontaminate(docs, bench.limit(0)).count() == 5


def test_blocks_of_long_texts(spark):
    bench = [(1, "often"), (2, " ".join(f"w{j}" for j in range(700))), (3, "x y z"), (3, "other words here"), (None, "no id at all")]
    around = [" ".join(f"f{j}" for j in range(n)) for n in (0, 250, 255, 256, 511)]
    docs = [(k, f"{a} {bench[1][1]} {a}") for k, a in enumerate(around)]
    docs += [(10, " ".join(bench[1][1].split()[300:])), (11, " ".join(bench[1][1].split()[:500])), (12, f"{around[2]} x y z"), (12, "other words here")]
    docs += [(13, "x q z"), (13, "x q z"), (None, "x y z"), (None, "no id at all"), (14, f"{around[3]} often")]
    rows = D.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    got = {tuple(r)[:4] for r in rows.collect()}
    assert got == {r[:4] for r in brute_rows(docs, bench)}


def brute_rows(docs, bench):
    """As brute, where ids repeat or are null: the best of all pairs of rows under one pair of ids."""
    best = {}
    for d, i in product(docs, bench):
        for _, _, n, size, run, at in brute([(0, d[1])], [(0, i[1])]):
            best[d[0], i[0]] = max(best.get((d[0], i[0]), (0, 0)), (n, size, run, at))
    return [(d, i, n, size, run, at) for (d, i), (n, size, run, at) in best.items()]


def test_a_frequent_seed_in_a_long_text(spark):
    docs = [(1, "the word " * 40_000)]
    assert found(spark, docs, [(1, "word"), (2, "not there")]) == [(1, 1, 1, 1, 1, 1)]
