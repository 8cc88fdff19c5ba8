"""Plain Python versions of what the operators return."""

import hashlib
from collections import Counter, defaultdict

LAST = (1 << 63) - 1


def byte_dedup(rows, window=50):
    rows = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in rows:
        for s in range(len(t) - window + 1):
            first[t[s : s + window]] = min(first.get(t[s : s + window], LAST), i)
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for s in range(len(t) - window + 1):
            if first[t[s : s + window]] < i:
                gone[s : s + window] = b"\1" * window
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def word_dedup(rows, window=20):
    rows = [(LAST if i is None else i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in rows:
        for s in range(len(w) - window + 1):
            g = tuple(w[s : s + window])
            first[g] = min(first.get(g, (i, s)), (i, s))
    out = []
    for i, w in rows:
        gone = [0] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (i, s):
                gone[s : s + window] = [1] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def jaccard(rows, percent=75):
    sets, postings = [], defaultdict(list)
    for k, (_, t) in enumerate(rows):
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
        for x in sets[k]:
            postings[x].append(k)
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for k, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in postings[x] if j > k).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n) and root(k) != root(j):
                parent[max(root(k), root(j))] = min(root(k), root(j))
    least = defaultdict(lambda: LAST)
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least[root(k)], LAST if i is None else i)
    return sorted((LAST if i is None else i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows))


def repeated_words(text, size=5):
    w = (text or "").encode().split()
    grams = [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]
    seen = Counter(grams)
    return len({p for i, g in enumerate(grams) if seen[g] > 1 for p in range(i, i + size)})
