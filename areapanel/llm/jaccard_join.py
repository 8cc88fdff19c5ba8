"""N-gram Jaccard join: groups of similar documents, token unions, and bounds that decide what is opened.

1. Sets. A document's set are the hashes of its distinct word shingles; equal sets are one node.
2. Coarse bound. The matrix has one column per node and one row per shingle; all other nodes are one
   group, and its union is the shingles that another node has too. A node can only link if its overlap
   with that union reaches the threshold. This leaves the near copies.
3. Pivots. Nodes that share the least shingle of some order are a group; its smallest node is the
   pivot. Nodes close to a pivot join its class, so that most near copies are of one class already.
4. Groups. Linked nodes share one of their rarest shingles (prefix filter), so nodes of different
   classes that could link meet under such a shingle. They are cut into groups of similar size; the
   overlap of a query with a group's token union bounds its overlap with every member, and only groups that
   reach the threshold are opened and compared.
5. Components over the links, by star contraction.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import spans as sp
from .common import cut_lineage, partitions, text_bytes
from .de_bruijn_dedup import word_hashes
from .suffix_dedup import BUCKET_BYTES, PACKED, keyed

SHINGLE = 5
PERCENT = 75
ORDERS = 6
"""Orders of tokens that pivots are sought by."""

MEMBERS = 64
"""Nodes in a group of the matrix."""

BLOCK = 512
"""Nodes of one side of a comparison; larger meetings are cut into pairs of blocks."""

SAMPLE_NODES = 2048
HOT_SHARE = 64
"""A shingle that more than one in HOT_SHARE sampled nodes have comes last in the common order."""

COUNT_BYTES = 16 << 20
"""Text whose tokens one bucket of the coarse bound takes; few buckets keep a node's tokens together under one name."""

ROWS, COUNTS, TOKENS = 0, 1, 2
"""What a dealt value holds: rows of documents, counts by node, tokens by node."""

DEALT = "group int, kind int, blob binary"
_DEALT = pa.schema([("group", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])
_PACKED = pa.schema([("group", pa.int32()), ("blob", pa.binary())])
_NODES = pa.schema([("id", pa.int64()), ("mark", pa.int64()), ("n", pa.int64()), ("node", pa.binary())])
_LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary())])
LINKS = "a binary, b binary"


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; a shorter text is one shingle, a blank one has none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    hashes = word_hashes(data, np.flatnonzero(data == 32))
    if len(hashes) < size:
        whole = sp.gram_hashes(hashes, len(hashes))
        return sp.mix(whole + np.uint64(len(hashes)))
    return np.unique(sp.gram_hashes(hashes, size))


def needed(size):
    """Least overlap with a set of this size, or any larger one, that can reach the threshold."""
    return -(-PERCENT * size // 100)


def node_of(tokens: np.ndarray) -> bytes | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def _sets(batch):
    """(row, tokens) of each row of a batch that has any."""
    for row, text in enumerate(batch.column(batch.schema.get_field_index("text"))):
        tokens = shingles(text.as_py())
        if len(tokens):
            yield row, tokens


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)


def _dealt(group: int, kind: int, *arrays: np.ndarray) -> pa.RecordBatch:
    return sp.rows_batch(_DEALT, [(group, kind, sp.pack(*arrays))])


def _by_name(names: np.ndarray, counts: np.ndarray, groups: int):
    """Packed (names, counts) of the nodes that have any, by name."""
    some = counts > 0
    names, counts = names[some], counts[some]
    for group, at in sp.by_group((names[:, 0] % np.uint64(groups)).astype(np.int64)):
        yield _dealt(group, COUNTS, names[at].reshape(-1), counts[at].astype(np.int64))


def _deal(parts: int, groups: int):
    """Each text is hashed once here: its row (id, mark, size, node), and its tokens by bucket, node by node.

    Of a token that many nodes of a batch have, two say so and the rest is counted here.
    """

    def deal(batches):
        for batch in sp.larger(batches):
            if not batch.num_rows:
                continue
            ids, marks = sp.columns_of(batch, "id", "mark")
            size, names, lists, seen = np.zeros(len(ids), np.int64), np.zeros((len(ids), 2), np.uint64), [], {}
            for row, tokens in _sets(batch):
                node = node_of(tokens)
                size[row], names[row] = len(tokens), np.frombuffer(node, np.uint64)
                if node not in seen:
                    seen[node] = row
                    lists.append(tokens)
            yield _dealt(int(np.uint64(marks.view(np.uint64)[0]) % np.uint64(parts)), ROWS, ids, marks, size, names.reshape(-1))
            if not lists:
                continue
            names = names[list(seen.values())]
            owner = np.repeat(np.arange(len(names)), [len(x) for x in lists])
            tokens = np.concatenate(lists)
            order = np.argsort(tokens, kind="stable")
            first = _runs(tokens[order])
            nth = np.arange(len(tokens)) - np.repeat(first, np.diff(np.append(first, len(tokens))))
            spare = np.zeros(len(tokens), bool)
            spare[order] = nth >= 2
            for group, at in sp.by_group((names[:, 0] % np.uint64(parts)).astype(np.int64)):
                counts = np.bincount(owner[spare], minlength=len(names))[at]
                if counts.any():
                    yield _dealt(group, COUNTS, names[at][counts > 0].reshape(-1), counts[counts > 0].astype(np.int64))
            owner, tokens = owner[~spare], tokens[~spare]
            for group, at in sp.by_group((tokens % np.uint64(parts)).astype(np.int64)):
                mine = owner[at]
                begins = _runs(mine)
                sizes = np.diff(np.append(begins, len(mine))).astype(np.uint32)
                yield _dealt(group, TOKENS, names[mine[begins]].reshape(-1), sizes, (tokens[at] >> np.uint64(32)).astype(np.uint32))

    return deal


def _count(groups: int):
    """How many tokens of each node another node has too, in this bucket; never fewer, as an upper bound must be.

    A node that several batches hold is taken once. Tokens are cut to 32 bits: two that become equal
    both count, so that a cut can only raise a count. Rows are passed on.
    """

    def count(batches):
        names, sizes, tokens = [np.zeros((0, 2), np.uint64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
        for batch in batches:
            for kind, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if kind == ROWS:
                    yield sp.rows_batch(_DEALT, [(0, ROWS, blob)])
                    continue
                name, *rest = sp.unpack(blob)
                name = name.reshape(-1, 2)
                if kind == COUNTS:
                    yield from _by_name(name, rest[0], groups)
                else:
                    names.append(name)
                    sizes.append(rest[0])
                    tokens.append(rest[1])
        names, sizes, tokens = np.concatenate(names), np.concatenate(sizes), np.concatenate(tokens)
        if not len(tokens):
            return
        order = np.lexsort((names[:, 1], names[:, 0]))
        same = (names[order][1:] == names[order][:-1]).all(axis=1)
        again = np.zeros(len(names), bool)
        again[order[1:]] = same
        owner = np.repeat(np.arange(len(names), dtype=np.uint64), sizes)
        once = np.repeat(~again, sizes)
        ranked = np.sort((tokens[once].astype(np.uint64) << np.uint64(32)) | owner[once])
        owner = (ranked & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = _runs(ranked >> np.uint64(32))
        last = np.append(first[1:], len(ranked)) - 1
        shared = np.repeat(owner[first] != owner[last], last - first + 1)
        yield from _by_name(names, np.bincount(owner[shared], minlength=len(names)), groups)

    return count


FOLD = 1 << 20
"""Counts held before they are added up by node."""


def _total(batches):
    """(node, shared): the counts of all buckets added up; a task sees every count of its nodes."""

    def folded(names, counts):
        names, counts = np.concatenate(names), np.concatenate(counts)
        order = np.lexsort((names[:, 1], names[:, 0]))
        names, counts = names[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], (names[1:] != names[:-1]).any(axis=1))))
        return names[first], np.add.reduceat(counts, first)

    names, counts, fresh = [], [], 0
    for batch in batches:
        for blob in batch.column(2).to_pylist():
            name, count = sp.unpack(blob)
            names.append(name.reshape(-1, 2))
            counts.append(count)
            fresh += len(count)
            if fresh > max(FOLD, len(names[0])):
                name, count = folded(names, counts)
                names, counts, fresh = [name], [count], 0
    if names:
        name, count = folded(names, counts)
        for k in range(0, len(name), 4096):
            nodes = [x.tobytes() for x in name[k : k + 4096]]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(count[k : k + 4096])], names=["node", "shared"])


def _rows(batches):
    for batch in batches:
        for blob in batch.column(2).to_pylist():
            ids, marks, size, names = sp.unpack(blob)
            nodes = [x.tobytes() if n else None for x, n in zip(names.reshape(-1, 2), size)]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(marks), pa.array(size), pa.array(nodes, pa.binary())], schema=_NODES)


def named(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, mark, n, node) of every row, and (node, shared): an upper bound of each node's overlap with the union of all others."""
    groups = partitions(rows.sparkSession)
    parts = max(groups, -(-text_bytes(rows) // COUNT_BYTES))
    dealt = rows.mapInArrow(_deal(parts, groups), DEALT).repartitionById(parts, "group")
    met = cut_lineage(dealt.mapInArrow(_count(groups), DEALT))
    nodes = met.where(F.col("kind") == ROWS).mapInArrow(_rows, "id long, mark long, n long, node binary")
    shared = met.where(F.col("kind") == COUNTS).repartitionById(groups, "group").mapInArrow(_total, "node binary, shared long")
    return nodes, shared


def near_copies(nodes: DataFrame, shared: DataFrame) -> DataFrame:
    """Nodes whose overlap with the union of all others reaches the threshold, with the row that shows their text."""
    shown = nodes.where("node IS NOT NULL").groupBy("node").agg(F.first("n").alias("n"), F.min(F.struct("id", "mark")).alias("shown"))
    live = shown.join(shared, "node").where(F.col("shared") * 100 >= PERCENT * F.col("n"))
    return live.select("node", "n", "shown.id", "shown.mark")


def _open_sets(batches):
    for batch in batches:
        nodes = batch.column(batch.schema.get_field_index("node")).to_pylist()
        found = {row: tokens.tobytes() for row, tokens in _sets(batch)}
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array([found.get(i, b"") for i in range(len(nodes))], pa.binary())], names=["node", "tokens"]
        )


def _hot(batches):
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(blob, np.int64))], names=["token"])


def hot_tokens(sets: DataFrame, count: int) -> np.ndarray:
    """Tokens that many sampled nodes have, sorted; at most HOT_SHARE times a set's mean size of them."""
    every = max(1, count // SAMPLE_NODES)
    sample = sets.where(F.pmod(F.xxhash64("node"), F.lit(every)) == 0).select("tokens")
    limit = max(8, count // every // HOT_SHARE)
    found = sample.mapInArrow(_hot, "token long").groupBy("token").count().where(F.col("count") > limit).select("token")
    return np.sort(np.array([r["token"] for r in found.collect()], np.int64).view(np.uint64))


OFTEN = (1 << 32) - 1


def _blobs_by_bucket(nodes: np.ndarray, owner: np.ndarray, tokens: np.ndarray, counts: np.ndarray, buckets: np.ndarray):
    """Packed (nodes, tokens of each, tokens, counts) per bucket; nodes are two numbers each."""
    for group, at in sp.by_group(buckets):
        used, sizes = np.unique(owner[at], return_counts=True)
        at = at[np.argsort(owner[at], kind="stable")]
        yield sp.rows_batch(_PACKED, [(group, sp.pack(nodes[used].reshape(-1), sizes.astype(np.uint32), tokens[at], counts[at]))])


def _unpacked(batches):
    """All (node numbers, owner of each token, tokens, counts) of a bucket, each node once."""
    names, owners, tokens, counts, seen = [np.zeros((0, 2), np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)], 0
    for batch in batches:
        for blob in batch.column(1).to_pylist():
            name, sizes, values, number = sp.unpack(blob)
            names.append(name.reshape(-1, 2))
            owners.append(np.repeat(np.arange(seen, seen + len(sizes)), sizes))
            tokens.append(values)
            counts.append(number)
            seen += len(sizes)
    name, inverse = np.unique(np.concatenate(names), axis=0, return_inverse=True)
    return name, inverse.reshape(-1)[np.concatenate(owners)] if seen else np.concatenate(owners), np.concatenate(tokens), np.concatenate(counts)


def ranked_sets(sets: DataFrame, hot: np.ndarray, parts: int) -> DataFrame:
    """(node, tokens): the size of a node's set, and its tokens that another node has too, rarest first, then by hash.

    Tokens no other node has are counted in the size only. Hot tokens are not counted; they come last.
    """

    def deal(batches):
        for batch in sp.larger(batches):
            nodes = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64).reshape(-1, 2)
            lists = [np.frombuffer(x, np.uint64) for x in batch.column(1).to_pylist()]
            owner, tokens = np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate(lists)
            late = np.isin(tokens, hot)
            often = np.where(late, OFTEN, 1).astype(np.uint32)
            yield from _blobs_by_bucket(nodes, owner, tokens, often, (np.where(late, nodes[owner, 0], tokens) % np.uint64(parts)).astype(np.int64))

    def count(batches):
        nodes, owner, tokens, counts = _unpacked(batches)
        if not len(tokens):
            return
        order = np.argsort(tokens, kind="stable")
        ranked = tokens[order]
        first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        met = np.diff(np.append(first, len(ranked)))
        counts = counts.copy()
        counts[order] = np.maximum(counts[order], np.repeat(np.minimum(met, OFTEN), met).astype(np.uint32))
        kept = counts > 1
        owner, tokens, counts = owner[kept], tokens[kept], counts[kept]
        yield from _blobs_by_bucket(nodes, owner, tokens, counts, (nodes[owner, 0] % np.uint64(parts)).astype(np.int64))

    def gather(batches):
        nodes, owner, tokens, counts = _unpacked(batches)
        order = np.lexsort((tokens, counts, owner))
        bounds = np.searchsorted(owner[order], np.arange(len(nodes) + 1))
        tokens = tokens[order]
        for k in range(0, len(nodes), 512):
            part = range(k, min(k + 512, len(nodes)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([nodes[i].tobytes() for i in part], pa.binary()),
                    pa.array([tokens[bounds[i] : bounds[i + 1]].tobytes() for i in part], pa.binary()),
                ],
                names=["node", "shared"],
            )

    met = sets.select("node", "tokens").mapInArrow(deal, PACKED).repartitionById(parts, "group").mapInArrow(count, PACKED)
    shared = met.repartitionById(parts, "group").mapInArrow(gather, "node binary, shared binary")
    size = F.floor(F.octet_length("tokens") / 8).cast("long")
    return sets.select("node", size.alias("n")).join(shared, "node").select("node", "n", F.col("shared").alias("tokens"))


def _prefix(batches):
    """The rarest tokens of each node: as many as a linked node must share one of, less those it has alone."""
    for batch in batches:
        nodes, classes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out_node, out_class, out_token = [], [], [np.zeros(0, np.uint64)]
        for node, klass, n, blob in zip(nodes, classes, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            tokens = np.frombuffer(blob, np.uint64)
            kept = tokens[: max(0, n - needed(n) + 1 - (n - len(tokens)))]
            out_node += [node] * len(kept)
            out_class += [klass] * len(kept)
            out_token.append(kept)
        values = np.concatenate(out_token).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out_node, pa.binary()), pa.array(out_class, pa.binary()), pa.array(values)], names=["node", "class", "token"]
        )


def _least_tokens(batches):
    """The least token of each node in each of several orders; near copies share most of them."""
    for batch in batches:
        nodes, out = batch.column(0).to_pylist(), []
        for blob in batch.column(1).to_pylist():
            tokens = np.frombuffer(blob, np.uint64)
            out.append([sp.mix(tokens ^ np.uint64(k * 0x5851F42D4C957F2D % (1 << 64))).min() if len(tokens) else k for k in range(1, ORDERS + 1)])
        values = np.array(out, np.uint64).reshape(-1).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([n for n in nodes for _ in range(ORDERS)], pa.binary()), pa.array(values)], names=["node", "token"])


def linked(x: np.ndarray, y: np.ndarray, n: int, m: int) -> bool:
    """Whether sets of n and m tokens link, from those of their tokens that they may share."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (n + m - both)


def _to_pivot(batches):
    for batch in batches:
        pairs = zip(*[c.to_pylist() for c in batch.columns])
        near = [
            (node, pivot if linked(np.frombuffer(t, np.uint64), np.frombuffer(p, np.uint64), n, m) else node) for node, n, t, pivot, m, p in pairs
        ]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in near], pa.binary()) for i in (0, 1)], names=["node", "class"])


def pivot_classes(sets: DataFrame) -> DataFrame:
    """(node, class): nodes joined by the links to their pivots, the smallest nodes with the same least token."""
    least = sets.select("node", "tokens").mapInArrow(_least_tokens, "node binary, token long")
    pivots = least.groupBy("token").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    paired = least.join(pivots, "token").where("node <> pivot").select("node", "pivot").distinct()
    with_pivot = paired.join(sets.select(F.col("node").alias("pivot"), F.col("n").alias("m"), F.col("tokens").alias("pivot_tokens")), "pivot")
    both = with_pivot.join(sets, "node").select("node", "n", "tokens", "pivot", "m", "pivot_tokens")
    links = both.mapInArrow(_to_pivot, "node binary, class binary").select(F.col("node").alias("a"), F.col("class").alias("b"))
    found = sets.select("node").join(components(links), "node", "left")
    return found.select("node", F.coalesce("root", "node").alias("class"))


def meetings(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(meeting, side, node, class): nodes of different classes that share one of their first tokens.

    Lists of nodes that overlap form a family; a family of up to BLOCK nodes is one meeting. In larger
    families a meeting is a token's list of nodes; of equal lists one is kept. Nodes are sorted by class
    into blocks, and a long list becomes one meeting per pair of blocks, except for pairs within a class.
    """
    given = sets.join(classes, "node").select("node", "class", "n", "tokens")
    prefix = given.mapInArrow(_prefix, "node binary, class binary, token long")
    lists = prefix.groupBy("token").agg(
        F.count(F.lit(1)).alias("m"),
        F.min("class").alias("low"),
        F.max("class").alias("high"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sign"),
        F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(38,0)")).alias("sign2"),
    )
    mixed = lists.where("low < high").groupBy("sign", "sign2", "m").agg(F.min("token").alias("token"))
    listed = cut_lineage(prefix.join(mixed.select("token"), "token"))
    hubs = listed.groupBy("token").agg(F.min("node").alias("hub"))
    tied = listed.join(hubs, "token").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    family = listed.select("node").distinct().join(components(tied), "node", "left").select("node", F.coalesce("root", "node").alias("family"))
    size = family.groupBy("family").count()
    family = cut_lineage(family.join(size, "family"))
    small = family.where(F.col("count") <= BLOCK).join(classes, "node")
    whole = small.select(F.xxhash64("family").alias("meeting"), F.lit(0).alias("side"), "node", "class")
    listed = listed.join(family.where(F.col("count") > BLOCK).select("node"), "node", "left_semi")
    rank = F.row_number().over(W.partitionBy("token").orderBy("class", "node")) - 1
    blocked = cut_lineage(listed.withColumn("block", F.floor(rank / BLOCK).cast("int")))
    blocks = blocked.groupBy("token", "block").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    other = blocks.select("token", F.col("block").alias("block2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    pairs = blocks.join(other, "token").where(
        (F.col("block") <= F.col("block2")) & ~((F.col("low") == F.col("high")) & (F.col("low") == F.col("low2")) & (F.col("low2") == F.col("high2")))
    ).select("token", "block", "block2", F.xxhash64("token", "block", "block2").alias("meeting"))
    left = blocked.join(pairs, ["token", "block"]).select("meeting", F.lit(0).alias("side"), "node", "class")
    right = (
        blocked.withColumnRenamed("block", "block2")
        .join(pairs.where("block < block2").select("token", "block2", "meeting"), ["token", "block2"])
        .select("meeting", F.lit(1).alias("side"), "node", "class")
    )
    return whole.unionByName(left).unionByName(right)


def _compare(table: pa.Table) -> pa.Table:
    """Links between the classes of a meeting, one for each pair of classes that must be joined.

    The matrix has a row for each token of the members and a column for each group: the rows of a
    query's tokens, added up, are its overlaps with the unions of all groups at once.
    """
    side = table.column("side").to_numpy()
    nodes, classes = table.column("node").to_pylist(), table.column("class").to_pylist()
    sets = [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]
    size = table.column("n").to_pylist()
    parent = {c: c for c in classes}

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    one_block = not side.any()
    queries = np.flatnonzero(side == 0)
    members = sorted(queries if one_block else np.flatnonzero(side == 1), key=lambda i: (size[i], nodes[i]))
    groups = [members[k : k + MEMBERS] for k in range(0, len(members), MEMBERS)]
    values, rows = np.unique(np.concatenate([sets[i] for i in members]), return_inverse=True)
    lengths = [len(sets[i]) for i in members]
    matrix = np.zeros((len(values), len(groups)), bool)
    matrix[rows, np.repeat(np.arange(len(members)) // MEMBERS, lengths)] = True
    rows_of = dict(zip(members, np.split(rows, np.cumsum(lengths)[:-1])))
    mine = np.zeros(len(values), bool)
    found = []
    for q in queries:
        if one_block:
            at = rows_of[q]
        else:
            at = np.searchsorted(values, sets[q])
            at = at[values[np.minimum(at, len(values) - 1)] == sets[q]] if len(values) else at[:0]
        bound, least = matrix[at].sum(axis=0), needed(size[q])
        mine[at] = True
        for group, most in zip(groups, bound):
            if size[group[-1]] < least or PERCENT * size[group[0]] > 100 * size[q] or most < least:
                continue
            for i in group:
                a, b = root(classes[q]), root(classes[i])
                if a == b:
                    continue
                both = int(mine[rows_of[i]].sum())
                if 100 * both >= PERCENT * (size[q] + size[i] - both):
                    parent[max(a, b)] = min(a, b)
                    found.append((min(classes[q], classes[i]), max(classes[q], classes[i])))
        mine[at] = False
    return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())}, schema=_LINKS)


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, by alternating large and small stars."""

    def digest(edges: DataFrame):
        """Two sums over distinct edges; equal sets of edges have equal sums, others do not but by chance of 2^-64."""
        marks = [F.sum(F.xxhash64("a", "b", F.lit(k)).cast("decimal(38,0)")) for k in (1, 2)]
        return tuple(edges.agg(F.count(F.lit(1)), *marks).first())

    edges = cut_lineage(links.select("a", "b").where("a <> b").distinct())
    before = digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # m <= a < b, so every edge already points down.
        down = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        joined = down.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b")))
        edges = cut_lineage(small.where("a <> b").distinct())
        after = digest(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after


def node_components(docs: DataFrame) -> DataFrame:
    """(id, mark, n, node, root) of every row; null nodes have no shingle, null roots link with nothing else."""
    spark = docs.sparkSession
    rows = keyed(docs)
    parts = max(partitions(spark), -(-text_bytes(docs) // BUCKET_BYTES), 1)
    nodes, shared = named(rows)
    live = cut_lineage(near_copies(nodes, shared))
    texts = rows.join(live.select("id", "mark", "node"), ["id", "mark"]).select("node", "text").dropDuplicates(["node"])
    sets = cut_lineage(texts.mapInArrow(_open_sets, "node binary, tokens binary"))
    sets = cut_lineage(ranked_sets(sets, hot_tokens(sets, live.count()), parts))
    classes = cut_lineage(pivot_classes(sets))
    met = meetings(sets, classes).join(sets, "node")
    across = met.groupBy("meeting").applyInArrow(_compare, LINKS)
    stars = classes.where("node <> class").select(F.col("node").alias("a"), F.col("class").alias("b"))
    return nodes.join(components(stars.unionByName(across)), "node", "left")


def jaccard_join(docs: DataFrame) -> DataFrame:
    """Per document the size of its set and its component: the smallest doc_id it reaches over links.

    Equal sets are one node from the start, so copies never meet. Documents without a shingle form
    components of their own. Rows without an id link like others and take the smallest id of their
    component, or null where it has none. Repeated rows and other columns do not matter.
    """
    found = node_components(docs)
    root = F.coalesce("root", "node")
    least = found.where("node IS NOT NULL").groupBy(root.alias("root")).agg(F.min("id").alias("least"))
    joined = found.withColumn("_root", root).join(least.withColumnRenamed("root", "_root"), "_root", "left")

    def restored(c):
        return F.when(c != int(sp.LAST), c)

    return joined.select(
        restored(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"), restored(F.coalesce("least", "id")).alias("component_id")
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, then the smallest mark; documents without shingles stay."""
    found = node_components(docs)
    root = F.coalesce("root", "node")
    kept = found.where("node IS NOT NULL").groupBy(root.alias("root")).agg(F.min(F.struct("id", "mark")).alias("k")).select("k.id", "k.mark")
    bare = found.where("node IS NULL").select("id", "mark")
    wanted = kept.unionByName(bare.distinct()).select(F.col("id").alias("_id"), F.col("mark").alias("_mark"))
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    given = docs.select(row, F.coalesce(F.col("doc_id").cast("long"), F.lit(int(sp.LAST))).alias("_id"), F.xxhash64("doc_id", text).alias("_mark"))
    given = given.withColumn("_blank", F.btrim(text_of("row"), F.lit(" \t\n\x0b\x0c\r")) == "")
    met = given.join(wanted, ["_id", "_mark"], "left_semi")
    # Repeated rows share id and mark; one of them stays.
    nth = F.row_number().over(W.partitionBy("_id", "_mark").orderBy("_blank"))
    return met.withColumn("_nth", nth).where(F.col("_blank") | (F.col("_nth") == 1)).select("row.*")


def text_of(row: str):
    return F.coalesce(F.col(f"{row}.text"), F.lit(""))
