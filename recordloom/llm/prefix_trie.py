"""Prefix trie of conversations as flat tables.

A node is a distinct sequence of first turns, known by a 128-bit digest of it.
Counts of a node come from one grouped aggregation.  Sums over subtrees come from
shards of whole conversations: a shard numbers its distinct digests by a minimal
perfect hash, scatters what it owns into flat arrays and adds it up through the
array of parent slots, deepest level first.  Every node is owned by one shard, that
of its smallest member, so the shards' sums add up to the tree's.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import take, written

U = np.uint64
#: Rebuilding: conversation ``c - c % GROUP`` lends its first ``crc32(c) % HEADS`` turns.
GROUP, HEADS = 5, 9
#: Path rows that one set of arrays holds, if more than one conversation.
SHARD_ROWS = 1 << 19
#: Of N nodes fewer than HEAVY have more than N / HEAVY children; their names are broadcast.
HEAVY = 1000
#: Ids of members that end at a node are joined in pieces of so many consecutive ids.
ID_PIECE = 4096

PATHS = "conv_id bigint, depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, bytes bigint, ends boolean"
PARTS = "k1 bigint, k2 bigint, n_leaves bigint, saved bigint"
ENDS = "k1 bigint, k2 bigint, s0 bigint, s1 bigint, s2 bigint, s3 bigint"


# ---- rebuilt conversations as paths


class Rebuild:
    """Turns in order, a base's own conversation before the others of its base, to a row per prefix of the rebuilt ones.

    Only the base's first turns are kept; a conversation is never held.
    """

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.open = False
        self.base: int | None = None
        self.lent: list[tuple[bytes, int]] = []

    def start(self, base: int | None, conv: int | None) -> None:
        self.finish()
        if base != self.base or base is None:
            self.base, self.lent = base, []
        self.open, self.conv, self.seen = True, conv, 0
        self.digest, self.parent, self.depth, self.size = hashlib.md5(b"root").digest(), None, 0, 0
        self.lends, self.skip = conv == base, 0
        if not self.lends:
            self.skip = zlib.crc32(str(conv).encode()) % HEADS
            for turn, size in self.lent[: self.skip]:
                self.step(turn, size)

    def emit(self, ends: bool) -> None:
        self.rows.append((self.conv, self.depth, self.digest, self.parent, self.size, ends))

    def step(self, turn: bytes, size: int) -> None:
        self.emit(False)
        self.digest, self.parent = hashlib.md5(self.digest + turn).digest(), self.digest
        self.depth, self.size = self.depth + 1, size

    def turn(self, turn: bytes, size: int) -> None:
        if self.lends and self.seen < HEADS - 1:
            self.lent.append((turn, size))
        if self.seen >= self.skip:
            self.step(turn, size)
        self.seen += 1

    def finish(self) -> None:
        if self.open:
            self.emit(True)
            self.open = False

    def batch(self) -> pa.RecordBatch:
        conv, depth, k, p, size, ends = zip(*self.rows, strict=True)
        self.rows = []
        top = np.array([x is None for x in p])
        k = np.frombuffer(b"".join(k), np.int64).reshape(-1, 2)
        p = np.frombuffer(b"".join(x or bytes(16) for x in p), np.int64).reshape(-1, 2)
        columns = [pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), pa.array(k[:, 0]), pa.array(k[:, 1]), pa.array(p[:, 0], mask=top),
                   pa.array(p[:, 1], mask=top), pa.array(size, pa.int64()), pa.array(ends)]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "depth", "k1", "k2", "p1", "p2", "bytes", "ends"])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, last = Rebuild(), object()
    for b in batches:
        for base, conv, turn, size in zip(*[b.column(i).to_pylist() for i in range(4)], strict=True):
            if conv != last:
                now.start(base, conv)
                last = conv
            now.turn(turn, size)
        if len(now.rows) >= 1 << 14:
            yield now.batch()
    now.finish()
    if now.rows:
        yield now.batch()


def rebuilt_paths(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """A row per prefix of every rebuilt conversation, ``ends`` at the whole one."""
    t = take(turns, conv_id, turn, role, text).toDF("conv_id", "turn", "role", "text")
    t = t.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    base = F.expr(f"conv_id - conv_id % {GROUP}")
    t = t.withColumn("base", base).repartition("base").sortWithinPartitions("base", F.col("conv_id") != F.col("base"), "conv_id", "turn", "role", "text")
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    return t.select("base", "conv_id", digest.alias("digest"), F.octet_length("text").alias("size")).mapInArrow(_paths, PATHS)


# ---- shards


def _place(k1: np.ndarray, k2: np.ndarray, seed: int, size: int) -> np.ndarray:
    x = k1 ^ (k2 * U(0x9E3779B97F4A7C15)) ^ U((seed + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return ((x ^ (x >> U(31))) % U(size)).astype(np.int64)


@dataclass
class SlotTable:
    """Minimal perfect hash of distinct digests: a digest's slot is the rank of its bit on the first level where it is alone.

    The slot holds the digest, and every look-up is compared with it.
    """

    levels: list[tuple[np.ndarray, np.ndarray]]
    k1: np.ndarray
    k2: np.ndarray

    @classmethod
    def build(cls, k1: np.ndarray, k2: np.ndarray, spare: float = 1.5) -> SlotTable:
        left, levels, before = np.arange(len(k1)), [], 0
        slot = np.zeros(len(k1), np.int64)
        while len(left):
            size = max(int(spare * len(left)), 2)
            at = _place(k1[left], k2[left], len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            rank = before + np.cumsum(alone) - 1
            levels.append((alone, rank))
            placed = alone[at]
            slot[left[placed]] = rank[at[placed]]
            before += int(alone.sum())
            left = left[~placed]
        by_slot = np.empty(len(k1), np.int64)
        by_slot[slot] = np.arange(len(k1))
        return cls(levels, k1[by_slot], k2[by_slot])

    def slots(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """Slots of digests; an error if one is not in the table."""
        out, left = np.full(len(k1), -1, np.int64), np.arange(len(k1))
        for seed, (alone, rank) in enumerate(self.levels):
            at = _place(k1[left], k2[left], seed, len(alone))
            hit = alone[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        if len(left) or (self.k1[out] != k1).any() or (self.k2[out] != k2).any():
            raise ValueError("a digest is not in its shard")
        return out


def shard_sums(depth: np.ndarray, k: np.ndarray, p: np.ndarray, leaf: np.ndarray, saved: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digests of a shard's nodes and the sums over their subtrees of what the shard owns.

    ``k`` and ``p`` are two-column arrays of digests and parents' digests; paths
    are complete up to the root.  Rows that own nothing have zeros.
    """
    order = np.lexsort((k[:, 1], k[:, 0]))
    s = k[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]).any(axis=1)
    table = SlotTable.build(s[new, 0], s[new, 1])
    slot = table.slots(k[:, 0], k[:, 1])
    n = len(table.k1)
    level, parent = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    leaves, tokens = np.zeros(n, np.int64), np.zeros(n, np.int64)
    level[slot] = depth
    below = depth > 0
    parent[slot[below]] = table.slots(p[below, 0], p[below, 1])
    np.add.at(leaves, slot, leaf)
    np.add.at(tokens, slot, saved)
    deepest = np.argsort(-level, kind="stable")
    cuts = np.flatnonzero(np.diff(level[deepest])) + 1
    for at in np.split(deepest, cuts):
        if level[at[0]]:
            np.add.at(leaves, parent[at], leaves[at])
            np.add.at(tokens, parent[at], tokens[at])
    return table.k1, table.k2, leaves, tokens


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``conv, none, depth, k1, k2, p1, p2, own, leaf, saved`` sorted by conversation; a conversation is in one shard."""
    held: list[np.ndarray] = []
    size = 0

    def sums(rows: np.ndarray) -> pa.RecordBatch | None:
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        group = np.cumsum(new) - 1
        rows = rows[np.bincount(group, rows[:, 7])[group] > 0]  # conversations that own no node add nothing
        if not len(rows):
            return None
        u = rows.view(U)
        out = shard_sums(rows[:, 2], u[:, 3:5], u[:, 5:7], rows[:, 8], rows[:, 9])
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in out], ["k1", "k2", "n_leaves", "saved"])

    for b in batches:
        rows = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(10)], axis=1)
        if not len(rows):
            continue
        held.append(rows)
        size += len(rows)
        if size >= SHARD_ROWS:
            every = np.concatenate(held)
            new = np.flatnonzero((every[1:, :2] != every[:-1, :2]).any(axis=1))
            cut = int(new[-1]) + 1 if len(new) else 0  # the last conversation may go on
            if cut and (out := sums(every[:cut])) is not None:
                yield out
            held, size = [every[cut:]], len(every) - cut
    if size and (out := sums(np.concatenate(held))) is not None:
        yield out


# ---- ends


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``k1, k2, ids`` by node and piece: SHA-256 of a node's joined ids, fed piece by piece."""
    last, sha, done = None, None, []

    def batch() -> pa.RecordBatch:
        s = np.frombuffer(b"".join(d for _, d in done), ">i8").astype(np.int64).reshape(-1, 4)
        k = np.array([key for key, _ in done], np.int64).reshape(-1, 2)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(k[:, 0]), pa.array(k[:, 1]), *[pa.array(s[:, i]) for i in range(4)]], ["k1", "k2", "s0", "s1", "s2", "s3"])

    for b in batches:
        for k1, k2, ids in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
            if (k1, k2) == last:
                sha.update(b",")
            else:
                if last is not None:
                    done.append((last, sha.digest()))
                last, sha = (k1, k2), hashlib.sha256()
            sha.update(ids.encode())
        if len(done) >= 1 << 14:
            yield batch()
    if last is not None:
        done.append((last, sha.digest()))
        yield batch()


def ends_digests(ends: DataFrame) -> DataFrame:
    """Per node of the rows ``k1, k2, conv_id`` the digest of its ids in order, as four numbers."""
    piece = F.floor(F.col("conv_id") / F.lit(ID_PIECE)).alias("piece")
    joined = ends.where("conv_id is not null").groupBy("k1", "k2", piece).agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))
    return joined.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "piece").select("k1", "k2", "ids").mapInArrow(_digests, ENDS)


# ---- the trie


def prefix_nodes(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``, one per node of the trie.

    Turns follow ``turn`` (null first), then role and text; null roles and texts
    count as empty, repeated rows are turns of their own.  A conversation is rebuilt
    from the first turns that conversation ``c - c % 5`` lends (the sign of the
    remainder is that of c) and its own turns behind as many.  Rows with a null id
    form one conversation that is not rebuilt; it counts as a member and a leaf, but
    has no id to be the smallest or to be listed.  An empty table gives an empty one.

    A conversation is streamed by one task, and so are the five of a base; the
    arrays of a shard hold at least one conversation, at about 200 bytes a turn.
    """
    paths = written(rebuilt_paths(turns, conv_id, turn, role, text), "paths")
    nodes = paths.groupBy("k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("bytes").alias("bytes"),
        F.count("*").alias("n_convs"), F.sum(F.col("ends").cast("bigint")).alias("n_ends"))
    nodes = written(nodes, "nodes")
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")

    def shard_row(own: Column, leaf: Column, saved: Column) -> list[Column]:
        return [F.coalesce("conv_id", zero).alias("conv"), F.col("conv_id").isNull().cast("bigint").alias("none"), F.col("depth"), F.col("k1"), F.col("k2"),
                F.coalesce("p1", zero).alias("p1"), F.coalesce("p2", zero).alias("p2"), own.alias("own"), leaf.alias("leaf"), saved.alias("saved")]

    own = nodes.select(*shard_row(zero + 1, (F.col("n_ends") == F.col("n_convs")).cast("bigint"), (F.col("n_convs") - 1) * F.col("bytes")))
    rows = paths.select(*shard_row(zero, zero, zero)).unionAll(own)
    parts = rows.repartition("conv", "none").sortWithinPartitions("conv", "none").mapInArrow(_shards, PARTS)

    fields = {"conv_id": "max", "depth": "max", "p1": "max", "p2": "max", "n_convs": "max", "n_children": "sum", "n_leaves": "sum", "saved": "sum", "s0": "max", "s1": "max", "s2": "max", "s3": "max"}

    def facts(df: DataFrame, k1: str = "k1", k2: str = "k2", **given: Column) -> DataFrame:
        return df.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), *[given.get(f, none).alias(f) for f in fields])

    every = facts(nodes, **{c: F.col(c) for c in ("conv_id", "depth", "p1", "p2", "n_convs")})
    every = every.unionAll(facts(nodes.where("depth > 0"), "p1", "p2", n_children=zero + 1))
    every = every.unionAll(facts(parts, n_leaves=F.col("n_leaves"), saved=F.col("saved")))
    every = every.unionAll(facts(ends_digests(paths.where("ends").select("k1", "k2", "conv_id")), **{c: F.col(c) for c in ("s0", "s1", "s2", "s3")}))
    tree = written(every.groupBy("k1", "k2").agg(*[getattr(F, how)(c).alias(c) for c, how in fields.items()]), "tree")

    # a parent's name goes to its children: by broadcast where there are many of them, by a join elsewhere
    limit = nodes.count() // HEAVY
    parents = tree.where("n_children > 0").select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    heavy = F.broadcast(parents.where(F.col("n_children") > limit).select("p1", "p2", "parent_conv_id"))
    light = parents.where(F.col("n_children") <= limit).select("p1", "p2", "parent_conv_id")
    below = tree.where("depth > 0")
    named = below.join(heavy, ["p1", "p2"]).unionByName(below.join(heavy.select("p1", "p2"), ["p1", "p2"], "left_anti").join(light, ["p1", "p2"]))
    named = named.unionByName(tree.where("depth = 0").withColumn("parent_conv_id", none))
    ends = F.when(F.col("s0").isNull(), F.sha2(F.lit(""), 256)).otherwise(F.concat(*[F.lpad(F.lower(F.hex(f"s{i}")), 16, "0") for i in range(4)]))
    return named.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", F.col("saved").alias("saved_tokens"), ends.alias("ends_sha256"))
