"""SimHash near-duplicates with a hierarchical index over fingerprints in Gray order.

Fingerprints within two bits of each other agree on two of four 16-bit bands.
Each fingerprint goes to the six places its band pairs name; a place is searched
by an index over its fingerprints, and only a spanning set of its links comes out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from recordloom.llm.common import connected_components, pieces_of, positional, settled, written
from recordloom.llm.shingle_sets import similar_groups

U = np.uint64
BITS, BAND = 64, 16
SEED = 42
SHINGLE = 3
MAX_DIFF = 2
#: A place with more distinct fingerprints is divided again by the rest of the bits.
PLACE_LIMIT = 4096
FANOUT = 8
CHUNK = 1 << 16


# ---- fingerprints


def fingerprint(raw: bytes, part: int = 1 << 18, shingle: int = SHINGLE) -> int:
    """SimHash over the XXH64 of ``shingle``-word shingles, repeats included; 0 without words."""
    words = raw.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, n)
    ends, starts = ends[k - 1 :].tolist(), starts[: n - k + 1].tolist()
    ones, total = np.zeros(BITS, np.int64), len(starts)
    for a in range(0, total, part):
        h = b"".join([xxh64_digest(joined[i:j], SEED) for i, j in zip(starts[a : a + part], ends[a : a + part], strict=True)])
        ones += np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def with_fingerprints(rows: DataFrame, text: str, result: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``rows`` without column ``text``, with its 64-bit fingerprint (signed) as ``result``."""
    keep = [c for c in rows.columns if c != text]
    src = rows.select(F.struct(*keep).alias("row"), F.col(text).cast("binary").alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, 1):
            fps = np.array([fingerprint(r or b"", shingle=shingle) for r in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["row", "fp"])

    return src.mapInArrow(run, f"row {src.schema['row'].dataType.simpleString()}, fp bigint").select("row.*", F.col("fp").alias(result))


# ---- index


def gray_rank(v: np.ndarray) -> np.ndarray:
    """Position of each value in the reflected Gray order."""
    v = v.copy()
    for s in (1, 2, 4, 8, 16, 32):
        v ^= v >> U(s)
    return v


@dataclass
class GrayIndex:
    """Levels from leaves to root over fingerprints in Gray order.

    A node holds the bits its whole group shares (``mask``, ``pattern``).  What its
    parent already shares is factored out, so the differences met on the way down
    add up, and a group is left as soon as they exceed the limit.
    """

    values: np.ndarray
    masks: list[np.ndarray]
    patterns: list[np.ndarray]

    @classmethod
    def build(cls, values: np.ndarray, fanout: int = FANOUT) -> GrayIndex:
        values = values[np.argsort(gray_rank(values), kind="stable")]
        both = values.copy()
        either = values.copy()
        full: list[np.ndarray] = [np.full(len(values), ~U(0))]
        shared: list[np.ndarray] = [values]
        while len(both) > 1:
            cut = np.arange(0, len(both), fanout)
            both, either = np.bitwise_and.reduceat(both, cut), np.bitwise_or.reduceat(either, cut)
            full.append(~(both ^ either))
            shared.append(both)
        masks, patterns = [], []
        for i, (m, p) in enumerate(zip(full, shared, strict=True)):
            up = full[i + 1][np.arange(len(m)) // fanout] if i + 1 < len(full) else U(0)
            masks.append(m & ~up)
            patterns.append(p)
        return cls(values, masks, patterns)

    def links(self, exact: np.uint64, limit: int = MAX_DIFF, fanout: int = FANOUT, step: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs ``i < j`` of values that differ in ``limit`` bits or fewer, and in none of the bits ``exact``; a block of queries at a time."""
        for a in range(0, len(self.values), step):
            q = np.arange(a, min(a + step, len(self.values)))
            node, met = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
            for level in range(len(self.masks) - 1, -1, -1):
                diff = (self.values[q] ^ self.patterns[level][node]) & self.masks[level][node]
                met = met + np.bitwise_count(diff)
                width = fanout**level
                stay = (met <= limit) & ((diff & exact) == 0) & ((node + 1) * width > q)
                q, node, met = q[stay], node[stay], met[stay]
                if level:
                    size = len(self.masks[level - 1])
                    q, met = np.repeat(q, fanout), np.repeat(met, fanout)
                    node = (node[:, None] * fanout + np.arange(fanout)).ravel()
                    inside = node < size
                    q, node, met = q[inside], node[inside], met[inside]
            later = node > q
            if later.any():
                yield q[later], node[later]


def local_roots(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index of each one's component, blocks of links folded in one after the other."""
    root = np.arange(n)
    for a, b in links:
        while True:
            ra, rb = root[a], root[b]
            if np.array_equal(ra, rb):
                break
            low = np.minimum(ra, rb)
            np.minimum.at(root, ra, low)
            np.minimum.at(root, rb, low)
            while not np.array_equal(up := root[root], root):
                root = up
    while not np.array_equal(up := root[root], root):
        root = up
    return root


def _places(fp: str, bands: list[tuple[int, int]]) -> F.Column:
    """The six (place, key) pairs of a fingerprint: two bands of four, by number, with both bands' bits."""
    return F.array(*[
        F.struct(F.lit(n).alias("place"), F.expr(f"(shiftrightunsigned({fp}, {BAND * i}) & 65535L) << 16 | (shiftrightunsigned({fp}, {BAND * j}) & 65535L)").alias("key"))
        for n, (i, j) in enumerate(bands)])


PAIRS = list(combinations(range(BITS // BAND), 2))
#: The same for the remaining 32 bits in four parts of 8, used in full places.
REST = {n: [k for k in range(BITS // BAND) if k not in p] for n, p in enumerate(PAIRS)}


def _bits(bands: tuple[int, ...], width: int) -> int:
    return sum(((1 << width) - 1) << (width * k) for k in bands)


def _parts(place: int, sub: int) -> int:
    """Bits that a divided place fixes besides its bands: two of the four bytes of the other bands."""
    octets = [2 * band + h for band in REST[place] for h in (0, 1)]
    return sum(0xFF << (8 * octets[k]) for k in PAIRS[sub])


def _to_top(v: np.ndarray, mask: int) -> np.ndarray:
    """Values with the octets of ``mask`` moved to the top; the move keeps distances."""
    octets = [k for k in range(8) if mask >> (8 * k) & 0xFF] + [k for k in range(8) if not mask >> (8 * k) & 0xFF]
    out = np.zeros_like(v)
    for at, k in enumerate(octets):
        out |= (v >> U(8 * k) & U(0xFF)) << U(8 * (7 - at))
    return out


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows ``place, sub, key, fp``: spanning links of each place, several small places in one index."""
    held: list[np.ndarray] = []
    size, last = 0, None

    def search(rows: np.ndarray) -> pa.RecordBatch | None:
        a_out, b_out = [], []
        kinds = rows[:, 0] * 8 + rows[:, 1]
        for kind in np.unique(kinds):
            place, sub = int(kind) // 8, int(kind) % 8 - 1
            mask = _bits(PAIRS[place], BAND) | (_parts(place, sub) if sub >= 0 else 0)
            v = np.unique(rows[kinds == kind, 3].view(np.uint64))
            if len(v) < 2:
                continue
            moved = _to_top(v, mask)
            back = dict(zip(moved.tolist(), v.tolist(), strict=True))
            index = GrayIndex.build(moved)
            fixed = U(((1 << mask.bit_count()) - 1) << (BITS - mask.bit_count()))
            root = local_roots(len(v), index.links(fixed))
            far = np.flatnonzero(root != np.arange(len(v)))
            a_out += [back[x] for x in index.values[far].tolist()]
            b_out += [back[x] for x in index.values[root[far]].tolist()]
        if not a_out:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a_out, b_out)], ["a", "b"])

    for b in batches:
        rows = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
        if not len(rows):
            continue
        held.append(rows)
        size += len(rows)
        if size >= CHUNK:
            every = np.concatenate(held)
            new = np.flatnonzero((every[1:, :3] != every[:-1, :3]).any(axis=1))
            cut = int(new[-1]) + 1 if len(new) else 0  # the last place may go on
            if cut and (out := search(every[:cut])) is not None:
                yield out
            held, size = [every[cut:]], len(every) - cut
    if size and (out := search(np.concatenate(held))) is not None:
        yield out


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Spanning links ``a, b`` among distinct fingerprints (column ``fp``): same components as all pairs within two bits.

    A place with more than ``PLACE_LIMIT`` fingerprints is divided by pairs of the
    other bands' bytes, which leaves at most 65,536 distinct values to a place.
    """
    p = fps.select("fp", F.explode(_places("fp", PAIRS)).alias("p")).select("fp", "p.place", "p.key")
    sizes = p.groupBy("place", "key").agg(F.count("*").alias("n")).where("n > 1").select("place", "key", (F.col("n") > PLACE_LIMIT).alias("full"))
    p = p.join(sizes, ["place", "key"])
    near = p.where("not full").select("place", F.lit(0).alias("sub"), "key", "fp")
    subs = F.lit(None)
    for place in range(len(PAIRS)):
        octets = [2 * band + h for band in REST[place] for h in (0, 1)]
        parts = F.array(*[F.struct(F.lit(s + 1).alias("sub"), F.expr(f"(shiftrightunsigned(fp, {8 * octets[i]}) & 255L) << 8 | (shiftrightunsigned(fp, {8 * octets[j]}) & 255L)").alias("more"))
                          for s, (i, j) in enumerate(PAIRS)])
        subs = F.when(F.col("place") == place, parts).otherwise(subs)
    far = p.where("full").select("place", "key", "fp", F.explode(subs).alias("s")).select("place", "s.sub", F.expr("key << 16 | s.more").alias("key"), "fp")
    every = near.unionAll(far).select(F.col("place").cast("bigint").alias("place"), F.col("sub").cast("bigint").alias("sub"), "key", "fp")
    return every.repartition("place", "sub", "key").sortWithinPartitions("place", "sub", "key").mapInArrow(_stars, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Rows ``doc_id, k1, k2, fp, root, component_id``, one per row of ``docs``.

    ``fp`` is the SimHash of the lower-cased words' ``shingle``-word shingles.  Rows are
    linked where fingerprints differ in two bits or fewer; ``root`` names the
    component and ``component_id`` is its smallest id (null if all are null).
    Null, empty and blank texts have fingerprint zero and link like any other;
    repeated rows share a component; an empty table gives an empty one.  ``k1, k2``
    are hashes of id and text.
    """
    d, where = positional(docs)
    i, t = F.col(where[doc_id]), F.col(where[text])
    src = d.select(i.alias("doc_id"), F.xxhash64(i, t).alias("k1"), F.xxhash64(F.lit("row"), t, i).alias("k2"), t.alias("text"))
    rows = written(with_fingerprints(src, "text", shingle=shingle), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    comps = connected_components(fingerprint_links(distinct)).toDF("fp", "root")
    known = distinct.join(comps, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = known.groupBy("root").agg(F.min("low").alias("component_id"))
    named = known.join(lows, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "k1", "k2", "fp", "root", "component_id")


def joined_groups(docs: DataFrame, doc_id: str, text: str, shingle: int, similarity: float) -> DataFrame:
    """Rows ``doc_id, k1, k2, root``: rows with one ``root`` are joined by a chain of links of either kind, fingerprints within two bits or similar sets of ``shingle``-word shingles."""
    near = near_duplicates(docs, doc_id, text).select("k1", "k2", F.col("root").alias("f")).dropDuplicates(["k1", "k2"])
    similar = written(similar_groups(docs, doc_id, text, shingle, similarity), "similar-groups")
    pairs = written(similar.join(near, ["k1", "k2"]).select("f", "root").distinct(), "group-pairs")
    # a component of fingerprints that holds several groups of similar texts joins them
    low = pairs.groupBy("f").agg(F.min("root").alias("b"), F.max("root").alias("top")).where("b <> top").select("f", "b")
    comps = connected_components(pairs.join(low, "f").select(F.col("root").alias("a"), "b")).toDF("root", "one")
    return similar.join(comps, "root", "left").select("doc_id", "k1", "k2", F.coalesce("one", "root").alias("root"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similarity: float | None = None) -> DataFrame:
    """``docs`` without near copies: of each component the row with the smallest id stays (null ids last; ties by content; of repeated rows one).

    Components are those of fingerprints within two bits; with ``similarity`` texts
    whose sets of ``shingle``-word shingles reach it are linked besides.
    """
    d, where = positional(docs)

    def steps() -> DataFrame:
        groups = near_duplicates(docs, doc_id, text, shingle) if similarity is None else joined_groups(docs, doc_id, text, shingle, similarity)
        best = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")).alias("k"))
        return best.select(F.col("k.k1").alias("_k1"), F.col("k.k2").alias("_k2"))

    best = settled(docs.sparkSession, "kept", steps)
    i, t = F.col(where[doc_id]), F.col(where[text])
    kept = d.withColumns({"_k1": F.xxhash64(i, t), "_k2": F.xxhash64(F.lit("row"), t, i)}).join(best, ["_k1", "_k2"], "left_semi")
    return kept.dropDuplicates(["_k1", "_k2"]).drop("_k1", "_k2").toDF(*docs.columns)
