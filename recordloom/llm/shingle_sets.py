"""Groups of texts whose sets of word shingles reach a Jaccard similarity, exactly.

Shingles have one global order, frequent ones last.  Two sets of similarity t share
a shingle among the first ``n - ceil(t * n) + 1`` of each, so texts meet on those;
candidates whose signatures allow the similarity are verified on their whole sets.
Neighbours of a meeting place are verified first, and only pairs that this leaves
unconnected are formed after it, so a large group of copies does not make all its
pairs.  Texts are read for their description once, and again for verified pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh64_intdigest

from recordloom.llm.common import connected_components, pieces_of, positional, written

U = np.uint64
#: Frequent shingles go last in the order: those met ``FREQUENT`` times in one of ``SAMPLE`` parts of the rows, at most ``FREQUENT_MOST`` (for speed only, any order is right).
SAMPLE, FREQUENT, FREQUENT_MOST = 8, 8, 1 << 16
PAIRS_AT_ONCE = 1 << 18
#: Candidates whose rows are broadcast at most (24 bytes each); beyond, all texts meet them in a shuffle join.
BROADCAST_KEYS = 1 << 20


def shingle_set(raw: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased words' ``k``-word shingles; a shorter text is one shingle."""
    words = raw.decode("utf-8", "replace").lower().encode().split()
    h = np.array([xxh64_intdigest(w, 7) for w in words], U)
    k = min(k, len(h))
    n = len(h) - k + 1
    out = np.full(n if k else 0, U(k))
    for j in range(k):
        out = (out ^ h[j : j + n]) * U(0x9E3779B97F4A7C15)
        out ^= out >> U(31)
    return np.unique(out)


def least_shared(n: int, similarity: float) -> int:
    return math.ceil(similarity * n - 1e-9)


def signature(s: np.ndarray) -> np.ndarray:
    """Bits that the hashes set in a table of four times their number or more, a power of two."""
    m = 1 << max(6, (4 * len(s) - 1).bit_length())
    bits = np.zeros(m, np.uint8)
    bits[(s & U(m - 1)).astype(np.int64)] = 1
    return np.packbits(bits)


def most_shared(n: tuple[int, int], a: np.ndarray, b: np.ndarray) -> int:
    """A bound that the number of common hashes cannot exceed: common bits, and all that share a bit with others of their set."""
    while len(a) > len(b):
        a = a[: len(a) // 2] | a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] | b[len(b) // 2 :]
    return int(np.bitwise_count(a & b).sum()) + min(n[0] - int(np.bitwise_count(a).sum()), n[1] - int(np.bitwise_count(b).sum()))


def _described(k: int, similarity: float, last: np.ndarray):
    """From ``doc_id, k1, k2, raw``: the set's hash, size, signature and first shingles, those in ``last`` after the others, instead of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, 3):
            keys, sizes, signs, firsts = [], [], [], []
            for r in b.column(3).to_pylist():
                s = shingle_set(r or b"", k)
                keys.append(xxh3_64_intdigest(s))
                sizes.append(len(s))
                signs.append(signature(s).tobytes())
                at = np.searchsorted(last, s)  # a set is small beside the frequent shingles
                late = (at < len(last)) & (last[np.minimum(at, max(len(last) - 1, 0))] == s) if len(last) else np.zeros(len(s), bool)
                firsts.append(np.concatenate((s[~late], s[late]))[: len(s) - least_shared(len(s), similarity) + 1].view(np.int64))
            columns = [pa.array(np.array(keys, U).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(signs, pa.binary()), pa.array(firsts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), *columns], ["doc_id", "k1", "k2", "key", "size", "sign", "first"])

    return run


def _grams(k: int):
    """From ``raw``: a row for each different shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, 0):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([shingle_set(r or b"", k) for r in b.column(0).to_pylist()]).view(np.int64))], ["gram"])

    return run


def _sets(k: int):
    """From ``key, raw``: rows ``key, grams``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, 1):
            sets = [shingle_set(r or b"", k).view(np.int64) for r in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], ["key", "grams"])

    return run


def _possible(size: np.ndarray, pos: np.ndarray, met: np.ndarray, i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Pairs whose sizes and places of the shared shingle allow the similarity.  Before it they can share only what any two first shingles share (``met``)."""
    low, high = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
    most = np.minimum(met[i], met[j]) + np.minimum(size[i] - pos[i], size[j] - pos[j])
    return (low >= similarity * high - 1e-9) & (most * (1 + similarity) >= similarity * (low + high) - 1e-9)


def _meetings(similarity: float, every: bool):
    """From rows ``gram, size, key, pos, comp, met, own`` sorted by the first three: pairs ``a < b`` in different components.

    These are neighbours of a shingle and each text with the one that has the
    fewest shingles of its ``own`` there (the least edited of a group of near
    copies); with ``every`` all pairs.
    """

    def possible(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        _, size, key, pos, comp, met, _ = rows.T
        ok = (comp[i] != comp[j]) & _possible(size, pos, met, i, j, similarity)
        if ok.any():
            x, y = key[i[ok]], key[j[ok]]
            both = np.unique(np.stack((np.minimum(x, y), np.maximum(x, y)), axis=1), axis=0)
            yield both[:, 0], both[:, 1]

    def sparse(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not len(rows):
            return
        gram, at = rows[:, 0], np.arange(len(rows))
        next_to = at[:-1][gram[:-1] == gram[1:]]
        best = np.lexsort((rows[:, 2], rows[:, 6], gram))
        cut = np.flatnonzero(np.diff(gram, prepend=gram[0] - 1))
        centre = np.repeat(best[cut], np.diff(cut, append=len(rows)))
        yield from possible(rows, np.concatenate((next_to, at)), np.concatenate((next_to + 1, centre)))

    def pairs(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not every:
            yield from sparse(rows)
            return
        if len(rows):  # shingles of one component make no pairs
            cut = np.flatnonzero(np.diff(rows[:, 0], prepend=rows[0, 0] - 1))
            mixed = np.minimum.reduceat(rows[:, 4], cut) != np.maximum.reduceat(rows[:, 4], cut)
            rows = rows[np.repeat(mixed, np.diff(cut, append=len(rows)))]
        gram, size, comp = rows[:, 0], rows[:, 1], rows[:, 4]
        begins, ends = np.arange(len(gram)) + 1, np.searchsorted(gram, gram, side="right")
        for a, e in zip(*np.unique(ends, return_index=True), strict=True):
            # partners by size, or all of later components where those are fewer
            near = e + np.searchsorted(size[e:a], size[e:a] / similarity + 1e-6, side="right")
            order = e + np.argsort(comp[e:a], kind="stable")
            behind = e + np.searchsorted(comp[order], comp[order], side="right")
            if (a - behind).sum() < (near - begins[e:a]).sum():
                rows[e:a] = rows[order]
                begins[e:a] = behind
            else:
                ends[e:a] = near
        count = ends - begins
        upto = np.cumsum(count)
        at = 0
        while at < len(gram):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
            i = np.repeat(np.arange(at, to), count[at:to])
            j = begins[i] + np.arange(len(i)) - np.repeat(np.cumsum(count[at:to]) - count[at:to], count[at:to])
            yield from possible(rows, i, j)
            at = to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 7), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            held = np.concatenate((held, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns], axis=1)))
            cut = int(np.searchsorted(held[:, 0], held[-1, 0]))  # the last shingle may go on
            for a, c in pairs(held[:cut]):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], ["a", "b"])
            held = held[cut:]
        for a, c in pairs(held):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], ["a", "b"])

    return run


def _hopeful(similarity: float):
    """From ``a, b, n, x, m, y``: the pairs whose sizes ``n, m`` and signatures ``x, y`` allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for n, x, m, y in zip(*(b.column(i).to_pylist() for i in range(2, 6)), strict=True):
                both = most_shared((n, m), np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8))
                ok.append(both >= similarity * (n + m - both) - 1e-9)
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _verify(similarity: float):
    """From ``a, b, x, y``: the pairs whose sets ``x`` and ``y`` are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = (v.values.to_numpy(zero_copy_only=False) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """Rows ``doc_id, k1, k2, root``, one per row of ``docs``: rows with the same ``root`` are joined by a chain of similar texts.

    Similar means that the sets of ``shingle``-word shingles of the lower-cased
    words have a Jaccard similarity of ``similarity`` or more; all such pairs count.
    Texts without words are similar to each other only; an empty table gives an
    empty one.  ``k1, k2`` are hashes of id and text.
    """
    d, where = positional(docs)
    i, t = F.col(where[doc_id]), F.col(where[text])
    keyed = d.select(i.alias("doc_id"), F.xxhash64(i, t).alias("k1"), F.xxhash64(F.lit("row"), t, i).alias("k2"), t.cast("binary").alias("raw"))
    kind = keyed.schema["doc_id"].dataType.simpleString()
    sample = keyed.select("raw").where(F.pmod(F.xxhash64("raw"), F.lit(SAMPLE)) == 0)
    frequent = sample.mapInArrow(_grams(shingle), "gram bigint").groupBy("gram").agg(F.count("*").alias("n"))
    frequent = frequent.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "gram").limit(FREQUENT_MOST).collect()
    last = np.sort(np.array([r[0] for r in frequent], np.int64).view(U))
    rows = keyed.mapInArrow(_described(shingle, similarity, last), f"doc_id {kind}, k1 bigint, k2 bigint, key bigint, size int, sign binary, first array<bigint>")
    rows = written(rows, "described")
    first = rows.select("key", "size", F.posexplode("first").alias("pos", "gram")).repartition("gram").dropDuplicates(["gram", "key"])
    shared = first.withColumn("n", F.count("*").over(Window.partitionBy("gram"))).where("n > 1").drop("n")
    of = Window.partitionBy("key")
    shared = shared.withColumns({"met": F.row_number().over(of.orderBy("pos")) - 1, "own": F.max("pos").over(of) + 1 - F.count("*").over(of)})
    shared = written(shared, "shared-shingles")
    signs = rows.select("key", "size", "sign").where("size > 0").dropDuplicates(["key"])

    def links(places: DataFrame, every: bool) -> DataFrame:
        near = places.select("gram", "size", "key", "pos", "comp", "met", "own").repartition("gram").sortWithinPartitions("gram", "size", "key")
        near = near.mapInArrow(_meetings(similarity, every), "a bigint, b bigint").distinct()
        near = near.join(signs.toDF("a", "n", "x"), "a").join(signs.toDF("b", "m", "y"), "b").select("a", "b", "n", "x", "m", "y")
        near = written(near.mapInArrow(_hopeful(similarity), "a bigint, b bigint"), "candidates")
        keys = near.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        chosen = rows.join(keys, "key", "left_semi").groupBy("key").agg(F.min(F.struct("k1", "k2")).alias("k")).select("key", "k.k1", "k.k2")
        chosen = written(chosen, "chosen")
        if chosen.count() <= BROADCAST_KEYS:
            chosen = F.broadcast(chosen)
        texts = keyed.select("k1", "k2", "raw").join(chosen, ["k1", "k2"]).select("key", "raw")
        sets = written(texts.mapInArrow(_sets(shingle), "key bigint, grams array<bigint>").dropDuplicates(["key"]), "sets")
        both = near.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")
        return written(both.mapInArrow(_verify(similarity), "a bigint, b bigint"), "similar")

    sure = links(shared.withColumn("comp", F.col("key")), False)
    comps = connected_components(sure).toDF("key", "root")
    rest = links(shared.join(comps, "key", "left").withColumn("comp", F.coalesce("root", "key")), True)
    comps = connected_components(sure.unionAll(rest)).toDF("key", "root")
    return rows.select("doc_id", "k1", "k2", "key").join(comps, "key", "left").select("doc_id", "k1", "k2", F.coalesce("root", "key").alias("root"))
