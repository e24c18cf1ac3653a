"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases level by level.  Where a phrase ends is decided by
deterministic coin tossing over a handful of neighbouring names, and a phrase's
name is a hash of the names in it, so equal substrings get equal phrases inside,
wherever they stand.  The fingerprint keeps a fixed number of minima over a
text's distinct phrase names; two fingerprints show what share of names is common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import positional

U = np.uint64
#: Minima in a fingerprint, 16 bits each.
BINS = 128
#: Names of phrases from this level on are kept, and that of the whole text.
FIRST_LEVEL = 2
#: Rounds of coin tossing: 64-bit names become labels below 6 after four.
ROUNDS = 4
WINDOW = 1 << 20
BATCH_CHARS = 1 << 20


# ---- parsing


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, one to one."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def toss(left: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Lowest bit in which a name differs from its left neighbour, by place and value.  Neighbours that differ get labels that differ."""
    d = own ^ left
    low = d & (~d + d.dtype.type(1))
    return (2 * np.bitwise_count(low - low.dtype.type(1)) + ((own & low) != 0)).astype(np.uint8)


def landmarks(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a phrase begins: at a text's first name and at local maxima of the labels.

    Neighbours within a text differ.  A label depends on four names to its left, a
    border on one more to its right, so parsing is the same inside equal parts.
    A text's first name meets a zero in its left neighbour's place.  Its last name
    begins no phrase, so every level has fewer names than the one before.
    """
    n, out = len(names), first.copy()
    for a in range(0, n, WINDOW):
        lo, hi = max(a - ROUNDS - 1, 0), min(a + WINDOW + 1, n)
        own, head = names[lo:hi], first[lo:hi]
        for r in range(ROUNDS):
            left = np.empty_like(own)
            left[0], left[1:] = 0, own[:-1]
            # the value that stands before a text, never equal to its first label
            left[head] = 0 if r == 0 else np.where(own[head] == 0, 1, 0)
            own = toss(left, own)
        peak = np.zeros(len(own), bool)
        peak[1:-1] = (own[1:-1] > own[:-2]) & (own[1:-1] > own[2:]) & ~head[1:-1] & ~head[2:]
        b = min(a + WINDOW, n)
        out[a:b] |= peak[a - lo : b - lo]
    return out


def next_level(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and text starts of the next level: runs of one name become one, then phrases do."""
    new = first.copy()
    new[1:] |= names[1:] != names[:-1]
    at = np.flatnonzero(new)
    length = np.diff(at, append=len(names)).astype(U)
    names, first = names[at], first[at]
    many = length > 1
    names[many] = mix(names[many] ^ (length[many] * U(0x9E3779B97F4A7C15)))
    begin = landmarks(names, first)
    at = np.flatnonzero(begin)
    place = np.arange(len(names)) - np.repeat(at, np.diff(at, append=len(names)))
    parts = mix(names + (place.astype(U) + U(1)) * U(0xD1342543DE82EF95))
    return mix(np.add.reduceat(parts, at)), first[at]


def phrase_names(texts: list[str], first_level: int = FIRST_LEVEL) -> tuple[np.ndarray, np.ndarray]:
    """Names of all phrases from ``first_level`` up to the whole text, and the number of the text each belongs to.  Empty texts have none.

    A text of one phrase at a lower level keeps that phrase alone.
    """
    chars = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.array([len(c) for c in chars], np.int64)
    owner = np.flatnonzero(sizes)
    if not len(owner):
        return np.zeros(0, U), np.zeros(0, np.int64)
    names = mix(np.concatenate(chars).astype(U) + U(1))
    first = np.zeros(len(names), bool)
    first[np.cumsum(sizes[owner]) - sizes[owner]] = True
    level, found, of = 0, [], []
    while len(names):
        at = np.flatnonzero(first)
        counts = np.diff(at, append=len(names))
        done = counts == 1
        if level >= first_level:
            found.append(names)
            of.append(np.repeat(owner, counts))
        elif done.any():
            found.append(names[at[done]])
            of.append(owner[done])
        if done.any():
            stay = np.repeat(~done, counts)
            names, first, owner = names[stay], first[stay], owner[~done]
            if not len(names):
                break
        names, first = next_level(names, first)
        level += 1
    return np.concatenate(found), np.concatenate(of)


# ---- fingerprints


def fingerprints(texts: list[str], bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` 16-bit values per text: the smallest name that falls into each bin, cut to 16 bits.

    An empty bin takes the value of the first filled bin in an order of its own,
    which is the same for all texts, so texts with the same names fill alike.  A
    text without names has zeros.
    """
    names, of = phrase_names(texts)
    full = np.full(len(texts) * bins, ~U(0))
    h = mix(names)
    np.minimum.at(full, of * bins + (h >> U(32)).astype(np.int64) % bins, h & U(0xFFFFFFFF))
    full = full.reshape(len(texts), bins)
    filled = full != ~U(0)
    out = np.where(filled, mix(full) & U(0xFFFF), U(0))
    order = np.argsort(mix(np.arange(1, bins * bins + 1, dtype=U)).reshape(bins, bins), axis=1)
    row, cell = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for a in range(0, len(row), 1 << 15):
        r, c = row[a : a + (1 << 15)], cell[a : a + (1 << 15)]
        out[r, c] = out[r, order[c, filled[r[:, None], order[c]].argmax(axis=1)]]
    return out.astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Twice the common names over the names of both, estimated from the share of equal minima: 1 for equal fingerprints, about 0 for unrelated ones."""
    j = (a == b).mean(axis=1)
    return 2 * j / (1 + j)


# ---- neighbours in the order of ids


def _bucket_of(key: Column, starts: Column, n: int) -> Column:
    """Number of the last of the ``n`` sorted values that is not behind ``key``, by halving."""

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        left = F.get(starts, middle) > key
        return F.when(acc["lo"] + 1 >= acc["hi"], acc).otherwise(
            F.struct(F.when(left, acc["lo"]).otherwise(middle).alias("lo"), F.when(left, middle).otherwise(acc["hi"]).alias("hi")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length() + 1)), F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi")), halve, lambda a: a["lo"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows ``bucket, doc_id, text, guard``: each row that is no guard with its successor in the bucket."""
    held: list[tuple] = []

    def flush(rows: list[tuple]) -> pa.RecordBatch | None:
        place = np.array([i for i, a in enumerate(rows[:-1]) if not a[3]], np.int64)
        if not len(place):
            return None
        own = [(rows[i], rows[i + 1]) for i in place.tolist()]
        edited = [a[2][: len(a[2]) - len(a[2]) // 3] + b[2][: len(a[2]) // 3] for a, b in own]
        prints = fingerprints([r[2] for r in rows] + edited)
        mine, after, changed = prints[place], prints[place + 1], prints[len(rows) :]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([a[1] for a, _ in own], pa.int64()),
                pa.array([len(a[2]) for a, _ in own], pa.int64()),
                pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]),
                pa.array([p.tobytes().hex() for p in mine]),
                pa.array([p.tobytes().hex() for p in changed]),
                pa.array(likeness(mine, changed)),
                pa.array(likeness(mine, after)),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    size = 0
    for b in batches:
        for i in range(b.num_rows):
            row = tuple(b.column(k)[i].as_py() for k in range(4))
            held.append(row)
            size += len(row[2])
            if size >= BATCH_CHARS and len(held) > 1:
                if (out := flush(held)) is not None:
                    yield out
                held, size = held[-1:], len(held[-1][2])
    if (out := flush(held)) is not None:
        yield out


RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def neighbour_prints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, one per row of ``docs``.

    The next document is the one with the next smaller id; after the smallest comes
    the largest, and a single document is its own next one.  The edited text is the
    text whose last third (rounded down, in code points) is replaced by as many
    code points from the beginning of the next document, or all it has.
    ``near_edited`` and ``near_next`` compare the text's fingerprint with those of
    the edited text and of the next document.

    Null texts count as empty; empty texts share the fingerprint of zeros.  Null ids
    stand behind all others; rows of one id follow a hash of their texts, so repeated
    rows are neighbours.  An empty table gives an empty one.

    Texts are dealt once.  Borders of the ordered buckets come from ids alone, one
    id per bucket goes to the driver, and the rows of the first id of a bucket are
    sent along to the bucket before as guards.  A bucket is streamed; rows of one
    id are in one bucket.
    """
    d, where = positional(docs)
    i, t = F.col(where[doc_id]).cast("bigint"), F.coalesce(F.col(where[text]).cast("string"), F.lit(""))
    # ascending in the order wanted: larger ids first, null last
    key = F.coalesce(F.bitwise_not(i).cast("decimal(20,0)"), F.lit(str(2**63)).cast("decimal(20,0)"))
    rows = d.select(i.alias("doc_id"), t.alias("text"), key.alias("key"))
    # so many buckets as the session asks for shuffles: ids alone are too small to tell how many their texts need
    n = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    borders = rows.select("key").repartitionByRange(n, "key").groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("start"))
    starts = sorted(r["start"] for r in borders.select("start").collect())
    if not starts:
        return d.sparkSession.createDataFrame([], RESULT)
    known = F.array(*[F.lit(s).cast("decimal(20,0)") for s in starts])
    rows = rows.withColumn("bucket", _bucket_of(F.col("key"), known, len(starts)))
    own = F.struct(F.col("bucket"), F.lit(False).alias("guard"))
    before = F.struct(F.when(F.col("bucket") == 0, len(starts) - 1).otherwise(F.col("bucket") - 1).alias("bucket"), F.lit(True).alias("guard"))
    places = F.when(F.col("key") == F.get(known, F.col("bucket")), F.array(own, before)).otherwise(F.array(own))
    dealt = rows.select("doc_id", "text", "key", F.explode(places).alias("p")).select("p.bucket", "doc_id", "text", "p.guard", "key")
    dealt = dealt.repartitionById(len(starts), "bucket").sortWithinPartitions("bucket", "guard", "key", F.xxhash64("text"))
    return dealt.select("bucket", "doc_id", "text", "guard").mapInArrow(_pairs, RESULT)
