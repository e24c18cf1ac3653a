"""Importance resampling towards a target distribution over hashed word features.

Features are runs of words, hashed by CRC-32.  A batch's distinct features are
grouped by length into byte matrices, and all their checksums are updated together,
one column after the other; buckets are then scattered back to the words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import flat_bytes, pieces_of, positional, written

#: Longer features are cut into blocks of so many bytes, whose checksums are put together.
BLOCK = 64
PIECE = 1 << 21


# ---- checksums


@cache
def crc_table() -> np.ndarray:
    """One byte's step of the reflected CRC-32."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


@cache
def skip_tables() -> np.ndarray:
    """What ``BLOCK`` zero bytes do to a register, a table per byte of it; a register's effect is the sum of its bytes'."""
    t = crc_table()
    r = (np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)).astype(np.uint32)
    for _ in range(BLOCK):
        r = t[r & np.uint32(0xFF)] ^ (r >> np.uint32(8))
    return r


def matrix_crc(rows: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Registers after the equally long byte rows, all updated column by column."""
    t, r = crc_table(), start
    for column in np.ascontiguousarray(rows.T):
        r = t[(r ^ column) & np.uint32(0xFF)] ^ (r >> np.uint32(8))
    return r


def feature_crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte ranges; equal ranges of one length are computed once."""
    out = np.zeros(len(starts), np.uint32)
    by_length = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[by_length])) + 1
    for at in np.split(by_length, cuts) if len(by_length) else []:
        n = int(lengths[at[0]])
        whole, head = divmod(n, BLOCK)
        if not whole or (whole == 1 and not head):
            rows = data[starts[at][:, None] + np.arange(n)]
            distinct, back = _distinct(rows)
            out[at] = ~matrix_crc(distinct, np.full(len(distinct), 0xFFFFFFFF, np.uint32))[back]
            continue
        # a head of the rest, then blocks: all blocks of all features are one matrix
        for a in range(0, len(at), max(1, (1 << 20) // n)):
            some = at[a : a + max(1, (1 << 20) // n)]
            r = matrix_crc(data[starts[some][:, None] + np.arange(head)], np.full(len(some), 0xFFFFFFFF, np.uint32))
            blocks = data[(starts[some] + head)[:, None] + np.arange(n - head)].reshape(-1, BLOCK)
            parts = matrix_crc(blocks, np.zeros(len(blocks), np.uint32)).reshape(len(some), whole)
            s = skip_tables()
            for k in range(whole):
                r = s[0][r & np.uint32(0xFF)] ^ s[1][(r >> np.uint32(8)) & np.uint32(0xFF)] ^ s[2][(r >> np.uint32(16)) & np.uint32(0xFF)] ^ s[3][r >> np.uint32(24)] ^ parts[:, k]
            out[some] = ~r
    return out


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct byte rows of one length, and for each row which of them it is."""
    n, width = rows.shape
    if width <= 8:
        packed = np.zeros((n, 8), np.uint8)
        packed[:, :width] = rows
        keys = packed.view(np.uint64).ravel()
    else:
        keys = np.ascontiguousarray(rows).view(np.dtype((np.void, width))).ravel()
    _, first, back = np.unique(keys, return_index=True, return_inverse=True)
    return rows[first], back.ravel()


# ---- words and features


@cache
def word_bytes() -> np.ndarray:
    """Bytes of words after lower-casing: digits, a-z and all of non-ASCII characters."""
    b = np.arange(256)
    return ((b >= 0x30) & (b <= 0x39)) | ((b >= 0x61) & (b <= 0x7A)) | (b >= 0x80)


def text_features(raw: np.ndarray, borders: np.ndarray, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, features per text, and the features' buckets, text by text, for the lower-cased bytes of several texts.

    Words are laid out with one blank between them; a feature of several words is
    then a range of bytes like any other.
    """
    low = raw + (((raw >= 0x41) & (raw <= 0x5A)).astype(np.uint8) << 5)
    inside = np.zeros(len(low) + 1, bool)
    inside[:-1] = word_bytes()[low]
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    cut = borders[1:-1]
    cut = cut[cut < len(low)]
    begins[cut] |= inside[:-1][cut]  # a word ends with its text
    starts = np.flatnonzero(begins)
    ends = inside[:-1] & ~inside[1:]
    ends[cut - 1] |= inside[:-1][cut - 1]
    stops = np.flatnonzero(ends) + 1
    lengths = stops - starts
    of = np.searchsorted(borders, starts, side="right") - 1
    n_words = np.bincount(of, minlength=len(borders) - 1)
    if longest > 1 and len(starts):
        to = np.cumsum(lengths + 1) - (lengths + 1)
        flat = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
        flat[np.repeat(to - starts, lengths) + np.flatnonzero(inside[:-1])] = low[inside[:-1]]
        low, starts = flat, to
    found, whose = [], []
    for k in range(1, longest + 1):
        a = np.arange(max(len(starts) - k + 1, 0))
        a = a[of[a] == of[a + k - 1]] if len(a) else a
        found.append(feature_crcs(low, starts[a], starts[a + k - 1] + lengths[a + k - 1] - starts[a]) % np.uint32(buckets))
        whose.append(of[a])
    found, whose = np.concatenate(found), np.concatenate(whose)
    if longest > 1:
        order = np.argsort(whose, kind="stable")
        found, whose = found[order], whose[order]
    return n_words, np.bincount(whose, minlength=len(borders) - 1), found


def hashed(rows: DataFrame, longest: int, buckets: int) -> DataFrame:
    """``row, n_words, n_features, buckets`` of rows ``row, text``; the buckets are two bytes each, or four beyond 65,536."""
    width = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, 1, PIECE):
            raw, borders = flat_bytes(b.column(1))
            words, features, found = text_features(raw, borders, longest, buckets)
            at = np.concatenate(([0], np.cumsum(features))) * width.itemsize
            packed = pa.Array.from_buffers(pa.large_binary(), len(features), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(found.astype(width).tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words.astype(np.int64)), pa.array(features.astype(np.int64)), packed], ["row", "n_words", "n_features", "buckets"])

    src = rows.select("row", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    return src.mapInArrow(run, f"row {src.schema['row'].dataType.simpleString()}, n_words bigint, n_features bigint, buckets binary")


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs; a task adds up its own rows, at most ``buckets`` sums come to the driver."""
    width = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.bincount(flat_bytes(b.column(0))[0].view(width), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in rows.select("buckets").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


# ---- weights, draw


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed bucket shares, rounded down."""
    n, t_all, s_all = len(source), int(target.sum()), int(source.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for t, s in zip(target.tolist(), source.tolist(), strict=True)], np.int64)


def weighted(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``row, n_words, n_features, weight`` of hashed rows; the gains go along as one small array."""
    width = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")
    table = rows.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, borders = flat_bytes(b.column(3))
            upto = np.concatenate(([0], np.cumsum(table.value[raw.view(width)])))
            at = borders // width.itemsize
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(upto[at[1:]] - upto[at[:-1]])], ["row", "n_words", "n_features", "weight"])

    return rows.select("row", "n_words", "n_features", "buckets").mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel draw that only seed and id decide, rounded down."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with their place in the order, from 1, as ``rank``: places inside ranges, plus what all ranges before hold (a row per range)."""
    part = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    part = written(part.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_i")), "ranges")
    sizes = sorted((r["_p"], r["n"]) for r in part.groupBy("_p").agg(F.count("*").alias("n")).collect())
    before, at = [], 0
    for p, n in sizes:
        before.append((p, at))
        at += n
    if not before:
        return part.select(*rows.columns, F.lit(None).cast("bigint").alias("rank"))
    offsets = rows.sparkSession.createDataFrame(before, "_p int, _before bigint")
    place = F.col("_i") - F.shiftleft(F.col("_p").cast("bigint"), 33)
    return part.join(F.broadcast(offsets), "_p").select(*rows.columns, (place + F.col("_before") + 1).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = 1,
             buckets: int = 10000, seed: int = 2024, percent: int = 10, min_words: int = 20) -> DataFrame:
    """Rows ``doc_id, n_features, weight, score, rank``, one per row of ``docs``: the drawn ones are those with a rank.

    Features are the runs of 1 to ``longest`` words of the lower-cased text (A-Z
    only).  A text's weight is the sum of its features' gains, a bucket's gain the
    log ratio of its share in ``target`` to that in ``docs``.  ``percent`` of the
    documents with ``min_words`` words, rounded down, are drawn: those with the
    highest scores, ties to the smaller id.

    Null and empty texts have no features and weight 0; a null id is hashed as an
    empty string and stands behind all others; repeated rows score alike and each
    may be drawn.  An empty target gives gains all the same; an empty table gives an
    empty one.
    """
    d, where = positional(docs)
    i, t = F.col(where[doc_id]).cast("bigint"), F.col(where[text])
    rows = written(hashed(d.select(i.alias("row"), t.alias("text")), longest, buckets), "features")
    g, at = positional(target)
    wanted = hashed(g.select(F.lit(0).alias("row"), F.col(at[target_text]).alias("text")), longest, buckets)
    gain = gains(bucket_counts(wanted, buckets), bucket_counts(rows, buckets))
    scored = weighted(rows, gain).select(F.col("row").alias("doc_id"), "n_words", "n_features", "weight", (F.col("weight") + noise(F.col("row"), seed)).alias("score"))
    scored = written(scored, "scores")
    able = F.col("n_words") >= min_words
    draws = percent * scored.where(able).count() // 100
    placed = ranked(scored.where(able).select("doc_id", "n_features", "weight", "score"), F.desc("score"), F.asc_nulls_last("doc_id"))
    rank = F.when(F.col("rank") <= draws, F.col("rank"))
    rest = scored.where(~able).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank"))
    return placed.withColumn("rank", rank).unionByName(rest)
