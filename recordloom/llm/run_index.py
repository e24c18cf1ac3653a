"""Exact removal of long repeated byte strings with a run-length index.

Every window of ``window`` bytes belongs to the segment of windows around it that
share the smallest hash of their k-byte strings, so equal windows meet in segments
of equal hash (the *anchor*).  Equal segments are counted; the different ones of an
anchor are indexed together in blocks: suffix order, Burrows-Wheeler transform in
runs, text positions sampled at run ends.  Matching statistics are streamed from
the samples, and windows that match elsewhere are marked.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_digest, xxh3_64_intdigest

from recordloom.llm.common import flat_bytes, pieces_of, positional, settled, written

U = np.uint64
WINDOW = 400
GRAM = 32
#: Bytes that stand for a word where windows are counted in words.
CODE = 8
#: Bytes of segments in one index, and different segments of one anchor in it; an anchor with more is counted window by window.
BLOCK_BYTES = 1 << 19
ANCHOR_LIMIT = 4096
STRIPE = 1 << 20
_WORD = re.compile(rb"[^ \t\n\r\x0b\x0c]+")


# ---- segments


def gram_hashes(data: np.ndarray, k: int = GRAM) -> np.ndarray:
    """A 64-bit hash of every ``k``-byte string, ``k`` a multiple of 8."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    words = np.zeros(len(data) - 7, U)
    for s in range(8):
        part = data[s : s + (len(data) - s) // 8 * 8].view("<u8")
        words[s::8] = part[: len(words[s::8])]
    h = np.zeros(n, U)
    for j in range(k // 8):
        h = (h ^ words[8 * j : 8 * j + n]) * U(0x9E3779B97F4A7C15)
        h ^= h >> U(29)
    return h * U(0xBF58476D1CE4E5B9)


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima forth and back inside blocks."""
    n = len(h)
    if n < width:
        return np.zeros(0, h.dtype)
    padded = np.full(-(-n // width) * width, ~U(0), U)
    padded[:n] = h
    grid = padded.reshape(-1, width)
    forth = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], forth[width - 1 : n])


def segments_of(data: np.ndarray, window: int = WINDOW, k: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``start, windows, anchor, again`` of the segments of one text.

    ``again`` says that the anchor occurs more than once inside the segment, so
    that a window may return in it.  A segment has at most ``window - k + 1`` windows.
    """
    width = window - k + 1
    out = []
    for a in range(0, max(0, len(data) - window + 1), STRIPE):
        part = np.ascontiguousarray(data[a : a + STRIPE + window - 1])
        h = gram_hashes(part, k)
        low = window_minima(h, width)
        change = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        sizes = np.diff(np.append(change, len(low)))
        parts = -(-sizes // width)
        start = np.repeat(change, parts) + width * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        count = np.diff(np.append(start, len(low)))
        anchor = low[start]
        owner = np.repeat(np.arange(len(start)), count)
        # an anchor's occurrences in a segment, counted at the window that ends or begins there
        ends = np.bincount(owner[h[width - 1 : width - 1 + len(low)] == low], minlength=len(start))
        first = np.array([np.count_nonzero(h[s : s + width - 1] == v) for s, v in zip(start.tolist(), anchor, strict=True)], np.int64)
        out.append((start + a, count, anchor, first + ends > 1))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z.astype(U), z.astype(bool)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _segment_rows(window: int):
    """From ``_k1, _k2, raw``: a row for each segment; ``digest`` hashes its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, 2):
            flat, offsets = flat_bytes(b.column(2))
            rows, cols = [], []
            for i in np.flatnonzero(np.diff(offsets) >= window).tolist():
                text = flat[offsets[i] : offsets[i + 1]]
                start, count, anchor, again = segments_of(text, window)
                view = memoryview(text)
                digest = np.array([xxh3_64_intdigest(view[s : s + c + window - 1], 1) for s, c in zip(start.tolist(), count.tolist(), strict=True)], U)
                rows.append(np.full(len(start), i))
                cols.append((start, count, anchor.view(np.int64), digest.view(np.int64), again))
            if rows:
                at = pa.array(np.concatenate(rows))
                start, count, anchor, digest, again = (np.concatenate(x) for x in zip(*cols, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array(start.astype(np.int64)), pa.array(count.astype(np.int32)), pa.array(anchor), pa.array(digest), pa.array(again)],
                    ["_k1", "_k2", "start", "windows", "anchor", "digest", "again"])

    return run


_SEGMENT = "_k1 bigint, _k2 bigint, start bigint, windows int, anchor bigint, digest bigint, again boolean"


# ---- index


@dataclass
class RunIndex:
    """Runs of the Burrows-Wheeler transform of a collection of segments, each ended by a mark of its own.

    ``head`` and ``length`` are the runs' characters (-1: a segment's mark) and
    lengths.  ``first`` and ``last`` are the text positions of each run's first and
    last suffix, and ``shared`` the characters that a run's first suffix shares with
    the last suffix of the run before it.
    """

    head: np.ndarray
    length: np.ndarray
    first: np.ndarray
    last: np.ndarray
    shared: np.ndarray
    size: int

    @classmethod
    def build(cls, data: np.ndarray, ends: np.ndarray) -> RunIndex:
        """``data``: the segments' bytes after each other; ``ends``: where each ends."""
        n = len(data)
        lengths = np.diff(np.concatenate(([0], ends)))
        stop = np.repeat(ends, lengths)
        pos = np.arange(n)
        rest = stop - pos
        # ranks of the next 7, 14, 28, ... characters; a segment's end is smaller than any character
        key = np.zeros(n, U)
        for j in range(7):
            c = np.zeros(n, U)
            c[: n - j] = data[j:]
            key = key << U(9) | np.where(rest > j, c + U(1), U(0))
        depth, levels = 7, []
        order = np.argsort(key, kind="stable")
        rank = cls._ranks(key, order)
        longest = int(lengths.max())
        while True:
            levels.append((depth, rank))
            if depth >= longest:
                break
            after = np.zeros(n, np.int64)
            inside = rest > depth
            after[inside] = rank[pos[inside] + depth] + 1
            key = rank.astype(np.int64) * (n + 1) + after
            order = np.argsort(key)
            rank = cls._ranks(key, order)
            depth *= 2
        order = np.argsort(rank.astype(np.int64) * n + pos)
        # the character before each suffix; a segment's first suffix has a mark before it, alike to none
        begins = rest == np.repeat(lengths, lengths)
        before = np.full(n, -1, np.int16)
        before[1:] = data[:-1]
        before[begins] = -1
        bwt = before[order]
        cut = np.flatnonzero(np.concatenate(([True], (bwt[1:] != bwt[:-1]) | (bwt[1:] < 0))))
        first, last = order[cut], order[np.append(cut[1:], n) - 1]
        shared = np.zeros(len(cut), np.int64)
        shared[1:] = cls._common(last[:-1], first[1:], data, levels, rest)
        return cls(bwt[cut], np.diff(np.append(cut, n)), first, last, shared, n)

    @staticmethod
    def _ranks(key: np.ndarray, order: np.ndarray) -> np.ndarray:
        k = key[order]
        rank = np.empty(len(key), np.int32)
        rank[order] = np.cumsum(np.concatenate(([False], k[1:] != k[:-1])))
        return rank

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray, data: np.ndarray, levels: list[tuple[int, np.ndarray]], rest: np.ndarray) -> np.ndarray:
        """Characters that the suffixes at ``a`` and ``b`` share, by equal ranks from the widest level down."""
        most = np.minimum(rest[a], rest[b])
        got = np.zeros(len(a), np.int64)
        for depth, rank in reversed(levels):
            open_ = got < most
            same = np.zeros(len(a), bool)
            same[open_] = rank[a[open_] + got[open_]] == rank[b[open_] + got[open_]]
            got[same] += np.minimum(depth, most[same] - got[same])
        for _ in range(levels[0][0] - 1):  # what is left is narrower than the narrowest level
            open_ = np.flatnonzero(got < most)
            got[open_[data[a[open_] + got[open_]] == data[b[open_] + got[open_]]]] += 1
        return got

    def matching_statistics(self) -> np.ndarray:
        """For every position, where its longest match with another position ends.

        A suffix inside a run shares with its neighbour one character less than the
        suffix one position earlier does, so a match ends where the match of the last
        sampled position ends: run firsts carry the match with the suffix before,
        run lasts that with the suffix after.
        """
        end = np.zeros(self.size, np.int64)
        after = np.append(self.shared[1:], 0)
        for at, shared in ((self.first, self.shared), (self.last, after)):
            sample = np.full(self.size, -1, np.int64)
            sample[at] = at + shared
            here = np.maximum.accumulate(np.where(sample >= 0, np.arange(self.size), 0))
            end = np.maximum(end, sample[here])
        return end


def repeated_windows(texts: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each segment a flag per window: it also starts anywhere else in the segments."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    matched = RunIndex.build(data, ends).matching_statistics() - np.arange(len(data)) >= window
    return [matched[e - len(t) : e - window + 1] for t, e in zip(texts, ends.tolist(), strict=True)]


def _spans(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edge[::2].tolist(), edge[1::2].tolist()


def _index_blocks(window: int):
    """Rows ``anchor, digest, open, body`` sorted by anchor: marked windows of the open segments, a block of whole anchors at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bool, bytes]] = []
        size = 0

        def search() -> pa.RecordBatch | None:
            out = []
            for (anchor, digest, open_, _), flags in zip(held, repeated_windows([h[3] for h in held], window), strict=True):
                if open_ and flags.any():
                    out.append((anchor, digest, *_spans(flags)))
            if not out:
                return None
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], ["anchor", "digest", "from", "to"])

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if size >= BLOCK_BYTES and row[0] != held[-1][0]:
                    if (r := search()) is not None:
                        yield r
                    held, size = [], 0
                if held and held[-1][:2] == row[:2]:
                    continue  # the same segment of a repeated row
                held.append(row)
                size += len(row[3])
        if held and (r := search()) is not None:
            yield r

    return run


def _single_windows(window: int):
    """Rows ``anchor, digest, open, body``: a row with two hashes for every window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for anchor, digest, open_, body in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                hashes = [hashlib.blake2b(body[i : i + window], digest_size=16).digest() for i in range(len(body) - window + 1)]
                n = len(hashes)
                yield pa.RecordBatch.from_arrays([pa.array([anchor] * n, pa.int64()), pa.array([digest] * n, pa.int64()), pa.array([open_] * n, pa.bool_()), pa.array(range(n), pa.int32()),
                                                  pa.array(hashes, pa.binary())], ["anchor", "digest", "open", "at", "hash"])

    return run


def repeated_segments(rows: DataFrame, segments: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows ``anchor, digest, from, to`` for segments with repeated windows (lists of first and end window numbers).

    ``rows`` has ``_k1, _k2, raw``; ``segments`` is the written table of their segments.
    """
    kinds = segments.groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.max("windows").alias("windows"), F.max("again").alias("again"),
                                                     F.min(F.struct("_k1", "_k2", "start")).alias("at"))
    whole = kinds.where("n > 1").select("anchor", "digest", F.array(F.lit(0)).alias("from"), F.array("windows").alias("to"))
    anchors = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.count(F.when(F.col("n") == 1, 1)).alias("single"), F.max("again").alias("again"))
    anchors = anchors.where("single > 0 and (kinds > 1 or again)").select("anchor", (F.col("kinds") > ANCHOR_LIMIT).alias("full"))
    wanted = kinds.join(anchors, "anchor").select(
        "at._k1", "at._k2", F.struct("anchor", "digest", (F.col("n") == 1).alias("open"), "full", F.col("at.start").alias("start"), (F.col("windows") + window - 1).alias("bytes")).alias("want"))
    wanted = wanted.groupBy("_k1", "_k2").agg(F.collect_list("want").alias("want"))
    found = rows.join(wanted, ["_k1", "_k2"]).select("raw", F.explode("want").alias("w"))
    bodies = found.select("w.anchor", "w.digest", "w.open", F.expr("substring(raw, cast(w.start + 1 as int), w.bytes)").alias("body"), "w.full")
    bodies = written(bodies, "segments")
    near = bodies.where("not full").drop("full").repartition("anchor").sortWithinPartitions("anchor", "digest").mapInArrow(_index_blocks(window), "anchor bigint, digest bigint, from array<int>, to array<int>")
    every = bodies.where("full").drop("full").dropDuplicates(["anchor", "digest"]).mapInArrow(_single_windows(window), "anchor bigint, digest bigint, open boolean, at int, hash binary")
    twice = every.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    far = every.where("open").join(twice, "hash").groupBy("anchor", "digest").agg(F.sort_array(F.collect_list("at")).alias("from"))
    far = far.select("anchor", "digest", "from", F.transform("from", lambda x: x + 1).alias("to"))
    return whole.unionAll(near).unionAll(far)


# ---- removal


def _cut(raw: bytes, starts: list[int], ends: list[int]) -> tuple[bytes, int, int]:
    """``raw`` without the union of the spans, the bytes removed and the number of maximal runs."""
    order = np.argsort(starts, kind="stable")
    a, e = np.asarray(starts)[order], np.maximum.accumulate(np.asarray(ends)[order])
    new = np.concatenate(([True], a[1:] > e[:-1]))
    run_start, run_end = a[new], e[np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1)]
    kept, at = [], 0
    for s, t in zip(run_start.tolist(), run_end.tolist(), strict=True):
        kept.append(raw[at:s])
        at = t
    kept.append(raw[at:])
    return b"".join(kept), int((run_end - run_start).sum()), len(run_start)


def repeated_spans(rows: DataFrame, window: int = WINDOW, codes: bool = False) -> DataFrame:
    """From ``_k1, _k2, raw``: rows ``_k1, _k2, spans`` with the byte spans (structs ``s, e``) whose windows also start elsewhere.

    With ``codes`` windows and spans count bytes of the words' codes, which one
    Python worker makes and cuts into segments.
    """
    cut = _segment_rows(window)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cut(_word_codes(batches))

    def steps() -> DataFrame:
        segments = written(rows.mapInArrow(coded if codes else cut, _SEGMENT), "segments")
        raw = rows.mapInArrow(_word_codes, "_k1 bigint, _k2 bigint, raw binary") if codes else rows
        marks = repeated_segments(raw, segments, window).select("anchor", "digest", F.explode(F.arrays_zip("from", "to")).alias("m")).select("anchor", "digest", "m.from", "m.to")
        spans = segments.select("_k1", "_k2", "anchor", "digest", "start").join(marks, ["anchor", "digest"])
        spans = spans.select("_k1", "_k2", (F.col("start") + F.col("from")).alias("s"), (F.col("start") + F.col("to") + window - 1).alias("e"))
        return spans.groupBy("_k1", "_k2").agg(F.collect_list(F.struct("s", "e")).alias("spans"))

    return settled(rows.sparkSession, "spans", steps)


def _word_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ``_k1, _k2, raw``: the text with ``CODE`` bytes for each word."""
    for b in pieces_of(batches, 2):
        codes = [b"".join([xxh3_64_digest(w, 3) for w in (r or b"").split()]) for r in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(codes, pa.binary())], ["_k1", "_k2", "raw"])


def _bytes_of_words(raw: bytes, starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """Byte spans from the first to the last whole word of each span of codes."""
    words = [m.span() for m in _WORD.finditer(raw)]
    whole = [(-(-s // CODE), e // CODE) for s, e in zip(starts, ends, strict=True)]
    return [words[s][0] for s, _ in whole], [words[e - 1][1] for _, e in whole]


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, words: int | None = None) -> DataFrame:
    """``docs`` with three columns more: ``kept`` (binary), ``n_removed`` and ``n_spans``; every row stays.

    A byte goes if a string of ``window`` bytes that covers it also starts
    anywhere else in the texts, its own included, or with ``words`` if so many words in a row
    that cover it do, whatever white space is between them; matches lie inside one text.  All
    copies go, repeated rows' too.  Null texts count as empty and keep nothing;
    texts shorter than the windows stay whole; ids may be null; an empty table
    gives an empty one.
    """
    d, where = positional(docs)
    i, t = F.col(where[doc_id]), F.col(where[text])
    keys = {"_k1": F.xxhash64(i, t), "_k2": F.xxhash64(F.lit("row"), t, i)}
    rows = d.select(*[c.alias(k) for k, c in keys.items()], t.cast("binary").alias("raw"))
    spans = repeated_spans(rows, window)
    if words:
        spans = spans.join(repeated_spans(rows, words * CODE, codes=True).withColumnRenamed("spans", "runs"), ["_k1", "_k2"], "full")
    else:
        spans = spans.withColumn("runs", F.array().cast(spans.schema["spans"].dataType))
    j = d.withColumns(keys).join(spans, ["_k1", "_k2"], "left")
    src = j.select(F.struct(*d.columns).alias("row"), t.cast("binary").alias("raw"), *[F.col(f"{c}.{k}").alias(f"{c}_{k}") for c in ("spans", "runs") for k in "se"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, 1):
            out = []
            for r, s, e, s_words, e_words in zip(*(b.column(i).to_pylist() for i in range(1, 6)), strict=True):
                if s_words:
                    more = _bytes_of_words(r, s_words, e_words)
                    s, e = (s or []) + more[0], (e or []) + more[1]
                out.append(_cut(r, s, e) if s else (r or b"", 0, 0))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, k) for x, k in zip(zip(*out, strict=True), (pa.binary(), pa.int64(), pa.int64()), strict=True)]],
                                             ["row", "kept", "n_removed", "n_spans"])

    res = src.mapInArrow(run, f"row {src.schema['row'].dataType.simpleString()}, kept binary, n_removed bigint, n_spans bigint")
    return res.select(*[F.col("row").getField(c) for c in d.columns], "kept", "n_removed", "n_spans").toDF(*docs.columns, "kept", "n_removed", "n_spans")
