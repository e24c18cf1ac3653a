"""Packing by shortest-pack-first over the length histogram, joined back to pieces by rank."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import pieces_of, reach, take, written
from recordloom.llm.pretokens import SAFE, plain_pattern

# Fixed value: the pre-token pattern of lower-case BPE with word ends.
WORD_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PATTERN = plain_pattern(WORD_TOKEN)
_CUT = re.compile(r"[ \t\n\r]")
SIZE = 2048
END_ID = 1
CACHE_ENTRIES, RUN_CHARS = 1 << 19, 64

_WORKERS: dict[str, "WordIds"] = {}


class WordIds(dict):
    """Ids of pre-tokens met in this worker, as little-endian 32-bit numbers, and those of runs without a blank.  Either is emptied at ``CACHE_ENTRIES``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.runs: dict[str, bytes] = {}
        self.lib = Tokenizer.from_file(path)
        self.model = self.lib.model
        added = {t.content: i for i, t in self.lib.get_added_tokens_decoder().items()}
        self.added = {k: np.uint32(v).tobytes() for k, v in added.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def __missing__(self, piece: str) -> bytes:
        # a pre-token in lower case: only its bytes' letters and the model are left of the library's steps
        letters = piece if piece.isascii() else self.letters.pre_tokenize_str(piece)[0][0]
        ids = [t.id for t in self.model.tokenize(letters)]
        ids = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[piece] = ids
        return ids

    def plain(self, text: str) -> bytes:
        """Ids of a safe text without special strings.  No pre-token crosses a blank, so runs stand alone."""
        runs = text.lower().split()
        parts = list(map(self.runs.get, runs))
        if None in parts:
            if len(self.runs) >= CACHE_ENTRIES:
                self.runs.clear()
            for i, p in enumerate(parts):
                if p is None:
                    parts[i] = b"".join(map(self.__getitem__, _PATTERN.findall(runs[i])))
                    if len(runs[i]) <= RUN_CHARS:
                        self.runs[runs[i]] = parts[i]
        return b"".join(parts)

    def whole(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def direct(self, text: str, size: int = 1 << 16) -> bytes:
        """The library's own ids, over parts that end at white space, which no pre-token crosses."""
        out, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, at + size)
            to = cut.start() if cut else len(text)
            out.append(self.whole(text[at:to]))
            at = to
        return b"".join(out)

    def ids(self, text: str) -> bytes:
        if not SAFE.fullmatch(text):
            return self.direct(text)
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        return b"".join(self.added[p] if p in self.added else self.plain(p) for p in self.special.split(text))


def token_pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Rows ``doc_id, start, length, doc_tokens, ids``: each document's ids with ``end_id`` after them, cut every ``size`` ids.

    ``ids`` holds little-endian 32-bit numbers.  Null and empty texts give one piece with the end id alone.
    """
    src = take(docs, doc_id, text).toDF("doc_id", "text").select("doc_id", F.col("text").cast("binary").alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _WORKERS:
            _WORKERS[path] = WordIds(path)
        words, end = _WORKERS[path], np.uint32(end_id).tobytes()
        for b in pieces_of(batches, 1):
            at, start, length, total, ids = [], [], [], [], []
            for i, raw in enumerate(b.column(1).to_pylist()):
                every = words.ids((raw or b"").decode("utf-8", "replace")) + end
                n = len(every) // 4
                for s in range(0, n, size):
                    at.append(i)
                    start.append(s)
                    length.append(min(size, n - s))
                    total.append(n)
                    ids.append(every[4 * s : 4 * (s + size)])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(total, pa.int64()),
                                              pa.array(ids, pa.binary())], ["doc_id", "start", "length", "doc_tokens", "ids"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, ids binary")


def packing_patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with their counts.  Lengths go longest first, each to the shortest open pack; what fits none opens packs.

    A pattern stands for all packs with the same lengths, so work follows the number of lengths.
    """
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(pattern: tuple[int, ...], count: int, gap: int) -> None:
        if count:
            open_packs.setdefault(gap, []).append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            gap = max((g for g, packs in open_packs.items() if packs), default=0)
            if gap < length:
                per = size // length
                put((length,) * per, left // per, size - per * length)
                put((length,) * (left % per), int(left % per > 0), size - (left % per) * length)
                break
            pattern, count = open_packs[gap].pop()
            # equal lengths go on into the same pack while it stays the shortest
            used = min(left, count)
            put(pattern, count - used, gap)
            put((*pattern, length), used, gap - length)
            left -= used
    return [x for packs in open_packs.values() for x in packs]


def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows ``length, first rank, first sequence, offset``, by length and rank."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            out.append((length, rank.get(length, 0), sequence, offset))
            rank[length] = rank.get(length, 0) + count
            offset += length
        sequence += count
    a = np.array(out, np.int64).reshape(-1, 4)
    return a[np.lexsort((a[:, 1], a[:, 0]))]


def pack(pieces: DataFrame, length: str = "length", size: int = SIZE, buckets: int | None = None) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; every row keeps its columns.

    ``length`` is from 1 to ``size``.  The histogram has at most ``size`` rows and
    goes to the driver; pieces do not.  A piece's rank among its length is the
    count in earlier hash buckets plus its place in its own bucket, so a length
    that a third of all pieces share is ranked by many tasks.  Repeated rows get
    places of their own; an empty table gives an empty one.
    """
    reach(pieces.sparkSession)
    p = written(pieces, "pieces")
    spark = p.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns, schema = p.columns, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in p.schema)
    p = p.withColumn("_h", F.xxhash64(*columns)).withColumn("_b", F.pmod("_h", F.lit(buckets)))
    histogram = {r[0]: r[1] for r in p.groupBy(length).count().collect()}
    slots = spark.sparkContext.broadcast(_slots(packing_patterns(histogram, size)))
    before = Window.partitionBy(length).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    first = p.groupBy(length, "_b").count().select(length, "_b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    place = F.row_number().over(Window.partitionBy(length, "_b").orderBy("_h", *columns))
    ranked = p.select("*", place.alias("_n")).join(first, [length, "_b"]).select(*columns, (F.col("_first") + F.col("_n") - 1).alias("_rank"))
    at = columns.index(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        step = int(table[:, 1].max(initial=0)) + 1
        keys = table[:, 0] * step + table[:, 1]
        for b in batches:
            rank = b.column(len(columns)).to_numpy(zero_copy_only=False)
            i = np.searchsorted(keys, b.column(at).to_numpy(zero_copy_only=False) * step + np.minimum(rank, step - 1), side="right") - 1
            sequence = table[i, 2] + rank - table[i, 1]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(table[i, 3])], [*columns, "sequence_id", "offset"])

    return ranked.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")
