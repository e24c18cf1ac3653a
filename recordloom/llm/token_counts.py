"""Token counts without a shuffle: a broadcast table of frequent pre-tokens, then a cache in each worker."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import pieces_of, take
from recordloom.llm.pretokens import SAFE, plain_pattern

# Fixed value: the pre-token pattern of byte-level BPE with a leading blank.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = re.compile(r"(?<=[!-~]) (?=[!-~])")
_PATTERN = plain_pattern(PRE_TOKEN)
CACHE_ENTRIES = 1_000_000
FIT_ROWS, FIT_CHARS, FREQUENT = 2_000, 4_096, 1 << 15

_WORKERS: dict[str, "Encoder"] = {}


class Encoder(dict):
    """Lengths of pre-tokens met in this worker; a missing one is encoded.  Emptied at ``CACHE_ENTRIES``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.lib = Tokenizer.from_file(path)
        added = sorted((t.content for t in self.lib.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, added))) if added else None

    def __missing__(self, piece: str) -> int:
        n = len(self.lib.encode(piece, add_special_tokens=False).ids)
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[piece] = n
        return n

    def direct(self, text: str, size: int = 1 << 16) -> int:
        """The library's own count, over parts that end where every pre-token ends."""
        n, at = 0, 0
        while at < len(text):
            cut = _CUT.search(text, at + size)
            to = cut.start() if cut else len(text)
            n += len(self.lib.encode(text[at:to], add_special_tokens=False).ids)
            at = to
        return n

    def pieces(self, text: str) -> tuple[int, list[str]]:
        """Special strings found, and the pre-tokens between them."""
        if self.special is None or not self.special.search(text):
            return 0, _PATTERN.findall(text)
        parts = self.special.split(text)
        return len(parts) - 1, list(chain.from_iterable(map(_PATTERN.findall, parts)))

    def count(self, text: str, frequent: dict[str, int]) -> int:
        if not SAFE.fullmatch(text):
            return self.direct(text)
        n, pieces = self.pieces(text)
        first = list(map(frequent.get, pieces))
        n += sum(filter(None, first))
        return n + sum(map(self.__getitem__, [p for p, v in zip(pieces, first, strict=True) if v is None]))


def encoder(path: str) -> Encoder:
    if path not in _WORKERS:
        _WORKERS[path] = Encoder(path)
    return _WORKERS[path]


def frequent_lengths(docs: DataFrame, text: str, path: str) -> dict[str, int]:
    """At most ``FREQUENT`` pre-tokens with their lengths, from the first ``FIT_CHARS`` characters of ``FIT_ROWS`` rows.

    It decides only where a length is looked up, never what it is.  The rows come
    from the first partitions that have them; no other partition is read.
    """
    rows = take(docs, text).select(F.substring(text, 1, FIT_CHARS).alias("t")).limit(FIT_ROWS).collect()
    enc, seen = Encoder(path), Counter()
    for r in rows:
        if r["t"] and SAFE.fullmatch(r["t"]):
            seen.update(p for p in enc.pieces(r["t"])[1] if len(p) <= 64)
    return {p: enc[p] for p, _ in seen.most_common(FREQUENT)}


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens).

    ``path`` is a byte-level BPE file of the tokenizers library; special strings
    in a text are handled as that library does by default.  Null or empty text: 0
    bytes, 0 tokens.  Null ids and repeated rows are kept; other columns are not
    read; an empty table gives an empty one.
    """
    src = take(docs, doc_id, text).toDF("doc_id", "text")
    frequent = src.sparkSession.sparkContext.broadcast(frequent_lengths(src, "text", path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, table = encoder(path), frequent.value
        for b in pieces_of(batches, 1):
            raws = [r or b"" for r in b.column(1).to_pylist()]
            n = [enc.count(r.decode("utf-8", "replace"), table) for r in raws]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(r) for r in raws], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.select("doc_id", F.col("text").cast("binary").alias("raw")).mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
