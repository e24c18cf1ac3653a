"""Benchmark decontamination by templates: numbers, names and units become typed placeholders, windows of templates are joined by hash."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from recordloom.llm.common import pieces_of, positional, take, written

U = np.uint64
WINDOW = 5
MIN_LITERALS = 3
MIN_COVERAGE = 0.4
MIN_CONSISTENCY = 0.8
#: Benchmark windows that are broadcast at most (16 bytes each); beyond, windows of all texts meet in a shuffle join.
BROADCAST_WINDOWS = 1 << 20
CACHE_ENTRIES = 500_000
#: Alignments of one chain follow each other at this distance at most.
CHAIN_GAP = WINDOW

# Units of measure and number words.
UNITS = frozenset("mm cm m km in ft yd mi mile miles meter meters metre metres kilometer kilometers inch inches foot feet yard yards mg g kg lb lbs oz gram grams kilogram kilograms "
                  "pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hrs hour hours day days week weeks "
                  "month months year years cent cents dollar dollars euro euros usd eur km/h mph percent % $ € £".split())
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty "
                         "sixty seventy eighty ninety hundred thousand million billion first second third fourth fifth half twice".split())

_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%)?$")
_MEASURE = re.compile(r"[+-]?[$€£]?\d[\d.,]*([a-z/%]+)$")
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "$%+-") + "“”‘’„«»…–—¿¡"
SKIP, LITERAL, NUMBER, NAME, UNIT, MEASURE = range(6)


def classify(word: str) -> tuple[int, str]:
    """Kind and lower-case core of a word: number, measure (number with unit), unit, name (capital first, not all capitals) or literal."""
    core = word.strip(_EDGE)
    low = core.lower()
    if not low:
        return SKIP, ""
    if _NUMBER.match(low) or low in NUMBER_WORDS:
        return NUMBER, low
    if (m := _MEASURE.match(low)) and m[1] in UNITS:
        return MEASURE, low
    if low in UNITS:
        return UNIT, low
    if core[0].isupper() and not (len(core) > 1 and core.isupper()):
        return NAME, low
    return LITERAL, low


class Words(dict):
    """Codes of words met in this worker, with their template hash, own hash, kind and core.  Emptied at ``CACHE_ENTRIES`` between batches."""

    def __init__(self):
        super().__init__()
        self.cores: list[str] = []
        self.kinds, self.template, self.own = [], [], []
        self.arrays = (np.zeros(0, np.int8), np.zeros(0, U), np.zeros(0, U))

    def __missing__(self, word: bytes) -> int:
        kind, core = classify(word.decode("utf-8", "replace"))
        core = core.casefold()  # as ß is SS in capitals
        own = xxh64_intdigest(core, 5)
        self[word] = code = len(self.kinds)
        self.cores.append(core)
        self.kinds.append(kind)
        self.own.append(own)
        self.template.append(own if kind <= LITERAL else xxh64_intdigest(b"slot", kind))
        return code

    def columns(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(self.arrays[0])
        if n < len(self.kinds):
            self.arrays = tuple(np.concatenate((a, np.array(x[n:], a.dtype))) for a, x in zip(self.arrays, (self.kinds, self.template, self.own), strict=True))
        return self.arrays


_WORKER: list[Words] = []


def _words() -> Words:
    if not _WORKER or len(_WORKER[0]) >= CACHE_ENTRIES:
        _WORKER[:] = [Words()]
    return _WORKER[0]


def _rolled(h: np.ndarray, length: int, kind: int) -> np.ndarray:
    """Hash of every window of ``length`` words; windows of another length or kind have other hashes."""
    n = len(h) - length + 1
    out = np.full(max(n, 0), U(length * 2 + kind))
    for j in range(length if n > 0 else 0):
        out = (out ^ h[j : j + n]) * U(0x9E3779B97F4A7C15)
        out ^= out >> U(31)
    return out


_WINDOWS = "_i bigint, pos int, words int, hash bigint, kind int, length int, literals int, slots array<struct<at:int,value:string>>"
_SLOTS = pa.list_(pa.struct([("at", pa.int32()), ("value", pa.string())]))


def _windows(keys: int, shapes: list[tuple[int, int]] | None, wanted: np.ndarray | None):
    """Windows of texts (the column after ``keys`` key columns): of the given (kind, length) shapes, all or those whose hash is wanted.

    Shapes None: those of a benchmark text, whole if it is shorter than the window.
    Kind 0 windows are templates, in which neighbouring words of one slot type are
    one placeholder with their joined value; kind 1 windows are the words themselves.
    Places and lengths are counted in placeholders and words.
    """
    near = np.zeros(1 << 20, bool)
    if wanted is not None:
        near[(wanted >> U(44)).astype(np.int64)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, keys):
            words = _words()
            codes, sizes = [], []
            for raw in b.column(keys).to_pylist():
                c = list(map(words.__getitem__, (raw or b"").split()))
                codes += c
                sizes.append(len(c))
            code = np.array(codes, np.int64)
            kind_of, template, own = words.columns()
            owner = np.repeat(np.arange(len(sizes)), sizes)
            keep = kind_of[code] != SKIP
            code, owner = code[keep], owner[keep]
            kinds = kind_of[code]
            head = np.ones(len(code), bool)
            head[1:] = (kinds[1:] <= LITERAL) | (kinds[1:] != kinds[:-1]) | (owner[1:] != owner[:-1])
            start = np.flatnonzero(head)
            stop = np.append(start[1:], len(code))
            # of templates and words: hashes, kinds, owners and where each text begins
            forms = [(x, kinds[at], owner[at], np.searchsorted(owner[at], np.arange(len(sizes) + 1))) for x, at in ((template[code[start]], start), (own[code], slice(None)))]
            rows: list[tuple] = []
            todo = [(k, n, None) for k, n in shapes] if shapes is not None else [
                (k, int(min(WINDOW, n)), int(n)) for k in (0, 1) for n in np.unique(np.diff(forms[k][3])) if n]
            for kind, length, only in todo:
                hashes, kinds, owner, first = forms[kind]
                h = _rolled(hashes, length, kind)
                if wanted is None:
                    hit = np.arange(len(h))
                else:
                    hit = np.flatnonzero(near[(h >> U(44)).astype(np.int64)])
                    hit = hit[np.isin(h[hit], wanted)]
                hit = hit[owner[hit] == owner[hit + length - 1]] if len(hit) else hit
                for at in hit.tolist():
                    i = int(owner[at])
                    size = int(first[i + 1] - first[i])
                    if only is not None and size != only:
                        continue
                    inside = kinds[at : at + length]
                    slots = [{"at": j, "value": " ".join([words.cores[c] for c in code[start[at + j] : stop[at + j]].tolist()])} for j in np.flatnonzero(inside > LITERAL).tolist()] if kind == 0 else []
                    rows.append((i, at - int(first[i]), size, int(h[at].view(np.int64)), kind, length, int((inside == LITERAL).sum()), slots))
            if rows:
                cols = list(zip(*rows, strict=True))
                at = pa.array(cols[0], pa.int64())
                types = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), _SLOTS)
                yield pa.RecordBatch.from_arrays([*[b.column(i).take(at) for i in range(keys)], *[pa.array(x, t) for x, t in zip(cols[1:], types, strict=True)]],
                                                 [*b.schema.names[:keys], "pos", "words", "hash", "kind", "length", "literals", "slots"])

    return run


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Windows that stand for each benchmark text: ``item_id, item, hash, kind, length, ipos, islots, windows``.

    Templates need ``MIN_LITERALS`` literal words (fewer in a text shorter than the
    window: all but two fifths).  Every text is also looked for by its own words, whose case does not count.
    """
    b = take(benchmark, item_id, text).toDF("item_id", "text").select("item_id", F.xxhash64("item_id", "text").alias("item"), F.col("text").cast("binary").alias("raw"))
    kind = b.schema["item_id"].dataType.simpleString()
    w = written(b.mapInArrow(_windows(2, None, None), f"item_id {kind}, item bigint, {_WINDOWS.split(', ', 1)[1]}"), "benchmark")
    fit = (F.col("kind") == 0) & (F.col("literals") >= F.least(F.lit(MIN_LITERALS), F.ceil(F.col("length") * MIN_LITERALS / WINDOW).cast("int")))
    able = w.groupBy("item").agg(F.count_distinct(F.when(fit, F.col("pos"))).alias("fit"), F.count_distinct(F.when(F.col("kind") == 1, F.col("pos"))).alias("every"))
    w = w.join(able, "item").where(fit | (F.col("kind") == 1))
    return w.select("item_id", "item", "hash", "kind", "length", F.col("pos").alias("ipos"), F.col("slots").alias("islots"),
                    F.when(F.col("kind") == 0, F.col("fit")).otherwise(F.col("every")).alias("windows")).dropDuplicates(["item", "kind", "ipos"])


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows ``doc_id, k1, k2, item_id, windows, matched, coverage, consistency, verbatim``, one per document and benchmark text found in it.

    Found means: windows with the same words, or templates with the same slots, cover ``MIN_COVERAGE`` of
    the benchmark text's windows (``verbatim``), or template windows in one
    alignment or a chain of neighbouring ones do and ``MIN_CONSISTENCY`` of the slots are filled consistently: one
    benchmark value always has the same value in the document.  Null and empty
    texts on either side match nothing; ids may be null; repeated documents are one
    row, repeated benchmark rows too; empty tables give an empty one.  ``k1, k2``
    are hashes of document id and text.
    """
    w = written(benchmark_windows(benchmark, item_id, item_text), "benchmark")
    shapes = [tuple(r) for r in w.select("kind", "length").distinct().limit(4 * WINDOW).collect()]
    d, where = positional(docs)
    i, t = F.col(where[doc_id]), F.col(where[text])
    src = d.select(i.alias("doc_id"), F.xxhash64(i, t).alias("k1"), F.xxhash64(F.lit("row"), t, i).alias("k2"), t.cast("binary").alias("raw"))
    hashes = w.select("hash").distinct()
    few = hashes.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    wanted = np.sort(np.array([r[0] for r in hashes.collect()], np.int64).view(U)) if few else None
    kind = src.schema["doc_id"].dataType.simpleString()
    found = src.mapInArrow(_windows(3, shapes, wanted), f"doc_id {kind}, k1 bigint, k2 bigint, {_WINDOWS.split(', ', 1)[1]}")
    hits = found.select("doc_id", "k1", "k2", "pos", "hash", "kind", "length", "slots").join(w, ["hash", "kind", "length"])
    same = F.transform("slots", lambda x: x["value"]) == F.transform("islots", lambda x: x["value"])
    keys = ["doc_id", "k1", "k2", "item_id", "item"]
    # one row per aligned window, so that repeated rows do not count twice
    hits = hits.groupBy(*keys, "kind", "pos", "ipos").agg(F.first("windows").alias("windows"), F.first(same).alias("same"), F.first("slots").alias("slots"), F.first("islots").alias("islots"))
    hits = hits.withColumn("line", F.col("pos") - F.col("ipos"))
    hits = written(hits, "hits")
    plain = hits.where("same").groupBy(*keys, "kind").agg(F.max("windows").alias("windows"), F.count_distinct("ipos").alias("matched"))
    plain = plain.where(F.col("matched") >= MIN_COVERAGE * F.col("windows")).select(*keys, "windows", "matched", F.lit(1.0).alias("consistency"), F.lit(True).alias("verbatim"))
    hits = hits.where("kind = 0").drop("kind")
    # alignments alone, and chains of neighbouring ones: a window counts for both
    near = hits.select(*keys, "line").distinct()
    order = Window.partitionBy(*keys).orderBy("line")
    near = near.withColumn("new", F.coalesce((F.col("line") - F.lag("line").over(order) > CHAIN_GAP).cast("int"), F.lit(0)))
    near = near.withColumn("chain", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    sizes = near.groupBy(*keys, "chain").agg(F.collect_list("line").alias("members")).where(F.size("members") > 1).select(*keys, "chain", F.explode("members").alias("line"))
    same_line = F.lit(True)
    for k in (*keys, "line"):
        same_line = same_line & F.col(f"h.{k}").eqNullSafe(F.col(f"c.{k}"))
    chained = hits.alias("h").join(sizes.alias("c"), same_line).select(*[F.col(f"h.{c}") for c in hits.columns if c != "line"], F.struct(F.lit(True).alias("chain"), F.col("c.chain").cast("int").alias("n")).alias("line"))
    hits = hits.withColumn("line", F.struct(F.lit(False).alias("chain"), F.col("line").cast("int").alias("n"))).unionByName(chained)
    lines = hits.groupBy(*keys, "line").agg(F.max("windows").alias("windows"), F.count_distinct("ipos").alias("matched")).where(F.col("matched") >= MIN_COVERAGE * F.col("windows"))
    slot = hits.select(*keys, "line", "ipos", F.explode(F.arrays_zip("slots", "islots")).alias("s"))
    slot = slot.select(*keys, "line", (F.col("ipos") + F.col("s.islots.at")).alias("at"), F.col("s.slots.value").alias("d"), F.col("s.islots.value").alias("b")).distinct()
    slot = slot.groupBy(*keys, "line", "b", "d").agg(F.count("*").alias("n")).groupBy(*keys, "line", "b").agg(F.max("n").alias("top"), F.sum("n").alias("n"))
    slot = slot.groupBy(*keys, "line").agg((F.sum("top") / F.sum("n")).alias("consistency"))
    null_safe = [lines[k].eqNullSafe(slot[k]) for k in (*keys, "line")]
    cond = null_safe[0]
    for c in null_safe[1:]:
        cond = cond & c
    lines = lines.join(slot, cond, "left").select(*[lines[k] for k in keys], lines["windows"], lines["matched"], F.coalesce(slot["consistency"], F.lit(1.0)).alias("consistency"),
                                                  F.lit(False).alias("verbatim"))
    both = plain.unionAll(lines.where(F.col("consistency") >= MIN_CONSISTENCY))
    best = both.groupBy(*keys).agg(F.max(F.struct("verbatim", "matched", "consistency", "windows")).alias("m"))
    return best.select("doc_id", "k1", "k2", "item_id", "m.windows", "m.matched", (F.col("m.matched") / F.col("m.windows")).alias("coverage"), "m.consistency", "m.verbatim")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents in which a benchmark text is found."""
    d, where = positional(docs)
    i, t = F.col(where[doc_id]), F.col(where[text])
    bad = contaminated(docs, benchmark, doc_id, text).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct()
    out = d.withColumns({"_k1": F.xxhash64(i, t), "_k2": F.xxhash64(F.lit("row"), t, i)}).join(bad, ["_k1", "_k2"], "left_anti")
    return out.drop("_k1", "_k2").toDF(*docs.columns)
