"""Shared helpers: columns by exact name, row keys, written intermediate tables, Arrow batches."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.session import run_folder


def reach(spark: SparkSession) -> None:
    """Let Python workers that share this file system import the package, whatever folder the driver runs in."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns ``_c0, _c1, ...`` and the map from exact name to that name (the first of equal names).

    Extra columns whose names clash with a result's, or differ from a needed
    one only in case, can then do no harm.
    """
    reach(df.sparkSession)
    names = [f"_c{i}" for i in range(len(df.columns))]
    where: dict[str, str] = {}
    for name, pos in zip(df.columns, names, strict=True):
        where.setdefault(name, pos)
    return df.toDF(*names), where


def take(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, picked by exact name; every other column is left out."""
    d, where = positional(df)
    return d.select(*[F.col(where[n]).alias(n) for n in names])


def row_key(row_id: Column, text: Column) -> list[Column]:
    """Two 64-bit hashes ``_k1, _k2`` of id and text that stand for a row.  Only fully repeated rows share them."""
    return [F.xxhash64(row_id, text).alias("_k1"), F.xxhash64(F.lit("row"), text, row_id).alias("_k2")]


_OPEN: list[list[str]] = []


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: lineage is cut, no executor holds the only copy."""
    spark = df.sparkSession
    path = run_folder(spark, tag)
    if _OPEN:
        _OPEN[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, tag: str, steps: Callable[[], DataFrame]) -> DataFrame:
    """What ``steps`` gives as a written table; the tables written on the way there are deleted, and their shuffles let go.

    For results that are small beside what leads to them.
    """
    _OPEN.append([])
    try:
        path = run_folder(spark, tag)
        out = steps()
        out.write.option("compression", "zstd").parquet(path)
        schema = out.schema
        del out
    finally:
        done = _OPEN.pop()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in done:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        where.getFileSystem(conf).delete(where, True)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    if _OPEN:
        _OPEN[-1].append(path)
    return spark.read.schema(schema).parquet(path)


def pieces_of(batches: Iterable[pa.RecordBatch], column: int, max_bytes: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of the batches, each with about ``max_bytes`` of binary column ``column`` or a single row."""
    for b in batches:
        if not b.num_rows:
            continue
        offsets = np.frombuffer(b.column(column).buffers()[1], np.int32 if pa.types.is_binary(b.schema.field(column).type) else np.int64)
        offsets = offsets[b.column(column).offset : b.column(column).offset + b.num_rows + 1].astype(np.int64)
        at = 0
        while at < b.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
            to = min(max(to, at + 1), b.num_rows)
            yield b.slice(at, to - at)
            at = to


def flat_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and the row borders in them (null: empty)."""
    if col.null_count:
        col = col.fill_null(b"")
    kind = np.int32 if pa.types.is_binary(col.type) else np.int64
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def connected_components(edges: DataFrame, tag: str = "components", max_rounds: int = 60) -> DataFrame:
    """Rows ``(node, root)`` for every node of the edges ``(a, b)``; the root is the component's smallest node.

    Alternating large-star and small-star rounds on grouped minima: a node's
    neighbours are never gathered, and each round is a written table.  Rows of an
    edge table with null ends are not links.  An empty table gives an empty one.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = written(e, tag)
    state = None
    for _ in range(max_rounds):
        # large star: larger neighbours of a node meet the smallest of its neighbourhood
        both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: smaller neighbours of a node, and the node, meet the smallest one
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        e = e.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        e = written(e.select("e.a", "e.b").where("a <> b").distinct(), tag)
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == state:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(e.select(F.col("b"), F.col("b"))).distinct()
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
