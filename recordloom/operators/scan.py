"""Running values over long ordered groups, computed in chunks.

A plain window puts a whole group into one task.  One document may hold a third
of all rows, so everything that runs across pages is computed in levels: inside
the finest chunk with an ordinary window, then over one summary row per chunk,
and the carried value is joined back.  ``levels`` lists chunk columns from coarse
to fine; each must be a non-decreasing function of the order inside its parent.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Pages per coarse chunk: a document of a billion pages leaves about 60,000
# summary rows for the last window.
PAGES_PER_CHUNK = 16384


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is ``last`` (ignoring nulls), ``sum``, ``max`` or ``min``."""

    out: str
    kind: str
    value: str

    def over(self, w) -> Column:
        c = F.col(self.value)
        return {
            "last": F.last(c, ignorenulls=True),
            "sum": F.sum(c),
            "max": F.max(c),
            "min": F.min(c),
        }[self.kind].over(w)

    def summary(self, order: Sequence[str]) -> Column:
        c = F.col(self.value)
        if self.kind == "last":
            key = F.struct(*[F.col(o) for o in order])
            return F.max_by(c, F.when(c.isNotNull(), key))
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.kind](c)

    def join(self, carried: Column, local: Column) -> Column:
        if self.kind == "last":
            return F.coalesce(local, carried)
        if self.kind == "sum":
            return F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))
        fn = F.greatest if self.kind == "max" else F.least
        return fn(carried, local)


def running(
    df: DataFrame,
    keys: Sequence[str],
    levels: Sequence[str],
    order: Sequence[str],
    specs: Sequence[Running],
    inclusive: bool = True,
) -> DataFrame:
    """Add the running values of ``specs`` over ``order`` inside ``keys``.

    ``inclusive`` False leaves the current row out.
    """
    end = 0 if inclusive else -1
    w = (
        Window.partitionBy(*keys, *levels)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, end)
    )
    out = df.select("*", *[s.over(w).alias(s.out) for s in specs])
    if not levels:
        return out
    chunk = levels[-1]
    n = len(levels)
    summary = df.groupBy(*keys, *levels).agg(*[s.summary(order).alias(f"_v{n}_{i}") for i, s in enumerate(specs)])
    carried = running(
        summary, keys, levels[:-1], [chunk],
        [Running(f"_c{n}_{i}", s.kind, f"_v{n}_{i}") for i, s in enumerate(specs)], inclusive=False,
    ).select(*keys, *levels, *[f"_c{n}_{i}" for i in range(len(specs))])
    joined = out.join(carried, [*keys, *levels], "left")
    cols = []
    for i, s in enumerate(specs):
        cols.append(s.join(F.col(f"_c{n}_{i}"), F.col(s.out)).alias(s.out))
    keep = [c for c in df.columns]
    return joined.select(*keep, *cols)


def with_page_chunks(df: DataFrame, page: str = "page_no", size: int = PAGES_PER_CHUNK) -> DataFrame:
    """Add ``page_chunk``, the coarse level above pages."""
    return df.withColumn("page_chunk", F.floor(F.col(page) / F.lit(size)))


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: dict[str, str],
    step: int = 1,
    chunk_size: int = PAGES_PER_CHUNK,
) -> DataFrame:
    """``lead`` (``step`` 1) or ``lag`` (``step`` -1) of several columns over a long group.

    ``values`` maps output name to source column.  Inside a chunk of ``order``
    it is a window; only rows at the chunk edge look at the next non-empty
    chunk's edge row, which comes from one summary row per chunk.
    """
    src = list(values.values())
    d = df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk_size)))
    w = Window.partitionBy(*keys, "_chunk").orderBy(order)
    shift = F.lead if step > 0 else F.lag
    pack = F.struct(*[F.col(s).alias(f"v{i}") for i, s in enumerate(src)])
    d = d.withColumn("_n", shift(pack, 1).over(w))
    edge_pick = F.min_by if step > 0 else F.max_by
    edges = d.groupBy(*keys, "_chunk").agg(edge_pick(pack, F.col(order)).alias("_edge"))
    we = Window.partitionBy(*keys).orderBy("_chunk")
    edges = edges.select(*keys, "_chunk", shift("_edge", 1).over(we).alias("_next_edge"))
    d = d.join(edges, [*keys, "_chunk"], "left").withColumn("_n", F.coalesce("_n", "_next_edge"))
    return d.select(*df.columns, *[F.col("_n").getField(f"v{i}").alias(o) for i, o in enumerate(values)])
