"""Scan helpers."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

#: Session setting of single-machine runs: the number of partitions of a feed.  Unset on a cluster.
FEED_PARTITIONS = "spark.recordloom.feed.partitions"

#: Rows of a source table in one partition; a row becomes a page of some dozens of lines, words or cells.
ROWS_PER_PARTITION = 10_000


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys``, which name a page (or a customer), before its rows are rendered.

    The narrow source rows are shuffled once; what is made of them stays where it is,
    since groups, windows and joins of a page find their rows already together.
    The number of partitions grows with the table (its row count is in the file's footers).
    """
    n = df.sparkSession.conf.get(FEED_PARTITIONS, None)
    if n is None:
        n = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / ROWS_PER_PARTITION))
    return df.repartition(int(n), *keys)
