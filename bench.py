"""Headline queries, timed over whole results; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from recordloom.plans import load_all  # noqa: E402
from recordloom.plans.registry import QUERIES  # noqa: E402
from recordloom.session import local_session  # noqa: E402

HEADLINE = [
    "count_check", "page_metrics", "line_filter", "best_table", "six_columns", "block_pivot", "period_cell", "tilde_grammar",
    "names_backward", "catalog_contains", "dup_mark", "licence_dedup", "award_merge", "validator", "result_diff",
    "attach_continuations", "words_to_lines", "reentrant_block",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "recordloom-bench")
    spark.sparkContext.setLogLevel("OFF")
    load_all()
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    times: dict[str, float] = {}
    for n in names:
        t = time.time()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": Path(sf_dir).name.replace("sf", "")}))


if __name__ == "__main__":
    main()
