"""Second-way counts and the checks built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.operators.lines import line_kind

LOOK_BACK, LOOK_AHEAD = 12, 8
PAGE_CAPACITY = 6


def page_metrics(lines: DataFrame, keys: tuple[str, ...] = ("doc_id", "page_no")) -> DataFrame:
    """Valid career blocks and arrow classes per page.

    A ``~`` line counts when the nearest decisive line within 12 above is a date
    and within 8 below is a date or ongoing mark.  Arrow lines before the first
    counted block belong to the previous page ('border'), later ones to the table.
    Both windows share one partitioning and order, so the page is sorted once.
    """
    w = Window.partitionBy(*keys).orderBy("line_no")
    k = F.col("kind")
    d = lines.select(*keys, "line_no", line_kind(F.col("line")).alias("kind"))
    before = F.when(k.isin("mask", "arrow", "date", "tilde"), k)
    after = F.when(k.isin("mask", "date", "ongoing", "tilde"), k)
    d = d.select(
        "*",
        F.last(before, ignorenulls=True).over(w.rowsBetween(-LOOK_BACK, -1)).alias("prev_kind"),
        F.first(after, ignorenulls=True).over(w.rowsBetween(1, LOOK_AHEAD)).alias("next_kind"),
    )
    valid = (k == "tilde") & (F.col("prev_kind") == "date") & F.col("next_kind").isin("date", "ongoing")
    d = d.select("*", F.coalesce(valid, F.lit(False)).alias("valid"))
    seen = F.max(F.col("valid").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = d.select("*", F.coalesce(seen, F.lit(0)).alias("seen"))
    arrow = k == "arrow"
    out = d.groupBy(*keys).agg(
        F.count_if(F.col("valid")).alias("n_tilde"),
        F.count_if(arrow & (F.col("seen") == 0)).alias("n_border"),
        F.count_if(arrow & (F.col("seen") == 1)).alias("n_table"),
    )
    return out.select(
        *keys, "n_tilde", "n_border", "n_table",
        F.greatest(F.lit(0), F.col("n_tilde") - F.col("n_border")).cast("bigint").alias("legacy"),
        F.greatest(F.lit(0), F.lit(PAGE_CAPACITY) - F.col("n_border") - F.col("n_table")).cast("bigint").alias("capacity"),
    )


def page_check(metrics: DataFrame, records: DataFrame, keys: tuple[str, ...] = ("doc_id", "page_no")) -> DataFrame:
    """Parsed records per page against the counted blocks and the page capacity."""
    parsed = records.groupBy(*keys).agg(F.count(F.lit(1)).alias("parsed"))
    d = metrics.join(parsed, list(keys), "left").withColumn("parsed", F.coalesce("parsed", F.lit(0)).cast("bigint"))
    return d.select(
        *keys, "n_tilde", "parsed", "n_border", "n_table", "capacity",
        (F.col("n_tilde") == F.col("parsed")).alias("match"),
        (F.col("n_tilde") > F.col("capacity")).alias("overflow"),
    )


def page_check_errors(check: DataFrame, section: str = "tech") -> DataFrame:
    """One error row per mismatch and per overflow."""
    return check.where(~F.col("match") | F.col("overflow")).select(
        "doc_id", "page_no",
        F.explode(
            F.filter(
                F.array(
                    F.when(
                        ~F.col("match"),
                        F.struct(
                            F.lit("page_count_mismatch").alias("kind"), F.lit(section).alias("section"),
                            F.col("n_tilde").alias("expected"), F.col("parsed").alias("actual"),
                            (F.col("parsed") - F.col("n_tilde")).alias("diff"),
                        ),
                    ),
                    F.when(
                        F.col("overflow"),
                        F.struct(
                            F.lit("page_over_capacity").alias("kind"), F.lit(section).alias("section"),
                            F.col("capacity").alias("expected"), F.col("n_tilde").alias("actual"),
                            (F.col("n_tilde") - F.col("capacity")).alias("diff"),
                        ),
                    ),
                ),
                lambda x: x.isNotNull(),
            )
        ).alias("e"),
    ).select("doc_id", "page_no", "e.*")


def section_totals(metrics: DataFrame, page_sections: DataFrame) -> DataFrame:
    """Counted blocks per document and section over the section's page range (tilde and legacy sums)."""
    return (
        metrics.join(page_sections.select("doc_id", "page_no", "section"), ["doc_id", "page_no"])
        .groupBy("doc_id", "section")
        .agg(F.sum("n_tilde").alias("total"), F.sum("legacy").alias("total_legacy"), F.count(F.lit(1)).alias("pages"))
    )


def count_check(expected: DataFrame, parsed: DataFrame) -> DataFrame:
    """Expected and parsed counts per (document, section): equal, difference and direction.

    Both inputs are (doc_id, section, n); a side without a row counts as 0.
    """
    e = expected.select("doc_id", "section", F.col("n").alias("expected"))
    p = parsed.select("doc_id", "section", F.col("n").alias("parsed"))
    d = e.join(p, ["doc_id", "section"], "full").select(
        "doc_id", "section",
        F.coalesce("expected", F.lit(0)).cast("bigint").alias("expected"),
        F.coalesce("parsed", F.lit(0)).cast("bigint").alias("parsed"),
    )
    diff = F.col("parsed") - F.col("expected")
    return d.select(
        "*", (diff == 0).alias("equal"), diff.alias("diff"),
        F.when(diff > 0, F.concat(F.lit("초과 +"), diff.cast("string")))
        .when(diff < 0, F.concat(F.lit("누락 "), diff.cast("string")))
        .otherwise("일치").alias("direction"),
    )


def active_pages(metrics: DataFrame) -> DataFrame:
    """Pages that take part in the count: some block or arrow is on them."""
    return metrics.where((F.col("n_tilde") > 0) | (F.col("legacy") > 0) | (F.col("n_border") > 0) | (F.col("n_table") > 0))
