"""Date blocks of a page whose lines have heights, and the project name above or below each of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions import grammar as G
from recordloom.functions.text import compact, let, squeeze
from recordloom.operators.lines import DATE_LINE, DAYS_LINE, MASKED_DATE, is_boilerplate
from recordloom.operators.records import PAGE, pages_with_blocks

#: Points of a name candidate: a head office, a page's own text, overview text, a bare word, Hangul, and a letter up to as many.
OFFICE, BOILERPLATE, OVERVIEW, BARE, HANGUL, LETTERS = 10_000, -9_000, -500, 1, 10, 60
# Words that are no names by themselves.
BARE_WORDS = ["용역", "공사", "사업"]
#: Lines right above a block that are not taken for names below the block before it.
GUARD = 6
#: What a row of a page's order is: a block that opens before its first line, a line, a block that closes behind its last.
OPENS, LINE, CLOSES = 0, 1, 2


def name_points(line: Column) -> Column:
    """Points of a filled line as a project name."""
    return let(squeeze(line), lambda s: let(compact(s), lambda t: _points(s, t, is_boilerplate(s))))


def _points(s: Column, t: Column, boilerplate: Column) -> Column:
    """Points of a squeezed line ``s`` that is ``t`` without blanks."""
    return (
        F.when(boilerplate, BOILERPLATE).when(t.startswith("본사"), OFFICE)
        .when(G.is_technical(s, t) | s.rlike(r"[㎥㎞㎡㎝㎜]|L=\d|\d+\s*개소|1\s*식"), OVERVIEW).when(t.isin(*BARE_WORDS), BARE)
        .otherwise(F.when(s.rlike("[가-힣]"), HANGUL).otherwise(0) + F.least(F.length(s), F.lit(LETTERS)))
    )


def block_names(lines: DataFrame, blocks: DataFrame, keys: Sequence[str] = PAGE, guard: int = GUARD) -> DataFrame:
    """``blocks`` (``block, y_start, y_end``) with ``name``, ``name_above`` and ``name_points``: the best candidate of ``lines`` (``top, line``) between the blocks around it."""
    edge = lambda y, mark: F.struct(F.col(y).alias("y"), F.lit(mark).alias("mark"), F.when(F.lit(mark) == OPENS, F.struct(*blocks.columns)).alias("b"))
    edges = blocks.select(*keys, F.explode(F.array(edge("y_start", OPENS), edge("y_end", CLOSES))).alias("e")).select(*keys, "e.y", "e.mark", F.lit(None).cast("string").alias("line"), "e.b")
    marks = edges.unionByName(lines.select(*keys, F.col("top").alias("y"), F.lit(LINE).alias("mark"), "line", F.lit(None).cast(edges.schema["b"].dataType).alias("b")))
    return _named(marks, keys, guard).select("b.*", "name", "name_above", "name_points")


def _named(marks: DataFrame, keys: Sequence[str], guard: int) -> DataFrame:
    """Blocks ``b`` with their names, out of a page's blocks and lines in one order (``y, mark``; ``line``, or ``b`` where a block opens).

    A line lies in one gap, between the block above it and the block below it, and
    is a candidate of these two alone; counts over the order tell a line's gap, so
    nothing is joined.  Of a gap's lines the one with most points counts, the first
    at a tie; the last ``guard`` lines above a block are not candidates of the block
    before.  Above or below, points times a hundred less the distance in lines
    decides, above at a tie.  A block without a candidate has an empty name.
    """
    upto = Window.partitionBy(*keys).orderBy("y", "mark", "b.block").rowsBetween(Window.unboundedPreceding, 0)
    count = lambda mark: F.count_if(F.col("mark") == mark).over(upto)
    # asked before the order is made: in one piece with the points it would be too long to be compiled
    d = marks.withColumn("s", F.when((F.col("mark") == LINE) & (F.trim("line") != ""), squeeze(F.col("line")))).withColumn("page_text", is_boilerplate(F.col("s")))
    d = d.select(*keys, "y", "mark", "line", "b", "s", "page_text", count(OPENS).alias("gap"), count(CLOSES).alias("closed"), count(LINE).alias("n"))
    d = d.select(*keys, "gap", "n", "line", "b", F.when(F.col("gap") == F.col("closed"), F.col("s")).alias("s"), "page_text", compact(F.col("s")).alias("t"))
    d = d.select(*keys, "gap", "line", "b", F.when(F.col("s").isNotNull(), _points(F.col("s"), F.col("t"), F.col("page_text"))).alias("points"), F.when(F.col("s").isNotNull(), F.col("n")).alias("n"))
    d = d.withColumn("last", F.max("n").over(Window.partitionBy(*keys, "gap")))
    best = lambda which: F.max_by(F.struct("line", "points", "n"), F.when(which, F.struct("points", -F.col("n"))))
    g = d.groupBy(*keys, "gap").agg(best(F.col("n").isNotNull()).alias("above"), best(F.col("n") <= F.col("last") - guard).alias("below"), F.max("last").alias("last"), F.min("n").alias("first"), F.first("b", ignorenulls=True).alias("b"))
    d = g.withColumn("up", F.lag(F.struct("above", "last")).over(Window.partitionBy(*keys).orderBy("gap"))).where("b is not null")
    d = d.select(*keys, "b", F.col("up.above").alias("a"), (F.col("up.above.points") * 100 - (F.col("up.last") + 1 - F.col("up.above.n"))).alias("a_points"),
                 F.col("below").alias("u"), (F.col("below.points") * 100 - (F.col("below.n") - F.col("first"))).alias("u_points"))
    above = F.col("a").isNotNull() & (F.col("u").isNull() | (F.col("a_points") >= F.col("u_points")))
    chosen = F.when(above, F.col("a")).otherwise(F.col("u"))
    return d.select(*keys, "b", F.coalesce(chosen["line"], F.lit("")).alias("name"), above.alias("name_above"), chosen["points"].alias("name_points"))


def template_blocks(lines: DataFrame, keys: Sequence[str] = PAGE, guard: int = GUARD) -> DataFrame:
    """Date blocks of a page's ``line_no, top, line`` with the heights ``y_start, y_end`` of their first and last line and with names.

    A page's lines are grouped once and its blocks come out of the same array, so
    nothing is joined, and what is dealt by page stays where it is.
    """
    line = F.col("line")
    d = lines.withColumn("free", ~(line.rlike(DATE_LINE) | line.rlike(DAYS_LINE) | line.rlike(MASKED_DATE) | line.startswith("~")))
    g = pages_with_blocks(d, keys, carry=["top", "free"])
    block = lambda b, i: F.struct(
        b["line_no"].alias("line_no"), b["last_no"].alias("last_no"), i.cast("bigint").alias("block"), b["start"].alias("start_date"), b["end"].alias("end_date"),
        b["recog"].alias("recog_days"), b["part"].alias("part_days"), b["first_top"].alias("y_start"), b["last_top"].alias("y_end"))
    g = g.select(*keys, "r", F.transform("blocks", block).alias("blocks"))
    none = F.lit(None).cast(g.schema["blocks"].dataType.elementType)
    row = lambda y, mark, line, b: F.struct(y.alias("y"), F.lit(mark).alias("mark"), line.alias("line"), b.alias("b"))
    marks = F.concat(F.transform(F.filter("r", lambda x: x["free"]), lambda x: row(x["top"], LINE, x["line"], none)),
                     F.transform("blocks", lambda b: row(b["y_start"], OPENS, F.lit(None).cast("string"), b)), F.transform("blocks", lambda b: row(b["y_end"], CLOSES, F.lit(None).cast("string"), none)))
    return _named(g.select(*keys, F.explode(marks).alias("x")).select(*keys, "x.*"), keys, guard).select(*keys, "b.*", "name", "name_above", "name_points")
