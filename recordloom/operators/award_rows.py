"""Awards out of a section's table: rows that go on, several dates in a cell, types in other cells or in the text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.dates import date_to_iso
from recordloom.functions.text import compact, count_char, let
from recordloom.operators.dedup import AWARD_KINDS, award_kind_position, normalize_award_text
from recordloom.operators.fallbacks import shift_award_cells
from recordloom.operators.tables import TABLE, joined, locate_columns

# Labels of the sections that may stand below the awards.
NEXT_SECTIONS = ["근무처", "벌점", "교육훈련", "국가기술자격", "학력"]
DATE = r"\d{4}\.\d{2}\.\d{2}"


def is_open(c: Column) -> Column:
    return count_char(c, "[") > count_char(c, "]")


def join_pieces(head: Column, tail: Column) -> Column:
    """Two pieces of an award's type as one text.

    A piece that the other one holds adds nothing; behind an open bracket all blanks
    go, otherwise a blank parts them.
    """
    def join(h: Column, t: Column, ch: Column, ct: Column) -> Column:
        holds = lambda big, small, cbig, csmall: F.contains(big, small) | F.startswith(cbig, csmall) | (F.contains(cbig, csmall) & (F.length(csmall) >= 8))
        return (
            F.when(ch == "", t).when(ct == "", h).when(ch == ct, F.when(F.length(h) >= F.length(t), h).otherwise(t))
            .when(holds(t, h, ct, ch), t).when(holds(h, t, ch, ct), h)
            .when(is_open(h), F.concat(ch, ct)).otherwise(F.concat(h, F.lit(" "), t))
        )

    pair = F.struct(F.trim(head).alias("h"), F.trim(tail).alias("t"), compact(head).alias("ch"), compact(tail).alias("ct"))
    return let(pair, lambda x: join(x["h"], x["t"], x["ch"], x["ct"]))


def split_overflow(institution: Column, kind: Column) -> Column:
    """struct(institution, kind): the type's beginning moved out of the institution cell."""
    def cut(i: Column) -> Column:
        return let(award_kind_position(i), lambda p: F.when(p > 1, F.struct(
            F.trim(F.substr(i, F.lit(1), p - 1)).alias("institution"), join_pieces(F.substr(i, p), kind).alias("kind"))).otherwise(F.struct(i.alias("institution"), kind.alias("kind"))))

    return let(F.trim(F.replace(institution, F.lit("\n"), F.lit(" "))), cut)


def _lines(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, r"[\n\r]+"), lambda x: F.trim(x)), lambda x: x != "")


def type_items(c: Column) -> Column:
    """Lines of a type cell, a line that does not look like a type's beginning glued to the one before it."""
    begins = lambda x: x.rlike("(" + "|".join(AWARD_KINDS) + r")|제\s*\d+\s*호")
    return F.aggregate(_lines(c), F.array().cast("array<string>"), lambda a, x: F.when((F.size(a) == 0) | begins(x), F.concat(a, F.array(x))).otherwise(
        F.concat(F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))), F.array(F.concat(F.try_element_at(a, F.lit(-1)), F.lit(" "), x)))))


def go_on(award: Column, rows: Column) -> Column:
    """Type of ``award`` after the undated ``rows`` below it (structs ``institution, kind``).

    While its bracket is open, what stands in the institution cell belongs to the
    type as well; a closed type takes the type cell alone, as the institution cell
    may hold a piece of another award.
    """
    def step(kind: Column, x: Column) -> Column:
        return F.when(is_open(kind), let(join_pieces(kind, x["institution"]), lambda k: join_pieces(k, x["kind"]))).when(
            F.contains(kind, x["kind"]), kind).otherwise(join_pieces(kind, x["kind"]))

    return F.aggregate(rows, award["kind"], step)


def award_table_rows(rows: DataFrame, pages: DataFrame, lines: DataFrame, stop: Sequence[str] = tuple(NEXT_SECTIONS)) -> DataFrame:
    """Rows ``row_no, item, award_date, institution, kind`` of the award section of every table.

    ``rows`` are cleaned table rows, ``pages`` the pages' texts, ``lines`` their
    lines.  A row with a date begins an award; its cells are put right where columns
    are shifted or torn.  Rows without a date go on with the last award above them.
    Several dates of one cell become awards by position, with the institution and
    type of that position or else the last one.  An award without a type takes the
    text behind its institution, or else behind its date, in the first line that
    holds both, or else the date.
    """
    d = locate_columns(rows, ["수여일"], {"date": ("수여일", 0), "inst": ("수여기관", 1), "sort": ("종류", -1), "basis": ("근거", 2)}, stop=stop, whole=True)
    at = F.when(F.col("sort_at") < 0, F.col("basis_at")).otherwise(F.col("sort_at"))
    d = d.withColumns({"type_at": at, "dated": F.col("date").rlike("^" + DATE)}).where(~F.contains(joined(F.col("cells")), F.lit("해당없음")) | F.col("dated"))
    w = Window.partitionBy(*TABLE).orderBy("row_no")
    d = d.withColumn("award", F.sum(F.col("dated").cast("int")).over(w)).where("award > 0")

    heads = d.where("dated").join(pages.select("doc_id", "page_no", F.col("text").alias("page_text")), ["doc_id", "page_no"], "left")
    heads = shift_award_cells(heads, "cells", "header", F.col("date_at"), F.col("inst_at"), F.col("type_at"), F.coalesce("page_text", F.lit("")))
    raw = F.struct(F.get("cells", F.col("inst_at")).alias("institution"), F.get("cells", F.col("type_at")).alias("kind"))
    nth = lambda xs, i: F.coalesce(F.get(xs, i), F.try_element_at(xs, F.lit(-1)), F.lit(""))

    def several(dates: Column) -> Column:
        return let(F.struct(_lines(raw["institution"]).alias("i"), type_items(raw["kind"]).alias("k")), lambda y: F.transform(
            dates, lambda v, i: F.struct(v.alias("date"), nth(y["i"], i).alias("institution"), nth(y["k"], i).alias("kind"))))

    def one(dates: Column) -> Column:
        return let(F.struct("institution", "kind"), lambda r: let(split_overflow(r["institution"], r["kind"]), lambda x: F.array(
            F.struct(F.get(dates, F.lit(0)).alias("date"), x["institution"].alias("institution"), x["kind"].alias("kind")))))

    items = let(F.regexp_extract_all("date", F.lit(f"({DATE})"), F.lit(1)), lambda dates: F.when(F.size(dates) > 1, several(dates)).otherwise(one(dates)))
    heads = heads.select(*TABLE, "award", "row_no", items.alias("items"))

    spare = F.array_join(F.filter(F.transform("cells", lambda x, i: F.when(i == F.col("date_at"), "").otherwise(F.trim(F.replace(F.coalesce(x, F.lit("")), F.lit("\n"), F.lit(" "))))), lambda x: x != ""), " ")
    typed = F.trim(F.coalesce(F.get("cells", F.col("type_at")), F.lit("")))
    more = d.where(~F.col("dated")).select(*TABLE, "award", "row_no", F.col("inst").alias("institution"), F.when(typed == "", spare).otherwise(typed).alias("kind")).where("institution <> '' or kind <> ''")
    more = more.groupBy(*TABLE, "award").agg(F.sort_array(F.collect_list(F.struct("row_no", "institution", "kind"))).alias("more"))

    # outer, so that no filter on the items is put below the join, where it would compute them again
    d = heads.join(more, [*TABLE, "award"], "left").select(*TABLE, "row_no", "more", F.posexplode_outer(F.transform("items", lambda x, i: F.struct(x.alias("x"), (i == F.size("items") - 1).alias("last")))).alias("item", "y"))
    d = d.select(*TABLE, "row_no", "item", F.col("y.x.date").alias("date"), F.trim("y.x.institution").alias("institution"),
                 F.when(F.col("y.last") & F.col("more").isNotNull(), go_on(F.col("y.x"), F.col("more"))).otherwise(F.col("y.x.kind")).alias("kind"))

    # a type from the page's lines that hold the date
    dates = lines.select("doc_id", "page_no", "line_no", "line", F.explode(F.array_distinct(F.regexp_extract_all("line", F.lit(f"({DATE})"), F.lit(1)))).alias("date"))
    dates = dates.groupBy("doc_id", "page_no", "date").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("near"))
    d = d.join(dates, ["doc_id", "page_no", "date"], "left")
    behind = lambda line, c: F.trim(F.substr(line, F.instr(line, c) + F.length(c)))

    def from_text(inst: Column, date: Column, near: Column) -> Column:
        held = F.filter(near, lambda x: (inst != "") & F.contains(compact(x["line"]), compact(inst)))
        line = F.coalesce(F.get(held, F.lit(0)), F.get(near, F.lit(0)))["line"]
        return let(line, lambda x: F.regexp_replace(F.when((inst != "") & F.contains(x, inst), behind(x, inst)).when(inst != "", F.trim(F.replace(behind(x, date), inst, F.lit(" ")))).otherwise(behind(x, date)), r"\s+", " "))

    kind = let(F.struct("institution", "date", "near", "kind"), lambda x: F.coalesce(F.nullif(x["kind"], F.lit("")), from_text(x["institution"], x["date"], x["near"]), F.lit("")))
    return d.select(*TABLE, "row_no", "item", date_to_iso(F.col("date"), "passthrough").alias("award_date"), "institution", let(kind, normalize_award_text).alias("kind"))


def strip_institution(institution: Column, kind: Column) -> Column:
    """The type without the institution at its front, as it stands, without blanks, or short of its last syllable."""
    def cut(x: Column) -> Column:
        i, k, ti, tk = x["i"], x["k"], compact(x["i"]), compact(x["k"])
        short = F.substr(i, F.lit(1), F.greatest(F.length(i) - 1, F.lit(0)))
        return F.when(i == "", k).when(F.startswith(k, i), F.trim(F.substr(k, F.length(i) + 1))).when(F.startswith(tk, ti), F.substr(tk, F.length(ti) + 1)).when(
            (F.length(i) >= 2) & F.startswith(k, short), F.trim(F.substr(k, F.length(short) + 1))).otherwise(k)

    flat = lambda c: F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" ")))
    return let(F.struct(flat(institution).alias("i"), flat(kind).alias("k")), cut)


# Pieces of a type that say nothing.
TORN = r"^(구사업|호\])$"


def same_date_awards(df: DataFrame, doc: str = "doc_id", date: str = "award_date", order: str = "seq") -> DataFrame:
    """One award per document and date: the institution with fewest line breaks and letters, the longest type and what the others add to it.

    A date in an institution's place is none.  Types that hold a date, are torn
    pieces or lie in the type so far add nothing; of equal length the earlier one
    comes first.  Only different types of a date are gathered.
    """
    inst, kind = F.trim(F.coalesce("institution", F.lit(""))), F.trim(F.coalesce("kind", F.lit("")))
    d = df.select(doc, date, order, inst.alias("i"), kind.alias("k"))
    usable = (F.col("i") != "") & ~F.col("i").rlike(rf"^{DATE}$")
    breaks = count_char(F.col("i"), "\n") + count_char(F.col("i"), "\r")
    once = d.groupBy(doc, date, "k").agg(F.min(order).alias("o"), F.min(F.when(usable, F.struct(breaks.alias("b"), F.length(compact(F.col("i"))).alias("n"), F.col(order).alias("o"), F.col("i").alias("i")))).alias("i"))
    g = once.groupBy(doc, date).agg(F.min("i").alias("i"), F.sort_array(F.collect_list(F.when(F.col("k") != "", F.struct((-F.length("k")).alias("n"), "o", "k")))).alias("ks"))
    useless = lambda x: x.rlike(rf"(?<!\d){DATE}(?!\d)") | compact(x).rlike(TORN)
    merged = F.aggregate(F.slice("ks", F.lit(2), F.greatest(F.size("ks") - 1, F.lit(0))), F.coalesce(F.get("ks", F.lit(0))["k"], F.lit("")),
                         lambda a, x: F.when(useless(x["k"]) | F.contains(a, x["k"]), a).otherwise(F.concat(a, F.lit(" "), x["k"])))
    return g.select(doc, date, F.coalesce("i.i", F.lit("")).alias("institution"), merged.alias("kind"))


def sanction_rows(rows: DataFrame) -> DataFrame:
    """Rows of the penalty section of every table: ``points`` and, where the row has a date, ``sanction_date, kind, basis, institution``.

    Rows that say 해당없음 are none; points are a number if the cell has one.
    """
    from recordloom.operators.records import penalty_points

    columns = {"points": ("벌점", 0), "date": ("제재일", 1), "kind": ("종류", 2), "basis": ("근거", 3), "institution": ("제재기관", 4)}
    stop = ["근무처", "근무기간", "교육훈련", "상훈", "수여일", "국가기술자격", "학력"]
    d = locate_columns(rows, ["벌점", "제재사항", "제재일"], columns, exclude=["교육훈련", "상훈", "근무처", "근무기간"], stop=stop, whole=True)
    d = d.where(~F.contains(joined(F.col("cells")), F.lit("해당없음")))
    dated = F.col("date").rlike("^" + DATE)
    flat = lambda c: F.when(dated, F.trim(F.replace(F.col(c), F.lit("\n"), F.lit(" ")))).alias(c)
    return d.where(dated | (F.col("points") != "")).select(
        *TABLE, "row_no", F.when(F.col("points") != "", penalty_points(F.col("points"))).alias("points"),
        F.when(dated, date_to_iso(F.regexp_extract("date", f"^({DATE})", 1), "passthrough")).alias("sanction_date"), flat("kind"), flat("basis"), flat("institution"))
