"""Recognised tables: scoring, headers, column layout, record blocks.

A table is ``(doc_id, page_no, attempt, table_no)`` and a row carries its cells as
an array, so one row is one record and a table never needs a pivot.  Windows run
inside one table of one page, which is bounded by the page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.text import ARROW, SPACE, clean_blanks, compact, contains_any, count_hits, is_blank, let, quote, squeeze, strip

TABLE = ("doc_id", "page_no", "attempt", "table_no")
PAGE = ("doc_id", "page_no")

# Fixed keyword lists of the certificate tables.
TECH_TABLE_WORDS = ["사업명", "발주자", "공사(용역)개요", "참여기간", "직무분야", "전문분야", "직위", "비고"]
CM_TABLE_WORDS = ["사업명", "참여기간", "발주자", "직무분야", "전문분야", "직위", "공사(용역)개요"]
FRONT_TABLE_WORDS = [
    "인적사항", "성명", "등급", "국가기술자격", "학력", "졸업일", "교육훈련", "교육기간", "상훈", "수여일", "벌점",
    "제재", "근무처", "근무기간", "상호",
]
LABEL_WORDS = [
    "참여기간", "사업명", "발주자", "공사종류", "직무분야", "전문분야", "담당업무", "책임정도", "직위", "공사(용역)개요",
    "공사(용역)금액", "적용 공법", "적용 신기술", "적용 융", "시설물 종류", "비고",
]
CM_STOP_WORDS = ["업무수행기간", "용역완성비율", "인정일수현황"]
TECH_NOTE = r"(?U)\b1\.\s*기술경력\b"
CM_NOTE = r"(?U)\b2\.\s*건설사업관리\s*및\s*감리경력\b"


# ----------------------------------------------------------------- row helpers
def cell(cells: Column, i: int | Column) -> Column:
    """Cell ``i`` (from 0) as text; missing cells are empty."""
    return F.coalesce(F.get(cells, F.lit(i) if isinstance(i, int) else i), F.lit(""))


def clean_cells(cells: Column) -> Column:
    """DOS line ends unified, odd blanks normalised, ends trimmed, null to empty."""
    return F.transform(
        cells, lambda c: strip(F.replace(F.replace(clean_blanks(c), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")))
    )


def joined(cells: Column, sep: str = " ") -> Column:
    """Filled cells joined."""
    return F.array_join(F.array_remove(cells, ""), sep)


def filled(cells: Column) -> Column:
    """Number of non-blank cells."""
    return F.size(F.filter(cells, lambda c: ~is_blank(c)))


def row_is_blank(cells: Column) -> Column:
    """No cell is filled: nothing but blanks in all of them together."""
    return F.btrim(F.array_join(cells, ""), F.lit(BLANKS)) == ""


def only_arrow(cells: Column) -> Column:
    """An arrow in the first cell and no other cell filled."""
    return (F.trim(cell(cells, 0)) == ARROW) & (F.btrim(F.array_join(cells, ""), F.lit(BLANKS)) == ARROW)


def cells_to_rows(cells: DataFrame) -> DataFrame:
    """Cell table to row form; a row's cells are laid out by column number, gaps empty.  Of cells with one number the first by text stays."""
    key = (*TABLE, "row_no")
    d = cells.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("col_no", "text"))).alias("e"))
    n = F.size("e")
    dense = F.col("e.col_no") == F.sequence(F.lit(0), n - 1)
    first = F.filter("e", lambda x, i: (i == 0) | (x["col_no"] != F.get("e", i - 1)["col_no"]))
    last = F.try_element_at("e", F.lit(-1))["col_no"]
    # bound once: a map named inside the lambda would be built for every cell
    laid = let(F.map_from_entries(first), lambda m: F.transform(F.sequence(F.lit(0), last), lambda i: F.coalesce(F.try_element_at(m, i), F.lit(""))))
    whole = F.transform(F.col("e.text"), lambda t: F.coalesce(t, F.lit("")))
    return d.select(*key, F.when(dense, whole).otherwise(laid).alias("cells"))


def rows_to_cells(rows: DataFrame) -> DataFrame:
    """Row form to one row per filled or empty cell."""
    return rows.select(*TABLE, "row_no", F.posexplode("cells").alias("col_no", "text"))


# ------------------------------------------------------------- source attempts
def first_attempt_rows(rows: DataFrame) -> DataFrame:
    """Rows of the first attempt that found any table on the page."""
    first = rows.groupBy(*PAGE).agg(F.min("attempt").alias("attempt"))
    return rows.join(first, [*PAGE, "attempt"], "left_semi")


# --------------------------------------------------------------------- scoring
RECORD_START = r"^\s*\d{4}\.\d{2}\.\d{2}"
BLANKS = SPACE + "\u00a0\u200b\ufeff"


def _first(cond: Column) -> Column:
    """First row that meets a condition, as an aggregate."""
    return F.min(F.when(cond, F.col("row_no")))


def _head_end(cells: Column) -> Column:
    """A table's head ends with its first record row, or with the table."""
    return F.coalesce(_first(F.trim(cell(cells, 0)).rlike(RECORD_START)), F.lit(2**31 - 1))


def career_table_score(rows: DataFrame, section: str = "tech", n_rows: bool = False) -> DataFrame:
    """One row per table: score tuple (base, n_header, max_cols) for career tables.

    Keyword rows in the head, column count and filled rows add up; both outer
    columns present adds 900; a keyword-rich table of at most four columns loses
    900; a note table loses 2500; two columns or fewer disqualify.  The head is what
    stands before the first record, that row included.  ``n_rows`` adds the table's rows.
    """
    tech = section == "tech"
    words = TECH_TABLE_WORDS if tech else CM_TABLE_WORDS
    line = F.col("line")
    d = rows.select(*TABLE, "row_no", "cells", F.size("cells").alias("n_cols"), joined(F.col("cells")).alias("line"), (~row_is_blank(F.col("cells"))).alias("full"))
    has = lambda w: F.contains(line, F.lit(w))
    notes = ["책임정도의", "보정계수"] if tech else ["건설기술", "시행령", "제45조"]
    a = d.groupBy(*TABLE).agg(
        F.max("n_cols").cast("bigint").alias("max_cols"), F.count(F.lit(1)).alias("n_rows"), F.count_if("full").alias("n_filled_rows"),
        _head_end(F.col("cells")).alias("end"), F.collect_list(F.when(contains_any(line, words), F.col("row_no"))).alias("word_rows"),
        F.array(_first(has("※") | line.rlike(TECH_NOTE if tech else CM_NOTE))).alias("note"), F.array(*[_first(has(w)) for w in notes]).alias("pair"),
        F.array(_first(has("참여기간")), _first(has("비고"))).alias("sides"))
    in_head = lambda c: F.coalesce(F.forall(c, lambda x: x <= F.col("end")), F.lit(False))
    a = a.select("*", F.size(F.filter("word_rows", lambda x: x <= F.col("end"))).alias("n_header"), (in_head("note") | in_head("pair")).alias("is_note"), in_head("sides").alias("both_sides"))
    base = (
        F.when(F.col("n_header") >= 1, 1200).otherwise(0) + F.col("max_cols") * 20 + F.col("n_filled_rows")
        + F.when(F.col("both_sides"), 900).otherwise(0)
        - F.when((F.col("n_header") >= 2) & (F.col("max_cols") <= 4), 900).otherwise(0)
        - F.when(F.col("is_note"), 2500).otherwise(0)
    )
    small = F.col("max_cols") <= 2
    return a.select(
        *TABLE,
        F.when(small, F.lit(-10000)).otherwise(base).cast("bigint").alias("s1"),
        F.when(small, F.col("max_cols")).otherwise(F.col("n_header")).cast("bigint").alias("s2"),
        F.when(small, F.col("n_rows")).otherwise(F.col("max_cols")).alias("s3"),
        *(["n_rows"] if n_rows else []),
    )


def front_table_score(rows: DataFrame) -> DataFrame:
    """(keyword hits, rows) for front pages."""
    line = F.col("_line")
    d = rows.select(*TABLE, "row_no", F.replace(joined(F.col("cells")), F.lit("\n"), F.lit(" ")).alias("_line"))
    return d.groupBy(*TABLE).agg(
        F.sum(count_hits(line, FRONT_TABLE_WORDS)).cast("bigint").alias("s1"),
        F.count(F.lit(1)).alias("s2"), F.lit(0).cast("bigint").alias("s3"),
    )


def export_table_score(rows: DataFrame) -> DataFrame:
    """(base, label hits, columns) used when dumping one best table per page; labels and notes count in the head, up to the first record."""
    line = F.col("_line")
    rows = rows.withColumn("_line", joined(F.col("cells")))
    has = lambda w: F.contains(line, F.lit(w))
    a = rows.groupBy(*TABLE).agg(
        F.max(F.size("cells")).cast("bigint").alias("cols"), F.count(F.lit(1)).alias("n_rows"), F.count_if(~row_is_blank(F.col("cells"))).alias("n_filled"),
        _head_end(F.col("cells")).alias("end"), F.array(*[_first(has(w)) for w in LABEL_WORDS]).alias("labels"), F.array(_first(has("참여기간")), _first(has("비고"))).alias("sides"),
        F.array(_first(has("※") | line.rlike(r"(?U)\b[12]\.\s*(기술경력|건설사업관리|감리경력)\b"))).alias("note"), F.array(_first(has("책임정도의")), _first(has("보정계수"))).alias("pair"),
        F.collect_list(F.struct("row_no", F.length(squeeze(line)).alias("n"))).alias("sizes"))
    in_head = lambda c: F.coalesce(F.forall(c, lambda x: x <= F.col("end")), F.lit(False))
    texts = F.filter("sizes", lambda x: (x["row_no"] <= F.col("end")) & (x["n"] > 0))
    a = a.select("*", F.size(F.filter("labels", lambda x: x <= F.col("end"))).alias("hits"), in_head("sides").alias("both_sides"), F.size(texts).alias("n_texts"),
                 F.aggregate(texts, F.lit(0), lambda n, x: n + x["n"] + 1).alias("head_len"))
    wordy = (F.col("hits") <= 1) & (F.col("head_len") - 1 >= 80)
    base = (
        F.col("hits") * 220 + F.col("cols") * 25 + F.col("n_filled")
        + F.when(F.col("both_sides"), 800).otherwise(0)
        - F.when((F.col("hits") >= 3) & (F.col("cols") <= 4), 900).otherwise(0)
        - F.when(in_head("note") | in_head("pair") | (F.col("n_texts") == 0) | wordy, 2000).otherwise(0)
    )
    small = F.col("cols") < 3
    return a.select(
        *TABLE, F.when(small, F.lit(-10000)).otherwise(base).cast("bigint").alias("s1"),
        F.when(small, F.col("cols")).otherwise(F.col("hits")).cast("bigint").alias("s2"),
        F.when(small, F.lit(0)).otherwise(F.col("cols")).cast("bigint").alias("s3"),
    )


def best_table(scores: DataFrame, score: Sequence[str] = ("s1", "s2", "s3")) -> DataFrame:
    """The table with the greatest score tuple per page; the first wins ties.

    ``max_by`` combines map-side, so no window over all tables is needed.
    """
    key = F.struct(*score, -F.col("attempt"), -F.col("table_no"))
    return scores.groupBy(*PAGE).agg(F.max_by(F.struct("attempt", "table_no", *score), key).alias("b")).select(*PAGE, "b.*")


def best_setting(rows: DataFrame, sections: DataFrame) -> DataFrame:
    """Compare table-boundary settings (in ``attempt``) and keep the best per document.

    A table scores 10*columns + filled rows, +400 with both outer columns; the
    setting's score is the sum over the two sections, +10000 when both reach 400.
    """
    line = joined(F.col("cells"))
    t = rows.groupBy(*TABLE).agg(
        (F.max(F.size("cells")) * 10 + F.count_if(~row_is_blank(F.col("cells")))
         + F.when((F.max(F.contains(line, F.lit("참여기간")).cast("int")) == 1)
                  & (F.max(F.contains(line, F.lit("비고")).cast("int")) == 1), 400).otherwise(0)).alias("base")
    )
    per = t.join(sections, list(PAGE)).groupBy("doc_id", "attempt", "section").agg(F.max("base").alias("base"))
    tot = per.groupBy("doc_id", "attempt").agg(
        (F.sum("base") + F.when((F.count_if(F.col("base") >= 400) == 2), 10000).otherwise(0)).cast("bigint").alias("score")
    )
    return tot.groupBy("doc_id").agg(
        F.max_by(F.struct("attempt", "score"), F.struct("score", -F.col("attempt"))).alias("b")
    ).select("doc_id", "b.attempt", "b.score")


def keep_best(rows: DataFrame, best: DataFrame) -> DataFrame:
    return rows.join(best.select(*TABLE), list(TABLE), "left_semi")


def has_header_signal(rows: DataFrame, words: Sequence[str]) -> DataFrame:
    """Does any table of the page show one of ``words``?"""
    line = F.col("_line")
    return rows.withColumn("_line", joined(F.col("cells"))).groupBy(*PAGE).agg(
        F.max(contains_any(line, list(words))).alias("has_signal")
    )


# ------------------------------------------------------------ header and layout
def header_start_row(rows: DataFrame) -> DataFrame:
    """Header start per table: keyword row, else the first later row with 3+ cells that starts no date."""
    rows = rows.withColumn("_t", F.replace(joined(F.col("cells")), F.lit(" "), F.lit("")))
    t = F.col("_t")
    strict = F.contains(t, F.lit("사업명")) & contains_any(t, ["비고", "참여기간"])
    c0 = F.trim(cell(F.col("cells"), 0))
    loose = (F.col("row_no") >= 1) & (filled(F.col("cells")) >= 3) & ~c0.rlike(r"^\s*\d{4}\.\d{2}\.\d{2}\s*$")
    return rows.groupBy(*TABLE).agg(
        F.coalesce(F.min(F.when(strict, F.col("row_no"))), F.min(F.when(loose, F.col("row_no")))).alias("header_row")
    )


def _clean_where_odd(c: Column) -> Column:
    """``clean_cells``, computed only for rows with a null cell, an odd blank or a blank at a cell's end; other rows are clean as they are."""
    edges = F.concat(F.lit("\x01"), F.array_join(c, "\x01", "\u00a0"), F.lit("\x01"))
    odd = contains_any(edges, ["\u00a0", "\u200b", "\ufeff", "\r", *[x for s in SPACE for x in ("\x01" + s, s + "\x01")]])
    return F.when(odd, clean_cells(c)).otherwise(c)


def _kept_columns(r: Column, labelled: Column, n_cols: Column, width: int) -> Column:
    """Numbers of a table's columns that stay, from its rows ``r`` and those of them with a label word (structs with clean ``cells``)."""
    at = lambda x, i: F.coalesce(F.get(x["cells"], i), F.lit(""))
    labels = "|".join(quote(w.replace(" ", "")) for w in LABEL_WORDS)
    # a cleaned cell is blank if it is empty
    stats = F.transform(
        F.sequence(F.lit(0), (F.greatest(n_cols, F.lit(1)) - 1).cast("int")),
        lambda i: F.struct(
            F.exists(labelled, lambda x: F.replace(at(x, i), F.lit(" "), F.lit("")).rlike(labels)).cast("int").alias("label"),
            F.size(F.filter(r, lambda x: at(x, i) != "")).alias("fill"), i.alias("col_no")))

    def keep(s: Column) -> Column:
        inner = F.filter(s, lambda x, i: (i > 0) & (i < F.size(s) - 1))
        drop = F.transform(F.slice(F.array_sort(inner), F.lit(1), F.greatest(F.size(s) - F.lit(width), F.lit(0))), lambda x: x["col_no"])
        return F.array_except(F.transform(s, lambda x: x["col_no"]), drop)

    return let(F.filter(stats, lambda x: x["fill"] > 0), keep)


def six_columns(rows: DataFrame, width: int = 6) -> DataFrame:
    """Drop columns that are empty, then the least filled, until ``width`` remain.

    The outer two columns always stay; columns with a label word go last.  A table
    lies on one page, so it is one array: its rows are grouped once and never joined
    to themselves.  A table without a filled cell has no rows.
    """
    others = [x for x in rows.columns if x not in (*TABLE, "cells")]
    d = rows.select(*TABLE, *others, _clean_where_odd(F.col("cells")).alias("cells"))
    tight = F.replace(F.array_join("cells", ""), F.lit(" "), F.lit(""))
    d = d.withColumn("_label", contains_any(tight, [w.replace(" ", "") for w in LABEL_WORDS]))
    g = d.groupBy(*TABLE).agg(F.collect_list(F.struct(*others, "cells", "_label")).alias("r"), F.max(F.size("cells")).alias("_c"))
    g = g.withColumn("_keep", _kept_columns(F.col("r"), F.filter("r", lambda x: x["_label"]), F.col("_c"), width)).where(F.size("_keep") > 0)
    d = g.select(*TABLE, "_keep", F.explode("r").alias("x")).select(*TABLE, *[F.col(f"x.{c}").alias(c) for c in others], "_keep", F.col("x.cells").alias("cells"))
    return d.select(*TABLE, *others, F.transform("_keep", lambda i: F.coalesce(F.get("cells", i), F.lit(""))).alias("cells"))


def drop_title_rows(rows: DataFrame) -> DataFrame:
    """Rows repeating the section title with its note, and rows holding only an arrow."""
    key = compact(joined(F.col("cells")))
    title = F.contains(key, F.lit("1.기술경력")) & F.contains(key, F.lit("책임정도의")) & F.contains(key, F.lit("*"))
    arrow_only = only_arrow(F.col("cells"))
    return rows.where(~title & ~arrow_only)


def best_six_columns(rows: DataFrame, width: int = 6) -> DataFrame:
    """Rows of the best career table of each page in ``width`` columns, with the table's ``header_row``.

    The same as ``career_table_score``, ``best_table``, ``header_start_row`` and
    ``six_columns`` one after the other, but a table is one array (a table lies on one
    page), so rows are never joined to themselves; where they are dealt by page before,
    nothing is shuffled here.
    """
    # what a row says is computed before its table is put together: there it is compiled, inside arrays and collected lists it is interpreted
    c = F.col("cells")
    d = rows.select(*TABLE, "row_no", "cells", F.array_join(F.array_remove(c, ""), " ").alias("_line"), F.array_join(c, "").alias("_all"), F.trim(cell(c, 0)).alias("_c0"), _clean_where_odd(c).alias("_clean"))
    d = d.withColumn("_tight", F.replace("_line", F.lit(" "), F.lit("")))
    line, c0 = F.col("_line"), F.col("_c0")
    has = lambda w: F.contains(line, F.lit(w))
    d = d.select(
        *TABLE, "row_no", F.col("_clean").alias("cells"), F.size("cells").alias("_w"), (F.btrim("_all", F.lit(BLANKS)) != "").alias("_full"), c0.rlike(RECORD_START).alias("_date"),
        F.when(contains_any(line, TECH_TABLE_WORDS), F.col("row_no")).alias("_word"), (has("※") | (has("기술경력") & line.rlike(TECH_NOTE))).alias("_note"),
        *[has(w).alias(f"_has{i}") for i, w in enumerate(("책임정도의", "보정계수", "참여기간", "비고"))],
        (F.contains("_tight", F.lit("사업명")) & contains_any(F.col("_tight"), ["비고", "참여기간"])).alias("_strict"),
        ((F.col("row_no") >= 1) & (F.size(F.array_remove("_clean", "")) >= 3) & ~c0.rlike(r"^\s*\d{4}\.\d{2}\.\d{2}\s*$")).alias("loose"),
        contains_any(F.replace("_all", F.lit(" "), F.lit("")), [w.replace(" ", "") for w in LABEL_WORDS]).alias("label"))
    t = d.groupBy(*TABLE).agg(
        F.sort_array(F.collect_list(F.struct("row_no", "cells", "label", "loose"))).alias("r"), F.max("_w").cast("bigint").alias("_c"), F.count(F.lit(1)).alias("_n"), F.count_if("_full").alias("_f"), _first(F.col("_strict")).alias("_strict"),
        F.coalesce(_first(F.col("_date")), F.lit(2**31 - 1)).alias("_end"), F.collect_list("_word").alias("_words"), F.array(_first(F.col("_note"))).alias("_note"),
        F.array(_first(F.col("_has0")), _first(F.col("_has1"))).alias("_pair"), F.array(_first(F.col("_has2")), _first(F.col("_has3"))).alias("_sides"))
    in_head = lambda c: F.coalesce(F.forall(c, lambda x: x <= F.col("_end")), F.lit(False))
    t = t.select(*TABLE, "r", "_c", "_n", "_f", "_strict", F.size(F.filter("_words", lambda x: x <= F.col("_end"))).alias("_h"), (in_head("_note") | in_head("_pair")).alias("_note"), in_head("_sides").alias("_both"))
    base = (F.when(F.col("_h") >= 1, 1200).otherwise(0) + F.col("_c") * 20 + F.col("_f") + F.when(F.col("_both"), 900).otherwise(0)
            - F.when((F.col("_h") >= 2) & (F.col("_c") <= 4), 900).otherwise(0) - F.when(F.col("_note"), 2500).otherwise(0))
    small = F.col("_c") <= 2
    score = F.struct(F.when(small, F.lit(-10000)).otherwise(base).alias("s1"), F.when(small, F.col("_c")).otherwise(F.col("_h")).alias("s2"), F.when(small, F.col("_n")).otherwise(F.col("_c")).alias("s3"),
                     (-F.col("attempt")).alias("a"), (-F.col("table_no")).alias("t"))
    b = t.groupBy(*PAGE).agg(F.max_by(F.struct("attempt", "table_no", "r", "_strict", "_c"), score).alias("b")).select(*PAGE, "b.*")

    r = F.col("r")
    b = b.withColumn("header_row", F.coalesce("_strict", F.array_min(F.transform(F.filter(r, lambda x: x["loose"]), lambda x: x["row_no"]))))
    # only rows with a label in them are looked at for their cells' labels
    b = b.withColumn("_keep", _kept_columns(r, F.filter(r, lambda x: x["label"]), F.col("_c"), width))
    d = b.select(*TABLE, "header_row", "_keep", F.explode("r").alias("x"))
    return d.select(*TABLE, F.col("x.row_no").alias("row_no"), F.transform("_keep", lambda i: F.coalesce(F.get(F.col("x.cells"), i), F.lit(""))).alias("cells"), "header_row")


def clean_table(rows: DataFrame, boilerplate: Sequence[str], header_words: Sequence[str] = tuple(LABEL_WORDS), max_headers: int = 3) -> DataFrame:
    """Drop boilerplate rows and header repeats after ``max_headers``; runs of blank rows become one.

    Leading and trailing blank rows go as well.
    """
    w = Window.partitionBy(*TABLE).orderBy("row_no")
    line = joined(F.col("cells"))
    blank = row_is_blank(F.col("cells"))
    header = ~blank & (count_hits(line, list(header_words)) >= 2)
    d = rows.where(blank | ~contains_any(line, list(boilerplate))).withColumn("_b", blank).withColumn("_h", header)
    d = d.withColumn("_seen", F.sum(F.col("_h").cast("int")).over(w))
    d = d.where(~(F.col("_h") & (F.col("_seen") > max_headers)))
    d = d.withColumn("_prev_blank", F.coalesce(F.lag("_b").over(w), F.lit(True)))
    d = d.withColumn("_more", F.coalesce(F.max((~F.col("_b")).cast("int")).over(w.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)))
    return d.where(~(F.col("_b") & (F.col("_prev_blank") | (F.col("_more") == 0)))).select(*rows.columns)


# ------------------------------------------------------------------ record blocks
_START_DATE = r"^\s*\d{4}\.\d{2}\.\d{2}"


def is_period_start(c0: Column, allow_month: bool = False) -> Column:
    """A row opens a record when its period cell starts with a full date.

    ``allow_month`` also takes ``yyyy.MM ~ yyyy.MM`` of two different months with a
    days token; which pages need it is the caller's choice.
    """
    s = F.trim(c0)
    full = s.rlike(_START_DATE)
    if not allow_month:
        return full
    months = F.regexp_extract_all(s, F.lit(r"(?U)\b(\d{4}\.\d{2})\b"), F.lit(1))
    month = (
        s.rlike(r"(?U)^\s*\d{4}\.\d{2}\b") & F.contains(s, F.lit("~")) & (F.size(months) >= 2)
        & (F.get(months, 0) != F.get(months, 1)) & s.rlike(r"\(\s*\d[\d,]*\s*일\s*\)")
    )
    return full | F.coalesce(month, F.lit(False))


def period_blocks(rows: DataFrame, header: DataFrame | None = None, header_rows: int = 4, allow_month: bool = False) -> DataFrame:
    """Number the rows below the header into record blocks; rows before the first start are dropped.

    The header row comes with ``header`` or as a column of ``rows``.  Adds ``block`` (from 1) and ``rn`` (row in block from 1).
    """
    d = rows if header is None else rows.join(header, list(TABLE))
    if "header_row" in d.columns:
        d = d.where(F.col("row_no") >= F.col("header_row") + header_rows).drop("header_row")
    arrow_only = only_arrow(F.col("cells"))
    d = d.where(~row_is_blank(F.col("cells")) & ~arrow_only)
    w = Window.partitionBy(*TABLE).orderBy("row_no")
    d = d.withColumn("block", F.sum(is_period_start(cell(F.col("cells"), 0), allow_month).cast("int")).over(w))
    d = d.where("block > 0")
    wb = Window.partitionBy(*TABLE, "block").orderBy("row_no")
    return d.withColumn("rn", F.row_number().over(wb))


def cm_row_flags(cells: Column) -> dict[str, Column]:
    """'anchor', 'break' and 'stop' flags of a CM table row."""
    spaced = F.array_join(F.transform(cells, lambda c: F.coalesce(c, F.lit(""))), " ")
    tight = compact(spaced)
    head = F.trim(F.replace(F.array_join(cells, ""), F.lit("\n"), F.lit(" ")))
    note = head.rlike(r"^\s*[※〇○❍◦ⓞ]") | head.startswith("「건설") | head.startswith("건설사업관리 업무수행기간")
    n_full = F.regexp_count(spaced, F.lit(r"\d{4}\.\d{2}\.\d{2}"))
    rest = F.regexp_replace(spaced, r"\d{4}\.\d{2}\.\d{2}", " ")
    n_month = F.regexp_count(rest, F.lit(r"(?U)\b\d{4}\.\d{2}\b(?!\.\d)"))
    n = n_full + n_month
    ongoing = F.contains(tight, F.lit("근무중")) | (F.contains(spaced, F.lit("근무")) & F.contains(spaced, F.lit("중")))
    anchor = ~note & ((n >= 2) | ((n == 1) & (tight.rlike("[~〜～]") | ongoing)))
    bare = F.replace(head, F.lit(" "), F.lit(""))
    other = F.contains(bare, F.lit("배치금지")) | F.contains(bare, F.lit("**해당없음*")) | (
        F.contains(bare, F.lit("용역명")) & F.contains(bare, F.lit("근무형태")))
    stop = F.exists(cells, lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit(" "), F.lit("")).rlike("^(" + "|".join(CM_STOP_WORDS) + ")"))
    return {"anchor": anchor, "break": (note | other) & ~anchor, "stop": stop}


def cut_at_stop(rows: DataFrame, header: DataFrame, header_rows: int = 4) -> DataFrame:
    """Keep the rows above the first row with a cell starting with a stop word."""
    d = rows.join(header, list(TABLE), "left")
    w = Window.partitionBy(*TABLE)
    hit = cm_row_flags(F.col("cells"))["stop"] & (F.col("row_no") >= F.col("header_row") + header_rows)
    d = d.withColumn("_cut", F.min(F.when(hit, F.col("row_no"))).over(w))
    return d.where(F.col("_cut").isNull() | (F.col("row_no") < F.col("_cut"))).select(*rows.columns)


def cm_blocks(rows: DataFrame, header: DataFrame | None = None, header_rows: int = 4) -> DataFrame:
    """CM record blocks: anchors open, annotation and summary rows close, loose rows are dropped.

    The header row comes with ``header`` or as a column of ``rows``.
    """
    flags = cm_row_flags(F.col("cells"))
    w = Window.partitionBy(*TABLE)
    wo = w.orderBy("row_no")
    d = (rows if header is None else rows.join(header, list(TABLE))).withColumn("_a", flags["anchor"]).withColumn("_x", flags["break"])
    first = F.min(F.when(F.col("_a") & (F.col("row_no") >= F.col("header_row")), F.col("row_no"))).over(w)
    d = d.withColumn("_from", F.coalesce(first, F.col("header_row") + header_rows)).where(F.col("row_no") >= F.col("_from"))
    d = d.where(~row_is_blank(F.col("cells")))
    # A block lives from its anchor to the next anchor or break.
    d = d.withColumn("_open", F.last(F.when(F.col("_a"), F.lit(True)).when(F.col("_x"), F.lit(False)), ignorenulls=True).over(wo))
    d = d.withColumn("block", F.sum(F.col("_a").cast("int")).over(wo)).where(F.col("_open"))
    wb = Window.partitionBy(*TABLE, "block").orderBy("row_no")
    return d.withColumn("rn", F.row_number().over(wb)).select(*[c for c in rows.columns if c != "header_row"], "block", "rn")


def merge_fragments(acc: Column, frag: Column) -> Column:
    """Glue a continuation fragment (without its arrow) behind ``acc``."""
    p = F.trim(acc)
    f = F.trim(F.regexp_replace(F.trim(frag), r"^\s*┖→\s*", ""))
    return F.when(f == "", p).when(p == "", f).otherwise(F.concat(p, f))


def is_numeric_tail(text: Column) -> Column:
    """The last word is a cut-off number."""
    last = F.replace(F.try_element_at(F.split(squeeze(text), " "), F.lit(-1)), F.lit(","), F.lit(""))
    return F.coalesce(last.rlike(r"^(\d(\.\d{0,12})?|\.\d+)$"), F.lit(False))


def is_measure_piece(text: Column) -> Column:
    """A number with a unit, as it continues a cut-off number."""
    t = compact(text)
    u = F.replace(F.replace(t, F.lit(","), F.lit("")), F.lit("㎞"), F.lit("km"))
    return u.rlike(r"(?i)^\d+(\.\d+)?(㎥|㎡|%|개소외?|km|m|/min|[a-z]+)$")


# Points of a row for a spilled cell of column 0 to 5 (none: -1), and the rows' order at equal points.
SLOT_POINTS = [[3, 3, -1, 3, 3, 3], [-1, 3, 3, 3, 3, -1], [-1, 3, -1, 3, 3, -1], [-1, 3, 3, 3, 3, -1]]
SLOT_ORDER = [[2, 1, 3, 0], [2, 1, 0, 3], [1, 3, 2, 0], [1, 2, 3, 0], [0, 1, 2, 3], [2, 1, 3, 0]]
TAKEN, MEASURE_TAIL = 10, 55


def _put(block: Column, s: Column, j: Column, text: Column) -> Column:
    return F.transform(block, lambda row, i: F.when(i == s, F.transform(row, lambda c, k: F.when(k == j, text).otherwise(c))).otherwise(row))


def _slot(block: Column, j: Column, frag: Column) -> Column:
    """Row for a spilled cell: most points, then first in the column's order.  A taken cell and a cut-off number that the piece goes on earn more."""
    table = lambda rows: F.array(*[F.array(*[F.lit(v) for v in r]) for r in rows])
    goes_on = (j == 1) & is_numeric_tail(F.get(F.get(block, 2), F.lit(1))) & is_measure_piece(frag)

    def rated(s: Column) -> Column:
        points = F.get(F.get(table(SLOT_POINTS), s), j)
        more = F.when(F.trim(F.get(F.get(block, s), j)) != "", TAKEN).otherwise(0) + F.when((s == 2) & goes_on, MEASURE_TAIL).otherwise(0)
        return F.struct(F.when(points > 0, points + more).otherwise(points).alias("points"), (-F.array_position(F.get(table(SLOT_ORDER), j), s)).alias("place"), s.alias("s"))

    return F.array_max(F.transform(F.sequence(F.lit(0), F.lit(3)), rated))["s"]


def fold_block(rows: Column, width: int = 6) -> Column:
    """Four rows of a record; the cells of further rows are glued into the best fitting slot.

    ``rows`` is the ordered array of the block's cell arrays.  A spilled cell's slot
    depends on earlier merges, so this is an ``aggregate`` fold over the block (a
    handful of rows of one table), all inside the JVM.
    """
    blank = F.array(*[F.lit("")] * width)
    fit = lambda r: F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.trim(F.coalesce(F.get(r, i), F.lit(""))))
    base = F.array(*[fit(F.coalesce(F.get(rows, i), blank)) for i in range(4)])
    extras = F.slice(rows, F.lit(5), F.greatest(F.size(rows) - 4, F.lit(0)))

    def put_cell(block: Column, row: Column, j: Column) -> Column:
        frag = F.trim(F.get(row, j))
        tight = F.replace(F.replace(frag, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))
        arrow_text = F.contains(frag, F.lit(ARROW)) & ~frag.rlike(r"\d{4}\.\d{2}\.\d{2}")

        def place(s: Column) -> Column:
            return (
                F.when((s == 0) & (j == 0) & (tight == ARROW), block)
                .when(
                    (s == 0) & (j == 0) & arrow_text,
                    _put(block, F.lit(2), F.lit(1), merge_fragments(F.get(F.get(block, 2), F.lit(1)), frag)),
                )
                .otherwise(_put(block, s, j, merge_fragments(F.get(F.get(block, s), j), frag)))
            )

        return F.when(frag == "", block).otherwise(let(_slot(block, j, frag), place))

    def put_row(block: Column, row: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit(width - 1)), block, lambda b, j: put_cell(b, row, j))

    return F.aggregate(F.transform(extras, fit), base, put_row)


def four_row_blocks(blocks: DataFrame, width: int = 6) -> DataFrame:
    """One row per block with its folded 4 x ``width`` matrix in ``m``."""
    g = blocks.groupBy(*TABLE, "block").agg(
        F.sort_array(F.collect_list(F.struct("row_no", "cells"))).alias("r"), F.min("row_no").alias("row_no")
    )
    return g.select(*TABLE, "block", "row_no", fold_block(F.transform("r", lambda x: x["cells"]), width).alias("m"))


# (row, column) of every field in the 4 x 6 block.
FIELD_CELLS = {
    "project_name": (0, 1), "job_field": (0, 3), "duty": (0, 4), "note": (0, 5),
    "issuer": (1, 1), "work_type": (1, 2), "specialty": (1, 3), "position": (1, 4),
    "overview": (2, 1), "resp": (2, 3), "amount": (2, 4),
    "method": (3, 1), "fusion": (3, 2), "newtech": (3, 3), "facility": (3, 4),
}


def block_fields(blocks: DataFrame, date_mode: str = "first_day") -> DataFrame:
    """4 x 6 matrix to the 19 record fields."""
    from recordloom.functions.dates import period_cell

    d = blocks.withColumn("p", period_cell(cell(F.get("m", F.lit(0)), 0), date_mode))
    return d.select(
        *TABLE, "block", "row_no",
        F.col("p.start").alias("start_date"), F.col("p.end").alias("end_date"),
        F.col("p.recog").alias("recog_days"), F.col("p.part").alias("part_days"), F.col("p.is_continuation").alias("is_continuation"),
        *[cell(F.get("m", F.lit(r)), c).alias(f) for f, (r, c) in FIELD_CELLS.items()],
    )


def fixed_chunks(rows: DataFrame, size: int = 4) -> DataFrame:
    """Filled rows of a table in chunks of ``size``; an incomplete tail is dropped.  Adds ``chunk`` and ``rn``."""
    w = Window.partitionBy(*TABLE).orderBy("row_no")
    wc = Window.partitionBy(*TABLE)
    d = rows.where(~row_is_blank(F.col("cells"))).withColumn("_i", F.row_number().over(w) - 1).withColumn("_n", F.count(F.lit(1)).over(wc))
    d = d.where(F.col("_i") < F.floor(F.col("_n") / size) * size)
    return d.select(*rows.columns, F.floor(F.col("_i") / size).cast("bigint").alias("chunk"), (F.col("_i") % size + 1).cast("bigint").alias("rn"))


def merge_continuations(
    records: DataFrame, fields: Sequence[str], keys: Sequence[str] = PAGE, order: str = "rec_idx", flag: str = "is_continuation",
    page: str = "page_no",
) -> DataFrame:
    """Glue continuation records onto the record before them, field by field, and list their pages.

    ``keys`` bound the run (a page in the certificate flow).  The first record of
    a run keeps its text as it is; later texts lose their arrow.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    d = records.withColumn("_g", F.sum((~F.col(flag)).cast("int")).over(w))
    g = d.groupBy(*keys, "_g").agg(
        F.sort_array(F.collect_list(F.struct(order, *fields))).alias("r"),
        F.array_sort(F.collect_set(page)).alias("pages"),
    )

    def glue(f: str) -> Column:
        head = F.coalesce(F.get("r", F.lit(0))[f], F.lit(""))
        rest = F.transform(
            F.slice("r", F.lit(2), F.greatest(F.size("r") - 1, F.lit(0))),
            lambda x: F.trim(F.regexp_replace(F.trim(F.coalesce(x[f], F.lit(""))), r"^\s*┖→\s*", "")),
        )
        tail = F.array_join(F.filter(rest, lambda t: t != ""), "")
        return F.when(tail == "", head).when(F.trim(head) == "", tail).otherwise(F.trim(F.concat(head, tail))).alias(f)

    return g.select(*keys, F.get("r", F.lit(0))[order].alias(order), *[glue(f) for f in fields], "pages")


def keep_dated(records: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Records with a start or an end."""
    return records.where(~is_blank(F.col(start)) | ~is_blank(F.col(end)))


def smart_concat(a: Column, b: Column) -> Column:
    """Join two pieces; Hangul on both sides joins without a blank."""
    x, y = F.trim(a), F.trim(b)
    tight = x.rlike("[가-힣]$") & y.rlike("^[가-힣]")
    return F.when(x == "", y).when(y == "", x).when(tight, F.concat(x, y)).otherwise(F.concat(x, F.lit(" "), y))


def join_broken_rows(rows: DataFrame) -> DataFrame:
    """A row with only its last cell filled is glued to the last filled cell of the row before it."""
    d = rows.withColumn("cells", clean_cells(F.col("cells"))).where(~row_is_blank(F.col("cells")))
    w = Window.partitionBy(*TABLE).orderBy("row_no")
    n = F.size("cells")
    only_last = (n >= 2) & (filled(F.col("cells")) == 1) & (F.try_element_at("cells", F.lit(-1)) != "")
    first_row = F.row_number().over(w) == 1
    d = d.withColumn("_b", only_last & ~first_row).withColumn("_g", F.sum((~F.col("_b")).cast("int")).over(w))
    g = d.groupBy(*TABLE, "_g").agg(F.sort_array(F.collect_list(F.struct("row_no", "cells"))).alias("r"))
    head = F.get("r", F.lit(0))["cells"]
    tails = F.transform(F.slice("r", F.lit(2), F.greatest(F.size("r") - 1, F.lit(0))), lambda x: F.try_element_at(x["cells"], F.lit(-1)))
    last = F.array_max(F.filter(F.transform(head, lambda c, i: F.when(c != "", i)), lambda i: i.isNotNull()))
    text = F.aggregate(tails, F.get(head, last), lambda acc, t: smart_concat(acc, t))
    return g.select(
        *TABLE, F.get("r", F.lit(0))["row_no"].alias("row_no"),
        F.transform(head, lambda c, i: F.when(i == last, text).otherwise(c)).alias("cells"),
    )


def locate_columns(
    rows: DataFrame, words: Sequence[str], columns: dict[str, tuple[str, int]], exclude: Sequence[str] = (), stop: Sequence[str] = (), whole: bool = False,
) -> DataFrame:
    """Data rows of a section with the cells of its columns picked by header keyword.

    The section header is the first row holding one of ``words`` and none of
    ``exclude``; ``columns`` maps an output name to (header keyword, default
    index); rows end before the first later row holding one of ``stop``.  ``whole``
    adds all cells, the ``header`` and every column's number as ``<name>_at``.
    """
    line = joined(F.col("cells"))
    w = Window.partitionBy(*TABLE)
    is_head = contains_any(line, list(words))
    if exclude:
        is_head = is_head & ~contains_any(line, list(exclude))
    d = rows.withColumn("_h", F.min(F.when(is_head, F.col("row_no"))).over(w)).where("row_no >= _h")
    if stop:
        d = d.withColumn("_e", F.min(F.when((F.col("row_no") > F.col("_h")) & contains_any(line, list(stop)), F.col("row_no"))).over(w))
        d = d.where("_e is null or row_no < _e")
    d = d.withColumn("_head", F.max(F.when(F.col("row_no") == F.col("_h"), F.col("cells"))).over(w))
    def holds(word: str):
        return lambda c: F.contains(F.coalesce(c, F.lit("")), F.lit(word))

    pos = {
        out: F.coalesce(
            F.nullif(F.array_position(F.transform("_head", holds(key)), F.lit(True)), F.lit(0).cast("bigint")) - 1, F.lit(default)
        )
        for out, (key, default) in columns.items()
    }
    return d.where("row_no > _h").select(
        *TABLE, "row_no", *[F.trim(F.coalesce(F.get("cells", p.cast("int")), F.lit(""))).alias(o) for o, p in pos.items()],
        *(["cells", F.col("_head").alias("header"), *[p.cast("int").alias(o + "_at") for o, p in pos.items()]] if whole else []),
    )


def pair_columns(head: Column, left: str, right: str) -> Column:
    """Column pairs of a repeated header: every ``left`` label with the nearest free ``right`` label after it.

    A left label without one takes the next column when there are two or more
    left labels.  The header row is one short array, so this is a fold over it.
    """
    idx = lambda word: F.filter(
        F.transform(head, lambda c, i: F.when(F.contains(F.coalesce(c, F.lit("")), F.lit(word)), i)), lambda i: i.isNotNull()
    )
    lefts, rights = idx(left), idx(right)
    start = F.struct(F.array().cast("array<struct<l:int,r:int>>").alias("out"), F.array().cast("array<int>").alias("used"))

    def step(acc: Column, p: Column) -> Column:
        free = F.array_min(F.filter(rights, lambda r: (r > p) & ~F.array_contains(acc["used"], r)))
        return F.when(free.isNull(), acc).otherwise(
            F.struct(
                F.concat(acc["out"], F.array(F.struct(p.cast("int").alias("l"), free.cast("int").alias("r")))).alias("out"),
                F.concat(acc["used"], F.array(free.cast("int"))).alias("used"),
            )
        )

    paired = F.aggregate(lefts, start, step, lambda a: a["out"])
    lone = F.filter(lefts, lambda p: ~F.exists(paired, lambda x: x["l"] == p) & (p + 1 < F.size(head)))
    extra = F.when(F.size(lefts) >= 2, F.transform(lone, lambda p: F.struct(p.cast("int").alias("l"), (p + 1).cast("int").alias("r"))))
    return F.concat(paired, F.coalesce(extra, F.array().cast("array<struct<l:int,r:int>>")))


def paired_cells(rows: DataFrame, left: str, right: str, stop: Sequence[str] = ()) -> DataFrame:
    """Cells of all (left, right) column pairs below the header, side by side pairs as separate rows."""
    line = joined(F.col("cells"))
    w = Window.partitionBy(*TABLE)
    head = F.contains(line, F.lit(left)) & F.contains(line, F.lit(right))
    d = rows.withColumn("_h", F.min(F.when(head, F.col("row_no"))).over(w)).where("row_no >= _h")
    if stop:
        d = d.withColumn("_e", F.min(F.when((F.col("row_no") > F.col("_h")) & contains_any(line, list(stop)), F.col("row_no"))).over(w))
        d = d.where("_e is null or row_no < _e")
    d = d.withColumn("_pairs", pair_columns(F.max(F.when(F.col("row_no") == F.col("_h"), F.col("cells"))).over(w), left, right))
    d = d.where("row_no > _h").select(*TABLE, "row_no", "cells", F.posexplode("_pairs").alias("pair_no", "p"))
    return d.select(
        *TABLE, "row_no", "pair_no", cell(F.col("cells"), F.col("p.l")).alias("left_text"), cell(F.col("cells"), F.col("p.r")).alias("right_text")
    ).where("left_text <> '' or right_text <> ''")


def split_parallel_cells(df: DataFrame, names: str, dates: str, numbers: str, skip: Sequence[str] = ()) -> DataFrame:
    """Multi-line cells to one row per item: names by line, dates and numbers by position."""
    lines = lambda c: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    ds = F.regexp_extract_all(F.coalesce(F.col(dates), F.lit("")), F.lit(r"(\d{4}\.\d{2}\.\d{2})"), F.lit(1))
    kept = F.filter(lines(names), lambda x: ~x.isin(*skip)) if skip else lines(names)
    rest = [c for c in df.columns if c not in (names, dates, numbers)]
    d = df.select(*rest, F.posexplode(kept).alias("item_no", "name"), ds.alias("_d"), lines(numbers).alias("_n"),
                  F.col(names).alias("_names"), F.col(dates).alias("_dates"), F.col(numbers).alias("_numbers"))
    return d.select(
        *rest, "item_no", "name", F.coalesce(F.get("_d", F.col("item_no")), F.lit("")).alias("date"),
        F.coalesce(F.get("_n", F.col("item_no")), F.lit("")).alias("number"),
        F.concat_ws(" ", "_names", "_dates", "_numbers").alias("all_text"),
    )


def two_halves(df: DataFrame, left: Sequence[str], right: Sequence[str], out: Sequence[str]) -> DataFrame:
    """A table laid out in two column sets: one row per half, blank halves dropped, one pass over the input."""
    half = lambda n, cols: F.struct(F.lit(n).alias("half"), *[F.trim(F.coalesce(F.col(c), F.lit(""))).alias(o) for c, o in zip(cols, out)])
    keep = [c for c in df.columns if c not in (*left, *right)]
    d = df.select(*keep, F.explode(F.array(half(0, left), half(1, right))).alias("h")).select(*keep, "h.*")
    return d.where(~is_blank(F.col(out[0])))


def three_row_records(rows: DataFrame, header_words: Sequence[str]) -> DataFrame:
    """CM fallback: a project-shaped row, the issuer row, the overview row, later col-0 text spilled to the overview.

    The project row has cells 0, 2 and 3 filled and cell 1 empty.  It owns the two
    rows below whatever their shape, so accepted starts come from a cursor fold
    over the table's rows (one table of one page).  All rows up to the next project
    row spill into the overview; header repeats do not.
    """
    c = lambda i: F.trim(cell(F.col("cells"), i))
    label = contains_any(joined(F.col("cells")), list(header_words))
    shape = (c(0) != "") & (c(2) != "") & (c(3) != "") & (c(1) == "") & ~label & ~c(0).rlike(
        r"^(~|\d{4}\.\d{2}(\.\d{2})?$|\(?\s*([\d,]+)?\s*일\s*\)?$)")
    d = rows.select(*TABLE, F.struct(
        "row_no", shape.alias("start"), label.alias("label"), *[c(i).alias(f"c{i}") for i in range(4)]).alias("x"))
    g = d.groupBy(*TABLE).agg(F.sort_array(F.collect_list("x")).alias("r"))
    starts = F.aggregate(
        F.sequence(F.lit(0), F.size("r") - 1), F.array().cast("array<int>"),
        lambda acc, i: F.when(
            F.get("r", i)["start"] & ((F.size(acc) == 0) | (F.try_element_at(acc, F.lit(-1)) + 3 <= i)), F.concat(acc, F.array(i))
        ).otherwise(acc),
    )
    g = g.select(*TABLE, "r", F.posexplode(starts).alias("rec", "i"))
    at = lambda k, i: F.get("r", F.col("i") + k)[f"c{i}"]
    sub = lambda k, i: F.when(~F.get("r", F.col("i") + k)["label"], at(k, i))
    spill = F.aggregate(
        F.slice("r", F.col("i") + 4, F.size("r")),
        F.struct(F.coalesce(sub(2, 0), F.lit("")).alias("t"), F.lit(True).alias("go")),
        lambda a, x: F.struct(
            F.when(~a["go"] | x["start"] | x["label"] | (x["c0"] == ""), a["t"])
            .when(a["t"] == "", x["c0"]).when(F.contains(a["t"], x["c0"]), a["t"])
            .otherwise(F.concat(a["t"], F.lit("\n"), x["c0"])).alias("t"),
            (a["go"] & ~x["start"]).alias("go"),
        ),
        lambda a: a["t"],
    )
    text = {
        "project_name": squeeze(F.replace(at(0, 0), F.lit("\n"), F.lit(""))), "job_field": at(0, 2), "duty": at(0, 3),
        "issuer": sub(1, 0), "work_type": sub(1, 1), "specialty": sub(1, 2), "position": sub(1, 3),
        "resp": sub(2, 2), "amount": sub(2, 3),
    }
    return g.select(*TABLE, (F.col("rec") + 1).cast("bigint").alias("rec"),
                    *[F.coalesce(v, F.lit("")).alias(k) for k, v in text.items()], spill.alias("overview"))


def line_era_records(rows: DataFrame, position_words: Sequence[str], issuer_hint: str) -> DataFrame:
    """Old four-column tables: project row, name continuation rows, issuer row, then overview rows.

    A project row has cells 0 and 2 and no cell 1, and is not an issuer row (a
    position word in cell 3, or a lone director next to an institution).  Rows that
    fill only cell 0 before the issuer row are name pieces, glued without a blank
    between letters; the first issuer-shaped row of the island is folded in.
    """
    c = lambda i: squeeze(F.replace(cell(F.col("cells"), i), F.lit("\n"), F.lit("")))
    pos_like = c(3).isin(*position_words) | ((c(3) != "이사") & c(3).endswith("이사") & (F.length(c(3)) <= 8))
    issuer_row = (c(0) != "") & (c(2) != "") & (pos_like | ((c(3) == "이사") & c(0).rlike(issuer_hint)))
    dated = c(0).rlike(r"^(~|\d{4}\.\d{2}(\.\d{2})?$|\(?\s*([\d,]+)?\s*일\s*\)?$)")
    label = contains_any(joined(F.col("cells")), ["사업명", "발주자", "공사(용역)개요", "적용 공법", "책임정도", "공사(용역)금액"])
    from recordloom.operators.cleanup import JOB_FIELDS

    start = (
        (c(0) != "") & (c(2) != "") & (c(1) == "") & ~dated & ~issuer_row & ~label & ~F.contains(c(2), F.lit("참여기술인"))
        & ~c(3).rlike(r"^[\d,\s]+$") & ((c(3) != "") | c(2).isin(*JOB_FIELDS))
    )
    w = Window.partitionBy(*TABLE).orderBy("row_no")
    d = rows.where(~row_is_blank(F.col("cells"))).where(~label).select(
        *TABLE, "row_no", start.alias("_s"), issuer_row.alias("_i"), *[c(i).alias(f"c{i}") for i in range(4)])
    d = d.withColumn("rec", F.sum(F.col("_s").cast("int")).over(w)).where("rec > 0")
    wi = Window.partitionBy(*TABLE, "rec").orderBy("row_no")
    d = d.withColumn("_ni", F.sum(F.col("_i").cast("int")).over(wi))
    name_part = F.col("_s") | ((F.col("_ni") == 0) & (F.col("c1") == "") & (F.col("c2") == "") & (F.col("c3") == ""))
    first_issuer = F.col("_i") & (F.col("_ni") == 1)
    g = d.groupBy(*TABLE, "rec").agg(
        F.sort_array(F.collect_list(F.when(name_part, F.struct("row_no", "c0")))).alias("_n"),
        F.max(F.when(F.col("_s"), F.col("c2"))).alias("job_field"), F.max(F.when(F.col("_s"), F.col("c3"))).alias("duty"),
        *[F.max(F.when(first_issuer, F.col(f"c{i}"))).alias(f) for i, f in enumerate(("issuer", "work_type", "specialty", "position"))],
        F.sort_array(F.collect_list(F.when((F.col("_ni") >= 1) & ~first_issuer, F.struct("row_no", "c0")))).alias("_o"),
    )
    glue = F.aggregate(
        F.col("_n"), F.lit(""),
        lambda acc, x: F.when(acc == "", x["c0"]).when(acc.rlike("[가-힣A-Za-z0-9]$") & x["c0"].rlike("^[가-힣A-Za-z0-9]"), F.concat(acc, x["c0"]))
        .otherwise(F.concat(acc, F.lit(" "), x["c0"])),
    )
    return g.select(
        *TABLE, "rec", glue.alias("project_name"), "job_field", "duty",
        *[F.coalesce(F.col(x), F.lit("")).alias(x) for x in ("issuer", "work_type", "specialty", "position")],
        F.array_join(F.filter(F.transform("_o", lambda x: x["c0"]), lambda t: t != ""), "\n").alias("overview"),
    )


def table_dump(rows: DataFrame, header: DataFrame, template: DataFrame) -> DataFrame:
    """All cells of all tables with the canonical header cells placed over the found header rows.

    ``template`` is (n_cols, header_offset, col_no, label); tables whose width has
    no template keep their cells.
    """
    w = Window.partitionBy(*TABLE)
    d = rows.withColumn("n_cols", F.max(F.size("cells")).over(w)).join(header, list(TABLE), "left")
    d = d.select(*TABLE, "row_no", "n_cols", (F.col("row_no") - F.col("header_row")).alias("header_offset"), F.posexplode("cells").alias("col_no", "text"))
    t = template.select("n_cols", "header_offset", "col_no", "label")
    widths = template.select("n_cols", "header_offset").distinct().withColumn("_covered", F.lit(True))
    d = d.join(t, ["n_cols", "header_offset", "col_no"], "left").join(widths, ["n_cols", "header_offset"], "left")
    return d.select(*TABLE, "row_no", "col_no", F.when(F.col("_covered"), F.coalesce("label", F.lit(""))).otherwise(F.coalesce("text", F.lit(""))).alias("text"))


def attempt_preview(rows: DataFrame) -> DataFrame:
    """Tables and rows per attempt, the best score and whether the attempt is the chosen one.

    Everything comes out of one row per table, grouped and compared inside the page, so nothing is joined.
    """
    best = F.max(F.struct("s1", "s2", "s3", -F.col("attempt"), -F.col("table_no")))
    d = career_table_score(rows, n_rows=True).groupBy(*PAGE, "attempt").agg(
        F.count(F.lit(1)).alias("n_tables"), F.sum("n_rows").alias("n_rows"), F.max("s1").alias("best_score"), best.alias("_best"))
    return d.select(*PAGE, "attempt", "n_tables", "n_rows", "best_score", (F.col("_best") == F.max("_best").over(Window.partitionBy(*PAGE))).alias("chosen"))
