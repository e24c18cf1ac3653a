"""Page ranges of sections, section state machines and text slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.text import contains_any
from recordloom.operators.scan import PAGES_PER_CHUNK, Running, running

# Keyword sets of the certificate's sections: the first set with a hit decides.
TECH_SETS = [["1. 기술경력"], ["기술경력"]]
CM_SETS = [["2. 건설사업관리 및 감리경력"], ["건설사업관리", "감리경력"]]
SUMMARY_SETS = [["분야별 참여기간 인정일"], ["공사종류별 인정일수"], ["직무/전문분야별 인정일수"]]


def contains_all(c: Column, words: Sequence[str]) -> Column:
    cond = F.contains(c, F.lit(words[0]))
    for w in words[1:]:
        cond = cond & F.contains(c, F.lit(w))
    return cond


def first_keyword_pages(pages: DataFrame, anchors: dict[str, list[list[str]]], text: str = "text") -> DataFrame:
    """First page per document holding all words of a set; sets are tried in order.

    One conditional minimum per set and ``total_pages``: a single partial aggregate.
    """
    t = F.col(text)
    aggs = [
        F.coalesce(*[F.min(F.when(contains_all(t, s), F.col("page_no"))) for s in sets]).alias(name)
        for name, sets in anchors.items()
    ]
    return pages.groupBy("doc_id").agg((F.max("page_no") + 1).alias("total_pages"), *aggs)


def section_ranges(anchors: DataFrame, tech_fallback: int = 3, cm_fallback: int = 7) -> DataFrame:
    """Half-open page ranges of the two career sections from the anchor pages.

    Input (doc_id, total_pages, tech, cm, summary); pages are dense from 0.
    """
    total = F.col("total_pages")
    ts = F.coalesce(F.col("tech"), F.when(total > tech_fallback, tech_fallback).otherwise(0))
    te = F.greatest(F.least(F.coalesce(F.col("cm"), F.col("summary"), total), total), ts)
    cs = F.coalesce(F.col("cm"), F.when(total > cm_fallback, cm_fallback).otherwise(te))
    ce = F.greatest(F.least(F.coalesce(F.col("summary"), total), total), cs)
    return anchors.select(
        "doc_id", "total_pages", ts.alias("tech_start"), te.alias("tech_end"), cs.alias("cm_start"), ce.alias("cm_end"),
        F.col("summary").alias("summary_start"),
    )


def pages_in_sections(pages: DataFrame, ranges: DataFrame) -> DataFrame:
    """Pages of each section: equi join on the document, range test on the page."""
    r = ranges.select("doc_id", F.explode(F.array(
        F.struct(F.lit("tech").alias("section"), F.col("tech_start").alias("lo"), F.col("tech_end").alias("hi")),
        F.struct(F.lit("cm").alias("section"), F.col("cm_start").alias("lo"), F.col("cm_end").alias("hi")),
    )).alias("r")).select("doc_id", "r.*").where("lo < hi")
    return pages.join(r, "doc_id").where("page_no >= lo and page_no < hi").drop("lo", "hi")


def front_matter(pages: DataFrame, anchor: str = "1. 기술경력", text: str = "text") -> DataFrame:
    """The pages up to and including the first page with ``anchor``; all pages without one."""
    stop = pages.groupBy("doc_id").agg(F.min(F.when(F.contains(F.col(text), F.lit(anchor)), F.col("page_no"))).alias("_stop"))
    return pages.join(stop, "doc_id").where("_stop is null or page_no <= _stop").drop("_stop")


# Transition rules of the front page, first match wins; each is a list of word groups that must all have a hit.
FRONT_SECTIONS: list[tuple[str, list[list[str]]]] = [
    ("workplace", [["근무기간"], ["상호"]]),
    ("penalty", [["벌점", "제재일"], ["제재", "제재사항", "종류"]]),
    ("award", [["상훈"], ["수여일", "종류", "근거"]]),
    ("training", [["교육기간"], ["과정명"]]),
    ("education", [["졸업일"], ["학교명"], ["학과", "전공"]]),
    ("license", [["국가기술자격"], ["종목", "합격", "등록"]]),
]


def front_transition(line: Column) -> Column:
    """Section a row opens, 'stop', or null when it opens none."""
    rule = lambda groups: [contains_any(line, g) for g in groups]

    def both(conds: list[Column]) -> Column:
        out = conds[0]
        for c in conds[1:]:
            out = out & c
        return out

    out = F.when(contains_any(line, ["1. 기술경력", "1.기술경력"]), "stop")
    for name, groups in FRONT_SECTIONS:
        out = out.when(both(rule(groups)), name)
    return (
        out.when(F.contains(line, F.lit("등급")) & (F.length(line) <= 40), "grade")
        .when(contains_any(line, ["설계·시공", "설계시공", "건설사업관리"]) & ~F.contains(line, F.lit("기술경력")), "grade")
        .when(contains_any(line, ["인적사항", "성명(한글)", "관리번호"]), "personal")
        .when(F.contains(line, F.lit("품질관리")) & contains_any(line, ["등급", "특급", "고급"]), "grade")
    )


def section_states(rows: DataFrame, line: str = "line", order: str = "row_no", page_chunk: int = PAGES_PER_CHUNK) -> DataFrame:
    """Section of every row of a document; rows before any section are personal, rows from the stop on are dropped.

    The running state crosses pages, so it is carried chunk by chunk (page, then
    runs of pages) and no task ever holds a whole document.
    """
    d = rows.withColumn("_t", front_transition(F.col(line)))
    d = d.withColumn("_sec", F.when(F.col("_t") != "stop", F.col("_t"))).withColumn("_stop", (F.coalesce(F.col("_t"), F.lit("")) == "stop").cast("int"))
    d = d.withColumn("_chunk", F.floor(F.col("page_no") / page_chunk))
    d = running(d, ["doc_id"], ["_chunk", "page_no"], [order], [Running("section", "last", "_sec"), Running("_stopped", "max", "_stop")])
    return d.where("_stopped = 0").select(*rows.columns, F.coalesce("section", F.lit("personal")).alias("section"))


def classify_unassigned(line: Column) -> Column:
    """Adjacent section of a row no rule assigned."""
    return (
        F.when(line.rlike(r"\d{4}\.\d{2}\.\d{2}\s*~\s*\d{4}\.\d{2}\.\d{2}"), "training")
        .when(F.trim(line).rlike(r"^\d{4}\.\d{2}\.\d{2}$"), "award")
        .when(contains_any(line, ["기사", "산업기사", "기능사", "기술사"]), "license")
        .otherwise("unassigned")
    )


def text_between(c: Column, starts: Sequence[str], ends: Sequence[str], keep_label: bool = False) -> Column:
    """Text from the first of ``starts`` to the next of ``ends``; empty without a start."""
    big = F.lit(2**31 - 1)
    first = F.least(*[F.coalesce(F.nullif(F.locate(w, c, 1), F.lit(0)), big) for w in starts], big)
    # The label found first decides how much to skip; the longest wins at one position.
    length = F.greatest(*[F.when(F.locate(w, c, 1) == first, F.lit(len(w))).otherwise(0) for w in starts], F.lit(0))
    body = F.substr(c, first + length)
    end = F.least(*[F.coalesce(F.nullif(F.instr(body, w), F.lit(0)), big) for w in ends], big)
    text = F.substr(body, F.lit(1), end - 1)
    out = F.concat(F.substr(c, first, length), text) if keep_label else text
    return F.when(first == big, "").otherwise(out)


def reentrant_blocks(
    lines: DataFrame, on: Column, off: Column, stop: Column | None = None, order: str = "line_no", page_chunk: int = PAGES_PER_CHUNK,
) -> DataFrame:
    """Lines inside blocks that open at ``on`` and close at ``off``, across pages; all ends at ``stop``.

    The switching lines themselves are not part of a block.
    """
    flag = F.when(on, F.lit(True)).when(off, F.lit(False))
    d = lines.withColumn("_on", flag).withColumn("_sw", F.coalesce(on | off, F.lit(False)))
    d = d.withColumn("_stop", F.coalesce(stop, F.lit(False)).cast("int") if stop is not None else F.lit(0))
    d = d.withColumn("_chunk", F.floor(F.col("page_no") / page_chunk))
    d = running(d, ["doc_id"], ["_chunk", "page_no"], [order], [Running("_in", "last", "_on"), Running("_stopped", "max", "_stop")])
    return d.where("_in and not _sw and _stopped = 0").select(*lines.columns)


def last_section_page(pages: DataFrame, ranges: DataFrame, start: str = "cm_start", end: str = "cm_end") -> DataFrame:
    """Text of the last page of a section (the CM bottom block)."""
    r = ranges.where(F.col(start) < F.col(end)).select("doc_id", (F.col(end) - 1).alias("page_no"))
    return pages.join(r, ["doc_id", "page_no"])


def stop_after_no_growth(pages: DataFrame, items: DataFrame, header_seen_from: DataFrame, streak: int = 2) -> DataFrame:
    """Pages up to where ``streak`` consecutive pages added no new item after the header was seen.

    ``items`` are (doc_id, page_no, kind, label); a label counts once, on its first
    page.  ``header_seen_from`` is (doc_id, header_page).  The place of an idle page
    in its streak is its number of pages since the last page that was not idle.
    """
    new = items.groupBy("doc_id", "kind", "label").agg(F.min("page_no").alias("page_no"))
    grow = new.groupBy("doc_id", "page_no").agg(F.count(F.lit(1)).alias("new_items"))
    d = pages.select("doc_id", "page_no").join(grow, ["doc_id", "page_no"], "left").join(header_seen_from, "doc_id", "left")
    d = d.select("doc_id", "page_no", F.coalesce("new_items", F.lit(0)).cast("bigint").alias("new_items"),
                 (F.col("new_items").isNull() & F.coalesce(F.col("page_no") >= F.col("header_page"), F.lit(False))).alias("_idle"))
    d = d.withColumn("_one", F.lit(1)).withColumn("_chunk", F.floor(F.col("page_no") / PAGES_PER_CHUNK))
    d = running(d, ["doc_id"], ["_chunk"], ["page_no"], [Running("_nth", "sum", "_one")]).withColumn("_busy", F.when(~F.col("_idle"), F.col("_nth")))
    d = running(d, ["doc_id"], ["_chunk"], ["page_no"], [Running("_last_busy", "max", "_busy")])
    long = F.col("_idle") & (F.col("_nth") - F.coalesce("_last_busy", F.lit(0)) >= streak)
    stop = d.groupBy("doc_id").agg(F.min(F.when(long, F.col("page_no"))).alias("_stop"))
    return d.join(stop, "doc_id").where("_stop is null or page_no < _stop").select("doc_id", "page_no", "new_items")
