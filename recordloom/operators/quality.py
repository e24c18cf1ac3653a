"""Completeness gates, validator roll-ups and reports over parsed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.dates import MASKED_ISO, ONGOING
from recordloom.functions.text import compact, contains_any, count_char, is_blank, squeeze
from recordloom.operators.scan import Running, neighbour, running, with_page_chunks

# Fields that must not be empty, per section.
REQUIRED_FIELDS = {
    "tech": ["project_name", "start_date", "end_date", "recog_days"],
    "cm": ["project_name", "start_date", "end_date", "recog_days"],
    "education": ["current_school"],
    "license": ["name"],
    "workplace": ["start_date"],
}
REQUIRED_SECTIONS = ["personal", "tech", "cm", "award", "workplace"]
FALLBACK_NAMES = ["(사업명 미상)", ""]
SHIFTED_NAME = r"(\(\s*\d[\d,]*\s*일\s*\))|(^\d{4}\.\d{2})|(\s~\s)|(^~)|(┖→)|(\d{1,3}(?:,\d{3})+\s*$)"
TITLE_LIKE_END = r"(기본\s*및\s*실시설계|실시설계|건설공사|용역)\s*$"
SCALE_HINT = r"(?U)(\d|km|㎞|m\b|㎡|m2|ha|D\d|L=|B=|V=|Q=|H=|%|~|:|-)"


def empty_fields(df: DataFrame, required: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per blank required field; one pass, no unpivot shuffle."""
    flags = F.filter(F.array(*[F.when(is_blank(F.col(f)), F.lit(f)) for f in required]), lambda x: x.isNotNull())
    return df.select(*keys, F.explode(flags).alias("field")).withColumn("error", F.lit("empty"))


def name_errors(df: DataFrame, keys: Sequence[str], name: str = "project_name") -> DataFrame:
    """Records without a project name."""
    return df.where(is_blank(F.col(name))).select(*keys, F.lit("project_name").alias("field"), F.lit("empty").alias("kind"))


def bad_date(c: Column) -> Column:
    """Not empty, ongoing, masked or ``yyyy-MM-dd`` shaped."""
    s = F.trim(F.coalesce(c, F.lit("")))
    return ~((s == "") | (s == ONGOING) | (s == MASKED_ISO) | s.rlike(r"^\d{4}-\d{2}-\d{2}$"))


def validate_documents(
    records: DataFrame, checks: DataFrame | None, work_types: Sequence[str], doc: str = "doc_id", section: str = "section", fail_ratio: float = 0.3,
) -> DataFrame:
    """PASS / WARN / FAIL per document from conditional counts in one aggregate.

    FAIL: 30 % or more fallback names in a section, or a malformed date.  WARN:
    fewer fallback names, shift suspects, issuer / work-type boundary suspects or a
    count mismatch (``checks`` is (doc, section, equal)).
    """
    from recordloom.functions.grammar import is_work_type, split_issuer_work_type

    nm, ov = squeeze(F.col("project_name")), squeeze(F.col("overview"))
    iss, wt = squeeze(F.col("issuer")), squeeze(F.col("work_type"))
    tech = F.col(section) == "tech"
    d = records.select(
        doc, tech.alias("_t"), nm.isin(*FALLBACK_NAMES).alias("_fb"),
        (bad_date(F.col("start_date")).cast("int") + bad_date(F.col("end_date")).cast("int")).alias("_bad"),
        (tech & (nm != "") & nm.rlike(SHIFTED_NAME)).alias("_shift"),
        (tech & (ov != "") & (F.length(ov) <= 40) & ov.rlike(TITLE_LIKE_END) & ~ov.rlike(SCALE_HINT)).alias("_title"),
        (tech & (iss != "") & (wt == "") & (split_issuer_work_type(iss, work_types)["work_type"] != "")).alias("_tail"),
        (tech & (iss != "") & is_work_type(iss, work_types)).alias("_isswt"),
    )
    g = d.groupBy(doc).agg(
        F.count_if("_t").alias("tech_rows"), F.count_if(~F.col("_t")).alias("cm_rows"),
        F.count_if(F.col("_t") & F.col("_fb")).alias("tech_fallback"), F.count_if(~F.col("_t") & F.col("_fb")).alias("cm_fallback"),
        F.sum("_bad").cast("bigint").alias("bad_dates"), F.count_if("_shift").alias("name_shift"), F.count_if("_title").alias("overview_shift"),
        F.count_if("_tail").alias("boundary"), F.count_if("_isswt").alias("issuer_is_work_type"),
    )
    if checks is not None:
        g = g.join(checks.groupBy(doc).agg(F.count_if(~F.col("equal")).alias("mismatches")), doc, "left")
    g = g.withColumn("mismatches", F.coalesce("mismatches", F.lit(0)) if checks is not None else F.lit(0))
    many = lambda a, n: (F.col(a) > 0) & (F.col(a) / F.greatest(F.col(n), F.lit(1)) >= fail_ratio)
    fail = many("tech_fallback", "tech_rows") | many("cm_fallback", "cm_rows") | (F.col("bad_dates") > 0)
    warn = sum((F.col(c) for c in ("cm_fallback", "name_shift", "overview_shift", "boundary", "issuer_is_work_type", "mismatches")), F.col("tech_fallback")) > 0
    return g.withColumn("level", F.when(fail, "FAIL").when(warn, "WARN").otherwise("PASS"))


def level_totals(validated: DataFrame) -> DataFrame:
    """Documents per level and in total."""
    r = validated.rollup("level").agg(F.count(F.lit(1)).alias("documents"), F.sum("tech_rows").cast("bigint").alias("tech_rows"), F.sum("cm_rows").cast("bigint").alias("cm_rows"))
    return r.withColumn("level", F.coalesce("level", F.lit("TOTAL")))


def neighbour_checks(records: DataFrame, keys: Sequence[str] = ("doc_id",), order: str = "rec_idx", tail: int = 30) -> DataFrame:
    """Suspicious pairs of consecutive records: same period with another name; overview tail heading the next name."""
    d = neighbour(records, keys, order, {"_n": "project_name", "_s": "start_date", "_e": "end_date"})
    nm, nxt = squeeze(F.col("project_name")), squeeze(F.col("_n"))
    end = F.substr(compact(F.col("overview")), F.greatest(F.length(compact(F.col("overview"))) - (tail - 1), F.lit(1)))
    same = (F.col("start_date") == F.col("_s")) & (F.col("end_date") == F.col("_e")) & (nm != nxt)
    heads = (F.length(end) > 3) & F.startswith(compact(nxt), end)
    torn = nm.rlike(r"(?U)(^|\s)[가-힣](\s[가-힣])+($|\s)")
    d = d.select(*keys, order, F.coalesce(same, F.lit(False)).alias("same_period"), F.coalesce(heads, F.lit(False)).alias("overview_heads_name"), torn.alias("torn_name"))
    return d.where("same_period or overview_heads_name or torn_name")


def contaminated_pages(records: DataFrame, min_rows: int, top: int, keys: Sequence[str] = ("doc_id", "page_no")) -> DataFrame:
    """Report: pages with most names that hold their own job field and duty, at least ``min_rows``, top ``top``."""
    jf, dt, nm = F.trim("job_field"), F.trim("duty"), F.col("project_name")
    hit = (jf != "") & (dt != "") & F.contains(nm, jf) & F.contains(nm, dt)
    g = records.groupBy(*keys).agg(F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("n"))
    return g.where(F.col("hits") >= min_rows).orderBy(F.col("hits").desc(), *keys).limit(top)


def content_checks(df: DataFrame, keys: Sequence[str], course: str, major: str) -> DataFrame:
    """Award words inside training courses and unbalanced brackets in majors."""
    return df.select(
        *keys, contains_any(F.col(course), ["표창장", "훈장", "포장", "감사장", "[제"]).alias("award_in_course"),
        (count_char(F.col(major), "(") != count_char(F.col(major), ")")).alias("unbalanced_major"),
    ).where("award_in_course or unbalanced_major")


def schema_report(counts: DataFrame, docs: DataFrame, sections: Sequence[str] = tuple(REQUIRED_SECTIONS)) -> DataFrame:
    """Per document and required section: row count and missing flag; ``counts`` is (doc_id, section, n)."""
    want = docs.select("doc_id").distinct().select("doc_id", F.explode(F.array(*[F.lit(s) for s in sections])).alias("section"))
    return want.join(counts, ["doc_id", "section"], "left").select("doc_id", "section", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.col("n").isNull().alias("missing"))


def corpus_summary(counts: DataFrame, checks: DataFrame, sections: Sequence[str]) -> DataFrame:
    """One row per document: count per section (fixed pivot) and number of mismatching sections."""
    g = counts.groupBy("doc_id").pivot("section", list(sections)).agg(F.sum("n"))
    g = g.select("doc_id", *[F.coalesce(F.col(s), F.lit(0)).cast("bigint").alias(f"n_{s}") for s in sections])
    m = checks.groupBy("doc_id").agg(F.count_if(~F.col("equal")).alias("mismatches"))
    return g.join(m, "doc_id", "left").withColumn("mismatches", F.coalesce("mismatches", F.lit(0)).cast("bigint"))


def trusted_pages(rows: DataFrame, keys: Sequence[str] = ("doc_id", "page_no"), ratio: float = 0.7) -> DataFrame:
    """Template results to trust: 70 % complete rows and few contaminated names."""
    full = ~is_blank(F.col("project_name")) & ~is_blank(F.col("start_date")) & ~is_blank(F.col("end_date"))
    # What a name must not hold (a range mark, day counts, dates).
    dirty = F.col("project_name").rlike(r"(^|\s)~|\(\s*\d[\d,]*\s*일\s*\)|\d{4}\.\d{2}\.\d{2}")
    g = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(full).alias("complete"), F.count_if(dirty).alias("dirty"))
    return g.withColumn("trusted", (F.col("n") > 0) & (F.col("complete") / F.col("n") >= ratio) & (F.col("dirty") <= F.greatest(F.lit(1), F.floor(F.col("n") / 6))))


def source_scores(rows: DataFrame, keys: Sequence[str] = ("doc_id", "page_no"), source: str = "source") -> DataFrame:
    """2 per name, 1 per issuer, 1 per period: total per source and the better source per page (first name wins ties)."""
    s = F.when(~is_blank(F.col("project_name")), 2).otherwise(0) + F.when(~is_blank(F.col("issuer")), 1).otherwise(0) + F.when(
        ~is_blank(F.col("start_date")) & ~is_blank(F.col("end_date")), 1).otherwise(0)
    g = rows.groupBy(*keys, source).agg(F.sum(s).cast("bigint").alias("score"))
    return g.groupBy(*keys).agg(F.min_by(F.struct(source, "score"), F.struct(-F.col("score"), source)).alias("b")).select(*keys, "b.*")


def lookup(records: DataFrame, **fields: str) -> DataFrame:
    """Records whose fields hold the given values, blanks ignored."""
    cond = F.lit(True)
    for k, v in fields.items():
        cond = cond & F.contains(compact(F.col(k)), F.lit("".join(v.split())))
    return records.where(cond)


def page_list(c: Column) -> Column:
    """Distinct positive page numbers in order."""
    return F.array_sort(F.array_distinct(F.filter(c, lambda x: x > 0)))


def expected_counts(lines: DataFrame) -> DataFrame:
    """Licence rows of a document, counted in the text between their header and the next section.

    A block may go on over page borders, so its flag is carried from page to page.
    """
    line = F.col("line")
    on = F.contains(line, F.lit("종목")) & F.contains(line, F.lit("합격일"))
    off = contains_any(line, ["학력", "졸업일", "교육기간", "교육훈련"])
    d = with_page_chunks(lines.withColumn("_f", F.when(on, F.lit(True)).when(off, F.lit(False))))
    d = running(d, ["doc_id"], ["page_chunk", "page_no"], ["line_no"], [Running("_in", "last", "_f")])
    hits = F.regexp_count(line, F.lit(r"(기사|기술사|산업기사|기능사|기능장).*?\d{4}\.\d{2}\.\d{2}"))
    return d.groupBy("doc_id").agg(F.sum(F.when(F.col("_in") & F.col("_f").isNull(), hits).otherwise(0)).cast("bigint").alias("n"))


# What one row of a front-page section looks like.
EXPECTED_ROWS = {
    "training": r"\d{4}\.\d{2}\.\d{2}\s*~\s*\d{4}\.\d{2}\.\d{2}",
    "workplace": r"\d{4}\.\d{2}\.\d{2}\s*~",
    "license": r"(기사|기술사|산업기사|기능사|기능장).*?\d{4}\.\d{2}\.\d{2}",
    "award": r"^\s*\d{4}\.\d{2}\.\d{2}(?!\s*~)",
}


def expected_front_counts(lines: DataFrame, doc: str = "doc_id", section: str = "section", line: str = "line") -> DataFrame:
    """Rows that each front-page section should yield, counted by pattern on lines that know their section: one row per document.

    Every document of ``lines`` gets a row; sections without a hit count 0.  Career
    sections are counted by their ``~`` lines (``section_totals``).
    """
    hits = {s: F.sum(F.when(F.col(section) == s, F.regexp_count(F.col(line), F.lit(p))).otherwise(0)).cast("bigint") for s, p in EXPECTED_ROWS.items()}
    return lines.groupBy(doc).agg(*[c.alias(f"n_{s}") for s, c in hits.items()])
