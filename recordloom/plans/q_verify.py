"""Lines, page metrics and count checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators import lines as L
from recordloom.operators import verify as V
from recordloom.plans import feeds
from recordloom.plans.feeds import DUCK_FEEDS, duck, table
from recordloom.plans.registry import query

# --- SQL twins of the line classes ------------------------------------------------
_any = lambda words: " or ".join(f"contains(line, '{w}')" for w in words)
_hits = lambda words: " + ".join(f"cast(contains(line, '{w}') as int)" for w in words)
DUCK_ANNOTATION = (
    "((contains(line,'책임정도의') and contains(line,'*')) or starts_with(line,'(책임정도') "
    "or (starts_with(line,'(*') and contains(line,'는') and length(line)<=120) "
    "or (starts_with(line,'(*') and (contains(line,'별표') or contains(line,'법') or contains(line,'시행령')) and length(line)<=160) "
    "or regexp_full_match(line,'\\(?\\s*(인정일|참여일)\\s*\\)?'))"
)
DUCK_BOILER = (
    f"(line = '' or {DUCK_ANNOTATION} or starts_with(line,'Page :') or starts_with(line,'성명 :') "
    "or (contains(line,'기술경력') and (contains(line,'1.') or starts_with(line,'1'))) "
    "or (starts_with(line,'(') and contains(line,'쪽')) or contains(line,'본 증명서는 인터넷으로 발급') "
    f"or {_any(L.TECH_FOOTER_WORDS)} "
    "or (starts_with(line,'사업명') and (contains(line,'직무분야') or contains(line,'담당업무'))) "
    "or line in ('참여기간','비고') "
    f"or (({_hits(L.TECH_HEADER_WORDS)}) >= 2 and length(line) <= 80))"
)
DUCK_BOILER_CM = (
    f"(line = '' or {DUCK_ANNOTATION} or starts_with(line,'Page :') or starts_with(line,'성명 :') "
    "or (contains(line,'건설사업관리') and (contains(line,'2.') or starts_with(line,'2'))) "
    "or (starts_with(line,'(') and contains(line,'쪽')) or contains(line,'본 증명서는 인터넷으로 발급') "
    f"or {_any(L.CM_FOOTER_WORDS)} "
    f"or (({_hits(L.CM_HEADER_WORDS)}) >= 2 and length(line) <= 80))"
)
DUCK_KIND = (
    "case when starts_with(line,'┖→') then 'arrow' when starts_with(line,'~') then 'tilde' "
    "when regexp_full_match(line,'\\*{2,}\\.\\*{2,}\\.\\*{2,}') then 'mask' "
    "when regexp_full_match(line,'[0-9]{4}\\.[0-9]{2}\\.[0-9]{2}') then 'date' "
    "when regexp_replace(line,'\\s+','','g') in ('근무중','재직중') then 'ongoing' "
    "when regexp_full_match(line,'\\(?\\s*([0-9][0-9,]*)?\\s*일\\s*\\)?') then 'days' else 'text' end"
)
DUCK_FEEDS["content"] = (
    "select doc_id, page_no, cast(row_number() over (partition by doc_id, page_no order by line_no) - 1 as bigint) as line_no, line "
    f"from lines where not {DUCK_BOILER}",
    ("lines",),
)
DUCK_FEEDS["kinds"] = (f"select *, {DUCK_KIND} as kind from content", ("content",))
DUCK_FEEDS["metrics"] = (
    """select doc_id, page_no, count(*) filter (valid) as n_tilde,
  count(*) filter (kind='arrow' and not seen) as n_border, count(*) filter (kind='arrow' and seen) as n_table,
  greatest(0, count(*) filter (valid) - count(*) filter (kind='arrow' and not seen)) as legacy,
  greatest(0, 6 - count(*) filter (kind='arrow')) as capacity
from (select *, coalesce(bool_or(valid) over (partition by doc_id, page_no order by line_no rows between unbounded preceding and 1 preceding), false) as seen
 from (select *, coalesce(kind='tilde' and pk='date' and nk in ('date','ongoing'), false) as valid
  from (select *,
    last_value(case when kind in ('mask','arrow','date','tilde') then kind end ignore nulls) over (partition by doc_id, page_no order by line_no rows between 12 preceding and 1 preceding) as pk,
    first_value(case when kind in ('mask','date','ongoing','tilde') then kind end ignore nulls) over (partition by doc_id, page_no order by line_no rows between 1 following and 8 following) as nk
    from kinds)))
group by doc_id, page_no""",
    ("kinds",),
)


@query("line_split", """
select doc_id, cast(row_number() over (partition by doc_id order by pos) - 1 as bigint) as line_no, line
from (select doc_id, unnest(range(0, len(a))) as pos, trim(regexp_replace(unnest(a), '[ \\t]+', ' ', 'g')) as line
      from (select doc_id, string_split(text, chr(10)) as a from documents))
where line <> ''""")
def line_split(spark, sf):
    """L3 over the whole prose texts."""
    return L.split_lines(feeds.text_docs(spark, sf)).select("doc_id", "line_no", "line")


@query("line_filter", duck("select doc_id, page_no, line_no, line from content", "content"))
def line_filter(spark, sf):
    """L4: career page lines without headers, footers and foot notes."""
    return L.content_lines(L.split_lines(feeds.career_pages(spark, sf))).select("doc_id", "page_no", "line_no", "line")


@query("line_filter_cm", duck(f"""select doc_id, page_no,
  cast(row_number() over (partition by doc_id, page_no order by line_no) - 1 as bigint) as line_no, line
  from lines where not {DUCK_BOILER_CM}""", "lines"))
def line_filter_cm(spark, sf):
    """L4, the CM form's own word lists."""
    return L.content_lines(L.split_lines(feeds.career_pages(spark, sf)), "cm").select("doc_id", "page_no", "line_no", "line")


@query("page_metrics", duck("select * from metrics", "metrics"))
def page_metrics(spark, sf):
    """A1."""
    return V.page_metrics(L.content_lines_of_pages(feeds.career_pages(spark, sf)))


_CHECK = """select m.doc_id, m.page_no, n_tilde, coalesce(p.n, 0) as parsed, n_border, n_table, capacity,
  n_tilde = coalesce(p.n, 0) as match, n_tilde > capacity as overflow
from metrics m left join (select doc_id, page_no, count(*) as n from careers group by all) p
  on m.doc_id = p.doc_id and m.page_no = p.page_no"""


@query("page_check", duck(_CHECK, "metrics", "careers"))
def page_check(spark, sf):
    """A2: blocks counted on the page against records parsed from it."""
    m = V.page_metrics(L.content_lines_of_pages(feeds.career_pages(spark, sf)))
    return V.page_check(m, feeds.career_records(spark, sf))


@query("page_check_errors", duck("""
select doc_id, page_no, 'page_count_mismatch' as kind, 'tech' as section, n_tilde as expected, parsed as actual, parsed - n_tilde as diff from chk where not match
union all
select doc_id, page_no, 'page_over_capacity', 'tech', capacity, n_tilde, n_tilde - capacity from chk where overflow""",
    "metrics", "careers", extra={"chk": _CHECK}))
def page_check_errors(spark, sf):
    """A2: the error rows."""
    return V.page_check_errors(page_check(spark, sf))


_SECTIONS = "select o_custkey as doc_id, o_orderkey as page_no, case when o_orderstatus = 'P' then 'cm' else 'tech' end as section from orders"


def _sections(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("page_no"),
        F.when(F.col("o_orderstatus") == "P", "cm").otherwise("tech").alias("section"),
    )


@query("section_totals", duck("""select m.doc_id, section, cast(sum(n_tilde) as bigint) as total,
  cast(sum(legacy) as bigint) as total_legacy, count(*) as pages
  from metrics m join sec s on m.doc_id = s.doc_id and m.page_no = s.page_no group by 1, 2""",
    "metrics", extra={"sec": _SECTIONS}))
def section_totals(spark, sf):
    """A3."""
    m = V.page_metrics(L.content_lines_of_pages(feeds.career_pages(spark, sf)))
    return V.section_totals(m, _sections(spark, sf))


@query("count_check", duck("""select doc_id, section, coalesce(e, 0) as expected, coalesce(p, 0) as parsed,
  coalesce(e, 0) = coalesce(p, 0) as equal, coalesce(p, 0) - coalesce(e, 0) as diff,
  case when coalesce(p, 0) > coalesce(e, 0) then '초과 +' || (coalesce(p, 0) - coalesce(e, 0))
       when coalesce(p, 0) < coalesce(e, 0) then '누락 ' || (coalesce(p, 0) - coalesce(e, 0)) else '일치' end as direction
from (select m.doc_id, section, cast(sum(n_tilde) as bigint) as e from metrics m join sec s on m.doc_id = s.doc_id and m.page_no = s.page_no group by 1, 2) a
full join (select doc_id, section, count(*) as p from careers group by 1, 2) b using (doc_id, section)""",
    "metrics", "careers", extra={"sec": _SECTIONS}))
def count_check(spark, sf):
    """A5, the flagship: lines -> filter -> page metrics -> section totals -> check against parsed records."""
    expected = section_totals(spark, sf).select("doc_id", "section", F.col("total").alias("n"))
    parsed = feeds.career_records(spark, sf).groupBy("doc_id", "section").agg(F.count(F.lit(1)).alias("n"))
    return V.count_check(expected, parsed)


@query("active_pages", duck("select * from metrics where n_tilde > 0 or legacy > 0 or n_border > 0 or n_table > 0", "metrics"))
def active_pages(spark, sf):
    """A6."""
    return V.active_pages(page_metrics(spark, sf))


@query("find_text_pages", """
select doc_id, page_no, cast(strpos(text, 'the ') as bigint) as first_pos,
  cast((length(text) - length(replace(text, 'the ', ''))) / 4 as bigint) as hits
from (select doc_id, 0 as page_no, text from documents) where contains(text, 'the ')""")
def find_text_pages(spark, sf):
    """L11 over the prose texts."""
    return L.pages_containing(feeds.text_docs(spark, sf), "the ")
