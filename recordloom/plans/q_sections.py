"""Section and page ranging."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators import sections as S
from recordloom.operators.lines import split_lines
from recordloom.operators.tables import joined
from recordloom.plans import feeds
from recordloom.plans.feeds import DUCK_FEEDS, duck
from recordloom.plans.registry import query

# The career pages carry the certificate anchors; the dialogues have dense page numbers, so ranges use words of their languages.
CAREER = {"tech": S.TECH_SETS, "cm": S.CM_SETS, "summary": S.SUMMARY_SETS}
WORDS = {"tech": [["the ", "and "], ["die "]], "cm": [["que", "de la"], ["ich "]], "summary": [["eau", "le "], [" un"]]}


def _sets(sets) -> str:
    return "coalesce(" + ", ".join(
        "min(page_no) filter (" + " and ".join(f"contains(text, '{w}')" for w in s) + ")" for s in sets) + ")"


def _anchor_sql(feed: str, anchors) -> str:
    return f"select doc_id, max(page_no) + 1 as total_pages, {', '.join(f'{_sets(s)} as {n}' for n, s in anchors.items())} from {feed} group by doc_id"


@query("first_keyword_page", duck(_anchor_sql("career_pages", CAREER), "career_pages"))
def first_keyword_page(spark, sf):
    """P1 with the certificate's keyword sets."""
    return S.first_keyword_pages(feeds.career_pages(spark, sf), CAREER)


DUCK_FEEDS["danchors"] = (_anchor_sql("dialogue", WORDS), ("dialogue",))
DUCK_FEEDS["dranges"] = (
    """select doc_id, total_pages, ts as tech_start, te as tech_end, cs as cm_start, greatest(least(coalesce(summary, total_pages), total_pages), cs) as cm_end, summary as summary_start
 from (select *, coalesce(cm, case when total_pages > 7 then 7 else te end) as cs from (select *, greatest(least(coalesce(cm, summary, total_pages), total_pages), ts) as te
  from (select *, coalesce(tech, case when total_pages > 3 then 3 else 0 end) as ts from danchors)))""", ("danchors",))


@query("section_ranges", duck("select * from dranges", "dranges"))
def section_ranges(spark, sf):
    """P2 ranges over the dialogues."""
    return S.section_ranges(S.first_keyword_pages(feeds.dialogue_pages(spark, sf), WORDS))


@query("section_pages", duck("""select d.doc_id, d.page_no, 'tech' as section from dialogue d join dranges r on d.doc_id = r.doc_id and page_no >= tech_start and page_no < tech_end
 union all select d.doc_id, d.page_no, 'cm' from dialogue d join dranges r on d.doc_id = r.doc_id and page_no >= cm_start and page_no < cm_end""", "dialogue", "dranges"))
def section_pages(spark, sf):
    """Pages of each range."""
    p = feeds.dialogue_pages(spark, sf).select("doc_id", "page_no")
    return S.pages_in_sections(p, section_ranges(spark, sf)).select("doc_id", "page_no", "section")


@query("front_matter", duck("""select d.doc_id, d.page_no from dialogue d join (select doc_id, min(page_no) filter (contains(text, 'que')) as stop from dialogue group by 1) s on d.doc_id = s.doc_id
 where stop is null or page_no <= stop""", "dialogue"))
def front_matter(spark, sf):
    """P3."""
    return S.front_matter(feeds.dialogue_pages(spark, sf), "que").select("doc_id", "page_no")


_FLINE = "array_to_string(list_filter(cells, lambda c: c <> ''), ' ')"


def _front_sql(line: str) -> str:
    a = lambda ws: "(" + " or ".join(f"contains({line}, '{w}')" for w in ws) + ")"
    rules = " ".join(f"when {' and '.join(a(g) for g in groups)} then '{n}'" for n, groups in S.FRONT_SECTIONS)
    return (f"case when {a(['1. 기술경력', '1.기술경력'])} then 'stop' {rules} when contains({line}, '등급') and length({line}) <= 40 then 'grade' "
            f"when {a(['설계·시공', '설계시공', '건설사업관리'])} then 'grade' when {a(['인적사항', '성명(한글)', '관리번호'])} then 'personal' "
            f"when contains({line}, '품질관리') and {a(['등급', '특급', '고급'])} then 'grade' end")


@query("section_state", duck(f"""select doc_id, row_no, coalesce(last_value(case when t <> 'stop' then t end ignore nulls) over w, 'personal') as section from (
 select *, coalesce(bool_or(t = 'stop') over (partition by doc_id order by page_no, row_no rows between unbounded preceding and current row), false) as stopped from (select *, {_front_sql(_FLINE)} as t from front))
 where not stopped window w as (partition by doc_id order by page_no, row_no rows between unbounded preceding and current row)""", "front"))
def section_state(spark, sf):
    """P4 over front-page rows."""
    rows = feeds.front_rows(spark, sf).select("doc_id", "page_no", "row_no", joined(F.col("cells")).alias("line"))
    return S.section_states(rows).select("doc_id", "row_no", "section")


@query("classify_rows", duck(f"""select doc_id, row_no, case when regexp_matches(line, '[0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}\\s*~\\s*[0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}') then 'training'
 when regexp_full_match(trim(line), '[0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}') then 'award' when contains(line, '기사') or contains(line, '기능사') or contains(line, '기술사') then 'license' else 'unassigned' end as section
 from (select doc_id, row_no, {_FLINE} as line from front)""", "front"))
def classify_rows(spark, sf):
    """P5."""
    rows = feeds.front_rows(spark, sf).select("doc_id", "row_no", joined(F.col("cells")).alias("line"))
    return rows.select("doc_id", "row_no", S.classify_unassigned(F.col("line")).alias("section"))


@query("text_slice", """select doc_id, case when p = 0 then '' when e > 0 then left(body, e - 1) else body end as slice from (
 select *, case when e1 > 0 and e2 > 0 then least(e1, e2) else greatest(e1, e2) end as e from (select *, strpos(body, '.') as e1, strpos(body, ',') as e2 from (
  select doc_id, p, substr(text, p + length(w)) as body from (select doc_id, text, case when a > 0 and (b = 0 or a < b) then a else b end as p, case when a > 0 and (b = 0 or a < b) then 'the' else 'die' end as w
   from (select doc_id, text, strpos(text, 'the') as a, strpos(text, 'die') as b from documents)))))""")
def text_slice(spark, sf):
    """Text between a label and the next section word, whole prose texts."""
    return feeds.text_docs(spark, sf).select("doc_id", S.text_between(F.col("text"), ["the", "die"], [".", ","]).alias("slice"))


@query("reentrant_block", duck("""select doc_id, page_no, line_no, line from (select *, last_value(f ignore nulls) over w as inside, coalesce(bool_or(stop) over w, false) as stopped from (
  select *, case when contains(line, '사업명') and contains(line, '담당업무') then true when starts_with(line, 'Page :') or starts_with(line, '┖→') then false end as f, starts_with(line, '2. 건설사업관리') as stop from lines)
 window w as (partition by doc_id order by page_no, line_no rows between unbounded preceding and current row)) where inside and f is null and not stopped""", "lines"))
def reentrant_block(spark, sf):
    """Table body lines between column header and footer, over all pages of a document."""
    line = F.col("line")
    return S.reentrant_blocks(
        split_lines(feeds.career_pages(spark, sf)), F.contains(line, F.lit("사업명")) & F.contains(line, F.lit("담당업무")),
        line.startswith("Page :") | line.startswith("┖→"), line.startswith("2. 건설사업관리"),
    ).select("doc_id", "page_no", "line_no", "line")


@query("last_section_page", duck("select d.doc_id, d.page_no, d.text from dialogue d join dranges r on d.doc_id = r.doc_id and cm_start < cm_end and d.page_no = cm_end - 1", "dialogue", "dranges"))
def last_section_page(spark, sf):
    """P8."""
    pages = feeds.dialogue_pages(spark, sf).select("doc_id", "page_no", "text")
    return S.last_section_page(pages, section_ranges(spark, sf))


@query("no_growth_stop", duck("""select doc_id, page_no, new_items from (select *, min(page_no) filter (idle and prev_idle) over (partition by doc_id) as stop from (
 select *, coalesce(lag(idle) over (partition by doc_id order by page_no), false) as prev_idle from (
  select p.doc_id, p.page_no, coalesce(n, 0) as new_items, n is null and coalesce(p.page_no >= header_page, false) as idle from career_pages p
  left join (select doc_id, page_no, count(*) as n from (select doc_id, work_type, min(page_no) as page_no from careers group by 1, 2) group by 1, 2) g on p.doc_id = g.doc_id and p.page_no = g.page_no
  left join (select doc_id, min(page_no) as header_page from career_pages where contains(text, '분야별 참여기간 인정일') group by 1) h on p.doc_id = h.doc_id)))
 where stop is null or page_no < stop""", "career_pages", "careers"))
def no_growth_stop(spark, sf):
    """Pages until two in a row add no new label after the summary header."""
    pages = feeds.career_pages(spark, sf)
    items = feeds.career_records(spark, sf).select("doc_id", "page_no", F.lit("work_type").alias("kind"), F.col("work_type").alias("label"))
    header = pages.where(F.contains("text", F.lit("분야별 참여기간 인정일"))).groupBy("doc_id").agg(F.min("page_no").alias("header_page"))
    return S.stop_after_no_growth(pages, items, header)
