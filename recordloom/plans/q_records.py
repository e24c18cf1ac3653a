"""Record extraction from lines and front-page text."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from recordloom.operators import records as R
from recordloom.operators import sections as S
from recordloom.operators import tables as T
from recordloom.operators.lines import content_lines_of_pages, split_lines
from recordloom.operators.merge import attach_continuations
from recordloom.plans import feeds
from recordloom.plans.feeds import DUCK_FEEDS, duck, table
from recordloom.plans.q_lookups import _TILDE, WORDS
from recordloom.plans.registry import query
from recordloom.sources.scan import spread


def _content(spark, sf):
    return content_lines_of_pages(feeds.career_pages(spark, sf))


def _with_more_lines(d, at, after=(), before=()):
    """Lines more around those where ``at`` holds, on every third page."""
    here = at & (F.col("page_no") % 3 == 0)
    span = F.sequence(F.when(here, -len(before)).otherwise(0), F.when(here, len(after)).otherwise(0))
    d = d.select("doc_id", "page_no", "line_no", "line", F.explode(span).alias("k"))
    more = F.array(*[F.lit(x) for x in [*before, "", *after]])
    return d.select("doc_id", "page_no", (F.col("line_no") * 64 + F.col("k")).alias("line_no"), F.when(F.col("k") == 0, F.col("line")).otherwise(F.get(more, F.col("k") + len(before))).alias("line"))


@query("date_blocks", duck("select doc_id, page_no, cast(k - 1 as bigint) as block, start_iso as start_date, end_iso as end_date, recog as recog_days, part as part_days from spine", "spine"))
def date_blocks(spark, sf):
    """Cursor fold over every page; every rendered record must come back as one block, on every third page with 13 lines of text between all its dates."""
    c = _content(spark, sf).withColumn("starts", ~F.coalesce(F.lag("line").over(Window.partitionBy("doc_id", "page_no").orderBy("line_no")).startswith("~"), F.lit(False)))
    dated = F.col("line").rlike(r"^\d{4}\.\d{2}\.\d{2}$") & F.col("starts")
    return R.date_blocks(_with_more_lines(c, dated, [f"- 구간 {i}" for i in range(13)])).drop("line_no", "last_no")


_EB = """select doc_id, page_no, rec_idx * 2 + c as ord, start_date, end_date, recog_days, part_days, case when c = 1 then concat(project_name, '추가') else project_name end as name from careers {copies} where c = 0 or rec_idx % 3 = 0"""
_SAME = " and ".join(f"lag({c}) over w = {c}" for c in ("start_date", "end_date", "recog_days", "part_days"))


@query("equal_blocks", duck(f"""select doc_id, page_no, ord, start_date, end_date, recog_days, part_days, array_to_string(list_filter(l, lambda x: x <> ''), '|') as names, merged from (
 select doc_id, page_no, g, min(ord) as ord, any_value(start_date) as start_date, any_value(end_date) as end_date, any_value(recog_days) as recog_days, any_value(part_days) as part_days, list(name order by ord) as l, count(*) > 1 as merged from (
  select *, sum(nw) over (partition by doc_id, page_no order by ord) as g from (select *, case when {_SAME} then 0 else 1 end as nw from b window w as (partition by doc_id, page_no order by ord))) group by 1, 2, 3)""", "careers",
    extra={"b": _EB.format(copies=", (values (0), (1)) v(c)")}))
def equal_blocks(spark, sf):
    """Runs of equal start, end and day counts become one block with its distinct names; every third record comes twice."""
    c = spark.sql(_EB.format(copies="lateral view explode(array(0, 1)) v as c").replace("from careers", "from {careers}"), careers=feeds.career_records(spark, sf))
    d = R.merge_equal_blocks(c, ["start_date", "end_date", "recog_days", "part_days"], "name", "ord")
    return d.withColumn("names", F.array_join("names", "|"))


_MORE_NAMES = [f"{x}구간확장공사" for x in "가나다라마바사아자차카타파"]


@query("names_backward", duck("""select doc_id, page_no, case when stopped then '' when k = 1 and status = 'O' then '분야별 참여기간 인정일' when k = 1 and status = 'P' then '2. 건설사업관리 및 감리경력' else '' end
  || case when stopped then '' else name end || case when page_no % 3 = 0 then '""" + "".join(_MORE_NAMES) + """' else '' end as name, case when h % 3 <> 0 and not stopped then job end as job, case when h % 3 <> 0 and not stopped then duty end as duty
 from (select *, (k = 1 and note = '2-HIGH') or (k > 1 and (h - 13) % 5 = 0 and (h - 13) % 7 <> 0) as stopped from spine) where page_no % 3 = 0 or not stopped""", "spine"))
def names_backward(spark, sf):
    """Project name above every start date, on every third page over 14 lines."""
    return R.names_before_dates(_with_more_lines(_content(spark, sf), F.col("line").rlike("^제[0-9]+호"), _MORE_NAMES), WORDS).drop("line_no")


_HEADS, _TAILS = ["가나건설사무", "다라지방해양항만", "마바관리단", "사아조합", "자차청"], ["국", "과", "팀"]


@query("tilde_context", duck(f"""select doc_id, page_no, case when page_no % 3 = 0 and issuer <> '' then issuer || '{"".join(_TAILS)}' else issuer end as issuer, work_type, specialty, position from wide""", "content", extra={
    "ctx": f"select doc_id, page_no, line_no, case when page_no % 3 = 0 and starts_with(line, '~') then '~ {''.join(_HEADS)} ' || trim(substr(line, 2)) else line end as line from content",
    "wide": _TILDE.replace("from content", "from ctx")}))
def tilde_context(spark, sf):
    """``~`` lines, on every third page with five issuer lines above and three fragments below."""
    return R.tilde_with_context(_with_more_lines(_content(spark, sf), F.col("line").startswith("~"), _TAILS, _HEADS), WORDS).drop("line_no")


_CONT = """select doc_id, page_no, string_agg(case when arrow then trim(substr(line, 3)) else line end, chr(10) order by line_no) as cont from (
 select *, min(line_no) filter (fin) over (partition by doc_id, page_no) as stop from (
  select *, starts_with(line, '「') or boiler or dt or (line_no > frm and not arrow and length(line) > 1 and coalesce(nxt, false)) as fin from (
   select *, min(line_no) filter (arrow) over (partition by doc_id, page_no) as frm, first_value(case when d then dt end ignore nulls) over (partition by doc_id, page_no order by line_no rows between 1 following and unbounded following) as nxt from (
    select *, starts_with(line, '┖→') as arrow, regexp_full_match(line, '[0-9]{4}\\.[0-9]{2}\\.[0-9]{2}') as d, coalesce(regexp_full_match(line, '[0-9]{4}\\.[0-9]{2}\\.[0-9]{2}') and starts_with(lead(line) over (partition by doc_id, page_no order by line_no), '~'), false) as dt,
     starts_with(line, 'Page :') or starts_with(line, '문서확인번호') or starts_with(line, '성명 :') or contains(line, '사업명 직무분야') or contains(line, '1. 기술경력') or contains(line, '2. 건설사업관리') as boiler from lines))
  ) where line_no >= frm) where (stop is null or line_no < stop) and line <> '┖→' group by doc_id, page_no"""
DUCK_FEEDS["conts"] = (_CONT, ("lines",))


@query("page_continuations", duck("select * from conts", "conts"))
def page_continuations(spark, sf):
    """Text from the first arrow of a page to the next record."""
    return R.page_continuations(split_lines(feeds.career_pages(spark, sf)))


@query("attach_continuations", duck("""select c.rec_idx, case when m.cont is null then overview when overview = '' then m.cont else overview || chr(10) || m.cont end as overview, case when b.cont is not null and length(b.one) >= 8 and starts_with(project_name, b.one) then trim(substr(project_name, length(b.one) + 1)) else project_name end as project_name
 from (select *, lag(rec_idx) over (partition by doc_id order by rec_idx) as prev from careers) c
 left join att m on c.doc_id = m.doc_id and c.rec_idx = m.target left join att b on c.doc_id = b.doc_id and c.prev = b.target""", "careers", "conts",
    extra={"att": """select doc_id, target, string_agg(cont, chr(10) order by page_no) as cont, min(replace(cont, chr(10), ' ')) as one from (select k.doc_id, k.page_no, k.cont, max(p.last) as target from conts k join (select doc_id, page_no, max(rec_idx) as last from careers group by 1, 2) p on p.doc_id = k.doc_id and p.page_no < k.page_no group by 1, 2, 3) group by 1, 2"""}))
def attach_continuations_q(spark, sf):
    """Continuation text goes to the last record of an earlier page."""
    conts = R.page_continuations(split_lines(feeds.career_pages(spark, sf)))
    return attach_continuations(feeds.career_records(spark, sf), conts).select("rec_idx", "overview", "project_name")


_STITCH = """select doc_id, page_no, line from (
 select doc_id, page_no, case h % 6 when 0 then wt || ' ' || format('{:,}', cast(recog as bigint)) || ' 일 ' || job || '/' || sp || ' ' || format('{:,}', cast(part as bigint)) || ' 일' when 1 then wt || ' ' || format('{:,}', cast(recog as bigint)) || ' 일'
  when 2 then wt || ' ' || format('{:,}', cast(recog as bigint)) || ' 일' when 3 then job || '/' || sp || ' ' || format('{:,}', cast(part as bigint)) || '일' when 4 then '인정일수 합계 9,999 일' else '관광시설(공원.' || wt || '부수시설) ' || format('{:,}', cast(recog as bigint)) || ' 일' end as line from spine
 union all select o_custkey, o_orderkey, case o_orderpriority when '1-URGENT' then '공사종류별 인정일수 현황 직무/전문분야별 인정일수 현황' when '2-HIGH' then '공사종류별 인정일수 현황' else '직무/전문분야별 인정일수 현황' end from orders where o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW')
 union all select o_custkey, o_orderkey, unnest(['2. 건설기술진흥법령 외', '기타 ' || o_orderkey || ' 12 일']) from orders where o_orderstatus = 'P'
 union all select o_custkey, o_orderkey, '※ 문서하단 안내' from orders)"""


@query("summary_stitch", duck(_STITCH, "spine"))
def summary_stitch(spark, sf):
    """Torn and wrapped summary lines."""
    return R.stitch_summary_lines(split_lines(feeds.summary_pages(spark, sf))).drop("line_no")


_ITEMS = """select doc_id, side, work_type, job_field, specialty, days from (select *, row_number() over (partition by doc_id, side, work_type, job_field, specialty order by page_no, pos, i) as r from (
 select *, case when side = 'left' then label else '' end as work_type, case when side = 'left' then '' when contains(label, '/') then trim(split_part(label, '/', 1)) else label end as job_field,
  case when side = 'right' and contains(label, '/') then trim(substr(label, strpos(label, '/') + 1)) else '' end as specialty from (
 select *, case when two then case when i = 0 then 'left' else 'right' end when mode = 'right' or (mode = 'both' and contains(label, '/')) then 'right' else 'left' end as side from (
  select s.doc_id, s.page_no, k as pos, 0 as i, h % 6 = 0 as two, case h % 6 when 3 then job || '/' || sp when 4 then '인정일수 합계' when 5 then '관광시설(공원.' || wt || '부수시설)' else wt end as label, case when h % 6 = 3 then part when h % 6 = 4 then '9999' else recog end as days from spine s
  union all select doc_id, page_no, k, 1, true, job || '/' || sp, part from spine where h % 6 = 0) x
 join (select doc_id, page_no, last_value(m ignore nulls) over w as mode, coalesce(bool_or(e) over (partition by doc_id order by page_no rows between unbounded preceding and 1 preceding), false) as ended from (
   select doc_id, page_no, m, status = 'P' and last_value(m ignore nulls) over w is not null as e from (select o_custkey as doc_id, o_orderkey as page_no, o_orderstatus as status, case o_orderpriority when '1-URGENT' then 'both' when '2-HIGH' then 'left' when '5-LOW' then 'right' end as m from orders) window w as (partition by doc_id order by page_no rows between unbounded preceding and current row))
  window w as (partition by doc_id order by page_no rows between unbounded preceding and current row)) p on x.doc_id = p.doc_id and x.page_no = p.page_no
 where mode is not null and not ended and label <> '인정일수 합계')) where side = 'left' or job_field <> '' or specialty <> '') where r = 1"""


@query("summary_items", duck(_ITEMS, "spine"))
def summary_items(spark, sf):
    """Items by header mode, first label wins, over all pages of a document."""
    return R.summary_items(R.stitch_summary_lines(split_lines(feeds.summary_pages(spark, sf))))


_CM = """concat('건설사업관리 업무 수행기간 ', {n1}, ' 일 상주 : ', {n2}, '일 (감독 권한대행 등 건설사업관리 3일/ 시공 단계 건설사업관리 4 일) 기술지원 : 5일 (감독 권한대행 등 건설사업관리 6일 시공단계 건설사업관리 7일) 감리 업무 수행기간 ', {n3}, ' 일 상 주 : 9일 (공동주택 10일 다중이용시설 11일) 기술지원 12일 (공동주택 13일 다중이용시설 14일) 건설사업관리기술인으로서 안전관리 업무 수행기간 : ', {n4}, '일 용역완성비율 : ', {n5}, '.5% 참여 1건 2건 완료 ', {n6}, '건', case when c_nationkey % 2 = 0 then ' 4건' else '' end)"""
_CM_TEXT = _CM.format(n1="cast(c_custkey as string)", n2="cast(c_nationkey as string)", n3="cast(c_custkey + 8 as string)", n4="cast(c_custkey % 77 as string)", n5="cast(c_nationkey as string)", n6="cast(c_nationkey + 3 as string)")


@query("work_periods", """select c_custkey, cast(c_custkey as varchar) as cm_total, cast(c_nationkey as varchar) as cm_stay, '3' as cm_stay_proxy, '4' as cm_stay_build, '5' as cm_tech, '6' as cm_tech_proxy, '7' as cm_tech_build, cast(c_custkey + 8 as varchar) as sup_total, '9' as sup_stay, '10' as sup_stay_housing, '11' as sup_stay_public,
 '12' as sup_tech, '13' as sup_tech_housing, '14' as sup_tech_public, cast(c_custkey % 77 as varchar) as safety from customer""")
def work_periods(spark, sf):
    """R26."""
    return spread(table(spark, sf, "customer"), "c_custkey").select("c_custkey", R.work_periods(F.expr(_CM_TEXT)).alias("w")).select("c_custkey", "w.*")


@query("one_year_stats", """select c_custkey, c_nationkey || '.5' as percent, case when c_nationkey % 2 = 0 then '1' else '' end as joined_stay, case when c_nationkey % 2 = 0 then '2' else '' end as joined_tech, case when c_nationkey % 2 = 0 then cast(c_nationkey + 3 as varchar) else '' end as done_stay, case when c_nationkey % 2 = 0 then '4' else '' end as done_tech from customer""")
def one_year_stats(spark, sf):
    """R27."""
    return spread(table(spark, sf, "customer"), "c_custkey").select("c_custkey", R.one_year_stats(F.expr(_CM_TEXT)).alias("w")).select("c_custkey", "w.*")


def front_section(spark, sf, name, heading=False):
    """Front rows of one section, found by the section machine; ``heading`` keeps the row that opens it."""
    d = feeds.front_rows(spark, sf).withColumn("line", F.replace(T.joined(F.col("cells")), F.lit("\n"), F.lit(" ")))
    s = S.section_states(d, "line", "row_no").where(F.col("section") == name)
    return s if heading else s.where(S.front_transition(F.col("line")).isNull())


def _front_text(spark, sf, name):
    """A section of one document as text."""
    d = front_section(spark, sf, name, True).withColumn("t", T.joined(F.col("cells")))
    g = d.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("page_no", "row_no", "t"))).alias("r"))
    return g.select("doc_id", F.array_join(F.transform("r", lambda x: x["t"]), "\n").alias("text"))


@query("personal_info", """select c_custkey as doc_id, '홍길동' as name, coalesce(strftime(try_strptime(case when c_custkey % 100 <= 26 then '20' else '19' end || lpad(cast(c_custkey % 100 as varchar), 2, '0') || '-' || lpad(cast(1 + c_custkey % 13 as varchar), 2, '0') || '-' || lpad(cast(1 + c_nationkey as varchar), 2, '0'), '%Y-%m-%d'), '%Y-%m-%d'), '') as birth,
 '서울시 ' || c_mktsegment || '로 ' || c_nationkey as address, '#' || (c_custkey % 9) || c_nationkey || '7' as mgmt_no, '' as issue_date from customer""")
def personal_info(spark, sf):
    """R13."""
    return _front_text(spark, sf, "personal").select("doc_id", R.personal_info(F.col("text"), 26).alias("p")).select("doc_id", "p.*")


_KINDS = ("기사", "기능자격", "기능사자격", "기술사", "산업기사", "기능사")


@query("licence_rows", duck(f"""select doc_id, cast(i as int) as seq, n as name, replace(ds[i + 1], '.', '-') as pass_date from (
 select doc_id, unnest(range(0, len(names))) as i, unnest(names) as n, ds from (select doc_id, list_filter(string_split(cells[2], chr(10)), lambda x: x <> '' and x not in {_KINDS}) as names, regexp_extract_all(cells[3], '[0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}') as ds from front where row_no = 5))
 where ds[i + 1] is not null""", "front"))
def licence_rows(spark, sf):
    """Licence rows of one and of several lines."""
    d = front_section(spark, sf, "license").select(*T.TABLE, "row_no", *[T.cell(F.col("cells"), i).alias(c) for i, c in ((1, "names"), (2, "dates"), (3, "numbers"))])
    d = T.split_parallel_cells(d.where("names <> ''"), "names", "dates", "numbers", _KINDS)
    d = d.select("doc_id", "item_no", F.concat_ws(" ", "name", "date").alias("text"))
    return R.licence_rows(d, "text", ["doc_id", "item_no"]).select("doc_id", F.col("item_no").cast("int").alias("seq"), "name", "pass_date")


@query("licence_number", """select c_custkey, case when num = '' then 'AB' || lpad(cast(c_custkey as varchar), 6, '0') else num end as number from (select *, case when c_nationkey % 2 = 0 then '' else 'X1' end as num from customer)""")
def licence_number(spark, sf):
    """Number found among the other cells."""
    c = table(spark, sf, "customer").select(
        "c_custkey", F.lit("토목기사").alias("name"), F.lit("2001.02.03").alias("date"), F.when(F.col("c_nationkey") % 2 == 0, "").otherwise("X1").alias("number"),
        F.concat(F.lit("토목기사 2001.02.03 AB"), F.lpad(F.col("c_custkey").cast("string"), 6, "0"), F.lit(" Z9")).alias("all_text"))
    return R.infer_licence_number(c, "all_text", "name", "date", "number", ["c_custkey"]).select("c_custkey", "number")


@query("education_rows", duck("""select doc_id, case when prev then '한빛공과대학' else '' end as prev_school, case when not prev and major like '건축%' then '한빛대학교 건축' else '한빛대학교' end as school, replace(major, '건축 ', '') as major, '학사' as degree, '졸업' as status, replace(d, '.', '-') as date
 from (select doc_id, contains(cells[3], '現') as prev, cells[2] as d, regexp_replace(cells[4], ' 학사.*$', '') as major from front where row_no = 8)""", "front"))
def education_rows(spark, sf):
    """Date, schools, major, degree and status of one row."""
    d = front_section(spark, sf, "education").select("doc_id", R.education_row(T.joined(F.col("cells"))).alias("e"))
    return d.select("doc_id", "e.*")


@query("penalty", duck("""select doc_id, case when p = '' or p = '해당없음' then '해당없음' else replace(p, '점', '') end as points, case when s <> '' then replace(s, '.', '-') end as sanction_date from (select doc_id, cells[2] as p, cells[3] as s from front where row_no = 15)""", "front"))
def penalty(spark, sf):
    """Points, and a sanction row where a date is given."""
    from recordloom.functions.dates import date_to_iso

    d = front_section(spark, sf, "penalty").select("doc_id", T.cell(F.col("cells"), 1).alias("raw"), T.cell(F.col("cells"), 2).alias("date"))
    return d.select("doc_id", R.penalty_points(F.col("raw")).alias("points"),
                                         F.when(F.col("date").rlike(r"^\d{4}\.\d{2}\.\d{2}"), date_to_iso(F.col("date"), "unchecked")).alias("sanction_date"))


@query("company_split", duck("""select doc_id, case when m = 3 then '' else maker end as previous, case when m = 3 then maker else newer end as current
 from (select doc_id, regexp_extract(cells[2], '^(건설[0-9]+\\(주\\))', 1) as maker, regexp_extract(cells[2], '(새건설[0-9]+\\(주\\))$', 1) as newer, case when contains(cells[2], '새건설') then 0 else 3 end as m from front where row_no = 17)""", "front"))
def company_split(spark, sf):
    """Company texts split at change markers or a bare colon."""
    d = front_section(spark, sf, "workplace").select("doc_id", R.company_split(T.cell(F.col("cells"), 1)).alias("c"))
    return d.select("doc_id", "c.*")


_WP = "select c_nationkey as doc_id, c_custkey as seq, concat('2', cast(c_custkey % 3 as string)) as start_date, concat('2', cast((c_custkey + 1) % 3 as string)) as end_date, case when c_custkey % 4 = 0 then c_mktsegment else '' end as previous, c_name as current from "


@query("chain_workplaces", duck("""select seq, case when hit then current else previous end as previous, case when hit then np else current end as current from (
 select *, coalesce(end_date = ns and previous = '' and current <> '' and np <> '' and nc <> '', false) as hit from (select *, lead(start_date) over w as ns, lead(previous) over w as np, lead(current) over w as nc from wp window w as (partition by doc_id order by seq)))""", extra={"wp": _WP + "customer"}))
def chain_workplaces(spark, sf):
    """R25."""
    d = spark.sql(_WP + "{c}", c=table(spark, sf, "customer"))
    return R.chain_workplaces(d).select("seq", "previous", "current")


@query("prose_paragraphs", """select doc_id, g as island, string_agg(line, ' ' order by n) as text from (
 select doc_id, n, line, cast(sum(cast(regexp_matches(line, '^[A-ZÀ-Þ]') as int)) over (partition by doc_id order by n) as bigint) as g from (
  select doc_id, row_number() over (partition by doc_id order by pos) as n, line from (select doc_id, unnest(range(0, len(a))) as pos, trim(regexp_replace(unnest(a), '[ \\t]+', ' ', 'g')) as line from (select doc_id, string_split(text, chr(10)) as a from documents)) where line <> '')) where g > 0 group by doc_id, g""")
def prose_paragraphs(spark, sf):
    """Islands over whole prose texts: a line starting with a capital opens a paragraph."""
    lines = split_lines(feeds.text_docs(spark, sf)).select("doc_id", "line_no", "line")
    return R.line_islands(lines, F.col("line").rlike("^[A-ZÀ-Þ]"), ["doc_id"])


@query("grade_blocks", duck("""select doc_id, '토목' as design_job, case when contains(c, '특급') then '특급' when contains(c, '고급') then '고급' else '초급' end as design_job_grade, '토질·지질' as design_specialty, '중급' as design_specialty_grade,
 '' as cm_job, '' as cm_job_grade, '' as cm_specialty, '' as cm_specialty_grade, '' as quality_grade from (select doc_id, cells[1] as c from front where row_no = 3)""", "front"))
def grade_blocks(spark, sf):
    """Job and specialty with the grade behind them, per block."""
    from recordloom.functions.grammar import SPECIALTIES_BY_JOB

    specs = [x for xs in SPECIALTIES_BY_JOB.values() for x in xs]
    return _front_text(spark, sf, "grade").select("doc_id", R.grade_blocks(F.col("text"), list(SPECIALTIES_BY_JOB), specs).alias("g")).select("doc_id", "g.*")


@query("workplace_cells", duck("""select doc_id, 0 as pair_no, replace(left(p, 10), '.', '-') as start_date, replace(right(p, 10), '.', '-') as end_date, case when contains(c, '새건설') then maker else '' end as previous, case when contains(c, '새건설') then regexp_extract(c, '(새건설[0-9]+\\(주\\))$', 1) else maker end as current
 from (select doc_id, cells[1] as p, cells[2] as c, regexp_extract(cells[2], '^(건설[0-9]+\\(주\\))', 1) as maker from front where row_no = 17)
 union all select doc_id, 1, '2021-01-01', '근무중', '', cells[4] from front where row_no = 17 and cells[3] <> ''""", "front"))
def workplace_cells(spark, sf):
    """Two-column workplace tables to rows."""
    d = T.paired_cells(feeds.front_rows(spark, sf), "근무기간", "상호", stop=["기술경력"]).select("doc_id", "pair_no", "left_text", "right_text")
    return R.workplace_cells(d)


@query("inline_workplaces", duck("""select doc_id, 0 as seq, replace(left(p, 10), '.', '-') as start_date, replace(right(p, 10), '.', '-') as end_date, case when m in (0, 1) then maker else '' end as previous, case when m in (0, 1) then '새' || regexp_extract(c, '새(건설[0-9]+\\(주\\))$', 1) else maker end as current
 from (select doc_id, cells[1] as p, cells[2] as c, regexp_extract(cells[2], '^(건설[0-9]+\\(주\\))', 1) as maker, case when contains(cells[2], '現') then 0 when contains(cells[2], '흡수') then 1 else 2 end as m from front where row_no = 17)""", "front"))
def inline_workplaces(spark, sf):
    """Ranges with companies in running text."""
    d = front_section(spark, sf, "workplace").select("doc_id", F.concat_ws(" ", T.cell(F.col("cells"), 0), T.cell(F.col("cells"), 1)).alias("text"))
    return R.inline_workplaces(d, "text", ["doc_id"])


@query("award_lines", duck("""select doc_id, 1::bigint as island, replace(d, '.', '-') as award_date, '국토교통부' as institution, case when contains(i, '표창장') and not starts_with(k, '표창장[') then '표창장 ' || k else k end as kind from (select doc_id, cells[2] as d, cells[3] as i, cells[4] as k from front where row_no = 13)""", "front"))
def award_lines(spark, sf):
    """Award rows from text lines, torn over two lines."""
    d = front_section(spark, sf, "award").select("doc_id", F.concat_ws(" ", T.cell(F.col("cells"), 1), T.cell(F.col("cells"), 2)).alias("a"), T.cell(F.col("cells"), 3).alias("b"))
    # header, a first line with the section's name, the kind torn inside its bracket, and what stands behind the penalty line
    torn = ~F.contains("a", F.lit("표창장"))
    parts = F.array(F.lit("상훈 수여일 수여기관 종류 및 근거"), F.concat(F.lit("상훈 "), F.col("a")), F.when(torn, F.regexp_extract("b", r"^([^\[]*\[?.?)", 1)).otherwise(F.col("b")), F.when(torn, F.regexp_extract("b", r"^[^\[]*\[?.?(.*)$", 1)).otherwise(""), F.lit("벌점 해당없음"), F.lit("2001.01.01 나중 표창장[제9호]"))
    d = d.select("doc_id", F.posexplode(F.filter(parts, lambda x: x != "")).alias("line_no", "line"))
    return R.award_lines(d, ["doc_id"])


@query("award_line_count", duck("select doc_id, cast(case when count(*) filter (d) > 0 then count(*) filter (d) when count(*) filter (contains(l, '해당없음')) > 0 then 1 else 0 end as bigint) as n from (select doc_id, l, regexp_matches(l, '^[0-9]{4}\\.[0-9]{2}\\.[0-9]{2}') and not contains(l, '~') as d from (select doc_id, array_to_string(list_filter(cells, lambda c: c <> ''), ' ') as l from front where row_no between 12 and 13)) group by 1", "front"))
def award_line_count(spark, sf):
    """R35."""
    d = front_section(spark, sf, "award", True).select("doc_id", T.joined(F.col("cells")).alias("line"))
    return R.award_line_count(d, ["doc_id"])


@query("award_institution_clean", """select c_custkey, case when c_nationkey % 4 = 0 or (c_nationkey % 4 = 1 and c_custkey % 2 = 0) then '' when c_nationkey % 4 = 1 then '도로' when c_nationkey % 4 = 2 then c_mktsegment else case when c_custkey % 2 = 0 then '' else '가/나 다' end end as institution from customer""")
def award_institution_clean(spark, sf):
    """C9."""
    c = table(spark, sf, "customer")
    odd = F.col("c_custkey") % 2 == 1
    inst = F.expr("case c_nationkey % 4 when 0 then '표창' when 1 then '도로' when 2 then c_mktsegment else '가/나 다' end")
    kind = F.when(odd, "공로").otherwise("표창장[제1호]")
    kind = F.when(F.col("c_nationkey") % 4 == 2, "공로").otherwise(kind)
    return c.select("c_custkey", R.sanitize_institution(inst, kind).alias("institution"))
