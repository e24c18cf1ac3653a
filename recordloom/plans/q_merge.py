"""Joins between sources and result comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators import merge as M
from recordloom.plans import feeds
from recordloom.plans.feeds import duck
from recordloom.plans.registry import query

_FIELDS = ["work_type", "overview", "position"]


def _sides(spark, sf):
    """Records as read from lines (some fields lost) and from tables (some rows lost, names shortened)."""
    c = feeds.career_records(spark, sf)
    left = c.select("doc_id", "page_no", "rec_idx", "project_name", "issuer", "specialty", "position", F.when(F.col("note") == "2-HIGH", "").otherwise(F.col("work_type")).alias("work_type"), F.lit("").alias("overview"))
    right = c.where("rec_idx % 10 <> 2").selectExpr(
        "doc_id", "page_no", "rec_idx as row_idx", "case when note = '3-MEDIUM' then concat(project_name, ' 일원') else project_name end as project_name", "issuer", "specialty", "position", "work_type", "overview")
    return left, right


_L = "select doc_id, page_no, rec_idx, project_name, issuer, specialty, position, case when note = '2-HIGH' then '' else work_type end as work_type, '' as overview from careers"
_R = "select doc_id, page_no, rec_idx as row_idx, case when note = '3-MEDIUM' then concat(project_name, ' 일원') else project_name end as project_name, issuer, specialty, position, work_type, overview from careers where rec_idx % 10 <> 2"
_N = lambda c: f"replace({c}, ' ', '')"


def _greedy(recs: str, rows: str, pick: str) -> str:
    """Per page the records of ``recs`` in order (i, with all their columns) each take ``pick`` from the list ``rows`` of the page, given the rows ``used`` before."""
    return f"""select doc_id, page_no, cast(0 as bigint) as i, cast([] as bigint[]) as used, cast(null as bigint) as rec_idx, cast(null as bigint) as row_idx from {recs} where i = 1
 union all select doc_id, page_no, i, case when p is null then used else list_append(used, p) end, rec_idx, p from (
  select q.doc_id, q.page_no, q.i, g.used, q.rec_idx, cast({pick} as bigint) as p from g join {recs} q on g.doc_id = q.doc_id and g.page_no = q.page_no and q.i = g.i + 1 left join {rows} t on q.doc_id = t.doc_id and q.page_no = t.page_no)"""


_NUMBERED = "row_number() over (partition by doc_id, page_no order by rec_idx) as i"
_INSIDE = f"""length({_N('a.project_name')}) >= 3 and b.project_name <> '' and (ends_with({_N('b.project_name')}, {_N('a.project_name')}) or (length({_N('a.project_name')}) >= 4 and contains({_N('b.project_name')}, {_N('a.project_name')})) or (length({_N('b.project_name')}) >= 4 and contains({_N('a.project_name')}, {_N('b.project_name')})))"""
_CTX = f"{_N('issuer')} || '|' || {_N('specialty')} || '|' || {_N('position')} || '|' || {_N('work_type')}"


def _pair(a: str, b: str, key: str, cond: str) -> str:
    n = lambda t, o: f"(select *, {key} as k, row_number() over (partition by doc_id, page_no, {key} order by {o}) as i from {t} where {cond})"
    return f"select x.rec_idx, y.row_idx from {n(a, 'rec_idx')} x join {n(b, 'row_idx')} y on x.doc_id = y.doc_id and x.page_no = y.page_no and x.k = y.k and x.i = y.i"


_EXTRA = {
    "l0": _L, "r0": _R, "p1": _pair("l0", "r0", _N("project_name"), "project_name <> ''"),
    "l1": "select * from l0 where rec_idx not in (select rec_idx from p1)", "r1": "select * from r0 where row_idx not in (select row_idx from p1)",
    "p2": _pair("l1", "r1", _CTX, "issuer <> ''"),
    "l2": "select * from l1 where rec_idx not in (select rec_idx from p2)", "r2": "select * from r1 where row_idx not in (select row_idx from p2)",
    "c3": f"select a.doc_id, a.page_no, a.rec_idx, list(b.row_idx order by b.row_idx) as fit from l2 a join r2 b on a.doc_id = b.doc_id and a.page_no = b.page_no and {_N('a.issuer')} = {_N('b.issuer')} and a.issuer <> '' and {_INSIDE} group by 1, 2, 3",
    "q3": f"select *, {_NUMBERED} from c3", "t3": "select distinct doc_id, page_no from c3",
    "g": _greedy("q3", "t3", "list_filter(q.fit, lambda x: not list_contains(g.used, x))[1]"),
    "pr": "select *, 1 as tier from p1 union all select *, 2 from p2 union all select rec_idx, row_idx, 3 from g where row_idx is not null",
}


@query("enrich_one_to_one", duck("""select l.rec_idx, coalesce(nullif(l.work_type, ''), r.work_type, '') as work_type, coalesce(nullif(l.overview, ''), r.overview, '') as overview, coalesce(nullif(l.position, ''), r.position, '') as position, tier
 from l0 l left join pr on l.rec_idx = pr.rec_idx left join r0 r on pr.row_idx = r.row_idx""", "careers", extra=_EXTRA))
def enrich_one_to_one(spark, sf):
    """Tiered one-to-one enrichment from table rows."""
    left, right = _sides(spark, sf)
    return M.enrich_one_to_one(left, right, _FIELDS).select("rec_idx", *_FIELDS, "tier")


@query("positional_join", duck("""select r.doc_id, r.page_no, r.i as pos, r.start_date, l.project_name from (select *, row_number() over w as i, count(*) over (partition by doc_id, page_no) as n from careers window w as (partition by doc_id, page_no order by rec_idx)) r
 left join (select *, row_number() over (partition by doc_id, page_no order by row_idx) as i, count(*) over (partition by doc_id, page_no) as n from r0) l on r.doc_id = l.doc_id and r.page_no = l.page_no and r.i = l.i and r.n = l.n""", "careers", extra={"r0": _R}))
def positional_join(spark, sf):
    """Table rows joined to date blocks by position where the counts agree."""
    c = feeds.career_records(spark, sf)
    _, right = _sides(spark, sf)
    return M.positional_join(right.select("doc_id", "page_no", "row_idx", "project_name"), c.select("doc_id", "page_no", "rec_idx", "start_date"), ["start_date"], "row_idx", "rec_idx").drop("row_idx")


_RANKED = "case when job_field = '' then 3 when position = '' then 2 when overview like '%용역' then 2 else 1 end"


@query("source_priority", duck(f"""select doc_id, page_no, rec_idx, rank from (select *, min(rank) over (partition by doc_id, page_no) as m from (
 select * from (select *, page_no % 5 <> 0 and count(*) filter (rank = 2) over (partition by doc_id, page_no) >= 1 + page_no % 3 as ok from (select doc_id, page_no, rec_idx, {_RANKED} as rank from careers)) where rank <> 2 or ok)) where rank = m""", "careers"))
def source_priority(spark, sf):
    """The best source of a page, the template's only where it is trusted and has as many rows as the page has ``~`` lines."""
    c = feeds.career_records(spark, sf)
    d = c.select("doc_id", "page_no", "rec_idx", F.expr(_RANKED).alias("rank"))
    pages = c.select("doc_id", "page_no").distinct().select("doc_id", "page_no", (F.col("page_no") % 5 != 0).alias("trusted"), (1 + F.col("page_no") % 3).alias("n_tilde"))
    return M.best_source(M.gate_template(d, pages, pages), rank="rank")


@query("template_fill", duck("""select l.rec_idx, coalesce(nullif(l.work_type, ''), s.work_type, n.work_type, '') as work_type, coalesce(nullif(l.overview, ''), s.overview, n.overview, '') as overview
 from l0 l left join best s on l.doc_id = s.doc_id and l.page_no = s.page_no and replace(l.project_name, ' ', '') = s.k
 left join (select a.rec_idx, arg_min(b.work_type, b.row_idx) as work_type, arg_min(b.overview, b.row_idx) as overview from l0 a join best b on a.doc_id = b.doc_id and a.page_no = b.page_no and a.project_name <> '' and (ends_with(replace(a.project_name, ' ', ''), b.k) or ends_with(b.k, replace(a.project_name, ' ', ''))) group by 1) n
  on l.rec_idx = n.rec_idx and s.k is null""", "careers", extra={"l0": _L, "r0": _R.replace("concat(project_name, ' 일원')", "concat('가칭 ', project_name)"), "best": """select doc_id, page_no, replace(project_name, ' ', '') as k, (list(work_type order by length(overview) desc, row_idx))[1] as work_type, (list(overview order by length(overview) desc, row_idx))[1] as overview, min(row_idx) as row_idx from r0 where project_name <> '' group by 1, 2, 3"""}))
def template_fill(spark, sf):
    """J9."""
    left, right = _sides(spark, sf)
    right = right.withColumn("project_name", F.expr("case when project_name like '% 일원' then concat('가칭 ', replace(project_name, ' 일원', '')) else project_name end"))
    return M.template_fill(left, right, ["work_type", "overview"]).select("rec_idx", "work_type", "overview")


_A = "select c_custkey as doc_id, case when c_nationkey % 3 = 0 then '' else c_name end as name, case when c_nationkey % 2 = 0 then null else c_mktsegment end as address from customer where c_nationkey < 20"
_B = "select c_custkey as doc_id, lower(c_name) as name, 'seg' as address from customer where c_nationkey > 3"


@query("fill_empty_merge", duck("select coalesce(a.doc_id, b.doc_id) as doc_id, coalesce(nullif(a.name, ''), b.name, '') as name, coalesce(a.address, b.address, '') as address from a full join b on a.doc_id = b.doc_id", extra={"a": _A, "b": _B}))
def fill_empty_merge(spark, sf):
    """Table first, text fills the blanks."""
    c = feeds.table(spark, sf, "customer")
    return M.fill_from_fallback(spark.sql(_A.replace("from customer", "from {c}"), c=c), spark.sql(_B.replace("from customer", "from {c}"), c=c), ["doc_id"], ["name", "address"])


_S2 = "select doc_id, section, rec_idx + case when rec_idx % 61 = 0 then 1000000 else 0 end as rec_idx, project_name, case when rec_idx % 37 = 1 then concat(issuer, '!') else issuer end as issuer from careers where rec_idx % 50 <> 0"


@query("section_equality", duck("""select coalesce(a.doc_id, b.doc_id) as doc_id, coalesce(a.section, b.section) as section, count(a.rec_idx) as rows_left, count(b.rec_idx) as rows_right, count(*) filter (b.rec_idx is null) as only_left, count(*) filter (a.rec_idx is null) as only_right,
 count(*) filter (a.rec_idx is not null and b.rec_idx is not null and (a.issuer <> b.issuer or a.project_name <> b.project_name)) as different,
 count(*) filter (a.rec_idx is null or b.rec_idx is null or a.issuer <> b.issuer or a.project_name <> b.project_name) = 0 as equal,
 coalesce(cast(min(coalesce(a.rec_idx, b.rec_idx)) filter (a.rec_idx is null or b.rec_idx is null or a.issuer <> b.issuer or a.project_name <> b.project_name) as varchar), '') as example
 from careers a full join s2 b on a.doc_id = b.doc_id and a.section = b.section and a.rec_idx = b.rec_idx group by 1, 2""", "careers", extra={"s2": _S2}))
def section_equality(spark, sf):
    """Whole sections of two result sets, with an example."""
    c = feeds.career_records(spark, sf)
    right = spark.sql(_S2.replace("from careers", "from {careers}"), careers=c)
    return M.section_equality(c, right, ["doc_id", "section"], ["rec_idx"], ["project_name", "issuer"])


_U1 = "select doc_id, start_date, end_date, project_name, 'table' as src from careers where rec_idx % 3 <> 0"
_U2 = "select doc_id, start_date, end_date, case when rec_idx % 2 = 0 then concat(project_name, ' ') else project_name end as project_name, 'text' as src from careers where rec_idx % 5 <> 1"


@query("list_union", duck("""select doc_id, start_date, end_date, replace(project_name, ' ', '') as name, src from u1 union all select doc_id, start_date, end_date, n, 'text' from (
 select distinct doc_id, start_date, end_date, replace(project_name, ' ', '') as n from u2) u where not exists (select 1 from u1 where u1.doc_id = u.doc_id and u1.start_date = u.start_date and u1.end_date = u.end_date and replace(u1.project_name, ' ', '') = u.n)""", "careers", extra={"u1": _U1, "u2": _U2}))
def list_union(spark, sf):
    """List fields, table rows first, text rows by their full key."""
    c = feeds.career_records(spark, sf)
    a, b = (spark.sql(x.replace("from careers", "from {careers}"), careers=c) for x in (_U1, _U2))
    d = M.union_on_key(a, b, ["doc_id", "start_date", "end_date", "project_name"])
    return d.select("doc_id", "start_date", "end_date", F.replace("project_name", F.lit(" "), F.lit("")).alias("name"), "src")


@query("fallback_anti", duck("select doc_id, name from a union all select doc_id, name from b where doc_id not in (select doc_id from a)", extra={"a": _A, "b": _B}))
def fallback_anti(spark, sf):
    """J11."""
    c = feeds.table(spark, sf, "customer")
    a, b = (spark.sql(x.replace("from customer", "from {c}"), c=c).select("doc_id", "name") for x in (_A, _B))
    return M.fallback_only(a, b)


_LI = "select l_orderkey as doc_id, l_linenumber as line, l_partkey as ord, cast({q} as string) as quantity, l_returnflag as flag from {t} where {w}"
_QL, _QR = "cast(l_quantity as int)", "case when l_linestatus = 'F' and l_suppkey < 20 then cast(l_quantity as int) + 1 else cast(l_quantity as int) end"
_J13 = {"a": _LI.format(q=_QL, t="lineitem", w="l_discount < 0.09"), "b": _LI.format(q=_QR, t="lineitem", w="l_tax < 0.07")}


@query("result_diff", duck("""select doc_id, line, ord, status, field, lv as left_value, rv as right_value from (
 select *, case when rq is null then 'only_left' when lq is null then 'only_right' else 'both' end as status, case when rq is null or lq is null then [{'f': null::varchar, 'l': null::varchar, 'r': null::varchar}] else
  list_filter([{'f': 'quantity', 'l': lq, 'r': rq}, {'f': 'flag', 'l': lf, 'r': rf}], lambda x: x.l <> x.r) end as ds from (
  select coalesce(a.doc_id, b.doc_id) as doc_id, coalesce(a.line, b.line) as line, coalesce(a.i, b.i) as ord, a.quantity as lq, b.quantity as rq, a.flag as lf, b.flag as rf from
  (select *, row_number() over (partition by doc_id, line order by ord, quantity, flag) as i from a) a full join (select *, row_number() over (partition by doc_id, line order by ord, quantity, flag) as i from b) b on a.doc_id = b.doc_id and a.line = b.line and a.i = b.i)), lateral (select unnest(ds).f as field, unnest(ds).l as lv, unnest(ds).r as rv)""", extra=_J13))
def result_diff(spark, sf):
    """Two versions of the line items compared by key and ordinal."""
    li = feeds.table(spark, sf, "lineitem")
    key = F.struct("ord", "quantity", "flag")
    a, b = (spark.sql(_LI.format(q=q, t="{t}", w=w), t=li).withColumn("_o", key).withColumn("_chunk", F.floor(F.col("ord") / 4096)) for q, w in ((_QL, "l_discount < 0.09"), (_QR, "l_tax < 0.07")))
    a, b = (d.withColumnRenamed("ord", "part") for d in (a, b))
    return M.compare_by_key(a, b, ["line"], ["quantity", "flag"], "_o", chunks=["_chunk"])


@query("diff_counts", duck("""select f as field, count(*) as rows_compared, count(*) filter (l <> r and replace(l, ' ', '') <> replace(r, ' ', '')) as real_diffs, count(*) filter (l <> r and replace(l, ' ', '') = replace(r, ' ', '')) as space_diffs from (
 select 'project_name' as f, project_name as l, case when note = '2-HIGH' then replace(project_name, ' ', '') else project_name end as r from careers union all select 'issuer', issuer, case when note = '5-LOW' then issuer || '청' else issuer end from careers) group by 1""", "careers"))
def diff_counts(spark, sf):
    """J14."""
    c = feeds.career_records(spark, sf).select("rec_idx", "project_name", "issuer", "note")
    r = c.withColumn("project_name", F.when(F.col("note") == "2-HIGH", F.replace(F.col("project_name"), F.lit(" "), F.lit(""))).otherwise(F.col("project_name"))).withColumn(
        "issuer", F.when(F.col("note") == "5-LOW", F.concat("issuer", F.lit("청"))).otherwise(F.col("issuer")))
    return M.diff_counts(c, r, ["project_name", "issuer"], ["rec_idx"])


@query("source_crosscheck", duck("""select rec_idx, issuer <> '' and contains(replace(replace(text, ' ', ''), chr(10), ''), replace(issuer, ' ', '')) as in_text,
  issuer <> '' and d <> '' and strpos(text, d) > 0 and contains(replace(replace(substr(text, greatest(strpos(text, d) - 40, 1), 80), ' ', ''), chr(10), ''), replace(issuer, ' ', '')) as near_date
 from (select c.rec_idx, c.issuer, replace(c.start_date, '-', '.') as d, p.text from careers c left join career_pages p on c.doc_id = p.doc_id and c.page_no = p.page_no)""", "careers", "career_pages"))
def source_crosscheck(spark, sf):
    """Record values looked up in the page text, also near their date."""
    c = feeds.career_records(spark, sf).select("doc_id", "page_no", "rec_idx", "issuer", F.replace(F.col("start_date"), F.lit("-"), F.lit(".")).alias("d"))
    return M.crosscheck(c, feeds.career_pages(spark, sf), "issuer", "d", 40).select("rec_idx", "in_text", "near_date")


_LR_SCORE = """case when x.issuer = q.issuer and q.issuer <> '' then coalesce(1 + case when x.specialty = '' or q.specialty = '' then 0 when x.specialty = q.specialty then 2 end
 + case when x.position = '' or q.position = '' then 0 when x.position = q.position then 2 end, 0) end"""
_LR = {
    "l0": "select doc_id, page_no, rec_idx, case when rec_idx % 3 = 0 then '' else project_name end as project_name, left(issuer, 2) as issuer, case when job_field = '' then '' else specialty end as specialty, '' as position from careers",
    "r0": "select doc_id, page_no, rec_idx as row_idx, project_name, left(issuer, 2) as issuer, specialty, position from careers where project_name <> '' and rec_idx % 4 < 3",
    "q1": f"select *, {_NUMBERED} from l0 where project_name = ''",
    "t1": "select doc_id, page_no, list({row: row_idx, issuer: issuer, specialty: specialty, position: position}) as rows from r0 group by 1, 2",
    "g": _greedy("q1", "t1", f"list_sort(list_filter(list_transform(t.rows, lambda x: {{s: - ({_LR_SCORE}), row: x.row}}), lambda y: y.s is not null and not list_contains(g.used, y.row)))[1].row"),
    "left_recs": f"select doc_id, page_no, rec_idx, {_NUMBERED} from q1 where rec_idx not in (select rec_idx from g where row_idx is not null)",
    "left_rows": "select doc_id, page_no, row_idx, row_number() over (partition by doc_id, page_no order by row_idx) as i from r0 where row_idx not in (select row_idx from g where row_idx is not null)",
    "pr": "select rec_idx, row_idx from g where row_idx is not null union all select a.rec_idx, b.row_idx from left_recs a join left_rows b on a.doc_id = b.doc_id and a.page_no = b.page_no and a.i = b.i",
}


@query("last_resort_names", duck("""select c.rec_idx, case when c.project_name <> '' then c.project_name else coalesce(r.project_name, '(사업명 미상)') end as project_name
 from l0 c left join pr on c.rec_idx = pr.rec_idx left join r0 r on pr.row_idx = r.row_idx""", "careers", extra=_LR))
def last_resort_names(spark, sf):
    """J16."""
    c = feeds.career_records(spark, sf)
    a = c.selectExpr("doc_id", "page_no", "rec_idx", "case when rec_idx % 3 = 0 then '' else project_name end as project_name", "left(issuer, 2) as issuer", "case when job_field = '' then '' else specialty end as specialty", "'' as position")
    b = c.where("rec_idx % 4 < 3").selectExpr("doc_id", "page_no", "rec_idx as row_idx", "project_name", "left(issuer, 2) as issuer", "specialty", "position")
    return M.last_resort_names(a, b).select("rec_idx", "project_name")


@query("tiered_fill", duck("""select l.rec_idx, coalesce(nullif(l.work_type, ''), case when t1.s is not null then t1.w else t2.w end, '') as work_type, case when t1.s is not null then t1.o else coalesce(t2.o, '') end as overview, case when t1.s is not null then 1 when t2.s is not null then 2 end as tier
 from l0 l left join (select doc_id, s, e, (list(work_type order by length(replace(overview, ' ', '')) desc, overview desc))[1] as w, (list(overview order by length(replace(overview, ' ', '')) desc, overview desc))[1] as o from r0 where s <> '' group by 1, 2, 3) t1 on l.doc_id = t1.doc_id and l.s = t1.s and l.e = t1.e
 left join (select doc_id, s, (list(work_type order by length(replace(overview, ' ', '')) desc, overview desc))[1] as w, (list(overview order by length(replace(overview, ' ', '')) desc, overview desc))[1] as o from r0 where s <> '' group by 1, 2) t2 on l.doc_id = t2.doc_id and l.s = t2.s""", "careers",
    extra={"l0": "select doc_id, rec_idx, start_date as s, end_date as e, case when note = '2-HIGH' then '' else work_type end as work_type from careers", "r0": "select doc_id, start_date as s, case when note = '3-MEDIUM' then '' else end_date end as e, work_type, overview || ' ' || cast(rec_idx as string) as overview from careers where rec_idx % 10 <> 2"}))
def tiered_fill(spark, sf):
    """Period key, then start date; the longest overview wins."""
    c = feeds.career_records(spark, sf)
    left = c.selectExpr("doc_id", "rec_idx", "start_date as s", "end_date as e", "case when note = '2-HIGH' then '' else work_type end as work_type", "'' as overview")
    right = c.where("rec_idx % 10 <> 2").selectExpr("doc_id", "start_date as s", "case when note = '3-MEDIUM' then '' else end_date end as e", "work_type", "concat(overview, ' ', cast(rec_idx as string)) as overview")
    return M.fill_by_tiers(left, right, [["s", "e"], ["s"]], ["work_type", "overview"], ["doc_id"], "rec_idx").select("rec_idx", "work_type", "overview", "tier")
