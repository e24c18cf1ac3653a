"""De-duplication, awards and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions.grammar import SHORT_WORK_TYPES
from recordloom.operators import dedup as D
from recordloom.operators import quality as Q
from recordloom.operators.lines import split_lines
from recordloom.plans import feeds
from recordloom.plans.feeds import DUCK_FEEDS, duck, table
from recordloom.plans.registry import query

_REC = "select *, left(start_date, 7) || '-01' as month from careers"


#: Every fourth record twice, every twentieth three times.
_TWICE = "select * from careers {copies} where c = 0 or (c = 1 and rec_idx % 4 = 0) or (c = 2 and rec_idx % 20 = 0)"
_DUCK_TWICE = {"twice": _TWICE.format(copies=", (values (0), (1), (2)) v(c)")}


def _twice(spark, sf):
    return spark.sql(_TWICE.format(copies="lateral view explode(array(0, 1, 2)) v as c").replace("from careers", "from {careers}"), careers=feeds.career_records(spark, sf))


@query("dup_mark", duck("""select t.rec_idx, t.c, d.n is not null as dup, d.g as dup_group, d.n as dup_count from twice t left join (
 select *, row_number() over (partition by doc_id, section order by project_name, start_date, end_date) as g from (select doc_id, section, project_name, start_date, end_date, count(*) as n from twice where project_name <> '' and start_date <> '' and end_date <> '' group by all) where n >= 2) d
 on t.doc_id = d.doc_id and t.section = d.section and t.project_name = d.project_name and t.start_date = d.start_date and t.end_date = d.end_date""", "careers", extra=_DUCK_TWICE))
def dup_mark(spark, sf):
    """A7 by name, start and end."""
    return D.mark_duplicates(_twice(spark, sf)).select("rec_idx", "c", "dup", "dup_group", "dup_count")


_LIC = """select doc_id, rec_idx as seq, left(start_date, 7) || '-01' as pass_date, case note when '1-URGENT' then '토목기사' when '2-HIGH' then '기사' when '3-MEDIUM' then '토목 기사' else '측량기능사' end as name,
 case when position = '' then '' when job_field = '' then cast(part_days as string) else concat(substring(start_date, 3, 2), '2', lpad(cast(page_no % 3 as string), 8, '0'), case when position = '부장' then 'a' else '' end) end as number from careers"""
_LSCORE = """case when n in ('기사','산업기사','기능사','기술사','기능장') then 0 else 1 end desc, case when length(number) >= 2 and left(number, 2) = substring(pass_date, 3, 2) and regexp_matches(pass_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') then 10 else 0 end desc,
 case when regexp_full_match(number, '[0-9]+') and length(number) < 10 then 0 else 1 end desc, least(length(number), 30) desc, length(name) desc, upper(number) desc, seq"""


@query("licence_dedup", duck(f"""select doc_id, seq, pass_date, name, number from (select *, row_number() over (partition by doc_id, pass_date, n order by {_LSCORE}) as r2 from (
 select * from (select *, row_number() over (partition by doc_id, pass_date, k order by {_LSCORE}) as r1 from (
  select *, replace(name, ' ', '') as n, case when length(number) >= 8 and regexp_matches(number, '[0-9]') then 'reg|' || upper(number) else 'name|' || replace(name, ' ', '') end as k from lic)) where r1 = 1)) where r2 = 1""", "careers", extra={"lic": _LIC}))
def licence_dedup(spark, sf):
    """Two passes, best score stays."""
    return D.dedup_licences(spark.sql(_LIC.replace("from careers", "from {c}"), c=feeds.career_records(spark, sf)))


_AWARD = """select doc_id, rec_idx as seq, case when start_date like '*%' then start_date else concat(substring(start_date, 1, 4), '-05-05') end as award_date, case when job_field = '' then '' when position = '' then replace(issuer, ' ', '') else issuer end as institution,
 case note when '1-URGENT' then concat('표창장[제', recog_days, '호]') when '2-HIGH' then concat('표창장[제', recog_days, '호') when '3-MEDIUM' then '공로' when '4-NOT SPECIFIED' then '상장 수여일' else '' end as kind from careers"""
_AQ = "case when kind = '' then -10 when kind = '공로' then 0 when kind = '상장 수여일' then 1 else 4 end"


def _awards(spark, sf):
    return spark.sql(_AWARD.replace("from careers", "from {c}"), c=feeds.career_records(spark, sf))


@query("award_merge", duck(f"""select doc_id, award_date, coalesce((list(institution order by seq) filter (institution <> ''))[1], '') as institution, (list(kind order by {_AQ} desc, length(kind) desc, seq))[1] as kind
 from aw group by doc_id, award_date, replace(institution, ' ', '')""", "careers", extra={"aw": _AWARD}))
def award_merge(spark, sf):
    """A9."""
    return D.merge_awards(_awards(spark, sf))


@query("fragment_anti", duck("""select doc_id, seq, kind from aw a where not exists (select 1 from (select distinct doc_id, award_date, replace(kind, ' ', '') as k from aw) b
 where a.doc_id = b.doc_id and a.award_date = b.award_date and replace(a.kind, ' ', '') <> '' and length(b.k) > length(replace(a.kind, ' ', '')) and contains(b.k, replace(a.kind, ' ', '')))""", "careers", extra={"aw": _AWARD}))
def fragment_anti(spark, sf):
    """A10: rows contained in a longer row of the same document and date."""
    return D.drop_contained(_awards(spark, sf), ["doc_id", "award_date"], "kind").select("doc_id", "seq", "kind")


_BLEED = """select doc_id, rec_idx as seq, case note when '1-URGENT' then concat('표창장[국토교통부제', page_no % 3, '호]') when '2-HIGH' then concat('감사장[서울특별시]', ' 표창장[국토교통부 제', page_no % 3, '호]') when '3-MEDIUM' then concat('훈장[행정안전부장관상] 감사장[서울특별시] 표창장[국토교통부제', page_no % 3, '호]') else '포장 국토 표창장[국토교통부제1호]' end as kind from careers"""


@query("suffix_bleed", duck("""select a.doc_id, a.seq, case when note = '3-MEDIUM' and two then '훈장[행정안전부장관상]' when note = '3-MEDIUM' and one then '훈장[행정안전부장관상] 감사장[서울특별시]' when note = '2-HIGH' and one then '감사장[서울특별시]' else kind end as kind
 from (select aw.*, note, page_no % 3 as k, bool_or(note = '1-URGENT') over (partition by aw.doc_id, page_no % 3) as one, bool_or(note = '2-HIGH') over (partition by aw.doc_id, page_no % 3) as two from aw join careers on seq = rec_idx) a""", "careers", extra={"aw": _BLEED}))
def suffix_bleed(spark, sf):
    """Two passes."""
    return D.strip_suffix_bleed(spark.sql(_BLEED.replace("from careers", "from {c}"), c=feeds.career_records(spark, sf)), ["doc_id"], "seq", "kind", passes=2)


_CUST = """select c_custkey as doc_id, i as seq, concat('20', lpad(cast((c_custkey + i * 7) % 20 as string), 2, '0'), '-0', cast(1 + i as string), '-05') as award_date,
 case when c_nationkey % 3 = 0 then '표창장[제1호] 감사장[제2호]' when c_nationkey % 3 = 1 then '표창장[제1호] 감사장[제2호] 표창장[제1호] 감사장[제2호]' else concat('표창장[제', cast(i as string), '호]') end as kind,
 case when i = case when (c_custkey + 7) % 20 > (c_custkey + 14) % 20 then 2 else 1 end then '서울특별시 순천시' else '서울특별시' end as institution from """
_CUST_D = _CUST + "customer, (values (1), (2)) as v(i)"


def _cust_awards(spark, sf):
    c = table(spark, sf, "customer").select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("i"))
    return spark.sql(_CUST + "{c}", c=c)


@query("award_redistribute", duck("""select doc_id, seq, award_date, institution, case when contains(kind, '감사장') then case when row_number() over (partition by doc_id order by award_date, seq) = 1 then '표창장[제1호]' else '감사장[제2호]' end else kind end as kind from aw""", extra={"aw": _CUST_D}))
def award_redistribute(spark, sf):
    """A12."""
    return D.redistribute_blocks(_cust_awards(spark, sf)).select("doc_id", "seq", "award_date", "institution", "kind")


@query("award_institutions", duck("select doc_id, seq, case when contains(institution, ' ') then '순천시' else institution end as institution from aw", extra={"aw": _CUST_D}))
def award_institutions(spark, sf):
    """Two merged institutions over two rows."""
    return D.split_merged_institutions(_cust_awards(spark, sf)).select("doc_id", "seq", "institution")


_NA = """select c_custkey as doc_id, case when c_nationkey % 4 = 0 then '해당없음' else '2001-02-03' end as award_date, case when c_nationkey % 4 = 0 then '' else c_mktsegment end as kind from customer where c_nationkey % 4 < 3
 union all select c_custkey, '2005-01-01', '추가' from customer where c_nationkey % 8 = 0"""


@query("award_none_row", duck("""select doc_id, award_date, kind from na where award_date <> '해당없음' or doc_id not in (select doc_id from na where award_date <> '해당없음')
 union all select c_custkey, '해당없음', null from customer where c_custkey not in (select doc_id from na)""", extra={"na": _NA}))
def award_none_row(spark, sf):
    """The 'not applicable' row."""
    c = table(spark, sf, "customer")
    na = spark.sql(_NA.replace("from customer", "from {c}"), c=c)
    return D.with_not_applicable(na, c.select(F.col("c_custkey").alias("doc_id")))


@query("exact_dedup", duck("select doc_id, start_date, end_date, issuer, arg_min(rec_idx * 3 + c, rec_idx * 3 + c) as ord, arg_min(overview, rec_idx * 3 + c) as overview from twice group by doc_id, start_date, end_date, issuer", "careers", extra=_DUCK_TWICE))
def exact_dedup(spark, sf):
    """A14 by start, end and issuer."""
    t = _twice(spark, sf).select("doc_id", "start_date", "end_date", "issuer", "overview", (F.col("rec_idx") * 3 + F.col("c")).alias("ord"))
    return D.first_per_key(t, ["doc_id", "start_date", "end_date", "issuer"], ["ord"])


@query("completeness", duck("select * from (" + " union all ".join(f"select doc_id, section, rec_idx, '{f}' as field, 'empty' as error from careers where trim({f}) = ''" for f in Q.REQUIRED_FIELDS["tech"]) + ")", "careers"))
def completeness(spark, sf):
    """A15."""
    return Q.empty_fields(feeds.career_records(spark, sf), Q.REQUIRED_FIELDS["tech"], ["doc_id", "section", "rec_idx"])


@query("name_errors", duck("select doc_id, section, rec_idx, 'project_name' as field, 'empty' as kind from careers where project_name = ''", "careers"))
def name_errors(spark, sf):
    """A16."""
    return Q.name_errors(feeds.career_records(spark, sf), ["doc_id", "section", "rec_idx"])


@query("schema_report", duck("""select d.doc_id, s.section, coalesce(n, 0) as n, n is null as missing from (select distinct doc_id from careers) d, (values ('tech'), ('cm'), ('award')) s(section)
 left join (select doc_id, section, count(*) as n from careers group by all) c on d.doc_id = c.doc_id and s.section = c.section""", "careers"))
def schema_report(spark, sf):
    """A17."""
    c = feeds.career_records(spark, sf)
    return Q.schema_report(c.groupBy("doc_id", "section").agg(F.count(F.lit(1)).alias("n")), c.select("doc_id"), ["tech", "cm", "award"])


_W = "(" + ",".join(f"'{w}'" for w in SHORT_WORK_TYPES) + ")"
_SHIFTED = "case rec_idx % 17 when 0 then concat('2021.01 ', project_name) when 1 then concat(project_name, ' (12일)') else project_name end"
DUCK_FEEDS["validated"] = (
    f"""select *, case when (tech_fallback > 0 and tech_fallback / greatest(tech_rows, 1) >= 0.3) or (cm_fallback > 0 and cm_fallback / greatest(cm_rows, 1) >= 0.3) or bad_dates > 0 then 'FAIL'
  when tech_fallback + cm_fallback + name_shift + overview_shift + boundary + issuer_is_work_type + mismatches > 0 then 'WARN' else 'PASS' end as level from (
 select doc_id, count(*) filter (t) as tech_rows, count(*) filter (not t) as cm_rows, count(*) filter (t and fb) as tech_fallback, count(*) filter (not t and fb) as cm_fallback,
  cast(sum(cast(b1 as int) + cast(b2 as int)) as bigint) as bad_dates, count(*) filter (t and rec_idx % 17 in (0, 1)) as name_shift, count(*) filter (t and length(overview) <= 40 and regexp_matches(overview, '(실시설계|건설공사|용역)$') and not regexp_matches(overview, '[0-9]|:|-|~|%')) as overview_shift,
  count(*) filter (t and issuer <> '' and work_type = '' and (sw)) as boundary, count(*) filter (t and issuer in {_W}) as issuer_is_work_type, cast(count(distinct section) filter (doc_id % 4 = 0) as bigint) as mismatches
 from (select *, section = 'tech' as t, project_name in ('', '(사업명 미상)') as fb, string_split(issuer, ' ')[-1] in {_W} as sw, not (start_date in ('', '****-**-**') or regexp_full_match(start_date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')) as b1,
   not (end_date in ('', '근무중') or regexp_full_match(end_date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')) as b2 from (select * replace ({_SHIFTED} as project_name) from careers)) group by doc_id)""", ("careers",))


@query("validator", duck("select * from validated", "validated"))
def validator(spark, sf):
    """A18 per document, with shifted names and with count checks of which every fourth document fails."""
    c = feeds.career_records(spark, sf).withColumn("project_name", F.expr(_SHIFTED))
    checks = c.groupBy("doc_id", "section").agg((F.first("doc_id") % 4 != 0).alias("equal"))
    return Q.validate_documents(c, checks, SHORT_WORK_TYPES)


@query("validator_rollup", duck("select coalesce(level, 'TOTAL') as level, count(*) as documents, cast(sum(tech_rows) as bigint) as tech_rows, cast(sum(cm_rows) as bigint) as cm_rows from validated group by rollup (level)", "validated"))
def validator_rollup(spark, sf):
    """A18 totals."""
    return Q.level_totals(validator(spark, sf))


@query("neighbour_checks", duck("""select doc_id, rec_idx, coalesce(start_date = s and end_date = e and project_name <> n, false) as same_period, coalesce(length(t) > 3 and starts_with(replace(n, ' ', ''), t), false) as overview_heads_name, rec_idx % 23 = 0 as torn_name
 from (select *, lead(project_name) over w as n, lead(start_date) over w as s, lead(end_date) over w as e, right(replace(overview, ' ', ''), 30) as t from (select doc_id, rec_idx, case when rec_idx % 23 = 0 then '공 사 ' || project_name else project_name end as project_name, left(start_date, 4) as start_date, left(end_date, 4) as end_date, case when note = '2-HIGH' then '제' || left(project_name, 7) else project_name end as overview from careers) window w as (partition by doc_id order by rec_idx))
 where same_period or overview_heads_name or torn_name""", "careers"))
def neighbour_checks(spark, sf):
    """A19."""
    c = feeds.career_records(spark, sf)
    name = F.when(F.col("rec_idx") % 23 == 0, F.concat(F.lit("공 사 "), "project_name")).otherwise(F.col("project_name")).alias("project_name")
    d = c.select("doc_id", "rec_idx", name, F.substring("start_date", 1, 4).alias("start_date"), F.substring("end_date", 1, 4).alias("end_date"),
                 F.when(F.col("note") == "2-HIGH", F.concat(F.lit("제"), F.substring("project_name", 1, 7))).otherwise(F.col("project_name")).alias("overview"))
    return Q.neighbour_checks(d)


_DIRTY = "case when rec_idx % 3 = 0 then concat(project_name, job_field, duty) else project_name end"


@query("contaminated_pages", duck(f"select doc_id, page_no, count(*) filter (job_field <> '' and duty <> '' and contains(nm, job_field) and contains(nm, duty)) as hits, count(*) as n from (select *, {_DIRTY} as nm from careers) group by doc_id, page_no having hits >= 2 order by hits desc, doc_id, page_no limit 20", "careers"))
def contaminated_pages(spark, sf):
    """A top-k report."""
    c = feeds.career_records(spark, sf).withColumn("project_name", F.expr(_DIRTY))
    return Q.contaminated_pages(c, 2, 20)


@query("content_checks", duck("""select rec_idx, note = '2-HIGH' as award_in_course, note = '5-LOW' and duty like '(%' as unbalanced_major from careers where note = '2-HIGH' or (note = '5-LOW' and duty like '(%')""", "careers"))
def content_checks(spark, sf):
    """A21."""
    c = feeds.career_records(spark, sf).select(
        "rec_idx", F.when(F.col("note") == "2-HIGH", F.concat("overview", F.lit(" 표창장"))).otherwise(F.col("overview")).alias("course"),
        F.when(F.col("note") == "5-LOW", F.replace(F.col("duty"), F.lit(")"), F.lit(""))).otherwise(F.col("duty")).alias("major"))
    return Q.content_checks(c, ["rec_idx"], "course", "major")


@query("corpus_summary", duck("""select c.doc_id, count(*) filter (section = 'tech') as n_tech, count(*) filter (section = 'cm') as n_cm, coalesce(max(m), 0) as mismatches from careers c left join (
 select doc_id, count(*) filter (n <> e) as m from (select doc_id, section, count(*) as n, count(*) filter (project_name <> '') as e from careers group by all) group by 1) x on c.doc_id = x.doc_id group by c.doc_id""", "careers"))
def corpus_summary(spark, sf):
    """A22."""
    g = feeds.career_records(spark, sf).groupBy("doc_id", "section").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("project_name") != "").alias("e"))
    return Q.corpus_summary(g, g.select("doc_id", "section", (F.col("n") == F.col("e")).alias("equal")), ["tech", "cm"])


@query("template_trust", duck("""select *, complete / n >= 0.7 and dirty <= greatest(1, n // 6) as trusted from (select doc_id, page_no, count(*) as n, count(*) filter (project_name <> '' and start_date <> '' and end_date <> '') as complete, count(*) filter (regexp_matches(nm, '\\([0-9]+일\\)')) as dirty
 from (select *, case when work_type = '' and project_name <> '' then project_name || '(12일)' else project_name end as nm from careers) group by 1, 2)""", "careers"))
def template_trust(spark, sf):
    """A23."""
    nm = F.when((F.col("work_type") == "") & (F.col("project_name") != ""), F.concat("project_name", F.lit("(12일)"))).otherwise(F.col("project_name"))
    return Q.trusted_pages(feeds.career_records(spark, sf).withColumn("project_name", nm))


@query("source_score", duck("""select doc_id, page_no, source, score from (select *, row_number() over (partition by doc_id, page_no order by score desc, source) as r from (
 select doc_id, page_no, resp as source, cast(sum(case when project_name <> '' then 2 else 0 end + case when issuer <> '' then 1 else 0 end + case when start_date <> '' and end_date <> '' then 1 else 0 end) as bigint) as score from careers group by 1, 2, 3)) where r = 1""", "careers"))
def source_score(spark, sf):
    """The better of two sources per page."""
    return Q.source_scores(feeds.career_records(spark, sf).withColumn("source", F.col("resp")))


@query("record_lookup", duck("select rec_idx, project_name, issuer from careers where contains(replace(issuer, ' ', ''), '경기도양주시') and contains(replace(work_type, ' ', ''), '공원')", "careers"))
def record_lookup(spark, sf):
    """A25."""
    return Q.lookup(feeds.career_records(spark, sf), issuer="경기도 양주시", work_type="공원").select("rec_idx", "project_name", "issuer")


@query("page_meta", duck("select rec_idx, p[1] as first_page, array_to_string(p, ',') as pages from (select rec_idx, list_sort(list_distinct(list_filter([page_no, -page_no, rec_idx % 5, page_no], lambda x: x > 0))) as p from careers)", "careers"))
def page_meta(spark, sf):
    """Distinct positive pages of a record; the first and the text form."""
    c = feeds.career_records(spark, sf)
    p = Q.page_list(F.array(F.col("page_no"), -F.col("page_no"), F.col("rec_idx") % 5, F.col("page_no")))
    return c.select("rec_idx", F.get(p, F.lit(0)).alias("first_page"), F.array_join(F.transform(p, lambda x: x.cast("string")), ",").alias("pages"))


@query("expected_licences", duck("""select doc_id, cast(sum(case when inside and f is null then len(regexp_extract_all(line, '(기사|기술사|산업기사|기능사|기능장).*?[0-9]{4}\\.[0-9]{2}\\.[0-9]{2}')) else 0 end) as bigint) as n from (
 select *, last_value(f ignore nulls) over (partition by doc_id order by page_no, row_no rows between unbounded preceding and current row) as inside from (
  select *, case when contains(line, '종목') and contains(line, '합격일') then true when contains(line, '학력') or contains(line, '졸업일') or contains(line, '교육기간') or contains(line, '교육훈련') then false end as f
  from (select doc_id, page_no, row_no, replace(array_to_string(list_filter(cells, lambda c: c <> ''), ' '), chr(10), ' ') as line from front))) group by doc_id""", "front"))
def expected_licences(spark, sf):
    """A4: licence rows counted a second way."""
    from recordloom.operators.tables import joined

    d = feeds.front_rows(spark, sf).select("doc_id", "page_no", F.col("row_no").alias("line_no"), F.replace(joined(F.col("cells")), F.lit("\n"), F.lit(" ")).alias("line"))
    return Q.expected_counts(d)


_D10 = "[0-9]{4}\\.[0-9]{2}\\.[0-9]{2}"


@query("expected_sections", duck(f"""select doc_id, cast(sum(case when row_no in (10, 11) then len(regexp_extract_all(line, '{_D10}\\s*~\\s*{_D10}')) else 0 end) as bigint) as n_training,
 cast(sum(case when row_no = 17 then len(regexp_extract_all(line, '{_D10}\\s*~')) else 0 end) as bigint) as n_workplace,
 cast(sum(case when row_no in (5, 6) then len(regexp_extract_all(line, '(기사|기술사|산업기사|기능사|기능장).*?{_D10}')) else 0 end) as bigint) as n_license,
 cast(sum(case when row_no = 13 and regexp_matches(line, '^{_D10}') then 1 else 0 end) as bigint) as n_award
 from (select doc_id, row_no, replace(array_to_string(list_filter(cells, lambda c: c <> ''), ' '), chr(10), ' ') as line from front) group by doc_id""", "front"))
def expected_sections(spark, sf):
    """A4: the front-page sections counted a second way, on the rows that the section machine assigns."""
    from recordloom.operators import sections as S
    from recordloom.operators.tables import joined

    d = feeds.front_rows(spark, sf).withColumn("line", F.replace(joined(F.col("cells")), F.lit("\n"), F.lit(" ")))
    return Q.expected_front_counts(S.section_states(d, "line", "row_no"))
