"""Scalar rules on dates, periods, cells and career fields (R1 R2 R5 C1-C12, date variants)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import dates as D
from recordloom.functions.typed_cells import typed_cell
from recordloom.operators import cleanup as C
from recordloom.plans import feeds
from recordloom.plans.feeds import duck, table
from recordloom.plans.registry import query

_RAW_DATE_SPARK = """case l_linenumber
  when 1 then date_format(l_shipdate, 'yyyy.MM.dd') when 2 then date_format(l_shipdate, 'yyyy.MM')
  when 3 then date_format(l_shipdate, 'yyyy-MM-dd') when 4 then concat(date_format(l_shipdate, 'yyyy.MM.'), cast(cast(l_quantity as int) + 10 as string))
  when 5 then concat(' ', date_format(l_shipdate, 'yyyy-MM')) when 6 then concat(date_format(l_shipdate, 'yyyy.'), cast(cast(l_quantity as int) % 13 as string)) else '****.**.**' end"""
_RAW_DATE_DUCK = """case l_linenumber
  when 1 then strftime(l_shipdate, '%Y.%m.%d') when 2 then strftime(l_shipdate, '%Y.%m')
  when 3 then strftime(l_shipdate, '%Y-%m-%d') when 4 then concat(strftime(l_shipdate, '%Y.%m.'), cast(cast(l_quantity as int) + 10 as string))
  when 5 then concat(' ', strftime(l_shipdate, '%Y-%m')) when 6 then concat(strftime(l_shipdate, '%Y.'), cast(cast(l_quantity as int) % 13 as string)) else '****.**.**' end"""


def _iso(x: str) -> str:
    return f"coalesce(strftime(try_strptime({x}, '%Y-%m-%d'), '%Y-%m-%d'), '')"


_DATE_SQL = f"""select distinct raw,
 case when full_d then {_iso("dash")} when mon or imon then {_iso("dash || '-01'")} else '' end as first_day,
 case when full_d then {_iso("dash")} when mon then dash else '' end as keep_month,
 case when full_d or iso_d then {_iso("dash")} else s end as passthrough,
 case when full_d or iso_d then {_iso("dash")} when mon then coalesce(nullif({_iso("dash || '-01'")}, ''), s) else s end as workplace,
 case when regexp_matches(raw, '^[0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}') then replace(left(raw, 10), '.', '-')
      when regexp_matches(raw, '^[0-9]{{4}}\\.[0-9]{{1,2}}') then left(raw, 4) || '-' || lpad(regexp_extract(raw, '^[0-9]{{4}}\\.([0-9]{{1,2}})', 1), 2, '0') || '-01'
      else raw end as unchecked
from (select raw, s, replace(s, '.', '-') as dash,
   regexp_full_match(s, '[0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}') as full_d, regexp_full_match(s, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') as iso_d,
   regexp_full_match(s, '[0-9]{{4}}\\.[0-9]{{2}}') as mon, regexp_full_match(s, '[0-9]{{4}}-[0-9]{{2}}') as imon
  from (select distinct {_RAW_DATE_DUCK} as raw, trim({_RAW_DATE_DUCK}) as s from lineitem))"""


@query("date_norm", _DATE_SQL)
def date_norm(spark, sf):
    """All five date-to-ISO variants over ship dates written in seven ways."""
    raw = table(spark, sf, "lineitem").select(F.expr(_RAW_DATE_SPARK).alias("raw")).distinct()
    return raw.select("raw", *[D.date_to_iso(F.col("raw"), m).alias(m) for m in D.MODES])


@query("birth_date", """select c_custkey, raw, case when regexp_full_match(raw, '[0-9]{2}\\.[0-9]{2}\\.[0-9]{2}')
  then coalesce(strftime(try_strptime((case when cast(left(raw, 2) as int) <= 26 then '20' else '19' end) || replace(raw, '.', '-'), '%Y-%m-%d'), '%Y-%m-%d'), '') else '' end as birth
from (select c_custkey, lpad(cast(c_custkey % 100 as varchar), 2, '0') || '.' || lpad(cast(1 + c_custkey % 13 as varchar), 2, '0') || '.' || lpad(cast(1 + c_nationkey as varchar), 2, '0') as raw from customer)""")
def birth_date(spark, sf):
    """Two-digit birth years with a pivot parameter."""
    c = table(spark, sf, "customer")
    p2 = lambda e: F.lpad(e.cast("string"), 2, "0")
    raw = F.concat_ws(".", p2(F.col("c_custkey") % 100), p2(1 + F.col("c_custkey") % 13), p2(1 + F.col("c_nationkey")))
    return c.select("c_custkey", raw.alias("raw"), D.birth_to_iso(raw, 26).alias("birth"))


_P_FULL = "regexp_extract_all(cell, '([0-9]{4}\\.[0-9]{2}\\.[0-9]{2})', 1)"
_PERIOD_SQL = f"""select doc_id, page_no, attempt, table_no, row_no,
 case when len(ds) >= 1 then {_iso("replace(ds[1], '.', '-')")} else '' end as start_date,
 case when len(ds) >= 2 then {_iso("replace(ds[2], '.', '-')")} when contains(replace(s, ' ', ''), '근무중') then '근무중' else '' end as end_date,
 coalesce(days[1], '') as recog_days, coalesce(days[2], '') as part_days, cont
from (select *, case when len(full_d) > 0 then full_d else list_transform(regexp_extract_all(s, '([0-9]{{4}}\\.[0-9]{{2}})', 1), lambda x: x || '.01') end as ds,
   list_transform(regexp_extract_all(s, '\\(\\s*([0-9][0-9,]*)\\s*일\\s*\\)', 1), lambda x: replace(x, ',', '')) as days
  from (select *, {_P_FULL} as full_d, contains(cell, '┖→') and len({_P_FULL}) = 0 as cont, trim(replace(cell, '┖→', ' ')) as s
    from (select doc_id, page_no, attempt, table_no, row_no, cells[1] as cell from trows where cells[1] <> '')))"""


@query("period_cell", duck(_PERIOD_SQL, "trows"))
def period_cell(spark, sf):
    """R1 R2 over every filled first cell of every table and attempt."""
    keys = ["doc_id", "page_no", "attempt", "table_no", "row_no"]
    d = feeds.table_rows(spark, sf).select(*keys, F.get("cells", F.lit(0)).alias("cell")).where("cell <> ''")
    p = D.period_cell(F.col("cell"))
    return d.select(*keys, p.alias("p")).select(
        *keys, F.col("p.start").alias("start_date"), F.col("p.end").alias("end_date"),
        F.col("p.recog").alias("recog_days"), F.col("p.part").alias("part_days"), F.col("p.is_continuation").alias("cont"),
    )


@query("days_tokens", duck("""select doc_id, page_no, line_no, cast(unnest(range(0, len(a))) as int) as tok_no, unnest(a) as days
from (select doc_id, page_no, line_no, list_transform(regexp_extract_all(line, '\\(\\s*([0-9][0-9,]*)\\s*일\\s*\\)', 1), lambda x: replace(x, ',', '')) as a from lines) where len(a) > 0""", "lines"))
def days_tokens(spark, sf):
    """R2 over all page lines."""
    from recordloom.operators.lines import split_lines

    lines = split_lines(feeds.career_pages(spark, sf))
    return lines.select("doc_id", "page_no", "line_no", F.posexplode(D.days_tokens(F.col("line"))).alias("tok_no", "days"))


@query("typed_records", duck("""select rec_idx, end_kind, cast(start_d as varchar) as start_d, cast(end_d as varchar) as end_d, days from (
select rec_idx, case when end_date = '근무중' then 'ongoing' when end_date = '****-**-**' then 'masked' when end_date = '' then 'empty' else 'date' end as end_kind,
 cast(try_strptime(start_date, '%Y-%m-%d') as date) as start_d, cast(try_strptime(end_date, '%Y-%m-%d') as date) as end_d, try_cast(nullif(recog_days, '') as int) as days from careers)""", "careers"))
def typed_records(spark, sf):
    """Typed twins of the text fields."""
    c = feeds.career_records(spark, sf)
    return c.select("rec_idx", D.end_kind(F.col("end_date")).alias("end_kind"),
                    D.typed_date(F.col("start_date")).cast("string").alias("start_d"),
                    D.typed_date(F.col("end_date")).cast("string").alias("end_d"),
                    D.typed_int(F.col("recog_days")).alias("days"))


@query("masked_drop", duck("""select * from (select rec_idx, start_date, case when position = '부장' then '****-**-**' else end_date end as end_date,
 case when job_field = '' then '' else issuer end as issuer from careers)
where not (start_date = '****-**-**' and end_date = '****-**-**' and issuer = '')""", "careers"))
def masked_drop(spark, sf):
    """Masked rows without payload go."""
    d = feeds.career_records(spark, sf).select(
        "rec_idx", "start_date", F.when(F.col("position") == "부장", "****-**-**").otherwise(F.col("end_date")).alias("end_date"),
        F.when(F.col("job_field") == "", "").otherwise(F.col("issuer")).alias("issuer"))
    return C.drop_masked_placeholders(d, ("issuer",))


_CELL_SPARK = """case l_linenumber when 1 then format_number(cast(floor(l_extendedprice) as bigint), 0)
 when 2 then concat(cast(cast(l_quantity as int) as string), '.5%') when 3 then lpad(cast(l_partkey as string), 8, '0')
 when 4 then concat('2024.2.', cast(cast(l_quantity as int) as string)) when 5 then concat('=', cast(l_suppkey as string), 'm')
 when 6 then concat('-', cast(l_suppkey as string)) when 7 then case l_returnflag when 'A' then '+a' when 'R' then concat('2023-1-', cast(1 + l_suppkey % 31 as string), ' 9:05') else concat(cast(l_partkey as string), '.', cast(l_suppkey as string)) end end"""
_CELL_DUCK = """case l_linenumber when 1 then format('{:,}', cast(floor(l_extendedprice) as bigint))
 when 2 then concat(cast(cast(l_quantity as int) as string), '.5%') when 3 then lpad(cast(l_partkey as string), 8, '0')
 when 4 then concat('2024.2.', cast(cast(l_quantity as int) as string)) when 5 then concat('=', cast(l_suppkey as string), 'm')
 when 6 then concat('-', cast(l_suppkey as string)) when 7 then case l_returnflag when 'A' then '+a' when 'R' then concat('2023-1-', cast(1 + l_suppkey % 31 as string), ' 9:05') else concat(cast(l_partkey as string), '.', cast(l_suppkey as string)) end end"""
_NUM = "[+-]?([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\\.[0-9]+)?"


@query("typed_cells", f"""select raw, kind,
 case when kind in ('int', 'number') then cast(bare as double) when kind = 'percent' then cast(bare as double) / 100.0 end as num,
 case when kind = 'date' then strftime(d, '%Y-%m-%d') end as day, case when kind = 'datetime' then strftime(d, '%Y-%m-%d') || ' 09:05:00' end as stamp,
 case when kind = 'text' then esc end as txt,
 case when kind in ('int', 'number') then '#,##0' || dec when kind = 'percent' then '0' || dec || '%' when kind = 'date' then 'yyyy-mm-dd'
      when kind = 'datetime' then 'yyyy-mm-dd hh:mm' when esc <> raw or zero then '@' end as fmt
from (select *, case when esc <> raw then 'text' when stamp and d is not null then 'datetime' when stamp then 'text' when dayish and d is not null then 'date' when dayish then 'text'
   when pct then 'percent' when isnum and zero then 'text' when isnum and contains(bare, '.') then 'number' when isnum then 'int' else 'text' end as kind
 from (select *, case when regexp_matches(raw, '^[=@]') or (regexp_matches(raw, '^[+-]') and not isnum and not pct) then '''' || raw else raw end as esc,
    case when regexp_matches(bare, '\\.[0-9]+$') then '.' || repeat('0', length(regexp_extract(bare, '\\.([0-9]+)$', 1))) else '' end as dec
  from (select *, regexp_full_match(raw, '{_NUM}') as isnum, regexp_full_match(raw, '{_NUM}%') as pct, regexp_replace(raw, '[,%]', '', 'g') as bare,
     regexp_full_match(raw, '[0-9]{{4}}[./-][0-9]{{1,2}}[./-][0-9]{{1,2}}') as dayish, regexp_full_match(raw, '[0-9]{{4}}[./-][0-9]{{1,2}}[./-][0-9]{{1,2}} [0-9]{{1,2}}:[0-9]{{2}}') as stamp,
     regexp_full_match(raw, '0[0-9]+') and regexp_matches(raw, '[1-9]') as zero,
     try_cast(regexp_replace(regexp_extract(raw, '^([0-9./-]+)', 1), '[./]', '-', 'g') as date) as d
   from (select distinct {_CELL_DUCK} as raw from lineitem))))""")
def typed_cells(spark, sf):
    """C10 over cell texts made from line items."""
    raw = table(spark, sf, "lineitem").select(F.expr(_CELL_SPARK).alias("raw")).distinct()
    return raw.select("raw", typed_cell(F.col("raw")).alias("t")).select(
        "raw", "t.kind", "t.num", F.col("t.date").alias("day"), F.col("t.ts").alias("stamp"), F.col("t.text").alias("txt"), "t.fmt")


_DIRTY = """case note when '1-URGENT' then concat('기술용역 ', project_name) when '2-HIGH' then concat(project_name, ' ', job_field, ' ', duty)
 when '3-MEDIUM' then concat('가,나 ', project_name, ' ', job_field, duty, ' 일원') when '4-NOT SPECIFIED' then concat(project_name, ' 토목')
 else concat(project_name, ',보완  구간') end"""
_JOBS = "('토목','건축','기계','전기','통신','조경','환경','안전','품질','안전관리','품질관리')"


@query("name_cleanup", duck(f"""select rec_idx,
 case when contains(n3, ',') then trim(regexp_replace(regexp_replace(n3, ',(\\S)', ', \\1', 'g'), '\\s+', ' ', 'g')) else n3 end as project_name,
 case when n3 <> n2 and job_field = '' then tj else job_field end as job_field, case when n3 <> n2 and duty = '' then td else duty end as duty
from (select *, case when two then array_to_string(t[:-3], ' ') when one then array_to_string(t[:-2], ' ') else trim(regexp_replace(n2, '\\s+', ' ', 'g')) end as n3,
   case when two then t[-2] when one then t[-1] else '' end as tj, case when two then t[-1] else '' end as td
 from (select *, len(t) >= 3 and t[-2] in {_JOBS} as two, len(t) >= 2 and t[-1] in {_JOBS} as one
  from (select *, string_split(trim(regexp_replace(n2, '\\s+', ' ', 'g')), ' ') as t
   from (select rec_idx, job_field, duty, case when job_field <> '' and duty <> '' and cut <> n1 and trim(cut) <> '' then regexp_replace(regexp_replace(trim(regexp_replace(cut, '\\s+', ' ', 'g')), ',\\s*', ', ', 'g'), '\\s+,', ',', 'g') else n1 end as n2
    from (select *, case when job_field <> '' and duty <> '' then regexp_replace(n1, '(?s)^(.*)' || regexp_escape(job_field) || '\\s*' || regexp_escape(duty) || '(.*)$', '\\1\\2') else n1 end as cut
     from (select *, case when starts_with(raw, '기술용역') and length(raw) > 5 and trim(substr(raw, 5)) <> '' then trim(regexp_replace(substr(raw, 5), '\\s+', ' ', 'g')) else raw end as n1
      from (select rec_idx, job_field, duty, trim({_DIRTY}) as raw from careers)))))))""", "careers"))
def name_cleanup(spark, sf):
    """C1."""
    d = feeds.career_records(spark, sf).select("rec_idx", "job_field", "duty", F.expr(_DIRTY).alias("project_name"))
    return C.clean_project_name(d).select("rec_idx", "project_name", "job_field", "duty")


@query("work_type_from_name", duck("""select rec_idx, case when n = '' then w
 when contains(n, '상하수도') and (not contains(w, '상수도') or not contains(w, '하수')) then '상수도,하수도'
 when contains(n, '정수장') and not contains(w, '정수장') then '상수도(정수장)'
 when regexp_matches(n, '상수도|급수|배수지') and not contains(w, '상수도') then '상수도'
 when regexp_matches(n, '하수도|하수처리|하수관로') and not contains(w, '하수') then '하수도'
 when regexp_matches(n, '하천|골재|부존량|준설') and not contains(w, '하천') then '하천'
 when regexp_matches(n, '국도|지방도|도로') and not regexp_matches(w, '국도|지방도|도로') then case when contains(n, '교') then '도로,교량' else '도로' end
 when contains(n, '철도') and not contains(w, '철도') then '철도' when contains(n, '항만') and not contains(w, '항만') then '항만' else w end as work_type
from (select rec_idx, replace(project_name || case when note = '5-LOW' then ' 상하수도' when note = '2-HIGH' then '교 가설' else '' end, ' ', '') as n, work_type as w from careers)""", "careers"))
def work_type_from_name(spark, sf):
    """C2."""
    extra = F.when(F.col("note") == "5-LOW", " 상하수도").when(F.col("note") == "2-HIGH", "교 가설").otherwise("")
    c = feeds.career_records(spark, sf)
    return c.select("rec_idx", C.work_type_from_name(F.concat("project_name", extra), F.col("work_type")).alias("work_type"))


_IW = "('고속도로','국도','지방도','도로','상수도','하수도','하천','항만','철도','교량','공원')"


@query("issuer_work_type", duck(f"""select rec_idx, case when hit then '' else issuer end as issuer, case when hit then issuer else work_type end as work_type
from (select *, issuer in {_IW} and trim(work_type) = '' as hit from careers)""", "careers"))
def issuer_work_type(spark, sf):
    """C3."""
    return C.move_issuer_work_type(feeds.career_records(spark, sf)).select("rec_idx", "issuer", "work_type")


@query("field_squeeze", duck("""select rec_idx, case when length(d) - length(replace(d, '(', '')) > length(d) - length(replace(d, ')', '')) then d || ')' else d end as duty,
  trim(regexp_replace(work_type || '  ' || note, '\\s+', ' ', 'g')) as work_type
from (select rec_idx, work_type, note, trim(regexp_replace(case when note = '5-LOW' then replace(duty, ')', '') else ' ' || duty end, '\\s+', ' ', 'g')) as d from careers)""", "careers"))
def field_squeeze(spark, sf):
    """C5."""
    raw = F.when(F.col("note") == "5-LOW", F.replace(F.col("duty"), F.lit(")"), F.lit(""))).otherwise(F.concat(F.lit(" "), "duty"))
    return feeds.career_records(spark, sf).select(
        "rec_idx", C.close_duty_bracket(raw).alias("duty"), C.squeeze(F.concat("work_type", F.lit("  "), "note")).alias("work_type"))


_LABELED = "case when note = '3-MEDIUM' then '사업명 직무분야  담당업무' when note = '5-LOW' then '시설물 종류' else project_name end"


@query("label_names", duck(f"""select rec_idx, case when hit then '' else nm end as project_name
from (select *, (({" + ".join(f"cast(contains(sq, '{w}') as int)" for w in C.COLUMN_LABELS)}) >= 2 and length(sq) <= 80 or sq in ('적용 공법','시설물 종류','적용 신기술 등')) and issuer = '' and work_type = '' as hit
 from (select *, trim(regexp_replace(nm, '\\s+', ' ', 'g')) as sq from (select rec_idx, {_LABELED} as nm, issuer, case when position = '' then '' else work_type end as work_type from (select * replace (case when job_field = '' then '' else issuer end as issuer) from careers))))""", "careers"))
def label_names(spark, sf):
    """Names that are column labels."""
    c = feeds.career_records(spark, sf)
    d = c.select("rec_idx", F.expr(_LABELED).alias("project_name"), F.lit("").alias("job_field"), F.lit("").alias("duty"),
                 F.when(F.col("job_field") == "", "").otherwise(F.col("issuer")).alias("issuer"),
                 F.when(F.col("position") == "", "").otherwise(F.col("work_type")).alias("work_type"))
    return C.blank_label_names(d).select("rec_idx", "project_name")


@query("overview_names", duck("""select rec_idx, case when regexp_matches(nm, '(^|[^A-Za-z0-9])L=[0-9]+m($|[^A-Za-z])') and start_date = '' and recog_days = '' then '' else nm end as project_name
from (select rec_idx, case when note = '2-HIGH' then overview else project_name end as nm, case when start_date like '*%' or position = '부장' then '' else start_date end as start_date,
  case when position = '부장' then '' else recog_days end as recog_days from careers)""", "careers"))
def overview_names(spark, sf):
    """Overview sentences in the name of rows without period and days."""
    c = feeds.career_records(spark, sf)
    boss = F.col("position") == "부장"
    d = c.select("rec_idx", F.when(F.col("note") == "2-HIGH", F.col("overview")).otherwise(F.col("project_name")).alias("project_name"),
                 F.when(F.col("start_date").startswith("*") | boss, "").otherwise(F.col("start_date")).alias("start_date"),
                 F.when(boss, "").otherwise(F.col("recog_days")).alias("recog_days"))
    return C.blank_overview_names(d).select("rec_idx", "project_name")


_POS = "(" + ",".join(f"'{p}'" for p in C.POSITION_WORDS) + ")"


@query("shift_repair", duck(f"""select rec_idx, issuer, position, duty, job_field, case
   when job_field0 = '및' and contains(nm1, '용역') and not contains(nm1, '실시설계') then case when ends_with(nm1, '용역') then replace(nm1, '기본 용역', '기본 및 실시설계용역') else nm1 || ' 및 실시설계용역' end
   when slash then nm1 else project_name end as project_name
from (select rec_idx, case when swap then '' else issuer end as issuer, case when swap then issuer else position end as position, job_field as job_field0, project_name, slash,
   case when slash then project_name || ' ' || job_field else project_name end as nm1, case when job_field = '및' then '토목' else job_field end as job_field,
   case when job_field = '및' and duty = '실시설계' then '설계' else duty end as duty
 from (select *, issuer in {_POS} and position = '' as swap, ends_with(project_name, '/') and ends_with(job_field, '부') and job_field not in {_JOBS} as slash
  from (select rec_idx, case when job_field = '환경' then '상무보' else issuer end as issuer, position, case note when '1-URGENT' then '본사 /' when '2-HIGH' then '기본 용역' when '3-MEDIUM' then '감독 용역 일원' else project_name end as project_name,
    case note when '1-URGENT' then '감리부' when '2-HIGH' then '및' when '3-MEDIUM' then '및' else job_field end as job_field, case when duty = '계획' then '실시설계' else duty end as duty from careers)))""", "careers"))
def shift_repair(spark, sf):
    """C7."""
    c = feeds.career_records(spark, sf)
    d = c.select(
        "rec_idx", F.when(F.col("job_field") == "환경", "상무보").otherwise(F.col("issuer")).alias("issuer"), "position",
        F.expr("case note when '1-URGENT' then '본사 /' when '2-HIGH' then '기본 용역' when '3-MEDIUM' then '감독 용역 일원' else project_name end").alias("project_name"),
        F.expr("case note when '1-URGENT' then '감리부' when '2-HIGH' then '및' when '3-MEDIUM' then '및' else job_field end").alias("job_field"),
        F.when(F.col("duty") == "계획", "실시설계").otherwise(F.col("duty")).alias("duty"))
    return C.repair_shifted_fields(d)


@query("issuer_specialty", duck("""select rec_idx, specialty, case when specialty <> '' and iss = specialty then '' else iss end as issuer
from (select rec_idx, specialty, trim(regexp_replace(case when position = '부장' then ' ' || specialty else issuer end, '\\s+', ' ', 'g')) as iss from careers)""", "careers"))
def issuer_specialty(spark, sf):
    """C8."""
    c = feeds.career_records(spark, sf).withColumn(
        "issuer", F.when(F.col("position") == "부장", F.concat(F.lit(" "), "specialty")).otherwise(F.col("issuer")))
    return C.drop_issuer_equal_specialty(c).select("rec_idx", "specialty", "issuer")


_OFFICE = """select doc_id, page_no, rec_idx, start_date, end_date, recog_days, case when position = '' then '' else issuer end as issuer, work_type, specialty, position, job_field, duty,
  case note when '1-URGENT' then '본사/공사부' when '3-MEDIUM' then '단양~영월' when '4-NOT SPECIFIED' then '본사/기술' when '2-HIGH' then '본사' else project_name end as project_name from careers"""
_ISO_D = "[0-9]{4}-[0-9]{2}-[0-9]{2}"


@query("head_office", duck(f"""select rec_idx, nm as project_name, case when few then '' else issuer end as issuer, case when few then '' else specialty end as specialty,
  case when few then '' else position end as position, case when al then '' else duty end as duty
from (select *, short or part or bare as few, part or bare as al from (select *, nm = '본사' and days between 1 and 60 as bare
 from (select *, case when spans or short or part then '본사' else project_name end as nm
  from (select *, contains(project_name, '공사부') and not spans and not short and y(start_date) is not distinct from y(end_date) and y(start_date) is not null as part
   from (select *, coalesce(same and contains(project_name, '/') and issuer = '' and ni = '' and y(ns) <> y(ne), false) as spans,
      coalesce(same and contains(project_name, '~') and days between 1 and 90 and nd >= 180, false) as short
    from (select *, project_name <> '' and project_name = nn as same from (select *, coalesce(try_cast(recog_days as int), 0) as days,
       lead(project_name) over w as nn, lead(issuer) over w as ni, lead(start_date) over w as ns, lead(end_date) over w as ne, coalesce(try_cast(lead(recog_days) over w as int), 0) as nd
      from base window w as (partition by doc_id order by rec_idx))))))))""".replace("y(ns)", f"(case when regexp_full_match(ns, '{_ISO_D}') then left(ns, 4) end)")
    .replace("y(ne)", f"(case when regexp_full_match(ne, '{_ISO_D}') then left(ne, 4) end)")
    .replace("y(start_date)", f"(case when regexp_full_match(start_date, '{_ISO_D}') then left(start_date, 4) end)")
    .replace("y(end_date)", f"(case when regexp_full_match(end_date, '{_ISO_D}') then left(end_date, 4) end)"),
    "careers", extra={"base": _OFFICE}))
def head_office(spark, sf):
    """Neighbour corrections, records ordered over the whole document in chunks."""
    spark_sql = _OFFICE.replace("from careers", "from {c}")
    d = spark.sql(spark_sql, c=feeds.career_records(spark, sf))
    return C.correct_head_office(d, ["doc_id"], "rec_idx").select("rec_idx", "project_name", "issuer", "specialty", "position", "duty")
