"""Recognised-table operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators import tables as T
from recordloom.operators.cleanup import POSITION_WORDS
from recordloom.plans import feeds
from recordloom.plans.feeds import DUCK_FEEDS, duck
from recordloom.plans.registry import query

K = "doc_id, page_no, attempt, table_no"


def _any(col: str, words) -> str:
    return "(" + " or ".join(f"contains({col}, '{w}')" for w in words) + ")"


def _hits(col: str, words) -> str:
    return "(" + " + ".join(f"cast(contains({col}, '{w}') as int)" for w in words) + ")"


_LINE = "array_to_string(list_filter(cells, lambda c: c <> ''), ' ')"
DUCK_FEEDS["tlines"] = (f"select *, {_LINE} as line, len(list_filter(cells, lambda c: trim(c) <> '')) as nf, row_no <= coalesce(min(case when regexp_matches(trim(cells[1]), '^[0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}') then row_no end) over (partition by {K}), 999999) as hd from trows", ("trows",))
_SCORE = f"""select {K}, case when mc <= 2 then -10000 else b end as s1, case when mc <= 2 then mc else nh end as s2, case when mc <= 2 then nr else mc end as s3
from (select *, (case when nh >= 1 then 1200 else 0 end) + mc * 20 + nfr + (case when lft and rgt then 900 else 0 end) - (case when nh >= 2 and mc <= 4 then 900 else 0 end) - (case when note then 2500 else 0 end) as b
from (select {K}, max(len(cells)) as mc, count(*) as nr, count(*) filter (hd and {_any('line', T.TECH_TABLE_WORDS)}) as nh, count(*) filter (nf > 0) as nfr,
 bool_or(hd and contains(line, '참여기간')) as lft, bool_or(hd and contains(line, '비고')) as rgt,
 bool_or(hd and (contains(line, '※') or regexp_matches(line, '1\\.\\s*기술경력'))) or (bool_or(hd and contains(line, '책임정도의')) and bool_or(hd and contains(line, '보정계수'))) as note
from tlines group by all))"""
DUCK_FEEDS["tscore"] = (_SCORE, ("tlines",))
DUCK_FEEDS["tbest"] = (
    "select doc_id, page_no, attempt, table_no, s1, s2, s3 from (select *, row_number() over (partition by doc_id, page_no order by s1 desc, s2 desc, s3 desc, attempt, table_no) as r from tscore) where r = 1",
    ("tscore",))
_C0 = "trim(cells[1])"
DUCK_FEEDS["thead"] = (
    f"""select {K}, coalesce(min(row_no) filter (contains(t, '사업명') and (contains(t, '비고') or contains(t, '참여기간'))),
  min(row_no) filter (row_no >= 1 and nf >= 3 and not regexp_full_match({_C0}, '[0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}'))) as header_row
from (select *, replace(line, ' ', '') as t from tlines) group by all""", ("tlines",))
# The chosen tables, brought to six columns, as (row, column) pairs and row form.
_LAB = _any("replace(txt, ' ', '')", [w.replace(" ", "") for w in T.LABEL_WORDS])
DUCK_FEEDS["tcols"] = (
    f"""select {K}, col, row_number() over (partition by {K} order by col) - 1 as new_col from (
 select *, row_number() over (partition by {K} order by outer_col, label desc, fill desc, col desc) as keep_rank from (
  select *, case when col = min(col) over (partition by {K}) or col = max(col) over (partition by {K}) then 0 else 1 end as outer_col from (
   select {K}, col, count(*) filter (trim(txt) <> '') as fill, max(cast({_LAB} as int)) as label
   from (select {K}, row_no, unnest(range(0, len(cells))) as col, unnest(cells) as txt from trows) group by all) where fill > 0))
where keep_rank <= 6""", ("trows",))
DUCK_FEEDS["t6"] = (
    f"""select {K}, row_no, list(txt order by new_col) as cells from (select r.doc_id, r.page_no, r.attempt, r.table_no, r.row_no, c.new_col, coalesce(r.cells[c.col + 1], '') as txt
 from trows r join tcols c on r.doc_id = c.doc_id and r.page_no = c.page_no and r.attempt = c.attempt and r.table_no = c.table_no) group by all""", ("trows", "tcols"))
_START = "regexp_matches(cells[1], '^\\s*[0-9]{4}\\.[0-9]{2}\\.[0-9]{2}')"
DUCK_FEEDS["tblocks"] = (
    f"""select *, row_number() over (partition by {K}, block order by row_no) as rn from (
 select *, cast(sum(cast({_START} as int)) over (partition by {K} order by row_no) as bigint) as block from (
  select t6.* from t6 join tbest using (doc_id, page_no, attempt, table_no) join thead using (doc_id, page_no, attempt, table_no)
  where t6.row_no >= header_row + 4 and len(list_filter(cells, lambda c: trim(c) <> '')) > 0
   and not (trim(cells[1]) = '┖→' and len(list_filter(cells, lambda c: trim(c) <> '')) = 1))) where block > 0""", ("t6", "tbest", "thead"))


def _chosen(spark, sf):
    """Best table per page, six columns, with its header row."""
    return T.best_six_columns(feeds.table_rows(spark, sf))


def _blocks(spark, sf):
    return T.period_blocks(_chosen(spark, sf))


@query("table_score", duck(f"select {K}, s1, s2, s3 from tscore", "tscore"))
def table_score(spark, sf):
    """Tech score of every candidate table."""
    return T.career_table_score(feeds.table_rows(spark, sf))


@query("best_table", duck("select * from tbest", "tbest"))
def best_table(spark, sf):
    """First maximum per page."""
    return T.best_table(T.career_table_score(feeds.table_rows(spark, sf)))


@query("front_table_score", duck(f"""select {K}, cast(sum({_hits("replace(line, chr(10), ' ')", T.FRONT_TABLE_WORDS)}) as bigint) as s1, count(*) as s2, 0::bigint as s3
 from (select *, {_LINE} as line from front) group by all""", "front"))
def front_table_score(spark, sf):
    """Front-page scorer."""
    return T.front_table_score(feeds.front_rows(spark, sf))


@query("export_table_score", duck(f"""select {K}, cast(case when cols < 3 then -10000 else hits * 220 + cols * 25 + nfr + (case when lft and rgt then 800 else 0 end) - (case when hits >= 3 and cols <= 4 then 900 else 0 end) - (case when note then 2000 else 0 end) end as bigint) as s1,
 cast(case when cols < 3 then cols else hits end as bigint) as s2, cast(case when cols < 3 then 0 else cols end as bigint) as s3
from (select {K}, max(len(cells)) as cols, count(*) filter (nf > 0) as nfr, {" + ".join(f"cast(bool_or(hd and contains(line, '{w}')) as int)" for w in T.LABEL_WORDS)} as hits,
 bool_or(hd and contains(line, '참여기간')) as lft, bool_or(hd and contains(line, '비고')) as rgt,
 bool_or(hd and (contains(line, '※') or regexp_matches(line, '[12]\\.\\s*(기술경력|건설사업관리|감리경력)'))) or coalesce(sum(length(line)) filter (hd), 0) = 0
  or (({" + ".join(f"cast(bool_or(hd and contains(line, '{w}')) as int)" for w in T.LABEL_WORDS)}) <= 1 and length(trim(regexp_replace(string_agg(line, ' ' order by row_no) filter (hd and line <> ''), '\\s+', ' ', 'g'))) >= 80) as note
from tlines group by all)""", "tlines"))
def export_table_score(spark, sf):
    """Dump scorer."""
    return T.export_table_score(feeds.table_rows(spark, sf))


@query("cm_table_score", duck(f"""select {K}, case when mc <= 2 then -10000 else b end as s1, case when mc <= 2 then mc else nh end as s2, case when mc <= 2 then nr else mc end as s3
from (select *, (case when nh >= 1 then 1200 else 0 end) + mc * 20 + nfr + (case when lft and rgt then 900 else 0 end) - (case when nh >= 2 and mc <= 4 then 900 else 0 end) - (case when note then 2500 else 0 end) as b
from (select {K}, max(len(cells)) as mc, count(*) as nr, count(*) filter (hd and {_any('line', T.CM_TABLE_WORDS)}) as nh, count(*) filter (nf > 0) as nfr,
 bool_or(hd and contains(line, '참여기간')) as lft, bool_or(hd and contains(line, '비고')) as rgt, bool_or(hd and contains(line, '※')) as note
from tlines group by all))""", "tlines"))
def cm_table_score(spark, sf):
    """CM scorer."""
    return T.career_table_score(feeds.table_rows(spark, sf), "cm")


@query("best_setting", duck("""select doc_id, attempt, score from (select *, row_number() over (partition by doc_id order by score desc, attempt) as r from (
 select doc_id, attempt, cast(sum(base) + case when count(*) filter (base >= 400) = 2 then 10000 else 0 end as bigint) as score from (
  select t.doc_id, attempt, section, max(base) as base from (select doc_id, page_no, attempt, table_no, max(len(cells)) * 10 + count(*) filter (nf > 0) + case when bool_or(contains(line, '참여기간')) and bool_or(contains(line, '비고')) then 400 else 0 end as base from tlines group by all) t
  join (select o_custkey as doc_id, o_orderkey as page_no, case when o_orderstatus = 'P' then 'cm' else 'tech' end as section from orders) s on t.doc_id = s.doc_id and t.page_no = s.page_no group by all) group by all)) where r = 1""", "tlines"))
def best_setting(spark, sf):
    """Compare table-boundary settings over both sections."""
    from recordloom.plans.q_verify import _sections

    return T.best_setting(feeds.table_rows(spark, sf), _sections(spark, sf))


@query("header_signal", duck(f"select doc_id, page_no, bool_or({_any('line', ['수여일', '비고'])}) as has_signal from tlines group by all", "tlines"))
def header_signal(spark, sf):
    """T2."""
    return T.has_header_signal(feeds.table_rows(spark, sf), ["수여일", "비고"])


@query("header_row", duck("select * from thead", "thead"))
def header_row(spark, sf):
    """T3."""
    return T.header_start_row(feeds.table_rows(spark, sf))


@query("first_attempt", duck("select doc_id, page_no, attempt, table_no, row_no from trows join (select doc_id, page_no, min(attempt) as attempt from trows group by all) using (doc_id, page_no, attempt)", "trows"))
def first_attempt(spark, sf):
    """S5."""
    return T.first_attempt_rows(feeds.table_rows(spark, sf)).select(*T.TABLE, "row_no")


@query("six_columns", duck(f"select {K}, row_no, array_to_string(cells, '|') as cells from t6", "t6"))
def six_columns(spark, sf):
    """T4 over every table."""
    d = T.six_columns(feeds.table_rows(spark, sf))
    return d.select(*T.TABLE, "row_no", F.array_join("cells", "|").alias("cells"))


@query("cells_roundtrip", duck(f"select {K}, row_no, array_to_string(cells, '|') as cells from trows", "trows"))
def cells_roundtrip(spark, sf):
    """Cell form and back to row form."""
    d = T.cells_to_rows(T.rows_to_cells(feeds.table_rows(spark, sf)))
    return d.select(*T.TABLE, "row_no", F.array_join("cells", "|").alias("cells"))


@query("title_rows", duck(f"select {K}, row_no from tlines where not (contains(replace(line, ' ', ''), '1.기술경력') and contains(line, '책임정도의') and contains(line, '*')) and not (trim(cells[1]) = '┖→' and nf = 1)", "tlines"))
def title_rows(spark, sf):
    """T5."""
    return T.drop_title_rows(feeds.table_rows(spark, sf)).select(*T.TABLE, "row_no")


@query("clean_table", duck(f"""select {K}, row_no from (select *, coalesce(lag(b) over w, true) as pb, coalesce(bool_or(not b) over (partition by {K} order by row_no rows between 1 following and unbounded following), false) as more from (
 select *, sum(cast(h as int)) over (partition by {K} order by row_no) as seen from (select *, nf = 0 as b, nf > 0 and {_hits('line', T.LABEL_WORDS)} >= 2 as h from tlines) where b or not contains(line, '※'))
 where not (h and seen > 3) window w as (partition by {K} order by row_no)) where not (b and (pb or not more))""", "tlines"))
def clean_table(spark, sf):
    """T6."""
    return T.clean_table(feeds.table_rows(spark, sf), ["※"]).select(*T.TABLE, "row_no")


@query("islands_records", duck(f"select {K}, row_no, block, rn from tblocks", "tblocks"))
def islands_records(spark, sf):
    """Best table, six columns, rows grouped at period-start rows."""
    return _blocks(spark, sf).select(*T.TABLE, "row_no", "block", F.col("rn").cast("bigint").alias("rn"))


_GLUE = lambda r, c: f"(max(case when rn = {r + 1} then trim(cells[{c + 1}]) end))"
_EXTRA = lambda c: f"coalesce(max(case when rn = 5 then trim(cells[{c + 1}]) end), '')"
DUCK_FEEDS["tfold"] = (
    f"""select {K}, block, min(row_no) as row_no, {_GLUE(0, 0)} as period, {_GLUE(0, 1)} as project_name, {_GLUE(0, 3)} as job_field, {_GLUE(0, 4)} || {_EXTRA(4)} as duty, {_GLUE(0, 5)} as note,
 {_GLUE(1, 1)} as issuer, {_GLUE(1, 2)} || {_EXTRA(2)} as work_type, {_GLUE(1, 3)} as specialty, {_GLUE(1, 4)} as position,
 {_GLUE(2, 1)} || {_EXTRA(1)} as overview, {_GLUE(2, 3)} as resp, {_GLUE(2, 4)} as amount, {_GLUE(3, 1)} as method, {_GLUE(3, 2)} as fusion, {_GLUE(3, 3)} as newtech, {_GLUE(3, 4)} as facility
 from tblocks group by {K}, block""", ("tblocks",))


@query("block_pivot", duck(f"""select {K}, block, row_no, project_name, job_field, duty, note, issuer, work_type, specialty, position, overview, resp, amount, method, fusion, newtech, facility,
 coalesce(strftime(try_strptime(ds[1], '%Y.%m.%d'), '%Y-%m-%d'), '') as start_date, case when len(ds) >= 2 then coalesce(strftime(try_strptime(ds[2], '%Y.%m.%d'), '%Y-%m-%d'), '') when contains(period, '근무중') then '근무중' else '' end as end_date,
 coalesce(dd[1], '') as recog_days, coalesce(dd[2], '') as part_days, false as is_continuation
from (select *, regexp_extract_all(period, '[0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}') as ds, list_transform(regexp_extract_all(period, '\\(([0-9,]+)일\\)', 1), lambda x: replace(x, ',', '')) as dd from tfold)""", "tfold"))
def block_pivot(spark, sf):
    """Spilled rows folded into the four block rows, then the 19 fields."""
    return T.block_fields(T.four_row_blocks(_blocks(spark, sf)))


_CM_JOIN = "array_to_string(cells, ' ')"
_CM_FLAGS = f"""select *, not note and (n >= 2 or (n = 1 and (regexp_matches(tight, '[~〜～]') or contains(tight, '근무중') or (contains(sp, '근무') and contains(sp, '중'))))) as anchor
from (select *, regexp_replace(sp, '\\s+', '', 'g') as tight, len(regexp_extract_all(sp, '[0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}')) + len(regexp_extract_all(regexp_replace(sp, '[0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}', ' ', 'g'), '\\b[0-9]{{4}}\\.[0-9]{{2}}\\b')) as n,
  regexp_matches(trim(sp), '^[※〇○❍◦ⓞ]') or starts_with(trim(sp), '「건설') as note from (select *, {_CM_JOIN} as sp from (select t6.*, header_row from t6 join tbest using ({K}) join thead using ({K}))))"""


@query("cm_blocks", duck(f"""select {K}, row_no, block, row_number() over (partition by {K}, block order by row_no) as rn from (
 select *, cast(sum(cast(anchor as int)) over (partition by {K} order by row_no) as bigint) as block from (
  select *, coalesce(min(row_no) filter (anchor and row_no >= header_row and row_no < header_row + 12) over (partition by {K}), header_row + 4) as frm from flags)
 where row_no >= frm and trim(tight) <> '') where block > 0""", "t6", "tbest", "thead", extra={"flags": _CM_FLAGS}))
def cm_blocks(spark, sf):
    """T8 on the chosen tables."""
    d = T.cm_blocks(_chosen(spark, sf))
    return d.select(*T.TABLE, "row_no", F.col("block").cast("bigint").alias("block"), F.col("rn").cast("bigint").alias("rn"))


_STOPPED = "case when row_no >= 9 and cells[1] like '%.%~%' and len(cells) = 7 then list_concat(['업무 수행기간 ' || cells[1]], cells[2:]) else cells end"


@query("cm_cut", duck(f"""select {K}, row_no from (select *, min(row_no) filter (hit and row_no >= header_row + 4) over (partition by {K}) as cut from (
 select r.*, h.header_row, len(list_filter(c2, lambda c: regexp_matches(replace(c, ' ', ''), '^(업무수행기간|용역완성비율|인정일수현황)'))) > 0 as hit from (select *, {_STOPPED} as c2 from trows) r left join thead h using ({K}))) where cut is null or row_no < cut""", "trows", "thead"))
def cm_cut(spark, sf):
    """Pages with a stop word in a later row are cut there."""
    rows = feeds.table_rows(spark, sf)
    head = T.header_start_row(rows)
    c0 = T.cell(F.col("cells"), 0)
    stop = (F.col("row_no") >= 9) & c0.like("%.%~%") & (F.size("cells") == 7)
    marked = rows.withColumn("cells", F.when(stop, F.concat(F.array(F.concat(F.lit("업무 수행기간 "), c0)), F.slice("cells", 2, 6))).otherwise(F.col("cells")))
    return T.cut_at_stop(marked, head).select(*T.TABLE, "row_no")


@query("fixed_chunks", duck(f"""select {K}, row_no, cast((i - 1) // 4 as bigint) as chunk, cast((i - 1) % 4 + 1 as bigint) as rn from (
 select {K}, row_no, row_number() over (partition by {K} order by row_no) as i, count(*) over (partition by {K}) as n from tlines where nf > 0) where i <= n // 4 * 4""", "tlines"))
def fixed_chunks(spark, sf):
    """T12."""
    return T.fixed_chunks(feeds.table_rows(spark, sf)).select(*T.TABLE, "row_no", "chunk", "rn")


_MERGE_FIELDS = ("project_name", "issuer", "overview")


@query("continuation_merge", duck("""select doc_id, page_no, min(rec_idx) as rec_idx,
 case when tail = '' then head when trim(head) = '' then tail else trim(head || tail) end as project_name, string_agg(issuer, '' order by rec_idx) as issuer, string_agg(overview, '' order by rec_idx) as overview
from (select *, first_value(project_name) over (partition by doc_id, page_no, g order by rec_idx) as head,
  coalesce(string_agg(case when rn > 1 then trim(replace(project_name, '┖→', '')) end, '') over (partition by doc_id, page_no, g order by rec_idx rows between unbounded preceding and unbounded following), '') as tail
 from (select *, row_number() over (partition by doc_id, page_no, g order by rec_idx) as rn from (
  select *, sum(case when position = '' then 0 else 1 end) over (partition by doc_id, page_no order by rec_idx) as g from
   (select * replace (case when position = '' then '┖→ ' || project_name else project_name end as project_name) from careers)))) group by doc_id, page_no, g, head, tail""", "careers"))
def continuation_merge(spark, sf):
    """Rows marked as continuation are glued onto the record before them."""
    c = feeds.career_records(spark, sf)
    cont = F.col("position") == ""
    d = c.select("doc_id", "page_no", "rec_idx", "issuer", "overview", cont.alias("is_continuation"),
                 F.when(cont, F.concat(F.lit("┖→ "), "project_name")).otherwise(F.col("project_name")).alias("project_name"))
    return T.merge_continuations(d, _MERGE_FIELDS).drop("pages")


@query("keep_dated", duck("select rec_idx from (select rec_idx, case when start_date like '*%' then '' else start_date end as s, case when position = '' or start_date like '*%' then '' else end_date end as e from careers) where s <> '' or e <> ''", "careers"))
def keep_dated(spark, sf):
    """T14."""
    c = feeds.career_records(spark, sf)
    star = F.col("start_date").startswith("*")
    d = c.select("rec_idx", F.when(star, " ").otherwise(F.col("start_date")).alias("start_date"),
                 F.when(star | (F.col("position") == ""), "").otherwise(F.col("end_date")).alias("end_date"))
    return T.keep_dated(d).select("rec_idx")


# In the front feed a broken row carries its text in the last of four cells and the row before always ends in a filled cell.
_BROKEN_SQL = f"""select {K}, row_no, array_to_string(case when tail is null then cells when cells[4] <> '' then [cells[1], cells[2], cells[3], cells[4] || glue(cells[4]) || tail]
  else [cells[1], cells[2], cells[3] || glue(cells[3]) || tail, ''] end, '|') as cells from (
 select *, case when lead(nf) over w = 1 and (lead(cells) over w)[4] <> '' then (lead(cells) over w)[4] end as tail from (select *, len(list_filter(cells, lambda c: c <> '')) as nf from front) where nf > 0
 window w as (partition by {K} order by row_no)) where not (nf = 1 and cells[4] <> '')""".replace("glue(cells[4])", "(case when regexp_matches(cells[4], '[가-힣]$') then '' else ' ' end)").replace("glue(cells[3])", "(case when regexp_matches(cells[3], '[가-힣]$') then '' else ' ' end)")


@query("broken_rows", duck(_BROKEN_SQL, "front"))
def broken_rows(spark, sf):
    """T15 over front-page tables."""
    d = T.join_broken_rows(feeds.front_rows(spark, sf))
    return d.select(*T.TABLE, "row_no", F.array_join("cells", "|").alias("cells"))


@query("locate_columns", duck(f"select {K}, row_no, trim(cells[2]) as award_date, trim(cells[3]) as institution, trim(cells[1]) as kind from front where row_no = 13", "front"))
def locate_columns(spark, sf):
    """Award rows by header keyword, a missing keyword falls back to its default column."""
    d = T.locate_columns(
        feeds.front_rows(spark, sf), ["수여일"], {"award_date": ("수여일", 0), "institution": ("수여기관", 1), "kind": ("없는 말", 0)},
        stop=["벌점", "근무기간"])
    return d.select(*T.TABLE, "row_no", "award_date", "institution", "kind")


@query("paired_columns", duck(f"""select {K}, row_no, pair_no, l as left_text, r as right_text from (
 select {K}, row_no, 0 as pair_no, cells[1] as l, cells[2] as r from front where row_no = 17 union all select {K}, row_no, 1, cells[3], cells[4] from front where row_no = 17) where l <> '' or r <> ''""", "front"))
def paired_columns(spark, sf):
    """Side by side period/company columns."""
    return T.paired_cells(feeds.front_rows(spark, sf), "근무기간", "상호", stop=["기술경력"])


def _three_row_feed(spark, sf):
    c = feeds.career_records(spark, sf).where("project_name <> ''")
    return c.selectExpr(
        "doc_id", "page_no", "0 as attempt", "0 as table_no",
        """posexplode(array(array(project_name, '', case when job_field = '' then '토목' else job_field end, duty), array(issuer, work_type, specialty, position), array(overview, '', resp, amount),
           array(case when note = '5-LOW' then overview when note = '2-HIGH' then concat('추가 ', amount) else '' end, '', '', ''))) as (i, cells)""", "rec_idx",
    ).selectExpr("doc_id", "page_no", "attempt", "table_no", "cast(rec_idx * 5 + i as bigint) as row_no", "cells")


@query("three_row_records", duck(f"""select doc_id, page_no, 0 as attempt, 0 as table_no, rec, project_name, job_field, duty,
  issuer, work_type, specialty, position, resp, amount, overview from (
 select doc_id, page_no, cast(row_number() over (partition by doc_id, page_no order by rec_idx) as bigint) as rec, project_name, case when job_field = '' then '토목' else job_field end as job_field, duty, issuer, work_type, specialty, position, resp, amount,
  overview || case when note = '2-HIGH' then chr(10) || '추가 ' || amount else '' end as overview from careers where project_name <> '')""", "careers"))
def three_row_records(spark, sf):
    """Project, issuer and overview rows plus spilled overview text."""
    d = _three_row_feed(spark, sf)
    return T.three_row_records(d, ["참여기간", "발주자"])


_SKIP = "('기사','기능자격','기능사자격','기술사','산업기사','기능사')"


@query("split_cells", duck(f"""select doc_id, page_no, attempt, table_no, row_no, item_no, nm as name, coalesce(ds[item_no + 1], '') as date, coalesce(ns[item_no + 1], '') as number from (
 select {K}, row_no, unnest(range(0, len(names))) as item_no, unnest(names) as nm, ds, ns from (
  select {K}, row_no, list_filter(string_split(cells[2], chr(10)), lambda x: x <> '' and x not in {_SKIP}) as names, regexp_extract_all(cells[3], '[0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}') as ds, list_filter(string_split(cells[4], chr(10)), lambda x: x <> '') as ns from front where row_no = 5))""", "front"))
def split_cells(spark, sf):
    """Parallel multi-line cells of the licence rows."""
    d = T.locate_columns(feeds.front_rows(spark, sf), ["국가기술자격"], {"names": ("종목", 0), "dates": ("합격일", 1), "numbers": ("등록번호", 2)}, stop=["학력"])
    d = d.where("names <> ''")
    out = T.split_parallel_cells(d, "names", "dates", "numbers", ("기사", "기능자격", "기능사자격", "기술사", "산업기사", "기능사"))
    return out.drop("all_text")


@query("two_halves", duck("""select doc_id, page_no, row_no, 0 as half, trim(cells[1]) as period, trim(cells[2]) as company from front where row_no = 17 and trim(cells[1]) <> ''
 union all select doc_id, page_no, row_no, 1, trim(cells[3]), trim(cells[4]) from front where row_no = 17 and trim(cells[3]) <> ''""", "front"))
def two_halves(spark, sf):
    """T20."""
    from recordloom.plans.q_records import front_section

    d = front_section(spark, sf, "workplace").select("doc_id", "page_no", "row_no", *[T.cell(F.col("cells"), i).alias(f"c{i}") for i in range(4)])
    return T.two_halves(d, ["c0", "c1"], ["c2", "c3"], ["period", "company"])


_ERA_SPARK = """posexplode(array(array(concat('사업', replace(project_name, '사업명', '')), '', '토목', duty), array(case when note = '5-LOW' then '일원' when note = '2-HIGH' then '(2차)' else '' end, '', '', ''),
   array(concat('기관', issuer), work_type, specialty, '부장'), array(overview, '', resp, amount))) as (i, cells)"""


@query("line_era_records", duck("""select doc_id, page_no, 0 as attempt, 0 as table_no, cast(row_number() over (partition by doc_id, page_no order by rec_idx) as bigint) as rec,
 trim(regexp_replace('사업' || replace(project_name, '사업명', ''), '\\s+', ' ', 'g')) || case when note = '5-LOW' then case when project_name like '%)' then ' 일원' else '일원' end when note = '2-HIGH' then ' (2차)' else '' end as project_name, '토목' as job_field, duty, '기관' || issuer as issuer, work_type, specialty, '부장' as position, overview from careers""", "careers"))
def line_era_records(spark, sf):
    """T21."""
    d = feeds.career_records(spark, sf).selectExpr("doc_id", "page_no", "0 as attempt", "0 as table_no", _ERA_SPARK, "rec_idx")
    d = d.selectExpr("doc_id", "page_no", "attempt", "table_no", "cast(rec_idx * 5 + i as bigint) as row_no", "cells")
    return T.line_era_records(d, POSITION_WORDS, "(시청|군청|구청|관리청|공사|공단)")


_TEMPLATE = "(values (6, 0, 0, '참여기간(인정일)'), (6, 0, 1, '사업명'), (6, 0, 3, '직무분야'), (6, 1, 1, '발주자'), (7, 0, 0, '참여기간'), (7, 1, 1, '발주자')) as t(n_cols, header_offset, col_no, label)"


@query("table_dump", duck(f"""select {K}, row_no, c.col_no, case when w.n_cols is not null then coalesce(t.label, '') else txt end as text from (
 select {K}, row_no, nc, row_no - header_row as off, unnest(range(0, len(cells))) as col_no, unnest(cells) as txt from (select *, max(len(cells)) over (partition by {K}) as nc from trows) left join thead using ({K})) c
 left join {_TEMPLATE} on c.nc = t.n_cols and c.off = t.header_offset and c.col_no = t.col_no
 left join (select distinct n_cols, header_offset from {_TEMPLATE}) w on c.nc = w.n_cols and c.off = w.header_offset""", "trows", "thead"))
def table_dump(spark, sf):
    """T22."""
    rows = feeds.table_rows(spark, sf)
    template = spark.sql(f"select * from {_TEMPLATE}")
    return T.table_dump(rows, T.header_start_row(rows), template)


@query("attempt_preview", duck("""select p.doc_id, p.page_no, p.attempt, n_tables, n_rows, best_score, p.attempt = b.attempt as chosen
from (select doc_id, page_no, attempt, count(distinct table_no) as n_tables, count(*) as n_rows from trows group by all) p
 join (select doc_id, page_no, attempt, max(s1) as best_score from tscore group by all) s using (doc_id, page_no, attempt) join tbest b on p.doc_id = b.doc_id and p.page_no = b.page_no""", "trows", "tscore", "tbest"))
def attempt_preview(spark, sf):
    """T23."""
    return T.attempt_preview(feeds.table_rows(spark, sf))
