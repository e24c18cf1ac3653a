"""Catalog lookups and the line grammar built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import grammar as G
from recordloom.operators import lookups as LK
from recordloom.operators.cleanup import DUTY_WORDS, JOB_FIELDS, POSITION_WORDS
from recordloom.operators.lines import content_lines_of_pages
from recordloom.plans import feeds
from recordloom.plans.feeds import DUCK_FEEDS, duck, table
from recordloom.plans.registry import query

# Small sample dimensions (invented), shared by both engines.
REGIONS = ["경기도", "경기도 양주시", "경기도 안양시", "용인시", "서천군", "광명시"]
INSTITUTIONS = ["한국수자원공사", "한국문학번역원", "지방국토관리청", "상수도사업소"]
WORDS = G.Words(regions=REGIONS, institutions=INSTITUTIONS)

_l = lambda xs: "(" + ",".join(f"'{x}'" for x in xs) + ")"
_values = lambda xs, cols: "(values " + ",".join(f"({i}, '{x}')" for i, x in enumerate(xs)) + f") as c({cols})"
SPECS = G.DEFAULT.specialties


def _names_df(spark, names, column="name"):
    return spark.createDataFrame([(n,) for n in names], f"{column} string")


_CAT_TEXT = "case note when '1-URGENT' then concat(specialty, ' 특급') when '2-HIGH' then concat('토목/', specialty) when '3-MEDIUM' then concat('항만및해안 ', specialty) when '4-NOT SPECIFIED' then concat(duty, ' 없음') else concat('  철도ㆍ삭도  ', job_field) end"
_BEST = f"""select x, coalesce((select name from {_values(SPECS, 'ord, name')} where contains(t, name) order by length(name) desc, ord limit 1),
  (select name from {_values(SPECS, 'ord, name')} where contains(replace(t, ' ', ''), replace(name, ' ', '')) order by length(name) desc, ord limit 1), '') as best
 from (select distinct x, replace(trim(regexp_replace(x, '\\s+', ' ', 'g')), 'ㆍ', '·') as t from texts)"""


@query("catalog_contains", duck("select rec_idx, t.x as txt, best as specialty from texts t join best b on t.x = b.x", "careers",
                                extra={"texts": f"select rec_idx, {_CAT_TEXT} as x from careers", "best": _BEST}))
def catalog_contains(spark, sf):
    """Longest specialty inside a cell, then ignoring blanks."""
    d = feeds.career_records(spark, sf).select("rec_idx", F.expr(_CAT_TEXT).alias("txt"))
    return d.withColumn("specialty", G.best_specialty(F.col("txt"), SPECS))


_SPEC_TEXT = "case note when '1-URGENT' then concat(specialty, specialty) when '2-HIGH' then '도로및공항상하수도 * 공사감독 등' when '3-MEDIUM' then concat(specialty, ' 특허 제12호') when '4-NOT SPECIFIED' then concat('립식 흙막이', cast(rec_idx % 7 + 10 as string), ' 외') else concat(specialty, ' * 감리') end"


@query("specialty_normalise", duck("""select rec_idx, t.txt, case note when '2-HIGH' then '도로및공항상하수도*공사감독' when '3-MEDIUM' then t.txt when '4-NOT SPECIFIED' then '입식 흙막이'
 when '5-LOW' then case when specialty in (select replace(name, ' ', '') from """ + _values(SPECS, "ord, name") + """) then specialty || '*감리' else b.best end else b.best end as specialty
 from t join best b on t.x = b.x""", "careers", extra={
    "t": f"select rec_idx, note, specialty, {_SPEC_TEXT} as txt, case note when '1-URGENT' then specialty else {_SPEC_TEXT} end as x from careers",
    "texts": "select x from t", "best": _BEST}))
def specialty_normalise(spark, sf):
    """C4."""
    d = feeds.career_records(spark, sf).select("rec_idx", F.expr(_SPEC_TEXT).alias("txt"))
    return d.withColumn("specialty", G.normalize_specialty(F.col("txt"), SPECS))


_WT_TEXT = "case note when '1-URGENT' then concat(work_type, ',', '도로') when '2-HIGH' then concat(work_type, ' 및 교량') when '3-MEDIUM' then concat('상수도(', work_type, ',정수장)') when '4-NOT SPECIFIED' then concat(work_type, '·없음') else work_type end"
_WT_SQL = f"""select rec_idx, txt, norm in {_l(G.SHORT_WORK_TYPES)} or (len(parts) >= 2 and len(list_filter(parts, lambda p: p not in {_l(G.SHORT_WORK_TYPES)})) = 0)
 or regexp_extract(txt, '^([^()]+)\\([^()]+\\)$', 1) in {_l(G.SHORT_WORK_TYPES)} as is_work_type
 from (select rec_idx, {_WT_TEXT} as txt, regexp_replace({_WT_TEXT}, '[ ·ㆍ.]', '', 'g') as norm,
  list_filter(list_transform(regexp_split_to_array(regexp_replace({_WT_TEXT}, '\\s*및\\s*', ',', 'g'), '[,·ㆍ/]+'), lambda p: trim(p)), lambda p: p <> '') as parts from careers)"""


@query("worktype_phrase", duck(_WT_SQL, "careers"))
def worktype_phrase(spark, sf):
    """J4 as an expression over a literal set."""
    d = feeds.career_records(spark, sf).select("rec_idx", F.expr(_WT_TEXT).alias("txt"))
    return d.withColumn("is_work_type", G.is_work_type(F.col("txt"), G.SHORT_WORK_TYPES))


@query("worktype_phrase_join", duck(_WT_SQL, "careers"))
def worktype_phrase_join(spark, sf):
    """J4 as a join, for catalogs of any size."""
    d = feeds.career_records(spark, sf).select("rec_idx", F.expr(_WT_TEXT).alias("txt"))
    return LK.work_type_phrases(d, "txt", _names_df(spark, G.SHORT_WORK_TYPES, "norm"))


_TAIL = "case note when '1-URGENT' then concat(issuer, ' ', work_type) when '2-HIGH' then concat(issuer, ' 상 수 도') else issuer end"
_SUFFIX_SQL = f"""select rec_idx, txt, case when k4 then 4 when k3 then 3 when k2 then 2 when k1 then 1 else 0 end as suffix_size,
 case when k4 then array_to_string(t[-4:], ' ') when k3 then array_to_string(t[-3:], ' ') when k2 then array_to_string(t[-2:], ' ') when k1 then t[-1] else '' end as suffix
 from (select *, {", ".join(f"len(t) >= {k} and array_to_string(t[-{k}:], '') in {_l(G.SHORT_WORK_TYPES)} as k{k}" for k in (1, 2, 3, 4))} from (
  select rec_idx, trim({_TAIL}) as txt, list_filter(string_split(trim({_TAIL}), ' '), lambda x: x <> '') as t from careers))"""


@query("worktype_suffix", duck(_SUFFIX_SQL, "careers"))
def worktype_suffix(spark, sf):
    """J5 as an equality join on exploded suffixes."""
    d = feeds.career_records(spark, sf).select("rec_idx", F.trim(F.expr(_TAIL)).alias("txt"))
    return LK.longest_suffix(d, "txt", _names_df(spark, G.SHORT_WORK_TYPES, "norm"))


@query("prefix_longest", duck(f"""select rec_idx, issuer, coalesce(list_max(list_filter(range(1, len(t) + 1), lambda k: array_to_string(t[1:k], ' ') in {_l(REGIONS)})), 0) as prefix_size
 from (select rec_idx, issuer, list_filter(string_split(issuer, ' '), lambda x: x <> '') as t from careers)""", "careers"))
def prefix_longest(spark, sf):
    """Longest region prefix."""
    d = feeds.career_records(spark, sf).select("rec_idx", "issuer")
    return LK.longest_prefix(d, "issuer", _names_df(spark, REGIONS)).withColumn("prefix_size", F.col("prefix_size").cast("bigint"))


@query("institution_prefix", duck(f"""select rec_idx, txt, coalesce(list_max(list_filter(range(1, len(t)), lambda k: len(list_filter({[x for x in INSTITUTIONS]}, lambda n: ends_with(array_to_string(t[1:k], ' '), n))) > 0)), 0) as institution_size
 from (select rec_idx, issuer || ' ' || work_type as txt, list_filter(string_split(issuer || ' ' || work_type, ' '), lambda x: x <> '') as t from careers)""", "careers"))
def institution_prefix(spark, sf):
    """Longest proper prefix ending in an institution name."""
    d = feeds.career_records(spark, sf).select("rec_idx", F.concat("issuer", F.lit(" "), "work_type").alias("txt"))
    return LK.institution_prefix(d, "txt", _names_df(spark, INSTITUTIONS)).withColumn("institution_size", F.col("institution_size").cast("bigint"))


@query("issuer_split", duck(f"""select rec_idx, case when k = 0 then txt else array_to_string(t[:-(k + 1)], ' ') end as issuer, case when k = 0 then '' else array_to_string(t[-k:], ' ') end as work_type
 from (select *, case when k4 then 4 when k3 then 3 when k2 then 2 when k1 then 1 else 0 end as k from (select *, {", ".join(f"len(t) >= {k} and array_to_string(t[-{k}:], '') in {_l(G.SHORT_WORK_TYPES)} as k{k}" for k in (1, 2, 3, 4))} from (
  select rec_idx, trim({_TAIL}) as txt, list_filter(string_split(trim({_TAIL}), ' '), lambda x: x <> '') as t from careers)))""", "careers"))
def issuer_split(spark, sf):
    """Issuer text split at its work-type suffix."""
    d = feeds.career_records(spark, sf).select("rec_idx", F.trim(F.expr(_TAIL)).alias("txt"))
    return d.select("rec_idx", G.split_issuer_work_type(F.col("txt"), G.SHORT_WORK_TYPES).alias("s")).select("rec_idx", "s.*")


_TAILW = " or ".join(f"contains(r, '{w}')" for w in G.WORK_TYPE_TAIL_WORDS)
_CELL_TEXT = "case note when '1-URGENT' then concat(issuer, ' 토공,관로공') when '2-HIGH' then concat(issuer, ' ', specialty) else issuer end"


@query("issuer_cell", duck(f"""select rec_idx, case when w2 = '' or i2 = '' then i2 when i2 = w2 then '' when ends_with(i2, w2) and trim(left(i2, length(i2) - length(w2))) <> '' then rtrim(left(i2, length(i2) - length(w2))) else i2 end as issuer, w2 as work_type
 from (select rec_idx, case when hit then array_to_string(t[:-2], ' ') else iss end as i2, case when hit then r else work_type end as w2 from (
  select *, work_type = '' and len(t) >= 2 and (contains(r, ',') or contains(r, '·') or r in {_l(G.SHORT_WORK_TYPES)} or {_TAILW}) as hit from (
   select *, t[-1] as r from (select rec_idx, work_type, trim({_CELL_TEXT}) as iss, list_filter(string_split(trim({_CELL_TEXT}), ' '), lambda x: x <> '') as t from careers))))""", "careers"))
def issuer_cell(spark, sf):
    """Last word of the issuer cell moved to an empty work type, then the overlap dropped."""
    d = feeds.career_records(spark, sf).select("rec_idx", G.split_issuer_cell(F.expr(_CELL_TEXT), F.col("work_type"), G.SHORT_WORK_TYPES).alias("s"))
    return d.select("rec_idx", G.drop_overlap(F.col("s.issuer"), F.col("s.work_type")).alias("issuer"), "s.work_type")


# --- tilde lines -------------------------------------------------------------------
_pos = lambda x: f"coalesce({x} in {_l(POSITION_WORDS)}, false)"
_sp = lambda x: f"({x} <> '' and (ends_with({x}, '구조') or contains({x}, '·') or {x} in {_l(SPECS)}))"
_sh = lambda x: f"({x} in {_l(G.SHORT_WORK_TYPES)})"
_TILDE = f"""select doc_id, page_no, line_no, r[1] as issuer, r[2] as work_type, r[3] as specialty, r[4] as position from (
 select *, case when n = 2 then case when {_pos('b')} and {_sp('a')} then ['', '', a, b] when {_sp('b')} and not {_pos('b')} then [a, '', b, ''] else [a, '', '', b] end
  when n = 3 then case when {_pos('c')} then case when {_sp('b')} then [a, '', b, c] else [a, b, '', c] end
     when {_sp('b')} then case when {_sh('c')} then [a, c, b, ''] else [a, '', b, ''] end else [a, b, c, ''] end
  when not {_pos('z')} and {_sp('z')} then [array_to_string(t[1:n - 2], ' '), y, z, '']
  else case when hn = 1 then [h[1], '', y, z] when {_sh('h[hn]')} then [array_to_string(h[1:hn - 1], ' '), h[hn], y, z] when hn = 2 then [array_to_string(h, ' '), '', y, z]
     when adm >= 2 and adm < hn then [array_to_string(h[1:adm], ' '), array_to_string(h[adm + 1:hn], ' '), y, z] when adm = hn then [array_to_string(h, ' '), '', y, z]
     when inst >= 1 then [array_to_string(h[1:inst], ' '), array_to_string(h[inst + 1:hn], ' '), y, z] else [h[1], array_to_string(h[2:hn], ' '), y, z] end end as r
 from (select *, t[1] as a, t[2] as b, t[3] as c, t[n] as z, t[n - 1] as y, len(h) as hn,
   coalesce(list_max(list_filter(range(1, len(h) + 1), lambda k: array_to_string(h[1:k], ' ') in {_l(REGIONS)})), 0) as adm,
   coalesce(list_max(list_filter(range(1, len(h)), lambda k: len(list_filter({[x for x in INSTITUTIONS]}, lambda m: ends_with(array_to_string(h[1:k], ' '), m))) > 0)), 0) as inst
  from (select *, len(t) as n, t[1:len(t) - 2] as h from (select doc_id, page_no, line_no, string_split(trim(substr(line, 2)), ' ') as t from content where starts_with(line, '~')))))"""
DUCK_FEEDS["tilde"] = (_TILDE, ("content",))


@query("tilde_grammar", duck("select doc_id, page_no, issuer, work_type, specialty, position, count(*) as n from tilde group by all", "tilde"))
def tilde_grammar(spark, sf):
    """Every ``~`` line of every page."""
    d = content_lines_of_pages(feeds.career_pages(spark, sf)).where(F.col("line").startswith("~"))
    d = d.select("doc_id", "page_no", G.tilde_line(F.col("line"), WORDS).alias("t")).select("doc_id", "page_no", "t.*")
    return d.groupBy("doc_id", "page_no", "issuer", "work_type", "specialty", "position").agg(F.count(F.lit(1)).alias("n"))


_HEAD = "concat(issuer, case when work_type = '' then '' else concat(' ', work_type) end)"


@query("token_conserve", duck(f"""select rec_idx, head, case when hn <= 1 then head when {_sh('h[hn]')} then array_to_string(h[1:hn - 1], ' ') when hn = 2 then head
   when adm >= 2 and adm < hn then array_to_string(h[1:adm], ' ') when adm = hn then head when inst >= 1 then array_to_string(h[1:inst], ' ') else h[1] end as issuer, true as conserved
 from (select *, len(h) as hn, coalesce(list_max(list_filter(range(1, len(h) + 1), lambda k: array_to_string(h[1:k], ' ') in {_l(REGIONS)})), 0) as adm,
   coalesce(list_max(list_filter(range(1, len(h)), lambda k: len(list_filter({[x for x in INSTITUTIONS]}, lambda m: ends_with(array_to_string(h[1:k], ' '), m))) > 0)), 0) as inst
  from (select rec_idx, head, case when len(h) >= 2 and h[-1] = h[-2] then h[:-2] else h end as h from (select rec_idx, trim({_HEAD}) as head, list_filter(string_split(trim({_HEAD}), ' '), lambda x: x <> '') as h from careers)))""".replace("select rec_idx, head, case when len(h) >= 2 and h[-1] = h[-2] then h[:-2] else h end as h", "select rec_idx, case when len(h) >= 2 and h[-1] = h[-2] then array_to_string(h[:-2], ' ') else head end as head, case when len(h) >= 2 and h[-1] = h[-2] then h[:-2] else h end as h"), "careers"))
def token_conserve(spark, sf):
    """The split keeps every token, in order (repeated trailing tokens count once)."""
    from recordloom.functions.text import head_tokens, join_tokens, tokens

    d = feeds.career_records(spark, sf).select("rec_idx", tokens(F.expr(_HEAD)).alias("t"))
    d = d.select("rec_idx", "t", G.split_head(F.col("t"), WORDS).alias("s"))
    n = F.size("t")
    once = F.when((n >= 2) & (F.try_element_at("t", F.lit(-1)) == F.get("t", n - 2)), head_tokens(F.col("t"), n - 1)).otherwise(F.col("t"))
    head = join_tokens(once)
    return d.select("rec_idx", head.alias("head"), "s.issuer", (F.trim(F.concat_ws(" ", "s.issuer", "s.work_type")) == head).alias("conserved"))


_J, _D = _l(JOB_FIELDS), _l(DUTY_WORDS)
_isduty = lambda x: f"({x} in {_D} or regexp_full_match({x}, '\\([^)]+\\)'))"


@query("project_line", duck(f"""select doc_id, page_no, line_no, array_to_string(t[1:p - 2], ' ') as name, t[p - 1] as job, case when t[p] = '설계담당' then '설계' else t[p] end as duty
 from (select *, case when n >= 1 and {_isduty('t[n]')} then n when n >= 2 and {_isduty('t[n - 1]')} then n - 1 when n >= 3 and {_isduty('t[n - 2]')} then n - 2 else 0 end as p
  from (select *, len(t) as n from (select doc_id, page_no, line_no, line, string_split(line, ' ') as t from lines))) where p >= 3 and t[p - 1] in {_J} and not starts_with(line, '~')""", "lines"))
def project_line(spark, sf):
    """R7: 'name job duty' lines."""
    from recordloom.operators.lines import split_lines

    d = split_lines(feeds.career_pages(spark, sf))
    return d.select("doc_id", "page_no", "line_no", G.project_line(F.col("line")).alias("p")).where("p is not null").select("doc_id", "page_no", "line_no", "p.*")


_STACK = "case when starts_with(line, '~') then trim(substr(line, 2)) else line end"


@query("stacked_lines", duck(f"""select doc_id, page_no, line_no, case when jd then case when t[1] in {_J} then t[1] else t[2] end end as job, case when jd then case when t[1] in {_J} then t[2] else t[1] end end as duty,
  case when iss then array_to_string(t[1:n - 3], ' ') end as issuer, case when iss then t[n - 2] end as work_type, case when iss then t[n - 1] end as specialty, case when iss then t[n] end as position
 from (select *, n = 2 and ((t[1] in {_J} and {_isduty('t[2]')}) or (t[2] in {_J} and {_isduty('t[1]')})) as jd, n >= 4 and t[n] in {_l(POSITION_WORDS)} as iss
  from (select *, len(t) as n from (select doc_id, page_no, line_no, string_split({_STACK}, ' ') as t from lines))) where jd or iss""", "lines"))
def stacked_lines(spark, sf):
    """Two-token job/duty lines and bare issuer lines (here also the text behind a ``~``)."""
    from recordloom.operators.lines import split_lines

    d = split_lines(feeds.career_pages(spark, sf))
    line = F.when(F.col("line").startswith("~"), F.trim(F.substr(F.col("line"), F.lit(2)))).otherwise(F.col("line"))
    d = d.select("doc_id", "page_no", "line_no", G.job_duty_line(line).alias("j"), G.issuer_line(line).alias("i")).where("j is not null or i is not null")
    return d.select("doc_id", "page_no", "line_no", "j.*", "i.*")


_LIC = ["토목기사", "토목기술사", "측량기능사", "건설안전산업기사", "조경기사", "조경기능사"]
_SUF = ["기사", "산업기사", "기능사", "기술사", "기능장"]


@query("licence_completion", f"""select p_partkey, case when x not in {_l(_LIC)} and len(f) = 1 then f[1] else x end as licence
 from (select p_partkey, x, list_filter({[s for s in _SUF]}, lambda s: x || s in {_l(_LIC)}) as g, list_transform(list_filter({[s for s in _SUF]}, lambda s: x || s in {_l(_LIC)}), lambda s: x || s) as f
  from (select p_partkey, case p_size % 5 when 0 then '토목' when 1 then '측량' when 2 then '건설안전' when 3 then '조경기사' else p_type end as x from part))""")
def licence_completion(spark, sf):
    """A licence name without its grade gets it when exactly one completion is known."""
    d = table(spark, sf, "part").select("p_partkey", F.expr("case p_size % 5 when 0 then '토목' when 1 then '측량' when 2 then '건설안전' when 3 then '조경기사' else p_type end").alias("licence"))
    return LK.complete_licence_name(d, "licence", _names_df(spark, _LIC))
