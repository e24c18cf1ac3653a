"""Sources and sinks on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators import sinks as K
from recordloom.plans import feeds
from recordloom.plans.feeds import duck, table
from recordloom.plans.registry import query
from recordloom.session import run_folder
from recordloom.sources import catalogs as CT
from recordloom.sources import documents as SD


@query("input_guard", "select page_id, case when not ends_with(lower(u), '.pdf') then 'not_pdf' when starts_with(h, 'PK') then 'zip' end as reason from (select page_id, case when page_id % 3 = 0 then url else url || '.PDF' end as u, case when page_id % 5 = 0 then 'PK' else left(html, 4) end as h from pages)")
def input_guard(spark, sf):
    """Accepted and rejected inputs with the reason."""
    p = table(spark, sf, "pages").select(
        "page_id", F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(F.concat("url", F.lit(".PDF"))).alias("path"),
        F.when(F.col("page_id") % 5 == 0, "PK").otherwise(F.substring("html", 1, 4)).cast("binary").alias("head"))
    good, bad = SD.guard(p)
    return good.select("page_id", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("page_id", "reason"))


@query("merge_errors", "select doc_id, 'quality' as kind, cast(quality as varchar) as actual, null as detail from labels where quality = 0 union all select doc_id, 'lang', null, lang from documents where lang <> 'en'")
def merge_errors(spark, sf):
    """S6."""
    a = table(spark, sf, "labels").where("quality = 0").select("doc_id", F.lit("quality").alias("kind"), F.col("quality").cast("string").alias("actual"))
    b = table(spark, sf, "documents").where("lang <> 'en'").select("doc_id", F.lit("lang").alias("kind"), F.col("lang").alias("detail"))
    return SD.merge_errors(a, b)


@query("nested_documents", duck("""select doc_id, part, count(*) as n, '[' || string_agg('{"rec_idx":' || rec_idx || ',"project_name":"' || project_name || '","issuer":"' || issuer || '"}', ',' order by rec_idx) || ']' as doc_json from (select doc_id, rec_idx // 5000 as part, rec_idx, project_name, issuer from careers) group by 1, 2""", "careers"))
def nested_documents(spark, sf):
    """Nested objects, one per document and bounded part."""
    d = K.nested_documents(K.squash_newlines(feeds.career_records(spark, sf), ["project_name"]), ["project_name", "issuer"], max_records=5000)
    return d.select("doc_id", "part", "n", F.to_json("records").alias("doc_json"))


@query("output_names", "select c_custkey, b || case when n > 1 then '_' || n else '' end as output_key from (select *, row_number() over (partition by b order by c_custkey) as n from (select c_custkey, c_mktsegment || '_' || c_nationkey as b from customer))")
def output_names(spark, sf):
    """File keys with a running suffix."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").cast("string").alias("d"))
    return K.output_names(c, "c_mktsegment", "d", "c_custkey").select("c_custkey", "output_key")


@query("section_unpivot", "select c_custkey, 0 as pos, 'c_name' as item, c_name as value from customer union all select c_custkey, 1, 'c_mktsegment', c_mktsegment from customer union all select c_custkey, 2, 'c_nationkey', cast(c_nationkey as varchar) from customer")
def section_unpivot(spark, sf):
    """Object sections as (item, value) rows."""
    return K.key_values(table(spark, sf, "customer"), ["c_custkey"], ["c_name", "c_mktsegment", "c_nationkey"])


@query("section_placeholder", "select d.doc_id, case when l.doc_id is null then '(데이터 없음)' end as note, quality from documents d left join labels l on d.doc_id = l.doc_id")
def section_placeholder(spark, sf):
    """Empty sections keep one placeholder row."""
    rows = table(spark, sf, "labels").select("doc_id", F.lit(None).cast("string").alias("note"), "quality")
    return K.with_placeholder(rows, table(spark, sf, "documents"), "note")


@query("sheet_names", "select doc_id, case when n = 1 then b else trim(left(b, 31 - length('_' || (n - 1))) || '_' || (n - 1)) end as sheet from (select *, row_number() over (partition by lang, b order by doc_id) as n from (select doc_id, lang, case when s = '' then 'Sheet' else s end as b from (select doc_id, lang, left(trim(translate(source || '/' || left(text, 1), '\\/*?:[]', '_______')), 31) as s from documents)))")
def sheet_names(spark, sf):
    """Sanitised sheet names with numbered repeats per language."""
    d = table(spark, sf, "documents").select("doc_id", "lang", F.concat("source", F.lit("/"), F.substring("text", 1, 1)).alias("t"))
    return K.safe_sheet_names(d, ["lang"], "t", "doc_id").select("doc_id", "sheet")


@query("specialty_catalog", "select job_field, specialty, cast(min(ord) as int) as ord from (select p_brand as job_field, unnest(string_split(specs, ',')) as specialty, unnest(range(0, len(string_split(specs, ',')))) as ord from (select p_brand, p_name || ',' || p_type || ',' || p_name as specs from part)) group by 1, 2")
def specialty_catalog(spark, sf):
    """Listed cells to ordered distinct catalog rows."""
    p = table(spark, sf, "part").select("p_brand", F.concat_ws(",", "p_name", "p_type", "p_name").alias("specs"))
    return CT.specialties_from_rows(p, "p_brand", "specs")


@query("marker_catalog", "select trim(event_type) as marker, min(event_id) as pos from events group by 1")
def marker_catalog(spark, sf):
    """Distinct markers in first-seen order."""
    e = table(spark, sf, "events").select(F.col("event_id").alias("pos"), F.col("event_type").alias("marker"))
    return CT.change_markers(e, spark)


@query("region_catalog", "select distinct unnest([r_name, r_name || ' ' || n_name, n_name]) as name from nation join region on n_regionkey = r_regionkey")
def region_catalog(spark, sf):
    """Province, province with district, district."""
    d = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return CT.region_prefixes(d.select(F.col("r_name").alias("province"), F.col("n_name").alias("district")))


@query("work_type_catalog", "select distinct unnest([p_brand, p_type, p_name]) as name, replace(name, ' ', '') as norm from part")
def work_type_catalog(spark, sf):
    """Every level of category trees, here one JSON tree per part."""
    p = table(spark, sf, "part")
    tree = F.array(F.struct(F.col("p_brand").alias("mainCategory"), F.array(F.struct(
        F.col("p_type").alias("subCategory"), F.array(F.struct(F.col("p_name").alias("detailCategory"))).alias("detailCategories"))).alias("subCategories")))
    return CT.work_types(p.select(F.to_json(tree).alias("json")))


@query("page_source", duck("select cast(doc_id as varchar) as doc_id, cast(page_no as int) as page_no, text from career_pages", "career_pages"))
def page_source(spark, sf):
    """S3: page texts written, and read with the explicit schema."""
    path = run_folder(spark, "pages")
    feeds.career_pages(spark, sf).select(F.col("doc_id").cast("string"), F.col("page_no").cast("int"), "text").write.parquet(path)
    return SD.page_text(spark, path)


@query("manifest", "select source, cast(sum(octet_length(encode(coalesce(text, ''))) + 1) as bigint) as bytes, true as named, true as dated from documents group by 1")
def manifest(spark, sf):
    """A folder per source with its texts as lines; names, lengths and times of the files are listed, nothing is read."""
    path = run_folder(spark, "files")
    table(spark, sf, "documents").select("source", F.coalesce("text", F.lit("")).alias("text")).write.partitionBy("source").text(path)
    m = SD.manifest(spark, path, "*.txt", recursive=True)
    named = F.regexp_extract("path", r"([^/]+)\.txt$", 1)
    return m.groupBy(F.regexp_extract("path", r"source=([^/]+)/", 1).alias("source")).agg(
        F.sum("length").cast("bigint").alias("bytes"), F.bool_and(named != "").alias("named"), F.bool_and(F.col("modified").isNotNull()).alias("dated"))


@query("reload_results", duck("""select cast(doc_id as varchar) as doc_id, cast(row_number() over (partition by doc_id order by rec_idx) - 1 as int) as rec_idx, project_name, issuer, work_type, start_date, end_date, position, overview from careers""", "careers"))
def reload_results(spark, sf):
    """One JSON object per document written, read again with the explicit schema, sections back to rows."""
    from recordloom import schema as SC

    path = run_folder(spark, "results")
    c = feeds.career_records(spark, sf)
    fields = [F.col(f).cast("string").alias(f) if f in c.columns else F.lit(None).cast("string").alias(f) for f in SC.RECORD_FIELDS]
    g = c.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("rec_idx", F.struct(*fields).alias("r")))).alias("t"))
    g.select(F.col("doc_id").cast("string").alias("doc_id"), F.transform("t", lambda x: x["r"]).alias("tech")).write.json(path)
    root = SD.reload_results(spark, path).where("_corrupt_record is null")
    return SD.section_rows(root, "tech").select("doc_id", "rec_idx", "project_name", "issuer", "work_type", "start_date", "end_date", "position", "overview")


@query("token_config", duck("select rec_idx, coalesce(position in ('부장', '과장', '감리원'), false) as is_position from careers", "careers"))
def token_config(spark, sf):
    """Position words from a configuration, with extra ones, used on every record."""
    from recordloom.functions.grammar import is_position

    words = CT.words_from_config({"table_col3_position_tokens": ["부장", " 과장 ", "", 7], "issuer_position_extra_tokens": ["감리원"], "unknown": ["x"]})
    return feeds.career_records(spark, sf).select("rec_idx", F.coalesce(is_position(F.col("position"), words), F.lit(False)).alias("is_position"))


@query("licence_names", "select distinct replace(p_name, ' ', '') as name from part where p_name <> ''")
def licence_names(spark, sf):
    """A list file with a header line."""
    path = run_folder(spark, "names")
    table(spark, sf, "part").select(F.col("p_name").alias("name"), "p_brand").write.option("header", True).csv(path)
    return CT.licence_names(spark, path)


@query("write_sections", duck("""select 'tech' as section, cast(rec_idx as varchar) as id from careers union all select 'labels_quality', cast(doc_id as varchar) from labels union all select 'errors', cast(doc_id as varchar) from labels where quality = 0""", "careers"))
def write_sections(spark, sf):
    """A folder per section, errors last; read back."""
    path = run_folder(spark, "sections")
    labels = table(spark, sf, "labels")
    parts = {"tech": feeds.career_records(spark, sf).select(F.col("rec_idx").cast("string").alias("id")), "labels/quality": labels.select(F.col("doc_id").cast("string").alias("id"))}
    K.write_sections(parts, labels.where("quality = 0").select(F.col("doc_id").cast("string").alias("id")), path)
    names = {**K.sheet_names(list(parts)), "errors": "errors"}
    out = [spark.read.parquet(f"{path}/{n}").select(F.lit(n).alias("section"), "id") for n in names.values()]
    return out[0].unionAll(out[1]).unionAll(out[2])
