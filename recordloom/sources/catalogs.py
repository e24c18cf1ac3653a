"""Catalog sources.  Data files come from the caller; small word lists have defaults."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.grammar import SPECIALTIES_BY_JOB, Words, norm_work_type
from recordloom.functions.text import squeeze
from recordloom.operators.records import CHANGE_MARKERS

_TREE = "array<struct<mainCategory:string,subCategories:array<struct<subCategory:string,detailCategories:array<struct<detailCategory:string>>>>>>"


def work_types(trees: DataFrame, column: str = "json") -> DataFrame:
    """(name, norm) of every main, sub and detail category in JSON tree texts."""
    d = trees.select(F.explode_outer(F.from_json(column, _TREE)).alias("m"))
    d = d.select(F.col("m.mainCategory").alias("main"), F.explode_outer("m.subCategories").alias("s"))
    d = d.select("main", F.col("s.subCategory").alias("sub"), F.explode_outer("s.detailCategories").alias("x"))
    names = d.select(F.explode(F.array("main", "sub", F.col("x.detailCategory"))).alias("name"))
    out = names.where("name is not null").select(F.trim("name").alias("name"), norm_work_type(F.col("name")).alias("norm"))
    return out.where("norm <> ''").distinct()


def read_text_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Whole small files as (json)."""
    return spark.read.option("wholetext", True).text(list(paths)).withColumnRenamed("value", "json")


def specialties_from_json(texts: DataFrame, column: str = "json") -> DataFrame:
    """(job_field, specialty, ord) of a {job: [specialty, ...]} object; order and first spelling kept."""
    d = texts.select(F.explode(F.from_json(column, "map<string,array<string>>")).alias("job", "specs"))
    d = d.select(squeeze(F.col("job")).alias("job_field"), F.posexplode("specs").alias("ord", "specialty"))
    return _first_spelling(d)


def specialties_from_rows(rows: DataFrame, job: str, specs: str) -> DataFrame:
    """The same from spreadsheet rows whose specialty cell lists names by comma or line; header rows are dropped."""
    d = rows.where(~F.contains(F.coalesce(job, F.lit("")), F.lit("직무")) & ~F.contains(F.coalesce(specs, F.lit("")), F.lit("전문")))
    d = d.select(squeeze(F.col(job)).alias("job_field"), F.posexplode(F.split(F.coalesce(specs, F.lit("")), "[,\n]")).alias("ord", "specialty"))
    return _first_spelling(d)


def _first_spelling(d: DataFrame) -> DataFrame:
    d = d.withColumn("specialty", F.replace(squeeze(F.col("specialty")), F.lit("ㆍ"), F.lit("·"))).where("job_field <> '' and specialty <> ''")
    return d.groupBy("job_field", "specialty").agg(F.min("ord").cast("int").alias("ord"))


def default_specialties(spark: SparkSession) -> DataFrame:
    rows = [(j, s, i) for j, xs in SPECIALTIES_BY_JOB.items() for i, s in enumerate(xs)]
    return spark.createDataFrame(rows, T.StructType([T.StructField("job_field", T.StringType()), T.StructField("specialty", T.StringType()), T.StructField("ord", T.IntegerType())]))


def change_markers(markers: DataFrame | None, spark: SparkSession) -> DataFrame:
    """(pos, marker): distinct markers in first-seen order, the default list without any."""
    if markers is None:
        markers = spark.createDataFrame([(i, m) for i, m in enumerate(CHANGE_MARKERS)], "pos int, marker string")
    return markers.select("pos", F.trim("marker").alias("marker")).where("marker <> ''").groupBy("marker").agg(F.min("pos").alias("pos"))


def words_from_config(config: dict, base: Words | None = None) -> Words:
    """Word lists with the keys of ``config`` overriding the defaults one by one; blank entries are dropped."""
    base = base or Words()
    clean = lambda xs: [x.strip() for x in xs if isinstance(x, str) and x.strip()]
    names = {"duty_words": "duties", "job_field_hints": "jobs", "table_col3_position_tokens": "positions", "tilde_short_worktype_tokens": "short_work_types"}
    over = {names[k]: clean(v) for k, v in config.items() if k in names and clean(v)}
    if config.get("issuer_position_extra_tokens"):
        over["positions"] = [*over.get("positions", base.positions), *clean(config["issuer_position_extra_tokens"])]
    return replace(base, **over)


# District names shared by several cities.
AMBIGUOUS_DISTRICTS = ["중구", "동구", "서구", "남구", "북구"]


def region_prefixes(regions: DataFrame) -> DataFrame:
    """(name): province, 'province district' and every unambiguous district alone, from (province, district) rows."""
    p, d = F.trim("province"), F.trim(F.coalesce("district", F.lit("")))
    alone = F.when((F.length(d) >= 2) & ~d.isin(*AMBIGUOUS_DISTRICTS), d)
    names = regions.select(F.explode(F.array(p, F.when(d != "", F.concat(p, F.lit(" "), d)), alone)).alias("name"))
    return names.where("name is not null and name <> ''").distinct()


def licence_names(spark: SparkSession, path: str, column: str = "name") -> DataFrame:
    """(name) of a licence list file."""
    return spark.read.option("header", True).csv(path).select(F.regexp_replace(column, r"\s+", "").alias("name")).where("name <> ''").distinct()
