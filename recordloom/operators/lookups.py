"""Catalog lookups as joins, for catalogs too large for literals.

Catalyst broadcasts a catalog that is under the session's threshold and shuffles
one that is not; nothing here forces a broadcast.  Texts are looked up once per
distinct value and joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.functions.grammar import norm_work_type
from recordloom.functions.text import head_tokens, join_tokens, let, tail_tokens, tokens


#: Parts a text's rows are dealt to when results come back to them: a text, or no text, that a third of all rows share is spread.
SALTS = 8


def _join_back(df: DataFrame, column: str, found: DataFrame) -> DataFrame:
    """``df`` with the columns of ``found``, a row per text ``_x`` that has a result; rows without one get nulls."""
    salted = found.where("_x is not null").withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    d = df.withColumn("_s", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    return d.join(salted, (d[column] == salted["_x"]) & (d["_s"] == salted["_s"]), "left").drop("_x", "_s")


def work_type_phrases(df: DataFrame, column: str, catalog: DataFrame, out: str = "is_work_type") -> DataFrame:
    """Add ``out``: is the text a work type of ``catalog(norm)`` (same rule as ``is_work_type``)."""
    texts = df.select(F.col(column).alias("_x")).distinct()
    s = F.trim(F.coalesce(F.col("_x"), F.lit("")))
    main = F.regexp_extract(s, r"^\s*([^()]+)\s*\(\s*([^()]+)\s*\)\s*$", 1)
    parts = F.filter(
        F.transform(F.split(F.regexp_replace(s, r"\s*및\s*", ","), r"[,·ㆍ/]+"), norm_work_type), lambda p: p != "")
    probes = texts.select("_x", F.explode(F.concat(
        F.array(F.struct(F.lit("whole").alias("role"), norm_work_type(s).alias("norm"))),
        F.array(F.struct(F.lit("main").alias("role"), norm_work_type(main).alias("norm"))),
        F.transform(parts, lambda p: F.struct(F.lit("part").alias("role"), p.alias("norm"))),
    )).alias("p")).select("_x", "p.*")
    hits = probes.join(catalog.select("norm").distinct().withColumn("_hit", F.lit(1)), "norm", "left")
    found = hits.groupBy("_x").agg(
        (
            (F.count_if((F.col("role") != "part") & F.col("_hit").isNotNull()) > 0)
            | ((F.count_if(F.col("role") == "part") >= 2) & (F.count_if((F.col("role") == "part") & F.col("_hit").isNull()) == 0))
        ).alias(out))
    return _join_back(df, column, found.where(F.col(out))).withColumn(out, F.coalesce(out, F.lit(False)))


def longest_suffix(df: DataFrame, column: str, catalog: DataFrame) -> DataFrame:
    """Add ``suffix_size`` and ``suffix``: the longest tail of tokens found in ``catalog(norm)``."""
    texts = df.select(F.col(column).alias("_x")).distinct()
    # One generator makes all suffixes, so the token array is built once per text.
    tails = let(tokens(F.col("_x")), lambda t: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(t), F.lit(1))),
        lambda k: F.struct(k.alias("k"), join_tokens(tail_tokens(t, k)).alias("suffix"))))
    probes = texts.select("_x", F.explode(tails).alias("p")).select("_x", "p.*").where("suffix <> ''")
    hit = probes.withColumn("norm", norm_work_type(F.col("suffix"))).join(catalog.select("norm").distinct(), "norm", "left_semi")
    best = hit.groupBy("_x").agg(F.max(F.struct(F.col("k").alias("suffix_size"), "suffix")).alias("b")).select("_x", "b.*")
    return _join_back(df, column, best).select(
        *df.columns, F.coalesce("suffix_size", F.lit(0)).alias("suffix_size"), F.coalesce("suffix", F.lit("")).alias("suffix"))


def longest_prefix(df: DataFrame, column: str, catalog: DataFrame, out: str = "prefix_size") -> DataFrame:
    """Add the token count of the longest prefix equal to a ``catalog(name)`` (0 without one)."""
    texts = df.select(F.col(column).alias("_x")).distinct().withColumn("_t", tokens(F.col("_x"))).where(F.size("_t") > 0)
    probes = texts.select("_x", "_t", F.explode(F.sequence(F.lit(1), F.size("_t"))).alias("k")).select(
        "_x", "k", join_tokens(head_tokens(F.col("_t"), F.col("k"))).alias("name"))
    best = probes.join(catalog.select("name").distinct(), "name", "left_semi").groupBy("_x").agg(F.max("k").alias(out))
    return _join_back(df, column, best).withColumn(out, F.coalesce(out, F.lit(0)))


def institution_prefix(df: DataFrame, column: str, catalog: DataFrame, min_len: int = 5, out: str = "institution_size") -> DataFrame:
    """Add the token count of the longest proper prefix that ends with a ``catalog(name)`` of ``min_len``+ letters.

    Suffixes of each prefix are exploded, so the match is an equality join.
    """
    texts = df.select(F.col(column).alias("_x")).distinct().withColumn("_t", tokens(F.col("_x"))).where(F.size("_t") > 1)
    p = texts.select("_x", "_t", F.explode(F.sequence(F.lit(1), F.size("_t") - 1)).alias("k")).select(
        "_x", "k", join_tokens(head_tokens(F.col("_t"), F.col("k"))).alias("p")).where(F.length("p") >= min_len)
    s = p.select("_x", "k", F.explode(F.sequence(F.lit(1), F.length("p") - min_len + 1)).alias("i"), "p").select(
        "_x", "k", F.expr("substring(p, i)").alias("name"))
    names = catalog.where(F.length("name") >= min_len).select("name").distinct()
    best = s.join(names, "name", "left_semi").groupBy("_x").agg(F.max("k").alias(out))
    return _join_back(df, column, best).withColumn(out, F.coalesce(out, F.lit(0)))


def complete_licence_name(df: DataFrame, column: str, names: DataFrame, suffixes: tuple[str, ...] = ("기사", "산업기사", "기능사", "기술사", "기능장")) -> DataFrame:
    """Complete a licence name by the one suffix that makes it a catalog name; leave it when none or several do."""
    texts = df.select(F.col(column).alias("_x")).distinct()
    probes = texts.select("_x", F.explode(F.array(*[F.concat(F.regexp_replace("_x", r"\s+", ""), F.lit(s)) for s in suffixes])).alias("name"))
    known = names.select("name").distinct()
    full = probes.join(known, "name", "left_semi").groupBy("_x").agg(F.count(F.lit(1)).alias("n"), F.first("name").alias("name")).where("n = 1")
    exact = texts.join(known, texts["_x"] == known["name"], "left_semi")
    full = full.join(exact, "_x", "left_anti").select("_x", F.col("name").alias("_full"))
    return _join_back(df, column, full).withColumn(column, F.coalesce("_full", column)).drop("_full")
