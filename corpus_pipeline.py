"""From raw documents to packed training sequences: line cleaning, near copies, long repeats, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept;
its result is written as Parquet and read again as the next one's documents.  All
but the last return the columns of documents; a stage that changes texts brings
``n_chars`` along.  Extra columns are carried through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.common import positional, written
from recordloom.llm.gray_simhash import keep_one
from recordloom.llm.line_rules import line_rules
from recordloom.llm.pack_hist import pack, token_pieces
from recordloom.llm.queries import table, tokenizer_path
from recordloom.llm.run_index import remove_repeats
from recordloom.llm.template_decon import without_contaminated


def _with_text(rows: DataFrame, columns: list[str], text: Callable[[dict[str, str]], Column]) -> DataFrame:
    """The first columns of ``rows``, named ``columns``, with a new text and its length."""
    d, where = positional(rows)
    new = text(where)
    cols = []
    for i, name in enumerate(columns):
        c = F.col(f"_c{i}")
        if where[name] == f"_c{i}":
            c = new if name == "text" else F.length(new).cast("bigint") if name == "n_chars" else c
        cols.append(c.alias(f"_c{i}"))
    return d.select(*cols).toDF(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that fail the base rules or lose too much go."""
    r = line_rules(docs, result="_rules")
    return _with_text(r.where(F.col("_rules.kept")), docs.columns, lambda at: F.col(at["_rules"])["clean"])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by SimHash fingerprints within two bits or by a five-word-shingle similarity of 0.8 or more one stays, that with the smallest id."""
    return keep_one(docs, shingle=5, similarity=0.8)


def long_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings of 400 bytes and repeated passages of over 50 words go; a character that a border cuts in half goes whole.  Every document stays, if need be with an empty text."""
    r = remove_repeats(docs, words=51)

    def text(at: dict[str, str]) -> Column:
        kept = F.replace(F.make_valid_utf8(F.col(f"_c{len(docs.columns)}").cast("string")), F.lit("�"), F.lit(""))
        return F.when(F.col(f"_c{len(docs.columns) + 1}") > 0, kept).otherwise(F.col(at["text"]))

    return _with_text(r, docs.columns, text)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark text is found go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their sequences."""
    p = token_pieces(docs, tokenizer_path("word_bpe_49k.json"))
    return pack(p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_copies),
    ("long repeats", long_repeats),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL cannot say SimHash components or tokens; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
