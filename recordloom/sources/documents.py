"""Sources: manifest, guard, decoded tables, saved results, extraction errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom import schema as S


def manifest(spark: SparkSession, folder: str, glob: str = "*.pdf", recursive: bool = False) -> DataFrame:
    """Files of a folder without their content: (doc_id, path, length, modified); the content column is never read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(folder)
    )
    return files.select(F.sha2("path", 256).alias("doc_id"), "path", "length", F.col("modificationTime").alias("modified"))


def guard(docs: DataFrame, path: str = "path", head: str | None = "head") -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected documents: the name must end in .pdf and the first bytes must not be a zip's.

    Rejected rows carry a ``reason``.
    """
    reason = F.when(~F.lower(path).endswith(".pdf"), "not_pdf")
    if head:
        reason = reason.when(F.substring(head, 1, 2) == F.lit(b"PK"), "zip")
    d = docs.withColumn("reason", reason)
    return d.where("reason is null").drop("reason"), d.where("reason is not null")


def page_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.PAGE_TEXT).parquet(path)


def words(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.WORDS).parquet(path)


def cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.CELLS).parquet(path)


def merge_errors(*sources: DataFrame) -> DataFrame:
    """Error tables of all stages as one wide table; missing columns are null."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def reload_results(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Saved results, one nested object per document, malformed files kept in ``_corrupt_record``."""
    schema = T.StructType([*S.ROOT.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).option("multiLine", multi_line).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def section_rows(root: DataFrame, section: str) -> DataFrame:
    """Records of one section of reloaded results as rows."""
    return root.select("doc_id", F.posexplode(section).alias("rec_idx", "r")).select("doc_id", "rec_idx", "r.*")
