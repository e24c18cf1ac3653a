"""Output shapes: nested documents, section tables and names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.text import compact, squeeze
from recordloom.operators.scan import Running, running


def squash_newlines(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Line breaks inside the given text fields become blanks."""
    return df.select(*[squeeze(F.col(c)).alias(c) if c in fields else F.col(c) for c in df.columns])


def nested_documents(records: DataFrame, fields: Sequence[str], doc: str = "doc_id", order: str = "rec_idx", max_records: int = 100_000) -> DataFrame:
    """One object per document and part: (doc, part, n, records).

    A part holds the records of one ``max_records`` wide range of ``order``, so a
    document of any size is written whole as several bounded objects.
    """
    d = records.withColumn("part", F.floor(F.col(order) / max_records).cast("bigint"))
    g = d.groupBy(doc, "part").agg(F.sort_array(F.collect_list(F.struct(order, *fields))).alias("records"))
    return g.select(doc, "part", F.size("records").cast("bigint").alias("n"), "records")


def output_names(docs: DataFrame, name: str, date: str, order: str) -> DataFrame:
    """``name_date`` keys; the second and later documents of one key get ``_2``, ``_3`` ...

    The ordinal is carried over ranges of ``order``, so one name may be shared by any number of documents.
    """
    d = docs.withColumn("_base", F.concat_ws("_", F.regexp_replace(F.trim(F.col(name)), r'[\\/:*?"<>|]', "_"), F.col(date)))
    d = d.withColumn("_chunk", F.floor(F.col(order) / 16384)).withColumn("_one", F.lit(1))
    d = running(d, ["_base"], ["_chunk"], [order], [Running("_n", "sum", "_one")])
    key = F.when(F.col("_n") > 1, F.concat(F.col("_base"), F.lit("_"), F.col("_n").cast("string"))).otherwise(F.col("_base"))
    return d.select(*docs.columns, key.alias("output_key"))


def key_values(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(item, value) rows of object sections, in field order."""
    pairs = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(f).alias("item"), F.coalesce(F.col(f).cast("string"), F.lit("")).alias("value")) for i, f in enumerate(fields)])
    return df.select(*keys, F.explode(pairs).alias("e")).select(*keys, "e.*")


def with_placeholder(rows: DataFrame, docs: DataFrame, text_column: str, label: str = "(데이터 없음)", doc: str = "doc_id") -> DataFrame:
    """Documents without any row get one placeholder row."""
    none = docs.select(doc).distinct().join(rows.select(doc).distinct(), doc, "left_anti")
    return rows.unionByName(none.withColumn(text_column, F.lit(label)), allowMissingColumns=True)


def write_sections(sections: dict[str, DataFrame], errors: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One directory per section; the errors directory is always written, last, even when empty."""
    names = sheet_names(list(sections))
    for key, df in sections.items():
        df.write.mode(mode).format(fmt).save(f"{path}/{names[key]}")
    errors.write.mode(mode).format(fmt).save(f"{path}/errors")


def sheet_names(keys: Sequence[str]) -> dict[str, str]:
    """The sheet-name rule for a handful of section keys of the program itself."""
    used: set[str] = set()
    out: dict[str, str] = {}
    for key in keys:
        base = "".join("_" if ch in r"\/*?:[]" else ch for ch in key).strip()[:31] or "Sheet"
        name, n = base, 0
        while name in used:
            n += 1
            name = base[: 31 - len(f"_{n}")] + f"_{n}"
        used.add(name)
        out[key] = name
    return out


def sheet_base(c: Column) -> Column:
    """Forbidden characters replaced, 31 characters at most."""
    s = F.substring(F.trim(F.translate(c, r"\/*?:[]", "_______")), 1, 31)
    return F.when(s == "", "Sheet").otherwise(s)


def safe_sheet_names(titles: DataFrame, scope: Sequence[str], title: str, order: str) -> DataFrame:
    """Sheet names of a table of titles: sanitised, cut to 31, repeats numbered ``_1``, ``_2`` in order."""
    d = titles.withColumn("_b", sheet_base(F.col(title))).withColumn("_chunk", F.floor(F.col(order) / 16384)).withColumn("_one", F.lit(1))
    d = running(d, [*scope, "_b"], ["_chunk"], [order], [Running("_n", "sum", "_one")])
    suffix = F.concat(F.lit("_"), (F.col("_n") - 1).cast("string"))
    name = F.when(F.col("_n") == 1, F.col("_b")).otherwise(F.trim(F.concat(F.substr("_b", F.lit(1), F.greatest(F.lit(31) - F.length(suffix), F.lit(0))), suffix)))
    return d.select(*titles.columns, name.alias("sheet"))
