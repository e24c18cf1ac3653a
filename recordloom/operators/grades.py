"""Grades of tables whose columns are known by order alone, and of the short text form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.grammar import best_specialty
from recordloom.functions.text import contains_any, let, squeeze
from recordloom.operators.records import GRADES
from recordloom.operators.tables import TABLE, joined

# Labels of grade tables, and words of cells without a grade.
LABELS = ["직무분야", "전문분야", "등급", "설계", "시공", "설계·시공 등", "건설사업관리", "품질관리"]
NO_GRADE = ["생략", "해당없음"]
SLOTS = ["design_job", "design_specialty", "cm_job", "cm_specialty"]
GRADE = "(" + "|".join(GRADES) + ")"


def _slots(**given: Column) -> Column:
    """struct of the nine grade fields; ``given`` are structs ``name, grade``."""
    empty = F.struct(F.lit("").alias("name"), F.lit("").alias("grade"))
    parts = [(s, F.coalesce(given[s], empty) if s in given else empty) for s in SLOTS]
    return F.struct(*[c for s, x in parts for c in (x["name"].alias(s), x["grade"].alias(s + "_grade"))], F.lit("").alias("quality_grade"))


def simple_grades(text: Column) -> Column:
    """Grades of 'job grade ** 해당없음 ** job grade', empty fields otherwise."""
    pattern = rf"([\w가-힣·]+)\s+{GRADE}\s+\*\*\s*해당없음\s*\*\*\s+([\w가-힣·]+)\s+{GRADE}"
    s = squeeze(text)
    pair = lambda i: F.struct(F.regexp_extract(s, pattern, i).alias("name"), F.regexp_extract(s, pattern, i + 1).alias("grade"))
    return _slots(design_job=pair(1), cm_job=pair(3))


def ordered_grades(cells: Column, jobs: Sequence[str], specialties: Sequence[str]) -> Column:
    """Grades of value cells from left to right: the first job and specialty are the design block's, the second ones the CM block's.

    Labels and cells without a name and a grade hold no place.
    """
    values = F.filter(F.transform(cells, lambda c: squeeze(c)), lambda c: ~c.isin(*LABELS) & ~contains_any(c, NO_GRADE) & c.rlike(rf"^.+?\s*{GRADE}"))
    pattern = rf"^(.+?)\s*{GRADE}"
    pairs = F.transform(values, lambda c: F.struct(F.trim(F.regexp_extract(c, pattern, 1)).alias("name"), F.regexp_extract(c, pattern, 2).alias("grade")))

    def place(x: Column) -> Column:
        job = F.filter(x, lambda p: p["name"].isin(*jobs))
        spec = F.filter(F.transform(F.filter(x, lambda p: ~p["name"].isin(*jobs)), lambda p: F.struct(best_specialty(p["name"], specialties).alias("name"), p["grade"].alias("grade"))), lambda p: p["name"] != "")
        return let(F.struct(job.alias("j"), spec.alias("s")), lambda y: _slots(
            design_job=F.get(y["j"], F.lit(0)), design_specialty=F.get(y["s"], F.lit(0)), cm_job=F.get(y["j"], F.lit(1)), cm_specialty=F.get(y["s"], F.lit(1))))

    return let(pairs, place)


def fill_grades(*grades: Column) -> Column:
    """The nine fields, each name with its grade from the first that has it."""
    def first(name: str) -> Column:
        out = F.struct(F.lit("").alias("name"), F.lit("").alias("grade"))
        for g in reversed(grades):
            out = F.when(g[name] != "", F.struct(g[name].alias("name"), g[name + "_grade"].alias("grade"))).otherwise(out)
        return out

    parts = [(s, first(s)) for s in SLOTS]
    quality = F.coalesce(*[F.nullif(g["quality_grade"], F.lit("")) for g in grades], F.lit(""))
    return F.struct(*[c for s, x in parts for c in (x["name"].alias(s), x["grade"].alias(s + "_grade"))], quality.alias("quality_grade"))


def grade_cells(rows: DataFrame) -> DataFrame:
    """``cells`` of the value rows of every table whose header names design and CM in one row, row after row, up to the licence section."""
    line = joined(F.col("cells"))
    w = Window.partitionBy(*TABLE)
    head = F.contains(line, F.lit("설계")) & F.contains(line, F.lit("시공")) & F.contains(line, F.lit("건설사업관리"))
    d = rows.withColumn("_h", F.min(F.when(head, F.col("row_no"))).over(w)).where("row_no > _h")
    d = d.withColumn("_e", F.min(F.when(F.contains(line, F.lit("국가기술자격")), F.col("row_no"))).over(w)).where("_e is null or row_no < _e")
    return d.groupBy(*TABLE).agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("row_no", "cells"))), lambda x: x["cells"])).alias("cells"))
