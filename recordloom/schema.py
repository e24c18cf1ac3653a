"""Explicit schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_s, _d, _i = T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


PAGE_TEXT = _struct(doc_id=_s, page_no=_i, text=_s)
WORDS = _struct(doc_id=_s, page_no=_i, engine_rank=_i, seq=_i, text=_s, x0=_d, x1=_d, top=_d, bottom=_d)
CELLS = _struct(doc_id=_s, page_no=_i, attempt=_i, table_no=_i, row_no=_i, col_no=_i, text=_s)
ERRORS = _struct(doc_id=_s, kind=_s, section=_s, idx=T.LongType(), page=_i, field=_s, expected=_s, actual=_s, detail=_s)

RECORD_FIELDS = [
    "project_name", "issuer", "work_type", "start_date", "end_date", "recog_days", "part_days", "job_field", "specialty", "duty",
    "resp", "position", "amount", "overview", "method", "fusion", "newtech", "facility", "note",
]
RECORD = T.StructType([T.StructField(f, _s) for f in RECORD_FIELDS])
EDUCATION = _struct(date=_s, prev_school=_s, school=_s, major=_s, degree=_s, status=_s)
TRAINING = _struct(start=_s, end=_s, course=_s, institution=_s, recognition=_s)
LICENCE = _struct(name=_s, pass_date=_s, number=_s)
AWARD = _struct(award_date=_s, institution=_s, kind=_s)
WORKPLACE = _struct(start_date=_s, end_date=_s, previous=_s, current=_s)
ROOT = _struct(
    doc_id=_s, tech=T.ArrayType(RECORD), cm=T.ArrayType(RECORD), education=T.ArrayType(EDUCATION), training=T.ArrayType(TRAINING),
    license=T.ArrayType(LICENCE), award=T.ArrayType(AWARD), workplace=T.ArrayType(WORKPLACE),
)
