"""Lines, page metrics, date blocks and the running-value toolkit."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from recordloom.operators import lines as L
from recordloom.operators import records as R
from recordloom.operators import verify as V
from recordloom.operators.scan import Running, neighbour, running


def page(spark, lines, doc="d", no=0):
    return spark.createDataFrame([(doc, no, i, x) for i, x in enumerate(lines)], "doc_id string, page_no int, line_no bigint, line string")


CASES = [
    (["2020.01.01", "~ 참여 개요", "2021.12.31"], (1, 0, 0, 1, 6)),
    (["┖→ 이전 페이지 이어짐", "2020.01.01", "~ 항목", "근무중"], (1, 1, 0, 0, 5)),
    (["2020.01.01", "~ a", "2021.01.01", "┖→ 표 안 이어짐", "2020.06.01", "~ b", "2022.01.01"], (2, 0, 1, 2, 5)),
    (["2020.01.01", "****.**.**", "~ a", "2021.01.01"], (0, 0, 0, 0, 6)),
]


def test_page_metrics(spark):
    df = None
    for i, (lines, _) in enumerate(CASES):
        p = page(spark, lines, no=i)
        df = p if df is None else df.unionByName(p)
    got = {r.page_no: tuple(r)[2:] for r in V.page_metrics(df).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


def test_split_lines_numbers_without_gaps(spark):
    df = spark.createDataFrame([("d", 0, " a \r\n\n\tb\t c \n   \nd")], "doc_id string, page_no int, text string")
    got = [(r.line_no, r.line) for r in L.split_lines(df).orderBy("line_no").collect()]
    assert got == [(0, "a"), (1, "b c"), (2, "d")]


@pytest.mark.parametrize("section,line,drop", [
    ("tech", "Page : 3", True), ("tech", "1. 기술경력", True), ("tech", "사업명 담당업무", True), ("tech", "서울 도로 공사", False),
    ("tech", "(*는 법에 따른 표기", True), ("cm", "2. 건설사업관리 및 감리경력", True), ("cm", "1. 기술경력", False), ("tech", "(인정일)", True),
])
def test_boilerplate(spark, section, line, drop):
    assert spark.range(1).select(L.is_boilerplate(F.lit(line), section)).first()[0] is drop


def record(name, start="1996.08.02", end="1996.12.13", a="(67일)", b="(134일)"):
    return [name, start, "~ 한국도로공사 국도 토질·지질 과장", end, a, b]


def test_date_blocks_and_equal_runs(spark):
    lines = record("첫째 사업") + record("둘째 사업") + record("셋째 사업", "1996.12.26", "1997.04.30", "(10일)", "(20일)")
    blocks = R.date_blocks(page(spark, lines))
    rows = blocks.orderBy("block").collect()
    assert [(r.start_date, r.end_date, r.recog_days, r.part_days) for r in rows] == [
        ("1996-08-02", "1996-12-13", "67", "134")] * 2 + [("1996-12-26", "1997-04-30", "10", "20")]
    named = blocks.withColumn("name", F.element_at(F.array(*[F.lit(x) for x in ("첫째 사업", "둘째 사업", "셋째 사업")]), (F.col("block") + 1).cast("int")))
    m = R.merge_equal_blocks(named, ["start_date", "end_date", "recog_days", "part_days"], "name", "block").orderBy("block").collect()
    assert [(r.names, r.merged) for r in m] == [(["첫째 사업", "둘째 사업"], True), (["셋째 사업"], False)]


def test_date_block_with_wrapped_work_type(spark):
    lines = ["어떤 사업", "2001.05.01", "~ 서울시 관광휴게시설(공원.유원지", "수시설)", "2001.11.27", "(1,031일)", "(41일)"]
    r = R.date_blocks(page(spark, lines)).collect()
    assert [(x.start_date, x.end_date, x.recog_days, x.part_days) for x in r] == [("2001-05-01", "2001-11-27", "1031", "41")]


def test_date_block_without_tilde(spark):
    lines = ["사업", "2001.05.01", "2001.11.27", "(5일)", "(6일)", "끝"]
    r = R.date_blocks(page(spark, lines)).collect()
    assert [(x.start_date, x.end_date, x.recog_days, x.part_days) for x in r] == [("2001-05-01", "2001-11-27", "5", "6")]


def test_continuation_text_stops_at_next_record(spark):
    one = ["┖→ 앞쪽 개요", "다음 사업", "2020.01.01", "~ a b", "2021.01.01"]
    assert R.page_continuations(page(spark, one)).first().cont == "앞쪽 개요"
    two = ["머리", "┖→ 앞쪽 개요", "둘째 줄", "┖→ 셋째", "Page : 3", "끝"]
    assert R.page_continuations(page(spark, two)).first().cont == "앞쪽 개요\n둘째 줄\n셋째"


def test_running_equals_plain_window(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("aaaab"), i // 7, i, rnd.choice([None, None, i]), rnd.randint(0, 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, page int, n int, v int, x int").withColumn("chunk", F.floor(F.col("page") / 5))
    specs = [Running("last_v", "last", "v"), Running("sum_x", "sum", "x"), Running("max_x", "max", "x"), Running("min_x", "min", "x")]
    w = Window.partitionBy("k").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "n", F.last("v", ignorenulls=True).over(w).alias("last_v"), F.sum("x").over(w).alias("sum_x"), F.max("x").over(w).alias("max_x"), F.min("x").over(w).alias("min_x"))
    for levels in ([], ["page"], ["chunk", "page"]):
        got = running(df, ["k"], levels, ["n"], specs).select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_neighbour_equals_lead_and_lag(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3).withColumn("v", F.col("id") * 10)
    w = Window.partitionBy("k").orderBy("id")
    for step, fn in ((1, F.lead), (-1, F.lag)):
        got = neighbour(df, ["k"], "id", {"nv": "v"}, step=step, chunk_size=8).select("id", "nv").collect()
        want = df.select("id", fn("v").over(w).alias("nv")).collect()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
