"""Costly expressions are computed once per row: plans and odd inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from recordloom.operators import records as R
from recordloom.operators import tables as Tab
from recordloom.operators import text_flow as T

def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_training_row_is_not_computed_by_a_filter_too(spark, sf_dir):
    import __spark_entry__ as entry

    assert plan(entry.queries()["training_rows"](spark, sf_dir)).count("포장") == 1


def test_ranges_of_a_line_that_share_a_date_and_digits_before_a_range(spark):
    lines = [(1, 1, 0, "교육기간 과정명 교육기관명"), (1, 1, 1, "앞 2001.01.01 ~ 2001.02.02 ~ 2001.03.03 가 교육원 12001.01.01 ~ 2001.02.02 나"), (1, 1, 2, " 다 ~ 라")]
    d = T.training_texts(spark.createDataFrame(lines, "doc_id long, page_no long, line_no long, line string"))
    assert [r["text"] for r in d.collect()] == ["2001.02.02 ~ 2001.03.03 가 교육원 12001.01.01 ~ 2001.02.02 나다 ~ 라"]


def test_best_six_columns_are_those_of_the_single_steps_on_odd_cells(spark):
    head = ["참여기간", "사업명 ", None, " 비 고", "", "x"]
    rows = [(1, 1, 0, 1, 0, head + ["y"]), (1, 1, 0, 1, 1, ["2001.01.01", "​", None, "b \r\n", " ", "\tz", "1"]), (1, 1, 0, 1, 2, ["﻿", " ", None, "\n", "", "​", None]),
            (1, 2, 0, 0, 0, ["a", "b", "c"]), (1, 2, 0, 0, 1, [" ", "b", "c"]), (1, 2, 0, 0, 2, ["a\x01", " b", "c​"]), (1, 3, 0, 0, 0, ["\x01", None, "", "\x0b"])]
    d = spark.createDataFrame(rows, "doc_id long, page_no long, attempt int, table_no int, row_no int, cells array<string>")
    best = Tab.keep_best(d, Tab.best_table(Tab.career_table_score(d)))
    want = Tab.six_columns(best).join(Tab.header_start_row(d), list(Tab.TABLE)).select(*Tab.TABLE, "row_no", "cells", "header_row")
    order = lambda x: sorted((tuple(r) for r in x.collect()), key=repr)
    assert order(Tab.best_six_columns(d).select(want.columns)) == order(want) and len(order(want)) == 7


def test_rows_of_the_best_table_are_read_outside_of_arrays(spark, sf_dir):
    import __spark_entry__ as entry

    assert not [x for x in plan(entry.queries()["islands_records"](spark, sf_dir)).splitlines() if "lambda" in x and "책임정도의" in x]


def test_pages_of_a_summary_run_through_the_document_once(spark, sf_dir):
    import __spark_entry__ as entry

    assert plan(entry.queries()["summary_items"](spark, sf_dir)).count("Relation [") <= 3


def test_a_summary_ends_with_the_first_end_line_behind_a_header(spark):
    head, end = "공사종류별 인정일수 현황", "2. 건설기술진흥법령 외"
    lines = [(1, 1, 0, end), (1, 1, 1, "가 1 일"), (1, 2, 0, head), (1, 2, 1, "나 2 일"), (1, 20000, 0, "다 3 일"), (1, 20000, 1, end), (1, 20000, 2, "라 4 일"), (1, 40000, 0, head), (1, 40000, 1, "마 5 일"), (2, 1, 0, head), (2, 1, 1, "바 6 일")]
    d = R.summary_items(spark.createDataFrame(lines, "doc_id long, page_no long, line_no long, line string"))
    assert sorted((r["doc_id"], r["work_type"], r["days"]) for r in d.collect()) == [(1, "나", "2"), (1, "다", "3"), (2, "바", "6")]


def test_customers_of_one_file_are_dealt(spark, sf_dir):
    import __spark_entry__ as entry

    assert "RepartitionByExpression" in plan(entry.queries()["grade_slots"](spark, sf_dir))


def test_grade_blocks_are_cut_out_once(spark, sf_dir):
    import __spark_entry__ as entry

    assert plan(entry.queries()["grade_blocks"](spark, sf_dir)).count("국가기술자격") <= 12


def test_attempts_are_compared_without_a_join(spark, sf_dir):
    import __spark_entry__ as entry

    p = plan(entry.queries()["attempt_preview"](spark, sf_dir))
    assert "Join" not in p and p.count("Relation [") == 1


@pytest.mark.parametrize("name", ["text_fallback", "project_headers", "tilde_context"])
def test_lines_of_a_page_are_read_once(spark, sf_dir, name):
    import __spark_entry__ as entry

    p = plan(entry.queries()[name](spark, sf_dir))
    assert "Join" not in p and p.count("Relation [") == 1


@pytest.mark.parametrize("name", ["names_backward", "text_fallback"])
def test_most_of_a_line_s_grammar_is_outside_of_lambdas(spark, sf_dir, name):
    import __spark_entry__ as entry

    # 478 and 809 mentions of a lambda's variable before
    assert plan(entry.queries()[name](spark, sf_dir)).count("lambda") < 400


def test_tilde_fields_in_columns_are_those_of_the_expression(spark):
    from recordloom.functions import grammar as G
    from recordloom.plans.q_lookups import WORDS

    lines = ["~", "~ ", "~ ┖→", "부장", None, "~ 부장", "~ 시청", "~ 토질·지질 부장", "~ 시청 토질·지질", "~ 시청 부장", "~ 시청 토질·지질 부장", "~ 시청 국도 부장", "~ 시청 토질·지질 국도", "~ 시청 토목 토질·지질",
             "~ 시청 국도 토질·지질 부장", "~ 시청 토목 토질·지질 부장", "~  경기도   양주시 국도 국도 토질·지질 부장", "~ 경기도 안양시 동안구 토목 토질·지질", "~ a b c d e f", "~ 가 가 나 나 토목구조 부장", "~ 한국수자원공사 본부 댐 건설 수자원개발 과장"]
    d = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    want = {r.i: r.t for r in d.select("i", G.tilde_line(F.col("line"), WORDS).alias("t")).collect()}
    got = {r.i: r.t for r in G.with_tilde_fields(d, "line", WORDS).collect()}
    assert got == want and got[14] == ("시청", "국도", "토질·지질", "부장") and got[3] is None


def test_pages_are_cleaned_as_their_lines_are(spark):
    import random

    from recordloom.operators import lines as L

    rnd = random.Random(5)
    texts = ["".join(rnd.choice("a가b \t\n\r\x0b\f ​﻿") for _ in range(rnd.randrange(40))) for _ in range(300)] + [None, ""]
    d = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "doc_id long, page_no long, text string")
    each = d.select("doc_id", "page_no", F.posexplode(F.filter(F.transform(F.split("text", "\n"), L.line_text), lambda x: x != "")).alias("line_no", "line"))
    assert sorted(map(tuple, L.split_lines(d).collect())) == sorted(map(tuple, each.collect()))


def test_continuations_read_their_tables_a_few_times_only(spark, sf_dir):
    import __spark_entry__ as entry

    assert plan(entry.queries()["attach_continuations"](spark, sf_dir)).count("Relation [") <= 10


def test_texts_of_pages_with_and_without_records_go_to_the_record_before(spark):
    from recordloom.operators import merge as M

    rec = spark.createDataFrame([(1, 1, 10, "가", ""), (1, 1, 11, "나", ""), (1, 40000, 20, "둘째 쪽 내용 여덟 다", "앞"), (2, 5, 30, "라", "")], "doc_id long, page_no long, rec_idx long, project_name string, overview string")
    cont = spark.createDataFrame([(1, 1, "첫 쪽"), (1, 2, " "), (1, 3, "둘째 쪽 내용 여덟"), (1, 40000, "셋"), (1, 40001, "넷"), (2, 4, "다섯"), (3, 1, "여섯")], "doc_id long, page_no long, cont string")
    got = {r.rec_idx: (r.overview, r.project_name, r.cont_pages) for r in M.attach_continuations(rec, cont).collect()}
    assert got == {10: ("", "가", None), 11: ("둘째 쪽 내용 여덟\n셋", "나", [3, 40000]), 20: ("앞\n넷", "다", [40001]), 30: ("", "라", None)}
