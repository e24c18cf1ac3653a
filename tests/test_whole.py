"""Nothing is cut: long tables, long pages, many rounds, blocks over page borders."""

import pytest
from pyspark.sql import functions as F

from recordloom.operators import fallbacks as B
from recordloom.operators import lookups as LK
from recordloom.operators import merge as M
from recordloom.operators import quality as Q
from recordloom.operators import records as R
from recordloom.operators import sections as S
from recordloom.operators import tables as T

REC = "doc_id bigint, page_no bigint, rec_idx bigint, project_name string, issuer string, specialty string, position string, work_type string"
ROW = REC.replace("rec_idx", "row_idx")


def test_every_pair_is_found(spark):
    """A chain in which each record's first choice is taken by the record before it."""
    recs = [(1, 0, i, "가나다라", "시청", f"s{i}", "", "") for i in range(6)]
    rows = [(1, 0, i, "가나다라마" + "바" * i, "시청", f"t{i}", "", f"w{i}") for i in range(6)]
    got = M.enrich_one_to_one(spark.createDataFrame(recs, REC), spark.createDataFrame(rows, ROW), ["work_type"]).collect()
    assert sorted((r.rec_idx, r.tier, r.work_type) for r in got) == [(i, 3, f"w{i}") for i in range(6)]


def test_no_placeholder_while_a_row_is_free(spark):
    recs = [(1, 0, i, "", "시청" if i < 2 else "", "", "", "") for i in range(4)]
    rows = [(1, 0, i, f"사업{i}", "시청" if i != 2 else "도청", "", "", "") for i in range(3)]
    got = {r.rec_idx: r.project_name for r in M.last_resort_names(spark.createDataFrame(recs, REC), spark.createDataFrame(rows, ROW)).collect()}
    assert got == {0: "사업0", 1: "사업1", 2: "사업2", 3: "(사업명 미상)"}


@pytest.mark.parametrize("course", ["제2기 안전 과정", "문제해결 과정"])
def test_training_course_is_not_cut(spark, course):
    d = spark.createDataFrame([(f"2020.01.02 ~ 2020.01.03 {course} 건설기술교육원",)], "t string").select(R.training_row(F.col("t")).alias("x")).first().x
    assert d.course == course and d.institution == "건설기술교육원"


def test_column_first_filled_far_down_stays(spark):
    rows = [(1, 0, 0, 0, i, ["a", "", "z"] if i < 55 else ["a", "late", "z"]) for i in range(60)]
    d = T.six_columns(spark.createDataFrame(rows, "doc_id bigint, page_no bigint, attempt int, table_no int, row_no int, cells array<string>"))
    assert d.where("row_no = 59").first().cells == ["a", "late", "z"]


def test_all_items_of_a_line(spark):
    lines = [(1, 0, 0, "공사종류별 인정일수 현황 직무/전문분야별 인정일수 현황"), (1, 0, 1, "도로 10 일 토목/토목시공 20 일 토목 / 토목시공 30 일"), (1, 0, 2, "교량 5 일 (미기재) 7 일 조경 9 일"),
             (1, 1, 0, "2. 건설기술진흥법령 외"), (1, 1, 1, "기타 1 일")]
    got = {(r.side, r.work_type, r.job_field, r.specialty): r.days for r in R.summary_items(spark.createDataFrame(lines, "doc_id bigint, page_no bigint, line_no bigint, line string")).collect()}
    assert got == {("left", "도로", "", ""): "10", ("right", "", "토목", "토목시공"): "20", ("left", "교량", "", ""): "5", ("right", "", "", "(미기재)"): "7", ("right", "", "조경", ""): "9"}


def test_licences_over_a_page_border(spark):
    lines = [(1, 0, 0, "종목 합격일"), (1, 0, 1, "토목기사 2001.01.01"), (1, 1, 0, "건축기사 2002.01.01"), (1, 1, 1, "학력"), (1, 1, 2, "조경기사 2003.01.01")]
    assert Q.expected_counts(spark.createDataFrame(lines, "doc_id bigint, page_no bigint, line_no bigint, line string")).first().n == 2


def test_long_front_matter_and_streaks(spark):
    pages = spark.createDataFrame([(1, i, "1. 기술경력" if i == 30 else "x") for i in range(40)], "doc_id bigint, page_no bigint, text string")
    assert S.front_matter(pages).count() == 31
    items = spark.createDataFrame([(1, p, "k", f"l{p}") for p in (2, 3, 6, 12)], "doc_id bigint, page_no bigint, kind string, label string")
    header = spark.createDataFrame([(1, 1)], "doc_id bigint, header_page bigint")
    last = {n: S.stop_after_no_growth(pages, items, header, n).agg(F.max("page_no")).first()[0] for n in (1, 2, 3, 9, 60)}
    assert last == {1: 0, 2: 4, 3: 8, 9: 20, 60: 39}


def test_long_work_type_suffix(spark):
    d = LK.longest_suffix(spark.createDataFrame([("청 a b c d e f",), (None,), ("",)], "t string"), "t", spark.createDataFrame([("abcdef",), ("f",)], "norm string"))
    assert {r.t: r.suffix_size for r in d.collect()} == {"청 a b c d e f": 6, None: 0, "": 0}


def test_chosen_names(spark):
    rows = [("위", ["아래"], True), ("위", ["위 ", "b"], True), ("위", ["아래"], False), ("", ["", "b"], False), ("위", [], True), (None, None, None)]
    d = spark.createDataFrame(rows, "a string, b array<string>, i boolean").select(B.choose_names(F.col("a"), F.col("b"), F.col("i")).alias("n"))
    assert [r.n for r in d.collect()] == [["위", "아래"], ["위 ", "b"], ["위"], ["b"], ["위"], []]


def test_repeated_cell_number(spark):
    cells = spark.createDataFrame([(1, 0, 0, 0, 0, 1, "b"), (1, 0, 0, 0, 0, 1, "a"), (1, 0, 0, 0, 0, 3, "d")], "doc_id bigint, page_no bigint, attempt int, table_no int, row_no int, col_no int, text string")
    assert T.cells_to_rows(cells).first().cells == ["", "a", "", "d"]


def test_headers_far_down(spark):
    """Header rows, signals, labels and anchors count wherever they stand above the first record."""
    from recordloom.operators import tables as T

    note = [["긴 설명 " + "가" * 20, "", ""]] * 60
    head = [["참여기간", "사업명", "비고"]]
    body = [["2001.01.01\n~\n2002.02.02", "제1호 공사", ""]] * 3
    rows = [(1, 1, 0, 0, n, c) for n, c in enumerate([*note, *head, *body])]
    d = spark.createDataFrame(rows, "doc_id bigint, page_no bigint, attempt int, table_no int, row_no int, cells array<string>")
    assert T.header_start_row(d).first().header_row == 60
    assert T.has_header_signal(d, ["비고"]).first().has_signal
    s = T.career_table_score(d).first()
    assert s.s2 == 1 and s.s1 == 1200 + 3 * 20 + 64 + 900
    late = spark.createDataFrame([(1, 1, 0, 0, n, c) for n, c in enumerate([*body, *head])], d.schema)
    assert T.career_table_score(late).first().s2 == 0  # behind the first record there is no head


def test_column_borders_of_a_low_header(spark):
    from recordloom.operators import layout as L

    words = [(1, 1, 0, "사업명", 100.0, 130.0, 600.0, 610.0), (1, 1, 1, "비고", 200.0, 220.0, 600.0, 610.0), (1, 1, 2, "2001.01.01", 30.0, 80.0, 620.0, 630.0), (1, 1, 3, "비고", 300.0, 320.0, 640.0, 650.0)]
    d = spark.createDataFrame(words, "doc_id bigint, page_no bigint, seq bigint, text string, x0 double, x1 double, top double, bottom double")
    assert L.column_borders(d, ["사업명", "비고"], 27.0, 560.0).first().borders == [27.0, 165.0, 560.0]
