"""Tilde lines, catalogs, training rows, company texts and awards."""

import pytest
from pyspark.sql import functions as F

from recordloom.functions import grammar as G
from recordloom.functions.dates import period_cell
from recordloom.functions.typed_cells import typed_cell
from recordloom.operators import dedup as D
from recordloom.operators import records as R

WORDS = G.Words(regions=["경기도", "경기도 안양시", "경기도 양주시"], institutions=["한국문학번역원"])
TILDE = [
    ("~ 용인시 상수도사업소 상수도 조경계획", ("용인시 상수도사업소", "상수도", "조경계획", "")),
    ("~ 한국도로공사 국도 토질·지질", ("한국도로공사", "국도", "토질·지질", "")),
    ("~ 한국도로공사 토질·지질", ("한국도로공사", "", "토질·지질", "")),
    ("~ 경기도 양주시 공원 조경계획 부장", ("경기도 양주시", "공원", "조경계획", "부장")),
    ("~ 고양시청 단지조성 단지조성 조경계획 부장", ("고양시청", "단지조성", "조경계획", "부장")),
    ("~ 대전지방국토관리청 국도 도로및공항 사원", ("대전지방국토관리청", "국도", "도로및공항", "사원")),
    ("~ 경기도 안양시 동안구 도시개발공사 기타시설 조경계획 사원", ("경기도 안양시", "동안구 도시개발공사 기타시설", "조경계획", "사원")),
    ("~ 한국문학번역원 기획실 기타시설 조경계획 사원", ("한국문학번역원", "기획실 기타시설", "조경계획", "사원")),
    ("~ 광명시 조경 조경계획 대리", ("광명시", "", "조경계획", "대리")),
    ("~ 조경계획 대리", ("", "", "조경계획", "대리")),
    ("~ 사원", ("", "", "", "사원")),
    ("~", ("", "", "", "")),
]


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


@pytest.mark.parametrize("line,want", TILDE)
def test_tilde_line(spark, line, want):
    assert tuple(one(spark, G.tilde_line(F.lit(line), WORDS))) == want


def test_tilde_conserves_tokens(spark):
    heads = ["가", "가 나", "가 나 다 라", "경기도 안양시 도로", "경기도", "서울 국도 국도"]
    for h in heads:
        s = one(spark, G.split_head(F.split(F.lit(h), " "), WORDS))
        toks = h.split()
        while len(toks) > 1 and toks[-1] == toks[-2]:
            toks.pop()
        assert f"{s.issuer} {s.work_type}".strip() == " ".join(toks)


def test_issuer_work_type_overlap(spark):
    assert one(spark, G.drop_overlap(F.lit("서천군 관광지"), F.lit("관광지"))) == "서천군"
    s = one(spark, G.split_issuer_cell(F.lit("한국수자원공사 토공,관로공,상·하수도공"), F.lit(""), G.SHORT_WORK_TYPES))
    assert tuple(s) == ("한국수자원공사", "토공,관로공,상·하수도공")


@pytest.mark.parametrize("text,want", [("도로,교량", True), ("도로 및 교량", True), ("도로,없음", False), ("상수도(정수장)", True), ("", False), ("상 수 도", True)])
def test_work_type(spark, text, want):
    assert one(spark, G.is_work_type(F.lit(text), G.SHORT_WORK_TYPES)) is want


@pytest.mark.parametrize("text,want", [
    ("토목구조토목구조", "토목구조"), ("도로및공항상하수도 * 공사감독", "도로및공항상하수도*공사감독"), ("토질·지질 특급", "토질·지질"),
    ("항만및해안", "항만 및 해안"), ("특허 제12호 공법", "특허 제12호 공법"), ("립식 흙막이 23호", "입식 흙막이"), ("", ""),
])
def test_specialty(spark, text, want):
    assert one(spark, G.normalize_specialty(F.lit(text), G.DEFAULT.specialties)) == want


def test_training_row(spark):
    t = one(spark, R.training_row(F.lit("2023.06.23 ~ 2023.08.14 건설사업관리기술인 승급 전문교육 경복대학교 건설사업관리")))
    assert tuple(t) == ("2023-06-23", "2023-08-14", "건설사업관리기술인 승급 전문교육", "경복대학교", "건설사업관리")
    assert one(spark, R.training_row(F.lit("과정만 있는 줄"))) is None


@pytest.mark.parametrize("text,want", [
    ("(주)A 흡수합병 : (주)B", ("(주)A", "(주)B")), ("(주)A 現:(주)B", ("(주)A", "(주)B")), ("(주)A :(주)B", ("(주)A", "(주)B")),
    ("(주)A", ("", "(주)A")), ("(주)A 2016.07.24 :(주)B", ("(주)A 2016.07.24", "(주)B")),
])
def test_company_split(spark, text, want):
    assert tuple(one(spark, R.company_split(F.lit(text)))) == want


@pytest.mark.parametrize("cell,want", [
    ("1996.03.14\n~\n1996.04.23\n(31일)\n(41일)", ("1996-03-14", "1996-04-23", "31", "41", False)),
    ("2020.01 ~ 2020.03 (1,031일)", ("2020-01-01", "2020-03-01", "1031", "", False)),
    ("2020.02.30 ~ 근무 중", ("", "근무중", "", "", False)), ("┖→ 연장", ("", "", "", "", True)),
])
def test_period_cell(spark, cell, want):
    assert tuple(one(spark, period_cell(F.lit(cell)))) == want


@pytest.mark.parametrize("text,kind,num,fmt", [
    ("1,234", "int", 1234.0, "#,##0"), ("12.5%", "percent", 0.125, "0.0%"), ("00123", "text", None, "@"), ("2024.2.30", "text", None, None),
    ("2024.2.3", "date", None, "yyyy-mm-dd"), ("=3,320m", "text", None, "@"), ("-5", "int", -5.0, "#,##0"), ("+a", "text", None, "@"), ("1.50", "number", 1.5, "#,##0.00"),
])
def test_typed_cell(spark, text, kind, num, fmt):
    t = one(spark, typed_cell(F.lit(text)))
    assert (t.kind, t.num, t.fmt) == (kind, num, fmt)


def brute_lcs(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            m[i + 1][j + 1] = m[i][j] + 1 if x == y else max(m[i][j + 1], m[i + 1][j])
    return m[-1][-1]


@pytest.mark.parametrize("a,b", [("가나다라", "나라가"), ("abcde", "ace"), ("", "x"), ("같다", "같다"), ("xy", "zz")])
def test_lcs(spark, a, b):
    assert one(spark, D.lcs_length(F.lit(a), F.lit(b))) == brute_lcs(a, b)


@pytest.mark.parametrize("text,want", [
    ("상훈 표창장[제12호]", "표창장[제12호]"), ("장관 표창장[제 1 호", "표창장[제1호]"), ("표창장[제99-2 30호]", "표창장[제99-230호]"),
    ("표창장[가] 감사장[나] 표창장[가] 감사장[나]", "표창장[가] 감사장[나]"), ("표창장[국토교통부장관상] 국토교통부장관", "표창장[국토교통부장관상]"), ("", ""),
])
def test_award_text(spark, text, want):
    assert one(spark, D.normalize_award_text(F.lit(text))) == want


def test_text_functions_name_their_argument_once(spark):
    """Inside a lambda every further mention computes the argument again, and mentions multiply."""
    from recordloom.functions import grammar as G
    from recordloom.functions.text import clean_blanks, compact, squeeze, tokens
    from recordloom.operators.lines import line_text
    from recordloom.operators.template_blocks import name_points

    for f in (clean_blanks, squeeze, compact, tokens, line_text, G.is_technical_line, G.job_duty_line, name_points):
        assert str(f(F.col("argument_"))).count("argument_") == 1, f.__name__


def test_blanks_of_all_kinds(spark):
    from recordloom.functions.text import compact, squeeze, tokens
    from recordloom.operators.lines import line_text

    texts = ["  a   b\tc​ d﻿ ", "a ​ b", " ", None, "x\x0by", "가 나"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    t = F.col("t")
    got = d.orderBy("i").select(squeeze(t), compact(t), tokens(t), line_text(t)).collect()
    assert [r[0] for r in got] == ["a b c d", "a b", "", "", "x y", "가 나"]
    assert [r[1] for r in got] == ["abcd", "ab", "", "", "xy", "가나"]
    assert [r[2] for r in got] == [["a", "b", "c", "d"], ["a", "b"], [], [], ["x", "y"], ["가", "나"]]
    assert [r[3] for r in got] == ["a b c d", "a b", "", "", "x\x0by", "가 나"]
