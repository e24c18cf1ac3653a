"""Records over several lines, rows and pages next to plain versions in loops."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from recordloom.operators import award_rows as A
from recordloom.operators import name_parts as N
from recordloom.operators import records as R
from recordloom.operators import template_blocks as B
from recordloom.operators import text_flow as T
from recordloom.operators import workplaces as W

LINES = "doc_id bigint, page_no bigint, line_no bigint, line string"


def pages(spark, docs):
    """Lines of ``docs``: a list of lines per page, one document each."""
    rows = [(d, 1, n, x) for d, lines in enumerate(docs) for n, x in enumerate(lines)]
    return spark.createDataFrame(rows, LINES)


# --- torn names
def plain_gain(a, b):
    lone = lambda x: re.fullmatch("[가-힣]", x) and x not in N.PARTICLES
    if a not in N.PARTICLES and b not in N.PARTICLES and any(
            (a.endswith(w[0]) and b.startswith(w[1:])) or (len(w) > 2 and a.endswith(w[:-1]) and b.startswith(w[-1])) for w in N.NAME_WORDS):
        return N.WHOLE_WORD
    if lone(a) and lone(b):
        return N.LONE_PAIR
    if a not in N.PARTICLES and lone(b) and re.search("[가-힣A-Za-z0-9)]$", a):
        return N.LONE_LEFT
    return None


def plain_score(toks, glue):
    score = 0
    for i, g in enumerate(glue):
        if not g:
            continue
        w = plain_gain(toks[i], toks[i + 1])
        if w is None:
            return None
        score += w
        if i and glue[i - 1]:
            leftish = len(toks[i - 1]) != 1 and len(toks[i]) == 1
            score -= N.TORN_TWICE if leftish and len(toks[i]) == 1 else 0 if len(toks[i]) == 1 else N.BOTH_SIDES
    return score


def test_names_are_glued_best(spark):
    rng = random.Random(1)
    parts = ["건", "설", "공사", "사", "업", "국도", "및", "실", "시설계", "설계", "기본계", "획", "용역", "포", "장공사", "제3호", "교량(", "A", "대", "장작성"]
    names = [" ".join(rng.choice(parts) for _ in range(rng.randint(1, 7))) for _ in range(300)] + ["", "하나"]
    got = [r.x for r in spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").repartition(4).select("i", N.rejoin_name(F.col("n")).alias("x")).orderBy("i").collect()]
    for name, x in zip(names, got, strict=True):
        assert x.replace(" ", "") == name.replace(" ", "")
        toks = name.split()
        best = max((s for g in itertools.product([False, True], repeat=max(len(toks) - 1, 0)) if (s := plain_score(toks, g)) is not None), default=0)
        # the gluing that came out is one of the best
        glue, rest = [], x
        for t in toks:
            rest = rest[len(t):]
            glue.append(not rest.startswith(" "))
            rest = rest.lstrip(" ")
        assert plain_score(toks, glue[:-1]) == best, (name, x)


# --- text alone
def plain_record(kinds):
    state, out = T.START, {f: "" for f in T.FIELDS}
    more = []
    for k, line in kinds:
        state, field = T.TRANSITIONS[state][k]
        if field == "more":
            more += [] if k == "arrow" else [line]
        elif field:
            out[field] = line
    return out, more


def test_records_follow_the_transition_table(spark):
    rng = random.Random(2)
    text = {"date": "2001.02.03", "arrow": "┖→", "tilde": "~ 한국도로공사 국도 토질·지질 부장", "days": "(12일)", "mask": "****.**.**", "text": "- 개요 본문"}
    docs, want = [], []
    for _ in range(120):
        kinds = [rng.choice(T.KINDS) for _ in range(rng.randint(0, 8))]
        docs.append(["제1호 국도 건설공사 토목 설계", *[text[k] for k in kinds]])
        want.append(plain_record([(k, text[k]) for k in kinds]))
    got = {r.doc_id: r for r in T.text_records(pages(spark, docs)).collect()}
    day = lambda x: {"": "", "┖→": "┖→"}.get(x, "12")
    date = lambda x: {"": "", "┖→": "┖→"}.get(x, "2001-02-03")
    for i, (f, more) in enumerate(want):
        r = got[i]
        assert (r.project_name, r.job_field, r.duty) == ("제1호 국도 건설공사", "토목", "설계")
        assert (r.start_date, r.end_date, r.recog_days, r.part_days) == (date(f["start"]), date(f["end"]), day(f["recog"]), day(f["part"])), docs[i]
        assert r.overview == "\n".join(more) and r.issuer == ("한국도로공사" if f["tilde"] else "") and r.is_continuation == ("┖→" in f.values())


def test_headers_take_the_best_alternative(spark):
    docs = [["제1호 공사 토목 설계", "2001.01.01"], ["제1호 공사", "토목 설계", "2001.01.01", "~ 가"], ["제1호 공사", "둘째 줄", "셋째 줄", "2001.01.01", "~ 가"],
            ["앞의 줄", "제1호 공사", "둘째 줄", "셋째 줄", "2001.01.01", "****.**.**", "~ 가"], ["제1호 공사", "2001.01.01", "2002.01.01", "(1일)", "~ 가"], ["위의 글", "제1호 공사", "토목 설계", "2001.01.01", "~ 가"]]
    got = [(r.doc_id, r.line_no, r.header["size"], r.header["name"]) for r in T.project_headers(pages(spark, docs)).where("header is not null").collect()]
    assert sorted(got) == [(0, 0, 1, "제1호 공사"), (1, 0, 2, "제1호 공사"), (2, 0, 3, "제1호 공사 둘째 줄 셋째 줄"), (3, 1, 3, "제1호 공사 둘째 줄 셋째 줄"), (5, 1, 2, "제1호 공사")]


# --- workplaces
@pytest.mark.parametrize(("line", "want"), [
    ("2003.04.05 2009.10.11", (1, "2003.04.05", "", "2009.10.11", "")), ("2003.04.05 現:(주)다 근 무 중 :(주)바", (1, "2003.04.05", "(주)다", "근 무 중", "(주)바")),
    ("2003.04.05 분할설립:(주)다 2009.10.11", (2, "2003.04.05", "분할설립:(주)다", "2009.10.11", "")), ("2003.04.05 어떤말 : (주)다 2009.10 (주)바", (3, "2003.04.05", "(주)다", "2009.10", "(주)바")),
    ("2003.04.05 " + "긴" * 31 + ":(주)다 2009.10.11", (4, "2003.04.05", "(주)다", "2009.10.11", "")), ("2003.04.05 사유 없음 2009.10.11 :(주)바", (5, "2003.04.05", "", "2009.10.11", "(주)바")),
    ("2003.04.05 퇴사", None), ("퇴사", None)])
def test_end_rows_by_tier(spark, line, want):
    got = spark.range(1).select(W.end_row(F.lit(line), R.CHANGE_MARKERS).alias("x")).first().x
    assert (got and tuple(got)) == want


def test_an_end_closes_one_pair(spark):
    pair, end = "2001.01.01 ~ (주)가 2005.03.04 ~ (주)나", "2003.04.05 2009.10.11"
    docs = [[pair, "글", end, end], [pair, pair, end], [pair, "글"], [end, pair], []]
    got = W.workplace_pairs(pages(spark, docs)).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == {0: 2, 1: 2}


# --- awards
def test_award_pieces(spark):
    cases = [("표창장[국가", "기간", "표창장[국가기간"), ("표창장[제1호]", "외 1건", "표창장[제1호] 외 1건"), ("", "감사장", "감사장"), ("감사장[제1호]", "제1호", "감사장[제1호]"),
             ("감사 장", "감사장[제1호]", "감사장[제1호]"), ("표창장", "", "표창장")]
    for a, b, want in cases:
        assert spark.range(1).select(A.join_pieces(F.lit(a), F.lit(b)).alias("x")).first().x == want
    assert spark.range(1).select(A.type_items(F.lit("표창장[제1호]\n감사장[공로\n인정]\n우수상")).alias("x")).first().x == ["표창장[제1호]", "감사장[공로 인정]", "우수상"]


@pytest.mark.parametrize(("text", "want"), [("표창장[제123호][제123호]", "표창장[제123호]"), ("표창장[유공 제12-3호] [제 123 호]", "표창장[유공제12-3호]"), ("표창장[제123호][제77호]", "표창장[제123호][제77호]")])
def test_a_repeated_number_goes(spark, text, want):
    from recordloom.operators.dedup import normalize_award_text

    assert spark.range(1).select(normalize_award_text(F.lit(text)).alias("x")).first().x == want


# --- template blocks
def test_block_names_between_blocks(spark):
    rng = random.Random(4)
    words = ["제1호 국도 건설공사", "공사", "- L=12m 개요", "본사 공무부", "짧은 이름", "제12호 상수도 정비사업 실시설계", "abc"]
    lines, blocks, want = [], [], {}
    for page in range(60):
        y, spans, rows = 0, [], []
        for b in range(rng.randint(1, 4)):
            for _ in range(rng.randint(0, 10)):
                rows.append((y, rng.choice(words)))
                y += 1
            spans.append((b, y, y + 3))
            y += 4
        rows += [(y + i, rng.choice(words)) for i in range(rng.randint(0, 9))]
        lines += [(page, 1, float(t), x) for t, x in rows]
        blocks += [(page, 1, b, float(s), float(e)) for b, s, e in spans]
        for i, (b, s, e) in enumerate(spans):
            above = [(t, x) for t, x in rows if (i == 0 or t > spans[i - 1][2]) and t < s]
            gap = [(t, x) for t, x in rows if t > e and (i + 1 == len(spans) or t < spans[i + 1][1])]
            want[page, b] = (above, gap[: max(len(gap) - B.GUARD, 0)])
    pts = {w: spark.range(1).select(B.name_points(F.lit(w)).alias("x")).first().x for w in words}
    ln = spark.createDataFrame(lines, "doc_id bigint, page_no bigint, top double, line string")
    bl = spark.createDataFrame(blocks, "doc_id bigint, page_no bigint, block bigint, y_start double, y_end double")
    got = {(r.doc_id, r.block): r.name for r in B.block_names(ln, bl).collect()}
    for k, (above, below) in want.items():
        top = max(range(len(above)), key=lambda j: (pts[above[j][1]], -j), default=None)
        low = max(range(len(below)), key=lambda j: (pts[below[j][1]], -j), default=None)
        a = None if top is None else pts[above[top][1]] * 100 - (len(above) - top)
        b = None if low is None else pts[below[low][1]] * 100 - low
        name = "" if a is None and b is None else above[top][1] if b is None or (a is not None and a >= b) else below[low][1]
        assert got[k] == name, (k, above, below)


# --- training
def plain_training(lines):
    rows, cur, on = [], None, False
    for x in lines:
        hits = [m.start() for m in re.finditer(rf"(?<!\d){T.RANGE}", x)]
        for p in [x[a:b].strip() for a, b in zip(hits, [*hits[1:], len(x)], strict=False)] or [x.strip()]:
            header = all(w in p for w in ("교육기간", "과정명", "교육기관명"))
            if "1. 기술경력" in p:
                return [*rows, *([cur] if cur else [])]
            if header or (re.match(r"\d{4}\.\d{2}\.\d{2}(?!\d)", p) and "~" not in p) or re.fullmatch(r"\d{4}\.\d{2}\.\d{2}\s*~\s*", p) or "근무기간" in p or p == "근무처":
                rows, cur, on = [*rows, *([cur] if cur else [])], None, header
            elif on and re.match(T.RANGE, p):
                rows, cur = [*rows, *([cur] if cur else [])], p
            elif on and cur and not any(t in p for t in T.PAGE_TEXTS):
                cur = cur + ("" if re.search("[가-힣]$", cur) and re.match("[가-힣]", p) else " ") + p
    return [*rows, *([cur] if cur else [])]


def test_training_rows_over_pages(spark):
    rng = random.Random(6)
    kinds = ["교육기간 과정명 교육기관명", "2001.01.01 ~ 2001.02.02 안전", "관리", "교육) 2001.01.01 ~ 2001.02.02 품질 2003.01.01 ~ 2003.02.02 시공", "Page : 3", "교육원", "2004.01.01 국토부 표창장", "2005.01.01 ~",
             "2006.01.01 ~ 2006.02.02 토목 설", "A반", "1. 기술경력"]
    weights = [3, 5, 5, 3, 2, 5, 1, 1, 4, 2, 0.3]
    docs = [[rng.choices(kinds, weights)[0] for _ in range(rng.randint(1, 40))] for _ in range(60)]
    rows = [(d, n // 3 * 9000, n, x) for d, lines in enumerate(docs) for n, x in enumerate(lines)]  # pages far apart: several chunks
    got = {}
    for r in T.training_texts(spark.createDataFrame(rows, LINES).repartition(5)).collect():
        got.setdefault(r.doc_id, []).append(r.text)
    for d, lines in enumerate(docs):
        assert sorted(got.get(d, [])) == sorted(plain_training(lines)), lines


# --- look-ahead without a bound
def test_dates_and_names_far_apart(spark):
    far = ["제1호 국도 건설공사 토목 설계", "2001.01.01", *["- 구간"] * 40, "~ 가 나 다 부장", "2002.02.02", *["- 구간"] * 70, "(10일)", "(20일)"]
    b = R.date_blocks(pages(spark, [far])).collect()
    assert [(x.start_date, x.end_date, x.recog_days, x.part_days, x.line_no, x.last_no) for x in b] == [("2001-01-01", "2002-02-02", "10", "20", 1, len(far) - 1)]
    names = [f"구간{i}확장공사" for i in range(40)]
    n = R.names_before_dates(pages(spark, [[*names, "2001.01.01"]])).collect()
    assert [x.name for x in n] == ["".join(names)]
