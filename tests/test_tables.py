"""Table blocks, the spill fold against a plain implementation, and column rules."""

import random
import re

from pyspark.sql import functions as F

from recordloom.operators import layout as LY
from recordloom.operators import tables as T


def rows(spark, data, doc="d"):
    return spark.createDataFrame([(doc, 0, 0, 0, i, r) for i, r in enumerate(data)],
                                 "doc_id string, page_no int, attempt int, table_no int, row_no int, cells array<string>")


HINTS = [{0, 1, 3, 4, 5}, {1, 2, 3, 4}, {1, 3, 4}, {1, 2, 3, 4}]
ORDER = {1: [2, 1, 0, 3], 2: [1, 3, 2, 0], 3: [1, 2, 3, 0], 4: [0, 1, 2, 3]}


def plain_fold(block):
    base = [list((block[i] if i < len(block) else [""] * 6)) for i in range(4)]
    for extra in block[4:]:
        for j, frag in enumerate(extra):
            frag = frag.strip()
            if not frag:
                continue
            tail = bool(re.fullmatch(r"\d(\.\d{0,12})?|\.\d+", (base[2][1].split() or [""])[-1]))
            piece = bool(re.fullmatch(r"\d+(\.\d+)?(㎥|㎡|%|개소외?|km|m|/min|[a-zA-Z]+)", frag.replace(" ", "")))
            sc = {s: 3 + (10 if base[s][j].strip() else 0) + (55 if j == 1 and s == 2 and tail and piece else 0) for s in range(4) if j in HINTS[s]}
            best = max(sc.values())
            slot = next(s for s in [*ORDER.get(j, [2, 1, 3, 0]), 0, 1, 2, 3] if sc.get(s) == best)
            clean = re.sub(r"^\s*┖→\s*", "", frag).strip()
            if slot == 0 and j == 0:
                if frag == "┖→":
                    continue
                if "┖→" in frag and not re.search(r"\d{4}\.\d{2}\.\d{2}", frag):
                    base[2][1] = base[2][1].strip() + clean
                    continue
            base[slot][j] = base[slot][j].strip() + clean
    return base


def test_fold_matches_plain_implementation(spark):
    rnd = random.Random(3)
    pool = ["", "", "가나", "25.0m", "연장 3", "┖→ 꼬리", "┖→", "12", "도로"]
    blocks = [[[rnd.choice(pool) for _ in range(6)] for _ in range(rnd.randint(1, 7))] for _ in range(60)]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(blocks)], "i int, b array<array<string>>")
    got = {r.i: [list(x) for x in r.m] for r in df.select("i", T.fold_block(F.col("b")).alias("m")).collect()}
    for i, b in enumerate(blocks):
        assert got[i] == plain_fold([[c.strip() for c in r] for r in b]), b


def test_six_columns_keeps_labelled_and_outer(spark):
    head = ["참여기간", "", "사업명", "", "공사종류", "직무분야", "", "담당업무", "", "비고"]
    body = ["2020.01.01", "x", "가", "", "", "토목", "", "설계", "", "끝"]
    got = T.six_columns(rows(spark, [head, body])).orderBy("row_no").collect()
    assert got[0].cells == ["참여기간", "사업명", "공사종류", "직무분야", "담당업무", "비고"]
    assert got[1].cells == ["2020.01.01", "가", "", "토목", "설계", "끝"]


def test_first_maximum_wins(spark):
    s = spark.createDataFrame([("d", 0, 0, 0, 5, 1, 1), ("d", 0, 0, 1, 7, 2, 1), ("d", 0, 1, 0, 7, 2, 1)],
                              "doc_id string, page_no int, attempt int, table_no int, s1 bigint, s2 bigint, s3 bigint")
    b = T.best_table(s).first()
    assert (b.attempt, b.table_no, b.s1) == (0, 1, 7)


def test_header_signal(spark):
    r = rows(spark, [["a", "b"], ["국가기술자격", "종목", "합격일"]])
    assert T.has_header_signal(r, ["종목", "합격"]).first().has_signal is True
    assert T.has_header_signal(rows(spark, [["a", "b"]]), ["종목"]).first().has_signal is False


def test_islands_partition_the_input(spark):
    data = [["머리"] + [""] * 5] + [[("2020.01.01" if i % 3 == 0 else "")] + [f"c{i}"] + [""] * 4 for i in range(12)]
    got = T.period_blocks(rows(spark, data)).collect()
    assert len(got) == 12 and {r.block for r in got} == {1, 2, 3, 4}
    assert sorted((r.block, r.rn) for r in got) == [(b, n) for b in (1, 2, 3, 4) for n in (1, 2, 3)]


def test_cm_blocks_break_at_annotations(spark):
    data = [["사업명 비고"] + [""] * 5] + [[""] * 6] * 3 + [
        ["2020.01.01 ~ 근무중", "가", "", "", "", ""], ["", "나", "", "", "", ""], ["※ 주석", "", "", "", "", ""], ["", "다", "", "", "", ""],
        ["2020.01.01", "2021.01.01", "", "", "", ""]]
    r = rows(spark, data)
    head = spark.createDataFrame([("d", 0, 0, 0, 0)], "doc_id string, page_no int, attempt int, table_no int, header_row int")
    assert [(x.row_no, x.block, x.rn) for x in T.cm_blocks(r, head).orderBy("row_no").collect()] == [(4, 1, 1), (5, 1, 2), (8, 2, 1)]


def test_month_precision_starts(spark):
    ok = lambda c, m: spark.range(1).select(T.is_period_start(F.lit(c), m)).first()[0]
    assert ok("2020.01 ~ 2020.03 (31일)", True) and not ok("2020.01 ~ 2020.03 (31일)", False)
    assert not ok("2020.01 ~ 2020.01 (31일)", True) and not ok("2020.01 ~ 2020.03", True)


def test_anchor_rule_for_lines(spark):
    w = spark.createDataFrame([("d", 0, float(t), float(x), float(x + 4), s) for t, x, s in [(0, 0, "a"), (1.5, 10, "b"), (3, 20, "c"), (4.5, 24.5, "d")]],
                              "doc_id string, page_no int, top double, x0 double, x1 double, text string")
    assert [r.line for r in LY.words_to_lines(w).orderBy("line_no").collect()] == ["a b", "cd"]
