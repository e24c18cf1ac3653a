"""Feeds are dealt by page once; what is grouped by page stays where it is."""

import re

import pytest
from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return [line for line in plan(df).splitlines() if re.search(r"[-\s]Exchange ", line)]


@pytest.mark.parametrize("name", ["cells_roundtrip", "nearest_right", "nearest_label", "engine_preference", "words_to_lines"])
def test_page_queries_shuffle_the_narrow_source_rows_only(spark, sf_dir, name):
    import __spark_entry__ as entry

    found = exchanges(entry.queries()[name](spark, sf_dir))
    assert len(found) == 1 and "hashpartitioning(o_custkey" in found[0]


@pytest.mark.parametrize("name", ["text_fallback", "stacked_lines", "template_dedup", "training_rows", "work_periods"])
def test_feeds_of_one_file_are_dealt_without_a_setting(spark, sf_dir, name):
    import __spark_entry__ as entry
    from recordloom.sources.scan import FEED_PARTITIONS

    n = spark.conf.get(FEED_PARTITIONS)
    spark.conf.unset(FEED_PARTITIONS)
    try:
        assert "REPARTITION_BY_NUM" in plan(entry.queries()[name](spark, sf_dir))
    finally:
        spark.conf.set(FEED_PARTITIONS, n)


def test_number_of_partitions_grows_with_the_table(spark, monkeypatch):
    from recordloom.sources import scan

    n = spark.conf.get(scan.FEED_PARTITIONS)
    spark.conf.unset(scan.FEED_PARTITIONS)
    try:
        monkeypatch.setattr(scan, "ROWS_PER_PARTITION", 10)
        assert scan.spread(spark.range(1000), "id").rdd.getNumPartitions() == 100
    finally:
        spark.conf.set(scan.FEED_PARTITIONS, n)


def test_cells_with_gaps_repeats_and_nulls(spark):
    from recordloom.operators import tables as T

    key = "1L as doc_id, 1L as page_no, 0 as attempt, 0 as table_no"
    cells = spark.sql(f"select {key}, r as row_no, c as col_no, t as text from values (0, 0, 'a'), (0, 1, null), (1, 0, 'b'), (1, 0, 'c'), (1, 2, 'd'), (2, 1, null), (2, 3, 'e') as v(r, c, t)")
    got = {r.row_no: r.cells for r in T.cells_to_rows(cells).collect()}
    assert got == {0: ["a", ""], 1: ["b", "", "d"], 2: ["", "", "", "e"]}


def test_nearest_label_against_all_pairs(spark):
    import math
    import random

    from recordloom.operators import layout as L

    rnd = random.Random(3)
    words = []
    for page in range(4):
        for seq in range(60):
            x, y = rnd.uniform(-40, 300), rnd.uniform(-20, 120)
            words.append((1, page, seq, rnd.choice("~LB"), x, x + 10.0, y, y + 4.0))
    df = spark.createDataFrame(words, "doc_id long, page_no long, seq long, text string, x0 double, x1 double, top double, bottom double")
    anchor, target = F.col("text").isin("~", "B"), F.concat("text", F.lit("")).isin("L", "B")
    want, right = set(), set()
    for a in (w for w in words if w[3] in "~B"):
        best, near = [], []
        for t in (w for w in words if w[1] == a[1] and w[3] in "LB"):
            dx, dy = (t[4] + t[5]) / 2 - (a[4] + a[5]) / 2, (t[6] + t[7]) / 2 - (a[6] + a[7]) / 2
            d = math.sqrt(dx * dx + dy * dy)
            if abs(dy) <= 6 and t[4] >= a[5]:
                best.append((0, t[4] - a[5], t[2], t[3]))
            elif d <= 25:
                best.append((1, d + (60 if dx < 0 else 0) + (15 if dy < 0 else 0), t[2], t[3]))
            if abs(dy) <= 6 and t[4] > a[5] + 2:
                near.append((t[4] - a[5], t[2], t[3]))
        want |= {(a[1], a[2], min(best)[3])} if best else set()
        right |= {(a[1], a[2], min(near)[2])} if near else set()
    assert {(r.page_no, r.seq, r.label) for r in L.nearest_label(df, anchor, target, radius=25.0).collect()} == want
    assert {(r.page_no, r.seq, r.target) for r in L.nearest_right(df, anchor, target).collect()} == right


def test_every_tilde_near_a_position_gets_its_label(spark, sf_dir):
    import math

    import __spark_entry__ as entry
    from recordloom.plans import feeds, q_layout

    words = q_layout.words(spark, sf_dir).where("page_no % 10 = 0").where(F.col("text").isin("~", *feeds.POSITIONS)).collect()
    pages = {}
    for w in words:
        pages.setdefault((w.doc_id, w.page_no), []).append(w)
    at = lambda w: ((w.x0 + w.x1) / 2, (w.top + w.bottom) / 2)
    want = {(w.doc_id, w.page_no, w.seq) for ws in pages.values() for w in ws if w.text == "~" and any(
        t.text != "~" and (math.dist(at(w), at(t)) <= 120 or (abs(at(w)[1] - at(t)[1]) <= 6 and t.x0 >= w.x1)) for t in ws)}
    got = entry.queries()["nearest_label"](spark, sf_dir).where("page_no % 10 = 0").collect()
    assert {(r.doc_id, r.page_no, r.seq) for r in got} == want and len(want) > 0.9 * sum(w.text == "~" for w in words)


@pytest.mark.parametrize("name", ["six_columns", "block_pivot", "cm_blocks"])
def test_table_rows_are_not_shuffled_again(spark, sf_dir, name):
    import __spark_entry__ as entry

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = exchanges(entry.queries()[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(found) == 1 and "hashpartitioning(o_custkey" in found[0]


def test_six_columns_of_tables_that_are_blank_or_narrow(spark):
    from recordloom.operators import tables as T

    rows = [(1, 1, 0, 0, 0, [" ", None]), (1, 1, 0, 1, 0, []), (1, 1, 0, 2, 0, ["a"]), (1, 1, 0, 2, 1, []), (1, 1, 0, 2, 2, ["", " b\u00a0"])]
    d = T.six_columns(spark.createDataFrame(rows, "doc_id long, page_no long, attempt int, table_no int, row_no int, cells array<string>"))
    assert sorted((r.table_no, r.row_no, *r.cells) for r in d.collect()) == [(2, 0, "a", ""), (2, 1, "", ""), (2, 2, "", "b")]


def test_template_blocks_read_their_lines_once_and_join_nothing(spark, sf_dir):
    import __spark_entry__ as entry

    p = plan(entry.queries()["template_blocks"](spark, sf_dir))
    assert "Join" not in p and "BroadcastExchange" not in p and p.count("FileScan") == 1


def test_template_blocks_take_heights_and_names_from_the_page(spark):
    from recordloom.operators import template_blocks as B

    text = ["제1호 공사", "2001.01.01", "~ 도로", "2002.02.02", "(1일)", "( 2 일 )", "", "제2호 공사", "2003.03.03", "~ 도로", "근무중"]
    lines = [(1, p, i, float(i * 10 + p), t) for p in (1, 2) for i, t in enumerate(text)]
    d = B.template_blocks(spark.createDataFrame(lines, "doc_id long, page_no long, line_no long, top double, line string"))
    got = sorted((r.page_no, r.block, r.line_no, r.last_no, r.y_start, r.y_end, r.name, r.name_above) for r in d.collect())
    assert got == [x for p in (1, 2) for x in [(p, 0, 1, 5, 10.0 + p, 50.0 + p, "제1호 공사", True), (p, 1, 8, 10, 80.0 + p, 100.0 + p, "제2호 공사", True)]]
