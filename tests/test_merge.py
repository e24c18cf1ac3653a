"""De-duplication, merging and comparison."""

from pyspark.sql import functions as F

from recordloom.operators import dedup as D
from recordloom.operators import merge as M
from recordloom.operators import sinks as K
from recordloom.operators.records import chain_workplaces


def test_dedup_is_idempotent_and_first_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")], "k string, seq int, v string")
    once = D.first_per_key(df, ["k"], ["seq"])
    assert sorted(map(tuple, once.collect())) == [("a", 1, "x"), ("b", 3, "z")]
    assert sorted(map(tuple, D.first_per_key(once, ["k"], ["seq"]).collect())) == sorted(map(tuple, once.collect()))


def test_mark_duplicates_keeps_every_row(spark):
    df = spark.createDataFrame([("d", "tech", "나", "1", "2", i) for i in range(3)] + [("d", "tech", "가", "1", "2", 9), ("d", "tech", "가 ", "1", "2", 10), ("d", "tech", "다", "1", "2", 11)],
                               "doc_id string, section string, project_name string, start_date string, end_date string, i int")
    got = {r.i: (r.dup, r.dup_group, r.dup_count) for r in D.mark_duplicates(df).collect()}
    assert got == {0: (True, 2, 3), 1: (True, 2, 3), 2: (True, 2, 3), 9: (True, 1, 2), 10: (True, 1, 2), 11: (False, None, None)}


def test_hot_key_is_whole(spark):
    """A third of all rows in one key: nothing is lost or capped."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("doc_id"), F.lit("tech").alias("section"),
                                  F.lit("이름").alias("project_name"), F.lit("s").alias("start_date"), F.lit("e").alias("end_date"), "id")
    out = D.mark_duplicates(df)
    assert out.count() == 3000 and out.where("dup").count() == 1000


def test_suffix_bleed_needs_a_bracket_before(spark):
    rows = [("d", 1, "표창장[국토교통부 장관상]"), ("d", 2, "감사장[서울] 표창장[국토교통부장관상]"), ("d", 3, "그냥 표창장[국토교통부장관상]")]
    df = spark.createDataFrame(rows, "doc_id string, seq int, kind string")
    got = {r.seq: r.kind for r in D.strip_suffix_bleed(df, ["doc_id"], "seq", "kind").collect()}
    assert got == {1: rows[0][2], 2: "감사장[서울]", 3: rows[2][2]}


def test_contained_rows_drop(spark):
    df = spark.createDataFrame([("d", "1", "표창장[제1호]"), ("d", "1", "표창 장[제1호] 추가"), ("d", "2", "표창장[제1호]"), ("d", "1", "장")], "doc string, dt string, t string")
    assert sorted(r.t for r in D.drop_contained(df, ["doc", "dt"], "t").collect()) == ["표창 장[제1호] 추가", "표창장[제1호]"]


def test_compare_with_itself_and_with_changes(spark):
    a = spark.createDataFrame([("d", "s1", "e1", "x", 1), ("d", "s2", "e2", "y", 2), ("d", "s3", "e3", "z", 3)], "doc_id string, s string, e string, v string, o int")
    assert M.compare_by_key(a, a, ["s", "e"], ["v"], "o").count() == 0
    b = a.where("o <> 3").withColumn("v", F.when(F.col("o") == 2, "Y").otherwise(F.col("v"))).unionByName(
        spark.createDataFrame([("d", "s4", "e4", "n", 4)], a.schema))
    got = sorted((r.s, r.status, r.field) for r in M.compare_by_key(a, b, ["s", "e"], ["v"], "o").collect())
    assert got == [("s2", "both", "v"), ("s3", "only_left", None), ("s4", "only_right", None)]


def test_attach_continuations(spark):
    rec = spark.createDataFrame([("d", 1, 10, "사업 하나", "개요"), ("d", 3, 30, "이어지는 글 열글자 다음 사업", "")], "doc_id string, page_no int, rec_idx int, project_name string, overview string")
    cont = spark.createDataFrame([("d", 2, "이어지는 글 열글자"), ("d", 3, "둘째")], "doc_id string, page_no int, cont string")
    got = {r.rec_idx: (r.overview, r.project_name, r.cont_pages) for r in M.attach_continuations(rec, cont).collect()}
    assert got[10] == ("개요\n이어지는 글 열글자\n둘째", "사업 하나", [2, 3])
    assert got[30] == ("", "다음 사업", None)


def test_chain_of_three_workplaces(spark):
    df = spark.createDataFrame([("d", 1, "1", "2", "", "A"), ("d", 2, "2", "3", "B", "C"), ("d", 3, "3", "4", "D", "E")], "doc_id string, seq int, start_date string, end_date string, previous string, current string")
    assert [(r.previous, r.current) for r in chain_workplaces(df).orderBy("seq").collect()] == [("A", "B"), ("B", "C"), ("D", "E")]


def test_nested_parts_hold_everything(spark):
    df = spark.range(250).select(F.lit("d").alias("doc_id"), F.col("id").alias("rec_idx"), F.col("id").cast("string").alias("v"))
    d = K.nested_documents(df, ["v"], max_records=100)
    assert sorted((r.part, r.n) for r in d.collect()) == [(0, 100), (1, 100), (2, 50)]


def test_sheet_names_unique(spark):
    assert K.sheet_names(["a/b", "a:b", "x" * 40]) == {"a/b": "a_b", "a:b": "a_b_1", "x" * 40: "x" * 31}


def test_contained_texts_and_their_letter_groups(spark):
    from recordloom.operators.dedup import drop_contained, letter_groups

    texts = {1: ["표창장[제7호]", "제 7호", "공로", "표창장[제7호"], 2: ["abcdefghij", "bcdefgh", "xbcdefgh"], 3: ["abcdef", "ghijkl"], 4: ["a", "ba", "", None], 5: ["xyzxyzxyz"]}
    rows = [(k, t) for k, ts in texts.items() for t in ts] + [(None, "ab"), (None, "abc"), (2, "bcdefgh")]
    flat = lambda t: (t or "").replace(" ", "")
    want = [(k, t) for k, t in rows if k is None or not flat(t) or not any(flat(t) in flat(o) and len(flat(o)) > len(flat(t)) for o in texts[k])]
    d = spark.createDataFrame(rows, "k int, t string")
    assert sorted(map(tuple, drop_contained(d, ["k"], "t").collect()), key=repr) == sorted(want, key=repr)
    short, long = letter_groups(spark.createDataFrame([(k, flat(t)) for k, t in rows if flat(t)], "k int, _c string").distinct(), ["k"])
    assert not {r.k for r in short.collect()} & {3, 5, None}
    groups = long.collect()
    assert not {r.k for r in groups} & {3, 5, None}
    assert {len(r._g) for r in groups if r.k == 2} == {6}
