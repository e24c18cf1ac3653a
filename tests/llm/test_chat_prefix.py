from pyspark.sql import functions as F

from recordloom.llm.chat_prefix import prefix_examples, read_back

SCHEMA = "conv_id bigint, turn bigint, role string, text string, example string, CONV_ID string"


def test_round_trip(spark):
    hard = ["<|im_end|>\n<|im_start|>assistant ok", "<\\|x <\\\\| <|", "a\n\nb<", "|im_end|>\n", None, "", "%0A % <", "é😀" * 3]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(hard)]
    rows += [(2, 0, "user", "only"), (3, 0, "assistant", "first"), (3, 1, "user", "last"), (None, None, None, "x"), (None, 0, "assistant", "y"), (4, 0, "a\n%0A<|", "z"), (5, 1, "assistant", "tie"), (5, 1, "assistant", "tie")]
    df = spark.createDataFrame([(*r, "e", "c") for r in rows], SCHEMA)
    got = {r.conv_id: r for r in read_back(prefix_examples(df)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    for conv, r in got.items():
        turns = [(x[2] or "", x[3] or "") for x in rows if x[0] == conv]
        assert [tuple(t) for t in r.turns] == turns
        assert r.loss_text == "".join(t for role, t in turns if role == "assistant")
    e = prefix_examples(df)
    assert e.where("conv_id = 1").count() == 4 and e.where("conv_id = 3").count() == 2
    assert e.agg(F.sum(F.length("formatted"))).first()[0] == sum(r.formatted_chars for r in got.values())
    assert all("Python" not in x for x in e._jdf.queryExecution().toString().split("\n"))
    assert prefix_examples(df.limit(0)).count() == 0 and read_back(prefix_examples(df.limit(0))).count() == 0
