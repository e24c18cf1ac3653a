import pytest

from recordloom.llm import template_decon as td

ITEM = "Alice has 12 apples and gives 5 kg of them to Bob before Alice walks home with 12 dogs again today."
OTHER = "Carol has 33 apples and gives 7 lb of them to Dave before Carol walks home with 33 dogs again today."
MIXED = "Carol has 33 apples and gives 7 lb of them to Dave before Erin walks home with 44 dogs after Finn has 55 cats and 66 dogs."
BENCH = [(1, ITEM), (2, None), (3, "one two"), (4, "seven 8 9 Alice 10"), (5, ""), (1, ITEM), (6, "short but odd words")]


@pytest.mark.parametrize("bound", [1 << 20, 2])
def test_found_and_left_alone(spark, make, prose, monkeypatch, bound):
    monkeypatch.setattr(td, "BROADCAST_WINDOWS", bound)
    rows = [(1, f"{prose(50, 1)} {ITEM} {prose(20000, 2)}"), (2, OTHER), (2, OTHER), (3, f"{prose(30, 3)}\n{OTHER.replace('apples', 'plums')}"), (4, prose(3000, 4)), (5, ""), (6, None), (None, ITEM.upper()),
            (7, " ".join(ITEM.split()[:6])), (8, "it said SHORT but odd words!"), (9, "x seven 8 9 Alice 10 y"), (10, "x seven 8 9 Carol 11 y"), (11, "one two")]
    docs, bench = make(rows), spark.createDataFrame(BENCH, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r for r in td.contaminated(docs, bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (None, 1), (8, 6), (9, 4), (11, 3)}
    assert got[1, 1].verbatim and not got[2, 1].verbatim and got[2, 1].consistency == 1
    kept = [r[0] for r in td.take(td.without_contaminated(docs, bench), "doc_id").collect()]
    assert sorted(kept) == [4, 5, 6, 7, 10]
    assert td.contaminated(docs.limit(0), bench).count() == 0 and td.contaminated(docs, bench.limit(0)).count() == 0


def test_other_case_is_the_same_text(spark, make):
    text = "The old mill at Grey Straße was sold. Few in town knew that Maria had kept the deed. Her son Tom found it there."
    bench = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    docs = make([(1, text.upper()), (2, f"so {text.lower()} and"), (3, text.title()), (4, "the old mill was sold and few in town knew it at all")])
    got = td.contaminated(docs, bench).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 3] and all(r.verbatim and r.coverage == 1 for r in got)


def test_slots_of_other_lengths(spark, make):
    text = "The mayor of Rome paid twenty coins for each old map that Anna drew on a wall. When Anna sold 5 kg of salt to the mayor he gave her twenty more and they left."
    bench = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    other = text.replace("Rome", "New York").replace("twenty", "thirty five").replace("Anna", "Mary Ann Lee")
    shifted = other.replace("5 kg", "7kg").replace("he gave", "kindly he gave")
    docs = make([(1, other), (2, f"so {shifted} today"), (3, "The mayor of Rome paid twenty coins. Anna drew on a wall and they left.")])
    got = {r.doc_id: r for r in td.contaminated(docs, bench).collect()}
    assert set(got) == {1, 2} and got[1].coverage == 1 and not got[1].verbatim


def test_parts_on_neighbouring_alignments_count_together(spark, make):
    parts = [" ".join(f"{c}{i}" for i in range(9)) for c in "abcdef"]
    text = " gap 12 kg of ".join(parts)
    bench = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    docs = make([(1, text.replace("gap 12 kg of", "13kg")), (2, " ".join(reversed(parts[:2])) + " 12 kg")])
    got = td.contaminated(docs, bench).collect()
    assert [r.doc_id for r in got] == [1]


def test_slots_must_be_filled_alike(spark, make):
    bench = spark.createDataFrame([(1, "Alice has 12 apples but Alice wants 12 pears so Alice takes 12 plums and Alice has 12 figs.")], "item_id bigint, text string")
    docs = make([(1, "Bob has 7 apples but Bob wants 7 pears so Bob takes 7 plums and Bob has 7 figs."), (2, "Bob has 7 apples but Carl wants 8 pears so Dan takes 9 plums and Ed has 10 figs.")])
    assert [r.doc_id for r in td.contaminated(docs, bench).collect()] == [1]


def test_kinds():
    kinds = {w: td.classify(w)[0] for w in ("12", "3.5,", "(7)", "5kg", "$20", "kg", "Alice", "NASA", "apples", "...", "seven", "12th")}
    assert kinds == {"12": td.NUMBER, "3.5,": td.NUMBER, "(7)": td.NUMBER, "5kg": td.MEASURE, "$20": td.NUMBER, "kg": td.UNIT, "Alice": td.NAME, "NASA": td.LITERAL, "apples": td.LITERAL, "...": td.SKIP,
                     "seven": td.NUMBER, "12th": td.NUMBER}
