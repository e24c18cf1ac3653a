import random

import numpy as np
import pytest
from brute import without_repeats

import corpus_pipeline
from recordloom.llm import run_index as ri
from recordloom.llm.common import take


@pytest.mark.parametrize("seed", range(6))
def test_index_marks_what_brute_force_marks(seed):
    rng = random.Random(seed)
    for _ in range(25):
        w = rng.choice([5, 9, 20, 40])
        alphabet = rng.choice([b"ab", b"abc", bytes(range(256)), b"\x00\x01"])
        base = [bytes(rng.choice(alphabet) for _ in range(rng.randint(w, 120))) for _ in range(4)]
        texts = [t for _ in range(rng.randint(1, 9)) if len(t := b"".join(rng.choice(base)[rng.randint(0, 30) :] for _ in range(rng.randint(1, 3)))) >= w]
        if texts:
            flags = ri.repeated_windows(texts, w)
            for t, f in zip(texts, flags, strict=True):
                assert f.tolist() == [sum(x.count(t[i : i + w]) + sum(x[j : j + w] == t[i : i + w] for j in range(len(x))) - x.count(t[i : i + w]) for x in texts) > 1 for i in range(len(t) - w + 1)]


def test_runs_describe_the_transform():
    index = ri.RunIndex.build(np.frombuffer(b"abracadabra" * 20, np.uint8), np.array([110, 220]))
    assert index.length.sum() == index.size == 220 and len(index.head) < 60
    assert sorted(index.first.tolist())[0] >= 0 and index.shared.max() >= 99


def test_segments_hold_every_window_once(monkeypatch):
    data = np.frombuffer(bytes(random.Random(1).choice(b"abcdefgh \n") for _ in range(3000)) + b"!" * 3000 + b"xyz " * 700, np.uint8)
    monkeypatch.setattr(ri, "STRIPE", 1700)
    start, count, _, again = ri.segments_of(data)
    assert start[0] == 0 and (start[1:] == (start + count)[:-1]).all() and count.sum() == len(data) - 399 and count.max() <= 369 and again.any()
    assert len(ri.segments_of(data[:399])[0]) == 0


@pytest.mark.parametrize("limit", [4096, 1])
def test_removal(spark, make, prose, monkeypatch, limit):
    monkeypatch.setattr(ri, "ANCHOR_LIMIT", limit)
    passage, other = prose(120, 1), prose(150, 2)
    texts = [None, "", "short", prose(300, 3), f"{prose(60, 4)} {passage} {prose(50, 5)}", f"{passage} é {prose(80, 6)}", f"{prose(30, 7)} {passage}", "!" * 1500, "ab" * 399 + "b", other, other,
             f"{other}{other[:-1]}", prose(200, 8) * 3, passage[:399], "x" + passage[:400], prose(2000, 9).replace("a", "ä") + passage, prose(20000, 10)]
    rows = [*enumerate(texts), (None, texts[3]), (4, texts[4])]
    docs = make(rows)
    r = ri.remove_repeats(docs)
    assert r.columns == [*docs.columns, "kept", "n_removed", "n_spans"]
    got = sorted((repr(x.doc_id), bytes(x.out), x.n_removed, x.n_spans) for x in take(r.withColumnRenamed("kept", "old").toDF(*docs.columns, "out", "n_removed", "n_spans"), "doc_id", "out", "n_removed", "n_spans").collect())
    want = sorted((repr(i), *x) for (i, _), x in zip(rows, without_repeats([(t or "").encode() for _, t in rows]), strict=True))
    assert got == want
    assert ri.remove_repeats(docs.limit(0)).count() == 0


def test_passages_of_over_fifty_words(spark, make, prose, tmp_path):
    short, fifty = prose(51, 21), prose(50, 22)
    assert len(short.encode()) < 400
    a, b = prose(60, 23) + " x1", "x2 " + prose(60, 24)
    rows = [(1, f"{a} {short} {b}"), (2, f"y1 {short.replace(' ', '\n ')} y2"), (3, f"{a.upper()} z1 {fifty} z2"), (4, f"w1 {fifty} w2 é"), (None, short)]
    got = {r.doc_id: r.text for r in take(corpus_pipeline.long_repeats(spark, make(rows), str(tmp_path)), "doc_id", "text").collect()}
    assert got == {1: f"{a}  {b}", 2: "y1  y2", 3: rows[2][1], 4: rows[3][1], None: ""}
