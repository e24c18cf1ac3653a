import random

import numpy as np
import pytest
from brute import similar_groups as groups

import corpus_pipeline
from recordloom.llm import shingle_sets as ss
from recordloom.llm.common import take


def edited(text, n, seed):
    r, words = random.Random(seed), text.split()
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randrange(999)}"
    return " ".join(words)


def test_stage_drops_edited_copies(spark, make, prose, tmp_path):
    base = prose(300, 1)
    rows = [(0, base), (1, edited(base, 3, 1)), (2, edited(base, 5, 2)), (3, prose(300, 2)), (4, edited(prose(300, 2), 40, 3)), (5, prose(300, 3))]
    assert groups([t for _, t in rows]) == [0, 0, 0, 3, 4, 5]
    kept = take(corpus_pipeline.near_copies(spark, make(rows), str(tmp_path)), "doc_id").collect()
    assert sorted(r[0] for r in kept) == [0, 3, 4, 5]


@pytest.mark.parametrize(("seed", "most_keys"), [(0, 1 << 20), (1, 2)])
def test_all_similar_pairs_are_found(spark, make, prose, monkeypatch, seed, most_keys):
    monkeypatch.setattr(ss, "FREQUENT", 2)
    monkeypatch.setattr(ss, "BROADCAST_KEYS", most_keys)
    monkeypatch.setattr(ss, "PAIRS_AT_ONCE", 7)
    r = random.Random(seed)
    bases = [prose(n, 100 + n + seed) for n in (5, 12, 40, 150, 600)]
    texts = ["", None, " ", "one two", "One  TWO", "one two three"]
    texts += [edited(b, r.randint(0, max(1, len(b.split()) // 25)), r.random()) + r.choice(["", " and", " and so it went on"]) for b in bases for _ in range(14)]
    got = {x.doc_id: x.root for x in ss.similar_groups(make(list(enumerate(texts)))).collect()}
    want = groups(texts)
    assert len(got) == len(texts) and len(set(want)) < len(want) - 20
    assert all((got[i] == got[j]) == (want[i] == want[j]) for i in got for j in got)


def test_prefixes_of_similar_sets_meet():
    for n in range(1, 60):
        for shared in range(ss.least_shared(n, 0.8), n + 1):
            assert n - ss.least_shared(n, 0.8) + 1 > n - shared
    assert len(ss.shingle_set(b"", 5)) == 0 and len(ss.shingle_set(b"a b c", 5)) == 1
    assert np.array_equal(ss.shingle_set("É b c d e".encode(), 5), ss.shingle_set("é B c d e".encode(), 5))


def test_one_shingle_in_all_rows(spark, make, prose):
    """A shingle that all texts share joins none of them but the copies."""
    rows = [(i, f"one two three four five {prose(4, i)}") for i in range(150)] + [(i, f"one two three four five {prose(40, 7)} x{i % 2}") for i in range(200, 320)]
    got = {x.doc_id: x.root for x in ss.similar_groups(make(rows)).collect()}
    want = groups([t for _, t in rows])
    assert all((got[a] == got[b]) == (want[i] == want[j]) for i, (a, _) in enumerate(rows) for j, (b, _) in enumerate(rows))


def test_signatures_never_rule_out_a_similar_pair():
    rng = np.random.default_rng(5)
    for n in (1, 3, 17, 64, 65, 500, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for share in (0.0, 0.5, 0.9, 1.0):
            kept = a[: int(share * len(a))]
            b = np.unique(np.concatenate((kept, rng.integers(0, 1 << 63, int(n * rng.uniform(0, 1.5)) + 1).astype(np.uint64))))
            shared = len(np.intersect1d(a, b))
            bound = ss.most_shared((len(a), len(b)), ss.signature(a), ss.signature(b))
            assert bound >= shared
            if n >= 64 and share == 0.0:
                assert bound < 0.6 * min(len(a), len(b)) + 8  # and it rules out most others


def test_pairs_of_near_copies_grow_with_their_number(spark, make, prose, monkeypatch):
    """Copies of one text, each with two words changed: like the text itself at best, rarely like each other."""
    seen = spark.sparkContext.accumulator(0)
    hopeful = ss._hopeful

    def counted(similarity):
        f = hopeful(similarity)

        def run(batches):
            def count():
                for b in batches:
                    seen.add(b.num_rows)
                    yield b

            return f(count())

        return run

    monkeypatch.setattr(ss, "_hopeful", counted)
    base = prose(90, 11)
    made = []
    for n in (200, 400):
        before = seen.value
        assert ss.similar_groups(make(list(enumerate([base] + [edited(base, 2, i) for i in range(n)])))).count() == n + 1
        made.append(seen.value - before)
    assert made[1] < 3 * 400, made
