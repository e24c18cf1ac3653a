import zlib

import numpy as np
import pyarrow as pa

from recordloom.llm import crf_langid as c

A, B = "the of and with this that stone", "der die und von nicht ein baum"


def sample(words, n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(words.split(), n))


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    score, trans, start = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    post, pairs = c.forward_backward(score, np.ones((1, 4), bool), trans, start)
    want, want_pairs, total = np.zeros((4, 3)), np.zeros((3, 3)), 0
    for path in np.ndindex(3, 3, 3, 3):
        p = np.exp(start[path[0]] + sum(score[0, t, s] for t, s in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += p
        for t, s in enumerate(path):
            want[t, s] += p
        for a, b in zip(path, path[1:], strict=False):
            want_pairs[a, b] += p
    assert np.allclose(post[0], want / total) and np.allclose(pairs, want_pairs / total)
    short, _ = c.forward_backward(np.concatenate((score, score)), np.array([[True] * 4, [True, True, False, False]]), trans, start)
    alone, _ = c.forward_backward(score[:, :2], np.ones((1, 2), bool), trans, start)
    assert np.allclose(short[0], post[0]) and np.allclose(short[1, :2], alone[0]) and not short[1, 2:].any()


def test_code_switch():
    model = c.train([("a", sample(A, 60, i)) for i in range(20)] + [("b", sample(B, 60, i)) for i in range(20)])
    texts = pa.array([sample(A, 9, 99), sample(B, 9, 99), f"{sample(A, 12, 1)} {sample(B, 8, 1)}", "12 !", ""])
    lang, score = c.label_texts(texts, c.WordScores(c.Crf.load(model.dump())))
    assert lang == ["a", "b", "a", "und", "und"] and 0.5 < score[2] < 0.7 and score[3] == 0
    assert c.train([]) is None and c.train([("a", "1 2")]) is None


def test_words():
    code, text, vocabulary, begins = c.words_of(pa.array(["Ab, CD\n\nab 12 é", "", "x" * 5, " ".join(["w"] * 200)]))
    assert [vocabulary[i].as_py() for i in code[:5]] == ["ab", "cd", "ab", "é", "xxxxx"] and text[:5].tolist() == [0, 0, 0, 0, 2]
    assert begins.tolist() == [0, 2, 4, 5, 5 + c.CHAIN, 5 + 2 * c.CHAIN]


def test_identify(spark):
    rows = [(i, sample(A if i % 2 else B, 40, i), "a" if i % 2 else "b") for i in range(120)]
    rows += [(200, None, "a"), (201, "", "b"), (202, "12 --", None), (None, sample(A, 20, 5), "a"), (203, sample(B, 30000, 6), None), (3, *rows[3][1:]), (204, sample(B, 20, 7), "a")]
    schema = "doc_id bigint, text string, lang string, score string, DOC_ID string"
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], schema)
    got = c.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert all(by[i].lang_pred == ("a" if i % 2 else "b") for i in range(120))
    assert [by[i].lang_pred for i in (200, 201, 202, None, 203, 204)] == ["und", "und", "und", "a", "b", "b"]
    assert c.identify(docs.limit(0)).count() == 0


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "words here", None), (2, "more", None)], "doc_id bigint, text string, lang string")
    assert [(r.lang_pred, r.score) for r in c.identify(docs).collect()] == [("und", 0.0)] * 2
