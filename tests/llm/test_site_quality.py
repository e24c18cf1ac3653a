import numpy as np
import pytest

from recordloom.llm import site_quality as sq


def docs_of(spark, prose, n=160):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = " ".join(w.upper() + "!!" for w in prose(60, i).split()) if bad else prose(60, i)
        rows.append((i, text, "big" if i % 3 else f"site{i}", "en" if i % 2 else None))
        if i % 5 < 3:
            labels.append((i, 0 if bad else 1, 0))
    rows += [(900, None, None, None), (901, "", "big", "en"), (None, prose(60, 3), "big", "en"), (5, *rows[5][1:]), (902, prose(20000, 4), "big", "en")]
    labels += [(5, 1, 0), (None, 1, 0), (7, None, 0), (12345, 0, 0)]
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, source string, lang string, score string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_scores(spark, prose):
    docs, labels = docs_of(spark, prose)
    got = sq.site_quality(docs, labels, "source", ["lang"]).collect()
    assert len(got) == docs.count()
    assert all(r.kept == (r.doc_id % 4 != 0) for r in got if r.doc_id is not None and r.doc_id < 900)
    assert all(0 <= r.score <= 1 and sq.POSTERIOR_FLOOR <= r.site <= 1 - sq.POSTERIOR_FLOOR for r in got)
    assert {r.doc_id: r.kept for r in got}[902]
    assert sq.site_quality(docs.limit(0), labels, "source", ["lang"]).count() == 0
    none = sq.site_quality(docs, labels.limit(0), "source", ["lang"]).collect()
    assert all(r.evidence == 0 and r.kept for r in none)


def test_sparse_sites_shrink(spark, prose):
    """The same text on a site with many bad documents, on one with a single other document, and on a good one."""
    rows = [(i, prose(60, i), "bad" if i < 60 else "good", "en") for i in range(120)] + [(200, prose(60, 200), "bad", "en"), (201, prose(60, 200), "new", "en"), (202, prose(60, 200), "good", "en")]
    labels = [(i, int(i >= 60)) for i in range(120)]
    got = {r.doc_id: r for r in sq.site_quality(spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string"), spark.createDataFrame(labels, "doc_id bigint, quality int"),
                                                "source", ["lang"]).collect()}
    assert got[200].site < 0.2 < got[201].site < 0.8 < got[202].site
    assert got[200].evidence == pytest.approx(got[202].evidence)


def test_logistic():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x @ np.array([2.0, -1.0, 0.0]) + 0.5 + rng.logistic(size=400) > 0).astype(float)
    w = sq.fit_logistic(x, y, ridge=1e-3)
    assert np.allclose(w, [2, -1, 0, 0.5], atol=0.6)
    assert np.isfinite(sq.fit_logistic(x, np.ones(400))).all()
