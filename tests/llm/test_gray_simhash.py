import random

import numpy as np
import pytest
from brute import components, simhash

from recordloom.llm import gray_simhash as gs
from recordloom.llm.common import connected_components, take


def near_values():
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(150)]
    v = [*base, 0, 1, 7, (1 << 64) - 1]
    v += [b ^ (1 << rng.randrange(64)) for b in base[:60] for _ in range(4)] + [base[0] ^ (3 << i) for i in range(60)] + [base[1] ^ i for i in range(300)]
    return sorted(set(v))


def test_index_finds_all_links():
    v = np.array(near_values(), np.uint64)
    index = gs.GrayIndex.build(v)
    got = {frozenset((int(index.values[i]), int(index.values[j]))) for a, b in index.links(np.uint64(0), step=100) for i, j in zip(a, b, strict=True)}
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 2
    assert got == {frozenset((int(v[i]), int(v[j]))) for i, j in zip(*np.nonzero(near), strict=True) if i < j}
    order = gs.gray_rank(np.arange(64, dtype=np.uint64) ^ np.arange(64, dtype=np.uint64) >> np.uint64(1))
    assert order.tolist() == list(range(64))


@pytest.mark.parametrize("limit", [4096, 5])
def test_links_span_the_components(spark, monkeypatch, limit):
    monkeypatch.setattr(gs, "PLACE_LIMIT", limit)
    v = near_values()
    gs.positional(spark.range(1))
    fps = spark.createDataFrame([(int(x),) for x in np.array(v, np.uint64).view(np.int64)], "fp bigint")
    roots = {r.node % 2**64: r.root % 2**64 for r in connected_components(gs.fingerprint_links(fps)).collect()}
    groups = {}
    for i, r in enumerate(components(v)):
        groups.setdefault(r, set()).add(v[i])
    got = {}
    for x in v:
        got.setdefault(roots.get(x, x), set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_components_of_chains(spark):
    e = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (7, 7), (None, 3)] + [(200, 200 + i) for i in range(1, 30)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(e, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90, **{200 + i: 200 for i in range(30)}}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_duplicates(spark, make, prose):
    long = prose(3000, 1)
    texts = [None, "", " \n", "one", "ONE", "one two", prose(300, 2), prose(300, 2).upper(), prose(300, 2) + " more", prose(300, 3), long, long + " and more", long.replace("ba", "bo", 1), "é" * 5, prose(300, 3)]
    rows = [(i * 3 + 5, t) for i, t in enumerate(texts)] + [(None, "one"), (None, "alone here you see"), (5, None)]
    docs = make(rows)
    fps = [simhash(t) for _, t in rows]
    root = components(fps)
    want = []
    for (i, _), fp, r in zip(rows, fps, root, strict=True):
        ids = [rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None]
        want.append((i, fp, min(ids, default=None)))
    got = [(r.doc_id, r.fp % 2**64, r.component_id) for r in gs.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = take(gs.keep_one(docs), "doc_id").collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in kept) == sorted({(c is None, c) for _, _, c in want})
    assert gs.near_duplicates(docs.limit(0)).count() == 0 and gs.keep_one(docs.limit(0)).count() == 0
