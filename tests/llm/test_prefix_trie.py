import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from recordloom.llm import prefix_trie as P

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def rebuilt(rows):
    convs = defaultdict(list)
    for c, n, role, text in rows:
        convs[c].append((n is not None, n or 0, role or "", text or ""))
    convs = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, own in convs.items():
        if c is None:
            out[c] = own
            continue
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def expected(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    low = {n: min((c for c in m if c is not None), default=None) for n, m in members.items()}
    out = []
    for n, m in members.items():
        subtree = [x for x in members if x[: len(n)] == n]
        kids = [x for x in subtree if len(x) == len(n) + 1]
        leaves = sum(not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in members) for x in subtree)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in subtree if x)
        ends = ",".join(str(c) for c in sorted(c for c in m if c is not None and len(convs[c]) == len(n)))
        out.append((low[n], len(n), low[n[:-1]] if n else None, len(m), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def sample():
    hello = [("system", "be brief"), ("user", "hello"), ("assistant", "hi there"), ("user", "é?")]
    rows = []
    for c in range(-7, 60):
        for n, (role, text) in enumerate(hello[: c % 5] + [("user", f"q{c % 3}"), ("assistant", "x" * (c % 7))] * (c % 4)):
            rows.append((c, n, role, text))
    rows += [(100, None, None, "null turn"), (100, None, "a", None), (100, 0, "user", "same"), (100, 0, "user", "same"), (103, 5, "b", "tie"), (103, 5, "a", "tie")]
    rows += [(201, 1, "user", "no base"), (None, 0, "user", "hello"), (None, 1, "user", "no id"), (305, 0, "user", "ab"), (309, 0, "userab", "")]
    rows += [(400, n, "user", f"long {n % 3}") for n in range(3000)] + [(401, n, "user", f"long {n % 3}") for n in range(300)]
    return rows


@pytest.mark.parametrize("limits", [{}, {"SHARD_ROWS": 50, "HEAVY": 2, "ID_PIECE": 3}])
def test_same_nodes_as_plain_version(spark, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(P, k, v)
    rows = [r for r in sample() if r[0] not in (400, 401)]
    df = spark.createDataFrame([(*r, "c") for r in rows], SCHEMA + ", depth string").repartition(7)
    got = sorted((tuple(r) for r in P.prefix_nodes(df).collect()), key=repr)
    assert got == expected(rows)


def test_long_conversation(spark):
    rows = [r for r in sample() if r[0] in (400, 401)]
    got = {(r["conv_id"], r["depth"]): r for r in P.prefix_nodes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 3001 and got[(400, 0)]["n_leaves"] == 1 and got[(400, 300)]["n_convs"] == 2
    assert got[(400, 300)]["saved_tokens"] == 6 and got[(400, 0)]["saved_tokens"] == 300 * 6


def test_many_equal_conversations(spark):
    rows = [(5 * c, n, "user", f"turn {n}") for c in range(600) for n in range(3)]
    got = sorted((tuple(r) for r in P.prefix_nodes(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == expected(rows)


def test_empty_table(spark):
    assert P.prefix_nodes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    k = rng.integers(0, 1 << 62, (5000, 2)).astype(np.uint64)
    k[:50, 1] = k[0, 1]
    k[50:90, 0] = k[50, 0]
    t = P.SlotTable.build(k[:, 0], k[:, 1])
    assert sorted(t.slots(k[:, 0], k[:, 1]).tolist()) == list(range(5000))
    with pytest.raises(ValueError):
        t.slots(k[:1, 0], k[:1, 1] + np.uint64(1))
