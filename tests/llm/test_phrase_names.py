import hashlib
import random

import numpy as np
import pytest
from recordloom.llm import phrase_names as P

M = (1 << 64) - 1


def mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & M
    x = (x ^ x >> 27) * 0x94D049BB133111EB & M
    return x ^ x >> 31


def plain_level(names):
    """One level by the rules in words: runs, labels from four rounds of coin tossing, phrases from local maxima."""
    runs = []
    for x in names:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    names = [x if n == 1 else mix(x ^ n * 0x9E3779B97F4A7C15 & M) for x, n in runs]
    labels = names
    for r in range(4):
        out = []
        for i, x in enumerate(labels):
            left = labels[i - 1] if i else (0 if r == 0 or x else 1)
            d = x ^ left
            place = (d & -d).bit_length() - 1
            out.append(2 * place + (x >> place & 1))
        labels = out
    begins = [0, *[i for i in range(1, len(labels) - 1) if labels[i - 1] < labels[i] > labels[i + 1]]]
    return [mix(sum(mix((x + (k + 1) * 0xD1342543DE82EF95) & M) for k, x in enumerate(names[a:b])) & M) for a, b in zip(begins, [*begins[1:], len(names)], strict=True)]


def plain_names(text, first_level=2):
    names, level, out = [mix(ord(c) + 1) for c in text], 0, []
    while names:
        if level >= first_level or len(names) == 1:
            out += names
        if len(names) == 1:
            return sorted(out)
        names, level = plain_level(names), level + 1
    return out


def texts():
    rng = random.Random(3)
    words = ["ab", "aaaa", "é", "文字", "x", "1.5", "\n"]
    return ["", "a", "aa", "ab", "aba", "a" * 500, "ab" * 300, *["".join(rng.choice(words) for _ in range(rng.randint(1, 400))) for _ in range(60)]]


@pytest.mark.parametrize("window", [1 << 20, 7])
def test_same_names_as_plain_version(monkeypatch, window):
    monkeypatch.setattr(P, "WINDOW", window)
    t = texts()
    names, of = P.phrase_names(t)
    for i, text in enumerate(t):
        assert sorted(names[of == i].tolist()) == plain_names(text), text


def test_equal_substrings_share_interior_names(prose):
    inner = prose(300, 1)
    a, b = P.phrase_names([prose(40, 2) + inner + prose(30, 3), "x" + inner + prose(77, 4)], 1), P.phrase_names([inner], 1)
    left, right = (set(a[0][a[1] == i].tolist()) for i in (0, 1))
    own = set(b[0].tolist())
    assert len(own & left & right) > 0.85 * len(own)


def test_likeness(prose):
    t = [prose(400, 1), prose(400, 1), prose(400, 2), prose(400, 1)[:-50] + "other end", "", ""]
    f = P.fingerprints(t)
    near = lambda i, j: float(P.likeness(f[i : i + 1], f[j : j + 1])[0])
    assert near(0, 1) == 1 and near(4, 5) == 1 and near(0, 2) < 0.15 and near(0, 3) > 0.75 and near(0, 4) < 0.05
    assert (P.fingerprints(t[2:3])[0] == f[2]).all()  # whatever else is in the batch


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        m = len(t) // 3
        e = t[: len(t) - m] + after[:m]
        f = P.fingerprints([t, e, after])
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), f[0].tobytes().hex(), f[1].tobytes().hex(), float(P.likeness(f[:1], f[1:2])[0]), float(P.likeness(f[:1], f[2:])[0])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("case", ["many", "one", "small batches"])
def test_neighbours(make, prose, monkeypatch, case):
    if case == "small batches":
        monkeypatch.setattr(P, "BATCH_CHARS", 50)
    rows = [(7 * i % 101, prose(1 + i % 37, i)) for i in range(101)] + [(500, None), (-3, ""), (None, "no id"), (2**63 - 1, "é" * 4000), (-(2**63), "lowest"), (501, prose(6000, 9))]
    rows = rows[:1] if case == "one" else rows
    got = sorted((tuple(r) for r in P.neighbour_prints(make(rows).repartition(5)).collect()), key=repr)
    assert got == expected(rows)


def test_repeated_rows_and_empty_table(make, prose):
    rows = [(1, prose(50, 1))] * 40 + [(2, prose(50, 2)), (2, prose(50, 2))]
    got = P.neighbour_prints(make(rows)).collect()
    assert sum(r["near_next"] == 1 for r in got) == 40 and len(got) == 42 and len({r["fingerprint"] for r in got}) == 2
    assert P.neighbour_prints(make([])).count() == 0


def test_bins_without_names_fill_alike():
    a, b = P.fingerprints(["short text"])[0], P.fingerprints(["short text", "x" * 9])[0]
    assert (a == b).all() and len(np.unique(a)) > 1
