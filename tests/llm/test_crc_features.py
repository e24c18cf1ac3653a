import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from recordloom.llm import crc_features as C

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, longest):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def expected(docs, bench, longest, buckets, percent, min_words):
    feats = [plain_features(t, longest) for _, t in docs]
    count = lambda fs: Counter(zlib.crc32(f.encode()) % buckets for f in fs)
    s, t = count(f for _, fs in feats for f in fs), count(f for x in bench for f in plain_features(x, longest)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for (i, _), (words, fs) in zip(docs, feats, strict=True):
        w = sum(gain(zlib.crc32(f.encode()) % buckets) for f in fs)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words) >= min_words])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for n, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = n + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def sample(prose):
    rng = random.Random(2)
    odd = ["ÀÉ Straße NAÏVE a1B2", "文" * 500 + " ok " + "字" * 64, "x" * 63, "x" * 64, "x" * 65, "y" * 128, "z" * 1000, "\x00a\x7fb`c{d@E[F", "", None, "   ", "é", "KK İ"]
    docs = [(i, t) for i, t in enumerate(odd)] + [(100 + i, prose(rng.randint(1, 90), i)) for i in range(150)]
    return docs + [(None, prose(60, 3)), (300, prose(60, 3)), (301, prose(60, 3)), (301, prose(60, 3)), (302, prose(30000, 4))]


@pytest.mark.parametrize(("longest", "buckets", "percent", "min_words"), [(1, 10000, 10, 20), (3, 70000, 50, 1)])
def test_same_draw_as_plain_version(spark, make, prose, monkeypatch, longest, buckets, percent, min_words):
    monkeypatch.setattr(C, "PIECE", 3000)
    docs, bench = sample(prose), [prose(40, 7), None, "", prose(40, 8), "文字 é"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(bench)], "item_id bigint, text string")
    got = sorted((tuple(r) for r in C.resample(make(docs).repartition(6), target, longest=longest, buckets=buckets, percent=percent, min_words=min_words).collect()), key=repr)
    want = expected(docs, bench, longest, buckets, percent, min_words)
    assert got == want
    assert sum(r[4] is not None for r in got) == sum(r[4] is not None for r in want) > 10


def test_empty_tables(spark, make, prose):
    none = spark.createDataFrame([], "text string")
    assert C.resample(make([]), none).count() == 0
    docs = [(i, prose(30, i)) for i in range(30)]
    assert sorted((tuple(r) for r in C.resample(make(docs), none).collect()), key=repr) == expected(docs, [], 1, 10000, 10, 20)


def test_checksums_of_every_length():
    rng = np.random.default_rng(4)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts, lengths = rng.integers(0, 2000, 900), np.concatenate([rng.integers(1, 3000, 300), np.arange(1, 301), np.full(300, 7)])
    got = C.feature_crcs(data, starts, lengths)
    assert got.tolist() == [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]


def test_ranks_over_ranges(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "id % 7 as score").repartition(9)
    from pyspark.sql import functions as F

    got = sorted((r["rank"], r["doc_id"]) for r in C.ranked(df, F.desc("score"), F.col("doc_id")).collect())
    assert [d for _, d in got] == sorted(range(5000), key=lambda i: (-(i % 7), i)) and [n for n, _ in got] == list(range(1, 5001))
