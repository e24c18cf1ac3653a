import zlib

import public_tokenizers
from brute import components, similar_groups, simhash, without_long_repeats, without_repeats
from tokenizers import Tokenizer

import corpus_pipeline
from recordloom.llm.common import take
from recordloom.llm.line_rules import LineRules, clean_text, measures

ITEM = "The baker sold 12 loaves and 3 pies before noon while Maria counted 12 coins near the old mill."


def corpus(prose):
    passage = prose(130, 77)
    texts = [prose(80, 1), prose(80, 1), prose(90, 2) + "\nHome | About | Login | Help\n", prose(30, 3), " | ".join(prose(90, 4).split()), None, "", f"{prose(60, 5)} {passage} {prose(60, 6)}",
             f"{prose(70, 7)} {passage}", f"{prose(70, 8)} {ITEM} {prose(40, 9)}", prose(2600, 10), prose(55, 11), prose(400, 12), prose(400, 12) + " and", "now!! " * 80]
    near = prose(400, 12).split()
    for k in range(8):  # similar by shingles, but not within two bits
        near[20 + 48 * k] = f"other{k}"
    short = prose(52, 21)  # a passage of over 50 words and under 400 bytes
    texts += [" ".join(near), f"{prose(60, 31)} {short} {prose(60, 32)}", f"{prose(70, 33)} {short}"]
    return [(i, t) for i, t in enumerate(texts)] + [(11, texts[11]), (None, prose(66, 13))]


def test_stages_against_plain_versions(spark, make, prose, tmp_path):
    rows = corpus(prose)
    sf_dir = str(tmp_path)
    make(rows, extra=False).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id bigint, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    docs, plain = spark.read.parquet(f"{sf_dir}/documents.parquet"), rows

    def step(i):
        nonlocal docs
        docs = corpus_pipeline.written(corpus_pipeline.STAGES[i][1](spark, docs, sf_dir), "test")
        return docs

    def same():
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        got = take(docs, "doc_id", "text", "n_chars").collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(plain, key=repr)
        assert all(r.n_chars == len(r.text) for r in got)

    step(0)
    rules, kept = LineRules(), []
    for i, t in plain:
        m = measures((t or "").encode())
        if t and m[0] >= 50 and 100 * m[4] <= 50 * m[0]:
            clean, n = clean_text(t, rules)
            if m[0] - n <= rules.max_loss * m[0]:
                kept.append((i, clean))
    plain = kept
    assert {i for i, _ in plain} >= {0, 1, 2, 7, 9, 10, 11, None} and not {3, 4, 5, 6, 14} & {i for i, _ in plain}
    same()

    step(1)
    root = similar_groups([t for _, t in plain])
    assert root != components([simhash(t) for _, t in plain])
    best = {}
    for (i, t), r in zip(plain, root, strict=True):
        best[r] = min(best.get(r, (i is None, i, t)), (i is None, i, t))
    plain = [(i, t) for _, i, t in best.values()]
    assert 1 not in {i for i, _ in plain} and sum(i == 11 for i, _ in plain) == 1
    same()

    step(2)
    raw = [t.encode() for _, t in plain]
    left = without_long_repeats(raw)
    assert left != [x[0] for x in without_repeats(raw)]
    plain = [(i, x.decode("utf-8", "ignore")) for (i, _), x in zip(plain, left, strict=True)]
    assert any(x != y for x, y in zip(plain, rows, strict=False))
    same()

    step(3)
    plain = [(i, t) for i, t in plain if ITEM not in t]
    assert 9 not in {i for i, _ in plain} and len(plain) > 5
    same()

    step(4)
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in plain:
        ids = [*lib.encode(t, add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), 2048):
            part = ids[s : s + 2048]
            want.append((i, s, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)), len(ids)))
    got = docs.collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(tuple, whole), key=repr) == sorted(map(tuple, got), key=repr)


def test_empty_and_extra_columns(spark, make, prose, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make(corpus(prose))
    for d in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            d = stage(spark, d, str(tmp_path))
            assert d.columns == docs.columns
            d.count()
        assert corpus_pipeline.STAGES[-1][1](spark, d, str(tmp_path)).count() >= 0


def test_near_copies_by_fingerprints_too(spark, make, prose, tmp_path):
    """texts that repeat one passage have fingerprints within two bits though their shingle sets differ; a chain may use both kinds of links."""
    passage = " ".join(prose(11, 41).split()[:11])
    texts = [" ".join([passage] * 20 + prose(30, k).split()[:30]) for k in (42, 43)]
    near = texts[1].split()
    near[-1] = "other"
    rows = [(1, texts[0]), (2, texts[1]), (3, prose(80, 44)), (4, " ".join(near))]
    fps = [simhash(t) for _, t in rows]
    assert (fps[0] ^ fps[1]).bit_count() <= 2 and len(set(similar_groups([t for _, t in rows]))) == 3
    kept = take(corpus_pipeline.near_copies(spark, make(rows), str(tmp_path)), "doc_id").collect()
    assert sorted(r.doc_id for r in kept) == [1, 3]
