import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recordloom.llm import pack_hist
from recordloom.llm import token_counts as tc
from recordloom.llm.pack_hist import WordIds, pack, packing_patterns, token_pieces
from recordloom.llm.pretokens import SAFE

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n\n  x \n", "a <|endoftext|>  b<|startoftext|>c", "it's I'LL we'Re 12 3½ ²x — “q” …", "İstanbul ΣΑΣ ok", "日本 語 é é", "x\x1cy\x85z \xa0\n q", "a\xadb ı ĸ ŉ ſ", "'s  's",
       "<|endoftext|><|endoftext|> ", "tab\t\t end  "]


def test_counts(spark, make, prose):
    rows = [*enumerate(ODD), (98, None), (None, prose(70, 1)), (97, prose(30000, 2)), (3, ODD[3])]
    got = tc.token_counts(make(rows), BYTE).collect()
    lib = Tokenizer.from_file(BYTE)
    want = [(i, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert tc.token_counts(make(rows).limit(0), BYTE).count() == 0


def test_parts_of_a_text_add_up():
    enc, ids = tc.Encoder(BYTE), WordIds(WORD)
    for t in [*ODD, "word " * 50]:
        assert enc.direct(t, 3) == len(enc.lib.encode(t, add_special_tokens=False).ids)
        assert ids.direct(t, 3) == ids.whole(t) == ids.ids(t)


def test_new_words_cost_no_whole_encoding(monkeypatch):
    """Words that a worker has not met go to the library's model alone, also with a full cache; their ids are the library's."""
    ids = WordIds(WORD)
    texts = [t for t in ODD if SAFE.fullmatch(t)] + [" ".join(f"na{chr(97 + i % 26)}ïve{i}'s,œuvre{i}!'S'" for i in range(k, k + 40)) for k in range(0, 400, 20)]
    want = [ids.whole(t) for t in texts]
    monkeypatch.setattr(pack_hist, "CACHE_ENTRIES", 7)
    monkeypatch.setattr(WordIds, "whole", None)
    assert len(texts) > 20 and [ids.ids(t) for t in texts] == want


def test_patterns_hold_every_length():
    hist = {2048: 3, 2047: 1, 1500: 4, 1024: 5, 600: 2, 500: 4, 100: 31, 48: 2, 1: 9}
    pats = packing_patterns(hist)
    seen = {}
    for p, n in pats:
        assert sum(p) <= 2048 and n > 0
        for x in p:
            seen[x] = seen.get(x, 0) + n
    assert seen == hist and packing_patterns({}) == []


@pytest.mark.parametrize("copies", [1, 3])
def test_packing_is_gapless(spark, make, prose, copies):
    rows = ([*enumerate(ODD), (98, None), (None, prose(70, 1)), (97, prose(9000, 2)), (96, prose(500, 3))] + [(1000 + i, prose(40 + i % 3, 4)) for i in range(90)]) * copies
    lib = Tokenizer.from_file(WORD)
    p = token_pieces(make(rows), WORD).collect()
    by = {}
    for r in p:
        by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    want = {}
    for i, t in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        want.setdefault((i, len(ids)), []).append(ids)
    assert by.keys() == want.keys()
    for key, many in want.items():
        got = sorted((r.start, bytes(r.ids)) for r in by[key])
        assert got == sorted((s, b"".join(x.to_bytes(4, "little") for x in ids[s : s + 2048])) for ids in many for s in range(0, len(ids), 2048))
    packed = pack(token_pieces(make(rows), WORD).drop("ids"), buckets=5).collect()
    assert len(packed) == len(p)
    seq = {}
    for r in packed:
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(seq) == list(range(len(seq)))
    for parts in seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert pack(token_pieces(make(rows).limit(0), WORD).drop("ids")).count() == 0
