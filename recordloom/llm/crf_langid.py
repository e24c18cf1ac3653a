"""Language of words by a linear-chain conditional random field, and of texts by their words.

Words carry hashed affix, n-gram and lexicon (whole word) features.  Emission and
transition weights are learned together by maximum likelihood; forward-backward
gives each word's distribution, also where a text switches languages.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import pieces_of, take

BUCKETS = 1 << 17
GRAMS = (2, 3, 4)
AFFIXES = (2, 3, 4)
CHAIN = 96
#: Bounds of the training sample: documents of a language (about), words of a language, rounds.
DOCS_PER_LANG, WORDS_PER_LANG, ROUNDS = 300, 60_000, 40
UND = "und"
CACHE_ENTRIES = 500_000
U = np.uint64


# ---- words and features


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """``codes, text, vocabulary, begins`` of the letter runs of texts: a code for each word, its text's number, the different words, and where chains begin.

    A chain ends with its line or after ``CHAIN`` words.
    """
    letters = pc.utf8_lower(pc.replace_substring_regex(texts, pattern=r"[^\p{L}\n]+", replacement=" "))
    lines = pc.split_pattern(letters, "\n")
    line_text = pc.list_parent_indices(lines).to_numpy()
    split = pc.split_pattern_regex(pc.utf8_trim(pc.list_flatten(lines), " "), " +")
    flat = pc.list_flatten(split)
    line = pc.list_parent_indices(split).to_numpy()
    full = pc.not_equal(flat, "")
    flat, line = flat.filter(full), line[full.to_numpy(zero_copy_only=False)]
    coded = flat.dictionary_encode()
    n = len(flat)
    new = np.concatenate(([True], line[1:] != line[:-1])) if n else np.zeros(0, bool)
    at = np.flatnonzero(new)
    place = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
    return coded.indices.to_numpy(), line_text[line], coded.dictionary, np.flatnonzero(place % CHAIN == 0)


def features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``word, bucket`` pairs: n-grams of the word between marks, its first and last bytes, and the word itself."""
    raw = [b"^" + w + b"$" for w in words.cast(pa.binary()).to_pylist()]
    data = np.frombuffer(b"".join(raw) + bytes(8), np.uint8)
    size = np.array([len(r) for r in raw], np.int64)
    end = np.cumsum(size)
    start = end - size
    word = np.repeat(np.arange(len(raw)), size)
    n = len(word)
    left = np.repeat(end, size) - np.arange(n)
    who, what = [], []

    def add(at: np.ndarray, h: np.ndarray, salt: int, owner: np.ndarray) -> None:
        h = (h + U(salt)) * U(0x9E3779B97F4A7C15)
        who.append(owner)
        what.append(((h ^ h >> U(32)) % U(BUCKETS)).astype(np.int64))

    h = np.zeros(n, U)
    for length in range(1, max(*GRAMS, *AFFIXES) + 1):
        h = h * U(263) + data[length - 1 : length - 1 + n]
        if length in GRAMS:
            at = np.flatnonzero(left >= length)
            add(at, h[at], length << 40, word[at])
        if length in AFFIXES:
            able = np.flatnonzero(size >= length + 2)
            add(able, h[start[able] + 1], length << 41 | 1 << 50, able)
            add(able, h[end[able] - 1 - length], length << 41 | 1 << 51, able)
    power = np.cumprod(np.full(int(size.max(initial=1)), U(0x100000001B3)), dtype=U)
    whole = np.add.reduceat(data[:n].astype(U) * power[np.arange(n) - np.repeat(start, size)], start) if n else np.zeros(0, U)
    add(start, whole, 1 << 52, np.arange(len(raw)))
    return np.concatenate(who), np.concatenate(what)


# ---- model


@dataclass
class Crf:
    langs: list[str]
    emission: np.ndarray  # bucket, language
    transition: np.ndarray  # from, to
    start: np.ndarray

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, langs=np.array(self.langs, dtype=np.str_), emission=self.emission, transition=self.transition, start=self.start)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Crf:
        z = np.load(io.BytesIO(raw))
        return cls(z["langs"].tolist(), z["emission"], z["transition"], z["start"])

    def scores(self, words: pa.Array) -> np.ndarray:
        who, what = features(words)
        return np.stack([np.bincount(who, self.emission[what, k], minlength=len(words)) for k in range(len(self.langs))], axis=1)


def _grids(begins: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chains of like length side by side: positions (chain, step) and which of them exist."""
    size = np.diff(np.append(begins, n))
    step = -(-size // 16)
    for s in np.unique(step):
        b, z = begins[step == s], size[step == s]
        t = np.arange(z.max())
        inside = t[None, :] < z[:, None]
        yield np.minimum(b[:, None] + t[None, :], n - 1), inside


def forward_backward(score: np.ndarray, inside: np.ndarray, transition: np.ndarray, start: np.ndarray, count: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (chain, step, language) and, if ``count``, expected transitions of chains; ``score`` holds emission scores."""
    chains, steps, langs = score.shape
    e = np.exp(score - score.max(axis=2, keepdims=True))
    a = np.exp(transition)
    alpha = np.empty_like(e)
    now = np.exp(start)[None, :] * e[:, 0]
    alpha[:, 0] = now / now.sum(1, keepdims=True)
    for t in range(1, steps):
        now = alpha[:, t - 1] @ a * e[:, t]
        now /= now.sum(1, keepdims=True)
        alpha[:, t] = np.where(inside[:, t, None], now, alpha[:, t - 1])
    beta = np.ones((chains, langs))
    post = np.empty_like(e)
    pairs = np.zeros((langs, langs))
    for t in range(steps - 1, -1, -1):
        p = alpha[:, t] * beta
        post[:, t] = p / p.sum(1, keepdims=True)
        if t:
            back = beta * e[:, t]
            live = inside[:, t]
            if count:
                joint = alpha[live, t - 1, :, None] * a[None] * back[live, None, :]
                pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            prior = back @ a.T
            beta = np.where(live[:, None], prior / prior.sum(1, keepdims=True), beta)
    return post * inside[:, :, None], pairs


def train(texts: list[tuple[str, str]], rounds: int = ROUNDS, seed: int = 7, rate: float = 0.25, decay: float = 1e-4) -> Crf | None:
    """Fit on (language, text) pairs; every word has its text's language.

    Half of the chains are joined from the beginning of one and the end of another, so that changes of language are learned too.
    """
    texts = sorted(t for t in texts if t[1])
    langs = sorted({t[0] for t in texts})
    if not langs:
        return None
    codes, owner, vocabulary, begins = words_of(pa.array([t[1] for t in texts], pa.string()))
    if not len(codes):
        return None
    label = np.array([langs.index(t[0]) for t in texts])[owner]
    keep = np.zeros(len(codes), bool)
    for k in range(len(langs)):
        keep[np.flatnonzero(label == k)[:WORDS_PER_LANG]] = True
    rng = np.random.default_rng(seed)
    chains = [c for c in np.split(np.arange(len(codes)), begins[1:]) if keep[c].all()] or [np.arange(len(codes))[keep][:CHAIN]]
    order = rng.permutation(len(chains))
    mixed = [np.concatenate((chains[i][: len(chains[i]) // 2], chains[j][len(chains[j]) // 2 :])) for i, j in zip(order[0::2], order[1::2], strict=False)]
    chains = [c for c in chains + mixed if len(c)]
    at = np.concatenate(chains)
    code, label = codes[at], label[at]
    begins = np.cumsum([0, *map(len, chains[:-1])])
    who, what = features(vocabulary)
    used, what = np.unique(what, return_inverse=True)
    k, n = len(langs), len(code)
    shape = {"w": (len(used), k), "t": (k, k), "s": (k,)}
    x = {name: np.zeros(s) for name, s in shape.items()}
    m1, m2 = {name: np.zeros(s) for name, s in shape.items()}, {name: np.zeros(s) for name, s in shape.items()}
    first = np.zeros(n, bool)
    first[begins] = True
    follow = np.flatnonzero(~first)
    seen = np.zeros((k, k))
    np.add.at(seen, (label[follow - 1], label[follow]), 1)
    grids = list(_grids(begins, n))
    for step in range(1, rounds + 1):
        score = np.stack([np.bincount(who, x["w"][what, j], minlength=len(vocabulary)) for j in range(k)], axis=1)[code]
        diff, pairs, start = np.zeros((n, k)), np.zeros((k, k)), np.zeros(k)
        for grid, inside in grids:
            post, p = forward_backward(score[grid], inside, x["t"], x["s"])
            diff[grid[inside]] = post[inside]
            pairs += p
            start += post[:, 0].sum(0)
        diff[np.arange(n), label] -= 1
        by_word = np.stack([np.bincount(code, diff[:, j], minlength=len(vocabulary)) for j in range(k)], axis=1)
        grad = {"w": np.stack([np.bincount(what, by_word[who, j], minlength=len(used)) for j in range(k)], axis=1) / n + decay * x["w"],
                "t": (pairs - seen) / n + decay * x["t"], "s": (start - np.bincount(label[begins], minlength=k)) / len(begins) + decay * x["s"]}
        for name, g in grad.items():
            m1[name] = 0.9 * m1[name] + 0.1 * g
            m2[name] = 0.99 * m2[name] + 0.01 * g * g
            x[name] -= rate * (m1[name] / (1 - 0.9**step)) / (np.sqrt(m2[name] / (1 - 0.99**step)) + 1e-8)
    emission = np.zeros((BUCKETS, k), np.float32)
    emission[used] = x["w"]
    return Crf(langs, emission, x["t"], x["s"])


# ---- Spark


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _as_text(col: pa.Array) -> pa.Array:
    try:
        return col.fill_null(b"").cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([(r or b"").decode("utf-8", "replace") for r in col.to_pylist()], pa.string())


def fit(docs: DataFrame) -> Crf | None:
    """A model from a bounded sample of ``doc_id, text, lang`` rows that are not held out: about ``DOCS_PER_LANG`` documents of a language, drawn by a hash of the text.

    The sample goes to one task, which reads ``WORDS_PER_LANG`` words of a language at most.
    """
    d = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    counts = {r[0]: r[1] for r in d.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, DOCS_PER_LANG / n)))])
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        rows = []
        for b in batches:
            for lang, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if held.get(lang, 0) < 12 * WORDS_PER_LANG:  # bytes, far beyond the words that are read
                    held[lang] = held.get(lang, 0) + len(raw)
                    rows.append((lang, raw.decode("utf-8", "replace")))
        model = train(rows)
        if model is not None:
            yield pa.RecordBatch.from_arrays([pa.array([model.dump()], pa.binary())], ["model"])

    sample = d.where(drawn).select("lang", F.col("text").cast("binary").alias("raw")).repartition(1)
    found = sample.mapInArrow(run, "model binary").collect()
    return Crf.load(bytes(found[0][0])) if found else None


class WordScores:
    """Emission scores of words met in this worker, so that a common word's features are hashed once.  Emptied at ``CACHE_ENTRIES``."""

    def __init__(self, model: Crf):
        self.model, self.rows, self.table = model, {}, np.zeros((0, len(model.langs)))

    def of(self, vocabulary: pa.Array) -> np.ndarray:
        if len(self.rows) > CACHE_ENTRIES:
            self.__init__(self.model)
        words = vocabulary.to_pylist()
        new = [w for w in words if w not in self.rows]
        if new:
            self.table = np.concatenate((self.table, self.model.scores(pa.array(new, pa.string()))))
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
        return self.table[np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))]


def label_texts(texts: pa.Array, model: WordScores) -> tuple[list[str], list[float]]:
    """Language and score of texts: the mean of their words' posteriors; ``und`` and 0 without a word."""
    code, owner, vocabulary, begins = words_of(texts)
    scorer, model = model, model.model
    sums = np.zeros((len(texts), len(model.langs)))
    if len(code):
        score = scorer.of(vocabulary)
        for grid, inside in _grids(begins, len(code)):
            for a in range(0, len(grid), 4096):
                g, i = grid[a : a + 4096], inside[a : a + 4096]
                post, _ = forward_backward(score[code[g]], i, model.transition, model.start, False)
                for k in range(len(model.langs)):
                    sums[:, k] += np.bincount(owner[g[i]], post[i][:, k], minlength=len(texts))
    total = sums.sum(1)
    best = sums.argmax(1)
    lang = [model.langs[k] if t > 0 else UND for k, t in zip(best.tolist(), total.tolist(), strict=True)]
    return lang, np.where(total > 0, sums.max(1) / np.maximum(total, 1e-9), 0.0).clip(0, 1).tolist()


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows ``doc_id, held_out, lang_pred, score``, one per row of ``docs``.

    Learned from the texts and non-null languages of rows whose crc32 of the id
    modulo 5 is not 0; null ids and texts are not learned from.  Null texts, texts
    without a letter, and all texts where nothing could be learned: ``und``, score
    0.  Ties go to the language first by name; repeated rows each get their row.
    """
    d = take(docs, doc_id, text, lang).toDF("doc_id", "text", "lang")
    model = fit(d)
    shared = d.sparkSession.sparkContext.broadcast(model.dump() if model else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = WordScores(Crf.load(shared.value)) if shared.value else None
        for b in pieces_of(batches, 2):
            lang, score = label_texts(_as_text(b.column(2)), crf) if crf else ([UND] * b.num_rows, [0.0] * b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = d.schema["doc_id"].dataType.simpleString()
    src = d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("raw"))
    return src.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
