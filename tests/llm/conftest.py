import random

import pytest

EXTRA = {"TEXT": "other", "row": "r", "_k1": "x", "kept": "no", "n_words": "-", "sequence_id": "s", "fp": "f", "rules": "q"}
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make(spark):
    """Documents with extra columns whose names clash with inner and result columns."""

    def build(rows, extra=True):
        rows = [(i, t, "en" if k % 2 else None, "s" if k % 3 else None, len(t) if t else None) for k, (i, t) in enumerate(rows)]
        if not extra:
            return spark.createDataFrame(rows, SCHEMA)
        return spark.createDataFrame([(*r, *EXTRA.values()) for r in rows], ", ".join([SCHEMA, *[f"`{c}` string" for c in EXTRA]]))

    return build


@pytest.fixture(scope="session")
def prose():
    """Sentences of made-up words, always the same."""
    rng = random.Random(5)
    words = ["".join(rng.choice(["ba", "lo", "mi", "ter", "on", "esh", "u"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]

    def text(n, seed):
        r = random.Random(seed)
        out = []
        while len(out) < n:
            out += [w if i else w.capitalize() for i, w in enumerate(r.choice(words) for _ in range(9))]
            out[-1] += "." if r.random() < 0.8 else ".\n"
        return " ".join(out[:n]).replace("\n ", "\n")

    return text
