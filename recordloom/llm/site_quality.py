"""Document quality by hierarchical empirical Bayes: a document's own evidence with the posteriors of its path and host.

Counts of good documents are aggregated by path and host.  A path's rate is shrunk
toward its host's, a host's toward the global rate, as strongly as the groups'
spread says, so that a site with few documents says little.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import pieces_of, positional, take, written

#: Labelled documents that the document classifier is fitted on, about; all if there are fewer.
FIT_ROWS = 20_000
EVIDENCE_LIMIT = 12.0
POSTERIOR_FLOOR = 0.02
FEATURES = ("length", "word_chars", "upper", "digits", "symbols", "marked_words", "divider_words", "repeat_next", "distinct", "repeat_lines", "ended_lines", "blank_lines",
            "long_words", "all_caps", "one_char")


def shape(raw: bytes) -> list[float]:
    """Measures of a text's form, each between 0 and about 1."""
    text = raw.decode("utf-8", "replace")
    words = text.split()
    n = max(len(words), 1)
    chars = max(len(text), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(len(lines), 1)
    pairs = list(zip(words, words[1:], strict=False))
    return [
        min(np.log1p(len(words)) / 10, 1.5), min(sum(map(len, words)) / n / 12, 2.0), sum(map(str.isupper, words)) / n,
        sum(any(c.isdigit() for c in w) for w in words) / n, sum(text.count(c) for c in "#*$%&|<>") / chars,
        sum(len(w) > 2 and w[-1] == w[-2] and not w[-1].isalnum() for w in words) / n, sum(not any(map(str.isalnum, w)) for w in words) / n,
        sum(a == b for a, b in pairs) / n, len(set(pairs)) / max(len(pairs), 1), 1 - len(set(lines)) / m,
        sum(x.rstrip().endswith((".", "!", "?", "…", "\"", "”", "»")) for x in lines) / m, 1 - len(lines) / max(text.count("\n") + 1, 1),
        sum(len(w) > 24 for w in words) / n, sum(len(w) > 1 and w.isupper() for w in words) / n, sum(len(w) == 1 for w in words) / n,
    ]


def with_shape(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` without column ``text``, with its measures as array ``x``."""
    keep = [c for c in rows.columns if c != text]
    src = rows.select(F.struct(*keep).alias("row"), F.col(text).cast("binary").alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, 1):
            x = pa.array([shape(r or b"") for r in b.column(1).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), x], ["row", "x"])

    return src.mapInArrow(run, f"row {src.schema['row'].dataType.simpleString()}, x array<double>").select("row.*", "x")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights with the constant last, by Newton steps; none but the constant where ``y`` has one value."""
    z = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    keep = np.full(len(w), ridge)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + keep * w
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(keep + 1e-9)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _strength(rate: float, groups: float, rows: float, spread: float) -> float:
    """Prior strength (in documents) of a level, by moments: how much less its groups' rates vary than single documents do."""
    noise = rate * (1 - rate) * groups / max(rows, 1)
    between = max(spread - noise, 1e-6)
    return float(min(max(rate * (1 - rate) / between - 1, 1.0), 1e6))


@dataclass(frozen=True)
class Global:
    rate: float
    host_strength: float
    path_strength: float


def _logit(c: Column) -> Column:
    return F.log(c / (1 - c))


def site_quality(docs: DataFrame, labels: DataFrame, host: str, path: list[str], doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """Rows ``doc_id, host, path, evidence, site, score, kept``, one per row of ``docs``.

    ``host`` is a column, ``path`` columns below it.  ``evidence`` is the document
    classifier's log-odds against the global rate, fitted on about ``FIT_ROWS``
    labelled rows, drawn by hash.  A document counts as good by its label, or by its
    classifier's probability where it has none.  ``site`` is the path's posterior
    without the document itself; ``score`` joins both, and ``kept`` is 0.5 or more.

    Null hosts and paths are groups of their own; null texts count as empty; several
    labels of one id are averaged, ids without a document are ignored; without
    labels the rate is one half and evidence 0.  Repeated rows each get their row.
    """
    d, where = positional(docs)
    i, t = F.col(where[doc_id]), F.col(where[text])
    sep = F.lit("\x1f")
    rows = d.select(i.alias("doc_id"), F.coalesce(F.col(where[host]).cast("string"), F.lit("")).alias("host"),
                    F.concat_ws("\x1f", *[F.coalesce(F.col(where[p]).cast("string"), F.lit("")) for p in (host, *path)]).alias("path"),
                    F.xxhash64(i, t, sep).alias("k"), t.alias("text"))
    marked = take(labels, doc_id, label).toDF("doc_id", "y").where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.avg(F.col("y").cast("double")).alias("y"))
    f = written(with_shape(rows, "text").join(marked, "doc_id", "left"), "shape")
    known = f.where("y is not null")
    share = min(1.0, FIT_ROWS / max(known.count(), 1))
    sample = known.where(F.pmod("k", F.lit(1 << 30)) < int(share * (1 << 30))).select("x", "y").collect()
    if sample:
        x, y = np.array([r.x for r in sample]), np.array([r.y for r in sample])
        prior = float(np.clip(y.mean(), 0.01, 0.99))
        w = fit_logistic(x, y)
    else:
        prior, w = 0.5, np.zeros(len(FEATURES) + 1)
    terms = F.lit(float(w[-1] - np.log(prior / (1 - prior))))
    for j, v in enumerate(w[:-1].tolist()):
        terms = terms + F.element_at("x", j + 1) * v
    own = F.greatest(F.least(terms, F.lit(EVIDENCE_LIMIT)), F.lit(-EVIDENCE_LIMIT))
    s = f.select("doc_id", "host", "path", "y", (own if sample else F.lit(0.0)).alias("evidence"))
    s = s.withColumn("good", F.coalesce("y", 1 / (1 + F.exp(-(F.col("evidence") + float(np.log(prior / (1 - prior))))))))
    paths = s.groupBy("host", "path").agg(F.count("*").alias("np"), F.sum("good").alias("gp"))
    hosts = paths.groupBy("host").agg(F.sum("np").alias("nh"), F.sum("gp").alias("gh"))
    n, good, groups = hosts.agg(F.sum("nh"), F.sum("gh"), F.count("*")).first()
    rate = float(np.clip((good or 0.0) / n, 0.01, 0.99)) if n else prior
    spread = hosts.agg(F.sum(F.col("nh") * F.pow(F.col("gh") / F.col("nh") - rate, 2)) / F.sum("nh")).first()[0] or 0.0
    inner = paths.join(hosts, "host").agg(F.sum(F.col("np") * F.pow(F.col("gp") / F.col("np") - F.col("gh") / F.col("nh"), 2)) / F.sum("np"), F.count("*")).first()
    g = Global(rate, _strength(rate, groups or 0, n or 0, spread), _strength(rate, max((inner[1] or 0) - (groups or 0), 0), n or 0, inner[0] or 0.0))
    sites = paths.join(hosts, "host")
    j = s.join(sites, ["host", "path"])
    host_rate = (F.col("gh") - F.col("good") + g.host_strength * g.rate) / (F.col("nh") - 1 + g.host_strength)
    site = (F.col("gp") - F.col("good") + g.path_strength * host_rate) / (F.col("np") - 1 + g.path_strength)
    site = F.greatest(F.least(site, F.lit(1 - POSTERIOR_FLOOR)), F.lit(POSTERIOR_FLOOR))
    j = j.select("doc_id", "host", F.replace("path", sep, F.lit("/")).alias("path"), "evidence", site.alias("site"))
    j = j.withColumn("score", 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.col("site"))))))
    return j.withColumn("kept", F.col("score") >= 0.5)
