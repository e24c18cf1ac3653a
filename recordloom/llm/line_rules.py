"""Line-first cleaning: every line is judged, failing lines go, then documents that lost too much text go."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import pieces_of, positional

# Sentence ends, symbols counted, menu words and stock phrases.
SENTENCE_ENDS = (".", "!", "?", "…", ";", ":", "\"", "”", "’", "'", ")", "»", "。", "！", "？")
SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
BLANKS = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
DIVIDERS = frozenset("| / > » › • · - – — :: || >> ←  →".split())
MENU_WORDS = frozenset("home about contact login logout register menu next previous search sitemap help faq share print top back "
                       "accueil inicio startseite suche buscar rechercher kontakt contacto".split())
STOCK_PHRASES = ("all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie", "javascript", "lorem ipsum",
                 "click here", "sign up", "subscribe to", "copyright", "powered by", "read more", "licensed under")


@dataclass(frozen=True)
class LineRules:
    """``max_loss``: largest share of a document's words that may be removed.  The other values bound one line."""

    max_loss: float = 0.5
    max_divider_share: float = 0.2
    max_marked_share: float = 0.3
    max_menu_share: float = 0.5
    stock_words: int = 40
    min_words: int = 50
    max_repeat_percent: int = 50


def punctuation_fails(words: list[str], rules: LineRules) -> bool:
    """No word ends a sentence, or too many words carry a run of marks at their end (``now!!``, ``price***``)."""
    marked = sum(len(w) > 2 and not w[-1].isalnum() and not w[-2].isalnum() and w[-1] == w[-2] for w in words)
    if marked > rules.max_marked_share * len(words):
        return True
    return not any(w.endswith(SENTENCE_ENDS) for w in words)


def navigation_fails(words: list[str], rules: LineRules) -> bool:
    """Dividers or menu words make up too much of the line."""
    if sum(w in DIVIDERS for w in words) > rules.max_divider_share * len(words):
        return True
    return sum(w.strip(".,:;!?").lower() in MENU_WORDS for w in words) > rules.max_menu_share * len(words)


def boilerplate_fails(line: str, words: list[str], rules: LineRules) -> bool:
    """A short line with a stock phrase."""
    return len(words) <= rules.stock_words and any(p in line for p in STOCK_PHRASES)


def clean_text(text: str, rules: LineRules) -> tuple[str, int]:
    """The text without failing lines, and the number of words kept.  Lines without a word stay where they are."""
    kept, n = [], 0
    for line in text.split("\n"):
        words = line.encode("utf-8", "replace").split()
        if words:
            strs = [w.decode("utf-8", "replace") for w in words]
            if punctuation_fails(strs, rules) or navigation_fails(strs, rules) or boilerplate_fails(line.lower(), strs, rules):
                continue
            n += len(words)
        kept.append(line)
    return "\n".join(kept), n


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more, the first find included."""
    n = len(words)
    if n < 4:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
    _, pair = np.unique(ids[:-2] * len(codes) + ids[1:-1], return_inverse=True)
    _, window, counts = np.unique(pair * len(codes) + ids[2:], return_inverse=True, return_counts=True)
    if len(counts) == n - 2:
        return 0
    hit = np.zeros(n + 2, bool)
    again = counts[window] > 1
    hit[: n - 2] |= again
    hit[1 : n - 1] |= again
    hit[2:n] |= again
    return int(hit.sum())


def measures(raw: bytes) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text."""
    words = raw.split()
    chars = len(raw.decode("utf-8", "replace")) - sum(raw.count(c) for c in BLANKS)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(words), chars, sum(raw.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeat_words(words)


RESULT = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,base_failed:boolean,n_kept_words:bigint,kept:boolean,clean:string>"
_FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
           ("base_failed", pa.bool_()), ("n_kept_words", pa.int64()), ("kept", pa.bool_()), ("clean", pa.string())]


def line_rules(docs: DataFrame, text: str = "text", result: str = "rules", rules: LineRules = LineRules(), with_text: bool = True) -> DataFrame:
    """``docs`` with one struct column ``result`` added (see ``RESULT``); every row and column is kept.

    Words are runs of other characters than blank and tab to carriage return.
    Null text: counts 0, not kept, ``clean`` null.  Empty text: the same with an
    empty ``clean``.  Repeated rows each get their row; an empty table gives an
    empty table.  A column of ``docs`` that is already named ``result`` stays, so
    choose another name then.  ``with_text`` False leaves ``clean`` null.
    """
    d, where = positional(docs)
    row = F.struct(*[F.col(c) for c in d.columns]).alias("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, 1):
            out: list[tuple] = []
            for raw in b.column(1).to_pylist():
                m = measures(raw or b"")
                bad = m[0] < rules.min_words or 100 * m[4] > rules.max_repeat_percent * m[0]
                clean, n = clean_text(raw.decode("utf-8", "replace"), rules) if raw and not (bad and not with_text) else (None if raw is None else "", 0)
                kept = not bad and m[0] - n <= rules.max_loss * m[0]
                out.append((*m, bad, n, kept, clean if with_text else None))
            cols = [pa.array(x, t) for x, (_, t) in zip(zip(*out, strict=True), _FIELDS, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.StructArray.from_arrays(cols, [n for n, _ in _FIELDS])], ["row", "res"])

    src = d.select(row, F.col(where[text]).cast("binary").alias("raw"))
    res = src.mapInArrow(run, f"row {src.schema['row'].dataType.simpleString()}, res {RESULT}")
    return res.select(*[F.col("row").getField(c) for c in d.columns], "res").toDF(*docs.columns, result)
