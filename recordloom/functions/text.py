"""Text expressions shared by every operator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ARROW = "┖→"


# Every text function below names its argument once: lambdas are interpreted, so a
# second mention would compute the argument again, and mentions nest.
def clean_blanks(c: Column) -> Column:
    """No-break space to blank, zero-width space and BOM removed; null to empty.  Byte searches that leave most texts as they are."""
    t = F.replace(F.coalesce(c, F.lit("")), F.lit("\u00a0"), F.lit(" "))
    return F.replace(F.replace(t, F.lit("\u200b"), F.lit("")), F.lit("\ufeff"), F.lit(""))


# White space as the trims see it.
SPACE = " \t\n\r\f\x0b"


def strip(c: Column) -> Column:
    """White space cut off both ends, without a regular expression."""
    return F.btrim(c, F.lit(SPACE))


def squeeze(c: Column) -> Column:
    """Every run of white space becomes one blank, ends trimmed.  A single blank is no match, so most texts stay as they are."""
    return F.trim(F.regexp_replace(clean_blanks(c), r"\s{2,}|[\t\n\x0B\f\r]", " "))


def compact(c: Column) -> Column:
    """All white space removed."""
    rare = F.regexp_replace(F.coalesce(c, F.lit("")), r"[\t\n\x0B\f\r\u00a0\u200b\ufeff]+", "")
    return F.replace(rare, F.lit(" "), F.lit(""))


def is_blank(c: Column) -> Column:
    """Null, empty or white space only (0 is a value, not blank)."""
    return F.btrim(F.coalesce(c.cast("string"), F.lit("")), F.lit(SPACE + "\u00a0\u200b\ufeff")) == ""


def blank_to_null(c: Column) -> Column:
    return F.when(is_blank(c), F.lit(None)).otherwise(c)


def fill_empty(cur: Column, other: Column) -> Column:
    """Keep ``cur`` unless it is blank."""
    return F.coalesce(blank_to_null(cur), blank_to_null(other), F.lit(""))


def contains_any(c: Column, words: list[str] | tuple[str, ...]) -> Column:
    """Does ``c`` contain one of ``words``: byte searches that stop at the first hit."""
    cond = F.contains(c, F.lit(words[0]))
    for w in words[1:]:
        cond = cond | F.contains(c, F.lit(w))
    return cond


def quote(word: str) -> str:
    """A word as a regular expression that matches it literally."""
    return "".join("\\" + ch if ch in r"\.^$|?*+()[]{}-" else ch for ch in word)


def count_hits(c: Column, words: list[str] | tuple[str, ...]) -> Column:
    """How many of ``words`` occur in ``c`` at least once."""
    total = F.lit(0)
    for w in words:
        total = total + F.contains(c, F.lit(w)).cast("int")
    return total


def count_char(c: Column, ch: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


def tokens(c: Column) -> Column:
    """Blank-separated tokens; an empty text has none."""
    return F.array_remove(F.split(squeeze(c), " "), "")


def join_tokens(arr: Column) -> Column:
    return F.array_join(arr, " ")


def head_tokens(arr: Column, n: Column | int) -> Column:
    """First ``n`` tokens (none when ``n`` <= 0)."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(n <= 0, F.array().cast("array<string>")).otherwise(F.slice(arr, F.lit(1), F.greatest(n, F.lit(0))))


def tail_tokens(arr: Column, k: Column | int) -> Column:
    """Last ``k`` tokens, ``k`` at most the size."""
    k = F.lit(k) if isinstance(k, int) else k
    size = F.size(arr)
    k = F.least(k, size)
    return F.when(k <= 0, F.array().cast("array<string>")).otherwise(
        F.slice(arr, F.greatest(size - k + 1, F.lit(1)), F.greatest(k, F.lit(0)))
    )


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    Nested expressions that use an intermediate result many times would otherwise
    repeat its whole computation at every use.
    """
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def last_token(arr: Column) -> Column:
    """Last element, null for an empty array."""
    return F.try_element_at(arr, F.lit(-1))
