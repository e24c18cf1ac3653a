"""Date, period and day-count expressions.

Certificate dates are text; three sentinels survive as text: ongoing (``근무중``),
masked (``****-**-**``) and empty.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordloom.functions.text import ARROW, clean_blanks, compact, strip

ONGOING = "근무중"
MASKED_ISO = "****-**-**"

_FULL = r"^[0-9]{4}\.[0-9]{2}\.[0-9]{2}$"
_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MONTH = r"^[0-9]{4}\.[0-9]{2}$"
_ISO_MONTH = r"^[0-9]{4}-[0-9]{2}$"
MODES = ("first_day", "keep_month", "passthrough", "unchecked", "workplace")


def _trim(c: Column) -> Column:
    return strip(clean_blanks(c))


def _iso(c: Column) -> Column:
    """Calendar-checked ``yyyy-MM-dd`` text, empty when no such day exists."""
    return F.coalesce(F.date_format(F.try_to_date(c, "yyyy-MM-dd"), "yyyy-MM-dd"), F.lit(""))


def date_to_iso(c: Column, mode: str = "first_day") -> Column:
    """Date text to ISO text.

    first_day    full date checked; month becomes its first day; the rest empty
    keep_month   full date checked; month stays ``yyyy-MM``; the rest empty
    passthrough  full or ISO date checked (bad day empty); the rest unchanged
    unchecked    date or month prefix rewritten without a calendar check; the rest unchanged
    workplace    as passthrough, and a month becomes its first day
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    s = _trim(c)
    dashed = F.replace(s, F.lit("."), F.lit("-"))
    full = s.rlike(_FULL)
    month_day = _iso(F.concat(dashed, F.lit("-01")))
    if mode == "first_day":
        return F.when(full, _iso(dashed)).when(s.rlike(_MONTH) | s.rlike(_ISO_MONTH), month_day).otherwise("")
    if mode == "keep_month":
        return F.when(full, _iso(dashed)).when(s.rlike(_MONTH), dashed).otherwise("")
    if mode == "passthrough":
        return F.when(full | s.rlike(_ISO), _iso(dashed)).otherwise(s)
    if mode == "workplace":
        return (
            F.when(full | s.rlike(_ISO), _iso(dashed))
            .when(s.rlike(_MONTH), F.when(month_day == "", s).otherwise(month_day))
            .otherwise(s)
        )
    raw = F.coalesce(c, F.lit(""))
    y = F.substring(raw, 1, 4)
    return (
        F.when(raw.rlike(r"^[0-9]{4}\.[0-9]{2}\.[0-9]{2}"), F.replace(F.substring(raw, 1, 10), F.lit("."), F.lit("-")))
        .when(
            raw.rlike(r"^[0-9]{4}\.[0-9]{1,2}"),
            F.concat(y, F.lit("-"), F.lpad(F.regexp_extract(raw, r"^[0-9]{4}\.([0-9]{1,2})", 1), 2, "0"), F.lit("-01")),
        )
        .otherwise(raw)
    )


def birth_to_iso(c: Column, pivot_yy: int) -> Column:
    """``yy.MM.dd`` to ISO; years up to ``pivot_yy`` are 20yy.  The pivot is a parameter, not the clock."""
    s = _trim(c)
    yy = F.try_to_number(F.substring(s, 1, 2), F.lit("99")).cast("int")
    century = F.when(yy <= pivot_yy, "20").otherwise("19")
    return F.when(
        s.rlike(r"^[0-9]{2}\.[0-9]{2}\.[0-9]{2}$"), _iso(F.concat(century, F.replace(s, F.lit("."), F.lit("-"))))
    ).otherwise("")


def end_kind(end_iso: Column) -> Column:
    """'ongoing', 'masked', 'empty' or 'date'."""
    return (
        F.when(compact(end_iso) == ONGOING, "ongoing")
        .when(end_iso == MASKED_ISO, "masked")
        .when(compact(end_iso) == "", "empty")
        .otherwise("date")
    )


def typed_date(iso: Column) -> Column:
    return F.try_to_date(iso, "yyyy-MM-dd")


def typed_int(text: Column) -> Column:
    return F.expr("cast(null as int)") if text is None else F.replace(text, F.lit(","), F.lit("")).try_cast("int")


DAYS_TOKEN = r"\(\s*([0-9][0-9,]*)\s*일\s*\)"


def days_tokens(c: Column) -> Column:
    """Numbers of all ``(n일)`` tokens, thousands commas removed."""
    return F.transform(
        F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(DAYS_TOKEN), F.lit(1)),
        lambda x: F.replace(x, F.lit(","), F.lit("")),
    )


def date_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"([0-9]{4}\.[0-9]{2}\.[0-9]{2})"), F.lit(1))


def month_tokens(c: Column) -> Column:
    """``yyyy.MM`` tokens at a word end (full dates must be removed before)."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?U)([0-9]{4}\.[0-9]{2})\b"), F.lit(1))


def period_cell(c: Column, mode: str = "first_day") -> Column:
    """Period cell to struct(start, end, recog, part, is_continuation).

    An arrow makes the cell a continuation only when no date is in it; without a
    full date, ``yyyy.MM`` tokens stand for the first day of their month.
    """
    raw = _trim(c)
    full = date_tokens(raw)
    cont = F.contains(raw, F.lit(ARROW)) & (F.size(full) == 0)
    s = _trim(F.replace(raw, F.lit(ARROW), F.lit(" ")))
    months = F.slice(F.transform(month_tokens(s), lambda x: F.concat(x, F.lit(".01"))), 1, 2)
    dates = F.when(F.size(full) > 0, full).otherwise(months)
    ongoing = F.contains(F.replace(s, F.lit(" "), F.lit("")), F.lit(ONGOING)) | (
        (F.size(dates) == 1) & F.contains(s, F.lit("근무")) & F.contains(s, F.lit("중"))
    )
    days = days_tokens(s)
    return F.struct(
        F.coalesce(date_to_iso(F.get(dates, 0), mode), F.lit("")).alias("start"),
        F.when(F.size(dates) >= 2, date_to_iso(F.get(dates, 1), mode)).when(ongoing, ONGOING).otherwise("").alias("end"),
        F.coalesce(F.get(days, 0), F.lit("")).alias("recog"),
        F.coalesce(F.get(days, 1), F.lit("")).alias("part"),
        cont.alias("is_continuation"),
    )
