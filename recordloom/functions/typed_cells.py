"""Spreadsheet cell coercion as one struct-valued expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\.[0-9]+)?$"
_PERCENT = r"^[+-]?([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\.[0-9]+)?%$"
_DATE = r"^[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2}$"
_STAMP = r"^([0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2})[ T]([0-9]{1,2}:[0-9]{2}(:[0-9]{2})?)$"


def escape_formula(c: Column) -> Column:
    """A leading apostrophe on text a spreadsheet would run as a formula; signed numbers stay."""
    numeric = F.trim(c).rlike(_NUMBER) | F.trim(c).rlike(_PERCENT)
    return F.when(c.rlike("^[=@]") | (c.rlike("^[+-]") & ~numeric), F.concat(F.lit("'"), c)).otherwise(c)


def typed_cell(c: Column) -> Column:
    """struct(kind, num, date, ts, text, fmt).

    kind is null/blank/text/int/number/percent/date/datetime; ``num``, ``date``
    and ``ts`` are set for their kinds and ``text`` keeps everything else.
    """
    s = F.trim(c)
    escaped = escape_formula(c)
    is_escaped = escaped != c
    day = F.try_to_date(F.regexp_replace(F.regexp_extract(s, r"^([0-9./-]+)", 1), "[./]", "-"), "yyyy-M-d")
    clock = F.regexp_extract(s, _STAMP, 2)
    stamp = F.try_to_timestamp(
        F.concat(
            F.date_format(day, "yyyy-MM-dd"), F.lit(" "),
            F.when(F.length(clock) - F.length(F.replace(clock, F.lit(":"), F.lit(""))) == 1, F.concat(clock, F.lit(":00"))).otherwise(clock),
        ),
        F.lit("yyyy-MM-dd H:mm:ss"),
    )
    bare = F.regexp_replace(s, "[,%]", "")
    decimals = F.length(F.regexp_extract(bare, r"\.([0-9]+)$", 1))
    dec_fmt = F.when(decimals > 0, F.concat(F.lit("."), F.repeat(F.lit("0"), decimals))).otherwise("")
    leading_zero = bare.rlike("^0[0-9]+$") & bare.rlike("[1-9]")
    is_stamp, is_day = s.rlike(_STAMP), s.rlike(_DATE)
    kind = (
        F.when(c.isNull(), "null")
        .when(s == "", "blank")
        .when(is_escaped, "text")
        .when(is_stamp & stamp.isNotNull(), "datetime")
        .when(is_stamp, "text")
        .when(is_day & day.isNotNull(), "date")
        .when(is_day, "text")
        .when(s.rlike(_PERCENT), "percent")
        .when(s.rlike(_NUMBER) & leading_zero, "text")
        .when(s.rlike(_NUMBER) & F.contains(bare, F.lit(".")), "number")
        .when(s.rlike(_NUMBER), "int")
        .otherwise("text")
    )
    num = bare.try_cast("double")
    plain_fmt = F.concat(F.lit("#,##0"), dec_fmt)
    return F.struct(
        kind.alias("kind"),
        F.when(kind.isin("int", "number"), num).when(kind == "percent", num / 100.0).alias("num"),
        F.when(kind == "date", F.date_format(day, "yyyy-MM-dd")).alias("date"),
        F.when(kind == "datetime", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")).alias("ts"),
        F.when(kind.isin("text", "blank"), escaped).alias("text"),
        F.when(kind.isin("int", "number"), plain_fmt)
        .when(kind == "percent", F.concat(F.lit("0"), dec_fmt, F.lit("%")))
        .when(kind == "date", "yyyy-mm-dd")
        .when(kind == "datetime", "yyyy-mm-dd hh:mm")
        .when((kind == "text") & (is_escaped | (s.rlike(_NUMBER) & leading_zero)), "@")
        .alias("fmt"),
    )
