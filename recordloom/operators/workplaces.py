"""Workplace rows out of a section's lines: side-by-side tables by start and end rows, single-column tables by islands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.dates import ONGOING, date_to_iso
from recordloom.functions.text import compact, is_blank, let, quote
from recordloom.operators.records import CHANGE_MARKERS, PAGE, company_split

DATE = r"\d{4}\.\d{2}(?:\.\d{2})?"
FULL_DATE = r"\d{4}\.\d{2}\.\d{2}"
WORKING = r"근\s*무\s*중"
# Words of a note below the table.
NOTE_WORDS = ["퇴", "사", "유"]
# Labels that are no company names.
LABELS = ["근무처", "근무기간", "상호"]


def _groups(line: Column, pattern: str, *names: str) -> Column:
    """struct of the pattern's groups, null where it does not match."""
    return F.when(line.rlike(pattern), F.struct(*[F.trim(F.regexp_extract(line, pattern, i + 1)).alias(n) for i, n in enumerate(names)]))


def end_date(c: Column) -> Column:
    return F.when(c.rlike(WORKING), ONGOING).otherwise(date_to_iso(c, "workplace"))


def end_row(line: Column, markers: Sequence[str]) -> Column:
    """struct(tier, l_end, l_new, r_end, r_new) of a row that ends the left and the right workplace, else null.

    Tiers: no reason, a listed reason, any word as a reason, reason and name in one
    piece, or merely two dates.
    """
    listed = "|".join(quote(m) for m in markers if m not in ("現", "현"))
    right = rf"({DATE}|{WORKING})\s*(?:(?::\s*)?(.+))?$"

    def tier(n: int, pattern: str, new: Column | None = None, ok: Column | None = None) -> Column:
        part = lambda i: F.trim(F.regexp_extract(line, pattern, i))
        found = line.rlike(pattern) if ok is None else line.rlike(pattern) & ok
        return F.when(found, F.struct(F.lit(n).alias("tier"), part(1).alias("l_end"), (part(2) if new is None else new).alias("l_new"), part(3).alias("r_end"), part(4).alias("r_new")))

    plain = rf"^({DATE})\s+(?:現?:(.+?)\s+)?{right}"
    known = rf"^({DATE})\s+((?:{listed})\s*[:：]\s*.+?)\s+{right}"
    word = rf"^({DATE})\s+[^\s:：]{{1,30}}\s*[:：]\s*(.+?)\s+{right}"
    glued = rf"^({DATE})\s+(\S+)\s+{right}"
    piece = F.regexp_extract(line, glued, 2)
    name = F.trim(F.regexp_extract(piece, r"[:：](.+)$", 1))
    dates = F.regexp_extract_all(line, F.lit(f"({FULL_DATE})"), F.lit(1))
    two = F.when(F.size(dates) >= 2, F.struct(F.lit(5).alias("tier"), F.get(dates, F.lit(0)).alias("l_end"), F.lit("").alias("l_new"), F.get(dates, F.lit(1)).alias("r_end"),
                                             F.trim(F.regexp_extract(line, r"^[^:]*:(.*)$", 1)).alias("r_new")))
    return F.coalesce(tier(1, plain), tier(2, known), tier(3, word), tier(4, glued, name, name != ""), two)


def workplace_pairs(lines: DataFrame, keys: Sequence[str] = PAGE, markers: Sequence[str] = tuple(CHANGE_MARKERS)) -> DataFrame:
    """Rows ``line_no, side, start_date, end_date, previous, current`` of a section with two workplaces side by side.

    A start row holds two open ranges; the next row that reads as their end closes
    both and is used once, a start row without one is dropped.  A change row is a
    workplace of its own, unless it begins at the right start of the open pair.  A
    single open range outside a pair is ongoing if the next line says so, or if it
    is the section's last dated line and a note follows.  A reason line behind a row
    that has one name makes that name the former one.
    """
    w = Window.partitionBy(*keys).orderBy("line_no")
    listed = "|".join(quote(m) for m in markers if m not in ("現", "현"))
    raw = F.col("line")
    at = F.when(raw.rlike(DATE), F.trim(F.regexp_extract(raw, rf"({DATE}.*)$", 1))).otherwise(raw)
    d = lines.select(*keys, "line_no", at.alias("line"))
    line = F.col("line")
    d = d.withColumns({
        "both": _groups(line, rf"^({DATE})\s*~\s*(.+?)\s+({DATE})\s*~\s*(.+)$", "l_start", "l_name", "r_start", "r_name"),
        "change": _groups(line, rf"^({DATE})\s+({listed})\s*[:：]\s*(.+?)\s+({DATE})\s*[:：]\s*(.+)$", "start", "reason", "old", "end", "new"),
        "reason": _groups(line, rf"^({listed})\s*[:：]\s*(.+)$", "reason", "new"),
        "one": F.when(~line.rlike(rf"^{DATE}\s*~\s*.+?\s+{DATE}\s*~"), _groups(line, rf"^({DATE})\s*~\s*(.+)$", "start", "name")),
        "dated": line.rlike(FULL_DATE),
    })
    d = d.withColumn("pair", F.coalesce(F.sum(F.col("both").isNotNull().cast("int")).over(w), F.lit(0))).withColumn("open", F.last("both", ignorenulls=True).over(w))
    closes = F.when(F.col("both").isNull() & F.col("open").isNotNull(), F.when(F.col("change").isNotNull(), F.when(F.col("change.start") == F.col("open.r_start"), F.struct(
        F.lit(0).alias("tier"), F.col("change.start").alias("l_end"), F.lit("").alias("l_new"), F.col("change.end").alias("r_end"),
        F.concat("change.old", F.lit(" "), "change.reason", F.lit(":"), "change.new").alias("r_new")))).otherwise(end_row(line, markers)))
    d = d.withColumn("end", closes)
    in_pair = Window.partitionBy(*keys, "pair")
    d = d.withColumn("closed", F.min(F.when(F.col("end").isNotNull(), F.col("line_no"))).over(in_pair))
    free = F.col("open").isNull() | (F.col("closed") < F.col("line_no"))
    rest = w.rowsBetween(1, Window.unboundedFollowing)
    note = F.lit(False)
    for x in NOTE_WORDS:
        note = note | F.contains(line, F.lit(x))
    d = d.withColumns({"free": free, "next": F.lead("line").over(w), "later": F.coalesce(F.max("dated").over(rest), F.lit(False)), "noted": F.coalesce(F.max(note).over(rest), F.lit(False))})

    name, none = lambda c: F.struct(F.lit("").alias("previous"), c.alias("current")), F.lit("")
    e, o = F.col("end"), F.col("open")
    left = F.when(e["tier"].isin(3, 4), F.struct(o["l_name"].alias("previous"), e["l_new"].alias("current"))).otherwise(company_split(
        F.when(e["l_new"] == "", o["l_name"]).when(e["tier"] == 2, F.concat(o["l_name"], F.lit(" "), e["l_new"])).otherwise(F.concat(o["l_name"], F.lit(" 現:"), e["l_new"])), markers))
    right = company_split(F.when(e["tier"] == 0, e["r_new"]).when(e["r_new"] == "", o["r_name"]).otherwise(F.concat(o["r_name"], F.lit(" 現:"), e["r_new"])), markers)
    ongoing = F.contains(compact(F.coalesce("next", none)), F.lit(ONGOING)) | (~F.col("later") & F.col("noted"))

    def found(side: int, start: Column, end: Column, company: Column) -> Column:
        return let(company, lambda c: F.struct(F.lit(side).alias("side"), date_to_iso(start, "workplace").alias("start_date"), end.alias("end_date"), c["previous"].alias("previous"), c["current"].alias("current")))

    nothing = F.array().cast("array<struct<side:int,start_date:string,end_date:string,previous:string,current:string>>")
    records = (
        F.when(F.col("line_no") == F.col("closed"), F.array(found(0, o["l_start"], end_date(e["l_end"]), left), found(1, o["r_start"], end_date(e["r_end"]), right)))
        .when(F.col("change").isNotNull() & (F.col("end").isNull() | F.col("free")), F.array(found(
            0, F.col("change.start"), end_date(F.col("change.end")), F.struct(F.col("change.old").alias("previous"), F.col("change.new").alias("current")))))
        .when(F.col("one").isNotNull() & F.col("free") & F.col("end").isNull() & ongoing, F.array(found(0, F.col("one.start"), F.lit(ONGOING), name(F.col("one.name")))))
        .otherwise(nothing)
    )
    d = d.select(*keys, "line_no", "reason", records.alias("x")).where("size(x) > 0 or reason is not null")
    d = d.withColumn("row", F.sum((F.size("x") > 0).cast("int")).over(w)).where("row > 0")
    g = d.groupBy(*keys, "row").agg(F.min(F.when(F.size("x") > 0, F.col("line_no"))).alias("line_no"), F.max(F.when(F.size("x") > 0, F.col("x"))).alias("x"),
                                    F.min_by("reason", F.when(F.col("reason").isNotNull(), F.col("line_no"))).alias("reason"))
    last = F.try_element_at("x", F.lit(-1))
    joins = F.col("reason").isNotNull() & (last["previous"] == "") & (last["current"] != "") & F.col("reason.new").rlike(r"주\)|\(|[가-힣A-Za-z0-9]")
    mended = company_split(F.concat(last["current"], F.lit(" "), "reason.reason", F.lit(":"), "reason.new"), markers)
    g = g.withColumn("mended", F.when(joins, mended))
    x = F.transform("x", lambda r, i: F.when(F.col("mended").isNotNull() & (i == F.size("x") - 1), F.struct(
        r["side"].alias("side"), r["start_date"].alias("start_date"), r["end_date"].alias("end_date"), F.col("mended.previous").alias("previous"), F.col("mended.current").alias("current"))).otherwise(r))
    return g.select(*keys, "line_no", F.explode(x).alias("r")).select(*keys, "line_no", "r.side", "r.start_date", "r.end_date", "r.previous", "r.current")


def single_column_workplaces(lines: DataFrame, keys: Sequence[str] = PAGE, markers: Sequence[str] = tuple(CHANGE_MARKERS)) -> DataFrame:
    """Rows ``line_no, start_date, end_date, previous, current`` of a table that was read as one column.

    A line that is an open date begins a row; its first line that is a date or says
    that the work goes on ends the period; all its other lines are the company.
    Rows without a company are dropped.
    """
    w = Window.partitionBy(*keys).orderBy("line_no")
    d = lines.select(*keys, "line_no", F.trim("line").alias("line")).where(~is_blank(F.col("line")))
    line = F.col("line")
    starts, ends = line.rlike(rf"^{DATE}\s*~\s*$"), line.rlike(rf"^{DATE}\s*$") | line.rlike(rf"^{WORKING}\s*$")
    d = d.withColumns({"starts": starts, "ends": ends}).withColumn("row", F.sum(F.col("starts").cast("int")).over(w)).where("row > 0")
    label = F.lit(False)
    for x in LABELS:
        label = label | F.contains(line, F.lit(x))
    d = d.withColumn("end_line", F.min(F.when(F.col("ends"), F.col("line_no"))).over(Window.partitionBy(*keys, "row")))
    own = ~F.col("starts") & (F.col("end_line").isNull() | (F.col("line_no") != F.col("end_line"))) & ~label
    g = d.groupBy(*keys, "row").agg(
        F.min("line_no").alias("line_no"), F.max(F.when(F.col("starts"), line)).alias("s"), F.max(F.when(F.col("line_no") == F.col("end_line"), line)).alias("e"),
        F.sort_array(F.collect_list(F.when(own, F.struct("line_no", "line")))).alias("names")).where("size(names) > 0")
    g = g.select(*keys, "line_no", date_to_iso(F.regexp_extract("s", f"({DATE})", 1), "workplace").alias("start_date"), F.coalesce(end_date(F.trim("e")), F.lit("")).alias("end_date"),
                 company_split(F.array_join(F.transform("names", lambda x: x["line"]), " "), markers).alias("c"))
    return g.select(*keys, "line_no", "start_date", "end_date", "c.previous", "c.current")
