"""Records out of line streams: date blocks, names, continuations, summary items, front-page rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions import grammar as G
from recordloom.functions.dates import ONGOING, date_to_iso, days_tokens
from recordloom.functions.text import ARROW, compact, contains_any, count_char, is_blank, let, quote, squeeze
from recordloom.operators.lines import DATE_LINE, DAYS_LINE, MASKED_DATE, is_annotation, is_boilerplate
from recordloom.operators.scan import Running, neighbour, running

PAGE = ("doc_id", "page_no")


def _page_arrays(lines: DataFrame, keys: Sequence[str], *fields: Column) -> DataFrame:
    """Lines of one page as one ordered array; a page is bounded, a document is not."""
    return lines.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("line_no", *fields))).alias("r"))


def date_blocks(lines: DataFrame, keys: Sequence[str] = PAGE, date_mode: str = "keep_month") -> DataFrame:
    """Start, end and the two day counts of every period block of a page, in order, with its first and last line (``line_no, last_no``).

    A block opens at a date line.  Its ``~`` is looked for up to the next project or
    day count; the end is then one of the two lines after it, without a ``~`` it is
    the next date or ongoing mark.  Day tokens follow until two are found or the
    next project or date begins.  A line begins a project if the next line that is
    no text is a date with its ``~``.  The consumed end date must not open a block,
    so this is a cursor fold over the page's line array.
    """
    g = pages_with_blocks(lines, keys, date_mode)
    return g.select(*keys, F.posexplode("blocks").alias("block", "b")).select(
        *keys, F.col("block").cast("bigint").alias("block"), "b.line_no", "b.last_no", F.col("b.start").alias("start_date"), F.col("b.end").alias("end_date"),
        F.col("b.recog").alias("recog_days"), F.col("b.part").alias("part_days"))


def pages_with_blocks(lines: DataFrame, keys: Sequence[str] = PAGE, date_mode: str = "keep_month", carry: Sequence[str] = ()) -> DataFrame:
    """Pages as arrays: ``r``, the lines with the columns ``carry``, and ``blocks`` (see ``date_blocks``), with ``first`` and ``last`` of ``carry``."""
    line = F.col("line")
    d = lines.select(*keys, "line_no", "line", *carry, line.rlike(DATE_LINE).alias("date"), line.startswith("~").alias("tilde"), line.rlike(DAYS_LINE).alias("daysline"))
    # from the last line up: what comes next is what came before
    w = Window.partitionBy(*keys).orderBy(F.col("line_no").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # A masked date is part of a period block, not the start of the next project.
    shape = F.when(F.col("date"), "date").when(F.col("tilde"), "tilde").when(F.col("daysline"), "days")
    d = d.withColumn("_s", shape).withColumn("_opens", F.when(shape.isNotNull(), (shape == "date") & F.coalesce(F.last("_s", ignorenulls=True).over(w) == "tilde", F.lit(False))))
    loose = (line != ARROW) & ~line.rlike(MASKED_DATE) & F.col("_s").isNull() & F.last("_opens", ignorenulls=True).over(w)
    d = d.withColumn("start", F.coalesce(loose, F.lit(False)))
    # dates and day counts are read here, where expressions are compiled; the fold moves them around
    days = F.when(F.contains(line, F.lit("일")), days_tokens(line)).otherwise(F.array().cast("array<string>"))
    g = _page_arrays(d, keys, *carry, "line", "date", "tilde", "daysline", "start", F.contains(compact(line), F.lit(ONGOING)).alias("ongoing"), days.alias("days"),
                     F.when(F.col("date"), date_to_iso(line, date_mode)).alias("iso"))
    r = F.col("r")
    n = F.size(r)
    kept = [f for f in d.schema.fields if f.name in carry]
    ends = "".join(f",{e}_{f.name}:{f.dataType.simpleString()}" for f in kept for e in ("first", "last"))
    empty = F.array().cast(f"array<struct<line_no:bigint,last_no:bigint,start:string,end:string,recog:string,part:string{ends}>>")

    def first_index(lo: Column, hi: Column, test) -> Column:
        """First index in [lo, hi) with ``test``, else null."""
        span = F.when(lo < hi, F.sequence(lo, hi - 1)).otherwise(F.array().cast("array<int>"))
        return F.get(F.filter(span, lambda k: test(F.get(r, k))), F.lit(0))

    def is_date(x: Column) -> Column:
        return F.coalesce(x["date"], F.lit(False))

    def tokens_from(cursor: Column) -> Column:
        """struct(days, next, from): tokens before the next block, the index to go on from and the one begun at."""
        cut = F.coalesce(first_index(cursor, n, lambda x: x["start"] | (x["date"] & (x["line_no"] != F.get(r, cursor)["line_no"]))), n)

        def read(c: Column) -> Column:
            toks = F.flatten(F.transform(F.slice(r, cursor + 1, F.greatest(c - cursor, F.lit(0))), lambda x, o: F.transform(x["days"], lambda t: F.struct(o.alias("o"), t.alias("d")))))
            return let(toks, lambda t: F.struct(
                F.transform(F.slice(t, 1, 2), lambda x: x["d"]).alias("days"),
                F.when(F.size(t) >= 2, cursor + F.get(t, F.lit(1))["o"] + 1).otherwise(F.greatest(c, cursor)).alias("next"), cursor.alias("from")))

        return let(cut, read)

    def end_after_tilde(t: Column) -> Column:
        a, b = F.get(r, t + 1), F.get(r, t + 2)
        return (
            F.when(is_date(a), F.struct(a["iso"].alias("end"), (t + 2).alias("cursor")))
            .when(F.coalesce(a["ongoing"], F.lit(False)), F.struct(F.lit(ONGOING).alias("end"), (t + 2).alias("cursor")))
            .when(is_date(b), F.struct(b["iso"].alias("end"), (t + 3).alias("cursor")))
            .otherwise(F.struct(F.lit("").alias("end"), (t + 1).alias("cursor")))
        )

    def end_without_tilde(i: Column) -> Column:
        hit = first_index(i + 1, n, lambda x: x["date"] | x["ongoing"] | x["start"] | x["daysline"])

        def read(k: Column) -> Column:
            x = F.get(r, k)
            return F.when(x["date"] | x["ongoing"], F.struct(F.when(x["date"], x["iso"]).otherwise(ONGOING).alias("end"), (k + 1).alias("cursor"))).otherwise(
                F.struct(F.lit("").alias("end"), (i + 1).alias("cursor")))

        return let(hit, read)

    def step(acc: Column, i: Column) -> Column:
        here = F.get(r, i)

        def add(end: Column, t: Column) -> Column:
            last = F.get(r, F.when(F.size(t["days"]) >= 2, t["next"] - 1).otherwise(t["from"] - 1))
            return F.struct(t["next"].alias("i"), F.concat(acc["out"], F.array(F.struct(
                here["line_no"].alias("line_no"), last["line_no"].alias("last_no"), here["iso"].alias("start"), end.alias("end"),
                F.coalesce(F.get(t["days"], F.lit(0)), F.lit("")).alias("recog"), F.coalesce(F.get(t["days"], F.lit(1)), F.lit("")).alias("part"),
                *[x[f.name].alias(f"{e}_{f.name}") for f in kept for e, x in (("first", here), ("last", last))]))).alias("out"))

        def with_tilde(t: Column) -> Column:
            return let(end_after_tilde(t), lambda e: let(tokens_from(e["cursor"]), lambda k: add(e["end"], k)))

        def without(_: Column) -> Column:
            return let(end_without_tilde(i), lambda e: let(tokens_from(e["cursor"]), lambda k: F.when(
                (e["end"] == "") & (F.size(k["days"]) < 2), F.struct((i + 1).alias("i"), acc["out"].alias("out"))).otherwise(add(e["end"], k))))

        def open_block(k: Column) -> Column:
            return F.when(F.coalesce(F.get(r, k)["tilde"], F.lit(False)), with_tilde(k)).otherwise(without(k))

        return F.when(i < acc["i"], acc).otherwise(
            let(first_index(i + 1, n, lambda x: x["tilde"] | x["start"] | x["daysline"]), open_block))

    # blocks open at dates only
    at = F.filter(F.sequence(F.lit(0), n - 1), lambda i: is_date(F.get(r, i)))
    return g.select(*keys, "r", F.aggregate(at, F.struct(F.lit(0).alias("i"), empty.alias("out")), step, lambda a: a["out"]).alias("blocks"))


def merge_equal_blocks(blocks: DataFrame, key: Sequence[str], name: str, order: str, keys: Sequence[str] = PAGE) -> DataFrame:
    """Consecutive blocks with one key become one; their distinct names stay in order."""
    w = Window.partitionBy(*keys).orderBy(order)
    k = F.struct(*key)
    d = blocks.withColumn("_new", F.coalesce((F.lag(k).over(w) != k).cast("int"), F.lit(1))).withColumn("_g", F.sum("_new").over(w))
    g = d.groupBy(*keys, "_g", *key).agg(F.sort_array(F.collect_list(F.struct(order, name))).alias("_n"), F.min(order).alias(order))
    names = F.array_distinct(F.filter(F.transform("_n", lambda x: x[name]), lambda x: x != ""))
    return g.select(*keys, order, *key, names.alias("names"), (F.size("_n") > 1).alias("merged"))


def names_before_dates(lines: DataFrame, words: G.Words = G.DEFAULT, keys: Sequence[str] = PAGE) -> DataFrame:
    """Project name above every date line: all name-like lines joined, up to a stop line.

    Job/duty and annotation lines are skipped; dates, days, ``~``, arrows, the line
    after an arrow and issuer lines stop.  Lines between two stops are one island,
    so no line is looked at from more than one date.
    """
    line = F.col("line")
    w = Window.partitionBy(*keys).orderBy("line_no")
    after_arrow = F.coalesce(F.lag(line).over(w).startswith(ARROW), F.lit(False))
    d = lines.select(*keys, "line_no", "line", after_arrow.alias("_aa"))
    shape = (
        F.when(line.rlike(DATE_LINE), "date")
        .when(line.rlike(DAYS_LINE) | line.startswith("~") | line.startswith(ARROW) | F.col("_aa"), "stop")
        .when(is_annotation(line), "skip")
    )
    d = G.with_tokens(d.withColumn("_shape", shape), F.col("_shape").isNull())
    text, toks = F.col("_text"), F.col("_tokens")
    kind = (
        F.when(F.col("_shape").isNotNull(), F.col("_shape")).when(G.issuer_tokens(toks, words).isNotNull(), "stop")
        .when(G.job_duty_tokens(toks, words).isNotNull(), "skip").when(G.is_name_text(text, F.col("_tight"), words), "name").otherwise("stop")
    )
    d = d.withColumn("kind", kind).withColumn("_p", F.when(F.col("kind") == "name", G.project_tokens(toks, words))).drop("_shape", "_text", "_tight", "_tokens")
    d = d.withColumn("_island", F.coalesce(F.sum(F.col("kind").isin("date", "stop").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    d = d.groupBy(*keys, "_island").agg(
        F.max(F.when(F.col("kind") == "date", F.col("line_no"))).alias("line_no"),
        F.sort_array(F.collect_list(F.when(F.col("kind") == "name", F.struct("line_no", "line", F.col("_p").alias("p"))))).alias("x")).where("line_no is not null and size(x) > 0")
    nearest = lambda f: F.try_element_at(F.filter(F.transform("x", lambda x: x["p"][f]), lambda v: v.isNotNull()), F.lit(-1))
    d = d.select(*keys, "line_no", F.array_join(F.transform("x", lambda x: F.coalesce(x["p"]["name"], x["line"])), "").alias("name"), nearest("job").alias("job"), nearest("duty").alias("duty"))
    d = G.with_tokens(d, F.lit(True), "name").withColumn("_q", G.project_tokens(F.col("_tokens"), words))
    return d.select(*keys, "line_no", F.coalesce("_q.name", "name").alias("name"), F.coalesce("job", "_q.job").alias("job"), F.coalesce("duty", "_q.duty").alias("duty")).where("name <> ''")


def tilde_with_context(lines: DataFrame, words: G.Words = G.DEFAULT, keys: Sequence[str] = PAGE) -> DataFrame:
    """``~`` lines with all issuer lines right above them and all short issuer fragments right below."""
    line = F.col("line")
    w = Window.partitionBy(*keys).orderBy("line_no")
    org = line.rlike(r"(청|사무소|관리단|사업단|조합|협회|본부|위원회|공단|공사\(주\)|\(주\))$") | contains_any(line, ["건설사무", "지방해양항만"])
    shaped = line.rlike(DATE_LINE) | line.rlike(DAYS_LINE) | line.rlike(MASKED_DATE) | line.startswith("~")
    free = ~shaped & ~F.contains(line, F.lit("참여기술인"))
    long = free & (F.length(line) >= 2) & ~line.startswith(ARROW) & ~line.rlike(r"^[\d.,\s]+$")
    short = free & (F.length(line) <= 3) & line.rlike("^[가-힣A-Za-z0-9]+$")
    d = G.with_tokens(lines.select(*keys, "line_no", "line", long.alias("_long"), short.alias("_short")), F.col("_long") | F.col("_short"))
    grammar = G.job_duty_tokens(F.col("_tokens"), words).isNotNull() | G.issuer_tokens(F.col("_tokens"), words).isNotNull()
    # a line with the ending of an issuer is not asked for a name
    d = d.withColumns({"_org": org, "_grammar": grammar})
    d = d.withColumn("_name", ~F.col("_grammar") & (F.col("_short") | ~F.col("_org")) & G.is_name_text(F.col("_text"), F.col("_tight"), words))
    d = d.select(*keys, "line_no", "line", (F.col("_long") & (F.col("_org") | ~F.col("_name")) & ~F.col("_grammar")).alias("_p"), (F.col("_short") & ~F.col("_name")).alias("_f"))
    # runs of prefix lines belong to the line that ends them, runs of fragments to the line before them
    count = lambda c, frame: F.coalesce(F.sum((~F.col(c)).cast("int")).over(frame), F.lit(0))
    d = d.withColumn("_up", count("_p", w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("_dn", count("_f", w))
    # first every line with the fragments below it, then every line with the prefixes above it; both stay on the page, so nothing is joined
    d = d.groupBy(*keys, "_dn").agg(F.sort_array(F.collect_list(F.struct("line_no", "line", "_p", "_f", "_up"))).alias("x"))
    glue = F.aggregate(F.filter("x", lambda x: x["_f"]), F.lit(""), lambda t, x: F.when(F.endswith(t, x["line"]), t).otherwise(F.concat(t, x["line"])))
    d = d.withColumn("_tail", F.when(F.get("x", F.lit(0))["line"].startswith("~"), glue)).select(*keys, F.posexplode("x").alias("i", "x"), "_tail")
    d = d.select(*keys, "x.*", F.when(F.col("i") == 0, F.col("_tail")).alias("_tail"))
    d = d.groupBy(*keys, "_up").agg(F.max(F.when(line.startswith("~"), F.struct("line_no", "line", "_tail"))).alias("t"), F.sort_array(F.collect_list(F.when(F.col("_p"), F.struct("line_no", "line")))).alias("x")).where("t is not null")
    d = d.select(*keys, "t.*", F.array_join(F.transform("x", lambda x: x["line"]), "").alias("head"))
    merged = F.when(F.col("head") == "", line).otherwise(F.concat(F.lit("~ "), "head", F.lit(" "), F.trim(F.substr(line, F.lit(2)))))
    d = G.with_tilde_fields(d.select(*keys, "line_no", merged.alias("line"), "_tail"), "line", words)
    return d.select(*keys, "line_no", F.when(F.col("t.issuer") != "", F.when(F.endswith("t.issuer", F.col("_tail")), F.col("t.issuer")).otherwise(F.concat("t.issuer", "_tail"))).otherwise("").alias("issuer"), "t.work_type", "t.specialty", "t.position")


def page_continuations(lines: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """Continuation text of a page: from its first arrow line to the block end or the next record."""
    line = F.col("line")
    w = Window.partitionBy(*keys).orderBy("line_no")
    date, arrow = line.rlike(DATE_LINE), line.startswith(ARROW)
    d = lines.select(*keys, "line_no", "line", date.alias("_d"), arrow.alias("_a"), F.coalesce(date & F.lead(line).over(w).startswith("~"), F.lit(False)).alias("_dt"))
    d = d.withColumn("_next", F.coalesce(F.first(F.when(F.col("_d"), F.col("_dt")), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)), F.lit(False)))
    wp = Window.partitionBy(*keys)
    d = d.withColumn("_from", F.min(F.when(F.col("_a"), F.col("line_no"))).over(wp))
    end = (
        is_boilerplate(line) | (line.startswith("「") & F.contains(line, F.lit("건설기술"))) | F.contains(line, F.lit("건설기술 진흥법 시행규칙"))
        | (line.rlike(r"^2\.\s*") & F.contains(line, F.lit("건설사업관리"))) | F.col("_dt")
        | ((F.col("line_no") > F.col("_from")) & ~F.col("_a") & (F.length(line) > 1) & F.col("_next"))
    )
    d = d.where("line_no >= _from").withColumn("_stop", F.min(F.when(end, F.col("line_no"))).over(wp)).where("_stop is null or line_no < _stop")
    piece = F.when(F.col("_a"), F.trim(F.regexp_replace(line, r"^(┖→)?\s*→?", ""))).otherwise(line)
    g = d.withColumn("_t", piece).where("_t <> ''").groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("line_no", "_t"))).alias("r"))
    return g.select(*keys, F.array_join(F.transform("r", lambda x: x["_t"]), "\n").alias("cont"))


# ------------------------------------------------------------------ summary pages
_ITEM = r"(.+?)\s+([\d,]+)\s*일"
# Fixed value: the heading that ends the summary.
_SUMMARY_END = r"^\s*2\.\s*건설기술진흥법령\s*외"


def _summary_kind(line: Column) -> Column:
    left, right = line.rlike(r"공사종류별\s*인정일수\s*현황"), line.rlike(r"직무\s*/\s*전문분야별\s*인정일수\s*현황")
    return (
        F.when(left & right, "both").when(left, "left").when(right, "right")
        .when(line.startswith("2.") | line.rlike(_SUMMARY_END), "end").when(line.startswith("※") | contains_any(line, ["문서하단", "바코드", "위·변조", "확인번호"]) | (F.contains(line, F.lit("자격")) & F.contains(line, F.lit("학력"))), "foot")
        .when(line.rlike(r"^[\d,]+$"), "num").when(line.rlike(r"^[\d,]+\s*일$"), "numday").when(line == "일", "day").when(line.rlike(_ITEM), "item").otherwise("label")
    )


def stitch_summary_lines(lines: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """Put label, number and 일 split over two or three lines together, and close wrapped labels.

    Greedy rules over short neighbours: one fold over the page's lines.
    """
    d = lines.select(*keys, "line_no", "line", _summary_kind(F.col("line")).alias("kind"))
    g = _page_arrays(d, keys, "line", "kind")
    at = lambda i: F.get("r", i)
    kind = lambda i: F.coalesce(at(i)["kind"], F.lit(""))
    item = lambda i, text: F.struct(at(i)["line_no"].alias("line_no"), text.alias("line"))

    def step(a: Column, i: Column) -> Column:
        k, k1, k2 = kind(i), kind(i + 1), kind(i + 2)
        x, y = at(i)["line"], at(i + 1)["line"]
        put = lambda text, used: F.struct((i + used).alias("i"), F.concat(a["out"], F.array(item(i, text))).alias("out"))
        return (
            F.when(i < a["i"], a)
            .when((k == "num") & (k1 == "day"), put(F.concat(x, F.lit(" 일")), 2))
            .when((k == "label") & (k1 == "num") & (k2 == "day"), put(F.concat_ws(" ", x, y, F.lit("일")), 3))
            .when((k == "label") & (k1 == "numday"), put(F.concat_ws(" ", x, y), 2))
            .otherwise(put(x, 1))
        )

    empty = F.array().cast("array<struct<line_no:bigint,line:string>>")
    first = F.aggregate(F.sequence(F.lit(0), F.size("r") - 1), F.struct(F.lit(0).alias("i"), empty.alias("out")), step, lambda a: a["out"])
    g = g.select(*keys, F.transform(first, lambda x: F.struct(x["line_no"].alias("line_no"), x["line"].alias("line"), _summary_kind(x["line"]).alias("kind"))).alias("r"))

    def close(a: Column, i: Column) -> Column:
        x = at(i)["line"]
        label, rest = F.regexp_extract(x, _ITEM, 1), F.regexp_extract(x, r"^(.+?)(\s+[\d,]+\s*일.*)$", 2)
        open_label = (at(i)["kind"] == "item") & (count_char(label, "(") > count_char(label, ")")) & (kind(i + 1) == "label")
        orphan = x.rlike(r"^\s*\d+(,\d+)*\s*일\b")
        prev = F.try_element_at(a["out"], F.lit(-1))
        above = F.coalesce(prev["kind"] == "label", F.lit(False))
        below = kind(i + 1) == "label"
        entry = lambda text: F.struct(at(i)["line_no"].alias("line_no"), text.alias("line"), F.lit("item").alias("kind"))
        cut = F.when(above, F.slice(a["out"], F.lit(1), F.greatest(F.size(a["out"]) - 1, F.lit(0)))).otherwise(a["out"])
        joined = F.concat(F.when(above, compact(prev["line"])).otherwise(""), F.when(below, compact(at(i + 1)["line"])).otherwise(""))
        return (
            F.when(i < a["i"], a)
            .when(orphan & (above | below), F.struct((i + F.when(below, 2).otherwise(1)).alias("i"), F.concat(cut, F.array(entry(F.concat(joined, F.lit(" "), x)))).alias("out")))
            .when(open_label, F.struct((i + 2).alias("i"), F.concat(a["out"], F.array(entry(F.concat(label, compact(at(i + 1)["line"]), rest)))).alias("out")))
            .otherwise(F.struct((i + 1).alias("i"), F.concat(a["out"], F.array(F.struct(at(i)["line_no"].alias("line_no"), x.alias("line"), at(i)["kind"].alias("kind")))).alias("out")))
        )

    empty2 = F.array().cast("array<struct<line_no:bigint,line:string,kind:string>>")
    second = F.aggregate(F.sequence(F.lit(0), F.size("r") - 1), F.struct(F.lit(0).alias("i"), empty2.alias("out")), close, lambda a: a["out"])
    return g.select(*keys, F.explode(second).alias("x")).select(*keys, "x.line_no", "x.line")


def summary_items(lines: DataFrame) -> DataFrame:
    """Recognised days per work type ('left') and per job field and specialty ('right') of a document; the first of equal keys wins.

    All items of a line count; in a line of several the first is left, the others right.

    The header mode runs over the pages of a document, carried page by page; an
    end line after the first header closes the section.  Totals are skipped.
    """
    d = lines.withColumn("_k", _summary_kind(F.col("line")))
    at = F.struct("page_no", "line_no")
    d = d.withColumns({"_m": F.when(F.col("_k").isin("both", "left", "right"), F.col("_k")), "_e": F.when(F.col("_k") == "end", at)}).withColumn("_h", F.when(F.col("_m").isNotNull(), at))
    d = d.withColumn("_chunk", F.floor(F.col("page_no") / 16384))
    # mode, first header and last end line in one run: an end line behind the first header has ended the section
    d = running(d, ["doc_id"], ["_chunk", "page_no"], ["line_no"], [Running("mode", "last", "_m"), Running("_first", "min", "_h"), Running("_last", "max", "_e")])
    d = d.withColumn("_ended", F.coalesce(F.col("_last") > F.col("_first"), F.lit(False)).cast("int"))
    d = d.where("mode is not null and _ended = 0 and _m is null and _k not in ('foot', 'end')")
    labels = F.regexp_extract_all("line", F.lit(_ITEM), F.lit(1))
    days = F.regexp_extract_all("line", F.lit(_ITEM), F.lit(2))
    d = d.select("doc_id", "page_no", "line_no", "mode", F.size(labels).alias("_n"), F.posexplode(F.arrays_zip(labels.alias("label"), days.alias("days"))).alias("_i", "x"))
    label = squeeze(F.col("x.label"))
    right = F.when(F.col("_n") >= 2, F.col("_i") >= 1).otherwise((F.col("mode") == "right") | ((F.col("mode") == "both") & F.contains(label, F.lit("/"))))
    d = d.select("doc_id", F.struct("page_no", "line_no", "_i").alias("_o"), F.when(right, "right").otherwise("left").alias("side"), label.alias("label"), F.replace(F.col("x.days"), F.lit(","), F.lit("")).alias("days"))
    d = d.where(~(F.contains("label", F.lit("인정일수")) & F.contains("label", F.lit("합계"))) & (F.col("label") != ""))
    slash, right = F.locate("/", F.col("label")), F.col("side") == "right"
    blank = F.col("label").startswith("(") & F.contains("label", F.lit("미기재"))
    job = F.when(slash > 0, F.trim(F.substr("label", F.lit(1), slash - 1))).when(blank, "").otherwise(F.col("label"))
    specialty = F.when(slash > 0, F.trim(F.substr("label", slash + 1))).when(blank, F.col("label")).otherwise("")
    d = d.select("doc_id", "_o", "side", F.when(right, "").otherwise(F.col("label")).alias("work_type"), F.when(right, job).otherwise("").alias("job_field"),
                 F.when(right, specialty).otherwise("").alias("specialty"), "days")
    d = d.where("side = 'left' or job_field <> '' or specialty <> ''")
    return d.groupBy("doc_id", "side", "work_type", "job_field", "specialty").agg(F.min_by("days", "_o").alias("days"))


# ------------------------------------------------------------------ page-bottom numbers
def days_after(text: Column, label: str) -> Column:
    """Number before 일 right after ``label`` in blank-free text; empty without one."""
    number = F.regexp_extract(F.coalesce(text, F.lit("")), quote(label) + r"[:：]?(\d[\d,]*)일", 1)
    return F.replace(number, F.lit(","), F.lit(""))


def _slice(text: Column, start: str, ends: Sequence[str]) -> Column:
    """From ``start`` to the nearest of ``ends`` behind it, or to the end; empty without ``start``."""
    return F.regexp_extract(text, f"(?s)({quote(start)}.*?)(?:{'|'.join(quote(e) for e in ends)}|\\z)", 1)


def work_periods(text: Column) -> Column:
    """The 15 day counts at the bottom of the CM section."""
    c = F.replace(compact(text), F.lit("："), F.lit(":"))
    safety = "건설사업관리기술인으로서안전관리업무수행기간"
    cm = lambda c: _slice(c, "건설사업관리업무수행기간", ["감리업무수행기간", safety, "용역완성비율"])
    sup = lambda c: _slice(c, "감리업무수행기간", [safety, "용역완성비율"])
    tech_of = lambda b: F.when(F.instr(b, "기술지원") > 0, F.substr(b, F.greatest(F.instr(b, "기술지원"), F.lit(1)))).otherwise("")
    stay_of = lambda b: F.when(F.instr(b, "상주") > 0, F.regexp_extract(b, r"(?s)(상주.*?)(기술지원|$)", 1)).otherwise(b)

    def build(x: Column) -> Column:
        a, b = x["cm"], x["sup"]
        at, bt, bs = tech_of(a), tech_of(b), stay_of(b)
        s = days_after(x["c"], safety)
        return F.struct(
            days_after(a, "건설사업관리업무수행기간").alias("cm_total"), days_after(a, "상주").alias("cm_stay"),
            days_after(a, "감독권한대행등건설사업관리").alias("cm_stay_proxy"), days_after(a, "시공단계건설사업관리").alias("cm_stay_build"),
            days_after(a, "기술지원").alias("cm_tech"), days_after(at, "감독권한대행등건설사업관리").alias("cm_tech_proxy"), days_after(at, "시공단계건설사업관리").alias("cm_tech_build"),
            days_after(b, "감리업무수행기간").alias("sup_total"), days_after(b, "상주").alias("sup_stay"),
            days_after(bs, "공동주택").alias("sup_stay_housing"), days_after(bs, "다중이용시설").alias("sup_stay_public"),
            days_after(b, "기술지원").alias("sup_tech"), days_after(bt, "공동주택").alias("sup_tech_housing"), days_after(bt, "다중이용시설").alias("sup_tech_public"),
            F.when(s != "", s).otherwise(days_after(x["c"], "안전관리업무수행기간")).alias("safety"))

    return let(c, lambda c: let(F.struct(c.alias("c"), cm(c).alias("cm"), sup(c).alias("sup")), build))


def one_year_stats(text: Column) -> Column:
    """Completion percentage and four (or two) counts of the last year."""
    c = compact(text)
    pos = F.instr(c, "용역완성비율")
    win = F.when(pos > 0, F.substr(c, F.greatest(pos, F.lit(1)))).otherwise("")

    def read(w: Column) -> Column:
        nums = F.regexp_extract_all(w, F.lit(r"(\d+)\s*건"), F.lit(1))
        n = F.size(nums)
        pick = lambda four, two: F.when(n >= 4, F.get(nums, F.lit(four))).when(n == 2, F.get(nums, F.lit(two)) if two is not None else F.lit("")).otherwise("")
        return F.struct(F.regexp_extract(w, r"용역완성비율[:：]?(\d+(?:\.\d+)?)%", 1).alias("percent"), pick(0, 0).alias("joined_stay"), pick(1, None).alias("joined_tech"), pick(2, 1).alias("done_stay"), pick(3, None).alias("done_tech"))

    return let(win, read)


# ------------------------------------------------------------------ front page
def personal_info(text: Column, pivot_yy: int) -> Column:
    """Name, birth date, address, management number and issue date out of the front text."""
    from recordloom.functions.dates import birth_to_iso

    def read(t: Column) -> Column:
        no = F.regexp_extract(t, r"관리번호\s*(?:[:：\s]*)(#\s*(?:\d\s*)+|\d(?:\s*\d)*)", 1)
        alt = F.regexp_extract(t, r"(#\s*(?:\d\s*)+)", 1)
        issued = [F.regexp_extract(t, r"(\d{4})\s*년\s*(\d{1,2})\s*월\s*(\d{1,2})\s*일", i) for i in (1, 2, 3)]
        nexts = "설계·시공|설계시공|건설사업관리|품질관리|연락처|전화번호|전화|휴대전화|휴대|전자우편|이메일|등급|국가기술자격|학력|교육훈련|상훈|벌점|제재|근무처"
        return F.struct(
            F.regexp_extract(t, r"성명\(한글\)\s+(\S+)", 1).alias("name"), birth_to_iso(F.regexp_extract(t, r"생년월일\s+(\d{2}\.\d{2}\.\d{2})", 1), pivot_yy).alias("birth"),
            F.trim(F.regexp_extract(t, rf"주소\s+(.+?)(?=\s+(?:{nexts})|$)", 1)).alias("address"),
            F.replace(F.when(no != "", no).otherwise(alt), F.lit(" "), F.lit("")).alias("mgmt_no"),
            F.coalesce(F.date_format(F.try_to_date(F.concat_ws("-", *issued), "yyyy-M-d"), "yyyy-MM-dd"), F.lit("")).alias("issue_date"))

    return let(squeeze(text), read)


# Fixed value: a licence row of the form (kind ending, date, number).
LICENCE_ROW = r"([가-힣A-Za-z0-9·ㆍ()\-/ ]+?(?:기사|산업기사|기능사|기술사|기능장))\s+(\d{4}\.\d{2}\.\d{2})(?:\s+([A-Z0-9\-]{4,}|\d{4,}|\S+))?"


def licence_rows(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """Name, date and number of every licence pattern in the text."""
    part = lambda i: F.regexp_extract_all(F.col(text), F.lit(LICENCE_ROW), F.lit(i))
    z = F.arrays_zip(part(1).alias("name"), part(2).alias("date"), part(3).alias("number"))
    d = df.select(*keys, F.posexplode(z).alias("seq", "x"))
    return d.select(*keys, "seq", F.trim("x.name").alias("name"), date_to_iso(F.col("x.date"), "passthrough").alias("pass_date"), F.coalesce("x.number", F.lit("")).alias("number"))


def infer_licence_number(df: DataFrame, all_text: str, name: str, date: str, number: str, keys: Sequence[str]) -> DataFrame:
    """Number for rows without one: best candidate of 6+ letters left after dates and the name are taken out."""
    from recordloom.operators.dedup import registration_quality

    need = df.where(is_blank(F.col(number)) & ~is_blank(F.col(date)))
    hay = squeeze(F.replace(F.regexp_replace(all_text, r"\d{4}\.\d{2}\.\d{2}", " "), F.col(name), F.lit(" ")))
    c = need.select(*keys, date, F.explode(F.regexp_extract_all(hay, F.lit(r"(?U)\b([A-Z0-9][A-Z0-9\-]{5,}[A-Z0-9]?)\b"), F.lit(1))).alias("_cand"))
    q = registration_quality(date_to_iso(F.col(date), "passthrough"), F.col("_cand"))
    best = c.groupBy(*keys).agg(F.max_by("_cand", F.struct(*q)).alias("_best"))
    return df.join(best, list(keys), "left").withColumn(number, F.when(is_blank(F.col(number)), F.coalesce("_best", F.lit(""))).otherwise(F.col(number))).drop("_best")


# Fixed value: degrees as the form prints them.
EDU_KIND = "(?:학사|석사|박사과정|박사수료|박사|없음|대졸|전문졸업|전문|고졸|중졸|초졸|석·박|본\\s*석사|본석사)"


def education_row(text: Column) -> Column:
    """struct(date, prev_school, school, major, degree, status) of 'date school major degree[status]', null otherwise.

    The major begins at the first word that ends like one, else it is the last word;
    what stands behind the status goes to the major.
    """
    s = squeeze(text)
    pat = rf"(?:^|\s)(?:학력\s+)?(\d{{4}}\.\d{{2}}\.\d{{2}})\s+(.+?)\s*({EDU_KIND})\[\s*([^\]]+?)\s*\]\s*(.*)$"
    g = lambda i: F.regexp_extract(s, pat, i)

    def read(x: Column) -> Column:
        t = F.filter(F.split(x["body"], " "), lambda y: y != "")
        at = F.get(F.filter(F.sequence(F.lit(1), F.greatest(F.size(t) - 1, F.lit(1))), lambda i: F.get(t, i).rlike("(과|학과|전공|학부)$")), F.lit(0))
        at = F.coalesce(at, F.when(F.size(t) >= 2, F.size(t) - 1))
        school = F.array_join(F.slice(t, F.lit(1), F.coalesce(at, F.size(t))), " ")
        major = F.trim(F.concat_ws(" ", F.array_join(F.slice(t, F.coalesce(at, F.size(t)) + 1, F.size(t)), " "), F.regexp_replace(x["rest"], r"(^|\s+)학력\s*$", "")))
        now = F.regexp_extract(school, r"\((?:現|현)\s*[:：]\s*([^)]+)\)", 1)
        return F.struct(
            date_to_iso(x["d"], "passthrough").alias("date"), F.when(now != "", F.trim(F.regexp_extract(school, r"^([^(]*)\(", 1))).otherwise("").alias("prev_school"),
            F.when(now != "", F.trim(now)).otherwise(school).alias("school"), major.alias("major"), x["deg"].alias("degree"), x["st"].alias("status"))

    return F.when(g(1) != "", let(F.struct(g(1).alias("d"), g(2).alias("body"), g(3).alias("deg"), g(4).alias("st"), g(5).alias("rest")), read))


# Recognition words and the endings of training institutions.
RECOGNITIONS = ["건설사업관리", "설계·시공", "품질관리"]
ORG_SUFFIX = "(교육원|협회|공단|공사|연구원|센터|연수원|재단|학회|진흥원|대학교|대학|전문학교|캠퍼스)$"


def training_row(text: Column) -> Column:
    """struct(start, end, course, institution, recognition) of a training row, null otherwise.

    The last token with an institution suffix is the institution; a recognition
    word is taken out wherever it stands last; text behind the institution goes
    back to the course.
    """
    s = squeeze(F.replace(F.coalesce(text, F.lit("")), F.lit("** 해당없음 **"), F.lit("")))
    pat = r"^(\d{4}\.\d{2}\.\d{2})\s*~\s*(\d{4}\.\d{2}\.\d{2})\s+(.+)$"
    # an award that runs on behind the course: its kind with a bracket, or its number
    award = r"(?s)(?:(?:표창장|훈장|포장|감사장)\s*[\[(]|\[제|제\s*[\d-]+\s*호).*$"

    def read(x: Column) -> Column:
        t0 = F.filter(F.split(F.trim(x["body"]), " "), lambda y: y != "")
        last = lambda arr, test: F.array_max(F.transform(arr, lambda y, i: F.when(test(y), i)))
        rec = last(t0, lambda y: y.isin(*RECOGNITIONS))

        def cut(t: Column) -> Column:
            def build(o: Column) -> Column:
                course = F.array_join(F.slice(t, F.lit(1), o), " ")
                trail = F.array_join(F.slice(t, o + 2, F.size(t)), " ")
                tight = course.rlike("[가-힣]$") & trail.rlike("^[가-힣]")
                full = F.when(trail == "", course).when(course == "", trail).when(tight, F.concat(course, trail)).otherwise(F.concat(course, F.lit(" "), trail))
                closed = F.when(count_char(full, "(") > count_char(full, ")"), F.when(full.endswith("(원격"), F.concat(full, F.lit("교육)"))).otherwise(F.concat(full, F.lit(")")))).otherwise(full)
                return F.when(o.isNotNull() & (closed != ""), F.struct(
                    date_to_iso(x["s"], "passthrough").alias("start"), date_to_iso(x["e"], "passthrough").alias("end"), closed.alias("course"),
                    F.get(t, o).alias("institution"), F.coalesce(F.get(t0, rec), F.lit("")).alias("recognition")))

            return let(last(t, lambda y: y.rlike(ORG_SUFFIX)), build)

        return let(F.when(rec.isNull(), t0).otherwise(F.filter(t0, lambda y, i: i != rec)), cut)

    parts = lambda s: F.struct(*[F.regexp_extract(s, pat, i).alias(n) for i, n in ((1, "s"), (2, "e"))], F.regexp_replace(F.regexp_extract(s, pat, 3), award, "").alias("body"))
    return let(s, lambda s: F.when(s.rlike(pat), let(parts(s), read)))


def _glue_open(texts: Column) -> Column:
    """Texts joined with blanks; behind an open square bracket without any, and without those before it."""
    is_open = lambda a: count_char(a, "[") > count_char(a, "]")
    return F.aggregate(texts, F.lit(""), lambda a, x: F.when(a == "", x).when(is_open(a), F.concat(compact(a), compact(x))).otherwise(F.concat(a, F.lit(" "), x)))


def line_islands(lines: DataFrame, start: Column, keys: Sequence[str], order: str = "line_no", sep: str = " ", join=None) -> DataFrame:
    """Lines from each ``start`` line to the next, joined by ``sep`` or by ``join``; lines before the first start are dropped."""
    w = Window.partitionBy(*keys).orderBy(order)
    d = lines.withColumn("_g", F.sum(start.cast("int")).over(w)).where("_g > 0")
    g = d.groupBy(*keys, "_g").agg(F.sort_array(F.collect_list(F.struct(order, "line"))).alias("r"))
    return g.select(*keys, F.col("_g").cast("bigint").alias("island"), (join(F.transform("r", lambda x: x["line"])) if join else F.array_join(F.transform("r", lambda x: x["line"]), sep)).alias("text"))


def penalty_points(cell: Column) -> Column:
    """Points of a penalty cell: its number, else its text; 해당없음 when blank or not applicable."""
    s = squeeze(cell)
    num = F.regexp_extract(F.replace(s, F.lit("점"), F.lit(" ")), r"(\d+(?:\.\d+)?)", 1)
    return F.when((s == "") | F.contains(s, F.lit("해당없음")) | F.contains(s, F.lit("근무기간")), "해당없음").when(num != "", num).otherwise(s)


# Words that announce a company change, in order of precedence.
CHANGE_MARKERS = ["現", "현", "흡수합병", "분할설립", "상호변경", "법인전환", "합병", "양수도", "양도양수"]


def company_split(c: Column, markers: Sequence[str] = tuple(CHANGE_MARKERS)) -> Column:
    """struct(previous, current) of a company text.

    The first marker of the list that occurs splits it, else a bare colon, else a
    dated colon; a single name is the current one.
    """
    def tidy(s: Column) -> Column:
        return F.trim(F.regexp_replace(s, "(" + "|".join(quote(m) for m in markers) + r")\s*:\s*", "$1:"))

    def split(s: Column) -> Column:
        def at(tok: str) -> Column:
            p = F.instr(s, tok)
            return F.struct(F.trim(F.substr(s, F.lit(1), F.greatest(p - 1, F.lit(0)))).alias("p"), F.trim(F.substr(s, p + len(tok))).alias("c"))

        colon = at(":")
        out = F.when(F.contains(s, F.lit(":")) & (colon["p"] != "") & colon["c"].rlike("[가-힣A-Za-z0-9]"), colon).otherwise(F.struct(s.alias("p"), F.lit("").alias("c")))
        for m in reversed(markers):
            out = F.when(F.contains(s, F.lit(m + ":")), at(m + ":")).otherwise(out)
        return out

    def dated(x: Column) -> Column:
        blob = F.when(x["c"] == "", x["p"]).otherwise(x["c"])
        pat = r"^(.*?)\d{4}\.\d{2}\.\d{2}\s*[:：]\s*(.+)$"
        left = squeeze(F.regexp_replace(F.regexp_extract(blob, pat, 1), r"\d{4}\.\d{2}\.\d{2}", " "))
        right = F.trim(F.regexp_extract(blob, pat, 2))
        ok = (left != "") & right.rlike("[가-힣A-Za-z0-9]")
        return F.when(ok & (x["c"] == ""), F.struct(left.alias("p"), right.alias("c"))).when(
            ok, F.struct(F.when(x["p"] == "", left).otherwise(x["p"]).alias("p"), right.alias("c"))).otherwise(x)

    def finish(x: Column) -> Column:
        cur = x["c"]
        for m in markers:
            cur = F.when(x["c"].startswith(m + ":"), F.trim(F.substr(x["c"], F.lit(len(m) + 2)))).otherwise(cur)
        return F.struct(F.when(cur == "", "").otherwise(x["p"]).alias("previous"), F.when(cur == "", x["p"]).otherwise(cur).alias("current"))

    base = squeeze(F.replace(F.coalesce(c, F.lit("")), F.lit("："), F.lit(":")))
    return let(let(let(let(base, tidy), split), dated), finish)


def chain_workplaces(df: DataFrame, keys: Sequence[str] = ("doc_id",), order: str = "seq") -> DataFrame:
    """A workplace that ends when the next one starts takes over the next one's former name.

    The rule reads the row's own former name and the next row as they were read: a
    row is changed at most once, by its successor, before it is looked at as one.
    """
    d = neighbour(df, keys, order, {"_ns": "start_date", "_np": "previous", "_nc": "current"})
    hit = (
        (F.col("end_date") != "") & (F.col("end_date") == F.col("_ns")) & is_blank(F.col("previous")) & ~is_blank(F.col("current"))
        & ~is_blank(F.col("_np")) & ~is_blank(F.col("_nc")) & ~F.col("_np").rlike("[:：]"))
    hit = F.coalesce(hit, F.lit(False))
    return d.withColumn("_p", F.when(hit, F.col("current")).otherwise(F.col("previous"))).withColumn("_c", F.when(hit, F.col("_np")).otherwise(F.col("current"))).select(
        *[F.col("_p").alias(c) if c == "previous" else F.col("_c").alias(c) if c == "current" else F.col(c) for c in df.columns])


GRADES = ["특급", "고급", "중급", "초급"]


def grade_blocks(text: Column, jobs: Sequence[str], specialties: Sequence[str]) -> Column:
    """Job and specialty grades of the design and CM blocks and the quality grade.

    In each block the longest catalog name directly followed by a grade wins; names
    match with or without their blanks.
    """
    from recordloom.operators.sections import text_between

    s = squeeze(F.replace(F.coalesce(text, F.lit("")), F.lit("ㆍ"), F.lit("·")))

    def graded(names: Sequence[str]):
        pairs = [(n, g) for n in sorted(dict.fromkeys(names), key=len, reverse=True) for g in GRADES]
        lit = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(g).alias("grade"), F.lit("".join(n.split()) + g).alias("key")) for n, g in pairs])
        return lambda block: let(compact(block), lambda b: F.get(F.filter(lit, lambda x: F.contains(b, x["key"])), F.lit(0)))

    job, spec = graded(jobs), graded(specialties)
    def cut(s: Column) -> Column:
        return F.struct(
            text_between(s, ["설계·시공", "설계시공"], ["건설사업관리", "품질관리", "국가기술자격"]).alias("design"), text_between(s, ["건설사업관리"], ["품질관리", "국가기술자격"]).alias("cm"),
            text_between(s, ["품질관리"], ["국가기술자격"]).alias("quality"))

    def quality(text: Column) -> Column:
        q = F.lit("")
        for g in reversed(GRADES):
            q = F.when(F.contains(text, F.lit(g)), g).otherwise(q)
        return q

    def part(x: Column, name: str) -> list[Column]:
        return [F.coalesce(x["name"], F.lit("")).alias(name), F.coalesce(x["grade"], F.lit("")).alias(name + "_grade")]

    def build(x: Column) -> Column:
        return F.struct(*part(x["a"], "design_job"), *part(x["b"], "design_specialty"), *part(x["c"], "cm_job"), *part(x["d"], "cm_specialty"), x["q"].alias("quality_grade"))

    # the blocks are bound before they are searched: names below would cut them out again
    found = lambda b: F.struct(job(b["design"]).alias("a"), spec(b["design"]).alias("b"), job(b["cm"]).alias("c"), spec(b["cm"]).alias("d"), quality(b["quality"]).alias("q"))
    return let(let(let(s, cut), found), build)


def workplace_cells(pairs: DataFrame, period: str = "left_text", company: str = "right_text") -> DataFrame:
    """(start, end, previous, current) of period/company cell pairs; pairs without a range are dropped."""
    pat = r"(\d{4}\.\d{2}(?:\.\d{2})?)\s*~\s*(\d{4}\.\d{2}(?:\.\d{2})?|근\s*무\s*중)"
    s, e = F.regexp_extract(period, pat, 1), F.regexp_extract(period, pat, 2)
    rest = [c for c in pairs.columns if c not in (period, company)]
    d = pairs.where((s != "") & ~is_blank(F.col(company))).select(
        *rest, date_to_iso(s, "unchecked").alias("start_date"),
        F.when(compact(e) == ONGOING, ONGOING).otherwise(date_to_iso(e, "unchecked")).alias("end_date"), company_split(F.col(company)).alias("_c"))
    return d.select(*rest, "start_date", "end_date", "_c.previous", "_c.current")


def inline_workplaces(df: DataFrame, text: str, keys: Sequence[str], markers: Sequence[str] = tuple(CHANGE_MARKERS)) -> DataFrame:
    """Ranges with a (주) company in running text; a marked successor right behind makes the first name the former one."""
    firm = r"(?:[가-힣0-9]+\(주\)|\(주\)[가-힣0-9]+)"
    mark = "(?:" + "|".join(quote(m) for m in markers) + ")"
    pat = rf"(\d{{4}}\.\d{{2}}(?:\.\d{{2}})?)\s*~\s*(\d{{4}}\.\d{{2}}(?:\.\d{{2}})?|근\s*무\s*중)\s+({firm})(?:\s*(?:\d{{4}}\.\d{{2}}\.\d{{2}}\s+)?{mark}\s*[:：]\s*({firm}))?"
    s = squeeze(F.col(text))
    part = lambda i: F.regexp_extract_all(s, F.lit(pat), F.lit(i))
    d = df.select(*keys, F.posexplode(F.arrays_zip(part(1).alias("s"), part(2).alias("e"), part(3).alias("a"), part(4).alias("b"))).alias("seq", "x"))
    now = F.coalesce("x.b", F.lit(""))
    return d.select(*keys, "seq", date_to_iso(F.col("x.s"), "workplace").alias("start_date"),
                    F.when(compact(F.col("x.e")) == ONGOING, ONGOING).otherwise(date_to_iso(F.col("x.e"), "workplace")).alias("end_date"),
                    F.when(now != "", F.col("x.a")).otherwise("").alias("previous"), F.when(now != "", now).otherwise(F.col("x.a")).alias("current"))


def award_lines(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Award rows of a text section: islands at date lines that are no ranges, split at the earliest award kind.

    The header line is skipped, a leading 상훈 taken off, and a penalty line that says
    해당없음 ends the section.  While a bracket is open, lines are joined without blanks.
    """
    from recordloom.operators.dedup import award_kind_position, normalize_award_text

    line = F.col("line")
    start = line.rlike(r"^\d{4}\.\d{2}\.\d{2}") & ~F.contains(line, F.lit("~"))
    w = Window.partitionBy(*keys).orderBy("line_no")
    lines = lines.withColumn("line", F.regexp_replace("line", r"^\s*상훈\s+(?=\d{4}\.)", "")).where(~(F.contains("line", F.lit("수여일")) & F.contains("line", F.lit("수여기관"))))
    lines = lines.withColumn("_end", F.max(F.col("line").rlike(r"^\s*벌점\s*[*＊]?\s*해당없음\s*[*＊]?\s*$").cast("int")).over(w)).where("_end = 0").drop("_end")
    d = line_islands(lines, start, keys, join=_glue_open)
    body = F.trim(F.substr("text", F.lit(11)))
    pos = award_kind_position(body)
    return d.select(*keys, "island", date_to_iso(F.substring("text", 1, 10), "passthrough").alias("award_date"),
                    F.when(pos > 1, F.trim(F.substr(body, F.lit(1), F.greatest(pos - 1, F.lit(0))))).when(pos == 1, "").otherwise(body).alias("institution"),
                    F.when(pos > 0, normalize_award_text(F.substr(body, F.greatest(pos, F.lit(1))))).otherwise("").alias("kind"))


def award_line_count(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dated award lines of a section; 1 where there is none but the section says 해당없음."""
    line = F.col("line")
    dated = line.rlike(r"^\d{4}\.\d{2}\.\d{2}") & ~F.contains(line, F.lit("~"))
    g = lines.groupBy(*keys).agg(F.count_if(dated).alias("d"), F.count_if(F.contains(compact(line), F.lit("해당없음"))).alias("x"))
    return g.select(*keys, F.when(F.col("d") > 0, F.col("d")).when(F.col("x") > 0, 1).otherwise(0).cast("bigint").alias("n"))


def sanitize_institution(inst: Column, kind: Column) -> Column:
    """Blank an institution cell that only holds a fragment of an award kind."""
    from recordloom.operators.dedup import award_kind_position

    s = F.trim(F.replace(F.coalesce(inst, F.lit("")), F.lit("\n"), F.lit(" ")))
    leads = award_kind_position(F.trim(F.coalesce(kind, F.lit("")))) == 1
    junk = s.isin("표창", "훈장", "포장", "감사", "상장", "장려", "포상", "유공", "관리청 표창", "관 감사", "경기도유공", "새서", "시", "청", "관", "사", "벽")
    return F.when(junk | (leads & ((F.length(s) <= 2) | (F.contains(s, F.lit("/")) & (F.length(s) <= 12)))), "").otherwise(s)
