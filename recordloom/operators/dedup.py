"""Duplicates, ranked de-duplication and award merging.

"First wins" and "best wins" are ``min_by`` / ``max_by`` aggregates, which combine
map-side: a key holding a third of all rows shrinks to one row per task before
the shuffle.  No window runs over a key group of unknown size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.text import compact, contains_any, count_char, is_blank, let, squeeze
from recordloom.operators.scan import Running, running


def mark_duplicates(df: DataFrame, scope: Sequence[str] = ("doc_id", "section"), key: Sequence[str] = ("project_name", "start_date", "end_date")) -> DataFrame:
    """Flag rows that share all key fields; nothing is deleted.

    Adds ``dup``, ``dup_group`` (number in key order inside the scope) and
    ``dup_count``.  Group numbers are a running count over the duplicate keys only,
    carried over key prefixes so that a scope of any size stays split.
    """
    norm = [f"_k{i}" for i in range(len(key))]
    d = df.select("*", *[squeeze(F.col(k)).alias(n) for k, n in zip(key, norm)])
    full = d.where(" and ".join(f"{n} <> ''" for n in norm))
    dup = full.groupBy(*scope, *norm).agg(F.count(F.lit(1)).alias("dup_count")).where("dup_count >= 2")
    dup = dup.withColumn("_p1", F.substring(norm[0], 1, 2)).withColumn("_p2", F.substring(norm[0], 1, 6)).withColumn("_one", F.lit(1))
    dup = running(dup, scope, ["_p1", "_p2"], norm, [Running("dup_group", "sum", "_one")]).drop("_p1", "_p2", "_one")
    out = d.join(dup, [*scope, *norm], "left")
    return out.select(*df.columns, F.col("dup_group").isNotNull().alias("dup"), F.col("dup_group").cast("bigint").alias("dup_group"),
                      F.col("dup_count").alias("dup_count"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Exact-key de-duplication, first in ``order`` wins."""
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return g.select(*[F.col(c) if c in keys else F.col("_r")[c].alias(c) for c in df.columns])


def best_per_key(df: DataFrame, keys: Sequence[str], score: Sequence[Column], order: str) -> DataFrame:
    """Row with the greatest score tuple per key; the first in ``order`` wins ties."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[s.alias(f"s{i}") for i, s in enumerate(score)], (-F.col(order)).alias("o"))
    g = df.withColumn("_s", rank).groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("_s")).alias("_r"))
    return g.select(*[F.col(c) if c in keys else F.col("_r")[c].alias(c) for c in df.columns])


# Grade words that are no licence name on their own.
LONE_GRADES = ["기사", "산업기사", "기능사", "기술사", "기능장"]


def registration_quality(pass_date: Column, number: Column) -> list[Column]:
    """(year prefix fits 10/0, not a short digit run, length up to 30, text): greater is better."""
    reg = F.trim(F.coalesce(number, F.lit("")))
    year = F.when(pass_date.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(pass_date, 3, 2))
    fits = F.coalesce((F.length(reg) >= 2) & (F.substring(reg, 1, 2) == year), F.lit(False))
    fragile = reg.rlike(r"^\d+$") & (F.length(reg) < 10)
    return [F.when(fits, 10).otherwise(0), F.when(fragile, 0).otherwise(1), F.least(F.length(reg), F.lit(30)), F.upper(reg)]


def dedup_licences(df: DataFrame, doc: str = "doc_id", name: str = "name", date: str = "pass_date", number: str = "number", order: str = "seq") -> DataFrame:
    """Two passes: by (date, reliable number) or else (date, name); then by (date, name).  The best score stays."""
    reg = F.upper(compact(F.col(number)))
    reliable = (F.length(reg) >= 8) & reg.rlike(r"\d")
    d = df.withColumn("_k", F.when(reliable, F.concat(F.lit("reg|"), reg)).otherwise(F.concat(F.lit("name|"), compact(F.col(name)))))
    d = d.withColumn("_n", compact(F.col(name)))
    q = registration_quality(F.col(date), F.col(number))
    score = [F.when(F.col("_n").isin(*LONE_GRADES), 0).otherwise(1), q[0], q[1], q[2], F.length(F.trim(F.col(name))), q[3]]
    once = best_per_key(d, [doc, date, "_k"], score, order)
    return best_per_key(once.drop("_k"), [doc, date, "_n"], score, order).select(*df.columns)


# Award kinds, most specific first.
AWARD_KINDS = ["공로표창장", "표창장", "표창패", "유공표창", "우수상", "훈장증", "훈장", "포장", "감사장", "상장", "표창"]
AWARD_BLOCK = (
    r"(공로표창장(?:\([^)]*\))?\[[^\]]*\]|훈장증\[[^\]]*\]|표창장(?:\([^)]*\))?\[[^\]]*\]|표창(?:\([^)]*\))?\[[^\]]*\]|표창패(?:\([^)]*\))?\[[^\]]*\]"
    r"|유공표창(?:\([^)]*\))?\[[^\]]*\]|우수상\[[^\]]*\]|감사장(?:\([^)]*\))?\[[^\]]*\]|포장(?:\([^)]*\))?\[[^\]]*\]|훈장\[[^\]]*\]|상장(?:\([^)]*\))(?:\[[^\]]*\])?)"
)


def award_kind_position(c: Column) -> Column:
    """Position (from 1) of the earliest award kind in the text, 0 without one."""
    big = F.lit(2**31 - 1)
    pos = F.least(*[F.coalesce(F.nullif(F.instr(c, k), F.lit(0)), big) for k in AWARD_KINDS])
    return F.when(pos == big, 0).otherwise(pos)


def award_blocks(c: Column) -> Column:
    """Award blocks of a text, in order."""
    return F.regexp_extract_all(F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" ")), F.lit(AWARD_BLOCK), F.lit(1))


def collapse_blocks(blocks: Column) -> Column:
    """A block list that repeats one sequence is reduced to that sequence; neighbours equal but for blanks become one (the longer)."""
    def repeat_once(b: Column) -> Column:
        n = F.size(b)
        periods = F.filter(
            F.sequence(F.lit(1), F.greatest(F.floor(n / 2), F.lit(1)).cast("int")),
            lambda p: (n >= 2) & (n % p == 0) & (n > p) & F.forall(F.sequence(F.lit(1), n), lambda i: F.get(b, i - 1) == F.get(b, (i - 1) % p)),
        )
        return F.slice(b, F.lit(1), F.greatest(F.coalesce(F.array_max(periods), n), F.lit(0)))

    inner = lambda x: compact(F.coalesce(F.nullif(F.regexp_extract(x, r"\[([^\]]*)\]", 1), F.lit("")), x))

    def merge(b: Column) -> Column:
        return F.aggregate(b, F.array().cast("array<string>"), lambda acc, x: F.when(
            (F.size(acc) > 0) & (inner(F.try_element_at(acc, F.lit(-1))) == inner(x)),
            F.when(F.length(x) > F.length(F.try_element_at(acc, F.lit(-1))), F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(x))).otherwise(acc),
        ).otherwise(F.concat(acc, F.array(x))))

    return let(let(blocks, repeat_once), merge)


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two short texts: a fold of one table row per letter."""
    xs = F.filter(F.split(a, ""), lambda x: x != "")
    ys = F.filter(F.split(b, ""), lambda x: x != "")

    def row(prev: Column, x: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.size(ys)), F.array(F.lit(0)),
            lambda cur, j: F.concat(cur, F.array(F.when(F.get(ys, j - 1) == x, F.get(prev, j - 1) + 1).otherwise(
                F.greatest(F.try_element_at(cur, F.lit(-1)), F.get(prev, j))))))

    last = F.aggregate(xs, F.array_repeat(F.lit(0), F.size(ys) + 1), row)
    return F.when((F.size(xs) == 0) | (F.size(ys) == 0), 0).otherwise(F.try_element_at(last, F.lit(-1)))


def normalize_award_text(c: Column) -> Column:
    """Award kind and reason: section label, torn numbers, text before the kind, doubled blocks, repeated tails, open bracket."""
    # The section's name in the text; a number torn behind its dash; a lost first word; a doubled kind.
    def start(t: Column) -> Column:
        t = F.regexp_replace(t, r"(?U)\b상훈\b", " ")
        t = F.regexp_replace(t, r"(제\s*\d+\s*[-–]\s*\d+)\s+(\d+\s*호)", "$1$2")
        t = F.regexp_replace(F.trim(t), r"^장(\[(?:제\s*)[^\]]+\])", "표창장$1")
        return squeeze(F.regexp_replace(t, r"(?:^|\s)표창장(?:\s+표창장)+(?=[\[(])", " 표창장"))

    def from_kind(t: Column) -> Column:
        out = F.lit(None).cast("string")
        for k in reversed(AWARD_KINDS):
            out = F.when(F.instr(t, k) > 1, F.trim(F.substr(t, F.instr(t, k)))).otherwise(out)
        # A text that already starts with a kind keeps its first block.
        t2 = F.when(award_kind_position(t) == 1, t).otherwise(F.coalesce(out, t))
        return F.trim(F.regexp_replace(t2, r"(?:^|\s)벌점\s*[*＊・]?\s*해당없음\s*[*＊・]?(?=\s|$)", " "))

    def once(t: Column) -> Column:
        # a number in brackets of its own at the end whose digits stand before it
        pattern = r"^(.*\])\s*\[(제\s*[\d－-]+\s*호)\]\s*$"
        digits = lambda i: F.regexp_replace(F.regexp_extract(t, pattern, i), r"\D", "")
        return F.when((digits(2) != "") & F.contains(digits(1), digits(2)), F.trim(F.regexp_extract(t, pattern, 1))).otherwise(t)

    def cut_tail(t: Column) -> Column:
        head, tail = F.regexp_extract(t, r"^([^\]]*)\]", 1), F.trim(F.regexp_extract(t, r"^[^\]]*\](.*)$", 1))
        clean = lambda x: F.regexp_replace(compact(x), r"[\[\](){}<>\"'“”‘’·,，.]", "")
        inside = clean(F.regexp_extract(head, r"\[(.*)$", 1))

        def decide(v: Column) -> Column:
            tail_n, base = v["tail"], F.when(v["inside"] != "", v["inside"]).otherwise(v["head"])
            same = F.contains(v["inside"], tail_n) | F.contains(v["head"], tail_n)
            near = lcs_length(tail_n, base) / F.greatest(F.length(tail_n), F.lit(1)) >= 0.85
            return (tail_n != "") & F.when(same, True).otherwise(near)

        plain = (F.length(tail) >= 6) & ~contains_any(tail, AWARD_KINDS)
        test = let(F.struct(clean(tail).alias("tail"), inside.alias("inside"), clean(head).alias("head")), decide)
        return F.when(F.contains(t, F.lit("]")) & plain, F.when(test, F.concat(F.trim(head), F.lit("]"))).otherwise(t)).otherwise(t)

    def collapse(t: Column) -> Column:
        return let(award_blocks(t), lambda b: let(collapse_blocks(b), lambda b2: F.when((F.size(b) >= 2) & (b != b2), F.array_join(b2, " ")).otherwise(t)))

    def close(t: Column) -> Column:
        opened = (count_char(t, "[") > count_char(t, "]"))
        t2 = F.when(opened, F.concat(t, F.lit("]"))).otherwise(t)
        first = F.regexp_extract(t2, r"^(.*?(?:" + "|".join(AWARD_KINDS) + r")\[)([^\]]*)(\].*)$", 2)
        return F.when(first == "", t2).otherwise(F.concat(
            F.regexp_extract(t2, r"^(.*?(?:" + "|".join(AWARD_KINDS) + r")\[)([^\]]*)(\].*)$", 1), compact(first),
            F.regexp_extract(t2, r"^(.*?(?:" + "|".join(AWARD_KINDS) + r")\[)([^\]]*)(\].*)$", 3)))

    base = F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" ")))
    out = let(base, start)
    for step in (from_kind, once, cut_tail, collapse, close):
        out = let(out, step)
    return out


def award_quality(c: Column) -> Column:
    """Plausibility score of an award text."""
    def score(t: Column) -> Column:
        balanced = F.contains(t, F.lit("[")) & F.contains(t, F.lit("]")) & (count_char(t, "[") == count_char(t, "]"))
        return F.when(t == "", -10).otherwise(
            F.when(contains_any(t, AWARD_KINDS), 3).otherwise(0) + F.when(balanced, 1).otherwise(0)
            - F.when(contains_any(t, ["수여일", "수여기관", "종류", "근거", "상훈"]), 2).otherwise(0)
            - F.when(t.rlike(r"제\s*\d+\s*[-–]\s*\d+\s+\d+\s*호"), 1).otherwise(0))

    return let(normalize_award_text(c), score)


def merge_awards(df: DataFrame, doc: str = "doc_id", order: str = "seq") -> DataFrame:
    """One award per (date, institution): best scored, then longest text; first non-empty institution spelling."""
    d = df.withColumn("_inst", compact(F.col("institution"))).withColumn("_q", award_quality(F.col("kind")))
    g = d.groupBy(doc, "award_date", "_inst").agg(
        F.min_by("institution", F.when(~is_blank(F.col("institution")), F.col(order))).alias("institution"),
        F.max_by("kind", F.struct("_q", F.length(F.trim(F.col("kind"))), -F.col(order))).alias("kind"),
    )
    return g.select(doc, "award_date", F.coalesce("institution", F.lit("")).alias("institution"), "kind")


def letter_groups(texts: DataFrame, keys: Sequence[str], gram: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rows ``keys, _s, _g`` of texts ``_c`` with their leading letters, and ``keys, _t, _g`` of longer ones with all letter groups to meet them.

    Keys whose texts are all equally long give none, and no group is shorter than
    the shortest text of its keys.
    """
    size = F.length("_c")
    lengths = texts.groupBy(*keys).agg(F.min(size).alias("_lo"), F.max(size).alias("_hi")).where("_lo < _hi")
    texts = texts.join(lengths, list(keys)).withColumn("_lo", F.least("_lo", F.lit(gram)))
    short = texts.where(size < F.col("_hi")).select(*keys, F.col("_c").alias("_s"), F.substr(F.col("_c"), F.lit(1), F.least(size, F.lit(gram))).alias("_g"))
    spots = F.explode(F.sequence(F.lit(1), size - F.col("_lo") + 1)).alias("_i")
    long = texts.where("length(_c) > _lo").select(*keys, "_c", "_lo", spots)
    long = long.select(*keys, "_c", "_i", F.explode(F.sequence("_lo", F.least(F.lit(gram), size - F.col("_i") + 1))).alias("_l"))
    return short, long.select(*keys, F.col("_c").alias("_t"), F.expr("substring(_c, _i, _l)").alias("_g")).distinct()


def drop_contained(df: DataFrame, keys: Sequence[str], text: str, gram: int = 6) -> DataFrame:
    """Drop rows whose blank-free text is part of a longer text with the same keys.

    Candidates meet on the shorter text's leading letters, an equality join on
    letter groups of the longer texts, so a key group is never crossed with itself.
    """
    d = df.withColumn("_c", compact(F.col(text)))
    short, long = letter_groups(d.select(*keys, "_c").distinct().where("_c <> ''"), keys, gram)
    hit = short.join(long, [*keys, "_g"]).where((F.length("_t") > F.length("_s")) & F.contains(F.col("_t"), F.col("_s")))
    gone = hit.select(*keys, F.col("_s").alias("_c")).distinct()
    return d.join(gone, [*keys, "_c"], "left_anti").select(*df.columns)


def strip_suffix_bleed(df: DataFrame, keys: Sequence[str], row: str, text: str, min_len: int = 12, passes: int = 1) -> DataFrame:
    """Cut another row's whole text off the end, the longest such text, if the rest ends with a bracket.

    Suffixes are exploded, so the match is an equality join.  A second pass cuts
    what only the first pass's shorter texts show.
    """
    if passes > 1:
        df = strip_suffix_bleed(df, keys, row, text, min_len, passes - 1)
    d = df.withColumn("_c", compact(F.col(text)))
    suff = d.select(*keys, row, text, "_c", F.explode(F.sequence(F.lit(2), F.greatest(F.length("_c") - min_len + 1, F.lit(2)))).alias("_i"))
    suff = suff.select(*keys, row, text, (F.col("_i") - 1).alias("_keep"), F.expr("substring(_c, _i)").alias("_s")).where(F.length("_s") >= min_len)
    other = d.where(F.length("_c") >= min_len).select(*keys, F.col("_c").alias("_s")).distinct()
    # The part before the suffix, read off the original text: its first ``_keep`` letters with their blanks.
    pre = F.trim(F.expr(f"regexp_extract({text}, concat('^((?:\\\\s*\\\\S){{', cast(_keep as string), '}})'), 1)"))
    cand = suff.join(other, [*keys, "_s"]).select(*keys, row, "_keep", pre.alias("_pre")).where(F.col("_pre").endswith("]"))
    best = cand.groupBy(*keys, row).agg(F.min_by("_pre", "_keep").alias("_pre"))
    return df.join(best, [*keys, row], "left").withColumn(text, F.coalesce("_pre", text)).select(*df.columns)


def redistribute_blocks(df: DataFrame, doc: str = "doc_id", date: str = "award_date", text: str = "kind", order: str = "seq") -> DataFrame:
    """N dated rows that all repeat the same N blocks get one block each, in date order.

    Only documents whose row count equals the block count of their one text are
    numbered, so the numbering window is as small as that text.
    """
    from pyspark.sql import Window

    dated = df.where(F.col(date).rlike(r"^\d{4}-\d{2}-\d{2}$"))
    per = dated.groupBy(doc).agg(F.count(F.lit(1)).alias("_n"), F.min(compact(F.col(text))).alias("_a"), F.max(compact(F.col(text))).alias("_b"), F.min(text).alias("_t"))
    per = per.where("_n >= 2 and _a = _b").withColumn("_blocks", collapse_blocks(award_blocks(F.col("_t")))).where("size(_blocks) = _n")
    d = df.join(per.select(doc, "_blocks"), doc, "left")
    hit = F.col("_blocks").isNotNull() & F.col(date).rlike(r"^\d{4}-\d{2}-\d{2}$")
    num = d.where(hit).withColumn("_i", F.row_number().over(Window.partitionBy(doc).orderBy(date, order)) - 1)
    num = num.withColumn(text, F.get("_blocks", F.col("_i")))
    return d.where(~hit).select(*df.columns).unionByName(num.select(*df.columns))


def split_merged_institutions(df: DataFrame, doc: str = "doc_id", date: str = "award_date", inst: str = "institution") -> DataFrame:
    """Exactly two dated rows, the earlier with 'A B' and the later with 'A': the earlier becomes B."""
    dated = df.where(F.col(date).rlike(r"^\d{4}-\d{2}-\d{2}$"))
    per = dated.groupBy(doc).agg(F.count(F.lit(1)).alias("_n"), F.min_by(F.struct(date, inst), F.col(date)).alias("_a"), F.max_by(inst, F.col(date)).alias("_b"), F.count_distinct(date).alias("_nd"))
    parts = F.split(squeeze(F.col("_a")[inst]), " ")
    per = per.where((F.col("_n") == 2) & (F.col("_nd") == 2) & (F.size(parts) == 2) & (F.get(parts, F.lit(0)) == squeeze(F.col("_b"))))
    per = per.select(doc, F.col("_a")[date].alias("_d"), F.get(parts, F.lit(1)).alias("_new"))
    d = df.join(per, doc, "left")
    return d.withColumn(inst, F.when(F.col(date) == F.col("_d"), F.col("_new")).otherwise(F.col(inst))).select(*df.columns)


def with_not_applicable(df: DataFrame, docs: DataFrame, doc: str = "doc_id", date: str = "award_date", label: str = "해당없음") -> DataFrame:
    """Drop 'not applicable' rows of documents with a dated row and add one to documents without any row."""
    dated = df.where(F.col(date).rlike(r"^\d{4}-\d{2}-\d{2}$")).select(doc).distinct()
    kept = df.where(F.col(date) != label).unionByName(df.where(F.col(date) == label).join(dated, doc, "left_anti"))
    none = docs.select(doc).distinct().join(df.select(doc).distinct(), doc, "left_anti")
    filler = none.select(*[F.col(doc) if c == doc else F.lit(label).alias(c) if c == date else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns])
    return kept.unionByName(filler)
