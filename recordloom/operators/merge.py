"""Joins between competing sources: priority, fill-empty, one-to-one enrichment, comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.text import compact, fill_empty, is_blank, let, squeeze
from recordloom.operators.scan import Running, neighbour, running, with_page_chunks

PAGE = ("doc_id", "page_no")


def gate_template(rows: DataFrame, trust: DataFrame, floor: DataFrame, rank: str = "rank", template: int = 2, keys: Sequence[str] = ("doc_id", "page_no")) -> DataFrame:
    """``rows`` without those of the template source (``rank`` = ``template``) on pages where it does not count.

    It counts where ``trust`` (keys, ``trusted``) says so and where it has at least as
    many rows as ``floor`` (keys, ``n_tilde``) counts on the page; a page that neither
    table knows has no template rows.
    """
    n = rows.where(F.col(rank) == template).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    good = n.join(trust.select(*keys, "trusted"), list(keys)).join(floor.select(*keys, "n_tilde"), list(keys)).where("trusted and _n >= n_tilde").select(*keys, F.lit(True).alias("_ok"))
    return rows.join(good, list(keys), "left").where((F.col(rank) != template) | F.col("_ok")).select(*rows.columns)


def best_source(df: DataFrame, keys: Sequence[str] = PAGE, rank: str = "source_rank") -> DataFrame:
    """Rows of the best (lowest) source present per key."""
    best = df.groupBy(*keys).agg(F.min(rank).alias(rank))
    return df.join(best, [*keys, rank], "left_semi")


def fill_from_fallback(primary: DataFrame, fallback: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Object fields: keep the primary value, fill blanks from the fallback; documents of either side stay."""
    p = primary.select(*keys, *[F.col(f).alias(f"_p_{f}") for f in fields])
    q = fallback.select(*keys, *[F.col(f).alias(f"_q_{f}") for f in fields])
    return p.join(q, list(keys), "full").select(*keys, *[fill_empty(F.col(f"_p_{f}"), F.col(f"_q_{f}")).alias(f) for f in fields])


def union_on_key(primary: DataFrame, fallback: DataFrame, key: Sequence[str]) -> DataFrame:
    """List fields of two sources: all primary rows, then the fallback rows whose full key no primary row has.

    Keys are compared without blanks, nulls as blank; of fallback rows with one key one stays.
    """
    norm = {f"_u{i}": compact(F.coalesce(F.col(k).cast("string"), F.lit(""))) for i, k in enumerate(key)}
    have = primary.select(*[c.alias(n) for n, c in norm.items()]).distinct()
    more = fallback.withColumns(norm).join(have, list(norm), "left_anti").dropDuplicates(list(norm)).select(*fallback.columns)
    return primary.unionByName(more, allowMissingColumns=True)


def fallback_only(primary: DataFrame, fallback: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Fallback rows only for documents the primary source left empty."""
    have = primary.select(*keys).distinct()
    return primary.unionByName(fallback.join(have, list(keys), "left_anti"), allowMissingColumns=True)


def positional_join(left: DataFrame, right: DataFrame, right_fields: Sequence[str], left_order: str, right_order: str, keys: Sequence[str] = PAGE) -> DataFrame:
    """Pair rows by position on pages where both sides have the same count; other pages keep the right rows alone.

    The right side (date blocks) is never lost.  Windows run inside one page.
    """
    num = lambda d, o: d.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(o))).withColumn(
        "_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    l, r = num(left, left_order), num(right, right_order)
    fields = [c for c in left.columns if c not in keys]
    joined = r.join(l.select(*keys, "_rn", "_n", *[F.col(c).alias(f"_l_{c}") for c in fields]), [*keys, "_rn", "_n"], "left")
    return joined.select(*keys, F.col("_rn").cast("bigint").alias("pos"), *right_fields, *[F.col(f"_l_{c}").alias(c) for c in fields])


def _page_sides(records: DataFrame, tables: DataFrame, keys: Sequence[str], rec: str, row: str, left: dict[str, Column], right: dict[str, Column], fields: Sequence[str]) -> DataFrame:
    """Records and table rows of a key side by side, as arrays ``_a`` and ``_b`` in order: what is compared, and the row itself as ``r``.

    Both sides hold the rows of one key, so ``keys`` must name something small, such as a page.
    """
    pack = lambda order, cols, whole: F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), *[c.alias(n) for n, c in cols.items()], F.struct(*whole).alias("r"))))
    a = records.groupBy(*keys).agg(pack(rec, left, records.columns).alias("_a"))
    b = tables.groupBy(*keys).agg(pack(row, right, fields).alias("_b"))
    kind = b.schema["_b"].dataType.simpleString()
    return a.join(b, list(keys), "left").withColumn("_b", F.coalesce("_b", F.array().cast(kind)))


_PAIRS = "array<struct<i:int,j:int,tier:int>>"


def _match_in_order(pairs: Column, tier: int, score, wanted=None) -> Column:
    """Pairs with one more tier: each free record in order takes the free table row of the best score (null: no match), the first of equals."""
    a, b = F.col("_a"), F.col("_b")

    def step(w: Column, i: Column) -> Column:
        x = F.get(a, i)
        free = F.filter(F.transform(b, lambda y, j: F.struct((-score(x, y)).alias("s"), j.alias("j"))), lambda c: c["s"].isNotNull() & ~F.exists(w, lambda p: p["j"] == c["j"]))
        open_ = ~F.exists(w, lambda p: p["i"] == i) & (wanted(x) if wanted is not None else F.lit(True))
        won = lambda c: F.when(c.isNotNull(), F.concat(w, F.array(F.struct(i.alias("i"), c["j"].alias("j"), F.lit(tier).alias("tier"))))).otherwise(w)
        return F.when(open_, let(F.array_min(free), won)).otherwise(w)

    return F.aggregate(F.transform(a, lambda x, i: i), pairs, step)


def _paired_rows(d: DataFrame) -> DataFrame:
    """One row per record: ``r``, the table row ``t`` it took and ``tier``, both null without one."""
    d = d.select("_b", "_w", F.posexplode("_a").alias("_i", "_x"))
    hit = F.get(F.filter("_w", lambda p: p["i"] == F.col("_i")), F.lit(0))
    return d.select(F.col("_x.r").alias("r"), F.get("_b", hit["j"])["r"].alias("t"), hit["tier"].alias("tier"))


def enrich_one_to_one(
    records: DataFrame, tables: DataFrame, fields: Sequence[str], keys: Sequence[str] = PAGE, rec: str = "rec_idx", row: str = "row_idx",
) -> DataFrame:
    """Match records to table rows on a page, each row used once, and fill blank fields.

    Tiers: equal name; equal (issuer, specialty, position, work type); equal issuer
    with one name inside the other.  In each tier the records go in order and take
    the first free row that fits.  Tiers are matched page-wide one after the other,
    so a record whose only partner is claimed by a better tier of a later record
    stays as it is.  Adds ``tier`` (null when unmatched).
    """
    ctx = F.concat_ws("|", *[compact(F.col(c)) for c in ("issuer", "specialty", "position", "work_type")])
    cols = {"n": compact(F.col("project_name")), "c": F.when(compact(F.col("issuer")) != "", ctx).otherwise(""), "s": compact(F.col("issuer"))}
    d = _page_sides(records, tables, keys, rec, row, cols, cols, fields)
    same = lambda f: lambda x, y: F.when((x[f] != "") & (x[f] == y[f]), 1)
    inside = lambda x, y: F.when(
        (x["s"] != "") & (x["s"] == y["s"]) & (F.length(x["n"]) >= 3) & (y["n"] != "")
        & (F.endswith(y["n"], x["n"]) | ((F.length(x["n"]) >= 4) & F.contains(y["n"], x["n"])) | ((F.length(y["n"]) >= 4) & F.contains(x["n"], y["n"]))), 1)
    pairs = F.array().cast(_PAIRS)
    for tier, score in enumerate((same("n"), same("c"), inside), 1):
        pairs = _match_in_order(pairs, tier, score)
    d = _paired_rows(d.withColumn("_w", pairs))
    return d.select(*[fill_empty(F.col(f"r.{c}"), F.col(f"t.{c}")).alias(c) if c in fields else F.col(f"r.{c}") for c in records.columns], "tier")


def fill_by_tiers(records: DataFrame, tables: DataFrame, tiers: Sequence[Sequence[str]], fields: Sequence[str], keys: Sequence[str], rec: str, longest: str = "overview") -> DataFrame:
    """Fill records from the best table row of the first tier with a hit; the longest ``longest`` text wins inside a tier.

    A tier is a list of columns that must be equal.  Table rows are reduced to one
    row per tier key first, so no join multiplies rows.  A name the table extends is replaced.
    """
    d = records
    text = compact(F.col(longest))
    for i, cols in enumerate(tiers):
        pick = tables.where(~is_blank(F.col(cols[0]))).withColumn("_len", F.length(text))
        best = pick.groupBy(*keys, *cols).agg(F.max_by(F.struct(*fields), F.struct("_len", longest)).alias(f"_b{i}"))
        d = d.join(best, [*keys, *cols], "left")
    chosen = F.coalesce(*[F.col(f"_b{i}") for i in range(len(tiers))])
    d = d.withColumn("_c", chosen).withColumn("tier", F.coalesce(*[F.when(F.col(f"_b{i}").isNotNull(), i + 1) for i in range(len(tiers))]))
    return d.select(*[
        F.when(F.contains(F.col("_c")[c], F.col(c)) & ~is_blank(F.col("_c")[c]) if c == "project_name" else F.lit(False), F.col("_c")[c])
        .otherwise(fill_empty(F.col(c), F.col("_c")[c])).alias(c) if c in fields else F.col(c)
        for c in records.columns], "tier")


def template_fill(rows: DataFrame, tables: DataFrame, fields: Sequence[str], keys: Sequence[str] = PAGE, rec: str = "rec_idx", row: str = "row_idx") -> DataFrame:
    """Fill template rows from the table row of the same name, else of a name that is a suffix of the other.

    Same-name table rows are first reduced to the one with the longest overview.
    """
    name = compact(F.col("project_name"))
    t = tables.withColumn("_k", name).where("_k <> ''").groupBy(*keys, "_k").agg(
        F.max_by(F.struct(*fields), F.struct(F.length("overview"), -F.col(row))).alias("_f"), F.min(row).alias("_row"))
    r = rows.withColumn("_n", name)
    same = r.join(t.select(*keys, F.col("_k").alias("_n"), F.col("_f").alias("_same")), [*keys, "_n"], "left")
    want = same.where("_same is null and _n <> ''").select(*keys, rec, "_n")
    cand = want.join(t, list(keys)).where(F.endswith(F.col("_n"), F.col("_k")) | F.endswith(F.col("_k"), F.col("_n")))
    near = cand.groupBy(*keys, rec).agg(F.min_by("_f", "_row").alias("_near"))
    d = same.join(near, [*keys, rec], "left").withColumn("_c", F.coalesce("_same", "_near"))
    return d.select(*[fill_empty(F.col(c), F.col("_c")[c]).alias(c) if c in fields else F.col(c) for c in rows.columns])


def last_resort_names(
    records: DataFrame, tables: DataFrame, keys: Sequence[str] = PAGE, rec: str = "rec_idx", row: str = "row_idx", placeholder: str = "(사업명 미상)", fields: Sequence[str] = (),
) -> DataFrame:
    """Names for nameless records from named table rows, each used once.

    In order, a record with an issuer takes the free row of that issuer with most
    equal specialty and position (2 each; a conflict counts least), and blank
    ``fields`` are filled from it.  Then the records still nameless take the free
    rows in order, whatever their issuer, for the name alone; what is left gets the placeholder.
    """
    n = lambda c: compact(F.col(c))
    cols = {"s": n("issuer"), "p": n("specialty"), "q": n("position")}
    named = tables.where(~is_blank(F.col("project_name")))
    d = _page_sides(records, named, keys, rec, row, {"u": is_blank(F.col("project_name")), **cols}, cols, list(dict.fromkeys(["project_name", *fields])))
    part = lambda x, y, f: F.when((x[f] == "") | (y[f] == ""), 0).when(x[f] == y[f], 2).otherwise(None)
    score = lambda x, y: F.when((x["s"] != "") & (x["s"] == y["s"]), F.coalesce(1 + part(x, y, "p") + part(x, y, "q"), F.lit(0)))
    pairs = _match_in_order(F.array().cast(_PAIRS), 1, score, lambda x: x["u"])
    pairs = _match_in_order(pairs, 2, lambda x, y: F.lit(1), lambda x: x["u"])
    d = _paired_rows(d.withColumn("_w", pairs))
    name = F.when(is_blank(F.col("r.project_name")), F.coalesce("t.project_name", F.lit(placeholder))).otherwise(F.col("r.project_name"))
    fill = lambda c: F.when(F.col("tier") == 1, fill_empty(F.col(f"r.{c}"), F.col(f"t.{c}"))).otherwise(F.col(f"r.{c}"))
    return d.select(*[name.alias(c) if c == "project_name" else fill(c).alias(c) if c in fields else F.col(f"r.{c}") for c in records.columns])


def attach_continuations(records: DataFrame, continuations: DataFrame, rec: str = "rec_idx", overview: str = "overview", name: str = "project_name", min_len: int = 8) -> DataFrame:
    """Append the continuation text at the top of a page to the last record before it.

    ``continuations`` is (doc_id, page_no, cont).  The target is the greatest record
    on earlier pages, carried page by page; texts of several pages are appended in
    order.  The record after the target loses the same text (``min_len``+ letters)
    from the start of its name.
    """
    # a page's text comes before its records in one order, so the greatest record before it is one of an earlier page and nothing is joined
    last = records.groupBy("doc_id", "page_no").agg(F.max(rec).alias("_last")).select("doc_id", "page_no", F.lit(1).alias("_kind"), "_last", F.lit(None).cast("string").alias("cont"))
    texts = continuations.where(~is_blank(F.col("cont"))).select("doc_id", "page_no", F.lit(0).alias("_kind"), F.lit(None).cast(last.schema["_last"].dataType).alias("_last"), "cont")
    run = running(with_page_chunks(last.unionByName(texts)), ["doc_id"], ["page_chunk"], ["page_no", "_kind"], [Running("_target", "max", "_last")], inclusive=False)
    hit = run.where("_kind = 0 and _target is not null")
    per = hit.groupBy("doc_id", "_target").agg(F.sort_array(F.collect_list(F.struct("page_no", "cont"))).alias("_c"))
    d = records.join(per.withColumnRenamed("_target", rec).withColumnRenamed("_c", "_mine"), ["doc_id", rec], "left")
    d = neighbour(d, ["doc_id"], rec, {"_before": "_mine"}, step=-1)
    more = F.array_join(F.transform("_mine", lambda x: x["cont"]), "\n")
    cut = F.aggregate(
        F.transform("_before", lambda x: squeeze(x["cont"])), squeeze(F.col(name)),
        lambda acc, x: F.when((F.length(x) >= min_len) & F.startswith(acc, x), F.trim(F.substr(acc, F.length(x) + 1))).otherwise(acc))
    changed = F.col("_before").isNotNull() & (cut != squeeze(F.col(name)))
    return d.select(*[
        F.when(F.col("_mine").isNull(), F.col(c)).when(is_blank(F.col(c)), more).otherwise(F.concat(F.trim(F.col(c)), F.lit("\n"), more)).alias(c) if c == overview
        else F.when(changed, cut).otherwise(F.col(c)).alias(c) if c == name else F.col(c)
        for c in records.columns
    ], F.transform("_mine", lambda x: x["page_no"]).alias("cont_pages"))


def compare_by_key(left: DataFrame, right: DataFrame, key: Sequence[str], fields: Sequence[str], order: str, scope: Sequence[str] = ("doc_id",), chunks: Sequence[str] = ()) -> DataFrame:
    """Field differences of two result sets whose rows pair by key and ordinal; unpaired rows are reported once.

    Rows are (scope, key, ord, status, field, left_value, right_value).  The ordinal
    is a running count; ``chunks`` (columns that do not decrease with ``order``)
    split it for keys that repeat without bound.
    """
    count = [Running("ord", "sum", "_one")]

    def side(d: DataFrame, p: str) -> DataFrame:
        n = running(d.withColumn("_one", F.lit(1)), [*scope, *key], list(chunks), [order], count)
        return n.select(*scope, *key, "ord", F.lit(True).alias(f"_{p}"), *[F.col(f).alias(f"{p}_{f}") for f in fields])

    j = side(left, "l").join(side(right, "r"), [*scope, *key, "ord"], "full")
    status = F.when(F.col("_r").isNull(), "only_left").when(F.col("_l").isNull(), "only_right").otherwise("both")
    diffs = F.filter(F.array(*[
        F.when(~F.col(f"l_{f}").eqNullSafe(F.col(f"r_{f}")), F.struct(F.lit(f).alias("field"), F.col(f"l_{f}").alias("left_value"), F.col(f"r_{f}").alias("right_value")))
        for f in fields]), lambda x: x.isNotNull())
    none = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("left_value"), F.lit(None).cast("string").alias("right_value")))
    j = j.withColumn("_status", status).withColumn("_d", F.when(F.col("_status") == "both", diffs).otherwise(none))
    return j.select(*scope, *key, F.col("ord").cast("bigint").alias("ord"), F.col("_status").alias("status"), F.explode("_d").alias("d")).select(*scope, *key, "ord", "status", "d.*")


def diff_counts(left: DataFrame, right: DataFrame, fields: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per field: rows compared, real differences and white-space-only differences of equally indexed rows."""
    j = left.select(*keys, *[F.col(f).alias(f"l_{f}") for f in fields]).join(right.select(*keys, *[F.col(f).alias(f"r_{f}") for f in fields]), list(keys))
    entries = F.array(*[F.struct(
        F.lit(f).alias("field"), (~F.col(f"l_{f}").eqNullSafe(F.col(f"r_{f}"))).alias("diff"),
        (compact(F.col(f"l_{f}")) == compact(F.col(f"r_{f}"))).alias("same_text")) for f in fields])
    return j.select(F.explode(entries).alias("e")).groupBy("e.field").agg(
        F.count(F.lit(1)).alias("rows_compared"), F.count_if(F.col("e.diff") & ~F.col("e.same_text")).alias("real_diffs"),
        F.count_if(F.col("e.diff") & F.col("e.same_text")).alias("space_diffs"))


def section_equality(left: DataFrame, right: DataFrame, scope: Sequence[str], key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Per scope (a document's section): rows of either side, rows only one side has, rows that differ, whether all is equal, and the first odd row as example.

    Rows pair by ``key``, which is unique in a scope; ``example`` is the smallest key
    of a row that is missing or different, as text.
    """
    ids = [*scope, *key]
    pack = lambda d, n: d.select(*ids, F.struct(*fields).alias(n))
    j = pack(left, "_l").join(pack(right, "_r"), ids, "full")
    a, b = F.col("_l").isNotNull(), F.col("_r").isNotNull()
    diff = a & b & ~F.col("_l").eqNullSafe(F.col("_r"))
    odd = ~(a & b) | diff
    g = j.groupBy(*scope).agg(
        F.count_if(a).alias("rows_left"), F.count_if(b).alias("rows_right"), F.count_if(a & ~b).alias("only_left"), F.count_if(b & ~a).alias("only_right"), F.count_if(diff).alias("different"),
        F.min(F.when(odd, F.struct(*key))).alias("_e"))
    return g.select(*scope, "rows_left", "rows_right", "only_left", "only_right", "different", F.col("_e").isNull().alias("equal"),
                    F.concat_ws("|", *[F.col("_e")[k].cast("string") for k in key]).alias("example"))


def crosscheck(values: DataFrame, pages: DataFrame, value: str, date: str | None = None, radius: int = 280, keys: Sequence[str] = PAGE) -> DataFrame:
    """Does the value occur, blanks ignored, in the page text, and within ``radius`` letters of its date."""
    d = values.join(pages.select(*keys, F.col("text").alias("_text")), list(keys), "left")
    v, text = compact(F.col(value)), F.coalesce(F.col("_text"), F.lit(""))
    out = d.withColumn("in_text", (v != "") & F.contains(compact(text), v))
    if date:
        at = F.instr(text, F.col(date))
        near = F.substr(text, F.greatest(at - radius, F.lit(1)), F.lit(2 * radius))
        out = out.withColumn("near_date", (v != "") & (F.col(date) != "") & (at > 0) & F.contains(compact(near), v))
    return out.drop("_text")
