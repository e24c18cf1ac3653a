"""Project names put together again: torn syllables re-joined, methods and overviews at their front moved out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordloom.functions.text import compact, let, squeeze, tokens

# Words of project names that come torn.
NAME_WORDS = [
    "실시설계", "기본설계", "기본계획", "정밀안전진단", "안전진단", "타당성조사", "영향평가", "평가용역", "설계용역", "조사용역", "감리용역", "건설공사",
    "포장공사", "정비사업", "개설공사", "확장공사", "복구공사", "공사", "용역", "사업", "설계", "계획", "조사", "진단", "정비", "복구", "작성", "대장",
]
# One-syllable words that stand alone.
PARTICLES = ["은", "는", "이", "가", "을", "를", "과", "와", "및", "또", "등"]
# How bridge overviews begin, and words of which one is in a project name.
OVERVIEW_STARTS = ["NATM", "Steel Box Girder", "STEEL BOX GIRDER", "PSC Beam", "강박스거더", "L="]
PROJECT_WORDS = ["공사", "용역", "사업", "정비", "설계"]
#: What gluing earns: a word of the list is whole again, two lone syllables meet, a lone syllable goes to the word before it; and what it
#: costs a piece to be glued on both sides, and a lone syllable to be taken from both.
WHOLE_WORD, LONE_PAIR, LONE_LEFT, BOTH_SIDES, TORN_TWICE = 4, 3, 2, 2, 5


def gain(left: Column, right: Column, words: Sequence[str]) -> Column:
    """What gluing two neighbouring pieces earns, null where they do not belong together.

    A word of the list counts if it lies across the gap with one syllable on a side.
    """
    torn = F.lit(False)
    for w in sorted(set(words)):
        torn = torn | (F.endswith(left, F.lit(w[0])) & F.startswith(right, F.lit(w[1:]))) | (F.endswith(left, F.lit(w[:-1])) & F.startswith(right, F.lit(w[-1])) if len(w) > 2 else F.lit(False))
    lone = lambda c: c.rlike("^[가-힣]$") & ~c.isin(*PARTICLES)
    free = ~left.isin(*PARTICLES) & ~right.isin(*PARTICLES)
    return F.when(free & torn, WHOLE_WORD).when(lone(left) & lone(right), LONE_PAIR).when(free & lone(right) & left.rlike("[가-힣A-Za-z0-9)]$"), LONE_LEFT)


def rejoin_name(name: Column, words: Sequence[str] = tuple(NAME_WORDS)) -> Column:
    """The name with pieces of torn words glued: of all ways to glue neighbours, the one that earns most, and the one with fewer gaps closed at a tie.

    A fold over the pieces that keeps the best way with the last gap open and the
    best with it closed, so it takes one step per piece.  No letter is lost: but for
    blanks the text stays as it is.
    """
    state = lambda score, out, leftish: F.struct(score.alias("score"), out.alias("out"), leftish.alias("leftish"))
    never = F.lit(-(10**6))

    def add(acc: Column, x: Column) -> Column:
        single = F.length(acc["prev"]) == 1

        def grow(g: Column) -> Column:
            leftish = ~single & (F.length(x) == 1)
            cost = F.when(acc["closed"]["leftish"] & single, TORN_TWICE).when(single, 0).otherwise(BOTH_SIDES)
            onto = lambda s: F.concat(F.slice(s["out"], F.lit(1), F.size(s["out"]) - 1), F.array(F.concat(F.try_element_at(s["out"], F.lit(-1)), x)))
            apart = let(F.when(acc["closed"]["score"] > acc["open"]["score"], acc["closed"]).otherwise(acc["open"]), lambda b: state(b["score"], F.concat(b["out"], F.array(x)), F.lit(False)))
            from_open, from_closed = acc["open"]["score"] + g, acc["closed"]["score"] + g - cost
            glued = F.when(g.isNull(), state(never, F.array(x), F.lit(False))).when(from_closed > from_open, state(from_closed, onto(acc["closed"]), leftish)).otherwise(
                state(from_open, onto(acc["open"]), leftish))
            return F.struct(apart.alias("open"), glued.alias("closed"), x.alias("prev"))

        return let(gain(acc["prev"], x, words), grow)

    def best(acc: Column) -> Column:
        return F.array_join(F.when(acc["closed"]["score"] > acc["open"]["score"], acc["closed"]["out"]).otherwise(acc["open"]["out"]), " ")

    def fold(t: Column) -> Column:
        start = F.struct(state(F.lit(0), F.array(F.get(t, F.lit(0))), F.lit(False)).alias("open"), state(never, F.array(F.get(t, F.lit(0))), F.lit(False)).alias("closed"), F.get(t, F.lit(0)).alias("prev"))
        return F.when(F.size(t) <= 1, F.coalesce(F.get(t, F.lit(0)), F.lit(""))).otherwise(F.aggregate(F.slice(t, F.lit(2), F.greatest(F.size(t) - 1, F.lit(0))), start, add, best))

    return let(tokens(name), fold)


def move_prefixes(name: Column, method: Column, overview: Column, prev_method: Column, prev_overview: Column) -> Column:
    """struct(name, method, overview): what stands before the name goes where it belongs.

    A method in Latin letters with a slash right before Hangul joins the method,
    unless method or overview hold it; a bridge overview up to its 교 goes before the
    overview if a project's name follows; what the record before has as method or
    overview is dropped.
    """
    pattern = r"^([A-Za-z][A-Za-z0-9 .,/+\-]{3,})([가-힣].*)$"

    def methods(x: Column) -> Column:
        front, rest = F.trim(F.regexp_extract(x["name"], pattern, 1)), F.regexp_extract(x["name"], pattern, 2)
        known = F.contains(x["method"], front) | F.contains(x["overview"], front)
        return F.when(F.contains(front, F.lit("/")), F.struct(rest.alias("name"), F.when(known, x["method"]).otherwise(F.trim(F.concat_ws(" ", x["method"], front))).alias("method"), x["overview"].alias("overview"))).otherwise(x)

    def overviews(x: Column) -> Column:
        begins, project = F.lit(False), F.lit(False)
        front, rest = F.regexp_extract(x["name"], "^([^교]+교)", 1), F.trim(F.regexp_extract(x["name"], "^[^교]+교(.*)$", 1))
        for w in OVERVIEW_STARTS:
            begins = begins | F.startswith(x["name"], F.lit(w))
        for w in PROJECT_WORDS:
            project = project | F.contains(rest, F.lit(w))
        merged = F.when(x["overview"] == "", front).when(F.contains(x["overview"], front), x["overview"]).otherwise(F.concat(front, F.lit("\n"), x["overview"]))
        return F.when(begins & project & (front != ""), F.struct(rest.alias("name"), x["method"].alias("method"), merged.alias("overview"))).otherwise(x)

    def earlier(c: Column):
        def cut(x: Column) -> Column:
            given = squeeze(c)
            hit = (given != "") & F.startswith(compact(x["name"]), compact(given)) & (F.length(compact(x["name"])) > F.length(compact(given)) + 3)
            rest = F.when(F.startswith(x["name"], given), F.trim(F.substr(x["name"], F.length(given) + 1))).otherwise(F.substr(compact(x["name"]), F.length(compact(given)) + 1))
            return F.struct(F.when(hit, rest).otherwise(x["name"]).alias("name"), x["method"].alias("method"), x["overview"].alias("overview"))

        return cut

    out = F.struct(squeeze(name).alias("name"), squeeze(method).alias("method"), F.trim(F.coalesce(overview, F.lit(""))).alias("overview"))
    for step in (methods, overviews, earlier(prev_method), earlier(prev_overview)):
        out = let(out, step)
    return out
