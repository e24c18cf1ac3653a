"""Line grammar of career pages: project lines, job/duty lines and ``~`` lines.

Everything is a column expression.  Word lists are literals (an ``IN`` set or a
short array); catalogs that do not fit that go through ``operators.lookups``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.text import (
    ARROW, compact, contains_any, head_tokens, join_tokens, last_token, let, squeeze, tail_tokens, tokens,
)
from recordloom.operators.cleanup import DUTY_WORDS, JOB_FIELDS, POSITION_WORDS
from recordloom.operators.lines import DATE_LINE, DAYS_LINE, MASKED_DATE, is_boilerplate

# Job fields with their specialties, in catalog order.
SPECIALTIES_BY_JOB: dict[str, list[str]] = {
    "기계": ["공조냉동 및 설비", "건설기계", "용접", "승강기", "일반기계"],
    "전기·전자": ["철도신호", "건축전기설비", "산업계측제어"],
    "토목": ["토질·지질", "토목구조", "항만 및 해안", "도로 및 공항", "철도·삭도", "수자원개발", "상하수도", "농어업토목",
           "토목시공", "토목품질관리", "측량 및 지형공간정보", "지적"],
    "건축": ["건축구조", "건축기계설비", "건축시공", "실내건축", "건축품질관리", "건축계획·설계"],
    "광업": ["화약류관리", "광산보안"],
    "도시·교통": ["도시계획", "교통"],
    "조경": ["조경계획", "조경시공관리"],
    "안전관리": ["건설안전", "소방", "가스", "비파괴검사"],
    "환경": ["대기관리", "수질관리", "소음진동", "폐기물처리", "자연환경", "토양환경", "해양"],
    "건설지원": ["건설금융·재무", "건설기획", "건설마케팅", "건설정보처리"],
}
# Work types short enough to stand alone in a ``~`` line.
SHORT_WORK_TYPES = [
    "상수도", "하수도", "상하수도", "국도", "지방도", "시도", "농로", "시군도", "국토", "해안", "항만", "하천", "댐", "철도", "터널",
    "교량", "도로", "국가지방도", "공원", "녹지", "광장", "체육", "유원지", "관광지", "관광단지", "단지조성", "주택", "산업단지", "택지",
]
# Words in the tail of an issuer cell that mark a work type.
WORK_TYPE_TAIL_WORDS = [
    "도로", "국도", "고속", "교량", "터널", "공항", "하수도", "매립", "준설", "호안", "부지조성", "유도로", "활주로", "토공", "항만",
    "철도", "댐", "포장", "관로", "구조물", "상수도", "하천",
]


@dataclass(frozen=True)
class Words:
    """Word lists the grammar depends on; callers override them key by key."""

    duties: Sequence[str] = field(default_factory=lambda: list(DUTY_WORDS))
    jobs: Sequence[str] = field(default_factory=lambda: list(JOB_FIELDS))
    positions: Sequence[str] = field(default_factory=lambda: list(POSITION_WORDS))
    specialties_by_job: dict = field(default_factory=lambda: dict(SPECIALTIES_BY_JOB))
    short_work_types: Sequence[str] = field(default_factory=lambda: list(SHORT_WORK_TYPES))
    work_types: Sequence[str] = field(default_factory=lambda: list(SHORT_WORK_TYPES))
    regions: Sequence[str] = ()
    institutions: Sequence[str] = ()

    @property
    def specialties(self) -> list[str]:
        out: list[str] = []
        for xs in self.specialties_by_job.values():
            out += [x for x in xs if x not in out]
        return out


DEFAULT = Words()


def _in(c: Column, xs: Sequence[str]) -> Column:
    return c.isin(*xs) if xs else F.expr("false")


# ------------------------------------------------------------------ work types
def norm_work_type(c: Column) -> Column:
    """Blanks and middle dots removed."""
    return F.translate(compact(c), "·ㆍ.．", "")


def _norm_text(x: str) -> str:
    return "".join(ch for ch in "".join(x.split()) if ch not in "·ㆍ.．")


def is_work_type(c: Column, names: Sequence[str]) -> Column:
    """Is ``c`` a work type: one name, several joined by ``, · ㆍ /`` or 및, or ``main(parts)`` with a known main."""
    known = sorted({_norm_text(n) for n in names} - {""})

    def test(s: Column) -> Column:
        main = F.regexp_extract(s, r"^\s*([^()]+)\s*\(\s*([^()]+)\s*\)\s*$", 1)
        listed = let(
            F.filter(F.transform(F.split(F.regexp_replace(s, r"\s*및\s*", ","), r"[,·ㆍ/]+"), norm_work_type), lambda p: p != ""),
            lambda parts: (F.size(parts) >= 2) & F.forall(parts, lambda p: _in(p, known)),
        )
        # Only texts with a separator or a bracket need more than the set test.
        return F.when(s == "", False).when(_in(norm_work_type(s), known), True).otherwise(
            (s.rlike("[,·ㆍ/및]") & listed) | (F.contains(s, F.lit("(")) & _in(norm_work_type(main), known)))

    return let(F.trim(F.coalesce(c, F.lit(""))), test)


def work_type_suffix_size(toks: Column, names: Sequence[str]) -> Column:
    """Tokens in the longest work-type suffix, 0 if there is none."""
    sizes = F.filter(F.sequence(F.lit(1), F.greatest(F.size(toks), F.lit(1))), lambda k: is_work_type(join_tokens(tail_tokens(toks, k)), names))
    return F.coalesce(F.array_max(sizes), F.lit(0))


def split_issuer_work_type(issuer: Column, names: Sequence[str]) -> Column:
    """struct(issuer, work_type): a work-type suffix of the issuer text cut off."""
    def cut(t: Column) -> Column:
        return let(work_type_suffix_size(t, names), lambda k: F.struct(
            join_tokens(head_tokens(t, F.size(t) - k)).alias("issuer"), join_tokens(tail_tokens(t, k)).alias("work_type")))

    return let(tokens(issuer), cut)


def split_issuer_cell(issuer: Column, work_type: Column, names: Sequence[str]) -> Column:
    """Last word of an issuer cell moved to an empty work type when it looks like a (list of) work type(s)."""
    wt = squeeze(work_type)

    def cut(t: Column) -> Column:
        right = F.coalesce(last_token(t), F.lit(""))
        looks = F.contains(right, F.lit(",")) | F.contains(right, F.lit("·")) | contains_any(right, WORK_TYPE_TAIL_WORDS) | is_work_type(right, names)
        return F.when((wt == "") & (F.size(t) >= 2) & looks, F.struct(
            join_tokens(head_tokens(t, F.size(t) - 1)).alias("issuer"), right.alias("work_type"))).otherwise(
            F.struct(join_tokens(t).alias("issuer"), wt.alias("work_type")))

    return let(tokens(issuer), cut)


def drop_overlap(issuer: Column, work_type: Column) -> Column:
    """Issuer without a tail that repeats the work type."""
    iss, wt = squeeze(issuer), squeeze(work_type)
    rest = F.rtrim(F.substr(iss, F.lit(1), F.greatest(F.length(iss) - F.length(wt), F.lit(0))))
    return (
        F.when((wt == "") | (iss == ""), iss).when(iss == wt, "")
        .when(F.endswith(iss, wt) & (rest != ""), rest).otherwise(iss)
    )


# ------------------------------------------------------------------ name lines
def is_position(c: Column, w: Words = DEFAULT) -> Column:
    return _in(squeeze(c), w.positions)


def _is_duty(c: Column, w: Words) -> Column:
    return _in(c, w.duties) | (c.startswith("(") & c.rlike(r"^\([^)]+\)$"))


def _is_measure(s: Column) -> Column:
    return s.rlike(DATE_LINE) | s.rlike(DAYS_LINE) | s.rlike(MASKED_DATE)


def job_duty_tokens(t: Column, w: Words = DEFAULT) -> Column:
    """``job_duty_line`` of a line's tokens."""
    a, b = F.get(t, F.lit(0)), F.get(t, F.lit(1))
    ok = (F.size(t) == 2) & ~F.startswith(a, F.lit("~"))
    return F.when(ok & _in(a, w.jobs) & _is_duty(b, w), F.struct(a.alias("job"), b.alias("duty"))).when(
        ok & _in(b, w.jobs) & _is_duty(a, w), F.struct(b.alias("job"), a.alias("duty")))


def job_duty_line(line: Column, w: Words = DEFAULT) -> Column:
    """struct(job, duty) of a two-token job/duty line in either order, else null."""
    return let(tokens(line), lambda t: job_duty_tokens(t, w))


def issuer_tokens(t: Column, w: Words = DEFAULT) -> Column:
    """``issuer_line`` of a line's tokens."""
    n = F.size(t)
    ok = (n >= 4) & ~F.startswith(F.get(t, F.lit(0)), F.lit("~")) & _in(last_token(t), w.positions)
    return F.when(ok, F.struct(
        join_tokens(head_tokens(t, n - 3)).alias("issuer"), F.get(t, n - 3).alias("work_type"),
        F.get(t, n - 2).alias("specialty"), F.get(t, n - 1).alias("position")))


def issuer_line(line: Column, w: Words = DEFAULT) -> Column:
    """struct(issuer, work_type, specialty, position) of a bare line of 4+ tokens ending in a position, else null."""
    return let(tokens(line), lambda t: issuer_tokens(t, w))


def project_tokens(t: Column, w: Words = DEFAULT) -> Column:
    """``project_line`` of a line's tokens."""
    duty_of = lambda c: F.when(c == "설계담당", "설계").otherwise(c)
    n = F.size(t)
    duty = lambda back: F.when(F.get(t, n - back) == "설계담당", "설계" in w.duties).otherwise(_is_duty(F.get(t, n - back), w))

    def build(p: Column) -> Column:
        job = F.get(t, p - 1)
        return F.when((p >= 2) & F.coalesce(_in(job, w.jobs), F.lit(False)), F.struct(
            join_tokens(head_tokens(t, p - 1)).alias("name"), job.alias("job"), duty_of(F.get(t, p)).alias("duty")))

    # the few lines with a duty are built by an interpreted expression, all others need three look-ups
    place = F.when(duty(1), n - 1).when(duty(2), n - 2).otherwise(n - 3)
    return F.when((n >= 3) & ~F.startswith(F.get(t, F.lit(0)), F.lit("~")) & (duty(1) | duty(2) | duty(3)), let(place, build))


def project_line(line: Column, w: Words = DEFAULT) -> Column:
    """struct(name, job, duty) of a 'name job duty' line, else null.

    The duty is the last duty word among the final three tokens; the token before
    it must be a job field and a name must remain.
    """
    return let(tokens(line), lambda t: project_tokens(t, w))


def with_tokens(df: DataFrame, when: Column, line: str = "line") -> DataFrame:
    """``df`` with ``_text``, the squeezed line, ``_tight``, the same without blanks, and ``_tokens``, where ``when`` holds (else null).

    Rules over these columns are compiled; ``let`` inside an expression is interpreted.
    """
    d = df.withColumn("_text", F.when(when, squeeze(F.col(line))))
    return d.withColumns({"_tight": compact(F.col("_text")), "_tokens": F.array_remove(F.split("_text", " "), "")})


def is_technical_line(line: Column) -> Column:
    """Overview-like technical text."""
    return let(squeeze(line), lambda s: let(compact(s), lambda c: is_technical(s, c)))


def is_technical(s: Column, c: Column) -> Column:
    """``is_technical_line`` of a squeezed line ``s`` that is ``c`` without blanks."""
    ends = c.endswith("공사") | c.endswith("용역") | c.endswith("사업")
    return (
        s.startswith("- ") | contains_any(s, ["○", "내용:", "내용 :"]) | s.rlike(r"^\d+\)\s*") | (F.contains(s, F.lit("공법")) & s.rlike(r"공법\s*\([^)]*개착"))
        | (F.contains(c, F.lit("공법")) & ~ends)
        | c.rlike(r"^[A-Z]{2,8}$") | (c.endswith("공법") & c.rlike(r"^[A-Za-z0-9.,/+\-]{2,20}공법$"))
        | (F.contains(s, F.lit("검토 설계")) & ~F.contains(s, F.lit("용역")))
        | (s.startswith("장") & s.rlike(r"^장\s*:\s*\d")) | (s.startswith("점") & s.rlike(r"^점\s+") & F.contains(s, F.lit("접속")))
    )


def is_name_line(line: Column, w: Words = DEFAULT, other: bool = False) -> Column:
    """Could the line be (part of) a project name.  ``other``: the caller has ruled out job/duty and issuer lines."""
    def test(s: Column) -> Column:
        name = let(compact(s), lambda c: is_name_text(s, c, w))
        return name if other else name & job_duty_line(s, w).isNull() & issuer_line(s, w).isNull()

    return let(squeeze(line), test)


def is_name_text(s: Column, c: Column, w: Words = DEFAULT) -> Column:
    """``is_name_line`` of a squeezed line ``s`` that is ``c`` without blanks and no job/duty or issuer line.

    Cheap shape tests come first; boilerplate only for what is left, interpreted, so that the tests before it stay short enough to be compiled.
    """
    return (
        (F.length(s) > 1) & (s != ARROW) & ~s.startswith("~") & ~_is_measure(s)
        & (s.rlike("[가-힣][^가-힣]*[가-힣]") | s.rlike("[A-Za-z0-9][^A-Za-z0-9]*[A-Za-z0-9][^A-Za-z0-9]*[A-Za-z0-9]"))
        & ~_in(s, w.positions)
        & ~s.rlike("[㎥㎞㎡㎝㎜㏃]|Q=|q=|m³|m²")
        & ~(F.contains(s, F.lit("~")) & s.rlike(r"(?U)\bD\d+~[D]?\d+\w*\b")) & ~(F.contains(s, F.lit("=")) & s.rlike(r"(?iU)\bL=\d+\.?\d*\s*(m|km|mm|cm)\b"))
        & ~((F.length(s) <= 15) & F.contains(s, F.lit(".")) & s.rlike(r"\.\s*[가-힣A-Z]")) & ~s.startswith("계(") & ~(s.startswith("등") & s.rlike(r"^등[,\s]"))
        & ~is_technical(s, c) & ~let(s, is_boilerplate)
    )


# ------------------------------------------------------------------ tilde lines
def looks_like_specialty(c: Column, w: Words = DEFAULT) -> Column:
    t = F.trim(F.coalesce(c, F.lit("")))
    return (t != "") & (t.endswith("구조") | F.contains(t, F.lit("·")) | _in(F.replace(t, F.lit("ㆍ"), F.lit("·")), w.specialties))


def is_job_noise(mid: Column, specialty: Column, w: Words = DEFAULT) -> Column:
    """A job-field word that slipped in front of one of its own specialties."""
    m = F.trim(F.coalesce(mid, F.lit("")))
    sp = F.replace(F.trim(F.coalesce(specialty, F.lit(""))), F.lit("ㆍ"), F.lit("·"))
    pairs = [f"{j}|{s}" for j, xs in w.specialties_by_job.items() for s in xs]
    return (
        (m != "") & (sp != "") & ~_in(m, w.short_work_types)
        & (_in(F.concat(m, F.lit("|"), sp), pairs) | (_in(m, w.jobs) & (F.length(m) >= 2) & F.startswith(sp, m)))
    )


def strip_job_noise(issuer: Column, work_type: Column, specialty: Column, w: Words = DEFAULT) -> Column:
    """struct(issuer, work_type) with job words before the specialty removed."""
    return F.struct(_issuer_without_noise(issuer, specialty, w).alias("issuer"), _work_type_without_noise(work_type, specialty, w).alias("work_type"))


def _issuer_without_noise(issuer: Column, specialty: Column, w: Words) -> Column:
    sp = F.trim(F.coalesce(specialty, F.lit("")))
    iss = F.trim(F.coalesce(issuer, F.lit("")))
    toks = F.filter(F.split(iss, " "), lambda x: x != "")

    def strip_tail(t: Column) -> Column:
        keep = F.coalesce(F.array_max(F.transform(t, lambda x, i: F.when(is_job_noise(x, sp, w), 0).otherwise(i + 1))), F.lit(0))
        return join_tokens(head_tokens(t, keep))

    # only an issuer that ends with a job word is cut into tokens
    return F.when(sp == "", F.trim(issuer)).when(is_job_noise(F.substring_index(iss, " ", -1), sp, w), let(toks, strip_tail)).when(
        F.contains(iss, F.lit("  ")), F.regexp_replace(iss, " {2,}", " ")).otherwise(iss)


def _work_type_without_noise(work_type: Column, specialty: Column, w: Words) -> Column:
    wt = F.trim(F.coalesce(work_type, F.lit("")))
    return F.when((F.trim(F.coalesce(specialty, F.lit(""))) != "") & is_job_noise(wt, specialty, w), "").otherwise(wt)


def prefix_size(toks: Column, names: Sequence[str]) -> Column:
    """Tokens in the longest prefix equal to one of ``names`` (0 without one)."""
    if not names:
        return F.lit(0)
    longest = max(len(n.split()) for n in names)
    out = F.lit(0)
    for k in range(1, longest + 1):
        out = F.when((F.size(toks) >= k) & _in(join_tokens(head_tokens(toks, k)), names), k).otherwise(out)
    return out


def institution_prefix_size(toks: Column, names: Sequence[str], min_len: int = 5) -> Column:
    """Tokens in the longest proper prefix that ends with an institution name of ``min_len``+ letters."""
    names = [n for n in names if len(n) >= min_len]
    if not names:
        return F.lit(0)
    lit = F.array(*[F.lit(n) for n in names])
    ks = F.sequence(F.lit(1), F.greatest(F.size(toks) - 1, F.lit(1)))
    hits = F.filter(ks, lambda k: (k < F.size(toks)) & F.exists(lit, lambda n: F.endswith(F.array_join(F.slice(toks, F.lit(1), k), " "), n)))
    return F.coalesce(F.array_max(hits), F.lit(0))


def split_head(head: Column, w: Words = DEFAULT) -> Column:
    """struct(issuer, work_type) of the tokens before specialty and position.

    Every token ends up in exactly one of the two, in order.
    """
    return let(let(head, _head_once), lambda h: let(_head_size(h, w), lambda k: _head_parts(h, k)))


def _head_once(h: Column) -> Column:
    """A head whose last token is repeated at its end, with that token once."""
    last = last_token(h)
    keep = F.coalesce(F.array_max(F.transform(h, lambda x, i: F.when(x == last, 0).otherwise(i + 1))), F.lit(0)) + 1
    return F.when((F.size(h) >= 2) & (F.get(h, F.size(h) - 2) == last), head_tokens(h, F.least(F.size(h), keep))).otherwise(h)


def _head_size(h: Column, w: Words) -> Column:
    """How many tokens of a head are the issuer."""
    n = F.size(h)
    return (
        F.when(n <= 1, n)
        .when(_in(last_token(h), w.short_work_types), n - 1)
        .when(n == 2, F.when(is_work_type(F.get(h, F.lit(1)), w.work_types), 1).otherwise(n))
        .otherwise(let(F.array(work_type_suffix_size(h, w.work_types), prefix_size(h, w.regions), institution_prefix_size(h, w.institutions)), lambda k: (
            F.when((k[0] >= 1) & (k[0] < n), n - k[0])
            .when((k[1] >= 2) & (k[1] <= n), k[1])
            .when((k[2] >= 1) & (k[2] < n), k[2])
            .otherwise(1))))
    )


def _head_parts(h: Column, k: Column) -> Column:
    return F.struct(join_tokens(head_tokens(h, k)).alias("issuer"), join_tokens(tail_tokens(h, F.size(h) - k)).alias("work_type"))


#: Layouts of a ``~`` line, the first that fits counts: number of tokens (4 stands for more, whose leading ones are one), what each
#: token must be, what each becomes.  P position, S specialty, s specialty and no position, T short work type, N job word before its
#: specialty; I issuer, W work type, H issuer and work type in one, - nothing.
LAYOUTS: list[tuple[int, str, str]] = [
    (1, "P", "P"), (1, ".", "I"),
    (2, "SP", "SP"), (2, ".s", "IS"), (2, "..", "IP"),
    (3, ".SP", "ISP"), (3, "..P", "IWP"), (3, ".ST", "ISW"), (3, ".S.", "IS-"), (3, ".NS", "I-S"), (3, "...", "IWS"),
    (4, ".Ns", "I-S"), (4, "..s", "IWS"), (4, "...", "HSP"),
]


def tilde_line(line: Column, w: Words = DEFAULT) -> Column:
    """struct(issuer, work_type, specialty, position) of a ``~`` line, null for other lines.  ``LAYOUTS`` says which token is which."""
    def fields(toks: Column, slots: Column, chosen: Column) -> Column:
        head = F.when(chosen.startswith("H"), split_head(head_tokens(toks, F.size(toks) - 2), w)).otherwise(_given_head(slots, chosen))
        return let(head, lambda h: _tilde_fields(slots, chosen, h, w))

    def read(s: Column) -> Column:
        return F.when(s.startswith("~"), let(_tilde_tokens(s), lambda t: let(_tilde_slots(t), lambda x: let(_tilde_layout(t, _slot_kinds(x, w)), lambda chosen: fields(t, x, chosen)))))

    return let(squeeze(line), read)


def with_tilde_fields(df: DataFrame, line: str, w: Words = DEFAULT, out: str = "t") -> DataFrame:
    """``df`` with ``tilde_line`` of a column, step by step in columns, which are compiled."""
    d = df.withColumn("_s", squeeze(F.col(line)))
    d = d.withColumn("_t", F.when(F.col("_s").startswith("~"), _tilde_tokens(F.col("_s")))).withColumn("_x", _tilde_slots(F.col("_t")))
    d = d.withColumns({f"_{letter}{i}": F.coalesce(c, F.lit(False)) for (letter, i), c in _slot_kinds(F.col("_x"), w).items()})
    flags = {(letter, i): F.col(f"_{letter}{i}") for letter, i in _slot_kinds(F.col("_x"), w)}
    d = d.withColumn("_l", F.when(F.col("_t").isNotNull(), _tilde_layout(F.col("_t"), flags)))
    # heads of more than one token are read by interpreted rules, so that the rest is short enough to be compiled
    head = lambda t: split_head(head_tokens(t, F.size(t) - 2), w)
    d = d.withColumn("_g", F.when(F.col("_l").startswith("H"), let(F.col("_t"), head)).otherwise(_given_head(F.col("_x"), F.col("_l"))))
    drop = ["_s", "_t", "_x", "_l", "_g", *[f"_{letter}{i}" for letter, i in flags]]
    return d.withColumn(out, F.when(F.col("_t").isNotNull(), _tilde_fields(F.col("_x"), F.col("_l"), F.col("_g"), w))).drop(*drop)


def _tilde_tokens(s: Column) -> Column:
    rest = F.trim(F.substr(s, F.lit(2)))
    return F.when((rest == "") | (rest == ARROW), F.array().cast("array<string>")).otherwise(F.split(rest, " "))


def _tilde_slots(t: Column) -> Column:
    """At most three texts: the tokens, the leading ones of more than three in one."""
    return F.when(F.size(t) <= 3, t).otherwise(F.concat(F.array(join_tokens(head_tokens(t, F.size(t) - 2))), tail_tokens(t, 2)))


def _slot_kinds(slots: Column, w: Words) -> dict[tuple[str, int], Column]:
    """What ``LAYOUTS`` ask of the slots, by letter and slot."""
    at = lambda i: F.get(slots, F.lit(i))
    tests = {
        "P": lambda i: _in(at(i), w.positions), "S": lambda i: looks_like_specialty(at(i), w), "T": lambda i: _in(at(i), w.short_work_types),
        "N": lambda i: is_job_noise(at(i), F.coalesce(at(i + 1), F.lit("")), w),
    }
    asked = {(x, i) for _, wanted, _ in LAYOUTS for i, letter in enumerate(wanted) if letter != "." for x in ("SP" if letter == "s" else letter)}
    return {(x, i): tests[x](i) for x, i in sorted(asked)}


def _tilde_layout(toks: Column, kinds: dict[tuple[str, int], Column]) -> Column:
    """What each slot becomes, by the first of ``LAYOUTS`` that fits; empty without tokens."""
    out = F.lit("")
    for size in (4, 3, 2, 1):
        fit = F.lit("")
        for n, wanted, given in reversed(LAYOUTS):
            if n == size:
                cond = F.lit(True)
                for i, letter in enumerate(wanted):
                    if letter != ".":
                        cond = cond & (kinds["S", i] & ~kinds["P", i] if letter == "s" else kinds[letter, i])
                fit = F.when(cond, given).otherwise(fit)
        out = F.when(F.least(F.size(toks), F.lit(4)) == size, fit).otherwise(out)
    return out


def _slot_of(slots: Column, chosen: Column, letter: str) -> Column:
    return F.coalesce(F.get(slots, F.locate(letter, chosen) - 1), F.lit(""))


def _given_head(slots: Column, chosen: Column) -> Column:
    return F.struct(_slot_of(slots, chosen, "I").alias("issuer"), _slot_of(slots, chosen, "W").alias("work_type"))


def _tilde_fields(slots: Column, chosen: Column, head: Column, w: Words) -> Column:
    sp = _slot_of(slots, chosen, "S")
    return F.struct(_issuer_without_noise(head["issuer"], sp, w).alias("issuer"), _work_type_without_noise(head["work_type"], sp, w).alias("work_type"), sp.alias("specialty"), _slot_of(slots, chosen, "P").alias("position"))


# ------------------------------------------------------------------ specialties
# Duties that may stand behind a specialty's star.
_DUTY_TAILS = ["공사감독", "공사관리", "시공관리", "설계감리", "감리", "감독", "분야책임기술인"]


def best_specialty(c: Column, names: Sequence[str]) -> Column:
    """Longest catalog name inside the text, then the longest one ignoring blanks; empty without a hit."""
    order = sorted(dict.fromkeys(names), key=len, reverse=True)
    lit = F.array(*[F.lit(n) for n in order])
    tight = F.array(*[F.struct(F.lit(n).alias("n"), F.lit("".join(n.split())).alias("c")) for n in order])

    def find(t: Column) -> Column:
        direct = F.get(F.filter(lit, lambda n: F.contains(t, n)), F.lit(0))
        loose = let(compact(t), lambda ct: F.get(F.filter(tight, lambda x: F.contains(ct, x["c"])), F.lit(0))["n"])
        return F.when(t == "", "").otherwise(F.coalesce(direct, loose, F.lit("")))

    return let(F.replace(squeeze(c), F.lit("ㆍ"), F.lit("·")), find)


def rebuild_specialties(left: Column, names: Sequence[str]) -> Column:
    """Concatenated specialty names cut greedily, longest first; null when something is left over.

    Each step eats one name, so a fold over at most ``len(left)/2`` steps of a short
    cell does it.
    """
    order = sorted({"".join(n.split()) for n in names}, key=len, reverse=True)
    lit = F.array(*[F.lit(n) for n in order])

    def eat(c: Column) -> Column:
        steps = F.sequence(F.lit(1), F.greatest(F.floor(F.length(c) / 2), F.lit(1)).cast("int"))
        at_end = F.aggregate(
            steps, F.lit(1),
            lambda at, _: F.when((at < 0) | (at > F.length(c)), at).otherwise(
                F.coalesce(at + F.length(F.get(F.filter(lit, lambda n: F.startswith(F.substr(c, at), n)), F.lit(0))), F.lit(-1))),
        )
        return F.when((c != "") & (at_end == F.length(c) + 1), c)

    return let(compact(left), eat)


def normalize_specialty(c: Column, names: Sequence[str]) -> Column:
    """Specialty cell to its catalog name; cells with patents or method notes stay whole."""
    def halve(s0: Column) -> Column:
        def cut(tight: Column) -> Column:
            half = F.floor(F.length(tight) / 2).cast("int")
            twice = (F.length(tight) >= 6) & (F.length(tight) % 2 == 0) & (F.substr(tight, F.lit(1), half) == F.substr(tight, half + 1))
            return F.when(twice, F.substr(tight, F.lit(1), half)).otherwise(s0)

        return let(compact(s0), cut)

    def finish(s: Column) -> Column:
        keep = s.rlike(r"(?i)특허|신기술|인\s*증서|인증서|\d{2,4}\s*-\s*\d+\s*-\s*\d+\s*호") | (
            s.rlike(r"(?i)P\s*공법|교량\s*\d*\s*개|복층|저소음") & (F.length(s) >= 10))
        left, right = F.regexp_extract(s, r"^([^*]*)\*", 1), squeeze(F.regexp_extract(s, r"^[^*]*\*(.*)$", 1))
        duty = F.lit(None).cast("string")
        for d in sorted(_DUTY_TAILS, key=len):
            duty = F.when(right.startswith(d), d).otherwise(duty)
        rebuilt = F.when(F.contains(s, F.lit("*")), F.concat(rebuild_specialties(left, names), F.lit("*"), duty))
        cut = squeeze(F.regexp_extract(s, r"^(.*?)(\d{2,}|특허|인증서|신기술|호\)|호,|호\s|$)", 1))
        other = F.coalesce(rebuilt, F.nullif(best_specialty(s, names), F.lit("")), cut)
        return F.when(s == "", "").when(keep, squeeze(s)).otherwise(other)

    start = F.regexp_replace(squeeze(F.replace(F.coalesce(c, F.lit("")), F.lit("립식"), F.lit("입식"))), r"\s*\*\s*", "*")
    return let(let(start, halve), finish)
