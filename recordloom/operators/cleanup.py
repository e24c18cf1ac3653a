"""Field clean-up of career records: projections over named columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.text import (
    compact, contains_any, count_char, count_hits, fill_empty, is_blank, join_tokens, squeeze, tokens,
)

# Fixed token lists of the domain.
JOB_FIELDS = ["토목", "건축", "기계", "전기", "통신", "조경", "환경", "안전", "품질", "안전관리", "품질관리"]
DUTY_WORDS = [
    "설계", "설계담당", "설계감리", "계획", "사업관리", "실시설계", "도면작성", "조사", "감리", "시공",
    "분야기술인", "참여기술인", "기술지원", "자문", "지하안전영향평가", "안전영향평가", "환경영향평가",
    "사전재해영향평가", "소규모환경영향평가", "소규모지하안전영향평가", "안전관리",
]
POSITION_WORDS = [
    "사외이사", "상무이사", "전무이사", "부사장", "사장", "대표", "이사장", "상무", "전무", "부장", "차장",
    "과장", "계장", "대리", "주임", "사원", "선임", "책임", "수석", "전임", "소장", "실장", "팀장", "본부장",
    "단장", "감리원", "원장", "반장", "조장", "검사원", "관리원", "기사", "상무보",
]
ISSUER_WORK_TYPES = [
    "고속도로", "국도", "지방도", "도로", "상수도", "하수도", "하천", "항만", "철도", "교량", "공원",
]
COLUMN_LABELS = [
    "사업명", "직무분야", "담당업무", "참여기간", "발주자", "공사종류", "전문분야", "직위", "공사(용역)개요",
    "책임정도", "공사(용역)금액", "적용 공법", "적용 융", "적용 신기술", "시설물 종류", "비고",
]
COLUMN_TITLES = ["적용 공법", "시설물 종류", "적용 신기술 등", "적용 융ㆍ복합건설기술", "적용 융복합건설기술"]

SERVICE_PREFIX = "기술용역"


def comma_spacing(c: Column) -> Column:
    """One blank after every comma that is followed by text."""
    return squeeze(F.regexp_replace(c, r",(?=\S)", ", "))


def strip_tail_job_duty(c: Column) -> Column:
    """struct(name, job, duty): a trailing 'job duty' or 'job' token is cut off the name."""
    s = squeeze(c)
    t = tokens(c)
    n = F.size(t)
    two = (n >= 3) & F.try_element_at(t, F.lit(-2)).isin(*JOB_FIELDS)
    one = (n >= 2) & F.try_element_at(t, F.lit(-1)).isin(*JOB_FIELDS)
    return (
        F.when(two, F.struct(join_tokens(F.slice(t, F.lit(1), F.greatest(n - 2, F.lit(0)))).alias("name"),
                             F.get(t, n - 2).alias("job"), F.get(t, n - 1).alias("duty")))
        .when(one, F.struct(join_tokens(F.slice(t, F.lit(1), F.greatest(n - 1, F.lit(0)))).alias("name"),
                            F.get(t, n - 1).alias("job"), F.lit("").alias("duty")))
        .otherwise(F.struct(s.alias("name"), F.lit("").alias("job"), F.lit("").alias("duty")))
    )


def clean_project_name(
    df: DataFrame, name: str = "project_name", job: str = "job_field", duty: str = "duty"
) -> DataFrame:
    """Leading service word, inner 'job duty' (last hit), tail 'job duty' and comma spacing.

    A tail cut fills empty job and duty fields.
    """
    n0 = F.trim(F.coalesce(F.col(name), F.lit("")))
    jf, dt = F.trim(F.coalesce(F.col(job), F.lit(""))), F.trim(F.coalesce(F.col(duty), F.lit("")))
    rest = squeeze(F.substr(n0, F.lit(len(SERVICE_PREFIX) + 1)))
    d = df.withColumn(
        "_n1",
        F.when(n0.startswith(SERVICE_PREFIX) & (F.length(n0) > len(SERVICE_PREFIX) + 1) & (rest != ""), rest).otherwise(n0),
    )
    n1 = F.col("_n1")
    # The literal quoting keeps brackets of the field values out of the pattern.
    pattern = F.concat(F.lit(r"(?s)^(.*)\Q"), jf, F.lit(r"\E\s*\Q"), dt, F.lit(r"\E(.*)$"))
    known = (jf != "") & (dt != "") & F.contains(n1, jf) & F.contains(n1, dt)
    cut = F.when(known & n1.rlike("."), F.regexp_replace(n1, pattern, F.lit("$1$2")))
    tidy = F.regexp_replace(F.regexp_replace(squeeze(cut), r",\s*", ", "), r"\s+,", ",")
    d = d.withColumn("_n2", F.when(cut.isNotNull() & (cut != n1) & (tidy != ""), tidy).otherwise(n1))
    tail = strip_tail_job_duty(F.col("_n2"))
    d = d.withColumn("_t", tail)
    changed = F.col("_t.name") != F.col("_n2")
    final = F.when(changed, F.col("_t.name")).otherwise(F.col("_n2"))
    out = d.withColumn("_name", F.when(n0 == "", n0).when(F.contains(final, F.lit(",")), comma_spacing(final)).otherwise(final))
    out = out.withColumn("_job", F.when((n0 != "") & changed & (jf == ""), F.col("_t.job")).otherwise(F.col(job)))
    out = out.withColumn("_duty", F.when((n0 != "") & changed & (dt == ""), F.col("_t.duty")).otherwise(F.col(duty)))
    repl = {name: "_name", job: "_job", duty: "_duty"}
    return out.select(*[F.col(repl.get(c, c)).alias(c) for c in df.columns])


def work_type_from_name(name: Column, current: Column) -> Column:
    """Correct the work type from words of the project name, first matching rule wins."""
    n = compact(name)
    cur = F.trim(F.coalesce(current, F.lit("")))
    c = compact(cur)
    lacks = lambda w: ~F.contains(c, F.lit(w))
    roads = ["고속도로", "국도", "지방도", "도로"]
    return (
        F.when(n == "", cur)
        .when(F.contains(n, F.lit("상하수도")) & (lacks("상수도") | lacks("하수")), "상수도,하수도")
        .when(F.contains(n, F.lit("정수장")) & lacks("정수장"), "상수도(정수장)")
        .when(contains_any(n, ["상수도", "광역상수도", "급수", "배수지"]) & lacks("상수도"), "상수도")
        .when(contains_any(n, ["하수도", "하수처리", "하수관로"]) & lacks("하수"), "하수도")
        .when(contains_any(n, ["하천", "골재", "부존량", "준설"]) & lacks("하천"), "하천")
        .when(contains_any(n, roads) & ~contains_any(c, roads), F.when(F.contains(n, F.lit("교")), "도로,교량").otherwise("도로"))
        .when(F.contains(n, F.lit("철도")) & lacks("철도"), "철도")
        .when(F.contains(n, F.lit("항만")) & lacks("항만"), "항만")
        .otherwise(cur)
    )


def move_issuer_work_type(df: DataFrame, issuer: str = "issuer", work_type: str = "work_type") -> DataFrame:
    """An issuer that is nothing but a work-type word fills an empty work type."""
    iss = F.trim(F.coalesce(F.col(issuer), F.lit("")))
    hit = iss.isin(*ISSUER_WORK_TYPES) & is_blank(F.col(work_type))
    return df.select(*[
        F.when(hit, F.lit("")).otherwise(F.col(c)).alias(c) if c == issuer
        else F.when(hit, iss).otherwise(F.col(c)).alias(c) if c == work_type
        else F.col(c)
        for c in df.columns
    ])


def close_duty_bracket(c: Column) -> Column:
    """Squeezed duty with a missing closing bracket added."""
    s = squeeze(c)
    return F.when(count_char(s, "(") > count_char(s, ")"), F.concat(s, F.lit(")"))).otherwise(s)


def looks_like_column_label(c: Column) -> Column:
    """Two or more column labels in at most 80 characters, or one bare column title."""
    s = squeeze(c)
    return ((count_hits(s, COLUMN_LABELS) >= 2) & (F.length(s) <= 80)) | s.isin(*COLUMN_TITLES)


def blank_label_names(
    df: DataFrame, name: str = "project_name", job: str = "job_field", duty: str = "duty",
    issuer: str = "issuer", work_type: str = "work_type",
) -> DataFrame:
    """Blank names (and then job, duty) that are column labels, unless issuer or work type are filled."""
    hit = looks_like_column_label(F.col(name)) & is_blank(F.col(issuer)) & is_blank(F.col(work_type))
    return df.select(*[
        F.when(hit, F.lit("")).otherwise(F.col(c)).alias(c) if c == name
        else F.when(hit & looks_like_column_label(F.col(c)), F.lit("")).otherwise(F.col(c)).alias(c) if c in (job, duty)
        else F.col(c)
        for c in df.columns
    ])


def looks_like_overview(c: Column) -> Column:
    """A measurement or list sentence standing where a project name should be."""
    s = squeeze(c)
    measure = (
        s.rlike(r"(?U)\bD\d+~[D]?\d+\w*\b")
        | s.rlike(r"(^|[^A-Za-z0-9])L=\d+\.?\d*\s*(m|km|mm|cm)($|[^A-Za-z])")
        | s.rlike(r"Q=\d+") | s.rlike("[㎥㎞㎡㎝㎜]|m³|m²")
        | s.rlike(r":\s*\d") | s.rlike(r"\d+\s*개소") | F.contains(s, F.lit(","))
        | s.rlike(r"(?i)\bD[1-9]\d{2,3}\b|L\d+(\.\d+)?|\bØ\d+\b")
    )
    head_office = compact(c).startswith("본사")
    return measure & ~head_office & (s != "")


def blank_overview_names(df: DataFrame, name: str = "project_name", start: str = "start_date", days: str = "recog_days") -> DataFrame:
    """Blank overview-like names of rows that have neither period nor days."""
    hit = looks_like_overview(F.col(name)) & is_blank(F.col(start)) & is_blank(F.col(days))
    return df.withColumn(name, F.when(hit, F.lit("")).otherwise(F.col(name)))


def repair_shifted_fields(
    df: DataFrame, name: str = "project_name", issuer: str = "issuer", position: str = "position",
    job: str = "job_field", duty: str = "duty", and_word: str = "및", and_phrase: str = "및 실시설계용역",
) -> DataFrame:
    """Position word in the issuer cell, '…/' + '…부' joined, and the job field 'and' repaired."""
    iss, pos = squeeze(F.col(issuer)), squeeze(F.col(position))
    swap = iss.isin(*POSITION_WORDS) & (pos == "")
    nm, jf, dt = squeeze(F.col(name)), squeeze(F.col(job)), squeeze(F.col(duty))
    slash = nm.endswith("/") & jf.endswith("부") & ~jf.isin(*JOB_FIELDS)
    nm1 = F.when(slash, F.concat(nm, F.lit(" "), jf)).otherwise(nm)
    is_and = jf == and_word
    needs = is_and & F.contains(nm1, F.lit("용역")) & ~F.contains(nm1, F.lit("실시설계"))
    nm2 = F.when(
        needs,
        F.when(nm1.endswith("용역"), squeeze(F.replace(nm1, F.lit("기본 용역"), F.lit("기본 " + and_phrase))))
        .otherwise(F.concat(nm1, F.lit(" " + and_phrase))),
    ).when(slash, nm1).otherwise(F.col(name))
    new = {
        name: nm2,
        issuer: F.when(swap, F.lit("")).otherwise(F.col(issuer)),
        position: F.when(swap, iss).otherwise(F.col(position)),
        job: F.when(is_and, F.lit("토목")).otherwise(F.col(job)),
        duty: F.when(is_and & (dt == "실시설계"), F.lit("설계")).otherwise(F.col(duty)),
    }
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def drop_issuer_equal_specialty(df: DataFrame, issuer: str = "issuer", specialty: str = "specialty", work_type: str = "work_type") -> DataFrame:
    """Squeeze the three fields and blank an issuer that only repeats the specialty."""
    sp, iss = squeeze(F.col(specialty)), squeeze(F.col(issuer))
    new = {
        specialty: sp,
        issuer: F.when((sp != "") & (iss == sp), F.lit("")).otherwise(iss),
        work_type: squeeze(F.col(work_type)),
    }
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def correct_head_office(
    df: DataFrame, keys: list[str], order: str, office: str = "본사", part_word: str = "공사부",
    short_days: int = 90, long_days: int = 180, bare_days: int = 60,
) -> DataFrame:
    """Head-office rows that took over the next record's name.

    Looks one record ahead (equal non-empty names):
    - a '/' name without issuers whose next record spans two years becomes ``office``;
    - a '~' name with few days before many days becomes ``office`` and loses issuer,
      work type, specialty and position;
    then ``part_word`` names inside one year become ``office``, and short ``office``
    rows keep their name only.  Thresholds and words are parameters.
    """
    from recordloom.operators.scan import neighbour

    d = neighbour(df, keys, order, {
        "_nn": "project_name", "_ni": "issuer", "_ns": "start_date", "_ne": "end_date", "_nd": "recog_days",
    })
    year = lambda c: F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.substring(c, 1, 4).cast("int"))
    days = lambda c: F.coalesce(c.try_cast("int"), F.lit(0))
    nm = F.trim(F.coalesce(F.col("project_name"), F.lit("")))
    same = (nm != "") & (nm == F.trim(F.coalesce(F.col("_nn"), F.lit(""))))
    spans = same & F.contains(nm, F.lit("/")) & is_blank(F.col("issuer")) & is_blank(F.col("_ni")) & (
        year(F.col("_ns")) != year(F.col("_ne")))
    short = same & F.contains(nm, F.lit("~")) & days(F.col("recog_days")).between(1, short_days) & (
        days(F.col("_nd")) >= long_days)
    part = F.contains(nm, F.lit(part_word)) & ~F.coalesce(spans | short, F.lit(False)) & (
        year(F.col("start_date")) == year(F.col("end_date")))
    t = lambda c: F.coalesce(c, F.lit(False))
    renamed = t(spans) | t(short) | t(part)
    d = d.withColumn("_nm", F.when(renamed, F.lit(office)).otherwise(F.col("project_name")))
    bare = (F.col("_nm") == office) & days(F.col("recog_days")).between(1, bare_days)
    few, all6 = t(short) | t(part) | t(bare), t(part) | t(bare)
    blanked = {c: few for c in ("issuer", "work_type", "specialty", "position")}
    blanked |= {c: all6 for c in ("job_field", "duty")}
    out = d.select(
        *[c for c in df.columns if c not in blanked and c != "project_name"],
        F.col("_nm").alias("project_name"),
        *[F.when(flag, F.lit("")).otherwise(F.col(c)).alias(c) for c, flag in blanked.items()],
    )
    return out.select(*df.columns)


def drop_masked_placeholders(df: DataFrame, payload: tuple[str, ...] = (
    "issuer", "work_type", "job_field", "specialty", "duty", "resp", "position",
    "recog_days", "part_days", "amount", "overview",
)) -> DataFrame:
    """Drop rows whose period is masked on both sides and that carry no other value."""
    masked = (F.col("start_date") == "****-**-**") & (F.col("end_date") == "****-**-**")
    has = F.lit(False)
    for c in payload:
        has = has | (~is_blank(F.col(c)) & (F.trim(F.col(c)) != "┖→"))
    return df.where(~(masked & ~has))


def fill_from(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Fill blank columns from other columns of the row."""
    return df.select(*[fill_empty(F.col(c), F.col(pairs[c])).alias(c) if c in pairs else F.col(c) for c in df.columns])
