"""Page text to lines, header/footer filter and line classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.text import ARROW, clean_blanks, compact, contains_any, count_hits, strip

# Fixed word lists of the certificate form.
TECH_FOOTER_WORDS = [
    "발급증명서확인", "www.kocea.or.kr", "문서확인번호", "문서 하단", "문서하단", "바코드로", "위·변조",
    "위변조", "발급일로부터", "90일까지", "가능합니다", "확인해 주십시오", "내용의 위", "변조 여부",
]
TECH_HEADER_WORDS = [
    "사업명", "직무분야", "담당업무", "참여기간", "발주자", "공사종류", "전문분야", "직위", "공사(용역)개요",
    "책임정도", "공사(용역)금액", "적용 공법", "적용 융", "시설물 종류", "비고", "(인정일)", "(참여일)",
]
CM_FOOTER_WORDS = [
    "발급증명서확인", "www.kocea.or.kr", "문서확인번호", "문서 하단", "문서하단", "바코드로", "위·변조",
    "위변조", "발급일로부터", "90일까지", "가능합니다", "확인해 주십시오",
]
CM_HEADER_WORDS = [
    "사업명", "참여기간", "발주자", "공사종류", "직무분야", "전문분야", "직위", "책임정도", "공사(용역)금액",
]

FULL_DATE = r"^[0-9]{4}\.[0-9]{2}\.[0-9]{2}$"
DATE_LINE = r"^[0-9]{4}\.[0-9]{2}(\.[0-9]{2})?$"
MASKED_DATE = r"^\*{2,}\.\*{2,}\.\*{2,}$"
DAYS_LINE = r"^\(?\s*([0-9][0-9,]*)?\s*일\s*\)?$"
ONGOING = ("근무중", "재직중")


def line_text(raw: Column) -> Column:
    """Blanks and tabs squeezed, ends trimmed (``\\r`` of DOS line ends included)."""
    return F.regexp_replace(strip(clean_blanks(raw)), r"[ \t]{2,}|\t", " ")


def _with_tidy_text(pages: DataFrame, text: str) -> DataFrame:
    """``pages`` with ``text`` such that its pieces between line feeds are what ``line_text`` makes of them.

    A page is cleaned at once and in compiled code; only texts with a blank at a
    line's end, two blanks in a row or other white space meet a regular expression.
    """
    t = F.col(text)
    d = pages.withColumn(text, clean_blanks(t))
    rare = contains_any(t, ["  ", " \n", "\n ", "\t", "\r", "\f", "\x0b"]) | t.startswith(" ") | t.endswith(" ")
    ends = r"(?<![^\n])[ \t\r\f\x0B]++|(?<![ \t\r\f\x0B])[ \t\r\f\x0B]++(?![^\n])"
    return d.withColumn(text, F.when(rare, F.regexp_replace(F.regexp_replace(t, ends, ""), r"[ \t]{2,}|\t", " ")).otherwise(t))


def split_lines(pages: DataFrame, keys: tuple[str, ...] = ("doc_id", "page_no"), text: str = "text") -> DataFrame:
    """Non-empty lines of every page, numbered from 0.

    The page is cut into its line array first and numbered by position in the
    filtered array, so neither a window nor a shuffle is needed.
    """
    others = [c for c in pages.columns if c not in (*keys, text)]
    arr = F.array_remove(F.split(F.col(text), "\n"), "")
    return _with_tidy_text(pages, text).select(*keys, *others, F.posexplode(arr).alias("line_no", "line")).withColumn(
        "line_no", F.col("line_no").cast("bigint")
    )


def is_annotation(line: Column) -> Column:
    """Foot notes and legal remarks under the table."""
    short = F.length(line)
    return (
        (F.contains(line, F.lit("책임정도의")) & F.contains(line, F.lit("*")))
        | line.startswith("(책임정도")
        | (line.startswith("(*") & F.contains(line, F.lit("는")) & (short <= 120))
        | (line.startswith("(*") & contains_any(line, ["별표", "법", "시행령"]) & (short <= 160))
        | (contains_any(line, ["인정일", "참여일"]) & line.rlike(r"^\(?\s*(인정일|참여일)\s*\)?$"))
    )


def is_boilerplate(line: Column, section: str = "tech") -> Column:
    """Header, footer or annotation line of a career page (``section`` 'tech' or 'cm')."""
    tech = section == "tech"
    title, number = ("기술경력", "1") if tech else ("건설사업관리", "2")
    footer, header = (TECH_FOOTER_WORDS, TECH_HEADER_WORDS) if tech else (CM_FOOTER_WORDS, CM_HEADER_WORDS)
    flag = (
        (line == "")
        | is_annotation(line)
        | line.startswith("Page :") | line.startswith("성명 :")
        | (F.contains(line, F.lit(title)) & (F.contains(line, F.lit(number + ".")) | line.startswith(number)))
        | (line.startswith("(") & F.contains(line, F.lit("쪽")))
        | F.contains(line, F.lit("본 증명서는 인터넷으로 발급"))
        | contains_any(line, footer)
        | ((F.length(line) <= 80) & (count_hits(line, header) >= 2))
    )
    if tech:
        flag = (
            flag
            | (line.startswith("사업명") & contains_any(line, ["직무분야", "담당업무"]))
            | line.isin("참여기간", "비고")
        )
    return flag


# Page texts and column headers of word-line pages.
TEMPLATE_FOOTER_WORDS = ["발급증명서확인", "www.kocea.or.kr", "문서확인번호", "문서 하단", "문서하단", "바코드로", "위·변조", "위변조", "발급일로부터", "90일까지", "가능합니다", "확인해 주십시오", "변조 여부"]
TEMPLATE_HEADER_WORDS = ["사업명", "직무분야", "담당업무", "참여기간", "발주자", "공사종류", "전문분야", "직위", "공사(용역)개요", "책임정도", "공사(용역)금액", "적용 공법", "적용 융", "시설물 종류", "비고", "(인정일)", "(참여일)"]


def is_template_boilerplate(line: Column) -> Column:
    """Header or footer line of a page whose lines come from words: annotations stay, two column headers on a line of up to 90 letters go."""
    return (
        (line == "") | line.startswith("Page :") | line.startswith("성명 :")
        | (F.contains(line, F.lit("기술경력")) & (F.contains(line, F.lit("1.")) | line.startswith("1")))
        | F.contains(line, F.lit("본 증명서는 인터넷으로 발급")) | contains_any(line, TEMPLATE_FOOTER_WORDS)
        | (line.startswith("(") & F.contains(line, F.lit("쪽")))
        | (line.startswith("사업명") & contains_any(line, ["직무분야", "담당업무"])) | line.isin("참여기간", "비고", "(인정일)", "(참여일)")
        | ((F.length(line) <= 90) & (count_hits(line, TEMPLATE_HEADER_WORDS) >= 2))
    )


def content_lines(lines: DataFrame, section: str = "tech", keys: tuple[str, ...] = ("doc_id", "page_no")) -> DataFrame:
    """Lines without boilerplate, renumbered densely inside the page."""
    w = Window.partitionBy(*keys).orderBy("line_no")
    kept = lines.where(~is_boilerplate(F.col("line"), section))
    return kept.withColumn("line_no", (F.row_number().over(w) - 1).cast("bigint"))


def content_lines_of_pages(pages: DataFrame, section: str = "tech", text: str = "text") -> DataFrame:
    """Content lines of every page, in order but with the gaps of the dropped lines.

    Row frames and ordering are all most operators need; ``content_lines`` numbers
    densely.  The cleaned line comes out of the generator, so the filter reads a
    column: pushed below a projection it would clean the line once per keyword.
    """
    others = [c for c in pages.columns if c != text]
    d = _with_tidy_text(pages, text).select(*others, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))
    return d.where((F.col("line") != "") & ~is_boilerplate(F.col("line"), section)).withColumn(
        "line_no", F.col("line_no").cast("bigint"))


def line_kind(line: Column) -> Column:
    """'arrow', 'tilde', 'mask', 'date', 'ongoing', 'days' or 'text'; cheap tests guard the patterns."""
    return (
        F.when(line.startswith(ARROW), "arrow")
        .when(line.startswith("~"), "tilde")
        .when(line.startswith("*") & line.rlike(MASKED_DATE), "mask")
        .when((F.length(line) == 10) & line.rlike(FULL_DATE), "date")
        .when(contains_any(line, ["근", "재"]) & compact(line).isin(*ONGOING), "ongoing")
        .when(F.contains(line, F.lit("일")) & line.rlike(DAYS_LINE), "days")
        .otherwise("text")
    )


def pages_containing(pages: DataFrame, needle: str, text: str = "text") -> DataFrame:
    """Pages whose text contains ``needle``, with the first position and the number of hits."""
    c = F.col(text)
    return pages.where(F.contains(c, F.lit(needle))).select(
        "doc_id", "page_no",
        F.instr(c, needle).cast("bigint").alias("first_pos"),
        ((F.length(c) - F.length(F.replace(c, F.lit(needle), F.lit("")))) / len(needle)).cast("bigint").alias("hits"),
    )
