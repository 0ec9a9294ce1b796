"""Text and label functions. Rules are ordered: the first that matches wins."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"[\s　]+"
AMENDMENTS = tuple("기재정정 기타정정 변경등록 연장결정 정정명령부과 첨부정정 첨부추가 취소".split())
_AMENDED = rf"^\[({'|'.join(AMENDMENTS)})\]"


def squeeze(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, BLANK, " "))


def citation_key(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), BLANK, "")


def segment_key(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"[()&·\-\s　]", ""))


def ticker6(c: Column) -> Column:
    """Zero-filled to six places; longer values stay whole."""
    return F.when(F.length(c) >= 6, c).otherwise(F.lpad(c, 6, "0"))


def has_any(c: Column, parts: list[str] | tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(p) for p in parts])


def first_match(c: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """rules: (pattern, code), in order."""
    out = None
    for pattern, code in rules:
        out = F.when(c.rlike(pattern), F.lit(code)) if out is None else out.when(c.rlike(pattern), F.lit(code))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of c, where c is evaluated once however often f uses it."""
    return F.transform(F.array(c), f)[0]


def share_class(label: Column) -> Column:
    """'common', 'other' or null (a total, a remark, undecidable). Preferred marks come before common ones, both before voting rights."""
    return bound(squeeze(F.coalesce(label, F.lit(""))), _share_class)


def _share_class(s: Column) -> Column:
    skipped = s.isin("", "종류의 주식", *"기타 기타주 기타주식 비고 유통주식 자본주 주식수".split()) | s.contains("합계")
    voting = F.when(has_any(s, ("없", "무의결권")), "other").otherwise("common")
    return F.when(skipped, None).when(has_any(s, "상환주 신형 우선 전환주 종류주".split()), "other").when(has_any(s, "보톧 보통 보퉁".split()), "common").when(s.contains("의결권"), voting)


#: What happened to the holders, in order of precedence.
OUTCOMES: list[tuple[str, tuple[str, ...]]] = [
    (outcome, tuple(marks.split("; ")))
    for outcome, marks in (
        ("merged", "완전 자회사; 완전자회사; 주식의 포괄적; 지주회사; 포괄적 주식교환; 합병으로; 흡수합병"),
        ("voluntary", "상장폐지 신청; 신청에 의한 상장폐지; 자진"),
        ("dissolved", "기업인수목적; 상장예비심사; 스팩; 존속기간"),
        ("failed", "감사범위 제한; 감사의견; 경영의 투명성; 계속성; 매출액 미달; 부도; 분산요건; 사업보고서; 상장폐지기준; 시가총액 미달; 의견거절; 자본잠식; 자본전액잠식; 주식분산; 지정자문인; 파산; 해산; 회생절차"),
    )
]
SPAC = "스팩"


def delisting_outcome(reason: Column, name: Column, outcomes: list[tuple[str, tuple[str, ...]]] | None = None, spac: str = SPAC) -> Column:
    """merged, voluntary, dissolved, failed or other. A blank reason is dissolved for a shell company's name only; its name also beats what comes after voluntary."""
    both = F.struct(squeeze(F.coalesce(reason, F.lit(""))).alias("s"), squeeze(F.coalesce(name, F.lit(""))).alias("n"))
    return bound(both, lambda x: _outcome(x["s"], x["n"], outcomes or OUTCOMES, spac))


def _outcome(s: Column, n: Column, outcomes: list[tuple[str, tuple[str, ...]]], spac: str) -> Column:
    out = F.when(s == "", F.when(n.contains(spac), "dissolved").otherwise("other"))
    for outcome, marks in outcomes:
        found = has_any(s, marks)
        out = out.when(found | n.contains(spac) if outcome == "dissolved" else found, outcome)
    return out.otherwise("other")


def report_key(name: Column) -> Column:
    return bound(squeeze(F.coalesce(name, F.lit(""))), lambda s: F.when(s.rlike(_AMENDED), F.trim(F.regexp_replace(s, _AMENDED, ""))).otherwise(s))


def is_amendment(name: Column) -> Column:
    return squeeze(F.coalesce(name, F.lit(""))).rlike(_AMENDED)


def short_name(report: Column) -> Column:
    """What stands in the last brackets of a report's name, else the name."""
    inner = F.regexp_extract(F.coalesce(report, F.lit("")), r"\(([^()]*)\)\s*$", 1)
    return F.when(inner != "", inner).otherwise(squeeze(report))


def parent_ticker(ticker: Column, stated: Column | None = None) -> Column:
    """A preferred line's common line: the stated one, else the first five places and 0. Common lines have none."""
    inferred = F.when((F.length(ticker) == 6) & (F.substring(ticker, 6, 1) != "0"), F.concat(F.substring(ticker, 1, 5), F.lit("0")))
    return inferred if stated is None else F.coalesce(stated, inferred)


def is_spac(name: Column) -> Column:
    return F.coalesce(name.rlike("스팩|기업인수목적"), F.lit(False))


def is_reit(name: Column) -> Column:
    return F.coalesce(name.rlike("리츠|위탁관리부동산"), F.lit(False))


def looks_like_holding(name: Column) -> Column:
    return F.coalesce(name.rlike("(홀딩스|지주|홀딩컴퍼니|Holdings)$"), F.lit(False))


_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))


def plain_text(markup: Column) -> Column:
    """Markup to text: no style or script, cells joined by ' | ', rows and blocks on lines of their own, five entities."""
    c = F.coalesce(markup, F.lit(""))
    c = F.regexp_replace(c, r"(?si)<(script|style)(?:\s[^>]*)?>.*?</\1\s*>", " ")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", " ")
    attributes = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
    c = F.regexp_replace(c, rf"(?i)</t[dhue]\s*>\s*<t[dhue]\b{attributes}>", " | ")
    c = F.regexp_replace(c, rf"(?i)<(?:br|/tr|/p|/div|/title|/h[1-6]|/li|/table)\b{attributes}>", "\n")
    c = F.regexp_replace(c, rf"<[/!?A-Za-z]{attributes}>", " ")
    for entity, char in _ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    c = F.regexp_replace(c, r"[ \t\x{00A0}\x{3000}]+", " ")
    c = F.regexp_replace(c, r" *\n *", "\n")
    return F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


# Six number formats, each with rules of its own.
def statement_amount(c: Column) -> Column:
    """Blank and '-' are missing, 0 isn't; commas and inner spaces go; brackets mean negative."""
    s = F.regexp_replace(F.trim(c), "[ ,]", "")
    s = F.when(s.rlike(r"^\(.*\)$"), F.concat(F.lit("-"), F.regexp_replace(s, "[()]", ""))).otherwise(s)
    return F.when(~s.isin("", "-"), s).try_cast("double")


def event_amount(c: Column) -> Column:
    """Dashes are missing; else the number, else the first number in the text."""
    s = F.replace(F.trim(c), F.lit(","), F.lit(""))
    return F.when(s.isin("", "-", "―", "–"), None).otherwise(F.coalesce(s.try_cast("double"), F.regexp_extract(s, r"-?\d+(?:\.\d+)?", 0).try_cast("double")))


def payout_amount(c: Column) -> Column:
    s = F.trim(F.replace(c, F.lit(","), F.lit("")))
    return F.when(~s.isin("", "-", "N/A"), s).try_cast("double")


def share_count(c: Column) -> Column:
    return F.when(~F.trim(c).isin("", "-"), F.replace(F.trim(c), F.lit(","), F.lit(""))).try_cast("double").try_cast("long")


def cell_number(c: Column) -> Column:
    """Percent signs and commas go; brackets mean negative."""
    s = F.regexp_replace(F.trim(c), "[%, ]", "")
    s = F.when(s.rlike(r"^[(△▲].*$"), F.concat(F.lit("-"), F.regexp_replace(s, "[()△▲]", ""))).otherwise(s)
    return s.try_cast("double")


def quote_number(c: Column) -> Column:
    return F.replace(F.trim(c), F.lit(","), F.lit("")).try_cast("double")
