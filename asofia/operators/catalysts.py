"""Events that move a stock: classification by filing name, magnitude, expiry and six checks."""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from asofia.functions.dates import expiry
from asofia.functions.nulls import hit
from asofia.functions.text import bound

CHECKS = tuple("grounded material no_reversal not_amended not_expired numbers_agree".split())


@dataclass(frozen=True)
class Spec:
    id: str
    polarity: str
    types: tuple[str, ...]
    patterns: tuple[str, ...]
    denominator: str | None = None
    least: float | None = None
    days: int | None = None
    enabled: bool = True
    own_metric: str | None = None


_GAP = r"[|\s]*"  # cells are joined by bars


def _major(*names: str) -> tuple[str, ...]:
    return tuple(rf"주요사항보고서\({n}결정\)" for n in names)


CATALOG = (
    Spec("C1", "positive", ("B",), _major("자기주식취득", "자기주식취득신탁계약체결", "자기주식소각"), "market_cap_used", 0.01, 180),
    Spec("C2", "positive", ("I",), ("단일판매[ㆍ·]공급계약체결",), None, 0.05, 365),
    Spec("C3", "positive", ("I",), (r"영업\(잠정\)", "매출액또는손익구조.*변[동경]"), "market_cap_used", 0.01, 90, own_metric="op_delta_q"),
    Spec("C4", "positive", ("I",), ("현금[ㆍ·]현물배당결정",), "close", 0.01, 365, False),
    Spec("C5", "positive", ("I",), ("기업가치제고계획",), None, None, 365, False),
    Spec("C6", "positive", ("I", "B"), ("신규시설투자등", "비유동자산취득결정", *_major("유형자산양수")), "assets", 0.05, 540, False),
    Spec("C7", "positive", ("B",), ("회사(합병|분할)결정", *_major("영업양수")), None, None, 365, False),
    Spec("C8", "positive", ("B",), (r"주요사항보고서\(소송등의제기\)",), "equity_controlling", 0.05, 730, False),
    Spec("X1", "negative", ("B",), (*_major("유상증자", "전환사채권발행", "신주인수권부사채권발행", "교환사채권발행"), "^유상증자결정$"), "market_cap_used", 0.03, 365),
    Spec("X2", "negative", ("B",), _major("자기주식처분", "자기주식취득신탁계약해지"), "market_cap_used", 0.01, 180, False),
    Spec("X3", "negative", ("B",), ("최대주주변경", "횡령|배임", "관리종목"), None, None, 365, False),
    Spec("X4", "negative", ("B", "I"), ("소송등의(제기|신청)", "손해배상"), "equity_controlling", 0.1, 365, False),
)


def classify(events: DataFrame, specs: tuple[Spec, ...] = CATALOG, enabled_only: bool = True) -> DataFrame:
    """A row for each kind whose types and patterns an event meets; compiled into the projection, so nothing is joined."""
    live = [s for s in specs if s.enabled or not enabled_only]
    kinds = [F.when(hit(F.col("pblntf_ty").isin(*s.types) & F.col("report_key").rlike("|".join(s.patterns))), F.lit(s.id)) for s in live]
    found = events.filter("ticker IS NOT NULL").withColumn("_kinds", F.array_compact(F.array(*kinds)))
    return found.select("*", F.explode("_kinds").alias("kind")).drop("_kinds")


def amendments(events: DataFrame) -> DataFrame:
    """(ticker, report_key) that were ever amended."""
    return events.filter(F.col("is_amendment") & F.col("ticker").isNotNull()).select("ticker", "report_key").distinct()


def magnitude(amounts: list[Column], summed: bool = False, shares: Column | None = None, close: Column | None = None) -> Column:
    """The sum of what is stated, or the first that is; else shares times close."""
    known = reduce(lambda a, b: a | b, [a.isNotNull() for a in amounts])
    stated = F.when(known, reduce(lambda a, b: a + b, [F.coalesce(a, F.lit(0.0)) for a in amounts])) if summed else F.coalesce(*amounts)
    return stated if shares is None else F.coalesce(stated, shares * close)


def contract(text: Column) -> Column:
    """ratio to revenue, end date and total of a supply contract's plain text; no ratio, no contract."""
    return bound(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "), _contract)


def _contract(t: Column) -> Column:
    number = lambda p: F.replace(F.regexp_extract(t, p, 1), F.lit(","), F.lit("")).try_cast("double")
    ratio = number(rf"매출액\s*대비\s*[(%)]*{_GAP}([0-9][0-9,.]*)")
    day = [F.regexp_extract(t, rf"종료일{_GAP}([0-9]{{4}})\D{{1,3}}([0-9]{{1,2}})\D{{1,3}}([0-9]{{1,2}})", k) for k in (1, 2, 3)]
    end = F.try_to_date(F.concat_ws("-", day[0], F.lpad(day[1], 2, "0"), F.lpad(day[2], 2, "0")), "yyyy-MM-dd")
    return F.when(ratio.isNotNull(), F.struct((ratio / 100).alias("ratio"), end.alias("expires_at"), number(rf"계약금액\s*총액\s*[(원)]*{_GAP}([0-9][0-9,]*)").alias("total")))


def build(found: DataFrame, metrics: DataFrame, amended: DataFrame, as_of: datetime.date, specs: tuple[Spec, ...] = CATALOG) -> DataFrame:
    """found: classified events with raw and stated_expiry (either may be null). Adds magnitude, expires_at, the checks and confidence, the number that hold."""
    c = F.col
    by = {s.id: s for s in specs}

    def per_kind(f) -> Column:
        out = F.when(F.lit(False), f(next(iter(by.values()))))
        for k, s in by.items():
            out = out.when(c("kind") == k, f(s))
        return out

    have = set(metrics.columns)
    metric = lambda n: c(f"_m.{n}").cast("double") if n and n in have else F.lit(None).cast("double")
    rows = found.join(metrics.select("ticker", F.struct("*").alias("_m")), "ticker", "left").join(amended.withColumn("_amended", F.lit(True)), ["ticker", "report_key"], "left")
    rows = rows.withColumn("polarity", per_kind(lambda s: F.lit(s.polarity)))
    other = F.max(F.when(c("polarity") == "negative", c("rcept_dt"))).over(Window.partitionBy("ticker"))
    same = F.max(F.when(c("polarity") == "positive", c("rcept_dt"))).over(Window.partitionBy("ticker"))
    rows = rows.withColumn("_opposite", F.when(c("polarity") == "positive", other).otherwise(same))
    raw = F.coalesce(c("raw"), per_kind(lambda s: metric(s.own_metric)))
    denominator = per_kind(lambda s: metric(s.denominator))
    plain = per_kind(lambda s: F.lit(s.denominator is None))
    rows = rows.withColumn("magnitude", F.when(plain, raw).when(denominator > 0, raw / denominator)).withColumn("expires_at", expiry(c("rcept_dt"), per_kind(lambda s: F.lit(s.days).cast("int")), c("stated_expiry")))
    least = per_kind(lambda s: F.lit(s.least).cast("double"))
    agree = F.when(c("_m").isNull(), False).when(c("kind") == "C3", F.coalesce(metric("op_growth_fy") > 0, F.lit(True))).when(c("kind") == "C1", F.coalesce(metric("fcf") > 0, F.lit(True))).otherwise(True)
    rows = rows.withColumns({
        "grounded": c("rcept_no").isNotNull(), "material": least.isNull() | hit(c("magnitude") >= least), "not_amended": c("_amended").isNull(), "not_expired": c("expires_at").isNull() | (c("expires_at") >= F.lit(as_of)),
        "no_reversal": c("_opposite").isNull() | (c("_opposite") <= c("rcept_dt")), "numbers_agree": agree,
    })
    return rows.withColumn("confidence", reduce(lambda a, b: a + b, [c(k).cast("int") for k in CHECKS])).drop("_m", "_amended", "_opposite")


def keep(rows: DataFrame, specs: tuple[Spec, ...] = CATALOG) -> DataFrame:
    """Kinds with a minimum need a magnitude."""
    need = [s.id for s in specs if s.least is not None]
    return rows.filter(~F.col("kind").isin(*need) | F.col("magnitude").isNotNull())


def live(rows: DataFrame, least: int = 4) -> DataFrame:
    return rows.filter(F.col("not_expired") & (F.col("confidence") >= least))


def top_per_kind(rows: DataFrame, top: int = 15) -> DataFrame:
    w = Window.partitionBy("kind")
    ranked = rows.withColumn("rank", F.row_number().over(w.orderBy(F.col("confidence").desc(), F.col("magnitude").desc_nulls_last(), "rcept_no"))).withColumn("more", F.greatest(F.count(F.lit(1)).over(w) - top, F.lit(0)))
    return ranked.filter(F.col("rank") <= top)
