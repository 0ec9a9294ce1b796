"""Hard guards and the adaptive gate: tightness by the closed form, ranking by composite z-scores, hysteresis, caps.

Each filter is monotone in the tightness t, so a row has a largest t that it passes: the least over its filters of where
its value lies between loose and tight. That makes the gate one pass and a top-k instead of a search over t.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from asofia.functions.nulls import hit


class GuardError(ValueError):
    pass


@dataclass(frozen=True)
class Filter:
    metric: str
    loose: float
    tight: float
    least: bool = True  # value >= threshold, else value <= threshold
    positive: bool = False

    @property
    def key(self) -> str:
        return f"{self.metric}.{'min' if self.least else 'max'}"

    def __post_init__(self) -> None:
        if (self.tight < self.loose) if self.least else (self.tight > self.loose):
            raise GuardError(f"{self.key}: {self.loose} -> {self.tight} widens")

    def at(self, share: float) -> float:
        width = self.tight - self.loose
        return self.loose + share * width

    def passes(self, t: float) -> Column:
        v = F.col(self.metric)
        ok = v >= self.at(t) if self.least else v <= self.at(t)
        return hit(ok & (v > 0)) if self.positive else hit(ok)

    def most(self) -> Column:
        """The largest tightness at which the row passes; -1 if it never does."""
        v = F.col(self.metric)
        if self.loose == self.tight:
            t = F.lit(1.0)
            ok = v >= self.loose if self.least else v <= self.loose
        else:
            t = F.least((v - self.loose) / (self.tight - self.loose), F.lit(1.0))
            ok = v.isNotNull() & (t >= 0)  # least() passes nulls over
        return F.when(hit(ok & (v > 0) if self.positive else ok), t).otherwise(-1.0)


@dataclass(frozen=True)
class Gate:
    filters: tuple[Filter, ...]
    ranking: tuple[tuple[str, float], ...]
    mode: str = "target_count"  # or fixed, rank_top_n
    target: int = 60
    tolerance: int = 5
    cap: int = 100
    hysteresis: float = 0.0


GUARDS = tuple("admin_issue audit_opinion_bad_admin capital_impairment is_preferred is_reit is_spac market_cap_implausible market_cap_inconsistent negative_earnings pbr_implausible price_dividend_inconsistent stale_financials ttm_incomplete".split())
_ADTV = Filter("adtv_20d", 1e8, 5e8)
SCREENS: dict[str, Gate] = {
    "deep_value": Gate((Filter("per", 15, 6, False, True), Filter("pbr", 1.2, 0.55, False, True), Filter("fcf_yield", 0, 0.08), _ADTV), (("per", -0.4), ("pbr", -0.3), ("fcf_yield", 0.3)), target=60, cap=100, hysteresis=0.08),
    "garp": Gate((Filter("roe", 0.1, 0.2), Filter("rev_growth_fy", 0.05, 0.2), Filter("op_growth_fy", 0.05, 0.2), Filter("per", 25, 25, False, True), Filter("per", 10, 10), _ADTV), (("roe", 0.35), ("rev_growth_fy", 0.25), ("op_margin", 0.2), ("per", -0.2)), target=40, cap=60, hysteresis=0.08),
    "quality_fcf": Gate((Filter("fcf_yield", 0.05, 0.12), Filter("op_margin", 0.08, 0.2), _ADTV), (("fcf_yield", 0.45), ("op_margin", 0.35), ("roic", 0.2)), target=40, cap=60, hysteresis=0.08),
    "theme_hunt": Gate((Filter("adtv_20d", 3e8, 3e8),), (("market_cap_used", 1.0),), "rank_top_n", 450, 999, 450),
}
MIN_CAP = {"deep_value": 5e10, "garp": 5e10, "quality_fcf": 5e10, "theme_hunt": 3e11}
#: What a screen adds to or takes from GUARDS: two of them look at companies with losses too.
SCREEN_GUARDS = {s: tuple(g for g in GUARDS if g != "negative_earnings" or s in ("deep_value", "garp")) for s in SCREENS}
#: Sectors that a screen keeps to; None: all.
SCREEN_SECTORS: dict[str, tuple[str, ...] | None] = dict.fromkeys(SCREENS) | {
    "theme_hunt": tuple("AEROSPACE_DEFENSE AUTO CHEM CONSTRUCTION ELECTRONIC_COMP ELEC_EQUIP ENERGY HEALTHCARE_SVC IT_SERVICES MACHINERY NONMETAL_MIN OTHER_MFG PHARMA_BIO SEMI STEEL_METAL TRADING_DISTRIB TRANSPORT_LOGISTICS UTILITIES".split())
}
MAX_RISK_GROUPS = {"deep_value": 2, "garp": 2, "quality_fcf": 2, "theme_hunt": 4}


def resolve(screen: str) -> Gate:
    if screen not in SCREENS:
        raise GuardError(f"no screen {screen}; there are {', '.join(SCREENS)}")
    return SCREENS[screen]


def _reasons(df: DataFrame, flags: list[str], min_cap: float | None, sectors: list[str] | None) -> Column:
    if lack := [f for f in flags if f not in df.columns]:
        raise GuardError(f"guards need columns {', '.join(lack)}")
    out = [F.when(hit(F.col(f)), F.lit(f)) for f in flags]
    if min_cap is not None:
        have = [c for c in ("market_cap_used", "market_cap_total", "market_cap") if c in df.columns]
        if not have:
            raise GuardError("no column with a market capitalisation")
        out.append(F.when(~hit(F.col(have[0]) >= min_cap), F.lit("below_min_market_cap_or_missing")))
    if sectors is not None:
        if "sector_code" not in df.columns:
            raise GuardError("an allow-list of sectors needs sector_code")
        out.append(F.when(~hit(F.col("sector_code").isin(*sectors)), F.lit("sector_not_in_scope")))
    return F.array_compact(F.array(*out))


def guard(df: DataFrame, flags: list[str], min_cap: float | None = None, sectors: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that no guard stops, one row for each ticker and reason). Missing capitalisation stops a row; a missing flag column is an error."""
    marked = df.withColumn("_why", _reasons(df, flags, min_cap, sectors))
    return marked.filter(F.size("_why") == 0).drop("_why"), marked.select("ticker", F.explode("_why").alias("reason"))


def guard_effect(df: DataFrame, flags: list[str]) -> DataFrame:
    """guard, hits, inert in one pass."""
    one = df.agg(*[F.count_if(hit(F.col(f))).alias(f) for f in flags])
    return one.select(F.explode(F.array(*[F.struct(F.lit(f).alias("guard"), F.col(f).alias("hits")) for f in flags])).alias("r")).select("r.guard", "r.hits", (F.col("r.hits") == 0).alias("inert"))


def composite_z(df: DataFrame, weights: tuple[tuple[str, float], ...], name: str = "score") -> DataFrame:
    """Weighted z-scores over all rows. Weight below zero: values of zero or less are missing, and missing gets the largest z, the worst; else missing gets 0. No spread: 0.

    The moments are one aggregate over all rows whose single row becomes literals, so nothing is joined.
    """
    value = {m: F.when(F.col(m) > 0, F.col(m)) if w < 0 else F.col(m) for m, w in weights}
    got = df.agg(*[f(v) for v in value.values() for f in (F.avg, F.stddev_pop, F.max)]).first()
    parts = []
    for k, (m, w) in enumerate(weights):
        mean, spread, top = got[3 * k : 3 * k + 3]
        z = (lambda v: (v - F.lit(mean)) / F.lit(spread)) if spread else (lambda v: F.when(v.isNotNull(), 0.0))  # noqa: B023,E731
        worst = z(F.lit(top)) if w < 0 and spread else F.lit(0.0)
        parts.append(F.coalesce(z(value[m]), worst) * w)
    return df.withColumn(name, reduce(lambda a, b: a + b, parts))


def resolve_target(gate: Gate, max_tokens: int | None = None, tokens_per_row: int = 1) -> int:
    return gate.target if max_tokens is None else min(gate.target, max(1, max_tokens // tokens_per_row))


def _least_most(gate: Gate) -> Column:
    return reduce(F.least, [f.most() for f in gate.filters]) if len(gate.filters) > 1 else gate.filters[0].most()


def tightness(rows: DataFrame, gate: Gate, target: int) -> tuple[float, int]:
    """(t, rows that pass at t) from rows with tau: 0 if few enough pass at 0, 1 if still too many do at 1, else just above the largest t of the row that must go."""
    most = F.col("tau")
    at0, at1 = rows.agg(F.count_if(most >= 0), F.count_if(most >= 1)).first()
    if gate.mode == "fixed":
        return 1.0, at1
    if gate.mode == "rank_top_n" or at0 <= target:
        return 0.0, at0
    if at1 >= target:
        return 1.0, at1
    edge = rows.orderBy(most.desc()).limit(target + 1).agg(F.min("tau")).first()[0]  # bounded by the target
    above = rows.filter(most > edge).agg(F.min("tau"), F.count(F.lit(1))).first()
    return (float(edge) + (float(above[0]) - float(edge)) * 2**-40 if above[1] else 1.0), above[1]


def run(df: DataFrame, gate: Gate, incumbents: DataFrame | None = None, max_tokens: int | None = None, tokens_per_row: int = 1) -> tuple[DataFrame, dict[str, object]]:
    """(survivors with tau, score and rank, manifest). Incumbents are tested at max(0, t - hysteresis), before the ranking and the cap.

    Rows that pass at no tightness go first; the others are kept (memory, then disk) for the few passes over them.
    """
    target = resolve_target(gate, max_tokens, tokens_per_row)
    marked = df.withColumn("tau", _least_most(gate)).filter("tau >= 0").persist()
    t, n = tightness(marked, gate, target)
    passes = F.col("tau") >= t
    rows = marked
    if incumbents is not None and gate.hysteresis:
        held = incumbents.select("ticker").distinct().withColumn("_held", F.lit(True))
        rows = rows.join(held, "ticker", "left")
        passes = passes | (F.col("_held").isNotNull() & (F.col("tau") >= max(0.0, t - gate.hysteresis)))
    ranked = composite_z(rows.filter(passes).drop("_held"), gate.ranking)
    best = ranked.orderBy(F.col("score").desc(), "ticker").limit(gate.cap)
    best = best.withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc(), "ticker")))
    return best, {"t": round(t, 6), "passed": n, "target": target, "converged": abs(n - target) <= gate.tolerance, "thresholds": {f.key: round(f.at(t), 6) for f in gate.filters}}


def drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """ticker and change: what entered and what left between two baskets."""
    a, b = before.select("ticker").distinct(), after.select("ticker").distinct()
    return b.subtract(a).withColumn("change", F.lit("entered")).unionByName(a.subtract(b).withColumn("change", F.lit("left")))
