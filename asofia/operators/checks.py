"""Configured checks: specs, a safe expression compiler, hits, coverage, previews and risk groups."""

from __future__ import annotations

import ast
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asofia.functions.nulls import hit, ratio
from asofia.operators.gate import Filter
from asofia.operators.metrics import FIN

KINDS = ("soft_flag", "hard_guard", "gate_filter")
OPS = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b}


class CheckError(ValueError):
    pass


class CoverageError(ValueError):
    pass


def compile_expression(text: str) -> tuple[Column, list[str]]:
    """Arithmetic over column names, abs, min and max; divisions by zero are missing. Anything else is an error."""
    names: list[str] = []

    def build(node: ast.AST) -> Column:
        if isinstance(node, ast.Expression):
            return build(node.body)
        if isinstance(node, ast.Name):
            names.append(node.id)
            return F.col(f"`{node.id}`").cast("double")
        if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)) and not isinstance(node.value, bool):
            return F.lit(float(node.value))
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.USub, ast.UAdd)):
            inner = build(node.operand)
            return -inner if isinstance(node.op, ast.USub) else inner
        if isinstance(node, ast.BinOp) and isinstance(node.op, (ast.Add, ast.Sub, ast.Mult, ast.Div)):
            a, b = build(node.left), build(node.right)
            return {ast.Add: lambda: a + b, ast.Sub: lambda: a - b, ast.Mult: lambda: a * b, ast.Div: lambda: ratio(a, b)}[type(node.op)]()
        if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and not node.keywords:
            args = [build(a) for a in node.args]
            if node.func.id == "abs" and len(args) == 1:
                return F.abs(args[0])
            if node.func.id in ("min", "max") and len(args) >= 2:
                known = reduce(lambda a, b: a & b, [a.isNotNull() for a in args])
                return F.when(known, F.least(*args) if node.func.id == "min" else F.greatest(*args))
        raise CheckError(f"not allowed in an expression: {text!r}")

    try:
        return build(ast.parse(text, mode="eval")), list(dict.fromkeys(names))
    except SyntaxError as e:
        raise CheckError(f"not an expression: {text!r}") from e


@dataclass(frozen=True)
class Check:
    id: str
    op: str
    threshold: float
    metric: str | None = None
    expr: str | None = None
    kind: str = "soft_flag"
    polarity: str = "risk"
    risk_group: str | None = None
    exempt: tuple[str, ...] = ()
    source: str | None = None
    enabled: bool = True
    max_missing: float = 0.05
    loose: float | None = None
    tight: float | None = None

    def __post_init__(self) -> None:
        if (self.metric is None) == (self.expr is None):
            raise CheckError(f"{self.id}: either a metric or an expression")
        if self.kind not in KINDS or self.op not in OPS:
            raise CheckError(f"{self.id}: kind {self.kind}, operator {self.op}")
        if self.kind == "gate_filter" and self.metric is None:
            raise CheckError(f"{self.id}: a gate filter needs a metric")
        if self.polarity == "risk" and self.kind == "soft_flag" and not self.risk_group:
            raise CheckError(f"{self.id}: a risk needs its group")

    def value(self) -> tuple[Column, list[str]]:
        return (F.col(f"`{self.metric}`").cast("double"), [self.metric]) if self.metric else compile_expression(self.expr)

    def hits(self) -> Column:
        """Missing is no hit; an exempt sector never is one."""
        found = hit(OPS[self.op](self.value()[0], F.lit(float(self.threshold))))
        return found & ~hit(F.col("sector_code").isin(*self.exempt)) if self.exempt else found


def _c(id: str, what: str, op: str, threshold: float, group: str | None = None, polarity: str = "risk", exempt: tuple = (), source: str | None = None) -> Check:
    named = {"metric": what} if what.isidentifier() else {"expr": what}
    return Check(id, op, threshold, **named, risk_group=group, polarity=polarity, exempt=exempt, source=source)


_DIV, _OWN = "dart_alot_matter", "dart_hyslr_sttus"
CATALOG: dict[str, Check] = {c.id: c for c in (
    _c("accrual_anomaly", "accrual_ratio", ">", 0.1, "cash generation", exempt=FIN), _c("cfo_shortfall", "cfo_to_ni", "<", 0.5, "cash generation", exempt=FIN),
    _c("high_leverage", "debt_ratio", ">", 2, "balance sheet", exempt=(*FIN, "REAL_ESTATE")), _c("low_roic", "roic", "<", 0.05, "profitability", exempt=FIN), _c("low_roe", "roe", "<", 0.05, "profitability"),
    _c("treasury_heavy", "treasury_ratio", ">", 0.05, polarity="positive"), _c("high_dividend", "div_yield", ">=", 0.04, polarity="positive", source=_DIV), _c("no_dividend", "div_yield", "<=", 0, polarity="neutral", source=_DIV),
    _c("dividend_uncovered", "dividend_fcf_cover", "<", 1, "dividend sustainability", source=_DIV), _c("payout_excessive", "payout_ratio", ">", 0.8, "dividend sustainability", source=_DIV),
    _c("yield_from_price_drop", "div_yield - div_yield_reported", ">", 0.02, "dividend sustainability", source=_DIV), _c("dividend_data_inconsistent", "dividend_total_gap", ">", 0.2, polarity="neutral", source=_DIV),
    Check("dividend_yield_min", ">=", 0.04, metric="div_yield", kind="gate_filter", polarity="neutral", enabled=False, loose=0.0, tight=0.04),
    _c("low_current_ratio", "current_ratio", "<", 1, "balance sheet", exempt=FIN), _c("owner_stake_low", "owner_stake", "<", 0.2, "governance", source=_OWN),
    _c("growth_decelerating", "rev_growth_fy - rev_growth_q", ">", 0.15, "growth durability"), _c("op_growth_decelerating", "op_growth_fy - op_growth_q", ">", 0.3, "growth durability"),
    _c("thin_margin", "op_margin", "<", 0.05, "profitability", exempt=FIN), _c("fcf_without_earnings", "fcf_yield - cfo_to_ni", ">", 1, "cash generation", exempt=FIN),
    _c("capex_starved", "capex_ppe_ttm / revenue_ttm", "<", 0.005, "cash generation", exempt=FIN), _c("revenue_shrinking", "rev_growth_fy", "<", -0.05, "growth durability"),
)}


_ALL = "accrual_anomaly high_leverage low_current_ratio owner_stake_low treasury_heavy"
#: The checks of each screen, by id.
SCREEN_CHECKS: dict[str, tuple[str, ...]] = {
    screen: tuple(sorted(f"{_ALL} {more}".split()))
    for screen, more in {
        "deep_value": "cfo_shortfall low_roic low_roe high_dividend no_dividend dividend_uncovered payout_excessive yield_from_price_drop dividend_data_inconsistent dividend_yield_min",
        "garp": "cfo_shortfall growth_decelerating op_growth_decelerating thin_margin high_dividend",
        "quality_fcf": "fcf_without_earnings capex_starved revenue_shrinking low_roic high_dividend dividend_uncovered",
        "theme_hunt": "cfo_shortfall low_roic revenue_shrinking",
    }.items()
}
#: What each source of facts brings.
SOURCES: dict[str, tuple[str, ...]] = {_DIV: ("DPS", "DIV_YIELD_REPORTED", "PAYOUT_RATIO", "DIV_TOTAL_REPORTED"), _OWN: ("OWNER_STAKE_PCT",)}


def of_screen(screen: str) -> list[Check]:
    return [CATALOG[i] for i in SCREEN_CHECKS[screen]]


def override(checks: list[Check], enable: tuple[str, ...] = (), disable: tuple[str, ...] = ()) -> list[Check]:
    """Switches at run time; an unknown id is fatal."""
    known = {c.id for c in checks}
    if unknown := (set(enable) | set(disable)) - known:
        raise CheckError(f"unknown checks: {', '.join(sorted(unknown))}")
    return [replace(c, enabled=(c.enabled or c.id in enable) and c.id not in disable) for c in checks]


def runnable(checks: list[Check], columns: list[str], sources: set[str]) -> list[Check]:
    """Enabled checks whose source is there; one whose columns lack is an error."""
    out = [c for c in checks if c.enabled and (c.source is None or c.source in sources)]
    for c in out:
        if lack := set(c.value()[1]) - set(columns):
            raise CheckError(f"{c.id}: no column {', '.join(sorted(lack))}")
    return out


def gate_filters(checks: list[Check]) -> list[Filter]:
    """Filters that enabled checks of that kind add to a gate."""
    return [Filter(c.metric, c.loose, c.tight) for c in checks if c.kind == "gate_filter" and c.enabled]


def guard_columns(df: DataFrame, checks: list[Check]) -> tuple[DataFrame, list[str]]:
    """df with a column for each enabled check that guards, and their names."""
    hard = [c for c in checks if c.kind == "hard_guard" and c.enabled]
    return apply(df, hard) if hard else df, [c.id for c in hard]


def apply(df: DataFrame, checks: list[Check]) -> DataFrame:
    return df.withColumns({c.id: c.hits() for c in checks})


def report(df: DataFrame, checks: list[Check]) -> DataFrame:
    """id, hits, unevaluable: one pass over all rows."""
    one = df.agg(*[F.struct(F.count_if(c.hits()).alias("h"), F.count_if(c.value()[0].isNull()).alias("u")).alias(c.id) for c in checks])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c.id).alias("id"), F.col(f"`{c.id}`.h").alias("hits"), F.col(f"`{c.id}`.u").alias("unevaluable")) for c in checks])).alias("r")).select("r.*")


def assert_coverage(df: DataFrame, checks: list[Check]) -> None:
    gates = [c for c in checks if c.kind == "gate_filter"]
    if gates:
        n = df.count()
        for r in report(df, gates).collect():
            most = next(c for c in gates if c.id == r["id"]).max_missing
            if n and r["unevaluable"] / n > most:
                raise CoverageError(f"{r['id']}: {r['unevaluable']} of {n} rows can't be evaluated")


def assert_monotone(loose: float, tight: float, op: str) -> None:
    """Tightening must never let more through."""
    if (op in (">", ">=") and tight < loose) or (op in ("<", "<=") and tight > loose):
        raise CheckError(f"{loose} -> {tight} widens {op}")


def risk_groups(df: DataFrame, checks: list[Check]) -> DataFrame:
    """The different groups, not checks, in which a row is hit; and the checks."""
    risky = [c for c in checks if c.polarity == "risk"]
    groups = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(F.col(c.id), F.lit(c.risk_group)) for c in risky]))))
    fired = F.array_compact(F.array(*[F.when(F.col(c.id), F.lit(c.id)) for c in risky]))
    return df.withColumn("risk_groups", groups).withColumn("n_risk_groups", F.size("risk_groups")).withColumn("fired", fired)


def preview(df: DataFrame, check: Check, quantiles: tuple[float, ...] = (0.1, 0.5, 0.9)) -> DataFrame:
    """One row: n, missing, hits and exact quantiles with linear interpolation."""
    v = check.value()[0]
    return df.agg(F.lit(check.id).alias("id"), F.count(F.lit(1)).alias("n"), F.count_if(v.isNull()).alias("missing"), F.count_if(check.hits()).alias("hits"), *[F.percentile(v, q).alias(f"q{int(q * 100)}") for q in quantiles])


@dataclass(frozen=True)
class CheckSet:
    checks: tuple[Check, ...] = field(default_factory=tuple)

    def of(self, kind: str) -> list[Check]:
        return [c for c in self.checks if c.enabled and c.kind == kind]
