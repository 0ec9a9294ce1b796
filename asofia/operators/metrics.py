"""Derived metrics, quality flags and the checks that guard them. One wide row a ticker; every part is joined once."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asofia.functions.nulls import hit, ratio, zero
from asofia.operators import periods
from asofia.operators.periods import FLOWS
from asofia.operators.pit import fixed_basis

TAX = 0.22
FIN = ("BANK", "INSURANCE", "SECURITIES", "OTHER_FIN")
INSTANTS = tuple("ASSETS ASSETS_CURRENT BORROWINGS_LONG BORROWINGS_SHORT CASH_AND_EQUIV EQUITY_CONTROLLING EQUITY_TOTAL LIABILITIES_CURRENT".split())
#: Element of a year's report -> column.
ANNUALS = {"DPS": "dps", "DIV_YIELD_REPORTED": "div_yield_pct", "PAYOUT_RATIO": "payout_pct", "DIV_TOTAL_REPORTED": "dividend_total_reported_m", "OWNER_STAKE_PCT": "owner_stake_pct"}
MASTER = tuple("fiscal_month is_financial is_holding is_preferred is_reit is_spac name sector_code".split())
STATUS_FLAGS = ("admin_issue", "audit_opinion_bad_admin")
STALE_DAYS = 200
CAP_LIMIT = 2e15


_TTM = {"NET_INCOME": "net_income_ttm_total"}


class MetricsError(ValueError):
    pass


def fact_pivot(facts: DataFrame) -> DataFrame:
    """One row a ticker from facts that are already as of a date: twelve months of each flow, growth of revenue and operating
    income, the last balances (consolidated before separate), the last annual values (whatever their basis), the last report.

    Partitioned by ticker once: windows and both groupings within it need no further shuffle.
    """
    rows = facts.repartition("ticker")
    flow = periods.flows(rows)
    pick = lambda e, c: F.max_by(c, F.when(F.col("element") == e, 1))
    wide = [pick(e, "ttm").alias(f"{_TTM.get(e, e.lower() + '_ttm')}") for e in sorted(FLOWS)] + [pick("NET_INCOME_CONTROLLING", "ttm_reason").alias("ttm_reason"), pick("CFO", "ttm_reason").alias("cfo_ttm_reason")]
    for short, e in (("rev", "REVENUE"), ("op", "OPERATING_INCOME")):
        wide += [pick(e, c).alias(f"{short}_{c}") for c in [f"{what}_{span}" for what in ("delta", "growth") for span in ("fy", "q")] + ["growth_reason", "turnaround"]]
    flow = flow.groupBy("ticker").agg(*wide)
    balances = fixed_basis(rows.filter((F.col("period_type") == "INSTANT") & F.col("element").isin(*INSTANTS)), ["ticker", "element"])
    order = F.struct("fiscal_end_date", "reported_at", "fact_id")

    def last(e: str, value: str) -> Column:
        return F.max_by(value, F.when((F.col("element") == e) & F.col("value").isNotNull(), order))

    balance = balances.groupBy("ticker").agg(*[last(e, "value").alias(e.lower()) for e in INSTANTS], last("EQUITY_CONTROLLING", "statement_basis").alias("equity_basis"))
    fy = F.col("period_type") == "FY"
    annual = rows.groupBy("ticker").agg(*[F.max_by("value", F.when(fy & (F.col("element") == e) & F.col("value").isNotNull(), order)).alias(c) for e, c in ANNUALS.items()], F.max("reported_at").alias("last_reported"))
    return annual.join(flow, "ticker", "left").join(balance, "ticker", "left")


def assemble(facts: DataFrame, prices: DataFrame, master: DataFrame, as_of: date, status: DataFrame | None = None) -> DataFrame:
    """The derived metrics and flags of every priced ticker. facts: already as of as_of; prices: one row a ticker; status: as of as_of."""
    own = [c for c in "adtv_20d close market_cap_common market_cap_total shares_common".split() if c in prices.columns]
    treasury = [F.col("treasury_shares").alias("shares_treasury")] if "treasury_shares" in prices.columns else []
    wide = prices.select("ticker", *own, *treasury).join(fact_pivot(facts), "ticker", "left")
    kinds = {"name": "string", "sector_code": "string", "fiscal_month": "int"}
    listed = master.select("ticker", *[F.col(c) if c in master.columns else F.lit(None).cast(kinds.get(c, "boolean")).alias(c) for c in MASTER])
    return add_flags(derive(wide).join(listed, "ticker", "left").withColumn("as_of", F.lit(as_of)), as_of, status)


def derive(wide: DataFrame) -> DataFrame:
    """Ratios from a row with flows (*_ttm), balances, prices, shares and dividends; columns that are missing count as null."""
    need = ["net_income_controlling_ttm", "net_income_ttm_total", "operating_income_ttm", "revenue_ttm", "cfo_ttm", "capex_ppe_ttm", "capex_intangible_ttm", *[e.lower() for e in INSTANTS], "market_cap_total", "market_cap_common", "close", "shares_common", "shares_treasury", "dps", "div_yield_pct", "payout_pct", "dividend_total_reported_m", "owner_stake_pct"]
    df = wide.withColumns({c: F.lit(None).cast("double") for c in need if c not in wide.columns})
    c = F.col
    df = df.withColumns({
        "net_income_ttm": F.coalesce("net_income_controlling_ttm", "net_income_ttm_total"), "ni_fallback_used": c("net_income_controlling_ttm").isNull() & c("net_income_ttm_total").isNotNull(), "equity_fallback_used": c("equity_controlling").isNull() & c("equity_total").isNotNull(),
        "equity_used": F.coalesce("equity_controlling", "equity_total"), "market_cap_used": F.coalesce("market_cap_total", "market_cap_common"),
        "net_cash": zero(c("cash_and_equiv")) - zero(c("borrowings_short")) - zero(c("borrowings_long")),
    })
    if "ttm_reason" in df.columns:
        df = df.withColumn("ttm_reason", F.when(c("ni_fallback_used"), "fallback:total").otherwise(c("ttm_reason")))
    if "op_turnaround" in df.columns:  # a base of zero or less is a loss in operating income, missing data in revenue
        df = df.withColumn("turnaround", hit(c("op_turnaround")))
    spent = c("capex_ppe_ttm").isNotNull() | c("capex_intangible_ttm").isNotNull()
    df = df.withColumn("fcf", F.when(spent, c("cfo_ttm") - (zero(F.abs("capex_ppe_ttm")) + zero(F.abs("capex_intangible_ttm")))))
    invested = c("equity_total") - c("net_cash")
    implied = F.when((c("dps") > 0) & (c("div_yield_pct") >= 0.1), c("dps") / (c("div_yield_pct") / 100))
    total = c("dps") * (c("shares_common") - zero(c("shares_treasury")))
    reported = c("dividend_total_reported_m") * 1e6
    cap = c("market_cap_used")
    return df.withColumns({
        "per": ratio(cap, c("net_income_ttm")), "pbr": ratio(cap, c("equity_used")), "per_op": ratio(cap, c("operating_income_ttm")), "psr": ratio(cap, c("revenue_ttm")), "roe": ratio(c("net_income_ttm"), c("equity_used")),
        "fcf_yield": ratio(c("fcf"), cap), "net_cash_to_cap": ratio(c("net_cash"), cap), "net_debt": -c("net_cash"), "op_margin": F.when(c("revenue_ttm") > 0, ratio(c("operating_income_ttm"), c("revenue_ttm"))),
        "liabilities": c("assets") - c("equity_total"), "debt_ratio": ratio(c("assets") - c("equity_total"), c("equity_total")), "current_ratio": ratio(c("assets_current"), c("liabilities_current")),
        "roic": F.when(invested > 0, c("operating_income_ttm") * (1 - TAX) / invested), "accrual_ratio": ratio(c("net_income_ttm") - c("cfo_ttm"), c("assets")), "cfo_to_ni": F.when(c("net_income_ttm") > 0, ratio(c("cfo_ttm"), c("net_income_ttm"))),
        "implied_price_div": implied, "price_divergence": ratio(c("close"), implied), "treasury_ratio": ratio(c("shares_treasury"), c("shares_common")), "div_yield": ratio(c("dps"), c("close")), "payout_ratio": c("payout_pct") / 100,
        "div_yield_reported": c("div_yield_pct") / 100, "owner_stake": c("owner_stake_pct") / 100, "dividend_total_implied": total, "dividend_total_gap": ratio(F.abs(total - reported), reported), "dividend_fcf_cover": ratio(c("fcf"), total),
    })


FLAGS = [
    "capital_impairment", "negative_earnings", "market_cap_implausible", "pbr_implausible", "dividend_data_impossible", "market_cap_inconsistent", "price_dividend_inconsistent", "stale_financials", "financials_missing", "ttm_incomplete", "oneoff_profit_suspect",
    "per_op_divergence", "minority_interest_large", "capex_unmapped", "ni_fallback_used", "equity_fallback_used", "cfs_missing_used_ofs", "non_standard_fiscal_month", "unmapped_industry", "financial_sector", "holding_company",
]


def add_flags(df: DataFrame, as_of: date, status: DataFrame | None = None) -> DataFrame:
    """Hard and soft flags. status (ticker, status), as of as_of, sets the STATUS_FLAGS; without it those that df has are kept, others are
    false, and status_source_missing says so. What a financial company has no meaning for is blanked last."""
    c = F.col
    kinds = {"sector_code": "string", "last_reported": "date", "ttm_reason": "string", "equity_basis": "string", "fiscal_month": "int", "is_holding": "boolean", "dps": "double", "div_yield_pct": "double"}
    have = {n: F.lit(None).cast(k) for n, k in kinds.items() if n not in df.columns}
    df = df.withColumns(have) if have else df
    empty = status is None or status.isEmpty()
    if not empty:
        found = status.filter(F.col("status").isin(*STATUS_FLAGS)).groupBy("ticker").agg(*[F.bool_or(F.col("status") == f).alias(f) for f in STATUS_FLAGS])
        df = df.drop(*STATUS_FLAGS).join(found, "ticker", "left")
    df = df.withColumns({f: hit(c(f)) if f in df.columns else F.lit(False) for f in STATUS_FLAGS} | {"status_source_missing": F.lit(empty)})
    financial = hit(c("is_financial")) if "is_financial" in df.columns else hit(c("sector_code").isin(*FIN))
    impossible = hit(c("div_yield_pct") > 20) | hit(c("dps") > c("close"))
    days = F.datediff(F.lit(as_of), "last_reported")
    minority = ratio(c("equity_total") - c("equity_used"), c("equity_total"))
    flagged = df.withColumns({
        "capital_impairment": hit(c("equity_used") <= 0), "negative_earnings": hit(c("net_income_ttm") <= 0), "market_cap_implausible": hit(c("market_cap_used") > CAP_LIMIT),
        "pbr_implausible": hit((c("pbr") > 200) | ((c("pbr") > 0) & (c("pbr") < 0.02))), "dividend_data_impossible": impossible,
        "market_cap_inconsistent": hit((c("pbr") > 0) & (c("pbr") < 0.15) & (c("psr") > 0) & (c("psr") < 0.08)) & ~financial,
        "price_dividend_inconsistent": hit((c("price_divergence") > 5) | (c("price_divergence") < 0.2)) & ~impossible,
        "stale_financials": F.coalesce(days > STALE_DAYS, F.lit(True)), "financials_missing": c("ttm_reason").isNull(), "ttm_incomplete": hit(c("ttm_reason").startswith("incomplete")),
        "oneoff_profit_suspect": hit(c("net_income_ttm") > 1.5 * c("operating_income_ttm")), "per_op_divergence": hit(ratio(c("per_op"), c("per")) > 3), "minority_interest_large": hit(minority > 0.2),
        "capex_unmapped": c("fcf").isNull() & c("cfo_ttm").isNotNull(), "cfs_missing_used_ofs": hit(c("equity_basis") == "OFS"), "non_standard_fiscal_month": hit(c("fiscal_month") != 12), "unmapped_industry": c("sector_code").isNull(),
        "financial_sector": financial, "holding_company": hit(c("is_holding")), **{f: hit(c(f)) for f in ("is_spac", "is_reit", "is_preferred") if f in df.columns},
    })
    return flagged.withColumns({n: F.when(~c("financial_sector"), c(n)) for n in ("fcf", "fcf_yield", "net_cash", "net_cash_to_cap")})


def defect_counts(df: DataFrame, flags: list[str], computable: list[str]) -> DataFrame:
    """One row: how often each flag is set and how many rows have each metric; a single pass."""
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f)).alias(f) for f in flags], *[F.count(m).alias(f"has_{m}") for m in computable])


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """name, rate: the share of missing values of each column, counted in one pass."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("rate")) for c in columns])).alias("r")).select("r.name", "r.rate")


def assert_sane(df: DataFrame, columns: list[str]) -> None:
    """A metric that no row has is an error, before anything is published."""
    empty = [r["name"] for r in null_rates(df, columns).filter("rate >= 1").collect()]
    if empty:
        raise MetricsError(f"all rows lack {', '.join(sorted(empty))}")
