"""Trailing twelve months and growth from cumulative reports, latest values, normalisation of filings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from asofia.functions.dates import compact_date, fiscal_end
from asofia.functions.text import statement_amount
from asofia.operators.pit import fact_id, fixed_basis

FLOWS = set("CAPEX_INTANGIBLE CAPEX_PPE CFO NET_INCOME NET_INCOME_CONTROLLING OPERATING_INCOME REVENUE".split())
SUMMED = ("CAPEX_PPE", "CAPEX_INTANGIBLE")
_ORDER = ("fiscal_end_date", "reported_at", "fact_id")


def _latest(condition: Column, value: Column) -> Column:
    return F.max_by(F.when(condition, value), F.when(condition, F.struct(*_ORDER)))


def _flow(element: str, strict: bool) -> tuple[str, ...]:
    if strict and element not in FLOWS:
        raise ValueError(f"{element} is no flow")
    return (element,)


def _change(now: Column, before: Column) -> tuple[Column, Column, Column]:
    rate = F.when(before > 0, F.try_divide(now - before, before))
    return rate, now - before, F.coalesce((before <= 0) & (now > 0), F.lit(False))


def flows(facts: DataFrame, elements: Iterable[str] = tuple(sorted(FLOWS))) -> DataFrame:
    """ticker, element: trailing twelve months and growth of every flow in one grouped pass.

    Twelve months: the latest period decides: a year is taken as it is, m months roll last year's figure forward. Growth:
    year on year, and cumulative months on the same months a year before; no rate on a base of zero or less, the delta
    always. Consolidated figures of a ticker's element are never mixed with separate ones.
    """
    key = ["ticker", "element"]
    rows = fixed_basis(facts.filter(F.col("element").isin(*elements) & F.col("period_type").isin("FY", "CUM")), key).withColumn("_m", F.coalesce("period_months", F.lit(12)))
    w = Window.partitionBy(*key)
    y, m = F.col("fiscal_year"), F.col("_m")
    order = F.struct(*_ORDER, y.alias("y"), m.alias("m"))
    fy, cum = m == 12, m < 12
    rows = rows.withColumns({"_l": F.max(order).over(w), "_fy": F.max(F.when(fy, y)).over(w), "_c": F.max(F.when(cum, order)).over(w)})
    parts = rows.groupBy(*key).agg(
        F.min("statement_basis").alias("basis"), F.max("_l.m").alias("m"),
        _latest((y == F.col("_l.y")) & (m == F.col("_l.m")), F.col("value")).alias("now"),
        _latest((y == F.col("_l.y") - 1) & fy, F.col("value")).alias("year_before"),
        _latest((y == F.col("_l.y") - 1) & (m == F.col("_l.m")) & cum, F.col("value")).alias("same_before"),
        _latest(fy & (y == F.col("_fy")), F.col("value")).alias("f1"), _latest(fy & (y == F.col("_fy") - 1), F.col("value")).alias("f0"),
        _latest(cum & (y == F.col("_c.y")) & (m == F.col("_c.m")), F.col("value")).alias("q1"), _latest(cum & (y == F.col("_c.y") - 1) & (m == F.col("_c.m")), F.col("value")).alias("q0"),
    )
    reason = F.when(F.col("m") == 12, "annual").when(F.col("year_before").isNull(), "incomplete:prev_fy").when(F.col("same_before").isNull(), "incomplete:prev_cum").otherwise(F.concat(F.lit("rolled:"), F.col("m").cast("string"), F.lit("m")))
    value = F.when(F.col("m") == 12, F.col("now")).otherwise(F.col("year_before") - F.col("same_before") + F.col("now"))
    rate_f, delta_f, turn_f = _change(F.col("f1"), F.col("f0"))
    rate_q, delta_q, _ = _change(F.col("q1"), F.col("q0"))
    tags = F.array_compact(F.array(
        F.when(F.col("f1").isNull(), "no_fy").when(F.col("f0").isNull(), "no_prev_fy").when(F.col("f0") <= 0, "fy_base_nonpositive"),
        F.when(F.col("q1").isNull(), "no_cum").when(F.col("q0").isNull(), "no_prev_cum").when(F.col("q0") <= 0, "q_base_nonpositive"),
    ))
    return parts.select(
        "ticker", "element", value.alias("ttm"), reason.alias("ttm_reason"), rate_f.alias("growth_fy"), delta_f.alias("delta_fy"), rate_q.alias("growth_q"), delta_q.alias("delta_q"), turn_f.alias("turnaround"),
        F.concat("basis", F.lit(":"), F.array_join(tags, "|")).alias("growth_reason"),
    )


def ttm(facts: DataFrame, element: str, strict: bool = True) -> DataFrame:
    """ticker, ttm, reason of one flow."""
    return flows(facts, _flow(element, strict)).select("ticker", "ttm", F.col("ttm_reason").alias("reason"))


def growth(facts: DataFrame, element: str, strict: bool = True) -> DataFrame:
    """ticker and the growth of one flow."""
    return flows(facts, _flow(element, strict)).select("ticker", "growth_fy", "delta_fy", "growth_q", "delta_q", "turnaround", F.col("growth_reason").alias("reason"))


def latest_annual(facts: DataFrame, element: str) -> DataFrame:
    """The last year's value whatever its basis."""
    rows = facts.filter((F.col("element") == element) & (F.col("period_type") == "FY"))
    return rows.groupBy("ticker").agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.struct(*_ORDER))).alias("value"), F.max(F.when(F.col("value").isNotNull(), F.col("fiscal_end_date"))).alias("fiscal_end_date"))


def latest_instant(facts: DataFrame, element: str) -> DataFrame:
    """The last balance, consolidated before separate."""
    rows = fixed_basis(facts.filter((F.col("element") == element) & (F.col("period_type") == "INSTANT")), ["ticker"])
    return rows.groupBy("ticker").agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.struct(*_ORDER))).alias("value"))


#: Account -> (element, priority); the lowest priority wins, but for SUMMED elements, which add up.
ACCOUNTS: dict[str, tuple[str, int]] = {}
for _element, _ids in {
    "REVENUE": "ifrs-full_Revenue ifrs-full_RevenueFromContractsWithCustomers ifrs-full_RevenueFromSaleOfGoods",
    "OPERATING_INCOME": "dart_OperatingIncomeLoss ifrs-full_ProfitLossFromOperatingActivities",
    "NET_INCOME": "ifrs-full_ProfitLoss",
    "NET_INCOME_CONTROLLING": "ifrs-full_ProfitLossAttributableToOwnersOfParent",
    "ASSETS": "ifrs-full_Assets",
    "ASSETS_CURRENT": "ifrs-full_CurrentAssets",
    "LIABILITIES_CURRENT": "ifrs-full_CurrentLiabilities",
    "EQUITY_TOTAL": "ifrs-full_Equity",
    "EQUITY_CONTROLLING": "ifrs-full_EquityAttributableToOwnersOfParent",
    "CASH_AND_EQUIV": "ifrs-full_CashAndCashEquivalents",
    "BORROWINGS_SHORT": "dart_ShortTermBorrowings ifrs-full_ShorttermBorrowings",
    "BORROWINGS_LONG": "ifrs-full_LongtermBorrowings dart_LongTermBorrowingsGross",
    "CFO": "ifrs-full_CashFlowsFromUsedInOperatingActivities",
    "CAPEX_PPE": "ifrs-full_PurchaseOfPropertyPlantAndEquipment ifrs-full_PurchaseOfPropertyPlantAndEquipmentClassifiedAsInvestingActivities dart_PurchaseOfOtherPropertyPlantAndEquipment dart_PurchaseOfStructure",
    "CAPEX_INTANGIBLE": "ifrs-full_PurchaseOfIntangibleAssetsOtherThanGoodwill ifrs-full_PurchaseOfIntangibleAssetsClassifiedAsInvestingActivities dart_PurchaseOfOtherIntangibleAssets",
}.items():
    ACCOUNTS |= {a: (_element, k) for k, a in enumerate(_ids.split())}
KINDS = dict.fromkeys(("CF", "CIS", "IS"), "CUM") | dict.fromkeys(("BS", "SCE"), "INSTANT")
MONTHS = dict(zip((f"1101{k}" for k in (1, 2, 3, 4)), (12, 6, 3, 9)))


def _lookup(c: Column, values: dict) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), c)


def normalize_filings(filings: DataFrame, lag_days: int = 1, fiscal_month: int = 12) -> DataFrame:
    """Facts from filing payloads: filings has ticker, statement_basis, reported_at, revision_of and list (schemas.FILING).

    Each line gives a current and a prior fact. Quarterly income takes only the accumulated fields, quarterly cash flow
    the accumulated prior quarter. Of several accounts of one element the best priority wins, then the earlier line;
    summed elements add absolute amounts. Lines of unknown accounts, statements or reports give none.
    """
    line = filings.select("ticker", "statement_basis", "reported_at", "revision_of", F.posexplode("list").alias("pos", "r"))
    line = line.select("*", F.trim("r.account_id").alias("account"), F.trim("r.sj_div").alias("sj"), F.trim("r.reprt_code").alias("report"), F.trim("r.rcept_no").alias("doc"))
    line = line.withColumn("element", F.try_element_at(F.create_map(*[F.lit(x) for a, (e, _) in ACCOUNTS.items() for x in (a, e)]), "account")).withColumn("priority", F.try_element_at(F.create_map(*[F.lit(x) for a, (_, p) in ACCOUNTS.items() for x in (a, p)]), "account"))
    line = line.withColumn("kind", F.try_element_at(F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv]), "sj")).withColumn("months", F.try_element_at(F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv]), "report"))
    line = line.withColumn("year", F.col("r.bsns_year").try_cast("int")).withColumn("reported_at", F.coalesce("reported_at", compact_date(F.col("doc"))))
    line = line.filter("element IS NOT NULL AND kind IS NOT NULL AND months IS NOT NULL AND year IS NOT NULL AND reported_at IS NOT NULL")
    plain, income = (F.col("kind") == "INSTANT") | (F.col("months") == 12), F.col("sj").isin("IS", "CIS")
    amount = {n: statement_amount(F.col(f"r.{n}")) for n in ("thstrm_amount", "thstrm_add_amount", "frmtrm_amount", "frmtrm_add_amount", "frmtrm_q_amount")}
    named = lambda n: F.struct(amount[n].alias("value"), F.lit(n).alias("field"))
    now = F.when(plain | ~income, named("thstrm_amount")).otherwise(named("thstrm_add_amount"))
    before = F.when(plain, named("frmtrm_amount")).when(income, named("frmtrm_add_amount")).when(amount["frmtrm_q_amount"].isNotNull(), named("frmtrm_q_amount")).otherwise(named("frmtrm_amount"))
    both = line.withColumn("side", F.explode(F.array(F.struct(F.lit(0).alias("back"), now.alias("x")), F.struct(F.lit(1).alias("back"), before.alias("x"))))).filter("side.x.value IS NOT NULL")
    year = F.col("year") - F.col("side.back")
    both = both.withColumn("fiscal_year", year).withColumn("fiscal_end_date", fiscal_end(year, F.col("months"), fiscal_month))
    both = both.withColumn("period_type", F.when(F.col("kind") == "INSTANT", "INSTANT").when(F.col("months") == 12, "FY").otherwise("CUM"))
    key = ["ticker", "element", "fiscal_year", "fiscal_end_date", "period_type", "months", "statement_basis", "reported_at", "doc", "revision_of"]
    best = F.struct("priority", "pos")
    summed = F.col("element").isin(*SUMMED)
    facts = both.groupBy(*key).agg(F.sum(F.abs("side.x.value")).alias("total"), F.min_by("side.x.value", best).alias("one"), F.min_by("side.x.field", best).alias("amount_field"), F.min_by("r.currency", best).alias("currency"), F.min_by("r.corp_code", best).alias("corp_code"))
    return facts.select(
        fact_id(*[F.col(c) for c in ("ticker", "element", "fiscal_end_date", "period_type", "statement_basis", "doc")]).alias("fact_id"), "ticker", F.lit("KR").alias("market"), "corp_code", "fiscal_year", (F.col("months") / 3).cast("int").alias("fiscal_quarter"), "fiscal_end_date", "period_type",
        F.when(F.col("period_type") != "INSTANT", F.col("months")).alias("period_months"), "reported_at", F.date_add("reported_at", lag_days).alias("available_at"), F.lit(None).cast("timestamp").alias("ingested_at"), "statement_basis", "element",
        F.when(summed, F.col("total")).otherwise(F.col("one")).alias("value"), F.coalesce("currency", F.lit("KRW")).alias("currency"), F.col("doc").alias("source_doc_id"), F.lit(None).cast("string").alias("source_url"), "revision_of", "amount_field",
    )
