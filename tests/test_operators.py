"""Operators on small literal tables, with values worked out by hand, and properties on random ones."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from asofia import schemas
from asofia.functions import dates, nulls, text
from asofia.operators import catalysts, checks, documents, gate, metrics, periods, pit, prices, report, themes, universe, verify
from asofia.sources import readers
from asofia.sources.store import Store
from asofia.streaming import ingest


def one(spark, column, **values):
    from pyspark.sql import Row

    return spark.createDataFrame([Row(**values)]).select(column.alias("v")).first()["v"] if values else spark.range(1).select(column.alias("v")).first()["v"]


def each(spark, f, values, kind="string"):
    return [r["v"] for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, x {kind}").orderBy("k").select(f(F.col("x")).alias("v")).collect()]


FACT = "ticker string, element string, fiscal_year int, fiscal_end_date date, period_type string, period_months int, statement_basis string, reported_at date, available_at date, value double, fact_id string"


def fact(element, year, end, kind, months, reported, value, basis="CFS", ticker="A", n=""):
    return (ticker, element, year, end, kind, months, basis, reported, date.fromordinal(reported.toordinal() + 1), value, f"{ticker}{element}{end}{kind}{reported}{n}")


NI = "NET_INCOME_CONTROLLING"
FILED = [
    fact(NI, 2024, date(2024, 12, 31), "FY", 12, date(2025, 3, 20), 100e9), fact(NI, 2024, date(2024, 3, 31), "CUM", 3, date(2025, 5, 15), 25e9), fact(NI, 2025, date(2025, 3, 31), "CUM", 3, date(2025, 5, 15), 30e9), fact(NI, 2024, date(2024, 12, 31), "FY", 12, date(2025, 8, 1), 90e9),
]


@pytest.mark.parametrize("as_of,want", [(date(2025, 3, 20), None), (date(2025, 3, 21), (100e9, "annual")), (date(2025, 4, 1), (100e9, "annual")), (date(2025, 6, 1), (105e9, "rolled:3m")), (date(2025, 9, 1), (95e9, "rolled:3m"))])
def test_ttm_by_date(spark, as_of, want):
    r = periods.ttm(pit.facts_asof(spark.createDataFrame(FILED, FACT), as_of), NI).first()
    assert (r and (r.ttm, r.reason)) == want


def test_ttm_incomplete(spark):
    quarter = [FILED[2]]
    r = periods.ttm(spark.createDataFrame(quarter, FACT), NI).first()
    assert r.ttm is None and r.reason == "incomplete:prev_fy"
    with pytest.raises(ValueError):
        periods.ttm(spark.createDataFrame(quarter, FACT), "ASSETS")


def test_growth(spark):
    f = [fact("REVENUE", y, date(y, m, 28), k, n, date(y + 1, 3, 1), v, ticker=t) for t, y, m, k, n, v in (("A", 2023, 12, "FY", 12, 100.0), ("A", 2024, 12, "FY", 12, 125.0), ("A", 2025, 3, "CUM", 3, 50.0), ("A", 2025, 6, "CUM", 6, 120.0), ("A", 2026, 3, "CUM", 3, 60.0), ("B", 2023, 12, "FY", 12, -10.0), ("B", 2024, 12, "FY", 12, 100.0))]
    r = {x.ticker: x for x in periods.growth(spark.createDataFrame(f, FACT), "REVENUE").collect()}
    assert r["A"].growth_fy == 0.25 and r["A"].growth_q == pytest.approx(0.2) and not r["A"].turnaround and r["A"].reason == "CFS:"
    assert r["B"].growth_fy is None and r["B"].delta_fy == 110 and r["B"].turnaround and r["B"].reason == "CFS:fy_base_nonpositive|no_cum"


def test_basis_is_never_mixed(spark):
    f = [fact("ASSETS", 2024, date(2024, 12, 31), "INSTANT", None, date(2025, 3, 1), 5.0, "OFS"), fact("ASSETS", 2023, date(2023, 12, 31), "INSTANT", None, date(2024, 3, 1), 4.0, "CFS")]
    assert periods.latest_instant(spark.createDataFrame(f, FACT), "ASSETS").first().value == 4.0
    assert periods.latest_instant(spark.createDataFrame(f[:1], FACT), "ASSETS").first().value == 5.0


def test_later_rows_never_change_the_past(spark):
    base = spark.createDataFrame(FILED, FACT)
    more = base.unionByName(spark.createDataFrame([fact(NI, 2024, date(2024, 12, 31), "FY", 12, date(2025, 12, 1), 1.0)], FACT))
    for day in (date(2025, 4, 1), date(2025, 9, 1)):
        assert sorted(pit.facts_asof(base, day).collect()) == sorted(pit.facts_asof(more, day).collect())
    assert [r.value for r in pit.revision_history(base).filter("revisions > 1").orderBy("revision").collect()] == [100e9, 90e9]


def test_normalize(spark):
    line = lambda **k: {f.name: k.get(f.name) for f in schemas.FILING_LINE}
    rows = [
        line(rcept_no="20250320000001", reprt_code="11011", bsns_year="2024", sj_div="IS", account_id="ifrs-full_RevenueFromSaleOfGoods", thstrm_amount="7", frmtrm_amount="6"), line(rcept_no="20250320000001", reprt_code="11011", bsns_year="2024", sj_div="IS", account_id="ifrs-full_Revenue", thstrm_amount="1,000", frmtrm_amount="(800)"),
        line(rcept_no="20250320000001", reprt_code="11011", bsns_year="2024", sj_div="CF", account_id="dart_PurchaseOfStructure", thstrm_amount="-30", frmtrm_amount="-"), line(rcept_no="20250320000001", reprt_code="11011", bsns_year="2024", sj_div="CF", account_id="ifrs-full_PurchaseOfPropertyPlantAndEquipment", thstrm_amount="20"),
        line(rcept_no="20250320000001", reprt_code="11011", bsns_year="2024", sj_div="BS", account_id="unknown", thstrm_amount="5"),
    ]
    quarter = [line(rcept_no="20250515000001", reprt_code="11013", bsns_year="2025", sj_div="IS", account_id=a, thstrm_amount="9", thstrm_add_amount=x, frmtrm_q_amount="8", frmtrm_add_amount=None) for a, x in (("ifrs-full_Revenue", "300"), ("ifrs-full_ProfitLoss", None))]
    quarter.append(line(rcept_no="20250515000001", reprt_code="11013", bsns_year="2025", sj_div="CF", account_id="ifrs-full_CashFlowsFromUsedInOperatingActivities", thstrm_amount="50", frmtrm_q_amount="40", frmtrm_amount="1"))
    schema = schemas.T.StructType([*schemas.schema(ticker="s", statement_basis="s", reported_at="d", revision_of="s"), schemas.T.StructField("list", schemas.T.ArrayType(schemas.FILING_LINE))])
    got = periods.normalize_filings(spark.createDataFrame([("A", "CFS", None, None, rows), ("A", "CFS", None, None, quarter)], schema)).collect()
    have = {(r.element, r.fiscal_year, r.period_type): (r.value, r.period_months, r.amount_field) for r in got}
    assert have == {
        ("REVENUE", 2024, "FY"): (1000.0, 12, "thstrm_amount"), ("REVENUE", 2023, "FY"): (-800.0, 12, "frmtrm_amount"), ("CAPEX_PPE", 2024, "FY"): (50.0, 12, "thstrm_amount"),
        ("REVENUE", 2025, "CUM"): (300.0, 3, "thstrm_add_amount"), ("CFO", 2025, "CUM"): (50.0, 3, "thstrm_amount"), ("CFO", 2024, "CUM"): (40.0, 3, "frmtrm_q_amount"),
    }
    assert {r.available_at for r in got} == {date(2025, 3, 21), date(2025, 5, 16)} and len({r.fact_id for r in got}) == len(got)


def test_numbers(spark):
    assert each(spark, text.statement_amount, ["1,234", "(5)", "-", "", "0", " 1 2 ", "x", None]) == [1234.0, -5.0, None, None, 0.0, 12.0, None, None]
    assert each(spark, text.event_amount, ["53,500,000,000", "-", "―", "약 1,200원", "abc", "12.5"]) == [5.35e10, None, None, 1200.0, None, 12.5]
    assert each(spark, text.payout_amount, ["25.13", "-", "N/A", "", "1,300"]) == [25.13, None, None, None, 1300.0]
    assert each(spark, text.share_count, ["15,000,000", "-", "x", "3.0"]) == [15_000_000, None, None, 3]
    assert each(spark, text.cell_number, ["12.5%", "(7)", "△3", "x"]) == [12.5, -7.0, -3.0, None]


def test_labels(spark):
    assert each(spark, text.share_class, ["보통주", "우선주", "의결권 있는 주식(우선주)", "의결권 있는 주식", "의결권 없는 주식", "합계", "", None, "보통부", "보톧주"]) == ["common", "other", "other", "common", "other", None, None, None, "common", "common"]
    rows = [("피흡수합병", "a", "merged"), ("상장폐지 신청", "a", "voluntary"), ("심사청구서 미제출", "가스팩", "dissolved"), ("감사의견 거절", "a", "failed"), ("기타", "a", "other"), (None, "나스팩", "dissolved"), ("", "a", "other"), ("존속기간 만료", "a", "dissolved"), ("자본전액잠식", "a", "failed")]
    df = spark.createDataFrame(rows, "reason string, name string, want string").withColumn("got", text.delisting_outcome(F.col("reason"), F.col("name")))
    assert all(r.got == r.want for r in df.collect())
    assert each(spark, text.report_key, ["[기재정정] 단일판매 ", "사업보고서", None]) == ["단일판매", "사업보고서", ""] and each(spark, text.is_amendment, ["[기재정정]x", "x", None]) == [True, False, False]
    assert each(spark, text.parent_ticker, ["005935", "005930", "35", None]) == ["005930", None, None, None] and each(spark, text.ticker6, ["35", "1234567"]) == ["000035", "1234567"]
    assert each(spark, text.short_name, ["보고서(결정)", "보고서"]) == ["결정", "보고서"]


def test_dates(spark):
    df = spark.createDataFrame([("2024-12-31", date(2025, 3, 1)), ("2024년 02월 30일", date(2025, 3, 1)), ("2024년 6월", date(2025, 3, 1)), (None, date(2025, 3, 1))], "s string, r date")
    assert [r[0] for r in df.select(dates.settlement_date(F.col("s"), F.col("r"))).collect()] == [date(2024, 12, 31), date(2024, 2, 29), date(2024, 6, 30), date(2024, 12, 31)]
    assert one(spark, dates.fiscal_end(F.lit(2024), F.lit(9))) == date(2024, 9, 30)
    assert dates.chunks(date(2024, 1, 1), date(2024, 1, 20)) == [(date(2024, 1, 1), date(2024, 1, 14)), (date(2024, 1, 15), date(2024, 1, 20))]


def test_ratio_and_nan(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(nulls.ratio(F.col("a"), F.col("b"))).collect()] == [None, 0.5, None]
    bad = spark.createDataFrame([(float("nan"), "x"), (float("inf"), "y"), (1.0, "z")], "a double, s string")
    assert [r.a for r in nulls.no_nan(bad).collect()] == [None, None, 1.0]


def test_price_and_dividend(spark):
    rows = [(10_000.0, 300.0, 3.0), (11_510.0, 4_000.0, 3.0), (5_990.0, 30.0, 30.0), (5_910.0, 1_809_965_900.0, 1.48), (38_150.0, 5.0, 0.01)]
    df = metrics.add_flags(metrics.derive(spark.createDataFrame([(str(k), *r) for k, r in enumerate(rows)], "ticker string, close double, dps double, div_yield_pct double")), date(2025, 1, 1)).orderBy("ticker").collect()
    assert [(r.dividend_data_impossible, r.price_dividend_inconsistent) for r in df] == [(False, False), (False, True), (True, False), (True, False), (False, False)]


def test_metrics(spark):
    r = metrics.derive(spark.createDataFrame([(1.2e12, 100e9, 1000e9, 150e9, -50e9)], "market_cap_total double, net_income_controlling_ttm double, equity_controlling double, cfo_ttm double, capex_ppe_ttm double")).first()
    assert (r.per, r.pbr, r.fcf) == (12.0, 1.2, 100e9)
    bad = metrics.derive(spark.createDataFrame([("A", 1e12, -50e9)], "ticker string, market_cap_total double, equity_controlling double"))
    r = metrics.add_flags(bad, date(2025, 1, 1)).first()
    assert r.pbr < 0 and r.capital_impairment and r.stale_financials and r.financials_missing and r.fcf is None
    with pytest.raises(metrics.MetricsError):
        metrics.assert_sane(bad, ["per"])


def test_composite_z(spark):
    df = spark.createDataFrame([("a", -2.0, 0.5, 0.0), ("b", 5.0, 0.5, 0.0), ("c", 50.0, 0.5, 0.0)], "ticker string, per double, pbr double, fcf_yield double")
    order = [r.ticker for r in gate.composite_z(df, (("per", -0.4), ("pbr", -0.3), ("fcf_yield", 0.3))).orderBy(F.desc("score"), "ticker").collect()]
    assert order[0] == "b" and order[-1] in "ac"


def naive(rows, filters, target):
    """Bisection over the tightness, the long way."""
    def n(t):
        return [r for r in rows if all(r[f.metric] is not None and (r[f.metric] >= f.at(t) if f.least else r[f.metric] <= f.at(t)) and (not f.positive or r[f.metric] > 0) for f in filters)]

    if len(n(0)) <= target:
        return n(0)
    if len(n(1)) >= target:
        return n(1)
    low = 0.0
    high = 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if len(n(mid)) > target else (low, mid)
    return n(high)


@pytest.mark.parametrize("seed", range(4))
def test_gate_is_the_bisection(spark, seed):
    import random

    rnd = random.Random(seed)
    filters = (gate.Filter("x", 0.0, 1.0), gate.Filter("y", 10.0, 2.0, False, True), gate.Filter("z", 0.3, 0.3))
    rows = [{"ticker": f"{k:03}", "x": rnd.choice([None, rnd.uniform(-0.2, 1.2)]), "y": rnd.uniform(-1, 12), "z": rnd.random()} for k in range(200)]
    for target in (1, 5, 20, 150):
        got, _ = gate.run(spark.createDataFrame(rows, "ticker string, x double, y double, z double"), gate.Gate(filters, (("x", 1.0),), target=target, cap=1000))
        assert sorted(r.ticker for r in got.collect()) == sorted(r["ticker"] for r in naive(rows, filters, target))


def test_gate_and_guard_errors(spark):
    df = spark.createDataFrame([("a", 1.0, True, None)], "ticker string, x double, bad boolean, market_cap_used double")
    with pytest.raises(gate.GuardError):
        gate.guard(df, ["missing"])
    with pytest.raises(gate.GuardError):
        gate.Filter("x", 1, 0)
    good, why = gate.guard(df, ["bad"], 5.0)
    assert good.count() == 0 and sorted(r.reason for r in why.collect()) == ["bad", "below_min_market_cap_or_missing"]
    assert gate.resolve_target(gate.SCREENS["deep_value"], 100, 10) == 10 and set(gate.SCREENS) == {"deep_value", "garp", "quality_fcf", "theme_hunt"}


CHECKED = [("A", "MACHINERY", 3.0, 0.02, 1.0), ("B", "BANK", 9.0, 0.30, 1.0), ("C", "CHEM", 0.5, 0.12, 0.0), ("D", "MACHINERY", None, 0.01, 1.0)]


def test_checks(spark):
    df = spark.createDataFrame(CHECKED, "ticker string, sector_code string, debt_ratio double, roic double, assets double")
    high, low = checks.CATALOG["high_leverage"], checks.CATALOG["low_roic"]
    got = {r.ticker: r for r in checks.risk_groups(checks.apply(df, [high, low]), [high, low]).collect()}
    assert [t for t, r in got.items() if r.high_leverage] == ["A"] and got["A"].n_risk_groups == 2 and got["D"].fired == ["low_roic"]
    assert {r.id: (r.hits, r.unevaluable) for r in checks.report(df, [high, low]).collect()} == {"high_leverage": (1, 1), "low_roic": (2, 0)}
    x, names = checks.compile_expression("max(debt_ratio, roic) / assets - abs(-1)")
    assert names == ["debt_ratio", "roic", "assets"] and [r[0] for r in df.orderBy("ticker").select(x).collect()] == [2.0, 8.0, None, None]
    for text_ in ("__import__('os')", "a.b", "a if b else c", "f(x)", "'s'", "a **"):
        with pytest.raises(checks.CheckError):
            checks.compile_expression(text_)
    with pytest.raises(checks.CheckError):
        checks.override(list(checks.CATALOG.values()), enable=("nothing",))
    assert checks.override([checks.CATALOG["dividend_yield_min"]], enable=("dividend_yield_min",))[0].enabled
    with pytest.raises(checks.CheckError):
        checks.runnable([high], ["roic"], set())
    assert checks.runnable([checks.CATALOG["high_dividend"]], ["div_yield"], set()) == []
    with pytest.raises(checks.CoverageError):
        checks.assert_coverage(df, [checks.Check("g", ">=", 1, metric="debt_ratio", kind="gate_filter", polarity="neutral")])


def test_store(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    f = spark.createDataFrame(FILED, FACT)
    assert s.append_facts(f) == 4 and s.append_facts(f) == 0 and s.read("facts").count() == 4
    row = lambda close: spark.createDataFrame([(date(2025, 1, 2), "A", close)], "date date, ticker string, close double")
    s.upsert("prices", row(1.0))
    s.upsert("prices", row(2.0))
    assert [r.close for r in s.read("prices").collect()] == [2.0]
    assert [r.close for r in Store(spark, str(tmp_path)).read("prices").collect()] == [2.0]


def test_streaming_is_idempotent_and_keeps_late_rows(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame(FILED, FACT)
    for k, part in enumerate((rows.limit(2), rows, rows.filter("value < 30e9"))):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        q = ingest.append_stream(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in/*"), s, "facts", f"{tmp_path}/check")
        q.awaitTermination()
    assert s.read("facts").count() == 4
    e = spark.createDataFrame([("a", "2024-01-01 01:00:00", 1.0), ("a", "2024-01-01 02:00:00", 2.0), ("a", "2024-01-02 02:00:00", 5.0)], "k string, s string, v double").withColumn("ts", F.to_timestamp("s"))
    assert sorted((r.n, r.total) for r in ingest.windowed(e, "ts", "k", "v").collect()) == [(1, 5.0), (2, 3.0)]
    with pytest.raises(ValueError):
        ingest.assert_coverage(8, 10)


def test_listed_and_survivorship(spark):
    day = date(2023, 1, 1)
    master = spark.createDataFrame([("A", date(2000, 1, 1)), ("B", date(2024, 1, 1)), ("N", None)], "ticker string, listing_date date")
    rows = [("C", date(1999, 1, 1), date(2023, 6, 1), "merged"), ("D", date(1999, 1, 1), date(2022, 6, 1), "failed"), ("E", None, date(2024, 1, 1), "failed"), ("A", None, date(2024, 1, 1), "other"), ("F", date(2023, 2, 1), date(2024, 1, 1), "other")]
    gone = spark.createDataFrame(rows, "ticker string, listing_date date, delisting_date date, outcome string")
    assert sorted((r.ticker, r.alive) for r in pit.listed_asof(master, gone, day).collect()) == [("A", True), ("C", False), ("E", False), ("N", True)]
    facts = spark.createDataFrame([("C", date(2022, 1, 1)), ("E", date(2023, 1, 2)), ("A", date(2020, 1, 1)), ("A", date(2021, 1, 1)), ("Z", date(2020, 1, 1))], "ticker string, available_at date")
    r = pit.survivorship(master, gone, facts, day).first()
    assert (r.listed, r.alive, r.gone, r.outcomes, r.with_facts, r.missing, r.coverage) == (4, 2, 2, "failed:1|merged:1", 2, 2, 0.5)  # E's facts came later
    r = pit.survivorship(master.limit(0), gone.limit(0), facts, day).first()
    assert (r.listed, r.outcomes, r.with_facts, r.missing, r.coverage) == (0, "", 0, 0, 0.0)


def test_metrics_from_filed_facts(spark):
    f = spark.createDataFrame(FILED, FACT)
    price = spark.createDataFrame([("A", 70000.0, 1.05e12, 1.2e12, 1.5e7, 5e5, 5e9), ("Z", 1.0, 1e9, None, 1.0, None, None)], "ticker string, close double, market_cap_common double, market_cap_total double, shares_common double, treasury_shares double, adtv_20d double")
    master = spark.createDataFrame([("A", "x", "MACHINERY", False)], "ticker string, name string, sector_code string, is_holding boolean")
    for as_of, per in ((date(2025, 4, 1), 12.0), (date(2025, 6, 1), 1200 / 105), (date(2025, 9, 1), 1200 / 95)):
        got = {r.ticker: r for r in metrics.assemble(pit.facts_asof(f, as_of), price, master, as_of).collect()}
        assert got["A"].per == pytest.approx(per) and not got["A"].financials_missing and got["A"].status_source_missing and not got["A"].admin_issue
        assert got["Z"].financials_missing and got["Z"].stale_financials and got["Z"].unmapped_industry and got["Z"].per is None
    status = spark.createDataFrame([("A", "admin_issue"), ("A", "other"), ("Q", "audit_opinion_bad_admin")], "ticker string, status string")
    got = {r.ticker: r for r in metrics.assemble(pit.facts_asof(f, date(2025, 4, 1)), price, master, date(2025, 4, 1), status).collect()}
    assert got["A"].admin_issue and not got["A"].audit_opinion_bad_admin and not got["A"].status_source_missing and not got["Z"].admin_issue


def test_minority_and_capex_flags(spark):
    rows = [("A", 100.0, 70.0, None, 5.0), ("B", 100.0, 90.0, 3.0, 5.0), ("C", 100.0, None, None, None)]
    df = spark.createDataFrame(rows, "ticker string, equity_total double, equity_controlling double, capex_ppe_ttm double, cfo_ttm double").withColumn("net_income_ttm_total", F.lit(1.0)).withColumn("ttm_reason", F.lit("incomplete:prev_fy"))
    r = {x.ticker: x for x in metrics.add_flags(metrics.derive(df), date(2025, 1, 1)).collect()}
    assert [r[t].minority_interest_large for t in "ABC"] == [True, False, False] and [r[t].capex_unmapped for t in "ABC"] == [True, False, False]
    assert r["C"].equity_fallback_used and r["C"].ni_fallback_used and r["C"].ttm_reason == "fallback:total" and not r["C"].ttm_incomplete


def test_pack_hash_ends_every_part(spark):
    import hashlib

    got = spark.range(1).select(documents.pack_hash(F.lit("A"), F.lit("b"), F.lit(None).cast("string"), F.lit("[]")).alias("h")).first().h
    assert got == hashlib.sha256(b"A\0b\0\0[]\0").hexdigest()[:32]


def test_escalation(spark):
    rows = [(1, [("t", 0.9, "adjacent", 0.1), ("t", 0.8, "core", 0.1), ("t", 0.1, "core", 0.1)], None), (2, [("t", 0.9, "adjacent", 0.9)], None), (3, [("t", 0.9, "adjacent", 0.4), ("u", 0.9, "adjacent", 0.9)], ""), (4, [("t", 0.1, "core", 0.4)], "new"), (5, [("t", 0.7, "core", 0.4)], None), (6, [], None)]
    df = spark.createDataFrame(rows, "k int, assignments array<struct<theme_id: string, confidence: double, role: string, revenue_share_claim: double>>, proposed_new_theme string").withColumn("theme_segment_share", F.create_map(F.lit("t"), F.lit(0.3)))
    assert [r.reason for r in themes.escalate(df).orderBy("k").collect()] == ["core_assignment", "share_mismatch", None, "proposed_new_theme", "low_confidence", None]


def test_quoted_items(spark):
    docs = spark.createDataFrame([(1, "one two three four five"), (2, "x one  two\nthree four"), (3, None), (4, "short"), (5, "twothreefour " * 30)], "doc_id long, text string")
    items = spark.createDataFrame([(10, "two three four"), (11, "two three\tfour five"), (12, "short"), (13, None), (14, "TWO THREE FOUR"), (15, "two three four")], "item_id long, text string")
    want = sorted([(1, 10), (1, 15), (1, 11), (2, 10), (2, 15), (5, 10), (5, 15)])
    for size in (1 << 20, 20):
        assert sorted((r.doc_id, r.item_id) for r in verify.quoted_items(docs, items, pass_bytes=size).collect()) == want
    assert verify.quoted_items(docs, items.limit(0)).collect() == [] and verify.quoted_items(docs.limit(0), items).collect() == []


def test_grams_never_lose_a_citation():
    import random

    rnd = random.Random(8)
    for _ in range(400):
        a = "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(8, 120)))
        b = list(a)
        for _ in range(rnd.randint(0, max(1, len(a) // 9))):
            k = rnd.randrange(len(b) + 1)
            b[k : k + rnd.randint(0, 1)] = rnd.choice(("", "x", "yz"))
        b = "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 60))) + "".join(b) + "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 60)))
        assert verify.cites(a, b) == (verify.partial_ratio(a, b) >= verify.FUZZY)


def test_share_of_segments(spark):
    seg = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(s).alias("share"), F.lit(p).cast("string").alias("path")) for n, s, p in (("Heavy electrics division", 0.5, None), ("Tyres", 0.2, "Goods Tyres Korea"), ("Tyres abroad", 0.3, "Goods Tyres abroad"), ("A", 0.1, None))])
    share = lambda n: spark.range(1).select(documents.share_of(seg, F.lit(n)).alias("s")).first().s
    assert (share("heavy-electrics"), share("Tyres"), share("Goods"), share("A"), share("Tyres Korea"), share("none")) == (0.5, 0.2, None, None, 0.2, None)


def test_prices(spark):
    a = spark.createDataFrame([("A", 100.0), ("B", 100.0), ("C", 100.0)], "ticker string, close double")
    b = spark.createDataFrame([("A", 101.0), ("B", 110.0)], "ticker string, close double")
    assert {r.ticker: (r.compared, r.disagrees, r.close) for r in prices.reconcile(a, b).collect()} == {"A": (True, False, 100.0), "B": (True, True, 100.0), "C": (False, False, 100.0)}
    assert not any(r.compared for r in prices.reconcile(a, None).collect())
    assert prices.probe(a.withColumn("price_date", F.current_date()))["ok"] and not prices.probe(a)["ok"] and not prices.probe(a.filter("close < 0").withColumn("price_date", F.current_date()))["ok"]
    t = prices.price_table(a, spark.createDataFrame([("A", 10, 5), ("B", None, 5)], "ticker string, shares_common long, shares_other long"))
    assert {r.ticker: r.market_cap_total for r in t.collect()} == {"A": 1500.0, "B": None, "C": None}


def piped(*rows):
    return "".join("| " + " | ".join(r) + " |\n\n" for r in rows)


TABLE = "나. 매출 실적\n\n" + piped(("부문", "품목", "당기", "전기"), ("철 강", "강판", "540", "700"), ("목재", "합판", "120", "150"), ("수 산", "냉동", "340", "100"))
SPAN = "나. 매출 실적\n\n" + piped(("(단위 : 백만원)",), ("부문", "유형", "품목", "당기", "전기"), ("과자부", "제조", "비스킷", "700", "650"), ("유통", "사탕", "44", "50"), ("소 계", "744", "700"), ("음료부", "제조", "주스", "400", "300"), ("유통", "생수", "56", "60"), ("소 계", "456", "360"))


def table(*rows, caption="나. 매출실적"):
    return caption + "\n\n" + "\n\n".join("| " + " | ".join(r) + " |" for r in rows) + "\n"


def shares(text, sales=None):
    got = documents.read_segments(text, sales)
    return {s["name"]: round(s["share"], 3) for s in got["segments"]}, got["method"], got["corroborated"]


ROLLED = table(["단위: 백만원"], ["사업부문", "유형", "품목", "2025년", "2024년"], ["사료부", "제품매출", "배합", "600", "500"], ["상품매출", "배합", "20", "30"], ["소 계", "620", "530"], ["육류부", "제품매출", "지육", "300", "310"], ["상품매출", "정육", "80", "70"], ["소 계", "380", "380"])


def test_segment_tables():
    assert shares(ROLLED, 1000e6) == ({"사료부": 0.62, "육류부": 0.38}, "table_amount", True)
    assert shares(ROLLED + "\n| 합 계 | 1,000 | 910 |\n", 1000e6)[0] == {"사료부": 0.62, "육류부": 0.38}  # the grand total is none
    assert shares(ROLLED, 9e12) == ({"사료부": 0.62, "육류부": 0.38}, "table_amount_unverified", False)
    other = ROLLED.replace("나. 매출실적", "나. 판매 가격")
    assert shares(other, 9e12)[0] == {} and shares(other + "\n\n" + ROLLED, 1000e6)[1:] == ("table_amount", True)
    assert shares(ROLLED.replace("나. 매출실적", "나. 매출 및 생산실적"), 1000e6)[0] == {}
    nested = table(["사업부문", "품목", "구분", "2025년"], ["줄자", "줄자", "수출", "550"], ["내수", "110"], ["합 계", "660"], ["압연", "압연", "수출", "340"], ["합 계", "340"])
    assert shares(nested, 1000e6)[0] == {"줄자": 0.66, "압연": 0.34}
    many = table(["사업부문", "구분", "2025년"], ["가부", "수출", "500"], ["합 계", "600"], ["합 계", "100"], ["나부", "수출", "400"], ["합 계", "400"])
    assert shares(many, 1000e6)[0].get("가부") == 0.6  # its first subtotal
    percent = table(["사업부문", "비율"], ["검사부문", "11.0"], ["장비부문", "89.0"])
    one = table(["사업부문", "품목", "구분", "2025년"], ["유압", "실린더", "내수", "300"], ["수출", "200"], ["합 계", "500"])
    assert shares(percent, 1.0) == ({"검사부문": 0.11, "장비부문": 0.89}, "table_pct", False)
    assert shares(one, 500e6) == ({"유압": 1.0}, "table_amount", True) and shares(one, 9e12)[0] == {}
    assert len(shares(one + "\n\n" + percent, 500e6)[0]) == 2


def test_tables_that_are_no_segments():
    for rows in ([["구분", "당사"], ["내수", "91.5"], ["수출", "8.5"]], [["구분", "금액"], ["매출액", "670"], ["매출총이익", "330"]], [["구분", "금액"], ["건물", "600"], ["기계장치", "400"]], [["구분", "금액"], ["가", "9990"], ["나", "1"]], [["구분", "종류", "금액"], ["가", "x", "50"], ["가", "y", "50"]]):
        assert shares(table(*rows), 1000e6)[0] == {}, rows
    assert shares(table(["구분", "당사"], ["가사", "60.0"], ["나사", "40.0"], caption="나. 시장점유율 및 매출"), 100.0)[0] == {}
    assert shares(table(["구분", "비율"], ["전력기기", "65"], ["상품", "11"], ["신재생", "24"]), 1.0)[0] == {"전력기기": 0.65, "상품": 0.11, "신재생": 0.24}


def test_segments_in_prose():
    said = "2023년 매출은 AX 부문이 20조 1,000억원(60.5%), BX 부문이 9조 90억원(30.0%), Nord는 3조 11억원(9.5%)."
    assert shares(said) == ({"AX": 0.605, "BX": 0.3, "Nord": 0.095}, "prose", True)
    grown = "작년의 매출은 900억원으로 전년 대비 12억원, 1.5% 증가하였습니다."
    assert shares(grown)[0] == {}
    assert shares(f"{grown} 매출액은 유리 500억원(55.0%), 타일 250억원(28.0%), 벽돌 150억원(17.0%)이다.")[0] == {"유리": 0.55, "타일": 0.28, "벽돌": 0.17}
    assert shares("로봇사업부문은 연결매출의 71.2%이고, 센서사업부문은 28.8%이다.")[0] == {"로봇": 0.712, "센서": 0.288}
    assert shares("가스 부문이 97% 이상이다.")[0] == {} and shares("")[1] is None
    assert shares("매출은 로봇사업부문 70%, 센서사업부문 30%로 나뉜다.\n\n" + ROLLED.replace("나. 매출실적", "나. 판매 가격"), 1000e6)[1] == "prose"


def test_segments(spark):
    got = documents.read_segments(TABLE, 1000e6)
    shares = {s["name"]: s["share"] for s in got["segments"]}
    assert got["method"] == "table_amount" and got["corroborated"] and shares == {"철강": 0.54, "목재": 0.12, "수산": 0.34}
    assert documents.read_segments(TABLE, 99e12)["method"] == "table_amount_unverified"
    assert documents.read_segments(TABLE.replace("나. 매출 실적", "나. 제품 단가"), 1000e6)["segments"] == []
    for extra in ("", piped(("합 계", "1,200", "1,060"))):
        got = documents.read_segments(SPAN + extra, 1200e6)
        assert {s["name"]: s["share"] for s in got["segments"]} == {"과자부": 0.62, "음료부": 0.38} and got["corroborated"]
    assert documents.read_segments(TABLE.replace("철 강", "내수").replace("수 산", "수출").replace("목재", "국내"), 1000e6)["segments"] == []
    assert documents.read_segments("", None)["segments"] == []
    df = spark.createDataFrame([(TABLE, 1000e6, "철강"), (None, None, "x")], "t string, r double, n string").select(documents.segments("t", "r").alias("s"), "n")
    assert [None if r[0] is None else round(r[0], 3) for r in df.select(documents.share_of(F.col("s.segments"), F.col("n"))).collect()] == [0.54, None]


def test_sections():
    real = "II. 사업의 내용\n1. 사업의 개요\n" + "배를 만든다. " * 50 + "\n2. 주요 제품\n" + "유조선. " * 50
    body, _, skipped = documents.pick_section("\n" + real + "\nIII. 재무에 관한 사항\n표.\nⅡ. 사업의 내용을 참조\n1. 감사 관련\n" + "의견. " * 900)
    assert skipped == 1 and "유조선" in body and "의견" not in body
    cut, dropped = documents.excerpt("1. 사업의 개요\n" + "길다. " * 4000 + "\n2. 생산 설비\n" + "공장. " * 90, 9000)
    assert "사업의 개요" in cut and "공장" not in cut and any("일부만" in d for d in dropped)
    cut, dropped = documents.excerpt("1. 매출 현황\n" + "팔았다. " * 80 + "\n2. 사업의 개요\n" + "길다. " * 4000, 600)
    assert len(cut) <= 600 and dropped == ["사업의 개요"]


def test_contract_document(spark):
    html = '<style>td{width:99%}</style><table><tr><td title="a>b">계약금액 총액(원)</td><td>53,500,000,000</td></tr><tr><td>매출액 대비(%)</td><td>145.42</td></tr><tr><td>종료일</td><td>2029-11-30</td></tr></table>&amp;'
    r = spark.createDataFrame([(html,), (None,)], "h string").select(text.plain_text(F.col("h")).alias("t")).select("t", catalysts.contract(F.col("t")).alias("c")).collect()
    assert r[0].c.ratio == pytest.approx(1.4542) and r[0].c.expires_at == date(2029, 11, 30) and r[0].c.total == 5.35e10 and "width" not in r[0].t and "&amp;" not in r[0].t
    assert r[1].t == "" and r[1].c is None


def test_catalysts(spark):
    rows = [("1", "A", "주요사항보고서(자기주식취득결정)", "B", date(2025, 1, 1), 2.0), ("2", "A", "주요사항보고서(유상증자결정)", "B", date(2025, 2, 1), 1.0), ("3", "B", "주요사항보고서(무상증자결정)", "B", date(2025, 1, 1), None), ("4", None, "주요사항보고서(자기주식취득결정)", "B", date(2025, 1, 1), None), ("5", "C", "주요사항보고서(자기주식취득결정)", "B", date(2025, 1, 1), None)]
    e = readers.disclosures(spark.createDataFrame([(a, b, c, d, str(f).replace("-", ""), g) for a, b, c, d, f, g in rows], "rcept_no string, ticker string, report_nm string, pblntf_ty string, rcept_dt string, raw double"))
    found = catalysts.classify(e)
    assert sorted((r.rcept_no, r.kind) for r in found.collect()) == [("1", "C1"), ("2", "X1"), ("5", "C1")]
    m = spark.createDataFrame([("A", 100.0, -1.0)], "ticker string, market_cap_used double, fcf double")
    got = {r.rcept_no: r for r in catalysts.build(found.withColumn("stated_expiry", F.lit(None).cast("date")), m, catalysts.amendments(e), date(2025, 3, 1)).collect()}
    assert got["1"].magnitude == 0.02 and got["1"].material and not got["1"].no_reversal and not got["1"].numbers_agree and got["1"].confidence == 4
    assert got["2"].magnitude == 0.01 and not got["2"].material and got["2"].no_reversal
    assert got["5"].magnitude is None and not got["5"].numbers_agree and catalysts.keep(catalysts.build(found.withColumn("stated_expiry", F.lit(None).cast("date")), m, catalysts.amendments(e), date(2025, 3, 1))).count() == 2
    digest = report.digest(spark.createDataFrame([], schemas.VERDICT), spark.createDataFrame([], "ticker string, n_risk_groups int, score double"), catalysts.build(found.withColumn("stated_expiry", F.lit(None).cast("date")), m, catalysts.amendments(e), date(2025, 3, 1)))
    assert digest.index("Counter-events") < digest.index("## Events")


def test_partial_ratio():
    assert verify.partial_ratio("abcd", "xxabcdxx") == 100 and verify.partial_ratio("", "a") == 0
    assert verify.partial_ratio("hello world", "say hello wurld now") > 85 and verify.partial_ratio("abc", "xyz") == 0


def brute_ratio(a, b):
    a, b = sorted((a, b), key=len)
    best = 0.0
    for start in range(1 - len(a), len(b)):
        part, row = b[max(0, start) : start + len(a)], [0] * (len(a) + 1)
        for c in part:
            last = 0
            for k, x in enumerate(a):
                last, row[k + 1] = row[k + 1], last + 1 if x == c else max(row[k + 1], row[k])
        best = max(best, 200.0 * row[-1] / (len(a) + len(part)))
    return best


def test_partial_ratio_of_long_quotes():
    import random

    rnd = random.Random(4)
    for n, m in ((65, 65), (70, 90), (80, 71), (66, 130)):
        a, b = ("".join(rnd.choice("abcdé😀") for _ in range(k)) for k in (n, m))
        assert verify.partial_ratio(a, b) == brute_ratio(a, b)


def test_fuzzy_citation_of_whole_turns(spark, tmp_path):
    from asofia.plans.queries import QUERIES

    opening = "the very same opening of forty characters and "
    turns = [opening + "then nothing that is like the other", opening + "73 quokkas jumped by 19 foxy wizards", "zig 5 " * 9 + "then nothing that is like the other", "short one here"]
    spark.createDataFrame([(1, k, "user", x) for k, x in enumerate(turns)], "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.turn: r for r in QUERIES["verify_fuzzy_citation"](spark, str(tmp_path)).collect()}
    bare = ["".join(x.split()) for x in turns]
    assert set(got) == {1, 2, 3} and not got[1].cited
    for k in got:
        assert got[k].similarity == pytest.approx(brute_ratio(bare[k], bare[k - 1]), abs=1e-4)


def test_verdicts(spark):
    cols = "ticker string, theme_id string, role string, confidence double, evidence_source string, cited_as string, known boolean, cited boolean, sector_code string, sector_ok boolean, floor double, actual double, revenue_share_claim double, has_segments boolean, unverified_segments boolean"
    rows = [("a", "t", "core", 0.9, "business", "business", True, True, "SEMI", True, 0.3, 0.72, 0.72, True, False), ("b", "t", "core", 0.9, "business", "segments", True, True, None, None, 0.3, 0.2, 0.7, True, False), ("c", "t", "core", 0.9, "business", None, True, False, "SEMI", True, 0.3, None, 0.0, False, False), ("d", "t", "core", 0.9, "business", "business", False, True, "SEMI", True, None, None, 0.0, False, False), ("e", "t", "core", 0.9, "business", "business", True, True, "SEMI", False, 0.3, None, 0.1, True, False), ("f", "t", "core", 0.9, "business", "business", True, True, "SEMI", True, 0.3, 0.1, 0.1, True, False)]
    got = {r.ticker: r for r in verify.judge(spark.createDataFrame(rows, cols)).collect()}
    assert (got["a"].role, got["a"].status, got["a"].share_evidence) == ("core", "verified", "confirmed")
    assert got["b"].role == "adjacent" and {"citation_source_mismatch:business->segments", "sector_unknown", "share_claim_gap:claim=0.70/actual=0.20"} <= set(got["b"].flags)
    assert got["c"].reject_reason == "hallucinated_citation" and got["d"].reject_reason == "unknown_theme"
    assert got["e"].role == "adjacent" and got["e"].share_evidence == "not_found" and "sector_conflict" in got["e"].flags and got["f"].role == "peripheral"
    assert {(r.kind, r.name): r.n for r in verify.verification_metrics(verify.judge(spark.createDataFrame(rows, cols))).collect()}[("status", "verified")] == 4


def test_merge(spark):
    cols = "ticker string, pos int, theme_id string, role string, confidence double, revenue_share_claim double, evidence_quote string, evidence_source string, segment_name string, rationale string"
    rows = [("a", 0, "t", "adjacent", 0.5, 0.314, "short", "business", "음반", "one"), ("a", 1, "t", "core", 0.4, 0.686, "longer!", "segments", "매니지먼트", "two"), ("a", 2, "t", "peripheral", None, None, "longer2", "business", "음반", "one")]
    r = verify.merge_assignments(spark.createDataFrame(rows, cols)).first()
    assert (r.role, r.confidence, round(r.revenue_share_claim, 6), r.evidence_quote, r.evidence_source, r.segments, r.rationale) == ("core", 0.5, 1.0, "longer!", "segments", ["음반", "매니지먼트"], "one / two")


def test_golden(spark, tmp_path):
    path = tmp_path / "labels.jsonl"
    path.write_text('{"_meta": "x"}\n{"core": ["t1", "t2"], "ticker": "A"}\n{"confidence": "contested", "core": [], "ticker": "B"}\n', encoding="utf-8")
    labels = readers.labels(spark, str(path))
    gold = labels.select("ticker", F.explode_outer("core").alias("theme"))
    predicted = spark.createDataFrame([("A", "t1"), ("A", "t3"), ("Z", "t1")], "ticker string, theme string")
    r = verify.golden_scores(gold, predicted).first()
    assert (r.tp, r.fp, r.fn, r.precision, r.recall) == (1, 1, 1, 0.5, 0.5)
    with pytest.raises(readers.SourceError):
        readers.one_label_each(labels, labels)
    with pytest.raises(ValueError):
        verify.assert_cohort(gold, predicted.filter("ticker = 'Z'"))


def test_taxonomy():
    good = [themes.Theme("one_theme", ("SEMI",), 0.3, ("a", "b"), "a definition that is long enough"), themes.Theme("two_theme", "NOT [SEMI]", None, ("c",), "a definition that is long enough")]
    assert themes.validate(good, {"SEMI", "CHEM"}) == [] and themes.resolve_sectors("NOT [SEMI]", {"SEMI", "CHEM"}) == {"CHEM"}
    bad = [themes.Theme("Bad", ("NOPE",), 2.0, ("a", "b"), "short"), themes.Theme("one_theme", "ANY", None, ("a", "b"), "a definition that is long enough")]
    assert len(themes.validate([*good, *bad], {"SEMI", "CHEM"})) >= 6
    assert themes.taxonomy_block(good) == themes.taxonomy_block(good[::-1])


def test_dividends_and_holders(spark):
    raw = spark.createDataFrame([("A", "20250310000001", "주당 현금배당금(원)", "보통주", "1,300", 0), ("A", "20250310000001", "주당 현금배당금(원)", "우선주", "1,350", 1), ("A", "20250310000001", "(연결)현금배당성향(%)", None, "25.13", 2), ("A", "20250310000001", "현금배당수익률(%)", "보통주", "-", 3)], "ticker string, rcept_no string, label string, stock_kind string, value string, ord int")
    assert {r.element: r.value for r in readers.dividends(raw).collect()} == {"DPS": 1300.0, "PAYOUT_RATIO": 25.13, "DIV_YIELD_REPORTED": 0.0}
    held = spark.createDataFrame([("A", "1", "x", "17.93"), ("A", "1", "y", "15.45"), ("A", "1", "계", "48.78"), ("B", "1", "x", "17.93"), ("B", "1", "y", "15.45"), ("C", "1", "x", "-")], "ticker string, rcept_no string, holder string, value string")
    assert {r.ticker: round(r.stake, 2) for r in readers.owner_stakes(held).collect()} == {"A": 48.78, "B": 33.38}


def test_readers(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "20250101000001.zip", "w") as z:
        z.writestr("other.xml", "x" * 100)
        z.writestr("20250101000001.xml", "<p>본문</p>".encode("euc-kr"))
    assert [(r.rcept_no, r.text) for r in readers.documents(spark, str(tmp_path)).collect()] == [("20250101000001", "본문")]
    page = ("<table><tr><th>회사명</th><th>종목코드</th></tr>" + "<tr><td>가</td><td>000010</td></tr>" * 1200 + "</table>").encode("euc-kr")
    assert len(readers.html_table(page, ("회사명", "종목코드"))) == 1200
    for raw, need in ((page[:500], ("회사명",)), (page, ("없음",)), (page[:3000], ("회사명",))):
        with pytest.raises(readers.SourceError):
            readers.html_table(raw, need)
    readers.save_basket(str(tmp_path / "b.json"), ["B", "A"], "2025-01-01")
    assert readers.load_basket(str(tmp_path / "b.json")) == ({"A", "B"}, "2025-01-01") and readers.load_basket(str(tmp_path / "none.json")) == (set(), None)
    (tmp_path / "old.json").write_text('["A"]')
    assert readers.load_basket(str(tmp_path / "old.json")) == ({"A"}, None)
    (tmp_path / "f.json").write_text('{"status": "900", "message": "x", "list": []}')
    with pytest.raises(Exception, match="status 900"):
        readers.filings(spark, str(tmp_path / "f.json")).collect()


def test_universe(spark):
    rows = [("A", "가홀딩스", "반도체 제조", False, False, date(2000, 1, 1)), ("B", "나", "은행", False, False, date(2024, 1, 1)), ("C", "다스팩", "x", False, True, None), ("D", "라", None, True, False, None)]
    m = spark.createDataFrame(rows, "ticker string, name string, industry string, is_preferred boolean, is_spac boolean, listing_date date")
    assert [r.ticker for r in universe.eligible(m, date(2010, 1, 1)).collect()] == ["A"] and [r.ticker for r in universe.eligible(m, head=1).collect()] == ["A"]
    assert universe.eligible(m, sample=1, seed=3).collect() == universe.eligible(m, sample=1, seed=3).collect() and universe.eligible(m, tickers=["B"]).count() == 1
    got = {r.ticker: r for r in universe.annotate(m, [("반도체", "SEMI"), ("은행", "BANK")]).collect()}
    assert (got["A"].sector_code, got["B"].sector_code, got["D"].sector_code) == ("HOLDING", "BANK", None) and got["B"].is_financial and got["C"].is_spac and got["D"].unmapped_industry
    f = spark.createDataFrame([(*FILED[0], "d1"), (*FILED[3], "d2")], FACT + ", source_doc_id string")
    assert universe.latest_filing(f, date(2025, 4, 1)).first().source_doc_id == "d1" and universe.latest_filing(f, date(2025, 9, 1)).first().source_doc_id == "d2"
    assert universe.available_sources(f, date(2025, 4, 1), {"a": (NI,), "b": ("DPS",)}) == {"a"}


def test_config(tmp_path):
    import json

    from asofia import config

    c = {"checks": [{"id": "x", "op": ">", "threshold": 1, "expr": "a / b", "polarity": "neutral"}], "gate": {"target": 5}, "filters": [{"metric": "per", "loose": 15, "tight": 6, "least": False}], "ranking": [{"metric": "per", "weight": -1}], "events": [{"id": "E", "polarity": "positive", "types": ["B"], "patterns": ["^x"]}]}
    (tmp_path / "c.json").write_text(json.dumps(c))
    c = config.read(str(tmp_path / "c.json"))
    assert config.checks(c)[0].expr == "a / b" and config.gate(c).target == 5 and config.events(c)[0].patterns == ("^x",)
    for bad in ({"id": "x", "op": "~", "threshold": 1, "metric": "a"}, {"id": "x", "op": ">", "threshold": 1, "metric": "a", "nope": 1}, {"id": "x", "op": ">", "threshold": 1, "expr": "f(a)", "polarity": "neutral"}):
        with pytest.raises(checks.CheckError):
            config.checks({"checks": [bad]})
