"""The command line: every command parses, and the chain from facts to digest runs on a small store."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from asofia import schemas
from asofia.__main__ import main, parser
from asofia.operators import checks, gate, verify
from asofia.sources.store import ConflictError, Store

DAY = "2025-06-30"


@pytest.mark.parametrize(
    "line",
    ["init", "status", "ingest-master", "renormalize", "ingest-dart --year 2025 --quarter 4 --sample 10", f"ingest-prices --as-of {DAY} --with-facts", f"derive --as-of {DAY}", f"screen --as-of {DAY} --target 40", f"enrich --as-of {DAY} --limit 5", f"tag --as-of {DAY}",
     f"verify --as-of {DAY}", f"report --as-of {DAY}", f"golden --as-of {DAY} --allow-cohort-drift", "checks", f"checks --as-of {DAY}", "ingest-dividend --year 2025", "ingest-holder --year 2025", f"probe-price --as-of {DAY}", f"ingest-prices --as-of {DAY} --cross-check other.csv",
     f"screen --as-of {DAY} --preview", f"screen --as-of {DAY} --rebalance", f"screen --as-of {DAY} --enable low_roic --disable low_roe", f"catalysts --as-of {DAY} --all-universe", "ingest-disclosures --begin 2025-01-01", "ingest-delisting", f"survivorship --as-of {DAY}"],
)
def test_commands_parse(line):
    assert callable(parser().parse_args(line.split()).fn)


def filed(ticker, scale):
    """A year, a quarter of it and one of the next, and two balances, of one company."""
    out = []
    flow = {"REVENUE": 1000.0, "OPERATING_INCOME": 120.0, "NET_INCOME": 90.0, "NET_INCOME_CONTROLLING": 80.0, "CFO": 100.0, "CAPEX_PPE": 20.0}
    for e, v in flow.items():
        for year, months, share, reported in ((2023, 12, 0.8, date(2024, 3, 20)), (2024, 3, 0.2, date(2024, 5, 15)), (2024, 12, 1.0, date(2025, 3, 20)), (2025, 3, 0.3, date(2025, 5, 15))):
            out.append((ticker, e, year, months, "FY" if months == 12 else "CUM", reported, v * share * scale))
    for e, v in {"ASSETS": 2000.0, "EQUITY_TOTAL": 1100.0, "EQUITY_CONTROLLING": 1000.0, "ASSETS_CURRENT": 700.0, "LIABILITIES_CURRENT": 400.0, "CASH_AND_EQUIV": 200.0}.items():
        out.append((ticker, e, 2025, 3, "INSTANT", date(2025, 5, 15), v * scale))
    return out


def fill(spark, root):
    s = Store(spark, root)
    rows = [x for k, t in enumerate(("000010", "000020", "000030", "000040")) for x in filed(t, 1e9 * (k + 1))]
    f = spark.createDataFrame(rows, "ticker string, element string, fiscal_year int, period_months int, period_type string, reported_at date, value double")
    end = F.last_day(F.make_date("fiscal_year", "period_months", F.lit(1)))
    f = f.withColumns({"fiscal_end_date": end, "available_at": F.date_add("reported_at", 1), "statement_basis": F.lit("CFS"), "fact_id": F.concat_ws("-", "ticker", "element", "fiscal_year", "period_months"), "source_doc_id": F.concat_ws("-", "ticker", "fiscal_year")})
    assert s.append_facts(f) == f.count() and s.append_facts(f) == 0
    price = [(date(2025, 6, 27), f"0000{k}0", 10_000.0 * k, 10_000_000, 6e8 * 1e3 * k, 1e9) for k in (1, 2, 3, 4)]
    s.upsert("prices", spark.createDataFrame(price, "date date, ticker string, close double, shares_common long, market_cap_common double, adtv_20d double"))
    s.upsert("master", spark.createDataFrame([(f"0000{k}0", f"n{k}", "SEMI" if k < 4 else "BANK", date(2000, 1, 1), False, False, False, False, k == 4) for k in (1, 2, 3, 4)], "ticker string, name string, sector_code string, listing_date date, is_spac boolean, is_reit boolean, is_preferred boolean, is_holding boolean, is_financial boolean"))
    s.upsert("status", spark.createDataFrame([("000030", "admin_issue", date(2025, 1, 1), "r", date(2025, 6, 1))], "ticker string, status string, effective_from date, reason string, snapshot_date date"))
    s.append_disclosures(spark.createDataFrame([("1", "000010", "주요사항보고서(자기주식취득결정)", "B", date(2025, 6, 2), False), ("2", "000020", "other", "I", date(2025, 6, 3), False)], "rcept_no string, ticker string, report_key string, pblntf_ty string, rcept_dt date, is_amendment boolean"))
    return s


def test_from_facts_to_digest(spark, tmp_path, capsys):
    root = str(tmp_path / "store")
    fill(spark, root)
    run = lambda line: (main(["--store", root, *line.split()]), [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")])
    assert run(f"derive --as-of {DAY}")[1][0]["rows"] == 4
    wide = {r.ticker: r for r in spark.read.parquet(f"{root}/out/{DAY}/metrics").collect()}
    assert wide["000010"].net_income_ttm == pytest.approx(80e9 * (1 - 0.2 + 0.3)) and wide["000030"].admin_issue and not wide["000010"].admin_issue and wide["000040"].financial_sector and wide["000040"].fcf is None
    code, said = run(f"screen --as-of {DAY} --screen deep_value --rebalance")
    assert code == 0 and said[0]["universe"] == 4 and "dividend_uncovered" not in said[0]["checks"] and "low_roic" in said[0]["checks"]  # no dividends were ingested
    why = {(r.ticker, r.reason) for r in spark.read.parquet(f"{root}/out/{DAY}/deep_value/why_excluded").collect()}
    assert ("000030", "admin_issue") in why
    code, said = run(f"screen --as-of {DAY} --screen theme_hunt")
    why = {(r.ticker, r.reason) for r in spark.read.parquet(f"{root}/out/{DAY}/theme_hunt/why_excluded").collect()}
    assert ("000040", "sector_not_in_scope") in why
    assert len(run(f"screen --as-of {DAY} --preview")[1]) == len([c for c in checks.of_screen("deep_value") if c.source is None and c.enabled])
    with pytest.raises(checks.CheckError):
        run(f"screen --as-of {DAY} --enable nothing")
    thin = str(tmp_path / "thin")
    spark.read.parquet(f"{root}/out/{DAY}/metrics").drop("admin_issue").write.parquet(thin)
    with pytest.raises(gate.GuardError):  # a guard without its column isn't skipped
        run(f"screen --as-of {DAY} --metrics {thin}")
    spark.read.parquet(f"{root}/out/{DAY}/metrics").drop("roic").write.mode("overwrite").parquet(thin)
    with pytest.raises(checks.CheckError):  # nor a check
        run(f"screen --as-of {DAY} --metrics {thin}")
    assert run(f"catalysts --as-of {DAY} --all-universe")[1][0]["events"] == 0  # no amounts are known
    amounts = tmp_path / "amounts.json"
    amounts.write_text(json.dumps({"rcept_no": "1", "raw": 6e10}))
    assert run(f"catalysts --as-of {DAY} --all-universe --amounts {amounts}")[1][0] == {"events": 1, "whole": 1}
    survivors = spark.read.parquet(f"{root}/out/{DAY}/deep_value/survivors").select("ticker", "sector_code")
    assert survivors.count() > 0
    packs = survivors.select("ticker", "sector_code", F.lit("makes wafers for everyone").alias("business"), F.lit("").alias("segments_text"), F.lit("").alias("disclosures"), F.lit(None).cast(schemas.SEGMENTS).alias("segments"))
    packs.write.parquet(f"{root}/out/{DAY}/deep_value/packs")
    tags, taxonomy, labels = tmp_path / "tags.json", tmp_path / "taxonomy.json", tmp_path / "golden.jsonl"
    one = {"theme_id": "chip_making", "role": "core", "rationale": "r", "evidence_quote": "wafers for everyone", "evidence_source": "business", "revenue_share_claim": 0.0, "confidence": 0.9}
    tickers = sorted(r.ticker for r in survivors.collect())
    tags.write_text("\n".join(json.dumps({"ticker": t, "assignments": [one, one | {"theme_id": "made_up"}]}) for t in tickers))
    taxonomy.write_text(json.dumps({"sectors": ["SEMI", "BANK"], "themes": [{"id": "chip_making", "sectors": ["SEMI"], "floor": 0.3, "keywords": ["wafer"], "definition": "makes chips or what they are made of"}]}))
    labels.write_text("\n".join(json.dumps(x) for x in [{"_meta": "x"}, *({"ticker": t, "core": ["chip_making"]} for t in tickers)]))
    assert run(f"tag --as-of {DAY} --taxonomy {taxonomy}")[1][0]["candidates"] == len(tickers)
    said = run(f"verify --as-of {DAY} --tags {tags} --taxonomy {taxonomy}")[1][0]
    assert said["assignments"] == 2 * len(tickers) and said["hallucinated_citation_rate"] == 0
    rows = run(f"golden --as-of {DAY} --tags {tags} --golden {labels}")[1]
    assert [r["tp"] for r in rows] == [len(tickers)] * 4 + [0, 0, len(tickers)] and [r["fp"] for r in rows] == [len(tickers)] * 2 + [0] * 5
    assert run(f"report --as-of {DAY}")[0] == 0
    text = open(f"{root}/out/{DAY}/deep_value/digest.md").read()
    for part in ("# deep_value 2025-06-30", "Universe 4,", "## chip_making", "no share claimed", "events: C1", "## Counter-events", "Rejected for an unknown theme:", "Golden, before", "a rerun gives another figure", "Not advice"):
        assert part in text, part
    assert run(f"survivorship --as-of {DAY}")[1][0]["with_facts"] == 4


def test_golden_rows(spark):
    labels = spark.createDataFrame([("a", ["x", "y"], "certain", False), ("b", [], "certain", False), ("c", ["x"], "contested", True), ("z", ["x"], "certain", False)], "ticker string, core array<string>, confidence string, evidence_defect boolean")
    tag = lambda theme, role="core": (theme, role)
    tags = spark.createDataFrame([("a", [tag("x"), tag("w"), tag("y", "adjacent")]), ("b", []), ("c", [tag("v")])], "ticker string, assignments array<struct<theme_id: string, role: string>>")
    verdicts = spark.createDataFrame([("a", "x", "core", "verified", "confirmed", []), ("a", "w", "core", "rejected", "unavailable", []), ("c", "v", "core", "verified", "unavailable", ["sector_unknown"])], "ticker string, theme_id string, role string, status string, share_evidence string, flags array<string>")
    got = [(r.tp, r.fp, r.fn, r.stocks, r.correct_abstain, r.reproducible) for r in verify.golden_rows(labels, tags, verdicts).orderBy("place").collect()]
    assert got == [(1, 2, 2, 3, "1/1", True), (1, 1, 1, 2, "1/1", True), (1, 1, 2, 3, "1/1", False), (1, 0, 1, 2, "1/1", False), (1, 0, 2, 3, "1/1", False), (1, 0, 2, 3, "1/1", False), (1, 0, 1, 2, "1/1", False)]


def test_store_parts_and_conflicts(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/s")
    row = lambda *r: spark.createDataFrame(list(r), "date date, ticker string, close double")
    s.upsert("prices", row((date(2025, 1, 2), "A", 1.0), (date(2025, 2, 3), "A", 2.0), (None, "B", 9.0)))
    before = s._manifest("prices", s._latest("prices"))
    s.upsert("prices", row((date(2025, 2, 3), "A", 3.0), (date(2025, 2, 4), "A", 4.0)))
    after = s._manifest("prices", s._latest("prices"))
    assert before["2025-01"] == after["2025-01"] and before["2025-02"] != after["2025-02"]  # other parts are left alone
    assert sorted(r.close for r in s.read("prices").collect()) == [1.0, 3.0, 4.0, 9.0] and [r.close for r in s.read("prices", ["2025-01", "1999-01"]).collect()] == [1.0]
    seen = s._latest("prices")
    s.upsert("prices", row((date(2025, 3, 1), "A", 5.0)))
    with pytest.raises(ConflictError):
        s._switch("prices", seen, {})
    assert s.read("prices").count() == 5
    d = spark.createDataFrame([("1", "later", date(2025, 1, 2)), ("1", "first", date(2025, 1, 1))], "rcept_no string, report_nm string, rcept_dt date")
    assert s.append_disclosures(d) == 1 and s.read("disclosures").first().report_nm == "first"
