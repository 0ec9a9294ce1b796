"""More queries: readers, label functions, number formats and joins on values that are made from the driver's tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofia.functions import dates, nulls, text
from asofia.operators import catalysts, documents, gate, periods, pit, prices, themes, universe, verify
from asofia.plans import queries as Q
from asofia.plans.queries import AS_OF, DAY, FACTS, query, t
from asofia.sources import readers


@query(f"WITH {FACTS}, {Q._SEEN} SELECT ticker, element, fiscal_end_date, value, fact_id FROM seen WHERE rn = 1 AND ticker IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')")
def facts_of_tickers(spark, d):
    chosen = t(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("ticker"))
    return pit.facts_asof(Q.facts(spark, d), AS_OF, chosen).select("ticker", "element", "fiscal_end_date", "value", "fact_id")


@query("SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_phone, c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def column_projection(spark, d):
    return nulls.pick(t(spark, d, "customer"), [("c_custkey", "long"), ("c_phone", "string"), ("c_acctbal", "double"), ("c_nationkey", "long")])


@query("""SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, 'the|de|und') AND (contains(x, '%') OR contains(x, '|')) AND length(x) <= 300)[1:40], '#') AS lines FROM documents WHERE text IS NOT NULL""")
def segment_lines(spark, d):
    return t(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.array_join(documents.segment_lines(F.col("text"), "the|de|und"), "#").alias("lines"))


@query("""SELECT p_partkey, lower(regexp_replace(p_type || ' & (' || p_brand || ')', '[()&·\\-\\s]', '', 'g')) AS key, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE trim(p_name) END AS short FROM part""")
def segment_and_short_names(spark, d):
    name = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Major report("), F.col("p_brand"), F.lit(") "))).otherwise(F.col("p_name"))
    return t(spark, d, "part").select("p_partkey", text.segment_key(F.concat("p_type", F.lit(" & ("), F.col("p_brand"), F.lit(")"))).alias("key"), text.short_name(name).alias("short"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN round((o_custkey % 1000 + 0.25) / 100, 6) END AS ratio, CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS expires_at, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey * 1000 AS DOUBLE) END AS total FROM orders""")
def contract_terms(spark, d):
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    ratio = F.when(k % 3 != 0, F.concat(F.lit("매출액 대비(%) | "), (F.col("o_custkey") % 1000 + 0.25).cast("string"), F.lit(" |\n"))).otherwise("")
    end = F.when(k % 5 != 0, F.concat(F.lit("종료일 | "), F.date_format(day, "yyyy-MM-dd"), F.lit(" |\n"))).otherwise("종료일 | - |\n")
    doc = F.concat(F.lit("<계약>\n"), ratio, end, F.lit("계약금액 총액(원) | "), F.format_string("%,d", F.col("o_custkey") * 1000), F.lit(" |"))
    return t(spark, d, "orders").select("o_orderkey", catalysts.contract(doc).alias("c")).select("o_orderkey", F.round("c.ratio", 6).alias("ratio"), "c.expires_at", "c.total")


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE abs(s_acctbal) END AS payout, CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE s_suppkey * 1234567 END AS shares, CASE WHEN s_suppkey % 4 = 1 THEN NULL WHEN s_suppkey % 4 IN (2, 3) THEN -abs(s_acctbal) ELSE abs(s_acctbal) END AS cell, abs(s_acctbal) AS quote FROM supplier""")
def number_formats(spark, d):
    k, grouped = F.col("s_suppkey") % 4, F.format_string("%,.2f", F.abs("s_acctbal"))
    cell = F.when(k == 1, "").when(k == 2, F.concat(F.lit("("), grouped, F.lit("%)"))).when(k == 3, F.concat(F.lit("△"), grouped)).otherwise(F.concat(grouped, F.lit(" %")))
    return t(spark, d, "supplier").select(
        "s_suppkey", text.payout_amount(F.when(k == 1, "N/A").otherwise(grouped)).alias("payout"), text.share_count(F.when(k == 1, "-").otherwise(F.format_string("%,d", F.col("s_suppkey") * 1234567))).alias("shares"),
        text.cell_number(cell).alias("cell"), text.quote_number(F.concat(F.lit(" "), grouped)).alias("quote"),
    )


@query("""SELECT o_orderkey, CASE CAST(o_orderkey % 4 AS INTEGER) WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN last_day(CAST(o_orderdate AS DATE)) WHEN 2 THEN last_day(CAST(o_orderdate AS DATE)) ELSE make_date(year(o_orderdate) - 1, 12, 31) END AS settled FROM orders""")
def settlement_dates(spark, d):
    k, day = F.col("o_orderkey") % 4, F.to_date("o_orderdate")
    said = F.when(k == 0, F.date_format(day, "yyyy'년' MM'월' dd'일'")).when(k == 1, F.date_format(day, "yyyy'년' M'월'")).when(k == 2, F.date_format(day, "yyyy-MM-'32'")).otherwise("-")
    return t(spark, d, "orders").select("o_orderkey", dates.settlement_date(said, day).alias("settled"))


@query("""SELECT CAST(user_id AS VARCHAR) AS ticker, event_id, value AS close, CASE WHEN user_id % 4 <> 0 THEN value * user_id * 100 END AS market_cap_common, CASE WHEN user_id % 4 <> 0 THEN value * (user_id * 100 + CASE WHEN user_id % 3 = 0 THEN 50 ELSE 0 END) END AS market_cap_total FROM events""")
def price_table(spark, d):
    e = t(spark, d, "events").select(F.col("user_id").cast("string").alias("ticker"), "event_id", F.col("value").alias("close"))
    k = F.col("user_id")
    shares = t(spark, d, "events").select("user_id").distinct().filter(k % 4 != 0).select(k.cast("string").alias("ticker"), (k * 100).alias("shares_common"), F.when(k % 3 == 0, F.lit(50).cast("long")).alias("shares_other"))
    return prices.price_table(e, shares).select("ticker", "event_id", "close", "market_cap_common", "market_cap_total")


@query("""SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS ticker, CASE WHEN s_suppkey IS NOT NULL THEN 'C' || s_suppkey END AS corp_code FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def corp_codes(spark, d):
    codes = t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("stock_code"), F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("corp_code"))
    blank = codes.limit(1).select(F.lit(" ").alias("stock_code"), F.lit("unlisted").alias("corp_code"))
    master = t(spark, d, "customer").select(text.ticker6(F.col("c_custkey").cast("string")).alias("ticker"))
    return universe.with_corp_codes(master, codes.unionByName(blank)).select("ticker", "corp_code")


@query("""WITH f AS (SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(year(o_orderdate) AS VARCHAR) AS bsns_year, CASE WHEN o_orderstatus = 'F' THEN 'CFS' ELSE 'OFS' END AS basis, o_orderkey, o_orderpriority <> '5-LOW' AS filled FROM orders)
  SELECT o_orderkey, basis FROM f WHERE filled AND (basis = 'CFS' OR NOT EXISTS (SELECT 1 FROM f g WHERE g.ticker = f.ticker AND g.bsns_year = f.bsns_year AND g.basis = 'CFS' AND g.filled))""")
def filing_fallback(spark, d):
    o = t(spark, d, "orders")
    line = F.struct(F.lit("x").alias("account_id"))
    rows = o.select(F.col("o_custkey").cast("string").alias("ticker"), F.year("o_orderdate").cast("string").alias("bsns_year"), F.lit("11011").alias("reprt_code"), F.when(F.col("o_orderstatus") == "F", "CFS").otherwise("OFS").alias("statement_basis"), "o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.array(line)).otherwise(F.array().cast("array<struct<account_id: string>>")).alias("list"))
    return readers.with_fallback(rows).select("o_orderkey", F.col("statement_basis").alias("basis"))


@query("""WITH f AS (SELECT n_nationkey AS n, y FROM nation, (SELECT unnest([2022, 2023]) AS y)), l AS (SELECT CAST(n AS VARCHAR) AS ticker, y, n FROM f),
  a AS (SELECT ticker, y AS fiscal_year, 'REVENUE' AS element, 'FY' AS period_type, CAST(n * 1000000 + y AS DOUBLE) AS value FROM l UNION ALL SELECT ticker, y - 1, 'REVENUE', 'FY', CAST(n * 900000 + y AS DOUBLE) FROM l
    UNION ALL SELECT ticker, y, 'BORROWINGS_SHORT', 'INSTANT', CASE WHEN n % 2 = 0 THEN CAST(n * 10 + 1 AS DOUBLE) ELSE CAST(n * 10 + 2 AS DOUBLE) END FROM l UNION ALL SELECT ticker, y, 'CAPEX_PPE', 'FY', CAST(n * 7 + n * 5 AS DOUBLE) FROM l WHERE n > 0 UNION ALL SELECT ticker, y, 'NET_INCOME', 'FY', CAST(-n AS DOUBLE) FROM l WHERE n > 0)
  SELECT ticker, fiscal_year, element, period_type, value, make_date(fiscal_year, 12, 31) AS fiscal_end_date, CASE WHEN element = 'REVENUE' AND value >= 0 THEN NULL END AS remark FROM a""")
def normalised_filings(spark, d):
    """Annual payloads of each nation: two accounts of one element, summed outlays, a loss in brackets, blanks and unknown accounts."""
    years = F.explode(F.array(F.lit(2022), F.lit(2023))).alias("y")
    n, y = F.col("n_nationkey"), F.col("y")
    money = lambda c: F.format_string("%,d", c.cast("long"))
    null = F.lit(None).cast("string")

    def line(sj: str, account: str, now, before=null):
        cells = {"rcept_no": F.concat((y + 1).cast("string"), F.lit("0320000001")), "reprt_code": F.lit("11011"), "bsns_year": y.cast("string"), "corp_code": F.lit("c"), "sj_div": F.lit(sj), "account_id": F.lit(account), "thstrm_amount": now, "frmtrm_amount": before, "thstrm_add_amount": null, "frmtrm_add_amount": null, "frmtrm_q_amount": null, "currency": F.lit("KRW")}
        return F.struct(*[c.cast("string").alias(k) for k, c in cells.items()])

    lines = F.array(
        line("IS", "ifrs-full_Revenue", money(n * 1_000_000 + y), money(n * 900_000 + y)), line("BS", "ifrs-full_ShorttermBorrowings", money(n * 10 + 2)), line("BS", "dart_ShortTermBorrowings", F.when(n % 2 == 0, money(n * 10 + 1)).otherwise("-")),
        line("CF", "ifrs-full_PurchaseOfPropertyPlantAndEquipment", F.when(n > 0, F.concat(F.lit("("), money(n * 7), F.lit(")"))).otherwise("")), line("CF", "dart_PurchaseOfStructure", F.when(n > 0, money(n * 5)).otherwise("-")),
        line("IS", "ifrs-full_ProfitLoss", F.when(n > 0, F.concat(F.lit("("), money(n), F.lit(")"))).otherwise("-")), line("IS", "somebody_Else", money(n)), line("XX", "ifrs-full_Assets", money(n)),
    )
    rows = t(spark, d, "nation").select(n, years).select(n.cast("string").alias("ticker"), F.lit("CFS").alias("statement_basis"), F.lit(None).cast("date").alias("reported_at"), null.alias("revision_of"), lines.alias("list"))
    got = periods.normalize_filings(rows)
    return got.select("ticker", "fiscal_year", "element", "period_type", "value", "fiscal_end_date", null.alias("remark"))


_SECU = ("주권", "기타")


@query("""SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS ticker, DATE '2020-01-01' + CAST(s_suppkey AS INTEGER) AS delisting_date, CASE CAST(s_suppkey % 4 AS INTEGER) WHEN 1 THEN 'merged' WHEN 2 THEN 'failed' ELSE 'other' END AS outcome FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey % 7 <> 0""")
def delisting_rows(spark, d):
    k = F.col("s_suppkey")
    raw = t(spark, d, "supplier").select(k.cast("string").alias("ticker"), F.col("s_name").alias("name"), F.when(k % 4 == 0, "기타").otherwise("주권").alias("secu_group"), F.when(k % 7 != 0, F.date_add(F.lit("2020-01-01").cast("date"), k.cast("int"))).alias("delisting_date"), F.when(k % 4 == 1, "피흡수합병 (흡수합병)").when(k % 4 == 2, "감사의견  거절").otherwise("x").alias("reason"))
    return readers.delistings(raw.unionByName(raw)).select("ticker", "delisting_date", "outcome")


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS ticker, element, CASE WHEN element = 'DPS' THEN CASE WHEN s_suppkey % 3 = 0 THEN 0.0 ELSE CAST(s_suppkey * 1000 AS DOUBLE) END ELSE CAST(s_suppkey % 100 AS DOUBLE) + 0.5 END AS value, DATE '2025-03-20' AS reported_at, DATE '2025-03-21' AS available_at FROM supplier, (SELECT unnest(['DPS', 'PAYOUT_RATIO']) AS element)""")
def dividend_facts(spark, d):
    k = F.col("s_suppkey")
    cell = lambda label, kind, v, o: F.struct(F.lit(label).alias("label"), F.lit(kind).alias("stock_kind"), v.alias("value"), F.lit(o).alias("ord"))
    cells = F.array(
        cell("주당 현금배당금(원)", "우선주", F.lit("9,999"), 0), cell("주당 현금배당금(원)", "보통주", F.when(k % 3 == 0, "-").otherwise(F.format_string("%,d", k * 1000)), 1), cell("주당 현금배당금(원)", "보통주", F.lit("1"), 2),
        cell("(연결)현금배당성향(%)", None, F.format_string("%.1f", k % 100 + 0.5), 3), cell("주당액면가액(원)", None, F.lit("500"), 4),
    )
    raw = t(spark, d, "supplier").select(k.cast("string").alias("ticker"), F.lit("20250320000001").alias("rcept_no"), F.explode(cells).alias("c")).select("ticker", "rcept_no", "c.*")
    return readers.dividends(raw).select("ticker", "element", "value", "reported_at", "available_at")


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS ticker, CAST(CASE WHEN s_suppkey % 2 = 0 THEN 48.78 ELSE 33.38 END AS DOUBLE) AS stake FROM supplier WHERE s_suppkey % 5 <> 0""")
def owner_stakes(spark, d):
    k = F.col("s_suppkey")
    row = lambda who, v: F.struct(F.lit(who).alias("holder"), v.cast("string").alias("value"))
    own = F.when(k % 5 != 0, F.lit("17.93")).otherwise("-")
    rows = F.array_compact(F.array(row("a", own), row("b", F.when(k % 5 != 0, F.lit("15.45")).otherwise("-")), F.when((k % 2 == 0) & (k % 5 != 0), row("합 계", F.lit("48.78")))))
    raw = t(spark, d, "supplier").select(k.cast("string").alias("ticker"), F.lit("r").alias("rcept_no"), F.explode(rows).alias("c")).select("ticker", "rcept_no", "c.*")
    return readers.owner_stakes(raw).select("ticker", F.round("stake", 2).alias("stake"))


@query("""WITH a AS (SELECT doc_id, quality, 'one' AS file FROM labels WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, quality, 'two' FROM labels WHERE doc_id % 2 = 1) SELECT CAST(doc_id AS VARCHAR) AS ticker, quality, file FROM a""")
def labels_of_files(spark, d):
    rows = t(spark, d, "labels").select(F.col("doc_id").cast("string").alias("ticker"), "quality", F.when(F.col("doc_id") % 2 == 0, "one").otherwise("two").alias("file"))
    return readers.one_label_each(rows.filter("file = 'one'"), rows.filter("file = 'two'"))


_RULES = {"capital_impairment": "coalesce(eq <= 0, false)", "stale_financials": f"coalesce({DAY} - last > 200, true)", "ttm_incomplete": "coalesce(starts_with(reason, 'incomplete'), false) AND NOT (ni_c IS NULL AND ni_t IS NOT NULL)", "admin_issue": "n % 6 = 2 AND n < 15", "audit_opinion_bad_admin": "n % 6 = 3 AND n < 15", "market_cap_implausible": "coalesce(cap > 2e15, false)",
          "pbr_implausible": "coalesce(cap / nullif(eq, 0) > 200 OR (cap / nullif(eq, 0) > 0 AND cap / nullif(eq, 0) < 0.02), false)", "market_cap_inconsistent": "NOT n < 4 AND coalesce(cap / nullif(eq, 0) > 0 AND cap / nullif(eq, 0) < 0.15 AND cap / nullif(revenue, 0) > 0 AND cap / nullif(revenue, 0) < 0.08, false)"}


@query(f"WITH {Q._LONG} " + " UNION ALL ".join([f"SELECT ticker, '{k}' AS reason FROM p1 WHERE {v}" for k, v in _RULES.items()] + ["SELECT ticker, 'below_min_market_cap_or_missing' FROM p1 WHERE NOT coalesce(cap >= 3e11, false)", "SELECT ticker, 'sector_not_in_scope' FROM p1 WHERE coalesce(sector_code, '') <> 'MACHINERY'"]))
def screen_reasons(spark, d):
    """The screen that hunts themes: its own guards, its sectors, its least capitalisation."""
    s = "theme_hunt"
    return gate.guard(Q.from_facts(spark, d), list(gate.SCREEN_GUARDS[s]), gate.MIN_CAP[s], list(gate.SCREEN_SECTORS[s]))[1]


_FLAG = {"citation_source_mismatch": "cited_as <> src", "sector_conflict": "n % 5 <> 0 AND (theme_id = 'semi' AND n % 5 <> 1 OR theme_id = 'bio' AND n % 5 <> 2)", "sector_unknown": "n % 5 = 0", "share_claim_gap": "abs(actual - claim) > 0.2", "role_downgraded_by_actual": "low", "segment_not_found": "actual IS NULL AND n % 3 = 0 AND len(coalesce(segs, [])) > 0",
         "segment_name_missing": "actual IS NULL AND n % 3 = 0 AND len(coalesce(segs, [])) = 0", "segment_data_unverified": "actual IS NULL AND n % 3 = 1", "segment_data_unavailable": "actual IS NULL AND n % 3 = 2", "role_downgraded": "claimed_low", "core_without_share_evidence": "actual IS NULL AND role = 'core' AND claim = 0"}
_VERDICTS = Q.SQL["verify_assignments"]
_HEAD, _TAIL = _VERDICTS.rsplit("\n  SELECT ticker, theme_id, ", 1)


@query(f"{_HEAD}, out AS (SELECT ticker, theme_id, {_TAIL}), k AS (SELECT 'status' AS kind, status AS name FROM out UNION ALL SELECT 'evidence', share_evidence FROM out WHERE share_evidence IS NOT NULL {' '.join(f'''UNION ALL SELECT 'flag', '{k}' FROM v WHERE ok AND ({c})''' for k, c in _FLAG.items())}) SELECT kind, name, count(*) AS n FROM k GROUP BY 1, 2")
def verification_metrics(spark, d):
    return verify.verification_metrics(Q.verdicts_of_tags(spark, d))


@query("""WITH s AS (SELECT user_id, CAST(max(ts) AS DATE) AS last FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20' GROUP BY 1), c AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker, greatest(coalesce(last + 1, DATE '2024-01-10'), DATE '2024-01-10') AS since FROM customer LEFT JOIN s ON user_id = c_custkey) SELECT * FROM c WHERE since <= DATE '2024-01-20'""")
def prices_to_fetch(spark, d):
    stored = t(spark, d, "events").select(F.col("user_id").cast("string").alias("ticker"), F.to_date("ts").alias("date"))
    return prices.to_fetch(t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("ticker")), stored, date(2024, 1, 20), 10)


_MODEL, _RULE = "some-model", "Assign themes to companies."
_BLOCK = themes.taxonomy_block(Q._THEMES)
_PRINT = themes.fingerprint(_RULE, Q._THEMES)


@query(f"""WITH c AS ({Q.SQL["theme_candidates"]}), i AS (SELECT doc_id, string_agg(theme_id, ', ' ORDER BY rank) AS ids FROM c GROUP BY 1) SELECT 'tag-' || d.doc_id AS custom_id, sha256(substring(sha256(CAST(d.doc_id AS VARCHAR)), 1, 32) || chr(0) || '{_PRINT}' || chr(0) || '{_MODEL}') AS key,
  'candidates: ' || ids || chr(10) || 'ticker: ' || d.doc_id || chr(10) || 'name: ' || chr(10) || 'sector: ' || coalesce(lang, '') || chr(10) || chr(10) || 'business:' || chr(10) || coalesce(text, '') || chr(10) || chr(10) || 'segments:' || chr(10) || chr(10) || chr(10) || 'disclosures:' || chr(10) || coalesce(source, '') AS said FROM documents d JOIN i ON i.doc_id = d.doc_id""")
def batch_requests(spark, d):
    name = F.col("doc_id").cast("string")
    null = F.lit(None).cast("string")
    packs = t(spark, d, "documents").select(name.alias("ticker"), null.alias("name"), F.col("lang").alias("sector_code"), F.col("text").alias("business"), null.alias("segments_text"), F.col("source").alias("disclosures"), F.substring(F.sha2(name, 256), 1, 32).alias("pack_hash"))
    found = Q.theme_candidates(spark, d).select(name.alias("ticker"), "theme_id", "rank")
    got = themes.requests(packs, found, _RULE, Q._THEMES, _MODEL)
    return got.select("custom_id", "key", F.from_json("body", "model string, system string, user string").getField("user").alias("said"))


@query("""SELECT CAST(conv_id AS VARCHAR) || '.' || turn AS ticker, CASE WHEN turn % 4 IN (0, 3) THEN 0 ELSE 1 END AS n, turn % 4 IN (0, 2, 3) AND turn % 4 <> 2 AS abstain, CASE turn % 4 WHEN 0 THEN 'expired' WHEN 3 THEN 'unreadable' END AS error FROM conversations""")
def batch_results(spark, d):
    k = F.col("turn") % 4
    one = F.concat(F.lit('{"assignments": [{"theme_id": "a", "role": "core", "rationale": '), F.to_json(F.array("role")), F.lit('}], "abstain": false}'))
    rows = t(spark, d, "conversations").select(F.concat(F.lit("tag-"), F.col("conv_id").cast("string"), F.lit("."), F.col("turn").cast("string")).alias("custom_id"), F.when(k == 0, "expired").otherwise("succeeded").alias("type"), F.when(k == 3, "{broken").otherwise(one).alias("text"))
    return themes.results(rows).select("ticker", F.size("assignments").alias("n"), "abstain", "error")


def _sql_plain() -> str:
    c = "coalesce(html, '')"
    attributes = """(?:[^>"'']|"[^"]*"|''[^'']*'')*"""
    for pattern, to in (
        (r"(?si)<script(?:\s[^>]*)?>.*?</script\s*>", "' '"), (r"(?si)<style(?:\s[^>]*)?>.*?</style\s*>", "' '"), ("(?s)<!--.*?-->", "' '"), (rf"(?i)</t[dhue]\s*>\s*<t[dhue]\b{attributes}>", "' | '"), (rf"(?i)<(?:br|/tr|/p|/div|/title|/h[1-6]|/li|/table)\b{attributes}>", "chr(10)"), (rf"<[/!?A-Za-z]{attributes}>", "' '"),
    ):
        c = f"regexp_replace({c}, '{pattern}', {to}, 'g')"
    for entity, char in text._ENTITIES:
        c = f"replace({c}, '{entity}', '{char}')"
    for pattern, to in ((r"[ \t\x{00A0}\x{3000}]+", "' '"), (r" *\n *", "chr(10)"), (r"\n{3,}", "chr(10) || chr(10)"), (r"^\s+|\s+$", "''")):
        c = f"regexp_replace({c}, '{pattern}', {to}, 'g')"
    return f"SELECT page_id, {c} AS text FROM pages"


Q.SQL["plain_text"] = _sql_plain()


def loaded() -> bool:
    """Importing this module registers its queries."""
    return True
