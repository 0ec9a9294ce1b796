"""The library's operators on the driver's tables, each beside the SQL that gives the same rows.

Roles: orders are filings (customer, priority and quarter name a fact, later orders revise it), suppliers with their
line items are companies, events are prices and disclosures, parts are instruments, documents and pages are evidence,
labels are golden labels.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from asofia.functions import dates, nulls, text
from asofia.operators import catalysts, checks, documents, gate, metrics, periods, pit, prices, themes, universe, verify
from asofia.operators.report import roll_up
from asofia.sources.store import unseen, upserted
from asofia.streaming import ingest

AS_OF = date(1998, 6, 30)
DAY = "DATE '1998-06-30'"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# facts from orders
def facts(spark: SparkSession, d: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("ticker"), F.col("o_orderpriority").alias("element"), F.last_day(F.make_date(F.year(day), F.quarter(day) * 3, F.lit(1))).alias("fiscal_end_date"), F.lit("INSTANT").alias("period_type"), F.lit("CFS").alias("statement_basis"),
        day.alias("reported_at"), F.date_add(day, 1).alias("available_at"), F.col("o_totalprice").alias("value"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("fact_id"),
    )


FACTS = """facts AS (SELECT CAST(o_custkey AS VARCHAR) AS ticker, o_orderpriority AS element, last_day(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1)) AS fiscal_end_date, 'INSTANT' AS period_type, 'CFS' AS statement_basis,
  CAST(o_orderdate AS DATE) AS reported_at, CAST(o_orderdate AS DATE) + 1 AS available_at, o_totalprice AS value, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS fact_id FROM orders)"""
_SEEN = f"seen AS (SELECT facts.*, row_number() OVER (PARTITION BY element, fiscal_end_date, ticker ORDER BY reported_at DESC, fact_id DESC) AS rn FROM facts WHERE available_at <= {DAY})"


@query(f"WITH {FACTS}, {_SEEN} SELECT ticker, element, fiscal_end_date, reported_at, value, fact_id FROM seen WHERE rn = 1")
def pit_facts_asof(spark, d):
    return pit.facts_asof(facts(spark, d), AS_OF).select("ticker", "element", "fiscal_end_date", "reported_at", "value", "fact_id")


@query("SELECT CAST(user_id AS VARCHAR) AS ticker, arg_max(value, ts) AS close, max(ts) AS ts FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00' GROUP BY user_id")
def pit_latest_price(spark, d):
    p = t(spark, d, "events").select(F.col("user_id").cast("string").alias("ticker"), "ts", F.col("value").alias("close"), "event_id")
    return pit.prices_asof(p, F.lit("2024-01-20 00:00:00").cast("timestamp"), "ts").select("ticker", "close", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query(f"""WITH {FACTS} SELECT ticker, element, fiscal_end_date, reported_at, value, CAST(revision AS INTEGER) AS revision FROM (SELECT facts.*, row_number() OVER (PARTITION BY element, fiscal_end_date, ticker ORDER BY reported_at, fact_id) AS revision,
  count(*) OVER (PARTITION BY element, fiscal_end_date, ticker) AS n FROM facts) WHERE n > 1""")
def pit_revision_history(spark, d):
    return pit.revision_history(facts(spark, d)).filter("revisions > 1").select("ticker", "element", "fiscal_end_date", "reported_at", "value", "revision")


@query(f"""WITH {FACTS}, stored AS (SELECT * FROM facts WHERE available_at <= {DAY}), added AS (SELECT * FROM facts f WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.fact_id = f.fact_id))
  SELECT element, CAST(count(*) FILTER (was) AS BIGINT) AS stored, CAST(count(*) FILTER (NOT was) AS BIGINT) AS added FROM (SELECT element, true AS was FROM stored UNION ALL SELECT element, false FROM added) GROUP BY element""")
def pit_append_idempotent(spark, d):
    f = facts(spark, d)
    stored = f.filter(F.col("available_at") <= F.lit(AS_OF))
    new = unseen(stored, f.unionByName(f), ["fact_id"])
    both = stored.select("element", F.lit(True).alias("was")).unionByName(new.select("element", F.lit(False).alias("was")))
    return both.groupBy("element").agg(F.count_if("was").alias("stored"), F.count_if(~F.col("was")).alias("added"))


_DAILY = "SELECT CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) AS ticker, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS close FROM events WHERE event_type {} GROUP BY 1, 2"


def _daily(spark, d, condition: str) -> DataFrame:
    e = t(spark, d, "events").filter(condition)
    return e.groupBy(F.to_date("ts").alias("date"), F.col("user_id").cast("string").alias("ticker")).agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("close"))


@query(f"""WITH old AS ({_DAILY.format("< 'm'")}), new AS ({_DAILY.format(">= 'm'")}) SELECT * FROM new UNION ALL SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.date = o.date AND n.ticker = o.ticker)""")
def pit_upsert(spark, d):
    return upserted(_daily(spark, d, "event_type < 'm'"), _daily(spark, d, "event_type >= 'm'"), ["date", "ticker"])


@query("""SELECT o_orderkey, substring(sha256(CAST(o_custkey AS VARCHAR) || chr(0) || o_orderpriority || chr(0) || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || chr(0) || 'INSTANT' || chr(0) || 'CFS' || chr(0) || CAST(o_orderkey AS VARCHAR) || chr(0)), 1, 32) AS fact_id FROM orders""")
def fact_id_hash(spark, d):
    o = t(spark, d, "orders")
    return o.select("o_orderkey", pit.fact_id(F.col("o_custkey"), F.col("o_orderpriority"), F.to_date("o_orderdate"), F.lit("INSTANT"), F.lit("CFS"), F.col("o_orderkey")).alias("fact_id"))


_LISTS = """spans AS (SELECT CAST(o_custkey AS VARCHAR) AS ticker, CASE WHEN o_custkey % 10 <> 3 THEN CAST(min(o_orderdate) AS DATE) END AS listing_date, CAST(max(o_orderdate) AS DATE) AS last, CASE o_custkey % 3 WHEN 0 THEN 'merged' WHEN 1 THEN 'failed' ELSE 'other' END AS outcome FROM orders GROUP BY o_custkey),
  delistings AS (SELECT ticker, listing_date, last AS delisting_date, outcome FROM spans WHERE last < DATE '2000-01-01' OR ticker LIKE '%7'), master AS (SELECT ticker, listing_date FROM spans WHERE last >= DATE '2000-01-01'),
  then_ AS (SELECT ticker, true AS alive, listing_date, CAST(NULL AS VARCHAR) AS outcome FROM master WHERE listing_date IS NULL OR listing_date <= {0}
  UNION ALL SELECT ticker, false, listing_date, outcome FROM delistings WHERE delisting_date > {0} AND (listing_date IS NULL OR listing_date <= {0}) AND ticker NOT IN (SELECT ticker FROM master))""".format(DAY)


def _lists(spark, d):
    """Some have no listing date, and some of those listed today are on the list of delistings too."""
    k = F.col("o_custkey")
    s = t(spark, d, "orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last"))
    s = s.select(k.cast("string").alias("ticker"), F.when(k % 10 != 3, F.col("first")).alias("listing_date"), "last", F.when(k % 3 == 0, "merged").when(k % 3 == 1, "failed").otherwise("other").alias("outcome"))
    edge = F.lit(date(2000, 1, 1))
    return s.filter(F.col("last") >= edge).select("ticker", "listing_date"), s.filter((F.col("last") < edge) | F.col("ticker").like("%7")).select("ticker", "listing_date", F.col("last").alias("delisting_date"), "outcome")


@query(f"WITH {_LISTS} SELECT * FROM then_")
def listed_asof(spark, d):
    return pit.listed_asof(*_lists(spark, d), AS_OF).select("ticker", "alive", "listing_date", "outcome")


@query(f"""WITH {_LISTS}, known AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS ticker FROM orders WHERE o_orderpriority = '1-URGENT' AND CAST(o_orderdate AS DATE) + 1 <= {DAY}),
  n AS (SELECT count(*) AS listed, count(*) FILTER (alive) AS alive, count(*) FILTER (NOT alive) AS gone, (SELECT count(*) FROM known WHERE ticker IN (SELECT ticker FROM then_)) AS with_facts FROM then_),
  o AS (SELECT coalesce(string_agg(outcome || ':' || n, '|' ORDER BY outcome), '') AS outcomes FROM (SELECT outcome, count(*) AS n FROM then_ WHERE NOT alive GROUP BY 1))
  SELECT listed, alive, gone, outcomes, with_facts, listed - with_facts AS missing, CASE WHEN listed > 0 THEN round(with_facts / CAST(listed AS DOUBLE), 4) ELSE 0.0 END AS coverage FROM n, o""")
def survivorship_report(spark, d):
    return pit.survivorship(*_lists(spark, d), facts(spark, d).filter("element = '1-URGENT'"), AS_OF)


@query("""SELECT CAST(user_id AS VARCHAR) AS ticker, event_type AS status, CAST(min(ts) AS DATE) AS effective_from, arg_min(props, (ts, props)) AS reason, CAST(max(ts) AS DATE) AS snapshot_date FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY 1, 2""")
def status_asof(spark, d):
    e = t(spark, d, "events").select(F.col("user_id").cast("string").alias("ticker"), F.col("event_type").alias("status"), F.col("ts").alias("effective_from"), F.col("props").alias("reason"), F.to_date("ts").alias("snapshot_date"))
    limit = F.lit("2024-01-15 23:59:59.999999").cast("timestamp")
    return pit.status_asof(e, limit).withColumn("effective_from", F.to_date("effective_from"))


_BASIS = "lines AS (SELECT CAST(l_suppkey AS VARCHAR) AS ticker, l_linestatus AS element, l_returnflag AS basis, CAST(l_shipdate AS DATE) AS shipped, l_extendedprice AS value, l_orderkey, l_linenumber FROM lineitem)"


@query(f"""WITH {_BASIS}, best AS (SELECT *, min(CASE WHEN basis = 'A' THEN 0 ELSE 1 END) OVER (PARTITION BY ticker, element) AS b FROM lines) SELECT ticker, element, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM best WHERE b = CASE WHEN basis = 'A' THEN 0 ELSE 1 END GROUP BY 1, 2""")
def basis_preference(spark, d):
    rows = t(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("ticker"), F.col("l_linestatus").alias("element"), F.col("l_returnflag").alias("basis"), F.col("l_extendedprice").alias("value"))
    return pit.fixed_basis(rows, ["ticker", "element"], "basis", "A").groupBy("ticker", "element").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))


@query(f"WITH {FACTS}, {_SEEN} SELECT ticker, fiscal_end_date, value FROM (SELECT seen.*, row_number() OVER (PARTITION BY ticker ORDER BY (fiscal_end_date, reported_at, fact_id) DESC) AS k FROM seen WHERE rn = 1 AND element = '2-HIGH') WHERE k = 1")
def latest_fact_asof(spark, d):
    return pit.latest_fact_asof(facts(spark, d), AS_OF, "2-HIGH").select("ticker", "fiscal_end_date", "value")


@query("""SELECT o.o_orderkey, u.o_orderkey AS urgent_orderkey, u.o_totalprice AS urgent_price FROM orders o ASOF LEFT JOIN (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2) u ON u.o_custkey = o.o_custkey AND u.o_orderdate <= o.o_orderdate""")
def asof_join_rows(spark, d):
    o = t(spark, d, "orders")
    u = o.filter("o_orderpriority = '1-URGENT'").select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("urgent_orderkey"), F.col("o_totalprice").alias("urgent_price"))
    return pit.asof_join(o.select("o_orderkey", "o_custkey", "o_orderdate"), u, "o_custkey", "o_orderdate", "o_orderdate", ["urgent_orderkey", "urgent_price"], "urgent_orderkey").select("o_orderkey", "urgent_orderkey", "urgent_price")


# periods
def cumulative(spark, d) -> DataFrame:
    """Running totals of a nation's orders within each year, by quarter."""
    o = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    q = o.groupBy(F.col("c_nationkey").cast("string").alias("ticker"), F.year("o_orderdate").alias("fiscal_year"), F.quarter("o_orderdate").alias("q")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"))
    run = F.sum("v").over(Window.partitionBy("ticker", "fiscal_year").orderBy("q")).cast("double")
    end = dates.fiscal_end(F.col("fiscal_year"), F.col("q") * 3)
    return q.select("ticker", F.lit("REVENUE").alias("element"), "fiscal_year", end.alias("fiscal_end_date"), F.when(F.col("q") == 4, "FY").otherwise("CUM").alias("period_type"), (F.col("q") * 3).alias("period_months"), F.lit("CFS").alias("statement_basis"), F.date_add(end, 45).alias("reported_at"), F.date_add(end, 46).alias("available_at"), run.alias("value"), F.concat_ws("-", "ticker", "fiscal_year", "q").alias("fact_id"))


_CUM = f"""q AS (SELECT CAST(c_nationkey AS VARCHAR) AS ticker, year(o_orderdate) AS y, quarter(o_orderdate) AS q, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
  cum AS (SELECT ticker, y, q * 3 AS m, CAST(sum(v) OVER (PARTITION BY ticker, y ORDER BY q) AS DOUBLE) AS value, last_day(make_date(y, q * 3, 1)) AS fe FROM q),
  seen AS (SELECT * FROM cum WHERE fe + 46 <= {DAY}), latest AS (SELECT ticker, arg_max(y, fe) AS y, arg_max(m, fe) AS m FROM seen GROUP BY 1)"""


@query(f"""WITH {_CUM} SELECT l.ticker, CASE WHEN l.m = 12 THEN n.value ELSE f.value - p.value + n.value END AS ttm, CASE WHEN l.m = 12 THEN 'annual' WHEN f.value IS NULL THEN 'incomplete:prev_fy' WHEN p.value IS NULL THEN 'incomplete:prev_cum' ELSE 'rolled:' || l.m || 'm' END AS reason
  FROM latest l JOIN seen n ON n.ticker = l.ticker AND n.y = l.y AND n.m = l.m LEFT JOIN seen f ON f.ticker = l.ticker AND f.y = l.y - 1 AND f.m = 12 LEFT JOIN seen p ON p.ticker = l.ticker AND p.y = l.y - 1 AND p.m = l.m AND l.m < 12""")
def ttm(spark, d):
    return periods.ttm(pit.facts_asof(cumulative(spark, d), AS_OF), "REVENUE")


@query(f"""WITH {_CUM}, fy AS (SELECT ticker, max(y) AS y FROM seen WHERE m = 12 GROUP BY 1), c AS (SELECT ticker, arg_max(y, fe) AS y, arg_max(m, fe) AS m FROM seen WHERE m < 12 GROUP BY 1), tick AS (SELECT DISTINCT ticker FROM seen),
  v AS (SELECT k.ticker, f1.value AS f1, f0.value AS f0, q1.value AS q1, q0.value AS q0 FROM tick k LEFT JOIN fy USING (ticker) LEFT JOIN seen f1 ON f1.ticker = k.ticker AND f1.y = fy.y AND f1.m = 12 LEFT JOIN seen f0 ON f0.ticker = k.ticker AND f0.y = fy.y - 1 AND f0.m = 12
  LEFT JOIN c ON c.ticker = k.ticker LEFT JOIN seen q1 ON q1.ticker = k.ticker AND q1.y = c.y AND q1.m = c.m LEFT JOIN seen q0 ON q0.ticker = k.ticker AND q0.y = c.y - 1 AND q0.m = c.m)
  SELECT ticker, round(CASE WHEN f0 > 0 THEN (f1 - f0) / f0 END, 6) AS growth_fy, round(f1 - f0, 2) AS delta_fy, round(CASE WHEN q0 > 0 THEN (q1 - q0) / q0 END, 6) AS growth_q, round(q1 - q0, 2) AS delta_q, coalesce(f0 <= 0 AND f1 > 0, false) AS turnaround,
  'CFS:' || concat_ws('|', CASE WHEN f1 IS NULL THEN 'no_fy' WHEN f0 IS NULL THEN 'no_prev_fy' WHEN f0 <= 0 THEN 'fy_base_nonpositive' END, CASE WHEN q1 IS NULL THEN 'no_cum' WHEN q0 IS NULL THEN 'no_prev_cum' WHEN q0 <= 0 THEN 'q_base_nonpositive' END) AS reason FROM v""")
def growth(spark, d):
    g = periods.growth(pit.facts_asof(cumulative(spark, d), AS_OF), "REVENUE")
    return g.select("ticker", F.round("growth_fy", 6).alias("growth_fy"), F.round("delta_fy", 2).alias("delta_fy"), F.round("growth_q", 6).alias("growth_q"), F.round("delta_q", 2).alias("delta_q"), "turnaround", "reason")


@query(f"WITH {_CUM} SELECT ticker, arg_max(value, fe) AS value, max(fe) AS fiscal_end_date FROM seen WHERE m = 12 GROUP BY 1")
def latest_annual(spark, d):
    return periods.latest_annual(pit.facts_asof(cumulative(spark, d), AS_OF), "REVENUE")


@query(f"WITH {FACTS}, {_SEEN} SELECT ticker, arg_max(value, (fiscal_end_date, reported_at, fact_id)) AS value FROM seen WHERE rn = 1 AND element = '3-MEDIUM' GROUP BY 1")
def latest_instant(spark, d):
    return periods.latest_instant(pit.facts_asof(facts(spark, d), AS_OF), "3-MEDIUM")


# companies from suppliers
def companies(spark, d) -> DataFrame:
    dec = lambda c, k: F.col(c).cast(f"decimal({k},2)")
    s = t(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.sum(dec("l_extendedprice", 18)).cast("double").alias("revenue_ttm"), F.sum(dec("l_extendedprice", 18) * dec("l_discount", 4)).cast("double").alias("operating_income_ttm"), F.sum(dec("l_extendedprice", 18) * dec("l_tax", 4)).cast("double").alias("ni"),
        F.sum(dec("l_quantity", 18)).cast("double").alias("quantity"), F.to_date(F.max("l_shipdate")).alias("last_reported"), F.count(F.lit(1)).cast("double").alias("lines"),
    )
    c, bal = F.col, F.col("s_acctbal")
    return t(spark, d, "supplier").join(s, c("s_suppkey") == c("l_suppkey"), "left").select(
        c("s_suppkey").cast("string").alias("ticker"), F.when(c("s_nationkey") < 5, "BANK").otherwise("MACHINERY").alias("sector_code"), "revenue_ttm", "operating_income_ttm", F.when(bal > 0, c("ni")).alias("net_income_controlling_ttm"), F.when((bal <= -500) | (bal > -300), c("ni") - bal).alias("net_income_ttm_total"),
        F.when(bal > 500, c("operating_income_ttm") + bal).alias("cfo_ttm"), F.when(bal > 1000, bal).alias("capex_ppe_ttm"), F.lit(None).cast("double").alias("capex_intangible_ttm"), (c("quantity") * 1000).alias("assets"), (c("quantity") * 400 + bal * 1000).alias("equity_total"),
        F.when(bal > 2000, c("quantity") * 300).alias("equity_controlling"), (bal * 10).alias("cash_and_equiv"), F.when(bal < 5000, c("lines") * 100).alias("borrowings_short"), F.lit(None).cast("double").alias("borrowings_long"), (c("quantity") * 500).alias("assets_current"), F.when(bal > 0, c("lines") * 200).alias("liabilities_current"),
        F.when(bal > -500, c("lines") * 20000 + bal).alias("market_cap_total"), (c("lines") * 9000).alias("market_cap_common"), (c("lines") + 10).alias("close"), F.lit(1000.0).alias("shares_common"), F.when(bal > 3000, F.lit(60.0)).alias("shares_treasury"), F.when(bal > 1500, bal / 1000).alias("dps"), F.when(bal > 1500, c("quantity") / 10000).alias("div_yield_pct"),
        "last_reported", F.when(bal > 0, "annual").when(bal > -500, "incomplete:prev_fy").alias("ttm_reason"), (bal < -800).alias("admin_issue"), (c("revenue_ttm") / 100 + bal).alias("adtv_20d"),
    )


_COMPANIES = """s AS (SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue_ttm, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * CAST(l_discount AS DECIMAL(4, 2))) AS DOUBLE) AS op, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * CAST(l_tax AS DECIMAL(4, 2))) AS DOUBLE) AS ni,
  CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity, CAST(max(l_shipdate) AS DATE) AS last_reported, CAST(count(*) AS DOUBLE) AS lines FROM lineitem GROUP BY 1),
  w AS (SELECT CAST(s_suppkey AS VARCHAR) AS ticker, CASE WHEN s_nationkey < 5 THEN 'BANK' ELSE 'MACHINERY' END AS sector_code, revenue_ttm, op AS operating_income_ttm, CASE WHEN s_acctbal > 0 THEN ni END AS ni_c, CASE WHEN s_acctbal <= -500 OR s_acctbal > -300 THEN ni - s_acctbal END AS ni_t, CASE WHEN s_acctbal > 500 THEN op + s_acctbal END AS cfo_ttm,
  CASE WHEN s_acctbal > 1000 THEN s_acctbal END AS capex_ppe_ttm, quantity * 1000 AS assets, quantity * 400 + s_acctbal * 1000 AS equity_total, CASE WHEN s_acctbal > 2000 THEN quantity * 300 END AS equity_controlling, s_acctbal * 10 AS cash, CASE WHEN s_acctbal < 5000 THEN lines * 100 END AS short, quantity * 500 AS assets_current,
  CASE WHEN s_acctbal > 0 THEN lines * 200 END AS liabilities_current, CASE WHEN s_acctbal > -500 THEN lines * 20000 + s_acctbal END AS cap_total, lines * 9000 AS cap_common, lines + 10 AS close, CASE WHEN s_acctbal > 3000 THEN 60.0 END AS treasury, CASE WHEN s_acctbal > 1500 THEN s_acctbal / 1000 END AS dps,
  CASE WHEN s_acctbal > 1500 THEN quantity / 10000 END AS div_yield_pct, last_reported, CASE WHEN s_acctbal <= 0 AND (s_acctbal <= -500 OR s_acctbal > -300) AND ni IS NOT NULL THEN 'fallback:total' WHEN s_acctbal > 0 THEN 'annual' WHEN s_acctbal > -500 THEN 'incomplete:prev_fy' END AS ttm_reason, s_acctbal < -800 AS admin_issue, revenue_ttm / 100 + s_acctbal AS adtv_20d FROM supplier LEFT JOIN s ON s_suppkey = l_suppkey),
  x AS (SELECT *, coalesce(ni_c, ni_t) AS net_income_ttm, coalesce(equity_controlling, equity_total) AS equity_used, coalesce(cap_total, cap_common) AS cap, CASE WHEN capex_ppe_ttm IS NOT NULL THEN cfo_ttm - (coalesce(abs(capex_ppe_ttm), 0) + 0) END AS fcf, coalesce(cash, 0) - coalesce(short, 0) - 0 AS net_cash FROM w),
  m AS (SELECT *, cap / nullif(net_income_ttm, 0) AS per, cap / nullif(equity_used, 0) AS pbr, cap / nullif(operating_income_ttm, 0) AS per_op, cap / nullif(revenue_ttm, 0) AS psr, net_income_ttm / nullif(equity_used, 0) AS roe, fcf / nullif(cap, 0) AS fcf_yield, net_cash / nullif(cap, 0) AS net_cash_to_cap,
  CASE WHEN revenue_ttm > 0 THEN operating_income_ttm / revenue_ttm END AS op_margin, (assets - equity_total) / nullif(equity_total, 0) AS debt_ratio, assets_current / nullif(liabilities_current, 0) AS current_ratio, CASE WHEN equity_total - net_cash > 0 THEN operating_income_ttm * (1 - 0.22) / (equity_total - net_cash) END AS roic,
  (net_income_ttm - cfo_ttm) / nullif(assets, 0) AS accrual_ratio, CASE WHEN net_income_ttm > 0 THEN cfo_ttm / net_income_ttm END AS cfo_to_ni, CASE WHEN dps > 0 AND div_yield_pct >= 0.1 THEN close / nullif(dps / (div_yield_pct / 100), 0) END AS price_divergence, treasury / 1000.0 AS treasury_ratio, dps / nullif(close, 0) AS div_yield,
  fcf / nullif(dps * (1000.0 - coalesce(treasury, 0)), 0) AS dividend_fcf_cover FROM x)"""
RATIOS = ("per", "pbr", "per_op", "psr", "roe", "fcf_yield", "net_cash_to_cap", "op_margin", "debt_ratio", "current_ratio", "roic", "accrual_ratio", "cfo_to_ni", "price_divergence", "treasury_ratio", "div_yield", "dividend_fcf_cover")


def wide(spark, d) -> DataFrame:
    return metrics.derive(companies(spark, d))


@query(f"WITH {_COMPANIES} SELECT ticker, {', '.join(f'round({r}, 6) AS {r}' for r in RATIOS)}, round(fcf, 4) AS fcf, round(net_cash, 4) AS net_cash FROM m")
def metrics_wide(spark, d):
    return wide(spark, d).select("ticker", *[F.round(r, 6).alias(r) for r in RATIOS], F.round("fcf", 4).alias("fcf"), F.round("net_cash", 4).alias("net_cash"))


_MDAY = date(2001, 12, 1)
_FLAGS = f"""f AS (SELECT *, coalesce(equity_used <= 0, false) AS capital_impairment, coalesce(net_income_ttm <= 0, false) AS negative_earnings, coalesce(cap > 2e15, false) AS market_cap_implausible, coalesce(pbr > 200 OR (pbr > 0 AND pbr < 0.02), false) AS pbr_implausible,
  coalesce(div_yield_pct > 20 OR dps > close, false) AS dividend_data_impossible, coalesce(pbr > 0 AND pbr < 0.15 AND psr > 0 AND psr < 0.08, false) AND sector_code <> 'BANK' AS market_cap_inconsistent,
  coalesce(price_divergence > 5 OR price_divergence < 0.2, false) AND NOT coalesce(div_yield_pct > 20 OR dps > close, false) AS price_dividend_inconsistent, coalesce(DATE '{_MDAY}' - last_reported > 200, true) AS stale_financials, ttm_reason IS NULL AS financials_missing, coalesce(starts_with(ttm_reason, 'incomplete'), false) AS ttm_incomplete,
  coalesce(net_income_ttm > 1.5 * operating_income_ttm, false) AS oneoff_profit_suspect, coalesce(per_op / nullif(per, 0) > 3, false) AS per_op_divergence, coalesce((equity_total - equity_used) / nullif(equity_total, 0) > 0.2, false) AS minority_interest_large, fcf IS NULL AND cfo_ttm IS NOT NULL AS capex_unmapped, ni_c IS NULL AND ni_t IS NOT NULL AS ni_fallback_used,
  equity_controlling IS NULL AND equity_total IS NOT NULL AS equity_fallback_used, false AS cfs_missing_used_ofs, false AS non_standard_fiscal_month, sector_code IS NULL AS unmapped_industry, sector_code = 'BANK' AS financial_sector, false AS holding_company FROM m)"""


def flagged(spark, d) -> DataFrame:
    return metrics.add_flags(wide(spark, d), _MDAY)


@query(f"WITH {_COMPANIES}, {_FLAGS} SELECT ticker, {', '.join(metrics.FLAGS)}, round(CASE WHEN NOT financial_sector THEN fcf END, 4) AS fcf FROM f")
def quality_flags(spark, d):
    return flagged(spark, d).select("ticker", *metrics.FLAGS, F.round("fcf", 4).alias("fcf"))


@query(f"WITH {_COMPANIES}, {_FLAGS} SELECT count(*) AS n, {', '.join(f'count(*) FILTER ({x}) AS {x}' for x in metrics.FLAGS)}, count(per) AS has_per, count(roic) AS has_roic FROM f")
def defect_kpis(spark, d):
    return metrics.defect_counts(flagged(spark, d), metrics.FLAGS, ["per", "roic"])


@query(f"WITH {_COMPANIES} " + " UNION ALL ".join(f"SELECT '{r}' AS name, round(avg(CASE WHEN {r} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS rate FROM m" for r in RATIOS))
def null_rates(spark, d):
    return metrics.null_rates(wide(spark, d), list(RATIOS)).select("name", F.round("rate", 6).alias("rate"))


# metrics from long facts: segments of a nation's customers as companies, their orders by quarter as filings
_FLOW = {"REVENUE": (1, 0), "OPERATING_INCOME": (0.3, 1.2), "NET_INCOME": (0.2, 0.9), "NET_INCOME_CONTROLLING": (0.15, 0.7), "CFO": (0.25, 0.8), "CAPEX_PPE": (0.05, 0)}
_BALANCE = {"ASSETS": (3, 0), "EQUITY_TOTAL": (1, 1.5), "EQUITY_CONTROLLING": (0.7, 1.1), "ASSETS_CURRENT": (0.9, 0), "LIABILITIES_CURRENT": (0.5, 0.1), "CASH_AND_EQUIV": (0.2, 0), "BORROWINGS_SHORT": (0.1, 0.2)}
_LACK = {"NET_INCOME_CONTROLLING": 3, "CAPEX_PPE": 4, "EQUITY_CONTROLLING": 5, "BORROWINGS_SHORT": 6}  # nations whose number is divisible by this don't report it


def long_facts(spark, d) -> DataFrame:
    o = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    price = F.col("o_totalprice").cast("decimal(18,2)")
    q = o.groupBy("c_nationkey", "c_mktsegment", F.year("o_orderdate").alias("fiscal_year"), F.quarter("o_orderdate").alias("q")).agg(F.sum(price).alias("v"), F.coalesce(F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", price)), F.lit(0)).cast("decimal(28,2)").alias("w"))
    run = Window.partitionBy("c_nationkey", "c_mktsegment", "fiscal_year").orderBy("q")
    both = q.withColumns({"cv": F.sum("v").over(run).cast("decimal(28,2)"), "cw": F.sum("w").over(run).cast("decimal(28,2)")})
    n, fy = F.col("c_nationkey"), F.col("q") == 4

    def lines(which: dict, v: str, w: str, kind, months) -> list:
        return [F.when((n % _LACK[e] != 0) if e in _LACK else F.lit(True), F.struct(F.lit(e).alias("element"), (F.col(v) * F.lit(a).cast("decimal(4,2)") - F.col(w) * F.lit(b).cast("decimal(4,2)")).cast("double").alias("value"), kind.alias("period_type"), months.alias("period_months"))) for e, (a, b) in which.items()]

    null = F.lit(None).cast("int")
    dps = F.when(fy & (n % 7 != 0), F.struct(F.lit("DPS").alias("element"), (F.col("cw") / 10000).cast("double").alias("value"), F.lit("FY").alias("period_type"), null.alias("period_months")))
    every = F.array_compact(F.array(*lines(_FLOW, "cv", "cw", F.when(fy, "FY").otherwise("CUM"), F.col("q") * 3), *lines(_BALANCE, "v", "w", F.lit("INSTANT"), null), dps))
    end = dates.fiscal_end(F.col("fiscal_year"), F.col("q") * 3)
    rows = both.select(F.concat_ws("-", n, F.substring("c_mktsegment", 1, 1)).alias("ticker"), "fiscal_year", "q", end.alias("fiscal_end_date"), F.when(n % 8 == 0, "OFS").otherwise("CFS").alias("statement_basis"), F.explode(every).alias("x"))
    return rows.select("ticker", "x.*", "fiscal_year", "fiscal_end_date", "statement_basis", F.date_add("fiscal_end_date", 45).alias("reported_at"), F.date_add("fiscal_end_date", 46).alias("available_at"), F.concat_ws("-", "ticker", "x.element", "fiscal_year", "q").alias("fact_id"))


def _lines_sql(which: dict, v: str, w: str, kind: str, months: str) -> str:
    return " UNION ALL ".join(f"SELECT ticker, n, y, q, fe, '{e}' AS element, CAST({v} * CAST({a} AS DECIMAL(4, 2)) - {w} * CAST({b} AS DECIMAL(4, 2)) AS DOUBLE) AS value, {kind} AS pt, {months} AS m FROM seen" + (f" WHERE n % {_LACK[e]} <> 0" if e in _LACK else "") for e, (a, b) in which.items())


def _one(e: str, what: str) -> str:
    return f"max({what}) FILTER (element = '{e}')"


_LONG = f"""q AS (SELECT c_nationkey AS n, c_mktsegment AS g, year(o_orderdate) AS y, quarter(o_orderdate) AS q, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS v, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (o_orderpriority = '1-URGENT'), 0) AS DECIMAL(28, 2)) AS w
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4), run AS (SELECT n || '-' || substring(g, 1, 1) AS ticker, *, CAST(sum(v) OVER (PARTITION BY n, g, y ORDER BY q) AS DECIMAL(28, 2)) AS cv, CAST(sum(w) OVER (PARTITION BY n, g, y ORDER BY q) AS DECIMAL(28, 2)) AS cw, last_day(make_date(y, q * 3, 1)) AS fe FROM q),
  seen AS (SELECT * FROM run WHERE fe + 46 <= {DAY}), fl AS ({_lines_sql(_FLOW, "cv", "cw", "CASE WHEN q = 4 THEN 'FY' ELSE 'CUM' END", "q * 3")}), ins AS ({_lines_sql(_BALANCE, "v", "w", "'INSTANT'", "NULL")}),
  lt AS (SELECT ticker, element, arg_max(y, fe) AS y, arg_max(m, fe) AS m FROM fl GROUP BY 1, 2),
  tt AS (SELECT l.ticker, l.element, CASE WHEN l.m = 12 THEN a.value ELSE b.value - c.value + a.value END AS ttm, CASE WHEN l.m = 12 THEN 'annual' WHEN b.value IS NULL THEN 'incomplete:prev_fy' WHEN c.value IS NULL THEN 'incomplete:prev_cum' ELSE 'rolled:' || l.m || 'm' END AS reason
    FROM lt l JOIN fl a ON a.ticker = l.ticker AND a.element = l.element AND a.y = l.y AND a.m = l.m LEFT JOIN fl b ON b.ticker = l.ticker AND b.element = l.element AND b.y = l.y - 1 AND b.m = 12 LEFT JOIN fl c ON c.ticker = l.ticker AND c.element = l.element AND c.y = l.y - 1 AND c.m = l.m AND l.m < 12),
  fy AS (SELECT ticker, element, max(y) AS y FROM fl WHERE m = 12 GROUP BY 1, 2), cu AS (SELECT ticker, element, arg_max(y, fe) AS y, arg_max(m, fe) AS m FROM fl WHERE m < 12 GROUP BY 1, 2),
  gr AS (SELECT k.ticker, k.element, f1.value AS f1, f0.value AS f0, q1.value AS q1, q0.value AS q0 FROM (SELECT DISTINCT ticker, element FROM fl WHERE element IN ('REVENUE', 'OPERATING_INCOME')) k LEFT JOIN fy ON fy.ticker = k.ticker AND fy.element = k.element LEFT JOIN fl f1 ON f1.ticker = k.ticker AND f1.element = k.element AND f1.y = fy.y AND f1.m = 12
    LEFT JOIN fl f0 ON f0.ticker = k.ticker AND f0.element = k.element AND f0.y = fy.y - 1 AND f0.m = 12 LEFT JOIN cu ON cu.ticker = k.ticker AND cu.element = k.element LEFT JOIN fl q1 ON q1.ticker = k.ticker AND q1.element = k.element AND q1.y = cu.y AND q1.m = cu.m LEFT JOIN fl q0 ON q0.ticker = k.ticker AND q0.element = k.element AND q0.y = cu.y - 1 AND q0.m = cu.m),
  gw AS (SELECT ticker, {", ".join(f"{_one(e, 'CASE WHEN f0 > 0 THEN (f1 - f0) / f0 END')} AS {p}_growth_fy, {_one(e, 'CASE WHEN q0 > 0 THEN (q1 - q0) / q0 END')} AS {p}_growth_q, {_one(e, 'f1 - f0')} AS {p}_delta_fy" for p, e in (("rev", "REVENUE"), ("op", "OPERATING_INCOME")))}, coalesce(bool_or(f0 <= 0 AND f1 > 0) FILTER (element = 'OPERATING_INCOME'), false) AS turnaround FROM gr GROUP BY 1),
  tw AS (SELECT ticker, {", ".join(f"{_one(e, 'ttm')} AS {e.lower()}" for e in _FLOW)}, {_one("NET_INCOME_CONTROLLING", "reason")} AS reason FROM tt GROUP BY 1), lb AS (SELECT ticker, element, arg_max(value, fe) AS value FROM ins GROUP BY 1, 2), bw AS (SELECT ticker, {", ".join(f"{_one(e, 'value')} AS {e.lower()}" for e in _BALANCE)} FROM lb GROUP BY 1),
  dp AS (SELECT ticker, arg_max(CAST(cw / 10000 AS DOUBLE), fe) AS dps FROM seen WHERE q = 4 AND n % 7 <> 0 GROUP BY 1), rep AS (SELECT ticker, max(fe + 45) AS last FROM seen GROUP BY 1),
  cc AS (SELECT c_nationkey AS n, c_nationkey || '-' || substring(c_mktsegment, 1, 1) AS ticker, count(*) AS k FROM customer GROUP BY 1, 2),
  pw AS (SELECT cc.ticker, n, CAST(k * 1000 AS DOUBLE) AS close, CAST(k * 90000000 AS DOUBLE) AS cap_common, CASE WHEN n % 9 <> 0 THEN CAST(k * 100000000 AS DOUBLE) END AS cap_total, CAST(k * 1000 AS DOUBLE) AS shares, CASE WHEN n % 2 = 0 THEN CAST(k * 30 AS DOUBLE) END AS treasury, CASE WHEN n < 4 THEN 'BANK' WHEN n < 20 THEN 'MACHINERY' END AS sector_code, reason, revenue, operating_income, cfo, capex_ppe, dps, last,
    net_income_controlling AS ni_c, net_income AS ni_t, equity_controlling AS eq_c, equity_total AS eq_t, assets, assets_current, liabilities_current, cash_and_equiv, borrowings_short, rev_growth_fy, rev_growth_q, rev_delta_fy, op_growth_fy, op_growth_q, op_delta_fy, coalesce(turnaround, false) AS turnaround
    FROM cc LEFT JOIN tw ON tw.ticker = cc.ticker LEFT JOIN gw ON gw.ticker = cc.ticker LEFT JOIN bw ON bw.ticker = cc.ticker LEFT JOIN dp ON dp.ticker = cc.ticker LEFT JOIN rep ON rep.ticker = cc.ticker),
  p1 AS (SELECT *, coalesce(ni_c, ni_t) AS ni, coalesce(eq_c, eq_t) AS eq, coalesce(cap_total, cap_common) AS cap, CASE WHEN capex_ppe IS NOT NULL THEN cfo - abs(capex_ppe) END AS fcf, coalesce(cash_and_equiv, 0) - coalesce(borrowings_short, 0) AS net_cash FROM pw)"""
_MET = ("net_income_ttm", "per", "pbr", "op_margin", "roe", "debt_ratio", "roic", "accrual_ratio", "div_yield", "rev_growth_fy", "rev_growth_q", "rev_delta_fy", "op_growth_fy", "op_growth_q", "op_delta_fy")


def from_facts(spark, d) -> DataFrame:
    n = F.col("c_nationkey")
    c = t(spark, d, "customer").groupBy("c_nationkey", F.concat_ws("-", n, F.substring("c_mktsegment", 1, 1)).alias("ticker")).agg(F.count(F.lit(1)).cast("double").alias("k"))
    k = F.col("k")
    prices_ = c.select("ticker", (k * 1000).alias("close"), (k * 90_000_000).alias("market_cap_common"), F.when(n % 9 != 0, k * 100_000_000).alias("market_cap_total"), (k * 1000).alias("shares_common"), F.when(n % 2 == 0, k * 30).alias("treasury_shares"))
    master = c.select("ticker", F.when(n < 4, "BANK").when(n < 20, "MACHINERY").alias("sector_code"), (n < 4).alias("is_financial"), (n == 10).alias("is_holding"), F.when(n == 11, 3).otherwise(12).alias("fiscal_month"))
    status = c.select("ticker", F.when(n % 6 == 2, "admin_issue").when(n % 6 == 3, "audit_opinion_bad_admin").otherwise("other").alias("status"), F.when(n < 15, F.lit(date(1997, 1, 1))).otherwise(F.lit(date(1999, 1, 1))).alias("effective_from"), F.lit("r").alias("reason"), F.lit(date(1999, 6, 1)).alias("snapshot_date"))
    return metrics.assemble(pit.facts_asof(long_facts(spark, d), AS_OF), prices_, master, AS_OF, pit.status_asof(status, AS_OF))


@query(f"""WITH {_LONG} SELECT ticker, CASE WHEN ni_c IS NULL AND ni_t IS NOT NULL THEN 'fallback:total' ELSE reason END AS ttm_reason, round(ni, 4) AS net_income_ttm, round(cap / nullif(ni, 0), 6) AS per, round(cap / nullif(eq, 0), 6) AS pbr, round(CASE WHEN revenue > 0 THEN operating_income / revenue END, 6) AS op_margin, round(ni / nullif(eq, 0), 6) AS roe,
  round((assets - eq_t) / nullif(eq_t, 0), 6) AS debt_ratio, round(CASE WHEN eq_t - net_cash > 0 THEN operating_income * (1 - 0.22) / (eq_t - net_cash) END, 6) AS roic, round((ni - cfo) / nullif(assets, 0), 6) AS accrual_ratio, round(dps / nullif(close, 0), 6) AS div_yield, round(CASE WHEN NOT n < 4 THEN fcf END, 4) AS fcf,
  round(rev_growth_fy, 6) AS rev_growth_fy, round(rev_growth_q, 6) AS rev_growth_q, round(rev_delta_fy, 6) AS rev_delta_fy, round(op_growth_fy, 6) AS op_growth_fy, round(op_growth_q, 6) AS op_growth_q, round(op_delta_fy, 6) AS op_delta_fy, turnaround, last AS last_reported FROM p1""")
def metrics_from_facts(spark, d):
    m = from_facts(spark, d)
    return m.select("ticker", "ttm_reason", *[F.round(c, 4 if c == "net_income_ttm" else 6).alias(c) for c in _MET], F.round("fcf", 4).alias("fcf"), "turnaround", "last_reported")


_STATUS_FLAGS = ("admin_issue", "audit_opinion_bad_admin", "status_source_missing", "capital_impairment", "negative_earnings", "minority_interest_large", "capex_unmapped", "ni_fallback_used", "equity_fallback_used", "cfs_missing_used_ofs", "non_standard_fiscal_month", "unmapped_industry", "financial_sector", "holding_company", "financials_missing", "ttm_incomplete", "stale_financials")


@query(f"""WITH {_LONG} SELECT ticker, n % 6 = 2 AND n < 15 AS admin_issue, n % 6 = 3 AND n < 15 AS audit_opinion_bad_admin, false AS status_source_missing, coalesce(eq <= 0, false) AS capital_impairment, coalesce(ni <= 0, false) AS negative_earnings, coalesce((eq_t - eq) / nullif(eq_t, 0) > 0.2, false) AS minority_interest_large, fcf IS NULL AND cfo IS NOT NULL AS capex_unmapped,
  ni_c IS NULL AND ni_t IS NOT NULL AS ni_fallback_used, eq_c IS NULL AND eq_t IS NOT NULL AS equity_fallback_used, n % 8 = 0 AND eq_c IS NOT NULL AS cfs_missing_used_ofs, n = 11 AS non_standard_fiscal_month, sector_code IS NULL AS unmapped_industry, n < 4 AS financial_sector, n = 10 AS holding_company,
  reason IS NULL AND ni_t IS NULL AS financials_missing, coalesce(starts_with(reason, 'incomplete'), false) AND NOT (ni_c IS NULL AND ni_t IS NOT NULL) AS ttm_incomplete, coalesce({DAY} - last > 200, true) AS stale_financials FROM p1""")
def status_flags(spark, d):
    return from_facts(spark, d).select("ticker", *_STATUS_FLAGS)


_HARD = "admin_issue capital_impairment negative_earnings pbr_implausible stale_financials ttm_incomplete".split()
_MIN = 5e6


@query(f"WITH {_COMPANIES}, {_FLAGS} SELECT ticker FROM f WHERE NOT ({' OR '.join(_HARD)}) AND coalesce(cap >= {_MIN}, false)")
def hard_guards_eligible(spark, d):
    return gate.guard(flagged(spark, d), _HARD, _MIN)[0].select("ticker")


@query(f"WITH {_COMPANIES}, {_FLAGS} " + " UNION ALL ".join([f"SELECT ticker, '{g}' AS reason FROM f WHERE {g}" for g in _HARD] + [f"SELECT ticker, 'below_min_market_cap_or_missing' FROM f WHERE NOT coalesce(cap >= {_MIN}, false)"]))
def hard_guards_why(spark, d):
    return gate.guard(flagged(spark, d), _HARD, _MIN)[1]


@query(f"WITH {_COMPANIES}, {_FLAGS} " + " UNION ALL ".join(f"SELECT '{g}' AS guard, count(*) FILTER ({g}) AS hits, count(*) FILTER ({g}) = 0 AS inert FROM f" for g in _HARD))
def guard_effectiveness(spark, d):
    return gate.guard_effect(flagged(spark, d), _HARD)


_CHECKS = [checks.CATALOG[i] for i in ("accrual_anomaly", "cfo_shortfall", "high_leverage", "low_roic", "low_roe", "treasury_heavy", "dividend_uncovered", "low_current_ratio", "thin_margin", "fcf_without_earnings", "capex_starved")]
_HIT = {"accrual_anomaly": "accrual_ratio > 0.1", "cfo_shortfall": "cfo_to_ni < 0.5", "high_leverage": "debt_ratio > 2", "low_roic": "roic < 0.05", "low_roe": "roe < 0.05", "treasury_heavy": "treasury_ratio > 0.05", "dividend_uncovered": "dividend_fcf_cover < 1", "low_current_ratio": "current_ratio < 1", "thin_margin": "op_margin < 0.05", "fcf_without_earnings": "fcf_yield - cfo_to_ni > 1", "capex_starved": "capex_ppe_ttm / nullif(revenue_ttm, 0) < 0.005"}
_HITS = "h AS (SELECT ticker, " + ", ".join(f"coalesce({_HIT[c.id]}, false)" + (" AND sector_code <> 'BANK'" if c.exempt else "") + f" AS {c.id}" for c in _CHECKS) + " FROM m)"


@query(f"WITH {_COMPANIES}, {_HITS} SELECT * FROM h")
def check_hits(spark, d):
    return checks.apply(wide(spark, d), _CHECKS).select("ticker", *[c.id for c in _CHECKS])


_GROUP = "list_sort(list_distinct(list_filter([" + ", ".join(f"CASE WHEN {c.id} THEN '{c.risk_group}' END" for c in _CHECKS if c.polarity == "risk") + "], lambda z: z IS NOT NULL)))"


@query(f"WITH {_COMPANIES}, {_HITS} SELECT ticker, array_to_string({_GROUP}, '|') AS risk_groups, CAST(len({_GROUP}) AS INTEGER) AS n_risk_groups FROM h")
def risk_groups(spark, d):
    return checks.risk_groups(checks.apply(wide(spark, d), _CHECKS), _CHECKS).select("ticker", F.array_join("risk_groups", "|").alias("risk_groups"), "n_risk_groups")


@query(f"WITH {_COMPANIES} SELECT 'low_roic' AS id, count(*) AS n, count(*) FILTER (roic IS NULL) AS missing, count(*) FILTER (coalesce(roic < 0.05, false) AND sector_code <> 'BANK') AS hits, round(quantile_cont(roic, 0.1), 6) AS q10, round(quantile_cont(roic, 0.5), 6) AS q50, round(quantile_cont(roic, 0.9), 6) AS q90 FROM m")
def check_preview_quantiles(spark, d):
    return checks.preview(wide(spark, d), checks.CATALOG["low_roic"]).select("id", "n", "missing", "hits", *[F.round(q, 6).alias(q) for q in ("q10", "q50", "q90")])


_FILTERS = (gate.Filter("per", 40, 6, False, True), gate.Filter("op_margin", 0.03, 0.05), gate.Filter("adtv_20d", 1e4, 2e5))
_WEIGHTS = (("per", -0.4), ("pbr", -0.3), ("op_margin", 0.3))
_TAU = """g AS (SELECT ticker, per, pbr, op_margin, adtv_20d, least(CASE WHEN per <= 40 AND per > 0 THEN least((per - 40) / (6 - 40), 1) ELSE -1 END, CASE WHEN op_margin >= 0.03 THEN least((op_margin - 0.03) / (0.05 - 0.03), 1) ELSE -1 END, CASE WHEN adtv_20d >= 1e4 THEN least((adtv_20d - 1e4) / (2e5 - 1e4), 1) ELSE -1 END) AS tau FROM m)"""
_Z = """z AS (SELECT *, CASE WHEN per > 0 THEN per END AS a, CASE WHEN pbr > 0 THEN pbr END AS b, op_margin AS c FROM kept), mo AS (SELECT avg(a) AS aa, stddev_pop(a) AS sa, max(a) AS ma, avg(b) AS ab, stddev_pop(b) AS sb, max(b) AS mb, avg(c) AS ac, stddev_pop(c) AS sc FROM z),
  sc AS (SELECT ticker, coalesce(CASE WHEN sa > 0 THEN (a - aa) / sa WHEN a IS NOT NULL THEN 0 END, CASE WHEN sa > 0 THEN (ma - aa) / sa ELSE 0 END, 0) * -0.4 + coalesce(CASE WHEN sb > 0 THEN (b - ab) / sb WHEN b IS NOT NULL THEN 0 END, CASE WHEN sb > 0 THEN (mb - ab) / sb ELSE 0 END, 0) * -0.3
  + coalesce(CASE WHEN sc > 0 THEN (c - ac) / sc WHEN c IS NOT NULL THEN 0 END, 0) * 0.3 AS score FROM z, mo)"""


def _gate_sql(kept: str, cap: int) -> str:
    return f"WITH {_COMPANIES}, {_TAU}, kept AS ({kept}), {_Z} SELECT ticker, round(score, 6) AS score, CAST(row_number() OVER (ORDER BY score DESC, ticker) AS INTEGER) AS rank FROM sc QUALIFY row_number() OVER (ORDER BY score DESC, ticker) <= {cap}"


def _gate(spark, d, incumbents=None, **over) -> DataFrame:
    g = gate.Gate(_FILTERS, _WEIGHTS, **({"target": 30, "cap": 40} | over))
    return gate.run(wide(spark, d), g, incumbents)[0].select("ticker", F.round("score", 6).alias("score"), "rank")


_EDGE = "(SELECT tau FROM g ORDER BY tau DESC LIMIT 1 OFFSET 30)"
_T = f"CASE WHEN (SELECT count(*) FROM g WHERE tau >= 0) <= 30 THEN 0 WHEN (SELECT count(*) FROM g WHERE tau >= 1) >= 30 THEN 1 ELSE {_EDGE} + coalesce(((SELECT min(tau) FROM g WHERE tau > {_EDGE}) - {_EDGE}) * 2.0 ** -40, 1) END"


@query(_gate_sql(f"SELECT * FROM g WHERE tau >= {_T}", 40))
def gate_target(spark, d):
    return _gate(spark, d)


@query(_gate_sql("SELECT * FROM g WHERE tau >= 1", 40))
def gate_fixed(spark, d):
    return _gate(spark, d, mode="fixed")


@query(_gate_sql("SELECT * FROM g WHERE tau >= 0", 25))
def gate_rank_top_n(spark, d):
    return _gate(spark, d, mode="rank_top_n", cap=25)


@query(_gate_sql(f"SELECT * FROM g WHERE tau >= {_T} OR (adtv_20d < 2e5 AND tau >= greatest(0, {_T} - 0.2))", 60))
def gate_hysteresis(spark, d):
    w = wide(spark, d)
    return _gate(spark, d, w.filter("adtv_20d < 2e5").select("ticker"), hysteresis=0.2, cap=60)


@query(f"WITH {_COMPANIES}, kept AS (SELECT * FROM m), {_Z} SELECT ticker, round(score, 6) AS score FROM sc")
def composite_z(spark, d):
    return gate.composite_z(wide(spark, d), _WEIGHTS).select("ticker", F.round("score", 6).alias("score"))


@query("""WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1996), b AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1997) SELECT CAST(o_custkey AS VARCHAR) AS ticker, 'entered' AS change FROM (SELECT * FROM b EXCEPT SELECT * FROM a) UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'left' FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""")
def basket_drift(spark, d):
    o = t(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("ticker"), F.year("o_orderdate").alias("y"))
    return gate.drift(o.filter("y = 1996"), o.filter("y = 1997"))


# prices
@query("SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 8) AS adtv_20d FROM events")
def adtv20(spark, d):
    return t(spark, d, "events").select("event_id", F.round(prices.trailing_mean(F.col("value"), "user_id", ["ts", "event_id"]), 8).alias("adtv_20d"))


@query(f"""WITH a AS ({_DAILY.format("< 'm'")}), b AS ({_DAILY.format(">= 'm'")}) SELECT date, ticker, a.close, b.close AS other_close, a.close IS NOT NULL AND b.close IS NOT NULL AS compared, coalesce(abs((a.close - b.close) / nullif(b.close, 0)) > 0.02, false) AS disagrees FROM a LEFT JOIN b USING (date, ticker)""")
def price_reconcile(spark, d):
    keyed = lambda df: df.withColumn("day", F.col("date")).withColumn("name", F.col("ticker")).withColumn("ticker", F.concat_ws("@", "ticker", "date"))
    r = prices.reconcile(keyed(_daily(spark, d, "event_type < 'm'")), keyed(_daily(spark, d, "event_type >= 'm'")))
    return r.select(F.col("day").alias("date"), F.col("name").alias("ticker"), "close", "other_close", "compared", "disagrees")


@query("""WITH lines AS (SELECT CAST(ts AS DATE) AS date, lpad(CAST(user_id AS VARCHAR), 6, '0') AS ticker, sum(CAST(value AS DECIMAL(18, 2))) AS cap FROM events GROUP BY 1, 2), p AS (SELECT date, substring(ticker, 1, 5) || '0' AS ticker, sum(cap) AS preferred_cap FROM lines WHERE substring(ticker, 6, 1) <> '0' GROUP BY 1, 2)
  SELECT l.date, l.ticker, CAST(cap AS DOUBLE) AS cap, CAST(preferred_cap AS DOUBLE) AS preferred_cap, CAST(cap + coalesce(preferred_cap, 0) AS DOUBLE) AS total_cap FROM lines l LEFT JOIN p ON p.date = l.date AND p.ticker = l.ticker WHERE substring(l.ticker, 6, 1) = '0'""")
def preferred_rollup(spark, d):
    e = t(spark, d, "events").groupBy(F.to_date("ts").alias("date"), text.ticker6(F.col("user_id").cast("string")).alias("ticker")).agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("cap"))
    r = prices.roll_up_preferred(e, text.parent_ticker(F.col("ticker")))
    return r.select("date", "ticker", *[F.col(c).cast("double").alias(c) for c in ("cap", "preferred_cap", "total_cap")])


# labels and classifiers
_RULES = [("BRASS|COPPER|STEEL|TIN|NICKEL", "METAL"), ("^PROMO", "PROMO"), ("POLISHED|BRUSHED", "FINISHED"), ("STANDARD|SMALL|LARGE", "PLAIN")]


@query("SELECT p_partkey, CASE " + " ".join(f"WHEN regexp_matches(p_type, '{p}') THEN '{c}'" for p, c in _RULES) + " ELSE 'OTHER' END AS sector_code FROM part")
def sector_map_first_match(spark, d):
    return t(spark, d, "part").select("p_partkey", text.first_match(F.col("p_type"), _RULES, "OTHER").alias("sector_code"))


_OUT = [("merged", ("und ", "que ")), ("voluntary", ("the ",)), ("dissolved", ("der ",)), ("failed", ("los ", "les "))]


@query("""SELECT doc_id, CASE WHEN s = '' THEN CASE WHEN contains(n, 'src1') THEN 'dissolved' ELSE 'other' END WHEN contains(s, 'und ') OR contains(s, 'que ') THEN 'merged' WHEN contains(s, 'the ') THEN 'voluntary' WHEN contains(n, 'src1') OR contains(s, 'der ') THEN 'dissolved' WHEN contains(s, 'los ') OR contains(s, 'les ') THEN 'failed' ELSE 'other' END AS outcome
  FROM (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS s, coalesce(source, '') AS n FROM documents)""")
def reason_classifier(spark, d):
    return t(spark, d, "documents").select("doc_id", text.delisting_outcome(F.col("text"), F.col("source"), _OUT, "src1").alias("outcome"))


def disclosures(spark, d) -> DataFrame:
    return t(spark, d, "events").select(F.col("event_id").cast("string").alias("rcept_no"), F.col("user_id").cast("string").alias("ticker"), F.concat_ws(":", F.col("event_type"), F.substring(F.col("props"), 1, 7)).alias("report_key"), (F.get_json_object("props", "$.k").cast("int") >= 90).alias("is_amendment"), F.when(F.col("value") > 100, "B").otherwise("I").alias("pblntf_ty"), F.to_date("ts").alias("rcept_dt"), F.col("value"))


_DISC = """disc AS (SELECT CAST(event_id AS VARCHAR) AS rcept_no, CAST(user_id AS VARCHAR) AS ticker, event_type || ':' || substring(props, 1, 7) AS report_key, CAST(json_extract(props, '$.k') AS INTEGER) >= 90 AS is_amendment, CASE WHEN value > 100 THEN 'B' ELSE 'I' END AS pblntf_ty, CAST(ts AS DATE) AS rcept_dt, value FROM events)"""
_SPECS = (catalysts.Spec("C1", "positive", ("B",), ("^purchase", "^signup"), "equity", 0.02, 10), catalysts.Spec("C2", "positive", ("I", "B"), ("^click",), None, 50.0, 5), catalysts.Spec("X1", "negative", ("B",), ("^(error|logout|view)",), "equity", 0.01, 8))
_KINDS = """cand AS (SELECT *, 'C1' AS kind FROM disc WHERE pblntf_ty = 'B' AND regexp_matches(report_key, '^purchase|^signup') UNION ALL SELECT *, 'C2' FROM disc WHERE regexp_matches(report_key, '^click') UNION ALL SELECT *, 'X1' FROM disc WHERE pblntf_ty = 'B' AND regexp_matches(report_key, '^(error|logout|view)'))"""


@query(f"WITH {_DISC}, {_KINDS} SELECT rcept_no, ticker, kind FROM cand")
def catalyst_classify(spark, d):
    return catalysts.classify(disclosures(spark, d), _SPECS).select("rcept_no", "ticker", "kind")


@query(f"WITH {_DISC} SELECT DISTINCT ticker, report_key FROM disc WHERE is_amendment")
def amendment_index(spark, d):
    return catalysts.amendments(disclosures(spark, d))


_CDAY = date(2024, 1, 25)
_CAT = f"""eq AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_acctbal AS equity FROM customer), am AS (SELECT DISTINCT ticker, report_key FROM disc WHERE is_amendment), op AS (SELECT *, max(CASE WHEN kind = 'X1' THEN rcept_dt END) OVER (PARTITION BY ticker) AS neg, max(CASE WHEN kind <> 'X1' THEN rcept_dt END) OVER (PARTITION BY ticker) AS pos FROM cand),
  b AS (SELECT o.*, e.ticker IS NOT NULL AS known, a.ticker IS NOT NULL AS amended, CASE WHEN kind = 'C2' THEN value WHEN e.equity > 0 THEN value / e.equity END AS magnitude, rcept_dt + CASE kind WHEN 'C1' THEN 10 WHEN 'C2' THEN 5 ELSE 8 END AS expires_at, CASE kind WHEN 'C1' THEN 0.02 WHEN 'C2' THEN 50.0 ELSE 0.01 END AS least,
  CASE WHEN kind = 'X1' THEN pos ELSE neg END AS opposite FROM op o LEFT JOIN eq e ON e.ticker = o.ticker LEFT JOIN am a ON a.ticker = o.ticker AND a.report_key = o.report_key),
  k AS (SELECT rcept_no, ticker, kind, rcept_dt, magnitude, expires_at, NOT amended AS not_amended, expires_at >= DATE '{_CDAY}' AS not_expired, coalesce(magnitude >= least, false) AS material, coalesce(opposite <= rcept_dt, true) AS no_reversal, known AS numbers_agree FROM b),
  r AS (SELECT *, 1 + CAST(not_amended AS INTEGER) + CAST(not_expired AS INTEGER) + CAST(material AS INTEGER) + CAST(no_reversal AS INTEGER) + CAST(numbers_agree AS INTEGER) AS confidence FROM k)"""


def built(spark, d) -> DataFrame:
    found = catalysts.classify(disclosures(spark, d), _SPECS).withColumn("raw", F.col("value")).withColumn("stated_expiry", F.lit(None).cast("date"))
    m = t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("ticker"), F.col("c_acctbal").alias("equity"))
    return catalysts.build(found, m, catalysts.amendments(disclosures(spark, d)), _CDAY, _SPECS)


@query(f"WITH {_DISC}, {_KINDS}, {_CAT} SELECT rcept_no, ticker, kind, round(magnitude, 6) AS magnitude, expires_at, material, no_reversal, not_amended, not_expired, numbers_agree, CAST(confidence AS INTEGER) AS confidence FROM r")
def catalyst_confidence(spark, d):
    return built(spark, d).select("rcept_no", "ticker", "kind", F.round("magnitude", 6).alias("magnitude"), "expires_at", "material", "no_reversal", "not_amended", "not_expired", "numbers_agree", "confidence")


@query(f"""WITH {_DISC}, {_KINDS}, {_CAT}, l AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY confidence DESC, magnitude DESC NULLS LAST, rcept_no) AS rank, greatest(count(*) OVER (PARTITION BY kind) - 15, 0) AS more FROM r WHERE magnitude IS NOT NULL AND not_expired AND confidence >= 4)
  SELECT kind, CAST(rank AS INTEGER) AS rank, rcept_no, CAST(confidence AS INTEGER) AS confidence, more FROM l WHERE rank <= 15""")
def catalyst_topk(spark, d):
    return catalysts.top_per_kind(catalysts.live(catalysts.keep(built(spark, d), _SPECS))).select("kind", "rank", "rcept_no", "confidence", "more")


# themes and evidence
_THEMES = [themes.Theme("english", ("en",), 0.2, ("the ", " of ", " with ")), themes.Theme("german", ("de",), 0.2, (" der ", " nicht ", "lich ")), themes.Theme("french", "NOT [en, de, es]", None, (" de ", " que ", " pour ")), themes.Theme("spanish", ("es",), 0.3, (" los ", "ción", " de ")), themes.Theme("junk", ("xx",), None, ("###", "***", "%%%", "!!"))]
_UNIVERSE = {"en", "de", "fr", "es", "xx"}
_ALLOWED = {"english": ("en",), "german": ("de",), "french": ("fr", "xx"), "spanish": ("es",), "junk": ("xx",)}
_SCORES = " UNION ALL ".join(f"SELECT doc_id, '{th.id}' AS theme_id, {' + '.join(f'CAST(contains(x, $${w}$$) AS INTEGER)' for w in th.keywords)} AS hits, lang IN ({', '.join(repr(s) for s in _ALLOWED[th.id])}) AS ok, {k} AS place FROM docs" for k, th in enumerate(_THEMES))


@query(f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS x, lang FROM documents), s AS ({_SCORES}), c AS (SELECT doc_id, theme_id, hits, hits + CASE WHEN coalesce(ok, false) THEN 0.5 ELSE 0.0 END AS score, place FROM s)
  SELECT doc_id, theme_id, CAST(hits AS INTEGER) AS hits, CAST(score AS DOUBLE) AS score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, place) AS rank FROM c WHERE score > 0) WHERE rank <= 3""")
def theme_candidates(spark, d):
    return themes.candidates(t(spark, d, "documents"), _THEMES, _UNIVERSE, F.coalesce("text", F.lit("")), F.col("lang"), "doc_id", 3).select("doc_id", "theme_id", "hits", "score", "rank")


@query("""WITH k AS (SELECT p_brand AS theme_id, list_distinct(list(p_size)) AS keywords FROM part GROUP BY 1) SELECT a.theme_id AS a, b.theme_id AS b, round(len(list_intersect(a.keywords, b.keywords)) / CAST(len(list_distinct(list_concat(a.keywords, b.keywords))) AS DOUBLE), 6) AS jaccard FROM k a JOIN k b ON a.theme_id < b.theme_id
  WHERE len(list_intersect(a.keywords, b.keywords)) / CAST(len(list_distinct(list_concat(a.keywords, b.keywords))) AS DOUBLE) >= 0.35""")
def keyword_jaccard(spark, d):
    k = t(spark, d, "part").groupBy(F.col("p_brand").alias("theme_id")).agg(F.collect_set("p_size").alias("keywords"))
    return themes.keyword_likeness(k).select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@query("""WITH a AS (SELECT conv_id, role AS theme_id, turn, CASE CAST(turn % 3 AS INTEGER) WHEN 0 THEN 'core' WHEN 1 THEN 'adjacent' ELSE 'peripheral' END AS role, length(text) / 1000.0 AS confidence, text FROM conversations)
  SELECT conv_id, theme_id, CASE max(CASE role WHEN 'core' THEN 3 WHEN 'adjacent' THEN 2 ELSE 1 END) WHEN 3 THEN 'core' WHEN 2 THEN 'adjacent' ELSE 'peripheral' END AS role, round(max(confidence), 4) AS confidence, round(CAST(sum(turn) AS DOUBLE), 4) AS revenue_share_claim, arg_max(text, (length(text), -turn)) AS evidence_quote, CAST(count(DISTINCT text) FILTER (text <> '') AS INTEGER) AS n_segments FROM a GROUP BY 1, 2""")
def merge_assignments(spark, d):
    c = t(spark, d, "conversations")
    role = F.when(F.col("turn") % 3 == 0, "core").when(F.col("turn") % 3 == 1, "adjacent").otherwise("peripheral")
    rows = c.select("conv_id", F.col("role").alias("theme_id"), F.col("turn").alias("pos"), role.alias("role"), (F.length("text") / 1000).alias("confidence"), F.col("turn").cast("double").alias("revenue_share_claim"), F.col("text").alias("evidence_quote"), F.lit("business").alias("evidence_source"), F.col("text").alias("segment_name"), F.col("text").alias("rationale"))
    return verify.merge_assignments(rows, "conv_id").select("conv_id", "theme_id", "role", F.round("confidence", 4).alias("confidence"), F.round("revenue_share_claim", 4).alias("revenue_share_claim"), "evidence_quote", F.size("segments").alias("n_segments"))


@query("""WITH q AS (SELECT item_id, regexp_replace(text, '\\s+', '', 'g') AS q FROM benchmark WHERE length(regexp_replace(text, '\\s+', '', 'g')) >= 8), t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '\\s+', '', 'g') AS t FROM documents) SELECT t.doc_id, q.item_id FROM t JOIN q ON contains(t.t, q.q)""")
def verify_exact_citation(spark, d):
    """Every item of the benchmark against every whole document."""
    return verify.quoted_items(t(spark, d, "documents"), t(spark, d, "benchmark"))


@query()
def verify_fuzzy_citation(spark, d):
    """Each turn, whole, against the turn before it."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = t(spark, d, "conversations").withColumn("source", F.lag("text").over(w)).withColumn("quote", F.col("text")).filter("source IS NOT NULL")
    return verify.verify_citations(rows, "quote", "source").select("conv_id", "turn", F.round("similarity", 4).alias("similarity"), "cited")


_TAGS = """a AS (SELECT CAST(conv_id AS VARCHAR) AS ticker, CASE WHEN conv_id % 9 = 8 THEN 'unheard' WHEN turn % 4 < 2 THEN 'semi' ELSE 'bio' END AS theme_id, turn, CASE CAST(turn % 3 AS INTEGER) WHEN 0 THEN 'core' WHEN 1 THEN 'adjacent' ELSE 'peripheral' END AS role, text AS quote, CASE WHEN turn % 2 = 0 THEN 'business' ELSE 'segments' END AS src, CASE CAST(conv_id % 4 AS INTEGER) WHEN 0 THEN 0.0 WHEN 1 THEN 0.1 ELSE 0.5 END AS claim, CASE WHEN turn % 4 = 0 THEN 'Wafers' WHEN turn % 4 = 1 THEN 'Tools' WHEN turn % 4 = 3 THEN 'Drugs' END AS seg FROM conversations)"""


@query(f"""WITH {_TAGS}, m AS (SELECT ticker, theme_id, CASE max(CASE role WHEN 'core' THEN 3 WHEN 'adjacent' THEN 2 ELSE 1 END) WHEN 3 THEN 'core' WHEN 2 THEN 'adjacent' ELSE 'peripheral' END AS role, sum(CAST(claim AS DOUBLE)) AS claim, arg_max(quote, (length(quote), -turn)) AS quote, arg_max(src, (length(quote), -turn)) AS src, list_distinct(list(seg) FILTER (seg IS NOT NULL)) AS segs FROM a GROUP BY 1, 2),
  p AS (SELECT CAST(conv_id AS VARCHAR) AS ticker, conv_id AS n, string_agg(text, chr(10) ORDER BY turn) FILTER (turn % 2 = 0) AS business, string_agg(text, chr(10) ORDER BY turn) FILTER (turn % 4 = 1) AS segs FROM conversations GROUP BY 1, 2),
  j AS (SELECT m.*, n, theme_id IN ('semi', 'bio') AS known, regexp_replace(quote, '\\s+', '', 'g') AS q, regexp_replace(coalesce(business, ''), '\\s+', '', 'g') AS b, regexp_replace(coalesce(p.segs, ''), '\\s+', '', 'g') AS s FROM m JOIN p USING (ticker)),
  c AS (SELECT *, CASE WHEN length(q) < 8 THEN NULL WHEN src = 'segments' AND contains(s, q) THEN 'segments' WHEN contains(b, q) THEN 'business' WHEN contains(s, q) THEN 'segments' END AS cited_as, CASE theme_id WHEN 'semi' THEN 0.35 END AS floor,
    CASE WHEN n % 3 = 0 AND len(list_filter(coalesce(segs, []), lambda x: x IN ('Wafers', 'Tools'))) > 0 THEN CAST(0.25 * len(list_filter(segs, lambda x: x = 'Wafers')) + 0.15 * len(list_filter(segs, lambda x: x = 'Tools')) AS DOUBLE) END AS actual FROM j),
  v AS (SELECT *, known AND cited_as IS NOT NULL AS ok, coalesce(role = 'core' AND floor IS NOT NULL AND actual < floor, false) AS low, role = 'core' AND floor IS NOT NULL AND actual IS NULL AND claim > 0 AND claim < floor AS claimed_low FROM c)
  SELECT ticker, theme_id, CASE WHEN NOT ok THEN role WHEN low THEN CASE WHEN actual >= floor / 2 THEN 'adjacent' ELSE 'peripheral' END WHEN claimed_low THEN 'adjacent' ELSE role END AS role, CASE WHEN ok THEN 'verified' ELSE 'rejected' END AS status, CASE WHEN NOT known THEN 'unknown_theme' WHEN NOT ok THEN 'hallucinated_citation' END AS reject_reason, round(CASE WHEN ok THEN actual END, 6) AS actual_share,
  round(CASE WHEN ok AND claim <> 0 THEN claim END, 6) AS claimed_share, CASE WHEN NOT ok THEN 'unavailable' WHEN actual IS NOT NULL THEN CASE WHEN low THEN 'below_floor' ELSE 'confirmed' END WHEN role = 'core' AND claim = 0 THEN 'not_claimed' WHEN n % 3 = 0 THEN 'not_found' WHEN n % 3 = 1 THEN 'unverified' ELSE 'unavailable' END AS share_evidence,
  ok AND cited_as <> src AS moved, ok AND n % 5 <> 0 AND (theme_id = 'semi' AND n % 5 <> 1 OR theme_id = 'bio' AND n % 5 <> 2) AS sector_conflict FROM v""")
def verify_assignments(spark, d):
    has = lambda what: F.exists("flags", lambda f: f.startswith(what))
    return verdicts_of_tags(spark, d).select("ticker", "theme_id", "role", "status", "reject_reason", F.round("actual_share", 6).alias("actual_share"), F.round("claimed_share", 6).alias("claimed_share"), "share_evidence", has("citation_source_mismatch:").alias("moved"), has("sector_conflict").alias("sector_conflict"))


def verdicts_of_tags(spark, d) -> DataFrame:
    """Turns as tags of their conversation, which is their evidence too: every other turn is its business section, one in four its segments."""
    c = t(spark, d, "conversations")
    n, k = F.col("conv_id"), F.col("turn")
    tags = c.select(
        n.cast("string").alias("ticker"), F.when(n % 9 == 8, "unheard").when(k % 4 < 2, "semi").otherwise("bio").alias("theme_id"), k.alias("pos"), F.when(k % 3 == 0, "core").when(k % 3 == 1, "adjacent").otherwise("peripheral").alias("role"), F.lit(0.9).alias("confidence"), F.col("text").alias("evidence_quote"),
        F.when(k % 2 == 0, "business").otherwise("segments").alias("evidence_source"), F.when(n % 4 == 0, 0.0).when(n % 4 == 1, 0.1).otherwise(0.5).alias("revenue_share_claim"), F.when(k % 4 == 0, "Wafers").when(k % 4 == 1, "Tools").when(k % 4 == 3, "Drugs").alias("segment_name"), F.lit("").alias("rationale"),
    )
    joined = lambda rows: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(rows, F.struct("turn", "text")))), lambda x: x["text"]), "\n")
    part = lambda name, share: F.struct(F.lit(name).alias("name"), F.lit(share).alias("share"), F.lit(None).cast("string").alias("amount"), F.lit(None).cast("string").alias("path"))
    packs = c.groupBy("conv_id").agg(joined(k % 2 == 0).alias("business"), joined(k % 4 == 1).alias("segments_text")).select(
        n.cast("string").alias("ticker"), F.when(n % 5 == 0, None).when(n % 5 == 1, "SEMI").when(n % 5 == 2, "PHARMA_BIO").otherwise("STEEL").alias("sector_code"), "business", "segments_text", F.lit("").alias("disclosures"),
        F.when(n % 3 != 2, F.struct(F.array(part("Wafers", 0.25), part("Tools", 0.15)).alias("segments"), (n % 3 == 0).alias("corroborated"))).alias("segments"),
    )
    taxonomy = [themes.Theme("semi", ("SEMI",), 0.35), themes.Theme("bio", ("PHARMA_BIO",))]
    return verify.verify_assignments(tags, packs, taxonomy, {"SEMI", "PHARMA_BIO", "STEEL"})


@query("""WITH a AS (SELECT conv_id, turn, CASE WHEN length(text) / CAST(1000 AS DOUBLE) + 0.6 < 0.75 THEN 'low_confidence' WHEN turn % 4 = 3 THEN 'core_assignment' WHEN role = 'user' AND abs(CAST(turn % 5 AS DOUBLE) / 5 - 0.5) > 0.2 THEN 'share_mismatch' END AS why FROM conversations)
  SELECT conv_id, CASE WHEN conv_id % 17 = 0 THEN 'proposed_new_theme' ELSE arg_min(why, turn) FILTER (why IS NOT NULL) END AS reason FROM a GROUP BY conv_id""")
def escalation(spark, d):
    k = F.col("turn")
    one = F.struct(k, F.col("role").alias("theme_id"), (F.length("text") / 1000 + 0.6).alias("confidence"), F.when(k % 4 == 3, "core").otherwise("adjacent").alias("role"), ((k % 5).cast("double") / 5).alias("revenue_share_claim"))
    tags = t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("assignments")).withColumns({"proposed_new_theme": F.when(F.col("conv_id") % 17 == 0, "new"), "theme_segment_share": F.create_map(F.lit("user"), F.lit(0.5))})
    return themes.escalate(tags).select("conv_id", "reason")


@query()
def plain_text(spark, d):
    return t(spark, d, "pages").select("page_id", text.plain_text(F.col("html")).alias("text"))


@query("""WITH s AS (SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS v FROM lineitem GROUP BY 1), n AS (SELECT n_regionkey, n_name, trunc(sum(coalesce(v, 0))) AS v FROM supplier JOIN nation ON n_nationkey = s_nationkey LEFT JOIN s ON l_suppkey = s_suppkey GROUP BY 1, 2)
  SELECT n_regionkey, 'table_amount' AS method, true AS corroborated, n_name AS name, round(v / sum(v) OVER (PARTITION BY n_regionkey), 4) AS share FROM n QUALIFY count(*) OVER (PARTITION BY n_regionkey) > 1""")
def segment_parse(spark, d):
    """Nations by revenue as a piped table a region, parsed back into shares."""
    s = companies(spark, d).join(t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("ticker"), "s_nationkey"), "ticker").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey", "n_name").agg(F.sum(F.coalesce("revenue_ttm", F.lit(0.0))).alias("v"))
    body = F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("| "), F.col("n_name"), F.lit(" | "), F.col("v").cast("long").cast("string"), F.lit(" |")))), "\n")
    doc = s.groupBy("n_regionkey").agg(F.concat(F.lit("매출실적\n| 사업부문 | 당기 |\n"), body).alias("text"), F.sum("v").alias("revenue"))
    return doc.select("n_regionkey", documents.segments("text", "revenue").alias("s")).select("n_regionkey", "s.method", "s.corroborated", F.explode("s.segments").alias("g")).select("n_regionkey", "method", "corroborated", "g.name", F.round("g.share", 4).alias("share"))


@query()
def section_excerpt(spark, d):
    doc = F.concat(F.lit("II. 사업의 내용\n1. 사업의 개요\n"), F.coalesce("text", F.lit("")), F.lit("\n2. 매출 현황\n매출.\nIII. 재무에 관한 사항\n"))
    return t(spark, d, "documents").select("doc_id", documents.section_excerpt(doc).alias("x")).select("doc_id", F.length("x.text").alias("n"), F.array_join("x.dropped", "|").alias("dropped"))


@query("""WITH g AS (SELECT doc_id, CASE WHEN quality = 0 THEN 'bad' END AS theme FROM labels), p AS (SELECT DISTINCT doc_id, 'bad' AS theme FROM documents WHERE regexp_matches(text, '[#*%]{3}|!!') AND doc_id IN (SELECT doc_id FROM labels)), w AS (SELECT DISTINCT doc_id, theme FROM g WHERE theme IS NOT NULL),
  j AS (SELECT w.doc_id AS gd, p.doc_id AS pd FROM w FULL JOIN p ON p.doc_id = w.doc_id), n AS (SELECT count(*) FILTER (gd IS NOT NULL AND pd IS NOT NULL) AS tp, count(*) FILTER (gd IS NULL) AS fp, count(*) FILTER (pd IS NULL) AS fn FROM j), r AS (SELECT *, tp / CAST(nullif(tp + fp, 0) AS DOUBLE) AS p, tp / CAST(nullif(tp + fn, 0) AS DOUBLE) AS r FROM n)
  SELECT tp, fp, fn, round(p, 4) AS precision, round(r, 4) AS recall, round(2 * p * r / nullif(p + r, 0), 4) AS f1, round(1 - p, 4) AS misclassified FROM r""")
def golden_scores(spark, d):
    gold = t(spark, d, "labels").select(F.col("doc_id").alias("ticker"), F.when(F.col("quality") == 0, "bad").alias("theme"))
    return verify.golden_scores(gold, t(spark, d, "documents").filter(F.col("text").rlike("[#*%]{3}|!!")).select(F.col("doc_id").alias("ticker"), F.lit("bad").alias("theme")))


# values and roll-ups
@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_props(spark, d):
    return t(spark, d, "events").select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


@query("SELECT event_type AS kind, CAST(user_id AS VARCHAR) AS name, count(*) AS n, count(DISTINCT CAST(ts AS DATE)) AS things, round(avg(value), 8) AS mean FROM events GROUP BY 1, 2")
def report_rollup(spark, d):
    e = t(spark, d, "events").select(F.col("event_type").alias("kind"), F.col("user_id").cast("string").alias("name"), F.to_date("ts").alias("day"), "value")
    return roll_up(e, ["kind", "name"], "value", "day").withColumn("mean", F.round("mean", 8))


@query("""SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS ticker6, CAST(o_orderdate AS DATE) + 46 AS expires_at, last_day(make_date(year(o_orderdate), 12, 1)) AS fiscal_end, CASE WHEN o_totalprice <> 0 THEN round(o_custkey / o_totalprice, 8) END AS ratio FROM orders""")
def scalar_functions(spark, d):
    o = t(spark, d, "orders")
    return o.select("o_orderkey", text.ticker6(F.col("o_custkey").cast("string")).alias("ticker6"), dates.expiry(F.to_date("o_orderdate"), F.lit(46), F.lit(None).cast("date")).alias("expires_at"), dates.fiscal_end(F.year("o_orderdate"), F.lit(12)).alias("fiscal_end"), F.round(nulls.ratio(F.col("o_custkey"), F.col("o_totalprice")), 8).alias("ratio"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN -abs(s_acctbal) WHEN s_suppkey % 4 = 1 THEN NULL ELSE s_acctbal END AS statement, CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE abs(s_acctbal) END AS event FROM supplier""")
def number_parsers(spark, d):
    bal, k = F.col("s_acctbal"), F.col("s_suppkey") % 4
    plain = F.format_string("%.2f", bal)
    grouped = F.format_string("%,.2f", F.abs(bal))
    stated = F.when(k == 0, F.concat(F.lit("("), grouped, F.lit(")"))).when(k == 1, "-").otherwise(plain)
    return t(spark, d, "supplier").select("s_suppkey", text.statement_amount(stated).alias("statement"), text.event_amount(F.when(k == 1, "―").when(k == 2, F.concat(F.lit("약 "), grouped, F.lit("원"))).otherwise(grouped)).alias("event"))


@query("SELECT doc_id, substring(sha256(CAST(doc_id AS VARCHAR) || chr(0) || coalesce(text, '') || chr(0) || coalesce(source, '') || chr(0) || '[]' || chr(0)), 1, 32) AS pack_hash FROM documents")
def pack_hash(spark, d):
    return t(spark, d, "documents").select("doc_id", documents.pack_hash(F.col("doc_id").cast("string"), F.col("text"), F.col("source"), F.lit("[]")).alias("pack_hash"))


@query("SELECT count(*) AS n, CAST(sum(ceil(length(text) / 2.2)) AS BIGINT) AS input_tokens, count(*) * 400 AS output_tokens, CAST(ceil(count(*) * 0.3) AS BIGINT) AS escalated FROM documents")
def cost_estimate(spark, d):
    return themes.cost_estimate(t(spark, d, "documents"), F.col("text"))


@query("""SELECT CASE WHEN o_orderstatus = 'F' THEN 'status' ELSE 'evidence' END AS kind, o_orderpriority AS name, count(*) AS n FROM orders GROUP BY 1, 2 UNION ALL SELECT 'all', o_orderstatus, count(*) FROM orders GROUP BY 2""")
def value_counts(spark, d):
    o = t(spark, d, "orders")
    by = o.groupBy(F.when(F.col("o_orderstatus") == "F", "status").otherwise("evidence").alias("kind"), F.col("o_orderpriority").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return by.unionByName(o.groupBy(F.lit("all").alias("kind"), F.col("o_orderstatus").alias("name")).agg(F.count(F.lit(1)).alias("n")))


@query("""WITH g AS (SELECT doc_id, coalesce(quality, 1) = 0 AS bad FROM labels), p AS (SELECT DISTINCT doc_id FROM documents WHERE regexp_matches(text, '!!')), e AS (SELECT 'fp' AS error, lang AS theme FROM documents d JOIN p USING (doc_id) JOIN g USING (doc_id) WHERE NOT bad UNION ALL SELECT 'fn', lang FROM documents d JOIN g USING (doc_id) WHERE bad AND doc_id NOT IN (SELECT doc_id FROM p)),
  c AS (SELECT error, theme, count(*) AS n FROM e GROUP BY 1, 2) SELECT error, theme, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY error ORDER BY n DESC, theme) AS rank FROM c) WHERE rank <= 5""")
def golden_top_errors(spark, d):
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("ticker"), F.col("lang").alias("theme"), F.col("text").rlike("!!").alias("hit"))
    labels = t(spark, d, "labels").select(F.col("doc_id").alias("ticker"), (F.coalesce("quality", F.lit(1)) == 0).alias("bad"))
    gold = labels.join(docs, "ticker", "left").select("ticker", F.when(F.col("bad"), F.col("theme")).alias("theme"))
    return verify.top_errors(gold, docs.filter("hit").select("ticker", "theme"))


# universe, labels, verdicts
_MASTER = """master AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_mktsegment AS industry, c_custkey % 7 = 0 AS is_preferred, c_custkey % 11 = 0 AS is_spac, l.day AS listing_date FROM customer LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS day FROM orders GROUP BY 1) l ON l.o_custkey = c_custkey)"""


def _master(spark, d) -> DataFrame:
    first = t(spark, d, "orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("listing_date"))
    c = t(spark, d, "customer").join(first, F.col("o_custkey") == F.col("c_custkey"), "left")
    return c.select(F.col("c_custkey").cast("string").alias("ticker"), F.lit(None).cast("string").alias("name"), F.col("c_mktsegment").alias("industry"), (F.col("c_custkey") % 7 == 0).alias("is_preferred"), (F.col("c_custkey") % 11 == 0).alias("is_spac"), "listing_date")


@query(f"WITH {_MASTER} SELECT ticker, listing_date FROM master WHERE NOT is_preferred AND NOT is_spac AND (listing_date IS NULL OR listing_date < DATE '1996-01-01')")
def pre_ingest_filter(spark, d):
    return universe.eligible(_master(spark, d), date(1996, 1, 1)).select("ticker", "listing_date")


_SECTORS = [("^AUTO", "AUTO"), ("MACHIN", "MACHINERY"), ("^(BUILD|HOUSE)", "CONSTRUCTION")]


@query("WITH s AS (SELECT CASE WHEN regexp_matches(c_mktsegment, '^AUTO') THEN 'AUTO' WHEN regexp_matches(c_mktsegment, 'MACHIN') THEN 'MACHINERY' WHEN regexp_matches(c_mktsegment, '^(BUILD|HOUSE)') THEN 'CONSTRUCTION' END AS sector_code FROM customer) SELECT sector_code, count(*) AS n, round(count(*) / CAST((SELECT count(*) FROM s) AS DOUBLE), 4) AS share FROM s GROUP BY 1")
def sector_coverage(spark, d):
    return universe.sector_coverage(universe.annotate(_master(spark, d), _SECTORS))


@query(f"SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderkey AS VARCHAR) AS source_doc_id, CAST(o_orderdate AS DATE) AS reported_at FROM orders WHERE CAST(o_orderdate AS DATE) + 1 <= {DAY} AND o_orderpriority = '1-URGENT' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY last_day(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1)) DESC, o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) = 1")
def latest_filing(spark, d):
    f = facts(spark, d).filter("element = '1-URGENT'").withColumn("period_type", F.lit("FY")).withColumn("source_doc_id", F.col("fact_id").cast("long").cast("string"))
    return universe.latest_filing(f, AS_OF).select("ticker", "source_doc_id", "reported_at")


@query("SELECT count(*) AS universe, count(p.user_id) AS priced, round(count(p.user_id) / CAST(count(*) AS DOUBLE), 4) AS coverage FROM customer LEFT JOIN (SELECT DISTINCT user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10') p ON p.user_id = c_custkey")
def price_coverage(spark, d):
    p = t(spark, d, "events").select(F.to_date("ts").alias("date"), F.col("user_id").cast("string").alias("ticker"))
    return universe.coverage(p, _master(spark, d), date(2024, 1, 10))


@query("""WITH w AS (SELECT CAST(l_orderkey AS VARCHAR) AS ticker, l_linenumber AS ord, CAST(l_quantity AS BIGINT) AS shares, CASE WHEN l_returnflag = 'N' THEN 'common' WHEN l_returnflag = 'R' THEN 'other' END AS kind FROM lineitem)
  SELECT ticker, arg_max(shares, (ord, shares)) FILTER (kind = 'common') AS common, CAST(sum(shares) FILTER (kind = 'other') AS BIGINT) AS other FROM w WHERE kind IS NOT NULL GROUP BY 1""")
def share_counts(spark, d):
    label = F.when(F.col("l_returnflag") == "N", "보통주").when(F.col("l_returnflag") == "R", "1종 종류주식").otherwise("합계")
    return prices.share_counts(t(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("ticker"), label.alias("label"), F.col("l_quantity").cast("long").alias("shares"), F.col("l_linenumber").alias("ord")))


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name ELSE trim(p_name) END AS report_key, p_size % 2 = 1 AS is_amendment FROM part""")
def report_names(spark, d):
    name = F.when(F.col("p_size") % 2 == 1, F.concat(F.lit("[기재정정] "), F.col("p_name"))).otherwise(F.col("p_name"))
    return t(spark, d, "part").select("p_partkey", text.report_key(name).alias("report_key"), text.is_amendment(name).alias("is_amendment"))


@query("""WITH v AS (SELECT conv_id, role, turn, CASE WHEN turn % 5 = 4 THEN NULL WHEN turn % 5 = 3 THEN 0.1 ELSE 0.5 END AS actual, CASE WHEN turn % 2 = 0 THEN 0.4 ELSE 0.0 END AS claim, length(text) > 40 AS cited FROM conversations)
  SELECT conv_id, turn, CASE WHEN NOT cited THEN 'core' WHEN actual < 0.3 THEN CASE WHEN actual >= 0.15 THEN 'adjacent' ELSE 'peripheral' END ELSE 'core' END AS role, CASE WHEN cited THEN 'verified' ELSE 'rejected' END AS status, CASE WHEN NOT cited THEN 'hallucinated_citation' END AS reject_reason,
  CASE WHEN NOT cited THEN 'unavailable' WHEN actual IS NOT NULL THEN CASE WHEN actual < 0.3 THEN 'below_floor' ELSE 'confirmed' END WHEN claim = 0 THEN 'not_claimed' ELSE 'unavailable' END AS share_evidence FROM v""")
def verdicts(spark, d):
    c = t(spark, d, "conversations")
    n = F.col("turn") % 5
    rows = c.select(
        F.concat_ws(":", "conv_id", "turn").alias("ticker"), F.col("role").alias("theme_id"), F.lit("core").alias("role"), F.lit(1.0).alias("confidence"), F.lit("business").alias("evidence_source"), F.lit("business").alias("cited_as"), F.lit(True).alias("known"), (F.length("text") > 40).alias("cited"),
        F.lit("SEMI").alias("sector_code"), F.lit(True).alias("sector_ok"), F.lit(0.3).alias("floor"), F.when(n == 4, None).when(n == 3, 0.1).otherwise(0.5).alias("actual"), F.when(F.col("turn") % 2 == 0, 0.4).otherwise(0.0).alias("revenue_share_claim"), F.lit(False).alias("has_segments"), F.lit(False).alias("unverified_segments"),
    )
    parts = F.split("ticker", ":")
    return verify.judge(rows).select(parts[0].cast("long").alias("conv_id"), parts[1].cast("long").alias("turn"), "role", "status", "reject_reason", "share_evidence")


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2")
def windowed_counts(spark, d):
    e = t(spark, d, "events").withColumn("v", F.col("value").cast("decimal(18,2)"))
    return ingest.windowed(e, "ts", "event_type", "v").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.col("total").cast("double").alias("total"))


def entry(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as companies: derived metrics, guards, the adaptive gate and the ranking."""
    eligible, _ = gate.guard(flagged(spark, d), ["capital_impairment", "stale_financials"])
    return gate.run(eligible, gate.Gate(_FILTERS, _WEIGHTS, target=30, cap=40))[0].select("ticker", F.round("score", 6).alias("score"), "rank")
