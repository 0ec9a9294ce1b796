"""Which companies are looked at: filters before ingestion, sector annotation and its coverage, latest filings, sources."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofia.functions.nulls import hit
from asofia.functions.text import first_match, is_reit, is_spac, looks_like_holding, squeeze, ticker6
from asofia.operators.metrics import FIN
from asofia.operators.pit import newest


def eligible(master: DataFrame, listed_before: date | None = None, *, seed: int = 0, sample: int | None = None, head: int | None = None, tickers: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """Common lines that are no shell companies; listed before a date, of a list, a seeded sample or the first few by ticker, where asked for."""
    rows = master.filter(~hit(F.col("is_preferred")) & ~hit(F.col("is_spac")))
    if listed_before is not None:
        rows = rows.filter(F.col("listing_date").isNull() | (F.col("listing_date") < F.lit(listed_before)))
    if tickers is not None:
        rows = rows.filter(F.col("ticker").isin(tickers))
    if sample is not None:
        rows = rows.orderBy(F.xxhash64("ticker", F.lit(seed)), "ticker").limit(sample)
    return rows.orderBy("ticker").limit(head) if head is not None else rows


def annotate(master: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Sector by the first rule that an industry meets; holdings, shell companies and trusts by name. What no rule meets is null, not a guess."""
    industry, name = squeeze(F.coalesce("industry", F.lit(""))), F.coalesce("name", F.lit(""))
    sector = F.when(looks_like_holding(name), "HOLDING").otherwise(first_match(industry, rules))
    return master.withColumns({"sector_code": sector, "is_spac": is_spac(name), "is_reit": is_reit(name), "is_holding": looks_like_holding(name), "is_financial": hit(sector.isin(*FIN)), "unmapped_industry": sector.isNull()})


def with_corp_codes(master: DataFrame, codes: DataFrame) -> DataFrame:
    """master with the corp_code of codes (stock_code, corp_code), where one is listed under the ticker; of several the smallest."""
    listed = codes.filter(F.length(F.trim("stock_code")) > 0).groupBy(ticker6(F.trim("stock_code")).alias("ticker")).agg(F.min("corp_code").alias("corp_code"))
    return master.drop("corp_code").join(listed, "ticker", "left")


def sector_coverage(master: DataFrame) -> DataFrame:
    """sector_code, n and share of all, unmapped ones included as null."""
    n = master.groupBy("sector_code").agg(F.count(F.lit(1)).alias("n"))
    total = master.count()
    return n.withColumn("share", F.round(F.col("n") / F.lit(total or 1), 4))


def latest_filing(facts: DataFrame, as_of: date) -> DataFrame:
    """The last annual filing of each ticker that was available at as_of."""
    rows = facts.filter((F.col("period_type") == "FY") & (F.col("available_at") <= F.lit(as_of)))
    return newest(rows, ["ticker"], F.col("fiscal_end_date").desc(), F.col("reported_at").desc(), F.col("source_doc_id").desc()).select("ticker", "source_doc_id", "fiscal_end_date", "reported_at")


def available_sources(facts: DataFrame, as_of: date, sources: dict[str, tuple[str, ...]]) -> set[str]:
    """Sources of which any element was there at as_of: one pass."""
    if not sources:
        return set()
    seen = facts.filter(F.col("available_at") <= F.lit(as_of))
    row = seen.agg(*[F.count_if(F.col("element").isin(*e)).alias(s) for s, e in sources.items()]).first()
    return {s for s in sources if row[s]}


def coverage(prices: DataFrame, universe: DataFrame, day: date) -> DataFrame:
    """One row: how many of the universe have a price on the day, and their share."""
    have = prices.filter(F.col("date") == F.lit(day)).select("ticker").distinct().withColumn("_p", F.lit(1))
    both = universe.select("ticker").distinct().join(have, "ticker", "left").agg(F.count(F.lit(1)).alias("universe"), F.count("_p").alias("priced"))
    return both.withColumn("coverage", F.round(F.try_divide(F.col("priced").cast("double"), F.col("universe").cast("double")), 4))


def last_trading_day(prices: DataFrame, until: date) -> date | None:
    """From the data, not from a calendar."""
    return prices.filter(F.col("date") <= F.lit(until)).agg(F.max("date")).first()[0]
