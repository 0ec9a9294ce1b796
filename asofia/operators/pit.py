"""Point-in-time views: what was knowable at a date. Filters stand below the windows, so scans prune."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

FACT_KEY = ["ticker", "element", "fiscal_end_date", "period_type", "statement_basis"]


def fact_id(*parts: Column) -> Column:
    """First 32 hex digits of the SHA-256 of the parts, each ended by NUL."""
    ended = [x for p in parts for x in (F.coalesce(p.cast("string"), F.lit("")), F.lit("\0"))]
    return F.substring(F.sha2(F.concat(*ended), 256), 1, 32)


def newest(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order, which should end in something unique."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_rn = 1").drop("_rn")


def facts_asof(facts: DataFrame, as_of: date, tickers: list[str] | DataFrame | None = None) -> DataFrame:
    """The newest revision of each fact that was available at as_of."""
    seen = facts.filter(F.col("available_at") <= F.lit(as_of))
    if isinstance(tickers, DataFrame):
        seen = seen.join(tickers.select("ticker").distinct(), "ticker", "left_semi")
    elif tickers is not None:
        seen = seen.filter(F.col("ticker").isin(tickers))
    ties = [F.col("ingested_at").desc()] if "ingested_at" in facts.columns else []
    return newest(seen, FACT_KEY, F.col("reported_at").desc(), *ties, F.col("fact_id").desc())


def latest_fact_asof(facts: DataFrame, as_of: date, element: str) -> DataFrame:
    """One row a ticker: consolidated before separate, then the latest period, then the newest report."""
    seen = facts_asof(facts.filter(F.col("element") == element), as_of)
    return newest(seen, ["ticker"], (F.col("statement_basis") != "CFS").asc(), F.col("fiscal_end_date").desc(), F.col("reported_at").desc(), F.col("fact_id").desc())


def fixed_basis(facts: DataFrame, key: list[str], basis: str = "statement_basis", preferred: str = "CFS") -> DataFrame:
    """Rows of the preferred basis where a key has any, else its others: never both."""
    best = F.min((F.col(basis) != preferred).cast("int")).over(Window.partitionBy(*key))
    return facts.withColumn("_best", best).filter((F.col(basis) != preferred).cast("int") == F.col("_best")).drop("_best")


def prices_asof(prices: DataFrame, as_of: date, order: str = "date") -> DataFrame:
    """The last price row of each ticker up to as_of: one aggregate, no sort."""
    rest = [c for c in prices.columns if c != "ticker"]
    last = prices.filter(F.col(order) <= F.lit(as_of)).groupBy("ticker").agg(F.max_by(F.struct(*rest), F.struct(order, *[c for c in ("event_id",) if c in rest])).alias("r"))
    return last.select("ticker", "r.*")


def status_asof(status: DataFrame, as_of: date) -> DataFrame:
    seen = status.filter(F.col("effective_from").isNotNull() & (F.col("effective_from") <= F.lit(as_of)))
    return seen.groupBy("ticker", "status").agg(F.min("effective_from").alias("effective_from"), F.min_by("reason", F.struct("effective_from", "reason")).alias("reason"), F.max("snapshot_date").alias("snapshot_date"))


def disclosures_asof(disclosures: DataFrame, as_of: date, since: date | None = None) -> DataFrame:
    seen = disclosures.filter(F.col("rcept_dt") <= F.lit(as_of))
    return (seen.filter(F.col("rcept_dt") >= F.lit(since)) if since else seen).orderBy(F.col("rcept_dt").desc(), "rcept_no")


def listed_asof(master: DataFrame, delistings: DataFrame, as_of: date) -> DataFrame:
    """Lines listed at as_of: those alive today that were listed by then, and those delisted later. alive tells which.

    A line without a listing date was there from the start. A ticker of the master is alive whatever the delistings say;
    a line that was delisted twice later counts twice, as the list has it.
    """
    by_then = F.col("listing_date").isNull() | (F.col("listing_date") <= F.lit(as_of))
    more = lambda df, *extra: [F.col(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in (("listing_date", "date"), *extra)]
    ends = (("delisting_date", "date"), ("outcome", "string"))
    alive = master.filter(by_then).select("ticker", F.lit(True).alias("alive"), *more(master), *[F.lit(None).cast(k).alias(c) for c, k in ends])
    gone = delistings.filter(by_then & (F.col("delisting_date") > F.lit(as_of))).join(master.select("ticker"), "ticker", "left_anti")
    return alive.unionByName(gone.select("ticker", F.lit(False).alias("alive"), *more(delistings, *ends)))


def survivorship(master: DataFrame, delistings: DataFrame, facts: DataFrame, as_of: date) -> DataFrame:
    """One row: how many were listed, how many of them are gone today and by which outcome, and how many have facts that were available at as_of."""
    then = listed_asof(master, delistings, as_of)
    known = facts.filter(F.col("available_at") <= F.lit(as_of)).select("ticker").distinct().withColumn("has_facts", F.lit(True))
    own = then.join(known, "ticker", "left")
    total = own.groupBy("alive", "outcome").agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("k"))
    seen = own.filter("has_facts").select("ticker").distinct().agg(F.lit(None).cast("boolean").alias("alive"), F.lit(None).cast("string").alias("outcome"), F.lit(0).cast("long").alias("n"), F.count(F.lit(1)).alias("k"))
    some = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    by = F.array_sort(F.collect_list(F.when(~F.col("alive") & F.col("outcome").isNotNull(), F.struct("outcome", "n"))))  # one entry an outcome
    whole = total.unionByName(seen).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("listed"), some(F.col("alive")).alias("alive"), some(~F.col("alive")).alias("gone"), by.alias("by"), F.sum("k").alias("with_facts"))
    outcomes = F.array_join(F.transform("by", lambda o: F.concat(o["outcome"], F.lit(":"), o["n"].cast("string"))), "|")
    share = F.when(F.col("listed") > 0, F.round(F.col("with_facts") / F.col("listed"), 4)).otherwise(0.0)
    return whole.select("listed", "alive", "gone", outcomes.alias("outcomes"), "with_facts", (F.col("listed") - F.col("with_facts")).alias("missing"), share.alias("coverage"))


def revision_history(facts: DataFrame, element: str | None = None) -> DataFrame:
    """All revisions in order; nothing is ever updated."""
    rows = facts if element is None else facts.filter(F.col("element") == element)
    w = Window.partitionBy(*FACT_KEY)
    return rows.withColumn("revision", F.row_number().over(w.orderBy("reported_at", "available_at", "fact_id"))).withColumn("revisions", F.count(F.lit(1)).over(w))


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: list[str], tie: str) -> DataFrame:
    """Each left row with the newest right row of its key at or before its time: union and last non-null, one shuffle, no range join.

    tie orders right rows of the same time. A right row counts for left rows of the same time.
    """
    packed = F.struct(*values)
    a = left.select(F.col(key).alias("_k"), F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[tie].dataType).alias("_tie"), F.struct(*left.columns).alias("_l"), F.lit(None).cast(right.select(packed.alias("v")).schema["v"].dataType).alias("_r"))
    b = right.select(F.col(key).alias("_k"), F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), F.lit(None).cast(a.schema["_l"].dataType).alias("_l"), packed.alias("_r"))
    w = Window.partitionBy("_k").orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    return a.unionByName(b).withColumn("_r", F.last("_r", True).over(w)).filter("_side = 1").select("_l.*", *[F.col(f"_r.{v}") for v in values])
