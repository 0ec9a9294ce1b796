"""Price tables: capitalisations, reconciliation of sources, preferred lines, traded value."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from asofia.functions.nulls import hit
from asofia.functions.text import share_class

TOLERANCE = 0.02


def trailing_mean(value: Column, key: str, order: list[str], rows: int = 20) -> Column:
    """Mean over a row and the rows before it, so many in all."""
    return F.avg(value).over(Window.partitionBy(key).orderBy(*order).rowsBetween(1 - rows, 0))


def share_counts(lines: DataFrame) -> DataFrame:
    """ticker, common, other from labelled lines (ticker, label, shares, ord): classes add up, of common lines the last one counts."""
    kind = lines.withColumn("kind", share_class(F.col("label"))).filter("kind IS NOT NULL AND shares IS NOT NULL")
    return kind.groupBy("ticker").agg(F.max_by("shares", F.when(F.col("kind") == "common", F.struct("ord", "shares"))).alias("common"), F.sum(F.when(F.col("kind") == "other", F.col("shares"))).alias("other"))


def price_table(prices: DataFrame, shares: DataFrame) -> DataFrame:
    """Capitalisations; missing where common shares are."""
    both = prices.join(shares, "ticker", "left")
    common = F.col("close") * F.col("shares_common")
    return both.withColumn("market_cap_common", common).withColumn("market_cap_total", F.when(common.isNotNull(), F.col("close") * (F.col("shares_common") + F.coalesce("shares_other", F.lit(0)))))


def reconcile(primary: DataFrame, other: DataFrame | None, tolerance: float = TOLERANCE) -> DataFrame:
    """primary with compared and disagrees; a value of the other source never replaces one. Missing in either: not compared."""
    if other is None:
        return primary.withColumn("other_close", F.lit(None).cast("double")).withColumn("compared", F.lit(False)).withColumn("disagrees", F.lit(False))
    both = primary.join(other.select("ticker", F.col("close").alias("other_close")), "ticker", "left")
    apart = F.abs(F.try_divide(F.col("close") - F.col("other_close"), F.col("other_close")))
    return both.withColumn("compared", F.col("close").isNotNull() & F.col("other_close").isNotNull()).withColumn("disagrees", hit(apart > tolerance))


def roll_up_preferred(lines: DataFrame, parent: Column) -> DataFrame:
    """Common lines with the capitalisation of their preferred lines on the same day: (date, ticker, cap), parent null for common lines."""
    marked = lines.withColumn("parent", parent)
    preferred = marked.filter("parent IS NOT NULL").groupBy("date", F.col("parent").alias("ticker")).agg(F.sum("cap").alias("preferred_cap"))
    common = marked.filter("parent IS NULL").drop("parent")
    return common.join(preferred, ["date", "ticker"], "left").withColumn("total_cap", F.col("cap") + F.coalesce("preferred_cap", F.lit(0).cast(lines.schema["cap"].dataType)))


def to_fetch(universe: DataFrame, stored: DataFrame, day: date, days: int = 40) -> DataFrame:
    """ticker and since: what an incremental fetch up to a day still lacks, of each ticker the days after its last stored one, at most so many."""
    last = stored.filter(F.col("date") <= F.lit(day)).groupBy("ticker").agg(F.max("date").alias("last"))
    since = F.greatest(F.coalesce(F.date_add("last", 1), F.date_sub(F.lit(day), days)), F.date_sub(F.lit(day), days))
    return universe.select("ticker").distinct().join(last, "ticker", "left").select("ticker", since.alias("since")).filter(F.col("since") <= F.lit(day))


def probe(source: DataFrame, columns: tuple[str, ...] = ("ticker", "close", "price_date")) -> dict[str, object]:
    """A source's contract: columns, rows, positive closes. Faults are returned, not raised."""
    lack = [c for c in columns if c not in source.columns]
    if lack:
        return {"ok": False, "rows": 0, "errors": [f"no column {c}" for c in lack]}
    n, bad = source.agg(F.count(F.lit(1)), F.count_if(~hit(F.col("close") > 0))).first()
    errors = (["no rows"] if not n else []) + ([f"{bad} rows without a positive close"] if bad else [])
    return {"ok": not errors, "rows": n, "errors": errors}
