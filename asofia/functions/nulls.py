"""Missing is null, never NaN; a comparison with it is no hit; a division by zero is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(a: Column, b: Column) -> Column:
    """a / b; null for a zero denominator, an infinite result or a missing part."""
    q = F.try_divide(a.cast("double"), b.cast("double"))
    return F.when(F.isnan(q) | (F.abs(q) == F.lit(float("inf"))), None).otherwise(q)


def zero(c: Column) -> Column:
    """Null counts as 0: only where a rule says so."""
    return F.coalesce(c, F.lit(0.0))


def hit(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def no_nan(df: DataFrame) -> DataFrame:
    """NaN and infinities of all floating columns become null; for data that enters."""
    bad = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.when(~bad(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns])


def pick(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """A fixed list of columns (name, type); those that df lacks are null."""
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(k).alias(n) for n, k in columns])
