"""Idempotent streaming ingestion into the store, and windowed counts of an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from asofia.sources.store import Store


def files(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def append_stream(stream: DataFrame, store: Store, name: str, checkpoint: str) -> StreamingQuery:
    """Every batch appends what is new by key, so a batch that is repeated adds nothing. There is no watermark: late corrections count."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda batch, _: store.append(name, batch) and None).start()


def windowed(stream: DataFrame, time: str, key: str, value: str, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and sums by key and tumbling window; what comes later than the watermark is left out, as counts must close. Works on tables too."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), key, "n", "total")


def assert_coverage(have: int, expected: int, least: float = 0.9) -> float:
    """A daily step that covers too little fails."""
    share = have / expected if expected else 0.0
    if share < least:
        raise ValueError(f"coverage {share:.3f} is below {least}")
    return share
