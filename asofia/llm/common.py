"""Helpers shared by the training-data operators: the shared folder, tables cut from lineage, hot-safe joins, hashes."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asofia.session import spread

#: A key counts as hot from this share of all rows on, so at most 1 / HOT_SHARE keys are hot, whatever the input's size.
HOT_SHARE = 1 / 256


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: spark.checkpoint.dir. Where it is unset, a temporary one, in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="asofia-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        found = "file://" + folder
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_MADE: list[str] = []


def work_dir(spark: SparkSession, tag: str) -> str:
    """A new folder's URI below the shared one."""
    _MADE.append(f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}")
    return _MADE[-1]


def made() -> list[str]:
    """The folders that this driver asked for and that weren't removed, oldest first."""
    return list(_MADE)


def remove_dirs(uris: Iterable[str]) -> None:
    """For folders that nothing reads any more."""
    for uri in uris:
        fs, path = filesystem(uri)
        if fs.get_file_info(path).type == pafs.FileType.Directory:
            fs.delete_dir(path)
        if uri in _MADE:
            _MADE.remove(uri)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + os.path.abspath(uri))


def write_file(uri: str, parts: Iterable[bytes]) -> None:
    """Writes under another name, then renames: a task that is repeated or runs twice leaves one whole file."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as out:
        for p in parts:
            out.write(p)
    fs.move(part, path)


def read_file(uri: str) -> pa.Buffer:
    fs, path = filesystem(uri)
    with fs.open_input_file(path) as f:
        return f.read_buffer()


def materialise(df: DataFrame, tag: str, compact: bool = True) -> DataFrame:
    """Writes df to the shared folder and reads it again: cuts the lineage and survives the loss of executors. Not compact: for bytes that hardly compress."""
    uri = work_dir(df.sparkSession, tag)
    df.write.options(**{"compression": "zstd"} if compact else {"compression": "snappy", "parquet.enable.dictionary": "false"}).parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def partitions_for(df: DataFrame, each: int) -> int:
    """As many partitions as keep about so many bytes of df's files each, by the optimizer's own estimate, or the session's setting if that is more."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(n_partitions(df.sparkSession), size // each if size < 1 << 55 else 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, start: Callable[[], Callable[[list[list]], list[list]]], schema: T.StructType) -> DataFrame:
    """Column-wise Arrow map. start() runs once a task and returns the function from input columns to output columns (lists)."""
    arrow = pa.schema([(f.name, _arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = start()
        for b in batches:
            if b.num_rows:
                out = each([c.to_pylist() for c in b.columns])
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, arrow.types)], schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def struct(spec: str) -> T.StructType:
    """'a long, b string' as a schema."""
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "binary": T.BinaryType(), "short": T.ShortType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split() for x in spec.split(","))])


def left_join_hot(big: DataFrame, small: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """big LEFT JOIN small on key, small having one row a key and the number of its rows of big in weight, total of them in all.

    Keys with HOT_SHARE of the rows or more are at most 1 / HOT_SHARE: they are broadcast, and rows that found theirs
    leave the shuffled join by a key of their own. The others can't make a partition of more than that share.
    """
    least = max(1, int(total * HOT_SHARE))
    cols = [c for c in small.columns if c not in (key, weight)]
    hot = small.filter(F.col(weight) >= least).select(F.col(key).alias("_hk"), F.struct(*cols).alias("_hot"))
    cold = small.filter(F.col(weight) < least).select(F.col(key).alias("_ck"), F.lit(0).alias("_cs"), F.struct(*cols).alias("_cold"))
    hit = F.col("_hot").isNotNull()
    with_hot = big.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left").withColumn("_salt", F.when(hit, 1 + F.pmod(F.monotonically_increasing_id(), F.lit(65536)).cast("int")).otherwise(0))
    joined = with_hot.join(cold, (F.col(key) == F.col("_ck")) & (F.col("_salt") == F.col("_cs")), "left")
    return joined.select(*[F.col(c) for c in big.columns], *[F.coalesce(F.col(f"_hot.{c}"), F.col(f"_cold.{c}")).alias(c) for c in cols])


def whole_text(text: str = "text") -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which each bit depends on all."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def with_plain_names(docs: DataFrame, stage: Callable[[DataFrame], DataFrame], roles: Iterable[str] = ("doc_id", "text", "n_chars")) -> DataFrame:
    """What stage makes of docs while all columns but roles have names that clash with nothing. stage returns the columns of its input."""
    plain = docs.toDF(*[c if c in roles else f"x{k}" for k, c in enumerate(docs.columns)])
    return stage(plain).toDF(*docs.columns)


def append_columns(df: DataFrame, text: str, keep: list[str], start: Callable[[], Callable[[list[str]], list[list]]], fields: str) -> DataFrame:
    """keep's columns of df and, after them, columns computed from whole texts (null: empty). start() runs once a task.

    keep may hold any columns, whatever they are called; a name in fields that is taken by one of them is an error.
    """
    new = struct(fields)
    if clash := {f.name for f in new} & set(keep):
        raise ValueError(f"columns {sorted(clash)} are taken")
    out = T.StructType([df.schema[c] for c in keep] + list(new))
    kinds = [_arrow_type(f.dataType) for f in new]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = start()
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                part = b.slice(k, 1024)
                cols = each(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(c, type=t) for c, t in zip(cols, kinds))], names=[*keep, *new.names])

    return spread(rows).mapInArrow(run, out)
