"""A point-in-time store of Parquet tables: append-only facts and disclosures, keyed upserts for the rest.

A table is a list of folders, one a version and part (a year of facts, a month of prices or disclosures, a day of status
rows), named by a numbered manifest. A writer adds a version with just the parts that its rows touch, reads no others,
and then creates the next manifest, which fails if another writer has made one since: so nothing is lost between two
writers, a reader never sees half a table, and a lost driver leaves the last manifest in place. Everything goes through
Hadoop's file systems, so a store may lie wherever Spark reads from.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asofia import schemas

TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    "facts": (schemas.FACTS, ["fact_id"]),
    "prices": (schemas.PRICES, ["date", "ticker"]),
    "master": (schemas.MASTER, ["ticker"]),
    "status": (schemas.STATUS, ["ticker", "status", "snapshot_date"]),
    "disclosures": (schemas.DISCLOSURES, ["rcept_no"]),
    "delistings": (schemas.DELISTINGS, ["ticker", "delisting_date"]),
}
_NULL = "none"


class ConflictError(RuntimeError):
    """Another writer made a version since this one read the table; nothing of it was changed."""


def part_of(name: str) -> Column:
    how = {"facts": lambda: F.col("fiscal_year").cast("string"), "prices": lambda: F.date_format("date", "yyyy-MM"), "disclosures": lambda: F.date_format("rcept_dt", "yyyy-MM"), "status": lambda: F.col("snapshot_date").cast("string")}
    return F.coalesce(how[name](), F.lit(_NULL)) if name in how else F.lit("all")


def unseen(old: DataFrame, new: DataFrame, key: list[str], order: Iterable[str] = ()) -> DataFrame:
    """Rows of new, the first of each key in the given order, whose key old lacks. An anti join, not NOT IN: nulls in a key don't empty it."""
    from pyspark.sql import Window

    if order:
        w = Window.partitionBy(*key).orderBy(*order)
        new = new.withColumn("_first", F.row_number().over(w)).filter("_first = 1").drop("_first")
    else:
        new = new.dropDuplicates(key)
    return new.join(old.select(*key).distinct(), key, "left_anti").select(*new.columns)


def upserted(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """new replaces old by key; columns that one of them lacks are null."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, str(path).rstrip("/")
        self._jvm = spark.sparkContext._jvm
        for name in TABLES:
            self._fs().mkdirs(self._at(name))

    def _at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _fs(self):
        return self._at("x").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _latest(self, name: str) -> int:
        """The number of the newest manifest, 0 without any."""
        found = [re.fullmatch(r"manifest-(\d+)\.json", f.getPath().getName()) for f in self._fs().listStatus(self._at(name))]
        return max((int(m[1]) for m in found if m), default=0)

    def _manifest(self, name: str, number: int) -> dict[str, list[str]]:
        """Part -> versions."""
        if not number:
            return {}
        stream = self._fs().open(self._at(name, f"manifest-{number:010d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _switch(self, name: str, seen: int, parts: dict[str, list[str]]) -> None:
        at = self._at(name, f"manifest-{seen + 1:010d}.json")
        try:
            stream = self._fs().create(at, False)
        except Exception as e:
            raise ConflictError(f"{name}: version {seen + 1} was made by another writer") from e
        stream.write(bytearray(json.dumps(parts).encode()))
        stream.close()

    def _read(self, name: str, manifest: dict[str, list[str]]) -> DataFrame:
        schema, _ = TABLES[name]
        paths = [str(self._at(name, f"version={v}", f"part={p}")) for p, versions in manifest.items() for v in versions]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, name: str, parts: Iterable[str] | None = None) -> DataFrame:
        """The whole table, or just some of its parts, of which no others are listed or read."""
        now = self._manifest(name, self._latest(name))
        return self._read(name, now if parts is None else {p: now[p] for p in parts if p in now})

    def _shaped(self, name: str, rows: DataFrame) -> DataFrame:
        return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[name][0]])

    def _write(self, name: str, rows: DataFrame) -> tuple[str, list[str]]:
        """A new version, and the parts that it has."""
        version = uuid.uuid4().hex
        order = [c for c in ("element", "ticker") if c in rows.columns]
        parted = rows.withColumn("part", part_of(name))
        parted.hint("rebalance", "part").sortWithinPartitions("part", *order).write.partitionBy("part").parquet(str(self._at(name, f"version={version}")))
        made = [f.getPath().getName().removeprefix("part=") for f in self._fs().listStatus(self._at(name, f"version={version}")) if f.isDirectory()]
        return version, sorted(made)

    def _touched(self, name: str, rows: DataFrame) -> list[str]:
        return sorted(r[0] for r in rows.select(part_of(name).alias("p")).distinct().collect())  # years, months or days

    def append(self, name: str, rows: DataFrame, order: Iterable[str] = ()) -> int:
        """Adds what is new by key, of several rows with one key the first in order, and returns how many rows that were; a second time it is none."""
        _, key = TABLES[name]
        rows, seen = self._shaped(name, rows), self._latest(name)
        now = self._manifest(name, seen)
        mine = self._touched(name, rows)
        version, made = self._write(name, unseen(self._read(name, {p: now[p] for p in mine if p in now}), rows, key, order))
        if not made:
            return 0
        added = self._read(name, {p: [version] for p in made}).count()
        self._switch(name, seen, now | {p: [*now.get(p, []), version] for p in made})
        return added

    def upsert(self, name: str, rows: DataFrame) -> None:
        """Rewrites the parts that rows touch."""
        _, key = TABLES[name]
        rows, seen = self._shaped(name, rows), self._latest(name)
        now = self._manifest(name, seen)
        mine = self._touched(name, rows)
        version, made = self._write(name, upserted(self._read(name, {p: now[p] for p in mine if p in now}), rows, key))
        self._switch(name, seen, {p: v for p, v in now.items() if p not in mine} | {p: [version] for p in made})

    def replace(self, name: str, rows: DataFrame) -> None:
        """The table anew, as after a change of how raw files are read."""
        seen = self._latest(name)
        version, made = self._write(name, self._shaped(name, rows))
        self._switch(name, seen, {p: [version] for p in made})

    def append_facts(self, rows: DataFrame) -> int:
        return self.append("facts", rows)

    def append_disclosures(self, rows: DataFrame) -> int:
        """The first row of each receipt number counts, in the order of what it says."""
        return self.append("disclosures", rows, ("rcept_dt", "report_nm", "ticker"))
