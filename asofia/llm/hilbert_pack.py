"""4. Packing along a space-filling curve.

Each document is encoded whole, its ids (with the end id) make a hashed, length-free vector, which is projected to DIMS
dimensions. Scaled by the corpus' means and deviations, the coordinates give a key on the Hilbert curve. Documents are
sorted by range of (key, doc_id, checksum of the ids, row), long ones in slices of SLICE ids, so neither a third of all
rows with one key nor long documents, which gather in the middle of the curve, overload a partition, and each partition
packs its stretch of the curve: documents one after the other, cut wherever a sequence is full. What remains at a
partition's end, fewer ids than a sequence holds, is cut into sequences of the powers of two that add up to it, which
need no padding; so nothing is padded and no partition waits for another.

Encoding is done once: its result (2 bytes an id where the vocabulary allows) is written to the shared folder and only
that is shuffled. Null texts are just the end id. Null doc_ids sort first and come back null; repeated rows are
documents each. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asofia.llm.common import materialise, mix64, n_partitions, struct, table, whole_text
from asofia.llm.tokens import default_path, library_encoder, vocabulary_size
from asofia.session import spread

DIMS, BITS = 4, 10
SEQUENCE = 2048
SLICE = 4096


@lru_cache(2)
def _projection(vocabulary: int, buckets: int = 1024) -> np.ndarray:
    """A row for each dimension, a place for each id: the projected, signed bucket into which the id is hashed."""
    h = mix64(np.arange(vocabulary, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    rows = np.random.default_rng(7).standard_normal((buckets, DIMS))
    sign = 1.0 - 2.0 * ((h >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    return np.ascontiguousarray((rows[(h % np.uint64(buckets)).astype(np.int64)] * sign[:, None]).T, np.float32)


def coordinates(ids: np.ndarray, first: np.ndarray, total: np.ndarray, vocabulary: int) -> np.ndarray:
    """The mean of the projected ids of each document; documents lie one after the other and none is empty."""
    return np.stack([np.add.reduceat(p[ids], first) / total for p in _projection(vocabulary)], axis=1).astype(np.float64)


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of rows of unsigned coordinates below 2**bits (Skilling's transposed form, all rows at once)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def keys(points: np.ndarray, mean: np.ndarray, deviation: np.ndarray) -> np.ndarray:
    z = (points - mean) / np.where(deviation > 0, deviation, 1)
    return hilbert(np.clip(((z + 3) / 6 * (1 << BITS)), 0, (1 << BITS) - 1).astype(np.int64))


def encode(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, row (as read), mark (checksum of all ids), start, total, ids (of a slice; little-endian, 2 or 4 bytes each), and the coordinates c0, c1, ..."""
    vocabulary = max(vocabulary_size(path), end_id + 1)
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    end = np.array([end_id], "<u4").tobytes()
    out = struct("doc_id long, row long, mark long, start long, total long, ids binary" + "".join(f", c{d} double" for d in range(DIMS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path)
        for b in batches:
            for k in range(0, b.num_rows, 2048):
                part = b.slice(k, 2048)
                raw = [x + end for x in encoder.stream(part.column(1))]
                flat = np.frombuffer(b"".join(raw), "<u4")
                total = np.array([len(x) // 4 for x in raw], np.int64)
                first = np.cumsum(total) - total
                points = coordinates(flat, first, total, vocabulary)
                mark = np.array([zlib.crc32(x) for x in raw], np.int64)
                slices = -(-total // SLICE)
                doc = np.repeat(np.arange(len(total)), slices)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(slices) - slices, slices)) * SLICE
                small = flat.astype(kind).tobytes()
                width = np.dtype(kind).itemsize
                lo = (first[doc] + start) * width
                hi = np.minimum(first[doc] + start + SLICE, (first + total)[doc]) * width
                ids = [small[i:j] for i, j in zip(lo.tolist(), hi.tolist())]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(doc)), part.column(2).take(pa.array(doc)), pa.array(mark[doc]), pa.array(start), pa.array(total[doc]), pa.array(ids, pa.binary()), *(pa.array(points[doc, d]) for d in range(DIMS))], names=out.names)

    return spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), F.monotonically_increasing_id().alias("row"))).mapInArrow(run, out)


class Packer:
    """Pieces of sequences in the order of the documents that are added."""

    def __init__(self, first: int, size: int):
        self.sequence, self.size, self.used = first, size, 0
        self.open: list[tuple] = []
        self.done: list[tuple] = []

    def add(self, doc_id: int | None, start: int, total: int, ids: np.ndarray) -> None:
        """A document of total ids, or its slice from start on; what follows the slice before it in a sequence is one piece with it."""
        at, size = 0, len(ids)
        raw = ids.astype("<u4").tobytes()
        while at < size:
            n = min(size - at, self.size - self.used)
            last = self.open[-1] if self.open else None
            if at == 0 and start and last and last[0] == doc_id and last[4] == total and last[1] + last[2] == start:
                self.open[-1] = (doc_id, last[1], last[2] + n, last[3] + raw[: 4 * n], total)
            else:
                self.open.append((doc_id, start + at, n, raw[4 * at : 4 * (at + n)], total))
            at, self.used = at + n, self.used + n
            if self.used == self.size:
                self._close(self.open)
                self.open, self.used = [], 0

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, at, n, raw, total in pieces:
            self.done.append((doc_id, at, n, zlib.crc32(raw), total, self.sequence, offset))
            offset += n
        self.sequence += 1

    def finish(self) -> None:
        """The rest as sequences of powers of two, the largest first."""
        while self.used:
            want = 1 << (self.used.bit_length() - 1)
            self.used -= want
            mine = []
            while want:
                doc_id, at, n, raw, total = self.open[0]
                k = min(n, want)
                mine.append((doc_id, at, k, raw[: 4 * k], total))
                want -= k
                if k == n:
                    self.open.pop(0)
                else:
                    self.open[0] = (doc_id, at + k, n - k, raw[4 * k :], total)
            self._close(mine)


_PIECE = struct("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack(docs: DataFrame, path: str | None = None, end_id: int = 1, size: int = SEQUENCE) -> DataFrame:
    """One row a piece. sequence_id: the partition's number times 2**32, plus the sequence's within it."""
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    path = path or default_path("byte_bpe_50k.json")
    wide = "<u2" if max(vocabulary_size(path), end_id + 1) <= 1 << 16 else "<u4"
    coded = materialise(encode(docs, path, end_id), "encoded", compact=False)
    axes = [f"c{d}" for d in range(DIMS)]
    stats = coded.filter("start = 0").agg(*[F.avg(c) for c in axes], *[F.stddev_pop(c) for c in axes]).first()
    mean, deviation = (np.array([x or 0.0 for x in part]) for part in (stats[:DIMS], stats[DIMS:]))

    @F.arrow_udf(T.LongType())
    def curve(*columns: pa.Array) -> pa.Array:
        return pa.array(keys(np.stack([c.to_numpy(zero_copy_only=False) for c in columns], axis=1), mean, deviation), pa.int64())

    order = ["_key", "doc_id", "mark", "row", "start"]  # rows that repeat a document spread too
    ordered = coded.withColumn("_key", curve(*axes)).select(*order, "total", "ids").repartitionByRange(n_partitions(docs.sparkSession), *order).sortWithinPartitions(*order).select("doc_id", "start", "total", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << 32, size)

        def out() -> pa.RecordBatch:
            cols = list(zip(*packer.done)) or [[]] * 7
            packer.done = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], _PIECE.names)

        for b in batches:
            for doc_id, start, total, ids in zip(*(c.to_pylist() for c in b.columns)):
                packer.add(doc_id, start, total, np.frombuffer(ids, wide))
                if len(packer.done) >= 10_000:
                    yield out()
        packer.finish()
        if packer.done:
            yield out()

    return ordered.mapInArrow(run, _PIECE)


def op4_hilbert_pack(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
