"""1. Token-ID output: ids of whole texts, bit-packed in the fewest bits the vocabulary needs, with block offsets.

A file holds the documents of one range of doc_id in ascending order:

    magic 8 bytes | header: 5 little-endian uint64 (bits, block, documents, ids, width of the block table)
    doc_id int64 x documents | null flag uint8 x documents | end (ids up to here) uint64 x documents
    block byte offset uint64 x (blocks + 1) | blocks

A block packs `block` ids, each in `bits` bits, most significant first, padded to a whole byte; so any id range is read
by unpacking just the blocks that it touches, all ids of a block at once with numpy. Documents are shuffled once, by
range of (doc_id, hash of the text, row), so repeated ids and rows spread too; each task writes its own files under a temporary name
and renames them, which is safe when tasks are repeated. One row a file comes back to the driver, for the starts.

Null texts are empty: just the end id. Null doc_ids sort first and come back null. Repeated rows are separate documents.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofia.llm.common import filesystem, n_partitions, read_file, struct, whole_text, work_dir, write_file
from asofia.llm.tokens import default_path, library_encoder, vocabulary_size

MAGIC = b"ASOTOK01"
BLOCK = 4096
#: Ids after which a task starts its next file, so a task's memory has a bound.
FILE_IDS = 32_000_000
#: Ids packed at a time.
TOGETHER = 1 << 20


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids in `bits` bits each, most significant bit first; the last byte is padded with zeros."""
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    rows = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(rows[:, 32 - bits :]).tobytes()


def unpack(data: bytes | memoryview, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", n).astype("<u4")
    rows = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, 32 - bits :] = rows
    return np.packbits(wide, axis=1).view(">u4").ravel().astype("<u4")


def encode_file(doc_ids: list[int | None], ids: list[bytes], bits: int, block: int = BLOCK) -> Iterator[bytes]:
    """ids: each document's, as little-endian unsigned 32-bit integers."""
    ends = np.cumsum([len(x) // 4 for x in ids]).astype("<u8")
    flat = np.frombuffer(b"".join(ids), "<u4")
    per_block = (block * bits + 7) // 8
    blocks = -(-len(flat) // block)
    last = len(flat) - max(blocks - 1, 0) * block
    total = max(blocks - 1, 0) * per_block + (last * bits + 7) // 8
    offsets = np.minimum(np.arange(blocks + 1, dtype=np.uint64) * np.uint64(per_block), np.uint64(total)).astype("<u8")
    yield MAGIC + np.array([bits, block, len(ids), len(flat), blocks + 1], "<u8").tobytes()
    yield np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array([d is None for d in doc_ids], np.uint8).tobytes()
    yield ends.tobytes() + offsets.tobytes()
    step = block if (block * bits) % 8 else block * max(1, TOGETHER // block)  # whole blocks at a time, so that unpacked bits take little memory
    for k in range(0, len(flat), step):
        yield pack(flat[k : k + step], bits)


class TokenFile:
    """Random access to one file."""

    def __init__(self, data: bytes | pa.Buffer):
        self.data = memoryview(data)
        if bytes(self.data[:8]) != MAGIC:
            raise ValueError("not a token file")
        self.bits, self.block, n, self.n_ids, table = (int(x) for x in np.frombuffer(self.data, "<u8", 5, 8))
        at = 48
        raw = np.frombuffer(self.data, "<i8", n, at)
        null = np.frombuffer(self.data, np.uint8, n, at := at + 8 * n)
        self.doc_ids = [None if z else int(x) for x, z in zip(raw, null)]
        self.ends = np.frombuffer(self.data, "<u8", n, at := at + n).astype(np.int64)
        self.offsets = np.frombuffer(self.data, "<u8", table, at := at + 8 * n).astype(np.int64)
        self.body = at + 8 * table

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the file, from just the blocks that hold them."""
        if stop <= start:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        if (self.block * self.bits) % 8 == 0:
            n = min((last + 1) * self.block, self.n_ids) - first * self.block
            some = unpack(self.data[self.body + self.offsets[first] : self.body + self.offsets[last + 1]], n, self.bits)
        else:
            some = np.concatenate([unpack(self.data[self.body + self.offsets[k] : self.body + self.offsets[k + 1]], min(self.block, self.n_ids - k * self.block), self.bits) for k in range(first, last + 1)])
        return some[start - first * self.block : stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 2, block: int = BLOCK, file_ids: int = FILE_IDS) -> list[tuple[str, int, int, int]]:
    """Writes (doc_id, text) below folder. Returns (file, documents, ids, ids before the file), in ascending order of doc_id."""
    spark = docs.sparkSession
    path = path or default_path("byte_bpe_50k.json")
    bits, end = bits_for(max(vocabulary_size(path), end_id + 1)), np.array([end_id], "<u4").tobytes()
    key = [F.col("doc_id"), F.xxhash64("text"), F.col("row")]  # rows that repeat a document spread too
    rows = docs.select("doc_id", whole_text().alias("text"), F.monotonically_increasing_id().alias("row")).repartitionByRange(n_partitions(spark), *key).sortWithinPartitions(*key).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = library_encoder(path), TaskContext.get().partitionId()
        ids: list[int | None] = []
        parts: list[bytes] = []
        made: list[tuple[str, int, int]] = []
        size = 0

        def flush() -> None:
            uri = f"{folder}/{task:08d}-{len(made):06d}.tok"
            write_file(uri, encode_file(ids, parts, bits, block))
            made.append((uri, len(ids), sum(map(len, parts)) // 4))
            ids.clear(), parts.clear()

        for b in batches:
            for d, coded in zip(b.column(0).to_pylist(), encoder.stream(b.column(1))):
                if size > file_ids:
                    flush()
                    size = 0
                ids.append(d)
                parts.append(coded + end)
                size += len(coded) // 4 + 1
        if ids:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array([m[c] for m in made], t) for c, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["file", "n_docs", "n_ids"])

    found = sorted((r.file, r.n_docs, r.n_ids) for r in rows.mapInArrow(write, struct("file string, n_docs long, n_ids long")).collect())
    before = np.cumsum([0, *(f[2] for f in found)]).tolist()
    return [(*f, b) for f, b in zip(found, before)]


def read_tokens(spark, files: list[tuple[str, int, int, int]]) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, all from the files."""
    out = struct("doc_id long, start long, n_tokens long, ids_crc32 long")
    if not files:
        return spark.createDataFrame([], out)
    listed = spark.createDataFrame([(f[0], f[3]) for f in files], "file string, before long").repartition(min(len(files), n_partitions(spark)), "file")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f = TokenFile(read_file(uri))
                ends = f.ends
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                for k in range(0, len(ends), 8192):
                    s, e = starts[k : k + 8192], ends[k : k + 8192]
                    raw, base = memoryview(f.ids(int(s[0]), int(e[-1])).astype("<u4").tobytes()), int(s[0])
                    crc = [zlib.crc32(raw[4 * (i - base) : 4 * (j - base)]) for i, j in zip(s.tolist(), e.tolist())]
                    yield pa.RecordBatch.from_arrays([pa.array(f.doc_ids[k : k + 8192], pa.int64()), pa.array(s + before), pa.array(e - s), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.mapInArrow(read, out)


def op1_token_store(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_tokens(spark, write_tokens(docs, work_dir(spark, "tokens")))


__all__ = ["TokenFile", "bits_for", "encode_file", "filesystem", "op1_token_store", "pack", "read_tokens", "unpack", "write_tokens"]
