"""3. Repeated passages by prefix-free parsing and suffix arrays.

A byte is removed if a SPAN-byte string that covers it also starts in a document with a smaller doc_id.

Parse. A rolling pass hashes every K-byte string; the least hash in each window of SPAN bytes is its trigger, so equal
windows have the same trigger at the same place, whatever surrounds them. Windows in a row with the same trigger make a
phrase; its text is all that they cover, at most LONG bytes, and no phrase is a proper prefix of another with the same
trigger place, as it ends where the trigger changes. So a document is a sequence of phrases, and the corpus a dictionary
of distinct phrases and the parse that lists which documents use them.

Order. Suffixes of the corpus are put in order by their bytes, as far as SPAN bytes, which is what the question needs:
phrases are sorted by their bytes into the dictionary, and the dictionary's suffixes that start a window into its suffix
array. Every window lies within one phrase, so the parse's own suffix array is needed no deeper than its first symbol:
which documents use a phrase. Both together give, for each run of equal suffixes of the corpus, the documents in which
they start; all but the first document's are repeats. Nothing rests on hashes being different: they choose triggers,
route phrases and pass over suffixes that can't have an equal (no other phrase with the same core, the bytes that all
windows of a third of the places around a trigger share); what is taken to be equal was compared byte by byte.

Scale. Documents are parsed in blocks of BLOCK_BYTES where they are read, each written once to the shared folder. Within
a block equal phrases are combined before anything is sent, so a passage that a third of all documents hold costs a
record a block, not one a document. A block sends its phrases' bytes to partitions by trigger, in one shuffle; those of a
trigger that would fill a partition are sent as windows instead, each to a partition by its own bytes, so that many
different phrases around one passage spread. What comes back are intervals, a row per block and partition. Partitions
are as many as keep about PART bytes of the input's files each, or the session's setting if that is more. Suffixes are
sorted a slice of classes at a time. A lost task rewrites its own files under the same names.

Null texts are empty. Null doc_ids count as larger than any other, equal among themselves. Rows that repeat a doc_id
don't count as earlier for each other. Texts shorter than SPAN bytes keep all bytes. An empty table gives no rows.
Extra columns, whatever their names, are passed through by drop_repeats and ignored by the query.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asofia.llm.common import _arrow_type, materialise, mix64, partitions_for, read_file, struct, table, with_plain_names, work_dir, write_file
from asofia.session import spread

SPAN, K = 50, 12
WIDTH = SPAN - K + 1
BIN = WIDTH // 3
#: A window's trigger lies in one of three bins of BIN places; what all windows of a bin cover: from, and up to, the trigger's place.
CORES = [(-BIN * k, SPAN - BIN * (k + 1) + 1) for k in range(3)]
BLOCK_BYTES = 12_000_000
CHUNK = 1 << 19
LAST = np.iinfo(np.int64).max
_U = np.uint64
_PLACE = 24  # bits of a place within a chunk, below the hash's
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of the longest phrase; bytes of files a partition; windows ordered at a time.
LONG, PART, SLICE = SPAN + WIDTH - 1, 16_000_000, 400_000
# What is sent; at is a place in the block's bytes.
_PHRASE = [("at", "<u4"), ("size", "<u1"), ("off", "<u1"), ("doc", "<i8")]
_WINDOW = [("at", "<u4"), ("doc", "<i8")]
_INTERVAL = [("at", "<u4"), ("size", "<u4")]
_STEPS = (*range(0, SPAN - 8, 8), SPAN - 8)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, _U)
    while len(out) < n:
        out = np.concatenate([out, out * _U(pow(base, len(out), 1 << 64))])
    return out[:n]


_POWERS: list[np.ndarray] = []


def _both_powers() -> list[np.ndarray]:
    if not _POWERS:
        _POWERS.extend((_powers(_BASE, CHUNK + 256), _powers(_INVERSE, CHUNK + 256)))
    return _POWERS


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, mixed."""
    return mix64(np.ndarray((len(data) - 7,), "<u8", data.data, 0, (1,)).astype(_U))


def pack(fields: list[tuple[str, str]], cols: dict[str, np.ndarray], text: bytes = b"") -> bytes:
    """Column after column, places as differences, then text, compressed."""
    n = len(cols["at"])
    parts = [np.diff(cols["at"], prepend=np.uint32(0)) if name == "at" else cols[name] for name, _ in fields]
    return np.uint32(n).tobytes() + zstandard.ZstdCompressor(3).compress(b"".join([*(np.ascontiguousarray(x, k).tobytes() for x, (_, k) in zip(parts, fields)), text]))


def unpack(fields: list[tuple[str, str]], blobs: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """The columns of all blobs, the number of rows in each, and the texts."""
    parts: dict[str, list[np.ndarray]] = {n: [np.zeros(0, k)] for n, k in fields}
    texts = [np.zeros(0, np.uint8)]
    sizes = [int(np.frombuffer(b, "<u4", 1)[0]) for b in blobs]
    for b, n in zip(blobs, sizes):
        raw, at = zstandard.ZstdDecompressor().decompress(b[4:]), 0
        for name, k in fields:
            x = np.frombuffer(raw, k, n, at)
            parts[name].append(np.cumsum(x, dtype="<u4") if name == "at" else x)
            at += n * np.dtype(k).itemsize
        texts.append(np.frombuffer(raw, np.uint8, offset=at) if at < len(raw) else texts[0])
    return {n: np.concatenate(p) for n, p in parts.items()}, np.array(sizes, np.int64), np.concatenate(texts)


def take(cols: dict[str, np.ndarray], which: np.ndarray) -> dict[str, np.ndarray]:
    return {n: c[which] for n, c in cols.items()}


def _view(data: np.ndarray, kind: str) -> np.ndarray:
    """The 8 bytes from each place on, as numbers."""
    return np.ndarray((max(len(data) - 7, 0),), kind, data.data if len(data) else b"", 0, (1,))


def _inside(size: np.ndarray) -> np.ndarray:
    return np.arange(LONG) < size.astype(np.int64)[:, None]


def padded(text: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Strings one after the other, each padded with zeros to LONG."""
    out = np.zeros((len(size), LONG), np.uint8)
    out[_inside(size)] = text
    return out.ravel()


class Block:
    """Documents one after the other: their bytes, where each starts, and their ids."""

    def __init__(self, batch: pa.RecordBatch):
        self.batch = batch
        text = batch.column("_text").cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        raw = text.buffers()[2]
        self.data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and len(text) else np.zeros(0, np.uint8)
        self.starts = offsets - offsets[0] if len(text) else np.zeros(1, np.int64)
        self.doc = batch.column("_doc").to_numpy(zero_copy_only=False).astype(np.int64)
        self.padded: np.ndarray | None = None

    def phrases(self) -> dict[str, np.ndarray]:
        """h: the trigger's hash; g: one of the phrase; size: its windows; off: the trigger's place in it."""
        found = [self._chunk(a) for a in range(0, len(self.data), CHUNK)]
        kinds = {"h": _U, "g": _U, "doc": np.int64, "at": np.uint32, "size": np.uint8, "off": np.uint8}
        return {n: np.concatenate([np.zeros(0, k), *(f[n] for f in found)]) for n, k in kinds.items()}

    def _chunk(self, a: int) -> dict[str, np.ndarray]:
        """Phrases of the windows that start in one chunk."""
        powers, inverse = _both_powers()
        b = min(a + CHUNK, len(self.data))
        piece = np.zeros(b - a + SPAN + 80, np.uint8)
        have = self.data[a : b + SPAN + 40]
        piece[: len(have)] = have
        m = _words(piece)
        n = b - a
        span = n + WIDTH - 1
        h = m[: span] * _U(0xC2B2AE3D27D4EB4F) + (m[K - 8 : K - 8 + span] ^ _U(0x165667B19E3779F9))
        h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        h ^= h >> _U(32)
        least = ((h >> _U(_PLACE)) << _U(_PLACE)) | np.arange(span, dtype=_U)
        for step in (1, 2, 4, 8, 16):
            least = np.minimum(least[:-step], least[step:])
        least = np.minimum(least[:n], least[WIDTH - 32 : WIDTH - 32 + n])
        anchor = (least & _U((1 << _PLACE) - 1)).astype(np.int64)
        first, last = np.searchsorted(self.starts, [a, b], "right")
        bounds = self.starts[first - 1 : last + 1]
        sound = np.zeros(n + 1, np.int8)  # whether the window lies within its document
        lo, hi = np.maximum(bounds[:-1], a), np.minimum(bounds[1:] - SPAN + 1, b)
        ok = hi > lo
        np.add.at(sound, lo[ok] - a, 1)
        np.add.at(sound, hi[ok] - a, -1)
        sound = np.cumsum(sound[:-1]).astype(bool)
        edge = np.ones(n + 1, bool)
        edge[1:-1] = (anchor[1:] != anchor[:-1]) | (sound[1:] != sound[:-1])
        inner = bounds[1:-1] - a  # documents that touch without an unsound place between them
        edge[inner[(inner > 0) & (inner < n)]] = True
        cut = np.flatnonzero(edge)
        at, size = cut[:-1], np.diff(cut)
        good = sound[at]
        at, size = at[good], size[good]
        place = anchor[at]
        total = np.zeros(n + SPAN + 1, _U)
        np.cumsum(m[: n + SPAN] * powers[: n + SPAN], out=total[1:])
        g = (total[at + size + SPAN - 8] - total[at]) * inverse[at]
        g = mix64(g ^ ((place - at).astype(_U) << _U(56)))
        doc = np.searchsorted(self.starts, at + a, "right") - 1
        return {"h": h[place] >> _U(_PLACE), "g": g, "doc": self.doc[doc], "at": (at + a).astype(np.uint32), "size": size.astype(np.uint8), "off": (place - at).astype(np.uint8)}

    def text(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """size bytes from each place, one string after the other."""
        if self.padded is None:
            self.padded = np.concatenate([self.data, np.zeros(LONG, np.uint8)])
        return np.lib.stride_tricks.sliding_window_view(self.padded, LONG)[at][_inside(size)]

    def windows(self, at: np.ndarray, size: np.ndarray) -> dict[str, np.ndarray]:
        """The windows of phrases, with a hash."""
        size = size.astype(np.int64)
        start = np.repeat(at.astype(np.int64) - (np.cumsum(size) - size), size) + np.arange(size.sum())
        view, w = _view(self.data, "<u8"), np.zeros(len(start), _U)
        for k in _STEPS:
            w = mix64(w * _U(0x9FB21C651E98DF25) + view[start + k].astype(_U) + _U(k))
        return {"w": w, "doc": self.doc[np.searchsorted(self.starts, start, "right") - 1], "at": start.astype(np.uint32)}

    def equal(self, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether as many bytes, SPAN to LONG, are the same from the places x and y on."""
        view, size = _view(self.data, "<u8"), size.astype(np.int64)
        x, y = x.astype(np.int64), y.astype(np.int64)
        out = np.ones(len(x), bool)
        for k in range(0, LONG, 8):
            step = np.minimum(k, size - 8)
            out &= view[x + step] == view[y + step]
        return out

    def combined(self, key: np.ndarray, at: np.ndarray, size: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of strings with keys: which are repeats of a smaller document's, which stand for all that are equal in the smallest
        document, and for each string which stands for it. What has the same key is compared byte by byte; equal strings
        that another with their key comes between stand for themselves, which costs a record and changes nothing."""
        n = len(key)
        order = np.argsort(key, kind="stable")
        same = np.zeros(n, bool)
        tie = np.flatnonzero((key[order[1:]] == key[order[:-1]]) & (size[order[1:]] == size[order[:-1]])) if n else np.zeros(0, np.int64)
        same[tie + 1] = self.equal(at[order[tie]], at[order[tie + 1]], size[order[tie]])
        start, number = np.flatnonzero(~same), np.cumsum(~same) - 1
        d = doc[order]
        least = np.minimum.reduceat(d, start) if n else d
        first = np.minimum.reduceat(np.where(d == least[number], np.arange(n), n), start) if n else d
        repeat, stands = np.zeros(n, bool), np.zeros(n, np.int64)
        repeat[order] = d > least[number]
        stands[order] = order[first[number]] if n else order
        return repeat, stands == np.arange(n), stands


def ranked(fetch: Callable[[np.ndarray, int], np.ndarray], n: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of n strings by their bytes, and where in it another string begins. fetch(rows, k): their k-th words, big-endian."""
    order = np.arange(n)
    new = np.zeros(n, bool)
    new[:1] = True
    for k in range(words):
        group = np.cumsum(new)
        tied = np.append(~new[1:], False) | ~new
        at = np.flatnonzero(tied)
        if not len(at):
            break
        w, g = fetch(order[at], k), group[at]
        differ = np.zeros(len(at), bool)
        differ[1:] = (w[1:] != w[:-1]) & (g[1:] == g[:-1])
        unequal = np.zeros(n + 2, bool)
        unequal[g[differ]] = True
        some = unequal[g]  # groups whose strings are all alike so far stay as they are
        at, w, g = at[some], w[some], g[some]
        by = np.lexsort((w, g)) if k or len(at) < n else np.argsort(w, kind="stable")
        order[at] = order[at][by]
        w = w[by]
        new[at[1:]] |= (w[1:] != w[:-1]) & (g[1:] == g[:-1])
    return order, new


def smallest(doc: np.ndarray, order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For each string the smallest document of its equals."""
    out = np.zeros(len(doc), np.int64)
    if len(doc):
        out[order] = np.minimum.reduceat(doc[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    return out


def repeats(c: dict[str, np.ndarray], text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of phrases, all of the same triggers: intervals (which phrase, from, bytes) that also start in a smaller document."""
    n = len(c["at"])
    big, little = _view(text, ">u8"), _view(text, "<u8")
    size, off = c["size"].astype(np.int64), c["off"].astype(np.int64)
    last = LONG // 8

    def word(rows: np.ndarray, k: int) -> np.ndarray:
        return big[rows * LONG + 8 * k].astype(_U) if k < last else size[rows].astype(_U) << _U(8) | off[rows].astype(_U)

    order, new = ranked(word, n, last + 1)  # the dictionary
    least = smallest(c["doc"], order, new)
    repeat = np.flatnonzero(c["doc"] > least)
    found = [(repeat, np.zeros(len(repeat), np.int64), size[repeat] + SPAN - 1)]
    entry = order[new]  # a phrase of the dictionary
    number = np.zeros(n, np.int64)
    number[order] = np.cumsum(new) - 1
    keys, of, begin, count = [], [], [], []
    for k, (lo, hi) in enumerate(CORES):
        i = np.flatnonzero((off[entry] >= BIN * k) & (off[entry] - size[entry] + 1 < BIN * (k + 1)))
        at = entry[i] * LONG + off[entry[i]] + lo
        x = np.full(len(i), k + 1, _U)
        for step in (*range(0, hi - lo - 8, 8), hi - lo - 8):
            x = mix64(x * _U(0x9FB21C651E98DF25) + little[at + step].astype(_U))
        far, near = np.minimum(off[entry[i]], BIN * (k + 1) - 1), np.maximum(off[entry[i]] - size[entry[i]] + 1, BIN * k)
        keys.append(x), of.append(i), begin.append(off[entry[i]] - far), count.append(far - near + 1)
    key, of, begin, count = (np.concatenate(x) for x in (keys, of, begin, count))
    by = np.argsort(key, kind="stable")
    key = key[by]
    shared = np.zeros(len(key), bool)
    shared[1:] |= key[1:] == key[:-1]
    shared[:-1] |= key[1:] == key[:-1]
    by, key = by[shared], key[shared]
    edge = np.append(np.flatnonzero(np.diff(key, prepend=key[:1] ^ _U(1))), len(key))
    total = np.concatenate([[0], np.cumsum(count[by])])
    cut = [0]
    for e in edge.tolist():  # slices of whole classes
        if total[e] - total[cut[-1]] >= SLICE:
            cut.append(e)
    hits = []
    for lo, hi in zip(cut, [*cut[1:], len(key)]):
        mine = by[lo:hi]
        m = count[mine]
        e = np.repeat(of[mine], m)
        s = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m - begin[mine], m)
        place = entry[e] * LONG + s
        win, fresh = ranked(lambda rows, k: big[place[rows] + _STEPS[k]].astype(_U), len(place), len(_STEPS))  # the dictionary's suffix array
        d = least[entry[e]]
        later = d > smallest(d, win, fresh)
        hits.append(np.stack([e[later], s[later]]))
    if hits:
        e, s = np.concatenate(hits, axis=1)
        by = np.lexsort((s, e))
        e, s = e[by], s[by]
        first = np.ones(len(e), bool)
        first[1:] = (e[1:] != e[:-1]) | (s[1:] != s[:-1] + 1)
        start = np.flatnonzero(first)
        long = np.diff(np.append(start, len(e))) + SPAN - 1
        e, s = e[start], s[start]
        users = np.flatnonzero(c["doc"] == least)  # of the entry, in its smallest document
        users = users[np.argsort(number[users], kind="stable")]
        lo, hi = np.searchsorted(number[users], e), np.searchsorted(number[users], e, "right")
        m = hi - lo
        found.append((users[np.arange(m.sum()) - np.repeat(np.cumsum(m) - m - lo, m)], np.repeat(s, m), np.repeat(long, m)))
    return tuple(np.concatenate(x) for x in zip(*found))


def _rows(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


_BLOB = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("kind", pa.string()), ("blob", pa.binary())])
_BLOB_SPEC = "part int, block long, kind string, blob binary"


def _split(fields: list, cols: dict[str, np.ndarray], text: Callable[[np.ndarray], np.ndarray], by: np.ndarray, parts: int, block: int, kind: str) -> Iterator[tuple]:
    part = (mix64(by) % _U(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(ends)).tolist():
        i = order[ends[p] : ends[p + 1]]
        yield p, block, kind, pack(fields, take(cols, i), text(i).tobytes())


def _write_block(uri: str, batch: pa.RecordBatch) -> None:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    write_file(uri, [sink.getvalue()])


def _read_block(uri: str) -> Block:
    got = pa.ipc.open_file(read_file(uri)).read_all().combine_chunks().to_batches()
    return Block(got[0])


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, list[bytes]]]]:
    """Rows come with those of a block together."""
    block, held = None, {}
    for b in batches:
        for k, kind, blob in zip(*(b.column(n).to_pylist() for n in ("block", "kind", "blob"))):
            if k != block and block is not None:
                yield block, held
                held = {}
            block = k
            held.setdefault(kind, []).append(blob)
    if block is not None:
        yield block, held


def _with_repeats(docs: DataFrame, keep: list[str], out: T.StructType, finish: Callable[[Block, np.ndarray], list]) -> DataFrame:
    """finish gets a block and which of its bytes are removed, and returns output columns after those of keep."""
    spark = docs.sparkSession
    folder, parts = work_dir(spark, "blocks"), partitions_for(docs, PART)
    rows = spread(docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_doc"), F.coalesce("text", F.lit("")).alias("_text")))

    hot = _hot_triggers(rows.select("_doc", "_text"), parts)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal count
            number = (task << 24) + count
            count += 1
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            _write_block(f"{folder}/{number}.docs", batch)
            block = Block(batch)
            c = block.phrases()
            long = c["size"].astype(np.uint32) + np.uint32(SPAN - 1)
            repeat, alone, stands = block.combined(mix64(c["h"] * _U(0x9E3779B97F4A7C15) ^ c["g"]), c["at"], long, c["doc"])
            twin = np.flatnonzero(~repeat & ~alone)
            common = np.isin(c["h"], hot)
            send, hotter = np.flatnonzero(alone & ~common), np.flatnonzero(alone & common)
            w = block.windows(c["at"][hotter], c["size"][hotter])
            again, single, of = block.combined(w["w"], w["at"], np.full(len(w["at"]), SPAN), w["doc"])
            double = np.flatnonzero(~again & ~single)
            known = io.BytesIO()
            np.savez(
                known, cut_at=np.concatenate([c["at"][repeat], w["at"][again]]), cut_size=np.concatenate([long[repeat], np.full(int(again.sum()), SPAN, np.uint32)]),
                phrase_at=c["at"][twin], phrase_of=c["at"][stands[twin]], phrase_size=c["size"][twin], window_at=w["at"][double], window_of=w["at"][of[double]], window_size=np.ones(len(double), np.uint8),
            )
            write_file(f"{folder}/{number}.known", [known.getvalue()])
            single = np.flatnonzero(single)
            c, long, w = take(c, send), long[send], take(w, single)
            sets = (
                _split(_PHRASE, c, lambda i: block.text(c["at"][i], long[i]), c["h"], parts, number, "phrases"),
                _split(_WINDOW, w, lambda i: np.lib.stride_tricks.sliding_window_view(block.data, SPAN)[w["at"][i]], w["w"], parts, number, "windows"),
            )
            out = [(number % parts, number, "block", b"")]
            for row in chain.from_iterable(sets):
                out.append(row)
                if len(out) >= 64:
                    yield _rows(out, _BLOB)
                    out = []
            if out:
                yield _rows(out, _BLOB)

        for b in batches:
            at = 0
            while at < b.num_rows:
                sizes = np.cumsum(pc.binary_length(b.column("_text").slice(at)).to_numpy(zero_copy_only=False), dtype=np.int64)
                n = max(1, int(np.searchsorted(sizes, BLOCK_BYTES)))
                held.append(b.slice(at, n))
                at += n
                if sum(x.nbytes for x in held) >= BLOCK_BYTES:
                    yield from flush()
        if held:
            yield from flush()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[str, list[tuple[int, bytes]]] = {}
        out: list[tuple] = []
        for b in batches:
            for _, block, kind, blob in zip(*(c.to_pylist() for c in b.columns)):
                if kind == "block":
                    out.append((0, block, "block", b""))
                else:
                    blobs.setdefault(kind, []).append((block, blob))
        if out:
            yield _rows(out, _BLOB)
        for kind, mine in blobs.items():
            c, sizes, text = unpack(_PHRASE if kind == "phrases" else _WINDOW, [x for _, x in mine])
            block = np.repeat(np.array([k for k, _ in mine]), sizes)
            if kind == "phrases":
                which, begin, size = repeats(c, padded(text, c["size"].astype(np.uint32) + np.uint32(SPAN - 1)))
            else:
                view = _view(text, ">u8")
                d = c["doc"].astype(np.int64)
                which = np.flatnonzero(d > smallest(d, *ranked(lambda rows, k: view[rows * SPAN + _STEPS[k]].astype(_U), len(d), len(_STEPS))))
                begin, size = np.zeros(len(which), np.int64), np.full(len(which), SPAN)
            out = _by_blocks("cut", block[which], {"at": c["at"][which] + begin, "size": size})
            if out:
                yield _rows(out, _BLOB)

    kinds = [_arrow_type(f.dataType) for f in out.fields]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _by_block(batches):
            block = _read_block(f"{folder}/{number}.docs")
            known = np.load(io.BytesIO(read_file(f"{folder}/{number}.known")))
            cuts, _, _ = unpack(_INTERVAL, held.get("cut", []))
            found = [np.stack([known["cut_at"], known["cut_size"]]).astype(np.int64), np.stack([cuts["at"], cuts["size"]]).astype(np.int64)]
            for name in ("window", "phrase"):
                found.append(_twins(np.concatenate(found, axis=1), *(known[f"{name}_{x}"].astype(np.int64) for x in ("at", "of", "size"))))
            gone = _covered(len(block.data), *np.concatenate(found, axis=1))
            cols = finish(block, gone)
            for k in range(0, block.batch.num_rows, 4096):
                part = block.batch.slice(k, 4096)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(c[k : k + 4096], t) for c, t in zip(cols, kinds[len(keep) :]))], names=out.names)

    spec = struct(_BLOB_SPEC)
    cuts = materialise(rows.mapInArrow(parse, spec).repartitionById(parts, F.col("part")).mapInArrow(match, spec), "cuts")
    return cuts.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(remove, out)


def _twins(cuts: np.ndarray, to: np.ndarray, of: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What was cut of a phrase or window (from of on, of so many places), at another that it stands for. Each cut starts in its own phrase."""
    at, long = cuts[:, np.argsort(cuts[0], kind="stable")]
    lo, hi = np.searchsorted(at, of), np.searchsorted(at, of + size)
    m = hi - lo
    i = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m - lo, m)
    return np.stack([at[i] + np.repeat(to - of, m), long[i]])


def _by_blocks(kind: str, block: np.ndarray, cols: dict[str, np.ndarray]) -> list[tuple]:
    order = np.argsort(block, kind="stable")
    edges = np.flatnonzero(np.diff(block[order])) + 1
    return [(0, int(block[i[0]]), kind, pack(_INTERVAL, take(cols, i))) for i in np.split(order, edges) if len(i)]


def _covered(n: int, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which of n bytes the intervals cover."""
    order = np.argsort(at)
    start, end = at[order], np.maximum.accumulate(at[order] + size[order]) if len(at) else at
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    change = np.zeros(n + 1, np.int8)
    change[start[new]] = 1
    if len(start):
        change[end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]] = -1  # runs neither overlap nor touch
    return np.cumsum(change[:-1], dtype=np.int8).view(bool)


def _hot_triggers(rows: DataFrame, parts: int) -> np.ndarray:
    """Triggers that would fill a quarter of a partition, as estimated from one document in 64: at most 4 * parts.

    This only decides how phrases are routed; the result is the same whatever it finds.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 2000):
                h, n = np.unique(Block(b.slice(k, 2000)).phrases()["h"], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(n)], ["h", "n"])

    found = rows.filter(F.rand(17) < 1 / 64).mapInArrow(count, struct("h long, n long")).groupBy("h").agg(F.sum("n").alias("n"))
    stored = materialise(found, "triggers")
    least = (stored.agg(F.sum("n")).first()[0] or 0) / (4 * parts)
    return np.array(sorted(r.h for r in stored.filter(F.col("n") >= max(64, least)).select("h").collect()), _U)


def _kept(block: Block, gone: np.ndarray) -> list[bytes]:
    kept = block.data[~gone].tobytes()
    ends = np.concatenate([[0], np.cumsum(~gone, dtype=np.int32)])[block.starts]
    return [kept[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    out = T.StructType([docs.schema["doc_id"], *struct("n_bytes long, n_removed long, n_spans long, kept_sha256 string")])

    def finish(block: Block, gone: np.ndarray) -> list:
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        starts = block.starts[:-1]
        starts = starts[starts < block.starts[1:]]
        first[starts] = gone[starts]
        count = lambda x: np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int32)])[block.starts])
        return [np.diff(block.starts), count(gone), count(first), [hashlib.sha256(x).hexdigest() for x in _kept(block, gone)]]

    return _with_repeats(docs, ["doc_id"], out, finish)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """docs, all its columns, without repeated passages in text; n_chars, where there is such a column, is counted anew.

    Bytes of a character that was cut in two are dropped. Null texts stay null.
    """
    return with_plain_names(docs, _drop)


def _drop(docs: DataFrame) -> DataFrame:
    rest = [c for c in docs.columns if c != "text"]
    marked = docs.withColumn("_null", F.col("text").isNull())
    out = T.StructType([*(marked.schema[c] for c in [*rest, "_null"]), T.StructField("text", T.StringType())])
    done = _with_repeats(marked, [*rest, "_null"], out, lambda block, gone: [[x.decode("utf-8", "ignore") for x in _kept(block, gone)]])
    done = done.withColumn("text", F.when(~F.col("_null"), F.col("text")))
    if "n_chars" in rest:
        done = done.withColumn("n_chars", F.when(F.col("_null"), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return done.select(*docs.columns)


def op3_prefix_free(spark, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
