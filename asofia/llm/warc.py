"""2. WARC: records written with segmentation and chunked transfer framing, read back and reassembled.

Writing: one record a row, gzip-compressed one by one. A response's block is an HTTP message with chunked transfer
framing; blocks over segment_bytes are cut: the first segment is the response record, the others are continuation
records that name it as their origin, in a file of their own; the last one states the total length. Of rows with equal
payloads of at least min_revisit bytes, the ones with the smallest page_id are responses, the others revisits, which
hold no payload but the digest and the response's record name (page and digest), so any reader can follow it, unless
rows repeat the response's page_id and payload: then each is a response with a name of its own.

Reading: unsegmented records are decoded where they are read. Segments are shuffled by origin, put in order of their
number and joined; the numbers must run from 1 without a gap and the lengths add up to the stated total. Then the
chunked framing is decoded and the digest compared. status says ok or what is wrong; a broken record has no payload
figures. Revisits take the length from the response that they name, by digest.

Equal payloads may be a third of all pages: only their digests are grouped (pre-aggregated), and both joins on a digest
send digests of a 256th of all rows or more, at most 256 of them, around them by broadcast. Null html is empty. Null
page_ids are never the smallest: such rows are revisits where another row has the payload, else responses. Rows that
repeat a page_id and its payload are responses each. Null urls have no target header. An empty table writes no files
and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofia.llm.common import left_join_hot, materialise, n_partitions, read_file, struct, table, work_dir, write_file

SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
FILE_BYTES = 64_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = re.compile(r"<urn:page:(-?[0-9]+|none)[;>]")


def b32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(c), c) for k in range(0, len(payload), size) if (c := payload[k : k + size])]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes | memoryview) -> bytes:
    """Decodes chunked transfer framing: sizes in hex, extensions after a semicolon, trailers up to an empty line."""
    body, at, parts = bytes(body), 0, []
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";", 1)[0], 16)
        at = end + 2
        if not size:
            break
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk doesn't end where it should")
        parts.append(body[at : at + size])
        at += size + 2
    while body[at : at + 2] != b"\r\n":
        at = body.index(b"\r\n", at) + 2
    return b"".join(parts)


def http_payload(block: bytes) -> bytes:
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of the HTTP head")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("WARC-Block-Digest", f"sha1:{b32(hashlib.sha1(block).digest())}"), ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def records(data: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each gzip member or plain record."""
    data = memoryview(data)
    if bytes(data[:2]) == b"\x1f\x8b":
        at = 0
        while at < len(data):
            unpacker = zlib.decompressobj(31)
            raw, size = [], 1 << 16
            while not unpacker.eof and at < len(data):
                raw.append(unpacker.decompress(data[at : at + size]))
                at += min(size, len(data) - at)
            at -= len(unpacker.unused_data)
            yield from records(b"".join(raw))
        return
    raw, at = bytes(data), 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(fields["content-length"])
        yield fields, raw[end + 4 : end + 4 + size]
        at = end + 8 + size


def record_id(page_id: int | None, name: str) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id};{name}>"


def page_records(name: str, page_id: int | None, url: str | None, payload: bytes, digest: bytes, first: tuple[int, str] | None, segment_bytes: int) -> tuple[bytes, list[bytes]]:
    """The row's record and its continuations. first: page and name of the response, for a revisit."""
    me = record_id(page_id, name)
    common = [("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        common.append(("WARC-Target-URI", re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url)))
    payload_digest = ("WARC-Payload-Digest", f"sha1:{b32(digest)}")
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if first:
        return record([("WARC-Type", "revisit"), ("WARC-Record-ID", me), *common, payload_digest, ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(*first))], head), []
    block = head + chunked(payload)
    parts = [block[k : k + segment_bytes] for k in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        return record([("WARC-Type", "response"), ("WARC-Record-ID", me), *common, payload_digest], block), []
    rest = []
    for k, part in enumerate(parts[1:], 2):
        own = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{me[:-1]};{k}>"), common[0], ("WARC-Segment-Origin-ID", me), ("WARC-Segment-Number", str(k))]
        rest.append(record(own + [("WARC-Segment-Total-Length", str(len(block)))] * (k == len(parts)), part))
    return record([("WARC-Type", "response"), ("WARC-Record-ID", me), *common, payload_digest, ("WARC-Segment-Number", "1")], parts[0]), rest


def write_archives(pages: DataFrame, folder: str, min_revisit: int = 0, segment_bytes: int = SEGMENT_BYTES, file_bytes: int = FILE_BYTES) -> list[str]:
    """Archives below folder, their names; one small row a file reaches the driver."""
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha1("payload"))
    total = pages.count()
    same = rows.filter(F.octet_length("payload") >= min_revisit).groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("n"))
    same = same.groupBy("digest").agg(F.sum("n").alias("copies"), F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "n"))).alias("first")).filter("copies > 1 AND first IS NOT NULL")
    marked = left_join_hot(rows, same, "digest", "copies", total).select("row", "page_id", "url", "payload", "digest", F.col("first.page_id").alias("first"), (F.col("first.n") == 1).alias("one"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), []
        held: dict[str, list[bytes]] = {"main": [], "continued": []}
        size = 0

        def flush() -> None:
            for kind, parts in held.items():
                if parts:
                    made.append(f"{folder}/{task:08d}-{len(made):06d}-{kind}.warc.gz")
                    write_file(made[-1], parts)
                    parts.clear()

        for b in batches:
            cols = {n: b.column(n) for n in ("row", "page_id", "url", "payload", "digest", "first", "one")}
            for row, page_id, url, payload, digest, first, one in zip(*(c.to_pylist() for c in cols.values())):
                revisit = first is not None and (page_id is None or page_id > first)
                main, rest = page_records(digest if one and page_id == first else str(row), page_id, url, payload, bytes.fromhex(digest), (first, digest) if revisit else None, segment_bytes)
                held["main"].append(main)
                held["continued"] += rest
                size += len(main) + sum(map(len, rest))
                if size > file_bytes:
                    flush()
                    size = 0
        flush()
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], ["file"])

    return sorted(r.file for r in marked.mapInArrow(write, struct("file string")).collect())


_READ = "kind string, origin string, segment int, total long, page_id long, payload_bytes long, payload_digest string, refers_to long, block binary, status string"


def _page(name: str | None) -> int | None:
    m = _ID.match(name or "")
    return int(m[1]) if m and m[1] != "none" else None


def _sha1_of(fields: dict[str, str]) -> str | None:
    d = fields.get("warc-payload-digest")
    return d.removeprefix("sha1:") if d else None


def _decoded(block: bytes, stated: str | None) -> tuple[int | None, str | None, str]:
    try:
        payload = http_payload(block)
    except ValueError:
        return None, None, "broken framing"
    found = b32(hashlib.sha1(payload).digest())
    return (len(payload), found, "ok") if stated in (None, found) else (None, None, "other digest")


def read_archives(spark, files: list[str]) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, status, one row a response or revisit."""
    listed = spark.createDataFrame([(f,) for f in files], "file string")
    if files:
        listed = listed.repartition(min(len(files), n_partitions(spark)), "file")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.string()), ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("block", pa.binary()), ("status", pa.string())])
        out: list[tuple] = []
        held = 0
        for b in batches:
            for uri in b.column(0).to_pylist():
                for f, block in records(read_file(uri)):
                    kind, me = f.get("warc-type"), f.get("warc-record-id")
                    if kind == "revisit":
                        out.append(("revisit", me, None, None, _page(me), None, _sha1_of(f), _page(f.get("warc-refers-to")), None, "ok"))
                    elif kind == "response" and "warc-segment-number" not in f:
                        size, digest, status = _decoded(block, _sha1_of(f))
                        out.append(("response", me, None, None, _page(me), size, digest, None, None, status))
                    elif kind in ("response", "continuation"):
                        total = f.get("warc-segment-total-length")
                        out.append(("segment", f.get("warc-segment-origin-id", me), int(f["warc-segment-number"]), total and int(total), _page(me), None, _sha1_of(f), None, block, None))
                        held += len(block)
                    if len(out) >= 5000 or held > 32_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                        out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    found = materialise(listed.mapInArrow(read, struct(_READ)), "warc-records")
    whole = found.filter(F.col("kind") == "response").select(*_OUT[:3], "status")
    parts = found.filter(F.col("kind") == "segment").select("origin", "segment", "total", "page_id", "payload_digest", "block")
    joined = reassemble(parts.repartition("origin").sortWithinPartitions("origin", "segment"))
    responses = whole.unionByName(joined).withColumn("record_type", F.lit("response")).withColumn("refers_to", F.lit(None).cast("long"))
    again = found.filter(F.col("kind") == "revisit").select("page_id", "payload_digest", "refers_to")
    times = again.groupBy("payload_digest").agg(F.count(F.lit(1)).alias("times"))
    sizes = responses.filter("status = 'ok'").groupBy(F.col("payload_digest").alias("d")).agg(F.max("payload_bytes").alias("payload_bytes"))
    known = times.join(sizes, F.col("payload_digest") == F.col("d")).select("payload_digest", "times", "payload_bytes")
    revisits = left_join_hot(again, known, "payload_digest", "times", again.count())
    revisits = revisits.select("page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to", F.when(F.col("payload_bytes").isNull(), "no such response").otherwise("ok").alias("status"))
    return responses.select(*_OUT, "status").unionByName(revisits)


_OUT = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def reassemble(parts: DataFrame) -> DataFrame:
    """parts: segments, those of an origin together and in order of their number. A repeated segment counts once."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        done: list[tuple] = []

        def close() -> None:
            seen = {s: (total, block) for _, s, total, *_, block in reversed(held)}
            page, stated = next(((p, d) for _, s, _, p, d, _ in held if s == 1), (_page(held[0][0]), None))
            block = b"".join(seen[s][1] for s in sorted(seen))
            totals = {t for t, _ in seen.values() if t is not None}
            if sorted(seen) != list(range(1, len(seen) + 1)) or totals != {len(block)} or seen[len(seen)][0] is None:
                done.append((page, None, None, "incomplete"))
            else:
                done.append((page, *_decoded(block, stated)))

        for b in batches:
            for row in zip(*(b.column(n).to_pylist() for n in ("origin", "segment", "total", "page_id", "payload_digest", "block"))):
                if held and held[0][0] != row[0]:
                    close()
                    held.clear()
                held.append(row)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string(), pa.string()))], [*_OUT[:3], "status"])
                done.clear()
        if held:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string(), pa.string()))], [*_OUT[:3], "status"])

    return parts.mapInArrow(join, struct("page_id long, payload_bytes long, payload_digest string, status string"))


def op2_warc(spark, sf_dir: str) -> DataFrame:
    return read_archives(spark, write_archives(table(spark, sf_dir, "pages"), work_dir(spark, "warc")))
