"""7. Secret scan: patterns propose spans; base64 and hex candidates are decoded and parsed before they are reported.

Kinds, in the order in which they are listed:

- assign, access, hex: the base patterns, leftmost and non-overlapping per kind; failing matches are dropped.
- jwt: a signed token: header and payload decode from base64url to JSON objects, the header names an algorithm.
- key: base64 or hex (a PEM body, line breaks or their escapes allowed, lines without armour, or a bare run, of either
  base64 alphabet) that decodes to a private key: DER whose nested
  lengths add up (PKCS#1, PKCS#8, SEC 1) or an openssh-key-v1 container whose length-prefixed fields add up.

Spans are code points, end exclusive, of the whole match. Nothing here is quadratic: runs are entered at their start
only. Null texts are empty and hold nothing; an empty list of spans is the empty string. Repeated rows are reported
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame

from asofia.llm.common import append_columns, table

KINDS = ("assign", "access", "hex", "jwt", "key")
Span = tuple[str, int, int]

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a shorter run would fail, and no later start in it is longer
_HEX = re.compile(r"[0-9a-f]{16,}")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{12,}+\.[A-Za-z0-9_-]{2,}+\.[A-Za-z0-9_-]*+")
_PEM = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----((?:[A-Za-z0-9+/=\s]|\\[nr])*+)-----END [A-Z0-9 ]{0,40}PRIVATE KEY-----")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}+={0,2}")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,80}(?:\r?\n[A-Za-z0-9+/]{40,80}+)*+\r?\n[A-Za-z0-9+/]{1,80}={0,2}")
_URL64 = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{40,}+={0,2}")
_LONG_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}+")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"api")


def base_spans(text: str) -> list[Span]:
    """Of the three base patterns."""
    found: list[Span] = []
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(w in low for w in _WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    if b"akia" in low:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


def _der(data: bytes, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(tag, start, end) of the elements that fill data[at:end] exactly; ValueError otherwise."""
    while at < end:
        if at + 2 > end:
            raise ValueError
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end:
                raise ValueError
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if at + size > end:
            raise ValueError
        yield tag, at, at + size
        at += size


def is_private_key(data: bytes) -> bool:
    """Whether data is, as a whole, a private key's encoding with sound nested lengths."""
    if data.startswith(b"openssh-key-v1\0"):
        at, fields = 15, 0
        while at + 4 <= len(data) and fields < 3:  # cipher, function, its options
            at += 4 + int.from_bytes(data[at : at + 4], "big")
            fields += 1
        if fields < 3 or at + 4 > len(data):
            return False
        keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        for _ in range(min(keys, 64) + 1):  # public parts, then the private one
            if at + 4 > len(data):
                return False
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        return 1 <= keys <= 64 and at == len(data)
    try:
        top = list(_der(data, 0, len(data)))
        if len(top) != 1 or top[0][0] != 0x30:
            return False
        parts = list(_der(data, *top[0][1:]))
        if not parts or parts[0][0] != 0x02 or parts[0][2] - parts[0][1] != 1:
            return False
        version, tags = data[parts[0][1]], [p[0] for p in parts]
        if tags[1:3] == [0x30, 0x04] and version <= 1:  # PKCS#8: algorithm, key
            algorithm = list(_der(data, *parts[1][1:]))
            return bool(algorithm) and algorithm[0][0] == 0x06 and parts[2][2] > parts[2][1]
        if len(tags) >= 9 and set(tags[:9]) == {0x02}:  # PKCS#1
            return True
        return version == 1 and tags[1:2] == [0x04] and parts[1][2] - parts[1][1] >= 16  # SEC 1
    except ValueError:
        return False


def _json_part(part: str) -> object:
    try:
        return json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, RecursionError):
        return None


def is_signed_token(candidate: str) -> bool:
    head, payload, signature = candidate.split(".", 2)
    header = _json_part(head)
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(_json_part(payload), dict) and (bool(signature) or header["alg"].lower() == "none")


def _decoded(run: str) -> bytes | None:
    run = "".join(run.replace("\\n", "").replace("\\r", "").split()).rstrip("=")
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (ValueError, binascii.Error):
        return None


_STANDARD = str.maketrans("-_", "+/")


def inside(spans: list[tuple[int, int]], keys: list[tuple[int, int]]) -> list[bool]:
    """Of each span, whether it lies within one of the keys: by bisection, as those that start no later reach so far."""
    rest = sorted(keys)
    reach = list(accumulate((b for _, b in rest), max))
    out = []
    for a, b in spans:
        k = bisect_left(rest, (a + 1,))
        out.append(k > 0 and reach[k - 1] >= b)
    return out


def confirmed_spans(text: str) -> list[Span]:
    """What structure confirms: signed tokens and private keys."""
    found = [("jwt", *m.span()) for m in _JWT.finditer(text) if is_signed_token(m[0])] if "." in text else []
    keys: list[tuple[int, int]] = []
    if "-----BEGIN " in text:
        keys += [m.span() for m in _PEM.finditer(text) if (d := _decoded(m[1])) and is_private_key(d)]
    bare = [m.span() for m in _LONG_HEX.finditer(text) if len(m[0]) % 2 == 0]
    keys += [(a, b) for (a, b), known in zip(bare, inside(bare, keys)) if not known and is_private_key(bytes.fromhex(text[a:b]))]
    for pattern in (_WRAPPED, _BASE64, _URL64):
        bare = [m.span() for m in pattern.finditer(text)] if pattern is not _WRAPPED or "\n" in text else []
        for (a, b), known in zip(bare, inside(bare, keys)):
            if not known and (d := _decoded(text[a:b] if pattern is not _URL64 else text[a:b].translate(_STANDARD))) and is_private_key(d):
                keys.append((a, b))
    return found + [("key", *s) for s in keys]


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans, each by start, then kind as listed."""
    # Each kind needs 12 characters or more without white space, bar PEM blocks with very short lines.
    long = "\n".join([w for w in text.split() if len(w) >= 12])
    low = long and text.encode("utf-8", "surrogatepass").lower()
    if not (long and (_SUSPECT(long) or any(w in low for w in _WORDS)) or "-----BEGIN " in text):
        return [], []
    rank = {k: i for i, k in enumerate(KINDS)}
    order = lambda s: (s[1], rank[s[0]], s[2])
    base = sorted(base_spans(text), key=order)
    return base, sorted(base + confirmed_spans(text), key=order)


_SUSPECT = re.compile(r"[0-9a-f]{16}|AKIA|[A-Za-z0-9+/]{40}|[A-Za-z0-9_-]{12}\.[A-Za-z0-9_-]{2}|[0-9A-Fa-f]{64}|[A-Za-z0-9_-]{40}").search


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """keep's columns, counts of the base kinds, a digest of the base spans, and all spans."""

    def start():
        def each(texts):
            found = [find_spans(t) for t in texts]
            counts = [[sum(s[0] == k for s in b) for b, _ in found] for k in KINDS[:3]]
            return [*counts, [hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found], [joined(a) for _, a in found]]

        return each

    return append_columns(docs, text, keep if keep is not None else ["doc_id"], start, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
