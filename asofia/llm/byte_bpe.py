"""9. Byte-level BPE over Latin-1 strings: Aho-Corasick matches, backtracking, memoised compatibility of neighbours.

Each piece's bytes are read as a Latin-1 string, in which an automaton (pyahocorasick) finds, for every position, the
longest token that starts there. Encoding walks from left to right with the longest token first and steps to shorter
prefixes, or back, while the last two tokens aren't compatible. Two tokens are compatible if merging their joint bytes
by rank would leave exactly them; that depends on these two tokens only and is memoised. Positions that proved dead are
marked, so each is left once and the work is linear in the piece. A piece that is itself a token is that token.

Null and empty texts give no ids. Repeated rows and ties are rows of their own; other columns are ignored; an empty
table gives no rows. Texts of any length are taken whole; memory follows the longest text.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from asofia.llm.common import append_columns, table
from asofia.llm.tokens import CUTTABLE, StretchEncoder, default_path

#: Memoised neighbours and pieces; both memos start anew when full.
MEMO = 500_000
PIECES = 100_000


class RankEncoder:
    """ranks: bytes of each token -> id; a lower id merges first. All 256 bytes must be tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.find = ranks, regex.compile(pattern).findall
        size = max(ranks.values()) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for b, i in ranks.items():
            self.bytes_of[i] = b
        self.left, self.right = list(range(size)), list(range(size))
        self.shorter = [-1] * size
        self.merged: dict[tuple[int, int], int] = {}
        self.fits_memo: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}
        trie = ahocorasick.Automaton()
        for b, i in sorted(ranks.items(), key=lambda x: x[1]):
            prefixes = [t for n in range(len(b) - 1, 0, -1) if (t := ranks.get(b[:n])) is not None]
            reachable = len(b) == 1
            for t in prefixes:
                rest = ranks.get(b[len(self.bytes_of[t]) :])
                if t < i and rest is not None and rest < i and self._fits(t, rest):
                    self.left[i], self.right[i], self.merged[t, rest], reachable = t, rest, i, True
                    break
            if reachable:
                trie.add_word(b.decode("latin-1"), (i, len(b)))
            else:  # merging never ends in it: only a whole piece may be it
                self.left[i] = -2
        for b, i in ranks.items():
            self.shorter[i] = next((t for n in range(len(b) - 1, 0, -1) if (t := ranks.get(b[:n])) is not None and self.left[t] != -2), -1)
        trie.make_automaton()
        self.trie = trie
        self.fits_memo.clear()

    def fits(self, a: int, b: int) -> bool:
        known = self.fits_memo.get((a, b))
        if known is None:
            if len(self.fits_memo) > MEMO:
                self.fits_memo.clear()
            known = self.fits_memo[a, b] = self._fits(a, b)
        return known

    def _fits(self, a: int, b: int) -> bool:
        """Undoes the merges of a's right edge and b's left edge from the latest to the earliest; none may cross before them."""
        limit, left, right, merged = 1 << 60, self.left, self.right, self.merged
        while True:
            crossing = merged.get((a, b))
            if crossing is not None and crossing < limit:
                return False
            a_whole, b_whole = right[a] == a, left[b] == b
            if a_whole and b_whole:
                return True
            if not a_whole and (a > b or b_whole):
                limit, a = a, right[a]
            else:
                limit, b = b + 1, left[b]

    def piece(self, b: bytes) -> list[int]:
        whole = self.ranks.get(b)
        if whole is not None:
            return [whole]
        n = len(b)
        longest, reach = [-1] * n, [0] * n
        for end, (t, size) in self.trie.iter(b.decode("latin-1")):
            if size > reach[end - size + 1]:
                longest[end - size + 1], reach[end - size + 1] = t, size
        bytes_of, shorter, fits = self.bytes_of, self.shorter, self.fits
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, t = 0, longest[0]
        while at < n:
            end = at + len(bytes_of[t])
            if alive[end] and (not out or fits(out[-1], t)):
                out.append(t)
                at = end
                t = longest[at] if at < n else -1
            elif shorter[t] >= 0:
                t = shorter[t]
            else:
                alive[at] = 0
                t = out.pop()
                at -= len(bytes_of[t])
        return out

    def encode(self, text: str) -> bytes:
        pieces, parts = self.pieces, []
        if len(pieces) > PIECES:
            pieces.clear()
        for p in self.find(text):
            ids = pieces.get(p)
            if ids is None:
                ids = np.array(self.piece(p.encode()), "<u4").tobytes()
                if len(p) < 24:
                    pieces[p] = ids
            parts.append(ids)
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(2)
def rank_encoder(path: str, pattern: str) -> tuple[RankEncoder, StretchEncoder]:
    r = RankEncoder(read_ranks(path), pattern)

    def many(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        ids = [r.encode(w) for w in words.to_pylist()]
        return np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) // 4 for x in ids], np.int64)

    return r, StretchEncoder(r.encode, many, pattern == CUTTABLE)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """keep's columns and ids, binary: little-endian unsigned 32-bit integers."""
    path, pattern = path or default_path("byte_bpe_multi_50k.tiktoken"), pattern or default_pattern()

    def start():
        _, stretch = rank_encoder(path, pattern)
        return lambda texts: [stretch.many(texts)]

    return append_columns(docs, text, keep if keep is not None else ["doc_id"], start, "ids binary")


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encodes whole texts, decodes the ids again, and returns counts and digests of both."""
    path, pattern = path or default_path("byte_bpe_multi_50k.tiktoken"), pattern or default_pattern()

    def start():
        ranks, stretch = rank_encoder(path, pattern)

        def each(texts):
            ids = stretch.many(texts)
            return [[len(x) // 4 for x in ids], [hashlib.sha256(x).hexdigest() for x in ids], [hashlib.sha256(ranks.decode(x)).hexdigest() for x in ids]]

        return each

    return append_columns(docs, "text", ["doc_id"], start, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
