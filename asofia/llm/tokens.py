"""Encoding of whole texts by public byte-level tokenizers, with a memo of the stretches between single spaces.

The pattern of GPT-2's kind never lets a piece run over a space that follows a character other than white space, and a
single newline between two such characters is a piece of its own. So a text whose gaps are all one space or one newline
can be cut there and each stretch encoded once; any other text is encoded in one go, and so is every text where a
tokenizer's file or a pattern says anything else (another pattern, a normaliser, a prefix, tokens of its own). The ids
are the library's own.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Stretches kept in a worker's memo; it starts anew when full, which changes no result.
MEMO = 600_000
#: Bytes of text cut at a time; words that repeat among them are looked up once.
TOGETHER = 4_000_000
#: A gap of more than one space or newline, one at an end, other white space, or nothing at all.
_UNSAFE = "^$|^[ \n]|[ \n]$|[ \n][ \n]|[\\x{9}\\x{b}-\\x{d}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def stretches(texts: pa.Array) -> tuple[np.ndarray, pa.ListArray]:
    """Which texts can be cut, and those texts, as if a newline came first, cut before each space and newline; what follows a space comes without it."""
    safe = pc.invert(pc.match_substring_regex(texts, f"(?-m){_UNSAFE}"))
    cut = pc.split_pattern(pc.binary_join_element_wise("\n", pc.replace_substring(texts.filter(safe), "\n", " \n"), ""), " ")
    return safe.to_numpy(zero_copy_only=False), cut


#: The pattern whose pieces keep to the stretches between single spaces; the tokenizers library's byte-level splitting has the same.
CUTTABLE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class StretchEncoder:
    """text -> ids as little-endian unsigned 32-bit integers.

    encode does so for any text by itself; encode_many takes stretches that start with a space or newline and returns
    all their ids and how many each has. A newline is one id. The memo is a column of stretches with their ids beside
    it, so lookups run in Arrow and no word becomes an object.
    """

    def __init__(self, encode: Callable[[str], bytes], encode_many: Callable[[pa.StringArray], tuple[np.ndarray, np.ndarray]], cuttable: bool = True):
        self.encode, self.encode_many, self.cuttable = encode, encode_many, cuttable
        self._clear()

    def _clear(self) -> None:
        self.words = pa.array([], pa.string())
        self.flat, self.starts, self.sizes, self.used = np.zeros(1 << 16, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int32), 0

    def _learn(self, new: pa.StringArray) -> None:
        lead = pc.if_else(pc.starts_with(new, "\n"), "", " ")
        ids, sizes = self.encode_many(pc.binary_join_element_wise(lead, new, ""))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
        self.words = pa.concat_arrays([self.words, new])
        self.used += len(ids)

    def many(self, texts: Sequence[str] | pa.Array) -> list[bytes]:
        return list(self.stream(texts))

    def stream(self, texts: Sequence[str] | pa.Array) -> Iterator[bytes]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        size = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64) if len(column) else []
        at = 0
        while at < len(column):
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + TOGETHER, "right")))
            yield from self._some(column.slice(at, end - at))
            at = end

    def _some(self, texts: pa.Array) -> Iterator[bytes]:
        if not self.cuttable:
            yield from map(self.encode, texts.to_pylist())
            return
        if len(self.words) > MEMO:
            self._clear()
        safe, cut = stretches(texts)
        words = cut.flatten().dictionary_encode()
        known = pc.index_in(words.dictionary, value_set=self.words)
        lack = pc.is_null(known)
        number = known.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        if known.null_count:
            number[lack.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(known.null_count)
            self._learn(words.dictionary.filter(lack))
        number = number[words.indices.to_numpy()]
        size = self.sizes[number]
        before = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        ids = self.flat[np.repeat(self.starts[number] - before[:-1], size) + np.arange(before[-1])].tobytes()
        ends = iter((before[np.cumsum(pc.list_value_length(cut).to_numpy(), dtype=np.int64)] * 4).tolist())
        at = 0
        for k, sound in enumerate(safe.tolist()):
            if sound:
                end = next(ends)
                yield ids[at + 4 : end]  # without the newline put first
                at = end
            else:
                yield self.encode(texts[k].as_py())


def joined(words: pa.StringArray, most: int) -> Iterator[tuple[str, np.ndarray]]:
    """Words one after the other as texts of at most so many words, and where each word ends, in bytes."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = words.buffers()[2]
    for k in range(0, len(words), most):
        o = offsets[k : k + most + 1]
        yield data[int(o[0]) : int(o[-1])].to_pybytes().decode(), o[1:] - o[0]


def cuttable(spec: dict) -> bool:
    """Whether a file of the tokenizers library splits bytes by CUTTABLE and by nothing else. Special tokens don't matter: they are ordinary text here."""
    split = spec.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    return plain and not spec.get("normalizer") and all(t.get("special") for t in spec.get("added_tokens") or [])


@lru_cache(2)
def library_encoder(path: str) -> StretchEncoder:
    """Of a file of the tokenizers library, without special tokens; their strings in a text are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    batch = getattr(t, "encode_batch_fast", t.encode_batch)
    width = np.zeros(t.get_vocab_size(), np.int64)  # each byte is one character of the library's alphabet
    for token, i in t.get_vocab(with_added_tokens=False).items():
        width[i] = len(token)

    def one(text: str) -> bytes:
        return np.array(batch([text], add_special_tokens=False)[0].ids, "<u4").tobytes() if text else b""

    def many(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [], []
        for text, ends in joined(words, 500):
            some = np.array(batch([text], add_special_tokens=False)[0].ids, "<u4")
            ids.append(some)
            sizes.append(np.diff(np.searchsorted(np.cumsum(width[some]), ends) + 1, prepend=0))
        return np.concatenate(ids), np.concatenate(sizes)

    return StretchEncoder(one, many, cuttable(json.loads(t.to_str())))


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


def default_path(name: str) -> str:
    """Where the installed package of public tokenizers keeps a file; every operator also takes a path of one's own."""
    import public_tokenizers

    return public_tokenizers.path(name)
