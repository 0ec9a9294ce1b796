import hashlib
import random

import numpy as np
import pytest
import tiktoken

from asofia.llm import byte_bpe as B
from asofia.llm.tokens import default_path

from .helpers import DOCS, document_rows, documents, odd


def library(path):
    return tiktoken.Encoding("own", pat_str=B.default_pattern(), mergeable_ranks=B.read_ranks(path), special_tokens={})


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_against_the_library(name):
    path = default_path(name)
    ranks, stretch = B.rank_encoder(path, B.default_pattern())
    lib, rnd = library(path), random.Random(1)
    parts = ["a", "e", "t", "th", " ", "  ", "\n", "é", "日", "本", "1", "23", "'s", "'", "!", "\t", "ing", "tion", "aaaa", "🙂", " "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(chr(rnd.choice((rnd.randint(97, 122), rnd.randint(0, 0x2FFF)))) for _ in range(30)) for _ in range(500)] + [t or "" for _, t, *_ in document_rows()] + ["a" * 3000, "ab" * 3000]
    for t, ids in zip(texts, stretch.many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(t)
        assert ranks.decode(ids) == t.encode()


def test_unreachable_tokens():
    ranks = {bytes([k]): k for k in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 300, b"xbc": 301, b"abcd": 302}
    e = B.RankEncoder(ranks, r"[a-z]+|[^a-z]+")
    lib = tiktoken.Encoding("own", pat_str=r"[a-z]+|[^a-z]+", mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(2)
    for _ in range(3000):
        t = "".join(rnd.choice("abcdx ") for _ in range(rnd.randint(0, 12)))
        assert np.frombuffer(e.encode(t), "<u4").tolist() == lib.encode_ordinary(t), t


def test_rows(spark):
    docs = odd(documents(spark))
    lib = library(default_path("byte_bpe_multi_50k.tiktoken"))
    want = []
    for r in docs.collect():
        ids = np.array(lib.encode_ordinary(r.text or ""), "<u4")
        want.append((r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, B.round_trip(docs).collect()), key=str) == sorted(want, key=str)
    assert B.encode(docs.drop("ids")).count() == len(want)
    assert B.round_trip(spark.createDataFrame([], DOCS)).collect() == []
