import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from asofia.llm import prefix_free as P

from .helpers import DOCS, bag, documents, odd

BIG = 1 << 63


def brute(docs):
    first = {}
    rows = [(d, (t or "").encode()) for d, t in docs]
    for d, b in rows:
        for i in range(len(b) - 49):
            w = b[i : i + 50]
            first[w] = min(first.get(w, BIG + 1), BIG if d is None else d)
    out = []
    for d, b in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < (BIG if d is None else d):
                gone[i : i + 50] = b"\1" * 50
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, y in zip(b, gone) if not y)
        out.append((d, len(b), sum(gone), spans, kept))
    return out


def digests(rows):
    return sorted([(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in rows], key=str)


def mixed(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcd ") for _ in range(rnd.choice((60, 200, 900)))) for _ in range(6)]
    docs = []
    for k in range(50):
        parts = [rnd.choice(base)[rnd.randint(0, 30) : rnd.randint(31, 800)] if rnd.random() < 0.6 else "".join(rnd.choice("abcdéf ") for _ in range(rnd.randint(0, 150))) for _ in range(rnd.randint(0, 5))]
        docs.append((rnd.choice([k, k, k, 3, None]), "".join(parts) if rnd.random() < 0.95 else None))
    return [*docs, (200, "ab" * 400), (201, "ab" * 300), (199, "a" * 500), (210, "a" * 49), (211, "a" * 50)]


@pytest.mark.parametrize("seed,block,hot", [(1, 12_000_000, False), (2, 3000, False), (3, 3000, True)])
def test_against_brute_force(spark, monkeypatch, seed, block, hot):
    docs = mixed(seed)
    monkeypatch.setattr(P, "BLOCK_BYTES", block)
    if hot:  # every trigger is sent as windows
        every = [P.Block(pa.RecordBatch.from_arrays([pa.array([0]), pa.array([t or ""])], ["_doc", "_text"])).phrases()["h"] for _, t in docs]
        monkeypatch.setattr(P, "_hot_triggers", lambda rows, parts: np.unique(np.concatenate(every)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert bag(P.report(df)) == digests(brute(docs))


def test_awkward_rows(spark):
    docs = odd(documents(spark))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert bag(P.report(docs)) == digests(brute(rows))


def test_drop_repeats_keeps_columns(spark):
    docs = odd(documents(spark))
    got = P.drop_repeats(docs)
    assert got.dtypes == docs.dtypes
    want = sorted([(d, k.decode("utf-8", "ignore")) for d, _, _, _, k in brute([(r.doc_id, r.text) for r in docs.collect()])], key=str)
    assert sorted([(r.doc_id, r.text or "") for r in got.collect()], key=str) == want
    assert all(r.n_chars == len(r.text) for r in got.collect() if r.text is not None) and sum(r.text is None for r in got.collect()) == 1


def test_no_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert P.report(empty).collect() == [] and P.drop_repeats(empty).collect() == []


def test_long_document_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 512)
    monkeypatch.setattr(P, "_POWERS", [])
    rnd = random.Random(4)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(5000))
    docs = [(2, text), (1, text[700:3100]), (3, "zz" + text[300:900] + "yy")]
    assert bag(P.report(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))) == digests(brute(docs))


def test_order_is_that_of_the_bytes():
    rnd = random.Random(5)
    texts = [bytes(rnd.choice(b"ab") for _ in range(24)) for _ in range(400)] + [b"a" * 24] * 3
    view = np.frombuffer(b"".join(texts), ">u8").reshape(-1, 3).astype(np.uint64)
    order, new = P.ranked(lambda rows, k: view[rows, k], len(texts), 3)
    ordered = [texts[i] for i in order]
    assert ordered == sorted(texts) and new.tolist() == [i == 0 or ordered[i] != ordered[i - 1] for i in range(len(texts))]
    assert P.ranked(lambda rows, k: view[rows, k], 0, 3)[0].tolist() == [] and P.ranked(lambda rows, k: view[rows, k], 1, 3)[1].tolist() == [True]


def pieces(docs, per_block, mix, monkeypatch):
    """report()'s rows by hand, without Spark, so that hashes can be made to collide."""
    monkeypatch.setattr(P, "mix64", mix)
    blocks = [P.Block(pa.RecordBatch.from_arrays([pa.array([P.LAST if d is None else d for d, _ in docs[k : k + per_block]], pa.int64()), pa.array([t or "" for _, t in docs[k : k + per_block]])], ["_doc", "_text"])) for k in range(0, len(docs), per_block)]
    sent, number, texts, gone = [], [], [], []
    for k, b in enumerate(blocks):
        c = b.phrases()
        repeat, alone, stands = b.combined(c["g"], c["at"], c["size"].astype(int) + 49, c["doc"])
        i = np.flatnonzero(alone)
        sent.append(P.take(c, i)), number.append(np.full(len(i), k)), texts.append(P.padded(b.text(c["at"][i], c["size"][i].astype(int) + 49), c["size"][i].astype(int) + 49))
        twin = np.flatnonzero(~repeat & ~alone)
        gone.append((np.stack([c["at"][repeat], c["size"][repeat].astype(int) + 49]).astype(int), c["at"][twin].astype(int), c["at"][stands[twin]].astype(int), c["size"][twin].astype(int)))
    c, number = {n: np.concatenate([x[n] for x in sent]) for n in sent[0]}, np.concatenate(number)
    which, begin, size = P.repeats(c, np.concatenate(texts))
    out = []
    for k, b in enumerate(blocks):
        mine = number[which] == k
        cuts = np.concatenate([gone[k][0], np.stack([c["at"][which[mine]] + begin[mine], size[mine]])], axis=1)
        removed = P._covered(len(b.data), *np.concatenate([cuts, P._twins(cuts, *gone[k][1:])], axis=1))
        for d, lo, hi in zip(b.doc.tolist(), b.starts.tolist(), b.starts[1:].tolist()):
            g = removed[lo:hi]
            out.append((None if d == P.LAST else d, hi - lo, int(g.sum()), int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()), hashlib.sha256(b.data[lo:hi][~g].tobytes()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [64, 16, 4])
def test_colliding_hashes_remove_nothing_else(monkeypatch, bits):
    docs, sound = mixed(7), P.mix64
    assert pieces(docs, 11, lambda x: sound(x) >> np.uint64(64 - bits), monkeypatch) == digests(brute(docs))


def test_one_phrase_many_times_in_a_document(spark):
    unit = "the quick brown fox jumps over the lazy dog and runs away from all. "
    docs = [(1, unit * 3), (2, unit * 200), (3, "x" + unit * 50 + "y"), (4, "ab" * 3000), (0, "ab" * 40)]
    assert bag(P.report(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))) == digests(brute(docs))
    assert bag(P.report(spark.createDataFrame(docs, "doc_id long, text string").repartition(5, "doc_id"))) == digests(brute(docs))
