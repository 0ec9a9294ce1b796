import zlib
from collections import defaultdict

import numpy as np

from asofia.llm import hilbert_pack as H

from .helpers import DOCS, documents, odd
from .test_token_store import plain_ids


def check(rows, docs, size):
    plain = plain_ids()
    by_seq, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at == size or at & (at - 1) == 0 and at < size
    want = defaultdict(list)
    for d, t in docs:
        want[d].append(np.array([*plain(t), 1], "<u4"))
    for d, texts in want.items():
        mine = pieces.pop(d)
        for ids in {x.tobytes(): x for x in texts}.values():
            copies = sum(x.tobytes() == ids.tobytes() for x in texts)
            covered = np.zeros(len(ids), int)
            for r in mine:
                if r.doc_tokens == len(ids) and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32:
                    covered[r.start : r.start + r.length] += 1
            assert (covered == copies).all()
        assert sum(r.length for r in mine) == sum(map(len, texts))
    assert not pieces


def test_every_id_once(spark):
    docs = odd(documents(spark))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for size in (64, 2048):
        check(H.pack(docs, size=size).collect(), rows, size)


def test_slices(spark, monkeypatch):
    monkeypatch.setattr(H, "SLICE", 40)
    docs = documents(spark)
    check(H.pack(docs, size=64).collect(), [(r.doc_id, r.text) for r in docs.collect()], 64)


def test_no_rows(spark):
    assert H.pack(spark.createDataFrame([], DOCS)).collect() == []


def test_hilbert_is_a_walk():
    for dims, bits in ((2, 3), (3, 2)):
        side = 1 << bits
        grid = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = H.hilbert(grid, bits)
        assert sorted(keys.tolist()) == list(range(side**dims))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()
