import numpy as np
import pytest

from asofia.llm import pruned_graph as G

from .helpers import odd


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute(rows, k=20, every=20):
    ok = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in rows if i is not None and v]
    out = {}
    for n, (i, q) in enumerate(ok):
        if i % every == 0:
            s = sorted(((-float(q @ v), j) for m, (j, v) in enumerate(ok) if m != n))[:k]
            out.setdefault(i, []).append([(j, -x) for x, j in s])
    return out


@pytest.mark.parametrize("shards", [1, 3, 12])
def test_recall_and_scores(spark, shards):
    rng = np.random.default_rng(2)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(3000, 24)) * rng.uniform(0.5, 2, (3000, 1)))]
    got = G.search(odd(vectors(spark, [(i, v, 0) for i, v in rows])), shard_rows=-(-3000 // shards), least_rows=3000).collect()
    want, found = brute(rows), {}
    for r in sorted(got, key=lambda r: r.rank):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == set(want) and all(len(x) == 20 for x in found.values())
    data = dict((i, np.array(v, np.float32).astype(np.float64)) for i, v in rows)
    assert all(abs(data[q] @ data[j] - s) < 1e-9 for q, x in found.items() for j, s in x)
    assert all(x == sorted(x, key=lambda y: (-y[1], y[0])) for x in found.values())
    assert np.mean([len({j for j, _ in found[q]} & {j for j, _ in want[q][0]}) / 20 for q in want]) >= 0.9


def test_tiles(spark, monkeypatch):
    """Several shards and blocks a tile give the rows of one each."""
    rng = np.random.default_rng(4)
    df = vectors(spark, [(k, v.tolist(), 0) for k, v in enumerate(rng.normal(size=(900, 8)))])
    monkeypatch.setattr(G, "BLOCK_ROWS", 4)
    fine = sorted(map(tuple, G.search(df, shard_rows=60, least_rows=60).collect()))
    for shards, blocks in ((1, 1), (3, 2)):
        monkeypatch.setattr(G, "TILE_SHARDS", shards)
        monkeypatch.setattr(G, "TILE_BLOCKS", blocks)
        assert sorted(map(tuple, G.search(df, shard_rows=60, least_rows=60).collect())) == fine


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.5, 0.5]), (4, [0.5, 0.5]), (5, None), (6, []), (7, [0.0, 0.0]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0]), (11, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (40, [nan, 1.0]), (3, [0.5, 0.5]), (-20, [-1.0, 0.0])]
    got = G.search(vectors(spark, [(i, v, 1) for i, v in rows])).collect()
    by = {}
    for r in sorted(got, key=lambda r: r.rank):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert by == {0: [(3, 0.5), (3, 0.5), (4, 0.5), (20, 0.5), (-20, -1.0)], 20: [(0, 0.5), (3, 0.5), (3, 0.5), (4, 0.5), (-20, -0.5)], -20: [(3, -0.5), (3, -0.5), (4, -0.5), (20, -0.5), (0, -1.0)]}


def test_no_rows(spark):
    assert G.search(vectors(spark, [])).collect() == []
    assert G.search(vectors(spark, [(20, [1.0], 0)])).collect() == []


def test_many_equal_vectors(spark):
    got = G.search(vectors(spark, [(k, [1.0, 1.0], 0) for k in range(300)])).collect()
    assert len(got) == 15 * 20 and all(r.score == 2.0 for r in got)
