import random

import numpy as np

from asofia.llm import simhash_forest as S

from .helpers import DOCS, documents, odd


def brute(rows):
    """(class_id, links, size) by row, from all pairs of different texts."""
    texts = {}
    for _, t in rows:
        texts.setdefault(t or "", len(texts))
    words = [S.words(t) for t in texts]
    prints = np.frombuffer(b"".join(S.fingerprint(w) for w in words), np.uint8).reshape(-1, 32)
    up, links = list(range(len(texts))), [0] * len(texts)

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for i in range(len(texts)):
        for j in range(i):
            a, b = len(words[i]), len(words[j])
            if min(a, b) >= S.MIN_WORDS and 2 * min(a, b) >= max(a, b) and np.unpackbits(prints[i] ^ prints[j]).sum() <= S.DISTANCE:
                links[i] += 1
                links[j] += 1
                up[find(i)] = find(j)
    groups = {}
    for d, t in rows:
        groups.setdefault(find(texts[t or ""]), []).append(d)
    out = []
    for d, t in rows:
        g = groups[find(texts[t or ""])]
        known = [x for x in g if x is not None]
        out.append((d, (min(known) if known else None) if len(g) > 1 else d, links[texts[t or ""]], len(g)))
    return sorted(out, key=str)


def corpus(n=260):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 9)))
    rows = []
    for k in range(n):
        kind = rnd.random()
        if k > 20 and kind < 0.5:
            t = rnd.choice(rows[: 20 if kind < 0.3 else k])[1].split()
            if kind > 0.1:
                for _ in range(max(1, len(t) // 20)):
                    t[rnd.randrange(len(t))] = word()
            rows.append((k, " ".join(t)))
        else:
            rows.append((k, " ".join(word() for _ in range(rnd.randint(3, 120)))))
    return rows


def got(df):
    return sorted([(r.doc_id, r.class_id, r.n_links, r.class_size) for r in df.collect()], key=str)


def agreement(df, rows):
    """The share of linked rows that come out as by brute force."""
    have, want = got(df), brute(rows)
    linked = [w for w in want if w[2]]
    return len(set(have) & set(linked)) / max(1, len(set(linked)))


def test_against_brute_force(spark, monkeypatch):
    """Links at up to 20 bits are sure to be found, so that rows are those of brute force."""
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(S, "DISTANCE", 20)  # for brute()
    want = brute(rows)
    for forest in (S.Forest(20, 1 - 1e-9), S.Forest(20, 1 - 1e-9, block=40), S.Forest(20, 1 - 1e-9, row=1)):  # as it is, dense nodes in blocks, long prefixes
        assert got(S.near_duplicates(df, forest)) == want


def test_at_the_distance_of_links(spark):
    rows = corpus()
    assert agreement(S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), rows) >= 0.97


def test_tries_reach_their_recall():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2, (4000, S.BITS), np.uint8)
    b = a.copy()
    np.put_along_axis(b, (apart := np.argsort(rng.random(a.shape), axis=1)[:, : S.DISTANCE]), 1 - np.take_along_axis(a, apart, axis=1), axis=1)
    for depth in (2, 8, 14):
        orders = S.permutations(S.Forest().tries(depth), depth)
        found = (S.prefixes(np.packbits(a, axis=1), orders) == S.prefixes(np.packbits(b, axis=1), orders)).any(axis=1)
        assert found.mean() >= S.RECALL - 0.005, depth


def planted(n, dense, pairs, seed=5):
    """Distinct fingerprints: random ones, a group around one centre, and pairs at 49 to 54 bits."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2, (n, S.BITS), np.uint8)
    centre = rng.integers(0, 2, S.BITS, np.uint8)
    base[:dense] = centre ^ (rng.random((dense, S.BITS)) < 0.2)  # some 82 bits from each other
    other = base[:pairs * (n // pairs) : n // pairs].copy()
    for row in other:
        row[rng.permutation(S.BITS)[: rng.integers(49, 55)]] ^= 1
    return np.packbits(np.concatenate([base, other]), axis=1)


def all_links(prints):
    """Links by row, from all pairs."""
    wide, links = prints.view(np.uint64), np.zeros(len(prints), np.int64)
    for k in range(0, len(wide), 256):
        apart = sum(np.bitwise_count(wide[k : k + 256, None, w] ^ wide[None, :, w]).astype(np.uint16) for w in range(4))
        links[k : k + 256] = (apart <= S.DISTANCE).sum(axis=1) - 1
    return links


def found_links(spark, prints):
    nodes = spark.createDataFrame([(bytearray(p.tobytes()), 50, 1) for p in prints], "_print binary, _words int, weight long").repartition(4)
    return {r.node: r.links for r in S._compare(nodes, len(prints)).groupBy("node").sum("links").withColumnRenamed("sum(links)", "links").collect()}


def test_recall_at_the_distance_of_a_link(spark):
    """Over 50,000 different fingerprints, pairs at 49 to 54 bits; a fifth of the rows crowd around one centre."""
    prints = planted(50_000, 10_000, 2_000)
    want = all_links(prints)
    found = found_links(spark, prints)
    have = np.array([found.get(x, 0) for x in S.node_ids(prints).tolist()])
    assert want.sum() >= 4_000 and (have <= want).all() and have.sum() >= 0.975 * want.sum()


def test_depth_follows_density(spark):
    prints = planted(20_000, 4_000, 10)
    nodes = spark.createDataFrame([(bytearray(p.tobytes()), 50, 1) for p in prints], "_print binary, _words int, weight long").repartition(3)
    plan, sent = S.make_plan(nodes, len(prints), S.Forest(row=50))
    level = plan.level(prints)
    assert level[:4_000].mean() > level[4_000:].mean() and len(set(level.tolist())) > 1 and sent > len(prints)
    few, _ = S.make_plan(nodes.limit(2), 2)
    assert len(few.orders(few.first)[0]) >= 2  # two rows meet in tries as well


def test_awkward_rows(spark):
    docs = odd(documents(spark))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(S.near_duplicates(docs)) == brute(rows)  # no link here is near the limit
    kept = S.drop_near_duplicates(docs)
    assert kept.dtypes == docs.dtypes
    classes = {r.class_id if r.class_size > 1 else ("own", r.doc_id) for r in S.near_duplicates(docs).collect()}
    assert kept.count() == len(classes) == sum(r.is_first for r in S.near_duplicates(docs).collect())
    assert {4, 3} & {r.doc_id for r in kept.collect()} == set() and 1 in {r.doc_id for r in kept.collect()}


def test_no_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert S.near_duplicates(empty).collect() == [] and S.drop_near_duplicates(empty).collect() == []


def test_hot_copies(spark):
    rows = [(k, "the same five or six words here") if k % 3 else (k, f"a different text number {k} with words w{k} x{k} y{k} z{k}") for k in range(400)]
    assert got(S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_components(spark):
    edges = [(k + 1, k) for k in range(0, 60)] + [(100, 105), (105, 103), (7, 7), (200, 300)]
    roots = {r.node: r.root for r in S.components(spark.createDataFrame(edges, "node long, root long")).collect()}
    assert all(roots[k] == 0 for k in range(1, 61)) and roots[105] == roots[103] == 100 and roots[300] == 200 and 7 in roots and 100 not in roots
