"""5. Nearest neighbours by inner product on robust-pruned directed graphs, one a shard.

Rows are dealt to shards by hash, of SHARD_ROWS each or fewer if the session has tasks for more; each shard is one task's.
That task adds its vectors in batches that double in size: a greedy beam search
on the graph so far proposes neighbours for a whole batch at once, robust pruning with the relaxed factor ALPHA keeps
diverse edges, and reverse edges are added and pruned alike. Inner products become distances by one more component,
sqrt(M^2 - |x|^2) with M the shard's largest norm. The graphs are written to the shared folder, and so are the queries,
once, in blocks. A task then takes a tile of some shards and some blocks: it reads each graph and each block, beam-searches
every query from the shard's entry point, scores the best WIDTH again in double precision on the original vectors and
keeps the best k over its shards, so just k rows a query and tile are shuffled. The best k over all tiles stay, ties to
the smaller vec_id.

The index is approximate; recall against brute force is measured in tests (0.9 at least). Every row is indexed. A
vector that is null, empty, zero, holds a null or non-finite component, or has another length than most takes no part,
nor does a null vec_id. Equal vectors of a shard are one point of its graph with a list of rows, so copies, however
many, don't crowd out edges; of a point's rows the k + 1 of the smallest vec_id can be wanted. Rows that repeat a vec_id are candidates each, for each other too. With fewer candidates than k
all are returned. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from asofia.llm.common import filesystem, materialise, n_partitions, read_file, struct, table, work_dir, write_file

DEGREE, BEAM, ALPHA = 32, 64, 1.2
QUERY_BEAM = 160
WIDTH = 48
#: Rows of a shard, at most and at least; queries of a block; shards and blocks of a tile at most.
SHARD_ROWS, LEAST_ROWS, BLOCK_ROWS, TILE_SHARDS, TILE_BLOCKS = 32_768, 8_192, 512, 8, 128
BATCH = 512
EXPAND = 4


class Graph:
    """points: rows with the extra component, float32. edges: DEGREE neighbours a row, -1 where there are fewer."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, entry: int):
        self.points, self.edges, self.entry = points, edges, entry
        self.half = (points * points).sum(1) / 2

    def search(self, queries: np.ndarray, beam: int, among: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and half distances (bar the query's own part) of the nearest found, nearest first; -1 fills up."""
        n, b = among or len(self.points), len(queries)
        seen = np.zeros((b, n), bool)
        rows = np.arange(b)
        place = np.full((b, beam), -1, np.int32)
        far = np.full((b, beam), np.inf, np.float32)
        done = np.ones((b, beam), bool)
        place[:, 0], done[:, 0], seen[:, self.entry] = self.entry, False, True
        far[:, 0] = self.half[self.entry] - queries @ self.points[self.entry]
        active = rows
        while len(active):
            open_far = np.where(done[active], np.inf, far[active])
            pick = np.argpartition(open_far, EXPAND - 1, axis=1)[:, :EXPAND] if beam > EXPAND else np.argsort(open_far, axis=1)
            good = np.isfinite(np.take_along_axis(open_far, pick, 1))
            alive = good.any(1)
            active, pick, good = active[alive], pick[alive], good[alive]
            if not len(active):
                break
            done[active[:, None], pick] |= good
            near = np.where(good[:, :, None], self.edges[place[active[:, None], pick]], -1).reshape(len(active), -1)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[(near >= 0) & seen[active[:, None], near]] = -1
            fresh = near >= 0
            r, c = np.nonzero(fresh)
            hit = near[r, c]
            seen[active[r], hit] = True
            new = np.full(near.shape, np.inf, np.float32)
            new[r, c] = self.half[hit] - np.einsum("ij,ij->i", self.points[hit], queries[active[r]])
            all_far = np.concatenate([far[active], new], axis=1)
            all_place = np.concatenate([place[active], near], axis=1)
            all_done = np.concatenate([done[active], ~fresh], axis=1)
            keep = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            far[active] = np.take_along_axis(all_far, keep, 1)
            place[active] = np.take_along_axis(all_place, keep, 1)
            done[active] = np.take_along_axis(all_done, keep, 1)
        order = np.argsort(far, axis=1, kind="stable")
        far = np.take_along_axis(far, order, 1)
        return np.where(np.isfinite(far), np.take_along_axis(place, order, 1), -1), far


def prune(points: np.ndarray, of: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each row of `of`, up to degree of its candidates (-1: none): the nearest first, each ruling out what it is nearer to by alpha."""
    c = np.sort(candidates, axis=1)
    c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
    c[c == of[:, None]] = -1
    x = points[np.maximum(c, 0)]
    p = points[of]
    far = ((x - p[:, None]) ** 2).sum(2)
    far[c < 0] = np.inf
    order = np.argsort(far, axis=1, kind="stable")
    c, far = np.take_along_axis(c, order, 1), np.take_along_axis(far, order, 1)
    x = np.take_along_axis(x, order[:, :, None], 1)
    own = (x * x).sum(2)
    apart = own[:, :, None] + own[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
    out = np.full((len(of), degree), -1, np.int32)
    rows = np.arange(len(of))
    alive = np.isfinite(far)
    for k in range(degree):
        first = alive.argmax(1)
        has = alive[rows, first]
        if not has.any():
            break
        out[has, k] = c[rows, first][has]
        alive &= ~(has[:, None] & (alpha * alpha * apart[rows, first] <= far))
        alive[rows, first] = False
    return out


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> Graph:
    v = vectors.astype(np.float64)
    norms = (v * v).sum(1)
    scale = np.sqrt(norms.max()) or 1.0
    points = np.concatenate([v / scale, np.sqrt(np.maximum(0, 1 - norms / scale**2))[:, None]], axis=1).astype(np.float32)
    n = len(points)
    order = np.random.default_rng(5).permutation(n)
    middle = points.mean(0)
    first = int(np.argmin(((points - middle) ** 2).sum(1)))
    order = np.concatenate([[first], order[order != first]])
    points_in = points[order]  # the entry is place 0 while building
    g = Graph(points_in, np.full((n, degree), -1, np.int32), 0)
    at = 1
    while at < n:
        new = np.arange(at, min(n, at + min(BATCH, max(1, at))))
        found, _ = g.search(points_in[new], beam, among=n)
        if at <= beam:  # few rows so far: all are proposed
            found = np.concatenate([found, np.broadcast_to(np.arange(at, dtype=np.int32), (len(new), at))], axis=1)
        g.edges[new] = prune(points_in, new, found, degree, alpha)
        src = np.repeat(new, degree)
        dst = g.edges[new].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        heads, start, count = np.unique(dst, return_index=True, return_counts=True)
        held = (g.edges[heads] >= 0).sum(1)
        fits = held + count <= degree
        place = np.arange(len(dst)) - np.repeat(start, count)
        ok = np.repeat(fits, count)
        g.edges[dst[ok], (np.repeat(held, count) + place)[ok]] = src[ok]
        over = np.flatnonzero(~fits)
        for wide in (over[count[over] <= degree], over[count[over] > degree]):  # few have many new neighbours
            for k in range(0, len(wide), BATCH):
                some = wide[k : k + BATCH]
                extra = np.full((len(some), int(count[some].max())), -1, np.int32)
                for row, h in enumerate(some):
                    extra[row, : count[h]] = src[start[h] : start[h] + count[h]]
                g.edges[heads[some]] = prune(points_in, heads[some], np.concatenate([g.edges[heads[some]], extra], axis=1), degree, alpha)
        at = int(new[-1]) + 1
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    edges = np.where(g.edges >= 0, order[np.maximum(g.edges, 0)], -1).astype(np.int32)[back]
    return Graph(points, edges, int(order[0]))


def nearest(graph: Graph, vectors: np.ndarray, queries: np.ndarray, width: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (-1: none) of the best width by exact inner product in double precision, and those products."""
    q = queries.astype(np.float64)
    length = np.sqrt((q * q).sum(1))[:, None]
    turned = np.concatenate([q / np.where(length > 0, length, 1), np.zeros((len(q), 1))], axis=1).astype(np.float32)
    found, _ = graph.search(turned, max(beam, width))
    found = found[:, :width]
    exact = np.einsum("ijk,ik->ij", vectors[np.maximum(found, 0)].astype(np.float64), q)
    return found, np.where(found >= 0, exact, -np.inf)


def clean(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and vector (double) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    sound = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    sound = sound.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0))
    usual = sound.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return sound.filter(F.size("v") == (usual["n"] if usual else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _runs(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows come sorted by a column: each of its values with all its rows."""
    held: list[pa.RecordBatch] = []
    now = None
    for b in batches:
        s = b.column(by).to_numpy()
        edges = np.flatnonzero(np.diff(s)) + 1
        for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(s)]):
            if i == j:
                continue
            if held and s[i] != now:
                yield now, pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            now = int(s[i])
            held.append(b.slice(i, j - i))
    if held:
        yield now, pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def search(rows: DataFrame, vector: str = "embedding", k: int = 20, every: int = 20, shard_rows: int = SHARD_ROWS, least_rows: int = LEAST_ROWS, width: int = WIDTH, beam: int = QUERY_BEAM) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose vec_id is divisible by every, against all rows."""
    spark = rows.sparkSession
    out = T.StructType([*struct("query_id long, rank int, vec_id long, score double")])
    stored = materialise(clean(rows, vector).withColumn("row", F.monotonically_increasing_id()), "vectors")
    n = stored.count()
    if not n:
        return spark.createDataFrame([], out)
    folder, parts = work_dir(spark, "graphs"), n_partitions(spark)
    shards = max(-(-n // shard_rows), min(parts, -(-n // least_rows)))
    dealt = stored.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")).repartitionById(shards, F.col("shard")).sortWithinPartitions("row")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for now, t in _runs(batches, "shard"):
            v, point = np.unique(_matrix(t.column("v")), axis=0, return_inverse=True)
            vec_id, row, point = t.column("vec_id").to_numpy(), t.column("row").to_numpy(), point.ravel()
            order = np.lexsort((row, vec_id, point))
            g = build(v)
            sink = io.BytesIO()
            np.savez(sink, vectors=v, points=g.points, edges=g.edges, entry=np.array(g.entry), vec_id=vec_id[order], row=row[order], first=np.searchsorted(point[order], np.arange(len(v) + 1)))
            write_file(f"{folder}/{now}.npz", [sink.getvalue()])
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32())], ["shard"])

    made = materialise(dealt.mapInArrow(index, struct("shard int")), "shards").count()  # before any search
    queries = stored.filter(F.col("vec_id") % every == 0)
    blocks = max(1, -(-queries.count() // BLOCK_ROWS))
    cut = queries.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")).repartition(min(blocks, parts), "block").sortWithinPartitions("block", "row")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for now, t in _runs(batches, "block"):
            sink = io.BytesIO()
            np.savez(sink, v=_matrix(t.column("v")), row=t.column("row").to_numpy(), vec_id=t.column("vec_id").to_numpy())
            write_file(f"{folder}/block-{now}.npz", [sink.getvalue()])
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32())], ["block"])

    asked = sorted(r.block for r in materialise(cut.mapInArrow(keep, struct("block int")), "blocks").collect()) if made else []  # a number a block, not its rows
    high = max(1, min(TILE_SHARDS, shards * len(asked) // (4 * parts)))
    wide = max(1, min(TILE_BLOCKS, shards * len(asked) // (4 * parts * high)))
    across = -(-len(asked) // wide)
    tiles = spark.range(0, -(-shards // high) * across, 1, max(1, min(4 * parts, -(-shards // high) * across)))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tile in b.column(0).to_pylist():
                s, x = tile // across * high, tile % across * wide
                best: dict[int, list[np.ndarray]] = {}
                for shard in range(s, min(s + high, shards)):
                    if not (graph := _graph(f"{folder}/{shard}.npz")):
                        continue
                    for block in asked[x : x + wide]:
                        z = np.load(io.BytesIO(read_file(f"{folder}/block-{block}.npz")))
                        for a in range(0, len(z["row"]), 256):
                            new = _hits(graph, z["v"][a : a + 256], z["row"][a : a + 256], z["vec_id"][a : a + 256], k, width, beam)
                            held = best.get(a << 32 | block)
                            best[a << 32 | block] = _top(new if held is None else [np.concatenate(c) for c in zip(held, new)], k)
                for cols in best.values():
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["own", "query_id", "vec_id", "score", "row"])

    hits = tiles.mapInArrow(ask, struct("own long, query_id long, vec_id long, score double, row long"))
    first = Window.partitionBy("own").orderBy(F.desc("score"), "vec_id", "row")
    return hits.withColumn("rank", F.row_number().over(first).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _graph(uri: str) -> tuple | None:
    """Graph, vectors, ids, rows, and where each point's rows begin; None for a shard that got no rows."""
    fs, path = filesystem(uri)
    if not fs.get_file_info(path).is_file:
        return None
    z = np.load(io.BytesIO(read_file(uri)))
    return Graph(z["points"], z["edges"], int(z["entry"])), z["vectors"], z["vec_id"], z["row"], z["first"]


def _hits(graph: tuple, q: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, width: int, beam: int) -> list[np.ndarray]:
    """own, query_id, vec_id, score, row of what one shard has for some queries."""
    g, vectors, vec_id, row, first = graph
    found, score = nearest(g, vectors, q, min(width, len(vectors)), beam)
    r, c = np.nonzero(found >= 0)
    point = found[r, c]
    n = np.minimum(first[point + 1] - first[point], k + 1)
    r, value = np.repeat(r, n), np.repeat(score[r, c], n)
    m = np.repeat(first[point] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    ok = row[m] != own[r]
    r, m, value = r[ok], m[ok], value[ok]
    return [own[r], ids[r], vec_id[m], value, row[m]]


def _top(cols: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The best k of each query."""
    own, _, vec_id, score, row = cols
    order = np.lexsort((row, vec_id, -score, own))
    start = np.flatnonzero(np.diff(own[order], prepend=own[order][:1] - 1))
    place = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return [c[order[place < k]] for c in cols]


def op5_pruned_graph(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
