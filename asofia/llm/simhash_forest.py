"""8. Near duplicates by SimHash and an LSH forest over permuted bits.

Fingerprint: BITS bits over the set of a text's words (lower case, outer punctuation off), each word one vote a bit.
Two texts are linked if their fingerprints differ in at most DISTANCE bits and neither has fewer than half the other's
distinct words; texts of fewer than MIN_WORDS distinct words only equal their exact copies. Classes are the connected
components of links and copies, named by their smallest doc_id.

Forest: each trie holds the fingerprints in an order of bits of its own. How deep a fingerprint stands follows the
density around it, fingerprint by fingerprint: from the deepest prefix it climbs to shorter ones as long as that is the
cheaper way to the target recall. A prefix of depth d needs tries(d) tries until a pair at DISTANCE bits shares one with
probability RECALL; each costs a row to send (ROW comparisons' worth) and comparisons with all that share the prefix
there, of which the counts in the first PROBES tries, taken over all fingerprints, tell how many they are. A pair meets
at the shorter of its two prefixes, in all tries of that depth, so its recall is RECALL whatever the number of rows or
their density, and it is the same code from two rows up. What meets is verified on all bits; a pair is counted in the
first trie in which it meets.

Scale: exact copies collapse by text hash and equal fingerprints by value, both pre-aggregated, before anything is
compared, so a group of copies of any size is one row. A node of more than BLOCK rows is cut into blocks and each pair
of blocks is a group of its own, so no node is gathered in one task and none of its pairs is skipped; such nodes, at most
MANY a trie, are sent around by broadcast. Counts for the depths are arrays of a fixed size. Fingerprints are sent
packed, to as many partitions as keep PART rows each. Groups emit per fingerprint a count and the root of its component
within the partition, not pairs. Components are then joined by alternating large and small stars, a table in the shared
folder after each round, hot roots around the join. Joins that bring classes back to rows send hot keys around by
broadcast, at most 1 / HOT_SHARE of them.

Tries grow with the number n of different fingerprints as the method has it (about n to the power 0.34), comparisons
with the density: within a group of texts that are all near each other every pair is a link and has to be counted.

Null texts are empty. Rows that repeat a doc_id are rows of their own. A null doc_id never names a class unless all of
the class' are null. An empty table gives no rows. Extra columns, whatever their names, are passed through by
drop_near_duplicates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofia.llm.common import append_columns, left_join_hot, materialise, mix64, n_partitions, struct, table, with_plain_names

BITS = 256
DISTANCE = 54
MIN_WORDS = 5
RECALL = 0.99
#: Depths that a prefix may have, and by how many bits it gets longer where it is dense.
DEPTHS, STEP = tuple(range(2, 25, 2)), 4
#: What it costs to send a fingerprint, in comparisons; tries whose nodes are counted for the depths; slots of a depth's counts.
ROW, PROBES, SLOTS = 2000, 4, 1 << 16
#: Rows of a node before it is cut into blocks; nodes that may be cut, in a trie; rows of a partition.
BLOCK, MANY, PART = 4096, 8192, 1_000_000
#: Rows that a task packs at a time.
SENT = 800_000
_STRIP = ".,;:!?*$%&#|<>()[]{}\"'`~^_+=/\\-"
_ROW = "_asofia_row"


def words(text: str) -> set[str]:
    found = {w.strip(_STRIP) for w in set(text.lower().split())}
    found.discard("")
    return found


def fingerprint(found: set[str]) -> bytes:
    if not found:
        return bytes(BITS // 8)
    votes, n = np.zeros(BITS, np.float64), len(found)
    digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(w.encode("utf-8", "surrogatepass")) for w in found]), "<u8").reshape(-1, 2)
    hashes = np.concatenate([digests, mix64(digests + np.uint64(0x9E3779B97F4A7C15))], axis=1)
    for k in range(0, n, 8192):
        bits = np.unpackbits(hashes[k : k + 8192].view(np.uint8), axis=1)
        votes += np.ones(len(bits), np.float32) @ bits.astype(np.float32)
    return np.packbits(2 * votes > n).tobytes()


@dataclass(frozen=True)
class Forest:
    """What counts as a link, how surely it is found, and what sending a fingerprint costs in comparisons."""

    distance: int = DISTANCE
    recall: float = RECALL
    row: int = ROW
    block: int = BLOCK

    def tries(self, depth: int) -> int:
        """How many tries find a pair at that distance with that probability, by prefixes of that depth."""
        hit = math.prod((BITS - self.distance - i) / (BITS - i) for i in range(depth))  # an order's bits are drawn without repeats
        return math.ceil(math.log(1 - self.recall) / math.log(1 - hit)) if hit < self.recall else 1

    def climbed(self, near: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        """For prefixes of DEPTHS[first] bits or STEP, 2 * STEP ... more: which depth each fingerprint climbs to, and what that costs."""
        ladder = rungs(first)
        tries = [self.tries(DEPTHS[i]) for i in ladder]
        rows = np.cumsum(tries)  # it is met by others at the shorter ones too
        costs = np.stack([self.row * float(r) + t * near[:, i] for i, t, r in zip(ladder, tries, rows)], axis=1)
        best = costs.argmin(axis=1)
        return np.array(ladder)[best], costs[np.arange(len(near)), best]


def permutations(n: int, depth: int) -> np.ndarray:
    """The first depth bits of the first n tries' orders: a longer prefix of a trie begins with its shorter one."""
    rng = np.random.default_rng(11)
    return np.stack([rng.permutation(BITS)[:depth] for _ in range(n)])


def prefixes(prints: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Fingerprints (rows of bytes) by trie: the prefix as a number."""
    bits = np.unpackbits(prints, axis=1).T.astype(np.int64)
    out = np.zeros((len(orders), len(prints)), np.int64)
    for d in range(orders.shape[1]):
        out <<= 1
        out |= bits[orders[:, d]]
    return out.T


def node_ids(prints: np.ndarray) -> np.ndarray:
    """A number for each fingerprint."""
    h = np.full(len(prints), 0x51ED270B9F3A6C15, np.uint64)
    for w in np.ascontiguousarray(prints).view(np.uint64).T:
        h = mix64(h * np.uint64(0x9FB21C651E98DF25) + w)
    return h.view(np.int64)


def _slot(prefix: np.ndarray, depth: int) -> np.ndarray:
    if 1 << depth <= SLOTS:
        return prefix
    return (mix64(prefix.astype(np.uint64)) % np.uint64(SLOTS)).astype(np.int64)


def _offsets() -> list[int]:
    """Where the counts of each probe and depth begin, probe after probe, and where they end."""
    return np.concatenate([[0], np.cumsum([min(1 << d, SLOTS) for _ in range(PROBES) for d in DEPTHS])]).tolist()


def density(nodes: DataFrame) -> np.ndarray:
    """How many fingerprints share each prefix of the first PROBES tries, at each depth; long prefixes share slots."""
    at = _offsets()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, total = permutations(PROBES, DEPTHS[-1]), np.zeros(at[-1], np.int64)
        for b in batches:
            whole = prefixes(_prints(b.column("_print")), orders)
            for k in range(PROBES * len(DEPTHS)):
                t, d = k // len(DEPTHS), DEPTHS[k % len(DEPTHS)]
                total[at[k] : at[k + 1]] += np.bincount(_slot(whole[:, t] >> (DEPTHS[-1] - d), d), minlength=at[k + 1] - at[k])
        chunks = [(k, zstandard.compress(c.tobytes(), 1)) for k in range(0, at[-1], SLOTS) if (c := total[k : k + SLOTS]).any()]
        if chunks:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in chunks], pa.int64()), pa.array([c for _, c in chunks], pa.binary())], ["chunk", "blob"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, blob in zip(b.column("chunk").to_pylist(), b.column("blob").to_pylist()):
                c = np.frombuffer(zstandard.decompress(blob), np.int64)
                sums[k] = sums[k] + c if k in sums else c
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([zstandard.compress(c.tobytes(), 1) for c in sums.values()], pa.binary())], ["chunk", "blob"])

    spec = struct("chunk long, blob binary")
    out = np.zeros(at[-1], np.int64)
    for r in nodes.select("_print").mapInArrow(count, spec).repartition(n_partitions(nodes.sparkSession), "chunk").mapInArrow(add, spec).collect():  # at[-1] numbers, however many rows
        c = np.frombuffer(zstandard.decompress(r.blob), np.int64)
        out[r.chunk : r.chunk + len(c)] = c
    return out


def neighbours(prints: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints by depth: how many others share the prefix, in the mean of the first PROBES tries."""
    at, orders = _offsets(), permutations(PROBES, DEPTHS[-1])
    whole = prefixes(prints, orders)
    out = np.zeros((len(prints), len(DEPTHS)), np.float64)
    for k in range(PROBES * len(DEPTHS)):
        i = k % len(DEPTHS)
        d = DEPTHS[i]
        here = counts[at[k] + _slot(whole[:, k // len(DEPTHS)] >> (DEPTHS[-1] - d), d)]
        out[:, i] += here if 1 << d <= SLOTS else np.maximum(here - n / SLOTS, 1)
    return out / PROBES


def rungs(first: int) -> list[int]:
    return [i for i, d in enumerate(DEPTHS) if i >= first and (d - DEPTHS[first]) % STEP == 0]


def signatures(docs: DataFrame, keep: list[str]) -> DataFrame:
    def start():
        def each(texts):
            found = [words(t) for t in texts]
            hashes = [xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in texts]
            prints = [fingerprint(f) for f in found]
            own = node_ids(np.frombuffer(b"".join(prints), np.uint8).reshape(-1, BITS // 8)).tolist()
            short = np.frombuffer(b"".join(hashes), np.int64)[::2].tolist()
            nodes = [a if len(f) >= MIN_WORDS else b for a, b, f in zip(own, short, found)]
            return [hashes, prints, [len(f) for f in found], nodes]

        return each

    return append_columns(docs, "text", keep, start, "_hash binary, _print binary, _words int, node long")


def _prints(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BITS // 8)


class Plan:
    """Depths in use, how many tries each has, and where each fingerprint stands."""

    def __init__(self, forest: Forest, counts: np.ndarray, n: int, first: int):
        self.forest, self.counts, self.n, self.first = forest, counts, n, first
        self.ladder = rungs(first)
        self._orders: np.ndarray | None = None

    def orders(self, i: int) -> np.ndarray:
        if self._orders is None:
            self._orders = permutations(self.forest.tries(DEPTHS[self.ladder[-1]]), DEPTHS[-1])
        return self._orders[: self.forest.tries(DEPTHS[i]), : DEPTHS[i]]

    def level(self, prints: np.ndarray) -> np.ndarray:
        return self.forest.climbed(neighbours(prints, self.counts, self.n), self.first)[0]

    def keys(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By depth: which fingerprints take part, whether they stand there (others stand deeper), and their nodes' keys, one column a trie."""
        level = self.level(prints)
        for i in self.ladder:
            which = np.flatnonzero(level >= i)
            if len(which):
                own = level[which] == i
                head = (i << 16 | np.arange(self.forest.tries(DEPTHS[i]))) << 24
                yield which, own, prefixes(prints[which], self.orders(i)) | head[None, :]


def make_plan(nodes: DataFrame, n: int, forest: Forest = Forest()) -> tuple[Plan, int]:
    """The plan whose shortest depth makes the whole table's cost least, and how many rows it sends."""
    counts = density(nodes)
    shared = nodes.sparkSession.sparkContext.broadcast(counts)

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(DEPTHS), 2), np.int64)
        for b in batches:
            near = neighbours(_prints(b.column("_print")), shared.value, n)
            for f in range(len(DEPTHS)):
                level, costs = forest.climbed(near, f)
                total[f] += int(costs.sum()), sum(int((level >= i).sum()) * forest.tries(DEPTHS[i]) for i in rungs(f))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(DEPTHS)), pa.int32()), pa.array(total[:, 0]), pa.array(total[:, 1])], ["first", "cost", "sent"])

    costs = nodes.select("_print").mapInArrow(cost, struct("first int, cost long, sent long")).groupBy("first").agg(F.sum("cost").alias("cost"), F.sum("sent").alias("sent")).collect()  # a row a depth
    best = min(costs, key=lambda r: (r.cost, r.first), default=None)
    return Plan(forest, counts, n, best.first if best else 0), best.sent if best else 0


class Links:
    """Verifies pairs of one partition's rows, counts each in its first trie only, and joins components."""

    def __init__(self, prints: np.ndarray, words: np.ndarray, weight: np.ndarray, keys: np.ndarray, plan: Plan):
        self.prints, self.words, self.weight, self.keys, self.plan = prints, words, weight, keys, plan
        self.wide = prints.view(np.uint64)
        self.nodes, self.of = np.unique(node_ids(prints), return_inverse=True)
        self.root = np.arange(len(self.nodes))
        self.links = np.zeros(len(self.nodes), np.int64)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.zeros(np.broadcast_shapes(x.shape, y.shape), np.uint16)
        for w in self.wide.T:
            out += np.bitwise_count(w[x] ^ w[y])
        return out

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        a, b = self.words[x], self.words[y]
        ok = (2 * np.minimum(a, b) >= np.maximum(a, b)) & (self.of[x] != self.of[y])
        if ok.any():
            self.held.append((x[ok], y[ok]))
            self.size += int(ok.sum())
            if self.size > 500_000:
                self.flush()

    def flush(self) -> None:
        if not self.size:
            return
        x, y = (np.concatenate(v) for v in zip(*self.held))
        self.held, self.size = [], 0
        for k in range(0, len(x), 50_000):
            self._count(x[k : k + 50_000], y[k : k + 50_000])
        a, b = self.of[x], self.of[y]
        while True:  # the smallest name spreads along links, and along what it has reached
            low = np.minimum(self.root[a], self.root[b])
            before = self.root.copy()
            for i in (a, b, before[a], before[b]):
                np.minimum.at(self.root, i, low)
            self.root = self.root[self.root]
            if (self.root == before).all():
                return

    def _count(self, x: np.ndarray, y: np.ndarray) -> None:
        depth, trie = self.keys[x] >> 40, self.keys[x] >> 24 & 0xFFFF
        differ = np.ascontiguousarray(np.unpackbits(self.prints[x] ^ self.prints[y], axis=1).T)
        new = np.ones(len(x), bool)
        for i in np.unique(depth).tolist():
            mine = depth == i
            for t, order in enumerate(self.plan.orders(i)[: int(trie[mine].max())]):
                new &= ~(mine & (trie > t)) | differ[order].any(axis=0)
        for p, q in ((x, y), (y, x)):
            self.links += np.bincount(self.of[p[new]], self.weight[q[new]], len(self.nodes)).astype(np.int64)

    def rows(self) -> pa.RecordBatch:
        self.flush()
        while (self.root[self.root] != self.root).any():
            self.root = self.root[self.root]
        touched = np.flatnonzero((self.root != np.arange(len(self.root))) | (self.links > 0))
        return pa.RecordBatch.from_arrays([pa.array(self.nodes[touched]), pa.array(self.nodes[self.root[touched]]), pa.array(self.links[touched])], ["node", "root", "links"])


_ENTRY = [("key", "<i8"), ("cut", "<u4"), ("words", "<i4"), ("weight", "<i8"), ("own", "<u1"), ("side", "<u1")]


def _pack(cols: dict[str, np.ndarray], prints: np.ndarray) -> bytes:
    small = b"".join(np.ascontiguousarray(cols[n] if n != "key" else np.diff(cols[n], prepend=0), k).view(np.uint8).reshape(-1, np.dtype(k).itemsize).T.tobytes() for n, k in _ENTRY)
    return np.uint32(len(prints)).tobytes() + prints.tobytes() + zstandard.compress(small, 1)


def _unpack(blobs: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    parts: dict[str, list[np.ndarray]] = {n: [] for n, _ in _ENTRY}
    prints = []
    for b in blobs:
        n = int(np.frombuffer(b, "<u4", 1)[0])
        prints.append(np.frombuffer(b, np.uint8, 32 * n, 4).reshape(n, 32))
        raw, at = np.frombuffer(zstandard.decompress(b[4 + 32 * n :]), np.uint8), 0
        for name, k in _ENTRY:
            w = np.dtype(k).itemsize
            x = np.ascontiguousarray(raw[at : at + n * w].reshape(w, n).T).view(k).reshape(n)
            parts[name].append(np.cumsum(x) if name == "key" else x)
            at += n * w
    return {n: np.concatenate(p) for n, p in parts.items()}, np.ascontiguousarray(np.concatenate(prints))


def _compare_group(links: Links, i: np.ndarray, own: np.ndarray, side: np.ndarray, two: bool) -> None:
    """i: a node's or a block's rows, or those of two blocks (side 0 and 1). A pair is compared here if either stands at this depth."""
    if two:
        a, b = i[side == 0], i[side == 1]
        for k in range(0, len(a), 128):
            x, y = np.nonzero(links.apart(a[k : k + 128, None], b[None, :]) <= links.plan.forest.distance)
            x, y = a[k + x], b[y]
            ok = own[x] | own[y]
            links.add(x[ok], y[ok])
        return
    i = i[np.argsort(~own[i], kind="stable")]
    n = int(own[i].sum())
    for k in range(0, n, 128):
        end = min(k + 128, n)
        x, y = np.nonzero(links.apart(i[k:end, None], i[None, k:]) <= links.plan.forest.distance)
        ok = y > x
        links.add(i[k + x[ok]], i[k + y[ok]])


def compare(c: dict[str, np.ndarray], prints: np.ndarray, plan: Plan) -> pa.RecordBatch:
    """node, root, links of a partition's rows that have any link there."""
    order = np.lexsort((c["cut"], c["key"]))
    c, prints = {n: x[order] for n, x in c.items()}, prints[order]
    links = Links(prints, c["words"], c["weight"].astype(np.float64), c["key"], plan)
    own, side = c["own"].astype(bool), c["side"].astype(bool)
    two = (c["cut"] - 1 >> 16 != (c["cut"] - 1 & 0xFFFF)) & (c["cut"] > 0)
    new = np.ones(len(order), bool)
    new[1:] = (c["key"][1:] != c["key"][:-1]) | (c["cut"][1:] != c["cut"][:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(order)))
    few = 16
    left = (np.repeat(start + size, size) - np.arange(len(order))) * np.repeat(size <= few, size)  # rows of a small node from here on
    for k in range(1, few):  # small nodes all at once
        x = np.flatnonzero(left > k)
        x = x[(own[x] | own[x + k]) & ((side[x] != side[x + k]) | ~two[x])]
        near = links.apart(x, x + k) <= plan.forest.distance
        links.add(x[near], x[near] + k)
    for s, n in zip(start[size > few].tolist(), size[size > few].tolist()):
        _compare_group(links, np.arange(s, s + n), own, side[s : s + n], bool(two[s]))
    return links.rows()


def _compare(nodes: DataFrame, n: int, forest: Forest = Forest()) -> DataFrame:
    """node, root, links from all partitions."""
    spark = nodes.sparkSession
    plan, sent = make_plan(nodes, n, forest)
    parts = max(n_partitions(spark), -(-sent // PART))
    shared = spark.sparkContext.broadcast(plan)
    rows = nodes.select("_print", "_words", "weight")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, keys in shared.value.keys(_prints(b.column("_print"))):
                k, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], ["key", "n"])

    least = max(forest.block, n // MANY)
    dense = materialise(rows.mapInArrow(sizes, struct("key long, n long")).groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") > least), "dense").orderBy("key").collect()  # at most MANY a trie
    many = spark.sparkContext.broadcast((np.array([r.key for r in dense], np.int64), np.array([min(-(-r.n // forest.block), 60_000) for r in dense], np.int64)))
    step = max(256, SENT * n // max(sent, 1))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, blocks = many.value
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            b = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            prints, words, weight = _prints(b.column("_print")), b.column("_words").to_numpy(), b.column("weight").to_numpy()
            ids = node_ids(prints).view(np.uint64)
            for which, own, keys in shared.value.keys(prints):
                t = keys.shape[1]
                row, key, own = np.repeat(which, t), keys.ravel(), np.repeat(own, t)
                n = np.ones(len(key), np.int64)
                if len(hot):
                    place = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                    n = np.where(hot[place] == key, blocks[place], 1)
                ends = np.flatnonzero(np.diff(np.cumsum(n) // SENT, append=-1))
                for lo, hi in zip([0, *(ends[:-1] + 1).tolist()], (ends + 1).tolist()):
                    yield from pack(prints, words, weight, ids, row[lo:hi], key[lo:hi], own[lo:hi], n[lo:hi])

        def pack(prints, words, weight, ids, row, key, own, n) -> Iterator[pa.RecordBatch]:
            block = (mix64(ids[row] ^ key.astype(np.uint64)) % n.astype(np.uint64)).astype(np.int64)
            other = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            row, key, own, block, n = (np.repeat(x, n) for x in (row, key, own, block, n))
            low, high = np.minimum(block, other), np.maximum(block, other)
            cut = np.where(n > 1, (low << 16 | high) + 1, 0)
            side = ((low != high) & (block == high)).astype(np.uint8)
            part = (mix64(key.astype(np.uint64) ^ mix64(cut.astype(np.uint64) + np.uint64(1))) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((key, part))
            ends = np.searchsorted(part[order], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(ends)).tolist():
                i = order[ends[p] : ends[p + 1]]
                r = row[i]
                blob = _pack({"key": key[i], "cut": cut[i], "words": words[r], "weight": weight[r], "own": own[i], "side": side[i]}, prints[r])
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([blob], pa.binary())], ["part", "blob"])

        for b in batches:
            for k in range(0, b.num_rows, step):
                held.append(b.slice(k, step))
                if sum(x.num_rows for x in held) >= step:
                    yield from flush()
        if held:
            yield from flush()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [x for b in batches for x in b.column("blob").to_pylist()]
        if blobs:
            yield compare(*_unpack(blobs), shared.value)

    return rows.mapInArrow(spread, struct("part int, blob binary")).repartitionById(parts, F.col("part")).mapInArrow(run, struct("node long, root long, links long"))


def components(edges: DataFrame, tag: str = "stars") -> DataFrame:
    """(node, root) from edges (node, root), root the smallest of the component; one row a node that isn't its own root."""
    def both(e: DataFrame) -> DataFrame:
        return e.unionByName(e.select(F.col("root").alias("node"), F.col("node").alias("root")))

    def large(e: DataFrame, rows: int) -> DataFrame:
        around = both(e)
        least = around.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("m"), F.count(F.lit(1)).alias("n"))
        return left_join_hot(around, least, "node", "n", 2 * rows).filter("root > node").select(F.col("root").alias("node"), F.col("m").alias("root"))

    def small(e: DataFrame, rows: int) -> DataFrame:
        least = e.groupBy("node").agg(F.min("root").alias("m"), F.count(F.lit(1)).alias("n"))
        near = left_join_hot(e, least, "node", "n", 2 * rows).filter("root <> m").select(F.col("root").alias("node"), F.col("m").alias("root"))
        return near.unionByName(least.select("node", F.col("m").alias("root")))

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(node, root))")).first())

    e = materialise(edges.filter("node <> root").select(F.greatest("node", "root").alias("node"), F.least("node", "root").alias("root")).distinct(), tag)
    seen = mark(e)
    while seen[0]:
        e = materialise(small(large(e, seen[0]).filter("node <> root").distinct(), seen[0]).distinct(), tag)
        now = mark(e)
        if now == seen:
            break
        seen = now
    return e


def classify(signed: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """For a stored table with doc_id, _asofia_row, _hash, _print, _words, node: _asofia_row, doc_id, class_id, n_links, class_size, first (the row that stands for the class)."""
    spark = signed.sparkSession
    own = signed.select(_ROW, F.col("doc_id").cast("long").alias("doc_id"), "_hash", "_print", "_words", "node")
    texts = own.groupBy("_hash").agg(F.first("node").alias("node"), F.first("_print").alias("_print"), F.first("_words").alias("_words"), F.count(F.lit(1)).alias("copies"))
    nodes = materialise(texts.groupBy("node").agg(F.first("_print").alias("_print"), F.min("_words").alias("_words"), F.count(F.lit(1)).alias("weight"), F.sum("copies").alias("docs")), "prints")
    compared = nodes.filter(F.col("_words") >= MIN_WORDS)
    n, total = compared.count(), signed.count()
    found = materialise(_compare(compared, n, forest), "linked")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    stars = components(found.select("node", "root"))
    known = nodes.join(links, "node", "left").join(stars, "node", "left").filter("weight > 1 OR links IS NOT NULL")
    known = known.select("node", "docs", F.coalesce("root", "node").alias("_root"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("_links"))
    placed = left_join_hot(own.select(_ROW, "doc_id", "node"), known, "node", "docs", total)
    placed = materialise(placed.select(_ROW, "doc_id", F.coalesce("_root", "node").alias("comp"), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links")), "placed")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", _ROW))
    groups = placed.groupBy("comp").agg(least.alias("least"), F.count(F.lit(1)).alias("class_size")).filter("class_size > 1")
    groups = groups.select("comp", F.col("least.doc_id").alias("class_id"), F.col(f"least.{_ROW}").alias("first"), "class_size", F.col("class_size").alias("rows"))
    done = left_join_hot(placed, groups, "comp", "rows", total)
    return done.select(_ROW, "doc_id", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "n_links", F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), F.coalesce("first", F.col(_ROW)).alias("first"))


def near_duplicates(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """doc_id, class_id, n_links (different texts that its own is linked to), class_size, is_first, one row a document."""
    signed = materialise(signatures(docs.select("doc_id", "text").withColumn(_ROW, F.monotonically_increasing_id()), ["doc_id", _ROW]), "signed")
    return classify(signed, forest).select("doc_id", "class_id", "n_links", "class_size", (F.col("first") == F.col(_ROW)).alias("is_first"))


def drop_near_duplicates(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """docs, one row of each class: the one of the smallest doc_id, of several the first as read."""
    return with_plain_names(docs, lambda d: _drop(d, forest))


def _drop(docs: DataFrame, forest: Forest) -> DataFrame:
    marked = docs.withColumn(_ROW, F.monotonically_increasing_id()).withColumn("_text_kept", F.col("text"))
    signed = materialise(signatures(marked, [*(c for c in docs.columns if c != "text"), "_text_kept", _ROW]), "signed")
    drop = classify(signed, forest).filter(F.col("first") != F.col(_ROW)).select(_ROW)
    return signed.join(drop, _ROW, "left_anti").withColumnRenamed("_text_kept", "text").select(*docs.columns)


def op8_simhash_forest(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
