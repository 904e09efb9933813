"""Approximate nearest neighbours by a forest of random-projection trees.

Every tree splits space by hyperplanes halfway between two random points of a bounded sample, down to small leaves; all
vectors are sent to their leaf of every tree. A query looks through all trees with one priority queue, ordered by the
margin of the worst hyperplane on the way, and takes leaves until they promise enough candidates; how many are enough
is measured on the table itself, against brute force. The vectors of these leaves are ranked again exactly, in double
precision: queries with the numbers of their leaves meet blocks of vectors, each vector once whatever its leaves, and
leave with the best of a block.
"""

from __future__ import annotations

import heapq
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenledger.llm.common import drop_saved, release_memory, saved
from evenledger.llm.vectors import HELD, classes, matrix, met, runs, usable

#: CANDIDATES is the least budget of a search; the audit widens it.
TREES, LEAF, CANDIDATES = 12, 64, 3000
#: The mean recall asked for, and the query points that are audited against brute force (picked by hash of the id). The
#: mean must lie DEVIATIONS of its standard errors above the bound, since other queries than these are answered.
RECALL, AUDIT, DEVIATIONS = 0.9, 600, 4
#: Vectors that hyperplanes are drawn from (picked by hash of the id), whatever the table's size.
SAMPLE = 32_768
ROWS_AT_ONCE, MORE_AT_ONCE, PAIRS_AT_ONCE = 256, 2048, 65_536
#: Vectors and queries that meet in a task, the least number of blocks, and the vectors moved at once at least.
BLOCK_ROWS, BLOCK_QUERIES, LEAST_BLOCKS, MOVED = 65_536, 32_768, 6, 1_000_000
#: How far a cosine in single precision may lie from the exact one.
ROUNDING = np.float32(1e-5)


class ByLeaf:
    """Which rows lie in each leaf, given the leaves of each row."""

    def __init__(self, leaves: np.ndarray, n: int):
        flat = leaves.ravel()
        self.rows = (np.argsort(flat, kind="stable") // max(1, leaves.shape[1])).astype(np.int32)
        self.ends = np.concatenate(([0], np.cumsum(np.bincount(flat, minlength=n))))

    def of(self, leaf: int) -> np.ndarray:
        return self.rows[self.ends[leaf] : self.ends[leaf + 1]]


class Forest:
    """Hyperplanes of all trees; children below zero are leaves (-1 - number)."""

    def __init__(self, sample: np.ndarray, points: np.ndarray, seed: int = 3):
        self.normals: list[np.ndarray] = []
        self.shifts: list[float] = []
        self.children: list[list[int]] = []
        self.sizes: list[int] = []
        rng = np.random.default_rng(seed)
        self.roots = [self._grow(sample, np.arange(len(sample)), rng) for _ in range(TREES)]
        self.normals = np.array(self.normals) if self.normals else np.zeros((0, sample.shape[1]))
        self.shifts, self.sizes = np.array(self.shifts), np.array(self.sizes)
        self.branches = np.array(self.children, dtype=np.int64).reshape(-1, 2)
        self.sample, self.once = sample, np.zeros(len(sample), dtype=bool)
        self.once[np.unique(points, return_index=True)[1]] = True
        parts = [self.leaves(sample[at : at + ROWS_AT_ONCE]) for at in range(0, len(sample), ROWS_AT_ONCE)]
        self.by_leaf = ByLeaf(np.concatenate(parts) if parts else np.zeros((0, TREES), np.int64), len(self.sizes))

    def _leaf(self, n: int) -> int:
        self.sizes.append(n)
        return -len(self.sizes)

    def _grow(self, sample, own, rng, depth: int = 0) -> int:
        if len(own) <= LEAF or depth > 40:
            return self._leaf(len(own))
        for _ in range(5):
            a, b = sample[rng.choice(own, 2, replace=False)]
            normal = a - b
            size = np.linalg.norm(normal)
            if size > 0:
                normal, shift = normal / size, -float(normal @ (a + b)) / 2 / size
                side = sample[own] @ normal + shift > 0
                if 0.05 < side.mean() < 0.95:
                    break
        else:
            return self._leaf(len(own))
        node = len(self.shifts)
        self.normals.append(normal)
        self.shifts.append(shift)
        self.children.append([0, 0])
        self.children[node] = [self._grow(sample, own[~side], rng, depth + 1), self._grow(sample, own[side], rng, depth + 1)]
        return node

    def leaves(self, v: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree."""
        out = np.empty((len(v), TREES), dtype=np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(v), root)
            go = np.flatnonzero(at >= 0)
            while len(go):
                node = at[go]
                side = np.einsum("ij,ij->i", v[go], self.normals[node]) + self.shifts[node] > 0
                at[go] = self.branches[node, side.astype(np.int64)]
                go = go[at[go] >= 0]
            out[:, t] = -1 - at
        return out

    def walk(self, margins: np.ndarray):
        """(leaf, sample vectors of the leaves before it) of one query, best first over all trees."""
        queue = [(-np.inf, root) for root in self.roots]
        heapq.heapify(queue)
        held = 0
        while queue:
            worst, node = heapq.heappop(queue)
            while node >= 0:
                margin = margins[node]
                near = int(margin > 0)
                heapq.heappush(queue, (max(worst, abs(margin)), self.children[node][1 - near]))
                node = self.children[node][near]
            yield -1 - node, held
            held += int(self.sizes[-1 - node])

    def search(self, margins: np.ndarray, budget: int) -> list[int]:
        """Leaves of one query until they hold ``budget`` sample vectors' share."""
        out = []
        for leaf, held in self.walk(margins):
            if held >= budget:
                break
            out.append(leaf)
        return out

    def reached(self, margins: np.ndarray, leaves: np.ndarray) -> list[int]:
        """For each vector, given by its leaf of every tree, the sample vectors that are held before the first of them is taken."""
        wanted: dict[int, list[int]] = {}
        for i, own in enumerate(leaves):
            for leaf in own:
                wanted.setdefault(int(leaf), []).append(i)
        out = [-1] * len(leaves)
        left = len(leaves)
        for leaf, held in self.walk(margins):
            for i in wanted.get(leaf, ()):
                if out[i] < 0:
                    out[i], left = held, left - 1
            if not left:
                break
        return out

    def bar(self, q: np.ndarray, leaves: list[int], k: int) -> float:
        """The score of the k-th best sample vector in these leaves, which k points of the table reach; no bar if there are fewer."""
        there = np.zeros(len(self.sample), dtype=bool)
        there[np.concatenate([self.by_leaf.of(leaf) for leaf in leaves])] = True
        there &= self.once
        if there.sum() < k:
            return -np.inf
        score = self.sample[there] @ q
        return float(np.partition(score, len(score) - k)[len(score) - k])


def pieces(batches, size: int = ROWS_AT_ONCE):
    """The same rows, few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def leaf_batches(batches, forest):
    """The same rows with their leaves."""
    release_memory()
    forest = forest.value
    for batch in pieces(batches, MORE_AT_ONCE):
        leaves = forest.leaves(matrix(batch.column("v"))).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("point"), batch.column("v"), pa.array(list(leaves), pa.list_(pa.int32()))], names=["block", "point", "v", "leaves"])


def exact_batches(batches, asked, k: int):
    """(query point, point, score, v): the k best of all rows of a task for each audited query, and never the query itself."""
    points, q = asked.value
    none = np.zeros(0)
    best = [(none, none.astype(np.int64), np.zeros((0, q.shape[1])))] * len(points)
    bars = np.full(len(points), -np.inf)
    for batch in pieces(batches, MORE_AT_ONCE):
        v, own = matrix(batch.column("v")), np.asarray(batch.column("point"))
        scores = q @ v.T
        high = scores >= bars[:, None]
        for i in np.flatnonzero(high.any(axis=1)):
            there = high[i] & (own != points[i])
            score, ids, rows = (np.concatenate(x) for x in zip(best[i], (scores[i][there], own[there], v[there])))
            top = np.lexsort((ids, -score))[:k]
            best[i] = score[top], ids[top], rows[top]
            if len(top) == k:
                bars[i] = score[top[-1]]
    for point, (score, ids, rows) in zip(points, best):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(ids), point)), pa.array(ids), pa.array(score), pa.array(list(rows), pa.list_(pa.float64()))], names=["query", "point", "score", "v"]
        )


def reach_batches(batches, forest):
    """(held array<long>): what a search of each audited query must hold before it takes each of its neighbours."""
    forest = forest.value
    for batch in batches:
        held = []
        for q, near in zip(batch.column("v"), batch.column("near")):
            leaves = np.concatenate([forest.leaves(matrix(near.values.slice(at, ROWS_AT_ONCE))) for at in range(0, len(near.values), ROWS_AT_ONCE)])
            held.append(forest.reached(forest.normals @ np.asarray(q.values) + forest.shifts, leaves))
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.int64()))], names=["held"])


def least_budget(held: list[list[int]]) -> int:
    """The smallest budget whose mean recall on the audited queries is RECALL, with the margin; CANDIDATES at least."""
    if not held:
        return CANDIDATES
    owner = np.repeat(np.arange(len(held)), [len(h) for h in held])
    flat = np.concatenate(held)
    order = np.argsort(flat, kind="stable")
    hits, share = np.zeros(len(held)), 1 / np.array([len(h) for h in held])
    for at, i in enumerate(order):
        hits[owner[i]] += share[owner[i]]
        last = at + 1 == len(order) or flat[order[at + 1]] > flat[i]
        if last and hits.mean() - DEVIATIONS * hits.std() / len(hits) ** 0.5 >= RECALL:
            return max(CANDIDATES, int(flat[i]) + 1)
    return max(CANDIDATES, int(flat.max()) + 1)


def audited(points: DataFrame, asking: DataFrame, forest, k: int) -> int:
    """The budget for these queries: the nearest points of some of them are found by brute force, in blocks of the whole table."""
    spark = points.sparkSession
    some = asking.orderBy(F.xxhash64("point", F.lit(2)), "point").limit(AUDIT).toArrow().combine_chunks()
    if not some.num_rows:
        return CANDIDATES
    asked = spark.sparkContext.broadcast((np.asarray(some.column("point")), matrix(some.column("v").combine_chunks())))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    near = points.select("point", "v").mapInArrow(partial(exact_batches, asked=asked, k=k), "query long, point long, score double, v array<double>")
    near = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).groupBy("query").agg(F.collect_list("v").alias("near"))
    rows = asking.join(near.withColumnRenamed("query", "point"), "point").select("v", "near")
    return least_budget([r.held for r in rows.mapInArrow(partial(reach_batches, forest=forest), "held array<long>").collect()])


def route_batches(batches, forest, budget: int, k: int):
    """Each query with the leaves it takes, as bytes, and a score that k of their vectors reach."""
    release_memory()
    forest = forest.value
    for batch in pieces(batches):
        v = matrix(batch.column("v"))
        margins = v @ forest.normals.T + forest.shifts
        found = [forest.search(row, budget) for row in margins]
        bars = [forest.bar(q, leaves, k) for q, leaves in zip(v, found)]
        steps = [np.diff(np.sort(leaves), prepend=0).astype(np.int32).tobytes() for leaves in found]
        yield pa.RecordBatch.from_arrays([batch.column("point"), batch.column("v"), pa.array(steps, pa.binary()), pa.array(bars, pa.float64())], names=["point", "v", "taken", "bar"])


class Members:
    """A block of vectors by their leaves."""

    def __init__(self, rows: list[pa.RecordBatch]):
        self.points = np.concatenate([np.asarray(x.column("point")) for x in rows])
        self.v = np.concatenate([matrix(x.column("v")) for x in rows])
        leaves = np.concatenate([np.asarray(x.column("leaves").flatten()) for x in rows]).reshape(len(self.v), -1)
        self.leaves = int(leaves.max()) + 1
        self.by_leaf = ByLeaf(leaves, self.leaves)
        length = np.linalg.norm(self.v, axis=1, keepdims=True)
        self.unit, self.shrink = (self.v / length).astype(np.float32), (1 / length[:, 0])

    def best(self, rows: pa.RecordBatch, k: int) -> pa.RecordBatch:
        """(query point, point, score): the k best of the block for each query, among the vectors of the leaves it takes."""
        asked, q, bar = np.asarray(rows.column("point")), matrix(rows.column("v")), np.asarray(rows.column("bar"))
        length = np.linalg.norm(q, axis=1, keepdims=True)
        unit, least = (q / length).astype(np.float32), bar / length[:, 0]
        taken = [np.cumsum(np.frombuffer(x.as_buffer(), dtype=np.int32)) for x in rows.column("taken")]
        visits = ByVisit(taken, self.leaves)
        pairs = [np.zeros(0, np.int64)]
        for leaf in range(self.leaves):
            queries, own = visits.of(leaf), self.by_leaf.of(leaf)
            if len(queries) and len(own):
                low = unit[queries] @ self.unit[own].T + ROUNDING < least[queries, None] * self.shrink[own]
                i, j = np.nonzero(~low)
                pairs.append(queries[i].astype(np.int64) * len(self.points) + own[j])
        i, j = np.divmod(np.unique(np.concatenate(pairs)), len(self.points))
        parts = [slice(at, at + PAIRS_AT_ONCE) for at in range(0, len(i), PAIRS_AT_ONCE)]
        score = np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", self.v[j[x]], q[i[x]]) for x in parts)])
        order = np.lexsort((-score, self.points[j], i))  # of vectors that share a point the nearest counts
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(i[order]) != 0) | (np.diff(self.points[j[order]]) != 0)
        order = order[new]
        order = order[np.lexsort((self.points[j[order]], -score[order], i[order]))]
        owner = i[order]
        top = order[np.arange(len(owner)) - np.searchsorted(owner, owner) < k]
        return pa.RecordBatch.from_arrays([pa.array(asked[i[top]]), pa.array(self.points[j[top]]), pa.array(score[top])], names=["query", "point", "score"])


class ByVisit(ByLeaf):
    """Which queries take each leaf, given the leaves of each; those from ``n`` on are none of the block's."""

    def __init__(self, taken: list[np.ndarray], n: int):
        owner = np.repeat(np.arange(len(taken), dtype=np.int32), [len(x) for x in taken])
        flat = np.concatenate(taken)
        owner, flat = owner[flat < n], flat[flat < n]
        self.rows = owner[np.argsort(flat, kind="stable")]
        self.ends = np.concatenate(([0], np.cumsum(np.bincount(flat, minlength=n))))


def rank_batches(batches, k: int):
    """(query point, point, score): the k best of a block of vectors for each query. A task holds one block at a time."""
    release_memory()
    now, held, block = None, [], None
    for key, side, rows in runs(batches, ("block", "part")):
        if key != now:
            now, held, block = key, [], None
        if side == HELD:
            held.append(rows)
            continue
        if held:
            block, held = Members(held), []
        if block is not None:
            yield block.best(rows, k)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best points of each query, a point with its highest score."""
    found = found.repartition("query").groupBy("query", "point").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).drop("place")


def ranked(points: DataFrame, routed: DataFrame, forest, k: int) -> DataFrame:
    """(query, point, score): the k best points in the leaves of each query, by some blocks of the table at a time."""
    n, asking = points.count(), routed.count()
    blocks, parts = max(LEAST_BLOCKS, -(-n // BLOCK_ROWS)), max(2, -(-asking // BLOCK_QUERIES))
    dealt = points.select(F.pmod(F.xxhash64("point"), F.lit(blocks)).cast("int").alias("block"), "point", "v")
    part = F.pmod(F.xxhash64("point", F.lit(1)), F.lit(parts)).cast("int").alias("part")
    at_once = max(1, max(5 * n // 4, MOVED) // max(1, -(-n // blocks) * parts + 3 * asking))
    found = None
    for first in range(0, blocks, at_once):
        last = min(blocks, first + at_once) - 1
        held = dealt.where(F.col("block").between(first, last)).mapInArrow(partial(leaf_batches, forest=forest), "block int, point long, v array<double>, leaves array<int>")
        held = held.withColumns({"part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))), "piece": F.lit(0)})
        asked = routed.select(part, "point", "v", "taken", "bar", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("block"))
        tasks = met(held, asked, ("block", "part"), 2 * (last - first + 1) * parts)
        more = tasks.mapInArrow(partial(rank_batches, k=k), "query long, point long, score double")
        before, found = found, saved(best_of(more if found is None else more.unionByName(found), k), "found")
        if before is not None:
            drop_saved(before)
    return found


def nearest(vectors: DataFrame, asked, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the largest inner product found for every row where ``asked`` holds.

    ``asked`` is a Column over ``vec_id``. A query is never its own neighbour. Ties go to the smaller vec_id. Null, empty
    and zero vectors, those with null or non-finite components and rows with a null id take no part. Vectors are
    searched among those of their own length, each length by a forest of its own. With fewer than k candidates all are
    returned, with none no row.

    Equal vectors are one point with its k + 1 smallest ids, so a vector that a third of the rows share stays small;
    queries are points too. The budget is widened until the audited queries have the asked recall, so a search may read
    much of a table whose vectors have no clusters.
    """
    rows = usable(vectors, key, vector).where("vec_id is not null")
    lengths = sorted(r.n for r in rows.select(F.size("v").alias("n")).distinct().collect())
    found = [_nearest(rows.where(F.size("v") == n), asked, k) for n in lengths or [0]]
    return reduce(DataFrame.unionByName, found)


def drawn_from(points: DataFrame, most: int) -> pa.Table:
    """The points with the smallest hashes. Where to stop is found on narrow rows, so that few vectors are sorted."""
    by_hash = (F.xxhash64("point"), F.col("point"))
    last = points.select("point").orderBy(*by_hash).limit(most).agg(F.max(by_hash[0])).first()[0]
    return points.where(by_hash[0] <= F.lit(last)).orderBy(*by_hash).limit(most).select("point", "v").toArrow().combine_chunks()


def _nearest(rows: DataFrame, asked, k: int) -> DataFrame:
    """``nearest`` over usable vectors of one length. Rows meet their class only where it has several."""
    spark = rows.sparkSession
    points = classes(rows).withColumnRenamed("rep", "point").withColumn("class", F.monotonically_increasing_id())
    points = saved(points, "points")
    alone, several = points.where("copies = 1").withColumn("vec_id", F.col("point")), points.where("copies > 1")
    queries, asking, ids = alone.where(asked).select("vec_id", "point"), alone.where(asked).select("point", "v"), alone.select("point", F.array("point").alias("ids"))
    if not several.isEmpty():
        owned = saved(rows.join(several.select("v", "point", "class"), "v").select("class", "point", "vec_id"), "owned")
        more = owned.where(asked).select("vec_id", "point")
        queries = queries.unionByName(more)
        asking = asking.unionByName(several.join(more.select("point").distinct(), "point").select("point", "v"))
        first = owned.withColumn("place", F.row_number().over(Window.partitionBy("class").orderBy("vec_id"))).where(F.col("place") <= k + 1)
        ids = ids.unionByName(first.groupBy("class", "point").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select("point", "ids"))
    queries, asking = saved(queries, "queries"), saved(asking, "asking")
    sample = drawn_from(points, SAMPLE)
    drawn = matrix(sample.column("v").combine_chunks()) if sample.num_rows else np.zeros((0, 1))
    forest = spark.sparkContext.broadcast(Forest(drawn, np.asarray(sample.column("point"))))
    budget = audited(points, asking, forest, k)
    routed = asking.repartition(spark.sparkContext.defaultParallelism).mapInArrow(partial(route_batches, forest=forest, budget=budget, k=k + 1), "point long, v array<double>, taken binary, bar double")
    routed = saved(routed, "routed")
    drop_saved(asking)
    found = ranked(points, routed, forest, k + 1)
    drop_saved(routed)
    spread = found.join(ids, "point").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    pairs = queries.select(F.col("vec_id").alias("query_id"), F.col("point").alias("query")).join(spread, "query").where("query_id <> vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
