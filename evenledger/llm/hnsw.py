"""Near-duplicate vectors by hierarchical navigable small-world graphs, one for each shard.

Vectors are dealt into shards of bounded size, and a graph of layers is built for each: a node's top layer is drawn
from its id, it is linked to diverse near nodes of every layer below. Every vector is searched in every shard, from the
top layer down. An audit plants queries just within the bound beside known nodes, and the beams of a block widen until
it passes. Where more than half of a beam is linked, as in a large group of near copies, the vector is compared with
the whole shard instead. Cosines are verified in double precision before a link counts, and a link that one end finds
counts at both.
"""

from __future__ import annotations

import pickle
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenledger.llm.common import drop_saved, release_memory, saved
from evenledger.llm.graph import components
from evenledger.llm.hashing import mix
from evenledger.llm.vectors import HELD, classes, matrix, met, runs, usable, usable_vector

SHARD_ROWS, LEAST_SHARDS, BLOCK_ROWS = 50_000, 6, 32_768
#: Nodes of a graph in one row, and how many vectors are dealt to shards at once, a vector counted for each shard.
PIECE_ROWS, MEETS = 2048, 2_000_000
LINKS, BASE_LINKS, BRIDGES, BUILD_BEAM, BEAM = 12, 24, 12, 48, 48
#: Planted queries of an audit, how far within the bound they lie, and the share that must find their node.
AUDITED, AUDIT_MARGIN, AUDIT_RECALL = 200, 0.002, 0.995
#: Vectors compared with a whole shard at once.
TOGETHER = 32
#: A block whose audit fails even with this beam is compared with the whole shard.
WIDEST = 1024


class Graph:
    """Layers of neighbour lists over unit vectors."""

    def __init__(self, ids: np.ndarray, unit: np.ndarray):
        self.ids, self.unit = ids, unit
        n = len(ids)
        draw = (mix(ids.astype(np.uint64) + np.uint64(99)) >> np.uint64(11)).astype(np.float64) / 2**53
        self.level = np.minimum((-np.log(np.maximum(draw, 1e-18)) / np.log(LINKS)).astype(np.int64), 8)
        self.near = [np.full((n, BASE_LINKS if k == 0 else LINKS), -1, dtype=np.int32) for k in range(int(self.level.max(initial=0)) + 1)]
        self.stamp = np.zeros(n, dtype=np.int64)
        self.clock = 0
        self.entry = -1
        for node in range(n):
            self._insert(node)
        for layer in range(len(self.near)):
            self.near[layer] = np.concatenate([self.near[layer], np.full((n, BRIDGES), -1, dtype=np.int32)], axis=1)
            if n:
                self._return_links(layer)
                self._bridge(layer)

    def _return_links(self, layer: int) -> None:
        """Nodes that pruning left with few links to them get one from each of their nearest neighbours."""
        near = self.near[layer]
        met = np.bincount(near[near >= 0], minlength=len(self.ids))
        for node in np.flatnonzero((self.level >= layer) & (met < 4)):
            for other in near[node, :4]:
                if other >= 0 and not (near[other] == node).any():
                    free = np.flatnonzero(near[other] < 0)
                    if len(free):
                        near[other, free[0]] = node

    def _bridge(self, layer: int) -> None:
        """Pruning may cut nodes off from the entry: each such island gets a link from the nearest node within reach."""
        reached = np.zeros(len(self.ids), dtype=bool)

        def spread(front):
            reached[front] = True
            while len(front):
                more = np.unique(self.near[layer][front])
                front = more[more >= 0]
                front = front[~reached[front]]
                reached[front] = True

        spread(np.array([self.entry]))
        for node in np.flatnonzero(self.level >= layer):
            if not reached[node]:
                found, score = self._beam(self.unit[node], np.array([self.entry]), layer, 4 * BUILD_BEAM)
                for at in found[np.argsort(-score)]:
                    free = np.flatnonzero(self.near[layer][at] < 0)
                    if len(free):
                        self.near[layer][at, free[0]] = node
                        break
                spread(np.array([node]))

    def _beam(self, q: np.ndarray, start: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, cosines) of the beam."""
        self.clock += 1
        near, unit, stamp = self.near[layer], self.unit, self.stamp
        found = np.unique(start)
        stamp[found] = self.clock
        score = unit[found] @ q
        fresh = np.ones(len(found), dtype=bool)
        while True:
            at = np.flatnonzero(fresh)
            if not len(at):
                return found, score
            if len(at) > 8:
                at = at[np.argpartition(-score[at], 8)[:8]]
            fresh[at] = False
            more = near[found[at]].ravel()
            more = more[more >= 0]
            more = np.unique(more[stamp[more] != self.clock])
            if not len(more):
                continue
            stamp[more] = self.clock
            gain = unit[more] @ q
            if len(found) >= width:
                good = gain > score.min()
                more, gain = more[good], gain[good]
            found, score, fresh = np.concatenate((found, more)), np.concatenate((score, gain)), np.concatenate((fresh, np.ones(len(more), bool)))
            if len(found) > width:
                top = np.argpartition(-score, width - 1)[:width]
                found, score, fresh = found[top], score[top], fresh[top]

    def _descend(self, q: np.ndarray, to: int) -> np.ndarray:
        at = np.array([self.entry])
        for layer in range(int(self.level[self.entry]), to, -1):
            found, score = self._beam(q, at, layer, 12)
            at = found[np.argsort(-score)[:4]]
        return at

    def _diverse(self, found: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
        """Near nodes that are nearer to the new one than to those taken before; filled up with the nearest."""
        order = found[np.argsort(-score, kind="stable")][: 3 * most]
        own = np.sort(-score)[: 3 * most] * -1
        between = self.unit[order] @ self.unit[order].T
        best, taken = np.full(len(order), -2.0), []
        for k in range(len(order)):
            if best[k] < own[k]:
                taken.append(k)
                if len(taken) == most:
                    break
                np.maximum(best, between[k], out=best)
        if len(taken) < most:
            chosen = set(taken)
            taken += [k for k in range(len(order)) if k not in chosen][: most - len(taken)]
        return order[taken]

    def _insert(self, node: int) -> None:
        if self.entry < 0:
            self.entry = node
            return
        q, top = self.unit[node], int(self.level[node])
        at = self._descend(q, min(top, int(self.level[self.entry])))
        for layer in range(min(top, int(self.level[self.entry])), -1, -1):
            found, score = self._beam(q, at, layer, BUILD_BEAM)
            near = self.near[layer]
            taken = self._diverse(found, score, near.shape[1] // 2)
            near[node, : len(taken)] = taken
            for other in taken:
                free = np.flatnonzero(near[other] < 0)
                if len(free):
                    near[other, free[0]] = node
                else:
                    old = np.append(near[other], node)
                    near[other] = -1
                    kept = self._diverse(old, self.unit[old] @ self.unit[other], near.shape[1])
                    near[other, : len(kept)] = kept
            at = found
        if top > self.level[self.entry]:
            self.entry = node

    def search(self, q: np.ndarray, width: int, least: float) -> np.ndarray | None:
        """Nodes whose cosine reaches ``least``, as far as the beam finds them; None if they fill more than half of it."""
        found, score = self._beam(q, self._descend(q, 0), 0, width)
        found = found[score >= least]
        return found if 2 * len(found) <= width else None


def unit_rows(v: np.ndarray) -> np.ndarray:
    scale = np.abs(v).max(axis=1, keepdims=True)
    v = v / scale
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def build(table: pa.Table) -> pa.Table:
    """The graph of one shard in pieces of ``PIECE_ROWS`` nodes, each a batch of its own."""
    release_memory()
    table = table.sort_by("id")
    shard, dim = table.column("shard")[0].as_py(), table.column("dim")[0].as_py()
    ids, copies = np.asarray(table.column("id")), np.asarray(table.column("copies"))
    v = matrix(table.column("v").combine_chunks())
    graph = Graph(ids, unit_rows(v).astype(np.float32))
    batches = []
    for piece, at in enumerate(range(0, len(ids), PIECE_ROWS)):
        own = slice(at, at + PIECE_ROWS)
        level = graph.level[own]
        packed = pickle.dumps({"level": level, "near": [near[own][level >= layer] for layer, near in enumerate(graph.near)], "entry": graph.entry})
        whole = pa.int32()
        batches.append(
            pa.RecordBatch.from_arrays(
                [pa.array([shard], whole), pa.array([dim], whole), pa.array([piece], whole), pa.array([ids[own]], pa.list_(pa.int64())), pa.array([copies[own]], pa.list_(pa.int64())), pa.array([v[own].tobytes()]), pa.array([packed])],
                names=["shard", "dim", "piece", "ids", "copies", "vectors", "graph"],
            )
        )
    return pa.Table.from_batches(batches)


def loaded(rows: list[pa.RecordBatch]) -> tuple[Graph, np.ndarray, np.ndarray]:
    """(graph, unit vectors, copies) of a shard from all its pieces."""

    def every(name):
        return [x for batch in rows for x in batch.column(name)]

    ids, copies = (np.concatenate([np.asarray(x.values) for x in every(c)]) for c in ("ids", "copies"))
    v = unit_rows(np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.float64) for x in every("vectors")]).reshape(len(ids), -1))
    packed = [pickle.loads(x.as_buffer()) for x in every("graph")]
    graph = Graph.__new__(Graph)
    graph.ids, graph.unit, graph.entry = ids, v.astype(np.float32), packed[0]["entry"]
    graph.level, graph.near = np.concatenate([x["level"] for x in packed]), []
    for layer, first in enumerate(packed[0]["near"]):
        near = np.full((len(ids), first.shape[1]), -1, dtype=np.int32)
        near[graph.level >= layer] = np.concatenate([x["near"][layer] for x in packed])
        graph.near.append(near)
    graph.stamp, graph.clock = np.zeros(len(ids), dtype=np.int64), 0
    return graph, v, copies


def planted(unit: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, queries): nodes spread over the shard, each with a query at the given cosine in a random direction."""
    nodes = np.unique(np.linspace(0, len(unit) - 1, min(AUDITED, len(unit))).astype(np.int64))
    base = unit[nodes].astype(np.float64)
    side = np.random.default_rng(17).normal(size=base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    length = np.linalg.norm(side, axis=1, keepdims=True)
    side = np.divide(side, length, out=np.zeros_like(side), where=length > 0)
    return nodes, (cosine * base + (1 - cosine**2) ** 0.5 * side).astype(np.float32)


def audited_width(graph: Graph, least: float) -> int:
    """The first beam that finds enough of the planted queries' nodes; over ``WIDEST`` where none does."""
    nodes, queries = planted(graph.unit, min(1.0, least + AUDIT_MARGIN))
    width = BEAM
    while width <= WIDEST:
        hits = 0
        for node, q in zip(nodes, queries):
            got = graph.search(q, width, least - 1e-4)
            hits += got is None or bool((got == node).any())
        if hits >= AUDIT_RECALL * len(nodes):
            break
        width *= 2
    return width


class Forest:
    """Which nodes of a shard are known to be connected; ``edges`` holds one edge for each thing learnt."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.root, self.edges = ids, np.arange(len(ids)), []

    def join(self, own: int, found: np.ndarray) -> None:
        roots, first = np.unique(self.root[found], return_index=True)
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]
        self.edges += [(own, int(self.ids[at])) for at in found[first]]


PAIR, COUNT, EDGE = 0, 1, 2


def link_batches(batches, least: float):
    """What the vectors of a block find in a shard, as (a, b, n, kind).

    PAIR: a link. COUNT: that vector a has n links in shard b, for a vector that was compared with all of it; its links
    are not listed, but EDGE rows connect what they connect. A task holds one graph at a time, and the vectors of a batch.
    """
    release_memory()
    now, pieces, graph = None, [], None
    for key, side, rows in runs(batches, ("dim", "shard", "block")):
        if key != now:
            now, pieces, graph = key, [], None
        if side == HELD:
            pieces.append(rows)
            continue
        if pieces:
            graph, v, copies = loaded(pieces)
            pieces, width, forest = [], audited_width(graph, least), Forest(graph.ids)
        if graph is not None:  # a length may have no vectors in this shard
            yield from links(graph, v, copies, forest, width, key[1], rows, least)


def links(graph: Graph, v: np.ndarray, copies: np.ndarray, forest: Forest, width: int, shard: int, rows: pa.RecordBatch, least: float):
    """``link_batches`` for some vectors."""
    ids, own = graph.ids, np.asarray(rows.column("id"))
    queries = unit_rows(matrix(rows.column("v")))
    q32 = queries.astype(np.float32)
    dense, pairs, counts = [], [], []

    def verified(k, got):
        return got[(v[got] @ queries[k] >= least) & (ids[got] != own[k])]

    for k in range(len(own)):
        got = graph.search(q32[k], width, least - 1e-4) if width <= WIDEST else None
        if got is None:
            dense.append(k)
        elif len(got := verified(k, got)):
            pairs.append(np.stack([np.full(len(got), own[k]), ids[got]]))
    for at in range(0, len(dense), TOGETHER):
        some = dense[at : at + TOGETHER]
        near = q32[some] @ graph.unit.T >= least - 1e-4
        for k, row in zip(some, near):
            got = verified(k, np.flatnonzero(row))
            counts.append((own[k], copies[got].sum()))
            if len(got):
                forest.join(int(own[k]), got)
    edges, forest.edges = forest.edges, []
    for kind, found in ((PAIR, np.concatenate(pairs, axis=1).T if pairs else ()), (EDGE, edges)):
        if len(found):
            a, b = np.asarray(found, dtype=np.int64).T
            yield rows_of(a, b, np.zeros(len(a), np.int64), kind)
    if counts:
        a, n = (np.array(c, dtype=np.int64) for c in zip(*counts))
        yield rows_of(a, np.full(len(a), shard, np.int64), n, COUNT)


def rows_of(a: np.ndarray, b: np.ndarray, n: np.ndarray, kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n), pa.array(np.full(len(a), kind, np.int32))], names=["a", "b", "n", "kind"])


def near_duplicates(vectors: DataFrame, least: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id (smallest linked vec_id, itself included), kept (vec_id = component_id) of every row.

    Null, empty and zero vectors and those with null or non-finite components link with nothing; so do vectors of
    different lengths. A row with a null id links with nothing either and has a null component. An id given twice is two
    vectors, each with its own links. Equal vectors are one class, searched once.

    A shard has at most about ``SHARD_ROWS`` classes; each is met by all classes in blocks, by some shards at a time. A
    task gets the graph in pieces and then the vectors, so neither fills a row. Links leave a task one by
    one only where a vector has few in the shard; of others their number leaves it, and edges enough to connect what
    they link.
    """
    rows = usable(vectors, key, vector)
    same = classes(rows.where("vec_id is not null")).withColumn("id", F.monotonically_increasing_id())
    same = saved(same, "vectors").withColumn("dim", F.size("v"))
    n = same.count()
    shards = max(LEAST_SHARDS, -(-n // SHARD_ROWS))

    def shard_of(c):
        return F.pmod(F.xxhash64(c), F.lit(shards)).cast("int")

    placed = same.withColumn("shard", shard_of("id"))
    graphs = placed.groupBy("dim", "shard").applyInArrow(build, "shard int, dim int, piece int, ids array<long>, copies array<long>, vectors binary, graph binary")
    graphs = saved(graphs, "graphs")
    blocks = max(LEAST_SHARDS, -(-n // BLOCK_ROWS))
    pieces = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    block = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)).cast("int").alias("block")
    found, at_once = [], max(1, MEETS // max(1, n))
    for first in range(0, shards, at_once):
        last = min(shards, first + at_once) - 1
        asked = same.select("dim", block, "id", "v", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("shard"))
        tasks = met(pieces.where(F.col("shard").between(first, last)), asked, ("dim", "shard", "block"), 2 * (last - first + 1) * blocks)
        found.append(saved(tasks.mapInArrow(partial(link_batches, least=least), "a long, b long, n long, kind int"), "links"))
    found = reduce(DataFrame.unionByName, found)
    drop_saved(graphs)

    one_way = found.where(F.col("kind") == PAIR).select("a", "b")
    dense = found.where(F.col("kind") == COUNT).select("a", F.col("b").cast("int").alias("shard"), "n")
    both = one_way.unionByName(one_way.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().withColumn("shard", shard_of("b"))
    open_pairs = both.join(dense.select("a", "shard"), ["a", "shard"], "left_anti")
    weighed = open_pairs.join(same.select(F.col("id").alias("b"), "copies"), "b").select("a", F.col("copies").alias("n"))
    counts = weighed.unionByName(dense.select("a", "n")).groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("others"))
    linked = components(found.where(F.col("kind") != COUNT).select("a", "b")).withColumnRenamed("node", "id")
    smallest = linked.join(same.select("id", "rep"), "id").groupBy("component").agg(F.min("rep").alias("component_id"))
    known = same.join(counts, "id", "left").join(linked, "id", "left").join(smallest, "component", "left").select(
        "v", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")
    )
    with_vector = rows.where("vec_id is not null").join(known, "v").select("vec_id", "n_links", "component_id")
    id_, fits = F.col(f"`{key}`"), usable_vector(vector)
    others = vectors.where(id_.isNull() | ~fits).select(id_.alias("vec_id"), F.lit(0).cast("long").alias("n_links"), id_.alias("component_id"))
    every = with_vector.unionByName(others)
    return every.withColumn("kept", F.col("vec_id") == F.col("component_id"))
