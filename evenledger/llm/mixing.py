"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is a row of lower-case words and one end. The most frequent words are the leaves of a Huffman tree, all others
share one leaf and are told apart by their counts; words that training never met count together as often as words that
it met once. So a word is a short row of binary decisions, each predicted by a mixer of two layers.

1. Phrase: bit counts under four hashed contexts: none, the last very frequent word before it (which tells language and
   phrase), the punctuation before it, and both. Their log odds are added with weights picked by how much the contexts
   have seen, learned online over the cells (context, word), and refined. A cell has one chance however often it occurs, so
   this layer is a table of states by leaves (``learned``) and, from sums over subtrees, by decisions (``node_odds``).
2. Words: bit counts under the hash of the word before and of the two words before, whatever these words are. Their log
   odds and those of the first layer are added with weights picked by how much the two contexts have seen. The weights are
   learned online over the texts in their order (predict by what was met so far, move along the error, count), and so is
   the adaptive table from predicted to observed odds that refines the sum. Tasks go through their own texts; their
   weights are averaged, their counts added up.

Each decision's two sides add up to one, so the scores are those of a proper distribution over known words and
"unknown", as the base score's are.

All counts are over all training texts. The first layer's weights and refinement see each word without one occurrence of
its own, the second's before it is counted.
"""

from __future__ import annotations

import heapq
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenledger.llm.common import drop_saved, saved, small_batches, text_rows
from evenledger.llm.hashing import LOWER, buffer_of, mix, words

#: Leaves of the tree, frequent words told apart as contexts, and slots of a context's table (2**SLOT_BITS).
LEAVES, STOPS, SLOT_BITS = 1 << 15, 64, 22
STATES = (STOPS + 1) * 3
CONTEXTS = 4
BLOCK = 1 << 17
#: Words whose counts are broadcast; the counts of all others are joined.
HEAD_WORDS = 1 << 18
TEXT_BYTES = 4 << 20
CELLS, SLICE_CELLS = 1 << 15, 1 << 11
GATES = 32
BINS, APM_LIMIT = 33, 8.0
#: Contexts of preceding words, and slots of their table: 2**WORD_BITS at most, fewer for a small corpus. A slot takes a
#: task eight bytes while it counts and one byte afterwards; beyond that contexts share slots, and none is left out.
WORD_CONTEXTS, WORD_BITS, LEAST_WORD_BITS = 2, 23, 14
WORD_BLOCK = 1 << 14
#: Depths of the tree whose decisions after one context lie together in the table.
BUCKET_DEPTHS = 3
#: Words that are predicted between two moves of the weights: few at first, later more.
STEP_WORDS, CHUNK_WORDS = 1 << 7, 1 << 14
#: What a slot has seen, in eight levels (up to 0, 1, 2, 4, 8, 32, 256 and beyond); a pair of levels picks the weights.
LEVELS = 8
LEVEL_OF = np.searchsorted([1, 2, 3, 5, 9, 33, 257], np.arange(258), side="right")
WORD_GATES = LEVELS**WORD_CONTEXTS
WORD_BINS, FINE_BINS, WORD_LIMIT = 49, 1 << 11, 12.0
SHIFT, RATE = 0.3, 0.3
END = np.uint64(0)


def word_batches(batches):
    """(word, n, train) of the distinct words of each piece of the texts; the empty word stands for the ends."""
    for batch in small_batches(batches, "text", TEXT_BYTES):
        buf, offsets = buffer_of(batch.column("text"))
        train = np.asarray(batch.column("train").cast(pa.int8()))
        for flag in (0, 1):
            ends = int((train == flag).sum())
            if ends:
                yield _word_rows([b""], [ends if flag else 0])
        hashes, starts, stops, flags = [], [], [], []
        at = 0
        for low, s, e, h, rows in words(buf, offsets):
            hashes.append(h)
            starts.append(s + at)
            stops.append(e + at)
            flags.append(train[rows])
            at += len(low)
        if not hashes:
            continue
        hashes, starts, stops, flags = map(np.concatenate, (hashes, starts, stops, flags))
        found, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        counts = np.bincount(inverse, weights=flags, minlength=len(found)).astype(np.int64)
        yield _word_rows(gathered(buf, starts[first], stops[first]), counts)


def gathered(buf, starts, stops) -> pa.Array:
    """The spans as an Arrow array of lowered bytes."""
    lengths = stops - starts
    offsets = np.zeros(len(starts) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    index = np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(LOWER[buf[index]]))])


def _word_rows(column, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, pa.binary()) if isinstance(column, list) else column, pa.array(counts, pa.int64())], names=["word", "n"])


def huffman(counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code lengths, nodes, bits) of the leaves; nodes and bits are padded to the longest code."""
    n = len(counts)
    heap = [(c + 1, s) for s, c in enumerate(counts)]
    heapq.heapify(heap)
    parent = {}
    for node in range(n, 2 * n - 1):
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        parent[x], parent[y] = (node, 0), (node, 1)
        heapq.heappush(heap, (a + b, node))
    paths = []
    for s in range(n):
        path, at = [], s
        while at in parent:
            path.append((parent[at][0] - n, parent[at][1]))
            at = parent[at][0]
        paths.append(path[::-1])
    longest = max(map(len, paths))
    nodes = np.zeros((n, longest), dtype=np.uint64)
    bits = np.zeros((n, longest), dtype=np.uint8)
    for s, path in enumerate(paths):
        if path:
            nodes[s, : len(path)], bits[s, : len(path)] = zip(*path)
    return np.array([len(p) for p in paths]), nodes, bits


def leaf_of(hashes: np.ndarray, head: dict) -> np.ndarray:
    """Leaf of each word; the last leaf is that of all words outside the tree."""
    at = np.searchsorted(head["leaf_hashes"], hashes)
    at[at == len(head["leaf_hashes"])] = 0
    return np.where(head["leaf_hashes"][at] == hashes, head["leaves"][at], head["other"])


def tokens(batch: pa.RecordBatch, head: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, leaf, state, hashes of the preceding words[WORD_CONTEXTS, n]) of every word and end, in text order."""
    row, own, leaf, state, begins, _, _ = placed(batch, head)
    return row, own, leaf, state, preceding(own, begins)


def placed(batch: pa.RecordBatch, head: dict) -> tuple:
    """(row, hash, leaf, state, where texts begin, distinct hashes, place of each hash among them), in text order."""
    buf, offsets = buffer_of(batch.column("text"))
    n = len(offsets) - 1
    parts = [(h, r, low[e - 1]) for low, _, e, h, r in words(buf, offsets)]
    hashes = np.concatenate([*(p[0] for p in parts), np.zeros(0, np.uint64)])
    rows = np.concatenate([*(p[1] for p in parts), np.zeros(0, np.int64)]).astype(np.int64)
    last = np.concatenate([*(p[2] for p in parts), np.zeros(0, np.uint8)])
    counts = np.bincount(rows, minlength=n)
    ends = np.cumsum(counts + 1) - 1
    place = np.arange(len(rows)) + rows
    own = np.zeros(len(rows) + n, dtype=np.uint64)
    own[place] = hashes
    tail = np.zeros(len(own), dtype=np.uint8)
    tail[place] = last
    row = np.repeat(np.arange(n), counts + 1)
    found, inverse = np.unique(own, return_inverse=True)
    leaf = leaf_of(found, head)[inverse]
    begins = ends - counts
    stop = np.where(leaf < STOPS, leaf + 1, -1)
    stop[ends] = -1
    before = np.full(len(own), -1, dtype=np.int64)
    before[1:] = stop[:-1]
    before[begins] = 0
    seen = np.maximum.accumulate(np.where(before >= 0, np.arange(len(own)), 0))
    mark = np.zeros(len(own), dtype=np.int64)
    mark[1:] = np.where(tail[:-1] == 44, 1, np.where((tail[:-1] == 46) | (tail[:-1] == 33) | (tail[:-1] == 63), 2, 0))
    mark[begins] = 2
    return row, own, leaf, before[seen] * 3 + mark, begins, found, inverse


def preceding(own: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Hashes of the word before each token and of the two words before it; before a text's first word there are ends."""
    words_before = np.zeros((WORD_CONTEXTS, len(own)), dtype=np.uint64)
    found = np.zeros(len(own), dtype=np.uint64)
    back = own
    for k in range(WORD_CONTEXTS):
        back = np.concatenate((np.zeros(min(1, len(back)), np.uint64), back[:-1]))
        back[begins] = END
        found = mix(found * np.uint64(0x9E3779B97F4A7C15) + back + np.uint64(k + 1))
        words_before[k] = found
    return words_before


def cell_batches(batches, head):
    """(state, leaf, n) over a task's training texts."""
    head = head.value
    size = head["other"] + 1
    total = np.zeros(STATES * size, dtype=np.int64)
    for batch in small_batches(batches, "text", TEXT_BYTES):
        _, _, leaf, state, *_ = placed(batch, head)
        total += np.bincount(state * size + leaf, minlength=STATES * size)
    cells = np.flatnonzero(total)
    for at in range(0, len(cells), CELLS):
        part = cells[at : at + CELLS]
        yield pa.RecordBatch.from_arrays([pa.array((part // size).astype(np.int32)), pa.array((part % size).astype(np.int32)), pa.array(total[part])], names=["state", "leaf", "n"])


def decisions(batch: pa.RecordBatch, tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots[contexts, n], bits, cell of each decision) of a batch of cells."""
    lengths, nodes, bits = tree
    state, leaf = np.asarray(batch.column("state")).astype(np.uint64), np.asarray(batch.column("leaf"))
    width = lengths[leaf]
    owner = np.repeat(np.arange(len(leaf)), width)
    depth = np.arange(len(owner)) - np.repeat(np.cumsum(width) - width, width)
    node = nodes[leaf[owner], depth]
    return slots_of(state, node, owner), bits[leaf[owner], depth], owner


def slots_of(state: np.ndarray, node: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Slots by context of the decisions at some nodes, in the states of their owners."""
    slots = np.empty((CONTEXTS, len(node)), dtype=np.int64)
    none = np.zeros(len(state), dtype=np.uint64)
    for k, context in enumerate((none, state // np.uint64(3) + np.uint64(1), state % np.uint64(3) + np.uint64(1), state + np.uint64(1))):
        key = mix((context * np.uint64(1 << 32) + np.uint64(k))[owner] + node * np.uint64(CONTEXTS))
        slots[k] = (key >> np.uint64(64 - SLOT_BITS)).view(np.int64)
    return slots


def cell_slices(batches):
    """Cells few enough that their decisions stay in a processor's cache."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_CELLS):
            yield batch.slice(at, SLICE_CELLS)


def count_batches(batches, tree):
    """Bit counts of all slots over a task's cells, as packed blocks."""
    tree = tree.value
    tables = np.zeros((2, 1 << SLOT_BITS), dtype=np.int64)
    for batch in cell_slices(batches):
        weight = np.asarray(batch.column("n"))
        slots, bits, owner = decisions(batch, tree)
        for bit in (0, 1):
            own = bits == bit
            for k in range(CONTEXTS):
                np.add.at(tables[bit], slots[k][own], weight[owner[own]])
    for at in range(0, tables.shape[1], BLOCK):
        part = tables[:, at : at + BLOCK]
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([at // BLOCK]), pa.array([zlib.compress(part.tobytes(), 1)])], names=["block", "counts"])


def add_blocks(table: pa.Table) -> pa.Table:
    """The sum of a block over all tasks."""
    total = 0
    for packed in table.column("counts"):
        total = total + np.frombuffer(zlib.decompress(packed.as_py()), dtype=np.int64)
    return pa.table({"block": table.column("block")[:1], "counts": pa.array([zlib.compress(total.tobytes(), 1)])})


def stretched(model, slots, bits=None) -> tuple[np.ndarray, np.ndarray]:
    """(log odds of bit 1 by context, gate). With ``bits`` one own occurrence is left out of the counts."""
    zero, one = model["zero"][slots].astype(np.float32), model["one"][slots].astype(np.float32)
    if bits is not None:
        one = np.maximum(one - bits, 0)
        zero = np.maximum(zero - (1 - bits), 0)
    odds = np.log((one + np.float32(SHIFT)) / (zero + np.float32(SHIFT)))
    both = np.log2(1 + zero[3] + one[3])
    stop = np.log2(1 + zero[1] + one[1])
    gate = np.minimum(both / 2, 7).astype(np.int64) * 4 + np.minimum(stop / 4, 3).astype(np.int64)
    return np.clip(odds, -12, 12), gate


def first_weights() -> np.ndarray:
    """Of each gate, by context and for a constant."""
    return np.tile(np.array([0.2, 0.4, 0.1, 0.3, 0.0]), (GATES, 1))


def mixed(weights, odds, gate) -> np.ndarray:
    weights = weights.astype(np.float32)
    return sum((odds[k] * weights[gate, k] for k in range(CONTEXTS)), weights[gate, CONTEXTS])


def squash(x):
    return 1 / (1 + np.exp(-x))


def weight_batches(batches, model):
    """Weights learned online over a task's cells, with the evidence behind each gate."""
    model = model.value
    weights = first_weights()
    speed = np.full_like(weights, 0.1)
    mass = np.zeros(GATES)
    for batch in cell_slices(batches):
        count = np.asarray(batch.column("n"))
        slots, bits, owner = decisions(batch, model["tree"])
        odds, gate = stretched(model, slots, bits)
        share = count[owner].astype(np.float64)
        error = share * (bits - squash(mixed(weights, odds, gate)))
        total = np.bincount(gate, weights=share, minlength=GATES)
        for k in range(CONTEXTS + 1):
            step = np.bincount(gate, weights=error * odds[k] if k < CONTEXTS else error, minlength=GATES) / np.maximum(total, 1)
            speed[:, k] += step**2
            weights[:, k] += RATE * step / np.sqrt(speed[:, k])
        mass += total
    rows = [(g, k, weights[g, k] * mass[g], mass[g]) for g in range(GATES) for k in range(CONTEXTS + 1)]
    g, k, w, m = zip(*rows)
    yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(k), pa.array(w), pa.array(m)], names=["gate", "input", "weight", "mass"])


def bin_of(x) -> tuple[np.ndarray, np.ndarray]:
    """(lower bin, share of the upper one) of log odds."""
    scaled = (np.clip(x, -APM_LIMIT, APM_LIMIT - 1e-6) + APM_LIMIT) * (BINS - 1) / (2 * APM_LIMIT)
    low = np.minimum(scaled.astype(np.int64), BINS - 2)
    return low, scaled - low


def refine_batches(batches, model):
    """Bits met in each bin of predicted odds, by gate, over a task's cells."""
    model = model.value
    ones, met = np.zeros(GATES * BINS), np.zeros(GATES * BINS)
    for batch in cell_slices(batches):
        weight = np.asarray(batch.column("n")).astype(np.float64)
        slots, bits, owner = decisions(batch, model["tree"])
        odds, gate = stretched(model, slots, bits)
        low, share = bin_of(mixed(model["weights"], odds, gate))
        for at, part in ((low, 1 - share), (low + 1, share)):
            ones += np.bincount(gate * BINS + at, weights=weight[owner] * part * bits, minlength=GATES * BINS)
            met += np.bincount(gate * BINS + at, weights=weight[owner] * part, minlength=GATES * BINS)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(GATES * BINS)), pa.array(ones), pa.array(met)], names=["cell", "ones", "met"])


def leaf_scores(batches, model):
    """log10 probability of each leaf, by state: each decision's once, then the sums along the paths."""
    model = model.value
    cells, (lengths, nodes, bits) = model["cells"], model["tree"]
    steps = []
    for depth in range(nodes.shape[1]):
        inside = np.flatnonzero(lengths > depth)
        steps.append((inside, nodes[inside, depth].astype(np.int64) * 2 + bits[inside, depth]))
    node = np.arange(len(lengths) - 1, dtype=np.uint64)
    for batch in batches:
        for state in batch.column("id").to_pylist():
            odds, gate = stretched(model, slots_of(np.array([state], dtype=np.uint64), node, np.zeros(len(node), dtype=np.int64)))
            x = mixed(model["weights"], odds, gate)
            low, share = bin_of(x)
            refined = (1 - share) * cells[gate * BINS + low] + share * cells[gate * BINS + low + 1]
            p = np.clip((squash(x) + refined) / 2, 1e-6, 1 - 1e-6)
            chances = np.stack([np.log10(1 - p), np.log10(p)], axis=-1).ravel()
            score = np.zeros(len(lengths))
            for inside, step in steps:
                score[inside] += chances.take(step)
            yield pa.RecordBatch.from_arrays([pa.array([state]), pa.array([score.astype(np.float32).tobytes()], pa.binary())], names=["state", "scores"])


def text_batches(batches, head):
    """A text's sums over the words whose counts are at hand, and its other words with their counts."""
    head = head.value
    known_hashes, known_logs = head["hashes"], head["logs"]
    for batch in small_batches(batches, "text", TEXT_BYTES):
        row, own, leaf, state, begins, found, inverse = placed(batch, head)
        contexts = preceding(own, begins)
        n = batch.num_rows
        at = np.searchsorted(known_hashes, found)
        at[at == len(known_hashes)] = 0
        known = known_hashes[at] == found if len(known_hashes) else np.zeros(len(found), bool)
        logs = np.where(known, known_logs[:, at], 0) if len(known_hashes) else np.zeros((2, len(found)))
        known, logs = known[inverse], logs[:, inverse]
        other = leaf == head["other"]
        score = word_scores(head["words"], leaf, state, contexts) + np.where(other & known, logs[1] - head["other_log"], 0)
        sums = [np.bincount(row, weights=v, minlength=n) for v in (logs[0], score, known)]
        keys, times = np.unique(row[~known].astype(np.int64) * len(found) + inverse[~known], return_counts=True)
        bounds = np.searchsorted(keys // max(1, len(found)), np.arange(n + 1)).astype(np.int32)
        rare = pa.array(found[keys % max(1, len(found))].view(np.int64))
        tail = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays([rare, pa.array(times.astype(np.int64))], names=["hash", "k"]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("train"), pa.array(np.diff(np.searchsorted(row, np.arange(n + 1)))), pa.array(sums[2].astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), pc_lengths(batch), tail],
            names=["doc_id", "train", "n_tokens", "n_known", "base", "score", "n_bytes", "tail"],
        )


def pc_lengths(batch: pa.RecordBatch) -> pa.Array:
    return pa.array(np.diff(buffer_of(batch.column("text"))[1]))


def word_hashes(batches):
    """(hash, n) of the rows of the vocabulary."""
    from evenledger.llm.hashing import prefix_sums, span_hashes

    for batch in small_batches(batches, "word", 1 << 20):
        buf, offsets = buffer_of(batch.column("word"))
        hashes = span_hashes(prefix_sums(buf, 1), offsets[:-1], offsets[1:], 1)
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), batch.column("n")], names=["hash", "n"])


def frequent(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach."""
    level = F.floor(F.log2(F.col("n")) * 16).alias("level")
    least, met = 1 << 62, 0
    for r in counts.where("n > 0").groupBy(level).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n")).orderBy(F.desc("level")).collect():
        met += r.k
        if met > most:
            break
        least = r.n
    return least


def learned(cells: DataFrame, leaf_counts: list[int]) -> np.ndarray:
    """The table of scores, states by leaves."""
    spark = cells.sparkSession
    tree = huffman(leaf_counts)
    sent_tree = spark.sparkContext.broadcast(tree)
    schema = "block long, counts binary"
    blocks = cells.mapInArrow(partial(count_batches, tree=sent_tree), schema).groupBy("block").applyInArrow(add_blocks, schema)
    tables = np.zeros((2, 1 << SLOT_BITS), dtype=np.int32)
    for r in blocks.toLocalIterator():  # 32 blocks, whatever the corpus
        counts = np.frombuffer(zlib.decompress(bytes(r.counts)), dtype=np.int64).reshape(2, BLOCK)
        tables[:, r.block * BLOCK : (r.block + 1) * BLOCK] = np.minimum(counts, 2**31 - 1)
    model = {"tree": tree, "zero": tables[0], "one": tables[1]}
    sent = spark.sparkContext.broadcast(model)
    moved = cells.mapInArrow(partial(weight_batches, model=sent), "gate long, input long, weight double, mass double")
    weights = first_weights()
    for r in moved.groupBy("gate", "input").agg(F.sum("weight").alias("w"), F.sum("mass").alias("m")).collect():
        if r.m > 0:
            weights[r.gate, r.input] = r.w / r.m
    model["weights"] = weights
    sent.unpersist()
    sent = spark.sparkContext.broadcast(model)
    odds = squash(np.tile(np.linspace(-APM_LIMIT, APM_LIMIT, BINS), GATES))
    prior = 10.0
    for r in cells.mapInArrow(partial(refine_batches, model=sent), "cell long, ones double, met double").groupBy("cell").agg(F.sum("ones").alias("ones"), F.sum("met").alias("met")).collect():
        odds[r.cell] = (odds[r.cell] * prior + r.ones) / (prior + r.met)
    model["cells"] = odds
    sent.unpersist()
    sent = spark.sparkContext.broadcast(model)
    leaves = len(leaf_counts)
    table = np.zeros((STATES, leaves), dtype=np.float32)
    for r in spark.range(STATES).mapInArrow(partial(leaf_scores, model=sent), "state long, scores binary").toLocalIterator(prefetchPartitions=True):
        table[r.state] = np.frombuffer(r.scores, dtype=np.float32)
    sent.unpersist()
    return table


def node_odds(scores: np.ndarray, tree) -> np.ndarray:
    """Log odds of bit 1 of each decision in each state, from the chances of the leaves on its two sides."""
    lengths, nodes, bits = tree
    parts = []
    for depth in range(nodes.shape[1]):
        inside = np.flatnonzero(lengths > depth)
        place = nodes[inside, depth].astype(np.int64) * 2 + bits[inside, depth]
        order = np.argsort(place, kind="stable")
        side, first = np.unique(place[order], return_index=True)
        parts.append((inside[order], side, first))
    odds = np.empty((len(scores), max(1, len(lengths) - 1)), dtype=np.float32)
    for state, row in enumerate(scores):
        chance = np.power(10.0, row)
        sums = np.full((odds.shape[1], 2), 1e-30)
        for leaf, side, first in parts:
            sums.ravel()[side] += np.add.reduceat(chance[leaf], first)
        odds[state] = np.clip(np.log(sums[:, 1] / sums[:, 0]), -14, 14)
    return odds


def word_paths(tree, bits: int) -> dict:
    """The tree's decisions by depth, of every leaf: node, bit and place in a bucket as one number, and a hash of the node
    by which buckets are found. The nodes of ``BUCKET_DEPTHS`` depths below it share a bucket: one line of memory."""
    lengths, nodes, sides = tree
    places = np.ones(nodes.T.shape, dtype=np.int64)
    for depth in range(len(places)):
        if depth % BUCKET_DEPTHS:
            places[depth] = places[depth - 1] * 2 + sides.T[depth - 1]
    ranks = np.empty(len(lengths), dtype=np.uint16 if len(lengths) <= 1 << 16 else np.int64)
    ranks[np.argsort(-lengths, kind="stable")] = np.arange(len(lengths))
    steps = (nodes.T * np.uint64(2) + sides.T).astype(np.int64)
    return {
        "lengths": lengths.astype(np.uint8),
        "ranks": ranks,
        "keys": np.ascontiguousarray(mix((nodes.T[::BUCKET_DEPTHS] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))),
        "steps": np.ascontiguousarray(steps << BUCKET_DEPTHS | places),
        "shift": np.uint64(64 - bits + BUCKET_DEPTHS),
    }


def deepest_first(paths: dict, leaf: np.ndarray) -> np.ndarray:
    """An order of tokens by falling length of their paths, those of a word together."""
    return np.argsort(paths["ranks"].take(leaf), kind="stable")


def word_decisions(paths: dict, odds: np.ndarray, leaf, state, contexts, read):
    """By depth (what ``read`` finds in the buckets, by context; places in them; bits; log odds of the first layer) of the
    decisions of the tokens that have so many; these come first, since tokens are given in the order of ``deepest_first``.
    Odds are laid out by node, so a word's in all states lie together."""
    width = paths["lengths"].take(leaf)
    deeper = len(leaf) - np.cumsum(np.bincount(width, minlength=len(paths["steps"]) + 1))
    states, odds = odds.shape[1], odds.ravel()
    for depth, n in enumerate(deeper[:-1]):
        if not n:
            return
        own = leaf[:n]
        if depth % BUCKET_DEPTHS == 0:
            key = paths["keys"][depth // BUCKET_DEPTHS].take(own)
            buckets = [read(((context[:n] ^ key) >> paths["shift"]).view(np.int64)) for context in contexts]
        step = paths["steps"][depth].take(own)
        place = step & ((1 << BUCKET_DEPTHS) - 1)
        step >>= BUCKET_DEPTHS
        bit = step & 1
        step >>= 1
        step *= states
        step += state[:n]
        yield [bucket[:n] for bucket in buckets], place, bit, odds.take(step)


def first_slots(buckets: np.ndarray) -> np.ndarray:
    return buckets << BUCKET_DEPTHS


def word_batches_online(batches, head, model):
    """Goes through a task's training texts: predicts each word by what the task has met before, moves weights and
    refinement along the error, then counts the word. Yields weights, refinement and packed blocks of the counts."""
    head, model = head.value, model.value
    paths = model["paths"]
    table = np.zeros(2 << int(64 - paths["shift"] + BUCKET_DEPTHS), dtype=np.uint32)
    pairs = table.view(np.uint64)
    one = np.array([1, 1 << 32], dtype=np.uint64)
    weights = first_word_weights()
    inputs = weights.shape[1]
    speed = np.full_like(weights, 0.1)
    mass, met = np.zeros(WORD_GATES), np.zeros(2 * WORD_GATES * WORD_BINS, dtype=np.int64)
    done = 0
    for batch in small_batches(batches, "text", TEXT_BYTES):
        _, _, leaf, state, contexts = tokens(batch, head)
        at = 0
        while at < len(leaf):
            part = slice(at, at + min(CHUNK_WORDS, max(STEP_WORDS, done // 16)))
            moves, cells = np.zeros_like(weights), np.zeros_like(met)
            now = np.ascontiguousarray(weights.T, dtype=np.float32)
            order = deepest_first(paths, leaf[part])
            for buckets, place, bit, first in word_decisions(paths, model["odds"], leaf[part][order], state[part][order], contexts[:, part][:, order], first_slots):
                values, gate = [], 0
                slots = [bucket | place for bucket in buckets]
                for slot in slots:
                    pair = pairs.take(slot).view(np.uint32)
                    gate = gate * LEVELS + LEVEL_OF.take(pair[::2] + pair[1::2], mode="clip")
                    pair = pair.astype(np.float32)
                    pair += np.float32(SHIFT)
                    odds = pair[1::2] / pair[::2]
                    values.append(np.log(odds, out=odds))
                values.append(first)
                x = now[-1].take(gate)
                for k, v in enumerate(values):
                    x += v * now[k].take(gate)
                cell = word_bin(x)
                cell += gate * WORD_BINS
                cell <<= 1
                cell |= bit
                cells += np.bincount(cell, minlength=len(met))
                error = bit - squash(x)
                for k, v in enumerate([*(error * v for v in values), error]):
                    moves[:, k] += np.bincount(gate, weights=v, minlength=WORD_GATES)
                more = one.take(bit)
                for slot in slots:
                    np.add.at(pairs, slot, more)
            met += cells
            total = cells.reshape(WORD_GATES, -1).sum(axis=1)
            moves /= np.maximum(total, 1)[:, None]
            speed += moves**2
            weights += RATE * moves / np.sqrt(speed)
            mass += total
            done += part.stop - part.start
            at = part.stop
    learned_now = (
        (0, np.arange(WORD_GATES * inputs), (weights * mass[:, None]).ravel(), np.repeat(mass, inputs)),
        (1, np.arange(len(met) // 2), met[1::2].astype(np.float64), (met[::2] + met[1::2]).astype(np.float64)),
    )
    for kind, cell, value, weight in learned_now:
        columns = [pa.array(np.full(len(cell), kind)), pa.array(cell), pa.array(value), pa.array(weight), pa.nulls(len(cell), pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["kind", "cell", "value", "mass", "counts"])
    for at in range(0, len(table), 2 * WORD_BLOCK):
        part = table[at : at + 2 * WORD_BLOCK]
        if part.any():
            columns = [pa.array([2]), pa.array([at // (2 * WORD_BLOCK)]), pa.array([0.0]), pa.array([0.0]), pa.array([packed_counts(part)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "cell", "value", "mass", "counts"])


def packed_counts(part: np.ndarray) -> bytes:
    """The counts of a block: the width of one, then all of them, compressed."""
    part = part.astype(np.uint8) if part.max() < 256 else part
    return bytes([part.itemsize]) + pa.compress(part.tobytes(), codec="zstd", asbytes=True)


def counts_of(packed: bytes) -> np.ndarray:
    """What ``packed_counts`` packed."""
    width = packed[0]
    size = 2 * WORD_BLOCK * width
    return np.frombuffer(pa.decompress(memoryview(packed)[1:], decompressed_size=size, codec="zstd", asbytes=True), dtype=np.uint8 if width == 1 else np.uint32)


def word_bin(x) -> np.ndarray:
    """The bin of log odds in the refinement of the second layer."""
    x = np.minimum(np.maximum(x, np.float32(-WORD_LIMIT)), np.float32(WORD_LIMIT))
    x += np.float32(WORD_LIMIT)
    x *= np.float32((WORD_BINS - 1) / (2 * WORD_LIMIT))
    x += np.float32(0.5)
    return x.astype(np.int64)


def level_odds() -> np.ndarray:
    """Largest log odds of each level's counts, with which the codes of a level are laid out."""
    most = np.array([0, 1, 2, 4, 8, 32, 256, 1 << 13])
    return np.log((most + SHIFT) / SHIFT)


def code_of(zeros, ones) -> np.ndarray:
    """A byte for what a slot has seen: three bits of level, five of log odds."""
    level = LEVEL_OF[np.minimum(zeros + ones, len(LEVEL_OF) - 1)]
    odds = np.log((ones + SHIFT) / (zeros + SHIFT)) / np.maximum(level_odds()[level], 1e-9)
    return (level * 32 + np.rint((np.clip(odds, -1, 1) + 1) * 15)).astype(np.uint8)


def add_word_blocks(table: pa.Table) -> pa.Table:
    """The codes of a block's slots, from the sums of their counts over all tasks."""
    total = 0
    for packed in table.column("counts"):
        total = total + counts_of(packed.as_py()).astype(np.int64)
    codes = code_of(total[0::2], total[1::2])
    return pa.table({"cell": table.column("cell")[:1], "counts": pa.array([zlib.compress(codes.tobytes(), 1)])})


def first_word_weights() -> np.ndarray:
    """Of each gate, for the words before, the first layer and a constant: what has seen nothing weighs nothing."""
    weights = np.tile(np.array([0.0] * WORD_CONTEXTS + [1.0, 0.0]), (WORD_GATES, 1))
    for k in range(WORD_CONTEXTS):
        seen = np.arange(WORD_GATES) // LEVELS ** (WORD_CONTEXTS - 1 - k) % LEVELS > 0
        weights[seen, k] = 0.3
        weights[seen, WORD_CONTEXTS] -= 0.2
    return weights


def smoothed(moved, mass, ones, seen) -> tuple[np.ndarray, np.ndarray]:
    """Weights and refinement of all gates: one that was met little follows the gates one level below it, since a task meets
    less than all tasks together. ``moved`` are sums of weights by mass, ``ones`` the bits among ``seen`` in each bin."""
    weights, prior = first_word_weights(), 2000.0
    cells = np.tile(squash(np.linspace(-WORD_LIMIT, WORD_LIMIT, WORD_BINS)), (WORD_GATES, 1))
    ones, seen = ones.reshape(cells.shape), seen.reshape(cells.shape)
    for gate in range(WORD_GATES):
        below = [gate - LEVELS**k for k in range(WORD_CONTEXTS) if gate // LEVELS**k % LEVELS > 1]
        if below:
            weights[gate] = weights[below].mean(axis=0)
            cells[gate] = cells[below].mean(axis=0)
        weights[gate] = (weights[gate] * prior + moved[gate]) / (prior + mass[gate])
        cells[gate] = (cells[gate] * 10 + ones[gate]) / (10 + seen[gate])
    return weights, cells


def word_tables(weights: np.ndarray, cells: np.ndarray) -> dict:
    """By the codes of the two contexts: their part of the sum, the first layer's weight and the place of their gate in
    ``chances``, the log10 probabilities of both bits by gate and sum."""
    codes = np.arange(256)
    level, odds = codes // 32, (codes % 32 / 15 - 1) * level_odds()[codes // 32]
    two, one = np.repeat(codes, 256), np.tile(codes, 256)
    gate = level[one] * LEVELS + level[two]
    part = weights[gate, 0] * odds[one] + weights[gate, 1] * odds[two] + weights[gate, -1]
    x = np.linspace(-WORD_LIMIT, WORD_LIMIT, FINE_BINS)
    coarse = np.linspace(-WORD_LIMIT, WORD_LIMIT, WORD_BINS)
    refined = np.stack([np.interp(x, coarse, c) for c in cells.reshape(WORD_GATES, WORD_BINS)])
    p = np.clip((squash(x) + refined) / 2, 1e-6, 1 - 1e-6)
    return {
        "part": part.astype(np.float32),
        "weight": weights[gate, WORD_CONTEXTS].astype(np.float32),
        "gate": gate * FINE_BINS,
        "chances": np.stack([np.log10(1 - p), np.log10(p)], axis=-1).ravel().astype(np.float32),
    }


def word_scores(model, leaf, state, contexts) -> np.ndarray:
    """log10 probability of each token after the words before it."""
    codes, chances, low = model["codes"].view(f"u{1 << BUCKET_DEPTHS}"), model["chances"], np.uint64(255)  # a bucket is one number
    scores = np.zeros(len(leaf))
    scale, middle, most = np.float32((FINE_BINS - 1) / (2 * WORD_LIMIT)), np.float32((FINE_BINS - 1) / 2 + 0.5), np.float32(FINE_BINS - 1)
    for at in range(0, len(leaf), CHUNK_WORDS):
        part = slice(at, at + CHUNK_WORDS)
        order = deepest_first(model["paths"], leaf[part])
        found = np.zeros(len(order))
        for buckets, place, bit, first in word_decisions(model["paths"], model["odds"], leaf[part][order], state[part][order], contexts[:, part][:, order], codes.take):
            place <<= 3
            one, two = ((bucket >> place.view(np.uint64) & low).view(np.int64) for bucket in buckets)
            both = two
            both <<= 8
            both |= one
            x = model["weight"].take(both)
            x *= first
            x += model["part"].take(both)
            x *= scale
            x += middle
            fine = np.minimum(np.maximum(x, np.float32(0), out=x), most, out=x).astype(np.int64)
            fine += model["gate"].take(both)
            fine <<= 1
            fine |= bit
            found[: len(fine)] += chances.take(fine)
        scores[part][order] = found
    return scores


def word_bits(total: int) -> int:
    """Slots for about sixteen decisions a training token, as far as ``WORD_BITS`` goes."""
    return max(LEAST_WORD_BITS, min(WORD_BITS, (16 * total).bit_length()))


def learned_words(texts: DataFrame, head, scores: np.ndarray, leaf_counts: list[int], total: int) -> dict:
    """The second layer, for ``word_scores``; ``head`` is broadcast, ``scores`` the first layer's table."""
    context = texts.sparkSession.sparkContext
    tree = huffman(leaf_counts)
    bits = word_bits(total)
    model = {"paths": word_paths(tree, bits), "odds": np.ascontiguousarray(node_odds(scores, tree).T)}
    sent = context.broadcast(model)
    met = saved(texts.mapInArrow(partial(word_batches_online, head=head, model=sent), "kind long, cell long, value double, mass double, counts binary"), "word-counts")
    moved, mass = np.zeros((WORD_GATES, WORD_CONTEXTS + 2)), np.zeros((WORD_GATES, 1))
    ones, seen = np.zeros((2, WORD_GATES * WORD_BINS))
    for r in met.where("kind < 2").groupBy("kind", "cell").agg(F.sum("value").alias("value"), F.sum("mass").alias("mass")).collect():
        if r.kind:
            ones[r.cell], seen[r.cell] = r.value, r.mass
        else:
            moved.flat[r.cell], mass[r.cell // moved.shape[1]] = r.value, r.mass
    weights, cells = smoothed(moved, mass, ones, seen)
    codes = np.full(1 << bits, code_of(np.zeros(1, np.int64), np.zeros(1, np.int64))[0], dtype=np.uint8)
    blocks = met.where("kind = 2").select("cell", "counts").groupBy("cell").applyInArrow(add_word_blocks, "cell long, counts binary")
    for r in blocks.toLocalIterator():  # 2**WORD_BITS / WORD_BLOCK blocks at most, whatever the corpus
        codes[r.cell * WORD_BLOCK : (r.cell + 1) * WORD_BLOCK] = np.frombuffer(zlib.decompress(bytes(r.counts)), dtype=np.uint8)
    drop_saved(met)
    sent.destroy()
    return model | {"codes": codes} | word_tables(weights, cells)


def score_texts(docs: DataFrame, held, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), n_bytes, bits_per_byte of every text.

    ``held`` is a Column over ``doc_id``: rows for which it is true are scored but not learned from. Null and empty
    texts have the end token alone. Each row is scored on its own, so keys may be repeated; a row with a null key has a
    null ``held_out`` and is not learned from. With nothing to learn from, all counts are zero.

    Words are counted by Spark over all texts. The counts of the most frequent ones (at most ``HEAD_WORDS``) are
    broadcast, those of all others are joined by a 64-bit hash. The first layer's tables (STATES * LEAVES floats at most)
    are of fixed size, the table of preceding words grows with the corpus up to 2**WORD_BITS slots.
    """
    spark = docs.sparkSession
    rows = text_rows(docs, key, text).withColumn("train", ~held)
    counted = rows.where("train").select("text", "train").mapInArrow(word_batches, "word binary, n long")
    vocabulary = saved(counted.groupBy("word").agg(F.sum("n").alias("n")).mapInArrow(word_hashes, "hash long, n long"), "vocabulary")
    total, distinct, once = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count(F.when(F.col("n") == 1, 1))).first()
    least, in_tree = frequent(vocabulary, HEAD_WORDS), frequent(vocabulary, LEAVES - 1)
    top = vocabulary.where(F.col("n") >= least).toArrow()
    hashes = np.asarray(top.column("hash").combine_chunks()).view(np.uint64)
    counts = np.asarray(top.column("n").combine_chunks())
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    leaf = np.flatnonzero(counts >= in_tree)
    ranked = leaf[np.lexsort((hashes[leaf], -counts[leaf]))]  # leaf numbers by falling count
    by_hash = np.argsort(hashes[ranked])
    once = max(1, once)
    rest = max(0, total - int(counts[ranked].sum()))
    head = {
        "leaf_hashes": hashes[ranked][by_hash] if len(ranked) else np.array([1], dtype=np.uint64),
        "leaves": by_hash.astype(np.int64) if len(ranked) else np.array([0]),
        "other": len(ranked),
        "hashes": hashes,
        "logs": np.stack([np.log10(counts + 1.0), np.log10(np.maximum(counts, 1.0))]),
        "other_log": float(np.log10(rest + once)),
    }
    sent = spark.sparkContext.broadcast(head)
    cells = rows.where("train").select("text").mapInArrow(partial(cell_batches, head=sent), "state int, leaf int, n long")
    cells = saved(cells.groupBy("state", "leaf").agg(F.sum("n").alias("n")), "cells")
    leaf_counts = [*counts[ranked].tolist(), rest + once]
    scores = learned(cells, leaf_counts)
    drop_saved(cells)
    layer = learned_words(rows.where("train").select("text"), sent, scores, leaf_counts, total)
    sent.destroy()
    del scores
    head = head | {"words": layer}
    sent = spark.sparkContext.broadcast(head)
    schema = "doc_id long, train boolean, n_tokens long, n_known long, base double, score double, n_bytes long, tail array<struct<hash: long, k: long>>"
    parts = saved(rows.mapInArrow(partial(text_batches, head=sent), schema).withColumn("_row", F.monotonically_increasing_id()), "text-sums")
    tail = parts.select("_row", F.explode("tail").alias("t")).select("_row", "t.hash", "t.k")
    rare = vocabulary.where(F.col("n") < least)
    count = F.coalesce("n", F.lit(0))
    met = tail.join(rare, "hash", "left").groupBy("_row").agg(
        F.sum(F.when(count > 0, F.col("k")).otherwise(0)).alias("known2"),
        F.sum(F.col("k") * F.log10(count + 1.0)).alias("base2"),
        F.sum(F.col("k") * (F.log10(F.when(count > 0, count).otherwise(F.lit(once)).cast("double")) - F.lit(head["other_log"]))).alias("score2"),
    )
    zero = F.lit(0)
    score = F.col("score") + F.coalesce("score2", zero)
    return parts.drop("tail").join(met, "_row", "left").select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known2", zero)).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", zero) - F.col("n_tokens") * F.log10(F.lit(float(total + distinct + 1)))).alias("base_score"),
        score.alias("score"),
        "n_bytes",
        (-score * float(np.log2(10)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
