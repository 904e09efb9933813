"""Best-fit packing of documents into sequences by linear grouping.

Only the histogram of piece lengths is planned, which has at most ``capacity`` rows however many documents there are:

1. Large lengths are sorted and cut into groups of equal cardinality; each is rounded up to its group's largest.
2. Configurations of these few sizes are optimised (a linear program over patterns, by column generation) and rounded
   down.
3. Actual lengths take the places of the rounded ones, the longest of a group first.
4. Small lengths and what the rounding left go, largest first, to the open sequence they fit best.

This is done for a few numbers of groups and bounds of "large", and the plan with the fewest sequences is taken.

Equal sequences are kept as one pattern with a number of copies. Every piece then finds its place from its length and
its rank among pieces of that length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenledger.llm.bpe import encode
from evenledger.llm.common import saved

#: Numbers of groups, and shares of the capacity above which a length is large, of which the best plan is taken.
#: A share of 1 makes no length large: best fit alone.
GROUPS, LARGE = (32, 64), (2, 3, 4, 1)
#: Pieces of one rank group; ranks within a group are formed by one task, which may spill.
RANK_ROWS = 500_000


def grouped(counts: list[tuple[int, int]], groups: int) -> list[tuple[int, list[list[int]]]]:
    """(rounded size, [[length, count]...] from the longest) of groups with equally many items."""
    total = sum(n for _, n in counts)
    out, room = [], 0
    for length, n in sorted(counts, reverse=True):
        while n:
            if not room:
                room = -(-total // groups)
                out.append((length, []))
            take = min(n, room)
            out[-1][1].append([length, take])
            n, room = n - take, room - take
    merged: dict[int, list[list[int]]] = {}
    for size, members in out:
        merged.setdefault(size, []).extend(members)
    return sorted(merged.items(), reverse=True)


def best_pattern(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, list[int]]:
    """The most valuable multiset of sizes that fits, as counts; by rounds of one more item."""
    useful = [i for i, v in enumerate(values) if v > 1e-12]
    value, picks = np.zeros(capacity + 1), []
    for _ in range(capacity // min(sizes)):
        tried = np.full((len(useful) + 1, capacity + 1), -1.0)
        tried[-1] = value
        for row, i in enumerate(useful):
            tried[row, sizes[i] :] = value[: capacity + 1 - sizes[i]] + values[i]
        pick = tried.argmax(axis=0)
        picks.append(pick)
        value = np.take_along_axis(tried, pick[None], axis=0)[0]
    counts, c = [0] * len(sizes), capacity
    for pick in reversed(picks):
        if pick[c] < len(useful):
            i = useful[pick[c]]
            counts[i] += 1
            c -= sizes[i]
    return float(value[capacity]), counts


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 200) -> list[tuple[int, list[int]]]:
    """(copies, counts by size) that cover the demand with nearly the least number of sequences."""
    k = len(sizes)
    columns = [[capacity // s if i == j else 0 for j in range(k)] for i, s in enumerate(sizes)]
    need = np.array(demand, dtype=float)
    for _ in range(rounds):
        basis = np.array(columns, dtype=float).T
        inverse = np.linalg.inv(basis)
        amounts = inverse @ need
        duals = np.ones(k) @ inverse
        value, pattern = best_pattern(sizes, duals, capacity)
        if value <= 1 + 1e-7:
            break
        step = inverse @ np.array(pattern, dtype=float)
        ratios = np.where(step > 1e-9, np.maximum(amounts, 0) / np.where(step > 1e-9, step, 1), np.inf)
        columns[int(np.argmin(ratios))] = pattern
    amounts = np.linalg.inv(np.array(columns, dtype=float).T) @ need
    left, out = list(demand), []
    for pattern, amount in zip(columns, amounts):
        used = [(i, c) for i, c in enumerate(pattern) if c]
        copies = min([int(amount + 1e-9), *(left[i] // c for i, c in used)])
        if copies > 0:
            out.append((copies, list(pattern)))
            for i, c in used:
                left[i] -= copies * c
    return out


def substituted(patterns, groups) -> tuple[list[tuple[int, list[tuple[int, int]]]], list[tuple[int, int]]]:
    """([(copies, [(length, count)...])...], what is left): actual lengths in the places of rounded ones."""
    pools = [list(reversed(members)) for _, members in groups]
    out = []
    for copies, counts in patterns:
        used = [(i, c) for i, c in enumerate(counts) if c]
        while copies:
            same = min(copies, *(pools[i][-1][1] // c for i, c in used))
            content = []
            for i, c in used:
                open_ = c * max(1, same)
                while open_:
                    run = pools[i][-1]
                    take = min(open_, run[1])
                    content.append((run[0], take // max(1, same)))
                    run[1] -= take
                    open_ -= take
                    if not run[1]:
                        pools[i].pop()
            out.append((max(1, same), content))
            copies -= max(1, same)
    return out, [(length, n) for pool in pools for length, n in pool]


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences as (copies, [(length, count)...])."""
    least = -(-sum(length * n for length, n in histogram.items()) // capacity)
    best, fewest = [], None
    for share in LARGE:
        for groups in GROUPS if share > 1 else GROUPS[:1]:
            found = plan_once(histogram, capacity, groups, share)
            n = sum(copies for copies, _ in found)
            if fewest is None or n < fewest:
                best, fewest = found, n
            if n == least:
                return best
    return best


def plan_once(histogram: dict[int, int], capacity: int, groups: int, share: int) -> list[tuple[int, list[tuple[int, int]]]]:
    full = histogram.get(capacity, 0)
    rest = {length: n for length, n in histogram.items() if length < capacity and n}
    large = [(length, n) for length, n in rest.items() if length * share > capacity]
    small = [(length, n) for length, n in rest.items() if length * share <= capacity]
    done: list[tuple[int, list[tuple[int, int]]]] = [(full, [(capacity, 1)])] if full else []
    bins: dict[int, list[tuple[int, list[tuple[int, int]]]]] = defaultdict(list)
    rooms: list[int] = []

    def put(copies, content):
        room = capacity - sum(length * c for length, c in content)
        if not bins[room]:
            insort(rooms, room)
        bins[room].append((copies, content))

    if large:
        members = grouped(large, groups)
        sizes = [size for size, _ in members]
        demand = [sum(n for _, n in lengths) for _, lengths in members]
        patterns, left = substituted(configurations(sizes, demand, capacity), members)
        small += left
        for copies, content in patterns:
            put(copies, content)
    for length, n in sorted(small, reverse=True):
        while n:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                put(-(-n // (capacity // length)), [])
                continue
            room = rooms[at]
            copies, content = bins[room].pop()
            if not bins[room]:
                rooms.pop(at)
            each = min(room // length, n)
            used = min(copies, n // each)
            if used < copies:
                put(copies - used, content)
            put(used, [*content, (length, each)])
            n -= used * each
    return done + [(copies, content) for room in list(bins) for copies, content in bins[room] if content]


def places(patterns) -> dict[str, np.ndarray]:
    """Runs of equal places by length and rank: which sequence and offset the pieces of a rank range get."""
    rank: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for copies, content in patterns:
        offset = 0
        for length, each in content:
            rows.append((length, rank[length], each, sequence, offset))
            rank[length] += copies * each
            offset += length * each
        sequence += copies
    rows.sort()
    length, first, each, base, offset = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return {"length": length, "first": first, "each": each, "base": base, "offset": offset}


def place_batches(batches, table):
    t = table.value
    keys = t["length"] << 44 | t["first"]
    for batch in batches:
        length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
        at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
        inside = rank - t["first"][at]
        sequence = t["base"][at] + inside // t["each"][at]
        offset = t["offset"][at] + inside % t["each"][at] * length
        names = [n for n in batch.schema.names if n != "rank"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter."""
    first = total % capacity or min(total, capacity)
    return [(0, first), *((at, capacity) for at in range(first, total, capacity))]


def piece_digest(vocab, doc_ids, tokens, bounds, capacity, end):
    out = []
    for doc_id, a, b in zip(doc_ids, bounds[:-1], bounds[1:]):
        ids = np.append(tokens[a:b], end).astype("<u4")
        for k, (start, n) in enumerate(cut(len(ids), capacity)):
            out.append((doc_id, k, start, n, zlib.crc32(ids[start : start + n].tobytes())))
    columns = list(zip(*out)) or [()] * 5
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])


def pack(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every document's tokens and the id ``end``, in sequences.

    Documents over ``capacity`` ids are cut into pieces of that length, the first of which may be shorter; all others
    stay whole. A null or empty text is the id ``end`` alone. Sequences are numbered from 0 and have no gaps.
    The driver sees the histogram of lengths (at most ``capacity`` rows) and the patterns made of it, nothing else.
    """
    spark = docs.sparkSession
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = saved(encode(docs, path, partial(piece_digest, capacity=capacity, end=end), schema, key, text), "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.sparkContext.broadcast(places(plan(histogram, capacity)))
    salts = max(8, sum(histogram.values()) // RANK_ROWS)
    rows = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sizes = rows.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = rows.withColumn("own", F.row_number().over(own)).join(firsts, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("own") - 1).alias("rank"))
    return ranked.mapInArrow(partial(place_batches, table=table), f"{schema}, sequence_id long, offset long")
