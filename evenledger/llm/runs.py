"""Periodic runs of words by seed-and-extend along diagonals.

A run of period q and length L matches itself at lag q on a stretch of L - q words, at least ``max(least - q, q)``. Every
stretch of 2k - 1 words holds a k-gram that starts at a multiple of k, so lags from 2k - 1 to 4k - 2 (for the smallest
k: all smaller lags too) are seeded by k-grams alone:

1. The k-grams of each document, k = 2, 4, 8 and so on, are indexed. A k-gram's identifier comes from those of its two
   halves, so equal identifiers mean equal words, without hashing. k-grams that stand only once leave, and with them all
   longer ones that hold them; the levels end when none is left.
2. A k-gram at a multiple of k is paired with its later occurrences at the level's lags: at most about 2 pairs a word
   for each level, also in a text that repeats one word.
3. For each lag, pairs one k-gram apart lie on the same stretch: the furthest place that the lag covers passes from one to the
   next, and only the first is extended to the left, the last to the right, by ever shorter k-grams.

Of stretches with the same words the smallest lag is the run's period: by the theorem of Fine and Wilf smaller periods
divide larger ones where a run has two periods of them.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from evenledger.llm.common import small_batches, text_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
STEP_BYTES = 1 << 20
FIRST = 2


def levels(words: np.ndarray, documents: np.ndarray) -> list[np.ndarray]:
    """Identifiers of 1, 2, 4, ... neighbouring words by start, -1 for those that stand once in their document."""
    found, keys, at = [], documents * (int(words.max()) + 1) + words, np.arange(len(words))
    while True:
        _, ident, met = np.unique(keys, return_inverse=True, return_counts=True)
        level = np.full(len(words), -1, dtype=np.int64)
        again = met[ident] > 1
        level[at[again]] = ident[again]
        found.append(level)
        if not again.any():
            return found
        half = 1 << (len(found) - 1)
        at = np.flatnonzero((level[:-half] >= 0) & (level[half:] >= 0)) if len(level) > half else at[:0]
        keys = level[at] * (int(level.max()) + 1) + level[at + half]


def seeds(level: np.ndarray, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, start) of all pairs of equal k-grams at lags from low to high, of which the first starts at a multiple of k."""
    size = len(level)
    at = np.flatnonzero(level >= 0)
    places = np.sort(level[at] * size + at)
    first = at[at % k == 0]
    base = level[first] * size
    begin = np.searchsorted(places, base + np.minimum(first + low, size - 1))
    begin = np.where(first + low < size, begin, len(places))
    end = np.searchsorted(places, base + np.minimum(first + high, size - 1), side="right")
    counts = np.maximum(end - begin, 0)
    which = np.repeat(np.arange(len(first)), counts)
    partner = places[np.repeat(begin, counts) + np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)] % size
    start = first[which]
    order = np.lexsort((start, partner - start))
    return (partner - start)[order], start[order]


def extended(found: list[np.ndarray], k: int, lag: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lag, from, to) of the whole stretches that the seeds lie on, each once; both arrays are sorted by lag and start."""
    joined = np.zeros(len(lag), dtype=bool)
    joined[1:] = (lag[1:] == lag[:-1]) & (start[1:] == start[:-1] + k)  # the lag's covered place is where the next begins
    heads = np.flatnonzero(~joined)
    tails = np.append(heads[1:], len(lag)) - 1
    lag, low, high = lag[heads], start[heads], start[tails] + k
    size = len(found[0])
    for e in range(k.bit_length() - 2, -1, -1):
        level, step = found[e], 1 << e
        inside = high + lag + step <= size
        here = np.where(inside, high, 0)
        same = inside & (level[here] >= 0) & (level[here] == level[np.where(inside, high + lag, 0)])
        high = high + step * same
        inside = low >= step
        here = np.where(inside, low - step, 0)
        same = inside & (level[here] >= 0) & (level[here] == level[np.where(inside, low - step + lag, 0)])
        low = low - step * same
    return lag, low, high


def runs_of(words: np.ndarray, documents: np.ndarray, least: int = 12) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period; ``documents`` numbers each word's document, ascending."""
    if not len(words):
        return np.zeros((0, 3), dtype=np.int64)
    if least < 6:
        raise ValueError("runs need at least 6 words")
    found, rows = levels(words, documents), []
    for e in range(1, len(found)):
        k = 1 << e
        low = 1 if k == FIRST else 2 * k - 1
        lag, start = seeds(found[e], k, low, 4 * k - 2)
        if len(lag):
            lag, low_at, high_at = extended(found, k, lag, start)
            good = high_at - low_at >= np.maximum(least - lag, lag)
            rows.append(np.stack([low_at, high_at + lag - low_at, lag], axis=1)[good])
    if not rows:
        return np.zeros((0, 3), dtype=np.int64)
    every = np.concatenate(rows)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    first = np.ones(len(every), dtype=bool)
    first[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    every = every[first]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def dropped(size: int, runs: np.ndarray) -> np.ndarray:
    """True for words that some run holds after its first period."""
    edges = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:-1]) > 0


def run_batches(batches, least: int, rewrite: Callable | None, schema: pa.Schema):
    for batch in small_batches(batches, "text", STEP_BYTES):
        keys = batch.column("doc_id").to_pylist()
        texts = [WORD.findall(t) for t in batch.column("text").to_pylist()]
        if rewrite:
            texts = [rewrite(key, words) for key, words in zip(keys, texts)]
        seen: dict[str, int] = {}
        flat = np.fromiter((seen.setdefault(w, len(seen)) for words in texts for w in words), dtype=np.int64)
        sizes = np.array([len(words) for words in texts], dtype=np.int64)
        edges = np.concatenate(([0], np.cumsum(sizes)))
        runs = runs_of(flat, np.repeat(np.arange(len(sizes)), sizes), least)
        gone = dropped(len(flat), runs)
        cuts = np.searchsorted(runs[:, 0], edges)
        lists, kept = [], []
        for r, words in enumerate(texts):
            own = runs[cuts[r] : cuts[r + 1]]
            lists.append([{"start": s - edges[r], "length": n, "period": p} for s, n, p in own])
            kept.append(" ".join(words) if not len(own) else " ".join(w for w, g in zip(words, gone[edges[r] : edges[r + 1]]) if not g))
        columns = [keys, sizes, lists, kept]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def periodic_runs(docs: DataFrame, least: int = 12, key: str = "doc_id", text: str = "text", rewrite: Callable | None = None) -> DataFrame:
    """(key, n_words, runs array<struct<start, length, period>>, collapsed) of every document; the first column is ``doc_id``.

    A run is a stretch of words, numbered from 0, with smallest period q and at least ``max(least, 2 * q)`` words that no
    neighbour extends with the same period; ``least`` is 6 or more. Runs come by start and period. ``collapsed`` is the
    text without the words that a run holds after its first period, joined by one space. Words are what stands between
    spaces and the bytes 9 to 13. Null and empty texts have no words. Rows are worked through one by one, so keys may be
    null or repeated; other columns are not read. ``rewrite(key, words)`` may give other words for a document.

    A task needs a few hundred bytes for each word of its longest text.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    rows = text_rows(docs, key, text)
    ddl = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return rows.mapInArrow(partial(run_batches, least=least, rewrite=rewrite, schema=schema), ddl)
