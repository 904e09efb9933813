"""Toxicity of whole texts by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is a row of words; a word is a vector made of its own hashed embedding and the mean embedding of its
three-character strings. Windows of ``WINDOW`` words, each half over the one before, are read forwards and backwards by
gated recurrent units; attention pools the states, and a logistic unit gives the window's score. A text scores as its
highest window. Training sees a text through its highest window too (after two epochs of random windows), so the score
is that of the whole text.
"""

from __future__ import annotations

import pickle
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenledger.llm.common import release_memory, small_batches, text_rows
from evenledger.llm.hashing import SPACES, buffer_of, mix, words

WINDOW, STRIDE = 64, 32
HIDDEN, ATTENTION = 8, 8
WORD_ROWS, WORD_SIZE, CHAR_ROWS, CHAR_SIZE = 1 << 15, 8, 1 << 13, 12
TEXT_BYTES = 1 << 20
WINDOWS_AT_ONCE, WORDS_AT_ONCE = 1024, 1 << 14
#: At most so many labelled texts of either class are learned from, none over so many bytes; taken by hash of the id.
POSITIVE, NEGATIVE, SAMPLE_BYTES = 1500, 2500, 1 << 16
#: Texts of a step, fewer where there are under 640 texts, and the rate of learning.
BATCH, RATE = 32, 0.01
#: Steps of training, whatever the sample's size, within these numbers of epochs; the most that a positive text counts;
#: and how many texts of a class are kept back at least.
STEPS, LEAST_EPOCHS, MOST_EPOCHS, MOST_WEIGHT, LEAST_KEPT = 650, 5, 40, 2.0, 30

#: Words of the network also end at ASCII punctuation.
BETWEEN = SPACES.copy()
BETWEEN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 128)]] = True


class Words:
    """Words of some texts: row of each, and features of the distinct ones."""

    def __init__(self, column: pa.Array):
        buf, offsets = buffer_of(column)
        hashes, rows, spans, at = [], [], [], 0
        low = []
        for part, s, e, h, r in words(buf, offsets, between=BETWEEN):
            hashes.append(h)
            rows.append(r)
            spans.append(np.stack([s + at, e + at]))
            low.append(part)
            at += len(part)
        self.texts = len(offsets) - 1
        if not at or not sum(len(h) for h in hashes):
            self.rows = np.zeros(0, dtype=np.int64)
            self.word = self.rows
            self.bucket = self.rows
            self.grams, self.gram_starts, self.gram_counts = self.rows, self.rows, self.rows
            self.counts = np.zeros(self.texts, dtype=np.int64)
            return
        hashes, self.rows, spans, low = np.concatenate(hashes), np.concatenate(rows), np.concatenate(spans, axis=1), np.concatenate(low)
        found, first, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        self.counts = np.bincount(self.rows, minlength=self.texts)
        self.bucket = (found >> np.uint64(40)).astype(np.int64) & (WORD_ROWS - 1)
        starts, ends = spans[:, first]
        lengths = ends - starts
        total = np.cumsum(lengths)
        self.gram_starts, self.gram_counts = total - lengths, lengths
        place = np.arange(total[-1]) + np.repeat(starts - self.gram_starts, lengths)
        padded = np.concatenate((low, [0]))
        middle = padded[place].astype(np.uint64)
        before = np.where(place == np.repeat(starts, lengths), 1, padded[place - 1]).astype(np.uint64)
        after = np.where(place == np.repeat(ends, lengths) - 1, 2, padded[place + 1]).astype(np.uint64)
        self.grams = (mix(before << np.uint64(16) | middle << np.uint64(8) | after) & np.uint64(CHAR_ROWS - 1)).astype(np.int64)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, first word, words) of all overlapping windows; the last one of a text ends with it."""
        n = self.counts
        each = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
        row = np.repeat(np.arange(self.texts), each)
        k = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
        start = np.minimum(k * STRIDE, np.maximum(n[row] - WINDOW, 0))
        base = np.cumsum(n) - n
        return row, base[row] + start, np.minimum(n[row] - start, WINDOW)


def embedded(model: dict, found: Words) -> np.ndarray:
    """Vector of each distinct word."""
    if not len(found.bucket):
        return np.zeros((0, WORD_SIZE + CHAR_SIZE), dtype=np.float32)
    sums = np.empty((len(found.bucket), CHAR_SIZE), dtype=model["chars"].dtype)
    for a in range(0, len(sums), WORDS_AT_ONCE):
        starts = found.gram_starts[a : a + WORDS_AT_ONCE]
        end = starts[-1] + found.gram_counts[a + len(starts) - 1]
        sums[a : a + WORDS_AT_ONCE] = np.add.reduceat(model["chars"][found.grams[starts[0] : end]], starts - starts[0], axis=0)
    return np.concatenate([model["words"][found.bucket], sums / found.gram_counts[:, None]], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def run(inputs: np.ndarray, ids: np.ndarray, mask: np.ndarray, recurrent: np.ndarray, backwards: bool, keep: list | None = None) -> np.ndarray:
    """States [words, windows, HIDDEN] of one direction; ``inputs`` is by distinct word, ``ids`` and ``mask`` by step."""
    steps, n = ids.shape
    h = np.zeros((n, HIDDEN), dtype=np.float32)
    out = np.empty((steps, n, HIDDEN), dtype=np.float32)
    for t in range(steps - 1, -1, -1) if backwards else range(steps):
        x = inputs[ids[t]]
        u = h @ recurrent
        gates = sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
        reset, update = gates[:, :HIDDEN], gates[:, HIDDEN:]
        inner = u[:, 2 * HIDDEN :]
        new = np.tanh(x[:, 2 * HIDDEN :] + reset * inner)
        update = np.where(mask[t][:, None], update, 1)
        if keep is not None:
            keep.append((t, h, reset, update, new, inner))
        h = new + update * (h - new)
        out[t] = h
    return out


def pooled(model: dict, states: np.ndarray, mask: np.ndarray):
    """(logits, what the gradients need) of windows from their states."""
    hidden = np.tanh(states @ model["attend"])
    weight = hidden @ model["attend_out"]
    weight = np.where(mask, weight, -1e9)
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    context = np.einsum("tn,tnh->nh", weight, states)
    return context @ model["out"] + model["bias"][0], (hidden, weight, context)


def steps_of(found: Words, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    longest = int(count.max())
    mask = np.arange(longest)[:, None] < count[None, :]
    place = np.where(mask, first[None, :] + np.arange(longest)[:, None], first[None, :])
    return found.word[place], mask


def window_logits(model: dict, found: Words, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    vectors = embedded(model, found)
    ahead, back = (vectors @ model[f"in{d}"] + model[f"b{d}"] for d in (0, 1))
    out = np.empty(len(first), dtype=np.float32)
    order = np.argsort(count, kind="stable")
    for at in range(0, len(first), WINDOWS_AT_ONCE):
        own = order[at : at + WINDOWS_AT_ONCE]
        ids, mask = steps_of(found, first[own], count[own])
        states = np.concatenate([run(ahead, ids, mask, model["re0"], False), run(back, ids, mask, model["re1"], True)], axis=2)
        out[own] = pooled(model, states, mask)[0]
    return out


def start(seed: int = 5) -> dict:
    rng = np.random.default_rng(seed)
    size = WORD_SIZE + CHAR_SIZE
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    model = {"words": draw(WORD_ROWS, WORD_SIZE, scale=0.1), "chars": draw(CHAR_ROWS, CHAR_SIZE, scale=0.3)}
    for d in (0, 1):
        model |= {f"in{d}": draw(size, 3 * HIDDEN, scale=size**-0.5), f"re{d}": draw(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5), f"b{d}": np.zeros(3 * HIDDEN, np.float32)}
    return model | {
        "attend": draw(2 * HIDDEN, ATTENTION, scale=0.3),
        "attend_out": draw(ATTENTION, scale=0.3),
        "out": draw(2 * HIDDEN, scale=0.3),
        "bias": np.array([-0.5], dtype=np.float32),
    }


def gradients(model: dict, found: Words, first: np.ndarray, count: np.ndarray, label: np.ndarray, positive: float = 1.0) -> tuple[float, dict]:
    """(loss, gradients) over some windows, those of label 1 counted ``positive`` times; embedding gradients come as (rows, values)."""
    ids, mask = steps_of(found, first, count)
    used, ids = np.unique(ids, return_inverse=True)
    ids = ids.reshape(mask.shape)
    part = Words.__new__(Words)
    lengths = found.gram_counts[used]
    ends = np.cumsum(lengths)
    place = np.arange(ends[-1]) + np.repeat(found.gram_starts[used] - (ends - lengths), lengths)
    part.bucket, part.grams, part.gram_starts, part.gram_counts = found.bucket[used], found.grams[place], ends - lengths, lengths
    vectors = embedded(model, part)
    kept = [[], []]
    states = np.concatenate([run(vectors @ model[f"in{d}"] + model[f"b{d}"], ids, mask, model[f"re{d}"], d == 1, kept[d]) for d in (0, 1)], axis=2)
    logits, (hidden, weight, context) = pooled(model, states, mask)
    p = sigmoid(logits)
    counted = np.where(label > 0, positive, 1.0).astype(label.dtype)
    loss = -float(np.mean(counted * np.where(label > 0, np.log(p + 1e-7), np.log(1 - p + 1e-7))))
    error = counted * (p - label) / len(label)
    grad = {"out": context.T @ error, "bias": np.array([error.sum()])}
    d_context = error[:, None] * model["out"]
    d_states = weight[:, :, None] * d_context
    d_weight = np.einsum("tnh,nh->tn", states, d_context)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    grad["attend_out"] = np.einsum("tna,tn->a", hidden, d_score)
    d_hidden = d_score[:, :, None] * model["attend_out"] * (1 - hidden**2)
    grad["attend"] = np.einsum("tnh,tna->ha", states, d_hidden)
    d_states += d_hidden @ model["attend"].T
    d_vectors = np.zeros_like(vectors)
    for d in (0, 1):
        recurrent = model[f"re{d}"]
        d_h = np.zeros((len(label), HIDDEN), dtype=np.float32)
        d_re = np.zeros_like(recurrent)
        d_in = np.zeros((len(used), 3 * HIDDEN), dtype=np.float32)
        for t, h, reset, update, new, inner in reversed(kept[d]):
            d_h = d_h + d_states[t][:, d * HIDDEN : (d + 1) * HIDDEN]
            d_new = d_h * (1 - update) * (1 - new**2)
            d_update = np.where(mask[t][:, None], d_h * (h - new) * update * (1 - update), 0)
            d_reset = d_new * inner * reset * (1 - reset)
            d_x = np.concatenate([d_reset, d_update, d_new], axis=1)
            d_u = np.concatenate([d_reset, d_update, d_new * reset], axis=1)
            d_re += h.T @ d_u
            d_h = d_h * update + d_u @ recurrent.T
            np.add.at(d_in, ids[t], d_x)
        grad[f"re{d}"], grad[f"in{d}"], grad[f"b{d}"] = d_re, vectors.T @ d_in, d_in.sum(axis=0)
        d_vectors += d_in @ model[f"in{d}"].T
    grad["words"] = (part.bucket, d_vectors[:, :WORD_SIZE])
    grad["chars"] = (part.grams, np.repeat(d_vectors[:, WORD_SIZE:] / lengths[:, None], lengths, axis=0))
    return loss, grad


def kept_back(labels: np.ndarray) -> np.ndarray:
    """True for every sixth text of each class: they choose when to stop; none of a sample too small to spare them."""
    chosen = np.zeros(len(labels), dtype=bool)
    for value in (0, 1):
        of = np.flatnonzero(labels == value)
        if len(of) >= LEAST_KEPT * 6:
            chosen[of[::6]] = True
    return chosen if chosen[labels == 1].any() and chosen[labels == 0].any() else np.zeros(len(labels), dtype=bool)


def weighted_loss(logits: np.ndarray, labels: np.ndarray, weight: float) -> float:
    """Mean logistic loss, the positive ones counted ``weight`` times."""
    each = np.logaddexp(0, np.where(labels == 1, -logits, logits))
    return float(np.average(each, weights=np.where(labels == 1, weight, 1.0)))


def learn(texts: list[str], labels: list[int], seed: int = 5) -> dict:
    """A model from labelled texts, by Adam; embeddings of rows met are moved by their own running scale.

    The number of steps is about the same for any number of texts. Positive texts count more where they are few. Some
    texts are kept back, and the model of the epoch that fits them best is the one returned.
    """
    model = start(seed)
    found = Words(pa.array(texts, pa.string()))
    release_memory()
    row, first, count = found.windows()
    if not len(row):
        return model
    rng = np.random.default_rng(seed)
    label = np.array(labels, dtype=np.float32)
    bounds = np.searchsorted(row, np.arange(found.texts + 1))
    usable = np.flatnonzero(np.diff(bounds) > 0)
    back = kept_back(label[usable])
    held, usable = usable[back], usable[~back]
    positive = max(1.0, label[usable].sum())
    weight = float(np.clip(((len(usable) - positive) / positive / 3) ** 0.5, 1, MOST_WEIGHT))  # 1 up to three to one
    moved = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    batches = max(1, len(usable) // int(np.clip(len(usable) // 20, 8, BATCH)))
    epochs = int(np.clip(-(-STEPS // batches), LEAST_EPOCHS, MOST_EPOCHS))
    best, kept, step = np.inf, None, 0
    for epoch in range(epochs):
        if epoch < 2:
            chosen = bounds[usable] + (rng.random(len(usable)) * np.diff(bounds)[usable]).astype(np.int64)
        else:
            logits = window_logits(model, found, first, count)
            order = np.lexsort((logits, row))
            top = order[np.maximum(bounds[1:] - 1, 0)]
            chosen = top[usable]
            if len(held) and (loss := weighted_loss(logits[top[held]], label[held], weight)) < best:
                best, kept = loss, {k: v.copy() for k, v in model.items()}
        rate = RATE * (0.3 if epoch >= epochs * 0.6 else 1)
        for part in np.array_split(rng.permutation(len(usable)), batches):
            own = chosen[part]
            _, grad = gradients(model, found, first[own], count[own], label[usable[part]], weight)
            step += 1
            for name, g in grad.items():
                mean, square = moved[name]
                if isinstance(g, tuple):
                    rows, at = np.unique(g[0], return_inverse=True)
                    total = np.zeros((len(rows), g[1].shape[1]), dtype=np.float32)
                    np.add.at(total, at, g[1])
                    square[rows] = 0.9 * square[rows] + 0.1 * total**2
                    model[name][rows] -= rate * total / (np.sqrt(square[rows]) + 1e-5)
                else:
                    g = np.clip(g, -1, 1).astype(np.float32)
                    mean[...] = 0.9 * mean + 0.1 * g
                    square[...] = 0.99 * square + 0.01 * g**2
                    model[name] -= rate * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    if len(held):
        logits = window_logits(model, found, first, count)
        top = np.lexsort((logits, row))[np.maximum(bounds[1:] - 1, 0)]
        if kept is not None and weighted_loss(logits[top[held]], label[held], weight) >= best:
            model = kept
    return model


def scores(model: dict, column: pa.Array) -> np.ndarray:
    """Score of each text: that of its highest window; 0 without words."""
    found = Words(column)
    row, first, count = found.windows()
    best = np.full(found.texts, -np.inf)
    if len(row):
        np.maximum.at(best, row, window_logits(model, found, first, count))
    return np.where(np.isneginf(best), 0.0, 1 / (1 + np.exp(-np.maximum(best, -500))))


def score_batches(batches, model):
    for batch in small_batches(batches, "text", TEXT_BYTES):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores(model.value, batch.column("text")))], names=["doc_id", "score"])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", learn_from=None) -> dict:
    """A model from at most POSITIVE and NEGATIVE labelled texts, trained in one task; ``learn_from`` is a Column over ``doc_id``."""
    marks = labels.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    marks = marks.where("label in (0, 1)").dropDuplicates(["doc_id"])
    if learn_from is not None:
        marks = marks.where(learn_from)
    place = F.xxhash64("doc_id")
    picked = marks.where("label = 1").orderBy(place, "doc_id").limit(2 * POSITIVE).unionByName(marks.where("label = 0").orderBy(place, "doc_id").limit(2 * NEGATIVE))
    rows = text_rows(docs, key, text).where(F.octet_length("text") <= SAMPLE_BYTES).join(F.broadcast(picked), "doc_id")
    chosen = [rows.where(F.col("label") == value).orderBy(place, "doc_id").limit(most) for value, most in ((1, POSITIVE), (0, NEGATIVE))]
    sample = chosen[0].unionByName(chosen[1]).select("doc_id", "text", "label").repartition(1)
    found = sample.mapInArrow(learn_batches, "model binary").collect()
    return pickle.loads(found[0].model) if found else start()


def learn_batches(batches):
    """A packed model from the rows of the one task that the bounded sample fills."""
    rows = sorted((i, t, x) for b in batches for i, t, x in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("label").to_pylist()))
    if rows:
        _, texts, given = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(learn(list(texts), list(given)))], pa.binary())], names=["model"])
        release_memory()


def score_texts(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text; null and empty texts and texts without words score 0."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return text_rows(docs, key, text).mapInArrow(partial(score_batches, model=sent), "doc_id long, score double")


def clean_batches(batches, model, text, threshold):
    for batch in batches:
        for part in small_batches([batch], text, TEXT_BYTES):
            yield part.filter(pa.array(scores(model.value, part.column(text)) < threshold))


def drop_toxic(docs: DataFrame, model: dict, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores below the threshold, with all their columns; rows without text stay."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(partial(clean_batches, model=sent, text=text, threshold=threshold), docs.schema)
