"""Language of texts by unigram models that sum over all segmentations.

Every language has a probability for each piece of a fixed public vocabulary of byte strings. The probability of a word
is the sum, over all ways to cut it into pieces, of the product of their probabilities; the forward algorithm adds them
up from left to right. Piece probabilities are learned by expectation maximisation, with the forward and the backward
sums giving the expected number of uses of each piece. A text's words are independent; the language with the greatest
posterior is predicted.

A word is a run of letters and their marks, in lower case, with a space before it, as bytes. All single bytes are
pieces, so every word has a segmentation. Words of a batch are scored together, place by place; one of any length is
scored whole, its running sums rescaled on the way.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenledger.llm.common import small_batches, text_rows

LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
STEP_BYTES = 1 << 20
SLICE = 1 << 20
#: Forward sums are rescaled after so many bytes of a word.
RESCALE = 16
#: Words whose scores a task keeps for its next batches.
KNOWN = 300_000
ROUNDS = 5
SMOOTHING = 0.02


class Pieces:
    """The vocabulary's pieces that can stand in a word, as a tree of bytes."""

    def __init__(self, vocabulary: list[bytes]):
        self.pieces = sorted({p for p in vocabulary if p and self._fits(p)} | {bytes([b]) for b in range(256)})
        edges: dict[tuple[int, int], int] = {}
        self.piece_of = [-1]
        for number, piece in enumerate(self.pieces):
            node = 0
            for byte in piece:
                if (node, byte) not in edges:
                    edges[node, byte] = len(self.piece_of)
                    self.piece_of.append(-1)
                node = edges[node, byte]
            self.piece_of[node] = number
        keys = np.array([n * 256 + b for n, b in edges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.to = keys[order], np.fromiter(edges.values(), dtype=np.int64)[order]
        self.piece_of = np.array(self.piece_of)
        self.lengths = np.array([len(p) for p in self.pieces])

    @staticmethod
    def _fits(piece: bytes) -> bool:
        """No byte but those of lower-case letters, and a space at most in front."""
        return all(b >= 128 or 97 <= b <= 122 for b in (piece[1:] if piece[0] == 32 else piece))

    def arcs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bounds, from, to, piece): all pieces found in the words laid end to end; place w of word k is bounds[k] + w + k."""
        buf = np.frombuffer(b"".join(words), dtype=np.uint8)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.repeat(np.cumsum(sizes), sizes)
        start = np.arange(len(buf))
        at, node = start, np.zeros(len(buf), dtype=np.int64)
        lows, pieces = [], []
        while len(at):
            key = node * 256 + buf[at]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            live = self.keys[place] == key
            start, at, node = start[live], at[live] + 1, self.to[place[live]]
            piece = self.piece_of[node]
            full = piece >= 0
            lows.append(start[full])
            pieces.append(piece[full])
            more = at < ends[start]
            start, at, node = start[more], at[more], node[more]
        low, piece = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (lows, pieces))
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        word = np.repeat(np.arange(len(words)), sizes)[low]
        low = low + word  # a word of n bytes has n + 1 places
        return bounds + np.arange(len(bounds)), low, low + self.lengths[piece], piece


def forward(bounds: np.ndarray, low: np.ndarray, high: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums by place, log scale by place) of arcs with the given weights, one column for each model.

    The sum over all segmentations up to a place is its value times e to the power of its scale.
    """
    models = weight.shape[1]
    sums, scale = np.zeros((bounds[-1], models)), np.zeros((bounds[-1], models))
    sums[bounds[:-1]] = 1.0
    owner = np.searchsorted(bounds, high, side="right") - 1
    depth = high - bounds[owner]
    order = np.lexsort((high, depth))
    cuts = np.searchsorted(depth[order], np.arange(1, (depth.max() if len(depth) else 0) + 2))
    lengths, now = np.diff(bounds) - 1, np.zeros((len(bounds) - 1, models))
    window = int((high - low).max()) if len(low) else 1
    for d in range(1, len(cuts)):
        of = order[cuts[d - 1] : cuts[d]]
        if not len(of):
            continue
        to = high[of]
        first = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        places = to[first]
        sums[places] = np.add.reduceat(sums[low[of]] * weight[of], first, axis=0)
        scale[places] = now[owner[of][first]]
        if d % RESCALE == 0:
            on = np.flatnonzero(lengths > d)
            if len(on):
                near = bounds[on][:, None] + np.arange(max(0, d - window), d + 1)
                top = sums[near].max(axis=1)
                sums[near] /= top[:, None, :]
                scale[near] += np.log(top)[:, None, :]
                now[on] += np.log(top)
    return sums, scale


def word_scores(pieces: Pieces, words: list[bytes], probabilities: np.ndarray) -> np.ndarray:
    """Log probability of each word, all segmentations summed, in each column's language."""
    if not words:
        return np.zeros((0, probabilities.shape[1]))
    bounds, low, high, piece = pieces.arcs(words)
    sums, scale = forward(bounds, low, high, probabilities[piece])
    last = bounds[1:] - 1
    return np.log(sums[last]) + scale[last]


def expected(pieces: Pieces, words: list[bytes], counts: np.ndarray, probabilities: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece in words with counts, under one language's probabilities."""
    bounds, low, high, piece = pieces.arcs(words)
    weight = probabilities[piece][:, None]
    ahead, ahead_scale = (x[:, 0] for x in forward(bounds, low, high, weight))
    total = bounds[-1] - 1  # backward sums are forward sums of the words turned round
    turned = (bounds[-1] - bounds)[::-1]
    back, back_scale = (x[::-1, 0] for x in forward(turned, total - high, total - low, weight))
    owner = np.searchsorted(bounds, low, side="right") - 1
    last = bounds[1:] - 1
    whole = np.log(ahead[last]) + ahead_scale[last]
    share = ahead[low] * weight[:, 0] * back[high] * np.exp(ahead_scale[low] + back_scale[high] - whole[owner])
    return np.bincount(piece, weights=share * counts[owner], minlength=len(pieces.pieces))


def learned(pieces: Pieces, words: list[bytes], counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language from its words, from equal ones on; every piece gets ``SMOOTHING`` uses more."""
    found = np.full(len(pieces.pieces), 1 / len(pieces.pieces))
    for _ in range(rounds):
        uses = np.full(len(found), SMOOTHING)
        for at in range(0, len(words), 20_000):
            uses += expected(pieces, words[at : at + 20_000], counts[at : at + 20_000], found)
        found = uses / uses.sum()
    return found


def slices(text: str) -> Iterator[str]:
    """A text in parts of about a million characters, cut where no word is cut."""
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and (text[end].isalpha() or regex.match(r"\p{M}", text[end])):
            end += 1
        yield text[at:end]
        at = end


def words_of(text: str) -> list[bytes]:
    return [b" " + w.encode("utf-8", "replace") for w in LETTERS.findall(text.lower())]


class Scorer:
    """Scores of words under all languages; those of words seen before are kept."""

    def __init__(self, pieces: Pieces, probabilities: np.ndarray):
        self.pieces, self.probabilities = pieces, probabilities
        self.known: dict[bytes, int] = {}
        self.scores = np.zeros((0, probabilities.shape[1]))

    def totals(self, words: list[bytes], row: np.ndarray, rows: int) -> np.ndarray:
        """Sums of the words' scores by row."""
        fresh = [w for w in dict.fromkeys(words) if w not in self.known]
        if len(self.known) + len(fresh) > KNOWN:
            self.known, self.scores = {}, self.scores[:0]
            fresh = list(dict.fromkeys(words))
        fresh.sort(key=len)
        made = [word_scores(self.pieces, fresh[at : at + 20_000], self.probabilities) for at in range(0, len(fresh), 20_000)]
        self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
        self.scores = np.concatenate([self.scores, *made])
        which = np.fromiter((self.known[w] for w in words), dtype=np.int64, count=len(words))
        return np.stack([np.bincount(row, weights=self.scores[which, m], minlength=rows) for m in range(self.scores.shape[1])], axis=1)


def vocabulary(path: str) -> list[bytes]:
    """The byte strings of a rank file: one in base64 a line, before a space."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def score_batches(batches, path: str, model):
    languages, prior, probabilities = model.value
    scorer = None
    for batch in small_batches(batches, "text", STEP_BYTES):
        scorer = scorer or Scorer(Pieces(vocabulary(path)), probabilities)
        texts = batch.column("text").to_pylist()
        total, met = np.tile(prior, (len(texts), 1)), np.zeros(len(texts), dtype=bool)
        words, row = [], []

        def add():
            nonlocal total
            if words and languages:
                total = total + scorer.totals(words, np.repeat(*map(np.array, zip(*row))), len(texts))
            words.clear()
            row.clear()

        for r, text in enumerate(texts):
            for part in slices(text):
                found = words_of(part)
                if found:
                    met[r] = True
                    words += found
                    row.append((r, len(found)))
                if len(words) > 200_000:
                    add()
        add()
        best = total.argmax(axis=1) if len(languages) else np.zeros(len(texts), dtype=int)
        share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1) if len(languages) else met * 0.0
        names = [languages[b] if m and languages else "und" for b, m in zip(best, met)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(np.where(met, share, 0.0))], names=["doc_id", "lang_pred", "score"]
        )


def learner(path: str):
    def learn(words: pd.DataFrame) -> pd.DataFrame:
        words = words.sort_values("word")
        found = learned(Pieces(vocabulary(path)), [bytes(w) for w in words["word"]], words["n"].to_numpy(dtype=float))
        return pd.DataFrame({"lang": words["lang"].iloc[:1], "probabilities": [found.tolist()]})

    return learn


def count_batches(batches):
    """(lang, word, n) of the words of each batch."""
    for batch in batches:
        met: dict[tuple[str, bytes], int] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for word in words_of(text):
                met[lang, word] = met.get((lang, word), 0) + 1
        langs, words = zip(*met) if met else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.binary()), pa.array(met.values(), pa.int64())], names=["lang", "word", "n"])


def fit(docs: DataFrame, path: str, learn_from: Column, sample: int = 1500, chars: int = 16_384, lang: str = "lang", text: str = "text"):
    """(languages, log shares, probabilities by piece and language) of the rows for which ``learn_from`` holds.

    Shares are those of all such rows with a language. Pieces are learned from about ``sample`` different texts of each
    language, chosen by hash, of which the first ``chars`` characters count; both are the bounds of what is learned
    from. Rows with a null language or text teach nothing.
    """
    rows = docs.where(learn_from).select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).where("lang is not null and text is not null")
    counted = {r.lang: r.rows for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).collect()}
    languages = sorted(counted)
    if not languages:
        return [], np.zeros(0), np.zeros((0, 0))
    places = 1 << 30
    place = F.pmod(F.xxhash64("text"), F.lit(places)).alias("place")
    most = F.create_map(*[F.lit(x) for lang, n in counted.items() for x in (lang, min(places, int(places * 1.5 * sample / n)))])
    near = rows.select("lang", F.substring("text", 1, chars).alias("text"), place).where(F.col("place") < most[F.col("lang")])
    near = near.groupBy("lang", "place").agg(F.min("text").alias("text"))
    chosen = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("place"))).where(F.col("rank") <= sample)
    words = chosen.select("lang", "text").mapInArrow(count_batches, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    found = words.groupBy("lang").applyInPandas(learner(path), "lang string, probabilities array<double>")
    tables = {r.lang: np.array(r.probabilities) for r in found.collect()}
    languages = [x for x in languages if x in tables]
    total = sum(counted[x] for x in languages)
    if not languages:
        return [], np.zeros(0), np.zeros((0, 0))
    return languages, np.log([counted[x] / total for x in languages]), np.stack([tables[x] for x in languages], axis=1)


def identify(docs: DataFrame, model: tuple, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row: the likeliest language of the whole text and its posterior probability.

    ``und`` with score 0 for null texts, texts without a letter, and where no language was learned. Of languages that
    are equally likely the first by name is taken. Rows are independent, so keys may be null or repeated.
    """
    rows = text_rows(docs, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(partial(score_batches, path=path, model=shared), f"doc_id {kind}, lang_pred string, score double")
