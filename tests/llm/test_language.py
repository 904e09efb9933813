"""Segmentation sums against all segmentations written out, and languages of held-out texts."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenledger.llm.common import held_out
from evenledger.llm.language import Pieces, expected, fit, identify, learned, slices, vocabulary, word_scores, words_of
from evenledger.llm.queries import QUERIES, piece_path

SCHEMA = "doc_id long, text string, lang string, score string, lang_pred string"


def cuts(word):
    """All ways to cut a byte string into parts."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        for rest in cuts(word[n:]):
            yield [word[:n], *rest]


def small():
    rng = np.random.default_rng(2)
    pieces = Pieces([b" a", b" ab", b"ab", b"abc", b"bc", b"ca", b" A", b"a b", b"9a", b"bcab"])
    return pieces, rng.dirichlet(np.ones(len(pieces.pieces)), 2).T


def test_only_pieces_that_fit_a_word():
    pieces, _ = small()
    assert {p for p in pieces.pieces if len(p) > 1} == {b" a", b" ab", b"ab", b"abc", b"bc", b"ca", b"bcab"}
    assert {bytes([b]) for b in range(256)} <= set(pieces.pieces)


def test_sums_over_all_segmentations():
    pieces, chances = small()
    number = {p: k for k, p in enumerate(pieces.pieces)}
    words = [b" a", b" abcab", b" bcabcabca", b" ", "é".encode(), b" cabcabcabcab"]
    got = word_scores(pieces, words, chances)
    uses, counts = np.zeros(len(number)), np.array([3.0, 1, 2, 1, 1, 4])
    for word, count, scores in zip(words, counts, got):
        for m in range(2):
            each = [(c, math.prod(chances[number[p], m] for p in c)) for c in cuts(word) if all(p in number for p in c)]
            total = sum(x for _, x in each)
            assert scores[m] == pytest.approx(math.log(total))
            if m == 0:
                for cut, chance in each:
                    for piece in cut:
                        uses[number[piece]] += count * chance / total
    assert expected(pieces, words, counts, chances[:, 0]) == pytest.approx(uses)


def test_long_words_are_whole():
    pieces, chances = small()
    word = b" " + b"abcab" * 5000
    sums = np.zeros(len(word) + 1)
    tops, sums[0] = np.zeros(len(word) + 1), 1.0
    number = {p: k for k, p in enumerate(pieces.pieces)}
    for end in range(1, len(word) + 1):
        terms = [(tops[end - n], sums[end - n] * chances[number[word[end - n : end]], 0]) for n in range(1, 5) if end >= n and word[end - n : end] in number]
        top = max(t for t, _ in terms)
        sums[end] = sum(x * math.exp(t - top) for t, x in terms)
        tops[end], sums[end] = top + math.log(sums[end]), 1.0
    assert word_scores(pieces, [b" a", word], chances)[1, 0] == pytest.approx(tops[-1])


def test_learning_raises_the_likelihood():
    pieces = Pieces(vocabulary(piece_path()))
    words = sorted(set(words_of("The cat sat on the mat while the other cats were sitting there, and then it sat again.")))
    counts = np.arange(1.0, len(words) + 1)
    totals = [float(counts @ word_scores(pieces, words, learned(pieces, words, counts, rounds)[:, None])[:, 0]) for rounds in (0, 1, 3, 6)]
    assert totals == sorted(totals)


def test_slices_cut_no_word(monkeypatch):
    monkeypatch.setattr("evenledger.llm.language.SLICE", 7)
    text = "ab cdé fghijklmnop. q " + "z" * 40 + " end"
    assert "".join(slices(text)) == text
    assert [w for part in slices(text) for w in words_of(part)] == words_of(text)


def test_odd_rows(spark):
    rng = random.Random(1)
    given = [(k, " ".join(rng.choice("uno dos tres casa gato".split() if k % 2 else "one two three house cat".split()) for _ in range(20)), "es" if k % 2 else "en", "", "") for k in range(40)]
    given += [(100, None, "en", "", ""), (101, "", None, "", ""), (102, "12 34 !?", "es", "", ""), (None, "casa gato dos", None, "", ""), (104, "TWO CATS", None, "", ""), (104, "TWO CATS", None, "", ""), (105, "gato " * 300_000, None, "", "")]
    docs = spark.createDataFrame(given, SCHEMA)
    model = fit(docs, piece_path(), F.lit(True))
    assert model[0] == ["en", "es"]
    got = identify(docs, model, piece_path()).collect()
    found = {(r.doc_id, r.lang_pred) for r in got}
    assert len(got) == len(given) and {(100, "und"), (101, "und"), (102, "und"), (None, "es"), (104, "en"), (105, "es")} <= found
    assert all((k, lang) in found for k, _, lang, _, _ in given[:40])
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.lang_pred != "und") for r in got)
    nothing = identify(docs, fit(docs, piece_path(), F.lit(False)), piece_path()).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert identify(docs.limit(0), model, piece_path()).collect() == []


@pytest.mark.parametrize("sf", ["0.01"])
def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    got = QUERIES["op12_unigrams"](spark, f"/root/testdata/sf{sf}").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
