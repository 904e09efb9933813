"""Runs against all lags of all words, one by one."""

import hashlib
import random
import zlib

import numpy as np

from evenledger.llm.queries import QUERIES, repeat_tail
from evenledger.llm.runs import WORD, periodic_runs, runs_of

SCHEMA = "doc_id long, text string, runs string, collapsed string"


def by_hand(words, least=12):
    n, spans = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            e = i
            while e < n - q and words[e] == words[e + q]:
                e += 1
            if e > i and e - i + q >= max(least, 2 * q):
                spans.setdefault((i, e + q), q)
            i = max(e, i) + 1
    return sorted((s, e - s, q) for (s, e), q in spans.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts():
    rng = random.Random(3)
    made = ["", " \t\n", "one", "a " * 5000, "a b " * 700, " ".join("ab"[bin(k).count("1") % 2] for k in range(600))]
    for k in range(60):
        words = [rng.choice("abc"[: 1 + k % 3]) for _ in range(rng.randrange(1, 90))]
        for _ in range(rng.randrange(4)):
            at, size = rng.randrange(len(words)), rng.randrange(1, 40)
            words[at:at] = words[at : at + size] * rng.randrange(1, 6)
        made.append(" ".join(words))
    long = [str(k) for k in range(300)]
    return [*made, " ".join(long * 3 + long[:7]), " ".join(["x", *long, *long, "y", *["z"] * 12, "q"])]


def test_all_small_words():
    for n in range(10, 17):
        for code in range(0, 2**n, 7):
            words = np.array([code >> k & 1 for k in range(n)])
            assert runs_of(words, np.zeros(n, dtype=int), 6).tolist() == [list(r) for r in by_hand(words.tolist(), 6)], words


def test_against_brute_force(spark):
    given = [(k, t, "clash", "clash") for k, t in enumerate(texts())] + [(None, None, "", ""), (3, "a " * 5000, "", "")]
    got = periodic_runs(spark.createDataFrame(given, SCHEMA)).collect()
    assert len(got) == len(given) and sum(r.doc_id == 3 for r in got) == 2
    for row in got:
        words = WORD.findall(given[row.doc_id][1] if row.doc_id is not None else "")
        runs = by_hand(words)
        assert [tuple(r) for r in row.runs] == runs and row.n_words == len(words)
        assert row.collapsed == collapsed(words, runs)
    assert periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_word_repeated_is_no_pair_of_all():
    words = np.zeros(300_000, dtype=int)
    assert runs_of(words, words).tolist() == [[0, 300_000, 1]]


def test_query(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = spark.createDataFrame([(10**6 + k, t, None, None, 0) for k, t in enumerate(texts())] + [(10**7, None, None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.select(*more.columns).unionByName(more).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op11_diagonals"](spark, str(tmp_path)).collect()}
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()}
    assert got.keys() == given.keys()
    hit = 0
    for key, text in given.items():
        words = WORD.findall(text or "")
        h = zlib.crc32(str(key).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            assert repeat_tail(key, WORD.findall(text)) == words
        if len(words) > 3000:
            continue
        runs, row = by_hand(words), got[key]
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        hit += bool(runs)
        assert row.n_runs == len(runs) and (row.start, row.length, row.period) == best
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert hit > 20
