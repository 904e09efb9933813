import math
import re
import zlib
from collections import Counter

from evenledger.llm.queries import op6_mixing

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(texts):
    tokens = {k: [w.translate(LOWER) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + [""] for k, t in texts.items()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    counts = Counter(w for k in texts if not held[k] for w in tokens[k])
    total = sum(counts.values())
    return {
        k: (held[k], len(ws), sum(counts[w] > 0 for w in ws), total, sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in ws))
        for k, ws in tokens.items()
    }


def agree(spark, tmp_path, texts):
    rows = [(k, v, "x", 1.0) for k, v in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, word string, score double").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op6_mixing(spark, str(tmp_path)).collect()}
    want = by_hand(texts)
    assert set(got) == set(want)
    for k, (held, n, known, total, base) in want.items():
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert abs(r.base_score - base) < 1e-6 and r.score < 0
    return got


def test_counts_and_base(spark, tmp_path):
    texts = {1: None, 2: "", 3: " \n\t", 4: "Ünder UNDER under", 5: "a" * 5000, 6: "x " * 3000}
    texts |= {k: "the cat sat, on the mat. a dog" if k % 3 else f"le chat {k} noir et le chien" for k in range(7, 80)}
    got = agree(spark, tmp_path, texts)
    held = [r for k, r in got.items() if r.held_out and k > 6]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_empty_table(spark, tmp_path):
    assert agree(spark, tmp_path, {}) == {}


def test_scores_are_a_distribution(spark, tmp_path, monkeypatch):
    """In every state the chances of all words and of an unknown one add up to one."""
    from evenledger.llm import mixing

    tables, real = [], mixing.learned
    monkeypatch.setattr(mixing, "learned", lambda *a: tables.append(real(*a)) or tables[-1])
    texts = {k: f"the cat {k % 9}, sat on. the mat" if k % 4 else "le chat noir et le chien, et le rat" for k in range(1, 60)}
    agree(spark, tmp_path, texts)
    chances = (10.0 ** tables[0].astype(float)).sum(axis=1)
    assert tables[0].shape[0] == mixing.STATES and abs(chances - 1).max() < 1e-4


def test_repeated_and_null_keys(spark, tmp_path):
    texts = {k: "the cat sat on the mat" if k % 3 else f"rare{k} words here" for k in range(1, 40)}
    more = [(3, texts[3], "x", 1.0), (5, "another rareword text", "x", 1.0), (None, "the cat", "x", 1.0)]
    spark.createDataFrame([*((k, v, "x", 1.0) for k, v in texts.items()), *more], "doc_id long, text string, word string, score double").write.parquet(f"{tmp_path}/documents.parquet")
    got = op6_mixing(spark, str(tmp_path)).collect()
    assert len(got) == len(texts) + 3
    twice = [r for r in got if r.doc_id == 3]
    assert twice[0] == twice[1] and len({r.n_tokens for r in got if r.doc_id == 5}) == 2
    assert [(r.held_out, r.n_tokens) for r in got if r.doc_id is None] == [(None, 3)]


def test_contexts_are_the_preceding_words():
    """Two tokens have the same contexts where the one or two words before them are the same, however rare these are."""
    import numpy as np
    import pyarrow as pa

    from evenledger.llm.mixing import WORD_CONTEXTS, tokens

    texts = ["Zorn apfel birne, zorn apfel", "", "quitte zorn apfel birne", None, "apfel birne"]
    head = {"leaf_hashes": np.array([1], dtype=np.uint64), "leaves": np.array([0]), "other": 0}
    row, own, _, _, contexts = tokens(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]), head)
    listed = []
    for t in texts:
        ws = [w.translate(LOWER) for w in (t or "").split()]
        listed += [tuple(["", "", *ws][i : i + 2]) for i in range(len(ws) + 1)]
    assert contexts.shape == (WORD_CONTEXTS, len(own)) and len(listed) == len(own) == len(row)
    for k in range(WORD_CONTEXTS):
        seen = {}
        for words_before, context in zip(listed, contexts[k].tolist()):
            assert seen.setdefault(words_before[1 - k :], context) == context
        assert len(set(seen.values())) == len(seen)


def test_rare_preceding_words_predict(spark, tmp_path):
    """Which word comes after each of 300 equally frequent words is learned, not only after the most frequent ones."""
    import random

    draw = random.Random(5)
    texts = {k: " ".join(f"a{i} b{i}" for i in (draw.randrange(300) for _ in range(60))) for k in range(1, 400)}
    got = agree(spark, tmp_path, texts)
    held = [r for r in got.values() if r.held_out]
    bits = -sum(r.score for r in held) * math.log2(10) / sum(r.n_tokens for r in held)
    assert bits < 5.5  # a word that nothing tells has 8.2 bits, half of the words follow from the other half


def test_words_after_any_words_are_a_distribution(spark, tmp_path, monkeypatch):
    import numpy as np

    from evenledger.llm import mixing

    layers, real = [], mixing.learned_words
    monkeypatch.setattr(mixing, "learned_words", lambda *a: layers.append(real(*a)) or layers[-1])
    texts = {k: f"the cat {k % 9}, sat on. the mat" if k % 4 else "le chat noir et le chien, et le rat" for k in range(1, 60)}
    agree(spark, tmp_path, texts)
    leaves = len(layers[0]["paths"]["lengths"])
    for context in (mixing.preceding(np.array([7, 9, 0], dtype=np.uint64), np.array([0]))[:, 2:], np.zeros((2, 1), np.uint64)):
        scores = mixing.word_scores(layers[0], np.arange(leaves), np.full(leaves, 5), np.repeat(context, leaves, axis=1))
        assert abs((10.0**scores).sum() - 1) < 1e-4


def learned_model(rng, leaves):
    """A first layer with made-up counts."""
    import numpy as np

    from evenledger.llm import mixing

    tree = mixing.huffman(rng.integers(1, 1000, leaves).tolist())
    zero, one = rng.integers(0, 50, (2, 1 << mixing.SLOT_BITS)).astype(np.int32)
    return {"tree": tree, "zero": zero, "one": one, "weights": mixing.first_weights(), "cells": rng.random(mixing.GATES * mixing.BINS)}


def test_first_layer_works_a_decision_out_once_a_state(monkeypatch):
    """A leaf's score is the sum over its own path, though its decisions are shared with other leaves."""
    import numpy as np
    import pyarrow as pa

    from evenledger.llm import mixing

    model, leaves = learned_model(np.random.default_rng(3), 300), 300
    worked, real = [], mixing.stretched
    monkeypatch.setattr(mixing, "stretched", lambda m, slots, *a: worked.append(slots.shape[1]) or real(m, slots, *a))
    sent = type("Sent", (), {"value": model})
    rows = [r for b in mixing.leaf_scores([pa.RecordBatch.from_arrays([pa.array([0, 7, 194])], names=["id"])], sent) for r in b.to_pylist()]
    assert worked == [leaves - 1] * 3
    for row in rows:
        batch = pa.RecordBatch.from_arrays([pa.array(np.full(leaves, row["state"])), pa.array(np.arange(leaves))], names=["state", "leaf"])
        slots, bits, owner = mixing.decisions(batch, model["tree"])
        odds, gate = real(model, slots)
        x = mixing.mixed(model["weights"], odds, gate)
        low, share = mixing.bin_of(x)
        refined = (1 - share) * model["cells"][gate * mixing.BINS + low] + share * model["cells"][gate * mixing.BINS + low + 1]
        p = np.clip((mixing.squash(x) + refined) / 2, 1e-6, 1 - 1e-6)
        want = np.bincount(owner, weights=np.log10(np.where(bits == 1, p, 1 - p)))
        assert np.allclose(np.frombuffer(row["scores"], np.float32), want, rtol=1e-6)


def test_buckets_hold_the_slots_of_single_decisions():
    """What is read bucket by bucket, words together, is what each token's own path names."""
    import numpy as np

    from evenledger.llm import mixing

    rng = np.random.default_rng(4)
    tree, bits = mixing.huffman(rng.integers(1, 1000, 200).tolist()), 16
    lengths, nodes, sides = tree
    paths, odds = mixing.word_paths(tree, bits), rng.random((199, mixing.STATES)).astype(np.float32)
    leaf, state, contexts = rng.integers(0, 200, 500), rng.integers(0, mixing.STATES, 500), rng.integers(0, 2**63, (2, 500)).astype(np.uint64)
    order, got = mixing.deepest_first(paths, leaf), {}
    found = mixing.word_decisions(paths, odds, leaf[order], state[order], contexts[:, order], mixing.first_slots)
    for depth, (buckets, place, bit, first) in enumerate(found):
        for i, (a, b, x, at) in enumerate(zip(buckets[0] | place, buckets[1] | place, bit, first)):
            got[order[i], depth] = (int(a), int(b), int(x), float(at))
    assert len(got) == lengths[leaf].sum() and all(0 <= v < 1 << bits for a, b, *_ in got.values() for v in (a, b))
    for (token, depth), (a, b, x, at) in got.items():
        node = nodes[leaf[token], depth]
        assert x == sides[leaf[token], depth] and at == float(odds[int(node), state[token]])
    again = {}
    for (token, depth), (a, b, *_) in got.items():
        assert again.setdefault((int(nodes[leaf[token], depth]), int(contexts[0, token])), a) == a


def test_packed_counts_come_back_whole():
    import numpy as np

    from evenledger.llm import mixing

    few = np.arange(2 * mixing.WORD_BLOCK, dtype=np.uint32) % 256
    for counts in (few, few + np.uint32(2**31)):
        assert (mixing.counts_of(mixing.packed_counts(counts)) == counts).all()
