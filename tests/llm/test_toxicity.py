import random
import zlib

import numpy as np
import pyarrow as pa

from evenledger.llm import toxicity
from evenledger.llm.queries import op3_bigru


def made(n, seed=3):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    bad = ["zorgle", "quaxit", "xyloth"]
    rows = []
    for k in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 250))]
        toxic = int(rng.random() < 0.4)
        if toxic:
            for _ in range(1 + len(words) // 40):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "s", "ed"]))
        rows.append((k, " ".join(words), toxic))
    return rows


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    model = {k: v.astype(np.float64) for k, v in toxicity.start(2).items()}
    found = toxicity.Words(pa.array(["one two three, four", "five two six", "seven"]))
    _, first, count = found.windows()
    label = np.array([1.0, 0.0, 1.0])
    _, grad = toxicity.gradients(model, found, first, count, label)
    for name in ("out", "attend", "attend_out", "re0", "re1", "in0", "b1"):
        at = tuple(rng.integers(0, s) for s in model[name].shape)
        old = model[name][at]
        loss = []
        for move in (1e-4, -1e-4):
            model[name][at] = old + move
            loss.append(toxicity.gradients(model, found, first, count, label)[0])
        model[name][at] = old
        assert abs((loss[0] - loss[1]) / 2e-4 - grad[name][at]) < 2e-3, name


def test_held_out_accuracy(spark, tmp_path):
    rows = made(700)
    docs = [(k, t, "en", 0.5) for k, t, _ in rows] + [(900, None, "en", 0.1), (901, "", "en", 0.1), (902, " ., ", "en", 0.1), (903, "ab " * 30_000 + "zorgle", "en", 0.1)]
    spark.createDataFrame(docs, "doc_id long, text string, label string, score double").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, 1, x) for k, _, x in rows] + [(5, 0, rows[5][2]), (900, 0, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in op3_bigru(spark, str(tmp_path)).collect()}
    assert len(got) == 704
    held = [(got[k].predicted, x) for k, _, x in rows if got[k].held_out]
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k in got)
    assert np.mean([p == x for p, x in held]) > 0.9
    assert got[900].score == got[901].score == got[902].score == 0 and got[903].predicted == 1
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_without_labels(spark, tmp_path):
    spark.createDataFrame([(1, "a b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert len(op3_bigru(spark, str(tmp_path)).collect()) == 1
