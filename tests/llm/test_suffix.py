import hashlib
import random

from evenledger.llm import suffix
from evenledger.llm.queries import op8_suffix

SCHEMA = "doc_id long, text string, spans int, bucket string"


def brute(texts, length):
    """text -> set of removed bytes."""
    seen = {}
    for key, text in texts.items():
        raw = (text or "").encode()
        for at in range(len(raw) - length + 1):
            seen.setdefault(raw[at : at + length], []).append((key, at))
    gone = {key: set() for key in texts}
    for places in seen.values():
        if len(places) > 1:
            for key, at in places:
                gone[key].update(range(at, at + length))
    return gone


def made(seed, length):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 5)))
    passages = [" ".join(word() for _ in range(rng.randint(5, 60))) for _ in range(6)]
    texts = {1: None, 2: "", 3: "short", 4: "x" * (length * 3), 5: "ab" * length, 6: passages[0], 7: passages[0]}
    for k in range(8, 60):
        parts = []
        for _ in range(rng.randint(1, 6)):
            parts.append(rng.choice(passages) if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randint(1, 30))))
        text = " ".join(parts)
        if rng.random() < 0.3:
            at = rng.randrange(len(text))
            text = text[:at] + "#" + text[at + 1 :]
        texts[k] = text
    return texts


def check(spark, texts, length):
    docs = spark.createDataFrame([(k, v, 0, "x") for k, v in texts.items()], SCHEMA).repartition(5)
    got = {r.doc_id: r for r in suffix.remove_repeats(docs, length).collect()}
    assert set(got) == set(texts)
    gone = brute(texts, length)
    for key, text in texts.items():
        raw = (text or "").encode()
        assert got[key].n_removed == len(gone[key]), key
        if text and text.isascii():
            assert got[key].text == "".join(c for i, c in enumerate(text) if i not in gone[key])
        assert len(got[key].text.encode()) >= len(raw) - len(gone[key])


def test_against_brute_force(spark):
    check(spark, made(1, 40), 40)
    check(spark, made(2, 24), 24)


def test_long_texts_over_slices(spark, monkeypatch):
    monkeypatch.setattr(suffix, "STEP_BYTES", 64)
    texts = made(3, 30)
    rows = [(k, v or "") for k, v in texts.items()]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows]), pa.array([v for _, v in rows])], names=["doc_id", "text"])
    found = {}
    for part in suffix.run_batches([batch], 30):
        for r in part.to_pylist():
            found.setdefault(r["doc_id"], []).extend(range(r["start"], r["start"] + r["n"]))
    for k, v in rows:
        assert sorted(found.get(k, [])) == list(range(max(0, len(v.encode()) - 29)))


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert suffix.remove_repeats(docs, 40).collect() == []


def test_query_digest(spark, tmp_path):
    texts = {1: "a" * 500, 2: "b" * 300, 3: None, 4: "é" * 150 + "q" * 399, 5: "q" * 399}
    spark.createDataFrame([(k, v) for k, v in texts.items()], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op8_suffix(spark, str(tmp_path)).collect()}
    gone = brute(texts, 400)
    for key, text in texts.items():
        raw = (text or "").encode()
        left = bytes(b for i, b in enumerate(raw) if i not in gone[key])
        assert got[key].n_bytes == len(raw) and got[key].n_removed == len(gone[key])
        assert got[key].kept_sha256 == hashlib.sha256(left).hexdigest()
    assert got[1].n_spans == 1 and got[2].n_spans == 0


def test_null_and_repeated_keys(spark, tmp_path):
    from evenledger.llm.queries import op8_suffix

    same, other = "x1 " + "abcdefg hij " * 50, "Q" + "zyxwvut srq" * 60
    rows = [(1, same), (1, other), (None, same), (None, None), (2, "short"), (3, other + "!")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.text) for r in op8_suffix(spark, str(tmp_path)).collect())
    assert got == sorted([(1, len(same), len(same), ""), (1, len(other), len(other), ""), (0, len(same), len(same), ""), (0, 0, 0, ""), (2, 5, 0, "short"), (3, len(other) + 1, len(other), "!")])
