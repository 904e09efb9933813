import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from evenledger.llm import bpe
from evenledger.llm.queries import op10_bpe, tokenizer_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def vocab():
    return bpe.load(tokenizer_path())


def texts(seed=1, n=300):
    rng = random.Random(seed)
    out = ["", "'s", "don't you'll ''s 's's 'sabc", "  ' 's", "\n's", "a  b   \n\n c \t", "a<|endoftext|>b 's<|endoftext|>'s"]
    out += ["aaaa" * 500, "é" * 300, "日本語" * 200, "१२३४½²ↁ", "!" * 1000 + "a", "'" * 501, "\x85 \x1c 　x", " a" * 300 + "     "]
    alphabet = "ab'st  \n.1é日<|>ol "
    out += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    out += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(50, 3000))) for _ in range(10)]
    return out


def test_same_ids_as_the_library(library, vocab):
    given = texts()
    buf, offsets = bpe.buffer_of(pa.array(given, pa.string()))
    tokens, bounds = bpe.encode_buffer(vocab, buf, offsets)
    for text, a, b in zip(given, bounds[:-1], bounds[1:]):
        want = library.encode(text, add_special_tokens=False).ids
        assert tokens[a:b].tolist() == want, text[:80]
        assert bpe.decoded(vocab, tokens[a:b]).decode() == library.decode(want, skip_special_tokens=False)


def test_joins_of_unsplit_text(library, vocab):
    rng = random.Random(5)
    for alphabet in ("ab", "etaoin", "日本語", "=-"):
        text = "".join(rng.choice(alphabet) for _ in range(5000))
        piece = np.frombuffer(text.encode(), dtype=np.uint8)
        assert bpe.encode_long(vocab, piece).tolist() == library.encode(text, add_special_tokens=False).ids


def test_segments_of_long_texts(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "SEGMENT_BYTES", 256)
    rng = random.Random(9)
    long = ["".join(rng.choice("abcde") for _ in range(4000)), " " * 3000 + "x", "word 's don't " * 200, "x" * 700 + "'s <|endoftext|> " * 80]
    long += ["".join(rng.choice("ab'st  \n.1é日<|>ol") for _ in range(3000)) for _ in range(5)]
    vocab = bpe.load(tokenizer_path())
    for text in long:
        buf = np.frombuffer(text.encode(), dtype=np.uint8)
        cut = bpe.segments(vocab, buf)
        assert [a for a, _, _ in cut] == [0, *(b for _, b, _ in cut[:-1])] and cut[-1][1] == len(buf) and len(cut) > 1

        class Sent:
            value = vocab

        rows = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["doc_id", "text"])
        parts = list(bpe.part_batches(bpe.segment_batches([rows], Sent), Sent))
        listed = [{"part": r["part"], "joined": r["joined"], "ids": r["ids"]} for p in parts for r in p.to_pylist()]
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([listed])], names=["doc_id", "parts"])
        (found,) = bpe.joined_batches([batch], Sent, bpe.text_digest)
        assert found.column("ids")[0].as_py() == library.encode(text, add_special_tokens=False).ids, text[:50]


def test_query(spark, library, tmp_path):
    rows = [(k, t, "x") for k, t in enumerate([None, *texts(2, 40), "word " * 300_000, "ab" * 600_000])]
    spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op10_bpe(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for k, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(docs, tokenizer_path(), bpe.text_digest, "doc_id long, ids array<int>").collect() == []


def test_long_texts_with_null_or_repeated_keys(spark):
    texts = [(None, "some words " * 40), (None, "other words " * 50), (7, "more words " * 60), (7, "few words " * 45)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    schema = "doc_id long, ids array<int>"
    got = [sorted((r.doc_id or 0, r.ids) for r in bpe.encode(docs, tokenizer_path(), bpe.text_digest, schema, long_bytes=n).collect()) for n in (100, 10_000)]
    assert len(got[0]) == 4 and got[0] == got[1]
