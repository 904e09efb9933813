import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from evenledger.llm.packing import cut, plan
from evenledger.llm.queries import op5_packing, tokenizer_path


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=20))
def test_plan_places_every_piece_once(histogram):
    placed = {}
    for copies, content in plan(histogram, 50):
        assert copies > 0 and sum(length * n for length, n in content) <= 50
        for length, n in content:
            placed[length] = placed.get(length, 0) + copies * n
    assert placed == histogram


def test_plan_is_near_the_least():
    rng = np.random.default_rng(0)
    for draw in (rng.integers(1, 2049, 20_000), rng.integers(1, 500, 20_000), rng.integers(600, 760, 20_000)):
        histogram = {int(a): int(b) for a, b in zip(*np.unique(draw, return_counts=True))}
        least = -(-int(draw.sum()) // 2048)
        assert sum(n for n, _ in plan(histogram, 2048)) <= least * 1.01


def test_only_the_first_piece_is_shorter():
    assert cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)]
    assert cut(4096, 2048) == [(0, 2048), (2048, 2048)] and cut(1, 2048) == [(0, 1)]


def test_query(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    texts = [None, "", "a b c", "a b c", *("word " * n for n in range(1, 400)), "long text " * 6000]
    rows = [(k, t, "x", 7) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, piece string, length int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = op5_packing(spark, str(tmp_path)).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    for k, text, *_ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        pieces = sorted(by_doc[k], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert [(p.start, p.length) for p in pieces] == cut(len(ids), 2048)
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // 2048) * 1.02 + 1


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op5_packing(spark, str(tmp_path)).collect() == []
