import random

import corpus_pipeline
from evenledger.llm.suffix import cut_texts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def made():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = prose(70)
    rows, labels = [], []
    for k in range(700):
        text = prose(rng.randint(20, 120))
        toxic = k % 4 == 0
        if toxic:
            text += " zorgle quaxit" + " zorgle" * (k % 3)
        if k % 10 == 1:
            text += "\nPowered by the site"
        rows.append((k, text, "en", "s0", len(text)))
        labels.append((k, 1, int(toxic)))
    copied = prose(100)
    for k, text in enumerate([copied, copied, copied + " " + prose(2), prose(40) + " " + passage, passage + " " + prose(50), "", None], start=1000):
        rows.append((k, text, None, None, len(text or "")))
    return rows, labels, passage


def test_every_stage_takes_effect(spark, tmp_path):
    rows, labels, passage = made()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.saved(stage(spark, docs, str(tmp_path)), name)
        seen[name] = {r.doc_id: r for r in docs.collect()} if name != "packing" else docs.collect()
        if name != "packing":
            assert docs.columns == COLUMNS
            assert all(r.n_chars == len(r.text) for r in seen[name].values() if r.text is not None and name != "toxicity")
    clean = {k for k, _, toxic in labels if not toxic}
    left = set(seen["toxicity"])
    assert len(clean - left) <= 0.03 * len(clean) and len({k for k, _, t in labels if t} & left) <= 3
    assert {1000, 1001, 1002, 1003, 1004, 1005, 1006} <= left
    lines = seen["line_dedup"]
    assert set(lines) == left and not any("Powered by" in (r.text or "") for r in lines.values())
    near = seen["near_dedup"]
    assert 1000 in near and 1001 not in near and 1002 not in near and len(near) == len(lines) - 2
    cut = seen["passage_dedup"]
    assert set(cut) == set(near) and passage not in cut[1003].text + cut[1004].text
    assert cut[1000].text == rows[700][1]
    assert {r.doc_id for r in seen["packing"]} == set(cut)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen["packing"])


def test_cut_keeps_other_columns(spark):
    docs = spark.createDataFrame([(1, "q" * 60, 5, "a"), (2, None, 6, "b")], "doc_id long, text string, spans int, _key string")
    got = {r.doc_id: r for r in cut_texts(docs, 50).collect()}
    assert got[1].text == "" and got[2].text is None and (got[1].spans, got[2]["_key"]) == (5, "b")


def stages(spark, docs, names):
    for name, stage in corpus_pipeline.STAGES:
        if name in names:
            docs = corpus_pipeline.saved(stage(spark, docs, ""), name)
    return docs


def test_one_copy_of_a_third_of_a_source_stays(spark):
    copied = "\n".join(f"line {k} of the copied text has words {k} {k + 1} {k + 2}" for k in range(6))
    given = [(k, copied, "en", "s0", len(copied)) for k in range(100)] + [(k, f"own words of document {k} alone", "en", "s0", 20) for k in range(100, 300)]
    left = {r.doc_id: r.text for r in stages(spark, spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long"), ("line_dedup", "near_dedup")).collect()}
    assert left[0] == copied and set(left) == {0, *range(100, 300)}


def test_null_and_repeated_ids(spark):
    prose = lambda k: " ".join(f"w{k}x{i}" for i in range(80))
    given = [(None, prose(1), "en", "a", 0), (None, prose(2), "en", "a", 0), (3, prose(3), "en", "a", 0), (3, prose(3), "en", "a", 0), (None, prose(4), "en", "b", 0), (4, prose(4), "en", "b", 0)]
    given += [(5, prose(5), "en", "b", 0), (5, prose(6), "en", "b", 0)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    left = stages(spark, docs, ("line_dedup", "near_dedup", "passage_dedup"))
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted([(0, prose(1)), (0, prose(2)), (3, prose(3)), (4, prose(4)), (5, prose(5)), (5, prose(6))])
    packed = stages(spark, left, ("packing",)).where("piece = 0")
    assert sorted(r.doc_id or 0 for r in packed.collect()) == [0, 0, 3, 4, 5, 5]
