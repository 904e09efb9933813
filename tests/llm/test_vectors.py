import numpy as np

from evenledger.llm.hnsw import near_duplicates
from evenledger.llm.queries import op1_hnsw, op7_forest

SCHEMA = "vec_id long, embedding array<float>, label int, v int, rep string"


def rows(n=600, seed=2):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 16)).astype(np.float32)
    base[100:200] = base[100] + rng.normal(size=(100, 16)) * 0.05
    base[200:260] = base[200]
    base[300:330] *= 5
    out = [(k, [float(x) for x in base[k]], k % 3, 0, "x") for k in range(n)]
    nan, inf = float("nan"), float("inf")
    return out + [(n, None, 0, 0, "x"), (n + 1, [], 0, 0, "x"), (n + 2, [0.0] * 16, 0, 0, "x"), (n + 3, [nan] * 16, 0, 0, "x"), (n + 4, [inf] + [1.0] * 15, 0, 0, "x"), (n + 5, [None] + [1.0] * 15, 0, 0, "x"), (n + 20, [1.0] * 3, 0, 0, "x")]


def exact_links(given, least=0.95):
    fine = {k: np.array(v, dtype=np.float64) for k, v, *_ in given if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = [k for k in fine if len(fine[k]) == 16]
    unit = np.stack([fine[k] / np.linalg.norm(fine[k]) for k in ids])
    near = unit @ unit.T >= least
    links = {k: set() for k, *_ in given}
    for i, k in enumerate(ids):
        links[k] = {ids[j] for j in np.flatnonzero(near[i])} - {k}
    return links


def test_links_and_components(spark):
    given = rows()
    links = exact_links(given)
    got = {r.vec_id: r for r in near_duplicates(spark.createDataFrame(given, SCHEMA).repartition(4)).collect()}
    assert set(got) == set(links)
    found = sum(r.n_links for r in got.values())
    assert all(got[k].n_links <= len(links[k]) for k in links) and found >= 0.99 * sum(map(len, links.values()))
    for k in links:
        seen, front = {k}, [k]
        while front:
            for other in links[front.pop()] - seen:
                seen.add(other)
                front.append(other)
        assert got[k].component_id == min(seen) and got[k].kept == (k == min(seen))


def test_search_recall_and_exact_scores(spark, tmp_path):
    given = rows(3000)
    spark.createDataFrame(given, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {}
    for r in op7_forest(spark, str(tmp_path)).collect():
        got.setdefault(r.query_id, []).append(r)
    fine = {k: np.array(v, dtype=np.float64) for k, v, *_ in given if v and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = np.array(sorted(fine))
    matrix = np.stack([fine[k] for k in ids])
    hit = total = 0
    assert set(got) == {k for k in fine if k % 20 == 0}
    for q, found in got.items():
        found.sort(key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, 21)) and q not in {r.vec_id for r in found}
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        for r in found:
            assert abs(r.score - fine[q] @ fine[r.vec_id]) < 1e-9
        score = matrix @ fine[q]
        order = [ids[i] for i in np.lexsort((ids, -np.round(score, 9))) if ids[i] != q][:20]
        hit += len(set(order) & {r.vec_id for r in found})
        total += 20
    assert hit / total >= 0.9


def test_recall_on_tables(spark):
    import pandas as pd

    table = pd.read_parquet("/root/testdata/sf0.1/embeddings.parquet")
    ids, v = table.vec_id.to_numpy(), np.stack(table.embedding.to_numpy()).astype(np.float64)
    got = {}
    for r in op7_forest(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = total = 0
    for q in ids[ids % 20 == 0]:
        score = v @ v[ids == q][0]
        score[ids == q] = -np.inf
        hit += len(got[q] & set(ids[np.argsort(-score)[:20]]))
        total += 20
    assert hit / total >= 0.9
    links = {r.vec_id: r.n_links for r in op1_hnsw(spark, "/root/testdata/sf0.1").collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    exact = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    assert sum(links.values()) >= 0.99 * exact.sum()


def test_few_rows(spark, tmp_path):
    few = [(0, [1.0, 0.0], 0, 0, "x"), (20, [0.5, 0.5], 0, 0, "x"), (3, None, 0, 0, "x")]
    for name, given in (("few", few), ("none", [])):
        spark.createDataFrame(given, SCHEMA).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
    got = op7_forest(spark, f"{tmp_path}/few").collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 20), (20, 1, 0)]
    assert len(op1_hnsw(spark, f"{tmp_path}/few").collect()) == 3
    assert op7_forest(spark, f"{tmp_path}/none").collect() == [] and op1_hnsw(spark, f"{tmp_path}/none").collect() == []


def test_search_recall_beyond_the_least_budget(spark, tmp_path):
    v = np.random.default_rng(5).normal(size=(12_000, 64)).astype(np.float32).astype(np.float64)
    spark.createDataFrame([(k, [float(x) for x in row], 0, 0, "x") for k, row in enumerate(v)], SCHEMA).repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {}
    for r in op7_forest(spark, str(tmp_path)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = total = 0
    for q in range(0, len(v), 20):
        score = v @ v[q]
        score[q] = -np.inf
        hit += len(got[q] & set(np.argsort(-score)[:20].tolist()))
        total += 20
    assert hit / total >= 0.9


def test_links_count_at_both_ends_beside_a_hot_group(spark):
    """Planted pairs just within the bound, a large group of near copies, repeated and null ids."""
    rng = np.random.default_rng(8)
    unit = rng.normal(size=(5000, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    side = rng.normal(size=(400, 32))
    side -= (side * unit[:400]).sum(axis=1, keepdims=True) * unit[:400]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.951, 0.975, size=(400, 1))
    pairs = cosine * unit[:400] + np.sqrt(1 - cosine**2) * side
    hot = unit[4999] + rng.normal(size=(2500, 32)) * 0.01
    every = np.concatenate([unit, pairs, hot])
    given = [(k, [float(x) for x in v], 0, 0, "x") for k, v in enumerate(every)]
    given += [(7, given[9][1], 0, 0, "x"), (None, given[3][1], 0, 0, "x"), (None, None, 0, 0, "x")]
    got = near_duplicates(spark.createDataFrame(given, SCHEMA.replace("float", "double")).repartition(4)).collect()
    assert len(got) == len(given)
    normal = every / np.linalg.norm(every, axis=1, keepdims=True)
    links = [set(np.flatnonzero(normal @ v >= 0.95).tolist()) - {k} for k, v in enumerate(normal)]
    by_id = {r.vec_id: r for r in got if r.vec_id is not None and r.vec_id != 7}
    wrong = {k: (r.n_links, len(links[k])) for k, r in by_id.items() if r.n_links != len(links[k]) + (9 in links[k] | {k})}
    assert not wrong
    assert sum(r.n_links for r in by_id.values()) > 2500 * 2499
    assert sorted(r.n_links for r in got if r.vec_id == 7) == sorted([len(links[7]), len(links[9]) + 1])
    assert all(r.n_links == 0 and r.component_id is None and r.kept is None for r in got if r.vec_id is None)
    assert {by_id[k].component_id for k in range(5400, len(every))} == {4999}


def test_search_among_vectors_of_one_length(spark, tmp_path):
    rng = np.random.default_rng(3)
    given = [(k, [float(x) for x in rng.normal(size=8 if k % 4 else 5)], 0, 0, "x") for k in range(200)] + [(400, [1.0, 2.0], 0, 0, "x"), (None, [0.5] * 8, 0, 0, "x")]
    spark.createDataFrame(given, SCHEMA.replace("float", "double")).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {}
    for r in op7_forest(spark, str(tmp_path)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    fine = {k: np.array(v) for k, v, *_ in given if k is not None}
    assert set(got) == {k for k in range(0, 200, 20)}
    for q, found in got.items():
        want = sorted(((float(fine[q] @ v), k) for k, v in fine.items() if k != q and len(v) == len(fine[q])), key=lambda x: (-x[0], x[1]))[:20]
        assert [k for _, k, _ in sorted(found)] == [k for _, k in want]


def test_search_moves_each_vector_once(spark, monkeypatch):
    """A vector is not repeated for each tree, nor a query for each leaf."""
    from evenledger.llm.forest import nearest

    frame, made = type(spark.range(0)), {}
    step = frame.mapInArrow

    def counted(self, fn, schema, *more, **options):
        out = step(self, fn, schema, *more, **options)
        if "v" in out.columns and "query" not in out.columns:
            made[schema] = max(made.get(schema, 0), out.count())
        return out

    monkeypatch.setattr(frame, "mapInArrow", counted)
    rng = np.random.default_rng(4)
    given = [(k, [float(x) for x in rng.normal(size=12)]) for k in range(1500)]
    got = {}
    for r in nearest(spark.createDataFrame(given, "vec_id long, embedding array<double>").repartition(3), 'vec_id % 20 = 0', k=5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert made and max(made.values()) <= len(given)
    v = np.array([x for _, x in given])
    assert set(got) == set(range(0, 1500, 20))
    for q, found in got.items():
        want = sorted((-s, k) for k, s in enumerate((v @ v[q]).tolist()) if k != q)[:5]
        assert [k for _, k, _ in sorted(found)] == [k for _, k in want] and np.allclose([s for _, _, s in sorted(found)], [-s for s, _ in want], rtol=0, atol=1e-12)


def test_links_of_shards_in_pieces(spark, monkeypatch):
    """A graph of more nodes than a row may hold, searched by some shards at a time."""
    from evenledger.llm import hnsw

    rows, save = {}, hnsw.saved

    def seen(df, name):
        out = save(df, name)
        if name == "graphs":
            rows["nodes"] = [r.n for r in out.selectExpr("size(ids) AS n").collect()]
        rows[name] = rows.get(name, 0) + 1
        return out

    monkeypatch.setattr(hnsw, "saved", seen)
    monkeypatch.setattr(hnsw, "MEETS", 30_000, raising=False)
    rng = np.random.default_rng(6)
    unit = rng.normal(size=(6500, 24))
    every = np.concatenate([unit, unit + rng.normal(size=unit.shape) * 0.1])
    got = {r.vec_id: r for r in near_duplicates(spark.createDataFrame([(k, [float(x) for x in v], 0, 0, "x") for k, v in enumerate(every)], SCHEMA.replace("float", "double")).repartition(4)).collect()}
    assert sum(rows["nodes"]) == len(every) and max(rows["nodes"]) <= 2048 and rows["links"] == 3
    normal = every / np.linalg.norm(every, axis=1, keepdims=True)
    exact = (normal @ normal.T >= 0.95).sum(axis=1) - 1
    links = np.array([got[k].n_links for k in range(len(every))])
    assert (links <= exact).all() and links.sum() >= 0.99 * exact.sum() and exact.sum() > 10_000
