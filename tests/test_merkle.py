"""Merkle trees of results: roots, leaves that differ, rows that differ."""

import hashlib

from pyspark.sql import functions as F

from evenledger.operators import merkle as mk
from evenledger.operators.results import result_fingerprint, result_hash, summarize_result

SCHEMA = "k long, v string, g string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def root_by_hand(cells, signature, paths=None, branch=3, leaf=6):
    """The root of canonical rows, level by level."""
    found = {}
    for i, cell in enumerate(cells):
        d = sha(cell)
        key = (paths[i] if paths else d, d)
        found[key] = found.get(key, 0) + 1
    nodes = {}
    for (path, d), n in found.items():
        nodes.setdefault(path[:leaf], []).append((f"{path}:{d}:{n}", n))
    for digits in (branch, 0):
        up = {}
        for name, parts in nodes.items():
            n = sum(c for _, c in parts)
            up.setdefault(name[:digits], []).append((f"{name}:{n}:" + sha("\n".join(sorted(p for p, _ in parts))), n))
        nodes = up
    parts = nodes.get("", [])
    return sha(f"{signature}\n{len(cells)}\n" + sha("\n".join(sorted(p for p, _ in parts))))


def test_root_by_hand(spark):
    rows = [(k % 40, f"t{k % 7}", "x") for k in range(300)] + [(None, None, None)] * 3
    df = frame(spark, rows)
    cells = ["\x1f".join("NULL" if c is None else f"NUM:{c}" if i == 0 else f"TEXT:{c}" for i, c in enumerate(r)) for r in rows]
    signature = "K:NUMBER|V:STRING|G:STRING"
    got = mk.result_root(df).first()
    assert (got.rowCount, got.resultHash) == (303, root_by_hand(cells, signature))
    assert mk.result_root(df.repartition(7, "v")).first() == got
    at = df.coalesce(1).withColumn("at", F.monotonically_increasing_id())
    paths = [f"{i:016X}" for i in range(len(rows))]
    assert mk.result_root(at, at="at").first().resultHash == root_by_hand(cells, signature, paths, 10, 13)


def test_what_changes_the_root(spark):
    base = [(1, "a", "x"), (2, "b", "x"), (2, "b", "x")]
    root = lambda rows, **o: result_hash(frame(spark, rows), **o).first().resultHash
    assert root(base) == root(base[::-1]) != root(base[:2])
    assert root(base) != result_hash(frame(spark, base).withColumnRenamed("v", "w")).first().resultHash
    assert root(base, ordered_by=["k"]) == root(base[::-1], ordered_by=["k"]) != root(base)
    delivered = [summarize_result(frame(spark, rows).coalesce(1), as_delivered=True, method="tree").first().resultHash for rows in (base, base[::-1])]
    assert delivered[0] != delivered[1]
    empty = summarize_result(frame(spark, []), method="tree").first()
    assert (empty.status, empty.rowCount) == ("SUCCESS", 0) and empty.resultHash == root([])


def test_groups_with_null_keys(spark):
    df = frame(spark, [(1, "a", None), (2, "b", None), (1, "a", "x"), (2, "b", "x"), (3, "c", "y")])
    for options in ({}, {"max_rows": 10}, {"max_rows": 10, "min_rows": 1}):
        got = {r.g: (r.rowCount, r.resultHash) for r in result_hash(df, ["g"], **options).collect()}
        assert got[None] == got["x"] and got[None][0] == 2 and got["y"][0] == 1 and len({h for _, h in got.values()}) == 2
    capped = {r.g: (r.rowCount, r.resultHash) for r in result_hash(df, ["g"], max_rows=1, min_rows=1).collect()}
    assert capped[None] == capped["x"] == (2, None) and capped["y"][1]


def test_only_differing_branches_are_opened(spark):
    a = spark.range(20000).select("id", (F.col("id") % 5).alias("v"))
    b = a.where("id <> 77").withColumn("v", F.when(F.col("id") == 4321, 9).otherwise(F.col("v")))
    leaves = [mk.tree_leaves(mk.tree_rows(side)).cache() for side in (a, b)]
    bad = mk.differing_leaves(*leaves)
    assert bad.count() == 3  # the row that is gone, the old and the new form of the changed one
    tops = bad.select(F.substring("branch", 1, 3)).distinct().count()
    assert tops <= 3 and mk.tree_branches(leaves[0]).count() > 3000
    assert mk.differing_leaves(leaves[0], leaves[0]).count() == 0
    found = {(r.id, r.kind) for r in mk.tree_diff(a, b, keys=["id"]).collect()}
    assert found == {(77, "ONLY_A"), (4321, "CHANGED")}
    for side in leaves:
        side.unpersist()


def test_diff_counts_copies_and_null_keys(spark):
    a = frame(spark, [(None, "a", "x"), (1, "b", "x"), (1, "b", "x"), (2, "c", None)])
    b = frame(spark, [(None, "z", "x"), (1, "b", "x"), (3, "c", None)])
    found = {(r.g, r.k, r.kind, r.aCopies, r.bCopies) for r in mk.tree_diff(a, b, by=["g"], keys=["k"]).collect()}
    assert found == {("x", None, "CHANGED", 1, 1), ("x", 1, "ONLY_A", 2, 1), (None, 2, "ONLY_A", 1, 0), (None, 3, "ONLY_B", 0, 1)}
    alone = mk.tree_diff(a, b).collect()
    assert sorted((r.kind, r.aRow or r.bRow) for r in alone)[0] == ("ONLY_A", "NULL\x1fTEXT:a\x1fTEXT:x") and len(alone) == 5
    assert mk.tree_diff(a, a).collect() == [] and mk.tree_diff(frame(spark, []), frame(spark, [])).collect() == []


def test_diff_by_position(spark):
    a = spark.range(10).select("id", F.col("id").alias("at"))
    b = a.withColumn("id", F.when(F.col("at") == 4, 5).when(F.col("at") == 5, 4).otherwise(F.col("id")))
    assert mk.tree_diff(a, b, columns=["id"]).collect() == []
    assert mk.tree_diff(a, b, columns=["id"], at="at").count() == 4


def test_saved_leaves(spark, tmp_path):
    df = frame(spark, [(k, "a", "x") for k in range(50)])
    saved = mk.save_leaves(df, f"{tmp_path}/leaves")
    now = mk.tree_leaves(mk.tree_rows(df.where("k <> 3")))
    assert mk.differing_leaves(saved, now).count() == 1


def test_second_print_is_its_own(spark):
    one = frame(spark, [(1, "a", "x")]).select(F.xxhash64("v").alias("first"), F.xxhash64(F.lit("again"), "v").alias("second"))
    parts = result_fingerprint(frame(spark, [(1, "a", "x")]), columns=["v"]).first().resultPrint.split("-")
    row = spark.range(1).select(F.hex(F.xxhash64(F.lit("again"), F.lit("TEXT:a"))).alias("h")).first().h
    assert parts[-1] == row and one.first().first != one.first().second


def test_diff_by_position_and_group_and_null(spark):
    """Rows that change place, group or number are found, also where a key is null and texts hold separators."""
    from evenledger.operators.merkle import tree_diff

    a = [(None, 0, "x"), ("g", 1, "y"), ("g", 2, "y"), ('h","', 3, "z"), ("h", 4, "z")]
    b = [("g", 0, "x"), ("g", 2, "y"), ("g", 1, "y"), ("h", 3, "z"), ('h","', 4, "z")]
    df = lambda rows: spark.createDataFrame(rows, "g string, at long, v string")
    moved = tree_diff(df(a), df(b), by=["g"], at="at").collect()
    assert sorted((r.g or "", r.kind) for r in moved) == [("", "ONLY_A"), ("g", "ONLY_B"), ("h", "ONLY_A"), ("h", "ONLY_B"), ('h","', "ONLY_A"), ('h","', "ONLY_B")]
    assert tree_diff(df(a), df(a[::-1]), by=["g"], at="at").count() == 0
    copies = tree_diff(df(a).select("v"), df([*b, b[0]]).select("v")).collect()
    assert [(r.kind, r.aCopies, r.bCopies) for r in copies] == [("ONLY_B", 1, 2)]


def test_diff_shuffles_no_texts_of_equal_rows(spark):
    """Leaves are told apart by numbers alone: no list, and no sorted list of digests, is made."""
    from evenledger.operators import merkle as mk

    rows = mk.tree_rows(spark.range(1000).withColumn("v", F.lit("text")))
    marks = mk._marks([mk._placed(rows, [], None)] * 2)
    plan = marks._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and marks.isEmpty()
