"""Near duplicates against all pairs of full shingle sets, and components against a plain search."""

import random
import re

from pyspark.sql import functions as F

from evenledger.llm.graph import components
from evenledger.llm.minhash import near_duplicates

SCHEMA = "doc_id long, text string, bands string, rep string, n_shingles string"


def shingle_set(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def reach(nodes, links):
    """node -> smallest node within reach."""
    found = {}
    for start in sorted(nodes):
        if start in found:
            continue
        front, found[start] = [start], start
        while front:
            for other in links.get(front.pop(), ()):
                if other not in found:
                    found[other] = start
                    front.append(other)
    return found


def expected(given, size=4, percent=80):
    sets = {k: shingle_set(t, size) for k, t in given}
    links = {}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both * 100 >= percent * (len(sets[a]) + len(sets[b]) - both):
                links.setdefault(a, set()).add(b)
                links.setdefault(b, set()).add(a)
    roots = reach(ids, links)
    return {k: (len(sets[k]), roots[k]) for k in ids}


def checked(spark, given, **options):
    rows = [(k, t, "clash", "clash", "clash") for k, t in given]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5), **options).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected(given, **options)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(given)


def varied(rng, words, share):
    return [rng.choice("klmnop") * 3 if rng.random() < share else w for w in words]


def test_copies_chains_and_odd_texts(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    given = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "one two three"), (6, "one two  three\n"), (7, "one two three four"), (8, "é Été"), (9, "é été")]
    for k in range(10, 70):  # near copies of every degree
        given.append((k, " ".join(varied(rng, base, rng.choice([0, 0.005, 0.02, 0.04, 0.2])))))
    for k in range(70, 100):  # a chain: each like the one before, its ends unlike
        given.append((k, " ".join(f"c{j}" for j in range((k - 70) * 6, (k - 70) * 6 + 100))))
    given += [(100 + k, " ".join(base)) for k in range(5)] + [(200, "long " * 30_000 + "tail"), (201, "long " * 30_000 + "tail")]
    checked(spark, given)
    checked(spark, given, size=5, percent=80)
    checked(spark, given, size=3, percent=60)


def test_a_large_group_beside_others_in_its_buckets(spark):
    """Groups that share bands with a hot one without being linked to it: hubs do not see them, blocks do."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(300)}" for _ in range(60)]
    given = [(k, " ".join(varied(rng, base, 0.01))) for k in range(400)]
    for g in range(20):
        other = varied(rng, base, 0.12)
        given += [(1000 + g * 10 + k, " ".join(varied(rng, other, 0.01))) for k in range(6)]
    checked(spark, given)


def test_empty_null_and_repeated_keys(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, "a b c d e", "", "", ""), (1, "a b c d e", "", "", ""), (1, "a b c d e", "", "", ""), (2, "x", "", "", "")]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 4 and {r.component_id for r in got if r.n_shingles == 2} == {1}
    assert [r.kept for r in got if r.doc_id is None] == [None]


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(600), rng.randrange(600)) for _ in range(330)] + [(1000 + k, 1001 + k) for k in range(200)] + [(5000, k) for k in range(6000, 6500)]
    edges += [(7, 7), (8, 9), (9, 8), (8, 9)]
    links = {}
    for a, b in edges:
        if a != b:
            links.setdefault(a, set()).add(b)
            links.setdefault(b, set()).add(a)
    df = spark.createDataFrame([*edges, (None, 3), (3, None)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == reach(links, links)
    assert components(df.where(F.lit(False))).collect() == []
