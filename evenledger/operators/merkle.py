"""Merkle trees over results of any size: one root for a result, and the rows that differ from another result.

A row's path is the SHA-256 of its canonical text, or its position where order counts. Leaves are ranges of paths (the
first ``leaf`` digits), sorted inside; 4096 leaves make a branch and all branches the root, so a tree has three levels
whatever the size, and no aggregate gathers more than the rows of a leaf or 4096 digests of a branch. Paths do not
depend on partitions, so trees of two sides, or of a saved result and one of today, can be compared node by node:
equal branches are never opened.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenledger.functions.canonical import canonical_row, signature_of
from evenledger.sources.sink import scratch_path


@dataclass(frozen=True)
class Shape:
    """Digits of a row's path that name its branch and its leaf."""

    branch: int
    leaf: int


#: Paths are 64 hexadecimal digits of a hash, or 16 of a position.
BY_CONTENT, BY_POSITION = Shape(3, 6), Shape(10, 13)


def _path(at: Column) -> Column:
    return F.lpad(F.hex(at.cast("long")), 16, "0")


def _once(c: Column) -> Column:
    """The column from a generator: Spark works it out once, and not again in every condition that it takes part in."""
    return F.explode(F.array(c))


def tree_rows(
    df: DataFrame, by: list[str] = (), columns: list[str] | None = None, scale: int | None = None, at: str | None = None, keep: list[str] = (), made=lambda c: c
) -> DataFrame:
    """by, keep, ``_row`` (canonical text), ``_digest`` and ``_path``; ``at`` names the rows' positions where order counts."""
    chosen = columns or [c for c in df.columns if c not in (*by, at)]
    rows = df.select(*by, *keep, made(canonical_row(df, chosen, scale)).alias("_row"), *([F.col(at).alias("_at")] if at else []))
    rows = rows.withColumn("_digest", made(F.sha2("_row", 256)))
    return rows.withColumn("_path", _path(F.col("_at"))).drop("_at") if at else rows.withColumn("_path", F.col("_digest"))


def _joined(parts: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(F.collect_list(parts)), "\n"), 256).alias("digest")


def tree_leaves(rows: DataFrame, by: list[str] = (), shape: Shape = BY_CONTENT) -> DataFrame:
    """(by, branch, rowCount, digest) of the leaves of ``tree_rows``. Equal rows meet before the shuffle and count as one entry."""
    kinds = rows.groupBy(*by, "_path", "_digest").agg(F.count(F.lit(1)).alias("n"))
    entry = F.concat_ws(":", "_path", "_digest", "n")
    placed = kinds.select(*by, F.substring("_path", 1, shape.leaf).alias("branch"), entry.alias("entry"), "n")
    return placed.groupBy(*by, "branch").agg(F.sum("n").alias("rowCount"), _joined(F.col("entry")))


def tree_branches(leaves: DataFrame, by: list[str] = (), shape: Shape = BY_CONTENT) -> DataFrame:
    """The same columns of the level above: the digest of a node is that of its children's names, counts and digests."""
    return _parents(leaves, [*by, F.substring("branch", 1, shape.branch).alias("_up")]).withColumnRenamed("_up", "branch")


def _parents(nodes: DataFrame, keys: list) -> DataFrame:
    entry = F.concat_ws(":", "branch", "rowCount", "digest")
    return nodes.groupBy(*keys).agg(F.coalesce(F.sum("rowCount"), F.lit(0)).alias("rowCount"), _joined(entry))


def tree_root(branches: DataFrame, by: list[str] = (), signature: str = "") -> DataFrame:
    """(by, rowCount, resultHash): one row for each group; without ``by`` also for a result without rows."""
    top = _parents(branches, list(by))
    whole = F.sha2(F.concat_ws("\n", F.lit(signature), F.col("rowCount").cast("string"), "digest"), 256)
    return top.select(*by, "rowCount", whole.alias("resultHash"))


def result_root(df: DataFrame, by: list[str] = (), columns: list[str] | None = None, scale: int | None = None, at: str | None = None) -> DataFrame:
    """(by, rowCount, resultHash) of results of any size: equal for equal rows with equal signatures and nothing else.

    Without ``at`` the order of the rows does not count, their number does; ``at`` names a column with their positions.
    """
    shape = BY_POSITION if at else BY_CONTENT
    chosen = columns or [c for c in df.columns if c not in (*by, at)]
    leaves = tree_leaves(tree_rows(df, by, chosen, scale, at), by, shape)
    return tree_root(tree_branches(leaves, by, shape), by, signature_of(df, chosen))


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of nodes that one side lacks or that differ; null keys meet null keys."""
    left = a.select(*keys, F.struct("rowCount", "digest").alias("_a"))
    right = b.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct("rowCount", "digest").alias("_b"))
    joined = left.join(right, _same(left, right, keys), "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))
    return joined.select(*[F.when(F.col("_a").isNotNull(), left[k]).otherwise(right[f"_{k}"]).alias(k) for k in keys])


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    met = F.lit(True)
    for k in keys:
        met = met & left[k].eqNullSafe(right[f"_{k}"])
    return met


def _within(df: DataFrame, nodes: DataFrame, keys: list[str]) -> DataFrame:
    few = nodes.select(*[F.col(k).alias(f"_{k}") for k in keys])
    return df.join(few, _same(df, few, keys), "left_semi")


def differing_leaves(a: DataFrame, b: DataFrame, by: list[str] = (), shape: Shape = BY_CONTENT) -> DataFrame:
    """(by, branch) of the leaves that differ, of two tables of leaves (saved, best); only differing branches are opened."""
    by = list(by)
    up = F.substring("branch", 1, shape.branch)
    tops = _differing(tree_branches(a, by, shape), tree_branches(b, by, shape), [*by, "branch"]).withColumnRenamed("branch", "top")
    keys = [*by, "top"]
    opened = [_within(side.withColumn("top", up), tops, keys).drop("top") for side in (a, b)]
    return _differing(*opened, [*by, "branch"])


def save_leaves(df: DataFrame, path: str, by: list[str] = (), columns: list[str] | None = None, scale: int | None = None, at: str | None = None) -> DataFrame:
    """The leaves of a result, written to ``path``: what a later run needs to find its differing rows."""
    tree_leaves(tree_rows(df, by, columns, scale, at), by, BY_POSITION if at else BY_CONTENT).write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


#: Bits of a row's place among the leaves of ``tree_diff``, and hexadecimal digits of each lane of their sums.
PLACE_BITS, LANE, LANES = 26, 7, 4


def _placed(rows: DataFrame, by: list[str], at: str | None) -> DataFrame:
    """``_whole`` (SHA-256 of a row with its group and, where order counts, its position) and ``_leaf``, its first bits."""
    extra = [*by, *(["_path"] if at else [])]
    named = F.concat_ws("\n", F.to_json(F.array(*[F.col(c).cast("string") for c in extra])), "_digest")
    whole = rows.withColumn("_whole", F.sha2(named, 256) if extra else F.col("_digest"))
    return whole.withColumn("_leaf", F.shiftright(F.conv(F.substring("_whole", 1, 7), 16, 10).cast("int"), 28 - PLACE_BITS))


def _marks(sides: list[DataFrame]) -> DataFrame:
    """(_bucket, _bits): the leaves that differ, a bit each, at most 8 MiB whatever the tables' size.

    The rows of both sides are added up leaf by leaf, those of the second with a minus, in lanes of the digests: one
    shuffle of a few numbers a row, and equal leaves add up to zero.
    """
    lanes = [F.conv(F.substring("_whole", 8 + LANE * i, LANE), 16, 10).cast("long") for i in range(LANES)]
    signed = [side.select("_leaf", F.lit(n).cast("long").alias("_n"), *[(x * n).alias(f"_l{i}") for i, x in enumerate(lanes)]) for side, n in zip(sides, (1, -1))]
    names = ["_n", *[f"_l{i}" for i in range(LANES)]]
    sums = signed[0].unionByName(signed[1]).groupBy("_leaf").agg(*[F.sum(c).alias(c) for c in names])
    differ = F.greatest(*[F.abs(F.col(c)) for c in names]) > 0
    place = F.col("_leaf").bitwiseAND(F.lit((1 << 15) - 1)).cast("long")
    return sums.where(differ).groupBy(F.shiftright("_leaf", 15).alias("_bucket")).agg(F.bitmap_construct_agg(place).alias("_bits"))


def _marked() -> Column:
    """Whether the row's leaf has its bit."""
    return F.expr("getbit(cast(conv(hex(substring(_bits, 1 + ((_leaf & 32767) >> 3), 1)), 16, 10) as int), _leaf & 7) = 1")


def tree_diff(
    a: DataFrame,
    b: DataFrame,
    by: list[str] = (),
    keys: list[str] = (),
    columns: list[str] | None = None,
    scale: int | None = None,
    at: str | None = None,
) -> DataFrame:
    """(by, keys, kind, aCopies, bCopies, aRow, bRow): the rows that one side has more often than the other.

    kind is ONLY_A, ONLY_B or, where ``keys`` pair a row of each side, CHANGED; rows are canonical texts. Only rows of
    differing leaves are compared, so a few changes in a large result cost two scans and a few small joins. Both sides
    are at hand, so leaves are told apart by sums of their rows' digests, which need no sort inside a leaf.
    Both sides need the same column names. Keys may be null; a key with several differing rows on both sides pairs all.
    """
    by, keys = list(by), list(keys)
    chosen = columns or [c for c in a.columns if c not in (*by, at)]
    rows = [tree_rows(side, by, chosen, scale, at, [k for k in keys if k not in by], _once) for side in (a, b)]
    spark = a.sparkSession
    found = scratch_path(spark, "differing")
    _marks([_placed(side, by, at) for side in rows]).write.parquet(found)
    bad = F.broadcast(spark.read.parquet(found))

    kept, shown = [], [*by, *[k for k in keys if k not in by], "_path", "_digest", "_row"]
    for side, n in zip(rows, (1, -1)):
        inside = _placed(side, by, at).join(bad, F.shiftright("_leaf", 15) == F.col("_bucket")).where(_marked())
        kept.append(inside.select(*shown, F.lit(n).alias("n")))
    counted = kept[0].unionByName(kept[1]).groupBy(*shown).agg(F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).alias("aCopies"), F.sum(F.when(F.col("n") < 0, 1).otherwise(0)).alias("bCopies"))
    odd = counted.where("aCopies <> bCopies")
    names = [c for c in shown if not c.startswith("_")]
    no_row, one = F.lit(None).cast("string"), [*names, "aCopies", "bCopies"]
    alone = [
        odd.where("aCopies > bCopies").select(*one, F.lit("ONLY_A").alias("kind"), F.col("_row").alias("aRow"), no_row.alias("bRow")),
        odd.where("bCopies > aCopies").select(*one, F.lit("ONLY_B").alias("kind"), no_row.alias("aRow"), F.col("_row").alias("bRow")),
    ]
    if not keys:
        return alone[0].unionByName(alone[1]).select(*names, "kind", "aCopies", "bCopies", "aRow", "bRow")
    left = alone[0].select(*names, F.struct("aCopies", "bCopies", "aRow").alias("_l"))
    right = alone[1].select(*[F.col(k).alias(f"_{k}") for k in names], F.struct("aCopies", "bCopies", "bRow").alias("_r"))
    joined = left.join(right, _same(left, right, names), "full_outer")
    paired = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    return joined.select(
        *[F.when(F.col("_l").isNotNull(), left[k]).otherwise(right[f"_{k}"]).alias(k) for k in names],
        F.when(paired, "CHANGED").when(F.col("_l").isNotNull(), "ONLY_A").otherwise("ONLY_B").alias("kind"),
        F.coalesce("_l.aCopies", "_r.aCopies").alias("aCopies"),
        F.coalesce("_r.bCopies", "_l.bCopies").alias("bCopies"),
        "_l.aRow",
        "_r.bRow",
    )
