"""Row numbers, first and last rows, and top-k, without handing a whole group to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from evenledger.functions.identity import numbered_id
from evenledger.sources.sink import drop_path, scratch_path

SPLIT_ROWS = 1_000_000
MAX_SPLITS = 2000


def position_of(order: list[str]) -> Column:
    """One comparable value for the whole sort order; nulls sort last."""
    parts = []
    for i, name in enumerate(order):
        parts += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}")]
    return F.struct(*parts)


def number_rows(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    out: str,
    split_rows: int = SPLIT_ROWS,
    max_splits: int = MAX_SPLITS,
) -> DataFrame:
    """``row_number() over (partition by keys order by order nulls last)`` with large groups split.

    The groups are counted first, by a job of its own. Where none has more than ``step = max(split_rows, rows /
    max_splits)`` rows, what is left is one window. At most ``max_splits`` groups can be larger; their rows are dealt
    out by ranges of the whole sort order and numbered by their place there. Rows that tie on ``order`` have any order
    among themselves. ``keys=[]`` numbers the whole table. Sort descending by passing a negated column.
    """
    if out in df.columns:  # whose old values may be a key or decide the order
        shown = [c for c in df.columns if c != out]
        was = lambda names: ["__was" if c == out else c for c in names]
        return number_rows(df.withColumnRenamed(out, "__was"), was(keys), was(order), out, split_rows, max_splits).select(*_quoted(shown), out)
    shown = [*_quoted(df.columns), out]
    placed = [F.col(c).asc_nulls_last() for c in order]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*placed)).cast("long").alias(out)
    large = _large_groups(df, keys, split_rows, max_splits)
    if large is None:
        return df.select("*", number)
    if not keys:
        ranged = positioned(df.repartitionByRange(*placed).sortWithinPartitions(*placed), "__at")
        return ranged.withColumn(out, F.col("__at") + 1).select(*shown)
    key = F.struct(*[F.col(k) for k in keys])
    hot = F.broadcast(large)
    rest = df.join(hot, key.eqNullSafe(F.col("__hot")), "left_anti").select("*", number)
    apart = df.join(hot, key.eqNullSafe(F.col("__hot")), "left_semi")
    dealt = [*[F.col(k).asc_nulls_last() for k in keys], *placed]
    ranged = positioned(apart.repartitionByRange(*dealt).sortWithinPartitions(*dealt), "__at")
    first = ranged.groupBy(key.alias("__first_key")).agg(F.min("__at").alias("__first"))
    joined = ranged.join(F.broadcast(first), key.eqNullSafe(F.col("__first_key")))
    split = joined.withColumn(out, F.col("__at") - F.col("__first") + 1)
    return rest.select(*shown).unionByName(split.select(*shown))


def _quoted(names: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def _large_groups(df: DataFrame, keys: list[str], split_rows: int, max_splits: int) -> DataFrame | None:
    """``__hot``: keys of the groups to split, at most ``max_splits``; None where there is none. One pass over the table."""
    spark = df.sparkSession
    if not keys:
        rows = df.count()
        return spark.range(1) if rows > max(split_rows, rows // max_splits) else None
    seen = Observation()
    sizes = df.select(*keys).observe(seen, F.count(F.lit(1)).alias("rows")).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    path = scratch_path(spark, "groups")
    hot = F.struct(*[F.col(k) for k in keys]).alias("__hot")
    sizes.where(F.col("__n") > split_rows).orderBy(F.desc("__n")).limit(max_splits).select(hot, "__n").write.parquet(path)
    step = max(split_rows, seen.get["rows"] // max_splits)
    large = spark.read.parquet(path).where(F.col("__n") > step).select("__hot")
    if large.isEmpty():
        drop_path(spark, path)
        return None
    return large


def positioned(df: DataFrame, out: str) -> DataFrame:
    """``out``: each row's place, from 0, in the order in which the frame's partitions deliver their rows.

    The rows are written once with their partition and place there; the partitions' sizes (one row each) do the rest.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "delivered")
    df.withColumn("__id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("__part", F.shiftright("__id", 33))
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    at = F.col("__before") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(first), "__part").withColumn(out, at).drop("__id", "__part", "__before")


def occurrence_index(
    df: DataFrame,
    keys=("serviceName", "className", "methodName", "sourceType", "sqlVariableName"),
    line: str = "lineNumber",
    statement_id: str = "sqlId",
    out: str = "occurrenceIndex",
    **split,
) -> DataFrame:
    """1-based position among the statements of the same method, by line, then id."""
    trimmed = [f"_k{i}" for i in range(len(keys))]
    named = df.select("*", *[F.coalesce(F.trim(k), F.lit("")).alias(t) for k, t in zip(keys, trimmed)])
    return number_rows(named, trimmed, [line, statement_id], out, **split).drop(*trimmed)


def assign_ids(
    df: DataFrame,
    service: str = "serviceName",
    order=("filePath", "lineNumber"),
    out: str = "sqlId",
    **split,
) -> DataFrame:
    """``<service>-0001`` in (service, file, line) order."""
    numbered = number_rows(df.withColumn("_service", F.coalesce(service, F.lit(""))), ["_service"], list(order), "_no", **split)
    return numbered.withColumn(out, numbered_id(F.col(service), F.col("_no"))).drop("_no", "_service")


def dedupe(df: DataFrame, keys: list[str], order: list[str], keep: str = "first") -> DataFrame:
    """One row per key. The row limit reaches the map side, so a hot key shuffles one row per task."""
    return top_rows(df, keys, order, 1, keep)


def top_rows(df: DataFrame, keys: list[str], order: list[str], n: int, keep: str = "first", out: str | None = None) -> DataFrame:
    """The first (or last) ``n`` rows of each key in the given order."""
    at = position_of(order)
    window = Window.partitionBy(*keys).orderBy(at.asc() if keep == "first" else at.desc())
    ranked = df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n)
    return ranked.withColumnRenamed("_rank", out) if out else ranked.drop("_rank")


def rank_rows(df: DataFrame, order: list[str], out: str = "rank", **split) -> DataFrame:
    """Running rank over the whole table in report order, without a single-task window.

    The rows are written once: counting them and dealing them out would each work them out again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "unranked")
    df.write.parquet(path)
    return number_rows(spark.read.parquet(path), [], order, out, **split)
