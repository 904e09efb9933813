"""Joins and filters that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1000
HOT_ROWS = 1_000_000
SALTS = 64


def heavy_keys(df: DataFrame, keys: list[str], share: int = HOT_SHARE, min_rows: int = HOT_ROWS) -> DataFrame:
    """Keys that hold more than ``1/share`` of the rows and at least ``min_rows`` rows.

    Fewer than ``share`` keys can qualify, whatever the table's size, so the result may be broadcast.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where((F.col("_n") >= min_rows) & (F.col("_n") * share > total)).select(*keys)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    sized_by: DataFrame | None = None,
    salts: int = SALTS,
    share: int = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join to a table with few rows per key, whose left side may have hot or null keys.

    Rows of a hot key are spread over ``salts`` partitions and only that key's right rows are
    repeated. Null keys never match, so they are spread as well. Hot keys are counted on the left
    side, or on ``sized_by`` when a cheaper table has the same keys: pass the scan that a long plan
    started from, so that the plan is not run again for its keys.
    """
    counted = left if sized_by is None else sized_by
    hot = F.broadcast(heavy_keys(counted, on, share, min_rows).withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in _hashable(left)]), F.lit(salts)).cast("int")
    is_null = _any_null(on)
    salted_left = left.join(hot, on, "left").withColumn(
        "_salt", F.when(F.col("_hot") | is_null, spread).otherwise(0)
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted_left.drop("_hot").join(salted_right, [*on, "_salt"], how).drop("_salt")


def lookup_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """The join that this library uses for facts by key: each side is read once.

    Null keys are spread here; hot keys are split by Spark's adaptive skew join. ``salted_join`` counts and salts them
    beforehand, at the price of reading the left side three times.
    """
    return spread_join(left, right, on, how)


def spread_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", salts: int = SALTS) -> DataFrame:
    """Left or inner join for a left side whose only hot key can be null or blank: those rows are spread.

    Other uneven keys are left to adaptive skew-join splitting.
    """
    lost = _any_null(on)
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in _hashable(left)]), F.lit(salts)).cast("int")
    placed = left.withColumn("_salt", F.when(lost, spread).otherwise(0))
    return placed.join(right.withColumn("_salt", F.lit(0)), [*on, "_salt"], how).drop("_salt")


def _hashable(df: DataFrame) -> list[str]:
    unhashable = ("map", "variant")
    return [f.name for f in df.schema.fields if not any(w in f.dataType.simpleString() for w in unhashable)]


def _any_null(names: list[str]) -> Column:
    found = F.lit(False)
    for name in names:
        found = found | F.col(name).isNull()
    return found


def within_cap(df: DataFrame, by: list[str], cap: int, min_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows of the groups with at most ``cap`` rows, group sizes).

    Hot groups above the cap are dropped before the shuffle by a bounded broadcast, the others by a
    join on the group key. Null keys form groups as well.
    """
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n")).scalar()
    hot = sizes.where(
        (F.col("_n") > cap) & (F.col("_n") >= min_rows) & (F.col("_n") * HOT_SHARE > total)
    ).select(*by)
    small = sizes.where(F.col("_n") <= cap).select(*by)
    kept = _keyed_join(_keyed_join(df, F.broadcast(hot), by, "left_anti"), small, by, "left_semi")
    return kept, sizes


def _keyed_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A semi or anti join in which null keys meet null keys."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    met = F.lit(True)
    for k in keys:
        met = met & left[k].eqNullSafe(right[f"_{k}"])
    return left.join(right, met, how)
