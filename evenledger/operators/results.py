"""Summaries of query results: counts, column signatures, hashes, order-free prints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenledger.functions.canonical import canonical_row, signature_of
from evenledger.operators.merkle import result_root
from evenledger.operators.ranking import number_rows, positioned
from evenledger.operators.skew import within_cap

SLICE = (1 << 21) - 1


def _rows(df: DataFrame, by: list[str], columns: list[str] | None, extra: list[str] = (), scale: int | None = None) -> DataFrame:
    chosen = columns or [c for c in df.columns if c not in by]
    return df.select(*by, *extra, canonical_row(df, chosen, scale).alias("_row"))


def _signature(df: DataFrame, by: list[str], columns: list[str] | None) -> str:
    return signature_of(df, columns or [c for c in df.columns if c not in by])


def _digest(signature: str, ordered: Column) -> Column:
    """SHA-256 over the signature and the rows, a line feed after each."""
    lines = F.array_join(F.concat(F.array(F.lit(signature)), ordered, F.array(F.lit(""))), "\n")
    return F.sha2(lines, 256)


def result_hash(
    df: DataFrame,
    by: list[str] = (),
    ordered_by: list[str] | None = None,
    columns: list[str] | None = None,
    *,
    max_rows: int | None = None,
    min_rows: int | None = None,
    as_delivered: bool = False,
    scale: int | None = None,
) -> DataFrame:
    """Per group: row count and result hash. A group above ``max_rows`` has no hash, never a cut one.

    Without ``max_rows`` the hash is the root of a Merkle tree (``merkle.result_root``), for groups of any size. With
    it a group's rows come together in one place, as many as the caller allows, for one SHA-256 over all of them.

    Rows are sorted unless ``ordered_by`` names the result's own order; duplicates are kept.
    ``as_delivered`` (whole results only) keeps the order in which a sorted query delivers its rows.
    """
    by = list(by)
    if max_rows is None:
        return _tree_hash(df, by, ordered_by, columns, as_delivered, scale)
    extra = [c for c in ordered_by or [] if c not in by]
    signature = _signature(df, by, columns)
    if as_delivered and not by:
        # After the limit there is one partition, in the query's own order.
        columns = columns or df.columns
        df = guard_max_rows(df, max_rows).withColumn("_seq", F.monotonically_increasing_id())
        extra = ["_seq"]
    rows = _rows(df, by, columns, extra, scale)
    item = F.struct(*[F.col(c) for c in extra], F.col("_row")) if extra else F.col("_row")
    gathered = F.sort_array(F.collect_list(item))
    ordered = F.transform(gathered, lambda x: x.getField("_row")) if extra else gathered
    digest = _digest(signature, ordered).alias("resultHash")
    if not by:
        guarded = guard_max_rows(rows, max_rows)
        return guarded.agg(F.count(F.lit(1)).alias("rowCount"), digest).select(
            "rowCount", F.when(F.col("rowCount") <= max_rows, F.col("resultHash")).alias("resultHash")
        )
    kept, sizes = within_cap(rows, by, max_rows, **({} if min_rows is None else {"min_rows": min_rows}))
    hashes = kept.groupBy(*by).agg(F.count(F.lit(1)).alias("rowCount"), digest)
    too_large = sizes.where(F.col("_n") > max_rows).select(*by, F.col("_n").alias("rowCount"), F.lit(None).cast("string").alias("resultHash"))
    return hashes.unionByName(too_large)


def _tree_hash(df, by, ordered_by, columns, as_delivered, scale) -> DataFrame:
    columns = columns or [c for c in df.columns if c not in by]
    if as_delivered and not by:
        return result_root(with_positions(df), by, columns, scale, at="_at")
    if ordered_by:
        numbered = number_rows(df.withColumn("_row", canonical_row(df, columns, scale)), by, [*ordered_by, "_row"], "_at").drop("_row")
        return result_root(numbered, by, columns, scale, at="_at")
    return result_root(df, by, columns, scale)


def guard_max_rows(df: DataFrame, n: int) -> DataFrame:
    """At most n+1 rows: enough to tell that a result is too large."""
    return df.limit(n + 1)


def with_positions(df: DataFrame) -> DataFrame:
    """``_at``: each row's place in the order in which the query delivers its rows."""
    return positioned(df, "_at")


def smoke_probe(df: DataFrame) -> DataFrame:
    """Run the query for at most one row: 1 when it has any, else 0."""
    return df.limit(1).agg(F.count(F.lit(1)).alias("rowCount"))


def fingerprint_columns(*row: Column) -> list[Column]:
    """Partial-and-final aggregates that identify a multiset of rows of any size; a row may be one cell or several.

    Three 21-bit slices of one 64-bit hash are summed as longs, which cannot overflow below 2^42
    rows, and a second hash is XORed.
    """
    h = F.xxhash64(*row)
    slices = [F.sum(F.shiftrightunsigned(h, 21 * i).bitwiseAND(F.lit(SLICE))) for i in range(3)]
    second = F.bit_xor(F.xxhash64(F.lit("again"), *row))  # the other way round it would go on from the first hash
    parts = [*[F.coalesce(s, F.lit(0)) for s in slices], F.coalesce(second, F.lit(0))]
    return [F.count(F.lit(1)).alias("rowCount"), F.concat_ws("-", *[F.hex(p) for p in parts]).alias("resultPrint")]


def result_fingerprint(df: DataFrame, by: list[str] = (), columns: list[str] | None = None, scale: int | None = None) -> DataFrame:
    """Order-free print per group for results of any size: one shuffle of partial sums, no sort."""
    by = list(by)
    return _rows(df, by, columns, scale=scale).groupBy(*by).agg(*fingerprint_columns(F.col("_row")))


def summarize_result(
    df: DataFrame,
    by: list[str] = (),
    max_rows: int | None = None,
    ordered_by: list[str] | None = None,
    columns: list[str] | None = None,
    as_delivered: bool = False,
    scale: int | None = None,
    method: str = "print",
) -> DataFrame:
    """(status, rowCount, resultHash, columnSignature) per group.

    The hash is the print of ``result_fingerprint``, for results of any size. ``as_delivered`` (whole
    results only) prints every row with its position. ``method="tree"`` takes the SHA-256 root of a Merkle tree
    instead, also for any size, which costs one shuffle of the rows' hashes. A caller that sets ``max_rows`` gets the
    SHA-256 of the rows; larger results are then RESULT_TOO_LARGE, counted as cap+1.
    """
    by = list(by)
    signature = F.lit(_signature(df, by, columns)).alias("columnSignature")
    if max_rows is None and method == "tree":
        whole = result_hash(df, by, ordered_by, columns, as_delivered=as_delivered, scale=scale)
        return whole.select(*by, F.lit("SUCCESS").alias("status"), "rowCount", "resultHash", signature)
    if max_rows is None:
        if as_delivered and not by:
            columns = columns or df.columns
            rows = with_positions(df.select(canonical_row(df, columns, scale).alias("_row")))
            whole = rows.agg(*fingerprint_columns(F.concat_ws(":", "_at", "_row")))
        else:
            whole = result_fingerprint(df, by, columns, scale)
        return whole.select(
            *by, F.lit("SUCCESS").alias("status"), "rowCount", F.col("resultPrint").alias("resultHash"), signature
        )
    hashed = result_hash(df, by, ordered_by, columns, max_rows=max_rows, as_delivered=as_delivered, scale=scale)
    return hashed.select(
        *by,
        F.when(F.col("rowCount") > max_rows, "RESULT_TOO_LARGE").otherwise("SUCCESS").alias("status"),
        F.least(F.col("rowCount"), F.lit(max_rows + 1)).alias("rowCount"),
        "resultHash",
        signature,
    )
