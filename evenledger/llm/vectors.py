"""Vectors as Spark columns and as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable_vector(vector: str):
    """True for a vector that is not null, empty or zero and has no null or non-finite component."""
    v = F.col(f"`{vector}`").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return F.coalesce(fine & (F.size(v) > 0), F.lit(False))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows with a usable vector."""
    return vectors.where(usable_vector(vector)).select(F.col(f"`{key}`").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))


def classes(rows: DataFrame) -> DataFrame:
    """(rep, copies, v): equal vectors as one row."""
    return rows.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")).select("rep", "copies", "v")


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    n = len(column)
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


HELD, ASKED = 0, 1


def met(held: DataFrame, asked: DataFrame, keys: tuple[str, ...], tasks: int) -> DataFrame:
    """Rows of both tables that have the same keys in one task, those of ``held`` first, sorted by their ``piece``.

    No row holds more than one of its table, however many of the other it meets; ``runs`` reads them again.
    """
    first = held.withColumn("side", F.lit(HELD))
    rest = asked.withColumns({"side": F.lit(ASKED), "piece": F.lit(0)})
    return first.unionByName(rest, allowMissingColumns=True).repartition(max(1, tasks), *keys).sortWithinPartitions(*keys, "side", "piece")


def runs(batches, keys: tuple[str, ...]):
    """(keys, side, rows) of the batches of ``met``, cut where keys or side change."""
    for batch in batches:
        if batch.num_rows:
            marks = np.stack([np.asarray(batch.column(c), dtype=np.int64) for c in (*keys, "side")])
            cuts = np.flatnonzero((np.diff(marks) != 0).any(axis=0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                yield tuple(marks[:-1, a].tolist()), int(marks[-1, a]), batch.slice(a, b - a)
