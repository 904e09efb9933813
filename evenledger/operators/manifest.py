"""Digest checks of a set of files against a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenledger.functions.chain import first_match


def manifest_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``<digest> *<path>`` lines; blank lines and ``#`` comments are left out, others kept as invalid."""
    line = F.trim(column)
    shape = r"^(\S+)\s+\*(.+)$"
    return lines.where((line != "") & ~line.startswith("#")).select(
        line.alias("line"),
        F.nullif(F.trim(F.regexp_extract(line, shape, 2)), F.lit("")).alias("path"),
        F.nullif(F.lower(F.regexp_extract(line, shape, 1)), F.lit("")).alias("expected"),
    )


def verify_manifest(digests: DataFrame, manifest: DataFrame) -> DataFrame:
    """OK, FAILED, MISSING or INVALID LINE for every manifest line. Paths are unique among the digests."""
    joined = manifest.join(digests.select("path", F.col("sha256").alias("actual")), "path", "left")
    status = first_match(
        [
            (F.col("path").isNull(), "INVALID LINE"),
            (F.col("actual").isNull(), "MISSING"),
            (F.lower("actual") != F.col("expected"), "FAILED"),
        ],
        "OK",
    )
    return joined.select(F.coalesce("path", "line").alias("path"), status.alias("status"))
