"""Names, Spark callables and their SQL twins."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

FAMILIES = (
    "text_queries",
    "result_queries",
    "candidate_queries",
    "binding_queries",
    "compare_queries",
    "issue_queries",
    "sampling_queries",
    "case_queries",
    "document_queries",
    "source_queries",
)


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under a name."""

    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return keep


def load_all() -> None:
    for family in FAMILIES:
        importlib.import_module(f"evenledger.catalog.{family}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
