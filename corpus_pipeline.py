"""A corpus from ``documents``: toxic documents go, then boilerplate lines, near copies and repeated passages; what stays is packed.

Every stage takes all that its predecessor kept and returns the columns of ``documents``, the last one the pieces of
token sequences. ``n_chars`` follows the text. SQL cannot express the network of the first stage; the stages after it
are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenledger.llm.common import numbered, saved
from evenledger.llm.lines import drop_boilerplate
from evenledger.llm.minhash import near_duplicates
from evenledger.llm.packing import pack
from evenledger.llm.queries import tokenizer_path
from evenledger.llm.suffix import cut_texts
from evenledger.llm.toxicity import drop_toxic, fit

#: Bytes of a passage that is cut; one of over 50 words is longer but for rare ones of very short words (README).
PASSAGE_BYTES = 200


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with the length of the text brought up to date."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the network learns from a bounded sample of all labelled documents."""
    return drop_toxic(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), threshold=0.5)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than a tenth of their source's distinct texts go; copies are left to the next stage."""
    keep = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    return _measured(drop_boilerplate(docs, percent=10, min_pages=3, keep=keep, copies_once=True), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles, the one with the smallest id stays.

    Rows are told apart by their number: of several with the smallest id the first stays, a null id comes last.
    """
    rows = numbered(docs)
    found = near_duplicates(rows, size=5, percent=80, key="_row").select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_component"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))
    kept = rows.select("_row", "doc_id").join(found, "_row").groupBy("_component").agg(F.min_by("_row", order).alias("_row"))
    return rows.join(kept, "_row", "left_semi").select(*docs.columns)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also stand elsewhere are cut out of every document that has them; no copy stays, the first one neither."""
    return _measured(cut_texts(docs, length=PASSAGE_BYTES), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids."""
    return pack(docs, tokenizer_path(), capacity=2048, end=0)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
