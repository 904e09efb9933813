"""Shared folders and small column helpers of the operators here."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the cluster names no shared folder, as in tests on one machine.
LOCAL_SHARED = "/tmp/checkpoints"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local one where it is unset."""
    return (spark.conf.get("spark.checkpoint.dir", None) or LOCAL_SHARED).rstrip("/")


#: Bytes of an Arrow batch between Spark and its workers; with Spark's own 64 MiB a few long texts fill an executor.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Sets the session's batch size to ``BATCH_BYTES`` where it is larger. Results do not depend on it."""
    now = spark.conf.get(BATCH_SETTING).lower().rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: lineage ends here, and a lost executor costs no rework."""
    bound_batches(df.sparkSession)
    path = f"{shared_folder(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    release_shuffles(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now; else they stay until the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def drop_saved(*frames: DataFrame) -> None:
    """Removes tables of ``saved`` that nothing reads any more."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            jvm = df.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


#: Bits of the filter of ``likely_in``: so many for each id, and at most these, 32 MiB, which is what is broadcast.
FILTER_BITS, MOST_FILTER_BITS = 64, 1 << 28


def likely_in(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is among the ids in the first column of ``ids``, and a few more: about one in 64.

    The ids' hashes set bits of a bitmap, which is broadcast; ``df`` is not shuffled. With more than four million ids
    the bitmap grows no further, so more rows pass by chance; none is ever lost but rows with a null key.
    """
    count = ids.count()
    bits = min(MOST_FILTER_BITS, max(1 << 15, 1 << (FILTER_BITS * count).bit_length()))

    def place(c):
        return F.pmod(F.xxhash64(c), F.lit(bits))

    at = place(ids.columns[0])
    maps = ids.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    rows = df.withColumn("_at", place(key))
    met = rows.join(F.broadcast(maps.withColumnsRenamed({"bucket": "_bucket", "bits": "_bits"})), F.bitmap_bucket_number("_at") == F.col("_bucket"))
    bit = F.bitmap_bit_position("_at")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(bitmap_bit_position(_at) div 8 as int) + 1, 1)")), 16, 10).cast("long")
    return met.where(F.floor(byte / F.pow(F.lit(2.0), bit % 8)) % 2 == 1).select(*df.columns)


def numbered(docs: DataFrame, out: str = "_row") -> DataFrame:
    """The table with a number for each row, by which rows with null or repeated keys are told apart.

    Rows of a table of files have the same place in it each time it is read; any other table is saved first.
    """
    read = docs._jdf.queryExecution().analyzed()
    if not (read.children().isEmpty() and docs.inputFiles()):
        docs = saved(docs, "numbered")
    return docs.withColumn(out, F.monotonically_increasing_id())


def text_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text alone, so that no other column of the table can clash; the text of a null is empty."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))


def release_memory() -> None:
    """Gives memory that a worker no longer uses back to the system: workers live on, and their neighbours need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts have about ``size`` bytes; a longer text makes a batch of its own."""
    release_memory()
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.array(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
        part = np.cumsum(lengths) // size
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(a, b - a)


def held_out(key: str, mod: int, rest: int):
    """True for rows whose crc32 of the key as text leaves ``rest``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % mod == rest
