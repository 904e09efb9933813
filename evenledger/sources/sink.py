"""Writers. Every function here starts a Spark job."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenledger.sources.contracts import BASELINE


class BaselineExists(RuntimeError):
    """The target already holds baseline rows; a baseline is never overwritten."""


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, or on the default file system when none is configured."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    base = shared.rstrip("/") if shared else "/tmp/evenledger"
    return f"{base}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes a folder of ``scratch_path`` that nothing reads any more."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(found, True)


def write_report(df: DataFrame, path: str, contract: list[str], fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Exactly the contract's columns in the contract's order."""
    writer = df.select(*contract).write.mode(mode)
    if fmt == "csv":
        writer = writer.options(
            header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    writer.format(fmt).save(path)


def has_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    try:
        reader = spark.read.format(fmt)
        saved = reader.option("header", "true").load(path) if fmt == "csv" else reader.load(path)
        return not saved.limit(1).isEmpty()
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def protect_baseline(spark: SparkSession, path: str, fmt: str = "parquet", fail_if_exists: bool = True) -> None:
    """Run before any query: fails when the target holds rows. An empty skeleton may be replaced."""
    if fail_if_exists and has_rows(spark, path, fmt):
        raise BaselineExists(f"baseline rows exist at {path}")


def _claim(spark: SparkSession, path: str):
    """Creates the marker of a writer next to ``path``, which only one of several can do; returns its release."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    marker = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "._writing")
    fs = marker.getFileSystem(conf)
    fs.mkdirs(marker.getParent())
    try:
        if fs.getScheme() == "file":  # whose create() looks first and creates then
            local = jvm.java.io.File(fs.makeQualified(marker).toUri())
            if not local.createNewFile():
                raise BaselineExists(f"another run writes to {path}; if none does, remove {marker.toString()}")
        else:
            fs.create(marker, False).close()
    except Py4JJavaError as taken:
        if "FileAlreadyExists" not in taken.java_exception.getClass().getName():
            raise
        raise BaselineExists(f"another run writes to {path}; if none does, remove {marker.toString()}") from taken
    return lambda: fs.delete(marker, False)


def write_baseline(df: DataFrame, path: str, fmt: str = "parquet", fail_if_exists: bool = True) -> None:
    """Immutable artefact of one run. Give every run its own path.

    Of several writers to a path one holds its marker, the others fail. The rows are written beside the path and then
    moved there, so that readers see all of them or none.
    """
    spark = df.sparkSession
    protect_baseline(spark, path, fmt, fail_if_exists)
    release = _claim(spark, path)
    try:
        protect_baseline(spark, path, fmt, fail_if_exists)  # another run may have ended since
        beside = f"{path.rstrip('/')}._rows-{uuid.uuid4().hex}"
        write_report(df, beside, BASELINE, fmt)
        drop_path(spark, path)
        of, to = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (beside, path))
        fs = to.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if not fs.rename(of, to):
            raise OSError(f"{beside} cannot be moved to {path}")
    finally:
        release()


def write_comparison(df: DataFrame, path: str, contract: list[str] | None = None, fmt: str = "parquet") -> None:
    """A run artefact that may be replaced by the next run."""
    write_report(df, path, contract or df.columns, fmt, mode="overwrite")


def write_report_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """Summary, detail and cross-database rows as one table each."""
    for name, df in tables.items():
        write_report(df, f"{folder.rstrip('/')}/{name}", df.columns, fmt, mode="overwrite")


def write_requests(requests: DataFrame, folder: str) -> None:
    """Accepted requests as JSON lines, one document per case."""
    requests.where(F.col("requestStatus") == "READY").select("request").write.mode("overwrite").text(folder)


def baseline_run_id(given: str | None = None, now: datetime | None = None) -> str:
    """The given id, else ``baseline-YYYYMMDD-HHmmss`` in UTC."""
    if given and given.strip():
        return given.strip()
    return (now or datetime.now(timezone.utc)).strftime("baseline-%Y%m%d-%H%M%S")
