"""Readers. CSV readers count quotes in one pass beforehand, ``first_nonempty`` looks for one row; the others are lazy."""

from __future__ import annotations

import hashlib
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenledger.functions.chain import filled, nonblank
from evenledger.sources.contracts import (
    BASELINE_FIELDS,
    BINDINGS,
    CASE_ROWS,
    EXECUTIONS,
    STATEMENTS,
    Field,
    schema_of,
)
from evenledger.sources.csv import scan_csv

REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def alias_column(df: DataFrame, field: Field, strict: bool = True) -> Column:
    """First non-blank of the field's aliases among the headers, whatever their case, typed and defaulted.

    A bad number fails the job when strict and counts as the default otherwise.
    """
    headers: dict[str, list[str]] = {}
    for name in df.columns:
        headers.setdefault(name.strip().lower(), []).append(name)
    found = [F.col(f"`{name}`") for alias in field.aliases for name in headers.get(alias.strip().lower(), [])]
    value = F.coalesce(*[nonblank(c.cast("string")) for c in found]) if found else F.lit(None).cast("string")
    if field.dtype == "string":
        typed = value
    elif field.dtype == "boolean":
        typed = F.when(value.isNotNull(), F.lower(value) == "true")
    else:
        typed = value.cast(field.dtype) if strict else value.try_cast(field.dtype)
    return F.coalesce(typed, F.lit(field.default).cast(field.dtype)).alias(field.name)


def with_aliases(df: DataFrame, fields: tuple[Field, ...], strict: bool = True, position: bool = True) -> DataFrame:
    """The contract's columns, plus ``_pos``, the row's place in its input (by file and place in it for CSV files)."""
    columns = [alias_column(df, f, strict) for f in fields]
    if position:
        columns.append((F.col("_pos") if "_pos" in df.columns else F.monotonically_increasing_id()).alias("_pos"))
    return df.select(*columns)


def scan_aliased_csv(
    spark: SparkSession, path: str, fields: tuple[Field, ...], strict: bool = True, position: bool = True
) -> DataFrame:
    return with_aliases(scan_csv(spark, path), fields, strict, position)


def scan_statements(spark: SparkSession, path: str, strict: bool = True, drop_blank_ids: bool = False) -> DataFrame:
    rows = scan_aliased_csv(spark, path, STATEMENTS, strict)
    return rows.where(filled(F.col("sqlId"))) if drop_blank_ids else rows


def scan_bindings(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return scan_aliased_csv(spark, path, BINDINGS, strict)


def scan_executions(spark: SparkSession, path: str, keep: str | None = "first", strict: bool = True) -> DataFrame:
    """One row per id: the first or the last one; ``keep=None`` keeps all."""
    from evenledger.operators.ranking import dedupe

    rows = scan_aliased_csv(spark, path, EXECUTIONS, strict).where(filled(F.col("sqlId")))
    return dedupe(rows, ["sqlId"], ["_pos"], keep) if keep else rows


def scan_baseline(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Saved baseline with its 43 typed columns; row counts and times may be null."""
    if fmt == "csv":
        return scan_aliased_csv(spark, path, BASELINE_FIELDS, position=False)
    saved = spark.read.format(fmt).load(path)
    kept = {f.name for f in saved.schema.fields if f.dataType.typeName() in ("array", "struct")}
    return saved.select(
        *[F.col(f.name) if f.name in kept else alias_column(saved, f) for f in BASELINE_FIELDS]
    )


def scan_cases(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Baseline or comparison rows under one set of names."""
    if fmt == "csv":
        return scan_aliased_csv(spark, path, CASE_ROWS)
    return with_aliases(spark.read.format(fmt).load(path), CASE_ROWS)


def first_nonempty(a: DataFrame | None, b: DataFrame | None) -> DataFrame:
    """``a`` when it has a row, else ``b``, else an error. Reads at most one row of each."""
    for df in (a, b):
        if df is not None and not df.limit(1).isEmpty():
            return df
    raise ValueError("neither input has data rows")


def scan_optional(spark: SparkSession, path: str, fields: tuple[Field, ...], fmt: str = "csv") -> DataFrame:
    """The scan, or an empty table of the same columns when the path does not exist."""
    try:
        raw = scan_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema_of(fields)).withColumn("_pos", F.lit(0).cast("long"))
    return with_aliases(raw, fields)


def load_side(spark: SparkSession, spec: dict[str, dict]) -> dict[str, DataFrame]:
    """Read-only tables of one side of a reconciliation.

    Each entry maps a view name to ``{"format": ..., "path": ...}``, ``{"table": ...}``, or JDBC
    options: ``{"format": "jdbc", "url": ..., "query": ..., "queryTimeout": seconds}``.
    """
    tables = {}
    for name, source in spec.items():
        options = dict(source)
        if "table" in options:
            tables[name] = spark.read.table(options["table"])
            continue
        fmt, path = options.pop("format", "parquet"), options.pop("path", None)
        reader = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()})
        tables[name] = reader.load(path) if path else reader.load()
    return tables


def scan_source_corpus(
    spark: SparkSession, roots: list[str], glob: str = "*.java", skip=("target", "build")
) -> DataFrame:
    """One row per source file: path and whole text; build folders are left out."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(roots, wholetext=True)
    path = F.col("_metadata.file_path")
    folders = "|".join(skip)
    return files.select(path.alias("filePath"), F.col("value").alias("sourceText")).where(
        ~F.col("filePath").rlike(rf"/(?:{folders})/")
    )


def scan_xml_docs(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """One variant per XML record."""
    return (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("attributePrefix", "@")
        .option("singleVariantColumn", "content")
        .load(path)
    )


JSON_SPACE = " \t\n\r"
JSON_NUMBER = r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?\z"


def _goes_on(text: Column) -> Column:
    """Whether more follows the first value of a text that Spark's parser, which stops after it, accepts.

    Nothing follows a number that is the whole text. Every other value ends in a character that it cannot lose: if the
    text still parses without its last one, that one was not part of the value.
    """
    whole = F.trim(text, F.lit(JSON_SPACE))
    shorter = F.substring(whole, F.lit(1), F.length(whole) - 1)
    return F.when(whole.rlike("^[-0-9]"), ~whole.rlike(JSON_NUMBER)).otherwise(F.try_parse_json(shorter).isNotNull())


def scan_json_docs(df: DataFrame, column: str, max_chars: int | None = None) -> DataFrame:
    """Adds ``json`` (variant, null when rejected) and ``docStatus``: VALID, BLANK, INVALID, or TOO_LARGE above ``max_chars``.

    Of fields with the same name in one object the last counts. A text that goes on after its value is no JSON.
    """
    text = F.col(column)
    size_ok = F.lit(True) if max_chars is None else F.length(text) <= max_chars
    conf, before = df.sparkSession.conf, df.sparkSession.conf.get(REPEATED_KEYS)
    conf.set(REPEATED_KEYS, "true")  # read when the expression is made
    try:
        parsed = df.withColumn("json", F.when(filled(text) & size_ok, F.try_parse_json(text)))
        parsed = parsed.withColumn("json", F.when(F.col("json").isNotNull() & ~_goes_on(text), F.col("json")))
    finally:
        conf.set(REPEATED_KEYS, before)
    return parsed.withColumn(
        "docStatus",
        F.when(~filled(text), "BLANK")
        .when(~size_ok, "TOO_LARGE")
        .when(F.col("json").isNull(), "INVALID")
        .otherwise("VALID"),
    )


#: Files from this size on are read in pieces instead of as one value.
STREAMED_BYTES = 256 << 20
PIECE_BYTES = 8 << 20


def _streamed_digest(uri: str) -> str:
    """SHA-256 of one file of a file system that executors reach, read piece by piece; ``uri`` is not escaped."""
    scheme, _, rest = ("file", ":", uri) if uri.startswith("/") else uri.partition(":")
    if scheme == "file":
        system, path = pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        system, path = pafs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")
    made = hashlib.sha256()
    with system.open_input_stream(path) as stream:
        while piece := stream.read(PIECE_BYTES):
            made.update(piece)
    return made.hexdigest()


def _digest_batches(batches):
    for batch in batches:
        for uri, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([length], pa.int64()), pa.array([_streamed_digest(uri)])], names=["path", "length", "sha256"])


def scan_file_digests(spark: SparkSession, root: str, streamed_bytes: int = STREAMED_BYTES) -> DataFrame:
    """(path relative to root, size, sha256) of every file below ``root``.

    Small files are read by Spark, one a row. Files of ``streamed_bytes`` and more, which may be larger than a row can
    be, are read in pieces by the task that gets their name; executors must reach their file system themselves (a
    mounted or Hadoop path, or an object store that Arrow knows). Spark does not list files without a byte.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    large = F.col("length") >= streamed_bytes
    whole = files.where(~large).select("path", "length", F.sha2("content", 256).alias("sha256"))
    # One partition for each name: a task reads one large file after another only where there are fewer slots than files.
    names = files.where(large).select("path", "length").repartition("path")
    pieces = names.mapInArrow(_digest_batches, "path string, length long, sha256 string")
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    return whole.unionByName(pieces).select(
        F.regexp_replace("path", F.lit(f"^.*?{_literal(base)}"), F.lit("")).alias("path"),
        F.col("length").alias("size"),
        "sha256",
    )


def _literal(path: str) -> str:
    return r"\Q" + path + r"\E"
