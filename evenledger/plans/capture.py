"""Capturing a baseline on two sides, and comparing one side with it later."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenledger.functions.canonical import normalization_version
from evenledger.functions.chain import says
from evenledger.functions.parameters import SAMPLE_VALUE
from evenledger.operators.compare import (
    assemble_baseline_rows,
    assemble_comparison_rows,
    compare_results,
    join_sides,
    match_baseline,
    overall_of_one,
    overall_status,
    recheck_verdict,
    saved_side,
)
from evenledger.operators.eligibility import capture_eligibility, compare_eligibility, executable_later
from evenledger.operators.sampling import SAMPLE_SIZE, Mapping, sample_table
from evenledger.operators.skew import lookup_join
from evenledger.plans.drift import drifted, save_sources
from evenledger.plans.replay import SUMMARY_SCHEMA, pending_side, replay
from evenledger.sources.scan import scan_baseline
from evenledger.sources.sink import baseline_run_id, protect_baseline, write_baseline, write_comparison


def sample_parameters(
    spark: SparkSession, tables: dict[str, DataFrame], specs: dict[str, tuple[str, list[Mapping]]], n: int = SAMPLE_SIZE
) -> DataFrame:
    """(sqlId, sampleIndex, values, collectedSampleCount) for each statement of a spec.

    ``specs`` maps a statement id to (table, mappings). Each table is read once for all its statements. Without
    mappings: one empty tuple.
    """
    by_table: dict[str, dict[str, list[Mapping]]] = {}
    for sql_id, (table, mappings) in specs.items():
        if mappings:
            by_table.setdefault(table, {})[sql_id] = mappings
    parts = [sample_table(tables[table], wanted, table, n) for table, wanted in by_table.items()]
    empty = [(sql_id, 1, [], 1) for sql_id, (_, mappings) in specs.items() if not mappings]
    if empty:
        parts.append(spark.createDataFrame(empty, f"sqlId string, sampleIndex int, values array<{SAMPLE_VALUE}>, collectedSampleCount int"))
    if not parts:
        raise ValueError("no sampling specs")
    return reduce(DataFrame.unionByName, parts)


def parameter_names(values) -> Column:
    return F.array_join(F.transform(values, lambda v: v.getField("parameterName")), "|")


def parameter_types(values) -> Column:
    return F.array_join(F.transform(values, lambda v: v.getField("javaType")), "|")


def capture_baseline(
    spark: SparkSession,
    candidates: DataFrame,
    samples: DataFrame,
    side_a: SparkSession,
    side_b: SparkSession,
    path: str | None = None,
    run_id: str | None = None,
    places: dict[str, str] | None = None,
    requested: int = SAMPLE_SIZE,
    max_rows: int | None = None,
    timeout_s: float | None = None,
    scale: int | None = None,
    workers: int = 4,
    journal: str | None = None,
    sources: str | None = None,
) -> DataFrame:
    """Run executable candidates with their samples on both sides and return the baseline rows.

    The target is checked before anything runs. Side B runs only for statements that passed there. With a ``journal``
    (a folder) a run that was stopped goes on where it ended. ``sources`` names a folder that gets the prints of the
    tables that the statements read on side B, by which a later comparison can tell drifted data.
    """
    if path:
        protect_baseline(spark, path)
    decided = capture_eligibility(candidates)
    cases = lookup_join(samples, executable_later(decided), ["sqlId"], how="inner")
    # Read once per side and once for the rows, so kept; a lost block is computed again.
    cases = cases.withColumn("executionOnly", F.col("eligibilityStatus") == "EXECUTION_ONLY").persist()
    runs = cases.select("sqlId", "sampleIndex", "jdbcSql", "values", "postgresValidationStatus")
    passed = says(F.col("postgresValidationStatus"), "PASSED")
    kept = lambda side: f"{journal.rstrip('/')}/{side}" if journal else None
    a = replay(spark, side_a, runs, max_rows, timeout_s, scale=scale, workers=workers, journal=kept("a"))
    on_b = replay(spark, side_b, runs.where(passed), max_rows, timeout_s, scale=scale, workers=workers, journal=kept("b"))
    if sources:
        save_sources(spark, side_b, cases.select("sqlId", "sampleIndex", "jdbcSql", "values", "baselineKey"), sources, key="baselineKey")
    b = on_b.unionByName(pending_side(runs.where(~passed)))
    keys = ["sqlId", "sampleIndex"]
    marks = cases.select(*keys, "executionOnly")
    judged = compare_results(join_sides(a, b, keys).join(marks, keys), execution_only=F.col("executionOnly"))
    overall = overall_status(judged.withColumn("aStatus", F.col("a.status")), ["sqlId"]).drop("sampleCount")
    rows = cases.join(judged.drop("executionOnly"), keys).join(overall, "sqlId")
    meta = {
        "baselineRunId": baseline_run_id(run_id),
        "baselineCreatedAt": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "normalizationVersion": normalization_version(max_rows, scale),
        "h2Database": "",
        "h2Schema": "",
        "postgresDatabaseAtCapture": "",
        "postgresSchemaAtCapture": "",
        **(places or {}),
    }
    described = (
        rows.withColumn("requestedSampleCount", F.lit(requested))
        .withColumn("parameterNames", parameter_names("values"))
        .withColumn("parameterTypes", parameter_types("values"))
        .withColumn("parameterValues", F.col("values"))
    )
    baseline = assemble_baseline_rows(described, meta)
    if path:
        try:
            write_baseline(baseline, path)
        finally:
            cases.unpersist()
        return scan_baseline(spark, path)
    return baseline


def compare_with_baseline(
    spark: SparkSession,
    baseline: DataFrame,
    candidates: DataFrame,
    open_side_b,
    path: str | None = None,
    database: str = "",
    schema: str = "",
    version: str | None = None,
    max_rows: int | None = None,
    timeout_s: float | None = None,
    scale: int | None = None,
    workers: int = 4,
    journal: str | None = None,
    sources: str | None = None,
) -> DataFrame:
    """One comparison row per saved sample, with the saved parameter values and side B run now.

    ``open_side_b`` is a function returning side B's session; it is called only when something runs. ``journal`` is as
    for ``capture_baseline``. With the ``sources`` that the capture wrote, another hash of a statement whose tables have
    changed since is POSSIBLE_DATA_DRIFT; only the tables of statements with another hash are read for that.
    """
    version = version or normalization_version(max_rows, scale)
    decided = compare_eligibility(match_baseline(baseline.drop("overallComparisonStatus"), candidates), version).persist()
    runs = decided.where(F.col("eligibilityStatus") == "AUTO_COMPARABLE").select(
        F.col("baselineKey").alias("sqlId"), "sampleIndex", F.col("current.jdbcSql").alias("jdbcSql"),
        F.col("parameterValues").alias("values"),
    )
    side_b = None
    if runs.limit(1).isEmpty():
        now = spark.createDataFrame([], SUMMARY_SCHEMA)
    else:
        side_b = open_side_b()
        now = replay(spark, side_b, runs, max_rows, timeout_s, scale=scale, workers=workers, journal=journal)
    b = now.select(
        F.col("sqlId").alias("baselineKey"), "sampleIndex",
        F.struct("status", "rowCount", "resultHash", "columnSignature", "executionTimeMs", "errorMessage").alias("b"),
    )
    not_run = F.struct(
        F.lit("NOT_EXECUTED").alias("status"), F.lit(None).cast("bigint").alias("rowCount"), F.lit("").alias("resultHash"),
        F.lit("").alias("columnSignature"), F.lit(None).cast("bigint").alias("executionTimeMs"),
        F.col("eligibilityReason").alias("errorMessage"),
    )
    joined = saved_side(decided).join(b, ["baselineKey", "sampleIndex"], "left")
    only_run = F.coalesce(F.col("sampleComparisonStatus") == "EXECUTION_ONLY", F.lit(False))
    ready = joined.withColumn("b", F.coalesce("b", not_run))
    judged = recheck_verdict(ready, execution_only=only_run)
    if side_b is not None and sources:
        # Only another hash can be laid to changed data, so only the tables of such statements are read for their prints.
        another = judged.where(F.col("differenceCategory") == "RESULT_HASH_MISMATCH").select(F.col("baselineKey").alias("sqlId")).distinct()
        drift = drifted(spark, side_b, runs.join(another, "sqlId", "left_semi"), sources)
        marked = ready.join(drift.withColumnRenamed("sqlId", "baselineKey"), "baselineKey", "left")
        judged = recheck_verdict(marked, execution_only=only_run, drifted=F.coalesce("dataDrifted", F.lit(False))).drop("dataDrifted")
    overall = overall_by_key(judged)
    rows = assemble_comparison_rows(judged.join(overall, "baselineKey", "left"), database, schema)
    if path:
        write_comparison(rows, path)
        decided.unpersist()
        return spark.read.parquet(path)
    return rows


def overall_by_key(judged: DataFrame) -> DataFrame:
    """One overall status per key; when nothing of a key ran, that of its rows as they stand.

    Never a match when one of the key's samples did not run.
    """
    ran = F.col("sampleComparisonStatus").isin("NOT_EXECUTED", "CURRENT_POSTGRES_NOT_READY")
    held = F.max(F.when(ran, overall_of_one(F.col("sampleComparisonStatus"))))
    by_rows = overall_status(judged.where(~ran).withColumn("aStatus", F.col("a.status")), ["baselineKey"])
    waiting = judged.groupBy("baselineKey").agg(held.alias("_held"))
    partly = F.col("_held").isNotNull() & F.col("overallComparisonStatus").isin("ALL_SAMPLES_MATCH", "EXECUTION_ONLY")
    status = F.when(partly, "PARTIAL_EXECUTION_FAILURE").otherwise(F.coalesce("overallComparisonStatus", "_held"))
    return waiting.join(by_rows.drop("sampleCount"), "baselineKey", "left").select("baselineKey", status.alias("overallComparisonStatus"))
