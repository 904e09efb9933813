"""Candidates: statements with their binding plan, execution outcome and stable key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenledger.functions.chain import blank, filled
from evenledger.functions.identity import baseline_key
from evenledger.functions.text import placeholder_count, statement_type
from evenledger.operators.bindings import binding_usable
from evenledger.operators.ranking import occurrence_index
from evenledger.operators.skew import lookup_join, spread_join

#: What names a statement's method; with its position there it makes the key.
METHOD = ("serviceName", "className", "methodName", "sourceType", "sqlVariableName")


def flag_duplicate_keys(df: DataFrame, key: str = "baselineKey", out: str = "duplicateBaselineKey") -> DataFrame:
    """True where a non-blank key occurs more than once.

    Keys are counted with map-side partial sums; only repeated ones are joined back. Blank keys are
    spread, and a key that holds many rows is split by the adaptive skew join.
    """
    named = df.withColumn("_key", F.when(filled(F.col(key)), F.col(key)))
    repeated = named.where("_key is not null").groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    flagged = spread_join(named, repeated.select("_key", F.lit(True).alias(out)), ["_key"])
    return flagged.select(*df.columns, F.coalesce(out, F.lit(False)).alias(out))


def _flag_shared_stems(placed: DataFrame, statements: DataFrame) -> DataFrame:
    """``flag_duplicate_keys`` of the keys of numbered statements, without a shuffle of the statements.

    Positions of a method run from 1 to its number of statements, so a key is met twice where another method with the
    same key but for the position has as many statements. Only methods that share that stem are joined back.
    """
    trimmed = [f"_t{i}" for i in range(len(METHOD))]
    names = [F.coalesce(F.trim(c), F.lit("")) for c in METHOD]
    sizes = statements.groupBy(*[c.alias(t) for c, t in zip(names, trimmed)]).agg(F.count(F.lit(1)).alias("_rows"))
    stem = baseline_key(*[F.col(t) for t in trimmed], F.lit(""))
    stems = sizes.select(F.struct(*trimmed).alias("_method"), "_rows", stem.alias("_stem")).where("_stem is not null")
    shared = stems.groupBy("_stem").agg(F.count(F.lit(1)).alias("_n"), F.max("_rows").alias("_most"), F.max_by("_method", F.struct("_rows", "_method")).alias("_first"))
    shared = shared.where("_n > 1")
    other = stems.join(shared, "_stem").where(F.col("_method") != F.col("_first")).groupBy("_stem").agg(F.max("_rows").alias("_second"))
    met = stems.join(shared, "_stem").join(other, "_stem").select(
        *[F.col(f"_method.{t}").alias(t) for t in trimmed],
        F.when(F.col("_method") == F.col("_first"), F.col("_second")).otherwise(F.col("_most")).alias("_also"),
    )
    flagged = placed.select("*", *[c.alias(t) for c, t in zip(names, trimmed)]).join(met, trimmed, "left")
    return flagged.select(*placed.columns, F.coalesce(F.col("occurrenceIndex") <= F.col("_also"), F.lit(False)).alias("duplicateBaselineKey"))


def build_candidates(
    statements: DataFrame, bindings: DataFrame, executions: DataFrame, unique_ids: bool = True
) -> DataFrame:
    """Statements left-joined to aggregated bindings and to one execution row per id.

    With ``unique_ids=False`` a repeated id takes its last position everywhere, so that its rows
    share a key and are flagged as duplicates.
    """
    placed = occurrence_index(statements)
    if unique_ids:
        placed = _flag_shared_stems(placed, statements)
    else:
        last = placed.groupBy("sqlId").agg(F.max("occurrenceIndex").alias("_last"))
        placed = lookup_join(placed, last, ["sqlId"]).withColumn("occurrenceIndex", F.coalesce("_last", "occurrenceIndex"))
    keyed = placed.withColumn(
        "baselineKey",
        F.coalesce(
            baseline_key(*[F.col(c) for c in (*METHOD, "occurrenceIndex")]),
            F.lit(""),
        ),
    )
    plan = bindings.select("sqlId", "jdbcSql", "bindingStatus", "bindingCount", F.lit(True).alias("_plan"))
    run = executions.select(
        "sqlId", F.col("jdbcSql").alias("executionReportJdbcSql"), F.col("executionStatus").alias("postgresValidationStatus")
    )
    known = plan.join(run, "sqlId", "full_outer")
    joined = lookup_join(keyed if unique_ids else flag_duplicate_keys(keyed), known, ["sqlId"])
    text = F.coalesce("jdbcSql", F.lit(""))
    present = F.coalesce("_plan", F.lit(False))
    return joined.select(
        "sqlId",
        "baselineKey",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("serviceName", "filePath", "className", "methodName", "sourceType", "sqlVariableName")],
        "occurrenceIndex",
        "lineNumber",
        F.col("sqlText").alias("originalSql"),
        F.col("normalizedSqlText").alias("normalizedSql"),
        text.alias("jdbcSql"),
        F.coalesce("executionReportJdbcSql", F.lit("")).alias("executionReportJdbcSql"),
        statement_type(F.when(blank(text), F.col("normalizedSqlText")).otherwise(text), "select").alias("statementType"),
        F.coalesce("dynamicSql", F.lit(False)).alias("dynamicSql"),
        F.coalesce("requiresManualReview", F.lit(False)).alias("requiresManualReview"),
        F.coalesce("manualReviewReason", F.lit("")).alias("manualReviewReason"),
        F.coalesce("confidence", F.lit("")).alias("confidence"),
        present.alias("bindingPlanPresent"),
        (present & binding_usable(text, F.col("bindingStatus"))).alias("bindingPlanUsable"),
        F.coalesce("bindingStatus", F.lit("")).alias("bindingPlanStatus"),
        F.coalesce("bindingCount", F.lit(0)).alias("bindingCount"),
        placeholder_count(text).alias("placeholderCount"),
        F.coalesce("postgresValidationStatus", F.lit("")).alias("postgresValidationStatus"),
        "duplicateBaselineKey",
    )
