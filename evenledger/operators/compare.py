"""Comparing two sides: sample statuses, roll-ups per statement, matching against a saved baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenledger.functions.chain import blank, filled, first_match, first_verdict
from evenledger.functions.text import select_flags
from evenledger.operators.eligibility import baseline_usable
from evenledger.operators.skew import lookup_join
from evenledger.sources.contracts import BASELINE, COMPARISON

VERDICT = ("sampleComparisonStatus", "differenceCategory", "differenceMessage")
SUMMARY = ("status", "rowCount", "resultHash", "columnSignature", "executionTimeMs", "errorMessage")


def comparison_verdict(a: str = "a", b: str = "b", labels=("H2", "POSTGRES"), names=("H2", "PostgreSQL"),
                       execution_only: Column | None = None, drifted: Column | None = None) -> Column:
    """Struct (status, category, message) from two summary structs named ``a`` and ``b``.

    ``execution_only`` marks statements of which only status and count are compared; ``drifted``
    marks samples whose data is known to differ, which turns a hash mismatch into a drift warning.
    """
    x = lambda n: F.col(f"{a}.{n}")
    y = lambda n: F.col(f"{b}.{n}")
    status = lambda side: F.coalesce(side("status"), F.lit("NOT_EXECUTED"))
    too_large = (status(x) == "RESULT_TOO_LARGE") | (status(y) == "RESULT_TOO_LARGE")
    only_run = F.lit(False) if execution_only is None else F.coalesce(execution_only, F.lit(False))
    # A success without its count, or without the hash that is to be compared, is a failure of that side.
    lost = lambda side: side("rowCount").isNull() | (side("resultHash").isNull() & ~only_run)
    a_failed, b_failed = ((status(s) != "SUCCESS") | lost(s) for s in (x, y))
    counts_differ = ~x("rowCount").eqNullSafe(y("rowCount"))
    count_text = F.concat(
        F.lit(f"{names[0]} row count "), x("rowCount").cast("string"),
        F.lit(f" differs from {names[1]} row count "), y("rowCount").cast("string"), F.lit("."),
    )
    incomplete = F.lit("The result's count or hash is missing.")
    error = lambda side: F.when((status(side) == "SUCCESS") & lost(side), incomplete).otherwise(F.coalesce(side("errorMessage"), F.lit("")))
    rules = [
        (
            status(y) == "PENDING_SQL_MIGRATION",
            ("PENDING_SQL_MIGRATION", "NONE", f"{names[1]} execution is pending SQL migration."),
        ),
        (too_large, ("RESULT_TOO_LARGE", "RESULT_TOO_LARGE", "At least one database exceeded maxSelectRows.")),
        (a_failed & b_failed, ("BOTH_EXECUTION_FAILED", "UNKNOWN", "Both database executions failed.")),
        (a_failed, (f"{labels[0]}_EXECUTION_FAILED", f"{labels[0]}_EXECUTION_ERROR", error(x))),
        (b_failed, (f"{labels[1]}_EXECUTION_FAILED", f"{labels[1]}_EXECUTION_ERROR", error(y))),
    ]
    if execution_only is not None:
        rules.append((execution_only & ~counts_differ, ("EXECUTION_ONLY", "NONE", "")))
        rules.append((execution_only, ("MISMATCH", "ROW_COUNT_MISMATCH", count_text)))
    rules += [
        (
            ~x("columnSignature").eqNullSafe(y("columnSignature")),
            ("MISMATCH", "COLUMN_STRUCTURE_MISMATCH", "Normalized column signatures differ."),
        ),
        (counts_differ, ("MISMATCH", "ROW_COUNT_MISMATCH", count_text)),
    ]
    hashes_differ = ~x("resultHash").eqNullSafe(y("resultHash"))
    if drifted is not None:
        rules.append((hashes_differ & drifted, ("MISMATCH", "POSSIBLE_DATA_DRIFT", "Data versions differ.")))
    rules.append((hashes_differ, ("MISMATCH", "RESULT_HASH_MISMATCH", "Normalized result hashes differ.")))
    return first_verdict(VERDICT, rules, ("MATCH", "NONE", ""))


def _side(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    missing = {"executionTimeMs": "bigint", "errorMessage": "string", "columnSignature": "string"}
    fields = [
        F.col(c).alias(c) if c in df.columns else F.lit(None).cast(missing.get(c, "string")).alias(c) for c in SUMMARY
    ]
    return df.select(*keys, F.struct(*fields).alias(name))


def join_sides(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Summaries of two sides as structs ``a`` and ``b``, one row per sample of either side; null keys meet null keys."""
    left, right = _side(a, keys, "a"), _side(b, keys, "b").withColumnsRenamed({k: f"_{k}" for k in keys})
    same = None
    for k in keys:
        both = left[k].eqNullSafe(right[f"_{k}"])
        same = both if same is None else same & both
    joined = left.join(right, same, "full_outer")
    # A side without the row has a null struct, one with a null key has not.
    key = lambda k: F.when(F.col("a").isNotNull(), left[k]).otherwise(F.col(f"_{k}")).alias(k)
    return joined.select(*[key(k) for k in keys], "a", "b")


def compare_sides(a: DataFrame, b: DataFrame, keys: list[str], **verdict) -> DataFrame:
    """Joined summaries with the verdict of each sample; one that a side lacks was not executed there."""
    return compare_results(join_sides(a, b, keys), **verdict)


def compare_results(df: DataFrame, **verdict) -> DataFrame:
    """Adds the verdict columns to rows that hold two summary structs, ``a`` and ``b``."""
    return df.withColumn("_v", comparison_verdict(**verdict)).select(*df.columns, "_v.*")


def _failures(labels) -> list[str]:
    return [f"{labels[0]}_EXECUTION_FAILED", f"{labels[1]}_EXECUTION_FAILED", "BOTH_EXECUTION_FAILED", "RESULT_TOO_LARGE"]


def overall_status(df: DataFrame, keys: list[str], labels=("H2", "POSTGRES"), a_status: str = "aStatus") -> DataFrame:
    """One status per statement over its samples: partial sums first, one row per key shuffled per task.

    A row without a comparison status stands for a statement that got no sample.
    """
    status = F.col("sampleComparisonStatus")
    pending = status == "PENDING_SQL_MIGRATION"
    return df.groupBy(*keys).agg(
        first_match(
            [
                (F.count(status) == 0, "NO_SAMPLE_DATA"),
                (
                    F.bool_or(pending) & F.bool_and(~pending | (F.col(a_status) == "SUCCESS")),
                    "BASELINE_CAPTURED",
                ),
                (F.bool_or(pending), "PARTIAL_EXECUTION_FAILURE"),
                (F.bool_and(status == "MATCH"), "ALL_SAMPLES_MATCH"),
                (F.bool_and(status.isin("MATCH", "EXECUTION_ONLY")), "EXECUTION_ONLY"),
                (F.bool_or(status.isin(*_failures(labels))), "PARTIAL_EXECUTION_FAILURE"),
            ],
            "PARTIAL_MISMATCH",
        ).alias("overallComparisonStatus"),
        F.count(status).alias("sampleCount"),
    )


def overall_of_one(status: Column, labels=("H2", "POSTGRES")) -> Column:
    """The same labels from a single sample."""
    return first_match(
        [
            (status == "MATCH", "ALL_SAMPLES_MATCH"),
            (status == "MISMATCH", "PARTIAL_MISMATCH"),
            (status.isin(*_failures(labels)), "PARTIAL_EXECUTION_FAILURE"),
            (status == "CURRENT_POSTGRES_NOT_READY", "PENDING_SQL_MIGRATION"),
            (status == "EXECUTION_ONLY", "EXECUTION_ONLY"),
        ],
        "NOT_EXECUTED",
    )


def match_baseline(baseline: DataFrame, current: DataFrame, order: str = "sqlId") -> DataFrame:
    """Every baseline row with the one current candidate of its key, if there is exactly one.

    Current rows are reduced to one per key before the join; blank keys take no part in it. ``_flags`` are the safety
    flags of the candidate's text, found here once and not for each of its saved samples.
    """
    fields = [c for c in current.columns if c != "baselineKey"]
    by_key = (
        current.where(filled(F.col("baselineKey")))
        .groupBy("baselineKey")
        .agg(F.count(F.lit(1)).alias("_n"), F.min_by(F.struct(*fields), order).alias("_one"))
        .select("baselineKey", "_n", F.when(F.col("_n") == 1, F.col("_one")).alias("current"))
        .withColumn("_flags", F.when(F.col("_n") == 1, select_flags(F.col("current.jdbcSql"))))
    )
    keyed = baseline.withColumn("_raw", F.col("baselineKey")).withColumn(
        "baselineKey", F.when(filled(F.col("baselineKey")), F.col("baselineKey"))
    )
    joined = lookup_join(keyed, by_key, ["baselineKey"])
    key = F.col("_raw")
    verdict = first_verdict(
        ("matchStatus", "matchReason"),
        [
            (blank(key), ("BASELINE_KEY_MISSING", "The baseline row has no baselineKey.")),
            (F.col("_n").isNull(), ("BASELINE_KEY_NOT_FOUND", F.concat(F.lit("No current SQL matches baselineKey "), key))),
            (
                F.col("_n") > 1,
                ("AMBIGUOUS_BASELINE_KEY", F.concat(F.lit("Multiple current SQL records match baselineKey "), key)),
            ),
        ],
        ("MATCHED", ""),
    )
    columns = [key.alias("baselineKey") if c == "baselineKey" else F.col(c) for c in baseline.columns]
    return joined.withColumn("_m", verdict).select(*columns, "current", "_flags", "_m.*")


def saved_side(df: DataFrame) -> DataFrame:
    """The saved baseline as a result summary: SUCCESS without timing, or NOT_EXECUTED."""
    ok = baseline_usable(F.col("h2ExecutionStatus"), F.col("h2RowCount"), F.col("h2ResultHash"), F.col("h2ColumnSignature"))
    kept = lambda c: F.when(ok, F.col(c))
    return df.withColumn(
        "a",
        F.struct(
            F.when(ok, "SUCCESS").otherwise("NOT_EXECUTED").alias("status"),
            kept("h2RowCount").alias("rowCount"),
            kept("h2ResultHash").alias("resultHash"),
            kept("h2ColumnSignature").alias("columnSignature"),
            F.lit(None).cast("bigint").alias("executionTimeMs"),
            F.when(ok, "").otherwise("Saved H2 baseline is unusable.").alias("errorMessage"),
        ),
    )


def recheck_verdict(df: DataFrame, **verdict) -> DataFrame:
    """Verdicts of a later comparison: rows that may not run keep their eligibility reason."""
    runs = F.col("eligibilityStatus") == "AUTO_COMPARABLE"
    held = F.struct(
        F.when(F.col("eligibilityStatus") == "CURRENT_POSTGRES_NOT_READY", "CURRENT_POSTGRES_NOT_READY")
        .otherwise("NOT_EXECUTED")
        .alias(VERDICT[0]),
        F.lit("BASELINE_MAPPING_ERROR").alias(VERDICT[1]),
        F.col("eligibilityReason").alias(VERDICT[2]),
    )
    chosen = F.when(runs, comparison_verdict(**verdict)).otherwise(held)
    return df.withColumn("_v", chosen).select(*[c for c in df.columns if c not in VERDICT], "_v.*")


def assemble_baseline_rows(df: DataFrame, meta: dict[str, str]) -> DataFrame:
    """The 43 baseline columns from compared samples and the run's metadata."""
    side = lambda s, prefix: {
        f"{prefix}ExecutionStatus": f"{s}.status",
        f"{prefix}RowCount": f"{s}.rowCount",
        f"{prefix}ResultHash": f"{s}.resultHash",
        f"{prefix}ColumnSignature": f"{s}.columnSignature",
        f"{prefix}ExecutionTimeMs": f"{s}.executionTimeMs",
        f"{prefix}ErrorMessage": f"{s}.errorMessage",
    }
    sources = {
        **side("a", "h2"),
        **side("b", "postgres"),
        "h2JdbcSql": "jdbcSql",
        "postgresJdbcSqlAtCapture": "jdbcSql",
        "postgresValidationStatusAtCapture": "postgresValidationStatus",
    }
    return df.select(
        *[F.lit(meta[n]).alias(n) if n in meta else F.col(sources.get(n, n)).alias(n) for n in BASELINE]
    )


def assemble_comparison_rows(df: DataFrame, database: str, schema: str) -> DataFrame:
    """The 41 comparison columns; what a missing current side would give is empty text."""
    now = lambda n: F.coalesce(F.col(f"current.{n}"), F.lit(""))
    special = {
        "baselineSqlId": F.col("sqlId"),
        "currentSqlId": now("sqlId"),
        "currentPostgresDatabase": F.lit(database),
        "currentPostgresSchema": F.lit(schema),
        "currentPostgresValidationStatus": now("postgresValidationStatus"),
        "currentPostgresJdbcSql": now("jdbcSql"),
        "baselineH2JdbcSql": F.col("h2JdbcSql"),
        "baselineH2ExecutionStatus": F.col("h2ExecutionStatus"),
        "baselineH2RowCount": F.col("h2RowCount"),
        "baselineH2ResultHash": F.col("h2ResultHash"),
        "baselineH2ColumnSignature": F.col("h2ColumnSignature"),
        "currentPostgresExecutionStatus": F.col("b.status"),
        "currentPostgresRowCount": F.col("b.rowCount"),
        "currentPostgresResultHash": F.col("b.resultHash"),
        "currentPostgresColumnSignature": F.col("b.columnSignature"),
        "currentPostgresExecutionTimeMs": F.col("b.executionTimeMs"),
        "currentPostgresErrorMessage": F.col("b.errorMessage"),
    }
    return df.select(*[special.get(n, F.col(n)).alias(n) for n in COMPARISON])


def row_diff(a: DataFrame, b: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """Rows only on side A and only on side B per group, counting duplicates."""
    from evenledger.operators.results import _rows

    counted = lambda df, n: _rows(df, by, columns).groupBy(*by, "_row").agg(F.count(F.lit(1)).alias(n))
    both = counted(a, "_a").join(counted(b, "_b"), [*by, "_row"], "full_outer")
    gap = F.coalesce("_a", F.lit(0)) - F.coalesce("_b", F.lit(0))
    return both.groupBy(*by).agg(
        F.sum(F.greatest(gap, F.lit(0))).alias("onlyA"), F.sum(F.greatest(-gap, F.lit(0))).alias("onlyB")
    )
