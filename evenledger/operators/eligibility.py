"""Eligibility decisions as ordered rules. Status, code and sentence values are fixed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenledger.functions.canonical import NORMALIZATION_VERSION
from evenledger.functions.chain import blank, filled, first_verdict, nonblank, says
from evenledger.functions.text import canonicalize_text, select_flags

VERDICT = ("eligibilityStatus", "reasonCode", "eligibilityReason")
EXECUTABLE = ("AUTO_COMPARABLE", "BASELINE_ONLY", "EXECUTION_ONLY")


def is_stale(current_text: Column, report_text: Column) -> Column:
    """The report was made for another text; a blank report text counts as fresh."""
    return filled(report_text) & (canonicalize_text(current_text) != canonicalize_text(report_text))


def baseline_usable(status: Column, row_count: Column, digest: Column, signature: Column) -> Column:
    return says(status, "SUCCESS") & row_count.isNotNull() & filled(digest) & filled(signature)


def _decided(df: DataFrame, verdict: Column) -> DataFrame:
    return df.withColumn("_v", verdict).select(*[c for c in df.columns if c not in (*VERDICT, "_flags")], "_v.*")


def capture_eligibility(df: DataFrame) -> DataFrame:
    """May a candidate be captured into a baseline, and on which sides?"""
    c = F.col
    # A column of its own, so that the text is inspected once and not once per rule.
    df = df.withColumn("_flags", select_flags(c("jdbcSql")))
    flag = lambda name: F.col(f"_flags.{name}")
    found = lambda status: (status, flag("reason_code"), flag("reason"))
    manual_reason = F.coalesce(
        nonblank(c("manualReviewReason")), F.lit("The SQL is dynamic or still requires manual review.")
    )
    counts = F.concat(
        F.lit("Binding count "),
        c("bindingCount").cast("string"),
        F.lit(" does not match JDBC placeholder count "),
        c("placeholderCount").cast("string"),
        F.lit("."),
    )
    rules = [
        (c("sqlId").isNull(), ("NOT_ELIGIBLE", "NULL_CANDIDATE", "Candidate is null.")),
        (
            ~says(c("statementType"), "SELECT"),
            ("NOT_ELIGIBLE", "NOT_SELECT", "Cross Database baseline validation supports SELECT only."),
        ),
        (
            c("requiresManualReview") | c("dynamicSql"),
            ("MANUAL_MAPPING_REQUIRED", "MANUAL_SQL_REQUIRED", manual_reason),
        ),
        (
            blank(c("baselineKey")),
            ("MANUAL_BASELINE_MAPPING_REQUIRED", "BASELINE_KEY_MISSING", "A stable baseline key could not be generated."),
        ),
        (
            c("duplicateBaselineKey"),
            (
                "MANUAL_BASELINE_MAPPING_REQUIRED",
                "BASELINE_KEY_DUPLICATE",
                "More than one current SQL record has the same baseline key.",
            ),
        ),
        (
            ~c("bindingPlanPresent") | ~c("bindingPlanUsable"),
            ("MANUAL_MAPPING_REQUIRED", "BINDING_PLAN_UNUSABLE", "The binding plan is missing or not usable."),
        ),
        (c("bindingCount") != c("placeholderCount"), ("MANUAL_MAPPING_REQUIRED", "BINDING_COUNT_MISMATCH", counts)),
        (
            is_stale(c("jdbcSql"), c("executionReportJdbcSql")),
            (
                "STALE_VALIDATION_RESULT",
                "STALE_EXECUTION_REPORT",
                "The execution-report JDBC SQL differs from the current binding-plan JDBC SQL.",
            ),
        ),
        (~flag("select"), found("NOT_ELIGIBLE")),
        (flag("multi"), found("SKIPPED_UNSUPPORTED")),
        (flag("dynamic_identifier"), found("MANUAL_MAPPING_REQUIRED")),
        (flag("unsafe"), found("SKIPPED_UNSAFE")),
        (flag("non_deterministic"), found("EXECUTION_ONLY")),
        (
            says(c("postgresValidationStatus"), "PASSED"),
            ("AUTO_COMPARABLE", "POSTGRES_ALREADY_PASSED", "The SELECT can later execute on both H2 and PostgreSQL."),
        ),
    ]
    default = (
        "BASELINE_ONLY",
        "POSTGRES_MIGRATION_PENDING",
        "The SELECT is eligible for an H2 baseline; PostgreSQL execution is pending migration.",
    )
    return _decided(df, first_verdict(VERDICT, rules, default))


def executable_later(df: DataFrame) -> DataFrame:
    return df.where(F.col("eligibilityStatus").isin(*EXECUTABLE))


def compare_eligibility(df: DataFrame, version: str = NORMALIZATION_VERSION) -> DataFrame:
    """May a matched baseline row be compared now?

    Takes the output of ``match_baseline``: baseline columns, ``matchStatus``, ``matchReason`` and the
    candidate under ``current``.
    """
    c = F.col
    now = lambda name: F.col(f"current.{name}")
    if "_flags" not in df.columns:
        df = df.withColumn("_flags", select_flags(now("jdbcSql")))
    flag = lambda name: F.col(f"_flags.{name}")
    found = lambda status: (status, flag("reason_code"), flag("reason"))
    same_version = F.lower(F.trim(F.coalesce(c("normalizationVersion"), F.lit("")))) == version.strip().lower()
    rules = [
        (
            ~baseline_usable(c("h2ExecutionStatus"), c("h2RowCount"), c("h2ResultHash"), c("h2ColumnSignature")),
            ("NOT_ELIGIBLE", "H2_BASELINE_NOT_USABLE", "The saved H2 baseline is incomplete or unsuccessful."),
        ),
        (
            ~same_version,
            (
                "STALE_VALIDATION_RESULT",
                "NORMALIZATION_VERSION_MISMATCH",
                "The saved baseline normalization version differs from the current version.",
            ),
        ),
        (
            c("matchStatus") == "BASELINE_KEY_MISSING",
            ("MANUAL_BASELINE_MAPPING_REQUIRED", "BASELINE_KEY_MISSING", c("matchReason")),
        ),
        (
            c("matchStatus") != "MATCHED",
            (c("matchStatus"), c("matchStatus"), c("matchReason")),
        ),
        (
            ~says(now("statementType"), "SELECT"),
            ("SKIPPED_UNSUPPORTED", "CURRENT_SQL_NOT_SELECT", "The matched current statement is not SELECT."),
        ),
        (
            now("requiresManualReview") | now("dynamicSql"),
            (
                "MANUAL_MAPPING_REQUIRED",
                "CURRENT_SQL_MANUAL_REVIEW",
                "The matched current SQL is dynamic or requires manual review.",
            ),
        ),
        (
            ~now("bindingPlanPresent") | ~now("bindingPlanUsable"),
            (
                "MANUAL_MAPPING_REQUIRED",
                "CURRENT_BINDING_PLAN_UNUSABLE",
                "The current binding plan is missing or unusable.",
            ),
        ),
        (
            now("placeholderCount") != now("bindingCount"),
            (
                "MANUAL_MAPPING_REQUIRED",
                "CURRENT_BINDING_COUNT_MISMATCH",
                "Current JDBC placeholders do not match the binding count.",
            ),
        ),
        (
            ~says(now("postgresValidationStatus"), "PASSED"),
            (
                "CURRENT_POSTGRES_NOT_READY",
                "CURRENT_POSTGRES_NOT_READY",
                "Current PostgreSQL validation status is not PASSED.",
            ),
        ),
        (~flag("select") | flag("multi"), found("SKIPPED_UNSUPPORTED")),
        (flag("dynamic_identifier"), found("MANUAL_MAPPING_REQUIRED")),
        (flag("unsafe"), found("SKIPPED_UNSAFE")),
    ]
    default = (
        "AUTO_COMPARABLE",
        "READY_FOR_POSTGRES_BASELINE_COMPARISON",
        "The current PostgreSQL SQL is ready for comparison with the saved H2 baseline.",
    )
    return _decided(df, first_verdict(VERDICT, rules, default))


def case_eligibility(df: DataFrame, require_match: bool = True) -> DataFrame:
    """May a compared sample be timed? Adds ``eligible`` and ``ineligibleReason``."""
    c = F.col
    rules = [
        (~says(c("statementType"), "SELECT"), "Statement is not SELECT."),
        (~says(c("h2ExecutionStatus"), "SUCCESS"), "H2 execution is not SUCCESS."),
        (~says(c("postgresExecutionStatus"), "SUCCESS"), "PostgreSQL execution is not SUCCESS."),
    ]
    if require_match:
        rules.append((~says(c("sampleComparisonStatus"), "MATCH"), "Cross DB result is not MATCH."))
    rules += [
        (blank(c("h2JdbcSql")), "H2 JDBC SQL is missing."),
        (blank(c("postgresJdbcSql")), "PostgreSQL JDBC SQL is missing."),
        (c("parameterValues").isNull(), "Saved parameter values are missing."),
    ]
    verdict = first_verdict(
        ("eligible", "ineligibleReason"), [(cond, (F.lit(False), why)) for cond, why in rules], (F.lit(True), "")
    )
    return df.withColumn("_v", verdict).select(*df.columns, "_v.*")
