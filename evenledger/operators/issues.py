"""Issue report: classification rules as data, ordering, counts and key figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenledger.functions.chain import first_match, first_verdict, lowered
from evenledger.functions.text import UPDATE_ALIAS, executed_text, lookup, original_text, text_signals
from evenledger.operators.ranking import dedupe, rank_rows
from evenledger.operators.skew import lookup_join

# Groups in report order with their display names.
GROUPS = {
    "PASSED": "Passed",
    "SQL_DIALECT_COMPATIBILITY": "SQL Dialect Compatibility",
    "SOURCE_SQL_DEFECT": "Source SQL Defect",
    "PARAMETER_TYPE_OR_BINDING": "Parameter Type / Binding",
    "DATABASE_ENVIRONMENT": "Database Environment",
    "MANUAL_REVIEW": "Manual Review",
}

# Issue types with their display names.
TYPES = {
    "PASSED": "Passed",
    "SEQUENCE_SYNTAX": "Oracle/H2 sequence syntax",
    "DUAL_TABLE": "Oracle DUAL table",
    "NVL_FUNCTION": "NVL function",
    "SYSDATE_FUNCTION": "SYSDATE function",
    "ROWNUM_PSEUDOCOLUMN": "ROWNUM pseudocolumn",
    "TO_CHAR_FUNCTION": "TO_CHAR compatibility",
    "TO_TIMESTAMP_FUNCTION": "TO_TIMESTAMP compatibility",
    "DATEADD_FUNCTION": "DATEADD function",
    "DATETIME_FUNCTION_SYNTAX": "Date/time function syntax",
    "UNSUPPORTED_FUNCTION": "Unsupported function",
    "QUOTED_IDENTIFIER_CASE_MISMATCH": "Quoted identifier / case mismatch",
    "UPDATE_TARGET_ALIAS": "UPDATE target alias in SET clause",
    "PARAMETER_TYPE_MISMATCH": "Java/SQL parameter type mismatch",
    "PARAMETER_BINDING_ERROR": "Parameter binding error",
    "COLUMN_NOT_FOUND": "Column not found",
    "RELATION_NOT_FOUND": "Table/view/relation not found",
    "IDENTIFIER_CASE_OR_QUOTING": "Identifier case or quoting",
    "MERGE_SYNTAX": "MERGE syntax compatibility",
    "GENERIC_SQL_SYNTAX": "SQL syntax error",
    "SKIPPED_OR_NOT_EXECUTED": "Skipped / not executed",
    "UNKNOWN": "Unknown / review required",
}

# What to do about each issue type; UNKNOWN has one sentence per way of getting there.
ADVICE = {
    "PASSED": "No action required.",
    "SKIPPED_OR_NOT_EXECUTED": "Review why the SQL was skipped or not executed before estimating migration work.",
    "PARAMETER_TYPE_MISMATCH": (
        "Align the Java parameter type with the PostgreSQL column/operator type "
        "or add an explicit cast only when business-safe."
    ),
    "PARAMETER_BINDING_ERROR": "Review positional/named parameter mapping and the generated binding plan.",
    "UPDATE_TARGET_ALIAS": (
        "For PostgreSQL UPDATE statements, remove the target-table alias from the left side of SET assignments."
    ),
    "SEQUENCE_SYNTAX": "Replace Oracle/H2 sequence syntax such as SEQ.NEXTVAL with PostgreSQL nextval('sequence_name').",
    "DUAL_TABLE": "Remove FROM DUAL and use a direct PostgreSQL SELECT expression.",
    "NVL_FUNCTION": "Replace NVL(expr1, expr2) with COALESCE(expr1, expr2).",
    "SYSDATE_FUNCTION": "Replace SYSDATE with CURRENT_TIMESTAMP or CURRENT_DATE according to the required precision.",
    "ROWNUM_PSEUDOCOLUMN": (
        "Replace ROWNUM filtering with LIMIT/FETCH FIRST or ROW_NUMBER() OVER (...), depending on semantics."
    ),
    "TO_CHAR_FUNCTION": "Review TO_CHAR argument types and format masks; add PostgreSQL-compatible casts or formats.",
    "TO_TIMESTAMP_FUNCTION": (
        "Replace Oracle/H2 TO_TIMESTAMP usage with a PostgreSQL-compatible timestamp expression and format mask."
    ),
    "DATEADD_FUNCTION": (
        "Replace DATEADD with PostgreSQL interval arithmetic, for example CURRENT_TIMESTAMP - INTERVAL '10 minutes'."
    ),
    "DATETIME_FUNCTION_SYNTAX": (
        "Use PostgreSQL CURRENT_TIMESTAMP without empty parentheses, or now(), after confirming expected behavior."
    ),
    "QUOTED_IDENTIFIER_CASE_MISMATCH": (
        'Review quoted identifiers such as "VALUE" or "ENTITY". '
        "PostgreSQL preserves quoted case exactly; use the actual column name/case."
    ),
    "COLUMN_NOT_FOUND": (
        "Confirm the source SQL column name against the migrated PostgreSQL schema; correct the SQL or schema mapping."
    ),
    "RELATION_NOT_FOUND": (
        "Confirm table/view migration, schema, search_path and identifier case before estimating SQL rewrite effort."
    ),
    "IDENTIFIER_CASE_OR_QUOTING": (
        "Review identifier qualification, aliases, quoting and Oracle/H2-specific object references."
    ),
    "UNSUPPORTED_FUNCTION": "Replace or rewrite the unsupported function with a PostgreSQL equivalent.",
    "MERGE_SYNTAX": (
        "Review MERGE syntax and target PostgreSQL version; "
        "rewrite to PostgreSQL-supported MERGE or UPSERT when required."
    ),
    "GENERIC_SQL_SYNTAX": "Review the PostgreSQL parser error position and convert the Oracle/H2-specific syntax.",
}
ADVICE_DYNAMIC = "Resolve the dynamic/manual SQL text before assigning migration effort."
ADVICE_FALLBACK = (
    "Manual review required. Use the original SQL, executed SQL, SQLState and PostgreSQL message together."
)

DIALECT = "SQL_DIALECT_COMPATIBILITY"
TEXT_TOO = "ERROR_MESSAGE_AND_SQL_TEXT"

# The ordered rules. Each is (condition, group, type, priority, source). A condition is
# SQL over: status, m (message), q (joined texts), string_bound, needs_review; all texts lower-cased.
RULES: tuple[tuple[str, str, str, str, str], ...] = (
    ("status = 'passed'", "PASSED", "PASSED", "None", "STATUS"),
    (
        "status like 'skipped%' or status in ('not_executed', 'not executed')",
        "MANUAL_REVIEW", "SKIPPED_OR_NOT_EXECUTED", "Review", "STATUS",
    ),
    (
        "contains(m, 'operator does not exist') and contains(m, 'character varying')"
        " and m rlike 'numeric|integer|bigint|date|timestamp' and string_bound",
        "PARAMETER_TYPE_OR_BINDING", "PARAMETER_TYPE_MISMATCH", "High", "ERROR_MESSAGE_AND_BINDING_PLAN",
    ),
    (
        "contains(m, 'operator does not exist') and contains(m, 'character varying')"
        " and m rlike 'numeric|integer|bigint|date|timestamp'",
        "PARAMETER_TYPE_OR_BINDING", "PARAMETER_TYPE_MISMATCH", "High", "ERROR_MESSAGE",
    ),
    (
        "contains(m, 'parameter') and m rlike 'bind|index'",
        "PARAMETER_TYPE_OR_BINDING", "PARAMETER_BINDING_ERROR", "High", "ERROR_MESSAGE",
    ),
    (
        "contains(m, 'column') and contains(m, 'of relation') and contains(m, 'does not exist') and alias_in_set",
        DIALECT, "UPDATE_TARGET_ALIAS", "High", TEXT_TOO,
    ),
    (
        "contains(m, 'missing from-clause entry for table') and contains(m, 'seq')",
        DIALECT, "SEQUENCE_SYNTAX", "High", TEXT_TOO,
    ),
    (
        "contains(m, 'relation \"dual\" does not exist') or contains(q, ' from dual')",
        DIALECT, "DUAL_TABLE", "High", TEXT_TOO,
    ),
    ("contains(m, 'function nvl(') or contains(q, 'nvl(')", DIALECT, "NVL_FUNCTION", "High", TEXT_TOO),
    (
        "contains(m, 'column \"sysdate\" does not exist') or contains(q, 'sysdate')",
        DIALECT, "SYSDATE_FUNCTION", "High", TEXT_TOO,
    ),
    (
        "contains(m, 'column \"rownum\" does not exist') or contains(q, 'rownum')",
        DIALECT, "ROWNUM_PSEUDOCOLUMN", "High", TEXT_TOO,
    ),
    ("contains(m, 'function to_char(') or contains(q, 'to_char(')", DIALECT, "TO_CHAR_FUNCTION", "Medium", TEXT_TOO),
    (
        "contains(m, 'function to_timestamp(') or contains(q, 'to_timestamp(')",
        DIALECT, "TO_TIMESTAMP_FUNCTION", "Medium", TEXT_TOO,
    ),
    ("contains(m, 'function dateadd(') or contains(q, 'dateadd(')", DIALECT, "DATEADD_FUNCTION", "High", TEXT_TOO),
    ("contains(q, 'current_timestamp()')", DIALECT, "DATETIME_FUNCTION_SYNTAX", "Medium", "SQL_TEXT"),
    (
        "contains(m, 'column') and contains(m, 'does not exist') and (contains(q, '\"value\"') or contains(q, '\"entity\"')"
        " or contains(m, 'column \"value\"') or contains(m, 'column \"entity\"'))",
        DIALECT, "QUOTED_IDENTIFIER_CASE_MISMATCH", "Medium", TEXT_TOO,
    ),
    (
        "contains(m, 'column') and contains(m, 'does not exist')",
        "SOURCE_SQL_DEFECT", "COLUMN_NOT_FOUND", "High", "ERROR_MESSAGE",
    ),
    (
        "contains(m, 'relation') and contains(m, 'does not exist')",
        "DATABASE_ENVIRONMENT", "RELATION_NOT_FOUND", "Environment", "ERROR_MESSAGE",
    ),
    ("contains(m, 'missing from-clause entry')", DIALECT, "IDENTIFIER_CASE_OR_QUOTING", "Medium", "ERROR_MESSAGE"),
    (
        "contains(m, 'function') and contains(m, 'does not exist')",
        DIALECT, "UNSUPPORTED_FUNCTION", "Medium", "ERROR_MESSAGE",
    ),
    ("contains(q, 'merge into')", DIALECT, "MERGE_SYNTAX", "Medium", "SQL_TEXT"),
    ("contains(m, 'syntax error') or contains(m, '42601')", DIALECT, "GENERIC_SQL_SYNTAX", "Medium", "ERROR_MESSAGE"),
    ("needs_review", "MANUAL_REVIEW", "UNKNOWN", "Review", "SQL_TEXT"),
)
FALLBACK = ("MANUAL_REVIEW", "UNKNOWN", "Review", "FALLBACK")

# SQL states and the category each one stands for.
ERROR_CATEGORIES = {
    "42601": "SYNTAX_ERROR",
    "42P01": "RELATION_NOT_FOUND",
    "42703": "COLUMN_NOT_FOUND",
    "42883": "FUNCTION_NOT_FOUND",
    "42804": "TYPE_MISMATCH",
    "42702": "AMBIGUOUS_COLUMN",
    "42501": "PERMISSION_DENIED",
    "57014": "TIMEOUT",
    "23505": "UNIQUE_VIOLATION",
    "23503": "FOREIGN_KEY_VIOLATION",
}


def error_category(state: Column) -> Column:
    return lookup(state, ERROR_CATEGORIES, "UNKNOWN_POSTGRES_ERROR")


# Plan statuses that are never run, and statement types each mode runs.
PLAN_STOPS = ("MANUAL_REQUIRED", "UNSUPPORTED_PARAMETER_STYLE", "EMPTY_SQL", "SKIPPED_DYNAMIC_SQL")
DML_TYPES = ("INSERT", "UPDATE", "DELETE", "MERGE")


def exec_status(df: DataFrame, mode: str) -> DataFrame:
    """Outcome of a validation run from what was recorded: plan status, statement type, SQL state.

    ``sqlState`` is null where the statement ran without an error. Modes: EXPLAIN, SELECT_SMOKE,
    DML_SAFETY, REAL_EXECUTION.
    """
    failed = F.col("sqlState").isNotNull()
    outcome = [
        (failed, ("FAILED_SQL_COMPATIBILITY", error_category(F.col("sqlState")))),
    ]
    gates = {
        "EXPLAIN": [],
        "SELECT_SMOKE": [
            (F.col("statementType") != "SELECT", ("SKIPPED_SAFETY", "RISKY_SELECT_SKIPPED_FOR_SAFETY"))
        ],
        "DML_SAFETY": [
            (~F.col("statementType").isin(*DML_TYPES), ("SKIPPED_SAFETY", "DML_SKIPPED_FOR_SAFETY"))
        ],
        "REAL_EXECUTION": [(F.lit(True), ("SKIPPED_SAFETY", "UNKNOWN"))],
    }[mode]
    stopped = (
        F.col("planStatus").isin(*PLAN_STOPS),
        ("SKIPPED_MANUAL_REQUIRED", "PARAMETER_BINDING_ERROR"),
    )
    verdict = first_verdict(("executionStatus", "errorCategory"), [stopped, *gates, *outcome], ("PASSED", "NONE"))
    kept = [c for c in df.columns if c not in ("executionStatus", "errorCategory")]
    return df.withColumn("_v", verdict).select(*kept, F.lit(mode).alias("validationMode"), "_v.*")


def join_issue_inputs(
    executions: DataFrame, statements: DataFrame, bindings: DataFrame, keep: str | None = "last", order: str = "_pos"
) -> DataFrame:
    """Executions with their statement and what the rules need of their bindings.

    Bindings are reduced to one row per id (any String-typed, count), never to lists. Of statements with the same id
    the last one in input order counts (``keep="first"``: the first, None: all, each with a row of its own).
    """
    if keep:
        place = [order] if order in statements.columns else sorted(statements.columns)
        statements = dedupe(statements, ["sqlId"], place, keep)
    typed = bindings.groupBy("sqlId").agg(
        F.bool_or(F.contains(lowered(F.col("javaType")), F.lit("string"))).alias("stringBound"),
        F.count(F.lit(1)).alias("bindingRows"),
    )
    facts = statements.select(
        "sqlId", "serviceName", "filePath", "className", "methodName", "lineNumber", "sqlText",
        "normalizedSqlText", "dynamicSql", "requiresManualReview",
    )
    joined = lookup_join(executions, facts.join(typed, "sqlId", "full_outer"), ["sqlId"])
    return joined.withColumn("stringBound", F.coalesce("stringBound", F.lit(False))).withColumn(
        "bindingRows", F.coalesce("bindingRows", F.lit(0))
    )


def classify_issue(df: DataFrame, rules=RULES) -> DataFrame:
    """Adds issueGroup, issueType, priority, classificationSource, detectedSignals, recommendedAction."""
    texts = [F.col(c) for c in ("sqlText", "normalizedSqlText", "jdbcSql", "adaptedJdbcSql") if c in df.columns]
    joined = F.lower(F.concat_ws(" ", *[F.when(F.trim(t) != "", t) for t in texts]))
    facts = df.select(
        "*",
        lowered(F.col("executionStatus")).alias("status"),
        lowered(F.col("message")).alias("m"),
        joined.alias("q"),
        F.col("stringBound").alias("string_bound"),
        F.coalesce(F.col("requiresManualReview") | F.col("dynamicSql"), F.lit(False)).alias("needs_review"),
    ).withColumn("alias_in_set", F.col("q").rlike(UPDATE_ALIAS))

    def verdict(group, kind, priority, source):
        advice = ADVICE.get(kind, ADVICE_DYNAMIC if source == "SQL_TEXT" else ADVICE_FALLBACK)
        return group, kind, priority, source, advice

    names = ("issueGroup", "issueType", "priority", "classificationSource", "recommendedAction")
    chain = first_verdict(names, [(F.expr(cond), verdict(*rest)) for cond, *rest in rules], verdict(*FALLBACK))
    return facts.withColumn("_v", chain).select(*df.columns, "_v.*", text_signals(F.col("q")).alias("detectedSignals"))


def group_order(group: Column) -> Column:
    return first_match([(group == name, F.lit(i)) for i, name in enumerate(GROUPS)], F.lit(len(GROUPS)))


def type_name(kind: Column) -> Column:
    return lookup(kind, TYPES)


def issue_type_count(df: DataFrame) -> DataFrame:
    """Adds the number of rows of the same type. Only a few types exist, so their counts are broadcast."""
    counts = df.groupBy("issueType").agg(F.count(F.lit(1)).alias("issueTypeCount"))
    return df.join(F.broadcast(counts), "issueType", "left").select(*df.columns, "issueTypeCount")


def report_keys(df: DataFrame) -> DataFrame:
    """Sort columns of the report, all ascending."""
    return df.select(
        "*",
        group_order(F.col("issueGroup")).alias("_g"),
        (-F.col("issueTypeCount")).alias("_n"),
        type_name(F.col("issueType")).alias("_t"),
        F.coalesce("serviceName", F.lit("")).alias("_s"),
        F.coalesce("sqlId", F.lit("")).alias("_i"),
    )


REPORT_ORDER = ["_g", "_n", "_t", "_s", "_i"]


def report_order(df: DataFrame) -> DataFrame:
    """Rows in report order: group, type count down, type name, service, id."""
    return report_keys(df).orderBy(*REPORT_ORDER).drop(*REPORT_ORDER)


def inventory_order(df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in ("serviceName", "filePath", "lineNumber")])


def detail_report(classified: DataFrame, **split) -> DataFrame:
    """Classified rows with their rank in report order and the texts the report shows.

    Counting and ranking read the input several times: pass persisted or saved rows.
    """
    keyed = report_keys(issue_type_count(classified))
    ranked = rank_rows(keyed, REPORT_ORDER, "rank", **split).drop(*REPORT_ORDER)
    return ranked.withColumn("originalSql", original_text(F.col("normalizedSqlText"), F.col("sqlText"))).withColumn(
        "executedSql", executed_text(F.col("adaptedJdbcSql"), F.col("jdbcSql"))
    )


def issue_summary(classified: DataFrame) -> DataFrame:
    """One row per issue type with its share and rank; the window runs over at most one row per type."""
    counts = classified.groupBy("issueGroup", "issueType").agg(
        F.count(F.lit(1)).alias("issueCount"),
        F.min("priority").alias("priority"),
        F.min("recommendedAction").alias("recommendedAction"),
    )
    everything = Window.partitionBy(F.lit(0))
    ranked = everything.orderBy(group_order(F.col("issueGroup")), F.desc("issueCount"), type_name(F.col("issueType")))
    return counts.select(
        F.row_number().over(ranked).cast("long").alias("rank"),
        lookup(F.col("issueGroup"), GROUPS).alias("issueGroup"),
        type_name(F.col("issueType")).alias("issueType"),
        "issueCount",
        (F.col("issueCount") / F.sum("issueCount").over(everything)).alias("shareOfTotal"),
        "priority",
        "recommendedAction",
    )


def issue_kpis(classified: DataFrame) -> DataFrame:
    """Total, passed, needing attention, pass rate; one row of partial sums."""
    passed = F.count_if(F.col("issueGroup") == "PASSED")
    total = F.count(F.lit(1))
    return classified.agg(
        total.alias("totalSql"),
        passed.alias("passed"),
        (total - passed).alias("needsAttention"),
        F.coalesce(F.try_divide(passed.cast("double"), total.cast("double")), F.lit(0.0)).alias("passRate"),
    )
