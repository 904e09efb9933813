"""Column contracts. Names and order are part of the file formats."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One output column: the headers it may come from, its type and its default."""

    name: str
    aliases: tuple[str, ...]
    dtype: str = "string"
    default: object = ""


def _fields(*specs) -> tuple[Field, ...]:
    made = []
    for spec in specs:
        name, aliases, *rest = spec if isinstance(spec, tuple) else (spec, (spec,))
        made.append(Field(name, aliases, *rest))
    return tuple(made)


STATEMENTS = _fields(
    ("sqlId", ("id", "sqlId")),
    "serviceName",
    "moduleName",
    "filePath",
    "className",
    "methodName",
    "sourceType",
    ("lineNumber", ("lineNumber",), "int", -1),
    "sqlVariableName",
    "sqlText",
    "normalizedSqlText",
    "parameterMode",
    "parameterNames",
    ("parameterCount", ("parameterCount",), "int", 0),
    ("dynamicSql", ("isDynamicSql", "dynamicSql"), "boolean", False),
    ("requiresManualReview", ("requiresManualReview", "manualReview"), "boolean", False),
    "manualReviewReason",
    "confidence",
    "notes",
)

BINDINGS = _fields(
    ("sqlId", ("sqlId", "id")),
    ("jdbcSql", ("jdbcSql", "adaptedJdbcSql", "executedSql")),
    ("bindingStatus", ("bindingStatus", "bindingPlanStatus", "status")),
    ("bindingIndex", ("jdbcIndex", "bindingIndex", "parameterIndex")),
    ("bindingCount", ("bindingCount", "parameterCount", "jdbcParameterCount"), "int", 0),
    "parameterMode",
    "originalParameter",
    "javaParameterName",
    "javaType",
    "parameterKind",
    "mockValue",
    "confidence",
    "bindingNote",
)

EXECUTIONS = _fields(
    ("sqlId", ("sqlId", "id")),
    ("jdbcSql", ("jdbcSql", "executedSql")),
    "validationMode",
    ("executionStatus", ("executionStatus", "validationStatus", "status")),
    "sqlState",
    "postgresErrorCode",
    "errorCategory",
    "identifierStrategy",
    ("identifierAdaptationApplied", ("identifierAdaptationApplied",), "boolean", False),
    "identifierAdaptationMode",
    "adaptedJdbcSql",
    "identifierAdaptationNote",
    "message",
    "recommendation",
)

CASE_ROWS = _fields(
    "baselineRunId",
    "baselineKey",
    ("baselineSqlId", ("baselineSqlId", "sqlId")),
    ("currentSqlId", ("currentSqlId", "currentPostgresSqlId")),
    "statementType",
    ("sampleIndex", ("sampleIndex",), "int", 1),
    "parameterValues",
    ("h2JdbcSql", ("h2JdbcSql", "baselineH2JdbcSql")),
    ("postgresJdbcSql", ("currentPostgresJdbcSql", "postgresJdbcSql", "postgresJdbcSqlAtCapture")),
    ("h2ExecutionStatus", ("h2ExecutionStatus", "baselineH2ExecutionStatus")),
    ("postgresExecutionStatus", ("postgresExecutionStatus", "currentPostgresExecutionStatus")),
    "sampleComparisonStatus",
    ("h2ObservedTimeMs", ("h2ObservedTimeMs", "h2ExecutionTimeMs"), "bigint", None),
    (
        "postgresObservedTimeMs",
        ("postgresObservedTimeMs", "postgresExecutionTimeMs", "currentPostgresExecutionTimeMs"),
        "bigint",
        None,
    ),
)

BASELINE = (
    "baselineRunId baselineCreatedAt normalizationVersion baselineKey sqlId serviceName className methodName "
    "sourceType sqlVariableName occurrenceIndex statementType h2Database h2Schema postgresDatabaseAtCapture "
    "postgresSchemaAtCapture postgresValidationStatusAtCapture eligibilityStatus eligibilityReason sampleIndex "
    "requestedSampleCount collectedSampleCount parameterNames parameterTypes parameterValues h2JdbcSql "
    "h2ExecutionStatus h2RowCount h2ResultHash h2ColumnSignature h2ExecutionTimeMs h2ErrorMessage "
    "postgresJdbcSqlAtCapture postgresExecutionStatus postgresRowCount postgresResultHash postgresColumnSignature "
    "postgresExecutionTimeMs postgresErrorMessage sampleComparisonStatus overallComparisonStatus "
    "differenceCategory differenceMessage"
).split()

COMPARISON = (
    "baselineRunId baselineCreatedAt normalizationVersion baselineKey baselineSqlId currentSqlId serviceName "
    "className methodName sourceType sqlVariableName occurrenceIndex statementType h2Database h2Schema "
    "currentPostgresDatabase currentPostgresSchema currentPostgresValidationStatus eligibilityStatus "
    "eligibilityReason sampleIndex requestedSampleCount parameterNames parameterTypes parameterValues "
    "baselineH2JdbcSql baselineH2ExecutionStatus baselineH2RowCount baselineH2ResultHash baselineH2ColumnSignature "
    "currentPostgresJdbcSql currentPostgresExecutionStatus currentPostgresRowCount currentPostgresResultHash "
    "currentPostgresColumnSignature currentPostgresExecutionTimeMs currentPostgresErrorMessage "
    "sampleComparisonStatus overallComparisonStatus differenceCategory differenceMessage"
).split()

INTEGER_COLUMNS = {
    "occurrenceIndex": "int",
    "sampleIndex": "int",
    "requestedSampleCount": "int",
    "collectedSampleCount": "int",
    "h2RowCount": "bigint",
    "postgresRowCount": "bigint",
    "h2ExecutionTimeMs": "bigint",
    "postgresExecutionTimeMs": "bigint",
    "baselineH2RowCount": "bigint",
    "currentPostgresRowCount": "bigint",
    "currentPostgresExecutionTimeMs": "bigint",
}

BASELINE_FIELDS = tuple(
    Field(n, (n,), INTEGER_COLUMNS.get(n, "string"), {"occurrenceIndex": 1, "sampleIndex": 1}.get(n, 0 if n in (
        "requestedSampleCount", "collectedSampleCount") else (None if n in INTEGER_COLUMNS else "")))
    for n in BASELINE
)

STATEMENT_REPORT = (
    "id serviceName moduleName filePath className methodName sourceType lineNumber sqlVariableName sqlText "
    "normalizedSqlText parameterMode parameterNames parameterCount isDynamicSql requiresManualReview "
    "manualReviewReason confidence notes"
).split()
BINDING_REPORT = (
    "sqlId parameterMode originalParameter bindingIndex javaParameterName javaType parameterKind mockValue "
    "confidence bindingNote"
).split()
EXECUTION_REPORT = (
    "sqlId jdbcSql validationMode executionStatus postgresErrorCode errorCategory message"
).split()
SANITY_REPORT = (
    "id serviceName className methodName sourceType confidence requiresManualReview isDynamicSql "
    "effectiveSqlText parserSql sanityStatus sanityIssues parserError recommendation"
).split()
CASE_REPORT = (
    "caseId baselineKey baselineSqlId currentSqlId sampleIndex selectedSampleIndex selectionReason "
    "performanceStatus htmlReportPath errorCode errorMessage"
).split()
DETAIL_REPORT = (
    "rank sqlId serviceName className methodName lineNumber executionStatus issueGroup issueType priority "
    "detectedSignals classificationSource sqlState parameterSummary originalSql executedSql message "
    "recommendedAction filePath"
).split()
SUMMARY_REPORT = "rank issueGroup issueType issueCount shareOfTotal priority recommendedAction".split()
CROSSDB_SHORT = (
    "baselineKey baselineSqlId currentSqlId sampleIndex parameterValues h2ExecutionStatus "
    "postgresExecutionStatus sampleComparisonStatus h2ObservedTimeMs postgresObservedTimeMs performanceReport"
).split()
CROSSDB_LONG = (
    "baselineRunId baselineKey baselineSqlId currentSqlId serviceName className methodName statementType "
    "postgresValidationStatus eligibilityStatus eligibilityReason sampleIndex parameterNames parameterTypes "
    "parameterValues h2ExecutionStatus h2RowCount h2ExecutionTimeMs postgresExecutionStatus postgresRowCount "
    "postgresExecutionTimeMs sampleComparisonStatus overallComparisonStatus differenceCategory differenceMessage "
    "h2ErrorMessage postgresErrorMessage"
).split()


def schema_of(fields: tuple[Field, ...]) -> T.StructType:
    return T.StructType.fromDDL(",".join(f"`{f.name}` {f.dtype}" for f in fields))
