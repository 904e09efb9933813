"""Issue classification and reports, run outcomes, validation summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenledger.catalog.derive import (
    BINDINGS_SQL,
    EXECUTIONS_SQL,
    STATES,
    STATEMENTS_SQL,
    bindings,
    executions,
    pick,
    sql_pick,
    sql_text,
    statements,
)
from evenledger.catalog.registry import query, table
from evenledger.catalog.text_queries import TYPE_CASE, alias_in_set, literal_case, signals_sql
from evenledger.functions.text import executed_text, original_text, statement_type
from evenledger.operators import issues as iss
from evenledger.operators import summaries as sm

q = sql_text
INPUT_SQL = f"""{STATEMENTS_SQL}, {BINDINGS_SQL}, {EXECUTIONS_SQL},
typed AS (SELECT "sqlId", bool_or(contains(lower("javaType"), 'string')) AS string_bound, count(*) AS n FROM bindings GROUP BY 1),
inputs AS (SELECT e."sqlId", e."executionStatus", e.message, e."jdbcSql", e."adaptedJdbcSql", e."sqlState", s."sqlText", s."normalizedSqlText",
    s."serviceName", s."filePath", s."lineNumber", coalesce(string_bound, false) AS string_bound, coalesce(n, 0) AS "bindingRows",
    coalesce(s."requiresManualReview" OR s."dynamicSql", false) AS needs_review, lower(e."executionStatus") AS status, lower(e.message) AS m,
    lower(concat_ws(' ', CASE WHEN trim(s."sqlText") <> '' THEN s."sqlText" END, CASE WHEN trim(s."normalizedSqlText") <> '' THEN s."normalizedSqlText" END,
      CASE WHEN trim(e."jdbcSql") <> '' THEN e."jdbcSql" END, CASE WHEN trim(e."adaptedJdbcSql") <> '' THEN e."adaptedJdbcSql" END)) AS q
  FROM executions e LEFT JOIN statements s ON s."sqlId" = e."sqlId" LEFT JOIN typed t ON t."sqlId" = e."sqlId"),
facts AS (SELECT *, {alias_in_set('q')} AS alias_in_set FROM inputs)"""


def _duck(condition: str) -> str:
    for words in ("'numeric|integer|bigint|date|timestamp'", "'bind|index'"):
        condition = condition.replace(f"m rlike {words}", f"regexp_matches(m, {words})")
    return condition


_ARMS = [(_duck(c), *rest) for c, *rest in iss.RULES] + [("true", *iss.FALLBACK)]


def _advice(kind: str, source: str) -> str:
    return iss.ADVICE.get(kind, iss.ADVICE_DYNAMIC if source == "SQL_TEXT" else iss.ADVICE_FALLBACK)


NUMBERED = "CASE " + " ".join(f"WHEN {arm[0]} THEN {i}" for i, arm in enumerate(_ARMS)) + " END"
VERDICT_ROWS = ", ".join(
    f"({i}, {q(g)}, {q(t)}, {q(p)}, {q(s)}, {q(_advice(t, s))}, {q(iss.GROUPS[g])}, {q(iss.TYPES[t])}, {list(iss.GROUPS).index(g)})"
    for i, (_, g, t, p, s) in enumerate(_ARMS)
)
CLASSIFIED_SQL = f"""{INPUT_SQL}, rules(rule, "issueGroup", "issueType", priority, "classificationSource", "recommendedAction", group_name, type_name, group_no) AS (VALUES {VERDICT_ROWS}),
classified AS (SELECT f.*, r.*, {signals_sql('q')} AS "detectedSignals" FROM (SELECT *, {NUMBERED} AS rule_no FROM facts) f JOIN rules r ON r.rule = f.rule_no),
counted AS (SELECT *, count(*) OVER (PARTITION BY "issueType") AS "issueTypeCount" FROM classified)"""


def classified(spark, sf_dir):
    return iss.classify_issue(
        iss.join_issue_inputs(executions(spark, sf_dir), statements(spark, sf_dir), bindings(spark, sf_dir))
    )


@query("join_issue_inputs", f'WITH {INPUT_SQL} SELECT "sqlId", "serviceName", "sqlText", string_bound AS "stringBound", "bindingRows" FROM inputs')
def _inputs(spark, sf_dir):
    joined = iss.join_issue_inputs(executions(spark, sf_dir), statements(spark, sf_dir), bindings(spark, sf_dir))
    return joined.select("sqlId", "serviceName", "sqlText", "stringBound", "bindingRows")


@query(
    "classify_issue",
    f"""WITH {CLASSIFIED_SQL} SELECT "sqlId", "issueGroup", "issueType", priority, "classificationSource", "detectedSignals", "recommendedAction" FROM classified""",
)
def _classify(spark, sf_dir):
    return classified(spark, sf_dir).select(
        "sqlId", "issueGroup", "issueType", "priority", "classificationSource", "detectedSignals", "recommendedAction"
    )


@query("issue_type_count", f'WITH {CLASSIFIED_SQL} SELECT "sqlId", "issueTypeCount" FROM counted')
def _type_count(spark, sf_dir):
    return iss.issue_type_count(classified(spark, sf_dir)).select("sqlId", "issueTypeCount")


ORDER_SQL = """group_no, "issueTypeCount" DESC, type_name, coalesce("serviceName", ''), "sqlId" """


@query("report_order", f'WITH {CLASSIFIED_SQL} SELECT "sqlId", "issueGroup", "issueType" FROM counted ORDER BY {ORDER_SQL}')
def _order(spark, sf_dir):
    return iss.report_order(iss.issue_type_count(classified(spark, sf_dir))).select("sqlId", "issueGroup", "issueType")


@query("rank_rows", f'WITH {CLASSIFIED_SQL} SELECT "sqlId", row_number() OVER (ORDER BY {ORDER_SQL}) AS rank FROM counted')
def _rank(spark, sf_dir):
    return iss.detail_report(classified(spark, sf_dir)).select("sqlId", "rank")


@query(
    "join_issue_inputs_repeated_ids",
    f"""WITH {INPUT_SQL} SELECT "sqlId", "serviceName", 'second of ' || "sqlText" AS "sqlText", "bindingRows" FROM inputs""",
)
def _inputs_repeated(spark, sf_dir):
    """Every statement twice in the input; the later one counts and no execution is doubled."""
    s = statements(spark, sf_dir)
    later = s.withColumn("sqlText", F.concat(F.lit("second of "), "sqlText")).withColumn("_turn", F.lit(2))
    twice = s.withColumn("_turn", F.lit(1)).unionByName(later)
    joined = iss.join_issue_inputs(executions(spark, sf_dir), twice, bindings(spark, sf_dir), keep="last", order="_turn")
    return joined.select("sqlId", "serviceName", "sqlText", "bindingRows")


@query(
    "issue_report_detail",
    f"""WITH {CLASSIFIED_SQL} SELECT "sqlId", row_number() OVER (ORDER BY {ORDER_SQL}) AS rank, "issueType", "bindingRows",
      coalesce(CASE WHEN trim("normalizedSqlText") <> '' THEN "normalizedSqlText" END, "sqlText", '') AS "originalSql",
      coalesce(CASE WHEN trim("adaptedJdbcSql") <> '' THEN "adaptedJdbcSql" END, "jdbcSql", '') AS "executedSql" FROM counted""",
)
def _detail(spark, sf_dir):
    from evenledger.plans.reports import issue_report

    report = issue_report(executions(spark, sf_dir), statements(spark, sf_dir), bindings(spark, sf_dir))
    return report["detail"].select("sqlId", "rank", "issueType", "bindingRows", "originalSql", "executedSql")


@query(
    "executed_text",
    f"""WITH {INPUT_SQL} SELECT "sqlId", coalesce(CASE WHEN trim("adaptedJdbcSql") <> '' THEN "adaptedJdbcSql" END, "jdbcSql", '') AS executed,
      coalesce(CASE WHEN trim("normalizedSqlText") <> '' THEN "normalizedSqlText" END, "sqlText", '') AS original FROM inputs""",
)
def _executed(spark, sf_dir):
    joined = iss.join_issue_inputs(executions(spark, sf_dir), statements(spark, sf_dir), bindings(spark, sf_dir))
    return joined.select(
        "sqlId", executed_text(F.col("adaptedJdbcSql"), F.col("jdbcSql")).alias("executed"),
        original_text(F.col("normalizedSqlText"), F.col("sqlText")).alias("original"),
    )


@query(
    "issue_summary",
    f"""WITH {CLASSIFIED_SQL}, c AS (SELECT group_no, group_name, type_name, count(*) AS n, min(priority) AS priority, min("recommendedAction") AS a
      FROM classified GROUP BY 1, 2, 3)
    SELECT row_number() OVER (ORDER BY group_no, n DESC, type_name) AS rank, group_name AS "issueGroup", type_name AS "issueType", n AS "issueCount",
      n / sum(n) OVER () AS "shareOfTotal", priority, a AS "recommendedAction" FROM c""",
)
def _summary(spark, sf_dir):
    return iss.issue_summary(classified(spark, sf_dir))


@query(
    "issue_kpis",
    f"""WITH {CLASSIFIED_SQL} SELECT count(*) AS "totalSql", count(*) FILTER ("issueGroup" = 'PASSED') AS passed,
      count(*) FILTER ("issueGroup" <> 'PASSED') AS "needsAttention", count(*) FILTER ("issueGroup" = 'PASSED') / count(*) AS "passRate" FROM classified""",
)
def _kpis(spark, sf_dir):
    return iss.issue_kpis(classified(spark, sf_dir))


@query(
    "error_category",
    f"""SELECT event_id, {literal_case(sql_pick([*STATES, 'XX000'], 'event_id'), iss.ERROR_CATEGORIES, "'UNKNOWN_POSTGRES_ERROR'")} AS category FROM events""",
)
def _error_category(spark, sf_dir):
    state = pick([*STATES, "XX000"], F.col("event_id"))
    return table(spark, sf_dir, "events").select("event_id", iss.error_category(state).alias("category"))


PLAN_STATES = ["READY", "READY", "READY_WITH_LOW_CONFIDENCE", "READY", "MANUAL_REQUIRED", "EMPTY_SQL", "SKIPPED_DYNAMIC_SQL", "UNSUPPORTED_PARAMETER_STYLE"]
MODES = ("EXPLAIN", "SELECT_SMOKE", "DML_SAFETY", "REAL_EXECUTION")
GATES = {
    "EXPLAIN": "",
    "SELECT_SMOKE": "WHEN t <> 'SELECT' THEN 'RISKY_SELECT_SKIPPED_FOR_SAFETY'",
    "DML_SAFETY": "WHEN t NOT IN ('INSERT', 'UPDATE', 'DELETE', 'MERGE') THEN 'DML_SKIPPED_FOR_SAFETY'",
    "REAL_EXECUTION": "WHEN true THEN 'UNKNOWN'",
}


def outcomes(spark, sf_dir):
    """Every event as a run of its statement, in each of the four modes."""
    e = executions(spark, sf_dir).withColumn("planStatus", pick(PLAN_STATES, F.col("_pos")))
    e = e.withColumn("statementType", statement_type(F.col("jdbcSql"))).drop("validationMode")
    runs = None
    for mode in MODES:
        part = iss.exec_status(e, mode)
        runs = part if runs is None else runs.unionByName(part)
    return runs


_CATEGORY = {
    mode: f"""CASE WHEN plan IN ('MANUAL_REQUIRED', 'UNSUPPORTED_PARAMETER_STYLE', 'EMPTY_SQL', 'SKIPPED_DYNAMIC_SQL') THEN 'PARAMETER_BINDING_ERROR'
      {gate} WHEN "sqlState" IS NULL THEN 'NONE' ELSE {literal_case('"sqlState"', iss.ERROR_CATEGORIES, "'UNKNOWN_POSTGRES_ERROR'")} END"""
    for mode, gate in GATES.items()
}
OUTCOMES_SQL = f"""{EXECUTIONS_SQL}, run AS (SELECT "sqlId", "sqlState", pos, {sql_pick(PLAN_STATES, 'pos')} AS plan, {TYPE_CASE.replace('(text,', '("jdbcSql",')} AS t FROM executions),
modes AS ({' UNION ALL '.join(f'SELECT *, {q(m)} AS "validationMode", {c} AS "errorCategory" FROM run' for m, c in _CATEGORY.items())}),
outcomes AS (SELECT *, CASE WHEN "errorCategory" = 'PARAMETER_BINDING_ERROR' THEN 'SKIPPED_MANUAL_REQUIRED'
    WHEN "errorCategory" IN ('RISKY_SELECT_SKIPPED_FOR_SAFETY', 'DML_SKIPPED_FOR_SAFETY', 'UNKNOWN') THEN 'SKIPPED_SAFETY'
    WHEN "errorCategory" = 'NONE' THEN 'PASSED' ELSE 'FAILED_SQL_COMPATIBILITY' END AS "executionStatus" FROM modes)"""


@query("exec_status", f'WITH {OUTCOMES_SQL} SELECT "sqlId", "validationMode", "executionStatus", "errorCategory" FROM outcomes')
def _exec_status(spark, sf_dir):
    return outcomes(spark, sf_dir).select("sqlId", "validationMode", "executionStatus", "errorCategory")


def _filtered(*pairs) -> str:
    return ", ".join(f'count(*) FILTER ({cond}) AS "{name}"' for cond, name in pairs)


@query(
    "validation_summary",
    f"""WITH {OUTCOMES_SQL} SELECT count(*) AS "totalSql", {_filtered(
        ('"executionStatus" NOT LIKE \'SKIPPED%\'', 'eligibleSql'), ('"executionStatus" LIKE \'SKIPPED%\'', 'skippedSql'),
        ('"validationMode" = \'EXPLAIN\' AND "executionStatus" = \'PASSED\'', 'explainPassed'),
        ('"validationMode" = \'EXPLAIN\' AND "executionStatus" LIKE \'FAILED%\'', 'explainFailed'),
        ('"validationMode" = \'SELECT_SMOKE\' AND "executionStatus" = \'PASSED\'', 'smokePassed'),
        ('"validationMode" = \'SELECT_SMOKE\' AND "executionStatus" LIKE \'FAILED%\'', 'smokeFailed'),
        ('"errorCategory" = \'DML_SKIPPED_FOR_SAFETY\'', 'dmlSkipped'),
        ('"validationMode" = \'REAL_EXECUTION\' AND "executionStatus" NOT LIKE \'SKIPPED%\'', 'realExecutionAttempted'),
        ('"executionStatus" = \'SKIPPED_MANUAL_REQUIRED\'', 'manualParameterRequired'))} FROM outcomes""",
)
def _validation_summary(spark, sf_dir):
    return sm.validation_summary(outcomes(spark, sf_dir))


@query(
    "validation_top_errors",
    f"""WITH {OUTCOMES_SQL} SELECT "errorCategory" AS value, count(*) AS failures FROM outcomes WHERE "executionStatus" LIKE 'FAILED%'
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
)
def _top_errors(spark, sf_dir):
    return sm.top_values(outcomes(spark, sf_dir), "errorCategory", 5)


FIRST = ["PASSED", "FAILED_SQL_COMPATIBILITY", "FAILED_SQL_COMPATIBILITY", "FAILED_SQL_COMPATIBILITY"]
CATEGORIES = ["NONE", "SYNTAX_ERROR", "TYPE_MISMATCH", "PARAMETER_BINDING_ERROR", "COLUMN_NOT_FOUND"]


@query(
    "validation_outcome",
    f"""WITH r AS (SELECT event_id, {sql_pick(FIRST, 'event_id')} AS a, CASE WHEN user_id % 3 = 0 THEN 'PASSED' WHEN user_id % 3 = 1 THEN 'FAILED_SQL_COMPATIBILITY' END AS b,
      {sql_pick(CATEGORIES, '(event_id + user_id)')} AS c, event_id % 31 = 0 AS dynamic, event_type <> 'error' AS supported, user_id % 2 = 0 AS rewritten FROM events)
    SELECT event_id, CASE WHEN NOT supported THEN 'SKIPPED_UNSUPPORTED_SOURCE' WHEN dynamic THEN 'SKIPPED_DYNAMIC_SQL' WHEN a = 'PASSED' THEN 'PASS'
      WHEN b = 'PASSED' THEN 'FAIL_THEN_FIXED' WHEN c IN ('TYPE_MISMATCH', 'PARAMETER_BINDING_ERROR') THEN 'FAIL_PARAMETER_TYPE'
      WHEN rewritten AND b IS NOT NULL THEN 'FAIL_AFTER_FIX' ELSE 'MANUAL_REVIEW' END AS outcome FROM r""",
)
def _outcome(spark, sf_dir):
    k, u = F.col("event_id"), F.col("user_id")
    second = F.when(u % 3 == 0, "PASSED").when(u % 3 == 1, "FAILED_SQL_COMPATIBILITY")
    outcome = sm.validation_outcome(
        pick(FIRST, k), second, pick(CATEGORIES, k + u), k % 31 == 0, F.col("event_type") != "error", u % 2 == 0
    )
    return table(spark, sf_dir, "events").select("event_id", outcome.alias("outcome"))


OVERALL = ["ALL_SAMPLES_MATCH", "PARTIAL_MISMATCH", "PARTIAL_EXECUTION_FAILURE", "NO_SAMPLE_DATA", "EXECUTION_ONLY"]
SAMPLE = ["MATCH", "MISMATCH", "PENDING_SQL_MIGRATION", "NOT_EXECUTED", "EXECUTION_ONLY", "MATCH", "RESULT_TOO_LARGE"]
ELIGIBILITY = [
    "AUTO_COMPARABLE", "CURRENT_POSTGRES_NOT_READY", "MANUAL_MAPPING_REQUIRED", "BASELINE_KEY_NOT_FOUND",
    "AMBIGUOUS_BASELINE_KEY", "SKIPPED_UNSAFE", "SKIPPED_UNSUPPORTED", "MANUAL_BASELINE_MAPPING_REQUIRED",
]


def _keys(condition: str, name: str) -> str:
    return f'count(DISTINCT CASE WHEN {condition} THEN k END) AS "{name}"'


@query(
    "crossdb_kpis",
    f"""WITH r AS (SELECT CASE WHEN o_custkey % 40 = 0 THEN NULL ELSE 'k' || o_custkey END AS k, {sql_pick(OVERALL, 'o_custkey')} AS o,
      {sql_pick(SAMPLE, 'o_orderkey')} AS s, {sql_pick(ELIGIBILITY, '(o_custkey + o_orderkey)')} AS e FROM orders)
    SELECT count(DISTINCT k) AS "baselineSql", count(*) AS "baselineSamples", count(*) FILTER (s IN ('MATCH', 'MISMATCH', 'EXECUTION_ONLY')) AS "currentDualDbComparisons",
      {', '.join((_keys("o = 'ALL_SAMPLES_MATCH'", 'allSamplesMatched'), _keys("o = 'PARTIAL_MISMATCH'", 'partialMismatch'),
      _keys("o = 'PARTIAL_EXECUTION_FAILURE'", 'executionFailure'), _keys("s = 'PENDING_SQL_MIGRATION'", 'pendingSqlMigration'),
      _keys("e = 'CURRENT_POSTGRES_NOT_READY'", 'currentPostgresNotReady'), _keys("o = 'NO_SAMPLE_DATA'", 'noSampleData'),
      _keys("e = 'MANUAL_MAPPING_REQUIRED'", 'manualMappingRequired'),
      _keys("e IN ('MANUAL_BASELINE_MAPPING_REQUIRED', 'BASELINE_KEY_NOT_FOUND', 'AMBIGUOUS_BASELINE_KEY')", 'baselineMappingFailure'),
      _keys("e = 'SKIPPED_UNSAFE'", 'skippedUnsafe'), _keys("e = 'SKIPPED_UNSUPPORTED'", 'skippedUnsupported')))} FROM r""",
)
def _crossdb(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, sf_dir, "orders").select(
        F.when(c % 40 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), c)).alias("baselineKey"),
        pick(OVERALL, c).alias("overallComparisonStatus"), pick(SAMPLE, k).alias("sampleComparisonStatus"),
        pick(ELIGIBILITY, c + k).alias("eligibilityStatus"),
    )
    return sm.crossdb_kpis(rows)


# Executions with the verdict and the signals written out by hand:
# (status, message, text, a binding is a String, needs review) and (group, type, priority, source, signals).
D, TEXT_TOO = "SQL_DIALECT_COMPATIBILITY", "ERROR_MESSAGE_AND_SQL_TEXT"
BY_HAND = [
    (("PASSED", "column \"x\" does not exist", "SELECT NVL(a, 1) FROM t", False, True), ("PASSED", "PASSED", "None", "STATUS", "NVL")),
    (("Skipped_Safety", "", "SELECT ROWNUM", False, False), ("MANUAL_REVIEW", "SKIPPED_OR_NOT_EXECUTED", "Review", "STATUS", "ROWNUM")),
    (("NOT EXECUTED", "syntax error", "x", False, False), ("MANUAL_REVIEW", "SKIPPED_OR_NOT_EXECUTED", "Review", "STATUS", "")),
    (("FAILED", "operator does not exist: bigint = character varying", "SELECT a FROM t WHERE b = ?", True, False),
     ("PARAMETER_TYPE_OR_BINDING", "PARAMETER_TYPE_MISMATCH", "High", "ERROR_MESSAGE_AND_BINDING_PLAN", "PARAMETERIZED SQL")),
    (("FAILED", "Operator does not exist: DATE = character varying", "SELECT a FROM t", False, False),
     ("PARAMETER_TYPE_OR_BINDING", "PARAMETER_TYPE_MISMATCH", "High", "ERROR_MESSAGE", "")),
    (("FAILED", "operator does not exist: json = json", "SELECT 1", False, False), ("MANUAL_REVIEW", "UNKNOWN", "Review", "FALLBACK", "")),
    (("FAILED", "The column index is out of range: 2, number of parameters: 1", "SELECT :id", False, False),
     ("PARAMETER_TYPE_OR_BINDING", "PARAMETER_BINDING_ERROR", "High", "ERROR_MESSAGE", "PARAMETERIZED SQL")),
    (("FAILED", "column \"t\" of relation \"o\" does not exist", "UPDATE o t SET t.a = 1", False, False),
     (D, "UPDATE_TARGET_ALIAS", "High", TEXT_TOO, "UPDATE SET alias.column")),
    (("FAILED", "column \"t\" of relation \"o\" does not exist", "UPDATE o SET a = 1", False, False),
     ("SOURCE_SQL_DEFECT", "COLUMN_NOT_FOUND", "High", "ERROR_MESSAGE", "")),
    (("FAILED", "missing FROM-clause entry for table \"order_seq\"", "SELECT order_seq.NEXTVAL FROM dual", False, False),
     (D, "SEQUENCE_SYNTAX", "High", TEXT_TOO, "SEQUENCE/NEXTVAL; DUAL")),
    (("FAILED", "relation \"dual\" does not exist", "SELECT 1", False, False), (D, "DUAL_TABLE", "High", TEXT_TOO, "")),
    (("FAILED", "some error", "SELECT Nvl(a, b), SYSDATE FROM t", False, False), (D, "NVL_FUNCTION", "High", TEXT_TOO, "NVL; SYSDATE")),
    (("FAILED", "column \"sysdate\" does not exist", "SELECT 1", False, False), (D, "SYSDATE_FUNCTION", "High", TEXT_TOO, "")),
    (("FAILED", "", "SELECT a FROM t WHERE rownum <= 5", False, True), (D, "ROWNUM_PSEUDOCOLUMN", "High", TEXT_TOO, "ROWNUM")),
    (("FAILED", "function to_char(integer) does not exist", "SELECT 1", False, False), (D, "TO_CHAR_FUNCTION", "Medium", TEXT_TOO, "")),
    (("FAILED", "", "SELECT TO_TIMESTAMP('x', 'y')", False, False), (D, "TO_TIMESTAMP_FUNCTION", "Medium", TEXT_TOO, "TO_TIMESTAMP")),
    (("FAILED", "", "SELECT DATEADD('DAY', 1, b)", False, False), (D, "DATEADD_FUNCTION", "High", TEXT_TOO, "DATEADD")),
    (("FAILED", "syntax error at or near )", "SELECT CURRENT_TIMESTAMP()", False, False),
     (D, "DATETIME_FUNCTION_SYNTAX", "Medium", "SQL_TEXT", "CURRENT_TIMESTAMP()")),
    (("FAILED", "column \"VALUE\" does not exist", "SELECT v", False, False), (D, "QUOTED_IDENTIFIER_CASE_MISMATCH", "Medium", TEXT_TOO, "")),
    (("FAILED", "column c does not exist", "SELECT \"Entity\" FROM t", False, False),
     (D, "QUOTED_IDENTIFIER_CASE_MISMATCH", "Medium", TEXT_TOO, "QUOTED RESERVED IDENTIFIER")),
    (("FAILED", "relation \"t\" does not exist", "MERGE INTO t USING u", False, False),
     ("DATABASE_ENVIRONMENT", "RELATION_NOT_FOUND", "Environment", "ERROR_MESSAGE", "MERGE")),
    (("FAILED", "missing FROM-clause entry for table \"a\"", "SELECT a.b", False, False), (D, "IDENTIFIER_CASE_OR_QUOTING", "Medium", "ERROR_MESSAGE", "")),
    (("FAILED", "function f() does not exist", "SELECT f()", False, False), (D, "UNSUPPORTED_FUNCTION", "Medium", "ERROR_MESSAGE", "")),
    (("FAILED", "", "Merge Into t USING u", False, False), (D, "MERGE_SYNTAX", "Medium", "SQL_TEXT", "MERGE")),
    (("FAILED", "ERROR SQLState: 42601", "SELEC 1", False, True), (D, "GENERIC_SQL_SYNTAX", "Medium", "ERROR_MESSAGE", "")),
    (("FAILED", "deadlock", "SELECT 1", False, True), ("MANUAL_REVIEW", "UNKNOWN", "Review", "SQL_TEXT", "")),
    (("FAILED", "deadlock", "SELECT 1", True, False), ("MANUAL_REVIEW", "UNKNOWN", "Review", "FALLBACK", "")),
]
_HAND_ROWS = ", ".join(f"({i}, {', '.join(q(x) for x in verdict)})" for i, (_, verdict) in enumerate(BY_HAND))


@query(
    "classify_issue_by_hand",
    f"""SELECT o_orderkey, v.g AS "issueGroup", v.t AS "issueType", v.p AS priority, v.s AS "classificationSource", v.d AS "detectedSignals"
    FROM orders JOIN (VALUES {_HAND_ROWS}) v(i, g, t, p, s, d) ON i = o_orderkey % {len(BY_HAND)}""",
)
def _classify_by_hand(spark, sf_dir):
    k = F.col("o_orderkey")
    at = lambda n: pick([given[n] for given, _ in BY_HAND], k)
    flag = lambda n: (k % len(BY_HAND)).isin([i for i, (given, _) in enumerate(BY_HAND) if given[n]])
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", at(0).alias("executionStatus"), at(1).alias("message"), at(2).alias("sqlText"), F.lit(None).cast("string").alias("normalizedSqlText"),
        F.lit("").alias("jdbcSql"), F.lit("").alias("adaptedJdbcSql"), flag(3).alias("stringBound"), flag(4).alias("requiresManualReview"), F.lit(False).alias("dynamicSql"),
    )
    found = iss.classify_issue(rows)
    return found.select("o_orderkey", "issueGroup", "issueType", "priority", "classificationSource", "detectedSignals")
