"""Keys, positions, duplicates, candidates and capture eligibility."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenledger.catalog.derive import (
    BINDINGS_SQL,
    EXECUTIONS_SQL,
    STATEMENTS_SQL,
    bindings,
    executions,
    sql_text,
    statements,
)
from evenledger.catalog.registry import query, table
from evenledger.catalog.text_queries import LEAD_RE, MASK_RE, flags_case, literal_case
from evenledger.functions import identity as ids
from evenledger.functions import text as tx
from evenledger.operators import ranking as rk
from evenledger.operators.bindings import aggregate_bindings
from evenledger.operators.candidates import build_candidates, flag_duplicate_keys
from evenledger.operators.eligibility import EXECUTABLE, capture_eligibility, executable_later, is_stale
from evenledger.operators.issues import inventory_order
from evenledger.operators.summaries import scan_summary, status_counts, union_scans

q = sql_text


def key_part(x: str) -> str:
    return f"lower(regexp_replace(replace(trim({x}), '|', '%7C'), '\\s+', ' ', 'g'))"


KEY_SQL = f"""CASE WHEN trim("serviceName") <> '' AND trim("className") <> '' AND trim("methodName") <> '' AND trim("sourceType") <> ''
  THEN concat_ws('|', {key_part('"serviceName"')}, {key_part('"className"')}, {key_part('"methodName"')}, {key_part('"sourceType"')},
    CASE WHEN trim("sqlVariableName") <> '' THEN {key_part('"sqlVariableName"')} ELSE '-' END, cast("occurrenceIndex" as varchar)) END"""
GROUP5 = """trim("serviceName"), trim("className"), trim("methodName"), trim("sourceType"), trim("sqlVariableName")"""
PLACED_SQL = f"""placed AS (SELECT *, row_number() OVER (PARTITION BY {GROUP5} ORDER BY "lineNumber", "sqlId") AS "occurrenceIndex" FROM statements),
keyed AS (SELECT *, coalesce({KEY_SQL}, '') AS "baselineKey" FROM placed)"""
AGGREGATED_SQL = """aggregated AS (SELECT "sqlId", coalesce(arg_min(trim("jdbcSql"), pos) FILTER (trim("jdbcSql") <> ''), '') AS "jdbcSql",
    coalesce(arg_min(trim("bindingStatus"), pos) FILTER (trim("bindingStatus") <> ''), '') AS "bindingStatus",
    CASE WHEN max("bindingCount") > 0 THEN max("bindingCount") ELSE count(DISTINCT "bindingIndex") END AS "bindingCount"
  FROM bindings GROUP BY 1)"""
USABLE = """(trim(coalesce(b."jdbcSql", '')) <> '' AND NOT regexp_matches(upper(coalesce(b."bindingStatus", '')), 'FAIL|ERROR|UNRESOLVED|INCOMPLETE|MANUAL'))"""


def two_way(x: str) -> str:
    return f"CASE WHEN regexp_matches(lower(regexp_replace({x}, {LEAD_RE}, '')), '^(select|with)\\b') THEN 'SELECT' ELSE 'UNKNOWN' END"


JOINED_SQL = f"""joined AS (SELECT k."sqlId", k."baselineKey", "serviceName", "filePath", "className", "methodName", "sourceType", "sqlVariableName",
    "occurrenceIndex", "lineNumber", "sqlText" AS "originalSql", "normalizedSqlText" AS "normalizedSql",
    coalesce(b."jdbcSql", '') AS "jdbcSql", coalesce(e."jdbcSql", '') AS "executionReportJdbcSql",
    {two_way('''CASE WHEN trim(coalesce(b."jdbcSql", '')) = '' THEN "normalizedSqlText" ELSE b."jdbcSql" END''')} AS "statementType",
    "dynamicSql", "requiresManualReview", "manualReviewReason", confidence, b."sqlId" IS NOT NULL AS "bindingPlanPresent",
    b."sqlId" IS NOT NULL AND {USABLE} AS "bindingPlanUsable", coalesce(b."bindingStatus", '') AS "bindingPlanStatus",
    coalesce(b."bindingCount", 0) AS "bindingCount",
    length(regexp_replace(regexp_replace(coalesce(b."jdbcSql", ''), {MASK_RE}, '', 'g'), '[^?]', '', 'g')) AS "placeholderCount",
    coalesce(e."executionStatus", '') AS "postgresValidationStatus"
  FROM keyed k LEFT JOIN aggregated b ON b."sqlId" = k."sqlId" LEFT JOIN executions e ON e."sqlId" = k."sqlId"),
candidates AS (SELECT *, "baselineKey" <> '' AND count(*) OVER (PARTITION BY "baselineKey") > 1 AS "duplicateBaselineKey" FROM joined)"""
CANDIDATES_SQL = ", ".join((STATEMENTS_SQL, BINDINGS_SQL, EXECUTIONS_SQL, PLACED_SQL, AGGREGATED_SQL, JOINED_SQL))


def candidate_rows(spark, sf_dir):
    return build_candidates(
        statements(spark, sf_dir), aggregate_bindings(bindings(spark, sf_dir)), executions(spark, sf_dir)
    )


@query("baseline_key", f'WITH {STATEMENTS_SQL}, {PLACED_SQL} SELECT "sqlId", {KEY_SQL} AS "baselineKey" FROM placed')
def _key(spark, sf_dir):
    placed = rk.occurrence_index(statements(spark, sf_dir))
    columns = ("serviceName", "className", "methodName", "sourceType", "sqlVariableName", "occurrenceIndex")
    return placed.select("sqlId", ids.baseline_key(*[F.col(c) for c in columns]).alias("baselineKey"))


@query("occurrence_index", f'WITH {STATEMENTS_SQL}, {PLACED_SQL} SELECT "sqlId", "occurrenceIndex" FROM placed')
def _occurrence(spark, sf_dir):
    return rk.occurrence_index(statements(spark, sf_dir)).select("sqlId", "occurrenceIndex")


@query(
    "assign_ids",
    f"""WITH {STATEMENTS_SQL} SELECT pos, "serviceName" || '-' || lpad(cast(n as varchar), greatest(4, length(cast(n as varchar)))::int, '0') AS id
    FROM (SELECT *, row_number() OVER (PARTITION BY "serviceName" ORDER BY "filePath", "lineNumber", pos) AS n FROM statements)""",
)
def _assign(spark, sf_dir):
    numbered = rk.assign_ids(statements(spark, sf_dir), order=("filePath", "lineNumber", "_pos"), out="id")
    return numbered.select(F.col("_pos").alias("pos"), "id")


@query(
    "flag_duplicate_keys",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
      count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS duplicate FROM lineitem""",
)
def _duplicates(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    keyed = li.withColumn("k", F.concat_ws("|", "l_orderkey", "l_linenumber"))
    return flag_duplicate_keys(keyed, "k", "duplicate").drop("k")


def _dedupe_sql(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in ("l_partkey", "l_suppkey", "l_extendedprice"))
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1"""


def _dedupe(spark, sf_dir, keep):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return rk.dedupe(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"], keep)


@query("dedupe_first", _dedupe_sql("ASC"))
def _dedupe_first(spark, sf_dir):
    return _dedupe(spark, sf_dir, "first")


@query("dedupe_last", _dedupe_sql("DESC"))
def _dedupe_last(spark, sf_dir):
    return _dedupe(spark, sf_dir, "last")


@query("build_candidates", f"WITH {CANDIDATES_SQL} SELECT * FROM candidates")
def _build(spark, sf_dir):
    return candidate_rows(spark, sf_dir)


CAPTURE_CODE = f"""CASE WHEN "statementType" <> 'SELECT' THEN 'NOT_SELECT'
  WHEN "requiresManualReview" OR "dynamicSql" THEN 'MANUAL_SQL_REQUIRED'
  WHEN trim("baselineKey") = '' THEN 'BASELINE_KEY_MISSING' WHEN "duplicateBaselineKey" THEN 'BASELINE_KEY_DUPLICATE'
  WHEN NOT "bindingPlanPresent" OR NOT "bindingPlanUsable" THEN 'BINDING_PLAN_UNUSABLE'
  WHEN "bindingCount" <> "placeholderCount" THEN 'BINDING_COUNT_MISMATCH'
  WHEN {{stale}} THEN 'STALE_EXECUTION_REPORT'
  WHEN {{flags}} = 'SAFE_SELECT' AND upper(trim("postgresValidationStatus")) = 'PASSED' THEN 'POSTGRES_ALREADY_PASSED'
  WHEN {{flags}} = 'SAFE_SELECT' THEN 'POSTGRES_MIGRATION_PENDING' ELSE {{flags}} END"""


def canonical(x: str) -> str:
    return f"trim(regexp_replace(trim(regexp_replace({x}, '\\s+', ' ', 'g')), ';+\\z', ''))"


STALE_SQL = f"""(trim("executionReportJdbcSql") <> '' AND {canonical('"jdbcSql"')} <> {canonical('"executionReportJdbcSql"')})"""
CAPTURED_SQL = f"""captured AS (SELECT *, {CAPTURE_CODE.format(stale=STALE_SQL, flags=flags_case('"jdbcSql"', MASK_RE))} AS "reasonCode" FROM candidates)"""
CAPTURE_STATUS = {
    "NOT_SELECT": "NOT_ELIGIBLE",
    "MANUAL_SQL_REQUIRED": "MANUAL_MAPPING_REQUIRED",
    "BASELINE_KEY_MISSING": "MANUAL_BASELINE_MAPPING_REQUIRED",
    "BASELINE_KEY_DUPLICATE": "MANUAL_BASELINE_MAPPING_REQUIRED",
    "BINDING_PLAN_UNUSABLE": "MANUAL_MAPPING_REQUIRED",
    "BINDING_COUNT_MISMATCH": "MANUAL_MAPPING_REQUIRED",
    "STALE_EXECUTION_REPORT": "STALE_VALIDATION_RESULT",
    "MULTIPLE_STATEMENTS": "SKIPPED_UNSUPPORTED",
    "DYNAMIC_IDENTIFIER": "MANUAL_MAPPING_REQUIRED",
    "UNSAFE_SELECT": "SKIPPED_UNSAFE",
    "NON_DETERMINISTIC_SELECT": "EXECUTION_ONLY",
    "POSTGRES_ALREADY_PASSED": "AUTO_COMPARABLE",
    "POSTGRES_MIGRATION_PENDING": "BASELINE_ONLY",
}
CAPTURE_REASON = {
    "NOT_SELECT": "Cross Database baseline validation supports SELECT only.",
    "BASELINE_KEY_MISSING": "A stable baseline key could not be generated.",
    "BASELINE_KEY_DUPLICATE": "More than one current SQL record has the same baseline key.",
    "BINDING_PLAN_UNUSABLE": "The binding plan is missing or not usable.",
    "STALE_EXECUTION_REPORT": "The execution-report JDBC SQL differs from the current binding-plan JDBC SQL.",
    "POSTGRES_ALREADY_PASSED": "The SELECT can later execute on both H2 and PostgreSQL.",
    "POSTGRES_MIGRATION_PENDING": "The SELECT is eligible for an H2 baseline; PostgreSQL execution is pending migration.",
    **{k: v for k, v in tx.SELECT_REASONS.items() if k != "NOT_SELECT"},
}
REASON_SQL = f"""CASE WHEN "reasonCode" = 'MANUAL_SQL_REQUIRED' THEN CASE WHEN trim("manualReviewReason") <> '' THEN trim("manualReviewReason")
    ELSE 'The SQL is dynamic or still requires manual review.' END
  WHEN "reasonCode" = 'BINDING_COUNT_MISMATCH' THEN 'Binding count ' || "bindingCount" || ' does not match JDBC placeholder count ' || "placeholderCount" || '.'
  ELSE {literal_case('"reasonCode"', CAPTURE_REASON)} END"""
ELIGIBLE_SQL = f"""eligible AS (SELECT *, {literal_case('"reasonCode"', CAPTURE_STATUS)} AS "eligibilityStatus", {REASON_SQL} AS "eligibilityReason" FROM captured)"""


@query(
    "capture_eligibility",
    f"""WITH {CANDIDATES_SQL}, {CAPTURED_SQL}, {ELIGIBLE_SQL} SELECT "sqlId", "eligibilityStatus", "reasonCode", "eligibilityReason" FROM eligible""",
)
def _capture(spark, sf_dir):
    return capture_eligibility(candidate_rows(spark, sf_dir)).select(
        "sqlId", "eligibilityStatus", "reasonCode", "eligibilityReason"
    )


@query(
    "executable_later",
    f"""WITH {CANDIDATES_SQL}, {CAPTURED_SQL}, {ELIGIBLE_SQL} SELECT "sqlId" FROM eligible
    WHERE "eligibilityStatus" IN ({', '.join(q(s) for s in EXECUTABLE)})""",
)
def _executable(spark, sf_dir):
    return executable_later(capture_eligibility(candidate_rows(spark, sf_dir))).select("sqlId")


@query("is_stale", f'WITH {CANDIDATES_SQL} SELECT "sqlId", {STALE_SQL} AS stale FROM candidates')
def _stale(spark, sf_dir):
    c = candidate_rows(spark, sf_dir)
    return c.select("sqlId", is_stale(F.col("jdbcSql"), F.col("executionReportJdbcSql")).alias("stale"))


@query(
    "status_counts",
    f"""WITH {CANDIDATES_SQL}, {CAPTURED_SQL}, {ELIGIBLE_SQL} SELECT "eligibilityStatus" AS status, count(*) AS "statementCount" FROM eligible
    GROUP BY 1 UNION ALL SELECT 'TOTAL', count(*) FROM eligible""",
)
def _status_counts(spark, sf_dir):
    return status_counts(capture_eligibility(candidate_rows(spark, sf_dir)))


@query(
    "scan_summary",
    f"""WITH {STATEMENTS_SQL} SELECT CASE WHEN grouping("sourceType") = 1 AND grouping(confidence) = 1 THEN 'all'
        WHEN grouping("sourceType") = 0 THEN 'sourceType' ELSE 'confidence' END AS grouping,
      coalesce("sourceType", confidence, '') AS value, count(*) AS total, count(*) FILTER ("requiresManualReview") AS "manualReview",
      count(*) FILTER ("dynamicSql") AS "dynamicSql" FROM statements GROUP BY GROUPING SETS ((), ("sourceType"), (confidence))""",
)
def _scan_summary(spark, sf_dir):
    return scan_summary(statements(spark, sf_dir))


@query(
    "inventory_order",
    f"""WITH {STATEMENTS_SQL} SELECT pos, "serviceName", "filePath", "lineNumber" FROM statements
    ORDER BY "serviceName" NULLS LAST, "filePath" NULLS LAST, "lineNumber" NULLS LAST""",
)
def _inventory_order(spark, sf_dir):
    return inventory_order(statements(spark, sf_dir)).select(F.col("_pos").alias("pos"), "serviceName", "filePath", "lineNumber")


_SCANS = """WITH {s}, scans AS (SELECT 0 AS scan, * FROM statements UNION ALL SELECT 1, * REPLACE ('SECOND' AS "sourceType") FROM statements
      WHERE confidence <> 'LOW' UNION ALL SELECT 2, * REPLACE ('THIRD' AS "sourceType", "lineNumber" + 1 AS "lineNumber") FROM statements)
    SELECT "sqlId", "sourceType", "lineNumber" FROM scans QUALIFY row_number() OVER
      (PARTITION BY "filePath", "lineNumber", "className", "methodName", "normalizedSqlText" ORDER BY scan, pos) = 1"""


@query("union_scans", _SCANS.format(s=STATEMENTS_SQL))
def _union(spark, sf_dir):
    s = statements(spark, sf_dir)
    second = s.where("confidence <> 'LOW'").withColumn("sourceType", F.lit("SECOND"))
    third = s.withColumn("sourceType", F.lit("THIRD")).withColumn("lineNumber", F.col("lineNumber") + 1)
    return union_scans(s, second, third).select("sqlId", "sourceType", "lineNumber")


@query(
    "profile_statements",
    _SCANS.format(s=STATEMENTS_SQL).replace('SELECT "sqlId", "sourceType", "lineNumber" FROM scans', ', kept AS (SELECT * FROM scans')
    + """) SELECT id, "sourceType", "parameterCount" FROM (SELECT "sourceType", "serviceName" || '-' || lpad(cast(n as varchar), greatest(4, length(cast(n as varchar)))::int, '0') AS id,
      (len(list_distinct(regexp_extract_all(regexp_replace("sqlText", ':{2,}', ' ', 'g'), ':([A-Za-z][A-Za-z0-9_]*)', 1)))
        + length(regexp_replace(regexp_replace("sqlText", '''[^'']*(?:''|\\z)', '', 'g'), '[^?]', '', 'g'))) AS "parameterCount"
      FROM (SELECT *, row_number() OVER (PARTITION BY "serviceName" ORDER BY "filePath", "lineNumber", pos, scan) AS n FROM kept))""",
)
def _profile(spark, sf_dir):
    from evenledger.plans.statements import profile_statements

    s = statements(spark, sf_dir)
    second = s.where("confidence <> 'LOW'").withColumn("sourceType", F.lit("SECOND"))
    third = s.withColumn("sourceType", F.lit("THIRD")).withColumn("lineNumber", F.col("lineNumber") + 1)
    inventory, _ = profile_statements(s, second, third)
    return inventory.select(F.col("sqlId").alias("id"), "sourceType", "parameterCount")


@query(
    "effective_id",
    """SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'B' || o_orderkey ELSE 'C' || o_custkey END AS effective,
      CASE WHEN o_custkey % 4 = 0 THEN CASE WHEN o_custkey % 3 = 0 THEN 'B' || o_orderkey ELSE 'C' || o_custkey END ELSE 'k' || o_custkey END AS grp FROM orders""",
)
def _effective_id(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = F.col("o_custkey")
    current = F.when(c % 3 == 0, " ").otherwise(F.concat(F.lit("C"), c))
    effective = ids.effective_id(current, F.concat(F.lit("B"), F.col("o_orderkey")))
    key = F.when(c % 4 == 0, "").otherwise(F.concat(F.lit("k"), c))
    return o.select("o_orderkey", effective.alias("effective"), ids.group_key(key, effective).alias("grp"))


@query(
    "case_id",
    """SELECT c_custkey, substr(regexp_replace(c_name || ' / ' || c_mktsegment || repeat('x', 60), '[^A-Za-z0-9._-]', '_', 'g'), 1, 64) || '-'
      || substr(sha256(c_mktsegment || c_custkey), 1, 8) AS case_id FROM customer""",
)
def _case_id(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    name = F.concat("c_name", F.lit(" / "), "c_mktsegment", F.lit("x" * 60))
    return c.select("c_custkey", ids.case_id(name, F.concat("c_mktsegment", "c_custkey")).alias("case_id"))


def current_case(c: str, usable: str, same_version: str) -> str:
    """Reason code of a later comparison, over matched m and candidate c."""
    flags = flags_case(f'{c}."jdbcSql"', MASK_RE)
    return f"""CASE WHEN NOT ({usable}) THEN 'H2_BASELINE_NOT_USABLE' WHEN NOT ({same_version}) THEN 'NORMALIZATION_VERSION_MISMATCH'
      WHEN "matchStatus" <> 'MATCHED' THEN "matchStatus" WHEN {c}."statementType" <> 'SELECT' THEN 'CURRENT_SQL_NOT_SELECT'
      WHEN {c}."requiresManualReview" OR {c}."dynamicSql" THEN 'CURRENT_SQL_MANUAL_REVIEW'
      WHEN NOT {c}."bindingPlanPresent" OR NOT {c}."bindingPlanUsable" THEN 'CURRENT_BINDING_PLAN_UNUSABLE'
      WHEN {c}."placeholderCount" <> {c}."bindingCount" THEN 'CURRENT_BINDING_COUNT_MISMATCH'
      WHEN upper({c}."postgresValidationStatus") <> 'PASSED' THEN 'CURRENT_POSTGRES_NOT_READY'
      WHEN {flags} IN ('SAFE_SELECT', 'NON_DETERMINISTIC_SELECT') THEN 'READY_FOR_POSTGRES_BASELINE_COMPARISON' ELSE {flags} END"""
