"""Comparing sides: verdicts, roll-ups, baseline matching, row contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenledger.catalog.candidate_queries import CANDIDATES_SQL, KEY_SQL, candidate_rows, current_case
from evenledger.catalog.derive import pick, sql_pick, sql_text, statements
from evenledger.catalog.registry import query, table
from evenledger.catalog.result_queries import ORDER_CELLS, ORDER_SIGNATURE, cells, changed_lineitem, digest
from evenledger.functions.canonical import NORMALIZATION_VERSION
from evenledger.functions.identity import baseline_key
from evenledger.operators import compare as cp
from evenledger.operators.eligibility import baseline_usable, compare_eligibility
from evenledger.operators.results import summarize_result
from evenledger.sources.contracts import BASELINE, COMPARISON

q = sql_text


@query(
    "compare_lineitem_by_year",
    """SELECT year(l_shipdate) AS ship_year, count(*) AS row_count_a, count(*) AS row_count_b,
      CASE WHEN bool_or(l_orderkey % 97 = 0) THEN 'MISMATCH' ELSE 'MATCH' END AS "sampleComparisonStatus",
      CASE WHEN bool_or(l_orderkey % 97 = 0) THEN 'RESULT_HASH_MISMATCH' ELSE 'NONE' END AS "differenceCategory"
    FROM lineitem GROUP BY 1""",
)
def compare_lineitem_by_year(spark, sf_dir):
    """Flagship: two copies of a table compared year by year with prints of unbounded size."""
    li = table(spark, sf_dir, "lineitem")
    side = lambda df: summarize_result(df.withColumn("ship_year", F.year("l_shipdate")), ["ship_year"], max_rows=None)
    compared = cp.compare_sides(side(li), side(changed_lineitem(spark, sf_dir)), ["ship_year"])
    return compared.select(
        "ship_year", F.col("a.rowCount").alias("row_count_a"), F.col("b.rowCount").alias("row_count_b"),
        "sampleComparisonStatus", "differenceCategory",
    )


A_STATES = ["SUCCESS", "SUCCESS", "EXECUTION_FAILED", "SUCCESS", "RESULT_TOO_LARGE", "SUCCESS", "SUCCESS", "NOT_EXECUTED", "SUCCESS"]
B_STATES = ["SUCCESS", "SUCCESS", "SUCCESS", "PENDING_SQL_MIGRATION", "SUCCESS", "EXECUTION_FAILED", "SUCCESS", "UNSUPPORTED_RESULT_TYPE"]


def summaries(spark, sf_dir):
    """One compared sample per order: two summary structs derived from the order."""
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")

    def side(status, count, digest_col, signature):
        return F.struct(
            status.alias("status"), count.alias("rowCount"), digest_col.alias("resultHash"),
            signature.alias("columnSignature"), (k % 100).alias("executionTimeMs"),
            F.when(status == "SUCCESS", "").otherwise(F.concat(F.lit("failed "), k)).alias("errorMessage"),
        )

    a = side(pick(A_STATES, k), k % 10, F.concat(F.lit("h"), k % 10), F.lit("ID:NUMBER"))
    b = side(
        pick(B_STATES, c),
        F.when(c % 23 == 0, k % 10 + 1).otherwise(k % 10),
        F.when(c % 5 == 0, "other").otherwise(F.concat(F.lit("h"), k % 10)),
        F.when(c % 19 == 0, "ID:STRING").otherwise("ID:NUMBER"),
    )
    return o.select(
        "o_orderkey", "o_custkey", (F.col("o_orderpriority") == "1-URGENT").alias("executionOnly"), a.alias("a"), b.alias("b")
    )


def verdict_sql(execution_only: bool = False) -> tuple[str, str, str]:
    """CASE texts of status, category and message over sa, sb, na, nb, ha, hb, ga, gb, ea, eb."""
    count_text = "'H2 row count ' || na || ' differs from PostgreSQL row count ' || nb || '.'"
    arms = [
        ("sb = 'PENDING_SQL_MIGRATION'", "'PENDING_SQL_MIGRATION'", "'NONE'", "'PostgreSQL execution is pending SQL migration.'"),
        (
            "sa = 'RESULT_TOO_LARGE' OR sb = 'RESULT_TOO_LARGE'", "'RESULT_TOO_LARGE'", "'RESULT_TOO_LARGE'",
            "'At least one database exceeded maxSelectRows.'",
        ),
        ("sa <> 'SUCCESS' AND sb <> 'SUCCESS'", "'BOTH_EXECUTION_FAILED'", "'UNKNOWN'", "'Both database executions failed.'"),
        ("sa <> 'SUCCESS'", "'H2_EXECUTION_FAILED'", "'H2_EXECUTION_ERROR'", "ea"),
        ("sb <> 'SUCCESS'", "'POSTGRES_EXECUTION_FAILED'", "'POSTGRES_EXECUTION_ERROR'", "eb"),
    ]
    if execution_only:
        arms += [
            ("eo AND na = nb", "'EXECUTION_ONLY'", "'NONE'", "''"),
            ("eo", "'MISMATCH'", "'ROW_COUNT_MISMATCH'", count_text),
        ]
    arms += [
        ("ga <> gb", "'MISMATCH'", "'COLUMN_STRUCTURE_MISMATCH'", "'Normalized column signatures differ.'"),
        ("na <> nb", "'MISMATCH'", "'ROW_COUNT_MISMATCH'", count_text),
        ("ha <> hb", "'MISMATCH'", "'RESULT_HASH_MISMATCH'", "'Normalized result hashes differ.'"),
        ("true", "'MATCH'", "'NONE'", "''"),
    ]
    return tuple("CASE " + " ".join(f"WHEN {arm[0]} THEN {arm[i]}" for arm in arms) + " END" for i in (1, 2, 3))


SUMMARIES_SQL = f"""sides AS (SELECT o_orderkey, o_custkey, o_orderpriority = '1-URGENT' AS eo,
    {sql_pick(A_STATES, 'o_orderkey')} AS sa, {sql_pick(B_STATES, 'o_custkey')} AS sb,
    o_orderkey % 10 AS na, CASE WHEN o_custkey % 23 = 0 THEN o_orderkey % 10 + 1 ELSE o_orderkey % 10 END AS nb,
    'h' || (o_orderkey % 10) AS ha, CASE WHEN o_custkey % 5 = 0 THEN 'other' ELSE 'h' || (o_orderkey % 10) END AS hb,
    'ID:NUMBER' AS ga, CASE WHEN o_custkey % 19 = 0 THEN 'ID:STRING' ELSE 'ID:NUMBER' END AS gb,
    'failed ' || o_orderkey AS ea, 'failed ' || o_orderkey AS eb FROM orders)"""
_S, _C, _M = verdict_sql(True)
VERDICTS_SQL = f"""{SUMMARIES_SQL}, verdicts AS (SELECT *, {_S} AS "sampleComparisonStatus", {_C} AS "differenceCategory",
    {_M} AS "differenceMessage" FROM sides)"""


def verdicts(spark, sf_dir):
    return cp.compare_results(summaries(spark, sf_dir), execution_only=F.col("executionOnly"))


@query(
    "compare_results",
    f'WITH {VERDICTS_SQL} SELECT o_orderkey, "sampleComparisonStatus", "differenceCategory", "differenceMessage" FROM verdicts',
)
def _compare_results(spark, sf_dir):
    return verdicts(spark, sf_dir).select("o_orderkey", *cp.VERDICT)


@query(
    "compare_sides",
    f"""WITH a AS (SELECT o_custkey, count(*) AS n, {digest(ORDER_SIGNATURE, cells(*ORDER_CELLS))} AS h FROM orders GROUP BY 1),
    changed AS (SELECT * REPLACE (CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
      FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderstatus <> 'P'),
    b AS (SELECT o_custkey, count(*) AS n, {digest(ORDER_SIGNATURE, cells(*ORDER_CELLS))} AS h FROM changed GROUP BY 1)
    SELECT o_custkey, CASE WHEN a.n > 20 OR b.n > 20 THEN 'RESULT_TOO_LARGE' WHEN b.n IS NULL THEN 'POSTGRES_EXECUTION_FAILED'
        WHEN a.n = b.n AND a.h = b.h THEN 'MATCH' ELSE 'MISMATCH' END AS "sampleComparisonStatus",
      CASE WHEN a.n > 20 OR b.n > 20 THEN 'RESULT_TOO_LARGE' WHEN b.n IS NULL THEN 'POSTGRES_EXECUTION_ERROR'
        WHEN a.n <> b.n THEN 'ROW_COUNT_MISMATCH' WHEN a.h <> b.h THEN 'RESULT_HASH_MISMATCH' ELSE 'NONE' END AS "differenceCategory"
    FROM a FULL JOIN b USING (o_custkey)""",
)
def _compare_sides(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    moved = F.when(F.col("o_orderkey") % 97 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    changed = o.where("o_orderpriority <> '5-LOW' or o_orderstatus <> 'P'").withColumn("o_totalprice", moved)
    by = ["o_custkey"]
    a, b = summarize_result(o, by, max_rows=20), summarize_result(changed, by, max_rows=20)
    return cp.compare_sides(a, b, by).select(*by, "sampleComparisonStatus", "differenceCategory")


FAILED = "('H2_EXECUTION_FAILED', 'POSTGRES_EXECUTION_FAILED', 'BOTH_EXECUTION_FAILED', 'RESULT_TOO_LARGE')"


@query(
    "overall_status",
    f"""WITH {VERDICTS_SQL}, k AS (SELECT c_custkey AS o_custkey, "sampleComparisonStatus" AS s, sa
      FROM customer LEFT JOIN verdicts ON o_custkey = c_custkey)
    SELECT o_custkey, count(s) AS "sampleCount", CASE WHEN count(s) = 0 THEN 'NO_SAMPLE_DATA'
      WHEN bool_or(s = 'PENDING_SQL_MIGRATION') AND bool_and(s <> 'PENDING_SQL_MIGRATION' OR sa = 'SUCCESS') THEN 'BASELINE_CAPTURED'
      WHEN bool_or(s = 'PENDING_SQL_MIGRATION') THEN 'PARTIAL_EXECUTION_FAILURE'
      WHEN bool_and(s = 'MATCH') THEN 'ALL_SAMPLES_MATCH' WHEN bool_and(s IN ('MATCH', 'EXECUTION_ONLY')) THEN 'EXECUTION_ONLY'
      WHEN bool_or(s IN {FAILED}) THEN 'PARTIAL_EXECUTION_FAILURE' ELSE 'PARTIAL_MISMATCH' END AS "overallComparisonStatus"
    FROM k GROUP BY o_custkey""",
)
def _overall(spark, sf_dir):
    v = verdicts(spark, sf_dir).select("o_custkey", "sampleComparisonStatus", F.col("a.status").alias("aStatus"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return cp.overall_status(customers.join(v, "o_custkey", "left"), ["o_custkey"])


@query(
    "overall_status_per_row",
    f"""WITH {VERDICTS_SQL} SELECT o_orderkey, CASE "sampleComparisonStatus" WHEN 'MATCH' THEN 'ALL_SAMPLES_MATCH'
      WHEN 'MISMATCH' THEN 'PARTIAL_MISMATCH' WHEN 'EXECUTION_ONLY' THEN 'EXECUTION_ONLY'
      ELSE CASE WHEN "sampleComparisonStatus" IN {FAILED} THEN 'PARTIAL_EXECUTION_FAILURE' ELSE 'NOT_EXECUTED' END END AS overall FROM verdicts""",
)
def _overall_row(spark, sf_dir):
    return verdicts(spark, sf_dir).select("o_orderkey", cp.overall_of_one(F.col("sampleComparisonStatus")).alias("overall"))


VERSIONS = [NORMALIZATION_VERSION, NORMALIZATION_VERSION.upper(), NORMALIZATION_VERSION, NORMALIZATION_VERSION, "canonical-0"]


def baseline_rows(spark, sf_dir):
    """Saved samples, one per line item, keyed like statements of its order's method; some keys blank or unknown."""
    li = table(spark, sf_dir, "lineitem")
    names = ("serviceName", "className", "methodName", "sourceType", "sqlVariableName")
    # The key without its position, worked out once per order.
    stem = baseline_key(*[F.col(n) for n in names], F.lit(""))
    facts = statements(spark, sf_dir).select(F.col("_pos").alias("l_orderkey"), stem.alias("stem"))
    k, p = F.col("l_orderkey"), F.col("l_partkey")
    key = F.concat("stem", F.col("l_linenumber") % 3 + 1)
    return li.join(facts, "l_orderkey").select(
        F.concat(F.lit("S"), k).alias("sqlId"),
        F.col("l_linenumber").alias("sampleIndex"),
        p.alias("part"),
        F.col("l_extendedprice").alias("price"),
        pick(VERSIONS, p).alias("normalizationVersion"),
        F.when(F.col("l_suppkey") % 12 == 0, "EXECUTION_FAILED").otherwise("SUCCESS").alias("h2ExecutionStatus"),
        F.when(p % 21 == 0, F.lit(None)).otherwise(k % 10).cast("bigint").alias("h2RowCount"),
        F.concat(F.lit("h"), k % 10).alias("h2ResultHash"),
        F.lit("ID:NUMBER").alias("h2ColumnSignature"),
        F.when(p % 25 == 0, "  ").when(p % 25 == 1, "no|such|key").otherwise(F.coalesce(key, F.lit(""))).alias("baselineKey"),
    )


BASELINE_KEY = KEY_SQL.replace('"occurrenceIndex"', "(l_linenumber % 3 + 1)")
BASELINE_SQL = f"""baseline AS (
  SELECT 'S' || l_orderkey AS "sqlId", l_linenumber AS "sampleIndex", l_partkey AS part, l_extendedprice AS price,
    {sql_pick(VERSIONS, 'l_partkey')} AS "normalizationVersion",
    CASE WHEN l_suppkey % 12 = 0 THEN 'EXECUTION_FAILED' ELSE 'SUCCESS' END AS "h2ExecutionStatus",
    CASE WHEN l_partkey % 21 = 0 THEN NULL ELSE l_orderkey % 10 END AS "h2RowCount",
    'h' || (l_orderkey % 10) AS "h2ResultHash", 'ID:NUMBER' AS "h2ColumnSignature",
    CASE WHEN l_partkey % 25 = 0 THEN '  ' WHEN l_partkey % 25 = 1 THEN 'no|such|key' ELSE coalesce({BASELINE_KEY}, '') END AS "baselineKey"
  FROM lineitem JOIN statements ON pos = l_orderkey),
by_key AS (SELECT "baselineKey" AS k, count(*) AS n, min("sqlId") AS "currentSqlId" FROM candidates
  WHERE trim("baselineKey") <> '' GROUP BY 1),
matched AS (SELECT b.*, CASE WHEN trim(b."baselineKey") = '' THEN 'BASELINE_KEY_MISSING' WHEN n IS NULL THEN 'BASELINE_KEY_NOT_FOUND'
    WHEN n > 1 THEN 'AMBIGUOUS_BASELINE_KEY' ELSE 'MATCHED' END AS "matchStatus",
    CASE WHEN n = 1 THEN m."currentSqlId" END AS "currentSqlId",
    CASE WHEN trim(b."baselineKey") = '' THEN 'The baseline row has no baselineKey.'
      WHEN n IS NULL THEN 'No current SQL matches baselineKey ' || b."baselineKey"
      WHEN n > 1 THEN 'Multiple current SQL records match baselineKey ' || b."baselineKey" ELSE '' END AS "matchReason"
  FROM baseline b LEFT JOIN by_key m ON m.k = b."baselineKey")"""


def matched(spark, sf_dir):
    return cp.match_baseline(baseline_rows(spark, sf_dir), candidate_rows(spark, sf_dir))


@query(
    "match_baseline",
    f"""WITH {CANDIDATES_SQL}, {BASELINE_SQL} SELECT "sqlId", "sampleIndex", part, price, "matchStatus", "matchReason", "currentSqlId" FROM matched""",
)
def _match(spark, sf_dir):
    return matched(spark, sf_dir).select(
        "sqlId", "sampleIndex", "part", "price", "matchStatus", "matchReason", F.col("current.sqlId").alias("currentSqlId")
    )


USABLE_SQL = """"h2ExecutionStatus" = 'SUCCESS' AND "h2RowCount" IS NOT NULL"""


@query("baseline_usable", f"""WITH {CANDIDATES_SQL}, {BASELINE_SQL} SELECT "sqlId", part, price, {USABLE_SQL} AS usable FROM baseline""")
def _usable(spark, sf_dir):
    return baseline_rows(spark, sf_dir).select(
        "sqlId", "part", "price",
        baseline_usable(F.col("h2ExecutionStatus"), F.col("h2RowCount"), F.col("h2ResultHash"), F.col("h2ColumnSignature")).alias("usable"),
    )


DECIDED_SQL = f"""decided AS (SELECT m.*, {current_case('c', USABLE_SQL, f"lower(trim(m.{chr(34)}normalizationVersion{chr(34)})) = '{NORMALIZATION_VERSION}'")} AS code,
    c."postgresValidationStatus", c."jdbcSql"
  FROM matched m LEFT JOIN candidates c ON c."sqlId" = m."currentSqlId")"""
STATUS_OF_CODE = {
    "H2_BASELINE_NOT_USABLE": "NOT_ELIGIBLE",
    "NORMALIZATION_VERSION_MISMATCH": "STALE_VALIDATION_RESULT",
    "BASELINE_KEY_MISSING": "MANUAL_BASELINE_MAPPING_REQUIRED",
    "BASELINE_KEY_NOT_FOUND": "BASELINE_KEY_NOT_FOUND",
    "AMBIGUOUS_BASELINE_KEY": "AMBIGUOUS_BASELINE_KEY",
    "CURRENT_SQL_NOT_SELECT": "SKIPPED_UNSUPPORTED",
    "CURRENT_SQL_MANUAL_REVIEW": "MANUAL_MAPPING_REQUIRED",
    "CURRENT_BINDING_PLAN_UNUSABLE": "MANUAL_MAPPING_REQUIRED",
    "CURRENT_BINDING_COUNT_MISMATCH": "MANUAL_MAPPING_REQUIRED",
    "CURRENT_POSTGRES_NOT_READY": "CURRENT_POSTGRES_NOT_READY",
    "NOT_SELECT": "SKIPPED_UNSUPPORTED",
    "MULTIPLE_STATEMENTS": "SKIPPED_UNSUPPORTED",
    "DYNAMIC_IDENTIFIER": "MANUAL_MAPPING_REQUIRED",
    "UNSAFE_SELECT": "SKIPPED_UNSAFE",
    "READY_FOR_POSTGRES_BASELINE_COMPARISON": "AUTO_COMPARABLE",
}
STATUS_SQL = "CASE code " + " ".join(f"WHEN '{c}' THEN '{s}'" for c, s in STATUS_OF_CODE.items()) + " END"


@query(
    "compare_eligibility",
    f"""WITH {CANDIDATES_SQL}, {BASELINE_SQL}, {DECIDED_SQL}
    SELECT "sqlId", "sampleIndex", part, price, {STATUS_SQL} AS "eligibilityStatus", code AS "reasonCode" FROM decided""",
)
def _compare_eligibility(spark, sf_dir):
    return compare_eligibility(matched(spark, sf_dir)).select(
        "sqlId", "sampleIndex", "part", "price", "eligibilityStatus", "reasonCode"
    )


@query(
    "saved_side",
    f"""WITH {CANDIDATES_SQL}, {BASELINE_SQL} SELECT "sqlId", part, price,
      CASE WHEN {USABLE_SQL} THEN 'SUCCESS' ELSE 'NOT_EXECUTED' END AS status, CASE WHEN {USABLE_SQL} THEN cast("h2RowCount" as varchar) END AS "rowCount",
      CASE WHEN {USABLE_SQL} THEN "h2ResultHash" END AS "resultHash",
      CASE WHEN {USABLE_SQL} THEN '' ELSE 'Saved H2 baseline is unusable.' END AS "errorMessage" FROM baseline""",
)
def _saved_side(spark, sf_dir):
    return cp.saved_side(baseline_rows(spark, sf_dir)).select(
        "sqlId", "part", "price", "a.status", F.col("a.rowCount").cast("string").alias("rowCount"), "a.resultHash", "a.errorMessage"
    )


META = {
    "baselineRunId": "run-1", "baselineCreatedAt": "2026-01-01T00:00:00Z", "normalizationVersion": NORMALIZATION_VERSION,
    "h2Database": "a", "h2Schema": "s", "postgresDatabaseAtCapture": "b", "postgresSchemaAtCapture": "t",
}


def baseline_contract(spark, sf_dir):
    v = verdicts(spark, sf_dir)
    k = F.col("o_orderkey")
    facts = {
        "baselineKey": F.concat(F.lit("k"), F.col("o_custkey")),
        "sqlId": F.concat(F.lit("S"), k),
        "occurrenceIndex": F.lit(1),
        "statementType": F.lit("SELECT"),
        "jdbcSql": F.concat(F.lit("SELECT "), k),
        "postgresValidationStatus": F.lit("PASSED"),
        "eligibilityStatus": F.lit("AUTO_COMPARABLE"),
        "sampleIndex": F.lit(1),
        "requestedSampleCount": F.lit(3),
        "collectedSampleCount": F.lit(1),
        "overallComparisonStatus": cp.overall_of_one(F.col("sampleComparisonStatus")),
    }
    empty = [c for c in (
        "serviceName className methodName sourceType sqlVariableName eligibilityReason parameterNames parameterTypes parameterValues"
    ).split()]
    return cp.assemble_baseline_rows(v.withColumns({**facts, **{c: F.lit("") for c in empty}}), META)


def contract_sql(columns: list[str], values: dict[str, str]) -> str:
    return ", ".join(f"{values.get(c, chr(39) * 2)} AS {chr(34)}{c}{chr(34)}" for c in columns)


_OVERALL_ONE = f"""CASE "sampleComparisonStatus" WHEN 'MATCH' THEN 'ALL_SAMPLES_MATCH' WHEN 'MISMATCH' THEN 'PARTIAL_MISMATCH'
  WHEN 'EXECUTION_ONLY' THEN 'EXECUTION_ONLY' ELSE CASE WHEN "sampleComparisonStatus" IN {FAILED} THEN 'PARTIAL_EXECUTION_FAILURE' ELSE 'NOT_EXECUTED' END END"""
BASELINE_VALUES = {
    **{k: q(v) for k, v in META.items()},
    "baselineKey": "'k' || o_custkey", "sqlId": "'S' || o_orderkey", "occurrenceIndex": "1", "statementType": "'SELECT'",
    "postgresValidationStatusAtCapture": "'PASSED'", "eligibilityStatus": "'AUTO_COMPARABLE'", "sampleIndex": "1",
    "requestedSampleCount": "3", "collectedSampleCount": "1", "h2JdbcSql": "'SELECT ' || o_orderkey",
    "postgresJdbcSqlAtCapture": "'SELECT ' || o_orderkey", "h2ExecutionStatus": "sa", "h2RowCount": "na", "h2ResultHash": "ha",
    "h2ColumnSignature": "ga", "h2ExecutionTimeMs": "o_orderkey % 100", "h2ErrorMessage": "CASE WHEN sa = 'SUCCESS' THEN '' ELSE ea END",
    "postgresExecutionStatus": "sb", "postgresRowCount": "nb", "postgresResultHash": "hb", "postgresColumnSignature": "gb",
    "postgresExecutionTimeMs": "o_orderkey % 100", "postgresErrorMessage": "CASE WHEN sb = 'SUCCESS' THEN '' ELSE eb END",
    "sampleComparisonStatus": '"sampleComparisonStatus"', "overallComparisonStatus": _OVERALL_ONE,
    "differenceCategory": '"differenceCategory"', "differenceMessage": '"differenceMessage"',
}
BASELINE_CONTRACT_SQL = f"""contract AS (SELECT {contract_sql(BASELINE, BASELINE_VALUES)} FROM verdicts)"""


@query("assemble_baseline_rows", f"WITH {VERDICTS_SQL}, {BASELINE_CONTRACT_SQL} SELECT * FROM contract")
def _assemble_baseline(spark, sf_dir):
    return baseline_contract(spark, sf_dir)


NOT_RUN = 'code <> \'READY_FOR_POSTGRES_BASELINE_COMPARISON\''
COMPARISON_VALUES = {
    "normalizationVersion": '"normalizationVersion"', "baselineKey": '"baselineKey"', "baselineSqlId": '"sqlId"',
    "currentSqlId": 'coalesce("currentSqlId", \'\')', "occurrenceIndex": "1", "statementType": "'SELECT'",
    "currentPostgresDatabase": "'db'", "currentPostgresSchema": "'public'",
    "currentPostgresValidationStatus": 'coalesce("postgresValidationStatus", \'\')', "eligibilityStatus": STATUS_SQL,
    "eligibilityReason": "code", "sampleIndex": '"sampleIndex"', "requestedSampleCount": "3",
    "baselineH2JdbcSql": "cast(part as varchar)", "baselineH2ExecutionStatus": '"h2ExecutionStatus"',
    "baselineH2RowCount": 'cast("h2RowCount" as varchar)', "baselineH2ResultHash": '"h2ResultHash"',
    "baselineH2ColumnSignature": '"h2ColumnSignature"', "currentPostgresJdbcSql": 'coalesce("jdbcSql", \'\')',
    "currentPostgresExecutionStatus": f"CASE WHEN {NOT_RUN} THEN 'NOT_EXECUTED' ELSE 'SUCCESS' END",
    "currentPostgresRowCount": "cast(part % 10 as varchar)", "currentPostgresResultHash": "'h' || (part % 10)",
    "currentPostgresColumnSignature": "'ID:NUMBER'", "currentPostgresExecutionTimeMs": "part % 100",
    "sampleComparisonStatus": f"""CASE WHEN code = 'CURRENT_POSTGRES_NOT_READY' THEN code WHEN {NOT_RUN} THEN 'NOT_EXECUTED'
      WHEN "h2RowCount" <> part % 10 THEN 'MISMATCH' ELSE 'MATCH' END""",
    "differenceCategory": f"""CASE WHEN {NOT_RUN} THEN 'BASELINE_MAPPING_ERROR' WHEN "h2RowCount" <> part % 10 THEN 'ROW_COUNT_MISMATCH' ELSE 'NONE' END""",
    "differenceMessage": f"""CASE WHEN {NOT_RUN} THEN code WHEN "h2RowCount" <> part % 10
      THEN 'H2 row count ' || "h2RowCount" || ' differs from PostgreSQL row count ' || (part % 10) || '.' ELSE '' END""",
    "overallComparisonStatus": "'-'",
}


@query(
    "assemble_comparison_rows",
    f"WITH {CANDIDATES_SQL}, {BASELINE_SQL}, {DECIDED_SQL} SELECT {contract_sql(COMPARISON, COMPARISON_VALUES)} FROM decided",
)
def _assemble_comparison(spark, sf_dir):
    decided = compare_eligibility(matched(spark, sf_dir))
    part = F.col("part")
    runs = F.col("eligibilityStatus") == "AUTO_COMPARABLE"
    b = F.struct(
        F.when(runs, "SUCCESS").otherwise("NOT_EXECUTED").alias("status"), (part % 10).alias("rowCount"),
        F.concat(F.lit("h"), part % 10).alias("resultHash"), F.lit("ID:NUMBER").alias("columnSignature"),
        (part % 100).alias("executionTimeMs"), F.lit("").alias("errorMessage"),
    )
    judged = cp.recheck_verdict(
        cp.saved_side(decided.withColumn("eligibilityReason", F.col("reasonCode"))).withColumn("b", b)
    )
    facts = {
        "statementType": F.lit("SELECT"), "occurrenceIndex": F.lit(1), "requestedSampleCount": F.lit(3),
        "h2JdbcSql": part.cast("string"), "overallComparisonStatus": F.lit("-"),
    }
    empty = (
        "baselineRunId baselineCreatedAt serviceName className methodName sourceType sqlVariableName h2Database h2Schema "
        "parameterNames parameterTypes parameterValues"
    ).split()
    rows = cp.assemble_comparison_rows(judged.withColumns({**facts, **{c: F.lit("") for c in empty}}), "db", "public")
    text = ("baselineH2RowCount", "currentPostgresRowCount")
    return rows.withColumns({c: F.col(c).cast("string") for c in text})


@query(
    "row_diff",
    """SELECT l_suppkey, sum(CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END)::bigint AS "onlyA",
      sum(CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END)::bigint AS "onlyB" FROM lineitem GROUP BY 1""",
)
def _row_diff(spark, sf_dir):
    return cp.row_diff(table(spark, sf_dir, "lineitem"), changed_lineitem(spark, sf_dir), ["l_suppkey"])
