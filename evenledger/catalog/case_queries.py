"""Slow-case selection, requests, outcomes and their display."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenledger.catalog.derive import pick, sql_pick, sql_text
from evenledger.catalog.registry import query, table
from evenledger.catalog.text_queries import MASK_RE, flags_case
from evenledger.functions.parameters import SAMPLE_VALUE
from evenledger.operators import cases as cs
from evenledger.operators.eligibility import case_eligibility
from evenledger.sources.contracts import CROSSDB_LONG
from evenledger.sources.sink import scratch_path, write_requests

q = sql_text
STATES_A = ["SUCCESS", "SUCCESS", "SUCCESS", "success", "SUCCESS", "EXECUTION_FAILED"]
STATES_B = ["SUCCESS", "SUCCESS", "SUCCESS", "SUCCESS", "PENDING_SQL_MIGRATION", "SUCCESS", "EXECUTION_FAILED"]
COMPARED = ["MATCH", "MATCH", "MATCH", "MATCH", "MISMATCH", "match"]
TEXTS = ["SELECT * FROM t WHERE a = ? AND b = ? AND c = ?", "SELECT 1 WHERE ? = '?'", "SELECT a FROM t WHERE b IN (?, ?, ?)"]
INCLUDE = ["C7", " b12 ", "C33", "", "b1007"]
TOP = 20


def case_rows(spark, sf_dir):
    """Compared samples, one per event; the user stands for the statement."""
    e = table(spark, sf_dir, "events")
    k, u = F.col("event_id"), F.col("user_id")
    time_a = F.floor(F.col("value") * 10).cast("bigint")
    return e.select(
        F.lit("run-1").alias("baselineRunId"),
        F.when(u % 50 == 0, "").otherwise(F.concat(F.lit("key-"), u)).alias("baselineKey"),
        F.concat(F.lit("B"), u).alias("baselineSqlId"),
        F.when(u % 5 == 0, "").otherwise(F.concat(F.lit("C"), u)).alias("currentSqlId"),
        F.when(k % 41 == 0, "UPDATE").otherwise("SELECT").alias("statementType"),
        (k % 4 + F.when(u % 3 == 0, 1).otherwise(2)).cast("int").alias("sampleIndex"),
        F.when(k % 43 == 0, F.lit(None)).otherwise(F.concat(F.lit("v"), k)).alias("parameterValues"),
        pick(TEXTS, k).alias("h2JdbcSql"),
        F.when(k % 47 == 0, " ").otherwise(pick(TEXTS, k + (u % 9 == 0).cast("int"))).alias("postgresJdbcSql"),
        pick(STATES_A, k).alias("h2ExecutionStatus"),
        pick(STATES_B, k).alias("postgresExecutionStatus"),
        pick(COMPARED, k).alias("sampleComparisonStatus"),
        F.when(u % 6 == 0, F.lit(None)).otherwise(time_a).alias("h2ObservedTimeMs"),
        F.when(u % 4 == 0, F.lit(None)).otherwise(time_a + k % 7).alias("postgresObservedTimeMs"),
        k.alias("_pos"),
    )


CASE_ROWS_SQL = f"""rows AS (SELECT *, CASE WHEN "currentSqlId" <> '' THEN "currentSqlId" ELSE "baselineSqlId" END AS effective,
    CASE WHEN "baselineKey" <> '' THEN "baselineKey" WHEN "currentSqlId" <> '' THEN "currentSqlId" ELSE "baselineSqlId" END AS grp,
    greatest(a_ms, b_ms) AS ms FROM (SELECT event_id AS pos,
    CASE WHEN user_id % 50 = 0 THEN '' ELSE 'key-' || user_id END AS "baselineKey", 'B' || user_id AS "baselineSqlId",
    CASE WHEN user_id % 5 = 0 THEN '' ELSE 'C' || user_id END AS "currentSqlId",
    CASE WHEN event_id % 41 = 0 THEN 'UPDATE' ELSE 'SELECT' END AS "statementType",
    event_id % 4 + CASE WHEN user_id % 3 = 0 THEN 1 ELSE 2 END AS "sampleIndex",
    CASE WHEN event_id % 43 = 0 THEN NULL ELSE 'v' || event_id END AS "parameterValues", {sql_pick(TEXTS, 'event_id')} AS "h2JdbcSql",
    CASE WHEN event_id % 47 = 0 THEN ' ' ELSE {sql_pick(TEXTS, '(event_id + (user_id % 9 = 0)::int)')} END AS "postgresJdbcSql",
    {sql_pick(STATES_A, 'event_id')} AS "h2ExecutionStatus", {sql_pick(STATES_B, 'event_id')} AS "postgresExecutionStatus",
    {sql_pick(COMPARED, 'event_id')} AS "sampleComparisonStatus",
    CASE WHEN user_id % 6 = 0 THEN NULL ELSE cast(floor(value * 10) as bigint) END AS a_ms,
    CASE WHEN user_id % 4 = 0 THEN NULL ELSE cast(floor(value * 10) as bigint) + event_id % 7 END AS b_ms FROM events)),
judged AS (SELECT *, CASE WHEN upper("statementType") <> 'SELECT' THEN 'Statement is not SELECT.'
    WHEN upper("h2ExecutionStatus") <> 'SUCCESS' THEN 'H2 execution is not SUCCESS.'
    WHEN upper("postgresExecutionStatus") <> 'SUCCESS' THEN 'PostgreSQL execution is not SUCCESS.'
    WHEN upper("sampleComparisonStatus") <> 'MATCH' THEN 'Cross DB result is not MATCH.'
    WHEN trim("h2JdbcSql") = '' THEN 'H2 JDBC SQL is missing.' WHEN trim("postgresJdbcSql") = '' THEN 'PostgreSQL JDBC SQL is missing.'
    WHEN "parameterValues" IS NULL THEN 'Saved parameter values are missing.' ELSE '' END AS why FROM rows),
chosen AS (SELECT * FROM judged WHERE why = '' QUALIFY row_number() OVER (PARTITION BY grp ORDER BY ("sampleIndex" <> 2)::int, "sampleIndex", pos) = 1),
slow AS (SELECT grp FROM chosen WHERE ms IS NOT NULL ORDER BY ms DESC, grp LIMIT {TOP}),
flagged AS (SELECT *, grp IN (SELECT grp FROM slow) AS top,
    lower("currentSqlId") IN ('c7', 'b12', 'c33', 'b1007') OR lower("baselineSqlId") IN ('c7', 'b12', 'c33', 'b1007') AS manual FROM chosen),
selected AS (SELECT *, CASE WHEN top AND manual THEN 'TOP_SLOWEST_AND_MANUAL_INCLUDE' WHEN top THEN 'TOP_SLOWEST' ELSE 'MANUAL_INCLUDE' END AS reason,
    regexp_replace(effective, '[^A-Za-z0-9._-]', '_', 'g') || '-' || substr(sha256(grp), 1, 8) AS case_id FROM flagged WHERE top OR manual)"""


def chosen_rows(spark, sf_dir):
    rows = case_eligibility(cs.case_columns(case_rows(spark, sf_dir)))
    return cs.representative_sample(rows.where("eligible"), default=2)


@query("case_eligibility", f'WITH {CASE_ROWS_SQL} SELECT pos, why = \'\' AS eligible, why AS "ineligibleReason" FROM judged')
def _eligibility(spark, sf_dir):
    judged = case_eligibility(case_rows(spark, sf_dir))
    return judged.select(F.col("_pos").alias("pos"), "eligible", "ineligibleReason")


@query("case_columns", f'WITH {CASE_ROWS_SQL} SELECT pos, effective AS "effectiveSqlId", grp AS "sqlGroupKey", cast(ms as varchar) AS "rankingTimeMs" FROM rows')
def _columns(spark, sf_dir):
    keyed = cs.case_columns(case_rows(spark, sf_dir))
    return keyed.select(F.col("_pos").alias("pos"), "effectiveSqlId", "sqlGroupKey", F.col("rankingTimeMs").cast("string").alias("rankingTimeMs"))


@query("representative_sample", f'WITH {CASE_ROWS_SQL} SELECT grp AS "sqlGroupKey", pos, "sampleIndex" FROM chosen')
def _representative(spark, sf_dir):
    return chosen_rows(spark, sf_dir).select("sqlGroupKey", F.col("_pos").alias("pos"), "sampleIndex")


@query("top_slowest", f'WITH {CASE_ROWS_SQL} SELECT grp AS "sqlGroupKey", ms AS "rankingTimeMs" FROM chosen WHERE ms IS NOT NULL ORDER BY ms DESC, grp LIMIT {TOP}')
def _slowest(spark, sf_dir):
    return cs.top_slowest(chosen_rows(spark, sf_dir), TOP).select("sqlGroupKey", "rankingTimeMs")


@query("manual_include", f"WITH {CASE_ROWS_SQL} SELECT pos, effective AS \"effectiveSqlId\" FROM rows WHERE lower(\"currentSqlId\") IN ('c7', 'b12', 'c33', 'b1007') OR lower(\"baselineSqlId\") IN ('c7', 'b12', 'c33', 'b1007')")
def _include(spark, sf_dir):
    return cs.manual_include(cs.case_columns(case_rows(spark, sf_dir)), INCLUDE).select(F.col("_pos").alias("pos"), "effectiveSqlId")


def selected_rows(spark, sf_dir):
    return cs.select_cases(case_rows(spark, sf_dir), TOP, 2, include=INCLUDE)


@query("select_cases", f'WITH {CASE_ROWS_SQL} SELECT grp AS "sqlGroupKey", "sampleIndex", reason AS "selectionReason" FROM selected')
def _select(spark, sf_dir):
    return selected_rows(spark, sf_dir).select("sqlGroupKey", "sampleIndex", "selectionReason")


@query(
    "attach_selected",
    f"""WITH {CASE_ROWS_SQL} SELECT r.pos, r.grp AS "sqlGroupKey", cast(s."sampleIndex" as varchar) AS "selectedSampleIndex", s.reason AS "selectionReason", s.case_id AS "caseId"
    FROM rows r LEFT JOIN selected s ON s.grp = r.grp""",
)
def _attach(spark, sf_dir):
    rows = cs.case_columns(case_rows(spark, sf_dir))
    attached = cs.attach_selected(rows, selected_rows(spark, sf_dir))
    return attached.select(
        F.col("_pos").alias("pos"), "sqlGroupKey", F.col("selectedSampleIndex").cast("string").alias("selectedSampleIndex"),
        "selectionReason", "caseId",
    )


RESULT_PATHS = ["index.html", "sub/index.html", "../index.html", "/etc/index.html", "index.html"]


def tool_results(spark, sf_dir, selected):
    """What the timing tool left behind for the selected cases, derived from their row numbers."""
    k = F.col("_pos")
    return cs_ids(selected).where("_pos % 7 <> 6").select(
        "caseId",
        F.when(k % 11 == 10, "other").otherwise(F.col("caseId")).alias("resultCaseId"),
        F.when(k % 13 == 12, "v1").otherwise("v2").alias("resultVersion"),
        (k % 5 == 4).alias("timedOut"),
        F.when(k % 6 == 5, 1).otherwise(0).alias("exitCode"),
        F.when(k % 19 == 18, "REPORT_GENERATION_FAILED").when(k % 23 == 22, "TIMEOUT").otherwise("SUCCESS").alias("resultStatus"),
        pick(RESULT_PATHS, k).alias("reportPath"),
        (k % 17 != 16).alias("reportExists"),
        F.when(k % 6 == 5, "BROKEN").otherwise("").alias("errorCode"),
        F.when(k % 6 == 5, "it broke").otherwise("").alias("errorMessage"),
    )


def cs_ids(selected):
    from evenledger.functions.identity import case_id

    return selected.withColumn("caseId", case_id(F.col("effectiveSqlId"), F.col("sqlGroupKey")))


OUTCOME_SQL = f"""outcome AS (SELECT case_id, grp, "sampleIndex" AS si, reason, pos, CASE WHEN pos % 7 <> 6 AND pos % 5 = 4 THEN 'TIMEOUT' WHEN pos % 7 = 6 OR pos % 13 = 12 OR pos % 11 = 10 THEN 'RESULT_JSON_INVALID'
    WHEN pos % 23 = 22 AND pos % 19 <> 18 THEN 'TIMEOUT' WHEN pos % 6 = 5 OR pos % 19 = 18 OR pos % 5 IN (2, 3) THEN 'TOOL_FAILED' WHEN pos % 17 = 16 THEN 'REPORT_MISSING' ELSE 'SUCCESS' END AS status,
    pos % 7 <> 6 AND pos % 5 = 4 AS late, CASE WHEN pos % 19 = 18 THEN 'REPORT_GENERATION_FAILED' WHEN pos % 23 = 22 THEN 'TIMEOUT' ELSE 'SUCCESS' END AS said FROM selected),
detailed AS (SELECT *, CASE WHEN status = 'SUCCESS' THEN '/out/run/reports/' || case_id || '/' || {sql_pick(RESULT_PATHS, 'pos')} ELSE '' END AS path,
    CASE WHEN late THEN 'TIMEOUT' WHEN status = 'RESULT_JSON_INVALID' THEN CASE WHEN pos % 7 = 6 THEN 'RESULT_JSON_MISSING' ELSE 'RESULT_JSON_CONTRACT_MISMATCH' END
      WHEN status IN ('TIMEOUT', 'TOOL_FAILED') THEN CASE WHEN pos % 6 = 5 THEN 'BROKEN' WHEN said <> 'SUCCESS' THEN said ELSE 'VALIDATOR_INVOCATION_ERROR' END
      WHEN status = 'REPORT_MISSING' THEN 'HTML_REPORT_MISSING' ELSE '' END AS code,
    CASE WHEN late THEN 'Performance tool exceeded 60 seconds.' WHEN status = 'RESULT_JSON_INVALID' THEN
        CASE WHEN pos % 7 = 6 THEN 'result.json is missing or invalid.' ELSE 'responseVersion or caseId does not match the request.' END
      WHEN status IN ('TIMEOUT', 'TOOL_FAILED') THEN CASE WHEN pos % 6 = 5 THEN 'it broke' WHEN said <> 'SUCCESS' THEN 'Performance tool exit code: 0' ELSE 'htmlReport escapes the output directory.' END
      WHEN status = 'REPORT_MISSING' THEN 'The tool returned SUCCESS but the HTML report does not exist.' ELSE '' END AS error FROM outcome)"""


def outcome_rows(spark, sf_dir):
    selected = selected_rows(spark, sf_dir)
    return cs.classify_outcome(cs_ids(selected), tool_results(spark, sf_dir, selected), "/out/run/reports", 60)


@query(
    "classify_outcome",
    f'WITH {CASE_ROWS_SQL}, {OUTCOME_SQL} SELECT case_id AS "caseId", status, path AS "reportPath", code AS "errorCode", error AS "errorMessage" FROM detailed',
)
def _outcome(spark, sf_dir):
    return outcome_rows(spark, sf_dir)


STATUS_SQL = f"""{OUTCOME_SQL}, status_rows AS (SELECT j.pos AS row_pos, j."baselineKey", j."baselineSqlId", j."currentSqlId", j."sampleIndex",
    CASE WHEN why <> '' OR d.grp IS NULL THEN '' ELSE d.case_id END AS "caseId",
    CASE WHEN why <> '' OR d.grp IS NULL THEN NULL ELSE d.si END AS selected_index,
    CASE WHEN why <> '' OR d.grp IS NULL THEN 'NONE' ELSE d.reason END AS "selectionReason",
    CASE WHEN why <> '' THEN 'NOT_ELIGIBLE' WHEN d.grp IS NULL THEN 'NOT_SELECTED' WHEN j."sampleIndex" <> d.si THEN 'COVERED_BY_SELECTED_SAMPLE' ELSE d.status END AS "performanceStatus",
    CASE WHEN why = '' AND d.grp IS NOT NULL AND j."sampleIndex" = d.si THEN replace(d.path, '/out/run/', '') ELSE '' END AS "htmlReportPath",
    CASE WHEN why <> '' THEN 'NOT_ELIGIBLE' WHEN d.grp IS NOT NULL AND j."sampleIndex" = d.si THEN d.code ELSE '' END AS "errorCode",
    CASE WHEN why <> '' THEN why WHEN d.grp IS NOT NULL AND j."sampleIndex" = d.si THEN d.error ELSE '' END AS "errorMessage"
  FROM judged j LEFT JOIN detailed d ON d.grp = j.grp)"""


def status_rows(spark, sf_dir):
    from evenledger.plans.reports import select_slow_cases

    return select_slow_cases(case_rows(spark, sf_dir), outcome_rows(spark, sf_dir), TOP, 2, include=INCLUDE, link_base="/out/run")["status"]


@query(
    "case_status_row",
    f"""WITH {CASE_ROWS_SQL}, {STATUS_SQL} SELECT "caseId", "baselineKey", "baselineSqlId", "currentSqlId", "sampleIndex", cast(selected_index as varchar) AS "selectedSampleIndex",
      "selectionReason", "performanceStatus", "htmlReportPath", "errorCode", "errorMessage" FROM status_rows""",
)
def _status(spark, sf_dir):
    return status_rows(spark, sf_dir).withColumn("selectedSampleIndex", F.col("selectedSampleIndex").cast("string"))


CASE_STATES = [
    "SUCCESS", "COVERED_BY_SELECTED_SAMPLE", "NOT_SELECTED", "NOT_ELIGIBLE", "PARAMETER_DECODE_FAILED", "TIMEOUT",
    "REPORT_MISSING", "RESULT_JSON_INVALID", "TOOL_FAILED",
]


def case_records(spark, sf_dir):
    """Case records derived from line items; several share a key and sample, the last one counts."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("key-"), F.col("l_suppkey")).alias("baselineKey"),
        (F.col("l_linenumber") % 6).alias("sampleIndex"),
        pick(CASE_STATES, F.col("l_partkey")).alias("performanceStatus"),
        F.col("l_linenumber").alias("selectedSampleIndex"),
        F.concat(F.col("l_partkey").cast("string"), F.lit("/index.html")).alias("htmlReportPath"),
        F.struct("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice").alias("_pos"),
    )


ATTACHED_SQL = f"""records AS (SELECT 'key-' || l_suppkey AS k, l_linenumber % 6 AS si, {sql_pick(CASE_STATES, 'l_partkey')} AS status, l_linenumber AS chosen_index,
    l_partkey || '/index.html' AS path FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_linenumber % 6
      ORDER BY l_orderkey DESC, l_partkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1),
attached AS (SELECT r.*, c.status, c.chosen_index, c.path FROM rows r LEFT JOIN records c ON c.k = r."baselineKey" AND c.si = r."sampleIndex")"""


@query("attach_case_status", f'WITH {CASE_ROWS_SQL}, {ATTACHED_SQL} SELECT pos, status AS "performanceStatus", path AS "htmlReportPath" FROM attached')
def _attach_status(spark, sf_dir):
    joined = cs.attach_case_status(case_rows(spark, sf_dir), case_records(spark, sf_dir))
    return joined.select(F.col("_pos").alias("pos"), "performanceStatus", "htmlReportPath")


_LABELS = " ".join(f"WHEN status = {q(k)} THEN {q(v)}" for k, v in cs.STATUS_LABELS.items())
SHOWN_SQL = f"""shown AS (SELECT *, CASE WHEN regexp_matches(upper("postgresExecutionStatus"), 'PENDING|NOT_READY') OR regexp_matches(upper("sampleComparisonStatus"), 'PENDING|NOT_READY') THEN 'Pending Migration'
    WHEN upper("postgresExecutionStatus") <> 'SUCCESS' THEN 'Not Eligible' WHEN upper("sampleComparisonStatus") <> 'MATCH' THEN 'Result Mismatch'
    WHEN status IS NULL THEN 'Not Generated' WHEN status = 'COVERED_BY_SELECTED_SAMPLE' THEN 'Covered by Sample ' || chosen_index {_LABELS} ELSE '' END AS report FROM attached)"""


@query(
    "performance_display",
    f"""WITH {CASE_ROWS_SQL}, {ATTACHED_SQL}, {SHOWN_SQL} SELECT pos, report AS "performanceReport",
      CASE WHEN report = 'Open Performance Report' THEN path ELSE '' END AS "performanceLink" FROM shown""",
)
def _display(spark, sf_dir):
    joined = cs.attach_case_status(case_rows(spark, sf_dir), case_records(spark, sf_dir))
    return cs.performance_display(joined).select(F.col("_pos").alias("pos"), "performanceReport", "performanceLink")


@query(
    "crossdb_report",
    f"""WITH {CASE_ROWS_SQL}, {ATTACHED_SQL}, {SHOWN_SQL} SELECT "baselineKey", "baselineSqlId", "currentSqlId", "sampleIndex", "parameterValues", "h2ExecutionStatus",
      "postgresExecutionStatus", "sampleComparisonStatus", cast(a_ms as varchar) AS "h2ObservedTimeMs", cast(b_ms as varchar) AS "postgresObservedTimeMs", report AS "performanceReport",
      CASE WHEN report = 'Open Performance Report' THEN path ELSE '' END AS "performanceLink" FROM shown""",
)
def _crossdb(spark, sf_dir):
    from evenledger.plans.reports import crossdb_report

    report = crossdb_report(case_rows(spark, sf_dir), case_records(spark, sf_dir))
    return report.withColumns({c: F.col(c).cast("string") for c in ("h2ObservedTimeMs", "postgresObservedTimeMs")})


_LONG_EXTRA = [c for c in CROSSDB_LONG if c not in (
    "baselineKey baselineSqlId currentSqlId sampleIndex parameterValues statementType h2ExecutionStatus postgresExecutionStatus sampleComparisonStatus baselineRunId").split()]


@query(
    "crossdb_report_long",
    f"""WITH {CASE_ROWS_SQL} SELECT 'run-1' AS "baselineRunId", "baselineKey", "baselineSqlId", "currentSqlId", "sampleIndex", "parameterValues", "statementType",
      "h2ExecutionStatus", "postgresExecutionStatus", "sampleComparisonStatus", {', '.join(f"pos || '{c}' AS {chr(34)}{c}{chr(34)}" for c in _LONG_EXTRA)} FROM rows""",
)
def _crossdb_long(spark, sf_dir):
    from evenledger.plans.reports import crossdb_report

    rows = case_rows(spark, sf_dir)
    extra = {c: F.concat(F.col("_pos").cast("string"), F.lit(c)) for c in _LONG_EXTRA}
    return crossdb_report(rows.withColumns(extra), None, long_form=True)


def request_rows(spark, sf_dir):
    """Selected cases with a tuple of one to three indexes each."""
    k = F.col("_pos")

    def value(index, jdbc, text):
        return F.struct(
            F.lit(index), jdbc, F.lit(f"p{index}"), F.lit("String"), F.lit(False), F.lit("STRING"), text, F.lit("t"), F.lit("c")
        ).cast(SAMPLE_VALUE)

    wide = F.array(F.lit(3), F.lit(1))
    values = F.array(value(1, F.when(k % 4 == 0, F.array(F.lit(4), F.lit(1))).otherwise(wide), F.lit("x")), value(2, F.array(F.lit(2)), k.cast("string")))
    return case_rows(spark, sf_dir).withColumn("values", values)


@query(
    "write_requests",
    f"""WITH {CASE_ROWS_SQL}, c AS (SELECT *, length(regexp_replace(regexp_replace("h2JdbcSql", {MASK_RE}, '', 'g'), '[^?]', '', 'g')) AS ha,
        length(regexp_replace(regexp_replace("postgresJdbcSql", {MASK_RE}, '', 'g'), '[^?]', '', 'g')) AS pa FROM selected)
    SELECT case_id AS "caseId", CASE WHEN pos % 4 = 0 OR ha <> 3 OR pa <> 3 THEN 'PARAMETER_DECODE_FAILED' ELSE 'READY' END AS "requestStatus",
      CASE WHEN pos % 4 = 0 THEN 'JDBC parameter indexes must be unique and contiguous from 1.' WHEN ha <> 3 THEN 'H2 placeholder count ' || ha || ' differs from parameter count 3'
        WHEN pa <> 3 THEN 'PostgreSQL placeholder count ' || pa || ' differs from parameter count 3' ELSE '' END AS "errorMessage",
      CASE WHEN pos % 4 = 0 OR ha <> 3 OR pa <> 3 THEN NULL ELSE effective || '|' || "sampleIndex" || '|' || pos || '|v2' END AS body FROM c""",
)
def _requests(spark, sf_dir):
    made = cs.build_requests(cs.select_cases(request_rows(spark, sf_dir), TOP, 2, include=INCLUDE))
    folder = scratch_path(spark, "requests")
    write_requests(made, folder)
    written = spark.read.text(folder).select(F.from_json("value", cs.REQUEST_SCHEMA).alias("r"), F.col("value").alias("line"))
    made = made.drop("request").join(written, made["caseId"] == written["r.caseId"], "left").withColumn("request", F.col("line"))
    second = F.get("r.parameters", F.lit(1)).getField("value")
    body = F.when(
        F.col("request").isNotNull(), F.concat_ws("|", "r.sqlId", F.col("r.sampleIndex").cast("string"), second, "r.requestVersion")
    )
    return made.select("caseId", "requestStatus", "errorMessage", body.alias("body"))


@query(
    "case_status_of_broken_requests",
    f"""WITH {CASE_ROWS_SQL}, {STATUS_SQL}, c AS (SELECT *, length(regexp_replace(regexp_replace("h2JdbcSql", {MASK_RE}, '', 'g'), '[^?]', '', 'g')) AS ha,
        length(regexp_replace(regexp_replace("postgresJdbcSql", {MASK_RE}, '', 'g'), '[^?]', '', 'g')) AS pa FROM selected),
      broken AS (SELECT case_id, CASE WHEN pos % 4 = 0 THEN 'JDBC parameter indexes must be unique and contiguous from 1.' WHEN ha <> 3 THEN 'H2 placeholder count ' || ha || ' differs from parameter count 3'
        ELSE 'PostgreSQL placeholder count ' || pa || ' differs from parameter count 3' END AS why FROM c WHERE pos % 4 = 0 OR ha <> 3 OR pa <> 3)
    SELECT s."baselineKey", s."sampleIndex", s."baselineSqlId", CASE WHEN b.case_id IS NULL THEN s."caseId" ELSE '' END AS "caseId",
      CASE WHEN hit THEN 'PARAMETER_DECODE_FAILED' ELSE "performanceStatus" END AS "performanceStatus", CASE WHEN hit THEN '' ELSE "htmlReportPath" END AS "htmlReportPath",
      CASE WHEN hit THEN 'REQUEST_BUILD_FAILED' ELSE "errorCode" END AS "errorCode", CASE WHEN hit THEN b.why ELSE "errorMessage" END AS "errorMessage"
    FROM (SELECT *, "caseId" <> '' AND "sampleIndex" = selected_index AS own FROM status_rows) s LEFT JOIN broken b ON b.case_id = s."caseId", LATERAL (SELECT own AND b.case_id IS NOT NULL AS hit)""",
)
def _status_of_broken(spark, sf_dir):
    from evenledger.plans.reports import select_slow_cases

    made = select_slow_cases(request_rows(spark, sf_dir), outcome_rows(spark, sf_dir), TOP, 2, include=INCLUDE, link_base="/out/run")
    return made["status"].select("baselineKey", "sampleIndex", "baselineSqlId", "caseId", "performanceStatus", "htmlReportPath", "errorCode", "errorMessage")


REQUEST_TEXTS = [
    "SELECT * FROM t WHERE a = ? AND b = ?", "SELECT 1", "UPDATE t SET a = ?", "SELECT a FROM t WHERE x = ? ; SELECT ?",
    "WITH d AS (DELETE FROM t WHERE a = ?) SELECT ?", "SELECT 'update' WHERE ? = ?", "", "SELECT * FROM t WHERE a = ? AND b = ? FOR UPDATE",
]


def requests(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")

    def parameter(index, kind, jdbc_type, encoding):
        return F.struct(
            index.cast("int").alias("jdbcIndex"), kind.alias("valueType"), jdbc_type.alias("jdbcType"),
            F.lit("v").alias("value"), encoding.alias("encoding"),
        )

    text = F.lit(None).cast("string")
    first = parameter(F.when(c % 29 == 0, 0).otherwise(1), F.lit("STRING"), F.lit("VARCHAR"), text)
    second = parameter(
        F.when(c % 31 == 0, 1).otherwise(2), F.when(c % 3 == 0, "NULL").when(c % 3 == 1, "BYTES").otherwise("LONG"),
        F.when(c % 5 == 0, "").otherwise("BIGINT"), F.when(c % 7 == 0, text).otherwise("BASE64"),
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(c % 23 == 0, "v1").otherwise("v2").alias("requestVersion"),
        F.when(c % 19 == 0, " ").otherwise(F.concat(F.lit("case-"), k)).alias("caseId"),
        pick(REQUEST_TEXTS, k).alias("h2JdbcSql"),
        pick(REQUEST_TEXTS, k + F.when(c % 2 == 0, 0).otherwise(5)).alias("postgresJdbcSql"),
        F.when(k % 16 == 1, F.array().cast("array<struct<jdbcIndex:int,valueType:string,jdbcType:string,value:string,encoding:string>>"))
        .otherwise(F.array(first, second)).alias("parameters"),
        (c % 13 != 0).alias("resultMatchedBeforePerformanceTest"),
    )


def _marks(x: str) -> str:
    return f"length(regexp_replace(regexp_replace({x}, {MASK_RE}, '', 'g'), '[^?]', '', 'g'))"


WRITES = r"(?i)\b(?:update|delete|insert|merge|create|alter|drop|truncate|grant|revoke)\b"


@query(
    "validate_requests",
    f"""WITH r AS (SELECT o_orderkey AS k, o_custkey AS c, {sql_pick(REQUEST_TEXTS, 'o_orderkey')} AS h,
        {sql_pick(REQUEST_TEXTS, '(o_orderkey + CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE 5 END)')} AS p, CASE WHEN o_orderkey % 16 = 1 THEN 0 ELSE 2 END AS n FROM orders),
      f AS (SELECT *, {flags_case('h', MASK_RE)} AS fh, {flags_case('p', MASK_RE)} AS fp FROM r),
      v AS (SELECT *, CASE WHEN c % 23 = 0 THEN 'REQUEST_VERSION' WHEN c % 19 = 0 THEN 'CASE_ID' WHEN h = '' OR p = '' THEN 'SQL_MISSING'
        WHEN fh IN ('NOT_SELECT', 'UNSAFE_SELECT') OR fp IN ('NOT_SELECT', 'UNSAFE_SELECT') THEN 'NOT_READ_ONLY_SELECT'
        WHEN fh = 'MULTIPLE_STATEMENTS' OR fp = 'MULTIPLE_STATEMENTS' THEN 'MULTIPLE_STATEMENTS'
        WHEN regexp_matches(regexp_replace(h || ' ' || p, '''[^'']*''', '', 'g'), {q(WRITES)}) THEN 'WRITE_STATEMENT'
        WHEN n = 2 AND (CASE WHEN c % 29 = 0 THEN 0 ELSE 1 END) = (CASE WHEN c % 31 = 0 THEN 1 ELSE 2 END) THEN 'DUPLICATE_INDEX'
        WHEN n = 2 AND c % 29 = 0 THEN 'INDEX_START' WHEN {_marks('h')} <> n THEN 'H2_PLACEHOLDER_COUNT' WHEN {_marks('p')} <> n THEN 'POSTGRES_PLACEHOLDER_COUNT'
        WHEN n = 2 AND c % 3 = 0 AND c % 5 = 0 THEN 'NULL_WITHOUT_TYPE' WHEN n = 2 AND c % 3 = 1 AND c % 7 = 0 THEN 'BYTES_ENCODING'
        WHEN c % 13 = 0 THEN 'RESULT_NOT_MATCHED' ELSE '' END AS failed FROM f)
    SELECT k AS o_orderkey, failed AS "failedCheck", CASE WHEN failed = '' THEN 'READY' ELSE 'INVALID_REQUEST' END AS "requestStatus" FROM v""",
)
def _validate(spark, sf_dir):
    return cs.validate_requests(requests(spark, sf_dir)).select("o_orderkey", "failedCheck", "requestStatus")


@query(
    "relative_link",
    r"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'cases/' || page_id || '/index.html' WHEN page_id % 3 = 1 THEN '/other/' || page_id || '.html' ELSE 'x/y.html' END AS link FROM pages""",
)
def _link(spark, sf_dir):
    k = F.col("page_id")
    path = (
        F.when(k % 3 == 0, F.concat(F.lit("/out/run/cases\\"), k, F.lit("\\index.html")))
        .when(k % 3 == 1, F.concat(F.lit("/other/"), k, F.lit(".html")))
        .otherwise("/out/run/x/y.html")
    )
    return table(spark, sf_dir, "pages").select("page_id", cs.relative_link(path, "/out/run").alias("link"))
