"""Readers and writers: derived records are written to a scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenledger.catalog.case_queries import CASE_ROWS_SQL, case_rows
from evenledger.catalog.compare_queries import BASELINE_CONTRACT_SQL, VERDICTS_SQL, baseline_contract, changed_lineitem
from evenledger.catalog.derive import (
    BINDINGS_SQL,
    EXECUTIONS_SQL,
    STATEMENTS_SQL,
    bindings,
    executions,
    sql_text,
    statements,
)
from evenledger.catalog.document_queries import SOURCE_SHAPES, source_files
from evenledger.catalog.registry import query, table
from evenledger.operators.compare import compare_sides
from evenledger.operators.manifest import manifest_lines, verify_manifest
from evenledger.operators.sampling import Mapping
from evenledger.plans.capture import capture_baseline, compare_with_baseline, sample_parameters
from evenledger.plans.replay import replay, view_side
from evenledger.sources import scan, sink
from evenledger.sources.contracts import BASELINE, BINDINGS, EXECUTION_REPORT, EXECUTIONS

q = sql_text
CHARS = "chr(32) || chr(9) || chr(10) || chr(13)"


def saved_csv(spark, df, name):
    path = sink.scratch_path(spark, name)
    df.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


@query(
    "scan_statements",
    f"""WITH {STATEMENTS_SQL} SELECT "sqlId", "serviceName", trim("methodName") AS "methodName", "lineNumber", trim("sqlText", {CHARS}) AS "sqlText",
      "dynamicSql", "requiresManualReview", 0 AS "parameterCount", '' AS notes FROM statements""",
)
def _statements(spark, sf_dir):
    s = statements(spark, sf_dir).withColumnsRenamed({"sqlId": " ID ", "dynamicSql": "isDynamicSql"}).drop("_pos")
    read = scan.scan_statements(spark, saved_csv(spark, s, "statements"), drop_blank_ids=True)
    return read.select(
        "sqlId", "serviceName", "methodName", "lineNumber", "sqlText", "dynamicSql", "requiresManualReview", "parameterCount", "notes"
    )


@query(
    "scan_bindings",
    f"""WITH {BINDINGS_SQL} SELECT "sqlId", trim("jdbcSql") AS "jdbcSql", "bindingStatus", coalesce(cast("bindingIndex" as varchar), '') AS "bindingIndex",
      "bindingCount", "javaParameterName", "javaType", cast(price as varchar) AS note FROM bindings""",
)
def _bindings(spark, sf_dir):
    b = bindings(spark, sf_dir).withColumnsRenamed(
        {"jdbcSql": "ExecutedSql", "bindingStatus": "status", "bindingIndex": "PARAMETERINDEX", "bindingCount": "jdbcParameterCount"}
    )
    b = b.withColumn("bindingNote", F.col("_price").cast("string")).drop("_price", "_part", "_pos")
    read = scan.scan_bindings(spark, saved_csv(spark, b, "bindings"))
    return read.select(
        "sqlId", "jdbcSql", "bindingStatus", "bindingIndex", "bindingCount", "javaParameterName", "javaType", F.col("bindingNote").alias("note")
    )


@query(
    "scan_aliased_csv_lenient",
    f"""WITH {BINDINGS_SQL} SELECT "sqlId", CASE WHEN "bindingIndex" IS NULL OR "javaType" = 'String' THEN 0 ELSE "bindingCount" END AS "bindingCount", '' AS "bindingNote" FROM bindings""",
)
def _lenient(spark, sf_dir):
    bad = F.when(F.col("javaType") == "String", "n/a").when(F.col("bindingIndex").isNull(), "").otherwise(F.col("bindingCount").cast("string"))
    b = bindings(spark, sf_dir).select("sqlId", bad.alias("parameterCount"))
    read = scan.scan_aliased_csv(spark, saved_csv(spark, b, "lenient"), BINDINGS, strict=False)
    return read.select("sqlId", "bindingCount", "bindingNote")


@query(
    "scan_executions",
    f"""WITH {EXECUTIONS_SQL} SELECT "sqlId", "executionStatus", trim("jdbcSql", {CHARS}) AS "jdbcSql", coalesce("sqlState", '') AS "sqlState", message FROM executions""",
)
def _executions(spark, sf_dir):
    e = executions(spark, sf_dir).drop("_pos")
    again = e.withColumn("executionStatus", F.lit("SECOND"))
    blank = e.withColumn("sqlId", F.lit("  "))
    files = e.unionByName(again).unionByName(blank).withColumnRenamed("executionStatus", "validationStatus")
    read = scan.scan_executions(spark, saved_csv(spark, files, "executions"))
    return read.select("sqlId", "executionStatus", "jdbcSql", "sqlState", "message")


@query(
    "scan_executions_of_files",
    """WITH placed AS (SELECT *, CASE WHEN o_orderkey % 50 = 0 THEN 0 WHEN o_orderkey % 5 = 0 THEN 1 ELSE 2 END AS f FROM orders),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY f, o_orderkey) AS n FROM placed)
    SELECT 'C' || o_custkey AS "sqlId", 'F' || f AS "executionStatus", 'of ' || o_orderkey || chr(10) || '"in, two" lines' AS message FROM ranked WHERE n = 1""",
)
def _executions_of_files(spark, sf_dir):
    """Three sets of files of very different size, with quoted line breaks; the first row of an id in input order stays."""
    key = F.col("o_orderkey")
    f = F.when(key % 50 == 0, 0).when(key % 5 == 0, 1).otherwise(2).alias("f")
    message = F.concat(F.lit("of "), key, F.lit('\n"in, two" lines')).alias("message")
    rows = table(spark, sf_dir, "orders").select(f, key, F.concat(F.lit("C"), "o_custkey").alias("id"), F.concat(F.lit("F"), f).alias("status"), message)
    path = sink.scratch_path(spark, "files")
    ordered = rows.repartitionByRange(8, "f", "o_orderkey").sortWithinPartitions("f", "o_orderkey").drop("o_orderkey")
    ordered.write.partitionBy("f").csv(path, header=True, escape='"')
    return scan.scan_executions(spark, path).select("sqlId", "executionStatus", "message")


@query(
    "scan_cases",
    f"""WITH {CASE_ROWS_SQL} SELECT "baselineKey", "baselineSqlId", "currentSqlId", "sampleIndex", trim("postgresJdbcSql") AS "postgresJdbcSql", "postgresExecutionStatus",
      coalesce(cast(a_ms as varchar), '') AS "h2ObservedTimeMs", coalesce(cast(b_ms as varchar), '') AS "postgresObservedTimeMs" FROM rows""",
)
def _cases(spark, sf_dir):
    rows = case_rows(spark, sf_dir).drop("_pos").withColumnsRenamed(
        {"h2JdbcSql": "baselineH2JdbcSql", "postgresJdbcSql": "currentPostgresJdbcSql", "h2ExecutionStatus": "baselineH2ExecutionStatus",
         "postgresExecutionStatus": "currentPostgresExecutionStatus", "postgresObservedTimeMs": "currentPostgresExecutionTimeMs"}
    )
    read = scan.scan_cases(spark, saved_csv(spark, rows, "cases"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return read.select(
        "baselineKey", "baselineSqlId", "currentSqlId", "sampleIndex", "postgresJdbcSql", "postgresExecutionStatus",
        text("h2ObservedTimeMs"), text("postgresObservedTimeMs"),
    )


@query("scan_baseline", f"WITH {VERDICTS_SQL}, {BASELINE_CONTRACT_SQL} SELECT * FROM contract")
def _baseline(spark, sf_dir):
    path = sink.scratch_path(spark, "baseline")
    sink.write_baseline(baseline_contract(spark, sf_dir), path)
    return scan.scan_baseline(spark, path)


@query("write_baseline", "SELECT count(*) AS rows_kept, true AS second_write_refused FROM orders")
def _immutable(spark, sf_dir):
    path = sink.scratch_path(spark, "baseline")
    rows = baseline_contract(spark, sf_dir)
    sink.write_baseline(rows.limit(0), path)  # an empty skeleton may be replaced
    sink.write_baseline(rows, path)
    try:
        sink.write_baseline(rows, path)
        refused = False
    except sink.BaselineExists:
        refused = True
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_kept")).withColumn("second_write_refused", F.lit(refused))


@query(
    "write_report",
    f"""WITH {EXECUTIONS_SQL} SELECT "sqlId", "jdbcSql", "validationMode", "executionStatus", coalesce("sqlState", '') AS "postgresErrorCode", '' AS "errorCategory", message FROM executions""",
)
def _report(spark, sf_dir):
    path = sink.scratch_path(spark, "report")
    e = executions(spark, sf_dir)
    state = F.coalesce("sqlState", F.lit(""))
    full = e.withColumn("postgresErrorCode", state).withColumn("errorCategory", F.lit(""))
    sink.write_report(full, path, EXECUTION_REPORT, fmt="csv")
    read = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return read.select(*[F.coalesce(c, F.lit("")).alias(c) for c in read.columns])


@query("write_comparison", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def _comparison(spark, sf_dir):
    path = sink.scratch_path(spark, "comparison")
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    sink.write_comparison(counts.limit(1), path)
    sink.write_comparison(counts, path)
    return spark.read.parquet(path)


@query("write_report_tables", "SELECT 'summary' AS name, count(DISTINCT o_custkey) AS n FROM orders UNION ALL SELECT 'detail', count(*) FROM orders")
def _tables(spark, sf_dir):
    folder = sink.scratch_path(spark, "tables")
    o = table(spark, sf_dir, "orders")
    sink.write_report_tables({"summary": o.select("o_custkey").distinct(), "detail": o}, folder)
    parts = [spark.read.parquet(f"{folder}/{n}").agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n in ("summary", "detail")]
    return parts[0].unionByName(parts[1]).select("name", "n")


@query("first_nonempty", "SELECT count(*) AS n, min(o_orderkey) AS low FROM orders WHERE o_totalprice > 0")
def _nonempty(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return scan.first_nonempty(o.where("o_totalprice < 0"), o.where("o_totalprice > 0")).agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("low")
    )


@query("scan_optional", f'WITH {EXECUTIONS_SQL} SELECT count(*) AS present, 0 AS missing, 14 AS columns FROM executions')
def _optional(spark, sf_dir):
    there = scan.scan_optional(spark, saved_csv(spark, executions(spark, sf_dir).drop("_pos"), "optional"), EXECUTIONS)
    gone = scan.scan_optional(spark, sink.scratch_path(spark, "no-such"), EXECUTIONS)
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return spark.range(1).select(count(there).alias("present"), count(gone).alias("missing"), F.lit(len(gone.columns) - 1).alias("columns"))


@query("load_side", "SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM customer) AS customers")
def _load(spark, sf_dir):
    copy = saved_csv(spark, table(spark, sf_dir, "customer"), "customers")
    side = scan.load_side(
        spark, {"orders": {"path": f"{sf_dir}/orders.parquet"}, "customer": {"format": "csv", "path": copy, "header": True}}
    )
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return spark.range(1).select(count(side["orders"]).alias("orders"), count(side["customer"]).alias("customers"))


SOURCE_LINES = [text.count("\n") + 1 for text, _ in SOURCE_SHAPES]


@query(
    "scan_source_corpus",
    f"SELECT (sum(list_extract({SOURCE_LINES}, cast(1 + c_custkey % 4 as bigint))))::bigint AS lines, true AS only_sources FROM customer",
)
def _corpus(spark, sf_dir):
    folder = sink.scratch_path(spark, "sources")
    files = source_files(spark, sf_dir)
    files.select("sourceText").write.text(f"{folder}/src")
    files.select("sourceText").write.text(f"{folder}/build/copy")
    found = scan.scan_source_corpus(spark, [folder], glob="*.txt")
    feeds = F.length("sourceText") - F.length(F.replace("sourceText", F.lit("\n"), F.lit("")))
    return found.agg(F.sum(feeds).cast("bigint").alias("lines"), F.bool_and(F.contains("filePath", F.lit("/src/"))).alias("only_sources"))


@query("scan_xml_docs", "SELECT n_regionkey AS region, count(*) AS n, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def _xml(spark, sf_dir):
    path = sink.scratch_path(spark, "xml")
    table(spark, sf_dir, "nation").write.format("xml").option("rowTag", "nation").option("rootTag", "nations").save(path)
    docs = scan.scan_xml_docs(spark, path, "nation")
    rows = docs.select(
        F.variant_get("content", "$.n_regionkey", "int").alias("region"), F.variant_get("content", "$.n_name", "string").alias("name")
    )
    names = F.array_join(F.sort_array(F.collect_list("name")), ",")
    return rows.groupBy("region").agg(F.count(F.lit(1)).alias("n"), names.alias("names"))


@query(
    "verify_manifest",
    """SELECT o_orderstatus AS folder, CASE WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'OK' END AS status FROM orders GROUP BY 1
    UNION ALL SELECT 'gone', 'MISSING' UNION ALL SELECT 'bad line', 'INVALID LINE'""",
)
def _manifest(spark, sf_dir):
    root = sink.scratch_path(spark, "release")
    o = table(spark, sf_dir, "orders")
    o.repartition(6).write.partitionBy("o_orderstatus").csv(root)
    # Files of some kilobytes and more take the way of large files.
    digests = scan.scan_file_digests(spark, root, streamed_bytes=20_000).where(F.col("path").endswith(".csv"))
    wrong = F.when(F.contains("path", F.lit("=F/")), F.reverse("sha256")).otherwise(F.upper("sha256"))
    lines = digests.select(F.concat_ws(" *", wrong, "path").alias("value"))
    others = spark.range(1).select(F.explode(F.array(F.lit("# note"), F.lit(" "), F.lit("00ff  *gone"), F.lit("bad line"))).alias("value"))
    checked = verify_manifest(digests, manifest_lines(lines.unionByName(others)))
    return checked.select(F.coalesce(F.nullif(F.regexp_extract("path", "=([^/]+)/", 1), F.lit("")), "path").alias("folder"), "status").distinct()


# Statements of the replayed corpus: (id, text, values of its sample or None, status of the validation run).
STATEMENTS = [
    ("Q1", "SELECT l_returnflag, sum(l_quantity) AS q FROM lineitem GROUP BY l_returnflag", None, "PASSED"),
    ("Q2", "SELECT count(*) AS n FROM lineitem WHERE l_linenumber = ?", "line", "PASSED"),
    ("Q3", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus ORDER BY o_orderstatus", None, "PASSED"),
    ("Q4", "SELECT o_orderkey FROM orders", None, "PASSED"),
    ("Q5", "SELECT no_such_column FROM orders", None, "PASSED"),
    ("Q6", "SELECT max(o_totalprice) AS top FROM orders", None, "FAILED_SQL_COMPATIBILITY"),
    ("Q7", "SELECT count(*) AS n, current_date AS d FROM orders", None, "PASSED"),
]
LINE = Mapping(1, (1,), "line", "l_linenumber", "Integer")


def sides(spark, sf_dir):
    """Two sessions with the same table names; side B has other quantities."""
    a, b = spark.newSession(), spark.newSession()
    for session, changed in ((a, False), (b, True)):
        view_side(
            session,
            {
                "orders": table(session, sf_dir, "orders"),
                "lineitem": changed_lineitem(session, sf_dir) if changed else table(session, sf_dir, "lineitem"),
            },
        )
    return a, b


def replay_cases(spark, sf_dir):
    specs = {i: ("lineitem", [LINE] if sample else []) for i, _, sample, _ in STATEMENTS}
    samples = sample_parameters(spark, {"lineitem": table(spark, sf_dir, "lineitem")}, specs, n=2)
    texts = spark.createDataFrame([(i, t, s) for i, t, _, s in STATEMENTS], "sqlId string, jdbcSql string, status string")
    return samples.join(texts, "sqlId")


EXPECTED_SQL = """lines AS (SELECT DISTINCT l_linenumber AS n FROM lineitem ORDER BY 1 LIMIT 2),
outcomes AS (SELECT 'Q1' AS id, 1 AS sample, (SELECT count(DISTINCT l_returnflag) FROM lineitem) AS rows,
    CASE WHEN (SELECT bool_or(l_orderkey % 97 = 0) FROM lineitem) THEN 'MISMATCH' ELSE 'MATCH' END AS status
  UNION ALL SELECT 'Q2', row_number() OVER (ORDER BY n), 1, 'MATCH' FROM lines
  UNION ALL SELECT 'Q3', 1, (SELECT count(DISTINCT o_orderstatus) FROM orders), 'MATCH'
  UNION ALL SELECT 'Q4', 1, (SELECT count(*) FROM orders), 'MATCH'
  UNION ALL SELECT 'Q5', 1, -1, 'BOTH_EXECUTION_FAILED'
  UNION ALL SELECT 'Q6', 1, 1, '{q6}'
  UNION ALL SELECT 'Q7', 1, 1, '{q7}')"""


@query("replay", f"WITH {EXPECTED_SQL.format(q6='MATCH', q7='MATCH')} SELECT id AS \"sqlId\", sample AS \"sampleIndex\", rows AS \"rowCount\", status AS \"sampleComparisonStatus\" FROM outcomes")
def _replay(spark, sf_dir):
    cases = replay_cases(spark, sf_dir).select("sqlId", "sampleIndex", "jdbcSql", "values")
    a, b = (replay(spark, side, cases) for side in sides(spark, sf_dir))
    compared = compare_sides(a, b, ["sqlId", "sampleIndex"])
    return compared.select("sqlId", "sampleIndex", F.coalesce("a.rowCount", F.lit(-1)).alias("rowCount"), "sampleComparisonStatus")


def corpus_candidates(spark):
    """The replayed statements as candidates."""
    rows = spark.createDataFrame([(i, t, s, bool(p)) for i, t, p, s in STATEMENTS], "sqlId string, jdbcSql string, postgresValidationStatus string, bound boolean")
    facts = {
        "baselineKey": F.concat(F.lit("svc|repo|m|entity_manager|-|"), F.substring("sqlId", 2, 9)),
        "serviceName": F.lit("svc"), "filePath": F.lit("f"), "className": F.lit("Repo"), "methodName": F.lit("m"),
        "sourceType": F.lit("ENTITY_MANAGER"), "sqlVariableName": F.lit(""), "occurrenceIndex": F.lit(1), "lineNumber": F.lit(1),
        "originalSql": F.col("jdbcSql"), "normalizedSql": F.col("jdbcSql"), "executionReportJdbcSql": F.col("jdbcSql"),
        "statementType": F.lit("SELECT"), "dynamicSql": F.lit(False), "requiresManualReview": F.lit(False), "manualReviewReason": F.lit(""),
        "confidence": F.lit("HIGH"), "bindingPlanPresent": F.lit(True), "bindingPlanUsable": F.lit(True), "bindingPlanStatus": F.lit("READY"),
        "bindingCount": F.col("bound").cast("int"), "placeholderCount": F.col("bound").cast("int"), "duplicateBaselineKey": F.lit(False),
    }
    return rows.withColumns(facts)


def captured(spark, sf_dir):
    a, b = sides(spark, sf_dir)
    samples = replay_cases(spark, sf_dir).drop("jdbcSql", "status")
    path = sink.scratch_path(spark, "captured")
    return capture_baseline(spark, corpus_candidates(spark), samples, a, b, path, run_id="run-1", requested=2), b


@query(
    "capture_baseline",
    f"""WITH {EXPECTED_SQL.format(q6='PENDING_SQL_MIGRATION', q7='EXECUTION_ONLY')} SELECT id AS "sqlId", sample AS "sampleIndex", rows AS "h2RowCount", status AS "sampleComparisonStatus",
      CASE status WHEN 'MATCH' THEN 'ALL_SAMPLES_MATCH' WHEN 'MISMATCH' THEN 'PARTIAL_MISMATCH' WHEN 'PENDING_SQL_MIGRATION' THEN 'BASELINE_CAPTURED' WHEN 'EXECUTION_ONLY' THEN status
        ELSE 'PARTIAL_EXECUTION_FAILURE' END AS "overallComparisonStatus", 'run-1' AS "baselineRunId", {len(BASELINE)} AS columns FROM outcomes""",
)
def _capture(spark, sf_dir):
    baseline, _ = captured(spark, sf_dir)
    return baseline.select(
        "sqlId", "sampleIndex", F.coalesce("h2RowCount", F.lit(-1)).alias("h2RowCount"), "sampleComparisonStatus", "overallComparisonStatus",
        "baselineRunId", F.lit(len(baseline.columns)).alias("columns"),
    )


@query(
    "compare_with_baseline",
    f"""WITH {EXPECTED_SQL.format(q6='CURRENT_POSTGRES_NOT_READY', q7='EXECUTION_ONLY')} SELECT id AS "baselineSqlId", sample AS "sampleIndex",
      CASE WHEN id = 'Q5' THEN 'NOT_EXECUTED' ELSE status END AS "sampleComparisonStatus",
      CASE WHEN id = 'Q5' THEN 'NOT_EXECUTED' WHEN status = 'EXECUTION_ONLY' THEN status WHEN status = 'MATCH' THEN 'ALL_SAMPLES_MATCH' WHEN status = 'MISMATCH' THEN 'PARTIAL_MISMATCH' ELSE 'PENDING_SQL_MIGRATION' END AS "overallComparisonStatus"
    FROM outcomes""",
)
def _recheck(spark, sf_dir):
    baseline, b = captured(spark, sf_dir)
    rows = compare_with_baseline(spark, baseline, corpus_candidates(spark), lambda: b)
    return rows.select("baselineSqlId", "sampleIndex", "sampleComparisonStatus", "overallComparisonStatus")


DRIFT_ROWS = [
    ("Q1", 1, "RESULT_HASH_MISMATCH", "POSSIBLE_DATA_DRIFT"),
    ("Q3", 1, "NONE", "NONE"),
    ("Q4", 1, "NONE", "NONE"),
    ("Q5", 1, "BASELINE_MAPPING_ERROR", "BASELINE_MAPPING_ERROR"),
    ("Q6", 1, "BASELINE_MAPPING_ERROR", "BASELINE_MAPPING_ERROR"),
    ("Q7", 1, "NONE", "NONE"),
]


@query(
    "compare_with_baseline_drift",
    f"""SELECT * FROM (VALUES {", ".join(f"('{i}', {n}, '{same}', '{changed}')" for i, n, same, changed in DRIFT_ROWS)}) v("baselineSqlId", "sampleIndex", same_data, changed_data)
    UNION ALL SELECT 'Q2', row_number() OVER (ORDER BY n), 'NONE', 'NONE' FROM (SELECT DISTINCT l_linenumber AS n FROM lineitem ORDER BY 1 LIMIT 2)""",
)
def _drift(spark, sf_dir):
    """A statement whose answer differs on the data of the capture, and again after its table has changed."""
    a, b = sides(spark, sf_dir)
    later = spark.newSession()
    moved = table(later, sf_dir, "lineitem").withColumn("l_quantity", F.col("l_quantity") + 3)
    view_side(later, {"orders": table(later, sf_dir, "orders"), "lineitem": moved})
    samples = replay_cases(spark, sf_dir).drop("jdbcSql", "status")
    path, kept = sink.scratch_path(spark, "captured"), sink.scratch_path(spark, "sources")
    baseline = capture_baseline(spark, corpus_candidates(spark), samples, a, b, path, run_id="run-1", requested=2, sources=kept)
    keys = ["baselineSqlId", "sampleIndex"]
    found = [
        compare_with_baseline(spark, baseline, corpus_candidates(spark), lambda s=s: s, sources=kept).select(*keys, F.col("differenceCategory").alias(name))
        for s, name in ((b, "same_data"), (later, "changed_data"))
    ]
    return found[0].join(found[1], keys)


@query("baseline_run_id", "SELECT count(*) AS statements, true AS well_formed FROM orders")
def _run_id(spark, sf_dir):
    ids = [sink.baseline_run_id(None), sink.baseline_run_id(" run-9 ")]
    marked = table(spark, sf_dir, "orders").withColumn("run", F.lit(ids[0]))
    ok = F.bool_and(F.col("run").rlike(r"^baseline-\d{8}-\d{6}$")) & F.lit(ids[1] == "run-9")
    return marked.agg(F.count(F.lit(1)).alias("statements"), ok.alias("well_formed"))
