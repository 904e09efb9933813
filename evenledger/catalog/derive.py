"""Statement, binding and execution records derived from the test tables, for Spark and for DuckDB.

Every order stands for a statement, every line item for one of its bindings, every event for an
execution. Texts come from a list of statement shapes chosen by the row's key, so the records grow
with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenledger.catalog.registry import table
from evenledger.functions.text import normalize_text

SHAPES = [
    "SELECT * FROM orders WHERE id = {k}",
    "select o.id, o.total from orders o where o.status = :status and o.id = :orderId",
    "SELECT count(*)\n FROM   lineitem\tWHERE qty > ?1 and part = ?2;",
    "WITH t AS (SELECT 1) SELECT * FROM t WHERE a = ? AND b = '?' -- ? skipped\n AND c = ?",
    "SELECT a FROM t WHERE x = 'it''s ?' AND y = ? /* ? */ ; ",
    "SELECT 1; SELECT {k}",
    "SELECT * FROM ? WHERE id = {k}",
    "SELECT * FROM t WHERE a = ? GROUP BY a ORDER BY ?",
    "SELECT * FROM stock WHERE id = {k} FOR UPDATE",
    "SELECT nextval('seq_{k}')",
    "SELECT current_timestamp, {k}",
    "/* lead */ -- more\n SELECT random() FROM t",
    "INSERT INTO t(a) VALUES (:a, :a, ?)",
    "UPDATE stock s SET s.qty = ? WHERE s.id = {k}",
    "DELETE FROM t WHERE d < SYSDATE",
    "MERGE INTO t USING u ON (t.id = u.id) WHEN MATCHED THEN UPDATE SET a = 1",
    "CALL refresh({k})",
    "TRUNCATE TABLE t{k}",
    "CREATE TABLE t{k} (a int)",
    "GRANT select ON t TO u",
    "SELECT order_seq.NEXTVAL FROM DUAL",
    "SELECT NVL(a, 0) FROM t WHERE ROWNUM <= 10",
    "SELECT to_char(d, 'YYYY') FROM t WHERE x IN :ids",
    "SELECT to_timestamp('{k}', 'x') FROM t",
    "SELECT dateadd('DAY', 1, d) FROM t",
    'SELECT "VALUE" FROM t WHERE d = current_timestamp()',
    "SELECT a::text, b FROM t WHERE c = :c::int",
    "\" + \"SELECT x FROM t\\n WHERE a = 'b",
    'sb.append("SELECT 1") // http://x',
    "",
    "   ",
    "explain select {k}",
    "SELECT x INTO y FROM t",
    "select into z from t",
    "SELECT a FROM t WHERE b = ':quoted' AND c = :named AND d = ?",
    "SELECT pg_try_advisory_xact_lock({k})",
    "SELECT rownum, systimestamp, to_date('{k}') FROM t WHERE rownum < 5 AND a = 1",
    "SELECT a FROM t WHERE a = ? AND b = ? AND c = ?;;",
    "ALTER TABLE t ADD c{k} int",
    'SELECT "entity", uuid() FROM t',
]

MESSAGES = [
    "",
    "ERROR: operator does not exist: numeric = character varying",
    "ERROR: operator does not exist: bigint = character varying",
    "No value specified for parameter 2, bind it",
    "parameter index out of range",
    'ERROR: column "s" of relation "stock" does not exist',
    'ERROR: missing FROM-clause entry for table "order_seq"',
    'ERROR: relation "dual" does not exist',
    "ERROR: function nvl(integer, integer) does not exist",
    'ERROR: column "sysdate" does not exist',
    'ERROR: column "rownum" does not exist',
    "ERROR: function to_char(text, unknown) does not exist",
    "ERROR: function to_timestamp(text) does not exist",
    "ERROR: function dateadd(unknown, integer) does not exist",
    'ERROR: column "value" does not exist',
    'ERROR: column "total" does not exist',
    'ERROR: relation "orders" does not exist',
    'ERROR: missing FROM-clause entry for table "o"',
    "ERROR: function refresh(integer) does not exist",
    'ERROR: syntax error at or near "MERGE"',
    "SQLState: 42601",
    "connection reset",
]

STATES = ["42601", "42P01", "42703", "42883", "42804", "42702", "42501", "57014", "23505", "23503", "99999"]
TYPES = ["String", "Long", "Integer", "BigDecimal", "LocalDate", "LocalDateTime", "UUID", "Boolean", "", "Money"]
NAMES = ["orderId", "status", "startDate", "updateTime", "customerUuid", "activeFlag", "", "ids", "comment"]


def sql_text(value: str) -> str:
    """A DuckDB string literal."""
    return "'" + value.replace("'", "''") + "'"


def pick(values: list[str], k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.lit(1) + k % len(values)).cast("int"))


def sql_pick(values: list[str], k: str) -> str:
    return f"list_extract([{', '.join(sql_text(v) for v in values)}], cast(1 + {k} % {len(values)} as bigint))"


def shape(k: Column) -> Column:
    return F.replace(pick(SHAPES, k), F.lit("{k}"), k.cast("string"))


def sql_shape(k: str) -> str:
    return f"replace({sql_pick(SHAPES, k)}, '{{k}}', cast({k} as varchar))"


def sql_normalized(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        F.concat(F.lit("S"), k).alias("sqlId"),
        F.col("o_orderpriority").alias("serviceName"),
        F.concat(F.lit("src/"), F.col("o_orderstatus"), F.lit("/C"), c % 50, F.lit(".java")).alias("filePath"),
        F.when(c % 7 == 0, "").otherwise(F.concat(F.lit("Repo"), c % 50)).alias("className"),
        F.concat(F.lit(" find  By"), c % 11).alias("methodName"),
        pick(["SPRING_DATA_QUERY", "ENTITY_MANAGER", "JDBC_TEMPLATE"], k).alias("sourceType"),
        F.when(k % 2 == 0, "q|1").otherwise("").alias("sqlVariableName"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("lineNumber"),
        shape(k).alias("sqlText"),
        normalize_text(shape(k)).alias("normalizedSqlText"),
        (k % 13 == 0).alias("dynamicSql"),
        (k % 17 == 0).alias("requiresManualReview"),
        F.when(k % 34 == 0, "looks odd").otherwise("").alias("manualReviewReason"),
        pick(["HIGH", "MEDIUM", "LOW"], c).alias("confidence"),
        k.alias("_pos"),
    )


STATEMENTS_SQL = f"""statements AS (
  SELECT 'S' || o_orderkey AS "sqlId", o_orderpriority AS "serviceName",
    'src/' || o_orderstatus || '/C' || (o_custkey % 50) || '.java' AS "filePath",
    CASE WHEN o_custkey % 7 = 0 THEN '' ELSE 'Repo' || (o_custkey % 50) END AS "className",
    ' find  By' || (o_custkey % 11) AS "methodName",
    {sql_pick(["SPRING_DATA_QUERY", "ENTITY_MANAGER", "JDBC_TEMPLATE"], "o_orderkey")} AS "sourceType",
    CASE WHEN o_orderkey % 2 = 0 THEN 'q|1' ELSE '' END AS "sqlVariableName",
    cast(floor(o_totalprice / 1000) as int) AS "lineNumber",
    {sql_shape("o_orderkey")} AS "sqlText",
    {sql_normalized(sql_shape("o_orderkey"))} AS "normalizedSqlText",
    o_orderkey % 13 = 0 AS "dynamicSql", o_orderkey % 17 = 0 AS "requiresManualReview",
    CASE WHEN o_orderkey % 34 = 0 THEN 'looks odd' ELSE '' END AS "manualReviewReason",
    {sql_pick(["HIGH", "MEDIUM", "LOW"], "o_custkey")} AS confidence, o_orderkey AS pos
  FROM orders)"""


def bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    return li.select(
        F.concat(F.lit("S"), k).alias("sqlId"),
        F.when(k % 19 == 0, "").otherwise(normalize_text(shape(k))).alias("jdbcSql"),
        pick(["READY", "", "READY", "READY", "MANUAL_REQUIRED", "ready", "Parse Error"], k).alias("bindingStatus"),
        F.when(k % 11 == 0, F.lit(None).cast("int")).otherwise(F.col("l_linenumber")).alias("bindingIndex"),
        F.when(k % 10 == 0, F.col("l_linenumber")).otherwise(0).alias("bindingCount"),
        F.lit("?").alias("originalParameter"),
        pick(NAMES, p).alias("javaParameterName"),
        pick(TYPES, p).alias("javaType"),
        pick(["SCALAR", "", "LIST"], s).alias("parameterKind"),
        F.when(s % 5 == 0, "").otherwise(F.col("l_returnflag")).alias("mockValue"),
        F.when(s % 20 == 0, "MANUAL_REQUIRED").when(s % 20 < 4, "LOW").otherwise("HIGH").alias("confidence"),
        F.col("l_extendedprice").alias("_price"),
        p.alias("_part"),
        F.col("l_linenumber").alias("_pos"),
    )


BINDINGS_SQL = f"""bindings AS (
  SELECT 'S' || l_orderkey AS "sqlId",
    CASE WHEN l_orderkey % 19 = 0 THEN '' ELSE {sql_normalized(sql_shape("l_orderkey"))} END AS "jdbcSql",
    {sql_pick(["READY", "", "READY", "READY", "MANUAL_REQUIRED", "ready", "Parse Error"], "l_orderkey")} AS "bindingStatus",
    CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_linenumber END AS "bindingIndex",
    CASE WHEN l_orderkey % 10 = 0 THEN l_linenumber ELSE 0 END AS "bindingCount",
    '?' AS "originalParameter", {sql_pick(NAMES, "l_partkey")} AS "javaParameterName",
    {sql_pick(TYPES, "l_partkey")} AS "javaType", {sql_pick(["SCALAR", "", "LIST"], "l_suppkey")} AS "parameterKind",
    CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE l_returnflag END AS "mockValue",
    CASE WHEN l_suppkey % 20 = 0 THEN 'MANUAL_REQUIRED' WHEN l_suppkey % 20 < 4 THEN 'LOW' ELSE 'HIGH' END AS confidence,
    l_extendedprice AS price, l_partkey AS part, l_linenumber AS pos
  FROM lineitem)"""

EXECUTION_STATUSES = ["PASSED", "FAILED_SQL_COMPATIBILITY", "SKIPPED_SAFETY", "Passed", "FAILED_SQL_COMPATIBILITY", "not executed"]


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k, u = F.col("event_id"), F.col("user_id")
    status = pick(EXECUTION_STATUSES, u)
    return e.select(
        F.concat(F.lit("S"), k).alias("sqlId"),
        status.alias("executionStatus"),
        F.when(F.col("value") > 150, F.concat(shape(k), F.lit(" -- changed"))).otherwise(shape(k)).alias("jdbcSql"),
        F.when(k % 29 == 0, F.concat(shape(k), F.lit(" /* adapted */"))).otherwise("").alias("adaptedJdbcSql"),
        pick(MESSAGES, k + u).alias("message"),
        F.when(F.lower(status) == "passed", F.lit(None).cast("string")).otherwise(pick(STATES, u)).alias("sqlState"),
        F.col("event_type").alias("validationMode"),
        k.alias("_pos"),
    )


EXECUTIONS_SQL = f"""executions AS (
  SELECT 'S' || event_id AS "sqlId", {sql_pick(EXECUTION_STATUSES, "user_id")} AS "executionStatus",
    CASE WHEN value > 150 THEN {sql_shape("event_id")} || ' -- changed' ELSE {sql_shape("event_id")} END AS "jdbcSql",
    CASE WHEN event_id % 29 = 0 THEN {sql_shape("event_id")} || ' /* adapted */' ELSE '' END AS "adaptedJdbcSql",
    {sql_pick(MESSAGES, "(event_id + user_id)")} AS message,
    CASE WHEN lower({sql_pick(EXECUTION_STATUSES, "user_id")}) = 'passed' THEN NULL ELSE {sql_pick(STATES, "user_id")} END AS "sqlState",
    event_type AS "validationMode", event_id AS pos
  FROM events)"""


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text): the derived statements, every document and every conversation turn, whole."""
    o = table(spark, sf_dir, "orders")
    d = table(spark, sf_dir, "documents")
    c = table(spark, sf_dir, "conversations")
    return (
        o.select(F.concat(F.lit("S"), F.col("o_orderkey")).alias("id"), shape(F.col("o_orderkey")).alias("text"))
        .unionByName(d.select(F.concat(F.lit("D"), F.col("doc_id")).alias("id"), "text"))
        .unionByName(
            c.select(F.concat(F.lit("C"), F.col("conv_id"), F.lit("-"), F.col("turn")).alias("id"), "text")
        )
    )


CORPUS_SQL = f"""corpus AS (
  SELECT 'S' || o_orderkey AS id, {sql_shape("o_orderkey")} AS text FROM orders
  UNION ALL SELECT 'D' || doc_id, text FROM documents
  UNION ALL SELECT 'C' || conv_id || '-' || turn, text FROM conversations)"""
