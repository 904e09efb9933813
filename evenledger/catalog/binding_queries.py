"""Bindings, plans, parameter resolution and default values."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenledger.catalog.candidate_queries import AGGREGATED_SQL, USABLE
from evenledger.catalog.derive import (
    BINDINGS_SQL,
    NAMES,
    STATEMENTS_SQL,
    TYPES,
    bindings,
    pick,
    sql_pick,
    sql_text,
    statements,
)
from evenledger.catalog.registry import query, table
from evenledger.functions import parameters as pm
from evenledger.operators import bindings as bd

q = sql_text
STRING_RE = q(r"'[^']*(?:'|\z)")


@query("aggregate_bindings", f"WITH {BINDINGS_SQL}, {AGGREGATED_SQL} SELECT * FROM aggregated")
def _aggregate(spark, sf_dir):
    return bd.aggregate_bindings(bindings(spark, sf_dir))


@query("binding_usable", f'WITH {BINDINGS_SQL}, {AGGREGATED_SQL} SELECT b."sqlId", {USABLE} AS usable FROM aggregated b')
def _usable(spark, sf_dir):
    plan = bd.aggregate_bindings(bindings(spark, sf_dir))
    return plan.select("sqlId", bd.binding_usable(F.col("jdbcSql"), F.col("bindingStatus")).alias("usable"))


ORDER = ["bindingIndex", "_part", "_price"]
PARTED = """parted AS (SELECT *, (row_number() OVER (PARTITION BY "sqlId" ORDER BY "bindingIndex" NULLS LAST, part, price) - 1) // {n} AS chunk,
    row_number() OVER (PARTITION BY "sqlId" ORDER BY "bindingIndex" NULLS LAST, part, price) AS no FROM bindings)"""
LABEL = """'#' || "bindingIndex" || ' ' || CASE WHEN trim("javaParameterName") <> '' THEN "javaParameterName" ELSE "originalParameter" END || ':'
  || CASE WHEN trim("javaType") = '' THEN '?' ELSE "javaType" END || CASE WHEN trim("parameterKind") = '' THEN '' ELSE '/' || "parameterKind" END
  || CASE WHEN trim("mockValue") = '' THEN '' ELSE '=' || "mockValue" END"""


@query(
    "group_bindings",
    f"""WITH {BINDINGS_SQL}, {PARTED.format(n=3)} SELECT "sqlId", chunk AS part, count(*) AS n,
      string_agg("javaType" || '/' || part, ',' ORDER BY no) AS items FROM parted GROUP BY 1, 2""",
)
def _group(spark, sf_dir):
    lists = bd.group_bindings(bindings(spark, sf_dir), ORDER, part_rows=3)
    item = F.transform("bindings", lambda b: F.concat_ws("/", b.getField("javaType"), b.getField("_part").cast("string")))
    return lists.select("sqlId", "part", F.size("bindings").alias("n"), F.array_join(item, ",").alias("items"))


@query(
    "parameter_summary",
    f"""WITH {BINDINGS_SQL}, {PARTED.format(n=1000)} SELECT "sqlId", chunk AS part, coalesce(string_agg({LABEL}, '; ' ORDER BY no), '') AS "parameterSummary"
    FROM parted GROUP BY 1, 2""",
)
def _summary(spark, sf_dir):
    b = bindings(spark, sf_dir)
    return bd.parameter_summary(b, ORDER)


@query(
    "plan_status",
    f"""WITH {BINDINGS_SQL} SELECT "sqlId", CASE WHEN bool_or(confidence = 'MANUAL_REQUIRED') THEN 'MANUAL_REQUIRED'
      WHEN bool_or(confidence = 'LOW') THEN 'READY_WITH_LOW_CONFIDENCE' ELSE 'READY' END AS "planStatus" FROM bindings GROUP BY 1""",
)
def _plan_status(spark, sf_dir):
    return bd.plan_status(bindings(spark, sf_dir))


MARKS = f"""regexp_extract_all(regexp_replace(regexp_replace("effectiveSql", {STRING_RE}, '', 'g'), ':{{2,}}', chr(1), 'g'),
  ':[A-Za-z_$][A-Za-z0-9_$]*|\\?[0-9]*')"""
KIND = "CASE WHEN x LIKE ':%' THEN 'NAMED' WHEN length(x) > 1 THEN 'JPA_INDEXED_POSITIONAL' ELSE 'JDBC_ORDINAL_POSITIONAL' END"
PLAN_SQL = f"""texts AS (SELECT *, CASE WHEN trim("normalizedSqlText") <> '' THEN "normalizedSqlText" ELSE '' END AS "effectiveSql" FROM statements),
kinds AS (SELECT *, list_distinct(list_transform({MARKS}, lambda x: {KIND})) AS kinds FROM texts),
plans AS (SELECT *, CASE WHEN "effectiveSql" = '' THEN 'EMPTY_SQL' WHEN "dynamicSql" THEN 'SKIPPED_DYNAMIC_SQL' WHEN len(kinds) = 0 THEN 'READY'
    WHEN len(kinds) > 1 THEN 'UNSUPPORTED_PARAMETER_STYLE' ELSE 'PENDING' END AS "planStatus",
  CASE WHEN "effectiveSql" = '' THEN 'Empty SQL' WHEN "dynamicSql" THEN 'Dynamic SQL requires manual review' WHEN len(kinds) = 0 THEN 'No parameters'
    WHEN len(kinds) > 1 THEN 'Mixed parameter styles are not supported' WHEN kinds[1] = 'NAMED' THEN 'Named parameter binding plan'
    WHEN kinds[1] = 'JPA_INDEXED_POSITIONAL' THEN 'JPA indexed positional binding plan' ELSE 'JDBC ordinal positional binding plan' END AS note FROM kinds)"""


def effective_statements(spark, sf_dir):
    return statements(spark, sf_dir).withColumn(
        "effectiveSql", F.when(F.trim("normalizedSqlText") != "", F.col("normalizedSqlText")).otherwise("")
    )


@query("plan_builder", f'WITH {STATEMENTS_SQL}, {PLAN_SQL} SELECT "sqlId", "planStatus", note FROM plans')
def _plan_builder(spark, sf_dir):
    return bd.plan_builder(effective_statements(spark, sf_dir)).select("sqlId", "planStatus", "note")


DECLARED_KEYS = ["status", "1", "ids", "2", "named", "c", "orderId", "3"]


def declared(spark, sf_dir):
    """Declared parameters: the first line item of each order names one key of its statement."""
    li = table(spark, sf_dir, "lineitem")
    keyed = li.select(
        F.concat(F.lit("S"), F.col("l_orderkey")).alias("sqlId"),
        pick(DECLARED_KEYS, F.col("l_partkey")).alias("paramKey"),
        F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("s"),
    )
    one = keyed.groupBy("sqlId", "paramKey").agg(F.min("p").alias("p"), F.min("s").alias("s"))
    return one.select(
        "sqlId",
        "paramKey",
        F.concat(F.lit("arg"), F.col("p")).alias("name"),
        pick(TYPES, F.col("p")).alias("javaType"),
        F.lit("SCALAR").alias("parameterKind"),
        F.col("s").cast("string").alias("value"),
        F.when(F.col("s") % 9 == 0, "MANUAL_REQUIRED").otherwise("HIGH").alias("confidence"),
    )


DECLARED_SQL = f"""declared AS (SELECT "sqlId", "paramKey", 'arg' || p AS name, {sql_pick(TYPES, 'p')} AS "javaType", 'SCALAR' AS "parameterKind",
    cast(s as varchar) AS value, CASE WHEN s % 9 = 0 THEN 'MANUAL_REQUIRED' ELSE 'HIGH' END AS confidence
  FROM (SELECT 'S' || l_orderkey AS "sqlId", {sql_pick(DECLARED_KEYS, 'l_partkey')} AS "paramKey", min(l_partkey) AS p, min(l_suppkey) AS s
    FROM lineitem GROUP BY 1, 2)),
marks AS (SELECT "sqlId", unnest({MARKS}) AS mark, generate_subscripts({MARKS}, 1) AS occurrence FROM plans WHERE "planStatus" = 'PENDING'),
resolved AS (SELECT m."sqlId", occurrence AS "bindingIndex", mark AS "originalParameter", d.name AS "javaParameterName", d."javaType",
    coalesce(d."parameterKind", 'UNKNOWN') AS "parameterKind", CASE WHEN d.name IS NULL THEN 'TEST' ELSE d.value END AS "mockValue",
    CASE WHEN d.name IS NULL THEN 'LOW' ELSE d.confidence END AS confidence,
    CASE WHEN mark LIKE ':%' THEN CASE WHEN d.name IS NULL THEN {q(bd.NOTES['NAMED'][1])} ELSE {q(bd.NOTES['NAMED'][0])} END
      WHEN length(mark) > 1 THEN CASE WHEN d.name IS NULL THEN {q(bd.NOTES['JPA_INDEXED_POSITIONAL'][1])} ELSE {q(bd.NOTES['JPA_INDEXED_POSITIONAL'][0])} END
      ELSE CASE WHEN d.name IS NULL THEN {q(bd.NOTES['JDBC_ORDINAL_POSITIONAL'][1])} ELSE {q(bd.NOTES['JDBC_ORDINAL_POSITIONAL'][0])} END END AS "bindingNote"
  FROM marks m LEFT JOIN declared d ON d."sqlId" = m."sqlId" AND d."paramKey" =
    CASE WHEN mark LIKE ':%' OR length(mark) > 1 THEN substr(mark, 2) ELSE cast(occurrence as varchar) END)"""


def planned(spark, sf_dir):
    from evenledger.plans.statements import plan_bindings

    return plan_bindings(effective_statements(spark, sf_dir), declared(spark, sf_dir))


@query("resolve_params", f"WITH {STATEMENTS_SQL}, {PLAN_SQL}, {DECLARED_SQL} SELECT * FROM resolved")
def _resolve(spark, sf_dir):
    return planned(spark, sf_dir)[1]


FINISHED_SQL = """finished AS (SELECT p."sqlId", note, coalesce(CASE WHEN "planStatus" = 'PENDING' THEN r.s END, "planStatus") AS "planStatus"
  FROM plans p LEFT JOIN (SELECT "sqlId", CASE WHEN bool_or(confidence = 'MANUAL_REQUIRED') THEN 'MANUAL_REQUIRED'
    WHEN bool_or(confidence = 'LOW') THEN 'READY_WITH_LOW_CONFIDENCE' ELSE 'READY' END AS s FROM resolved GROUP BY 1) r ON r."sqlId" = p."sqlId")"""


@query(
    "plan_bindings",
    f'WITH {STATEMENTS_SQL}, {PLAN_SQL}, {DECLARED_SQL}, {FINISHED_SQL} SELECT "sqlId", "planStatus", note FROM finished',
)
def _plan_bindings(spark, sf_dir):
    return planned(spark, sf_dir)[0].select("sqlId", "planStatus", "note")


@query(
    "binding_report",
    f"""WITH {STATEMENTS_SQL}, {PLAN_SQL}, {DECLARED_SQL} SELECT p."sqlId", p."sourceType" AS "parameterMode", coalesce("originalParameter", '') AS "originalParameter",
      coalesce(cast("bindingIndex" as varchar), '') AS "bindingIndex", coalesce("javaParameterName", '') AS "javaParameterName",
      coalesce("javaType", '') AS "javaType", coalesce("parameterKind", '') AS "parameterKind",
      coalesce("mockValue" || repeat('y', 98), '') AS "mockValue", coalesce(substr("mockValue" || repeat('y', 98), 1, 100), '') AS "mockValuePreview", coalesce(r.confidence, '') AS confidence,
      coalesce("bindingNote", note) AS "bindingNote" FROM plans p LEFT JOIN resolved r ON r."sqlId" = p."sqlId" """,
)
def _report(spark, sf_dir):
    plans, found = planned(spark, sf_dir)
    plans = plans.withColumn("parameterMode", F.col("sourceType"))
    long_values = found.withColumn("mockValue", F.concat("mockValue", F.lit("y" * 98)))
    return bd.binding_report(plans, long_values)


PARAMETER_NAMES = [*NAMES, "rowTimestamp", "uuid", "enabledNow"]


@query(
    "default_value",
    f"""WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, lower({sql_pick(TYPES, 'l_partkey')}) AS t,
      lower({sql_pick(PARAMETER_NAMES, 'l_suppkey')}) AS n, l_shipdate AS now FROM lineitem),
    g AS (SELECT *, CASE WHEN contains(n, 'uuid') THEN '{pm.DEFAULT_UUID}' WHEN n LIKE '%id' OR n LIKE '%ids' THEN '1'
      WHEN contains(n, 'date') THEN strftime(now, '%Y-%m-%d') WHEN contains(n, 'time') THEN strftime(now, '%Y-%m-%dT%H:%M:%S')
      WHEN regexp_matches(n, 'flag|enabled|active') THEN 'true' ELSE 'TEST' END AS guess FROM p)
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CASE WHEN t = '' OR contains(t, 'string') THEN guess
      WHEN regexp_matches(t, 'long|integer|short|bigdecimal') OR t = 'int' THEN '1' WHEN contains(t, 'boolean') THEN 'true'
      WHEN regexp_matches(t, 'localdatetime|timestamp') THEN strftime(now, '%Y-%m-%dT%H:%M:%S') WHEN contains(t, 'localdate') THEN strftime(now, '%Y-%m-%d')
      WHEN contains(t, 'uuid') THEN '{pm.DEFAULT_UUID}' ELSE guess END AS value FROM g""",
)
def _default(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    value = pm.default_value(pick(TYPES, F.col("l_partkey")), pick(PARAMETER_NAMES, F.col("l_suppkey")), F.col("l_shipdate"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", value.alias("value"))


@query(
    "default_list",
    f"""WITH p AS (SELECT p_partkey, lower({sql_pick(TYPES, 'p_partkey')}) AS t, cast(p_size % 4 as int) AS n FROM part)
    SELECT p_partkey, array_to_string(list_transform(range(1, greatest(n, 1) + 1), lambda i:
      CASE WHEN regexp_matches(t, 'long|integer|short|bigdecimal') THEN cast(i as varchar) WHEN contains(t, 'string') THEN 'TEST_' || i
        WHEN contains(t, 'boolean') THEN 'true' WHEN contains(t, 'localdatetime') THEN '2026-01-02T03:04:05'
        WHEN contains(t, 'localdate') THEN '2026-01-02' WHEN contains(t, 'uuid') THEN '{pm.DEFAULT_UUID}' ELSE 'TEST' END), ',') AS items FROM p""",
)
def _default_list(spark, sf_dir):
    now = F.to_timestamp_ntz(F.lit("2026-01-02 03:04:05"))
    items = pm.default_list(pick(TYPES, F.col("p_partkey")), F.lit("comment"), F.col("p_size") % 4, now)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(items, ",").alias("items"))


@query(
    "match_param_type",
    """WITH params AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_suppkey, 'src/' || (l_partkey % 20) AS f, 'm' || (l_suppkey % 10) AS m,
        'p' || (l_linenumber % 4) AS n, CASE WHEN l_returnflag = 'N' THEN 'Guess' END AS g FROM lineitem),
      declared AS (SELECT 'src/' || (p_partkey % 20) AS f, 'm' || (p_size % 10) AS m, 'p1' AS n, min(p_brand) AS t FROM part GROUP BY 1, 2, 3)
    SELECT l_orderkey, l_linenumber, l_extendedprice, coalesce(t, g, '') AS "javaType", CASE WHEN t IS NULL THEN 'LOW' ELSE 'HIGH' END AS confidence
    FROM params LEFT JOIN declared USING (f, m, n)""",
)
def _match_type(spark, sf_dir):
    text = lambda prefix, c: F.concat(F.lit(prefix), c)
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_suppkey",
        text("src/", F.col("l_partkey") % 20).alias("filePath"), text("m", F.col("l_suppkey") % 10).alias("methodName"),
        text("p", F.col("l_linenumber") % 4).alias("parameterName"),
        F.when(F.col("l_returnflag") == "N", "Guess").alias("guessedType"),
    )
    known = table(spark, sf_dir, "part").groupBy(
        text("src/", F.col("p_partkey") % 20).alias("filePath"), text("m", F.col("p_size") % 10).alias("methodName"),
        F.lit("p1").alias("parameterName"),
    ).agg(F.min("p_brand").alias("declaredType"))
    return bd.match_param_type(li, known).select("l_orderkey", "l_linenumber", "l_extendedprice", "javaType", "confidence")


def sample_bindings(spark, sf_dir):
    """(indexes, bindings) of each order: every line number is an index, distinct parts name logical parameters."""
    li = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_orderkey")).alias("sqlId"), F.col("l_linenumber").alias("jdbcIndex"), "l_partkey", "l_suppkey"
    )
    one = li.groupBy("sqlId", "jdbcIndex").agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    known = one.where("s % 4 <> 0").select(
        "sqlId", "jdbcIndex", (F.col("p") % 3).cast("int").alias("logicalParameterIndex"),
        F.when(F.col("s") % 3 == 0, " ").otherwise(F.concat(F.lit("n"), F.col("p") % 3)).alias("parameterName"),
        pick(TYPES, F.col("p")).alias("javaType"),
    )
    return one.select("sqlId", "jdbcIndex"), known


SAMPLE_BINDINGS_SQL = f"""one AS (SELECT 'S' || l_orderkey AS "sqlId", l_linenumber AS i, min(l_partkey) AS p, min(l_suppkey) AS s FROM lineitem GROUP BY 1, 2),
known AS (SELECT *, p % 3 AS logical, CASE WHEN s % 3 = 0 THEN ' ' ELSE 'n' || (p % 3) END AS name, {sql_pick(TYPES, 'p')} AS t FROM one WHERE s % 4 <> 0),
placed AS (SELECT o."sqlId", o.i, CASE WHEN k.logical >= 1 THEN k.logical ELSE o.i END AS logical, k.name, k.t FROM one o LEFT JOIN known k ON k."sqlId" = o."sqlId" AND k.i = o.i)"""


@query(
    "resolve_sample_bindings",
    f"""WITH {SAMPLE_BINDINGS_SQL} SELECT "sqlId", logical AS "logicalParameterIndex",
      CASE WHEN trim(coalesce(name, '')) <> '' THEN name ELSE 'param' || logical END AS "parameterName",
      array_to_string(list_sort(list_distinct(list(i))), ',') AS "jdbcIndexes", arg_min(coalesce(t, ''), i) AS "javaType" FROM placed GROUP BY 1, 2, 3""",
)
def _sample_bindings(spark, sf_dir):
    found = bd.resolve_sample_bindings(*sample_bindings(spark, sf_dir))
    return found.withColumn("jdbcIndexes", F.array_join(F.col("jdbcIndexes").cast("array<string>"), ","))


@query(
    "check_param_mapping",
    """WITH m AS (SELECT 'S' || l_orderkey AS "sqlId", l_linenumber % 2 AS "logicalParameterIndex",
        CASE WHEN l_partkey % 5 = 0 THEN 'STATUS' WHEN l_partkey % 5 = 1 THEN 'region' ELSE 'status' END AS c,
        CASE WHEN l_suppkey % 10 = 0 THEN 'LOWERCASE' ELSE 'IDENTITY' END AS t FROM lineitem)
    SELECT "sqlId", "logicalParameterIndex",
      CASE WHEN count(DISTINCT lower(c) || '/' || t) > 1 THEN 'MANUAL_MAPPING_REQUIRED' ELSE 'READY' END AS "mappingStatus",
      CASE WHEN count(DISTINCT lower(c) || '/' || t) > 1 THEN 'REPEATED_PARAMETER_DIFFERENT_COLUMNS' ELSE 'READY' END AS "reasonCode" FROM m GROUP BY 1, 2""",
)
def _check_mapping(spark, sf_dir):
    p = F.col("l_partkey")
    m = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_orderkey")).alias("sqlId"), (F.col("l_linenumber") % 2).alias("logicalParameterIndex"),
        F.when(p % 5 == 0, "STATUS").when(p % 5 == 1, "region").otherwise("status").alias("sourceColumn"),
        F.when(F.col("l_suppkey") % 10 == 0, "LOWERCASE").alias("transform"),
    )
    return bd.check_param_mapping(m)


@query(
    "validate_indexes",
    """SELECT l_orderkey, count(*) AS n, list_sort(list(l_linenumber)) = range(1, count(*) + 1) AS "indexesValid" FROM lineitem GROUP BY 1""",
)
def _validate(spark, sf_dir):
    return bd.validate_indexes(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


NULL_TYPE = "CASE " + " ".join(f"WHEN contains(t, {q(part)}) THEN {q(name)}" for part, name in pm.DECLARED_TYPES) + " ELSE 'VARCHAR' END"
KIND_TYPE = "CASE k " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in pm.KIND_TYPES.items()) + f" ELSE {NULL_TYPE} END"


def tuples(spark, sf_dir):
    """One tuple of two logical parameters per order; the second is bound at two indexes."""
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    null_second = F.when(c % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus"))

    def value(index, jdbc, name, java, kind, text):
        return F.struct(
            F.lit(index), F.array(*[F.lit(i) for i in jdbc]), F.lit(name), java, F.lit(False), kind, text,
            F.lit("orders"), F.lit(name),
        ).cast(pm.SAMPLE_VALUE)

    first = value(1, [2], "key", pick(TYPES, k), pick(list(pm.KIND_TYPES), k), k.cast("string"))
    second = value(2, [1, 3], "state", pick(TYPES, c), pick(list(pm.KIND_TYPES), c), null_second)
    return o.select("o_orderkey", "o_custkey", F.array(first, second).alias("values"))


EXPANDED_SQL = f"""v AS (SELECT o_orderkey, 1 AS logical, unnest([2]) AS i, 'key' AS name, {sql_pick(list(pm.KIND_TYPES), 'o_orderkey')} AS kind,
    cast(o_orderkey as varchar) AS value, {sql_pick(TYPES, 'o_orderkey')} AS t FROM orders
  UNION ALL SELECT o_orderkey, 2, unnest([1, 3]), 'state', {sql_pick(list(pm.KIND_TYPES), 'o_custkey')},
    CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_orderstatus END, {sql_pick(TYPES, 'o_custkey')} FROM orders),
expanded AS (SELECT *, CASE WHEN value IS NULL THEN 'NULL' ELSE kind END AS k FROM v)"""


@query(
    "expand_parameters",
    f"""WITH {EXPANDED_SQL} SELECT o_orderkey, i AS "jdbcIndex", logical AS "logicalParameterIndex", name AS "parameterName", k AS "valueType",
      {KIND_TYPE} AS "jdbcType", value, CASE WHEN k = 'BYTES' THEN 'BASE64' END AS encoding FROM expanded""",
)
def _expand(spark, sf_dir):
    return bd.expand_parameters(tuples(spark, sf_dir).drop("o_custkey"))


@query(
    "string_list",
    f"""SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(p_name || ' , ,' || p_type || ',', ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS items FROM part""",
)
def _string_list(spark, sf_dir):
    from evenledger.operators.feeds import string_list

    text = F.concat("p_name", F.lit(" , ,"), "p_type", F.lit(","))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(string_list(text), "|").alias("items"))
