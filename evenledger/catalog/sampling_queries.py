"""Parameter samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenledger.catalog.derive import pick, sql_pick
from evenledger.catalog.registry import query, table
from evenledger.operators import sampling as sp
from evenledger.operators.sampling import Mapping

MAPPINGS = [
    Mapping(1, (1, 3), "segment", "c_mktsegment", "String", lower=True),
    Mapping(2, (2,), "nation", "c_nationkey", "Integer"),
]


@query(
    "sample_tuples",
    """SELECT row_number() OVER (ORDER BY p1, p2) AS "sampleIndex", p1, p2 FROM (SELECT DISTINCT lower(c_mktsegment) AS p1, c_nationkey AS p2 FROM customer
      WHERE c_mktsegment IS NOT NULL AND c_nationkey IS NOT NULL) ORDER BY p1, p2 LIMIT 3""",
)
def _sample(spark, sf_dir):
    return sp.sample_tuples(table(spark, sf_dir, "customer"), MAPPINGS, 3)


@query(
    "sample_tuples_per_plan",
    """SELECT l_returnflag, "sampleIndex", p1, p2 FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY p1, p2) AS "sampleIndex"
      FROM (SELECT DISTINCT l_returnflag, l_suppkey AS p1, l_linenumber AS p2 FROM lineitem)) WHERE "sampleIndex" <= 4""",
)
def _per_plan(spark, sf_dir):
    mappings = [Mapping(1, (1,), "supplier", "l_suppkey"), Mapping(2, (2,), "line", "l_linenumber")]
    return sp.sample_tuples(table(spark, sf_dir, "lineitem"), mappings, 4, by=["l_returnflag"])


@query(
    "sample_index",
    """SELECT o_custkey, o_orderpriority, o_orderstatus, n AS "sampleIndex" FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderstatus) AS n
      FROM (SELECT DISTINCT o_custkey, o_orderpriority, o_orderstatus FROM orders)) WHERE n <= 3""",
)
def _index(spark, sf_dir):
    return sp.sample_index(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderpriority", "o_orderstatus"], 3)


@query(
    "tuple_column",
    """WITH s AS (SELECT row_number() OVER (ORDER BY p1, p2) AS n, p1, p2 FROM (SELECT DISTINCT lower(c_mktsegment) AS p1, c_nationkey AS p2 FROM customer) ORDER BY p1, p2 LIMIT 3)
    SELECT n AS "sampleIndex", 1 AS logical, '1,3' AS indexes, 'segment' AS name, 'STRING' AS kind, p1 AS value FROM s
    UNION ALL SELECT n, 2, '2', 'nation', 'INTEGER', cast(p2 as varchar) FROM s""",
)
def _tuple(spark, sf_dir):
    samples = sp.sample_tuples(table(spark, sf_dir, "customer"), MAPPINGS, 3)
    values = sp.tuple_column(samples, MAPPINGS, "customer").select("sampleIndex", F.explode("values").alias("v"))
    return values.select(
        "sampleIndex", F.col("v.logicalParameterIndex").alias("logical"),
        F.array_join(F.col("v.jdbcIndexes").cast("array<string>"), ",").alias("indexes"),
        F.col("v.parameterName").alias("name"), "v.kind", "v.value",
    )


# Columns that the statements of a table ask for, and the SQL text of their values.
ASKED = {
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"),
    "lineitem": ("l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
    "part": ("p_partkey", "p_name", "p_brand", "p_size"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey"),
}
PER_TABLE = 73


def asked():
    """Statement id -> (table, mappings): 73 statements a table with one to three parameters, some of them lower-cased."""
    specs = {}
    for t, columns in ASKED.items():
        for k in range(PER_TABLE):
            mappings = []
            for i in range(1 + k % 3):
                c = columns[(k // 3 + i * (1 + k % 2)) % len(columns)]
                mappings.append(Mapping(i + 1, (i + 1,), f"v{i}", c, lower=k % 5 == 0 and c.endswith(("name", "status", "segment", "brand"))))
            specs[f"{t}-{k}"] = (t, mappings)
    return specs


def asked_sql():
    parts = []
    for sql_id, (t, mappings) in asked().items():
        shown = {m.index: f"lower({m.column})" if m.lower else m.column for m in mappings}
        names = ", ".join(f"p{i}" for i in shown)
        text = " || '|' || ".join(
            f"strftime(p{m.index}, '%Y-%m-%dT%H:%M:%S.%f')" if m.column == "o_orderdate" else f"cast(p{m.index} as varchar)" for m in mappings
        )
        picked = ", ".join(f"{e} AS p{i}" for i, e in shown.items())
        known = " AND ".join(f"{m.column} IS NOT NULL" for m in mappings)
        parts.append(
            f"SELECT '{sql_id}' AS \"sqlId\", row_number() OVER (ORDER BY {names}) AS \"sampleIndex\", {text} AS texts, count(*) OVER () AS \"collectedSampleCount\" "
            f"FROM (SELECT DISTINCT {picked} FROM {t} WHERE {known} ORDER BY {names} LIMIT 3)"
        )
    return " UNION ALL ".join(parts)


@query("sample_parameters", asked_sql())
def _sample_parameters(spark, sf_dir):
    from evenledger.plans.capture import sample_parameters

    found = sample_parameters(spark, {t: table(spark, sf_dir, t) for t in ASKED}, asked())
    texts = F.array_join(F.transform("values", lambda v: v["value"]), "|")
    return found.select("sqlId", F.col("sampleIndex").cast("long"), texts.alias("texts"), F.col("collectedSampleCount").cast("long"))


PLAN = ["READY", "READY", "NO_PARAMETERS", "READY", "MANUAL_MAPPING_REQUIRED", "SKIPPED_UNSUPPORTED", "READY"]


def outcomes(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    plans = table(spark, sf_dir, "orders").select(
        "o_orderkey", pick(PLAN, k).alias("planStatus"), (c % 4).alias("tupleCount"),
        F.when(c % 37 == 0, "refused").alias("connectionError"), F.when(c % 11 == 0, "no such table").alias("queryError"),
        F.lit("CODE").alias("planCode"), F.lit("because").alias("planReason"),
    )
    return sp.sampling_status(plans)


OUTCOMES_SQL = f"""p AS (SELECT o_orderkey, {sql_pick(PLAN, 'o_orderkey')} AS plan, o_custkey % 4 AS n, o_custkey % 37 = 0 AS refused, o_custkey % 11 = 0 AS broken FROM orders),
o AS (SELECT *, CASE WHEN refused THEN 'H2_CONNECTION_FAILED' WHEN plan = 'NO_PARAMETERS' THEN plan WHEN plan = 'SKIPPED_UNSUPPORTED' THEN plan
    WHEN plan <> 'READY' THEN 'MANUAL_MAPPING_REQUIRED' WHEN broken THEN 'H2_QUERY_FAILED' WHEN n = 0 THEN 'NO_SAMPLE_DATA' ELSE 'SAMPLED' END AS s FROM p)"""


@query(
    "sampling_status",
    f"""WITH {OUTCOMES_SQL} SELECT o_orderkey, s AS "samplingStatus", CASE WHEN s IN ('SKIPPED_UNSUPPORTED', 'MANUAL_MAPPING_REQUIRED') THEN 'CODE'
      WHEN s = 'H2_QUERY_FAILED' THEN 'H2_SAMPLING_QUERY_FAILED' ELSE s END AS "reasonCode" FROM o""",
)
def _status(spark, sf_dir):
    return outcomes(spark, sf_dir).select("o_orderkey", "samplingStatus", "reasonCode")


@query(
    "sampling_totals",
    f"""WITH {OUTCOMES_SQL} SELECT count(*) AS "samplingCandidates", count(*) FILTER (s = 'SAMPLED') AS "sampledSql",
      (sum(n) FILTER (s = 'SAMPLED'))::bigint AS "sampledTuples", count(*) FILTER (s = 'NO_SAMPLE_DATA') AS "noSampleData",
      count(*) FILTER (s = 'MANUAL_MAPPING_REQUIRED') AS "manualMappingRequired", count(*) FILTER (s = 'SKIPPED_UNSUPPORTED') AS unsupported,
      count(*) FILTER (s = 'H2_QUERY_FAILED') AS "queryFailures", count(*) FILTER (s = 'H2_CONNECTION_FAILED') AS "connectionFailures" FROM o""",
)
def _totals(spark, sf_dir):
    return sp.sampling_totals(outcomes(spark, sf_dir))
