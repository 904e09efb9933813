"""Canonical rows, hashes, prints and summaries of results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from evenledger.catalog.registry import query, table
from evenledger.functions.canonical import canonical_row, canonical_value, column_signature, type_family
from evenledger.operators import merkle as mk
from evenledger.operators import results as rs

SEP = "chr(31)"
LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()
LINEITEM_SIGNATURE = (
    "L_ORDERKEY:NUMBER|L_PARTKEY:NUMBER|L_SUPPKEY:NUMBER|L_LINENUMBER:NUMBER|L_QUANTITY:NUMBER|L_EXTENDEDPRICE:NUMBER"
    "|L_DISCOUNT:NUMBER|L_TAX:NUMBER|L_RETURNFLAG:STRING|L_LINESTATUS:STRING|L_SHIPDATE:TIMESTAMP"
)
SUMMARY_TABLES = {
    "customer": "C_CUSTKEY:NUMBER|C_NAME:STRING|C_NATIONKEY:NUMBER|C_ACCTBAL:NUMBER|C_MKTSEGMENT:STRING",
    "orders": (
        "O_ORDERKEY:NUMBER|O_CUSTKEY:NUMBER|O_ORDERSTATUS:STRING|O_TOTALPRICE:NUMBER|O_ORDERDATE:TIMESTAMP|O_ORDERPRIORITY:STRING"
    ),
    "lineitem": LINEITEM_SIGNATURE,
    "labels": "DOC_ID:NUMBER|QUALITY:NUMBER|TOXIC:NUMBER",
}


def number(x: str) -> str:
    return f"'NUM:' || cast({x} as varchar)"


def decimal(x: str) -> str:
    return f"'NUM:' || rtrim(rtrim(cast(cast({x} as decimal(38,6)) as varchar), '0'), '.')"


def moment(x: str) -> str:
    return f"'TIMESTAMP:' || strftime(date_trunc('milliseconds', {x}), '%Y-%m-%dT%H:%M:%S.%g')"


def words(x: str) -> str:
    escaped = f"replace(replace(replace({x}, '\\', '\\\\'), chr(10), '\\n'), chr(31), '\\u001F')"
    return f"'TEXT:' || {escaped}"


def cells(*parts: str) -> str:
    return f"concat_ws({SEP}, {', '.join(f'coalesce({p}, chr(78) || chr(85) || chr(76) || chr(76))' for p in parts)})"


LINEITEM_CELLS = [
    *[number(c) for c in LINEITEM[:4]],
    *[decimal(c) for c in LINEITEM[4:8]],
    *[words(c) for c in LINEITEM[8:10]],
    moment("l_shipdate"),
]


def lineitem_row(skip: tuple[str, ...] = ()) -> str:
    return cells(*[c for n, c in zip(LINEITEM, LINEITEM_CELLS) if n not in skip])


def digest(signature: str, row: str, order: str | None = None) -> str:
    line = f"concat({row}, chr(10))"
    return f"sha256(concat('{signature}', chr(10), coalesce(string_agg({line}, '' ORDER BY {order or line}), '')))"


@query("canonical_row", f"SELECT l_orderkey, l_linenumber, {lineitem_row()} AS canonical FROM lineitem")
def _canonical_row(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", canonical_row(li).alias("canonical"))


@query(
    "canonical_value",
    f"""SELECT event_id, {moment('ts')} AS ts_cell, {decimal('value')} AS value_cell, {words('props')} AS props_cell,
      'BOOL:' || cast(value > 100 as varchar) AS bool_cell, 'DATE:' || cast(cast(ts as date) as varchar) AS date_cell,
      coalesce({decimal("CASE WHEN value > 100 THEN value END")}, 'NULL') AS null_cell,
      'BYTES:' || base64(encode(event_type)) AS bytes_cell,
      'NUM:' || rtrim(rtrim(cast(cast(value as decimal(20,2)) as varchar), '0'), '.') AS decimal_cell FROM events""",
)
def _canonical_value(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("ts_cell"),
        F.col("value").alias("value_cell"),
        F.col("props").alias("props_cell"),
        (F.col("value") > 100).alias("bool_cell"),
        F.to_date("ts").alias("date_cell"),
        F.when(F.col("value") > 100, F.col("value")).alias("null_cell"),
        F.encode("event_type", "UTF-8").alias("bytes_cell"),
        F.col("value").cast("decimal(20,2)").alias("decimal_cell"),
    )
    return e.select(
        "event_id", *[canonical_value(F.col(f.name), f.dataType).alias(f.name) for f in e.schema.fields[1:]]
    )


@query(
    "column_signature",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{s}' AS signature, count(*) AS row_count FROM {t}" for t, s in SUMMARY_TABLES.items()
    ),
)
def _column_signature(spark, sf_dir):
    parts = []
    for name in SUMMARY_TABLES:
        df = table(spark, sf_dir, name)
        parts.append(
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), F.lit(column_signature(df.schema)).alias("signature"), "row_count"
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "type_family",
    """SELECT family, count(*) AS filled FROM (
      SELECT CASE WHEN c IN ('event_id', 'user_id', 'value') THEN 'NUMBER' WHEN c = 'ts' THEN 'TIMESTAMP' ELSE 'STRING' END AS family
      FROM (UNPIVOT (SELECT event_id::varchar AS event_id, ts::varchar AS ts, user_id::varchar AS user_id, event_type,
        value::varchar AS value, props FROM events) ON COLUMNS(*) INTO NAME c VALUE v)) GROUP BY family""",
)
def _type_family(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    counts = e.agg(*[F.count(F.col(c)).alias(c) for c in e.columns])
    pairs = F.array(*[F.struct(F.lit(type_family(f.dataType)).alias("family"), F.col(f.name).alias("n")) for f in e.schema.fields])
    return counts.select(F.explode(pairs).alias("p")).groupBy("p.family").agg(F.sum("p.n").alias("filled"))


def _without(signature: str, *names: str) -> str:
    return "|".join(p for p in signature.split("|") if p.split(":")[0].lower() not in names)


@query(
    "result_hash",
    f"""SELECT l_suppkey, count(*) AS "rowCount", CASE WHEN count(*) <= 1000 THEN
      {digest(_without(LINEITEM_SIGNATURE, 'l_suppkey'), lineitem_row(('l_suppkey',)))} END AS "resultHash"
    FROM lineitem GROUP BY l_suppkey""",
)
def _result_hash(spark, sf_dir):
    return rs.result_hash(table(spark, sf_dir, "lineitem"), ["l_suppkey"], max_rows=1000)


ORDER_CELLS = [number("o_orderkey"), words("o_orderstatus"), decimal("o_totalprice"), moment("o_orderdate"), words("o_orderpriority")]
ORDER_SIGNATURE = _without(SUMMARY_TABLES["orders"], "o_custkey")


@query(
    "result_hash_order_sensitive",
    f"""SELECT o_custkey, count(*) AS "rowCount",
      {digest(ORDER_SIGNATURE, cells(*ORDER_CELLS), "o_orderdate, o_orderkey")} AS "resultHash" FROM orders GROUP BY o_custkey""",
)
def _result_hash_ordered(spark, sf_dir):
    return rs.result_hash(table(spark, sf_dir, "orders"), ["o_custkey"], ordered_by=["o_orderdate", "o_orderkey"], max_rows=1000)


def changed_lineitem(spark, sf_dir):
    """Side B: the same table with another quantity in every 97th order."""
    li = table(spark, sf_dir, "lineitem")
    return li.withColumn(
        "l_quantity", F.when(F.col("l_orderkey") % 97 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    )


@query(
    "result_fingerprint",
    """SELECT l_partkey, count(*) AS row_count_a, count(*) AS row_count_b, bool_and(l_orderkey % 97 <> 0) AS prints_equal,
      true AS equal_when_reordered FROM lineitem GROUP BY l_partkey""",
)
def _fingerprint(spark, sf_dir):
    by = ["l_partkey"]
    li = table(spark, sf_dir, "lineitem")
    a = rs.result_fingerprint(li, by).select(*by, F.col("rowCount").alias("row_count_a"), F.col("resultPrint").alias("a"))
    b = rs.result_fingerprint(changed_lineitem(spark, sf_dir), by).select(
        *by, F.col("rowCount").alias("row_count_b"), F.col("resultPrint").alias("b")
    )
    again = rs.result_fingerprint(li.repartition("l_shipdate"), by).select(*by, F.col("resultPrint").alias("c"))
    return a.join(b, by).join(again, by).select(
        *by, "row_count_a", "row_count_b", (F.col("a") == F.col("b")).alias("prints_equal"),
        (F.col("a") == F.col("c")).alias("equal_when_reordered"),
    )


def node_sql(entries: str) -> str:
    return f"sha256(coalesce(string_agg({entries}, chr(10) ORDER BY {entries}), ''))"


def tree_sql(rows: str, by: str, signature: str, leaf: int = 6, branch: int = 3) -> str:
    """The CTEs ``tree_leaves``, ``tree_branches`` and ``tree_root`` over rows with columns ``path`` and ``d``."""
    entry, child = "path || ':' || d || ':' || n", "node || ':' || c || ':' || digest"
    return f"""kinds AS (SELECT {by}, path, d, count(*) AS n FROM ({rows}) GROUP BY ALL),
tree_leaves AS (SELECT {by}, left(path, {leaf}) AS node, cast(sum(n) AS bigint) AS c, {node_sql(entry)} AS digest FROM kinds GROUP BY {by}, left(path, {leaf})),
tree_branches AS (SELECT {by}, left(node, {branch}) AS up, cast(sum(c) AS bigint) AS c, {node_sql(child)} AS digest FROM tree_leaves GROUP BY {by}, left(node, {branch})),
tree_root AS (SELECT {by}, cast(sum(c) AS bigint) AS "rowCount", sha256(concat_ws(chr(10), '{signature}', cast(sum(c) AS bigint), {node_sql(child.replace('node', 'up'))})) AS "resultHash"
  FROM tree_branches GROUP BY {by})"""


NULL_GROUP = "CASE WHEN l_partkey % 7 > 0 THEN l_partkey % 7 END"


def grouped_lineitem(spark, sf_dir):
    """Lineitem with a group key that is null for a seventh of the parts."""
    rest = F.col("l_partkey") % 7
    return table(spark, sf_dir, "lineitem").withColumn("part_group", F.when(rest > 0, rest))


@query(
    "result_root",
    f"""WITH {tree_sql(f"SELECT {NULL_GROUP} AS part_group, sha256({lineitem_row()}) AS d, d AS path FROM lineitem", "part_group", LINEITEM_SIGNATURE)}
    SELECT * FROM tree_root""",
)
def _result_root(spark, sf_dir):
    return rs.result_hash(grouped_lineitem(spark, sf_dir), ["part_group"])


@query(
    "result_root_ordered",
    f"""WITH {tree_sql(f"SELECT true AS w, sha256({cells(*ORDER_CELLS)}) AS d, lpad(upper(to_hex(row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) - 1)), 16, '0') AS path FROM orders", "w", ORDER_SIGNATURE, 13, 10)}
    SELECT "rowCount", "resultHash" FROM tree_root""",
)
def _result_root_ordered(spark, sf_dir):
    delivered = table(spark, sf_dir, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").drop("o_custkey")
    return rs.summarize_result(delivered, as_delivered=True, method="tree").select("rowCount", "resultHash")


@query(
    "result_hash_null_group",
    f"""SELECT {NULL_GROUP} AS part_group, count(*) AS "rowCount", CASE WHEN count(*) <= 9000 THEN
      {digest(LINEITEM_SIGNATURE, lineitem_row())} END AS "resultHash" FROM lineitem GROUP BY 1""",
)
def _result_hash_null_group(spark, sf_dir):
    return rs.result_hash(grouped_lineitem(spark, sf_dir), ["part_group"], max_rows=9000)


CHANGED_ROW = lineitem_row().replace(decimal("l_quantity"), decimal("l_quantity + 1"))


@query(
    "result_row_diff",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_orderkey % 89 = 0 THEN 'ONLY_A' ELSE 'CHANGED' END AS kind, 1 AS a_copies,
      CASE WHEN l_orderkey % 89 = 0 THEN 0 ELSE 1 END AS b_copies, {lineitem_row()} AS a_row,
      CASE WHEN l_orderkey % 89 <> 0 THEN {CHANGED_ROW} END AS b_row
    FROM lineitem WHERE l_orderkey % 97 = 0 OR l_orderkey % 89 = 0""",
)
def _result_row_diff(spark, sf_dir):
    changed = changed_lineitem(spark, sf_dir).where("l_orderkey % 89 <> 0")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    found = mk.tree_diff(table(spark, sf_dir, "lineitem"), changed, keys=keys)
    return found.select(
        *keys, "kind", F.col("aCopies").cast("int").alias("a_copies"), F.col("bCopies").cast("int").alias("b_copies"),
        F.col("aRow").alias("a_row"), F.col("bRow").alias("b_row"),
    )


@query(
    "summarize_result",
    f"""SELECT o_custkey, CASE WHEN count(*) > 12 THEN 'RESULT_TOO_LARGE' ELSE 'SUCCESS' END AS status,
      least(count(*), 13) AS "rowCount", CASE WHEN count(*) <= 12 THEN {digest(ORDER_SIGNATURE, cells(*ORDER_CELLS))} END AS "resultHash",
      '{ORDER_SIGNATURE}' AS "columnSignature" FROM orders GROUP BY o_custkey""",
)
def _summarize(spark, sf_dir):
    return rs.summarize_result(table(spark, sf_dir, "orders"), ["o_custkey"], max_rows=12)


@query("guard_max_rows", "SELECT least(count(*), 1001) AS rows_read, count(*) > 1000 AS too_large FROM lineitem")
def _guard(spark, sf_dir):
    guarded = rs.guard_max_rows(table(spark, sf_dir, "lineitem"), 1000)
    return guarded.agg(F.count(F.lit(1)).alias("rows_read"), (F.count(F.lit(1)) > 1000).alias("too_large"))


@query(
    "smoke_probe",
    """SELECT (SELECT least(count(*), 1) FROM lineitem WHERE l_quantity > 49) AS found,
      (SELECT least(count(*), 1) FROM lineitem WHERE l_quantity < 0) AS not_found""",
)
def _smoke(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    probe = lambda condition: rs.smoke_probe(li.where(condition)).scalar()
    return spark.range(1).select(probe("l_quantity > 49").alias("found"), probe("l_quantity < 0").alias("not_found"))
