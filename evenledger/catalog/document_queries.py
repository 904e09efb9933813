"""Documents: JSON and XML leaf paths, embedded statements, feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenledger.catalog.derive import pick, sql_pick, sql_text
from evenledger.catalog.registry import query, table
from evenledger.operators import paths as pt
from evenledger.sources.scan import scan_json_docs

q = sql_text
JSON_SHAPES = [
    '{"id":{k},"user":{"name":"n","emails":["a","b"]}}',
    '{"items":[{"id":1},{"price":2.5,"tags":[]}],"owners":[],"meta":{}}',
    '[{"id":{k}},{"name":null}]',
    '{"name":',
    '{"a":[[1,2],[{"b":{"c":true}}]],"x y":"[{"}',
    '"scalar"',
    "   ",
]


def json_docs(spark, sf_dir):
    """One document per event (its own props, or a nested shape) and one per text document."""
    e, d = table(spark, sf_dir, "events"), table(spark, sf_dir, "documents")
    k = F.col("event_id")
    content = F.when(k % 8 == 7, F.col("props")).otherwise(F.replace(pick(JSON_SHAPES, k), F.lit("{k}"), k.cast("string")))
    return e.select(F.concat(F.lit("E"), k).alias("doc_id"), content.alias("content")).unionByName(
        d.select(F.concat(F.lit("D"), F.col("doc_id")).alias("doc_id"), F.col("text").alias("content"))
    )


JSON_SQL = f"""docs AS (SELECT 'E' || event_id AS doc_id, CASE WHEN event_id % 8 = 7 THEN props ELSE replace({sql_pick(JSON_SHAPES, 'event_id')}, '{{k}}', cast(event_id as varchar)) END AS content FROM events
  UNION ALL SELECT 'D' || doc_id, text FROM documents),
valid AS (SELECT doc_id, content::json AS content FROM docs WHERE json_valid(content) AND length(content) <= 1048576),
nodes AS (SELECT doc_id, t.type AS type, json_array_length(valid.content, t.fullkey) AS n,
    regexp_replace(regexp_replace(replace(t.fullkey, '"', ''), '^\\$\\.?', ''), '\\[[0-9]+\\]', '[]', 'g') AS path
  FROM valid, json_tree(valid.content) t),
paths AS (SELECT DISTINCT doc_id, CASE WHEN type = 'ARRAY' THEN path || '[]' ELSE path END AS path FROM nodes
  WHERE type NOT IN ('OBJECT', 'ARRAY') OR (type = 'ARRAY' AND n = 0)),
leaf_paths AS (SELECT * FROM paths WHERE path <> '')"""


@query(
    "scan_json_docs",
    f"""WITH {JSON_SQL} SELECT doc_id, CASE WHEN trim(content, chr(32) || chr(9) || chr(10) || chr(13)) = '' THEN 'BLANK' WHEN json_valid(content) THEN 'VALID' ELSE 'INVALID' END AS "docStatus" FROM docs""",
)
def _scan(spark, sf_dir):
    return scan_json_docs(json_docs(spark, sf_dir), "content").select("doc_id", "docStatus")


def json_paths(spark, sf_dir):
    return pt.json_leaf_paths(json_docs(spark, sf_dir), "doc_id", "content")


@query("json_leaf_paths", f"WITH {JSON_SQL} SELECT doc_id, path FROM leaf_paths")
def _json(spark, sf_dir):
    return json_paths(spark, sf_dir)


@query("path_inventory", f'WITH {JSON_SQL} SELECT path, count(DISTINCT doc_id) AS "docCount" FROM leaf_paths GROUP BY 1 ORDER BY 1')
def _inventory(spark, sf_dir):
    return pt.path_inventory(json_paths(spark, sf_dir))


@query("distinct_paths", f"WITH {JSON_SQL} SELECT DISTINCT path FROM leaf_paths")
def _distinct(spark, sf_dir):
    return pt.distinct_paths(json_paths(spark, sf_dir))


# Shapes with the paths each of them has.
XML_SHAPES = [
    (
        '<?xml version="1.0"?><config><name>n{k}</name><toggle><local>true</local></toggle><owners><owner>a</owner></owners></config>',
        ["config.name", "config.toggle.local", "config.owners.owner"],
    ),
    (
        "<staff><person><id>{k}</id><name>a</name></person><person><id>2</id><name>b</name></person></staff>",
        ["staff.person[].id", "staff.person[].name"],
    ),
    ("<person><name/><team></team></person>", ["person.name", "person.team"]),
    ('<person id="{k}"><id>x</id></person>', ["person.@id", "person.id"]),
    ("<a><b></a>", []),
    ('<p:a xmlns:p="urn:p"><p:b p:c="1">t</p:b><d k="2"/></p:a>', ["a.b", "a.b.@c", "a.d", "a.d.@k"]),
    ("<phones><phone>1</phone><phone kind='m'>2</phone></phones>", ["phones.phone[]", "phones.phone[].@kind"]),
    ("<only>{k}</only>", ["only"]),
    ("not xml", []),
]


def xml_docs(spark, sf_dir):
    k = F.col("event_id")
    content = F.replace(pick([s for s, _ in XML_SHAPES], k), F.lit("{k}"), k.cast("string"))
    return table(spark, sf_dir, "events").select("event_id", content.alias("content"))


_XML_ROWS = ", ".join(f"({i}, {q(p)})" for i, (_, found) in enumerate(XML_SHAPES) for p in found)
XML_SQL = f"expected(shape, path) AS (VALUES {_XML_ROWS}), leaf_paths AS (SELECT event_id, path FROM events JOIN expected ON shape = event_id % {len(XML_SHAPES)})"


@query("xml_leaf_paths", f"WITH {XML_SQL} SELECT event_id, path FROM leaf_paths")
def _xml(spark, sf_dir):
    return pt.xml_leaf_paths(xml_docs(spark, sf_dir), "event_id", "content")


@query("xml_path_inventory", f'WITH {XML_SQL} SELECT path, count(*) AS "docCount" FROM leaf_paths GROUP BY 1 ORDER BY 1')
def _xml_inventory(spark, sf_dir):
    from evenledger.plans.reports import xml_path_inventory

    return xml_path_inventory(xml_docs(spark, sf_dir), "event_id", "content")


# Documents whose names meet, with the paths written out by hand.
MEETING_NAMES = [
    ("<r><a:x/><b:x/></r>", ["r.x[]"]),
    ("<!-- <!DOCTYPE r> --><r><![CDATA[<!DOCTYPE r>]]></r>", ["r"]),
    ("<!DOCTYPE r><r/>", []),
    ('<r xmlns:p="u"><p:x p:k="1"/><x k="{k}"/><y/></r>', ["r.x[]", "r.x[].@k", "r.y"]),
    ("<r><g><x/></g><g><x/><x/></g></r>", ["r.g[].x", "r.g[].x[]"]),
]
REPEATED_KEYS = [
    ('{"a":1,"a":2,"b":3}', ["a", "b"]),
    ('{"a":{"x":{k}},"a":[]}', ["a[]"]),
    ('{"a.b":1,"a":{"b":2,"c":{}}}', ["a.b"]),
    ("[" * 60 + "]" * 60, ["[]" * 60]),
    ('{"a":' * 80 + "null" + "}" * 80, [".".join("a" * 80)]),
    ("[[],{}]", ["[][]"]),
]


def shaped(spark, sf_dir, shapes):
    k = F.col("event_id")
    content = F.replace(pick([s for s, _ in shapes], k), F.lit("{k}"), k.cast("string"))
    return table(spark, sf_dir, "events").select("event_id", content.alias("content"))


def shaped_sql(shapes):
    rows = ", ".join(f"({i}, {q(p)})" for i, (_, found) in enumerate(shapes) for p in found)
    return f"SELECT event_id, path FROM events JOIN (VALUES {rows}) expected(shape, path) ON shape = event_id % {len(shapes)}"


@query("xml_leaf_paths_meeting_names", shaped_sql(MEETING_NAMES))
def _xml_names(spark, sf_dir):
    return pt.xml_leaf_paths(shaped(spark, sf_dir, MEETING_NAMES), "event_id", "content")


@query("json_leaf_paths_repeated_and_deep", shaped_sql(REPEATED_KEYS))
def _json_repeated(spark, sf_dir):
    return pt.json_leaf_paths(shaped(spark, sf_dir, REPEATED_KEYS), "event_id", "content")


@query(
    "flatten_observations",
    """SELECT event_type AS city, strftime(ts - INTERVAL 2 HOUR, '%A %I:%M %p') AS datetime, 'Cloudy ' || event_id AS weather,
      (user_id % 40) || '°C' AS temperature, (event_id % 90) || 'km/h' AS wind FROM events""",
)
def _observations(spark, sf_dir):
    from evenledger.plans.reports import flatten_observations

    now = F.struct(
        F.concat(F.lit("Cloudy "), F.col("event_id")).alias("text"), (F.col("user_id") % 40).cast("string").alias("temperature"),
        (F.col("event_id") % 90).cast("string").alias("wind_speed"),
    )
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+10:00"))
    body = F.to_json(F.struct(F.array(F.struct(now.alias("now"), stamp.alias("last_update"))).alias("results")))
    feed = table(spark, sf_dir, "events").select(F.col("event_type").alias("city"), body.alias("body"))
    return flatten_observations(feed)


# Source-file shapes with the statements each of them holds: (kind, method, line, text, needs review).
SOURCE_SHAPES = [
    (
        "interface R {\n  @Query(value = \"SELECT * FROM t \" +\n      \"WHERE id = :id{k}\", nativeQuery = true)\n  List<Row> findById(Long id);\n"
        "  @Query(\"select x from X x\")\n  List<X> all();\n  @Query(nativeQuery = true, value = \"SELECT \\\"a\\\"\\nFROM u\")\n  int count();\n}",
        [
            ("SPRING_DATA_QUERY", "findById", 2, "SELECT * FROM t WHERE id = :id{k}", False),
            ("SPRING_DATA_QUERY", "count", 7, 'SELECT "a"\nFROM u', False),
        ],
    ),
    (
        "class D {\n  List load(int a) {\n    return em.createNativeQuery(\"SELECT {k}\", Row.class).getResultList();\n  }\n\n"
        "  void save() throws Failure {\n    String sql = \"x\";\n    em.createNativeQuery(sql + a).executeUpdate();\n  }\n}",
        [("ENTITY_MANAGER", "load", 3, "SELECT {k}", False), ("ENTITY_MANAGER", "save", 8, "", True)],
    ),
    (
        "class J {\n  int n() {\n    return jdbcTemplate.queryForObject(\"SELECT count(*) FROM t WHERE a = ?\", Integer.class, a);\n  }\n"
        "  void w() {\n    this.jdbcTemplate.update(\"UPDATE t SET a = {k}\");\n    other.update(\"no\");\n  }\n}",
        [
            ("JDBC_TEMPLATE", "n", 3, "SELECT count(*) FROM t WHERE a = ?", False),
            ("JDBC_TEMPLATE", "w", 6, "UPDATE t SET a = {k}", False),
        ],
    ),
    ("class Empty {}\n", []),
]


def source_files(spark, sf_dir):
    """One source file per customer."""
    k = F.col("c_custkey")
    text = F.replace(pick([s for s, _ in SOURCE_SHAPES], k), F.lit("{k}"), k.cast("string"))
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("app/src/File"), k, F.lit(".java")).alias("filePath"), text.alias("sourceText"))


_SOURCE_ROWS = ", ".join(
    f"({i}, {q(kind)}, {q(method)}, {line}, {q(text)}, {str(review).lower()})"
    for i, (_, found) in enumerate(SOURCE_SHAPES)
    for kind, method, line, text, review in found
)


@query(
    "extract_statements",
    f"""WITH expected(shape, kind, method, line, text, review) AS (VALUES {_SOURCE_ROWS})
    SELECT 'app/src/File' || c_custkey || '.java' AS "filePath", 'File' || c_custkey AS "className", method AS "methodName", kind AS "sourceType", line AS "lineNumber",
      replace(text, '{{k}}', cast(c_custkey as varchar)) AS "sqlText", review AS "requiresManualReview", CASE WHEN review THEN 'LOW' ELSE 'HIGH' END AS confidence
    FROM customer JOIN expected ON shape = c_custkey % {len(SOURCE_SHAPES)}""",
)
def _extract(spark, sf_dir):
    from evenledger.plans.statements import extract_statements

    return extract_statements(source_files(spark, sf_dir)).select(
        "filePath", "className", "methodName", "sourceType", "lineNumber", "sqlText", "requiresManualReview", "confidence"
    )
