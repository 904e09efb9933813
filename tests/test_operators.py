"""Single operators on tiny inputs."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from evenledger.functions import text as tx
from evenledger.functions.canonical import UnsupportedResultType, canonical_row, canonical_value, column_signature, signature_of
from evenledger.functions.chain import blank
from evenledger.functions.identity import baseline_key, case_id, numbered_id
from evenledger.functions.parameters import SAMPLE_VALUE, default_value
from evenledger.operators import bindings as bd
from evenledger.operators import cases as cs
from evenledger.operators import compare as cp
from evenledger.operators import issues as iss
from evenledger.operators.candidates import build_candidates
from evenledger.operators.paths import json_leaf_paths, nesting_depth, xml_leaf_paths
from evenledger.operators.results import guard_max_rows, result_fingerprint, result_hash, summarize_result
from evenledger.operators.sampling import Mapping, sample_tuples, tuple_column
from evenledger.plans.replay import arguments
from evenledger.sources.contracts import BASELINE, COMPARISON, CROSSDB_LONG, CROSSDB_SHORT, DETAIL_REPORT


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "sql, count",
    [
        ("SELECT '?' , ?, \"?\" -- ignored ?\n, ? /* ignored ? */", 2),
        ("SELECT 'it''s ?' WHERE a = ?", 1),
        ("SELECT 'open ?", 0),
        ("/* open ?", 0),
        ("", 0),
    ],
)
def test_placeholder_count(spark, sql, count):
    assert one(spark, tx.placeholder_count(F.lit(sql))) == count


@pytest.mark.parametrize(
    "sql, code",
    [
        ("SELECT 1;", "SAFE_SELECT"),
        ("SELECT 1; SELECT 2", "MULTIPLE_STATEMENTS"),
        ("SELECT ';' ; -- x;", "SAFE_SELECT"),
        ("SELECT * FROM t FOR UPDATE", "UNSAFE_SELECT"),
        ("SELECT CURRENT_TIMESTAMP", "NON_DETERMINISTIC_SELECT"),
        ("SELECT * FROM ?", "DYNAMIC_IDENTIFIER"),
        ("SELECTED", "NOT_SELECT"),
        ("-- c\n/* d */ WITH a AS (SELECT 1) SELECT * FROM a", "SAFE_SELECT"),
        (None, "NOT_SELECT"),
    ],
)
def test_select_flags(spark, sql, code):
    assert one(spark, tx.select_flags(F.lit(sql).cast("string")).getField("reason_code")) == code


def test_long_texts_do_not_overflow_patterns(spark):
    long = "SELECT '" + "x''" * 50_000 + "' WHERE a = ? -- " + "y" * 200_000
    assert one(spark, tx.placeholder_count(F.lit(long))) == 1


@pytest.mark.parametrize(
    "value, ddl, cell",
    [
        (Decimal("1.00"), "decimal(10,2)", "NUM:1"),
        (1, "int", "NUM:1"),
        (1.0, "double", "NUM:1"),
        (100.25, "double", "NUM:100.25"),
        (0.1, "float", "NUM:0.1"),
        (float("nan"), "double", "NUM:NaN"),
        (1e300, "double", "NUM:1.0E300"),
        (-0.0, "double", "NUM:0"),
        (Decimal("1200"), "decimal(10,0)", "NUM:1200"),
        (date(2026, 7, 20), "date", "DATE:2026-07-20"),
        (datetime(2026, 7, 20, 1, 2, 3, 456789), "timestamp_ntz", "TIMESTAMP:2026-07-20T01:02:03.456"),
        (True, "boolean", "BOOL:true"),
        (b"\x01\x02", "binary", "BYTES:AQI="),
        ("NULL", "string", "TEXT:NULL"),
        (None, "string", "NULL"),
        ("a\nb\x1fc\\", "string", "TEXT:a\\nb\\u001Fc\\\\"),
    ],
)
def test_canonical_value(spark, value, ddl, cell):
    df = spark.createDataFrame([(value,)], f"c {ddl}")
    assert df.select(canonical_value(F.col("c"), df.schema["c"].dataType).alias("v")).first()["v"] == cell


def test_instants_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("select timestamp '2026-01-01 00:00:00+02:00' as c")
    expected = "INSTANT:2025-12-31T22:00:00.000Z"
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(canonical_value(F.col("c"), df.schema["c"].dataType).alias("v")).first()["v"] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_nested_columns_are_refused(spark):
    df = spark.sql("select array(1) as c")
    with pytest.raises(UnsupportedResultType):
        canonical_row(df)
    assert df.select(canonical_row(df, nested="json").alias("v")).first()["v"] == "JSON:[1]"


def test_signature(spark):
    df = spark.sql("select 1 as id, 'x' as Name, true as ok, current_date() as d")
    assert column_signature(df.schema) == signature_of(df) == "ID:NUMBER|NAME:STRING|OK:BOOLEAN|D:DATE"


def test_hash_invariants(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id bigint, name string")
    first = result_hash(df, max_rows=9).first()
    assert first.rowCount == 3
    assert result_hash(df.orderBy(F.desc("id")).repartition(3), max_rows=9).first().resultHash == first.resultHash
    assert result_hash(df.union(df.limit(1)), max_rows=9).first().resultHash != first.resultHash
    narrow = df.select(F.col("id").cast("int").alias("id"), "name")
    assert result_hash(narrow, max_rows=9).first().resultHash == first.resultHash
    ordered = lambda d: result_hash(d, max_rows=9, as_delivered=True).first().resultHash
    assert ordered(df.orderBy("id")) != ordered(df.orderBy(F.desc("id")))
    empty = result_hash(df.limit(0), max_rows=9).first()
    assert empty.rowCount == 0 and empty.resultHash


def test_doubles_are_kept_whole_unless_rounded(spark):
    df = lambda x: spark.createDataFrame([(x,)], "x double")
    whole = lambda x, **o: summarize_result(df(x), **o).first().resultHash
    assert whole(4e-7) != whole(0.0) and whole(1.0000001) != whole(1.0)
    assert whole(4e-7, scale=6) == whole(0.0, scale=6)
    assert whole(1e-30) != whole(0.0) and whole(1e300) != whole(2e300) and whole(-0.0) == whole(0.0)


def test_delivered_order_of_any_size(spark):
    rows = spark.range(5000).withColumn("v", F.col("id") % 7)
    ordered = lambda *c: summarize_result(rows.orderBy(*c), as_delivered=True).first()
    assert ordered("id").resultHash == ordered("id").resultHash != ordered(F.desc("id")).resultHash
    assert ordered("id").rowCount == 5000 and summarize_result(rows).first().status == "SUCCESS"


def test_null_keys_meet(spark):
    a = summarize_result(spark.createDataFrame([(None, 1), ("k", 2)], "g string, v int"), ["g"])
    assert {r.sampleComparisonStatus for r in cp.compare_sides(a, a, ["g"]).collect()} == {"MATCH"}


def test_a_sample_that_did_not_run_is_no_match(spark):
    from evenledger.plans.capture import overall_by_key

    rows = [("k", "MATCH", (side(),)), ("k", "NOT_EXECUTED", (side(),)), ("m", "MATCH", (side(),))]
    df = spark.createDataFrame([(k, s, a[0]) for k, s, a in rows], f"baselineKey string, sampleComparisonStatus string, a {SIDE}")
    got = {r.baselineKey: r.overallComparisonStatus for r in overall_by_key(df).collect()}
    assert got == {"k": "PARTIAL_EXECUTION_FAILURE", "m": "ALL_SAMPLES_MATCH"}


def test_fingerprint_invariants(spark, tables):
    li = tables("lineitem")
    whole = result_fingerprint(li).first()
    assert result_fingerprint(li.repartition(7, "l_partkey")).first() == whole
    assert result_fingerprint(li.union(li.limit(1))).first().resultPrint != whole.resultPrint
    changed = li.withColumn("l_tax", F.when(F.col("l_orderkey") == li.first().l_orderkey, 9.0).otherwise(F.col("l_tax")))
    assert result_fingerprint(changed).first().resultPrint != whole.resultPrint


def test_too_large_is_never_hashed(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    row = summarize_result(df, max_rows=2).first()
    assert (row.status, row.rowCount, row.resultHash) == ("RESULT_TOO_LARGE", 3, None)
    assert guard_max_rows(df, 1).count() == 2


def test_baseline_key(spark):
    parts = [F.lit(v) for v in (" Service ", "Repository", "findAll", "ENTITY_MANAGER")]
    assert one(spark, baseline_key(*parts, F.lit(""), F.lit(2))) == "service|repository|findall|entity_manager|-|2"
    assert one(spark, baseline_key(F.lit(" \t"), *parts[1:], F.lit("q"), F.lit(1))) is None
    assert one(spark, baseline_key(F.lit("a|b  c"), *parts[1:], F.lit("Q"), F.lit(1))).startswith("a%7cb c|")


def test_ids(spark):
    assert one(spark, numbered_id(F.lit("svc"), F.lit(7))) == "svc-0007"
    assert one(spark, numbered_id(F.lit("svc"), F.lit(12345))) == "svc-12345"
    made = one(spark, case_id(F.lit("a/b" + "x" * 100), F.lit("key")))
    assert made.startswith("a_bxx") and len(made) == 64 + 1 + 8


def test_blank_sees_all_white_space(spark):
    assert one(spark, blank(F.lit(" \n\t"))) and one(spark, blank(F.lit(None).cast("string"))) and not one(spark, blank(F.lit("x")))


def statement(sql_id, cls, line, text="SELECT 1"):
    return (sql_id, "service", "f", cls, "find", "SPRING_DATA_QUERY", line, "q", text, text, False, False, "", "HIGH")


STATEMENT = (
    "sqlId string, serviceName string, filePath string, className string, methodName string, sourceType string, lineNumber int,"
    " sqlVariableName string, sqlText string, normalizedSqlText string, dynamicSql boolean, requiresManualReview boolean,"
    " manualReviewReason string, confidence string"
)


def candidates(spark, statements, **options):
    plans = spark.createDataFrame([("s1", "SELECT * FROM c WHERE id = ?", "READY", 1)], "sqlId string, jdbcSql string, bindingStatus string, bindingCount int")
    runs = spark.createDataFrame([("s1", "PASSED", "SELECT * FROM c WHERE id = ?")], "sqlId string, executionStatus string, jdbcSql string")
    rows = build_candidates(spark.createDataFrame(statements, STATEMENT), plans, runs, **options).collect()
    return {(r.sqlId, r.lineNumber): r for r in rows}


def test_candidate(spark):
    row = candidates(spark, [statement("s1", "CustomerRepository", 10, "SELECT * FROM c WHERE id = :id")])[("s1", 10)]
    assert row.baselineKey == "service|customerrepository|find|spring_data_query|q|1"
    assert row.placeholderCount == row.bindingCount == 1
    assert row.bindingPlanUsable and not row.duplicateBaselineKey and row.postgresValidationStatus == "PASSED"


def test_case_variants_share_a_key(spark):
    found = candidates(spark, [statement("s1", "Repo", 10), statement("s2", "repo", 10), statement("s3", "Other", 10)])
    assert [found[k].duplicateBaselineKey for k in (("s1", 10), ("s2", 10), ("s3", 10))] == [True, True, False]


def test_repeated_ids_share_a_key(spark):
    rows = [statement("s1", "Repo", 10), statement("s1", "Repo", 20)]
    assert all(r.duplicateBaselineKey for r in candidates(spark, rows, unique_ids=False).values())
    assert not any(r.duplicateBaselineKey for r in candidates(spark, rows).values())


def test_statement_without_parameters_counts_no_binding(spark):
    rows = spark.createDataFrame([("s1", "SELECT 1", "READY", "", 0, 0)], "sqlId string, jdbcSql string, bindingStatus string, bindingIndex string, bindingCount int, _pos int")
    assert bd.aggregate_bindings(rows).first().bindingCount == 0


def side(status="SUCCESS", n=1, h="h", s="ID:NUMBER"):
    return {"status": status, "rowCount": n, "resultHash": h, "columnSignature": s, "executionTimeMs": 1, "errorMessage": "e"}


SIDE = "struct<status:string,rowCount:bigint,resultHash:string,columnSignature:string,executionTimeMs:bigint,errorMessage:string>"


@pytest.mark.parametrize(
    "a, b, status, category",
    [
        (side(), side(), "MATCH", "NONE"),
        (side(), side(h="x"), "MISMATCH", "RESULT_HASH_MISMATCH"),
        (side(), side(n=2, h="x"), "MISMATCH", "ROW_COUNT_MISMATCH"),
        (side(), side(s="ID:STRING", n=2), "MISMATCH", "COLUMN_STRUCTURE_MISMATCH"),
        (side("EXECUTION_FAILED"), side(), "H2_EXECUTION_FAILED", "H2_EXECUTION_ERROR"),
        (side(), side("UNSUPPORTED_RESULT_TYPE"), "POSTGRES_EXECUTION_FAILED", "POSTGRES_EXECUTION_ERROR"),
        (side("EXECUTION_FAILED"), side("NOT_EXECUTED"), "BOTH_EXECUTION_FAILED", "UNKNOWN"),
        (side("RESULT_TOO_LARGE"), side("EXECUTION_FAILED"), "RESULT_TOO_LARGE", "RESULT_TOO_LARGE"),
        (side("EXECUTION_FAILED"), side("PENDING_SQL_MIGRATION"), "PENDING_SQL_MIGRATION", "NONE"),
        (side(h=None), side(), "H2_EXECUTION_FAILED", "H2_EXECUTION_ERROR"),
        (side(), side(h=None), "POSTGRES_EXECUTION_FAILED", "POSTGRES_EXECUTION_ERROR"),
        (side(n=None), side(n=None), "BOTH_EXECUTION_FAILED", "UNKNOWN"),
        (side(s=None), side(), "MISMATCH", "COLUMN_STRUCTURE_MISMATCH"),
    ],
)
def test_comparison_verdict(spark, a, b, status, category):
    row = cp.compare_results(spark.createDataFrame([(a, b)], f"a {SIDE}, b {SIDE}")).first()
    assert (row.sampleComparisonStatus, row.differenceCategory) == (status, category)


def test_execution_only_and_drift(spark):
    df = spark.createDataFrame([(side(), side(h="x"))], f"a {SIDE}, b {SIDE}")
    assert cp.compare_results(df, execution_only=F.lit(True)).first().sampleComparisonStatus == "EXECUTION_ONLY"
    assert cp.compare_results(df, drifted=F.lit(True)).first().differenceCategory == "POSSIBLE_DATA_DRIFT"
    assert cp.compare_results(df, labels=("OLD", "NEW")).first().sampleComparisonStatus == "MISMATCH"


RULE_MESSAGES = {
    "PARAMETER_TYPE_MISMATCH": "operator does not exist: integer = character varying",
    "PARAMETER_BINDING_ERROR": "parameter index out of range",
    "SEQUENCE_SYNTAX": 'missing FROM-clause entry for table "my_seq"',
    "DUAL_TABLE": 'relation "dual" does not exist',
    "NVL_FUNCTION": "function nvl(integer) does not exist",
    "SYSDATE_FUNCTION": 'column "sysdate" does not exist',
    "ROWNUM_PSEUDOCOLUMN": 'column "rownum" does not exist',
    "TO_CHAR_FUNCTION": "function to_char(text) does not exist",
    "TO_TIMESTAMP_FUNCTION": "function to_timestamp(text) does not exist",
    "DATEADD_FUNCTION": "function dateadd(text) does not exist",
    "QUOTED_IDENTIFIER_CASE_MISMATCH": 'column "value" does not exist',
    "COLUMN_NOT_FOUND": 'column "a" does not exist',
    "RELATION_NOT_FOUND": 'relation "a" does not exist',
    "IDENTIFIER_CASE_OR_QUOTING": 'missing FROM-clause entry for table "a"',
    "UNSUPPORTED_FUNCTION": "function f(integer) does not exist",
    "GENERIC_SQL_SYNTAX": "SQLState: 42601",
    "UNKNOWN": "connection reset",
}


def test_every_issue_rule(spark):
    schema = (
        "executionStatus string, message string, sqlText string, normalizedSqlText string, jdbcSql string, adaptedJdbcSql string,"
        " stringBound boolean, requiresManualReview boolean, dynamicSql boolean, expected string, source string"
    )
    rows = [("FAILED", m, "", "", "", "", False, False, False, kind, None) for kind, m in RULE_MESSAGES.items()]
    rows += [
        ("passed", RULE_MESSAGES["DUAL_TABLE"], "", "", "", "", False, False, False, "PASSED", "STATUS"),
        ("SKIPPED_SAFETY", RULE_MESSAGES["DUAL_TABLE"], "", "", "", "", False, False, False, "SKIPPED_OR_NOT_EXECUTED", "STATUS"),
        ("FAILED", RULE_MESSAGES["PARAMETER_TYPE_MISMATCH"], "", "", "", "", True, False, False, "PARAMETER_TYPE_MISMATCH", "ERROR_MESSAGE_AND_BINDING_PLAN"),
        ("FAILED", 'column "t" of relation "u" does not exist', "UPDATE u t SET t.a = 1", "", "", "", False, False, False, "UPDATE_TARGET_ALIAS", "ERROR_MESSAGE_AND_SQL_TEXT"),
        ("FAILED", 'column "t" of relation "u" does not exist', "UPDATE u t SET x.a = 1", "", "", "", False, False, False, "COLUMN_NOT_FOUND", "ERROR_MESSAGE"),
        ("FAILED", "", "", "", "select nvl(a, b) from dual", "", False, False, False, "DUAL_TABLE", "ERROR_MESSAGE_AND_SQL_TEXT"),
        ("FAILED", "", "", "", "select current_timestamp()", "", False, False, False, "DATETIME_FUNCTION_SYNTAX", "SQL_TEXT"),
        ("FAILED", "syntax error", "merge into t", "", "", "", False, False, False, "MERGE_SYNTAX", "SQL_TEXT"),
        ("FAILED", None, "x", "", "", "", False, True, False, "UNKNOWN", "SQL_TEXT"),
        (None, None, None, None, None, None, False, None, None, "UNKNOWN", "FALLBACK"),
    ]
    for row in iss.classify_issue(spark.createDataFrame(rows, schema)).collect():
        assert row.issueType == row.expected, row
        assert row.source is None or row.classificationSource == row.source, row
    assert all(kind in iss.TYPES and group in iss.GROUPS for _, group, kind, _, _ in iss.RULES)


def test_sampling(spark):
    rows = [(1, "ACTIVE", 10, "Ann"), (2, "INACTIVE", 20, "Bea"), (3, "ACTIVE", 30, "Cid"), (4, None, 40, "ANN")]
    df = spark.createDataFrame(rows, "id bigint, status string, region bigint, name string")
    pair = [Mapping(1, (1,), "status", "status"), Mapping(2, (2,), "region", "region")]
    assert [(r.p1, r.p2) for r in sample_tuples(df, pair, 3).orderBy("sampleIndex").collect()] == [
        ("ACTIVE", 10), ("ACTIVE", 30), ("INACTIVE", 20)
    ]
    lower = [Mapping(1, (1,), "name", "name", lower=True)]
    assert [r.p1 for r in sample_tuples(df, lower, 5).orderBy("sampleIndex").collect()] == ["ann", "bea", "cid"]


def test_tuple_round_trip(spark):
    df = spark.createDataFrame(
        [("A|B;C% D", Decimal("100.250"), date(2026, 7, 17), 42, b"\x00\xff", datetime(2026, 1, 2, 3, 4, 5, 678901))],
        "s string, d decimal(10,3), t date, n bigint, b binary, ts timestamp_ntz",
    )
    maps = [Mapping(i + 1, (i + 1,), c, c) for i, c in enumerate(df.columns)]
    named = df.select(F.lit(2).alias("sampleIndex"), *[F.col(c).alias(f"p{i + 1}") for i, c in enumerate(df.columns)])
    values = tuple_column(named, maps, "t").first().asDict(recursive=True)["values"]
    assert arguments(values) == list(df.first())
    assert f"array<{SAMPLE_VALUE}>" == tuple_column(named, maps, "t").schema["values"].dataType.simpleString()


def test_case_selection(spark):
    rows = [("key-a", "SQL-A", 1, 10), ("key-a", "SQL-A", 2, 100), ("key-b", "SQL-B", 1, 50), ("key-c", "SQL-C", 1, 20)]
    df = spark.createDataFrame(rows, "baselineKey string, baselineSqlId string, sampleIndex int, h2ObservedTimeMs bigint").selectExpr(
        "*", "baselineSqlId as currentSqlId", "'SELECT' as statementType", "'' as parameterValues", "'SELECT 1' as h2JdbcSql",
        "'SELECT 1' as postgresJdbcSql", "'SUCCESS' as h2ExecutionStatus", "'SUCCESS' as postgresExecutionStatus",
        "'MATCH' as sampleComparisonStatus", "cast(null as bigint) as postgresObservedTimeMs", "1 as _pos",
    )
    found = cs.select_cases(df, top=1, include=["sql-c"]).orderBy("sqlGroupKey").collect()
    assert [(r.baselineSqlId, r.sampleIndex, r.selectionReason) for r in found] == [
        ("SQL-B", 1, "TOP_SLOWEST"), ("SQL-C", 1, "MANUAL_INCLUDE")
    ]


@pytest.mark.parametrize("path, ok", [("index.html", True), ("a/b.html", True), ("../x", False), ("/etc/x", False), ("a/../x", False), ("C:\\x", False), ("", False)])
def test_safe_link(spark, path, ok):
    assert one(spark, cs.safe_link(F.lit(path))) is ok


JSON_CASES = {
    '{"user":{"name":"a","emails":["x"]},"items":[{"id":1,"price":2},{"id":2}]}': {"user.name", "user.emails[]", "items[].id", "items[].price"},
    '{"a":null,"b":{}}': {"a"},
    '{"items":[{"a":1},{"b":2}]}': {"items[].a", "items[].b"},
    '{"name":': set(),
    '{"owners": []}': {"owners[]"},
    '[{"id":1},{"name":2}]': {"[].id", "[].name"},
    '{"a":"{[{[", "b":"\\"}"}': {"a", "b"},
}


def test_json_leaf_paths(spark):
    docs = list(JSON_CASES)
    found = json_leaf_paths(spark.createDataFrame(list(enumerate(docs)), "id int, c string"), "id", "c").collect()
    for i, doc in enumerate(docs):
        paths = [r.path for r in found if r.id == i]
        assert set(paths) == JSON_CASES[doc] and len(paths) == len(set(paths)), doc


def test_deeper_than_stated_fails(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":{"c":1}}}')], "id int, c string")
    assert json_leaf_paths(df, "id", "c", max_depth=3).count() == 1
    with pytest.raises(Exception, match="nested deeper"):
        json_leaf_paths(df, "id", "c", max_depth=2).collect()
    assert one(spark, nesting_depth(F.lit('{"a":[{"b":"]]]"}]}'))) == 3


def test_xml_leaf_paths(spark):
    docs = [
        "<staff><person><id>1</id></person><person><id>2</id></person></staff>", "<a><b/><c></c></a>", '<a id="1"><id>x</id></a>',
        "<a><b></a>", "<!DOCTYPE a [<!ENTITY x SYSTEM 'file:///etc/hosts'>]><a>&x;</a>",
    ]
    found = xml_leaf_paths(spark.createDataFrame(list(enumerate(docs)), "id int, c string"), "id", "c").collect()
    paths = lambda i: {r.path for r in found if r.id == i}
    assert [paths(i) for i in range(5)] == [{"staff.person[].id"}, {"a.b", "a.c"}, {"a.@id", "a.id"}, set(), set()]


def test_default_values(spark):
    now = F.to_timestamp_ntz(F.lit("2026-01-02 03:04:05"))
    value = lambda t, n: one(spark, default_value(F.lit(t), F.lit(n), now))
    assert value("String", "rowUuid") == "00000000-0000-0000-0000-000000000001"
    assert (value("LocalDate", "x"), value("LocalDateTime", "x"), value("Long", "x")) == ("2026-01-02", "2026-01-02T03:04:05", "1")


def test_contract_sizes():
    assert (len(BASELINE), len(COMPARISON), len(CROSSDB_LONG), len(CROSSDB_SHORT), len(DETAIL_REPORT)) == (43, 41, 27, 11, 19)


def test_numbers_and_moments_by_the_short_way(spark):
    numbers = [0.0, -0.0, 1.0, 100.0, -2.50, 0.001, 0.0001, 1e7, 12345678.125, 1e20, 1.5e-9, 1e300, float("inf"), float("-inf"), float("nan"), 0.1 + 0.2, 9999999.0, None]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    got = [r.v for r in df.select(canonical_value(F.col("x"), df.schema["x"].dataType).alias("v")).collect()]
    assert got == [
        "NUM:0", "NUM:0", "NUM:1", "NUM:100", "NUM:-2.5", "NUM:0.001", "NUM:0.0001", "NUM:10000000", "NUM:12345678.125", "NUM:1.0E20",
        "NUM:0.0000000015", "NUM:1.0E300", "NUM:Infinity", "NUM:-Infinity", "NUM:NaN", "NUM:0.30000000000000004", "NUM:9999999", "NULL",
    ]
    texts = ["2026-01-02 03:04:05", "2026-01-02 03:04:05.1", "1999-12-31 23:59:59.123987", "0001-01-01 00:00:00.010"]
    times = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp_ntz").alias("n"), F.col("t").cast("timestamp").alias("z"))
    rows = times.select(canonical_value(F.col("n"), times.schema["n"].dataType).alias("n"), canonical_value(F.col("z"), times.schema["z"].dataType).alias("z")).collect()
    want = ["2026-01-02T03:04:05.000", "2026-01-02T03:04:05.100", "1999-12-31T23:59:59.123", "0001-01-01T00:00:00.010"]
    assert [(r.n, r.z) for r in rows] == [(f"TIMESTAMP:{w}", f"INSTANT:{w}Z") for w in want]


def test_json_that_goes_on_is_rejected(spark):
    from evenledger.sources.scan import scan_json_docs

    valid = ["1", " -1.5e+3 ", '"a\\""', "true", "{}\n", '[1, "]"]', "[" * 1000 + "]" * 1000, "null"]
    invalid = ["12 months", "12 3", '"a" b', '"a" "b"', "true false", "{} {}", "{} x", "[1] ]", "{}}", "{}\x0c", "null,"]
    df = spark.createDataFrame([(t,) for t in [*valid, *invalid]], "c string")
    got = {r.c: r for r in scan_json_docs(df, "c").select("c", "docStatus", F.col("json").isNull().alias("none")).collect()}
    assert [t for t in valid if got[t].docStatus != "VALID" or got[t].none] == []
    assert [t for t in invalid if got[t].docStatus != "INVALID" or not got[t].none] == []


def test_wide_rows_stay_out_of_the_case_shuffles(spark):
    """Selected cases are few: rows and their texts meet them by broadcast, ties and null places included."""
    rows = [(f"key-{i % 7}", f"B{i % 7}", f"C{i % 7}", "SELECT", i % 3 or None, f"v{i}", "SELECT 1", "SELECT 1", "SUCCESS", "SUCCESS", "MATCH", i, i, i // 2) for i in range(60)]
    names = "baselineKey baselineSqlId currentSqlId statementType sampleIndex parameterValues h2JdbcSql postgresJdbcSql h2ExecutionStatus postgresExecutionStatus sampleComparisonStatus h2ObservedTimeMs postgresObservedTimeMs _pos"
    df = spark.createDataFrame(rows, names.split())
    selected = cs.select_cases(df, 2, 2, include=["c1"])
    got = {r.sqlGroupKey: (r.sampleIndex, r.selectionReason) for r in selected.collect()}
    assert selected.count() == len(got) == 3 and got["key-1"] == (2, "MANUAL_INCLUDE") and all(i == 2 for i, _ in got.values())
    shown = cs.attach_selected(cs.case_columns(df), selected)
    plan = shown._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and shown.count() == 60
