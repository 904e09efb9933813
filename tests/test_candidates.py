"""Candidates: keys and binding plans."""

from evenledger.operators import bindings as bd
from evenledger.operators.candidates import build_candidates


def test_candidates_flag_shared_keys_like_a_count(spark):
    """Methods whose names differ but make one key share its first positions; blank parts never do."""
    from evenledger.operators.candidates import flag_duplicate_keys

    names = ["svc", "Svc", "svc ", "", "a|b", "a%7cb"]
    rows = [(f"S{i}", names[i % 6], "f", "Repo" if i % 5 else "repo", f"m{i % 2}", "JPA", None if i % 3 else "-", i % 9, "select 1", "select 1", False, False, "", "HIGH") for i in range(90)]
    columns = "sqlId serviceName filePath className methodName sourceType sqlVariableName lineNumber sqlText normalizedSqlText dynamicSql requiresManualReview manualReviewReason confidence"
    kinds = " ".join(columns.split())
    statements = spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c == 'lineNumber' else 'boolean' if c in ('dynamicSql', 'requiresManualReview') else 'string'}" for c in kinds.split()))
    plans = spark.createDataFrame([("S1", "select 1", "READY", 0)], "sqlId string, jdbcSql string, bindingStatus string, bindingCount int")
    runs = spark.createDataFrame([("S1", "select 1", "PASSED")], "sqlId string, jdbcSql string, executionStatus string")
    made = build_candidates(statements, plans, runs)
    expected = {r.sqlId: r.duplicateBaselineKey for r in flag_duplicate_keys(made.drop("duplicateBaselineKey")).collect()}
    assert {r.sqlId: r.duplicateBaselineKey for r in made.collect()} == expected and len(set(expected.values())) == 2
    assert made._jdf.queryExecution().analyzed().toString().count("row_number") == 1


def test_aggregate_bindings_in_one_shuffle(spark):
    rows = [("S1", " b ", "READY", 1, 0, 5), ("S1", "a", None, 2, 0, 2), ("S1", " ", "X", 2, 0, 1), ("S2", None, "", None, 0, 1), (" ", "z", "z", 1, 9, 1), ("S3", "t", "ok", 1, 4, None)]
    df = spark.createDataFrame(rows, "sqlId string, jdbcSql string, bindingStatus string, bindingIndex int, bindingCount int, _pos int")
    made = bd.aggregate_bindings(df)
    got = {r.sqlId: (r.jdbcSql, r.bindingStatus, r.bindingCount) for r in made.collect()}
    assert got == {"S1": ("a", "X", 2), "S2": ("", "", 0), "S3": ("", "", 4)}
    made.collect()
    assert made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange ") == 1
