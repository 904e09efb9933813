"""Plan shape: what reaches the scan, what shuffles, and that no Python runs in the tasks."""

import ast
from pathlib import Path

import pytest

from evenledger.catalog import QUERIES, load_all

load_all()
SF_DIR = "/root/testdata/sf0.001"
PACKAGE = Path(__file__).resolve().parents[1] / "evenledger"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["compare_lineitem_by_year", "classify_issue", "text_issues", "json_leaf_paths", "select_cases", "build_candidates"])
def test_no_python_in_tasks(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_flagship_prunes_and_aggregates_first(spark):
    plan = plan_of(QUERIES["result_fingerprint"](spark, SF_DIR))
    assert "partial_sum" in plan and "partial_bit_xor" in plan
    narrow = plan_of(QUERIES["scan_summary"](spark, SF_DIR))
    assert "o_totalprice" not in narrow.split("ReadSchema:")[1]


def test_dedupe_limits_on_the_map_side(spark):
    plan = plan_of(QUERIES["dedupe_first"](spark, SF_DIR))
    assert plan.count("WindowGroupLimit") == 2


def test_top_slowest_takes_ordered(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_slowest"](spark, SF_DIR))


def test_candidates_read_their_tables_few_times(spark):
    assert plan_of(QUERIES["build_candidates"](spark, SF_DIR)).count("FileScan") <= 10
    assert plan_of(QUERIES["match_baseline"](spark, SF_DIR)).count("FileScan") <= 12


def test_library_never_collects_tables():
    """Only the two places that plan each statement, and so need a row of each, talk to the driver."""
    allowed = {"drift.py": {"toLocalIterator"}, "replay.py": {"first", "toLocalIterator"}}
    for path in PACKAGE.rglob("*.py"):
        if path.parent.name in ("catalog", "llm"):
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Attribute) and node.attr in ("collect", "toPandas", "toLocalIterator", "localCheckpoint", "rdd", "crossJoin"):
                assert node.attr in allowed.get(path.name, set()), (path, node.attr)
