"""CSV records over files and blocks of any size."""

import csv
import io
import random

import pytest

from evenledger.sources.csv import csv_records, scan_csv
from evenledger.sources.scan import scan_executions, scan_optional, scan_statements
from evenledger.sources.contracts import EXECUTIONS


def text_of(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


def made(seed, n):
    rng = random.Random(seed)
    values = ["plain", "", "a,b", 'say "hi"', "two\nlines", 'open "\n\n" end', "é\n", '"', "\n", "long " * 40]
    return [[f"{seed}-{k}", rng.choice(values), rng.choice(values)] for k in range(n)]


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_over_blocks(spark, tmp_path, small_blocks, end):
    files = {f"f{seed}.csv": made(seed, n) for seed, n in ((1, 700), (2, 3), (3, 0), (4, 150))}
    for name, rows in files.items():
        (tmp_path / name).write_text(text_of([["id", "x", "y"], *rows], end), newline="")
    df = scan_csv(spark, str(tmp_path))
    assert csv_records(spark, str(tmp_path)).rdd.getNumPartitions() > 0 and spark.read.text(str(tmp_path)).rdd.getNumPartitions() > len(files)
    got = [(r.id, r.x or "", r.y or "") for r in df.orderBy("_pos").collect()]
    want = [tuple(r) for name in sorted(files) for r in csv.reader(io.StringIO(text_of(files[name])))]
    assert got == want


def test_calm_files_need_no_shuffle(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text("﻿" * 0 + "id,x\n" + "".join(f'{k},"v ""{k}"""\n' for k in range(900)) + "\n\n900,last")
    df = scan_csv(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan.split("BroadcastExchange")[0]
    rows = df.orderBy("_pos").collect()
    assert [r.id for r in rows] == [str(k) for k in range(901)] and rows[5].x == 'v "5"' and rows[-1].x == "last"


def test_quote_left_open(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,x\n1,"open\n2,b\n')
    (tmp_path / "b.csv").write_text("id,x\n3,c\n")
    assert [r.id for r in scan_csv(spark, str(tmp_path)).orderBy("_pos").collect()] == ["1", "3"]


def test_first_wins_by_file_and_place(spark, tmp_path, small_blocks):
    head = "sqlId, Status ,Message"
    (tmp_path / "a.csv").write_text(head + "\n" + "".join(f's{k % 50},PASSED,"first\n{k}"\n' for k in range(400)))
    (tmp_path / "b.csv").write_text(head + "\n" + "".join(f"s{k % 60},FAILED,later {k}\n" for k in range(4000)))
    got = {r.sqlId: r for r in scan_executions(spark, str(tmp_path)).collect()}
    assert len(got) == 60 and all((r.executionStatus == "PASSED") == (int(k[1:]) < 50) for k, r in got.items())
    assert got["s7"].message == "first\n7"
    last = {r.sqlId: r.message for r in scan_executions(spark, str(tmp_path), keep="last").collect()}
    assert last["s7"] == "later 3967"


def test_empty_and_missing(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    assert scan_statements(spark, f"{tmp_path}/none.csv").collect() == []
    (tmp_path / "head.csv").write_text("sqlId,sqlText\n")
    assert scan_statements(spark, f"{tmp_path}/head.csv").collect() == []
    assert scan_optional(spark, f"{tmp_path}/gone.csv", EXECUTIONS).collect() == []
