"""Replaying statements: isolation, limits, saved arguments; and the driver entry."""

import time

import pytest
from pyspark.sql import functions as F

from evenledger.functions.parameters import SAMPLE_VALUE

from evenledger.plans.replay import arguments, replay_rows, run_one


def case(text, values=None, ordered=False):
    return {"sqlId": "q", "sampleIndex": 1, "jdbcSql": text, "values": values, "ordered": ordered}


def value(kind, text, *indexes):
    return {"kind": kind, "value": text, "jdbcIndexes": list(indexes)}


def test_one_bad_statement_does_not_stop_the_rest(spark):
    cases = [
        case("SELECT nothing FROM nowhere"),
        case("SELECT 1 / 0 AS a"),
        case("SELECT array(1) AS a"),
        case("SELECT ? AS a", [value("INTEGER", "x", 1)]),
        case("SELECT ? + ? AS a", [value("INTEGER", "2", 1), value("LONG", "3", 3)]),
        case("SELECT ? + ? AS a", [value("INTEGER", "2", 1, 2)]),
    ]
    found = list(replay_rows(spark, cases))
    assert [r["status"] for r in found] == [
        "EXECUTION_FAILED", "EXECUTION_FAILED", "UNSUPPORTED_RESULT_TYPE", "NOT_EXECUTED", "NOT_EXECUTED", "SUCCESS",
    ]
    assert found[0]["sqlState"] == "42P01"


def test_order_counts_under_a_cap_too(spark):
    run = lambda order, ordered: run_one(spark, f"SELECT id FROM range(5) ORDER BY id {order}", [], 10, None, ordered)["resultHash"]
    assert run("asc", False) != run("desc", False)
    assert run("asc", True) != run("desc", True)


def test_timeout_stops_a_statement(spark):
    started = time.monotonic()
    slow = "SELECT count(*) AS n FROM range(1000000000000) a WHERE hash(a.id) = 1"
    assert run_one(spark, slow, [], 10, 2.0, False)["status"] == "EXECUTION_FAILED"
    assert time.monotonic() - started < 60
    assert run_one(spark, "SELECT 1 AS a", [], 10, 30.0, False)["status"] == "SUCCESS"


def test_arguments_keep_their_places():
    assert arguments([value("STRING", "b", 2), value("INTEGER", "1", 1, 3)]) == [1, "b", 1]
    assert arguments(None) == []


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() == 7
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_order_counts_where_the_statement_sorts(spark):
    from evenledger.plans.replay import replay_rows

    spark.range(300).createOrReplaceTempView("numbered")
    texts = ["SELECT id FROM numbered ORDER BY id", "SELECT id FROM numbered ORDER BY id DESC", "SELECT id FROM numbered", "SELECT -id * -1 AS id FROM numbered DISTRIBUTE BY id"]
    up, down, plain, moved = (next(iter(replay_rows(spark, [case(t)])))["resultHash"] for t in texts)
    assert up != down and plain not in (up, down) and plain == moved


def test_commands_are_refused(spark, tmp_path):
    from evenledger.plans.replay import replay_rows

    spark.range(3).write.parquet(f"{tmp_path}/t")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW target USING parquet OPTIONS (path '{tmp_path}/t')")
    writes = ["WITH x AS (SELECT 9L AS id) INSERT INTO target SELECT id FROM x", "INSERT INTO target VALUES (9L)", "DROP VIEW target", "SET spark.sql.ansi.enabled = false"]
    for text in writes:
        assert next(iter(replay_rows(spark, [case(text)])))["status"] == "NOT_EXECUTED"
    assert spark.table("target").count() == 3
    assert next(iter(replay_rows(spark, [case("WITH x AS (SELECT 1 AS a) SELECT a FROM x")])))["status"] == "SUCCESS"


def numbered(spark, n):
    rows = spark.range(n).selectExpr("concat('q', id) as sqlId", "1 as sampleIndex", "concat('SELECT ', id, ' AS a') as jdbcSql")
    return rows.withColumn("values", F.array().cast(f"array<{SAMPLE_VALUE}>"))


def test_stopped_run_goes_on_from_its_journal(spark, tmp_path, monkeypatch):
    from evenledger.plans import replay as rp

    ran, real = [], rp.run_one

    def counted(session, text, *rest):
        ran.append(text)
        if len(ran) == 30 and not (tmp_path / "stopped").exists():
            (tmp_path / "stopped").touch()
            raise KeyboardInterrupt
        return real(session, text, *rest)

    monkeypatch.setattr(rp, "run_one", counted)
    journal = f"{tmp_path}/journal"
    cases = numbered(spark, 60)
    with pytest.raises(KeyboardInterrupt):
        rp.replay(spark, spark, cases, batch=7, workers=3, journal=journal)
    kept = {r.sqlId for r in spark.read.parquet(journal).collect()}
    assert 20 <= len(kept) < 60
    ran.clear()
    found = rp.replay(spark, spark, cases, batch=7, workers=3, journal=journal)
    assert len(ran) == 60 - len(kept) and found.count() == 60
    assert {r.status for r in found.collect()} == {"SUCCESS"} and found.columns == [c.split()[0] for c in rp.SUMMARY_SCHEMA.split(", ")]
    ran.clear()
    changed = cases.withColumn("jdbcSql", F.when(F.col("sqlId") == "q3", "SELECT 'x' AS a").otherwise(F.col("jdbcSql")))
    again = rp.replay(spark, spark, changed.where("sqlId <> 'q4'"), journal=journal)
    assert ran == ["SELECT 'x' AS a"] and again.count() == 59


def test_pool_is_bounded_and_really_parallel(spark, monkeypatch):
    from evenledger.plans import replay as rp

    taken, running, most = [0], [0], [0]

    def slow(session, text, *rest):
        running[0] += 1
        most[0] = max(most[0], running[0])
        time.sleep(0.02)
        running[0] -= 1
        return {}

    monkeypatch.setattr(rp, "run_one", slow)

    def cases():
        for k in range(200):
            taken[0] += 1
            yield {"sqlId": str(k), "sampleIndex": 1, "jdbcSql": ""}

    ahead = 0
    for done, _ in enumerate(rp.replay_rows(spark, cases(), workers=4), 1):
        ahead = max(ahead, taken[0] - done)
    assert done == 200 and most[0] == 4 and ahead <= 8


def test_of_two_writers_one_fails(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from evenledger.sources.contracts import BASELINE
    from evenledger.sources.sink import BaselineExists, write_baseline

    rows = spark.range(2000).repartition(4).select(*[F.col("id").cast("string").alias(c) for c in BASELINE])

    def write(_):
        try:
            write_baseline(rows, f"{tmp_path}/baseline")
            return "written"
        except BaselineExists:
            return "refused"

    with ThreadPoolExecutor(4) as pool:
        assert sorted(pool.map(write, range(4))) == ["refused"] * 3 + ["written"]
    assert spark.read.parquet(f"{tmp_path}/baseline").count() == 2000
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["baseline"]
    write_baseline(rows.limit(0), f"{tmp_path}/empty")
    write_baseline(rows, f"{tmp_path}/empty")
    assert spark.read.parquet(f"{tmp_path}/empty").count() == 2000


def test_sources_of_a_statement(spark):
    from evenledger.plans.drift import source_tables

    side = spark.newSession()
    for name in ("t1", "t2", "t3"):
        side.range(3).createOrReplaceTempView(name)
    text = "WITH x AS (SELECT id FROM t1) SELECT * FROM x JOIN t2 USING (id) WHERE id > (SELECT min(id) FROM t3) AND id < ?"
    assert source_tables(side, text, [5]) == ["t1", "t2", "t3"]
    assert source_tables(side, "SELECT 1 AS a") == []
