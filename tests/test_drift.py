"""Prints of source tables: what counts as another table, and which tables a later comparison reads."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from evenledger.catalog.source_queries import corpus_candidates, replay_cases, sides
from evenledger.plans import drift
from evenledger.plans.capture import capture_baseline, compare_with_baseline
from evenledger.sources import sink

SF_DIR = "/root/testdata/sf0.001"


def printed(df):
    return drift.table_print(df).first().tablePrint


def test_equal_numbers_print_alike_whatever_their_width(spark):
    whole = spark.range(5).select((F.col("id") * 1000).alias("n"))
    prints = {printed(whole.select(F.col("n").cast(t))) for t in ("short", "int", "long", "float", "double", "decimal(9,2)", "decimal(38,18)")}
    assert len(prints) == 1
    tenths = spark.range(5).select((F.col("id") / 10).alias("n"))
    assert len({printed(tenths.select(F.col("n").cast(t))) for t in ("double", "float", "decimal(5,1)", "decimal(38,18)")}) == 1
    assert printed(spark.sql("SELECT 0.0D AS n")) == printed(spark.sql("SELECT -0.0D AS n"))


@pytest.mark.parametrize(
    "one, other",
    [
        ("9007199254740992L", "9007199254740993L"),
        ("9223372036854775806L", "9223372036854775807L"),
        (f"CAST('{Decimal(10) ** 18 + 1}' AS decimal(38,18))", f"CAST('{Decimal(10) ** 18 + 1}.000000000000000001' AS decimal(38,18))"),
        ("CAST('1' AS string)", "1"),
        ("'a' COLLATE UTF8_LCASE", "'A' COLLATE UTF8_LCASE"),
        ("TIMESTAMP '2020-01-01 00:00:00.000001'", "TIMESTAMP '2020-01-01 00:00:00.000002'"),
        ("NULL", "0"),
        ("array(1, 2)", "array(2, 1)"),
        ("INTERVAL 1 DAY", "INTERVAL 2 DAY"),
    ],
)
def test_other_values_print_otherwise(spark, one, other):
    assert printed(spark.sql(f"SELECT {one} AS v")) != printed(spark.sql(f"SELECT {other} AS v"))


def test_rows_count_with_nulls_in_their_places_and_in_any_order(spark):
    rows = [(1, None), (None, 1), (2, 2)]
    frame = lambda some: spark.createDataFrame(some, "a int, b int")
    assert printed(frame(rows)) == printed(frame(rows[::-1]))
    assert printed(frame([(1, None)])) != printed(frame([(None, 1)]))
    assert printed(frame(rows)) != printed(frame(rows + rows))
    wide = [[None if i == at else 1 for i in range(130)] for at in (3, 70)]
    one, other = (printed(spark.createDataFrame([row], ", ".join(f"c{i} int" for i in range(130)))) for row in wide)
    assert one != other
    assert printed(frame([])) == printed(frame([]))


def test_prints_of_another_version_do_not_tell_of_drift(spark):
    path = sink.scratch_path(spark, "old-sources")
    spark.range(1).createOrReplaceTempView("drift_test_table")
    spark.createDataFrame([("q", "drift_test_table=1-AB-CD")], "sqlId string, sourcePrint string").write.parquet(path)
    cases = spark.sql("SELECT 'q' AS sqlId, 1 AS sampleIndex, 'SELECT id FROM drift_test_table' AS jdbcSql, cast(null AS array<struct<kind: string>>) AS values")
    assert drift.drifted(spark, spark, cases, path).where("dataDrifted").isEmpty()


def test_only_tables_behind_another_hash_are_printed_later(spark, monkeypatch):
    asked = []
    prints = drift.table_prints
    monkeypatch.setattr(drift, "table_prints", lambda s, side, names: asked.append(names) or prints(s, side, names))
    a, b = sides(spark, SF_DIR)
    samples = replay_cases(spark, SF_DIR).drop("jdbcSql", "status")
    path, kept = sink.scratch_path(spark, "captured"), sink.scratch_path(spark, "sources")
    baseline = capture_baseline(spark, corpus_candidates(spark), samples, a, b, path, run_id="run-1", requested=2, sources=kept)
    assert asked.pop() == ["lineitem", "orders"]
    compare_with_baseline(spark, baseline, corpus_candidates(spark), lambda: b, sources=kept)
    assert asked.pop() == ["lineitem"]
    compare_with_baseline(spark, baseline, corpus_candidates(spark), lambda: a, sources=kept)
    assert asked.pop() == []
