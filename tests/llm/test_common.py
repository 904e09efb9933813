"""Helpers that the operators share."""

from pyspark.sql import functions as F

from evenledger.llm.common import likely_in


def test_likely_in_loses_nothing(spark):
    rows = spark.range(20_000).select((F.col("id") * 7 - 5000).alias("k"), F.lit("x").alias("_other"))
    ids = rows.where("k % 11 = 0").select("k")
    got = likely_in(rows, "k", ids)
    assert got.columns == rows.columns and ids.exceptAll(got.select("k")).isEmpty()
    assert got.count() < ids.count() * 1.1 + 600
    assert likely_in(rows, "k", ids.limit(0)).count() == 0
    assert likely_in(rows.limit(0), "k", ids).count() == 0
    assert likely_in(spark.range(1).select(F.lit(None).cast("long").alias("k")), "k", ids).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
