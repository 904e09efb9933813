"""Operators that split hot keys give the same rows as the plain ones, with the split forced by tiny limits."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from evenledger.operators.ranking import number_rows, rank_rows
from evenledger.operators.results import result_hash
from evenledger.operators.skew import heavy_keys, salted_join, spread_join, within_cap

ORDER = ["l_shipdate", "l_orderkey", "l_partkey", "l_extendedprice"]


def same(a, b):
    columns = sorted(a.columns)
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def skewed(tables):
    """A third of the rows under one key, some without a key."""
    li = tables("lineitem")
    key = F.when(F.col("l_partkey") % 3 == 0, 7).when(F.col("l_partkey") % 11 == 0, F.lit(None)).otherwise(F.col("l_suppkey"))
    return li.withColumn("k", key.cast("long"))


@pytest.mark.parametrize("keys", [[], ["k"], ["l_returnflag", "k"]])
@pytest.mark.parametrize("split_rows", [5, 40, 10**6])
def test_number_rows(skewed, keys, split_rows):
    plain = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in ORDER])).cast("long")
    assert same(number_rows(skewed, keys, ORDER, "n", split_rows=split_rows), skewed.withColumn("n", plain))


def test_number_rows_of_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (1, 2), (2, None), (None, 3)], "k int, v int")
    rows = number_rows(df, ["k"], ["v"], "n", split_rows=1).orderBy("k", "n").collect()
    assert [(r.k, r.v, r.n) for r in rows] == [(None, 3, 1), (1, 2, 1), (1, 2, 2), (1, None, 3), (2, None, 1)]


def test_rank_rows_is_dense(skewed):
    top = rank_rows(skewed, ORDER, "r", split_rows=50).agg(F.min("r"), F.max("r"), F.count_distinct("r"), F.count("*")).first()
    assert top[0] == 1 and top[1] == top[2] == top[3]


def test_heavy_keys_are_few(skewed):
    hot = [r.k for r in heavy_keys(skewed, ["k"], share=5, min_rows=10).collect()]
    assert hot == [7]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join(skewed, how):
    right = skewed.where("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    plain = skewed.join(right, ["k"], how)
    assert same(salted_join(skewed, right, ["k"], how, share=50, min_rows=5), plain)
    assert same(salted_join(skewed, right, ["k"], how, sized_by=skewed.select("k"), share=2, min_rows=1), plain)
    assert same(spread_join(skewed, right, ["k"], how), plain)


def test_hash_of_capped_groups(skewed):
    named = skewed.withColumn("k", F.coalesce("k", F.lit(-1))).drop("l_shipdate")
    plain = result_hash(named, ["k"], max_rows=370)
    forced = result_hash(named, ["k"], max_rows=370, min_rows=1)
    assert same(plain, forced)
    over = plain.where("rowCount > 370")
    assert 0 < over.count() < plain.count() and over.where("resultHash is not null").isEmpty()


def test_within_cap_keeps_whole_groups(skewed):
    kept, sizes = within_cap(skewed.where("k is not null"), ["k"], 370, min_rows=1)
    expected = sizes.where("_n <= 370").agg(F.sum("_n")).first()[0]
    assert 0 < kept.count() == expected


def test_rank_rows_reads_its_input_once(spark):
    """Counting and dealing out do not work out the input again."""
    from evenledger.operators.ranking import rank_rows

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(5000).selectExpr("id", "pmod(id * 7919, 5000) as v").mapInArrow(counted, "id long, v long")
    ranked = rank_rows(df, ["v"], split_rows=100)
    assert [r["rank"] for r in ranked.orderBy("v").collect()] == list(range(1, 5001)) and seen.value == 5000
