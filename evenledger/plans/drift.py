"""Prints of the tables that statements read, kept with a baseline, to tell changed data from a changed answer."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenledger.functions.canonical import plain_decimal
from evenledger.operators.results import fingerprint_columns
from evenledger.plans.replay import arguments, nodes_of

SOURCES = "sqlId string, sourceTable string"
#: How tables are printed; prints made in another way are never compared.
PRINT_VERSION = "values-1:"


def source_tables(session: SparkSession, text: str, args: list | None = None) -> list[str]:
    """Names of the views and tables in the analysed plan of a statement, its subqueries included."""
    plan = (session.sql(text, args=args) if args else session.sql(text))._jdf.queryExecution().analyzed()
    below = plan.subqueriesAll()
    found = set()
    for root in [plan, *[below.apply(i) for i in range(below.size())]]:
        for node in nodes_of(root):
            kind = node.getClass().getSimpleName()
            if kind == "View":
                found.add(node.desc().identifier().unquotedString())
            elif kind == "LogicalRelation" and node.catalogTable().isDefined():
                found.add(node.catalogTable().get().identifier().unquotedString())
    return sorted(found)


def statement_sources(spark: SparkSession, side: SparkSession, cases: DataFrame) -> DataFrame:
    """(sqlId, sourceTable) of every statement that can be analysed, from its first sample; nothing is run."""
    first = cases.groupBy("sqlId").agg(F.min_by(F.struct("jdbcSql", "values"), "sampleIndex").alias("one")).select("sqlId", "one.*")
    rows = []
    for case in first.toLocalIterator():
        try:
            names = source_tables(side, case["jdbcSql"], arguments(case["values"]))
        except (PySparkException, ValueError, KeyError, ArithmeticError):
            continue
        rows += [(case["sqlId"], name) for name in names]
    return spark.createDataFrame(rows, SOURCES)


def table_prints(spark: SparkSession, side: SparkSession, names: list[str]) -> DataFrame:
    """(sourceTable, tablePrint): an order-free print of every row of each table, one pass a table."""
    empty = spark.createDataFrame([], "sourceTable string, tablePrint string")
    parts = [table_print(side.table(name)).select(F.lit(name).alias("sourceTable"), "tablePrint") for name in names]
    return reduce(DataFrame.unionByName, parts, empty)


def table_print(df: DataFrame) -> DataFrame:
    """(tablePrint) from the values of all cells, without making their canonical text, which costs most of a print.

    Equal numbers print alike whatever their declared width; time stamps count to the microsecond.
    """
    df = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    fields = [(F.col(f.name), f.dataType) for f in df.schema.fields]
    kinds = F.lit("|".join("STRING" if _nested(t) else "NUMBER" if isinstance(t, T.NumericType) else t.typeName().upper() for _, t in fields))
    values = [v for c, t in fields for v in _values(c, t)]
    count, rows = fingerprint_columns(*_nulls([c for c, _ in fields]), *values)
    return df.agg(F.concat_ws("-", F.lit(PRINT_VERSION), F.hex(F.xxhash64(kinds)), count, rows).alias("tablePrint"))


def _nested(dtype: T.DataType) -> bool:
    return dtype.typeName() in ("array", "map", "struct", "variant")


def _nulls(cells: list[Column], width: int = 60) -> list[Column]:
    """Which cells are null, as bits: a hash alone passes over nulls."""
    bits = [F.when(c.isNull(), F.lit(1 << i % width).cast("long")).otherwise(F.lit(0).cast("long")) for i, c in enumerate(cells)]
    return [reduce(Column.bitwiseOR, bits[at : at + width]) for at in range(0, len(bits), width)]


def _values(c: Column, dtype: T.DataType) -> list[Column]:
    """What is hashed of a cell. Of a number: the nearest double and, where that does not give the number back, its text."""
    if isinstance(dtype, T.FloatType):
        return [c.cast("string").cast("double") + F.lit(0.0)]
    if isinstance(dtype, T.NumericType):
        near = c.cast("double") + F.lit(0.0)
        if not isinstance(dtype, (T.DecimalType, T.LongType)):
            return [near]
        text = plain_decimal(c) if isinstance(dtype, T.DecimalType) and dtype.scale > 0 else c.cast("string")
        return [near, F.when(~near.try_cast(dtype).eqNullSafe(c), text)]
    if _nested(dtype):
        return [F.to_json(c)]
    if isinstance(dtype, T.StringType):
        return [c.cast("binary")]  # a collation would hide differences
    if isinstance(dtype, (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)):
        return [c]
    return [c.cast("string")]


def source_prints(spark: SparkSession, side: SparkSession, cases: DataFrame) -> DataFrame:
    """(sqlId, sourcePrint): one print over all tables that a statement reads on this side."""
    read = statement_sources(spark, side, cases)
    names = [row["sourceTable"] for row in read.select("sourceTable").distinct().toLocalIterator()]
    prints = table_prints(spark, side, sorted(names))
    lines = F.array_sort(F.collect_list(F.concat_ws("=", "sourceTable", "tablePrint")))
    return read.join(F.broadcast(prints), "sourceTable").groupBy("sqlId").agg(F.array_join(lines, "\n").alias("sourcePrint"))


def save_sources(spark: SparkSession, side: SparkSession, cases: DataFrame, path: str, key: str = "sqlId") -> None:
    """The prints of what the cases read on one side now, for a later comparison; ``key`` names the saved statements."""
    prints = source_prints(spark, side, cases)
    named = prints if key == "sqlId" else prints.join(cases.select("sqlId", F.col(key).alias("_key")).distinct(), "sqlId").select(F.col("_key").alias("sqlId"), "sourcePrint")
    named.write.mode("errorifexists").parquet(path)


def drifted(spark: SparkSession, side: SparkSession, cases: DataFrame, path: str) -> DataFrame:
    """(sqlId, dataDrifted): whether the tables that a statement reads have other rows than when ``path`` was written.

    A statement without a saved print of this version, or that cannot be analysed now, is not said to have drifted.
    """
    saved = spark.read.parquet(path).withColumnRenamed("sourcePrint", "_then").where(F.contains("_then", F.lit(f"={PRINT_VERSION}")))
    now = source_prints(spark, side, cases)
    return now.join(saved, "sqlId").select("sqlId", (F.col("_then") != F.col("sourcePrint")).alias("dataDrifted"))
