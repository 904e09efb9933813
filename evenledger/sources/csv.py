"""CSV files of any size in more tasks than files, also where quoted values hold line breaks.

Files are read as lines, in the blocks into which Spark splits them. A line begins a record where an even number of
quotes stands before it in its file (a doubled quote inside a value counts twice). One pass over the input sums the
quotes of each block; their prefix sums over a file's blocks tell how each block begins. Blocks in which every line
has its quotes closed are parsed line by line. Only in the others are the lines of a record brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evenledger.sources.sink import scratch_path

#: Positions: the number of the block above, the line's place in its task below.
PLACE_BITS = 33
PARSED = {"quote": '"', "escape": '"', "multiLine": "true"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, start (of the block), place, line and its number of quotes."""
    text = F.regexp_replace("value", "\r$", "")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    raw = spark.read.text(path, lineSep="\n")
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        place.alias("place"),
        text.alias("line"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )


def _blocks(lines: DataFrame) -> DataFrame:
    """file, start, number (by file and place in it), first (place of its first line), opened (a quote is open before it), calm.

    One row for each block, written to the scratch folder.
    """
    spark = lines.sparkSession
    odd = F.col("quotes") % 2 == 1
    each = lines.groupBy("file", "start").agg(F.min("place").alias("first"), F.sum("quotes").alias("quotes"), F.bool_or(odd).alias("odd"))
    path = scratch_path(spark, "csv-blocks")
    each.write.parquet(path)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    number = F.row_number().over(Window.orderBy("file", "start")) - 1
    return spark.read.parquet(path).select("file", "start", "first", number.cast("long").alias("number"), opened.alias("opened"), (~F.col("odd") & ~opened).alias("calm"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(_pos, _record, _header): the text of every record and its place by file and place in it; blank lines are left out.

    ``_header`` is true for the first record of each file. A quote that is never closed takes the rest of its file.
    """
    lines = _lines(spark, path)
    blocks = _blocks(lines)
    pos: Column = F.shiftleft("number", PLACE_BITS).bitwiseOR(F.col("place"))
    header = (F.col("start") == 0) & (F.col("place") == F.col("first"))
    placed = lines.join(blocks, ["file", "start"]).select("file", "number", "calm", "opened", "quotes", "line", pos.alias("_pos"), header.alias("_header"))
    plain = placed.where("calm").select("_pos", F.col("line").alias("_record"), "_header")
    solid = F.col("_record") != ""
    if blocks.where(~F.col("calm")).isEmpty():
        return plain.where(solid)
    rough = placed.where(~F.col("calm"))
    here = Window.partitionBy("number").orderBy("_pos")
    before = F.coalesce(F.sum("quotes").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("opened").cast("int")
    marked = rough.withColumn("begin", F.when(before % 2 == 0, F.col("_pos")))
    marked = marked.withColumn("record", F.max("begin").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    last = marked.groupBy("file", "number").agg(F.max("begin").alias("last"))
    earlier = Window.partitionBy("file").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("number", F.max("last").over(earlier).alias("carried"))
    joined = marked.join(carried, "number").select(F.coalesce("record", "carried").alias("_pos"), F.struct(F.col("_pos").alias("at"), "line").alias("part"), "_header")
    whole = joined.groupBy("_pos").agg(F.array_sort(F.collect_list("part")).alias("parts"), F.bool_or("_header").alias("_header"))
    text = F.array_join(F.transform("parts", lambda p: p["line"]), "\n")
    return plain.unionByName(whole.select("_pos", text.alias("_record"), "_header")).where(solid)


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, named by the first file's header, and ``_pos``. Every file begins with that header."""
    names = spark.read.csv(path, header=True, quote='"', escape='"').columns
    if not names:
        return spark.range(0).select(F.col("id").alias("_pos"))
    kinds = ", ".join(f"_c{i} string" for i in range(len(names)))
    records = csv_records(spark, path).where(~F.col("_header"))
    parsed = records.select("_pos", F.from_csv("_record", kinds, PARSED).alias("_row"))
    return parsed.select("_pos", *[F.col(f"_row._c{i}").alias(name) for i, name in enumerate(names)])
