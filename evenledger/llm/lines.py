"""Boilerplate lines by site-relative frequency: on how many of its host's pages a line stands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenledger.llm.common import saved

#: With at most so many boilerplate lines (32 bytes each and the host) their table is broadcast; beyond, all is joined.
BROADCAST_LINES = 100_000


def _print(line: Column) -> Column:
    """128 bits of a trimmed line."""
    return F.struct(F.xxhash64(F.lit(1), line).alias("a"), F.xxhash64(F.lit(2), line).alias("b"))


def drop_boilerplate(
    docs: DataFrame,
    percent: int = 10,
    min_pages: int = 3,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    broadcast_lines: int = BROADCAST_LINES,
    keep: tuple[str, ...] = (),
    copies_once: bool = False,
) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): texts without the lines that stand on too many pages of their host.

    A line goes if at least ``min_pages`` pages of the host have it and 100 * pages with it > ``percent`` * all pages
    of the host. Lines are compared without spaces at their ends; a page counts once however often it repeats a line.
    Columns named in ``keep`` come along. Blank lines never go. Null and empty texts have one empty line; null hosts form one host.
    With ``copies_once`` pages of a host with the same whole text count as one page, in both counts, so that copies of
    a text do not make boilerplate of its lines. Keys may be null or repeated.

    Counts are formed before the shuffle and shuffled by host and line, so a host or a line with a third of all pages
    is spread. A host has at most (distinct lines a page) * 100 / ``percent`` such lines.
    """
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{host}`")), F.lit("")).alias("host"),
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("kept_columns"),
    )
    split = F.split("text", "\n", -1).alias("lines")
    lines = rows.select("doc_id", "host", split, "kept_columns")
    prints = F.array_distinct(F.transform(F.filter("lines", lambda x: F.trim(x) != ""), lambda x: _print(F.trim(x))))
    on_page = lines.select("host", F.explode(prints).alias("line"))
    each = rows.select("host")
    if copies_once:
        whole = _print(F.col("text")).alias("page")
        on_page = rows.select("host", whole, split).select("host", "page", F.explode(prints).alias("line")).distinct()
        each = rows.select("host", whole).distinct()
    pages = each.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = on_page.groupBy("host", "line").agg(F.count(F.lit(1)).alias("met")).where(F.col("met") >= min_pages)
    bad = saved(counts.join(pages, "host").where(F.col("met") * 100 > F.col("pages") * percent).select("host", "line"), "boilerplate")
    if bad.count() <= broadcast_lines:
        listed = F.broadcast(bad.groupBy("host").agg(F.collect_list("line").alias("bad")))
        marked = lines.join(listed, "host", "left")
    else:
        lines = saved(lines.withColumn("row", F.monotonically_increasing_id()), "lines")
        found = lines.select("row", "host", F.explode(prints).alias("line")).join(bad, ["host", "line"])
        marked = lines.join(found.groupBy("row").agg(F.collect_list("line").alias("bad")), "row", "left")
    kept = F.when(F.col("bad").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: (F.trim(x) == "") | ~F.array_contains("bad", _print(F.trim(x))))
    )
    return marked.select("doc_id", kept.alias("kept"), F.size("lines").cast("long").alias("n_lines"), "kept_columns").select(
        "doc_id",
        F.array_join("kept", "\n").alias("text"),
        "n_lines",
        (F.col("n_lines") - F.size("kept")).alias("n_dropped"),
        *[F.col(f"kept_columns.`{c}`") for c in keep],
    )
