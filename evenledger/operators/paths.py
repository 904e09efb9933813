"""Leaf paths of JSON and XML documents held in a column.

JSON documents are opened level by level inside their own row. XML documents are read once, event by event, in Arrow batches. Nothing shuffles until paths are
counted over documents.
"""

from __future__ import annotations

import xml.parsers.expat
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from evenledger.functions.chain import filled
from evenledger.sources.scan import scan_json_docs

#: Deepest nesting of a JSON document that is read.
MOST_LEVELS = 1000
NODE = "struct<path:string,v:variant,fields:map<string,variant>,items:array<variant>>"
STATE = f"struct<leaves:array<string>,nodes:array<{NODE}>>"


def _node(path: Column, v: Column) -> Column:
    return F.struct(
        path.alias("path"),
        v.alias("v"),
        F.try_variant_get(v, "$", "map<string,variant>").alias("fields"),
        F.try_variant_get(v, "$", "array<variant>").alias("items"),
    )


def _children(o: Column) -> Column:
    path = o["path"]
    stem = F.when(path == "", "").otherwise(F.concat(path, F.lit(".")))
    named = F.transform(F.map_entries(o["fields"]), lambda e: _node(F.concat(stem, e["key"]), e["value"]))
    return F.when(o["fields"].isNotNull(), named).otherwise(F.transform(o["items"], lambda x: _node(F.concat(path, F.lit("[]")), x)))


def _is_open(n: Column) -> Column:
    return F.coalesce(F.size(n["fields"]) > 0, F.lit(False)) | F.coalesce(F.size(n["items"]) > 0, F.lit(False))


def _leaf(n: Column) -> Column:
    return F.when(n["items"].isNotNull(), F.concat(n["path"], F.lit("[]"))).otherwise(n["path"])


def nesting_depth(json_text: Column) -> Column:
    """Depth of brackets in a JSON text, string contents left out."""
    no_escapes = F.regexp_replace(json_text, r"\\.", "")
    brackets = F.regexp_replace(F.regexp_replace(no_escapes, r'"[^"]*"', ""), r"[^\[\]{}]", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def move(seen, mark):
        now = seen.getField("now") + F.when(mark.isin("{", "["), 1).when(mark.isin("}", "]"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(seen.getField("most"), now).alias("most"))

    return F.aggregate(F.split(brackets, ""), start, move, lambda s: s.getField("most"))


def _walked(s: Column) -> Column:
    """One level down: leaves among the nodes are noted, containers are replaced by what they hold."""
    nodes = s["nodes"]
    ended = F.filter(nodes, lambda n: ~_is_open(n) & n["fields"].isNull())
    kids = F.flatten(F.transform(F.filter(nodes, _is_open), _children))
    return F.when(F.size(nodes) == 0, s).otherwise(F.struct(F.array_union(s["leaves"], F.transform(ended, _leaf)).alias("leaves"), kids.alias("nodes")))


def json_leaf_paths(df: DataFrame, doc_id: str | list[str], column: str, max_depth: int | None = None, max_chars: int | None = None) -> DataFrame:
    """(doc_id, path), each pair once; rejected documents give nothing.

    ``.name`` for a field, ``[]`` for list items; an empty list is a leaf, an empty object nothing. Of fields with the
    same name in one object the last counts. A document is opened level by level by a loop inside its own row, which
    has no more rounds than the text has opening brackets. Documents nested deeper than ``MOST_LEVELS`` are rejected,
    and fail the job where they are deeper than a ``max_depth`` that the caller states.
    """
    ids = [doc_id] if isinstance(doc_id, str) else list(doc_id)
    docs = scan_json_docs(df.select(*ids, column), column, max_chars).where(F.col("json").isNotNull())
    brackets = F.length(column) - F.length(F.translate(column, "[{", ""))
    rounds = F.least(brackets, F.lit(MOST_LEVELS if max_depth is None else max_depth)) + 1
    start = F.struct(F.array().cast("array<string>").alias("leaves"), F.array(_node(F.lit(""), F.col("json"))).alias("nodes")).cast(STATE)
    rest = F.lit(None) if max_depth is None else F.raise_error(F.lit("document nested deeper than max_depth"))
    finish = lambda s: F.when(F.size(s["nodes"]) > 0, rest.cast("array<string>")).otherwise(s["leaves"])
    leaves = F.aggregate(F.sequence(F.lit(1), rounds), start, lambda s, _: _walked(s), finish)
    # The outer form keeps Spark from filtering by the list's size first, which would walk every document again.
    return docs.select(*ids, leaves.alias("_leaves")).select(*ids, F.explode_outer("_leaves").alias("path")).where(F.col("path") != "")


class _XmlPaths:
    """Leaf paths of one document, from the events of its parser.

    Every open element keeps, for each local name among its children, how many there are and the paths found below
    them; whether a child's step gets ``[]`` is known when its parent ends.
    """

    def __init__(self):
        self.open: list[tuple[list[str], dict[str, list]]] = [([], {})]
        parser = self.parser = xml.parsers.expat.ParserCreate()
        parser.StartElementHandler, parser.EndElementHandler = self.start, self.end
        parser.StartDoctypeDeclHandler = self.doctype

    @staticmethod
    def local(name: str) -> str:
        return name.rpartition(":")[2]

    def doctype(self, *_):
        raise ValueError("a document type is not accepted")

    def start(self, name, attributes):
        own = [f".@{self.local(a)}" for a in attributes if a != "xmlns" and not a.startswith("xmlns:")]
        self.open.append((own, {}))

    def end(self, name):
        paths, children = self.open.pop()
        found = set(paths)
        if not children:
            found.add("")
        for child, (count, below) in children.items():
            step = f".{child}[]" if count > 1 else f".{child}"
            found.update(step + p for p in below)
        met = self.open[-1][1].setdefault(self.local(name), [0, set()])
        met[0] += 1
        met[1] |= found

    def of(self, text: str) -> list[str]:
        self.parser.Parse(text, True)
        return [root + p for root, (_, below) in self.open[0][1].items() for p in below]


def xml_paths_of(text: str | None) -> list[str] | None:
    """Distinct leaf paths of a document; None where it is null, blank, malformed or has a document type."""
    try:
        return _XmlPaths().of(text) if text and text.strip() else None
    except (ValueError, xml.parsers.expat.ExpatError):
        return None


def _xml_batches(batches: Iterator[pa.RecordBatch], column: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [xml_paths_of(text) for text in batch.column(column).to_pylist()]
        status = ["INVALID" if paths is None else "VALID" for paths in found]
        kept = [batch.column(name) for name in schema.names[:-2]]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(status), pa.array(found, pa.list_(pa.string()))], schema=schema)


def xml_documents(df: DataFrame, column: str) -> DataFrame:
    """Adds ``docStatus`` (BLANK, VALID, or INVALID when malformed or with a document type) and ``paths``, null unless VALID."""
    text = df.schema[column].dataType
    schema = StructType([*df.schema.fields, StructField("docStatus", StringType()), StructField("paths", ArrayType(StringType()))])
    made = df.mapInArrow(partial(_xml_batches, column=column, schema=to_arrow_schema(schema)), schema)
    return made.withColumn("docStatus", F.when(~filled(F.col(column).cast(text)), "BLANK").otherwise(F.col("docStatus")))


def xml_leaf_paths(df: DataFrame, doc_id: str | list[str], column: str) -> DataFrame:
    """(doc_id, path), each pair once. The root is kept, repeated siblings get ``[]``, attributes ``.@name``.

    Names count without their prefix, also when siblings are told to be repeated; name-space declarations are no
    attributes. Documents that are malformed or have a document type give nothing.
    """
    ids = [doc_id] if isinstance(doc_id, str) else list(doc_id)
    return xml_documents(df.select(*ids, column), column).select(*ids, F.explode("paths").alias("path"))


def distinct_paths(paths: DataFrame) -> DataFrame:
    return paths.select("path").distinct()


def path_inventory(paths: DataFrame) -> DataFrame:
    """Documents per path, in path order; (doc, path) pairs arrive distinct, so a plain count is enough."""
    return paths.groupBy("path").agg(F.count(F.lit(1)).alias("docCount")).orderBy("path")
