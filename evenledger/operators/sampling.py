"""Parameter samples taken from real rows of one table."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from evenledger.functions.chain import first_verdict
from evenledger.functions.parameters import SAMPLE_VALUE
from evenledger.operators.ranking import top_rows

SAMPLE_SIZE = 3


@dataclass(frozen=True)
class Mapping:
    """Where one logical parameter takes its values from, and the indexes it is bound to."""

    index: int
    jdbc_indexes: tuple[int, ...]
    name: str
    column: str
    java_type: str = ""
    collection: bool = False
    lower: bool = False


def _value(mapping: Mapping) -> Column:
    c = F.col(mapping.column)
    return F.lower(c.cast("string")) if mapping.lower else c


# Kind of a parameter value of each Spark type.
KINDS = (
    (T.StringType, "STRING"),
    (T.LongType, "LONG"),
    (T.IntegralType, "INTEGER"),
    (T.DecimalType, "DECIMAL"),
    (T.FractionalType, "DOUBLE"),
    (T.BooleanType, "BOOLEAN"),
    (T.DateType, "DATE"),
    (T.TimestampNTZType, "TIMESTAMP"),
    (T.TimestampType, "INSTANT"),
    (T.BinaryType, "BYTES"),
)


def kind_of(dtype: T.DataType) -> str:
    for cls, kind in KINDS:
        if isinstance(dtype, cls):
            return kind
    raise ValueError(f"no parameter kind for {dtype.simpleString()}")


def _text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BinaryType):
        return F.base64(c)
    if isinstance(dtype, T.TimestampNTZType):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if isinstance(dtype, T.TimestampType):
        return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return c.cast("string")


def sample_tuples(
    df: DataFrame,
    mappings: list[Mapping],
    n: int = SAMPLE_SIZE,
    non_null: bool = True,
    by: list[str] = (),
) -> DataFrame:
    """Up to ``n`` distinct tuples, one column ``p<index>`` per mapping, all values from the same row.

    Values are transformed first, then made distinct (partial aggregation), then the smallest ``n``
    are taken in value order, so that reruns give the same samples.
    """
    by = list(by)
    names = [f"p{m.index}" for m in mappings]
    picked = df.select(*by, *[_value(m).alias(f"p{m.index}") for m in mappings])
    if non_null:
        picked = picked.dropna(subset=names)
    distinct = picked.distinct()
    if by:
        return top_rows(distinct, by, names, n, out="sampleIndex").withColumn("sampleIndex", F.col("sampleIndex").cast("int"))
    order = [F.col(c).asc_nulls_last() for c in names]
    few = distinct.orderBy(*order).limit(n)
    # At most n rows are left, so one window over all of them is fine.
    return few.withColumn("sampleIndex", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def sample_index(df: DataFrame, plan: list[str], columns: list[str], n: int) -> DataFrame:
    """1..n inside each plan after making its tuples distinct."""
    return top_rows(df.select(*plan, *columns).distinct(), plan, columns, n, out="sampleIndex")


def _sample_value(m: Mapping, name: str, types: dict[str, T.DataType], table: str) -> Column:
    return F.struct(
        F.lit(m.index),
        F.array(*[F.lit(i) for i in m.jdbc_indexes]),
        F.lit(m.name),
        F.lit(m.java_type),
        F.lit(m.collection),
        F.lit(kind_of(types[name])),
        _text(F.col(name), types[name]),
        F.lit(table),
        F.lit(m.column),
    ).cast(SAMPLE_VALUE)


def tuple_column(samples: DataFrame, mappings: list[Mapping], table: str) -> DataFrame:
    """(…, sampleIndex, values): the tuple as an array of typed, reversible text values."""
    types = {f.name: f.dataType for f in samples.schema.fields}
    names = [f"p{m.index}" for m in mappings]
    values = [_sample_value(m, name, types, table) for m, name in zip(mappings, names)]
    kept = [c for c in samples.columns if c not in names]
    packed = F.array(*values) if values else F.array().cast(f"array<{SAMPLE_VALUE}>")
    return samples.select(*kept, packed.alias("values"))


def _smallest(rows: pa.Table, best: pa.Table | None, names: list[str], n: int) -> pa.Table:
    """The first ``n`` distinct rows without nulls, in value order, of those known and the new ones."""
    rows = rows.select(names).drop_null()
    if best is not None:
        if best.num_rows == n:
            last = best[names[0]][n - 1]
            if not pa.types.is_floating(last.type) or last.as_py() == last.as_py():  # nothing is above a NaN
                rows = rows.filter(pc.less_equal(rows[names[0]], last))
        rows = pa.concat_tables([best, rows])
    return rows.group_by(names).aggregate([]).select(names).sort_by([(c, "ascending") for c in names]).slice(0, n)


def _wide(best: pa.Table, spec: int, schema: pa.Schema) -> pa.Table:
    """The rows with all columns of the table's samples, those of other statements null."""
    given = {"spec": pa.array([spec] * best.num_rows, pa.int32()), **{c: best[c] for c in best.column_names}}
    return pa.table([given[f.name].cast(f.type) if f.name in given else pa.nulls(best.num_rows, f.type) for f in schema], schema=schema)


def _sample_batches(batches: Iterator[pa.RecordBatch], specs: list[list[str]], n: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    best: list[pa.Table | None] = [None] * len(specs)
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        best = [_smallest(rows, known, names, n) for known, names in zip(best, specs)]
    for spec, found in enumerate(best):
        if found is not None and found.num_rows:
            yield from _wide(found, spec, schema).to_batches()


def _merged(specs: list[list[str]], n: int, schema: pa.Schema):
    def merge(rows: pa.Table) -> pa.Table:
        spec = rows["spec"][0].as_py()
        found = _smallest(rows, None, specs[spec], n)
        made = _wide(found, spec, pa.schema(list(schema)[:-2]))
        size = found.num_rows
        return made.append_column(schema[-2], pa.array(range(1, size + 1), pa.int32())).append_column(schema[-1], pa.array([size] * size, pa.int32()))

    return merge


def sample_table(df: DataFrame, specs: dict[str, list[Mapping]], table: str, n: int = SAMPLE_SIZE) -> DataFrame:
    """(sqlId, sampleIndex, values, collectedSampleCount): up to ``n`` tuples for every statement, from one pass over its table.

    A task keeps the ``n`` smallest distinct tuples of each statement and nothing else; what the tasks found meets by
    statement. Tuples with a null are left out, the others taken in value order, as ``sample_tuples`` does for one
    statement. Only the columns that some statement asks for are read.
    """
    wide: dict[tuple[str, bool], str] = {}
    for mappings in specs.values():
        for m in mappings:
            wide.setdefault((m.column, m.lower), f"w{len(wide)}")
    chosen = {(m.column, m.lower): m for mappings in specs.values() for m in mappings}
    picked = df.select(*[_value(chosen[at]).alias(name) for at, name in wide.items()])
    types = {f.name: f.dataType for f in picked.schema.fields}
    plus_zero = [(F.col(c) + F.lit(0.0).cast(t)).alias(c) if isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType) else F.col(c) for c, t in types.items()]
    names = [list(dict.fromkeys(wide[m.column, m.lower] for m in mappings)) for mappings in specs.values()]
    found = T.StructType([T.StructField("spec", T.IntegerType()), *picked.schema.fields])
    merged = T.StructType([*found.fields, T.StructField("sampleIndex", T.IntegerType()), T.StructField("collectedSampleCount", T.IntegerType())])
    few = picked.select(*plus_zero).mapInArrow(partial(_sample_batches, specs=names, n=n, schema=to_arrow_schema(found)), found)
    best = few.groupBy("spec").applyInArrow(_merged(names, n, to_arrow_schema(merged)), merged)

    # What the statements ask for, one row each; ``at`` is the place of a value among the texts of the wide columns.
    columns = list(wide.values())
    asked = [
        (spec, sql_id, [(m.index, list(m.jdbc_indexes), m.name, m.java_type, m.collection, kind_of(types[w]), columns.index(w), table, m.column) for m, w in zip(mappings, (wide[m.column, m.lower] for m in mappings))])
        for spec, (sql_id, mappings) in enumerate(specs.items())
    ]
    listed = df.sparkSession.createDataFrame(asked, f"spec int, sqlId string, asked array<{SAMPLE_VALUE.replace('value:string', 'at:int')}>")
    texts = F.array(*[_text(F.col(w), types[w]) for w in columns])
    fields = [name.partition(":")[0] for name in SAMPLE_VALUE[len("struct<") : -1].split(",")]

    def filled_in(v: Column) -> Column:
        return F.struct(*[F.get("_texts", v["at"]) if f == "value" else v[f] for f in fields]).cast(SAMPLE_VALUE)

    joined = best.withColumn("_texts", texts).join(F.broadcast(listed), "spec")
    return joined.select("sqlId", "sampleIndex", F.transform("asked", filled_in).alias("values"), "collectedSampleCount")


def sampling_status(df: DataFrame) -> DataFrame:
    """Outcome of each plan from planStatus, tupleCount, connectionError and queryError.

    A plan that is not READY keeps its own code and reason (planCode, planReason).
    """
    c = F.col
    rules = [
        (c("connectionError").isNotNull(), ("H2_CONNECTION_FAILED", "H2_CONNECTION_FAILED", c("connectionError"))),
        (c("planStatus") == "NO_PARAMETERS", ("NO_PARAMETERS", "NO_PARAMETERS", "The SELECT has no parameters.")),
        (c("planStatus") == "SKIPPED_UNSUPPORTED", ("SKIPPED_UNSUPPORTED", c("planCode"), c("planReason"))),
        (c("planStatus") != "READY", ("MANUAL_MAPPING_REQUIRED", c("planCode"), c("planReason"))),
        (c("queryError").isNotNull(), ("H2_QUERY_FAILED", "H2_SAMPLING_QUERY_FAILED", "The H2 sampling query failed.")),
        (
            c("tupleCount") == 0,
            ("NO_SAMPLE_DATA", "NO_SAMPLE_DATA", "H2 returned no usable real parameter tuple."),
        ),
    ]
    default = ("SAMPLED", "SAMPLED", "Real parameter tuples were sampled from H2.")
    verdict = first_verdict(("samplingStatus", "reasonCode", "reason"), rules, default)
    return df.withColumn("_v", verdict).select(*df.columns, "_v.*")


def sampling_totals(df: DataFrame) -> DataFrame:
    """Eight counters over sampling outcomes, one row of partial sums."""
    of = lambda status: F.count_if(F.col("samplingStatus") == status)
    return df.agg(
        F.count(F.lit(1)).alias("samplingCandidates"),
        of("SAMPLED").alias("sampledSql"),
        F.coalesce(F.sum(F.when(F.col("samplingStatus") == "SAMPLED", F.col("tupleCount"))), F.lit(0)).alias("sampledTuples"),
        of("NO_SAMPLE_DATA").alias("noSampleData"),
        of("MANUAL_MAPPING_REQUIRED").alias("manualMappingRequired"),
        of("SKIPPED_UNSUPPORTED").alias("unsupported"),
        of("H2_QUERY_FAILED").alias("queryFailures"),
        of("H2_CONNECTION_FAILED").alias("connectionFailures"),
    )
