"""Canonical cells, rows and column signatures.

A cell is a tag and a value, so that equal answers from two engines give equal text: every number
is ``NUM:`` without trailing zeros, whatever its declared width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NORMALIZATION_VERSION = "canonical-2"
CELL_SEPARATOR = "\x1f"
MILLISECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSS"

# Type family of each Spark type, as used in column signatures.
FAMILIES: tuple[tuple[tuple[type, ...], str], ...] = (
    ((T.NumericType,), "NUMBER"),
    ((T.BooleanType,), "BOOLEAN"),
    ((T.DateType,), "DATE"),
    ((T.TimestampType, T.TimestampNTZType), "TIMESTAMP"),
    ((T.BinaryType,), "BINARY"),
    ((T.StringType, T.CharType, T.VarcharType), "STRING"),
)


class UnsupportedResultType(ValueError):
    """A result column has a type with no canonical text."""


def type_family(dtype: T.DataType) -> str:
    for classes, family in FAMILIES:
        if isinstance(dtype, classes):
            return family
    name = dtype.typeName().upper()
    return "TIME" if name.startswith("TIME(") or name == "TIME" else name


def column_signature(schema: T.StructType) -> str:
    return "|".join(f"{f.name.strip().upper()}:{type_family(f.dataType)}" for f in schema.fields)


def plain_decimal(c: Column) -> Column:
    """Text of a decimal that has a fraction part, without trailing zeros."""
    return F.rtrim(F.rtrim(c.cast("string"), F.lit("0")), F.lit("."))


def escaped(c: Column) -> Column:
    """Keep cell and row separators out of text cells."""
    for mark, written in (("\\", "\\\\"), ("\n", "\\n"), (CELL_SEPARATOR, "\\u001F")):
        c = F.replace(c, F.lit(mark), F.lit(written))
    return c


def normalization_version(max_rows: int | None = None, scale: int | None = None) -> str:
    """Names how results were made comparable: prints and hashes, and roundings, are never compared with one another."""
    method = "" if max_rows is None else "-sha256"
    return NORMALIZATION_VERSION + method + ("" if scale is None else f"-scale{scale}")


def plain_number(c: Column, kind: str, scale: int | None) -> Column:
    """Text of a float or double: rounded to ``scale`` digits, or, with None, as many as tell it from all others."""
    text = c.cast("string")
    if scale is not None:
        source = c if kind == "double" else text
        return F.coalesce(plain_decimal(source.try_cast(f"decimal(38,{scale})")), text)
    # Without an exponent the text has the digits already; decimals, which cost more, are for the others.
    exact = text.try_cast("decimal(38,18)")
    large = F.when(exact.cast(kind) == c, plain_decimal(exact)).otherwise(text)
    return F.when(F.contains(text, F.lit("E")), large).when(text == "-0.0", "0").otherwise(plain_decimal(text))


def moment(c: Column) -> Column:
    """Date and time to the millisecond; years of four digits come from the plain text, which is cheaper to make."""
    text = c.cast("string")
    fraction = F.rpad(F.substring(text, 21, 3), 3, "0")
    plain = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), fraction)
    return F.when(F.substring(text, 5, 1) == "-", plain).otherwise(F.date_format(c, MILLISECONDS))


def canonical_value(c: Column, dtype: T.DataType, scale: int | None = None, nested: str = "error") -> Column:
    """Tagged text of one cell; floats and doubles are kept whole unless ``scale`` rounds them.

    ``nested='json'`` admits arrays, maps and structs as JSON.
    """
    if isinstance(dtype, T.BooleanType):
        tag, body = "BOOL:", c.cast("string")
    elif isinstance(dtype, T.DecimalType):
        tag, body = "NUM:", plain_decimal(c) if dtype.scale > 0 else c.cast("string")
    elif isinstance(dtype, T.DoubleType):
        tag, body = "NUM:", plain_number(c, "double", scale)
    elif isinstance(dtype, T.FloatType):
        tag, body = "NUM:", plain_number(c, "float", scale)
    elif isinstance(dtype, T.NumericType):
        tag, body = "NUM:", c.cast("string")
    elif isinstance(dtype, T.DateType):
        tag, body = "DATE:", c.cast("string")
    elif isinstance(dtype, T.TimestampNTZType):
        tag, body = "TIMESTAMP:", moment(c)
    elif isinstance(dtype, T.TimestampType):
        utc = F.to_utc_timestamp(c, F.current_timezone())
        tag, body = "INSTANT:", F.concat(moment(utc), F.lit("Z"))
    elif isinstance(dtype, T.BinaryType):
        tag, body = "BYTES:", F.base64(c)
    elif isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        tag, body = "TEXT:", escaped(c)
    elif isinstance(dtype, T.NullType):
        return F.lit("NULL")
    elif type_family(dtype) == "TIME":
        tag, body = "TIME:", c.cast("string")
    elif nested == "json":
        tag, body = "JSON:", F.to_json(c)
    else:
        raise UnsupportedResultType(f"no canonical text for {dtype.simpleString()}")
    return F.coalesce(F.concat(F.lit(tag), body), F.lit("NULL"))


def canonical_row(df: DataFrame, columns: list[str] | None = None, scale: int | None = None, nested: str = "error") -> Column:
    """All cells of a row in column order, joined by the unit separator."""
    chosen = columns or df.columns
    return F.concat_ws(
        CELL_SEPARATOR,
        *[canonical_value(F.col(f"`{n}`"), df.schema[n].dataType, scale, nested) for n in chosen],
    )


def signature_of(df: DataFrame, columns: list[str] | None = None) -> str:
    chosen = columns or df.columns
    return column_signature(T.StructType([df.schema[n] for n in chosen]))
