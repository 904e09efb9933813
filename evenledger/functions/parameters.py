"""Default values, value kinds and tuple columns for statement parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenledger.functions.chain import first_match, lowered

# Fixed values.
DEFAULT_TEXT = "TEST"
DEFAULT_NUMBER = "1"
DEFAULT_UUID = "00000000-0000-0000-0000-000000000001"
ISO_DATE = "yyyy-MM-dd"
ISO_SECOND = "yyyy-MM-dd'T'HH:mm:ss"

# Kind of a parameter value, the database type it binds to.
KIND_TYPES = {
    "STRING": "VARCHAR",
    "INTEGER": "INTEGER",
    "LONG": "BIGINT",
    "BIG_INTEGER": "NUMERIC",
    "DECIMAL": "DECIMAL",
    "DOUBLE": "DOUBLE",
    "BOOLEAN": "BOOLEAN",
    "DATE": "DATE",
    "TIME": "TIME",
    "TIMESTAMP": "TIMESTAMP",
    "OFFSET_DATE_TIME": "TIMESTAMP_WITH_TIMEZONE",
    "INSTANT": "TIMESTAMP_WITH_TIMEZONE",
    "UUID": "OTHER",
    "BYTES": "BINARY",
}

# Part of a declared type name, the database type a null of that type binds to, in order.
DECLARED_TYPES = (
    ("Long", "BIGINT"),
    ("Integer", "INTEGER"),
    ("Short", "INTEGER"),
    ("BigDecimal", "DECIMAL"),
    ("BigInteger", "DECIMAL"),
    ("Boolean", "BOOLEAN"),
    ("LocalDateTime", "TIMESTAMP"),
    ("Timestamp", "TIMESTAMP"),
    ("LocalDate", "DATE"),
    ("java.sql.Date", "DATE"),
    ("LocalTime", "TIME"),
    ("java.sql.Time", "TIME"),
    ("UUID", "OTHER"),
    ("byte[]", "BINARY"),
    ("Byte", "INTEGER"),
)

SAMPLE_VALUE = (
    "struct<logicalParameterIndex:int,jdbcIndexes:array<int>,parameterName:string,javaType:string,"
    "collection:boolean,kind:string,value:string,sourceTable:string,sourceColumn:string>"
)


def default_by_name(name: Column, now: Column) -> Column:
    """Guess from the parameter name; ``uuid`` is tested before the ``id`` ending."""
    n = lowered(name)
    return first_match(
        [
            (n.contains("uuid"), DEFAULT_UUID),
            (n.endswith("id") | n.endswith("ids"), DEFAULT_NUMBER),
            (n.contains("date"), F.date_format(now, ISO_DATE)),
            (n.contains("time"), F.date_format(now, ISO_SECOND)),
            (n.rlike("flag|enabled|active"), "true"),
        ],
        DEFAULT_TEXT,
    )


def default_value(java_type: Column, name: Column, now: Column | None = None) -> Column:
    """Text of the stand-in value: the declared type decides first, then the name."""
    now = F.current_timestamp() if now is None else now
    t = lowered(java_type)
    return first_match(
        [
            ((t == "") | t.contains("string"), default_by_name(name, now)),
            (t.rlike("long|integer|short|bigdecimal") | (t == "int"), DEFAULT_NUMBER),
            (t.contains("boolean"), "true"),
            (t.rlike("localdatetime|timestamp"), F.date_format(now, ISO_SECOND)),
            (t.contains("localdate"), F.date_format(now, ISO_DATE)),
            (t.contains("uuid"), DEFAULT_UUID),
        ],
        default_by_name(name, now),
    )


def default_list(java_type: Column, name: Column, n: Column, now: Column | None = None) -> Column:
    """Distinct stand-ins for a list parameter: 1..n, or TEST_1..TEST_n."""
    t = lowered(java_type)
    positions = F.sequence(F.lit(1), F.greatest(n.cast("int"), F.lit(1)))
    single = default_value(java_type, name, now)
    numeric = t.rlike("long|integer|short|bigdecimal") | (t == "int")
    textual = t.contains("string")
    return F.transform(
        positions,
        lambda i: first_match(
            [(numeric, i.cast("string")), (textual, F.concat(F.lit("TEST_"), i.cast("string")))], single
        ),
    )


def bound_type(kind: Column, declared: Column) -> Column:
    """Database type of a value kind; a null takes it from its declared type."""
    declared = F.coalesce(declared, F.lit(""))
    for_null = first_match([(declared.contains(F.lit(part)), name) for part, name in DECLARED_TYPES], "VARCHAR")
    return first_match([(kind == k, v) for k, v in KIND_TYPES.items()], for_null)
