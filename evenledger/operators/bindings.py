"""Bindings: per-statement aggregates, plan building, parameter resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenledger.functions.chain import blank, filled, first_match, first_verdict, lowered, nonblank
from evenledger.functions.parameters import bound_type
from evenledger.functions.text import placeholders
from evenledger.operators.ranking import number_rows
from evenledger.operators.skew import lookup_join

LIST_PART = 1000

# Notes written next to a bound parameter.
NOTES = {
    "JPA_INDEXED_POSITIONAL": (
        "Mapped from JPA indexed positional parameter",
        "Parameter index was not resolved, fallback value used",
    ),
    "JDBC_ORDINAL_POSITIONAL": (
        "Mapped from JDBC ordinal parameter",
        "Ordinal parameter not resolved, fallback value used",
    ),
    "NAMED": ("Mapped from named parameter", "Named parameter not resolved, fallback value used"),
}


def binding_usable(text: Column, status: Column) -> Column:
    """Has text, and no word in its status says otherwise."""
    return filled(text) & ~F.upper(F.coalesce(status, F.lit(""))).rlike("FAIL|ERROR|UNRESOLVED|INCOMPLETE|MANUAL")


def aggregate_bindings(bindings: DataFrame, order: str = "_pos") -> DataFrame:
    """One row per statement: first non-blank text and status, and the binding count.

    The count is the largest explicit one, else the number of distinct indexes. A row without an
    index is the placeholder row of a statement without parameters and counts nothing.
    """
    at = F.col(order)
    text = lambda c: F.when(filled(F.col(c)), F.trim(c))
    rows = bindings.where(filled(F.col("sqlId"))).select(
        "sqlId",
        nonblank(F.col("bindingIndex").cast("string")).alias("_index"),
        text("jdbcSql").alias("_text"),
        text("bindingStatus").alias("_status"),
        F.coalesce("bindingCount", F.lit(0)).alias("_explicit"),
        at.alias("_at"),
    )
    # One shuffle and one sort serve both levels: an index of a statement, then the statement.
    placed = rows.repartition("sqlId").sortWithinPartitions("sqlId", "_index")
    first = lambda c, by: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(by)))
    by_index = placed.groupBy("sqlId", "_index").agg(
        F.min(F.when(F.col("_text").isNotNull(), F.col("_at"))).alias("_text_at"),
        F.min(F.when(F.col("_status").isNotNull(), F.col("_at"))).alias("_status_at"),
        first("_text", "_at").alias("_text"),
        first("_status", "_at").alias("_status"),
        F.max("_explicit").alias("_explicit"),
    )
    return (
        by_index.groupBy("sqlId")
        .agg(
            first("_text", "_text_at").alias("jdbcSql"),
            first("_status", "_status_at").alias("bindingStatus"),
            F.max("_explicit").alias("_explicit"),
            F.count("_index").alias("_indexes"),
        )
        .select(
            "sqlId",
            F.coalesce("jdbcSql", F.lit("")).alias("jdbcSql"),
            F.coalesce("bindingStatus", F.lit("")).alias("bindingStatus"),
            F.when(F.col("_explicit") > 0, F.col("_explicit")).otherwise(F.col("_indexes")).cast("int").alias("bindingCount"),
        )
    )


def _parts(bindings: DataFrame, order: list[str], part_rows: int) -> DataFrame:
    numbered = number_rows(bindings, ["sqlId"], order, "_no")
    return numbered.withColumn("part", F.floor((F.col("_no") - 1) / part_rows).cast("int"))


def group_bindings(bindings: DataFrame, order=("bindingIndex",), part_rows: int = LIST_PART) -> DataFrame:
    """Bindings of a statement as ordered lists of at most ``part_rows``.

    A statement has part 0 only, unless it has more bindings than that; none are dropped.
    """
    fields = [c for c in bindings.columns if c not in ("sqlId", "_pos")]
    item = F.struct("_no", *fields)
    return (
        _parts(bindings, list(order), part_rows)
        .groupBy("sqlId", "part")
        .agg(F.sort_array(F.collect_list(item)).alias("bindings"))
        .withColumn("bindings", F.transform("bindings", lambda b: b.dropFields("_no")))
    )


def binding_label() -> Column:
    """``#i name:type/kind=value`` of one binding."""
    name = F.coalesce(F.when(filled(F.col("javaParameterName")), F.col("javaParameterName")), F.col("originalParameter"), F.lit(""))
    optional = lambda c, mark: F.when(blank(F.col(c)), "").otherwise(F.concat(F.lit(mark), F.col(c)))
    return F.concat(
        F.lit("#"),
        F.col("bindingIndex").cast("string"),
        F.lit(" "),
        name,
        F.lit(":"),
        F.when(blank(F.col("javaType")), "?").otherwise(F.col("javaType")),
        optional("parameterKind", "/"),
        optional("mockValue", "="),
    )


def parameter_summary(bindings: DataFrame, order=("bindingIndex",), part_rows: int = LIST_PART) -> DataFrame:
    """Labels of a statement's bindings joined by ``; ``, one row per ``part_rows`` bindings."""
    labelled = bindings.select("sqlId", *order, binding_label().alias("_label"))
    return (
        _parts(labelled, list(order), part_rows)
        .groupBy("sqlId", "part")
        .agg(F.sort_array(F.collect_list(F.struct("_no", "_label"))).alias("_l"))
        .select("sqlId", "part", F.array_join(F.transform("_l", lambda x: x.getField("_label")), "; ").alias("parameterSummary"))
    )


def plan_status_of(confidence: Column) -> Column:
    """Aggregate over a plan's bindings."""
    return first_match(
        [
            (F.bool_or(confidence == "MANUAL_REQUIRED"), "MANUAL_REQUIRED"),
            (F.bool_or(confidence == "LOW"), "READY_WITH_LOW_CONFIDENCE"),
        ],
        "READY",
    )


def plan_status(bindings: DataFrame) -> DataFrame:
    return bindings.groupBy("sqlId").agg(plan_status_of(F.col("confidence")).alias("planStatus"))


def placeholder_rows(statements: DataFrame, text: str = "effectiveSql") -> DataFrame:
    """One row per placeholder occurrence of each statement."""
    return statements.select("sqlId", F.explode(placeholders(F.col(text))).alias("p")).select(
        "sqlId", "p.kind", "p.text", "p.name", "p.index", "p.occurrence"
    )


def plan_builder(statements: DataFrame, text: str = "effectiveSql", dynamic: str = "dynamicSql") -> DataFrame:
    """Plan style of each statement before its parameters are resolved.

    Placeholders are looked at in the row itself, so nothing shuffles.
    """
    kinds = F.array_distinct(F.transform(placeholders(F.col(text)), lambda p: p.getField("kind")))
    return statements.withColumn("_kinds", kinds).select(
        *statements.columns,
        first_verdict(
            ("planStatus", "note"),
            [
                (blank(F.col(text)), ("EMPTY_SQL", "Empty SQL")),
                (F.coalesce(F.col(dynamic), F.lit(False)), ("SKIPPED_DYNAMIC_SQL", "Dynamic SQL requires manual review")),
                (F.size("_kinds") == 0, ("READY", "No parameters")),
                (
                    F.size("_kinds") > 1,
                    ("UNSUPPORTED_PARAMETER_STYLE", "Mixed parameter styles are not supported"),
                ),
                (F.get("_kinds", F.lit(0)) == "NAMED", ("PENDING", "Named parameter binding plan")),
                (
                    F.get("_kinds", F.lit(0)) == "JPA_INDEXED_POSITIONAL",
                    ("PENDING", "JPA indexed positional binding plan"),
                ),
            ],
            ("PENDING", "JDBC ordinal positional binding plan"),
        ).alias("_plan"),
    ).select(*statements.columns, "_plan.planStatus", "_plan.note")


def resolve_params(placeholder_df: DataFrame, declared: DataFrame) -> DataFrame:
    """Placeholders with their declared parameter, matched by name or by index.

    ``declared`` has (sqlId, paramKey, name, javaType, parameterKind, value, confidence), at most one
    row per key; the key is the name, or the index as text. Without a match: value TEST, LOW.
    """
    key = F.coalesce("name", F.col("index").cast("string"), F.col("occurrence").cast("string"))
    right = declared.select(
        "sqlId",
        "paramKey",
        F.col("name").alias("declaredName"),
        "javaType",
        "parameterKind",
        F.col("value").alias("declaredValue"),
        F.col("confidence").alias("declaredConfidence"),
        F.lit(True).alias("_found"),
    )
    joined = lookup_join(placeholder_df.withColumn("paramKey", key), right, ["sqlId", "paramKey"])
    found = F.coalesce("_found", F.lit(False))
    note = first_match(
        [
            (F.col("kind") == kind, F.when(found, yes).otherwise(no))
            for kind, (yes, no) in NOTES.items()
        ],
        "",
    )
    return joined.select(
        "sqlId",
        F.col("occurrence").alias("bindingIndex"),
        F.col("text").alias("originalParameter"),
        F.col("declaredName").alias("javaParameterName"),
        "javaType",
        F.coalesce("parameterKind", F.lit("UNKNOWN")).alias("parameterKind"),
        F.when(found, F.col("declaredValue")).otherwise("TEST").alias("mockValue"),
        F.when(found, F.col("declaredConfidence")).otherwise("LOW").alias("confidence"),
        note.alias("bindingNote"),
    )


def match_param_type(params: DataFrame, declared: DataFrame) -> DataFrame:
    """Type of each parameter: a declared one with HIGH confidence, else the guess with LOW.

    ``declared`` has (filePath, methodName, parameterName, declaredType), one row per parameter.
    """
    joined = lookup_join(params, declared, ["filePath", "methodName", "parameterName"])
    return joined.select(
        *params.columns,
        F.coalesce("declaredType", "guessedType", F.lit("")).alias("javaType"),
        F.when(F.col("declaredType").isNotNull(), "HIGH").otherwise("LOW").alias("confidence"),
    )


def binding_report(plans: DataFrame, bindings: DataFrame) -> DataFrame:
    """One row per binding, and one for each plan without any: whole values, and a preview of 100 characters."""
    values = bindings.select(
        "sqlId",
        "originalParameter",
        "bindingIndex",
        "javaParameterName",
        "javaType",
        "parameterKind",
        "mockValue",
        "confidence",
        "bindingNote",
    )
    facts = plans.select("sqlId", "parameterMode", "note")
    bare = facts.join(values.select("sqlId").distinct(), "sqlId", "left_anti")
    # An inner part and the rest, not one outer join: the adaptive skew join can split the inner part.
    rows = values.join(facts, "sqlId").unionByName(bare, allowMissingColumns=True)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return rows.select(
        "sqlId",
        "parameterMode",
        *[text(c) for c in ("originalParameter", "bindingIndex", "javaParameterName", "javaType", "parameterKind", "mockValue", "confidence")],
        F.coalesce("bindingNote", "note").alias("bindingNote"),
        F.substring(F.coalesce("mockValue", F.lit("")), 1, 100).alias("mockValuePreview"),
    )


def resolve_sample_bindings(indexes: DataFrame, bindings: DataFrame) -> DataFrame:
    """Logical parameters of each statement: their database indexes, name and type.

    ``indexes`` has (sqlId, jdbcIndex); ``bindings`` (sqlId, jdbcIndex, logicalParameterIndex,
    parameterName, javaType). An index without a binding stands for itself as ``param<i>``.
    """
    joined = lookup_join(indexes, bindings, ["sqlId", "jdbcIndex"])
    logical = F.when(F.col("logicalParameterIndex") >= 1, F.col("logicalParameterIndex")).otherwise(F.col("jdbcIndex"))
    named = joined.withColumn("logicalParameterIndex", logical).withColumn(
        "parameterName",
        F.coalesce(nonblank(F.col("parameterName")), F.concat(F.lit("param"), F.col("logicalParameterIndex"))),
    )
    return named.groupBy("sqlId", "logicalParameterIndex", "parameterName").agg(
        F.sort_array(F.collect_set("jdbcIndex")).alias("jdbcIndexes"),
        F.min_by(F.coalesce(F.trim("javaType"), F.lit("")), "jdbcIndex").alias("javaType"),
    )


def check_param_mapping(mappings: DataFrame) -> DataFrame:
    """A logical parameter must map to one source column and one transform, else it needs a person."""
    source = F.struct(lowered(F.col("sourceColumn")).alias("c"), F.coalesce("transform", F.lit("IDENTITY")).alias("t"))
    many = F.count_distinct(source) > 1
    return mappings.groupBy("sqlId", "logicalParameterIndex").agg(
        F.when(many, "MANUAL_MAPPING_REQUIRED").otherwise("READY").alias("mappingStatus"),
        F.when(many, "REPEATED_PARAMETER_DIFFERENT_COLUMNS").otherwise("READY").alias("reasonCode"),
    )


def validate_indexes(params: DataFrame, key: str = "sqlId", index: str = "jdbcIndex") -> DataFrame:
    """Are a statement's indexes exactly 1..n? Counted, not collected."""
    counted = params.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(index).alias("_d"),
        F.min(index).alias("_lo"),
        F.max(index).alias("_hi"),
    )
    ok = (F.col("_d") == F.col("n")) & (F.col("_lo") == 1) & (F.col("_hi") == F.col("n"))
    return counted.select(key, "n", F.coalesce(ok, F.lit(False)).alias("indexesValid"))


def expand_parameters(tuples: DataFrame, values: str = "values") -> DataFrame:
    """One typed row per database index of every tuple value; one value serves all its indexes."""
    others = [c for c in tuples.columns if c != values]
    exploded = tuples.select(*others, F.explode(values).alias("v")).select(
        *others,
        F.explode("v.jdbcIndexes").alias("jdbcIndex"),
        F.col("v.logicalParameterIndex").alias("logicalParameterIndex"),
        F.col("v.parameterName").alias("parameterName"),
        F.when(F.col("v.value").isNull(), "NULL").otherwise(F.col("v.kind")).alias("valueType"),
        F.col("v.value").alias("value"),
        F.col("v.javaType").alias("_declared"),
    )
    return exploded.select(
        *others,
        "jdbcIndex",
        "logicalParameterIndex",
        "parameterName",
        "valueType",
        bound_type(F.col("valueType"), F.col("_declared")).alias("jdbcType"),
        "value",
        F.when(F.col("valueType") == "BYTES", "BASE64").alias("encoding"),
    )
