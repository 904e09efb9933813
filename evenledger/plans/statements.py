"""Jobs over a corpus of statements: profile, extract, check, plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenledger.functions import text as tx
from evenledger.functions.chain import first_match
from evenledger.operators.bindings import placeholder_rows, plan_builder, plan_status, resolve_params
from evenledger.operators.ranking import assign_ids
from evenledger.operators.summaries import sanity_summary, scan_summary, union_scans

# Fixed patterns of embedded statements.
LITERAL = r'"[^"\\]*(?:\\.[^"\\]*)*"'
LITERALS = rf"{LITERAL}(?:\s*\+\s*{LITERAL})*"
QUERY_START = r"@(?:\w+\.)*Query\s*\("
ENTITY_START = r"createNativeQuery\s*\("
JDBC_START = r"(?:queryForObject|queryForList|batchUpdate|query|update|execute)\s*\("
ANY_START = rf"(?=@(?:\w+\.)*Query\s*\()|(?=\bcreateNativeQuery\s*\()|(?<=[jJ]dbcTemplate\.)(?={JDBC_START})"
METHOD = r"(\w+)\s*\([^(){};]*\)\s*(?:throws\s+[\w.,\s]+)?\{"
ABSTRACT_METHOD = r"\)\s*(?:[\w<>\[\],.?\s]+\s)?(\w+)\s*\("


def text_columns(df: DataFrame) -> DataFrame:
    """Adds the text-derived columns of an inventory row."""
    raw = F.col("sqlText")
    return (
        df.withColumn("normalizedSqlText", tx.normalize_text(raw))
        .withColumn("parameterMode", tx.parameter_mode(raw))
        .withColumn("parameterNames", tx.named_params(raw))
        .withColumn(
            "parameterCount",
            first_match(
                [
                    (F.col("parameterMode") == "NAMED", F.size("parameterNames")),
                    (F.col("parameterMode") == "POSITIONAL", tx.placeholder_count(raw, "single")),
                ],
                F.size("parameterNames") + tx.placeholder_count(raw, "single"),
            ),
        )
    )


def profile_statements(*scans: DataFrame, order: str = "_pos") -> tuple[DataFrame, DataFrame]:
    """(inventory with ids, scan summary) from the rows of one or more scanners."""
    merged = union_scans(*[text_columns(s) for s in scans], order=order)
    inventory = assign_ids(merged.drop("sqlId"), order=("filePath", "lineNumber", order))
    return inventory, scan_summary(inventory)


def _unescaped(c: Column) -> Column:
    joined = F.regexp_replace(c, r'(?<!\\)"\s*\+\s*"', "")
    bare = F.substring(joined, 2, F.length(joined) - 2)
    for written, meant in ((r"\\n", "\n"), (r"\\t", "\t"), (r"\\r", "\r"), (r'\\(["\\])', "$1")):
        bare = F.regexp_replace(bare, written, meant)
    return bare


def extract_statements(files: DataFrame, path: str = "filePath", source: str = "sourceText") -> DataFrame:
    """Statements embedded in source files: annotations, native queries, template calls.

    Each file is cut before every hit, so a piece starts with one hit and its line number follows from
    the line feeds of the pieces before it. An argument that is not built from literals alone needs
    review.
    """
    pieces = F.split(F.col(source), ANY_START)
    feeds = F.transform("_pieces", lambda p: F.length(p) - F.length(F.replace(p, F.lit("\n"), F.lit(""))))
    lines = F.aggregate(
        feeds, F.array(F.lit(1)), lambda seen, n: F.concat(seen, F.array(F.element_at(seen, -1) + n))
    )
    last_method = F.transform("_pieces", lambda p: F.try_element_at(F.regexp_extract_all(p, F.lit(METHOD), F.lit(1)), F.lit(-1)))
    carried = F.aggregate(
        "_methods",
        F.array(F.lit(None).cast("string")),
        lambda seen, m: F.concat(seen, F.array(F.coalesce(m, F.element_at(seen, -1)))),
    )
    cut = (
        files.select(F.col(path).alias("filePath"), pieces.alias("_pieces"))
        .withColumn("_lines", lines)
        .withColumn("_methods", last_method)
        .withColumn("_inside", carried)
        .select("filePath", "_lines", "_inside", F.posexplode("_pieces").alias("_i", "_piece"))
    )
    kind = first_match(
        [
            (F.col("_piece").rlike(rf"^{QUERY_START}"), "SPRING_DATA_QUERY"),
            (F.col("_piece").rlike(rf"^{ENTITY_START}"), "ENTITY_MANAGER"),
            (F.col("_piece").rlike(rf"^{JDBC_START}") & (F.col("_i") > 0), "JDBC_TEMPLATE"),
        ],
        F.lit(None).cast("string"),
    )
    native = F.col("_piece").rlike(rf"^{QUERY_START}[^;{{}}]*?nativeQuery\s*=\s*true")
    found = cut.withColumn("sourceType", kind).where(
        F.col("sourceType").isNotNull() & ((F.col("sourceType") != "SPRING_DATA_QUERY") | native)
    )
    start = r"^[@\w.]+\s*\(\s*(?:nativeQuery\s*=\s*true\s*,\s*)?(?:value\s*=\s*)?"
    literals = F.regexp_extract("_piece", rf"{start}({LITERALS})\s*[,)]", 1)
    resolved = literals != ""
    file_name = F.regexp_extract("filePath", r"([^/\\]+?)\.\w+$", 1)
    return found.select(
        "filePath",
        file_name.alias("className"),
        F.coalesce(
            F.when(F.col("sourceType") == "SPRING_DATA_QUERY", F.regexp_extract("_piece", ABSTRACT_METHOD, 1)),
            F.get("_inside", F.col("_i")),
            F.lit(""),
        ).alias("methodName"),
        "sourceType",
        F.get("_lines", F.col("_i")).alias("lineNumber"),
        F.when(resolved, _unescaped(literals)).otherwise("").alias("sqlText"),
        (~resolved).alias("dynamicSql"),
        (~resolved).alias("requiresManualReview"),
        F.when(resolved, "").otherwise("UNRESOLVED_EXPRESSION").alias("manualReviewReason"),
        F.when(resolved, "HIGH").otherwise("LOW").alias("confidence"),
        F.col("_i").cast("long").alias("_pos"),
    )


def check_text(statements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(checked statements, count per state). ``parse_ok`` is an input column."""
    reviewed = F.col("reviewedSqlText") if "reviewedSqlText" in statements.columns else F.lit(None).cast("string")
    checked = (
        statements.withColumn("effectiveSqlText", tx.effective_text(reviewed, F.col("normalizedSqlText"), F.col("sqlText")))
        .withColumn("_issues", tx.text_issues(F.col("effectiveSqlText")))
        .withColumn(
            "sanityStatus",
            tx.sanity_status(
                F.col("effectiveSqlText"), F.col("sqlText"), F.col("dynamicSql"), F.col("_issues"), F.col("parse_ok")
            ),
        )
        .withColumn("parserSql", tx.to_positional(F.col("effectiveSqlText")))
        .withColumn("sanityIssues", F.array_join("_issues", "|"))
        .withColumn("recommendation", tx.sanity_advice(F.col("sanityStatus")))
        .withColumn("readiness", tx.readiness(F.col("sanityStatus")))
        .drop("_issues")
    )
    return checked, sanity_summary(checked)


def plan_bindings(statements: DataFrame, declared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(plans, bindings): each statement's status and text with ``?`` only, and its resolved parameters."""
    plans = plan_builder(statements)
    open_plans = plans.where(F.col("planStatus") == "PENDING")
    bindings = resolve_params(placeholder_rows(open_plans), declared)
    resolved = plan_status(bindings).withColumnRenamed("planStatus", "_resolved")
    finished = plans.join(resolved, "sqlId", "left").select(
        *statements.columns,
        F.coalesce(F.when(F.col("planStatus") == "PENDING", F.col("_resolved")), "planStatus").alias("planStatus"),
        "note",
        tx.parameter_mode(F.col("effectiveSql")).alias("parameterMode"),
        tx.statement_type(F.col("effectiveSql")).alias("statementType"),
        F.when(
            F.col("planStatus").isin("PENDING", "READY"), tx.to_positional(F.col("effectiveSql"))
        ).alias("jdbcSql"),
    )
    return finished, bindings
