"""Slow cases: representatives, top-N and requested ones, requests, outcomes, display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenledger.functions.chain import blank, filled, first_match, first_verdict
from evenledger.functions.identity import case_id, effective_id, group_key
from evenledger.functions.parameters import bound_type
from evenledger.functions.text import placeholder_count, select_flags
from evenledger.operators.eligibility import case_eligibility
from evenledger.operators.ranking import dedupe
from evenledger.operators.skew import lookup_join
from evenledger.sources.sink import scratch_path

REQUEST_VERSION = "v2"
TOP_SLOWEST = 20


def case_columns(df: DataFrame) -> DataFrame:
    """Adds effectiveSqlId, sqlGroupKey and rankingTimeMs (the slower side, null when neither is timed)."""
    effective = effective_id(F.col("currentSqlId"), F.col("baselineSqlId"))
    return (
        df.withColumn("effectiveSqlId", effective)
        .withColumn("sqlGroupKey", group_key(F.col("baselineKey"), F.col("effectiveSqlId")))
        .withColumn("rankingTimeMs", F.greatest("h2ObservedTimeMs", "postgresObservedTimeMs"))
    )


def representative_sample(df: DataFrame, default: int = 1, order: str = "_pos") -> DataFrame:
    """Per group the default sample, else the smallest index; ties go to the first row."""
    preferred = df.withColumn("_other", (F.col("sampleIndex") != default).cast("int"))
    return dedupe(preferred, ["sqlGroupKey"], ["_other", "sampleIndex", order]).drop("_other")


def top_slowest(representatives: DataFrame, n: int = TOP_SLOWEST) -> DataFrame:
    """The n slowest groups, ties by key: a per-partition top-n, then one merge of n rows each."""
    timed = representatives.where(F.col("rankingTimeMs").isNotNull())
    return timed.orderBy(F.desc("rankingTimeMs"), F.asc("sqlGroupKey")).limit(max(0, n))


def _listed(ids: list[str]) -> Column:
    wanted = sorted({i.strip().lower() for i in ids if i and i.strip()})
    names = ("currentSqlId", "baselineSqlId", "effectiveSqlId")
    found = F.lit(False)
    for name in names:
        found = found | F.lower(F.trim(F.coalesce(name, F.lit("")))).isin(*wanted)
    return found if wanted else F.lit(False)


def manual_include(df: DataFrame, ids: list[str]) -> DataFrame:
    return df.where(_listed(ids))


def select_cases(
    df: DataFrame,
    top: int = TOP_SLOWEST,
    default: int = 1,
    require_match: bool = True,
    include: list[str] = (),
    order: str = "_pos",
) -> DataFrame:
    """Top-N slowest groups and the requested ones, each once, with the reason. Starts the jobs that find them.

    Every selected case is a run of the timing tool, so there are few and they may be broadcast.
    """
    spark = df.sparkSession
    eligible = case_eligibility(case_columns(df), require_match).where("eligible").drop("eligible", "ineligibleReason")
    # Representatives are told by few columns; the wide rows of the selected ones alone are fetched afterwards.
    place = ["sqlGroupKey", "sampleIndex", order]
    narrow = eligible.select(*place, "rankingTimeMs", _listed(list(include)).alias("_manual"))
    chosen = representative_sample(narrow, default, order)
    # ``top`` rows at most, so this side is safe to broadcast.
    slow = top_slowest(chosen, top).select("sqlGroupKey", F.lit(True).alias("_top"))
    marked = chosen.join(F.broadcast(slow), "sqlGroupKey", "left")
    is_top = F.coalesce("_top", F.lit(False))
    reason = first_match(
        [(is_top & F.col("_manual"), "TOP_SLOWEST_AND_MANUAL_INCLUDE"), (is_top, "TOP_SLOWEST")], "MANUAL_INCLUDE"
    )
    picked = marked.where(is_top | F.col("_manual")).select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(place)], reason.alias("selectionReason"), F.col("_manual").alias("_p3"))
    picked = _kept(spark, picked, "picked")
    same = F.lit(True)
    for i, c in enumerate(place):
        same = same & F.col(c).eqNullSafe(F.col(f"_p{i}"))
    # Rows that share their place are told apart as far as the list of ids tells them.
    found = eligible.join(F.broadcast(picked), same & (_listed(list(include)) == F.col("_p3"))).drop("_p0", "_p1", "_p2", "_p3")
    selected = representative_sample(found, default, order)
    return _kept(spark, selected.select("sqlGroupKey", *[c for c in selected.columns if c != "sqlGroupKey"]), "selected")


def _kept(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The few rows of selected cases, written once for their many readers."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def attach_selected(rows: DataFrame, selected: DataFrame) -> DataFrame:
    """Every row of a group gets its group's selected sample, reason and case id."""
    chosen = selected.select(
        "sqlGroupKey",
        F.col("sampleIndex").alias("selectedSampleIndex"),
        "selectionReason",
        case_id(F.col("effectiveSqlId"), F.col("sqlGroupKey")).alias("caseId"),
    )
    return rows.join(F.broadcast(chosen), "sqlGroupKey", "left")


def case_status_row(
    rows: DataFrame, outcomes: DataFrame, require_match: bool = True, requests: DataFrame | None = None, link_base: str | None = None
) -> DataFrame:
    """One status per row: not eligible, not selected, covered by the selected sample, or the tool's outcome.

    ``rows`` comes from ``attach_selected``; ``outcomes`` has (caseId, status, reportPath, errorCode, errorMessage). A
    case whose request, of those from ``build_requests``, could not be built has no id and no outcome but that failure.
    Report links are relative to ``link_base``, the folder of the result, where it is given.
    """
    result = outcomes.select(
        "caseId",
        F.col("status").alias("_status"),
        F.col("reportPath").alias("_path"),
        F.col("errorCode").alias("_code"),
        F.col("errorMessage").alias("_error"),
    )
    joined = case_eligibility(rows, require_match).join(F.broadcast(result), "caseId", "left")
    broken = F.lit(None).cast("string")
    if requests is not None:
        failed = requests.where(F.col("requestStatus") != "READY").select("caseId", F.col("errorMessage").alias("_broken"))
        joined, broken = joined.join(F.broadcast(failed), "caseId", "left"), F.col("_broken")
    own = F.col("sampleIndex") == F.col("selectedSampleIndex")
    text = lambda c: F.coalesce(c, F.lit(""))
    verdict = first_verdict(
        ("performanceStatus", "htmlReportPath", "errorCode", "errorMessage"),
        [
            (~F.col("eligible"), ("NOT_ELIGIBLE", "", "NOT_ELIGIBLE", F.col("ineligibleReason"))),
            (F.col("caseId").isNull(), ("NOT_SELECTED", "", "", "")),
            (~own, ("COVERED_BY_SELECTED_SAMPLE", "", "", "")),
            (broken.isNotNull(), ("PARAMETER_DECODE_FAILED", "", "REQUEST_BUILD_FAILED", broken)),
            (F.col("_status").isNull(), ("TOOL_FAILED", "", "NO_OUTCOME", "")),
        ],
        (
            F.col("_status"),
            relative_link(F.col("_path"), link_base) if link_base else text(F.col("_path")),
            text(F.col("_code")),
            text(F.col("_error")),
        ),
    )
    shown = F.col("eligible")
    return joined.withColumn("_v", verdict).select(
        F.when(shown & broken.isNull(), text(F.col("caseId"))).otherwise("").alias("caseId"),
        "baselineKey",
        "baselineSqlId",
        "currentSqlId",
        "sampleIndex",
        F.when(shown, F.col("selectedSampleIndex")).alias("selectedSampleIndex"),
        F.when(shown, F.coalesce("selectionReason", F.lit("NONE"))).otherwise("NONE").alias("selectionReason"),
        "_v.*",
    )


def parameter_list(values: Column) -> Column:
    """Typed parameters of one tuple in index order, built inside the row."""
    expanded = F.flatten(
        F.transform(
            values,
            lambda v: F.transform(
                v.getField("jdbcIndexes"),
                lambda i: F.struct(
                    i.alias("jdbcIndex"),
                    v.getField("logicalParameterIndex").alias("logicalParameterIndex"),
                    v.getField("parameterName").alias("name"),
                    F.when(v.getField("value").isNull(), "NULL").otherwise(v.getField("kind")).alias("valueType"),
                    bound_type(
                        F.when(v.getField("value").isNull(), "NULL").otherwise(v.getField("kind")), v.getField("javaType")
                    ).alias("jdbcType"),
                    v.getField("value").alias("value"),
                    F.when(v.getField("kind") == "BYTES", "BASE64").alias("encoding"),
                ),
            ),
        )
    )
    return F.array_sort(expanded)


def build_requests(selected: DataFrame, values: str = "values") -> DataFrame:
    """One JSON request per selected case, or the reason why it cannot be built."""
    made = selected.withColumn("_id", case_id(F.col("effectiveSqlId"), F.col("sqlGroupKey"))).withColumn(
        "_params", parameter_list(F.col(values))
    )
    n = F.size("_params")
    indexes = F.transform("_params", lambda p: p.getField("jdbcIndex"))
    contiguous = F.when(n == 0, True).otherwise(indexes == F.sequence(F.lit(1), n))
    h2, pg = placeholder_count(F.col("h2JdbcSql")), placeholder_count(F.col("postgresJdbcSql"))
    differs = lambda name, count: F.concat(
        F.lit(f"{name} placeholder count "), count.cast("string"), F.lit(" differs from parameter count "), n.cast("string")
    )
    error = first_match(
        [
            (~contiguous, "JDBC parameter indexes must be unique and contiguous from 1."),
            (h2 != n, differs("H2", h2)),
            (pg != n, differs("PostgreSQL", pg)),
        ],
        F.lit(None).cast("string"),
    )
    body = F.struct(
        F.lit(REQUEST_VERSION).alias("requestVersion"),
        F.col("_id").alias("caseId"),
        F.col("effectiveSqlId").alias("sqlId"),
        "baselineKey",
        "sampleIndex",
        "h2JdbcSql",
        "postgresJdbcSql",
        F.col("_params").alias("parameters"),
        F.lit(True).alias("resultMatchedBeforePerformanceTest"),
        F.lit("index.html").alias("outputFileName"),
    )
    return made.withColumn("_error", error).select(
        F.col("_id").alias("caseId"),
        "sqlGroupKey",
        "sampleIndex",
        F.when(F.col("_error").isNull(), "READY").otherwise("PARAMETER_DECODE_FAILED").alias("requestStatus"),
        F.coalesce("_error", F.lit("")).alias("errorMessage"),
        n.alias("parameterCount"),
        F.when(F.col("_error").isNull(), F.to_json(body)).alias("request"),
    )


REQUEST_SCHEMA = (
    "requestVersion string, caseId string, sqlId string, baselineKey string, sampleIndex int, h2JdbcSql string,"
    " postgresJdbcSql string, parameters array<struct<jdbcIndex:int,logicalParameterIndex:int,name:string,"
    "valueType:string,jdbcType:string,value:string,encoding:string>>,"
    " resultMatchedBeforePerformanceTest boolean, outputFileName string"
)


def validate_requests(df: DataFrame) -> DataFrame:
    """Thirteen checks of a request before it may run; adds requestStatus and failedCheck."""
    c = F.col
    params = F.coalesce("parameters", F.array())
    n = F.size(params)
    sides = ("_h2", "_pg")
    all_of = lambda test: test(sides[0]) & test(sides[1])
    read_only = lambda side: c(f"{side}.select") & ~c(f"{side}.unsafe")
    single = lambda side: ~c(f"{side}.multi")
    writes = r"(?i)\b(?:update|delete|insert|merge|create|alter|drop|truncate|grant|revoke)\b"
    indexes = F.transform(params, lambda p: p.getField("jdbcIndex"))
    rules = [
        (F.coalesce(c("requestVersion") != REQUEST_VERSION, F.lit(True)), "REQUEST_VERSION"),
        (blank(c("caseId")), "CASE_ID"),
        (blank(c("h2JdbcSql")) | blank(c("postgresJdbcSql")), "SQL_MISSING"),
        (~all_of(read_only), "NOT_READ_ONLY_SELECT"),
        (~all_of(single), "MULTIPLE_STATEMENTS"),
        (
            F.regexp_replace(F.concat_ws(" ", "h2JdbcSql", "postgresJdbcSql"), r"'[^']*'", "").rlike(writes),
            "WRITE_STATEMENT",
        ),
        (F.size(F.array_distinct(indexes)) != n, "DUPLICATE_INDEX"),
        ((n > 0) & (F.array_min(indexes) != 1), "INDEX_START"),
        (placeholder_count(c("h2JdbcSql")) != n, "H2_PLACEHOLDER_COUNT"),
        (placeholder_count(c("postgresJdbcSql")) != n, "POSTGRES_PLACEHOLDER_COUNT"),
        (
            F.exists(params, lambda p: (p.getField("valueType") == "NULL") & blank(p.getField("jdbcType"))),
            "NULL_WITHOUT_TYPE",
        ),
        (
            F.exists(
                params,
                lambda p: (p.getField("valueType") == "BYTES")
                & (F.coalesce(p.getField("encoding"), F.lit("")) != "BASE64"),
            ),
            "BYTES_ENCODING",
        ),
        (~F.coalesce(c("resultMatchedBeforePerformanceTest"), F.lit(False)), "RESULT_NOT_MATCHED"),
    ]
    inspected = df.withColumn("_h2", select_flags(c("h2JdbcSql"))).withColumn("_pg", select_flags(c("postgresJdbcSql")))
    return inspected.withColumn("failedCheck", first_match(rules, "")).drop("_h2", "_pg").withColumn(
        "requestStatus", F.when(F.col("failedCheck") == "", "READY").otherwise("INVALID_REQUEST")
    )


def safe_link(path: Column) -> Column:
    """The report link stays inside its own folder."""
    return filled(path) & ~path.rlike(r"^(?:/|\\|[A-Za-z]:)|(?:^|[/\\])\.\.(?:[/\\]|$)")


def classify_outcome(requests: DataFrame, results: DataFrame, report_folder: str | None = None, timeout_s: int | None = None) -> DataFrame:
    """Status of each requested case from the tool's result rows.

    ``results`` has (caseId, resultCaseId, resultVersion, resultStatus, timedOut, exitCode, reportPath, reportExists,
    errorCode, errorMessage): caseId is the folder the result was found in, the rest is what it says. A result counts as
    a success only if both the tool's exit code and its own status say so; without ``resultStatus`` the exit code
    decides. An error without a code or a message gets the status or the exit code instead. With ``report_folder`` the
    path of a report is below the case's folder in it.
    """
    given = results.withColumn("_found", F.lit(True))
    if "resultStatus" not in results.columns:
        given = given.withColumn("resultStatus", F.when(F.coalesce("exitCode", F.lit(1)) == 0, "SUCCESS").otherwise("INTERNAL_ERROR"))
    joined = lookup_join(requests.select("caseId"), given, ["caseId"])
    says_other = (F.coalesce("resultVersion", F.lit("")) != REQUEST_VERSION) | (
        F.coalesce("resultCaseId", F.lit("")) != F.col("caseId")
    )
    text = lambda name: F.coalesce(name, F.lit(""))
    said = F.coalesce("resultStatus", F.lit("INTERNAL_ERROR"))
    or_else = lambda name, other: F.when(filled(F.col(name)), F.col(name)).otherwise(other)
    exit_code = F.coalesce(F.col("exitCode").cast("string"), F.lit("unknown"))
    failed = (F.coalesce("exitCode", F.lit(1)) != 0) | (said != "SUCCESS")
    code = or_else("errorCode", said)
    message = or_else("errorMessage", F.concat(F.lit("Performance tool exit code: "), exit_code))
    too_long = text("errorMessage") if timeout_s is None else F.lit(f"Performance tool exceeded {timeout_s} seconds.")
    path = F.concat(F.lit(report_folder.rstrip("/") + "/"), "caseId", F.lit("/"), "reportPath") if report_folder else F.col("reportPath")
    # Status, code and message of each outcome.
    verdict = first_verdict(
        ("status", "reportPath", "errorCode", "errorMessage"),
        [
            (F.coalesce("timedOut", F.lit(False)), ("TIMEOUT", "", "TIMEOUT", too_long)),
            (F.col("_found").isNull(), ("RESULT_JSON_INVALID", "", "RESULT_JSON_MISSING", "result.json is missing or invalid.")),
            (
                says_other,
                ("RESULT_JSON_INVALID", "", "RESULT_JSON_CONTRACT_MISMATCH", "responseVersion or caseId does not match the request."),
            ),
            (failed & (said == "TIMEOUT"), ("TIMEOUT", "", code, message)),
            (failed, ("TOOL_FAILED", "", code, message)),
            (blank(F.col("reportPath")), ("TOOL_FAILED", "", "VALIDATOR_INVOCATION_ERROR", "htmlReport is empty.")),
            (
                ~safe_link(F.col("reportPath")),
                ("TOOL_FAILED", "", "VALIDATOR_INVOCATION_ERROR", "htmlReport escapes the output directory."),
            ),
            (
                ~F.coalesce("reportExists", F.lit(False)),
                ("REPORT_MISSING", "", "HTML_REPORT_MISSING", "The tool returned SUCCESS but the HTML report does not exist."),
            ),
        ],
        ("SUCCESS", path, "", ""),
    )
    return joined.withColumn("_v", verdict).select("caseId", "_v.*")


def relative_link(path: Column, base: str) -> Column:
    """Report path relative to the folder of the result file, with forward slashes."""
    slashed = F.replace(F.coalesce(path, F.lit("")), F.lit("\\"), F.lit("/"))
    stem = base.replace("\\", "/").rstrip("/") + "/"
    return F.when(slashed.startswith(stem), F.substring(slashed, len(stem) + 1, 1_000_000)).otherwise(slashed)


def attach_case_status(rows: DataFrame, cases: DataFrame, order: str = "_pos") -> DataFrame:
    """Rows with their case record on (baselineKey, sampleIndex); the last record wins."""
    last = dedupe(cases, ["baselineKey", "sampleIndex"], [order], keep="last").select(
        "baselineKey", "sampleIndex", "performanceStatus", "selectedSampleIndex", "htmlReportPath"
    )
    return lookup_join(rows, last, ["baselineKey", "sampleIndex"])


# Case status, label shown in the report.
STATUS_LABELS = {
    "SUCCESS": "Open Performance Report",
    "NOT_SELECTED": "Not Selected",
    "NOT_ELIGIBLE": "Not Eligible",
    "PARAMETER_DECODE_FAILED": "Parameter Decode Failed",
    "TIMEOUT": "Timeout",
    "REPORT_MISSING": "Report Missing",
    "RESULT_JSON_INVALID": "Invalid Result JSON",
    "TOOL_FAILED": "Report Generation Failed",
}


def performance_display(df: DataFrame) -> DataFrame:
    """Adds performanceReport (what the report cell says) and performanceLink."""
    upper = lambda c: F.upper(F.coalesce(F.col(c), F.lit("")))
    waiting = upper("postgresExecutionStatus").rlike("PENDING|NOT_READY") | upper("sampleComparisonStatus").rlike(
        "PENDING|NOT_READY"
    )
    covered = F.concat(F.lit("Covered by Sample "), F.col("selectedSampleIndex").cast("string"))
    rules = [
        (waiting, "Pending Migration"),
        (upper("postgresExecutionStatus") != "SUCCESS", "Not Eligible"),
        (upper("sampleComparisonStatus") != "MATCH", "Result Mismatch"),
        (F.col("performanceStatus").isNull(), "Not Generated"),
        (F.col("performanceStatus") == "COVERED_BY_SELECTED_SAMPLE", covered),
    ]
    rules += [(F.col("performanceStatus") == k, v) for k, v in STATUS_LABELS.items()]
    shown = df.withColumn("performanceReport", first_match(rules, ""))
    opens = F.col("performanceReport") == STATUS_LABELS["SUCCESS"]
    return shown.withColumn("performanceLink", F.when(opens, F.coalesce("htmlReportPath", F.lit(""))).otherwise(""))

