"""Report jobs: issues, slow cases, cross-database rows, document paths, feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenledger.operators.bindings import parameter_summary
from evenledger.operators.cases import (
    TOP_SLOWEST,
    attach_case_status,
    attach_selected,
    build_requests,
    case_columns,
    case_status_row,
    performance_display,
    select_cases,
)
from evenledger.operators.feeds import observation_columns
from evenledger.operators.issues import classify_issue, detail_report, issue_kpis, issue_summary, join_issue_inputs
from evenledger.operators.paths import json_leaf_paths, path_inventory, xml_leaf_paths
from evenledger.operators.skew import lookup_join
from evenledger.sources.contracts import CROSSDB_LONG, CROSSDB_SHORT


def issue_report(executions: DataFrame, statements: DataFrame, bindings: DataFrame) -> dict[str, DataFrame]:
    """Summary, detail and key figures of a validation run.

    Classified rows feed all three, so they are persisted; unpersist ``classified`` when done. The
    parameter text of a statement holds all its bindings.
    """
    classified = classify_issue(join_issue_inputs(executions, statements, bindings)).persist()
    parts = F.array_sort(F.collect_list(F.struct("part", "parameterSummary")))
    labels = parameter_summary(bindings).groupBy("sqlId").agg(
        F.array_join(F.transform(parts, lambda p: p.getField("parameterSummary")), "; ").alias("parameterSummary")
    )
    detail = lookup_join(detail_report(classified), labels, ["sqlId"]).withColumn(
        "parameterSummary", F.coalesce("parameterSummary", F.lit("No parameters"))
    )
    return {
        "summary": issue_summary(classified),
        "detail": detail,
        "kpis": issue_kpis(classified),
        "classified": classified,
    }


def select_slow_cases(
    rows: DataFrame,
    outcomes: DataFrame,
    top: int = TOP_SLOWEST,
    default: int = 1,
    require_match: bool = True,
    include: list[str] = (),
    order: str = "_pos",
    link_base: str | None = None,
) -> dict[str, DataFrame]:
    """Selected cases, their requests and one status per input row; requests that cannot be built decide the status of theirs."""
    keyed = case_columns(rows)
    selected = select_cases(rows, top, default, require_match, include, order)
    made = {"selected": selected}
    if "values" in rows.columns:
        made["requests"] = build_requests(selected)
    made["status"] = case_status_row(attach_selected(keyed, selected), outcomes, require_match, made.get("requests"), link_base)
    return made


def crossdb_report(rows: DataFrame, cases: DataFrame | None, long_form: bool = False) -> DataFrame:
    """Cross-database rows with what the report says about their timing; 11 or 27 columns."""
    if cases is None:
        empty = rows.withColumn("performanceStatus", F.lit(None).cast("string"))
        joined = empty.withColumn("selectedSampleIndex", F.lit(None).cast("int")).withColumn(
            "htmlReportPath", F.lit(None).cast("string")
        )
    else:
        joined = attach_case_status(rows, cases)
    shown = performance_display(joined)
    return shown.select(*(CROSSDB_LONG if long_form else CROSSDB_SHORT), *([] if long_form else ["performanceLink"]))


def json_path_inventory(docs: DataFrame, doc_id: str, column: str, **options) -> DataFrame:
    return path_inventory(json_leaf_paths(docs, doc_id, column, **options))


def xml_path_inventory(docs: DataFrame, doc_id: str, column: str, **options) -> DataFrame:
    return path_inventory(xml_leaf_paths(docs, doc_id, column, **options))


def flatten_observations(feed: DataFrame, body: str = "body", city: str = "city", zone: str = "+08:00") -> DataFrame:
    return observation_columns(feed, body, city, zone)
