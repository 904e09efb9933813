"""Running recorded statements on one side and summarising what they return."""

from __future__ import annotations

import base64
import threading
import time
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, as_completed, wait
from datetime import date, datetime
from decimal import Decimal

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenledger.functions.canonical import UnsupportedResultType, normalization_version
from evenledger.operators.results import summarize_result
from evenledger.sources.sink import scratch_path

SUMMARY_SCHEMA = (
    "sqlId string, sampleIndex int, status string, rowCount bigint, resultHash string, columnSignature string,"
    " executionTimeMs bigint, errorMessage string, sqlState string"
)
JOURNAL_SCHEMA = SUMMARY_SCHEMA + ", caseHash string"
CASE_KEY = ("sqlId", "sampleIndex", "caseHash")

# How the text of each parameter kind becomes a literal.
READERS = {
    "STRING": str,
    "UUID": str,
    "TIME": str,
    "INTEGER": int,
    "LONG": int,
    "BIG_INTEGER": Decimal,
    "DECIMAL": Decimal,
    "DOUBLE": float,
    "BOOLEAN": lambda t: t.lower() == "true",
    "DATE": date.fromisoformat,
    "TIMESTAMP": datetime.fromisoformat,
    "OFFSET_DATE_TIME": datetime.fromisoformat,
    "INSTANT": datetime.fromisoformat,
    "BYTES": base64.b64decode,
}


def literal(kind: str, value: str | None):
    return None if value is None or kind == "NULL" else READERS[kind](value)


def arguments(values) -> list:
    """Positional arguments of a tuple column value: one per database index, in index order."""
    placed = {i: literal(v["kind"], v["value"]) for v in values or [] for i in v["jdbcIndexes"]}
    if sorted(placed) != list(range(1, len(placed) + 1)):
        raise ValueError("JDBC parameter indexes must be unique and contiguous from 1")
    return [placed[i] for i in sorted(placed)]


def view_side(session: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Register one side's tables. Use one ``newSession()`` per side: both sides share table names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def nodes_of(plan) -> list:
    """All nodes of a JVM plan, root first."""
    children = plan.children()
    return [plan] + [n for i in range(children.size()) for n in nodes_of(children.apply(i))]


def changes_something(session: SparkSession, text: str) -> bool:
    """Whether the parsed text holds a command (insert, create, set and the like) instead of being a query alone."""
    plan = session._jsparkSession.sessionState().sqlParser().parsePlan(text)
    logical = "org.apache.spark.sql.catalyst.plans.logical."
    load = session._jvm.org.apache.spark.util.Utils.classForName
    kinds = [load(logical + name, True, False) for name in ("Command", "ParsedStatement")]
    return any(kind.isInstance(node) for node in nodes_of(plan) for kind in kinds)


def delivers_order(result: DataFrame) -> bool:
    """Whether a sort decides the order of the rows: it is the plan's root, under limits and projections."""
    plan = result._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "GlobalLimit", "LocalLimit", "SubqueryAlias", "Offset", "WithCTE", "Tail"):
        children = plan.children()
        plan = children.apply(0)
    return plan.nodeName() == "Sort"


def run_one(session: SparkSession, text: str, args: list, max_rows: int | None, timeout_s: float | None, ordered: bool, scale: int | None = None) -> dict:
    """Summary of one statement; an error becomes a status, never an exception. Only queries are run.

    Rows are compared in the order of delivery where the statement sorts them, or where ``ordered`` says so.
    """
    started = time.monotonic()
    tag = f"replay-{uuid.uuid4().hex}"
    context = session.sparkContext
    timer = threading.Timer(timeout_s, context.cancelJobsWithTag, [tag]) if timeout_s else None
    context.addJobTag(tag)
    try:
        if timer:
            timer.start()
        if changes_something(session, text):
            return {**_failure("NOT_EXECUTED", "The statement is not a query.", None), "executionTimeMs": None}
        result = session.sql(text, args=args) if args else session.sql(text)
        ordered = ordered or delivers_order(result)
        found = summarize_result(result, max_rows=max_rows, as_delivered=ordered, scale=scale).first().asDict()
        if found["status"] == "RESULT_TOO_LARGE":
            found.update(resultHash="", errorMessage=f"Result contains more than {max_rows} rows.")
        outcome = {"errorMessage": "", "sqlState": None, **found}
    except UnsupportedResultType as unsupported:
        outcome = _failure("UNSUPPORTED_RESULT_TYPE", str(unsupported), None)
    except PySparkException as failed:
        outcome = _failure("EXECUTION_FAILED", str(failed).split("\n")[0], failed.getSqlState())
    except Exception as failed:  # noqa: BLE001 - one bad statement must not stop the batch
        outcome = _failure("EXECUTION_FAILED", str(failed).split("\n")[0], None)
    finally:
        if timer:
            timer.cancel()
        context.removeJobTag(tag)
    return {**outcome, "executionTimeMs": int((time.monotonic() - started) * 1000)}


def _failure(status: str, message: str, state: str | None) -> dict:
    return {
        "status": status, "rowCount": None, "resultHash": "", "columnSignature": "",
        "errorMessage": message, "sqlState": state,
    }


def run_case(
    session: SparkSession, case, max_rows: int | None = None, timeout_s: float | None = None, scale: int | None = None
) -> dict:
    """The summary of one case: sqlId, sampleIndex, jdbcSql, values (tuple column) and, optionally, ordered."""
    case = case.asDict(recursive=True) if hasattr(case, "asDict") else case
    identity = {k: case[k] for k in CASE_KEY if k in case}
    try:
        args = arguments(case.get("values"))
    except (ValueError, KeyError, ArithmeticError) as broken:
        return {**identity, **_failure("NOT_EXECUTED", f"Saved parameterValues could not be decoded: {broken}", None), "executionTimeMs": None}
    return {**identity, **run_one(session, case["jdbcSql"], args, max_rows, timeout_s, bool(case.get("ordered")), scale)}


def replay_rows(
    session: SparkSession, cases: Iterable, max_rows: int | None = None, timeout_s: float | None = None, scale: int | None = None,
    workers: int = 1,
) -> Iterator[dict]:
    """One summary per case; each statement runs distributed.

    Up to ``workers`` statements run at once, as many more wait; summaries come in order with one worker and as they
    are ready with several.
    """
    if workers == 1:
        for case in cases:
            yield run_case(session, case, max_rows, timeout_s, scale)
        return
    with ThreadPoolExecutor(workers) as pool:
        running: set[Future] = set()
        for case in cases:
            if len(running) >= 2 * workers:
                ready, running = wait(running, return_when=FIRST_COMPLETED)
                yield from (f.result() for f in ready)
            running.add(pool.submit(run_case, session, case, max_rows, timeout_s, scale))
        yield from (f.result() for f in as_completed(running))


def with_case_hash(cases: DataFrame, max_rows: int | None, scale: int | None) -> DataFrame:
    """``caseHash``: what is run and how, so that a changed statement, value or cap is another case."""
    parts = ["jdbcSql", *(F.to_json(c) if c == "values" else F.col(c).cast("string") for c in ("values", "ordered") if c in cases.columns)]
    how = F.lit(normalization_version(max_rows, scale) + f"-{max_rows}")
    return cases.withColumn("caseHash", F.sha2(F.to_json(F.array(how, *parts)), 256))


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """Summaries written so far, one for each case; empty where there is no journal."""
    try:
        kept = spark.read.schema(JOURNAL_SCHEMA).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], JOURNAL_SCHEMA)
    return kept.dropDuplicates(list(CASE_KEY))


def _without(cases: DataFrame, done: DataFrame, how: str) -> DataFrame:
    keys = done.select(*[F.col(c).alias(f"_{c}") for c in CASE_KEY])
    met = F.lit(True)
    for c in CASE_KEY:
        met = met & cases[c].eqNullSafe(keys[f"_{c}"])
    return cases.join(keys, met, how)


def replay(
    spark: SparkSession,
    side: SparkSession,
    cases: DataFrame,
    max_rows: int | None = None,
    timeout_s: float | None = None,
    batch: int = 200,
    scale: int | None = None,
    workers: int = 4,
    journal: str | None = None,
) -> DataFrame:
    """Summaries of every case as a DataFrame of ``spark``. Starts one job per case, ``workers`` at once.

    Cases are streamed to the driver, which has to plan each statement anyway; results never are, only their one-row
    summaries, and of those at most ``batch`` are held before they are added to the journal, a folder of Parquet files.
    A run that was stopped goes on where its ``journal`` ends: cases that are in it, unchanged, are not run again.
    Without a name the journal is a new scratch folder.
    """
    path = journal or scratch_path(spark, "journal")
    keyed = with_case_hash(cases, max_rows, scale)
    todo = _without(keyed, read_journal(spark, path), "left_anti") if journal else keyed
    pending: list[dict] = []

    def write():
        if pending:
            spark.createDataFrame(pending, JOURNAL_SCHEMA).coalesce(1).write.mode("append").parquet(path)
            pending.clear()

    try:
        for row in replay_rows(side, todo.toLocalIterator(prefetchPartitions=True), max_rows, timeout_s, scale, workers):
            pending.append(row)
            if len(pending) == batch:
                write()
    finally:
        write()
    found = read_journal(spark, path)
    return (_without(found, keyed, "left_semi") if journal else found).drop("caseHash")


def pending_side(cases: DataFrame) -> DataFrame:
    """The summary of a side that has not been migrated yet."""
    return cases.selectExpr(
        "sqlId", "sampleIndex", "'PENDING_SQL_MIGRATION' as status", "cast(null as bigint) as rowCount",
        "'' as resultHash", "'' as columnSignature", "cast(null as bigint) as executionTimeMs",
        "'' as errorMessage", "cast(null as string) as sqlState",
    )
