"""Text columns over the derived statements, all documents and all conversation turns."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenledger.catalog.derive import (
    CORPUS_SQL,
    STATEMENTS_SQL,
    corpus,
    pick,
    sql_normalized,
    sql_text,
    statements,
)
from evenledger.catalog.registry import query, table
from evenledger.functions import text as tx

q = sql_text
STRING_RE = q(r"'[^']*(?:'|\z)")
MASK_RE = q(tx.QUOTED_OR_COMMENT)
LEAD_RE = q(tx.LEADING_COMMENTS)
BODY = f"lower(regexp_replace(text, {LEAD_RE}, ''))"
PLACEHOLDERS_FULL = f"length(regexp_replace(regexp_replace(text, {MASK_RE}, '', 'g'), '[^?]', '', 'g'))"
PLACEHOLDERS_SINGLE = f"length(regexp_replace(regexp_replace(text, {STRING_RE}, '', 'g'), '[^?]', '', 'g'))"
NAMES_ALL = r"regexp_extract_all(regexp_replace(text, ':{2,}', ' ', 'g'), ':([A-Za-z][A-Za-z0-9_]*)', 1)"


def ordered_distinct(items: str) -> str:
    """First occurrences of a list's items, in order."""
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


def column(name: str, fn, sql: str, out: str = "value"):
    """Register a text column over the corpus."""

    @query(name, f"WITH {CORPUS_SQL} SELECT id, {sql} AS {out} FROM corpus")
    def run(spark, sf_dir):
        return corpus(spark, sf_dir).select("id", fn(F.col("text")).alias(out))


column("normalize_text", tx.normalize_text, sql_normalized("text"))
CANONICAL = f"trim(regexp_replace({sql_normalized('text')}, ';+\\z', ''))"
column("canonicalize_text", tx.canonicalize_text, CANONICAL)

TYPE_CASE = f"""CASE
  WHEN regexp_matches({BODY}, '^select\\b') AND regexp_matches({BODY}, {q(tx.RISKY_SELECT)}) THEN 'RISKY_SELECT'
  WHEN regexp_matches({BODY}, '^select\\b') THEN 'SELECT'
  WHEN regexp_matches({BODY}, '^insert\\b') THEN 'INSERT'
  WHEN regexp_matches({BODY}, '^update\\b') THEN 'UPDATE'
  WHEN regexp_matches({BODY}, '^delete\\b') THEN 'DELETE'
  WHEN regexp_matches({BODY}, '^merge\\b') THEN 'MERGE'
  WHEN regexp_matches({BODY}, '^call\\b') THEN 'CALL'
  WHEN regexp_matches({BODY}, '^truncate\\b') THEN 'TRUNCATE'
  WHEN regexp_matches({BODY}, '^(create|alter|drop|comment|grant|revoke)\\s') THEN 'DDL'
  ELSE 'UNKNOWN' END"""
TWO_WAY = f"CASE WHEN regexp_matches({BODY}, '^(select|with)\\b') THEN 'SELECT' ELSE 'UNKNOWN' END"


def literal_case(value: str, mapping: dict[str, str], default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {value} {arms} ELSE {default} END"


@query(
    "statement_type",
    f"WITH {CORPUS_SQL}, typed AS (SELECT id, {TYPE_CASE} AS t FROM corpus) "
    f"SELECT id, t AS statement_type, {literal_case('t', tx.TYPE_HANDLING)} AS handling FROM typed",
)
def _statement_type(spark, sf_dir):
    typed = corpus(spark, sf_dir).select("id", tx.statement_type(F.col("text")).alias("statement_type"))
    return typed.withColumn("handling", tx.type_handling(F.col("statement_type")))


column("statement_type_two_way", lambda c: tx.statement_type(c, "select"), TWO_WAY)
column("placeholder_count", tx.placeholder_count, PLACEHOLDERS_FULL)
column("placeholder_count_quote_only", lambda c: tx.placeholder_count(c, "single"), PLACEHOLDERS_SINGLE)
column("named_params", lambda c: F.array_join(tx.named_params(c), ","), f"array_to_string({ordered_distinct(NAMES_ALL)}, ',')")
MODE = f"""CASE WHEN len({NAMES_ALL}) > 0 AND {PLACEHOLDERS_SINGLE} > 0 THEN 'MIXED'
  WHEN len({NAMES_ALL}) > 0 THEN 'NAMED' WHEN {PLACEHOLDERS_SINGLE} > 0 THEN 'POSITIONAL' ELSE 'NONE' END"""
column("parameter_mode", tx.parameter_mode, MODE)


def flags_case(text: str, mask: str) -> str:
    lead = f"lower(regexp_replace(trim({text}), {LEAD_RE}, ''))"
    masked = f"regexp_replace(trim({text}), {mask}, '', 'g')"
    return f"""CASE WHEN NOT regexp_matches({lead}, '^(select|with)\\b') THEN 'NOT_SELECT'
  WHEN regexp_matches({masked}, ';\\s*\\S') THEN 'MULTIPLE_STATEMENTS'
  WHEN regexp_matches({text}, {q(tx.DYNAMIC_IDENTIFIER)}) THEN 'DYNAMIC_IDENTIFIER'
  WHEN regexp_matches({text}, {q(tx.UNSAFE)}) THEN 'UNSAFE_SELECT'
  WHEN regexp_matches({text}, {q(tx.UNSTABLE)}) THEN 'NON_DETERMINISTIC_SELECT' ELSE 'SAFE_SELECT' END"""


@query(
    "select_flags",
    f"""WITH {CORPUS_SQL}, f AS (SELECT id, {flags_case('text', MASK_RE)} AS r FROM corpus)
    SELECT id, r AS reason_code, r <> 'NOT_SELECT' AS "select", r = 'MULTIPLE_STATEMENTS' AS multi,
      r = 'DYNAMIC_IDENTIFIER' AS dynamic_identifier, r = 'UNSAFE_SELECT' AS unsafe,
      r = 'NON_DETERMINISTIC_SELECT' AS non_deterministic, {literal_case('r', tx.SELECT_REASONS)} AS reason FROM f""",
)
def _select_flags(spark, sf_dir):
    return corpus(spark, sf_dir).select("id", tx.select_flags(F.col("text")).alias("f")).select("id", "f.*")


QUOTES_ONLY_RE = q(r"""'[^']*(?:'|\z)|"[^"]*(?:"|\z)""")
column(
    "select_flags_comments_seen",
    lambda c: tx.select_flags(c, mask_comments=False).getField("reason_code"),
    flags_case("text", QUOTES_ONLY_RE),
)

# Doubled colons are casts: they are parked on a control character while names are replaced.
PARK = r"replace(text, '::', chr(1))"
POSITIONAL_SQL = r"""replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(""" + PARK + r"""),
  '(?i)\bin\s+:([A-Za-z][A-Za-z0-9_]*)', 'IN (:\1)', 'g'), ';\s*\z', ''), ':([A-Za-z][A-Za-z0-9_]*)', '?', 'g'),
  """ + q(r"('[^']*(?:'|\z))|(\?)[0-9]+") + r""", '\1\2', 'g'), chr(1), '::')"""
column("to_positional", tx.to_positional, POSITIONAL_SQL)

ODD_SINGLE = "length(regexp_replace(replace(text, '''''', ''), '[^'']', '', 'g')) % 2 = 1"
ODD_DOUBLE = "length(regexp_replace(text, '[^\"]', '', 'g')) % 2 = 1"
ISSUES_SQL = f"""CASE WHEN trim(text) = '' THEN 'EMPTY_SQL' ELSE array_to_string(list_filter([
  CASE WHEN contains(text, '\\n') THEN 'LITERAL_BACKSLASH_N' END, CASE WHEN contains(text, '\\r') THEN 'LITERAL_BACKSLASH_R' END,
  CASE WHEN contains(text, '\\t') THEN 'LITERAL_BACKSLASH_T' END, CASE WHEN contains(text, '\\s') THEN 'LITERAL_BACKSLASH_S' END,
  CASE WHEN contains(text, '" +') OR contains(text, '+ "') OR contains(text, ''' +') OR contains(text, '+ ''')
    THEN 'JAVA_CONCAT_REMAINDER' END,
  CASE WHEN contains(text, '.append(') OR contains(text, 'StringBuilder') THEN 'JAVA_APPEND_REMAINDER' END,
  CASE WHEN contains(text, '//') THEN 'JAVA_LINE_COMMENT_OR_URL' END,
  CASE WHEN contains(text, '/*') OR contains(text, '*/') THEN 'SQL_OR_JAVA_BLOCK_COMMENT' END,
  CASE WHEN {ODD_SINGLE} THEN 'UNBALANCED_SINGLE_QUOTE' END,
  CASE WHEN {ODD_DOUBLE} THEN 'SUSPICIOUS_DOUBLE_QUOTE' END], lambda x: x IS NOT NULL), '|') END"""
column("text_issues", lambda c: F.array_join(tx.text_issues(c), "|"), ISSUES_SQL)


def signals_sql(text: str) -> str:
    body = f"lower({text})"
    has = lambda *parts: " OR ".join(f"contains({body}, {q(p)})" for p in parts)
    arms = [f"CASE WHEN {has(*parts)} THEN {q(label)} END" for parts, label in tx.DIALECT_SIGNALS]
    arms.append(f"CASE WHEN {alias_in_set(body)} THEN 'UPDATE SET alias.column' END")
    arms.append(f"CASE WHEN {has('merge into')} THEN 'MERGE' END")
    arms.append(f"CASE WHEN regexp_matches({body}, {q(tx.ANY_PARAMETER)}) THEN 'PARAMETERIZED SQL' END")
    return f"array_to_string(list_filter([{', '.join(arms)}], lambda x: x IS NOT NULL), '; ')"


def alias_in_set(body: str) -> str:
    """RE2 has no back references: the two names are taken out and compared."""
    shape = r'\bupdate\s+[\w.$"]+\s+(?:as\s+)?([a-z_][\w$]*)\s+set\s+([a-z_][\w$]*)\.[a-z_][\w$]*\s*='
    return (
        f"(regexp_extract({body}, {q(shape)}, 1) <> '' AND "
        f"regexp_extract({body}, {q(shape)}, 1) = regexp_extract({body}, {q(shape)}, 2))"
    )


column("text_signals", tx.text_signals, signals_sql("text"))

SEQ = r"(?i)\bselect\s+(\w+)\.nextval\s+from\s+dual\b"
REWRITE = (
    f"CASE WHEN regexp_matches(text, {q(SEQ)}) THEN regexp_replace(text, {q(SEQ)}, "
    f"'SELECT nextval(''' || lower(regexp_extract(text, {q(SEQ)}, 1)) || ''')', 'g') ELSE text END"
)
for _pattern, _with in (
    (r"(?i)\bnvl\s*\(", "COALESCE("),
    (r"(?i)\bsysdate\b", "CURRENT_TIMESTAMP"),
    (r"(?i)\bsystimestamp\b", "CURRENT_TIMESTAMP"),
    (r"(?i)\s+where\s+rownum\s*<=\s*(\d+)\s*;?\s*\z", r" LIMIT \1"),
):
    REWRITE = f"regexp_replace({REWRITE}, {q(_pattern)}, {q(_with)}, 'g')"


@query(
    "rewrite_candidate",
    f"""WITH {CORPUS_SQL}, r AS (SELECT id, text, {REWRITE} AS c FROM corpus)
    SELECT id, c AS candidate, c <> text AS changed,
      regexp_matches(c, '(?i)\\brownum\\b|\\bto_date\\s*\\(|\\bto_timestamp\\s*\\(|\\.nextval\\b') AS review FROM r""",
)
def _rewrite(spark, sf_dir):
    return corpus(spark, sf_dir).select("id", tx.rewrite_candidate(F.col("text")).alias("r")).select("id", "r.*")


@query(
    "placeholders",
    f"""WITH {CORPUS_SQL}, m AS (
      SELECT id, regexp_extract_all(regexp_replace(regexp_replace(text, {STRING_RE}, '', 'g'), ':{{2,}}', chr(1), 'g'),
        ':[A-Za-z_$][A-Za-z0-9_$]*|\\?[0-9]*') AS marks FROM corpus),
    e AS (SELECT id, unnest(marks) AS mark, generate_subscripts(marks, 1) AS occurrence FROM m)
    SELECT id, occurrence, mark AS text,
      CASE WHEN mark LIKE ':%' THEN 'NAMED' WHEN length(mark) > 1 THEN 'JPA_INDEXED_POSITIONAL' ELSE 'JDBC_ORDINAL_POSITIONAL' END AS kind,
      CASE WHEN mark LIKE ':%' THEN substr(mark, 2) END AS name,
      CASE WHEN mark NOT LIKE ':%' AND length(mark) > 1 THEN cast(try_cast(substr(mark, 2) as int) as varchar) END AS idx
    FROM e""",
)
def _placeholders(spark, sf_dir):
    marks = corpus(spark, sf_dir).select("id", F.explode(tx.placeholders(F.col("text"))).alias("p"))
    return marks.select("id", "p.occurrence", "p.text", "p.kind", "p.name", F.col("p.index").cast("string").alias("idx"))


@query(
    "effective_text",
    f"""WITH {STATEMENTS_SQL} SELECT "sqlId",
      coalesce(CASE WHEN trim("manualReviewReason") <> '' THEN "manualReviewReason" END,
        CASE WHEN trim("normalizedSqlText") <> '' THEN "normalizedSqlText" END,
        CASE WHEN trim("sqlText") <> '' THEN "sqlText" END, '') AS effective FROM statements""",
)
def _effective(spark, sf_dir):
    return statements(spark, sf_dir).select(
        "sqlId",
        tx.effective_text(F.col("manualReviewReason"), F.col("normalizedSqlText"), F.col("sqlText")).alias("effective"),
    )


SANITY_STATUS_SQL = """CASE WHEN trim(effective) = '' THEN 'SKIPPED_EMPTY_SQL'
      WHEN "dynamicSql" AND trim("sqlText") = '' THEN 'SKIPPED_DYNAMIC_SQL'
      WHEN parse_ok AND issues = '' THEN 'CLEAN_PARSE_OK' WHEN parse_ok THEN 'TEXT_SUSPECT_PARSE_OK'
      WHEN issues <> '' THEN 'TEXT_SUSPECT_PARSE_ERROR' ELSE 'PARSE_ERROR_NO_TEXT_ISSUE' END"""
CHECKED_SQL = f"""s AS (SELECT *, CASE WHEN trim("normalizedSqlText") <> '' THEN "normalizedSqlText"
      WHEN trim("sqlText") <> '' THEN "sqlText" ELSE '' END AS effective, confidence <> 'LOW' AS parse_ok FROM statements),
    t AS (SELECT *, {ISSUES_SQL.replace('text', 'effective')} AS issues FROM s),
    checked AS (SELECT *, {SANITY_STATUS_SQL} AS "sanityStatus" FROM t)"""


def _checked(spark, sf_dir):
    from evenledger.plans.statements import check_text

    return check_text(statements(spark, sf_dir).withColumn("parse_ok", F.col("confidence") != "LOW"))


@query(
    "sanity_status",
    f"""WITH {STATEMENTS_SQL}, {CHECKED_SQL} SELECT "sqlId", "sanityStatus", issues AS "sanityIssues",
      {literal_case('"sanityStatus"', tx.SANITY_ADVICE)} AS recommendation FROM checked""",
)
def _sanity(spark, sf_dir):
    return _checked(spark, sf_dir)[0].select("sqlId", "sanityStatus", "sanityIssues", "recommendation")


@query(
    "readiness",
    f"""WITH {STATEMENTS_SQL}, {CHECKED_SQL} SELECT "sqlId", {literal_case('"sanityStatus"', tx.READINESS)} AS readiness FROM checked""",
)
def _readiness(spark, sf_dir):
    return _checked(spark, sf_dir)[0].select("sqlId", "readiness")


@query(
    "sanity_summary",
    f"""WITH {STATEMENTS_SQL}, {CHECKED_SQL} SELECT k AS "sanityStatus", count("sanityStatus") AS "statementCount"
    FROM (SELECT unnest([{', '.join(q(k) for k in tx.SANITY_ADVICE)}]) AS k) LEFT JOIN checked ON "sanityStatus" = k GROUP BY k""",
)
def _sanity_summary(spark, sf_dir):
    return _checked(spark, sf_dir)[1]


SERVICE_SQL = """CASE WHEN contains(u, 'FLOW') THEN 'FLOW' WHEN contains(u, 'BETA') AND contains(u, 'CORE') THEN 'BETA_CORE'
  WHEN contains(u, 'CORE') THEN 'CORE' WHEN u = 'OS' THEN 'OS' ELSE replace(u, '-', '_') END"""
_RULES = ((("FLOW",), "FLOW"), (("BETA", "CORE"), "BETA_CORE"), (("CORE",), "CORE"))
_FOLDERS = ["alpha-core", "my-workflow", "os", "stock-os", "core-beta", "beta", "graph-api", "plain-one"]


@query(
    "service_label",
    f"""WITH n AS (SELECT p_partkey, upper(list_extract([{', '.join(q(f) for f in _FOLDERS)}], cast(1 + p_partkey % 8 as bigint))
      || '_' || p_brand) AS u FROM part) SELECT p_partkey, {SERVICE_SQL} AS label FROM n""",
)
def _service(spark, sf_dir):
    folder = F.element_at(F.array(*[F.lit(f) for f in _FOLDERS]), (1 + F.col("p_partkey") % 8).cast("int"))
    named = F.concat(folder, F.lit("_"), F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", tx.service_label(named, _RULES).alias("label"))


# Statements with the verdict written out by hand: (text, code, may be read).
WITH_TEXTS = [
    ("WITH x AS (SELECT 1 AS a) SELECT a FROM x", "SAFE_SELECT"),
    ("WITH x AS (SELECT 1 AS a) INSERT INTO t SELECT a FROM x", "UNSAFE_SELECT"),
    ("-- note\nwith x as (select ')' as a), y as (select 2)\n  delete from t where a in (select a from x)", "UNSAFE_SELECT"),
    ("WITH x AS (SELECT 1) UPDATE t SET a = 1", "UNSAFE_SELECT"),
    ("WITH x AS (SELECT 1) MERGE INTO t USING x ON true WHEN MATCHED THEN DELETE", "UNSAFE_SELECT"),
    ("WITH x AS (SELECT ') insert into t' AS a) SELECT a FROM x", "SAFE_SELECT"),
    ("WITH x AS (SELECT 1) /* ) delete from t */ SELECT max(update_count) FROM x", "SAFE_SELECT"),
    ("SELECT (1) AS insert_into", "SAFE_SELECT"),
    ("INSERT INTO t SELECT 1", "NOT_SELECT"),
]


@query(
    "select_flags_of_writing_with",
    "SELECT o_orderkey, code FROM orders JOIN (VALUES "
    + ", ".join(f"({i}, '{code}')" for i, (_, code) in enumerate(WITH_TEXTS))
    + f") v(i, code) ON i = o_orderkey % {len(WITH_TEXTS)}",
)
def _flags_of_with(spark, sf_dir):
    text = pick([t for t, _ in WITH_TEXTS], F.col("o_orderkey"))
    flags = tx.select_flags(text)
    return table(spark, sf_dir, "orders").select("o_orderkey", flags["reason_code"].alias("code"))
