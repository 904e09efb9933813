"""Statement-text columns: normalising, placeholders, safety flags, artefact codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenledger.functions.chain import first_match, first_verdict, lowered, nonblank

# Fixed patterns. Quoted text and comments run to their end mark or to the end of the text.
SINGLE_QUOTED = r"'[^']*(?:'|\z)"
QUOTED_OR_COMMENT = r"'[^']*(?:'|\z)|" r'"[^"]*(?:"|\z)|' r"--[^\r\n]*|/\*[\s\S]*?(?:\*/|\z)"
LEADING_COMMENTS = r"^(?:\s*(?:--[^\n]*(?:\n|\z)|/\*[\s\S]*?(?:\*/|\z)))*\s*"
NAMED = r"(?<!:):([A-Za-z][A-Za-z0-9_]*)"
ANY_PLACEHOLDER = r"(?<!:):[A-Za-z_$][A-Za-z0-9_$]*|\?[0-9]*"
IN_BARE_NAME = r"(?i)\bin\s+:([A-Za-z][A-Za-z0-9_]*)"
DYNAMIC_IDENTIFIER = r"(?i)\b(?:from|join|order\s+by|group\s+by)\s*\?"
UNSAFE = (
    r"(?i)\bfor\s+update\b|\bnextval\s*\(|\bsetval\s*\(|\bselect\s+into\b"
    r"|\bpg_(?:try_)?advisory_(?:xact_)?lock\s*\("
)
#: A statement that begins with common table expressions and writes after the last of them.
WRITING_WITH = r"(?is)\A\s*with\b.*\)\s*(?:insert\s+(?:into|overwrite)|update\s+\S+\s+(?:\S+\s+)?set|delete\s+from|merge\s+into)\b"
UNSTABLE = (
    r"(?i)\bcurrent_timestamp\b|\bcurrent_time\b|\bcurrent_date\b"
    r"|\brandom\s*\(|\brand\s*\(|\buuid\s*\(|\brandom_uuid\s*\("
)
RISKY_SELECT = r"nextval\(|setval\(|pg_advisory_lock|select\s[\s\S]*\sinto\s"
UPDATE_ALIAS = r'\bupdate\s+[\w.$"]+\s+(?:as\s+)?([a-z_][\w$]*)\s+set\s+\1\.[a-z_][\w$]*\s*='
ANY_PARAMETER = r"\?(?:\d+)?|:[a-zA-Z_][a-zA-Z0-9_]*"

# Reason code and sentence of each outcome of the safety inspection.
SELECT_REASONS = {
    "NOT_SELECT": "The statement is not a SELECT statement.",
    "MULTIPLE_STATEMENTS": "The SQL contains more than one executable statement.",
    "DYNAMIC_IDENTIFIER": "A JDBC parameter is used where an identifier is expected.",
    "UNSAFE_SELECT": "The SELECT contains a lock, state-changing function or SELECT INTO.",
    "NON_DETERMINISTIC_SELECT": "The SELECT contains a value that is not stable across executions.",
    "SAFE_SELECT": "The statement passed the static SELECT checks.",
}

# What to do next for each state of the text check.
SANITY_ADVICE = {
    "SKIPPED_EMPTY_SQL": "SQL text is empty. Check scanner extraction or manual review result.",
    "SKIPPED_DYNAMIC_SQL": "Dynamic SQL without resolved SQL text. Manual resolvedSqlText is required before validation.",
    "CLEAN_PARSE_OK": "SQL text looks clean and parser accepted it.",
    "TEXT_SUSPECT_PARSE_OK": "Parser accepted SQL, but text contains suspicious extraction artifacts. Review sanityIssues.",
    "TEXT_SUSPECT_PARSE_ERROR": "Parser failed and text contains suspicious artifacts. Fix scanner/normalizer first.",
    "PARSE_ERROR_NO_TEXT_ISSUE": (
        "Parser failed but no obvious text artifact was detected. "
        "Could be vendor-specific syntax. Do not treat as final SQL failure."
    ),
}

# May a statement in this state go on to the next phase?
READINESS = {
    "CLEAN_PARSE_OK": "PROCEED",
    "TEXT_SUSPECT_PARSE_OK": "PROCEED_AFTER_REVIEW",
    "PARSE_ERROR_NO_TEXT_ISSUE": "PROCEED_OR_REVIEW",
    "TEXT_SUSPECT_PARSE_ERROR": "FIX_FIRST",
    "SKIPPED_EMPTY_SQL": "BLOCKED",
    "SKIPPED_DYNAMIC_SQL": "REVIEW_REQUIRED",
}

# Default handling of each statement type.
TYPE_HANDLING = {
    "SELECT": "EXPLAIN_AND_SMOKE",
    "RISKY_SELECT": "EXPLAIN_ONLY",
    "INSERT": "EXPLAIN_ONLY",
    "UPDATE": "EXPLAIN_ONLY",
    "DELETE": "EXPLAIN_ONLY",
    "MERGE": "EXPLAIN_ONLY",
    "CALL": "SKIP",
    "DDL": "SKIP",
    "TRUNCATE": "SKIP",
    "UNKNOWN": "SKIP",
}


def lookup(c: Column, table: dict[str, str], default: str | None = None) -> Column:
    """Value of a short literal table, as a CASE."""
    return first_match([(c == key, value) for key, value in table.items()], F.lit(default))


def normalize_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))


def canonicalize_text(c: Column) -> Column:
    """Collapsed white space, trailing semicolons gone; letter case is kept."""
    return F.trim(F.regexp_replace(normalize_text(c), r";+\z", ""))


def effective_text(reviewed: Column, normalized: Column, raw: Column) -> Column:
    return F.coalesce(*[F.when(nonblank(c).isNotNull(), c) for c in (reviewed, normalized, raw)], F.lit(""))


def executed_text(adapted: Column, raw: Column) -> Column:
    return F.coalesce(F.when(nonblank(adapted).isNotNull(), adapted), raw, F.lit(""))


def original_text(normalized: Column, raw: Column) -> Column:
    return executed_text(normalized, raw)


def without_quotes_and_comments(c: Column) -> Column:
    return F.regexp_replace(c, QUOTED_OR_COMMENT, "")


def without_strings(c: Column) -> Column:
    return F.regexp_replace(c, SINGLE_QUOTED, "")


def without_leading_comments(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), LEADING_COMMENTS, "")


def statement_type(c: Column, form: str = "full") -> Column:
    """``full``: ten types. ``select``: SELECT (also WITH) or UNKNOWN."""
    body = F.lower(without_leading_comments(c))
    if form == "select":
        return F.when(body.rlike(r"^(?:select|with)\b"), "SELECT").otherwise("UNKNOWN")
    rules = [(body.rlike(r"^select\b") & body.rlike(RISKY_SELECT), "RISKY_SELECT")]
    rules += [
        (body.rlike(rf"^{word}\b"), word.upper())
        for word in ("select", "insert", "update", "delete", "merge", "call", "truncate")
    ]
    rules.append((body.rlike(r"^(?:create|alter|drop|comment|grant|revoke)\s"), "DDL"))
    return first_match(rules, "UNKNOWN")


def type_handling(statement_type_col: Column) -> Column:
    return lookup(statement_type_col, TYPE_HANDLING, "SKIP")


def select_flags(c: Column, mask_comments: bool = True) -> Column:
    """Struct of five flags and a reason; the first finding wins, later flags stay false."""
    whole = F.trim(F.coalesce(c, F.lit("")))
    masked = F.regexp_replace(
        whole, QUOTED_OR_COMMENT if mask_comments else SINGLE_QUOTED + r'|"[^"]*(?:"|\z)', ""
    )
    names = ("select", "multi", "dynamic_identifier", "unsafe", "non_deterministic", "reason_code", "reason")

    def finding(code, *flags):
        marks = [F.lit(name in flags) for name in names[:5]]
        return (*marks, code, SELECT_REASONS[code])

    return first_verdict(
        names,
        [
            (statement_type(whole, "select") != "SELECT", finding("NOT_SELECT")),
            (masked.rlike(r";\s*\S"), finding("MULTIPLE_STATEMENTS", "select", "multi")),
            (whole.rlike(DYNAMIC_IDENTIFIER), finding("DYNAMIC_IDENTIFIER", "select", "dynamic_identifier")),
            (whole.rlike(UNSAFE) | masked.rlike(WRITING_WITH), finding("UNSAFE_SELECT", "select", "unsafe")),
            (whole.rlike(UNSTABLE), finding("NON_DETERMINISTIC_SELECT", "select", "non_deterministic")),
        ],
        finding("SAFE_SELECT", "select"),
    )


def placeholder_count(c: Column, mask: str = "full") -> Column:
    """Question marks outside quotes and comments; ``single`` masks only single quotes."""
    masked = without_quotes_and_comments(c) if mask == "full" else without_strings(c)
    return F.coalesce(F.regexp_count(masked, F.lit(r"\?")), F.lit(0))


def named_params(c: Column) -> Column:
    names = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(NAMED), F.lit(1))
    return F.array_distinct(names)


def parameter_mode(c: Column) -> Column:
    named = F.coalesce(c, F.lit("")).rlike(NAMED)
    positional = placeholder_count(c, "single") > 0
    return first_match([(named & positional, "MIXED"), (named, "NAMED"), (positional, "POSITIONAL")], "NONE")


def placeholders(c: Column) -> Column:
    """Ordered array of (kind, text, name, index, occurrence), text inside single quotes skipped."""
    marks = F.regexp_extract_all(without_strings(F.coalesce(c, F.lit(""))), F.lit(ANY_PLACEHOLDER), F.lit(0))

    def describe(mark, position):
        named = mark.startswith(":")
        indexed = F.length(mark) > 1
        return F.struct(
            first_match(
                [(named, "NAMED"), (indexed, "JPA_INDEXED_POSITIONAL")], "JDBC_ORDINAL_POSITIONAL"
            ).alias("kind"),
            mark.alias("text"),
            F.when(named, F.substring(mark, 2, 1_000_000)).alias("name"),
            F.when(~named & indexed, F.substring(mark, 2, 1_000_000).try_cast("int")).alias("index"),
            (position + 1).alias("occurrence"),
        )

    return F.transform(marks, describe)


def to_positional(c: Column) -> Column:
    """``IN :x`` gets its parentheses; ``:name`` and ``?1`` become ``?``; one trailing ``;`` goes."""
    listed = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), IN_BARE_NAME, "IN (:$1)")
    ended = F.regexp_replace(listed, r";\s*\z", "")
    unnamed = F.regexp_replace(ended, NAMED, "?")
    return F.regexp_replace(unnamed, r"('[^']*(?:'|\z))|(\?)[0-9]+", "$1$2")


def text_issues(c: Column) -> Column:
    """Ordered array of artefact codes; EMPTY_SQL stands alone."""
    body = F.coalesce(c, F.lit(""))
    lone_quotes = F.regexp_count(F.replace(body, F.lit("''"), F.lit("")), F.lit("'"))
    contains_any = lambda *parts: _any(body.contains(F.lit(p)) for p in parts)
    codes = [
        (contains_any(r"\n"), "LITERAL_BACKSLASH_N"),
        (contains_any(r"\r"), "LITERAL_BACKSLASH_R"),
        (contains_any(r"\t"), "LITERAL_BACKSLASH_T"),
        (contains_any(r"\s"), "LITERAL_BACKSLASH_S"),
        (contains_any('" +', '+ "', "' +", "+ '"), "JAVA_CONCAT_REMAINDER"),
        (contains_any(".append(", "StringBuilder"), "JAVA_APPEND_REMAINDER"),
        (contains_any("//"), "JAVA_LINE_COMMENT_OR_URL"),
        (contains_any("/*", "*/"), "SQL_OR_JAVA_BLOCK_COMMENT"),
        (lone_quotes % 2 == 1, "UNBALANCED_SINGLE_QUOTE"),
        (F.regexp_count(body, F.lit('"')) % 2 == 1, "SUSPICIOUS_DOUBLE_QUOTE"),
    ]
    return F.when(nonblank(body).isNull(), F.array(F.lit("EMPTY_SQL"))).otherwise(labels_of(codes))


def _any(conditions) -> Column:
    found = None
    for condition in conditions:
        found = condition if found is None else found | condition
    return found


def labels_of(pairs: Sequence[tuple[Column, str]]) -> Column:
    """Labels whose condition holds, in the given order."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(label)) for condition, label in pairs]))


def sanity_status(effective: Column, raw: Column, dynamic: Column, issues: Column, parse_ok: Column) -> Column:
    """One of six states. ``parse_ok`` comes from whoever parsed the text."""
    suspect = F.size(issues) > 0
    return first_match(
        [
            (nonblank(effective).isNull(), "SKIPPED_EMPTY_SQL"),
            (dynamic & nonblank(raw).isNull(), "SKIPPED_DYNAMIC_SQL"),
            (parse_ok & ~suspect, "CLEAN_PARSE_OK"),
            (parse_ok, "TEXT_SUSPECT_PARSE_OK"),
            (suspect, "TEXT_SUSPECT_PARSE_ERROR"),
        ],
        "PARSE_ERROR_NO_TEXT_ISSUE",
    )


def sanity_advice(status: Column) -> Column:
    return lookup(status, SANITY_ADVICE)


def readiness(status: Column) -> Column:
    return lookup(status, READINESS)


def service_label(name: Column, rules: tuple[tuple[tuple[str, ...], str], ...] = ()) -> Column:
    """First rule whose parts all occur in the upper-cased name, else the name with ``_`` for ``-``."""
    upper = F.upper(name)

    def holds(parts):
        found = None
        for part in parts:
            hit = upper.contains(part)
            found = hit if found is None else found & hit
        return found

    chain = [(holds(parts), label) for parts, label in rules]
    chain.append((upper == "OS", "OS"))
    return first_match([(name.isNull(), "UNKNOWN"), *chain], F.replace(upper, F.lit("-"), F.lit("_")))


# Dialect patterns looked for in lower-cased text, with their labels, in report order.
DIALECT_SIGNALS: tuple[tuple[tuple[str, ...], str], ...] = (
    ((".nextval", " nextval from dual"), "SEQUENCE/NEXTVAL"),
    ((" from dual",), "DUAL"),
    (("nvl(",), "NVL"),
    (("sysdate",), "SYSDATE"),
    (("rownum",), "ROWNUM"),
    (("to_char(",), "TO_CHAR"),
    (("to_timestamp(",), "TO_TIMESTAMP"),
    (("dateadd(",), "DATEADD"),
    (("current_timestamp()",), "CURRENT_TIMESTAMP()"),
    (('"value"', '"entity"'), "QUOTED RESERVED IDENTIFIER"),
)


def text_signals(c: Column) -> Column:
    """Dialect labels found in the text, joined with ``; ``."""
    body = lowered(c)
    pairs = [(_any(body.contains(F.lit(p)) for p in parts), label) for parts, label in DIALECT_SIGNALS]
    pairs.append((body.rlike(UPDATE_ALIAS), "UPDATE SET alias.column"))
    pairs.append((body.contains("merge into"), "MERGE"))
    pairs.append((body.rlike(ANY_PARAMETER), "PARAMETERIZED SQL"))
    return F.array_join(labels_of(pairs), "; ")


def rewrite_candidate(c: Column) -> Column:
    """Struct (candidate, changed, review): the few rewrites that are safe to propose, and a review mark."""
    body = F.coalesce(c, F.lit(""))
    sequence = r"(?i)\bselect\s+(\w+)\.nextval\s+from\s+dual\b"
    simple_rownum = r"(?i)\s+where\s+rownum\s*<=\s*(\d+)\s*;?\s*\z"
    step = F.when(
        body.rlike(sequence),
        F.regexp_replace(
            body,
            F.lit(sequence),
            F.concat(F.lit("SELECT nextval('"), F.lower(F.regexp_extract(body, sequence, 1)), F.lit("')")),
        ),
    ).otherwise(body)
    for pattern, replacement in (
        (r"(?i)\bnvl\s*\(", "COALESCE("),
        (r"(?i)\bsysdate\b", "CURRENT_TIMESTAMP"),
        (r"(?i)\bsystimestamp\b", "CURRENT_TIMESTAMP"),
        (simple_rownum, " LIMIT $1"),
    ):
        step = F.regexp_replace(step, pattern, replacement)
    review = step.rlike(r"(?i)\brownum\b|\bto_date\s*\(|\bto_timestamp\s*\(|\.nextval\b")
    return F.struct(step.alias("candidate"), (step != body).alias("changed"), review.alias("review"))

