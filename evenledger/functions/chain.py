"""Ordered decision rules as one CASE expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(value) -> Column:
    """A string literal, or the Column unchanged."""
    return value if isinstance(value, Column) else F.lit(value)


def first_match(rules: Sequence[tuple[Column, object]], default) -> Column:
    """Value of the first rule whose condition holds, else ``default``."""
    chain = F
    for condition, value in rules:
        chain = chain.when(condition, text(value))
    return chain.otherwise(text(default))


def first_verdict(names: Sequence[str], rules, default) -> Column:
    """Like ``first_match`` for tuples: a struct with one field per name."""
    def verdict(values):
        return F.struct(*[text(v).alias(n) for n, v in zip(names, values, strict=True)])

    return first_match([(condition, verdict(values)) for condition, values in rules], verdict(default))


WHITE_SPACE = " \t\n\r\f\x0b"


def stripped(c: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.trim(c, F.lit(WHITE_SPACE))


def blank(c: Column) -> Column:
    """Null or only white space."""
    return ~filled(c)


def filled(c: Column) -> Column:
    """Not blank. A text that begins above the white space needs no trimming to tell."""
    return F.coalesce((c.cast("string") >= "!") | (stripped(c) != ""), F.lit(False))


def nonblank(c: Column) -> Column:
    """The trimmed text, null when nothing is left."""
    return F.nullif(stripped(c), F.lit(""))


def lowered(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit("")))


def says(c: Column, word: str) -> Column:
    """Case-folded equality, false for null."""
    return F.coalesce(F.upper(F.trim(c)) == word.upper(), F.lit(False))
