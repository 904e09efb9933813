"""Stable keys and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenledger.functions.chain import filled, nonblank


def _part(c: Column) -> Column:
    kept = F.replace(F.trim(c), F.lit("|"), F.lit("%7C"))
    return F.lower(F.regexp_replace(kept, r"\s+", " "))


def baseline_key(
    service: Column, cls: Column, method: Column, source: Column, variable: Column, occurrence: Column
) -> Column:
    """Six parts joined by ``|``; null when one of the four required parts is blank."""
    required = (service, cls, method, source)
    complete = filled(service) & filled(cls) & filled(method) & filled(source)
    return F.when(
        complete,
        F.concat_ws(
            "|",
            *[_part(c) for c in required],
            F.when(filled(variable), _part(variable)).otherwise("-"),
            occurrence.cast("string"),
        ),
    )


def effective_id(current: Column, baseline: Column) -> Column:
    return F.coalesce(F.when(filled(current), current), baseline, F.lit(""))


def group_key(key: Column, effective: Column) -> Column:
    return F.when(filled(key), key).otherwise(effective)


def case_id(statement_id: Column, key: Column) -> Column:
    """File-safe id of at most 64 characters, with eight hex digits of the group key's digest."""
    safe = F.regexp_replace(F.coalesce(nonblank(statement_id), F.lit("SQL")), r"[^A-Za-z0-9._-]", "_")
    return F.concat(F.substring(safe, 1, 64), F.lit("-"), F.substring(F.sha2(key, 256), 1, 8))


def numbered_id(service: Column, number: Column) -> Column:
    """``<service>-0001``; numbers past 9999 just get longer."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits)
    return F.concat(F.coalesce(service, F.lit("")), F.lit("-"), padded)
