"""Registered queries: each operator over the test tables, with the same question as DuckDB SQL."""

from evenledger.catalog.registry import ORACLE, QUERIES, load_all

__all__ = ["ORACLE", "QUERIES", "load_all"]
