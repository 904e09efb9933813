"""Runs registered queries in Spark and their SQL twins in DuckDB and compares whole results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "\0null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return f"{float(value):.9g}" if isinstance(value, float) else str(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> str:
    """Empty when both agree, else what differs."""
    df = fn(spark, sf_dir)
    names = sorted(df.columns)
    ours = sorted(tuple(plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    if sorted(columns) != names:
        return f"columns differ: {names} / {sorted(columns)}"
    at = [columns.index(n) for n in names]
    theirs = sorted(tuple(plain(row[i]) for i in at) for row in found.fetchall())
    if len(ours) != len(theirs):
        return f"row counts differ: {len(ours)} / {len(theirs)}"
    if not ours:
        return "both results are empty"
    for a, b in zip(ours, theirs):
        if a != b:
            gap = [(n, x[:200], y[:200]) for n, x, y in zip(names, a, b) if x != y]
            return f"values differ at {a[0][:80]}: {gap}"
    return ""


def main(argv: list[str]) -> int:
    from evenledger.catalog import ORACLE, QUERIES, load_all
    from evenledger.session import session

    load_all()
    sf = argv[0] if argv else "0.01"
    wanted = argv[1:]
    spark = session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("OFF")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        started = time.time()
        try:
            if name in ORACLE:
                gap = compare(spark, con, name, fn, ORACLE[name], sf_dir)
            else:
                gap = "" if fn(spark, sf_dir).count() else "no rows"
        except Exception as failed:  # noqa: BLE001
            gap = f"{type(failed).__name__}: {str(failed)[:600]}"
        bad += bool(gap)
        mark = "exact" if name in ORACLE else "rows"
        print(f"{'BAD' if gap else 'ok '} {mark} {time.time() - started:6.2f}s {name} {gap}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1:])))
