"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and once timed; the whole result is produced and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

HEADLINE = (
    "compare_lineitem_by_year",
    "canonical_row",
    "result_hash",
    "result_fingerprint",
    "summarize_result",
    "compare_results",
    "overall_status",
    "occurrence_index",
    "assign_ids",
    "flag_duplicate_keys",
    "dedupe_first",
    "aggregate_bindings",
    "build_candidates",
    "capture_eligibility",
    "match_baseline",
    "normalize_text",
    "select_flags",
    "text_issues",
    "placeholders",
    "classify_issue",
    "issue_summary",
    "rank_rows",
    "scan_summary",
    "sample_tuples_per_plan",
    "expand_parameters",
    "select_cases",
    "case_status_row",
    "json_leaf_paths",
    "xml_path_inventory",
    "extract_statements",
)


def main() -> None:
    from evenledger.catalog import QUERIES, load_all
    from evenledger.session import session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("OFF")
    load_all()
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
