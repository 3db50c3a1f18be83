"""Time the headline queries. Prints one JSON line.

Every query runs once to warm up code generation, then ``BENCH_RUNS`` times; the median counts. Results
go to the ``noop`` sink, which computes every row and column without collecting them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from custodia.session import local_session
from custodia.workload import QUERIES

HEADLINE = (
    "governed_select",
    "row_filter_cascade",
    "classify_columns",
    "kanon_join_aggregate",
    "dp_avg",
    "redact_full",
    "pii_inventory",
    "sentiment_documents",
    "topic_report",
    "dq_orders",
    "dq_report",
    "semantic_governed",
    "semantic_no_fanout",
    "audit_direct_access",
    "audit_column_lineage",
    "sensitive_access",
    "role_effectiveness",
    "governance_coverage",
    "share_transfers",
    "customer_order_summary",
)


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        timings = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timings[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": base.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
