"""Headline queries, warm: each is run once to warm up and once timed, writing its whole result to the noop sink."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daybook.plans import queries as registry  # noqa: E402
from daybook.session import local_session  # noqa: E402

HEADLINE = [
    "account_deltas",
    "closing_balances",
    "snapshots_all_dates",
    "first_postings",
    "postable_prefix",
    "violations_report",
    "balance_snapshot",
    "dup_transaction_lines",
    "scan_transaction_fw",
    "scan_customer_fw",
    "staged_with_lineage",
    "balance_file_lines",
    "business_date_clock",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores, "daybook-bench")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        for _ in range(2):
            begun = time.perf_counter()
            registry.run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - begun, 3)
    print(
        json.dumps({
            "metric": "total_seconds",
            "value": round(sum(seconds.values()), 3),
            "unit": "sec",
            "queries": seconds,
            "sf": os.path.basename(sf_dir.rstrip("/")),
            "cores": int(cores),
            "spark": spark.version,
        })
    )
    spark.stop()


if __name__ == "__main__":
    main()
