"""Headline timings: one JSON line with seconds per query.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores and
``BENCH_QUERIES`` an optional comma list.  A query is timed to a full run of its
result (a count would let the optimizer drop columns), second of two runs.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from acreledger.session import build_session
from checks.queries import REGISTRY

HEADLINE = [
    "account_totals", "counter_splits", "counter_flows", "cash_clean", "exec_summary", "summary_by_account",
    "summary_by_ancestor", "trend_pivot", "exec_trend", "detail_with_totals", "running_position",
    "balance_sheet", "identity_check", "stock_value", "price_nearest", "nearest_moments", "invoice_lines",
    "contract_status", "vendor_1099", "deductible_expense", "pattern_join", "depreciation_rows", "flex_lease",
    "progress", "production_vs_machine", "daily_orders", "double_entry", "anti_existing", "scrub_text",
    "account_paths",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='bench-')}",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(run(name), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline ledger queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
