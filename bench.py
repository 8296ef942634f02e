"""Time the headline queries; prints one JSON line.

Folder and cores come from ``BENCH_SF_DIR`` and ``BENCH_CPUS``. Every query runs
to completion over its whole input, without returning rows to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

from stockroom.catalog import queries
from stockroom.session import local_session

HEADLINE = (
    "revenue_by_store",
    "top_products",
    "revenue_by_month",
    "customer_segments",
    "payment_methods",
    "flagged_by_reason",
    "lifecycle_metrics",
    "revenue_by_category",
    "best_months",
    "lines_per_order",
    "anomaly_share",
    "discount_by_product",
    "fct_sales",
    "fct_payments",
    "fct_inventory_daily",
    "fct_order_lifecycle",
    "flagged_payments",
    "dim_customer",
    "dim_product",
    "scd2_bulk",
    "scd2_two_runs",
    "latest_by_key",
    "upsert_two_batches",
    "merge_load_evolved",
    "json_flatten",
    "ingest_pages",
    "stream_upsert",
    "stream_scd2",
    "dq_unique",
    "dq_report",
)


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), app="bench")
    registered = queries()
    registered["anomaly_share"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names or HEADLINE:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
