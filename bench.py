"""Times the headline results and prints one JSON line.

Each query runs whole (every row and column computed) into Spark's ``noop``
sink: one warm-up, then the median of the timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from innlake.queries import all_queries
from innlake.session import local_session

HEADLINE = (
    "validate_guests", "validate_reservations", "validate_rooms", "validate_housekeeping",
    "validate_billing", "merge_reservations", "dq_reservation_guest_fk",
    "dim_guest", "dim_room", "scd2_dim_room", "fact_reservation", "fact_housekeeping", "fact_billing",
    "anomaly_double_booking", "anomaly_hk_sla_breach", "anomaly_maintenance_overdue",
    "anomaly_billing_mismatch", "anomaly_suspicious_cancellation", "anomaly_cancellation_sliding",
    "kpi_occupancy", "kpi_conversion", "kpi_hk_sla", "kpi_revpar", "kpi_billing_accuracy",
    "masked_dim_guest", "rpt_top_guests",
    "dq_exceptions", "anomaly_log", "refresh_curated", "ingest_rooms", "incremental_rooms",
)


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cores, shuffle_partitions=8)
    queries = all_queries()
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        timed(queries[name], spark, sf_dir)
        seconds[name] = round(statistics.median(timed(queries[name], spark, sf_dir) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cores": cores, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
