"""Time all queries and print one JSON line; its value is the sum over the headline queries.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores,
``BENCH_ROUNDS`` the timed runs per query at most (their median counts): a query gets
no further run once it has taken ``BENCH_SECONDS``. One query runs untimed first, to start the JVM.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = """
net_payment net_payment_violations payment_signed_self_join monthly_parity cohort_retention order_report
users_with_item buyers_average channel_signups dq_generic dq_run_summary item_revenue plan_unit_price
transfer_withdrawn mask_expired weather_json_rows forecast_slots_wide hourly_forecast forecast_daily temp_triggers
actual_over_forecast forecast_totals frozen_forecast rfm_features robust_scaled volume_forecast user_segments
incremental_events stream_events redacted_text
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds, enough = int(os.environ.get("BENCH_ROUNDS", "3")), float(os.environ.get("BENCH_SECONDS", "3"))
    names = sys.argv[1:] or [*HEADLINE, *(n for n in QUERIES if n not in HEADLINE)]
    spark = build_session(
        "bench", f"local[{cpus}]", {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["net_payment"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        while len(times) < rounds and sum(times) < enough:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    counted = [s for n, s in seconds.items() if n in HEADLINE] or list(seconds.values())
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(counted), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)),
                "cpus": int(cpus),
                "rounds": rounds,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
