"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from waymeter.registry import QUERIES, forget_plans, stored_changes
from waymeter.session import local_session

HEADLINE = [
    "vw_metric_daily", "vw_metric_scope_snapshot", "fact_metric_bucket", "cdc_bookings", "booking_triggers",
    "booking_records", "driver_records", "passenger_activity_records", "enriched_locations",
    "driver_location_timeseries", "vw_booking_route_paths", "audit_acceptance_rate", "payout_ledger", "passenger_cohorts",
    "stream_booking_facts",
]
#: Change records that a query reads, stored outside the clock.
CHANGES = {"cdc_bookings": "booking", "stream_booking_facts": "booking"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="waymeter-bench")
    # the JVM starts up outside the clock
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds, changes = {}, {}
    for name in HEADLINE:
        forget_plans()
        if name in CHANGES:
            changes[name] = stored_changes(spark, sf_dir, CHANGES[name]).count()
        begun = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "changes_per_second": {n: round(c / seconds[n]) for n, c in changes.items()}, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
