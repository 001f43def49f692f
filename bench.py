"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one JSON line.

Each query runs once to warm up, then $BENCH_RUNS times (default 3); its time is
the median. ``states_then_four`` is the shared-state plan of the engine (one pass
over trips, four roll-ups); ``four_from_trips`` is the same result from four
passes, as a baseline for it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "trips_unified",
    "clean_trips",
    "cleaning_report",
    "zone_hourly",
    "daily_stats",
    "zone_time_buckets",
    "zone_anomaly_stats",
    "incremental_zone_hourly",
    "incremental_zone_anomaly_stats",
    "kpi_daily",
    "zone_heatmap_topk",
    "hotspot_profiles",
    "zscore_anomalies",
    "upsert_daily_stats",
    "dedupe_keep_last",
    "latest_metrics",
)
# Read, write and train as a whole; one timed run each.
LONG = ("raw_scan", "served_daily_stats", "fare_model_metrics", "tip_classifier", "trip_clusters")


def drain(frame) -> None:
    """Run a query to the end without collecting it."""
    frame.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    from kerbside import fixtures
    from kerbside.operators import aggregates as agg
    from kerbside.operators import rules
    from kerbside.plans.store import Store
    from kerbside.registry import AS_OF, QUERIES
    from kerbside.workspace import scratch, session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        drain(QUERIES[name](spark, sf_dir))
        times[name] = statistics.median(timed(lambda: drain(QUERIES[name](spark, sf_dir))) for _ in range(runs))
    for name in LONG:
        times[name] = timed(lambda: drain(QUERIES[name](spark, sf_dir)))

    trips = fixtures.trips(spark, sf_dir)

    def four_from_trips() -> None:
        clean = rules.clean(rules.validate_month(trips), as_of_year=AS_OF.year)
        for aggregate in agg.AGGREGATES.values():
            drain(aggregate(clean))

    def states_then_four() -> None:
        store = Store(spark, scratch(spark, "bench"))
        store.write_states(agg.partials(trips, as_of_year=AS_OF.year))
        for aggregate in agg.AGGREGATES.values():
            drain(aggregate(store.states()))

    for plan in (four_from_trips, states_then_four):
        plan()
        times[plan.__name__] = statistics.median(timed(plan) for _ in range(runs))

    result = {
        "metric": "total query time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "rows": {"lineitem": fixtures.lineitem(spark, sf_dir).count()},
        "cpus": int(cpus),
        "runs": runs,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
