"""Trip-record analytics on Spark: unify, clean, aggregate incrementally, serve and model.

The public functions by subject:

* sources: ``scan_raw check_files raw_inventory coverage outcome_rollup changed``
* trips: ``normalise validate_month clean cleaning_report``
* aggregates: ``partials combine zone_hourly daily_stats zone_time_buckets zone_anomaly_stats``
* keyed rows: ``conform dedupe_last upsert upsert_small nan_to_null``
* stages: ``run load flag reset run_stream run_flag_stream Store``
* models: ``train_fare train_demand train_tip train_clusters zscore_flags score``
* queries: ``zone_stats kpi_daily heatmap_topk anomalies_by_zone demand_vs_actual hotspots hotspot_choices
  latest_metrics``
"""

from kerbside.operators.aggregates import (
    combine,
    daily_stats,
    partials,
    zone_anomaly_stats,
    zone_hourly,
    zone_time_buckets,
)
from kerbside.operators.intake import pending
from kerbside.operators.joins import lookup_join
from kerbside.operators.keyed import conform, dedupe_last, nan_to_null, upsert, upsert_small
from kerbside.operators.rules import clean, cleaning_report, validate_month
from kerbside.operators.unify import normalise, union_trips
from kerbside.plans.extract import fetch_list, record_extract
from kerbside.plans.flags import flag
from kerbside.plans.ingest import run
from kerbside.plans.load import load, reset
from kerbside.plans.metrics import latest_metrics
from kerbside.plans.models import (
    cluster_trips,
    score,
    train_clusters,
    train_demand,
    train_fare,
    train_fare_in_store,
    train_tip,
    zscore_flags,
)
from kerbside.plans.serving import (
    anomalies_by_zone,
    anomalies_in_zone,
    demand_vs_actual,
    heatmap_topk,
    hotspot_choices,
    hotspot_profiles,
    hotspots,
    kpi_daily,
    zone_stats,
)
from kerbside.plans.store import Store
from kerbside.sources.coverage import coverage, outcome_rollup
from kerbside.sources.listing import check_files, raw_inventory
from kerbside.sources.processed import changed
from kerbside.sources.raw import scan_raw
from kerbside.streaming.flags import run_flag_stream
from kerbside.streaming.intake import run_stream
from kerbside.workspace import session

__all__ = [name for name in dir() if not name.startswith("_")]
