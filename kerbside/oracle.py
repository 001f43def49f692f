"""The registered queries as DuckDB SQL over the same tables, for cross-checking."""

from __future__ import annotations

from kerbside.fixtures import trips_sql_duckdb

_NAMED = f"named AS ({trips_sql_duckdb()})"

_VALID = """valid AS (
  SELECT * FROM named WHERE source_month IS NULL OR date_trunc('month', pickup_datetime) = source_month)"""

_FEATURES = """
  CAST(epoch(dropoff_datetime) - epoch(pickup_datetime) AS BIGINT) / CAST(60 AS DOUBLE) AS trip_duration_minutes,
  CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
  CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_dow,
  CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
  CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
  CAST(pickup_datetime AS DATE) AS pickup_date,
  dayofweek(pickup_datetime) IN (0, 6) AS is_weekend,
  CASE WHEN hour(pickup_datetime) BETWEEN 6 AND 11 THEN 'morning'
       WHEN hour(pickup_datetime) BETWEEN 12 AND 17 THEN 'afternoon'
       WHEN hour(pickup_datetime) BETWEEN 18 AND 22 THEN 'evening' ELSE 'night' END AS time_bucket"""

_REQUIRED = (
    "pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL "
    "AND pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL"
)
_YEAR = "year(pickup_datetime) BETWEEN 2019 AND 2023"
_DURATION = "trip_duration_minutes > 0 AND trip_duration_minutes < 300"
_DISTANCE = "(taxi_type = 'fhv' OR (trip_distance >= 0 AND trip_distance < 200))"
_FARE = "(taxi_type = 'fhv' OR (fare_amount >= 0 AND fare_amount < 1000))"

_CLEAN = f"""clean AS (
  SELECT * FROM (SELECT v.*, {_FEATURES} FROM valid v)
  WHERE {_REQUIRED} AND {_YEAR} AND {_DURATION} AND {_DISTANCE} AND {_FARE})"""

_ALL = f"WITH {_NAMED}, {_VALID}, {_CLEAN}"

_TRIP_COLUMNS = (
    "pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, passenger_count, "
    "trip_distance, fare_amount, tip_amount, total_amount, payment_type, rate_code, taxi_type"
)


def _sum(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,6))) AS DOUBLE)"


def _avg(column: str) -> str:
    return f"{_sum(column)} / COUNT({column})"


_SECONDS = "CAST(round(trip_duration_minutes * 60) AS BIGINT)"
_AVG_MINUTES = f"CAST(SUM({_SECONDS}) AS DOUBLE) / CAST(60 AS DOUBLE) / COUNT(*)"

_HOURLY = f"""
SELECT pickup_year, pickup_month, pickup_date, pickup_dow, pickup_hour, pickup_location_id, taxi_type,
  COUNT(*) AS trip_count, {_AVG_MINUTES} AS avg_duration_minutes, {_avg('trip_distance')} AS avg_distance,
  {_avg('fare_amount')} AS avg_fare, {_avg('total_amount')} AS avg_total
FROM clean GROUP BY ALL"""


def _daily(where: str = "TRUE") -> str:
    return f"""
SELECT pickup_date, taxi_type, COUNT(*) AS trip_count, {_AVG_MINUTES} AS avg_duration_minutes,
  CAST({_sum('passenger_count')} AS BIGINT) AS total_passengers, {_avg('fare_amount')} AS avg_fare,
  {_sum('fare_amount')} AS total_revenue
FROM clean WHERE {where} GROUP BY ALL"""


_UPSERTED = f"""{_ALL},
old AS ({_daily("source_month IS NULL OR source_month <= DATE '2023-02-01'")}),
new AS ({_daily("source_month IS NULL OR source_month >= DATE '2023-02-01'")})
SELECT pickup_date, taxi_type, coalesce(n.trip_count, o.trip_count) AS trip_count,
  coalesce(n.avg_duration_minutes, o.avg_duration_minutes) AS avg_duration_minutes,
  CASE WHEN n.trip_count IS NOT NULL THEN n.total_passengers ELSE o.total_passengers END AS total_passengers,
  o.avg_fare,
  CASE WHEN n.trip_count IS NOT NULL THEN n.total_revenue ELSE o.total_revenue END AS total_revenue
FROM old o FULL JOIN new n USING (pickup_date, taxi_type)"""

_BUCKETS = """
SELECT pickup_location_id, time_bucket, taxi_type, COUNT(*) AS trip_count FROM clean GROUP BY ALL"""

_STATS = f"""
SELECT pickup_location_id, taxi_type, COUNT(*) AS trip_count,
  {_avg('fare_amount')} AS avg_fare_amount, round(stddev_samp(fare_amount), 4) AS stddev_fare_amount,
  {_AVG_MINUTES} AS avg_trip_duration_minutes,
  round(stddev_samp(trip_duration_minutes), 4) AS stddev_trip_duration_minutes,
  {_avg('trip_distance')} AS avg_trip_distance, round(stddev_samp(trip_distance), 4) AS stddev_trip_distance
FROM clean GROUP BY ALL"""

_SOURCES = """(
  SELECT taxi_type, source_file AS file_name, source_month, COUNT(*) * 100 AS length
  FROM named GROUP BY ALL)"""

_RULES = {
    "month": "source_month IS NULL OR date_trunc('month', pickup_datetime) = source_month",
    "required": _REQUIRED,
    "year": _YEAR,
    "duration": _DURATION,
    "distance": _DISTANCE,
    "fare": _FARE,
}
_VERDICT = "CASE " + " ".join(
    f"WHEN NOT coalesce({rule}, FALSE) THEN '{name}'" for name, rule in _RULES.items()
) + " END"
_JUDGED = f"judged AS (SELECT n.*, {_FEATURES}, {_VERDICT} AS rejected_by FROM named n)"

_ACCOUNTS = """
SELECT taxi_type, source_file, source_month, COUNT(*) AS rows_in,
  COUNT(*) FILTER (WHERE rejected_by IS NULL) AS rows_kept
FROM judged GROUP BY ALL"""

_SCORED = """
scored AS (
  SELECT c.*,
    CASE WHEN s.sf > 0 THEN abs(fare_amount - s.af) / s.sf END AS z_fare_amount,
    CASE WHEN s.sm > 0 THEN abs(trip_duration_minutes - s.am) / s.sm END AS z_trip_duration_minutes,
    CASE WHEN s.sd > 0 THEN abs(trip_distance - s.ad) / s.sd END AS z_trip_distance
  FROM clean c JOIN (
    SELECT pickup_location_id, taxi_type, avg(fare_amount) AS af, stddev_samp(fare_amount) AS sf,
      avg(trip_duration_minutes) AS am, stddev_samp(trip_duration_minutes) AS sm,
      avg(trip_distance) AS ad, stddev_samp(trip_distance) AS sd
    FROM clean GROUP BY ALL) s USING (pickup_location_id, taxi_type)),
flagged AS (
  SELECT *, coalesce(z_fare_amount > 1.5, FALSE) OR coalesce(z_trip_duration_minutes > 1.5, FALSE)
    OR coalesce(z_trip_distance > 1.5, FALSE) AS is_anomaly
  FROM scored)"""

# Every hour of each zone and type from its first day to its last.
_DEMAND = f"""
hourly_ AS ({_HOURLY}),
days_ AS (
  SELECT pickup_location_id, taxi_type, CAST(unnest(generate_series(min(pickup_date), max(pickup_date), INTERVAL 1 DAY)) AS DATE)
    AS pickup_date
  FROM hourly_ GROUP BY pickup_location_id, taxi_type),
hours_ AS (SELECT *, CAST(unnest(range(24)) AS INTEGER) AS pickup_hour FROM days_),
demand_ AS (
  SELECT s.*, CAST(dayofweek(s.pickup_date) + 1 AS INTEGER) AS pickup_dow, CAST(month(s.pickup_date) AS INTEGER) AS pickup_month,
    coalesce(h.trip_count, 0) AS trip_count
  FROM hours_ s LEFT JOIN hourly_ h USING (pickup_date, pickup_hour, pickup_location_id, taxi_type))"""

_ORIGINS = ("2023-02-10", "2023-03-01", "2023-03-20")

_FARES = f"""
SELECT * FROM ({_HOURLY}) WHERE taxi_type IN ('yellow', 'green') AND avg_fare > 0 AND avg_fare < 200"""

_HOURLY_KEYS = "pickup_date pickup_hour pickup_location_id taxi_type".split()
_TIP_KEYS = "pickup_datetime dropoff_datetime pickup_location_id dropoff_location_id taxi_type".split()


def _split(rows: str, keys: list[str], label: str) -> str:
    text = ", ".join(f"CAST({key} AS VARCHAR)" for key in keys)
    slot = f"CAST('0x' || substr(md5(concat_ws('|', {text}, '42')), 1, 8) AS BIGINT) % 10000"
    return f"""SELECT CASE WHEN {slot} < 8000 THEN 'train' ELSE 'test' END AS part, COUNT(*) AS rows,
  round(SUM(CAST({label} AS DOUBLE)), 3) AS label_sum
FROM {rows} GROUP BY 1"""


def _checks(rows: str, label: str) -> str:
    """Mean and deviation of the features of training rows, types numbered by how many rows they have."""
    text = ", ".join(f"CAST({key} AS VARCHAR)" for key in _HOURLY_KEYS)
    slot = f"CAST('0x' || substr(md5(concat_ws('|', {text}, '42')), 1, 8) AS BIGINT) % 10000"
    names = ("pickup_location_id", "pickup_hour", "pickup_dow", "pickup_month", "taxi_type_idx")
    each = " UNION ALL ".join(
        f"SELECT '{name}' AS feature, COUNT(*) AS \"rows\", round(avg({name}), 6) AS mean, "
        f"round(stddev_samp({name}), 6) AS deviation, TRUE AS optimal FROM indexed"
        for name in names
    )
    return f"""train_ AS (SELECT * FROM {rows} WHERE {slot} < 8000),
types_ AS (
  SELECT taxi_type, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, taxi_type) - 1 AS DOUBLE) AS taxi_type_idx
  FROM train_ GROUP BY taxi_type),
indexed AS (SELECT * FROM train_ JOIN types_ USING (taxi_type))
{each}"""


_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_OUTCOMES = (
    "['ALREADY_EXISTS', 'DOWNLOADED', 'NOT_FOUND', 'ACCESS_DENIED', 'UNAVAILABLE', "
    "'CHECK_FAILED', 'DOWNLOAD_FAILED']"
)

ORACLE = {
    "trips_unified": f"{_ALL} SELECT {_TRIP_COLUMNS}, source_file, source_month FROM named",
    "time_features": f"""WITH {_NAMED}
SELECT taxi_type, pickup_datetime, dropoff_datetime, {_FEATURES} FROM named""",
    "month_validation": f"{_ALL} SELECT {_TRIP_COLUMNS}, source_file, source_month FROM valid",
    "clean_trips": f"{_ALL} SELECT * EXCLUDE (source_file) FROM clean",
    "cleaning_report": f"""WITH {_NAMED}, {_JUDGED}
SELECT taxi_type, COUNT(*) AS rows_in,
  {', '.join(f"COUNT(*) FILTER (WHERE rejected_by = '{name}') AS rejected_{name}" for name in _RULES)},
  COUNT(*) FILTER (WHERE rejected_by IS NULL) AS rows_kept
FROM judged GROUP BY taxi_type""",
    "zone_hourly": _ALL + _HOURLY,
    "daily_stats": _ALL + _daily(),
    "zone_time_buckets": _ALL + _BUCKETS,
    "zone_anomaly_stats": _ALL + _STATS,
    "incremental_zone_hourly": _ALL + _HOURLY,
    "incremental_daily_stats": _ALL + _daily(),
    "incremental_zone_time_buckets": _ALL + _BUCKETS,
    "incremental_zone_anomaly_stats": _ALL + _STATS,
    "source_accounts": f"WITH {_NAMED}, {_JUDGED} {_ACCOUNTS}",
    "stored_zone_anomaly_stats": _ALL + _STATS,
    "stream_file_once": _ALL + _daily(),
    "raw_scan": f"""{_ALL}
SELECT taxi_type, source_file, source_month, COUNT(*) AS trip_count, COUNT(trip_distance) AS distances,
  COUNT(payment_type) AS payments, MIN(pickup_datetime) AS first_pickup, MAX(dropoff_datetime) AS last_dropoff
FROM named GROUP BY ALL""",
    "file_integrity": " UNION ALL ".join(
        f"SELECT '{table}.parquet' AS file_name, TRUE AS is_valid, COUNT(*) AS row_count FROM {table}"
        for table in _TABLES
    ),
    "inventory": f"""{_ALL}
SELECT coalesce(taxi_type, 'ALL') AS taxi_type, COUNT(*) AS files, CAST(SUM(length) AS BIGINT) AS bytes
FROM {_SOURCES} GROUP BY ROLLUP (taxi_type)""",
    "file_coverage": f"""{_ALL},
files AS (
  SELECT taxi_type, source_month FROM {_SOURCES} s
  WHERE source_month IS NOT NULL AND NOT (taxi_type = 'fhv' AND source_month = DATE '2023-03-01'))
SELECT t.taxi_type, CAST(m.month AS DATE) AS month,
  t.taxi_type || '_tripdata_' || strftime(m.month, '%Y-%m') || '.parquet' AS file_name,
  CASE WHEN f.source_month IS NULL THEN 'MISSING'
       WHEN f.taxi_type = 'green' AND f.source_month = DATE '2023-02-01' THEN 'CORRUPT' ELSE 'PRESENT' END AS status
FROM (SELECT unnest(generate_series(DATE '2022-12-01', DATE '2023-04-01', INTERVAL 1 MONTH)) AS month) m
CROSS JOIN (SELECT unnest(['yellow', 'green', 'fhv', 'fhvhv']) AS taxi_type) t
LEFT JOIN files f ON f.taxi_type = t.taxi_type AND f.source_month = m.month""",
    "outcome_rollup": f"""
WITH log AS (SELECT {_OUTCOMES}[user_id % 5 + 1] AS outcome, value AS seconds FROM events)
SELECT d.outcome, COUNT(l.outcome) + CASE WHEN d.outcome = 'ALREADY_EXISTS' THEN 3 ELSE 0 END AS files,
  round(coalesce(SUM(l.seconds), 0), 4) AS seconds
FROM (SELECT unnest({_OUTCOMES}) AS outcome) d LEFT JOIN log l USING (outcome) GROUP BY d.outcome""",
    "pending_files": f"""{_ALL} SELECT taxi_type, file_name, length FROM {_SOURCES}
WHERE source_month IS NULL OR source_month <> DATE '2023-01-01'""",
    "stage_reset": f"{_ALL} SELECT taxi_type, file_name, length FROM {_SOURCES}",
    "changed_partitions": f"""{_ALL}
SELECT d.dataset, t.taxi_type FROM (SELECT DISTINCT taxi_type FROM named) t
CROSS JOIN (SELECT unnest(['zone_hourly', 'daily_stats', 'zone_time_buckets', 'zone_anomaly_stats']) AS dataset) d
WHERE t.taxi_type <> 'yellow'""",
    "upsert_daily_stats": _UPSERTED,
    "upsert_small_daily_stats": _UPSERTED,
    "dedupe_keep_last": """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "duplicate_report": """
SELECT CAST(SUM(n) AS BIGINT) AS "rows", COUNT(*) AS keys, CAST(SUM(n - 1) AS BIGINT) AS dropped
FROM (SELECT COUNT(*) AS n FROM events GROUP BY user_id, event_type)""",
    "conform_schema": """
SELECT event_id AS pickup_location_id, event_type AS taxi_type, CAST(round_even(value, 0) AS BIGINT) AS trip_count,
  TRY_CAST(props AS DOUBLE) AS avg_fare_amount, CAST(NULL AS DOUBLE) AS stddev_fare_amount,
  CAST(NULL AS DOUBLE) AS avg_trip_duration_minutes, CAST(NULL AS DOUBLE) AS stddev_trip_duration_minutes,
  CAST(user_id AS DOUBLE) AS avg_trip_distance, CAST(NULL AS DOUBLE) AS stddev_trip_distance
FROM events""",
    "nan_to_null": "SELECT event_id, CASE WHEN user_id % 7 <> 0 THEN value END AS value FROM events",
    "ingest_manifest": f"""WITH {_NAMED}, {_JUDGED}
SELECT 'transform' AS stage, source_file AS file_name, taxi_type, source_month, 'done' AS status, rows_in, rows_kept
FROM ({_ACCOUNTS})""",
    "ingest_metrics": f"""WITH {_NAMED}, {_JUDGED},
accounts AS ({_ACCOUNTS}),
totals AS (
  SELECT taxi_type, CAST(COUNT(*) AS DOUBLE) AS files_processed, CAST(0 AS DOUBLE) AS files_corrupt,
    CAST(SUM(rows_in) AS DOUBLE) AS rows_before, CAST(SUM(rows_kept) AS DOUBLE) AS rows_after
  FROM accounts GROUP BY taxi_type)
SELECT 'transform' AS job, metric, '{{"taxi_type":"' || taxi_type || '"}}' AS labels, value, CAST(NULL AS VARCHAR) AS text
FROM totals UNPIVOT (value FOR metric IN (files_processed, files_corrupt, rows_before, rows_after))
UNION ALL SELECT 'transform', 'status', '{{}}', NULL, 'success'""",
    "load_metrics": f"""{_ALL},
loaded AS (
  {' UNION ALL '.join(
      f"SELECT '{name}' AS dataset, taxi_type, COUNT(*) AS n FROM ({rows}) GROUP BY taxi_type"
      for name, rows in (("zone_hourly", _HOURLY), ("daily_stats", _daily()), ("zone_time_buckets", _BUCKETS),
                         ("zone_anomaly_stats", _STATS))
  )})
SELECT 'load' AS job, 'rows_loaded' AS metric,
  '{{"dataset":"' || dataset || '","taxi_type":"' || taxi_type || '"}}' AS labels, CAST(n AS DOUBLE) AS value,
  CAST(NULL AS VARCHAR) AS text
FROM loaded
UNION ALL SELECT 'load', 'failures', '{{}}', 0, NULL
UNION ALL SELECT 'load', 'status', '{{}}', NULL, 'success'""",
    "late_parts": _ALL + _daily(),
    "merged_daily_stats": f"""{_ALL}, served AS ({_daily()}),
incoming AS ({_daily("day(pickup_datetime) % 2 = 0 AND hour(pickup_datetime) < 12")})
SELECT * FROM incoming UNION ALL SELECT * FROM served ANTI JOIN incoming USING (pickup_date, taxi_type)""",
    "reprocessed_daily_stats": _ALL + _daily("day(pickup_datetime) % 2 = 0"),
    "fare_split": f"""{_ALL}, rows_ AS ({_FARES})
{_split("rows_", _HOURLY_KEYS, "avg_fare")}""",
    "demand_split": f"""{_ALL}, {_DEMAND}
{_split("demand_", _HOURLY_KEYS, "trip_count")}""",
    "demand_grid": f"""{_ALL}, {_DEMAND}
SELECT pickup_location_id, taxi_type, pickup_date, COUNT(*) AS hours, COUNT(*) FILTER (WHERE trip_count = 0) AS empty_hours,
  CAST(SUM(trip_count) AS BIGINT) AS trip_count
FROM demand_ GROUP BY ALL""",
    "demand_backtest_baseline": f"""{_ALL}, {_DEMAND},
pairs_ AS (
  SELECT a.pickup_date, a.trip_count, b.trip_count AS naive FROM demand_ a
  LEFT JOIN demand_ b ON b.pickup_date = a.pickup_date - 7 AND b.pickup_hour = a.pickup_hour
    AND b.pickup_location_id = a.pickup_location_id AND b.taxi_type = a.taxi_type)
{' UNION ALL '.join(
    f"SELECT DATE '{o}' AS origin, COUNT(*) FILTER (WHERE pickup_date < DATE '{o}') AS training_rows, "
    f"COUNT(*) FILTER (WHERE pickup_date >= DATE '{o}' AND pickup_date < DATE '{o}' + 7) AS test_rows, "
    f"COUNT(naive) FILTER (WHERE pickup_date >= DATE '{o}' AND pickup_date < DATE '{o}' + 7) AS naive_rows, "
    f"round(sqrt(avg((trip_count - naive) ** 2) FILTER (WHERE pickup_date >= DATE '{o}' AND pickup_date < DATE '{o}' + 7)), 6) "
    "AS naive_rmse FROM pairs_"
    for o in _ORIGINS)}""",
    "fare_model_checks": f"""{_ALL}, rows_ AS ({_FARES}), {_checks("rows_", "avg_fare")}""",
    "demand_model_checks": f"""{_ALL}, {_DEMAND}, {_checks("demand_", "trip_count")}""",
    "cluster_checks": f"""{_ALL}
SELECT COUNT(*) AS "rows", CAST(0 AS BIGINT) AS misplaced FROM clean
WHERE fare_amount IS NOT NULL AND trip_duration_minutes IS NOT NULL AND trip_distance IS NOT NULL""",
    "tip_split": f"""{_ALL}, rows_ AS (
  SELECT *, CAST(tip_amount > 0 AS DOUBLE) AS tipped FROM clean
  WHERE taxi_type IN ('yellow', 'green') AND tip_amount IS NOT NULL AND payment_type IS NOT NULL)
{_split("rows_", _TIP_KEYS, "tipped")}""",
    "model_status": f"""{_ALL}, rows_ AS ({_FARES}), parts AS ({_split("rows_", _HOURLY_KEYS, "avg_fare")})
SELECT 'model_fare' AS job, part || 'ing_rows' AS metric, '{{}}' AS labels, CAST("rows" AS DOUBLE) AS value,
  CAST(NULL AS VARCHAR) AS text
FROM parts WHERE part = 'train'
UNION ALL SELECT 'model_fare', part || '_rows', '{{}}', "rows", NULL FROM parts WHERE part = 'test'
UNION ALL SELECT 'model_fare', 'status', '{{}}', NULL, 'ready'""",
    "demand_actuals": f"""{_ALL}, {_DEMAND}
SELECT pickup_location_id, CAST(SUM(trip_count) AS BIGINT) AS actual_trips, COUNT(*) AS hours
FROM demand_ GROUP BY pickup_location_id""",
    "cluster_input": f"""{_ALL},
whole AS (
  SELECT fare_amount, trip_duration_minutes, trip_distance FROM clean
  WHERE fare_amount IS NOT NULL AND trip_duration_minutes IS NOT NULL AND trip_distance IS NOT NULL)
{' UNION ALL '.join(
    f"SELECT '{c}' AS feature, COUNT(*) AS rows, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS deviation FROM whole"
    for c in ("fare_amount", "trip_duration_minutes", "trip_distance"))}""",
    "served_daily_stats": _ALL + _daily(),
    "fare_training_set": f"""{_ALL} SELECT * FROM ({_HOURLY})
WHERE taxi_type IN ('yellow', 'green') AND avg_fare > 0 AND avg_fare < 200""",
    "tip_training_set": f"""{_ALL}
SELECT fare_amount, pickup_location_id, pickup_hour, pickup_dow, pickup_month, payment_type, taxi_type,
  CAST(tip_amount > 0 AS DOUBLE) AS tipped
FROM clean WHERE taxi_type IN ('yellow', 'green') AND tip_amount IS NOT NULL AND payment_type IS NOT NULL""",
    "zscore_anomalies": f"""{_ALL}, {_SCORED}
SELECT pickup_location_id, taxi_type, COUNT(*) AS trip_count, COUNT(*) FILTER (WHERE is_anomaly) AS anomaly_count
FROM flagged GROUP BY ALL""",
    "zscore_drilldown": f"""{_ALL}, {_SCORED}
SELECT {_TRIP_COLUMNS}, round(z_fare_amount, 4) AS z_fare_amount,
  round(z_trip_duration_minutes, 4) AS z_trip_duration_minutes, round(z_trip_distance, 4) AS z_trip_distance
FROM flagged WHERE is_anomaly AND pickup_location_id = 3""",
    "stored_anomalies": f"""{_ALL}, {_SCORED}
SELECT pickup_location_id, taxi_type, COUNT(*) AS anomaly_count FROM flagged WHERE is_anomaly GROUP BY ALL""",
    "stored_drilldown": f"""{_ALL}, {_SCORED}
SELECT {_TRIP_COLUMNS}, round(z_fare_amount, 4) AS z_fare_amount,
  round(z_trip_duration_minutes, 4) AS z_trip_duration_minutes, round(z_trip_distance, 4) AS z_trip_distance
FROM flagged WHERE is_anomaly AND pickup_location_id = 3 AND taxi_type IN ('yellow', 'fhvhv')
  AND strftime(pickup_datetime, '%Y-%m') = '2023-02'""",
    "zone_stats_lookup": f"""{_ALL} SELECT * FROM ({_HOURLY})
WHERE pickup_location_id IN (3, 17, 42) AND pickup_date BETWEEN DATE '2023-01-10' AND DATE '2023-02-20'
  AND taxi_type IN ('yellow', 'green')""",
    "kpi_daily": f"""{_ALL}
SELECT pickup_date, COUNT(*) AS trip_count, {_sum('fare_amount')} AS total_revenue, {_avg('fare_amount')} AS avg_fare
FROM clean GROUP BY pickup_date""",
    "zone_heatmap": f"{_ALL} SELECT pickup_location_id, COUNT(*) AS trip_count FROM clean GROUP BY ALL",
    "zone_heatmap_topk": f"""{_ALL} SELECT pickup_location_id, COUNT(*) AS trip_count FROM clean GROUP BY ALL
ORDER BY trip_count DESC, pickup_location_id LIMIT 10""",
    "hotspot_profiles": f"""{_ALL} SELECT pickup_location_id, COUNT(*) AS trip_count,
  {', '.join(
      f"CAST(COUNT(*) FILTER (WHERE time_bucket = '{b}') AS DOUBLE) / COUNT(*) AS {b}_share"
      for b in ('morning', 'afternoon', 'evening', 'night')
  )}
FROM clean GROUP BY pickup_location_id""",
    "hotspot_checks": f"""{_ALL}
SELECT COUNT(DISTINCT coalesce(pickup_location_id, -1)) AS "rows", CAST(0 AS BIGINT) AS misplaced FROM clean""",
    "latest_metrics": """
WITH log AS (
  SELECT event_type AS job, ['rmse', 'mae', 'training_rows'][user_id % 3 + 1] AS metric,
    '{"shard":"' || (user_id % 4) || '"}' AS labels, ts, value FROM events),
newest AS (
  SELECT * FROM log
  QUALIFY row_number() OVER (PARTITION BY job, metric, labels ORDER BY ts DESC, value DESC) = 1)
SELECT job, metric, labels, ts, value,
  CASE WHEN metric = 'rmse' AND value < 5 THEN 'green' WHEN metric = 'rmse' AND value < 10 THEN 'orange'
       WHEN metric = 'rmse' THEN 'red'
       WHEN metric = 'mae' AND value < 3 THEN 'green' WHEN metric = 'mae' AND value < 7 THEN 'orange'
       WHEN metric = 'mae' THEN 'red' END AS band
FROM newest""",
}
