import datetime as dt
import os
import subprocess
import sys

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from frames import rows_of
from kerbside import fixtures
from kerbside.operators import aggregates as agg
from kerbside.operators import rules
from kerbside.plans import ingest, load
from kerbside.plans.metrics import latest_metrics, metric_rows
from kerbside.plans.store import Store
from kerbside.schema import DATASETS
from kerbside.streaming.intake import run_stream
from test_sources import yellow_table

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2025, 6, 1)


@pytest.fixture(scope="module")
def derived(spark):
    """Trips of January to March of two types, as single raw files per type and month."""
    frame = fixtures.trips(spark, SF).filter(F.col("taxi_type").isin("yellow", "fhv")).persist()
    yield frame
    frame.unpersist()


@pytest.fixture(scope="module")
def raw_tables(derived):
    tables = {}
    for kind in ("yellow", "fhv"):
        raw = fixtures.raw_shape(derived, kind)
        for name in sorted(r.source_file for r in raw.select("source_file").distinct().collect()):
            part = raw.filter(F.col("source_file") == name).drop("source_file", "source_month")
            tables[name] = part.toArrow()
    return tables


def write(raw_dir, tables):
    os.makedirs(raw_dir, exist_ok=True)
    for name, table in tables.items():
        pq.write_table(table, f"{raw_dir}/{name}")


def stored(store):
    return {name: rows_of(_rounded(store.dataset(name))) for name in DATASETS}


def _rounded(frame):
    return frame.withColumns({n: F.round(n, 9) for n in frame.columns if n.startswith("stddev_")})


def statuses(manifest):
    return {r.file_name: r.status for r in manifest.collect()}


def test_month_by_month_equals_all_at_once(spark, tmp_path, raw_tables, derived):
    whole, steps = (Store(spark, str(tmp_path / name)) for name in ("whole", "steps"))
    write(tmp_path / "all", raw_tables)
    ingest.run(spark, str(tmp_path / "all"), whole.root, AS_OF)
    for month in ("02", "undated", "01", "03"):
        write(tmp_path / "growing", {n: t for n, t in raw_tables.items() if month in n.split("2023-")[-1]})
        ingest.run(spark, str(tmp_path / "growing"), steps.root, AS_OF)
    assert stored(steps) == stored(whole)
    clean = rules.clean(rules.validate_month(derived), as_of_year=AS_OF.year)
    assert stored(whole)["daily_stats"] == rows_of(agg.daily_stats(clean))

    # Nothing is pending any more; with force everything is done again, to the same end.
    assert ingest.run(spark, str(tmp_path / "all"), whole.root, AS_OF).count() == 0
    again = ingest.run(spark, str(tmp_path / "all"), whole.root, AS_OF, force=True)
    assert again.count() == len(raw_tables)
    assert stored(whole) == stored(steps)

    # The stream takes the same files to the same end, each once.
    streamed = Store(spark, str(tmp_path / "streamed"))
    for _ in range(2):
        run_stream(
            spark, str(tmp_path / "all"), streamed.root, str(tmp_path / "check"), AS_OF, files_per_batch=5
        ).awaitTermination()
    assert stored(streamed) == stored(whole)
    assert streamed.log("manifest").count() == len(raw_tables)


def test_crash_before_the_manifest_is_repaired(spark, tmp_path, raw_tables, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    raw = str(tmp_path / "raw")
    write(raw, {n: t for n, t in raw_tables.items() if "2023-01" in n})
    ingest.run(spark, raw, store.root, AS_OF)
    write(raw, {n: t for n, t in raw_tables.items() if "2023-02" in n})

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "refresh_datasets", crash)
    with pytest.raises(RuntimeError):
        ingest.run(spark, raw, store.root, AS_OF)
    monkeypatch.undo()
    ingest.run(spark, raw, store.root, AS_OF)
    whole = Store(spark, str(tmp_path / "whole"))
    ingest.run(spark, raw, whole.root, AS_OF)
    assert stored(store) == stored(whole)


def test_corrupt_and_empty_sources(spark, tmp_path, raw_tables):
    store = Store(spark, str(tmp_path / "store"))
    raw = tmp_path / "raw"
    name = "yellow_tripdata_2023-01.parquet"
    write(raw, {name: raw_tables[name], "notes.parquet": yellow_table()})
    (raw / "yellow_tripdata_2023-02.parquet").write_bytes(b"PAR1 cut off")
    assert statuses(ingest.run(spark, str(raw), store.root, AS_OF)) == {
        name: "done",
        "yellow_tripdata_2023-02.parquet": "corrupt",
        "notes.parquet": "skipped",
    }
    values = {
        (r.metric, r.labels): r.value
        for r in latest_metrics(store.log("run_metrics")).collect()
        if r.labels != "{}"
    }
    label = '{"taxi_type":"yellow"}'
    assert values[("files_processed", label)] == 1
    assert values[("files_corrupt", label)] == 1
    assert values[("rows_before", label)] == raw_tables[name].num_rows

    # The corrupt source stays pending; once repaired, it is taken.
    write(raw, {"yellow_tripdata_2023-02.parquet": raw_tables["yellow_tripdata_2023-02.parquet"]})
    assert statuses(ingest.run(spark, str(raw), store.root, AS_OF)) == {"yellow_tripdata_2023-02.parquet": "done"}

    # A source that has become empty replaces its rows by none.
    before = store.dataset("daily_stats").agg(F.sum("trip_count")).first()[0]
    write(raw, {name: raw_tables[name].slice(0, 0)})
    ingest.run(spark, str(raw), store.root, AS_OF, force=True)
    after = store.dataset("daily_stats").agg(F.sum("trip_count")).first()[0]
    assert after < before
    assert store.dataset("daily_stats").filter(F.month("pickup_date") == 1).count() == 0


def test_damage_inside_a_file_is_reported(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    path = raw / "yellow_tripdata_2023-01.parquet"
    pq.write_table(yellow_table(), path, compression="snappy", use_dictionary=False)
    data = bytearray(path.read_bytes())
    data[4:200] = bytes(196)
    path.write_bytes(data)
    store = Store(spark, str(tmp_path / "store"))
    assert statuses(ingest.run(spark, str(raw), store.root, AS_OF)) == {path.name: "partial"}
    pq.write_table(yellow_table(), path)
    assert statuses(ingest.run(spark, str(raw), store.root, AS_OF)) == {path.name: "done"}


def _store_with(spark, root, derived):
    store = Store(spark, str(root))
    store.write_states(agg.partials(derived, as_of_year=AS_OF.year))
    ingest.refresh_datasets(store, ["yellow", "fhv"])
    return store


def test_load(spark, tmp_path, derived):
    store = _store_with(spark, tmp_path / "store", derived)
    log = load.load(spark, store.root)
    assert {(r.dataset, r.taxi_type, r.status) for r in log.collect()} == {
        (d, t, "loaded") for d in DATASETS for t in ("yellow", "fhv")
    }
    for name in DATASETS:
        assert rows_of(store.serving(name)) == rows_of(store.dataset(name))
        assert store.serving(name).columns == DATASETS[name].fieldNames()
    assert load.load(spark, store.root).count() == 0

    # A changed partition is pending again, alone, and updates its rows in place.
    more = derived.filter(F.col("taxi_type") == "yellow").withColumn("source_file", F.lit("yellow_more.parquet"))
    store.write_states(agg.partials(more, as_of_year=AS_OF.year))
    ingest.refresh_datasets(store, ["yellow"])
    log = load.load(spark, store.root, only=[("daily_stats", "yellow")])
    assert [(r.dataset, r.taxi_type) for r in log.collect()] == [("daily_stats", "yellow")]
    assert rows_of(store.serving("daily_stats")) == rows_of(store.dataset("daily_stats"))

    load.reset(store)
    assert load.load(spark, store.root).count() == 2 * len(DATASETS)


def test_a_failing_partition_holds_up_no_other(spark, tmp_path, derived, monkeypatch):
    store = _store_with(spark, tmp_path / "store", derived)
    upsert_types = load._upsert_types

    def fail_for_fhv(store, dataset, types):
        if dataset == "daily_stats" and "fhv" in types:
            raise RuntimeError("bad partition")
        return upsert_types(store, dataset, types)

    monkeypatch.setattr(load, "_upsert_types", fail_for_fhv)
    log = {(r.dataset, r.taxi_type): r.status for r in load.load(spark, store.root).collect()}
    assert log.pop(("daily_stats", "fhv")) == "failed"
    assert set(log.values()) == {"loaded"}
    monkeypatch.undo()
    assert [(r.dataset, r.taxi_type) for r in load.changed_partitions(store).collect()] == [("daily_stats", "fhv")]


def test_serving_copy_survives_a_crash_while_writing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    schema = DATASETS["zone_time_buckets"]
    first = spark.createDataFrame([(1, "night", "yellow", 5)], schema)
    store.replace_serving("zone_time_buckets", first, ["yellow"])
    # The next version is written, but never committed.
    first.limit(0).write.parquet(f"{store.root}/serving/zone_time_buckets/version=2")
    assert rows_of(store.serving("zone_time_buckets")) == rows_of(first)
    second = store.serving("zone_time_buckets").withColumn("trip_count", F.lit(6).cast("bigint"))
    store.replace_serving("zone_time_buckets", second, ["yellow"])
    assert store.serving("zone_time_buckets").first().trip_count == 6


def test_latest_metrics(spark):
    old = metric_rows(spark, "m", [("rmse", {}, 4.0, None), ("mae", {}, 8.0, None)])
    new = metric_rows(spark, "m", [("rmse", {}, 12.0, None), ("status", {}, None, "ready")])
    log = old.withColumn("ts", F.lit("2024-01-01").cast("timestamp")).unionByName(new)
    found = {r.metric: (r.value, r.text, r.band) for r in latest_metrics(log).collect()}
    assert found == {"rmse": (12.0, None, "red"), "mae": (8.0, None, "red"), "status": (None, "ready", None)}


def test_extract_books(spark, tmp_path, raw_tables):
    from kerbside.plans.extract import fetch_list, record_extract

    store, raw = Store(spark, str(tmp_path / "store")), tmp_path / "raw"
    write(raw, {n: t for n, t in raw_tables.items() if n.startswith("yellow") and "02" not in n.split("2023-")[-1]})
    (raw / "fhv_tripdata_2023-01.parquet").write_bytes(b"PAR1 cut off")
    wanted = fetch_list(store, str(raw), dt.date(2023, 1, 1), dt.date(2023, 6, 1), ["yellow", "fhv"])
    assert {(r.file_name, r.status) for r in wanted.collect()} == {
        ("yellow_tripdata_2023-02.parquet", "MISSING"),
        ("fhv_tripdata_2023-01.parquet", "CORRUPT"),
        ("fhv_tripdata_2023-02.parquet", "MISSING"),
        ("fhv_tripdata_2023-03.parquet", "MISSING"),
    }
    log = spark.createDataFrame(
        [("u1", "a", "DOWNLOADED", 2.0), ("u2", "b", "NOT_FOUND", 1.0)],
        "url string, file_name string, outcome string, seconds double",
    )
    record_extract(store, str(raw), log, already_present=2)
    found = {(r.metric, r.labels): r.value for r in latest_metrics(store.log("run_metrics")).collect()}
    assert found[("files", '{"outcome":"ALREADY_EXISTS"}')] == 2
    assert found[("seconds", '{"outcome":"DOWNLOADED"}')] == 2.0
    assert found[("files", '{"outcome":"CHECK_FAILED"}')] == 0
    assert found[("files_on_disk", '{"taxi_type":"yellow"}')] == 3
    assert found[("files_on_disk", '{"taxi_type":"ALL"}')] == 4
    assert found[("bytes_on_disk", '{"taxi_type":"fhv"}')] == 12


def test_command_line(spark, tmp_path, raw_tables, capsys):
    from kerbside.__main__ import main

    raw, root = str(tmp_path / "raw"), str(tmp_path / "store")
    write(raw, {n: t for n, t in raw_tables.items() if "2023-01" in n})
    main(["run", raw, root, "--as-of", "2025-01-01"])
    main(["load", root])
    main(["status", root])
    assert "rows_loaded" in capsys.readouterr().out
    assert Store(spark, root).serving("daily_stats").count() > 0


def test_accounts_are_those_of_the_states(spark, tmp_path, raw_tables, monkeypatch):
    """Counted as they are written, or afterwards in what was written."""
    found = []
    write(tmp_path / "raw", raw_tables)
    for most in (ingest.OBSERVED_SOURCES, 0):
        monkeypatch.setattr(ingest, "OBSERVED_SOURCES", most)
        store = Store(spark, str(tmp_path / f"store{most}"))
        ingest.run(spark, str(tmp_path / "raw"), store.root, AS_OF)
        states = agg.source_accounts(store.states()).select("source_file", "rows_in", "rows_kept")
        manifest = store.log("manifest").select(F.col("file_name").alias("source_file"), "rows_in", "rows_kept")
        found.append(rows_of(manifest))
        assert found[-1] == rows_of(states)
    assert found[0] == found[1]


def test_a_task_that_runs_twice_is_counted_once(tmp_path):
    """In a session that retries: the first attempt of every task that writes states fails late."""
    code = f"""
import sys
sys.path[:0] = {[os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]!r}
from pyspark import TaskContext
from pyspark.sql import Observation
from pyspark.sql import functions as F
from kerbside import fixtures
from kerbside.operators import aggregates as agg
from kerbside.plans.store import Store
from kerbside.workspace import session

spark = session(**{{"spark.master": "local[2,4]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "3"}})
store = Store(spark, {str(tmp_path)!r})
states = agg.partials(fixtures.trips(spark, {SF!r}), as_of_year=2025)
def failing(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise OSError("lost")

def observe_and_fail(frame, *observed):
    return plain(frame, *observed).mapInArrow(failing, frame.schema)

plain, type(states).observe = type(states).observe, observe_and_fail
seen = Observation()
store.write_states(states, None, seen, [F.sum("trips").alias("n")])
type(states).observe = plain
assert seen.get["n"] == store.states().agg(F.sum("trips")).first()[0] == fixtures.trips(spark, {SF!r}).count(), seen.get
print("counted once")
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert "counted once" in done.stdout, done.stderr[-2000:]


def test_merging_load_keeps_what_is_gone(spark, tmp_path, derived):
    store = _store_with(spark, tmp_path / "store", derived)
    only = [("daily_stats", "yellow"), ("daily_stats", "fhv")]

    def keyed_rows(frame):
        rows = frame.select(*DATASETS["daily_stats"].fieldNames()).collect()
        return {(row.pickup_date, row.taxi_type): row for row in rows}

    load.load(spark, store.root, only=only, merge=True)
    before = keyed_rows(store.serving("daily_stats"))
    assert before == keyed_rows(store.dataset("daily_stats"))
    fewer = derived.filter((F.dayofmonth("pickup_datetime") % 2 == 0) & (F.hour("pickup_datetime") < 12))
    store.write_states(agg.partials(fewer, as_of_year=AS_OF.year))
    ingest.refresh_datasets(store, ["yellow", "fhv"])
    now = keyed_rows(store.dataset("daily_stats"))
    assert 0 < len(now) < len(before)
    load.load(spark, store.root, only=only, merge=True)
    assert keyed_rows(store.serving("daily_stats")) == before | now
    assert load.load(spark, store.root, only=only, merge=True).count() == 0
