"""Run one stage: ``python -m kerbside STAGE …`` (with spark-submit: a one-line script that calls ``main``)."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import DataFrame

from kerbside.plans import flags, ingest, load, models
from kerbside.plans.metrics import latest_metrics
from kerbside.plans.store import Store
from kerbside.streaming.intake import run_stream
from kerbside.workspace import session


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="kerbside")
    stages = parser.add_subparsers(dest="stage", required=True)

    def stage(name: str, text: str, *, raw: bool = False) -> argparse.ArgumentParser:
        sub = stages.add_parser(name, help=text)
        if raw:
            sub.add_argument("raw_dir")
        sub.add_argument("store_dir")
        return sub

    run = stage("run", "process pending raw files", raw=True)
    stream = stage("stream", "process new raw files as a stream, then stop", raw=True)
    stream.add_argument("checkpoint")
    for sub in (run, stream):
        sub.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    load_ = stage("load", "upsert changed datasets into the serving tables")
    for sub in (run, load_):
        sub.add_argument("--force", action="store_true", help="treat everything as pending")
    load_.add_argument("--merge", action="store_true", help="keep rows that are gone from the datasets")
    flag_ = stage("flag", "flag trips of ingested files against the zone statistics", raw=True)
    flag_.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    flag_.add_argument("--threshold", type=float, default=flags.THRESHOLD)
    stage("train-fare", "train the fare model").add_argument("model_dir")
    stage("reset", "make a stage start afresh").add_argument(
        "--only", choices=("transform", "load", "flag"), default=None
    )
    stage("status", "show the latest metrics")
    return parser.parse_args(argv)


def _print(rows: DataFrame) -> None:
    """All rows, as tab-separated text; they pass through the driver one partition at a time."""
    print(*rows.columns, sep="\t")
    for row in rows.toLocalIterator():
        print(*row, sep="\t")


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = session(f"kerbside-{args.stage}")
    store = Store(spark, args.store_dir)
    if args.stage == "run":
        _print(ingest.run(spark, args.raw_dir, args.store_dir, args.as_of, args.force))
    elif args.stage == "stream":
        run_stream(spark, args.raw_dir, args.store_dir, args.checkpoint, args.as_of).awaitTermination()
    elif args.stage == "load":
        _print(load.load(spark, args.store_dir, force=args.force, merge=args.merge))
    elif args.stage == "flag":
        _print(flags.flag(spark, args.raw_dir, args.store_dir, args.as_of, args.threshold))
    elif args.stage == "train-fare":
        _print(models.train_fare_in_store(store, args.model_dir).metrics_frame(spark))
    elif args.stage == "reset":
        load.reset(store, args.only)
    else:
        _print(latest_metrics(store.log("run_metrics")).orderBy("job", "metric", "labels"))


if __name__ == "__main__":
    main(sys.argv[1:])
