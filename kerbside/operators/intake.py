"""Which raw files are pending, and how to make them pending again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A source is known by its folder and name; its fingerprint tells whether it has changed.
_SOURCE = ("source_folder", "file_name")
_FINGERPRINT = ("parts", "length", "newest")
SETTLED = ("done", "skipped")


def _known(frame: DataFrame) -> DataFrame:
    """With a folder, which frames of one folder may leave out."""
    return frame if "source_folder" in frame.columns else frame.withColumn("source_folder", F.lit(""))


def latest_status(manifest: DataFrame) -> DataFrame:
    """The status in force of each stage and source, with its fingerprint: that of its newest row."""
    kept = [name for name in ("status", *_FINGERPRINT) if name in manifest.columns]
    last = F.max_by(F.struct(*kept), F.struct("committed_at", "status")).alias("last")
    return _known(manifest).groupBy("stage", *_SOURCE).agg(last).select("stage", *_SOURCE, "last.*")


def fingerprints(files: DataFrame) -> DataFrame:
    """Number of files, total length and newest change of each source of a listing."""
    return _known(files).groupBy(*_SOURCE).agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum("length").alias("length"),
        (F.max("mtime") if "mtime" in files.columns else F.lit(None).cast("timestamp")).alias("newest"),
    )


def pending(files: DataFrame, manifest: DataFrame, stage: str = "transform") -> DataFrame:
    """All files of the sources that a stage has not processed to the end as they are now.

    A source that has gained, lost or changed a file since is pending as a whole.
    """
    settled = latest_status(manifest.filter(F.col("stage") == stage)).filter(F.col("status").isin(*SETTLED))
    known = [name for name in _FINGERPRINT if name in settled.columns]
    now = fingerprints(files)
    unchanged = F.lit(True)
    for name in (*_SOURCE, *known):
        unchanged = unchanged & now[name].eqNullSafe(settled[name])
    todo = now.join(settled, unchanged, "left_anti").select(*_SOURCE)
    return _known(files).join(todo, list(_SOURCE), "left_semi").select(*files.columns)


def reset_rows(manifest: DataFrame, stage: str | None = None) -> DataFrame:
    """Rows to append to the manifest so that a stage, or every stage, starts afresh.

    The log is never rewritten: a reset is one more row per source, newer than the
    row it cancels. Raw files stay untouched.
    """
    selected = manifest if stage is None else manifest.filter(F.col("stage") == stage)
    live = latest_status(selected).filter(F.col("status") != "reset").select("stage", *_SOURCE)
    return live.withColumns({"status": F.lit("reset"), "committed_at": F.current_timestamp()})
