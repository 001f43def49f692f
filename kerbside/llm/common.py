"""Helpers that several operators of this folder share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.workspace import scratch

# What separates words and is stripped from lines.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    Later steps do not compute it again, lost executors cost only the tasks that ran
    on them, and a join with it splits its hot keys.
    """
    path = scratch(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def numbered(frame: DataFrame, name: str, purpose: str) -> DataFrame:
    """The rows in their present order with a gapless number from 0 in column ``name``.

    The rows are written with their partition and place in it; one count per partition
    tells where each begins.
    """
    placed = stored(frame.withColumn("_place", F.monotonically_increasing_id()), purpose)
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    row = F.col("_place").bitwiseAND((1 << 33) - 1)
    joined = placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + row)
    return joined.drop("_part", "_place", "_before")


def small_batches(spark: SparkSession, rows: int = 1000, size: int | None = None) -> None:
    """Hand texts to Python in batches of so many rows (and bytes) at most, for the rest of the session.

    Whole texts of the usual batch of 10,000 rows, twice or more in a worker, are a good
    part of an executor's memory.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
    if size is not None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


Batches = Iterator[pa.RecordBatch]


def tidy(function: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function for ``mapInArrow`` that hands its free memory back to the system as a task ends.

    Python workers live on after their tasks, and what they hold counts for the executor
    through all stages that follow, also those without Python.
    """

    def run(batches: Batches) -> Batches:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
            if trim is not None:
                trim(0)

    return run


#: ASCII letters and digits and all bytes of other characters stay; the rest becomes a space.
_ALPHANUMERIC = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def spaced(text: bytes | None) -> bytes:
    """A UTF-8 text with A to Z in lower case, and spaces for ASCII other than letters and digits."""
    return (text or b"").lower().translate(_ALPHANUMERIC)


def pieces(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text with spaces between words, in pieces of about ``size`` bytes that end between words."""
    at = 0
    while at < len(text):
        stop = text.find(b" ", at + size)
        stop = len(text) if stop < 0 else stop
        yield text[at:stop]
        at = stop + 1


def text_of(column: str | Column = "text") -> Column:
    """A text, empty if null."""
    return F.coalesce(column if isinstance(column, Column) else F.col(column), F.lit(""))


def fill(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the named columns, of the given types; null where the frame lacks one."""
    have = set(frame.columns)
    return frame.select(
        *[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()]
    )


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equality of the named columns of both, null equal to null."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition
