"""Join a large side with a side that is expected, but not known, to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
SALTS = 32
_FIXED_BYTES = 16  # of a column of numbers, with its share of the row


def size_within(frame: DataFrame, most_rows: int, most_bytes: int) -> int | None:
    """The number of rows of a frame, if it and their bytes lie within the bounds; else None.

    Strings and other values of variable length are measured.
    """
    fixed, measured = 0, []
    for field in frame.schema.fields:
        if isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
            fixed += _FIXED_BYTES
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            measured.append(F.octet_length(F.col(f"`{field.name}`")))
        else:
            measured.append(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))))
    width = F.lit(fixed)
    for length in measured:
        width = width + F.coalesce(length, F.lit(0)) + _FIXED_BYTES
    # More rows than allowed need not be read.
    some = frame.limit(most_rows + 1).select(width.cast("bigint").alias("width"))
    row = some.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("width"), F.lit(0)).alias("bytes")).first()
    return row["rows"] if row["rows"] <= most_rows and row["bytes"] <= most_bytes else None


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    lookup_rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner or left join of ``large`` with ``lookup``, which is unique by ``keys``.

    Up to ``broadcast_rows`` lookup rows of ``broadcast_bytes`` together are broadcast
    and the large side is not shuffled. Rows and bytes are measured first, unless the
    caller knows the number of rows and that they are short. Beyond that both sides
    shuffle on key and salt: rows of a hot key spread over ``salts`` tasks, and each
    lookup row is repeated once per salt. The salt comes from the row and its input partition: equal copies of a row
    spread too, and a re-run task gives the same salts again.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    if lookup_rows is None:
        lookup_rows = size_within(lookup, broadcast_rows, broadcast_bytes)
    if lookup_rows is not None and lookup_rows <= broadcast_rows:
        return large.join(F.broadcast(lookup), list(keys), how)
    salt = F.pmod(F.xxhash64(*large.columns, F.spark_partition_id()), F.lit(salts).cast("bigint"))
    each = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    repeated = lookup.withColumn("_salt", F.explode(each))
    return large.withColumn("_salt", salt).join(repeated, [*keys, "_salt"], how).drop("_salt")
