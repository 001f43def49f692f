"""Keyed rows: conform to a schema, keep the last of each key, upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, size_within


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in all floating-point columns."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: F.nanvl(F.col(name), F.lit(None)) for name in floating})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` in order: cast what is there, NULL for the rest.

    Fractions are rounded on their way into whole numbers, as a database does on
    assignment; values that do not fit become NULL.
    """
    present = {field.name: field.dataType for field in df.schema.fields}
    columns = []
    for field in schema.fields:
        value = F.col(field.name) if field.name in present else F.lit(None)
        fractional = isinstance(present.get(field.name), (T.DoubleType, T.FloatType))
        if fractional and isinstance(field.dataType, T.IntegralType):
            value = F.rint(value)
        if present.get(field.name) != field.dataType:
            value = value.try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def dedupe_last(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Keep the row of the highest ``version`` per key; equal versions are settled by
    the remaining columns, so that the outcome never depends on file or task order.

    A maximum over rows is combined in the map tasks already: a key with very many
    copies reaches the shuffle as one row per task, where a window would sort them
    all in one place.
    """
    payload = [name for name in df.columns if name not in keys and name != version]
    newest = F.max(F.struct(version, *payload)).alias("_newest")
    picked = df.groupBy(*keys).agg(newest)
    return picked.select(
        *[F.col(name) if name in keys else F.col(f"_newest.{name}").alias(name) for name in df.columns]
    )


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and rows that ``dedupe_last`` drops."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dropped"),
    )


def upsert_small(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The same as ``upsert``, without moving the target, if ``source`` is small.

    A source within the bounds, which are measured, is broadcast: the target is read in
    place once for its rows, and once more, by its keys only, for what of the source is
    new. No more keys than the source has come out of that. A larger source goes through
    ``upsert``. The source is read three times: give a stored one.
    """
    if size_within(source, broadcast_rows, broadcast_bytes) is None:
        return upsert(target, source, keys)
    updated = _merge(target, source, keys, "left", F.broadcast)
    held = target.select(*keys).join(F.broadcast(source.select(*keys)), list(keys), "left_semi")
    added = source.join(F.broadcast(held), list(keys), "left_anti")
    return updated.unionByName(added, allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` after inserting or updating the rows of ``source`` by ``keys``.

    Every column that ``source`` brings is overwritten, also by NULL; columns it
    lacks keep their value, or are NULL in new rows. Keys are unique on both
    sides, so the join meets at most one partner per row.
    """
    return _merge(target, source, keys, "full_outer", lambda frame: frame)


def _merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], how: str, hinted: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The target joined with the source by ``how``, each column from the source where it has the row."""
    unknown = [name for name in source.columns if name not in target.columns]
    if unknown:
        raise ValueError(f"columns not in the target: {unknown}")
    incoming = source.select(
        *keys,
        F.lit(True).alias("_incoming"),
        *[F.col(name).alias(f"_new_{name}") for name in source.columns if name not in keys],
    )
    joined = target.join(hinted(incoming), list(keys), how)

    def merged(name: str):
        if name in keys or name not in source.columns:
            return F.col(name)
        return F.when(F.col("_incoming"), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)

    return joined.select(*[merged(name) for name in target.columns])
