"""Map the raw columns of each taxi type to the unified trip schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.schema import RAW_COLUMNS, TRIP_SCHEMA


def normalise(raw: DataFrame, taxi_type: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Unified trips of one type; ``keep`` passes further columns through.

    Source names match without regard to case. A column that the type or the
    file lacks becomes a typed NULL, a value that does not fit its type too.
    """
    present = {name.lower(): name for name in raw.columns}
    sources = RAW_COLUMNS[taxi_type]
    columns = []
    for field in TRIP_SCHEMA.fields:
        source = present.get(sources.get(field.name, "").lower())
        if field.name == "taxi_type":
            value = F.lit(taxi_type)
        elif source is None:
            value = F.lit(None).cast(field.dataType)
        elif raw.schema[source].dataType == field.dataType:
            value = F.col(source)
        else:
            value = F.col(source).try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return raw.select(*columns, *keep)


def union_trips(frames: list[DataFrame]) -> DataFrame:
    """One frame of all unified trips; a column that a frame lacks becomes NULL."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
