"""Mergeable aggregate states: counts, exact sums and second moments.

A state holds, per measure, the number of values, their sum and (where a
deviation is asked for) the sum of their squares. Sums are kept as integers in a
fixed unit, because integer addition gives the same result in any order: re-run
tasks, another partitioning or a month-by-month build all yield bit-equal averages
and deviations, and states combine by sums alone. Values are rounded to the unit (a
millionth, or a second of duration). The sums are decimals of 38 digits: cleaning
keeps a squared value below 1e18, so that no history is long enough to overflow
them. Infinities, NaN and single values that 64 bits of units cannot hold go to a
plain floating-point remainder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """One averaged column of the trips.

    ``scale`` is the number of units in 1. ``bounded`` says that cleaning bounds the
    column, so that it needs no remainder. ``spread`` asks for the second moment.
    """

    name: str
    column: str
    scale: float
    bounded: bool = True
    spread: bool = False


MEASURES = (
    Measure("duration", "trip_duration_minutes", 60.0, spread=True),  # whole seconds
    Measure("distance", "trip_distance", 1e6, spread=True),
    Measure("fare", "fare_amount", 1e6, spread=True),
    Measure("total", "total_amount", 1e6, bounded=False),
    Measure("passengers", "passenger_count", 1e6, bounded=False),
)
_BY_NAME = {m.name: m for m in MEASURES}
TRIPS = "trips"
UNITS = "decimal(38,0)"
_MOST_UNITS = 9e18  # units of one value that 64 bits hold
_ROOT_OF_MOST = 3_000_000_000  # units whose square 64 bits hold


def _cnt(m: Measure) -> str:
    return f"{m.name}_cnt"


def _units(m: Measure) -> str:
    return f"{m.name}_units"


def _rest(m: Measure) -> str:
    return f"{m.name}_rest"


def _squares(m: Measure) -> str:
    return f"{m.name}_squares"


def state_columns() -> list[tuple[str, str]]:
    """Names and types of the columns of a state, in order."""
    columns = [(TRIPS, "bigint")]
    for m in MEASURES:
        columns += [(_cnt(m), "bigint"), (_units(m), UNITS)]
        if not m.bounded:
            columns.append((_rest(m), "double"))
        if m.spread:
            columns.append((_squares(m), UNITS))
    return columns


def is_state(df: DataFrame) -> bool:
    return TRIPS in df.columns


def summarise(trips: DataFrame, keys: list[str], counted: Column | None = None) -> DataFrame:
    """States of ``trips`` by ``keys``; rows outside ``counted`` enter the row count only.

    Every aggregate is partial, so map tasks combine first and a hot key costs
    one row per map task in the shuffle. Measures that a caller does not go on
    to use are pruned from the plan.
    """
    aggregates = [F.count(F.lit(1)).alias(TRIPS)]
    for m in MEASURES:
        value = F.col(m.column) if counted is None else F.when(counted, F.col(m.column))
        fits = F.abs(value) < _MOST_UNITS / m.scale
        exact = value if m.bounded else F.when(fits, value)
        units = F.rint(exact * m.scale).cast("bigint")
        aggregates += [
            F.count(value).alias(_cnt(m)),
            F.sum(units.cast("decimal(19,0)")).cast(UNITS).alias(_units(m)),
        ]
        if not m.bounded:
            aggregates.append(F.sum(F.when(~fits, value)).alias(_rest(m)))
        if m.spread:
            aggregates.append(F.sum(_square(units)).cast(UNITS).alias(_squares(m)))
    return trips.groupBy(*keys).agg(*aggregates)


def _square(units: Column) -> Column:
    """The square of a number of units: in 64 bits, where they hold it."""
    small = F.abs(units) < _ROOT_OF_MOST
    wide = units.cast("decimal(19,0)")
    return F.when(small, (units * units).cast("decimal(19,0)").cast(UNITS)).otherwise(wide * wide)


def merge(states: DataFrame, keys: list[str], spread: bool = False) -> DataFrame:
    """Combine states to coarser ``keys``: every column is a sum.

    The aggregate combines in the map tasks, however hot a key is.
    """
    wanted = [(name, kind) for name, kind in state_columns() if spread or not name.endswith("_squares")]
    return states.groupBy(*keys).agg(*[F.sum(name).cast(kind).alias(name) for name, kind in wanted])


def _whole(units: Column, m: Measure) -> Column:
    return units.cast("double") / F.lit(m.scale)


def total(name: str) -> Column:
    """Sum of a measure; NULL if it has no value."""
    m = _BY_NAME[name]
    units = _whole(F.col(_units(m)), m)
    if m.bounded:
        return units
    whole = F.coalesce(units, F.lit(0.0)) + F.coalesce(F.col(_rest(m)), F.lit(0.0))
    return F.when(F.col(_cnt(m)) > 0, whole)


def mean(name: str) -> Column:
    """Average of a measure; NULL if it has no value."""
    count = F.col(_cnt(_BY_NAME[name]))
    return F.when(count > 0, total(name) / count)


def deviation(name: str) -> Column:
    """Sample standard deviation of a measure; NULL for fewer than two values.

    The squares are taken around a whole number of units near the mean, exactly. What
    remains of the mean after that is at most half a unit, so that little is lost to
    cancellation, however small the spread is.
    """
    m = _BY_NAME[name]
    count, units = F.col(_cnt(m)), F.col(_units(m))
    n = count.cast("decimal(19,0)")
    centre = F.rint(units.cast("double") / count).cast("bigint").cast("decimal(19,0)")
    around = (F.col(_squares(m)) - centre * (units + units - n * centre)).cast("double")
    left = (units - n * centre).cast("double")
    variance = F.greatest(around - left * left / count, F.lit(0.0)) / (count - 1)
    return F.when(count > 1, F.sqrt(variance) / F.lit(m.scale))
