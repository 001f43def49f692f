"""What a raw file's name says: taxi type and month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.schema import MONTH_PATTERN, TYPE_PATTERN

NO_SUCH_MONTH = dt.date(1900, 1, 1)

# A source is one Parquet file, or a directory of part files that carries the
# source's name (also in key=value form), as Spark itself writes them.
_SOURCE_PATTERN = r"([^/=]+\.parquet)(?:/part-[^/]+)?$"


def source_file(path: Column) -> Column:
    """Name of the source that a data file belongs to."""
    return F.regexp_extract(path, _SOURCE_PATTERN, 1)


def source_folder(path: Column) -> Column:
    """What comes before the source's name: folder and name together are the path of the source."""
    return F.regexp_replace(path, _SOURCE_PATTERN, "")


def taxi_type(name: Column) -> Column:
    """Taxi type named by a source; NULL if it names none."""
    return F.nullif(F.regexp_extract(name, TYPE_PATTERN, 1), F.lit(""))


def source_month(name: Column) -> Column:
    """First day of the month named by a source; NULL if it carries no date.

    A date that does not exist (month 13) gives a day long before any trip that can be kept.
    """
    year, month = (F.regexp_extract(name, MONTH_PATTERN, group) for group in (1, 2))
    first_day = F.concat_ws("-", year, month, F.lit("01")).try_cast("date")
    return F.when(year != "", F.coalesce(first_day, F.lit(NO_SUCH_MONTH)))
