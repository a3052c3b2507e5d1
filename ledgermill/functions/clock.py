"""Time expressions that take their point in time as an argument, so a replay gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def convert_tz(moment: Column, source: str, target: str) -> Column:
    """Wall-clock time of one zone as wall-clock time of another."""
    return F.convert_timezone(F.lit(source), F.lit(target), moment.cast("timestamp_ntz"))


def last_hours(frame: DataFrame, column: str, hours: int, as_of: Column | None = None) -> DataFrame:
    """Rows not older than so many hours at ``as_of``, by default at the newest row."""
    end = frame.agg(F.max(column)).scalar() if as_of is None else as_of
    return frame.filter(F.col(column) >= end - F.make_dt_interval(hours=F.lit(hours)))
