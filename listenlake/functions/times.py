"""Event-time expressions; weekday 0 is Sunday."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


# A whole date, with or without a time of day and an offset.  Spark alone would also take
# '10:00' as a time of today and '2024' as the first of January.
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"


def parse_event_ts(text: Column) -> Column:
    """Timestamp of an ISO text, NULL (never an error) when it is none."""
    return F.when(text.rlike(_ISO), F.try_to_timestamp(text))


def weekday(ts: Column) -> Column:
    return F.dayofweek(ts) - 1


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def as_of_date(as_of: str | date | Column | None) -> Column:
    """A pinned day for reproducible runs, today when none is given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return F.to_date(as_of)
    return F.lit(str(as_of)).cast("date")
