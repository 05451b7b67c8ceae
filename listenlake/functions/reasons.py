"""Why an event was rejected: the first rule that fails names the reason."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Required fields in the order in which they are checked.
REQUIRED = ["event_id", "user_id", "song_id", "timestamp"]


def missing(name: str, strict: bool = False) -> Column:
    """NULL counts as missing; in strict mode a blank text does too."""
    field = F.col(name)
    return F.nullif(F.trim(field), F.lit("")).isNull() if strict else field.isNull()


def complete(strict: bool = False) -> Column:
    """All required fields are there. Never NULL, so ``~complete()`` is its complement."""
    return reduce(lambda a, b: a & b, [~missing(n, strict) for n in REQUIRED])


def _first_missing(separator: str, otherwise: str, strict: bool = False) -> Column:
    label = [F.when(missing(n, strict), F.lit(f"missing{separator}{n}")) for n in REQUIRED]
    return F.coalesce(*label, F.lit(otherwise))


def landing_reason(strict: bool = False) -> Column:
    """Reason codes of the landing zone (``missing_event_id`` ... ``unknown``)."""
    return _first_missing("_", "unknown", strict)


def bronze_reason() -> Column:
    """Reason texts of the bronze check (``missing event_id`` ... ``invalid timestamp``)."""
    return _first_missing(" ", "invalid timestamp")
