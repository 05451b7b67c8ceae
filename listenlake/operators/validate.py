"""Routing of parsed events into the clean and the quarantine zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.functions.reasons import complete, landing_reason


def clean(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """Events that carry all required fields."""
    return parsed.filter(complete(strict))


def quarantine(
    parsed: DataFrame, strict: bool = False, rejected_at: Column | None = None
) -> DataFrame:
    """The complement of ``clean``, with a reason code and the time of rejection."""
    stamp = F.current_timestamp() if rejected_at is None else rejected_at
    return parsed.filter(~complete(strict)).withColumns(
        {"_reject_reason": landing_reason(strict), "_rejected_at": stamp.cast("string")}
    )


def split(parsed: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    return clean(parsed, strict), quarantine(parsed, strict)


def with_zone(
    parsed: DataFrame, strict: bool = False, rejected_at: Column | None = None
) -> DataFrame:
    """Both zones in one relation, told apart by ``zone``: one pass over the input.

    Reject columns are NULL on clean rows; the JSON writer leaves NULL fields out,
    so files of the clean zone look as if these columns did not exist.
    """
    ok = complete(strict)
    stamp = F.current_timestamp() if rejected_at is None else rejected_at
    return parsed.withColumns(
        {
            "_reject_reason": F.when(~ok, landing_reason(strict)),
            "_rejected_at": F.when(~ok, stamp.cast("string")),
            "zone": F.when(ok, "clean").otherwise("quarantine"),
        }
    )
