"""Typed silver events and their complement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.functions.reasons import bronze_reason
from listenlake.functions.times import parse_event_ts
from listenlake.schemas import SILVER_COLUMNS

_IDS_PRESENT = (
    "event_id IS NOT NULL AND user_id IS NOT NULL AND song_id IS NOT NULL"
)


def silver_events(bronze: DataFrame) -> DataFrame:
    """Valid bronze rows, ``timestamp`` text replaced by the parsed ``event_ts``."""
    typed = bronze.withColumn("event_ts", parse_event_ts(F.col("timestamp")))
    valid = typed.filter(F.expr(_IDS_PRESENT) & F.col("event_ts").isNotNull())
    return valid.select(*SILVER_COLUMNS)


def silver_quarantine(bronze: DataFrame, rejected_at: Column | None = None) -> DataFrame:
    """Bronze rows that silver leaves out, with the reason and the time of rejection."""
    valid = F.expr(_IDS_PRESENT) & parse_event_ts(F.col("timestamp")).isNotNull()
    stamp = F.current_timestamp() if rejected_at is None else rejected_at
    return bronze.filter(~valid).withColumns(
        {"reject_reason": bronze_reason(), "rejected_at": stamp}
    )
