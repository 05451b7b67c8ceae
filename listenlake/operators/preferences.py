"""Most frequent device per group, ties broken by device name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.functions.measures import EVENTS, Measures


def _leading_device(silver: DataFrame, group: str, name: str, m: Measures) -> DataFrame:
    """Counts per (group, device) first; the choice then is a minimum over few rows
    that combines map-side, with no ranking of a whole group."""
    counts = silver.groupBy(group, "device_type").agg(m.events().alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("device_type")))
    return (
        counts.groupBy(group)
        .agg(best.alias("best"))
        .select(
            group,
            F.col("best.device_type").alias(name),
            (-F.col("best.rank")).alias("events"),
        )
    )


def preferred_device(silver: DataFrame, m: Measures = EVENTS) -> DataFrame:
    return _leading_device(silver, "user_id", "preferred_device", m)


def country_top_device(silver: DataFrame, m: Measures = EVENTS) -> DataFrame:
    return _leading_device(silver, "country", "top_device", m)
