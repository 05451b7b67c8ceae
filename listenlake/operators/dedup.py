"""Exact removal of repeated events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold(df: DataFrame) -> DataFrame:
    """Equal rows of one task as one row with their number ``_times``.

    A third of all messages may be the same unreadable text; folding them before a
    shuffle leaves one row per task of it.
    """
    return df.groupBy(*df.columns, F.spark_partition_id().alias("_task")).agg(
        F.count(F.lit(1)).alias("_times")
    )


def unfold(folded: DataFrame) -> DataFrame:
    times = F.sequence(F.lit(1).cast("bigint"), "_times")
    return folded.withColumn("_n", F.explode(times)).drop("_n", "_times", "_task")


def dedup_events(df: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per ``key``: the smallest in column order, so reruns agree.

    A minimum has a map-side partial step, hence a key with very many copies costs
    one row per map task; a ranking window would bring all copies into one task.
    Rows without a key are no copies of each other and all stay: they are told
    apart by their content and task, and equal ones are counted and given back.
    """
    rest = [c for c in df.columns if c != key]
    keyless = F.col(key).isNull()
    apart = F.when(keyless, F.struct(F.spark_partition_id(), *rest)).alias("_apart")
    groups = df.groupBy(key, apart).agg(
        F.min(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("_n")
    )
    once = F.array(F.lit(1).cast("bigint"))
    times = F.when(keyless, F.sequence(F.lit(1).cast("bigint"), "_n")).otherwise(once)
    return groups.select(key, "_row.*", F.explode(times).alias("_time")).select(*df.columns)
