"""NDJSON zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_ndjson(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    records_per_file: int | None = None,
    mode: str = "append",
) -> None:
    """One JSON object per line; NULL fields are left out.

    With folders the rows are first gathered by folder, so that not every task
    writes a small file into each of them; AQE splits a folder that is too large
    for one task.
    """
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    writer.json(path)


def with_ingest_hour(df: DataFrame, ingest_time: Column) -> DataFrame:
    """Add the ``date`` and ``hour`` folders of an arrival time (UTC)."""
    return df.withColumns(
        {"date": F.date_format(ingest_time, "yyyy-MM-dd"), "hour": F.date_format(ingest_time, "HH")}
    )


def write_by_ingest_hour(
    df: DataFrame,
    path: str,
    ingest_time: Column | None = None,
    records_per_file: int | None = None,
) -> None:
    """Write below ``date=…/hour=…`` of the arrival time, by default now.

    A last, partly filled file is written like any other.  ``records_per_file`` is
    open by default: 10 per file, as a small consumer would do it, means a file
    system full of tiny files on a large topic.
    """
    moment = F.current_timestamp() if ingest_time is None else ingest_time
    write_ndjson(
        with_ingest_hour(df, moment), path, ["date", "hour"], records_per_file
    )
