"""Message files as a stream: the offline twin of the message log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """One message per text line: ``value`` (binary) and ``timestamp`` (file time)."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.text(path)
    return lines.select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )
