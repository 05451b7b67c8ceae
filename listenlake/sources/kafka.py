"""Message log sources.

The connector is not part of PySpark: start the session with the package
``org.apache.spark:spark-sql-kafka-0-10_2.13`` of the same Spark version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    group_id: str | None = None,
) -> dict[str, str]:
    """Options of a one-topic scan from the start that tolerates expired offsets.

    ``max_offsets_per_trigger`` limits a micro-batch; leave it open to catch up at
    full speed.  Progress lives in the query's checkpoint; ``group_id`` only labels
    the consumer for monitoring.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if group_id is not None:
        options["kafka.group.id"] = group_id
    return options


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def kafka_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The same topic as a bounded relation, from the first to the newest offset."""
    bounded = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    return spark.read.format("kafka").options(**bounded).load()
