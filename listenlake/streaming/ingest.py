"""From a message stream to the zones of the lake.

All of it is map-only: no shuffle and no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from listenlake.operators.conform import conform
from listenlake.operators.dedup import dedup_events
from listenlake.operators.parse import expand_json, parse_with_contract
from listenlake.operators.validate import split, with_zone
from listenlake.sinks.landing import with_ingest_hour
from listenlake.sources.landing import has_files

# Trigger intervals of the two zones.
CLEAN_TRIGGER = "30 seconds"
QUARANTINE_TRIGGER = "10 seconds"


def _trigger(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """A processing-time trigger, or, without an interval, all that is there and stop."""
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def _json_sink(
    df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None
) -> DataStreamWriter:
    writer = (
        df.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return writer.partitionBy(*partition_by) if partition_by else writer


def start_zone_queries(
    parsed: DataFrame,
    clean_path: str,
    quarantine_path: str,
    clean_checkpoint: str,
    quarantine_checkpoint: str,
    clean_trigger: str | None = CLEAN_TRIGGER,
    quarantine_trigger: str | None = QUARANTINE_TRIGGER,
    strict: bool = False,
    partition_clean_by: list[str] | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Two independent queries, each with its own path, checkpoint and pace.

    Both read the whole source; ``start_zones_single_scan`` reads it once.
    """
    good, bad = split(parsed, strict)
    first = _json_sink(good, clean_path, clean_checkpoint, partition_clean_by)
    second = _json_sink(bad, quarantine_path, quarantine_checkpoint, None)
    return (
        _trigger(first, clean_trigger).start(),
        _trigger(second, quarantine_trigger).start(),
    )


def start_zones_single_scan(
    parsed: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = CLEAN_TRIGGER,
    strict: bool = False,
    by_country: bool = False,
) -> StreamingQuery:
    """One query that writes ``zone=clean`` and ``zone=quarantine`` folders in one pass.

    The file sink commits both zones together, exactly once.  With ``by_country``
    the zones are divided further into ``country=…`` folders.
    """
    folders = ["zone", "country"] if by_country else ["zone"]
    return _trigger(
        _json_sink(with_zone(parsed, strict), path, checkpoint, folders), trigger
    ).start()


def start_dead_letters(
    messages: DataFrame, path: str, checkpoint: str, trigger: str | None = QUARANTINE_TRIGGER
) -> StreamingQuery:
    """Messages that break the contract, with their raw text and what is wrong."""
    broken = parse_with_contract(messages).filter(F.col("violation").isNotNull())
    letters = broken.select("raw", "violation", "kafka_ingest_time")
    return _trigger(_json_sink(letters, path, checkpoint, None), trigger).start()


def start_hourly_archive(
    messages: DataFrame, path: str, checkpoint: str, trigger: str | None = CLEAN_TRIGGER,
    records_per_file: int | None = None,
) -> StreamingQuery:
    """Keep every message text below the ``date=…/hour=…`` folder of its processing time."""
    text = messages.select(F.col("value").cast("string").alias("value"))
    dated = with_ingest_hour(text, F.current_timestamp())
    writer = (
        dated.writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("date", "hour")
        .outputMode("append")
    )
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    return _trigger(writer, trigger).start()


def start_table_load(
    spark: SparkSession,
    landing_path: str,
    schema: StructType,
    target_path: str,
    checkpoint: str,
    trigger: str | None = None,
    max_files_per_trigger: int | None = None,
    key: str | None = "event_id",
) -> StreamingQuery:
    """Load each landing file exactly once, and each ``key`` once, into a Parquet dataset.

    The checkpoint remembers the files, so an hourly rerun reads new ones only.  A
    micro-batch owns the folder ``load_id=<query>-<batch>`` and overwrites it, so a batch
    repeated after a crash leaves one copy; the query's id lives as long as its checkpoint.
    A new checkpoint reads the landing files once more, and what they bring again is found
    by its key: of the stored rows only that column is read.  Rows without a key all stay.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.json"
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = expand_json(
        reader.text(landing_path), F.col("value"), schema, [], drop_undecodable=True
    )
    layout = StructType([*schema.fields, StructField("load_id", StringType())])

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        load_id = f"{query}-{batch_id}"
        fresh = conform(batch, schema)
        if key:
            fresh = dedup_events(fresh, key)
            if has_files(session, target_path):
                others = session.read.schema(layout).parquet(target_path).where(F.col("load_id") != load_id)
                fresh = fresh.join(others.select(key), key, "left_anti").select(*schema.fieldNames())
        fresh.write.mode("overwrite").parquet(f"{target_path}/load_id={load_id}")

    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def await_any(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Block until one query ends, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()
