"""Tables and views of the lake."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from listenlake import schemas
from listenlake.functions.times import parse_event_ts
from listenlake.operators.conform import to_bronze, to_bronze_quarantine, to_legacy_bronze
from listenlake.operators.dedup import fold, unfold
from listenlake.sinks import loads, releases

# Day of rows whose time is missing or does not parse.
NO_DAY = "1970-01-01"


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def ensure_table(
    spark: SparkSession, table: str, schema: StructType, partition_by: str | None = None
) -> None:
    """Create an empty Parquet table unless it exists."""
    layout = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schemas.ddl(schema)}) USING parquet{layout}"
    )


def save_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def save_table(df: DataFrame, table: str, partition_by: str | None = None) -> DataFrame:
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def day_of(ts: Column) -> Column:
    return F.coalesce(F.to_date(parse_event_ts(ts)), F.lit(NO_DAY).cast("date"))


def _balanced(df: DataFrame, column: str) -> DataFrame:
    """Gather a folder's rows in few tasks before a partitioned write; AQE splits the
    days that are too large for one task and merges the small ones."""
    return df.hint("rebalance", column)


def append_rows(df: DataFrame, table: str) -> None:
    names = df.sparkSession.table(table).columns
    df.select(*names).write.mode("append").insertInto(table)


def held_days(spark: SparkSession, table: str, day: str, incoming: DataFrame) -> DataFrame:
    """The rows of ``table`` on the days that ``incoming`` has rows for.

    The first and last of these days prune the folders; the days themselves stay a relation.
    """
    real = F.when(F.col(day) != F.lit(NO_DAY).cast("date"), F.col(day))
    first, last = incoming.agg(F.min(real), F.max(real)).first()
    within = F.col(day).between(F.lit(first), F.lit(last)) | (F.col(day) == F.lit(NO_DAY).cast("date"))
    return spark.table(table).where(within).join(incoming.select(day).distinct(), day, "left_semi")


def bronze_rows(landing: DataFrame) -> DataFrame:
    """The 17 event fields with the event day."""
    return to_bronze(landing).withColumn("event_date", day_of(F.col("timestamp")))


def bronze_quarantine_rows(landing: DataFrame) -> DataFrame:
    """The 11 columns of rejected events with the day of rejection."""
    return to_bronze_quarantine(landing).withColumn("rejected_date", day_of(F.col("_rejected_at")))


def load_bronze(landing: DataFrame, table: str, once: bool = True) -> None:
    """Load clean events into the bronze table in bulk, creating it if needed.

    With ``once`` an event id is stored one time, whatever its day and whichever load
    brings it; rows without an id are all stored.  Without it every row is appended, and
    reruns make copies.  ``table`` shows the 17 event fields and ``event_date``, by which
    it is laid out.
    """
    spark, load_id = landing.sparkSession, loads.new_load()
    loads.ensure_target(spark, table, schemas.EVENT, "event_date", "event_id")
    loads.stage(bronze_rows(landing), table, load_id, "event_date", "event_id", once)
    loads.commit(spark, loads.schema_of(table), load_id)


def load_bronze_quarantine(landing: DataFrame, table: str, once: bool = True) -> None:
    """Load rejected events (11 columns), laid out by the day of rejection.

    Rejected rows may lack every key, so ``once`` compares all columns with those that
    are stored for the same days; equal rows of one load all stay.
    """
    spark, load_id = landing.sparkSession, loads.new_load()
    loads.ensure_target(spark, table, schemas.QUARANTINE, "rejected_date")
    rows = bronze_quarantine_rows(landing)
    if once:
        # Equal rows are folded per task first: both sides are then free of hot keys.
        folded = fold(rows).persist(StorageLevel.MEMORY_AND_DISK)
        keys = ["rejected_date", *schemas.QUARANTINE_COLUMNS]
        old = held_days(spark, table, "rejected_date", folded).select(*keys).distinct().alias("old")
        same = reduce(lambda a, b: a & b, [F.col(f"new.{k}").eqNullSafe(F.col(f"old.{k}")) for k in keys])
        try:
            rows = unfold(folded.alias("new").join(old, same, "left_anti"))
            loads.stage(rows, table, load_id, "rejected_date")
        finally:
            folded.unpersist()
    else:
        loads.stage(rows, table, load_id, "rejected_date")
    loads.commit(spark, loads.schema_of(table), load_id)


def load_legacy_bronze(landing: DataFrame, table: str) -> None:
    """Append to the older 9-column bronze table."""
    rows = to_legacy_bronze(landing)
    ensure_table(landing.sparkSession, table, schemas.LEGACY_EVENT)
    append_rows(rows, table)


def write_silver(silver: DataFrame, path: str, only_given_days: bool = False) -> DataFrame:
    """Silver as Parquet by event day, so that time filters prune folders.

    ``only_given_days`` replaces the days that occur in ``silver`` and leaves the
    others as they are; otherwise the whole dataset is replaced.
    """
    dated = silver.withColumn("event_date", F.to_date("event_ts"))
    (
        _balanced(dated, "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_given_days else "static")
        .partitionBy("event_date")
        .parquet(path)
    )
    return read_silver(silver.sparkSession, path)


STORED_SILVER = StructType(schemas.SILVER.fields + [StructField("event_date", DateType(), True)])


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Stored silver: of a published lake what its release names, else the files there."""
    release = releases.current(spark, path)
    if release.number:
        return releases.read(spark, release, "silver", STORED_SILVER)
    return spark.read.schema(STORED_SILVER).parquet(path)


def append_run(record: DataFrame, table: str) -> None:
    """Add a run's metrics and parameters to the run log."""
    ensure_table(record.sparkSession, table, record.schema)
    append_rows(record.coalesce(1), table)
