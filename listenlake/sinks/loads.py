"""Loads that become visible as a whole, read each landing file once and each event id once.

A load writes its rows, the ids among them and the files it read under its own ``load_id``.
None of it counts until one row in ``<schema>.loads`` names that id: the tables' views show
rows of committed loads only.  A load that fails, in a task or in a check, leaves every
view as it was, and its rows are never seen.

========================  =========================================================
``<schema>.loads``        committed loads: the pointer
``<schema>.loaded_files`` ledger of landing files (path, length, time) by load
``<table>_rows``          rows with ``load_id``, laid out by day
``<table>_ids``           ids with ``load_id``, bucketed by id
``<table>``               view of the committed rows
========================  =========================================================

An id is looked up in the bucketed table whatever its day.  The stored ids are read where
they lie and only the incoming ones are shuffled.  One load at a time writes to a schema, as
a scheduler runs it.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from listenlake import schemas
from listenlake.operators.dedup import dedup_events
from listenlake.operators.parse import expand_json

# Buckets of a new table of ids: as many as tasks shall look ids up side by side.
BUCKETS = 64
_LOADS = "load_id STRING, committed_at TIMESTAMP"
_FILES = "path STRING, length BIGINT, modified TIMESTAMP, load_id STRING"


def schema_of(table: str) -> str:
    return table.rsplit(".", 1)[0]


def new_load() -> str:
    return uuid.uuid4().hex


def ensure_log(spark: SparkSession, schema: str) -> None:
    for name, columns in (("loads", _LOADS), ("loaded_files", _FILES)):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {schema}.{name} ({columns}) USING parquet")


def ensure_target(
    spark: SparkSession, table: str, columns: StructType, day: str, key: str | None = None, buckets: int = BUCKETS
) -> None:
    """The tables behind the view ``table``, if they are not there yet."""
    ensure_log(spark, schema_of(table))
    stored = StructType([*columns.fields, StructField("load_id", StringType()), StructField(day, DateType())])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table}_rows ({schemas.ddl(stored)}) USING parquet PARTITIONED BY (`{day}`)")
    if key:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table}_ids (`{key}` STRING, load_id STRING) USING parquet"
            f" CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS"
        )
    names = ", ".join(f"`{c}`" for c in [*columns.fieldNames(), day])
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS {table} AS SELECT {names} FROM {table}_rows"
        f" WHERE load_id IN (SELECT load_id FROM {schema_of(table)}.loads)"
    )


def append(df: DataFrame, table: str) -> None:
    df.select(*df.sparkSession.table(table).columns).write.mode("append").insertInto(table)


def commit(spark: SparkSession, schema: str, load_id: str) -> None:
    """Make a load visible: one row, in one file, moved into place by the writer's commit."""
    row = spark.range(1).select(F.lit(load_id).alias("load_id"), F.current_timestamp().alias("committed_at"))
    append(row.coalesce(1), f"{schema}.loads")


def committed(spark: SparkSession, table: str) -> DataFrame:
    """The rows of ``<schema>.<x>`` that committed loads wrote."""
    return spark.table(table).join(spark.table(f"{schema_of(table)}.loads").select("load_id"), "load_id", "left_semi")


def staged(spark: SparkSession, table: str, load_id: str) -> DataFrame:
    """What a load, committed or not, wrote for ``table``."""
    return spark.table(f"{table}_rows").where(marked_as(load_id)).drop("load_id")


def _ids(rows: DataFrame, key: str) -> DataFrame:
    """(key, _hash, _n) of the incoming ids: narrow rows only.

    Of the copies of an id the one with the least hash is named, so reruns agree.
    """
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("_hash").alias("_hash"), F.count(F.lit(1)).alias("_n"))


def unseen(rows: DataFrame, table: str, key: str) -> DataFrame:
    """(key, _hash, _n) of the incoming ids that ``table`` does not hold."""
    held = committed(rows.sparkSession, f"{table}_ids").select(key)
    return _ids(rows, key).join(held, key, "left_anti")


def judged(rows: DataFrame, table: str, key: str) -> DataFrame:
    """(key, _hash, _n, _fresh) of all incoming ids: ``_fresh`` tells those that ``table`` does not hold."""
    held = committed(rows.sparkSession, f"{table}_ids").groupBy(key).agg(F.lit(True).alias("_held"))
    return _ids(rows, key).join(held, key, "left").select(key, "_hash", "_n", F.col("_held").isNull().alias("_fresh"))


def stage(rows: DataFrame, table: str, load_id: str, day: str, key: str | None = None, once: bool = True) -> None:
    """Write the rows of a load, and with ``key`` its ids; ``once`` takes new ids only, each once.

    Rows without a key cannot be told from each other and all stay.
    """
    spark = rows.sparkSession
    marked = F.lit(load_id).alias("load_id")
    if not (key and once):
        append(_balanced(rows.select("*", marked), day), f"{table}_rows")
    else:
        _stage_new(rows, table, load_id, day, key)
    if key:
        buckets = int(spark.sql(f"DESCRIBE FORMATTED {table}_ids").where("col_name = 'Num Buckets'").first()["data_type"])
        ids = spark.table(f"{table}_rows").where(marked_as(load_id) & F.col(key).isNotNull()).select(key, "load_id")
        append(ids.repartition(buckets, key), f"{table}_ids")


def _stage_new(rows: DataFrame, table: str, load_id: str, day: str, key: str) -> None:
    """New ids and keyless rows.

    The ids are judged first, in narrow rows.  Whole rows then meet only the smaller part of
    them, those to take or those to leave, which Spark broadcasts as far as it is small.
    """
    plain = rows.columns
    held = rows.withColumn("_hash", F.xxhash64(*plain)).persist(StorageLevel.MEMORY_AND_DISK)
    ids = judged(held, table, key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        take = F.col("_fresh") & (F.col("_n") == 1)
        n_take, n_repeated, n_all = ids.agg(F.count_if(take), F.count_if(F.col("_fresh") & (F.col("_n") > 1)), F.count(F.lit(1))).first()
        if 2 * n_take > n_all:
            # Rows without a key match none of the ids that are left.
            fresh = held.join(ids.where(~take).select(key), key, "left_anti").select(*plain)
        else:
            fresh = held.where(F.col(key).isNull()).select(*plain)
            if n_take:
                fresh = held.join(ids.where(take).select(key), key, "left_semi").select(*plain).unionByName(fresh)
        if n_repeated:
            repeated = held.join(ids.where("_fresh AND _n > 1").select(key, "_hash"), [key, "_hash"]).select(*plain)
            fresh = fresh.unionByName(dedup_events(repeated, key))
        append(_balanced(fresh.select("*", F.lit(load_id).alias("load_id")), day), f"{table}_rows")
    finally:
        ids.unpersist()
        held.unpersist()


def marked_as(load_id: str) -> Column:
    return F.col("load_id") == load_id


def _balanced(df: DataFrame, column: str) -> DataFrame:
    """Gather a day's rows in few tasks before a partitioned write; AQE splits large days."""
    return df.hint("rebalance", column)


# --- landing files ------------------------------------------------------------------


def _sink_root(spark: SparkSession, path: str) -> str:
    """The folder at or above ``path`` in which a streaming file sink keeps its commit log."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    while at is not None:
        if fs.exists(jvm.org.apache.hadoop.fs.Path(at, "_spark_metadata")):
            return at.toString()
        at = at.getParent()
    return path


def landed_files(spark: SparkSession, path: str, file_glob: str = "*.json") -> DataFrame:
    """The landing files below ``path``: (path, length, modified).

    Below a streaming sink's root only files that its commit log names are listed, so that
    what a failed or repeated micro-batch left behind is never loaded.
    """
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")
    below = fs.makeQualified(at).toString().rstrip("/") + "/"
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", file_glob).option("recursiveFileLookup", "true")
        .load(_sink_root(spark, path))
    )
    listed = files.select("path", "length", F.col("modificationTime").alias("modified"))
    return listed.where(F.col("path").startswith(below))


def new_files(spark: SparkSession, schema: str, path: str) -> DataFrame:
    """Landing files that no committed load has read; one written anew counts as new."""
    ensure_log(spark, schema)
    known = committed(spark, f"{schema}.loaded_files").select("path", "length", "modified")
    return landed_files(spark, path).join(known, ["path", "length", "modified"], "left_anti")


def record_files(spark: SparkSession, schema: str, load_id: str, files: list) -> None:
    """Enter the files a load reads, as ``new_files`` listed them, into the ledger."""
    rows = spark.createDataFrame([(*f, load_id) for f in files], _FILES)
    append(rows.coalesce(1), f"{schema}.loaded_files")


def read_files(spark: SparkSession, files: list, schema: StructType) -> DataFrame:
    """The events of landing files; a country that only the folder names is taken from there."""
    if not files:
        return spark.createDataFrame([], schema)
    lines = spark.read.option("recursiveFileLookup", "true").text([f.path for f in files])
    rows = expand_json(lines, F.col("value"), schema, [folder_value("country").alias("_folder")], drop_undecodable=True)
    return rows.withColumn("country", F.coalesce("country", "_folder")).drop("_folder")


def folder_value(name: str) -> Column:
    """The value of a ``name=…`` folder in a file's path, else NULL.

    The folder's name is escaped once by the writer and the path once more; neither
    escapes a plus sign.
    """
    value = F.nullif(F.regexp_extract(F.col("_metadata.file_path"), f"/{name}=([^/]*)/", 1), F.lit(""))
    for _ in range(2):
        value = F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return F.nullif(value, F.lit("__HIVE_DEFAULT_PARTITION__"))
