"""NDJSON zones of the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listenlake.operators.parse import expand_json


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (a glob is fine) names anything at all."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def read_ndjson(
    spark: SparkSession,
    path: str,
    schema: StructType,
    partitions: StructType | None = None,
    file_glob: str = "*.json",
) -> DataFrame:
    """Read every ``file_glob`` file below ``path``, one JSON object per line.

    A line that is no JSON object is dropped.  A field of the wrong type becomes
    NULL and its row stays, which the JSON reader's own drop mode would not do.
    A missing path gives an empty relation.  ``partitions`` names the typed
    ``key=value`` folders to add as columns; a filter on them prunes folders.
    """
    folder_columns = list(partitions.fieldNames()) if partitions else []
    if not has_files(spark, path):
        everything = StructType(schema.fields + (partitions.fields if partitions else []))
        return spark.createDataFrame([], everything)
    reader = spark.read.option("pathGlobFilter", file_glob)
    if partitions is None:
        reader = reader.option("recursiveFileLookup", "true")
    else:
        reader = reader.option("basePath", path.rstrip("/"))
        typed = StructType().add("value", "string")
        for field in partitions.fields:
            typed = typed.add(field)
        reader = reader.schema(typed)
    lines = reader.text(path)
    return expand_json(lines, F.col("value"), schema, folder_columns, drop_undecodable=True)
