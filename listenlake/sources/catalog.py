"""Relations by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def source(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """A table by its logical name."""
    return spark.table(f"{schema}.{table}")


def query(spark: SparkSession, sql: str, **relations: DataFrame) -> DataFrame:
    """SQL over named tables, views and the given DataFrames (``{name}`` in the text).

    The result stays a distributed relation with lower-case column names.
    """
    result = spark.sql(sql, **relations)
    return result.toDF(*[c.lower() for c in result.columns])
