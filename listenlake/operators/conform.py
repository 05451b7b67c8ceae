"""Fit landing rows to the column lists of the bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listenlake import schemas


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``: absent ones NULL, further ones dropped."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None))
            .try_cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def to_bronze(landing: DataFrame) -> DataFrame:
    return conform(landing, schemas.EVENT)


def to_legacy_bronze(landing: DataFrame) -> DataFrame:
    return conform(landing, schemas.LEGACY_EVENT)


def to_bronze_quarantine(landing: DataFrame) -> DataFrame:
    rows = conform(landing, schemas.QUARANTINE)
    return rows.withColumn("_reject_reason", F.coalesce("_reject_reason", F.lit("unknown")))
