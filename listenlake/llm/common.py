"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.session import work_dir

# The characters of the class [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"
# Folders of tables that ``stored`` wrote and that may be dropped.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Lineage ends there: a lost executor costs a re-read of files, and a result that
    is used twice is computed once.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[found] = path
    return found


def dropped(*tables: DataFrame) -> None:
    """Delete the files of tables that ``stored`` gave and that nothing reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        at = context._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(df))
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go when the write or action that needed them has ended.

    Otherwise they stay until the driver happens to collect its garbage.
    """
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREED) if before is None else spark.conf.set(_FREED, before)


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads; whatever else a table holds stays unread."""
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
