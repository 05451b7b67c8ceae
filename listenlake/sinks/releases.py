"""Write, audit, publish: versions of datasets, and one pointer that names those in use.

A dataset's rows lie in folders written once, ``<root>/<name>/[event_date=…/]version=…``.
A release is a small file ``_releases/<number>.json`` that lists, per dataset, the folders in
use; the highest number is the pointer.  A job writes new versions, checks them as they
will be read, and then puts the next release into place by one rename.  Readers see
the old release until then and never a mixture, and a failed check or task leaves
nothing but folders that no release names.  Two jobs that start from the same release
cannot both publish.

``expire`` deletes folders that neither the last releases nor a running job name.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

POINTERS = "_releases"
VERSION = "version"


class ReleaseConflict(RuntimeError):
    """Another job has published in the meantime."""


@dataclass(frozen=True)
class Release:
    root: str
    number: int = 0
    # Dataset to the full paths of its folders, which may lie below another root.
    folders: dict[str, list[str]] = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    at, fs = _fs(spark, f"{root}/{POINTERS}/*.json")
    return sorted(int(s.getPath().getName()[:-5]) for s in fs.globStatus(at) or [])


def _load(spark: SparkSession, root: str, number: int) -> Release:
    text = spark.read.option("wholetext", "true").text(f"{root}/{POINTERS}/{number:010d}.json").first()["value"]
    return Release(root, number, json.loads(text))


def current(spark: SparkSession, root: str) -> Release:
    """The release in use; number 0, without datasets, if there is none yet."""
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    return _load(spark, root, numbers[-1]) if numbers else Release(root)


def stage(df: DataFrame, root: str, name: str, by: str | None = None) -> list[str]:
    """Write a new version of a dataset, or of the parts that ``df`` has; its folders."""
    spark, version, base = df.sparkSession, uuid.uuid4().hex, f"{root.rstrip('/')}/{name}"
    rows = df.hint("rebalance", by) if by else df
    rows.withColumn(VERSION, F.lit(version)).write.mode("append").partitionBy(*[by] * bool(by), VERSION).parquet(base)
    at, fs = _fs(spark, f"{base}/{by}=*/{VERSION}={version}" if by else f"{base}/{VERSION}={version}")
    return sorted(s.getPath().toString() for s in fs.globStatus(at) or [])


def part(folder: str, by: str) -> str | None:
    """The ``by=…`` value of a folder."""
    found = [x[len(by) + 1 :] for x in folder.split("/") if x.startswith(f"{by}=")]
    return found[-1] if found else None


def replaced(folders: list[str], fresh: list[str], by: str, first: str, last: str) -> list[str]:
    """``folders`` with the parts from ``first`` to ``last`` replaced: a part that has no rows any
    more goes."""
    return sorted([f for f in folders if not first <= part(f, by) <= last] + fresh)


def base_of(folder: str) -> str:
    """The dataset's own folder, above those that name parts and version."""
    while "=" in folder.rsplit("/", 1)[1]:
        folder = folder.rsplit("/", 1)[0]
    return folder


def read(spark: SparkSession, release: Release, name: str, schema: StructType) -> DataFrame:
    """A dataset as ``release`` names it; ``schema`` has all its columns."""
    folders = release.folders.get(name, [])
    if not folders:
        return spark.createDataFrame([], schema)
    stored = StructType([*schema.fields, StructField(VERSION, StringType())])
    roots: dict[str, list[str]] = {}
    for folder in folders:
        roots.setdefault(base_of(folder), []).append(folder)
    rows = [spark.read.schema(stored).option("basePath", base).parquet(*own) for base, own in roots.items()]
    return reduce(DataFrame.unionByName, rows).select(*schema.fieldNames())


def candidate(base: Release, changed: dict[str, list[str]]) -> Release:
    """What ``publish`` would put into place, to be read by the checks."""
    return Release(base.root, base.number + 1, {**base.folders, **changed})


def publish(spark: SparkSession, base: Release, changed: dict[str, list[str]]) -> Release:
    """Switch the pointer from ``base`` to the same release with some datasets changed."""
    release = candidate(base, changed)
    jvm = spark.sparkContext._jvm
    draft, fs = _fs(spark, f"{base.root}/{POINTERS}/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(release.folders).encode()))
    out.close()
    final = jvm.org.apache.hadoop.fs.Path(f"{base.root}/{POINTERS}/{release.number:010d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(draft, final, options)
    except Exception as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(error):
            raise ReleaseConflict(f"release {release.number} of {base.root} exists already") from None
        raise
    return release


def expire(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Delete all but the last ``keep`` releases and the versions that only those named.

    Versions that no release ever named stay, as a running job may be about to publish
    them.  Returns the deleted folders.
    """
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    kept = [_load(spark, root, n) for n in numbers[-keep:]]
    used = {(name, f) for r in kept for name, folders in r.folders.items() for f in folders}
    gone = []
    for number in numbers[:-keep]:
        old = _load(spark, root, number)
        for name, folders in old.folders.items():
            for folder in folders:
                if (name, folder) not in used:
                    at, fs = _fs(spark, folder)
                    if fs.delete(at, True):
                        gone.append(folder)
        at, fs = _fs(spark, f"{root}/{POINTERS}/{number:010d}.json")
        fs.delete(at, False)
    return gone


def point_table(spark: SparkSession, release: Release, name: str, table: str, df: DataFrame, by: str | None = None) -> None:
    """Make the catalog's ``table`` show a dataset of ``release``: metadata only, no rows move.

    ``df`` gives the columns.  Readers by path or by ``read`` follow the pointer alone.
    """
    folders = release.folders[name]
    columns = StructType([f for f in df.schema.fields if f.name != by] + [f for f in df.schema.fields if f.name == by])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
    if not by and spark.catalog.tableExists(table) and spark.table(table).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folders[0]}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        where = base_of(folders[0]) if by and folders else folders[0] if folders else None
        layout = f" PARTITIONED BY (`{by}`)" if by else ""
        place = f" LOCATION '{where}'" if where else ""
        spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet{layout}{place}")
        if by and folders:
            parts = " ".join(f"PARTITION (`{by}` = '{part(f, by)}') LOCATION '{f}'" for f in folders)
            spark.sql(f"ALTER TABLE {table} ADD {parts}")
    spark.catalog.refreshTable(table)
