"""WARC archives: written from rows, read by a Python data source.

Archives hold one gzip member per record.  A member's extra field ``sl`` tells its
compressed length and that of its header block, so that the reader inflates the headers
first, tests the pushed-down predicates and skips an unwanted payload unread.  A
member without the field is inflated as a whole.  A file is a partition of the scan;
the writer starts a new file after ``FILE_BYTES``.

The files lie in a folder that all executors reach; they are opened through Arrow's
file systems by URI.  A file is written under a new name; the manifest, a table that Spark
commits, names those of the tasks that succeeded, so a lost executor doubles no record.

Of records with equal payloads of at least ``least`` bytes the largest page id is a
response, the others revisit it.  Defined cases: a null html is an empty payload; rows
that repeat the largest id are responses each; a null id is stored as empty and never
referred to; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import struct
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from listenlake.llm.common import stored, table
from listenlake.session import work_dir

FILE_BYTES = 64 << 20
LEAST_BYTES = 0
SCHEMA = (
    "page_id long, record_type string, target_uri string, payload_digest string, payload_bytes long, "
    "refers_to long, payload binary"
)
_PUSHED = {"record_type", "target_uri", "payload_digest"}
_HEAD = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def member(headers: bytes, payload: bytes) -> bytes:
    """A gzip member; the deflate stream is flushed between headers and payload."""
    pack = zlib.compressobj(6, zlib.DEFLATED, -15)
    first = pack.compress(headers) + pack.flush(zlib.Z_FULL_FLUSH)
    body = first + pack.compress(payload + b"\r\n\r\n") + pack.flush()
    whole = headers + payload + b"\r\n\r\n"
    tail = struct.pack("<II", zlib.crc32(whole), len(whole) & 0xFFFFFFFF)
    total = len(_HEAD) + 2 + 12 + len(body) + 8
    return _HEAD + struct.pack("<H2sHII", 12, b"sl", 8, total, len(first)) + body + tail


def header_block(page_id: int | None, kind: str, uri: str, digest: str, size: int, refers: int | None) -> bytes:
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z", "WARC-Target-URI: " + " ".join((uri or "").split()),
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}",
        "Content-Type: text/html", f"Content-Length: {size if kind == 'response' else 0}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{refers}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def write(records: DataFrame, folder: str) -> DataFrame:
    """Writes (page_id, url, html, sha1, refers_to) as archives; returns their paths."""

    def archive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sink = path = None
        done = 0
        for batch in batches:
            refers = batch["refers_to"].astype("Int64")
            for page, url, html, sha1, ref in zip(batch["page_id"].astype("Int64"), batch["url"], batch["html"], batch["sha1"], refers):
                payload = html.encode()
                kind = "response" if ref is pd.NA else "revisit"
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                head = header_block(None if page is pd.NA else page, kind, url, digest, len(payload), ref)
                if sink is None:
                    system, root = _open(folder)
                    system.create_dir(root, recursive=True)
                    path, done = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                    sink = system.open_output_stream(path, compression=None)
                made = member(head, payload if kind == "response" else b"")
                sink.write(made)
                done += len(made)
                if done >= FILE_BYTES:
                    sink.close()
                    sink = None
                    yield pd.DataFrame({"name": [path.rsplit("/", 1)[1]]})
        if sink is not None:
            sink.close()
            yield pd.DataFrame({"name": [path.rsplit("/", 1)[1]]})

    return records.mapInPandas(archive, "name string")


def parse_headers(block: bytes) -> dict[str, str]:
    lines = block.decode().split("\r\n")[1:]
    return {k.lower(): v for k, v in (line.split(": ", 1) for line in lines if ": " in line)}


def _number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def records(stream, wanted, payloads: bool) -> Iterator[tuple]:
    """The rows of an open archive whose fields satisfy ``wanted``."""
    while fixed := stream.read(12):
        (extra,) = struct.unpack("<H", fixed[10:12]) if fixed[3] & 4 else (0,)
        field = stream.read(extra)
        if field[:2] != b"sl":
            raise ValueError("archive members need the sl field")
        total, first = struct.unpack("<II", field[4:12])
        inflate = zlib.decompressobj(-15)
        headers = parse_headers(inflate.decompress(stream.read(first)))
        rest = total - 12 - extra - first
        row = {
            "record_type": headers["warc-type"], "target_uri": headers.get("warc-target-uri", ""),
            "payload_digest": headers["warc-payload-digest"].removeprefix("sha1:"),
        }
        body = None
        if wanted(row) and payloads and row["record_type"] == "response":
            size = int(headers["content-length"])
            body = inflate.decompress(stream.read(rest)[:-8])[:size]
        else:
            stream.seek(stream.tell() + rest)
        if wanted(row):
            yield (
                _number(headers["warc-record-id"]), *row.values(), int(headers["x-payload-length"]),
                _number(headers.get("warc-refers-to")), body,
            )


class ArchiveFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.payloads = options.get("payloads", "true").lower() == "true"
        self.manifest = options.get("manifest")
        self.allowed: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name not in _PUSHED:
                yield f
            else:
                self.allowed.append((name, frozenset(f.value if isinstance(f, In) else [f.value])))

    def partitions(self) -> list[InputPartition]:
        system, root = _open(self.folder)
        if self.manifest:
            listed, place = _open(self.manifest)
            names = pq.read_table(place, filesystem=listed)["name"].to_pylist()
        else:
            found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
            names = [f.base_name for f in found if f.path.endswith(".warc.gz")]
        return [ArchiveFile(f"{root}/{name}") for name in names] or [ArchiveFile("")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if not partition.path:
            return
        system, _ = _open(self.folder)
        with system.open_input_file(partition.path) as stream:
            yield from records(stream, lambda row: all(row[n] in v for n, v in self.allowed), self.payloads)


class WarcSource(DataSource):
    """``spark.read.format("warc").option("payloads", "false").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))


def with_revisits(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Adds to (page_id, url, html) the payload's SHA-1 and the page it revisits."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    best = stored(
        rows.where(F.octet_length("html") >= least).groupBy("sha1")
        .agg(F.max("page_id").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha1", "best"),
        "warc-repeats",
    )
    other = F.when(~F.col("page_id").eqNullSafe(F.col("best")), F.col("best"))
    return rows.join(best, "sha1", "left").select("page_id", "url", "html", "sha1", other.alias("refers_to"))


def archive(pages: DataFrame, least: int = LEAST_BYTES) -> tuple[str, str]:
    """Writes the pages as archives into a new shared folder; returns it and its manifest,
    a table of the files of the tasks that succeeded."""
    folder, manifest = work_dir(pages.sparkSession, "warc"), work_dir(pages.sparkSession, "warc-names")
    write(with_revisits(pages, least), folder).write.parquet(manifest)
    return folder, manifest


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    folder, manifest = archive(table(spark, sf_dir, "pages"))
    read = spark.read.format("warc").option("payloads", "false").option("manifest", manifest).load(folder)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
