"""A sink for raw batches that hashes what it writes, so that one pass makes files and manifest.

Every task writes its rows as CSV, one file per batch it meets, and adds up rows, bytes and SHA-256 of
each file as the bytes go out. These few numbers are its commit message. When all tasks are through,
the driver moves the files to ``<batch>/<table>_<batch>.csv/`` and writes the manifest rows last: a
batch without them has not arrived. Files of failed or repeated attempts stay in the staging folder,
which is no batch.
"""

from __future__ import annotations

import datetime
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import csv, fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from fleetlake import registry
from fleetlake.sources import raw

FORMAT = "fleet_batches"
MANIFEST_SCHEMA = ("batch_id string, `table` string, file string, row_count bigint, file_size_bytes bigint, "
                   "sha256 string, created_at timestamp")
# Hadoop's names of object stores in the spelling of the file library.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs", "gs": "gs"}


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path in it; a plain path is a shared mounted folder."""
    scheme, mark, rest = uri.partition("://")
    if uri.startswith("file:") or not mark:
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}")


@dataclass
class Written:
    """A file of one batch."""

    batch_id: str
    name: str
    row_count: int
    size: int
    sha256: str


@dataclass
class Files(WriterCommitMessage):
    """What a task wrote."""

    files: list[Written]


class _File:
    def __init__(self, store: fs.FileSystem, folder: str, batch_id: str):
        self.batch_id, self.name = batch_id, f"part-{uuid.uuid4().hex}.csv"
        store.create_dir(folder)
        self.stream = store.open_output_stream(f"{folder}/{self.name}")
        self.rows = self.size = 0
        self.hash = hashlib.sha256()

    def add(self, rows: pa.Table) -> None:
        out = pa.BufferOutputStream()
        csv.write_csv(rows, out, csv.WriteOptions(include_header=not self.size))
        body = out.getvalue()
        self.stream.write(body)
        self.hash.update(body)
        self.rows += rows.num_rows
        self.size += body.size

    def close(self) -> Written:
        self.stream.close()
        return Written(self.batch_id, self.name, self.rows, self.size, self.hash.hexdigest())


class BatchWriter(DataSourceArrowWriter):
    """Options: ``root`` of the batches, ``table``, ``batches`` (ids, comma-separated) of this run."""

    def __init__(self, options: dict, columns: list[str]):
        self.root, self.table = options["root"].rstrip("/"), options["table"]
        self.batches, self.columns = options["batches"].split(","), columns
        self.staged = f"{self.root}/_staged/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        store, staged = file_system(self.staged)
        files: dict[str, _File] = {}
        for record in iterator:
            rows = pa.Table.from_batches([record])
            ids = rows.column("batch_id")
            for batch_id in pc.unique(ids).to_pylist():
                if batch_id not in files:
                    files[batch_id] = _File(store, f"{staged}/{batch_id}", batch_id)
                files[batch_id].add(rows.filter(pc.equal(ids, batch_id)).select(self.columns))
        return Files([f.close() for f in files.values()])

    def commit(self, messages: list[Files | None]) -> None:
        store, staged = file_system(self.staged)
        _, root = file_system(self.root)
        written: dict[str, list[Written]] = {b: [] for b in self.batches}
        for message in messages:
            for file in message.files if message else ():
                written[file.batch_id].append(file)
        for batch_id, files in written.items():
            if not files:  # a batch without rows of this table still has a header
                store.create_dir(f"{staged}/{batch_id}")
                empty = _File(store, f"{staged}/{batch_id}", batch_id)
                empty.add(pa.table({c: pa.array([], pa.string()) for c in self.columns}))
                files.append(empty.close())
            manifest = f"{root}/_manifest/batch_id={batch_id}/{self.table}.parquet"
            if store.get_file_info(manifest).type != fs.FileType.NotFound:
                store.delete_file(manifest)  # until the new one is whole, the table has not arrived
            place = f"{root}/{batch_id}/{self.table}_{batch_id}.csv"
            if store.get_file_info(place).type != fs.FileType.NotFound:
                store.delete_dir_contents(place)
            store.create_dir(place)
            for file in files:
                store.move(f"{staged}/{batch_id}/{file.name}", f"{place}/{file.name}")
            now = datetime.datetime.now(datetime.timezone.utc)
            rows = pa.table({
                "table": [self.table] * len(files), "file": [f.name for f in files],
                "row_count": pa.array([f.row_count for f in files], pa.int64()),
                "file_size_bytes": pa.array([f.size for f in files], pa.int64()),
                "sha256": [f.sha256 for f in files],
                "created_at": pa.array([now] * len(files), pa.timestamp("us", "UTC"))})
            store.create_dir(f"{root}/_manifest/batch_id={batch_id}")
            with store.open_output_stream(manifest) as out:
                pq.write_table(rows, out)

    def abort(self, messages: list[Files | None]) -> None:
        """Nothing was moved yet: what tasks wrote stays in the staging folder."""


class BatchFiles(DataSource):
    """``df.write.format("fleet_batches")`` for rows of text columns and a ``batch_id``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        return BatchWriter(dict(self.options), [f.name for f in schema.fields if f.name != "batch_id"])


def write_batches(rows: DataFrame, root: str, table: str, batches: list[str]) -> None:
    """Write rows of text columns and ``batch_id`` as the files of their batches, with a manifest.

    A batch of ``batches`` without rows gets a file with the header alone; what an earlier run wrote
    of the table is replaced.
    """
    rows.sparkSession.dataSource.register(BatchFiles)
    (rows.select(*[F.col(f"`{c}`").cast("string") for c in rows.columns])
     .write.format(FORMAT).mode("append").option("root", root).option("table", table)
     .option("batches", ",".join(batches)).save())


def split_table(spark: SparkSession, source: str, table: str, root: str,
                batches: tuple[tuple[str, int], ...] = registry.BATCHES, multi_line: bool = False) -> None:
    """Split the raw CSV of one table into its batches, in one pass, with every text as it is.

    Rows of tables with a batch date go to the batch of its year and rows of no batch are left out;
    other tables go whole into every batch. Lines that do not fit the header cannot be placed: they
    are kept, with what could be read of them, below ``<root>/_malformed/<table>``.
    """
    rows = raw.raw_rows(spark, source, multi_line)
    bad = F.col(raw.MALFORMED).isNotNull()
    rows.where(bad).write.mode("overwrite").parquet(f"{root.rstrip('/')}/_malformed/{table}")
    good = rows.where(~bad).drop(raw.MALFORMED)
    date = registry.table(table).batch_date
    ids = [b for b, _ in batches]
    placed = (raw.split_batches(good, date, batches) if date
              else good.withColumn("batch_id", F.explode(F.array(*map(F.lit, ids)))))
    write_batches(placed, root, table, ids)


def manifest(spark: SparkSession, root: str, batch_id: str | None = None) -> DataFrame:
    """Manifest rows of one batch or all; empty where none has arrived."""
    try:
        rows = spark.read.option("basePath", f"{root.rstrip('/')}/_manifest").schema(MANIFEST_SCHEMA).parquet(
            f"{root.rstrip('/')}/_manifest" + (f"/batch_id={batch_id}" if batch_id else ""))
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return rows


def arrived(spark: SparkSession, root: str, batch_id: str) -> bool:
    """Is there a manifest of every table for the batch?"""
    found = manifest(spark, root, batch_id).agg(F.countDistinct("table")).first()[0]
    return found == len(registry.TABLES)


def differing(spark: SparkSession, root: str, listed: DataFrame, batch_id: str) -> DataFrame:
    """Files of a batch whose size, hash or presence differs from its manifest rows: the bytes are
    read again. Empty when all is well."""
    found = raw.file_hashes(spark, f"{root.rstrip('/')}/{batch_id}").drop("location")
    recorded = listed.select("table", "file", F.col("file_size_bytes").alias("recorded_bytes"),
                             F.col("sha256").alias("recorded_sha256"))
    return recorded.join(found, "file", "full_outer").where(
        ~F.col("recorded_sha256").eqNullSafe(F.col("sha256"))
        | ~F.col("recorded_bytes").eqNullSafe(F.col("file_size_bytes")))
