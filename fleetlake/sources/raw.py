"""Raw files to Bronze: CSV scan, batch split, manifests, Bronze write."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fleetlake import registry
from fleetlake.functions import text

# A raw line that has not as many fields as the header, whole.
MALFORMED = "_malformed"
LINEAGE = ("_batch_id", "_ingested_at", "_source_file")
_HASH_CHUNK_BYTES = 1 << 20


# ----------------------------------------------------------------------- scan
def _csv(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """Columns by header name, all text, no inference pass. Every file's header is checked."""
    reader = (spark.read.option("header", True).option("escape", '"')
              .option("enforceSchema", False).option("multiLine", multi_line)
              .option("recursiveFileLookup", True))
    fields = [T.StructField(c, T.StringType()) for c in (*reader.csv(path).columns, MALFORMED)]
    return reader.option("columnNameOfCorruptRecord", MALFORMED).schema(T.StructType(fields)).csv(path)


def raw_rows(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Every text of a CSV as it is, and ``_malformed`` (the line where it does not fit the header)."""
    return _csv(spark, path, multi_line)


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False,
                 with_file: bool = False, with_malformed: bool = False) -> DataFrame:
    """CSV with header, every column as text, missing-value texts as null.

    ``multi_line`` allows line breaks inside quotes, at the price of unsplittable files.
    ``with_file`` adds ``_source_file``, the name of the file a row came from.
    ``with_malformed`` adds ``_malformed``: the line itself where it has more or fewer fields than
    the header, else null. Such rows are kept; the caller decides.
    """
    df = _csv(spark, path, multi_line)
    extra = [F.col(MALFORMED)] if with_malformed else []
    extra += [source_file().alias("_source_file")] if with_file else []
    return df.select(*[text.csv_null(F.col(c)).alias(c) for c in df.columns if c != MALFORMED], *extra)


def malformed_rows(rows: DataFrame) -> DataFrame:
    """The rows whose line did not fit the header: the line, what could be read of it, lineage."""
    return rows.where(F.col(MALFORMED).isNotNull())


def _file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def source_file() -> Column:
    return _file_name(F.col("_metadata.file_path"))


# ---------------------------------------------------------------- batch split
def batch_label(date_column: str,
                batches: tuple[tuple[str, int], ...] = registry.BATCHES) -> Column:
    """Batch of a row by the year of its date text; the last batch is open-ended.

    Null where the date does not parse or lies before the first batch.
    """
    day = text.strip(F.col(date_column))
    # A text with a colon can only be a timestamp and one without only a date: each is parsed once,
    # and none is tried in a format that must fail, since a failure costs far more than a parse.
    moment = F.when(day.contains(":"), F.try_to_timestamp(day, F.lit(registry.TIMESTAMP_FORMAT))).otherwise(
        F.try_to_timestamp(day, F.lit(registry.DATE_FORMAT)))
    last_id, last_year = batches[-1]
    of_year = {y: b for b, y in reversed(batches) if y < last_year} | {last_year: last_id}
    # The year stands in the expression once, however many batches there are.
    year = F.least(F.coalesce(F.year(moment), F.lit(min(of_year) - 1)), F.lit(last_year))
    return F.try_element_at(F.create_map(*[F.lit(x) for item in of_year.items() for x in item]), year)


def split_batches(df: DataFrame, date_column: str,
                  batches: tuple[tuple[str, int], ...] = registry.BATCHES) -> DataFrame:
    """Add ``batch_id``; rows of no batch are left out. One pass for all batches."""
    return df.withColumn("batch_id", batch_label(date_column, batches)).where(
        F.col("batch_id").isNotNull())


def write_batches(df: DataFrame, date_column: str, root: str,
                  batches: tuple[tuple[str, int], ...] = registry.BATCHES) -> None:
    """Write every batch of a table as CSV below ``root/batch_id=<id>/`` in one job."""
    (split_batches(df, date_column, batches).write.mode("overwrite")
     .partitionBy("batch_id").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(root))


# ------------------------------------------------------------------ manifests
def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """Location, name, size and SHA-256 of each CSV file below ``path``.

    Only the listing comes from the file source (content is pruned). Each task then reads
    its files in chunks, so a file of any size is hashed in constant memory.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.csv").load(path)
             .select("path", F.col("_metadata.file_path").alias("location"),
                     F.col("length").alias("file_size_bytes")))

    def digest(batches):
        import hashlib

        from fleetlake.sources.batch_sink import file_system

        for pdf in batches:
            sums = []
            for uri in pdf["path"]:
                store, name = file_system(uri)
                sha = hashlib.sha256()
                with store.open_input_stream(name) as stream:
                    while chunk := stream.read(_HASH_CHUNK_BYTES):
                        sha.update(chunk)
                sums.append(sha.hexdigest())
            yield pdf.assign(sha256=sums)

    return (files.mapInPandas(
        digest, "path string, location string, file_size_bytes bigint, sha256 string")
        .select("location", _file_name(F.col("path")).alias("file"), "file_size_bytes", "sha256"))


def file_row_counts(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Data rows of each CSV file below ``path``."""
    return _csv(spark, path, multi_line).drop(MALFORMED).groupBy(
        F.col("_metadata.file_path").alias("location")).agg(F.count(F.lit(1)).alias("row_count"))


def table_manifest(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One row per file of a table: table, file, row_count, file_size_bytes, sha256, location."""
    return file_hashes(spark, path).join(file_row_counts(spark, path), "location", "left").select(
        F.lit(table).alias("table"), "file", F.coalesce("row_count", F.lit(0)).alias("row_count"),
        "file_size_bytes", "sha256", "location")


def batch_manifest(spark: SparkSession, batch_id: str, target_year: int,
                   paths: dict[str, str]) -> dict:
    """Manifest of a batch: header plus one entry per file. It lists files, not rows."""
    entries = []
    for table, path in paths.items():
        entries += [row.asDict() for row in table_manifest(spark, path, table).drop("location")
                    .orderBy("file").toLocalIterator()]
    return {
        "batch_id": batch_id,
        "created_at": datetime.datetime.now(datetime.timezone.utc).isoformat(),
        "target_year": target_year,
        "total_tables": len(paths),
        "tables": entries,
    }


def write_manifest(spark: SparkSession, manifest: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def verify_manifest(spark: SparkSession, manifest: dict, paths: dict[str, str]) -> DataFrame:
    """Files whose size, hash or presence differs from the manifest. Empty when all is well."""
    recorded = spark.createDataFrame(
        [(e["file"], e["file_size_bytes"], e["sha256"]) for e in manifest["tables"]],
        "file string, recorded_bytes bigint, recorded_sha256 string")
    found = None
    for path in paths.values():
        hashes = file_hashes(spark, path).drop("location")
        found = hashes if found is None else found.unionByName(hashes)
    return recorded.join(found, "file", "full_outer").where(
        ~F.col("recorded_sha256").eqNullSafe(F.col("sha256"))
        | ~F.col("recorded_bytes").eqNullSafe(F.col("file_size_bytes")))


# --------------------------------------------------------------------- Bronze
def with_lineage(df: DataFrame, batch_id: str) -> DataFrame:
    return df.withColumns({"_batch_id": F.lit(batch_id), "_ingested_at": F.current_timestamp()})
