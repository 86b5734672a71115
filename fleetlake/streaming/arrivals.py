"""Batch arrival as a stream: raw files to Bronze, each file once.

The file source remembers what it has read in its checkpoint, so a restarted run skips
files that are done. This is the same skip-if-done contract as the control log, per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlake import registry
from fleetlake.functions import text
from fleetlake.sources.raw import MALFORMED


def arriving_rows(spark: SparkSession, raw_root: str, table: str, files: str | None = None,
                  batch_pattern: str | None = None, files_per_trigger: int = 1000) -> DataFrame:
    """Rows of arriving CSV files as Bronze rows, and ``_malformed``: the whole line where it has more
    or fewer fields than the table, else null.

    ``files`` is a glob below ``raw_root`` and ``batch_pattern`` the regular expression that
    finds the batch id in a path; the defaults fit ``<batch_id>/<table>_<batch_id>.csv``.
    """
    stream = (spark.readStream.schema(registry.raw_schema(table).add(MALFORMED, "string")).option("header", True)
              .option("columnNameOfCorruptRecord", MALFORMED)
              .option("escape", '"').option("enforceSchema", False)
              .option("recursiveFileLookup", True)
              .option("maxFilesPerTrigger", files_per_trigger)
              .csv(f"{raw_root.rstrip('/')}/{files or f'*/{table}_*.csv'}"))
    path = F.col("_metadata.file_path")
    batch_id = F.regexp_extract(path, batch_pattern or rf"/{table}_([^/]+)\.csv(?:/|$)", 1)
    return stream.select(
        *[text.csv_null(F.col(c)).alias(c) for c in stream.columns if c != MALFORMED], MALFORMED,
        batch_id.alias("_batch_id"), F.current_timestamp().alias("_ingested_at"),
        F.regexp_extract(path, r"([^/]+)$", 1).alias("_source_file"), batch_id.alias("batch_id"))


def ingest_arrivals(spark: SparkSession, raw_root: str, bronze_root: str, checkpoint_root: str,
                    table: str, files: str | None = None,
                    batch_pattern: str | None = None) -> StreamingQuery:
    """Ingest the files that are there and were not read before, then stop.

    The file sink commits a micro-batch at once; read the result with ``read_table``. Lines that do
    not fit the table are left to ``ingest_malformed``.
    """
    rows = arriving_rows(spark, raw_root, table, files, batch_pattern)
    return (rows.where(F.col(MALFORMED).isNull()).drop(MALFORMED).writeStream.format("parquet")
            .option("path", f"{bronze_root.rstrip('/')}/{table}")
            .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/bronze/{table}")
            .partitionBy("batch_id").trigger(availableNow=True).start())


def ingest_malformed(spark: SparkSession, raw_root: str, malformed_root: str, checkpoint_root: str,
                     table: str, files: str | None = None, batch_pattern: str | None = None) -> StreamingQuery:
    """Set aside the lines of new files that do not fit the table, with what could be read of them.

    A query of its own over the same files, with its own checkpoint: each file is read once by it.
    """
    rows = arriving_rows(spark, raw_root, table, files, batch_pattern)
    return (rows.where(F.col(MALFORMED).isNotNull()).writeStream.format("parquet")
            .option("path", f"{malformed_root.rstrip('/')}/{table}")
            .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/malformed/{table}")
            .partitionBy("batch_id").trigger(availableNow=True).start())
