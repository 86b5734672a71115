"""Tables at rest: a folder per table, batch and version, and a log of commits that names the ones in force.

A writer puts a new version beside the others, where no reader looks, and then adds one small marker
to the table's log. Readers take, for each batch, the version of its newest marker. Nothing is renamed
or deleted, so a writer that fails at any point leaves readers on what was there before, and queries
that run keep their files.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetlake import registry
from fleetlake.sources.scratch import shuffles_dropped

# Partition column of tables with a declared layout: month of the layout's date.
PERIOD = "_period"
# Rows of a file of such a table, about.
FILE_ROWS = 4_000_000
# Rows that are laid out at once, about, where a table lies at rest by years: only their shuffle files are
# on the disks at the same time.
SLICE_ROWS = 32_000_000
# Rows of a bucket of a bucketed table, about.
BUCKET_ROWS = 2_000_000
# More files than this are not named one by one: the scan then finds them by its own filters.
MOST_FILES = 10_000
_COMMIT = "seq bigint, batch_id string, version string"
# The one batch of a table that is replaced as a whole.
_WHOLE = "all"


class Conflict(Exception):
    """The table has a newer version than the one a change was made from."""


def _base(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def version_path(root: str, table: str, batch_id: str, version: str) -> str:
    return f"{_base(root, table)}/batch_id={batch_id}/version={version}"


# -------------------------------------------------------------------- commits
def commits(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The log (seq, batch_id, version) of a table, empty before its first commit."""
    try:
        return spark.read.schema(_COMMIT).option("recursiveFileLookup", True).json(
            f"{_base(root, table)}/_commits")
    except AnalysisException:
        return spark.createDataFrame([], _COMMIT)


def snapshot(spark: SparkSession, root: str, table: str, at: int | None = None) -> dict[str, str]:
    """Version in force of each batch, now or as of commit ``at``. It holds batches, not rows.

    Writers that took the same number at the same time are ordered by their versions' names, so all
    readers see the same one.
    """
    log = commits(spark, root, table)
    if at is not None:
        log = log.where(F.col("seq") <= at)
    newest = log.groupBy("batch_id").agg(F.max(F.struct("seq", "version")).alias("last"))
    return {r["batch_id"]: r["last"]["version"] for r in newest.collect()}


def superseded(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Versions no reader takes any more (batch_id, version, path), for a retention job."""
    log = commits(spark, root, table)
    newest = log.groupBy("batch_id").agg(F.max_by("version", F.struct("seq", "version")).alias("version"))
    old = log.join(newest, ["batch_id", "version"], "left_anti")
    return old.select("batch_id", "version", F.format_string(
        f"{_base(root, table)}/batch_id=%s/version=%s", "batch_id", "version").alias("path"))


def commit(spark: SparkSession, root: str, table: str, batch_id: str, version: str,
           based_on: str | None = None, checked: bool = False) -> int:
    """Put a written version in force and return the number of its commit.

    Every marker is a folder of its own, so writers never meet in a file. Numbers taken at the same
    time are ordered by the versions' names, for all readers alike. With ``checked`` the version in
    force must still be ``based_on`` (None: there is none) before, and this one after the marker is
    written, else Conflict: a change made from another state must not count as done.
    """
    if checked and snapshot(spark, root, table).get(batch_id) != based_on:
        raise Conflict(f"{table}: version {based_on} is no longer in force")
    seq = (commits(spark, root, table).agg(F.max("seq")).first()[0] or 0) + 1
    spark.createDataFrame([(seq, batch_id, version)], _COMMIT).coalesce(1).write.json(
        f"{_base(root, table)}/_commits/{seq:012d}-{version}")
    if checked and snapshot(spark, root, table).get(batch_id) != version:
        raise Conflict(f"{table}: another version has come at the same time as {version}")
    return seq


# -------------------------------------------------------------------- batches
def stage_batch(df: DataFrame, root: str, table: str, batch_id: str, version: str | None = None) -> str:
    """Write a version of a batch that no reader sees yet and return its name; with ``version`` add
    to the one of that name."""
    mode = "append" if version else "errorifexists"
    version = version or f"v{uuid.uuid4().hex}"
    path = version_path(root, table, batch_id, version)
    rows = df.drop("batch_id")
    writer = rows.write.option("compression", "snappy").mode(mode)
    with shuffles_dropped(df.sparkSession):
        if PERIOD not in df.columns:
            writer.parquet(path)
            return version
        writer.partitionBy(PERIOD).parquet(path)
    try:
        df.sparkSession.read.parquet(path)
    except AnalysisException:  # no rows, no months: the schema alone
        schema = rows.drop(PERIOD).schema
        df.sparkSession.createDataFrame([], schema).coalesce(1).write.parquet(f"{path}/{PERIOD}=none")
    return version


def release_batch(spark: SparkSession, version: str, root: str, table: str, batch_id: str) -> None:
    """Point readers to a staged version of a batch. Until then they see the one before."""
    if table in registry.LAYOUTS:
        _index_files(spark, root, table, batch_id, version)
    commit(spark, root, table, batch_id, version)


def write_batch(df: DataFrame, root: str, table: str, batch_id: str) -> None:
    """Replace exactly this batch of a table. An empty batch still leaves its schema behind.

    The new version is whole before readers are pointed to it, so a failed job changes nothing.
    """
    release_batch(df.sparkSession, stage_batch(df, root, table, batch_id), root, table, batch_id)


def read_table(spark: SparkSession, root: str, table: str, at: int | None = None) -> DataFrame:
    """All batches of a table, now or as of commit ``at``; filters on ``batch_id`` prune.

    A table without a log (one that a stream appends to) is read as it lies.
    """
    base = _base(root, table)
    versions = snapshot(spark, root, table, at)
    paths = [version_path(root, table, b, v) for b, v in sorted(versions.items())]
    return spark.read.option("basePath", base).parquet(*(paths or [base])).drop("version", PERIOD)


def read_batch(spark: SparkSession, root: str, table: str, batch_id: str) -> DataFrame:
    """One batch of a table. A batch that was never written is an error, not an empty table."""
    versions = snapshot(spark, root, table)
    try:
        path = (version_path(root, table, batch_id, versions[batch_id]) if batch_id in versions
                else f"{_base(root, table)}/batch_id={batch_id}")
        if versions and batch_id not in versions:
            raise KeyError(batch_id)
        return spark.read.parquet(path).drop(PERIOD).withColumn("batch_id", F.lit(batch_id))
    except (AnalysisException, KeyError) as missing:
        raise FileNotFoundError(
            f"no data for table {table!r}, batch {batch_id!r} below {root}") from missing


# ---------------------------------------------------------- layout, file index
def _period(date_column: str) -> Column:
    return F.date_format(F.col(date_column), "yyyy-MM")


def clustered(df: DataFrame, table: str, partitions: int | None = None) -> DataFrame:
    """Order rows for the declared layout so that file and row-group statistics can skip data.

    Ranges run over date, cluster columns and the row key together: a date or a truck that
    holds most rows is cut into several ranges instead of filling one task.
    """
    layout = registry.LAYOUTS.get(table)
    if layout is None:
        return df
    columns = [c for c in (layout.partition, *layout.cluster, *layout.key) if c in df.columns]
    ranged = (df.repartitionByRange(partitions, *columns) if partitions
              else df.repartitionByRange(*columns))
    return ranged.sortWithinPartitions(*columns)


def laid_out(df: DataFrame, table: str, file_rows: int = FILE_ROWS) -> DataFrame:
    """``clustered``, with the month as ``_period`` to partition by and a bounded number of files.

    Rows per month are counted first (one row a month reaches the driver): a month gets a file per
    ``file_rows`` rows, and two at its borders with other months at most. Within a month the cluster
    columns come before the date, so that a file holds few of their values.

    ``df`` is read three times: for its months, for the bounds of the ranges and for its rows. One
    that joins or groups large tables should be ``materialised`` before.
    """
    layout = registry.LAYOUTS.get(table)
    if layout is None:
        return df
    months = df.groupBy(_period(layout.partition).alias("m")).agg(F.count(F.lit(1)).alias("n")).collect()
    files = max(1, sum(-(-r["n"] // file_rows) for r in months))
    order = [PERIOD, *[c for c in (*layout.cluster, layout.partition, *layout.key) if c in df.columns]]
    return (df.withColumn(PERIOD, _period(layout.partition)).repartitionByRange(files, *order)
            .sortWithinPartitions(*order))


def _indexed_columns(df: DataFrame, table: str) -> list[str]:
    layout = registry.LAYOUTS[table]
    return [c for c in (layout.partition, *layout.cluster) if c in df.columns]


def _index_files(spark: SparkSession, root: str, table: str, batch_id: str, version: str) -> None:
    """Least and greatest value of each layout column per file, read from those columns alone."""
    written = spark.read.parquet(version_path(root, table, batch_id, version))
    columns = _indexed_columns(written, table)
    bounds = [f(c).cast("string").alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    counts = [F.count(c).alias(f"n_{c}") for c in columns]
    (written.groupBy(F.col("_metadata.file_path").alias("file"))
     .agg(F.count(F.lit(1)).alias("n"), *bounds, *counts)
     .write.parquet(f"{_base(root, table)}/_files/batch_id={batch_id}/version={version}"))


def file_index(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """file, n and min_*, max_*, n_* (values that are not null) of the layout columns, for the versions
    in force; None where a table has none."""
    versions = snapshot(spark, root, table)
    if not versions or table not in registry.LAYOUTS:
        return None
    return spark.read.parquet(*[f"{_base(root, table)}/_files/batch_id={b}/version={v}"
                                for b, v in sorted(versions.items())])


def read_where(spark: SparkSession, root: str, table: str, **wanted) -> DataFrame:
    """Rows of a table whose layout columns have wanted values: one value, or a (least, greatest) pair.

    The file index says which files can hold such rows; the scan is given those alone. If they are
    more than MOST_FILES, it is given the table and the months of the date range instead.
    """
    layout = registry.LAYOUTS[table]
    span = {c: v if isinstance(v, tuple) else (v, v) for c, v in wanted.items()}
    versions = snapshot(spark, root, table)
    base = _base(root, table)
    index = file_index(spark, root, table)
    if index is None:
        raise FileNotFoundError(f"no data for table {table!r} below {root}")
    for c, (low, high) in span.items():
        index = index.where((F.col(f"max_{c}") >= str(low)) & (F.col(f"min_{c}") <= str(high)))
    files = [r["file"] for r in index.select("file").limit(MOST_FILES + 1).collect()]
    if len(files) > MOST_FILES or not files:
        paths = [version_path(root, table, b, v) for b, v in sorted(versions.items())]
        rows = spark.read.option("basePath", base).parquet(*paths)
        if not files:
            rows = rows.limit(0)
    else:
        whole = spark.read.option("basePath", base).parquet(
            *[version_path(root, table, b, v) for b, v in sorted(versions.items())])
        rows = spark.read.option("basePath", base).schema(whole.schema).parquet(*files)
    for c, (low, high) in span.items():
        rows = rows.where(F.col(c).between(F.lit(low), F.lit(high)))
        if c == layout.partition:
            rows = rows.where(F.col(PERIOD).between(str(low)[:7], str(high)[:7]))
    return rows.drop("version", PERIOD)


def _slices(df: DataFrame, by: str) -> list[DataFrame]:
    """``df`` by runs of the values of ``by`` that have about SLICE_ROWS rows, one value at least."""
    counts = {r[by]: r["n"] for r in df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, held = [[]], 0
    for value in sorted(counts, key=lambda v: (v is not None, v)):
        if runs[-1] and held + counts[value] > SLICE_ROWS:
            runs.append([])
            held = 0
        runs[-1].append(value)
        held += counts[value]
    if len(runs) == 1:
        return [df.drop(by)]
    known = [F.col(by).isin([v for v in run if v is not None]) for run in runs]
    return [df.where(k | F.col(by).isNull() if None in run else k).drop(by) for run, k in zip(runs, known)]


def publish_fact(df: DataFrame, root: str, table: str, batch_id: str, by: str | None = None) -> None:
    """Publish a fact or mart batch: its version is replaced, other batches are untouched.

    Running a batch again changes nothing, also when the new run has fewer dates. ``by`` names a
    further column, the year of the layout's date, that ``df`` lies at rest by (``scratch.at_rest``):
    then some years after another are laid out, SLICE_ROWS at once, and the column is left out.
    """
    version = None
    for part in _slices(df, by) if by else [df]:
        version = stage_batch(laid_out(part, table), root, table, batch_id, version)
    release_batch(df.sparkSession, version, root, table, batch_id)


# -------------------------------------------------------------------- buckets
def buckets_for(*tables: DataFrame, least: int = 1) -> int:
    """Buckets that tables joined on their layout share: one per ``BUCKET_ROWS`` rows of the largest.

    A task sorts a bucket, so its memory stays the same whatever the tables grow to.
    """
    return max(least, *(-(-df.count() // BUCKET_ROWS) for df in tables))


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a table in hash buckets of ``keys``, sorted by them, and read it back.

    Two tables in as many buckets of the same keys join without a shuffle, however often they are
    read. ``buckets_for`` gives a number of which one fits a task: it is part of the layout. The catalog
    keeps the layout for the session; files lie below ``path``. Rows are dealt by the buckets' own
    hash first, so each bucket is one file.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, *keys).write.option("path", path).option("compression", "snappy")
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return df.sparkSession.table(name)


# ----------------------------------------------------------------- dimensions
def write_dimension(df: DataFrame, root: str, table: str) -> str:
    """Write a dimension as a new complete version and return its name. Readers do not see it.

    A merge reads the table it replaces, so a new version always goes to its own folder.
    """
    return stage_batch(df, root, table, _WHOLE)


def release_dimension(spark: SparkSession, root: str, table: str, version: str,
                      based_on: str | None = None) -> None:
    """Point readers to a version made from version ``based_on`` (None: the first). Conflict if
    another one has come between."""
    commit(spark, root, table, _WHOLE, version, based_on, checked=True)


def publish_dimension(df: DataFrame, root: str, table: str) -> str:
    """Write a new version of a dimension, then point readers to it, whatever is in force."""
    version = write_dimension(df, root, table)
    commit(df.sparkSession, root, table, _WHOLE, version)
    return version


def current_version(spark: SparkSession, root: str, table: str) -> str | None:
    """Version of a dimension in force; None before the first."""
    return snapshot(spark, root, table).get(_WHOLE)


def read_dimension(spark: SparkSession, root: str, table: str,
                   version: str | None = None) -> DataFrame | None:
    """Current (or given) version of a dimension, or None before the first publish."""
    version = version or current_version(spark, root, table)
    if version is None:
        return None
    return spark.read.parquet(version_path(root, table, _WHOLE, version))


# ----------------------------------------------------------------------- logs
def append(df: DataFrame, root: str, table: str) -> None:
    """Append log rows in a folder of their own: writers at the same time do not meet."""
    df.write.parquet(f"{_base(root, table)}/rows-{uuid.uuid4().hex}")


def read_log(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """A log table, empty before its first row."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(_base(root, table))
    except AnalysisException:
        return spark.createDataFrame([], schema)
