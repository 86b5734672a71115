"""A batch from raw files to Gold: Bronze, Silver with quarantine, Gold, logs.

Each step is one or two Spark jobs per table. The driver holds counts, never rows.
"""

from __future__ import annotations

import datetime
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from fleetlake import registry
from fleetlake.functions.casting import cast_table, conform, missing_required
from fleetlake.operators import quality
from fleetlake.operators.scd2 import type1_upsert
from fleetlake.plans import control, dims, facts
from fleetlake.sources import batch_sink, raw, store


class MissingKeys(Exception):
    """A Gold table has null values in a required column."""


@dataclass(frozen=True)
class Lake:
    """Folders of a lake and the settings of its batches."""

    root: str
    raw_root: str
    max_rejection_rate_pct: float = registry.MAX_REJECTION_RATE_PCT
    quarantine_enabled: bool = True
    fail_on_threshold: bool = True
    dimension_mode: str = "upsert"  # or "replace": only the keys that the batch carries
    multi_line: frozenset[str] = frozenset()  # tables with line breaks inside quotes
    calendar_years: tuple[int, int] = dims.CALENDAR_YEARS
    parallel_tables: int = 4

    def zone(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def raw_path(self, table: str, batch_id: str) -> str:
        return f"{self.raw_root.rstrip('/')}/{batch_id}/{table}_{batch_id}.csv"


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


def _each_table(lake: Lake, tables: list[str], step: Callable[[str], dict]) -> list[dict]:
    """Run a step per table, a few at a time: small tables share the cluster."""
    with ThreadPoolExecutor(lake.parallel_tables) as pool:
        return list(pool.map(step, tables))


def _alert(spark: SparkSession, lake: Lake, alerts: DataFrame) -> None:
    store.append(control.alert_rows(alerts), lake.zone("audit"), "alerts")


def _log_step(spark: SparkSession, lake: Lake, *args, **kwargs) -> None:
    store.append(control.step_row(spark, *args, **kwargs), lake.zone("audit"), "pipeline_audit")


# ---------------------------------------------------------------------- Bronze
def ingest_table(spark: SparkSession, lake: Lake, batch_id: str, table: str) -> dict:
    """Raw CSV of a table to its Bronze batch folder."""
    start = _now()
    counted = Observation(f"bronze_{table}")
    rows = raw.read_raw_csv(spark, lake.raw_path(table, batch_id), table in lake.multi_line,
                            with_file=True, with_malformed=True)
    bad = F.col(raw.MALFORMED).isNotNull()
    lined = raw.with_lineage(rows, batch_id)
    bronze = lined.observe(counted, F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"))
    store.write_batch(bronze.where(~bad).drop(raw.MALFORMED), lake.zone("bronze"), table, batch_id)
    n, malformed = counted.get["n"], counted.get["bad"]
    store.write_batch(raw.malformed_rows(lined) if malformed else raw.malformed_rows(lined).limit(0),
                      lake.zone("malformed"), table, batch_id)
    _log_step(spark, lake, batch_id, "BRONZE", table, "COMPLETED", n, n - malformed, malformed, start)
    return {"table": table, "rows": n - malformed, "malformed": malformed}


def ingest_batch(spark: SparkSession, lake: Lake, batch_id: str,
                 tables: list[str] | None = None) -> dict:
    done = _each_table(lake, tables or list(registry.TABLES),
                       lambda t: ingest_table(spark, lake, batch_id, t))
    return {"tables": done, "total_rows": sum(d["rows"] for d in done)}


# ---------------------------------------------------------------------- Silver
def refine_table(spark: SparkSession, lake: Lake, batch_id: str, table: str) -> dict:
    """Bronze batch to typed Silver rows and quarantined rows, with metrics and logs.

    The key count is the only full shuffle; the duplicate keys it finds are written as a
    table, so both passes over Bronze join a side of known size. The first pass writes the
    valid rows and observes all counts; the second runs only when something failed.
    """
    start = _now()
    meta = registry.table(table)
    key = list(meta.primary_key)
    bronze = store.read_batch(spark, lake.zone("bronze"), table, batch_id).drop("batch_id")
    silver_zone, quarantine_zone = lake.zone("silver"), lake.zone("quarantine")

    store.write_batch(quality.duplicate_keys(bronze, key), lake.zone("duplicate_keys"), table,
                      batch_id)
    duplicates = store.read_batch(
        spark, lake.zone("duplicate_keys"), table, batch_id).drop("batch_id")
    annotated = quality.annotate_table(bronze, table, duplicates)

    counted = Observation(f"silver_{table}")
    observed = annotated.observe(counted, *quality.metric_columns())
    kept = (quality.valid_rows(observed) if lake.quarantine_enabled
            else observed.drop("_rejection_rule", "_rejection_reason"))
    silver = cast_table(kept, meta.columns).withColumn("_silver_processed_at", F.current_timestamp())
    store.write_batch(silver, silver_zone, table, batch_id)
    counts = counted.get
    total, failed = counts["total_records"], counts["quarantined_records"]
    if not lake.quarantine_enabled:
        failed = 0

    rejected = quality.quarantined_rows(annotated, key, batch_id)
    store.write_batch(rejected if failed else rejected.limit(0), quarantine_zone, table, batch_id)
    if failed:
        written = store.read_batch(spark, quarantine_zone, table, batch_id)
        store.append(control.rejection_rows(written.drop("batch_id"), table),
                     lake.zone("audit"), "rejection_log")

    metrics = spark.createDataFrame(
        [(table, total, total - failed, failed)],
        "table_name string, total_records bigint, valid_records bigint, quarantined_records bigint")
    store.append(control.dq_metric_rows(metrics, batch_id), lake.zone("audit"),
                 "data_quality_metrics")
    try:
        if lake.fail_on_threshold:
            quality.check_gate(table, total, failed, lake.max_rejection_rate_pct)
    except quality.RejectionRateExceeded as breach:
        _log_step(spark, lake, batch_id, "SILVER", table, "FAILED", total, total - failed, failed,
                  start, error=str(breach))
        breached = spark.createDataFrame(
            [(table, batch_id, total, failed, failed * 100.0 / total, lake.max_rejection_rate_pct)],
            "table_name string, batch_id string, total_records bigint, quarantined_records bigint, "
            "rejection_rate_pct double, threshold_pct double")
        _alert(spark, lake, control.breach_alerts(breached))
        raise
    _log_step(spark, lake, batch_id, "SILVER", table, "COMPLETED", total, total - failed, failed,
              start)
    return {"table": table, "total": total, "valid": total - failed, "quarantined": failed}


def refine_batch(spark: SparkSession, lake: Lake, batch_id: str,
                 tables: list[str] | None = None) -> dict:
    done = _each_table(lake, tables or list(registry.TABLES),
                       lambda t: refine_table(spark, lake, batch_id, t))
    total = sum(d["total"] for d in done)
    valid = sum(d["valid"] for d in done)
    return {"tables": done, "total": total, "valid": valid,
            "quarantined": sum(d["quarantined"] for d in done),
            "dq_score_pct": valid * 100.0 / total if total else 100.0}


# ------------------------------------------------------------------------ Gold
def _checked(df: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """The contract projection of a Gold table, counting rows and missing keys as it is written."""
    counted = Observation(f"gold_{table}")
    return df.observe(counted, F.count(F.lit(1)).alias("n"), *missing_required(df, table)), counted


def _finish(spark: SparkSession, lake: Lake, batch_id: str, table: str, counted: Observation,
            start: datetime.datetime, release: Callable[[], None]) -> int:
    """Show the written rows to readers if no required key is missing; else they never see them."""
    counts = dict(counted.get)
    n = counts.pop("n")
    missing = {c.removeprefix("null_"): v for c, v in counts.items() if v}
    if missing:
        raise MissingKeys(f"{table}: null in required columns {missing}")
    release()
    _log_step(spark, lake, batch_id, "GOLD", table, "COMPLETED", n, n, 0, start)
    return n


def publish_dimension(spark: SparkSession, lake: Lake, batch_id: str, table: str,
                      as_of: datetime.date) -> int:
    start = _now()
    gold = lake.zone("gold")
    based_on = store.current_version(spark, gold, table)
    existing = store.read_dimension(spark, gold, table, based_on) if based_on else None
    if table == "dim_date":
        df = dims.calendar(spark, *lake.calendar_years)
    elif table == "dim_driver":
        silver = store.read_batch(spark, lake.zone("silver"), "drivers", batch_id)
        df = dims.dim_driver(silver, existing, as_of)
    else:
        source, key, sk = dims.SNAPSHOT_DIMS[table]
        silver = store.read_batch(spark, lake.zone("silver"), source, batch_id)
        if lake.dimension_mode == "upsert" and existing is not None:
            incoming = silver.withColumn("_created_at", F.current_timestamp())
            df = conform(type1_upsert(existing, incoming, key, sk), table)
        else:
            df = dims.snapshot_dim(table, silver)
    checked, counted = _checked(df, table)
    version = store.write_dimension(checked, gold, table)
    return _finish(spark, lake, batch_id, table, counted, start,
                   lambda: store.release_dimension(spark, gold, table, version, based_on))


def publish_fact(spark: SparkSession, lake: Lake, batch_id: str, table: str) -> int:
    start = _now()
    silver = lake.zone("silver")
    if table == "fact_trips":
        df = facts.fact_trips(store.read_batch(spark, silver, "trips", batch_id),
                              store.read_batch(spark, silver, "loads", batch_id), batch_id)
    else:
        build, source = facts.SINGLE_SOURCE[table]
        df = build(store.read_batch(spark, silver, source, batch_id), batch_id)
    # Counted before the range exchange: its sampling pass would count the rows twice.
    checked, counted = _checked(store.laid_out(df, table), table)
    gold = lake.zone("gold")
    version = store.stage_batch(checked, gold, table, batch_id)
    return _finish(spark, lake, batch_id, table, counted, start,
                   lambda: store.release_batch(spark, version, gold, table, batch_id))


def publish_batch(spark: SparkSession, lake: Lake, batch_id: str,
                  as_of: datetime.date | None = None) -> dict:
    """All dimensions, facts and marts of a batch."""
    as_of = as_of or effective_date(batch_id)
    published = {}
    for table in ("dim_date", *dims.SNAPSHOT_DIMS, "dim_driver"):
        published[table] = publish_dimension(spark, lake, batch_id, table, as_of)
    for table in ("fact_trips", *facts.SINGLE_SOURCE):
        published[table] = publish_fact(spark, lake, batch_id, table)
    return {"tables": published, "total_rows_published": sum(published.values())}


# ----------------------------------------------------------------------- batch
class ManifestMismatch(Exception):
    """Files of a batch differ from its manifest."""


def effective_date(batch_id: str) -> datetime.date:
    """The date a batch's changes hold from: the first day of its year, else today."""
    year = dict(registry.BATCHES).get(batch_id)
    return datetime.date(year, 1, 1) if year else _now().date()


def _set_status(spark, lake, batch_id, status, error=None) -> None:
    store.append(control.status_row(spark, batch_id, status, error), lake.zone("audit"),
                 "batch_control")


def run_batch(spark: SparkSession, lake: Lake, batch_id: str, force: bool = False,
              as_of: datetime.date | None = None, manifest: dict | None = None) -> dict:
    """Run one batch end to end. A batch that has completed is skipped unless forced."""
    audit = lake.zone("audit")
    log = store.read_log(spark, audit, "batch_control", control.BATCH_CONTROL_SCHEMA)
    if not force and control.is_completed(log, batch_id):
        return {"batch_id": batch_id, "status": "SKIPPED", "reason": "ALREADY_COMPLETED"}
    if manifest is None and batch_sink.arrived(spark, lake.raw_root, batch_id):
        listed = batch_sink.manifest(spark, lake.raw_root, batch_id)
        if not batch_sink.differing(spark, lake.raw_root, listed, batch_id).isEmpty():
            raise ManifestMismatch(f"batch {batch_id}: files differ from the manifest")
        arrivals = control.arrivals_of(listed, lake.raw_root)
    elif manifest is None:
        year = dict(registry.BATCHES).get(batch_id, 0)
        manifest = raw.batch_manifest(spark, batch_id, year, {
            t: lake.raw_path(t, batch_id) for t in registry.TABLES})
        arrivals = control.arrival_rows(spark, manifest, f"{lake.raw_root}/{batch_id}")
    else:
        listed = {e["table"] for e in manifest["tables"]}
        wrong = listed and raw.verify_manifest(spark, manifest, {
            t: lake.raw_path(t, batch_id) for t in registry.TABLES if t in listed})
        if listed and not wrong.isEmpty():
            raise ManifestMismatch(f"batch {batch_id}: files differ from the manifest")
        arrivals = control.arrival_rows(spark, manifest, f"{lake.raw_root}/{batch_id}")
    store.append(arrivals, audit, "batch_control")
    stage = "BRONZE"
    try:
        bronze = ingest_batch(spark, lake, batch_id)
        stage = "SILVER"
        silver = refine_batch(spark, lake, batch_id)
        stage = "GOLD"
        _set_status(spark, lake, batch_id, "PROCESSING")
        gold = publish_batch(spark, lake, batch_id, as_of)
    except Exception as error:
        _set_status(spark, lake, batch_id, "FAILED", str(error))
        if not isinstance(error, quality.RejectionRateExceeded):  # that one is logged already
            _log_step(spark, lake, batch_id, stage, "ALL", "FAILED", error=str(error))
            failed = control.step_row(spark, batch_id, stage, "ALL", "FAILED", error=str(error))
            _alert(spark, lake, control.failure_alerts(failed))
        raise
    _set_status(spark, lake, batch_id, "COMPLETED")
    steps = store.read_log(spark, audit, "pipeline_audit", control.PIPELINE_AUDIT_SCHEMA)
    _alert(spark, lake, control.completion_alerts(steps.where(F.col("batch_id") == batch_id)))
    return {"batch_id": batch_id, "status": "COMPLETED", "bronze": bronze, "silver": silver,
            "gold": gold}


def split_all(spark: SparkSession, lake: Lake, source_root: str,
              batches: tuple[tuple[str, int], ...] = registry.BATCHES) -> None:
    """Split the unsplit CSV of every table (``<source_root>/<table>.csv``) into the lake's batches.

    One table after another: a Python sink is found through the session of the calling thread.
    """
    for table in registry.TABLES:
        batch_sink.split_table(spark, f"{source_root.rstrip('/')}/{table}.csv", table, lake.raw_root, batches,
                               table in lake.multi_line)


def run_all_batches(spark: SparkSession, lake: Lake, force: bool = False,
                    batches: list[str] | None = None, source_root: str | None = None,
                    split: tuple[tuple[str, int], ...] = registry.BATCHES) -> list[dict]:
    """Run batches in order; a later batch builds on the dimensions of an earlier one.

    With ``source_root`` the batches are made from the unsplit folder first if any of them has not
    arrived.
    """
    wanted = batches or [b for b, _ in split]
    if source_root and not all(batch_sink.arrived(spark, lake.raw_root, b) for b in wanted):
        split_all(spark, lake, source_root, split)
    return [run_batch(spark, lake, b, force) for b in wanted]
