"""Batch control and audit logs: append-only tables, and the reads on them."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetlake.functions.text import safe_divide
from fleetlake.sources import store

# Log table schemas.
BATCH_CONTROL_SCHEMA = (
    "batch_id string, source_file string, table_name string, gcs_raw_path string, "
    "arrival_time timestamp, processing_start timestamp, processing_end timestamp, "
    "records_in_file bigint, status string, error_message string")
PIPELINE_AUDIT_SCHEMA = (
    "batch_id string, stage string, table_name string, status string, records_in bigint, "
    "records_out bigint, records_quarantined bigint, rejection_rate_pct double, "
    "start_time timestamp, end_time timestamp, duration_seconds double, error_message string")
REJECTION_LOG_SCHEMA = (
    "batch_id string, table_name string, record_pk string, rule_id string, rule_type string, "
    "rejection_reason string, rejected_payload string, rejected_at timestamp")
DQ_METRICS_SCHEMA = (
    "batch_id string, table_name string, total_records bigint, valid_records bigint, "
    "quarantined_records bigint, data_quality_score_pct double, evaluated_at timestamp")

STATUS_FILE = "__STATUS__"
REJECTION_RULE_TYPE = "DATA_QUALITY_RULE"


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


# --------------------------------------------------------------- batch control
def arrival_rows(spark: SparkSession, manifest: dict, raw_root: str = "",
                 at: datetime.datetime | None = None) -> DataFrame:
    """One PENDING row per file of the manifest."""
    at = at or _now()
    rows = [(manifest["batch_id"], e["file"], e["table"],
             f"{raw_root.rstrip('/')}/{e['table']}/{e['file']}" if raw_root else None,
             at, None, None, e.get("row_count", 0), "PENDING", None)
            for e in manifest.get("tables", [])]
    return spark.createDataFrame(rows, BATCH_CONTROL_SCHEMA)


def arrivals_of(manifest: DataFrame, raw_root: str, at: datetime.datetime | None = None) -> DataFrame:
    """One PENDING row per row of a manifest table; nothing passes through the driver."""
    time = F.lit(at or _now()).cast("timestamp")
    none = F.lit(None).cast("timestamp")
    place = F.format_string(f"{raw_root.rstrip('/')}/%s/%s_%s.csv/%s", "batch_id", "table", "batch_id", "file")
    return manifest.select(
        "batch_id", F.col("file").alias("source_file"), F.col("table").alias("table_name"),
        place.alias("gcs_raw_path"), time.alias("arrival_time"), none.alias("processing_start"),
        none.alias("processing_end"), F.col("row_count").alias("records_in_file"),
        F.lit("PENDING").alias("status"), F.lit(None).cast("string").alias("error_message"))


def status_row(spark: SparkSession, batch_id: str, status: str, error: str | None = None,
               at: datetime.datetime | None = None) -> DataFrame:
    """A status change: PROCESSING sets the start, COMPLETED, FAILED and SKIPPED the end."""
    at = at or _now()
    start = at if status == "PROCESSING" else None
    end = at if status in ("COMPLETED", "FAILED", "SKIPPED") else None
    return spark.createDataFrame(
        [(batch_id, STATUS_FILE, status, None, at, start, end, 0, status, error)],
        BATCH_CONTROL_SCHEMA)


def current_status(control: DataFrame) -> DataFrame:
    """Latest row of each batch. A reduce per batch, no window over its log."""
    return control.groupBy("batch_id").agg(F.max(F.struct(
        "arrival_time", "status", "error_message")).alias("_last")).select(
        "batch_id", F.col("_last.status").alias("status"),
        F.col("_last.arrival_time").alias("status_time"),
        F.col("_last.error_message").alias("error_message"))


def completed_batches(control: DataFrame) -> DataFrame:
    """Batches with any COMPLETED row, whatever came after."""
    return control.where(F.col("status") == "COMPLETED").select("batch_id").distinct()


def pending_batches(candidates: DataFrame, control: DataFrame) -> DataFrame:
    """Candidates that have not completed yet."""
    return candidates.join(completed_batches(control), "batch_id", "left_anti")


def is_completed(control: DataFrame, batch_id: str) -> bool:
    return not control.where(
        (F.col("batch_id") == batch_id) & (F.col("status") == "COMPLETED")).isEmpty()


def reset_rows(spark: SparkSession, completed: list[str],
               at: datetime.datetime | None = None) -> DataFrame:
    """Seed rows of a reset control log."""
    at = at or _now()
    return spark.createDataFrame(
        [(b, STATUS_FILE, "COMPLETED", None, at, None, at, 0, "COMPLETED", None)
         for b in completed], BATCH_CONTROL_SCHEMA)


def reset_control(spark: SparkSession, root: str, completed: list[str]) -> None:
    """Drop the control log and keep only the given batches as COMPLETED."""
    reset_rows(spark, completed).coalesce(1).write.mode("overwrite").parquet(
        f"{root.rstrip('/')}/batch_control")


# ----------------------------------------------------------------------- audit
# Logged figures round half to even, report figures (the views) half up.
def step_rate() -> Column:
    return F.bround(F.coalesce(safe_divide(
        F.col("records_quarantined") * 100.0, F.col("records_in")), F.lit(0.0)), 2)


def step_row(spark: SparkSession, batch_id: str, stage: str, table: str, status: str,
             records_in: int = 0, records_out: int = 0, quarantined: int = 0,
             start: datetime.datetime | None = None, end: datetime.datetime | None = None,
             error: str | None = None) -> DataFrame:
    """One audit row of a stage run on a table."""
    end = end or _now()
    start = start or end
    rate = quarantined * 100.0 / records_in if records_in else 0.0
    return spark.createDataFrame(
        [(batch_id, stage, table, status, records_in, records_out, quarantined, round(rate, 2),
          start, end, round((end - start).total_seconds(), 2), error)], PIPELINE_AUDIT_SCHEMA)


def with_step_rate(steps: DataFrame) -> DataFrame:
    """Add the rejection rate and round the duration of step records that lack them."""
    return steps.withColumns({"rejection_rate_pct": step_rate(),
                              "duration_seconds": F.bround("duration_seconds", 2)})


def dq_metric_rows(metrics: DataFrame, batch_id: str, at: Column | None = None) -> DataFrame:
    """Quality metric rows: score = valid / total * 100 to two digits, 100 for an empty table."""
    score = F.coalesce(safe_divide(F.col("valid_records") * 100.0, F.col("total_records")),
                       F.lit(100.0))
    return metrics.select(
        F.lit(batch_id).alias("batch_id"), "table_name", "total_records", "valid_records",
        "quarantined_records", F.bround(score, 2).alias("data_quality_score_pct"),
        (F.current_timestamp() if at is None else at).alias("evaluated_at"))


def rejection_rows(quarantined: DataFrame, table: str) -> DataFrame:
    """Log rows of all quarantined records: the payload is the raw row as JSON, lineage left out."""
    data = [c for c in quarantined.columns if not c.startswith("_")]
    return quarantined.select(
        F.col("_batch_id").alias("batch_id"), F.lit(table).alias("table_name"),
        F.col("_record_pk").alias("record_pk"), F.col("_rejection_rule").alias("rule_id"),
        F.lit(REJECTION_RULE_TYPE).alias("rule_type"),
        F.col("_rejection_reason").alias("rejection_reason"),
        F.to_json(F.struct(*data), {"ignoreNullFields": "false"}).alias("rejected_payload"),
        F.col("_rejected_at").alias("rejected_at"))


# ---------------------------------------------------------------- verification
def audit_steps(pipeline_audit: DataFrame, batch_id: str, stage: str) -> DataFrame:
    """All steps of a batch and stage, newest first."""
    return (pipeline_audit.where((F.col("batch_id") == batch_id) & (F.col("stage") == stage))
            .select("table_name", "stage", "status", "records_in", "records_out",
                    "duration_seconds", "start_time")
            .orderBy(F.desc("start_time"), "table_name").drop("start_time"))


def latest_metrics(dq_metrics: DataFrame, batch_id: str, limit: int = 14) -> DataFrame:
    return (dq_metrics.where(F.col("batch_id") == batch_id)
            .orderBy(F.desc("evaluated_at"), "table_name").limit(limit)
            .select("table_name", "total_records", "valid_records", "quarantined_records",
                    "data_quality_score_pct"))


def sample_rejections(rejection_log: DataFrame, batch_id: str, limit: int = 5) -> DataFrame:
    return (rejection_log.where(F.col("batch_id") == batch_id)
            .select("table_name", "record_pk", "rule_id", "rejection_reason")
            .orderBy("table_name", "record_pk", "rule_id", "rejection_reason").limit(limit))


def key_measures(fact_trips: DataFrame, batch_id: str) -> DataFrame:
    """Trips, revenue, miles and average MPG of a batch."""
    return fact_trips.where(F.col("batch_id") == batch_id).agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.round(F.sum("total_revenue"), 2).alias("total_revenue"),
        F.round(F.sum("actual_distance_miles").cast("double"), 0).alias("total_miles"),
        F.round(F.avg("average_mpg"), 2).alias("fleet_avg_mpg"))


# ---------------------------------------------------------------------- alerts
def breach_alerts(breaches: DataFrame) -> DataFrame:
    """CRITICAL alert rows for tables above the rejection threshold."""
    return breaches.select(
        F.lit("CRITICAL").alias("level"),
        F.concat(F.lit("DATA QUALITY THRESHOLD BREACH: "), "table_name", F.lit(" ("), "batch_id",
                 F.lit(")")).alias("subject"),
        F.format_string(
            "Table '%s' in batch '%s' had a rejection rate of %.2f%%, "
            "exceeding the maximum allowed threshold of %.2f%%.",
            "table_name", "batch_id", F.bround("rejection_rate_pct", 2),
            F.bround("threshold_pct", 2)).alias("message"),
        "batch_id", "table_name", "total_records", "quarantined_records", "rejection_rate_pct",
        "threshold_pct", F.lit("PIPELINE_HALTED_BEFORE_GOLD").alias("action"))


def failure_alerts(pipeline_audit: DataFrame) -> DataFrame:
    """ERROR alert rows for failed steps."""
    return pipeline_audit.where(F.col("status") == "FAILED").select(
        F.lit("ERROR").alias("level"),
        F.concat(F.lit("PIPELINE STAGE FAILED: "), "stage", F.lit(" ("), "batch_id", F.lit(")"))
        .alias("subject"),
        F.concat(F.lit("Batch '"), "batch_id", F.lit("' failed during stage '"), "stage",
                 F.lit("' for table '"), F.coalesce("table_name", F.lit("ALL")), F.lit("': "),
                 F.coalesce("error_message", F.lit(""))).alias("message"),
        "batch_id", "stage", "table_name", F.col("error_message").alias("error"))


def completion_alerts(pipeline_audit: DataFrame) -> DataFrame:
    """INFO alert rows for batches whose Gold steps all completed, each step as last run."""
    last = pipeline_audit.groupBy("batch_id", "stage", "table_name").agg(F.max_by(
        F.struct("status", "records_out", "duration_seconds"),
        F.struct("end_time", "start_time", "status")).alias("_last"))
    last = last.select("batch_id", "stage", "table_name", "_last.*")
    # A failure of a whole stage is over once the stage's tables have completed.
    last = last.where((F.col("table_name") != "ALL") | (F.col("status") == "COMPLETED"))
    per_batch = last.groupBy("batch_id").agg(
        F.count_if(F.col("stage") == "GOLD").alias("_gold"),
        F.count_if((F.col("stage") == "GOLD") & (F.col("status") != "COMPLETED")).alias("_open"),
        F.sum(F.when(F.col("stage") == "GOLD", F.col("records_out"))).alias("total_rows_published"),
        F.sum("duration_seconds").alias("_seconds"))
    return per_batch.where("_gold > 0 AND _open = 0").select(
        F.lit("INFO").alias("level"),
        F.concat(F.lit("BATCH COMPLETED SUCCESSFULLY: "), "batch_id").alias("subject"),
        F.format_string("Batch '%s' processed through Medallion architecture in %.2fs.",
                        "batch_id", F.bround("_seconds", 2)).alias("message"),
        "batch_id", F.col("_gold").alias("total_tables"), "total_rows_published")


# Alert levels, subjects, messages and the action above equal the original's.
ALERT_SCHEMA = "level string, subject string, message string, batch_id string, raised_at timestamp"


def alert_rows(alerts: DataFrame) -> DataFrame:
    """Any alert rows in the form of the alert log."""
    return alerts.select("level", "subject", "message", "batch_id",
                         F.current_timestamp().alias("raised_at"))
