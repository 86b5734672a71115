"""A lake from CSV files through two batches."""

import datetime

import pytest
from pyspark.sql import functions as F

from fleetlake import registry
from fleetlake.catalog.shapes import shape
from fleetlake.operators.quality import RejectionRateExceeded
from fleetlake.plans import control, pipeline
from fleetlake.sources import store

SF = "/root/testdata/sf0.001"
YEARS = {"batch_001": (1995, 1997), "batch_002": (1998, 2030)}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    for name, meta in registry.TABLES.items():
        df = shape(spark, SF, name)
        if name in ("trips", "fuel_purchases"):  # line keys repeat in the test data
            df = df.dropDuplicates(list(meta.primary_key))
        for batch_id, (first, last) in YEARS.items():
            part = df
            if name == "drivers" and batch_id == "batch_002":
                part = shape(spark, SF, "drivers_next").withColumn(
                    "employment_status", F.lit("On Leave"))
            elif name == "delivery_events":
                part = df if batch_id == "batch_002" else df.where("detention_minutes < 100")
            elif meta.batch_date and name != "loads":
                part = df.where(F.year(meta.batch_date).between(first, last))
            text = part.select(*[F.col(c).cast("string").alias(c) for c in meta.column_names])
            (text.coalesce(1).write.option("header", True)
             .csv(f"{root}/raw/{batch_id}/{name}_{batch_id}.csv"))
    return pipeline.Lake(f"{root}/lake", f"{root}/raw", max_rejection_rate_pct=60.0,
                         parallel_tables=8)


def test_two_batches_end_to_end(spark, lake):
    first = pipeline.run_batch(spark, lake, "batch_001", as_of=datetime.date(1998, 1, 1))
    assert first["status"] == "COMPLETED"
    silver = {t["table"]: t for t in first["silver"]["tables"]}
    for t in silver.values():
        assert t["valid"] + t["quarantined"] == t["total"]
    assert sum(t["total"] for t in silver.values()) == first["bronze"]["total_rows"]
    assert silver["trips"]["quarantined"] == 0 and silver["maintenance_records"]["quarantined"] == 0

    gold = lake.zone("gold")
    trips = store.read_table(spark, gold, "fact_trips")
    n1 = first["gold"]["tables"]["fact_trips"]
    assert trips.count() == n1 > 0
    assert trips.schema["total_revenue"].dataType.simpleString() == "double"
    assert store.read_dimension(spark, gold, "dim_date").count() == 2557

    assert pipeline.run_batch(spark, lake, "batch_001")["status"] == "SKIPPED"

    second = pipeline.run_batch(spark, lake, "batch_002", as_of=datetime.date(1999, 6, 30))
    drivers = store.read_dimension(spark, gold, "dim_driver")
    sk = [r.driver_sk for r in drivers.collect()]
    assert sorted(sk) == list(range(1, len(sk) + 1))
    current = drivers.where("is_current").groupBy("driver_id").count()
    assert current.where("count > 1").isEmpty()
    assert drivers.where("not is_current").count() > 0
    total = n1 + second["gold"]["tables"]["fact_trips"]
    assert store.read_table(spark, gold, "fact_trips").count() == total

    pipeline.publish_batch(spark, lake, "batch_002", datetime.date(1999, 6, 30))
    assert store.read_table(spark, gold, "fact_trips").count() == total
    assert store.read_dimension(spark, gold, "dim_driver").count() == len(sk)

    audit = store.read_log(spark, lake.zone("audit"), "pipeline_audit", control.PIPELINE_AUDIT_SCHEMA)
    per_stage = {(r.batch_id, r.stage): r["count"] for r in audit.groupBy("batch_id", "stage").count().collect()}
    assert per_stage[("batch_001", "BRONZE")] == per_stage[("batch_001", "SILVER")] == 14
    assert per_stage[("batch_001", "GOLD")] == 14 and per_stage[("batch_002", "GOLD")] == 28
    metrics = store.read_log(spark, lake.zone("audit"), "data_quality_metrics", control.DQ_METRICS_SCHEMA)
    assert metrics.where("batch_id = 'batch_001'").count() == 14
    rejected = store.read_log(spark, lake.zone("audit"), "rejection_log", control.REJECTION_LOG_SCHEMA)
    logged = {(r.batch_id, r.table_name): r["count"] for r in rejected.groupBy("batch_id", "table_name").count().collect()}
    for batch_id, run in (("batch_001", first), ("batch_002", second)):
        for t in run["silver"]["tables"]:
            assert logged.get((batch_id, t["table"]), 0) == t["quarantined"]

    # Keys of the first batch stay in the dimensions after the second.
    for dim, key in (("dim_customer", "customer_id"), ("dim_truck", "truck_id")):
        used = trips.where("batch_id = 'batch_001'").select(key).where(f"{key} IS NOT NULL")
        known = store.read_dimension(spark, gold, dim).select(key)
        early = store.read_batch(spark, lake.zone("silver"), dim[4:] + "s", "batch_001").select(key)
        assert used.join(early, key, "left_semi").join(known, key, "left_anti").isEmpty()

    alerts = store.read_log(spark, lake.zone("audit"), "alerts", control.ALERT_SCHEMA)
    assert alerts.where("level = 'INFO'").count() == 2
    done = control.completion_alerts(audit.where("batch_id = 'batch_002'")).first()
    assert (done.total_tables, done.total_rows_published) == (14, second["gold"]["total_rows_published"])


def test_a_bad_fact_is_never_seen(spark, lake, monkeypatch):
    before = store.read_batch(spark, lake.zone("gold"), "fact_maintenance", "batch_001").count()
    build, source = pipeline.facts.SINGLE_SOURCE["fact_maintenance"]
    monkeypatch.setitem(pipeline.facts.SINGLE_SOURCE, "fact_maintenance", (
        lambda df, b: build(df, b).withColumn("maintenance_id", F.lit(None).cast("string")), source))
    with pytest.raises(pipeline.MissingKeys):
        pipeline.publish_fact(spark, lake, "batch_001", "fact_maintenance")
    after = store.read_batch(spark, lake.zone("gold"), "fact_maintenance", "batch_001")
    assert after.count() == before > 0 and after.where("maintenance_id IS NULL").isEmpty()


def test_short_and_long_lines_are_set_aside(spark, lake, tmp_path):
    folder = tmp_path / "raw" / "b1"
    folder.mkdir(parents=True)
    head = registry.TABLES["routes"].column_names
    good = ",".join(f"v{i}" for i in range(len(head)))
    (folder / "routes_b1.csv").write_text("\n".join([",".join(head), good, good + ",extra", "only", good]) + "\n")
    small = pipeline.Lake(str(tmp_path / "lake"), str(tmp_path / "raw"))
    got = pipeline.ingest_table(spark, small, "b1", "routes")
    assert (got["rows"], got["malformed"]) == (2, 2)
    kept = store.read_batch(spark, small.zone("bronze"), "routes", "b1")
    assert kept.count() == 2 and "_malformed" not in kept.columns
    aside = store.read_batch(spark, small.zone("malformed"), "routes", "b1")
    assert {r["_malformed"] for r in aside.collect()} == {good + ",extra", "only"}


def test_batches_take_effect_on_their_own_dates():
    dates = [pipeline.effective_date(b) for b, _ in registry.BATCHES]
    assert dates == sorted(set(dates))


def test_a_wrong_manifest_stops_the_batch(spark, lake):
    manifest = {"batch_id": "batch_001", "tables": [
        {"table": "routes", "file": "routes.csv", "row_count": 1, "file_size_bytes": 1, "sha256": "0"}]}
    with pytest.raises(pipeline.ManifestMismatch):
        pipeline.run_batch(spark, lake, "batch_001", force=True, manifest=manifest)


def test_a_breach_stops_the_batch_and_is_logged_once(spark, lake):
    strict = pipeline.Lake(lake.root + "-strict", lake.raw_root, max_rejection_rate_pct=0.0)
    pipeline.ingest_table(spark, strict, "batch_001", "customers")
    with pytest.raises(RejectionRateExceeded):
        pipeline.refine_table(spark, strict, "batch_001", "customers")
    log = store.read_log(spark, strict.zone("audit"), "pipeline_audit", control.PIPELINE_AUDIT_SCHEMA)
    assert [(r.status, r.records_quarantined > 0) for r in log.where("stage = 'SILVER'").collect()] == [
        ("FAILED", True)]
    assert not store.read_batch(spark, strict.zone("quarantine"), "customers", "batch_001").isEmpty()
    open_lake = pipeline.Lake(strict.root, lake.raw_root, quarantine_enabled=False)
    assert pipeline.refine_table(spark, open_lake, "batch_001", "customers")["quarantined"] == 0


def test_missing_files_mark_the_batch_failed(spark, lake):
    empty = pipeline.Lake(lake.root + "-none", lake.raw_root)
    with pytest.raises(Exception):
        pipeline.run_batch(spark, empty, "batch_009", manifest={"batch_id": "batch_009", "tables": []})
    log = store.read_log(spark, empty.zone("audit"), "batch_control", control.BATCH_CONTROL_SCHEMA)
    assert control.current_status(log).first().status == "FAILED"
