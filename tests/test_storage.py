import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from fleetlake import registry
from fleetlake.functions import casting, text
from fleetlake.plans import control
from fleetlake.sources import raw, store
from fleetlake.streaming import arrivals


def write(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(content)


def test_csv_scan(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    write(path, 'a,b,c\n1, nan ,"x, ""y"""\nN/A,NULL,\n"",None,"two\nlines"\n')
    got = raw.read_raw_csv(spark, path, multi_line=True, with_file=True).collect()
    assert [tuple(r) for r in got] == [
        ("1", " nan ", 'x, "y"', "t.csv"), (None, None, None, "t.csv"),
        (None, None, "two\nlines", "t.csv")]


def test_batch_split_and_manifest(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "2022-01-01"), ("2", "2023-05-01 10:00:00.5"), ("3", "2026-01-01"), ("4", "2019-01-01"),
         ("5", "bad"), ("6", None)], "id string, d string")
    got = {r.id: r.batch_id for r in raw.split_batches(df, "d").collect()}
    assert got == {"1": "batch_001", "2": "batch_002", "3": "batch_003"}
    root = str(tmp_path / "split")
    raw.write_batches(df, "d", root)
    paths = {"loads": f"{root}/batch_id=batch_001"}
    manifest = raw.batch_manifest(spark, "batch_001", 2022, paths)
    (entry,) = manifest["tables"]
    with open(f"{root}/batch_id=batch_001/{entry['file']}", "rb") as f:
        content = f.read()
    assert entry["sha256"] == hashlib.sha256(content).hexdigest()
    assert (entry["row_count"], entry["file_size_bytes"]) == (1, len(content))
    raw.write_manifest(spark, manifest, str(tmp_path / "manifest"))
    assert raw.read_manifest(spark, str(tmp_path / "manifest")) == json.loads(json.dumps(manifest))
    assert raw.verify_manifest(spark, manifest, paths).isEmpty()
    entry["sha256"] = "0" * 64
    assert raw.verify_manifest(spark, manifest, paths).count() == 1


def test_casts(spark):
    df = spark.createDataFrame(
        [("12",), (" 12.0 ",), ("1e3",), ("12.5",), ("9007199254740993",), ("x",), ("1d",), (None,), ("",), ("+7.",)],
        "v string")
    got = [(r.l, r.n) for r in df.select(text.to_long(F.col("v")).alias("l"),
                                         text.to_number(F.col("v")).alias("n")).collect()]
    assert got == [(12, 12.0), (12, 12.0), (1000, 1000.0), (None, 12.5),
                   (9007199254740993, 9007199254740992.0), (None, None), (None, None), (None, None),
                   (None, None), (7, 7.0)]
    words = spark.createDataFrame([("TRUE",), (" t ",), ("y",), ("No",), ("0",), (None,)], "v string")
    assert [r[0] for r in words.select(casting.to_boolean(F.col("v"))).collect()] == [
        True, True, None, False, False, None]


def test_fact_publish_is_idempotent_per_batch(spark, tmp_path):
    root = str(tmp_path)
    columns = "maintenance_id string, truck_id string, maintenance_date date, maintenance_type string, batch_id string"
    first = spark.sql("select 'a' maintenance_id, 't' truck_id, date'2022-01-01' maintenance_date, 'Tire' maintenance_type, 'b1' batch_id"
                      " union all select 'b', 't', date'2022-02-01', 'Tire', 'b1'")
    assert first.schema.simpleString().count(":") == columns.count(" string") + 1
    store.publish_fact(first, root, "fact_maintenance", "b1")
    store.publish_fact(first.withColumn("maintenance_id", F.lit("c")).limit(1), root, "fact_maintenance", "b2")
    store.publish_fact(first.where("maintenance_id = 'a'"), root, "fact_maintenance", "b1")
    got = {(r.maintenance_id, r.batch_id) for r in store.read_table(spark, root, "fact_maintenance").collect()}
    assert got == {("a", "b1"), ("c", "b2")}
    plan = store.read_table(spark, root, "fact_maintenance").where("batch_id = 'b1'")
    assert "PartitionFilters: [isnotnull(batch_id" in plan._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileNotFoundError):
        store.read_batch(spark, root, "fact_maintenance", "b9")


def maintenance(spark, n=2000):
    return spark.range(n).select(
        F.format_string("m%05d", "id").alias("maintenance_id"), F.format_string("t%02d", F.col("id") % 20).alias("truck_id"),
        F.date_add(F.lit("2022-01-01").cast("date"), (F.col("id") % 360).cast("int")).alias("maintenance_date"),
        F.when(F.col("id") % 7 == 0, "Tire").alias("maintenance_type"))


def test_a_writer_that_dies_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    store.publish_fact(maintenance(spark, 10), root, "fact_maintenance", "b1")
    running = store.read_table(spark, root, "fact_maintenance")
    monkeypatch.setattr(store, "commit", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.publish_fact(maintenance(spark, 3), root, "fact_maintenance", "b1")
    monkeypatch.undo()
    assert store.read_table(spark, root, "fact_maintenance").count() == 10
    store.publish_fact(maintenance(spark, 4), root, "fact_maintenance", "b1")
    assert store.read_table(spark, root, "fact_maintenance").count() == 4
    assert running.count() == 10  # a query that started before keeps its files
    assert store.read_table(spark, root, "fact_maintenance", at=1).count() == 10
    assert store.superseded(spark, root, "fact_maintenance").count() == 1


def test_writers_at_the_same_time_all_commit(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    root = str(tmp_path)
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: store.commit(spark, root, "t", f"b{i % 3}", f"v{i}"), range(6)))
    log = store.commits(spark, root, "t").collect()
    assert sorted(r["version"] for r in log) == [f"v{i}" for i in range(6)]
    last = {}
    for r in sorted(log, key=lambda r: (r["seq"], r["version"])):
        last[r["batch_id"]] = r["version"]
    assert store.snapshot(spark, root, "t") == last and len(last) == 3


def test_a_dimension_made_from_an_old_version_is_refused(spark, tmp_path):
    root = str(tmp_path)
    first = store.write_dimension(spark.range(1), root, "d")
    store.release_dimension(spark, root, "d", first)
    mine, theirs = (store.write_dimension(spark.range(n), root, "d") for n in (2, 3))
    store.release_dimension(spark, root, "d", theirs, first)
    with pytest.raises(store.Conflict):
        store.release_dimension(spark, root, "d", mine, first)
    assert store.read_dimension(spark, root, "d").count() == 3


def test_date_ranges_and_cluster_values_read_few_files(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    rows = maintenance(spark)
    monkeypatch.setattr(store, "FILE_ROWS", 50)
    store.write_batch(store.laid_out(rows, "fact_maintenance", 50), root, "fact_maintenance", "b1")
    store.write_batch(store.laid_out(rows.limit(0), "fact_maintenance"), root, "fact_maintenance", "b2")
    every = len(store.read_table(spark, root, "fact_maintenance").inputFiles())
    per_month = {}
    for r in store.file_index(spark, root, "fact_maintenance").collect():
        per_month.setdefault(r["file"].split("_period=")[1][:7], []).append(r["n"])
    assert len(per_month) == 12 and all(len(f) <= sum(f) // 50 + 3 for f in per_month.values())
    day = __import__("datetime").date
    some = store.read_where(spark, root, "fact_maintenance", truck_id="t03",
                            maintenance_date=(day(2022, 3, 5), day(2022, 4, 2)))
    keep = (F.col("truck_id") == "t03") & F.col("maintenance_date").between(day(2022, 3, 5), day(2022, 4, 2))
    assert sorted(some.drop("batch_id").collect()) == sorted(rows.where(keep).collect()) != []
    assert len(some.inputFiles()) <= 4 < 40 <= every
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_period" in plan
    rare = store.read_where(spark, root, "fact_maintenance", maintenance_type="Tire", truck_id="t07")
    assert rare.count() == rows.where("truck_id = 't07' and maintenance_type = 'Tire'").count() > 0
    assert store.read_where(spark, root, "fact_maintenance", truck_id="none").count() == 0
    monkeypatch.setattr(store, "MOST_FILES", 1)
    assert store.read_where(spark, root, "fact_maintenance", truck_id="t03").count() == 100


def test_dimension_publish_keeps_readers_on_a_whole_version(spark, tmp_path):
    root = str(tmp_path)
    assert store.read_dimension(spark, root, "d") is None
    store.publish_dimension(spark.range(3), root, "d")
    current = store.read_dimension(spark, root, "d")
    store.publish_dimension(current.union(spark.range(3, 5).toDF("id")), root, "d")
    assert store.read_dimension(spark, root, "d").count() == 5
    assert current.count() == 3


def test_clustered_layout_cuts_a_hot_date(spark):
    df = spark.range(40000).select(
        F.concat(F.lit("m"), "id").alias("maintenance_id"), F.lit("t").alias("truck_id"),
        F.lit("2022-01-01").cast("date").alias("maintenance_date"), F.lit("Tire").alias("maintenance_type"))
    sizes = store.clustered(df, "fact_maintenance", 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 12000


def test_control_log(spark, tmp_path):
    root = str(tmp_path)
    log = lambda: store.read_log(spark, root, "batch_control", control.BATCH_CONTROL_SCHEMA)
    assert log().isEmpty()
    manifest = {"batch_id": "b1", "tables": [{"file": "f.csv", "table": "loads", "row_count": 3}]}
    store.append(control.arrival_rows(spark, manifest, "raw"), root, "batch_control")
    row = log().first()
    assert (row.status, row.gcs_raw_path, row.records_in_file) == ("PENDING", "raw/loads/f.csv", 3)
    for status in ("PROCESSING", "COMPLETED", "FAILED"):
        store.append(control.status_row(spark, "b1", status, "it's" if status == "FAILED" else None),
                     root, "batch_control")
    now = control.current_status(log()).first()
    assert (now.status, now.error_message) == ("FAILED", "it's")
    assert control.is_completed(log(), "b1") and not control.is_completed(log(), "b2")
    todo = control.pending_batches(spark.createDataFrame([("b1",), ("b2",)], "batch_id string"), log())
    assert [r.batch_id for r in todo.collect()] == ["b2"]
    control.reset_control(spark, root, ["b7"])
    assert [(r.batch_id, r.status) for r in log().collect()] == [("b7", "COMPLETED")]


def test_arrivals_are_read_once(spark, tmp_path):
    header = ",".join(registry.table("loads").column_names)
    line = lambda i: ",".join([f"L{i}"] + ["NULL"] * 11)
    landing, bronze, check = (str(tmp_path / n) for n in ("landing", "bronze", "check"))
    write(f"{landing}/b1/loads_b1.csv", f"{header}\n{line(1)}\n{line(2)}\n")
    write(f"{landing}/b1/trips_b1.csv", "x\n1\n")
    run = lambda: arrivals.ingest_arrivals(spark, landing, bronze, check, "loads").awaitTermination()
    read = lambda: sorted((r.load_id, r.route_id, r.batch_id, r._source_file)
                          for r in store.read_table(spark, bronze, "loads").collect())
    run(), run()
    assert read() == [("L1", None, "b1", "loads_b1.csv"), ("L2", None, "b1", "loads_b1.csv")]
    write(f"{landing}/b2/loads_b2.csv", f"{header}\n{line(3)}\n")
    run()
    assert [r[0] for r in read()] == ["L1", "L2", "L3"]


def test_arriving_lines_that_do_not_fit_are_set_aside(spark, tmp_path):
    head = registry.table("routes").column_names
    good = ",".join(f"v{i}" for i in range(len(head)))
    landing, bronze, aside, check = (str(tmp_path / n) for n in ("landing", "bronze", "aside", "check"))
    write(f"{landing}/b1/routes_b1.csv", "\n".join([",".join(head), good, good + ",extra", "only", good]) + "\n")
    for _ in range(2):
        arrivals.ingest_arrivals(spark, landing, bronze, check, "routes").awaitTermination()
        arrivals.ingest_malformed(spark, landing, aside, check, "routes").awaitTermination()
    assert store.read_table(spark, bronze, "routes").count() == 2
    bad = store.read_table(spark, aside, "routes").collect()
    assert sorted(r[raw.MALFORMED] for r in bad) == sorted([good + ",extra", "only"])
    assert {(r["batch_id"], r["_source_file"]) for r in bad} == {("b1", "routes_b1.csv")}
