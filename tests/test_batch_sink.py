"""Unsplit CSV to batches with hashes, and a run that makes its own batches."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from fleetlake import registry
from fleetlake.catalog.shapes import shape
from fleetlake.plans import control, pipeline
from fleetlake.sources import batch_sink, raw, store

SF = "/root/testdata/sf0.001"
BATCHES = (("batch_a", 1995), ("batch_b", 1996))


def unsplit(spark, folder, name, lines):
    head = registry.table(name).column_names
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w", encoding="utf-8") as f:
        f.write("\n".join([",".join(head), *lines]) + "\n")
    return len(head)


def files_of(root, batch_id, table):
    folder = f"{root}/{batch_id}/{table}_{batch_id}.csv"
    return {n: open(f"{folder}/{n}", "rb").read() for n in os.listdir(folder)}


def test_split_table(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    at = registry.table("loads").column_names.index("load_date")
    width = len(registry.table("loads").column_names)

    def line(key, day, text="x"):
        fields = [text] * width
        fields[0], fields[at] = key, day
        return ",".join(fields)

    unsplit(spark, source, "loads", [
        line("1", "1995-02-01"), line("2", "1995-03-01 10:00:00", '"a, ""b"""'), line("3", "1996-05-05", "N/A"), line("7", "1999-01-01"),
        line("4", "1990-01-01"), line("5", "never"), "short,line", line("6", "1996-01-01") + ",long"])
    for _ in range(2):  # a second run replaces the first
        batch_sink.split_table(spark, f"{source}/loads.csv", "loads", root, BATCHES + (("batch_c", 2030),))
    listed = {(r["batch_id"], r["file"]): r for r in batch_sink.manifest(spark, root).collect()}
    for batch_id in ("batch_a", "batch_b", "batch_c"):
        files = files_of(root, batch_id, "loads")
        assert {(batch_id, n) for n in files} == {k for k in listed if k[0] == batch_id}
        for name, body in files.items():
            row = listed[batch_id, name]
            assert (row["sha256"], row["file_size_bytes"]) == (hashlib.sha256(body).hexdigest(), len(body))
            assert row["row_count"] == body.count(b"\n") - 1
    read = lambda b: raw.read_raw_csv(spark, f"{root}/{b}/loads_{b}.csv")
    first = {r["load_id"]: r for r in read("batch_a").collect()}
    assert set(first) == {"1", "2"} and first["2"]["load_type"] == 'a, "b"'
    assert [(r["load_id"], r["load_type"]) for r in read("batch_b").collect()] == [("3", None)]
    assert b"N/A" in b"".join(files_of(root, "batch_b", "loads").values())  # texts stay as they were
    assert read("batch_c").columns == registry.table("loads").column_names and read("batch_c").isEmpty()
    aside = spark.read.parquet(f"{root}/_malformed/loads")
    assert sorted(r[raw.MALFORMED].rsplit(",", 1)[1] for r in aside.collect()) == ["line", "long"]


def test_a_failed_write_leaves_no_batch(spark, tmp_path):
    root = str(tmp_path)
    broken = spark.range(20).select(
        F.when(F.col("id") == 17, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("v"),
        F.lit("b1").alias("batch_id"))
    with pytest.raises(Exception, match="lost"):
        batch_sink.write_batches(broken, root, "loads", ["b1"])
    assert batch_sink.manifest(spark, root).isEmpty() and not os.path.exists(f"{root}/b1")
    whole = spark.range(5).select(F.col("id").cast("string").alias("v"), F.lit("b1").alias("batch_id"))
    batch_sink.write_batches(whole, root, "loads", ["b1"])
    assert batch_sink.manifest(spark, root, "b1").agg(F.sum("row_count")).first()[0] == 5


def test_run_starts_from_an_unsplit_folder(spark, tmp_path):
    source = str(tmp_path / "unsplit")
    for name, meta in registry.TABLES.items():
        df = shape(spark, SF, name)
        if meta.batch_date:
            df = df.where(F.year(meta.batch_date).between(1995, 2030)).limit(60)
        df = df.dropDuplicates(list(meta.primary_key)).limit(60)
        (df.select(*[F.col(c).cast("string").alias(c) for c in meta.column_names]).coalesce(1)
         .write.option("header", True).csv(f"{source}/{name}.csv"))
    lake = pipeline.Lake(str(tmp_path / "lake"), str(tmp_path / "batches"), max_rejection_rate_pct=100.0,
                         parallel_tables=8)
    first, second = pipeline.run_all_batches(spark, lake, source_root=source, split=BATCHES)
    assert first["status"] == second["status"] == "COMPLETED"
    listed = {(r["batch_id"], r["table"]): r["n"] for r in batch_sink.manifest(spark, lake.raw_root).groupBy(
        "batch_id", "table").agg(F.sum("row_count").alias("n")).collect()}
    assert len(listed) == 2 * len(registry.TABLES)
    for run in (first, second):
        assert {t["table"]: t["rows"] for t in run["bronze"]["tables"]} == {
            t: n for (b, t), n in listed.items() if b == run["batch_id"]}
    log = store.read_log(spark, lake.zone("audit"), "batch_control", control.BATCH_CONTROL_SCHEMA)
    pending = log.where("status = 'PENDING'")
    assert pending.agg(F.sum("records_in_file")).first()[0] == sum(listed.values())
    place = pending.where("table_name = 'loads'").first()["gcs_raw_path"]
    assert os.path.exists(place)
    # A file that changes after the split stops the batch.
    with open(place, "ab") as file:
        file.write(b"more\n")
    with pytest.raises(pipeline.ManifestMismatch):
        pipeline.run_batch(spark, lake, "batch_a" if "/batch_a/" in place else "batch_b", force=True)
