"""Work that must be done once, however many readers come after it."""

import pytest
from pyspark.sql import functions as F

from fleetlake.catalog import queries
from fleetlake.sources import raw, scratch, store

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["gold_publish_rerun", "gold_publish_concurrent", "gold_layouts"])
def test_published_facts_are_worked_out_once(spark, monkeypatch, name):
    """What is published lies at rest: no publishing repeats the join or the grouping."""
    plans, lay = [], store.laid_out
    monkeypatch.setattr(store, "laid_out", lambda df, table, *rest: plans.append(
        df._jdf.queryExecution().optimizedPlan().toString()) or lay(df, table, *rest))
    queries.QUERIES[name](spark, SF)
    assert len(plans) == {"gold_publish_rerun": 8, "gold_publish_concurrent": 6, "gold_layouts": 7}[name]
    assert not any("Join" in p or "Aggregate" in p for p in plans)


def test_a_table_at_rest_by_a_column(spark):
    rows = spark.createDataFrame([(1, "a", 1995), (2, None, 1996), (2, None, 1996), (3, "c", None)], "x int, y string, z int")
    rest = scratch.materialised(rows, "by", by="z")
    assert rest.columns == rows.columns and rest.schema["z"].dataType == rows.schema["z"].dataType
    assert sorted(map(str, rest.collect())) == sorted(map(str, rows.collect()))
    assert len(rest.where("z = 1995").inputFiles()) <= 4
    plan = rest.where("z = 1995")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(z" in plan
    assert scratch.materialised(rows.limit(0), "by", by="z").count() == 0


def test_a_batch_label_parses_a_text_once(spark):
    texts = ["1995-02-01", " 1996-12-31 ", "1996-05-05 10:00:00", "1997-01-01 10:00:00.123456", "1997-01-01 10:00:00.5", "2031-01-01",
             "1994-12-31", "soon", "", " ", None, "1996-02-30", "1996-05-05 25:00:00", "1996-05-05T10:00:00", "10:00:00", "1996-05-05 10:00",
             "+12345-01-01", "1996-5-5", "-1996-05-05", "1996-05-05 "]
    batches = (("a", 1995), ("twice", 1995), ("b", 1996), ("beyond", 2050), ("c", 1997))
    rows = spark.createDataFrame([(t,) for t in texts], "d string")

    def plain(text):  # both formats, each batch in turn
        from fleetlake import registry
        from fleetlake.functions.text import strip
        day = F.coalesce(*[F.try_to_timestamp(strip(F.col(text)), F.lit(f)) for f in (registry.TIMESTAMP_FORMAT, registry.DATE_FORMAT)])
        label = F.when(F.year(day) >= 1997, "c")
        for b, y in batches[:-1]:
            label = label.when(F.year(day) == y, b)
        return label

    label = raw.batch_label("d", batches)
    got = rows.select("d", label.alias("got"), plain("d").alias("want")).collect()
    assert [(r["d"], r["got"]) for r in got] == [(r["d"], r["want"]) for r in got]
    assert {r["got"] for r in got} == {"a", "b", "c", None}
    plan = rows.select(label)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("gettimestamp") == 2  # one per format, not two per batch


def _shuffle_files(spark):
    import glob
    store_dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in store_dirs for f in glob.glob(f"{d}/*/shuffle_*")}


def test_writing_leaves_no_shuffle_files(spark):
    import time
    before = _shuffle_files(spark)
    rows = spark.range(1000).repartition(5).groupBy(F.col("id") % 7).count()
    scratch.materialised(rows, "rows")
    for _ in range(50):  # they go soon after
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(scratch._SHUFFLE_CLEANUP, None) is None and not scratch._open


def test_what_lies_at_rest_for_a_block_is_deleted(spark, monkeypatch):
    import os
    rows = spark.createDataFrame([(1, 1995), (2, 1996), (3, None)], "x int, y int")
    paths, folder = [], scratch.run_folder
    monkeypatch.setattr(scratch, "run_folder", lambda *a: paths.append(folder(*a)) or paths[-1])
    with pytest.raises(KeyError), scratch.at_rest(rows, "rest", by="y") as rest:
        assert sorted(map(str, rest.collect())) == sorted(map(str, rows.collect()))
        assert os.path.isdir(paths[0].removeprefix("file:"))
        raise KeyError
    assert not os.path.exists(paths[0].removeprefix("file:"))


def test_years_are_laid_out_in_slices(spark, tmp_path, monkeypatch):
    """Only the rows of a slice are shuffled at once; together they are the whole table, null dates too."""
    rows = spark.range(600).select(
        F.concat(F.lit("m"), "id").alias("maintenance_id"), F.concat(F.lit("t"), F.col("id") % 9).alias("truck_id"),
        F.when(F.col("id") % 50 > 0, F.date_add(F.lit("2019-12-01").cast("date"), (F.col("id") * 2).cast("int")))
        .alias("maintenance_date"), F.lit("Tire").alias("maintenance_type"))
    sizes, lay = [], store.laid_out
    monkeypatch.setattr(store, "laid_out", lambda df, *rest: sizes.append(df.count()) or lay(df, *rest))
    monkeypatch.setattr(store, "SLICE_ROWS", 200)
    with scratch.at_rest(rows.withColumn("_year", F.year("maintenance_date")), "rows", by="_year") as lying:
        store.publish_fact(lying, str(tmp_path), "fact_maintenance", "b1", by="_year")
    assert sum(sizes) == 600 and len(sizes) == 5 and max(sizes) <= 200
    got = store.read_table(spark, str(tmp_path), "fact_maintenance").drop("batch_id")
    assert sorted(map(str, got.select(*rows.columns).collect())) == sorted(map(str, rows.collect()))
    index = store.file_index(spark, str(tmp_path), "fact_maintenance")
    assert index.agg(F.sum("n")).first()[0] == 600
    with scratch.at_rest(rows.limit(0).withColumn("_year", F.year("maintenance_date")), "rows", by="_year") as lying:
        store.publish_fact(lying, str(tmp_path), "fact_maintenance", "b1", by="_year")
    empty = store.read_table(spark, str(tmp_path), "fact_maintenance")
    assert empty.count() == 0 and {*rows.columns} <= {*empty.columns}
