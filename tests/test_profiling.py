"""Profiles that merge, types by share, joins on buckets."""

from pyspark.sql import functions as F

from fleetlake.operators import profiling
from fleetlake.plans import facts
from fleetlake.sources import store


def test_merged_states_equal_one_profile(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 4).alias("batch"), (F.col("id") % 7000).alias("k"), F.lit(None).cast("string").alias("nothing"),
        F.when(F.col("id") % 10 > 0, F.col("id") * 1.0).alias("x"))
    states = profiling.sketched(df, "batch", ["x"])
    assert states.count() == 4 * 3
    found = {r["column_name"]: r for r in profiling.merged_profile(states, (0.25, 0.5)).collect()}
    assert found["k"]["row_count"] == 20_000 and abs(found["k"]["unique_values"] - 7000) < 3 * profiling.HLL_ERROR * 7000
    assert (found["nothing"]["null_count"], found["nothing"]["unique_values"], found["nothing"]["q50"]) == (20_000, 0, None)
    assert found["x"]["null_count"] == 2000 and abs(found["x"]["q25"] - 5000) < 20_000 * profiling.KLL_ERROR
    assert found["k"]["q50"] is None


def test_a_few_bad_values_are_outliers(spark):
    df = spark.createDataFrame(
        [("1", "2022-01-01", "a", "true")] * 18 + [("x", "2022-01-01 10:00:00", "b", None), ("1.5", None, "1", None)],
        "n string, d string, s string, b string")
    got = {r["column_name"]: (r["dominant_type"], r["outlier_rows"], r["outlier_values"], r["values"])
           for r in profiling.type_shares(df).collect()}
    assert got == {"n": ("integer", 2, 2, 20), "d": ("date", 1, 1, 19), "s": ("text", 0, 0, 20), "b": ("boolean", 0, 0, 18)}
    assert profiling.type_shares(df.limit(0)).count() == 0


def test_tables_in_equal_buckets_join_without_a_shuffle(spark, tmp_path):
    trips = spark.range(500).select(F.col("id").cast("string").alias("trip_id"), (F.col("id") % 90).cast("string").alias("load_id"))
    loads = spark.range(80).select(F.col("id").cast("string").alias("load_id"), (F.col("id") * 1.5).alias("revenue"))
    left, right = (store.write_bucketed(df, str(tmp_path / n), ["load_id"], 4) for n, df in (("t", trips), ("l", loads)))
    joined = facts._priced(left.hint("merge").join(right.hint("merge"), "load_id").withColumns(
        {"fuel_surcharge": F.lit(0.0), "accessorial_charges": F.lit(0)}), "b1")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    got = facts.fact_trips_bucketed(left, right, "b1")
    assert sorted(r["trip_id"] for r in got.collect()) == sorted(
        r["trip_id"] for r in facts.fact_trips(trips, loads, "b1").collect()) and got.count() > 400


def test_buckets_grow_with_the_tables(spark, tmp_path, monkeypatch):
    from fleetlake.catalog.queries import QUERIES
    asked, write = [], store.write_bucketed
    monkeypatch.setattr(store, "BUCKET_ROWS", 500)
    monkeypatch.setattr(store, "write_bucketed", lambda df, path, keys, n: asked.append(n) or write(df, path, keys, n))
    found = QUERIES["fact_trips_bucketed"](spark, "/root/testdata/sf0.001")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert asked == [-(-lines // 500)] * 2 and asked[0] > 8  # rows of a bucket stay the same, both tables have as many
    assert found.count() == lines
    assert store.buckets_for(spark.range(3), spark.range(0), least=8) == 8
