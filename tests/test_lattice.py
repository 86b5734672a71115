"""States of facts: strays, blanks, one scan, no Expand."""

import datetime

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import joins
from fleetlake.plans import lattice, measures
from fleetlake.plans.measures import Context, PERIODS

D = datetime.date
TRIP = ("trip_id string, truck_id string, driver_id string, dispatch_date date, actual_distance_miles long, "
        "total_revenue double")


def tables(spark):
    trips = spark.createDataFrame([
        ("1", "T1", "D1", D(2022, 1, 1), 10, 1.0), ("2", "T1", "D2", D(2022, 1, 1), None, 2.0),
        ("3", "T2", None, D(2022, 1, 2), 30, 4.0), ("4", "T9", "D9", D(2022, 2, 1), 5, 8.0),
        ("5", None, "D1", D(2023, 2, 1), 7, None), ("6", "T9", "D1", D(2023, 2, 1), 9, 16.0)], TRIP)
    trucks = spark.createDataFrame([(1, "T1", "A"), (2, "T2", "B"), (40_000, "T3", "B")],
                                   "truck_sk long, truck_id string, make string")
    drivers = spark.createDataFrame([(1, "D1", "x", False), (3, "D1", "y", True), (2, "D2", "x", True)],
                                    "driver_sk long, driver_id string, employment_status string, is_current boolean")
    return trips, {"dim_truck": trucks, "dim_driver": drivers}


def plain(df):
    return sorted(map(str, df.collect()))


def test_contexts_equal_the_measures_evaluated_one_by_one(spark):
    trips, dims = tables(spark)
    names = ["total_revenue", "total_trips", "average_trip_distance", "active_truck_count", "active_driver_count",
             "revenue_per_mile"]
    contexts = {
        "all": Context(), "make": Context(attributes={"make": ("dim_truck", "make")}),
        "status_year": Context(periods={"year": PERIODS["year"]},
                               attributes={"status": ("dim_driver", "employment_status")}),
        "month": Context(periods={"month": PERIODS["month"]}), "truck": Context(columns=("truck_id",))}
    found = lattice.evaluate_many(names, {measures.TRIPS: trips}, contexts, dims)
    for name, context in contexts.items():
        one = measures.evaluate(names, {measures.TRIPS: trips}, context, dims)
        assert plain(found[name]) == plain(one.select(*found[name].columns)), name


def test_distinct_counts_add_up_over_time(spark):
    trips, dims = tables(spark)
    got = {(r["level"], r["period"]): (r["active_truck_count"], r["active_driver_count"])
           for r in lattice.distinct_rollup(trips, dims, ["active_truck_count", "active_driver_count"]).collect()}
    assert got["total", None] == (4, 4)  # T1, T2, the unknown T9 and the blank; D1, D2, D9 and the blank
    assert got["year", D(2022, 1, 1)] == (3, 4) and got["month", D(2023, 2, 1)] == (2, 1)
    assert got["day", D(2022, 1, 1)] == (1, 2)


def test_a_state_is_one_scan_without_expand(spark, tmp_path):
    trips, dims = tables(spark)
    trips.write.parquet(f"{tmp_path}/trips")
    for name, dim in dims.items():
        dim.write.parquet(f"{tmp_path}/{name}")
        dims[name] = spark.read.parquet(f"{tmp_path}/{name}")
    state = lattice.states(measures.TRIPS, spark.read.parquet(f"{tmp_path}/trips"), frozenset({lattice.DAY}),
                           ["total_revenue", "active_truck_count", "active_driver_count"], dims)
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "Expand [" not in plan and plan.count("/trips]") == 1
    assert state.where("_kind = ''").agg(F.sum("_rows")).first()[0] == 6


def test_a_fine_state_is_no_larger_than_its_fact(spark, tmp_path):
    """Keys that leave a row or two per group: a state holds words of the bits, not whole bitmaps."""
    n = 5000
    trips = spark.range(n).select(
        F.col("id").cast("string").alias("trip_id"), F.concat(F.lit("T"), F.col("id") % 1000).alias("truck_id"),
        F.concat(F.lit("D"), F.col("id") % 70).alias("driver_id"),
        F.date_add(F.lit("2022-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("dispatch_date"),
        F.col("id").alias("actual_distance_miles"), F.lit(1.0).alias("total_revenue"))
    # Dense keys at the borders of words, below zero and far apart; the last ids have none.
    trucks = spark.range(990).select(
        (F.when(F.col("id") < 500, F.col("id") - 200).otherwise(F.col("id") * 1_000_003)).alias("truck_sk"),
        F.concat(F.lit("T"), "id").alias("truck_id"), (F.col("id") % 3).cast("string").alias("make"))
    state = lattice.states(measures.TRIPS, trips, frozenset({"truck_id", "driver_id", lattice.DAY}),
                           ["active_truck_count"], {"dim_truck": trucks})
    assert state.count() <= 2 * n
    assert state.schema["_bits"].dataType.simpleString() == "bigint"  # 8 bytes a row
    assert "SortAggregate" not in state._jdf.queryExecution().executedPlan().toString()
    contexts = {"all": Context(), "make_year": Context(periods={"year": PERIODS["year"]}, attributes={"make": ("dim_truck", "make")})}
    found = lattice.evaluate_many(["active_truck_count"], {measures.TRIPS: trips}, contexts, {"dim_truck": trucks})
    assert found["all"].first()[0] == 1000
    for name, context in contexts.items():
        one = measures.evaluate(["active_truck_count"], {measures.TRIPS: trips}, context, {"dim_truck": trucks})
        assert plain(found[name]) == plain(one.select(*found[name].columns)), name


def fine_fact(spark, n=20_000):
    """Trips of which hardly two share a truck, a driver and a day; ids unknown, blank and of no current row."""
    trips = spark.range(n).select(
        F.col("id").cast("string").alias("trip_id"),
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("T"), F.col("id") * 7919 % 6500)).alias("truck_id"),
        F.when(F.col("id") % 60 != 0, F.concat(F.lit("D"), F.col("id") * 31 % 75)).alias("driver_id"),
        F.date_add(F.lit("2022-01-01").cast("date"), (F.col("id") * 13 % 730).cast("int")).alias("dispatch_date"),
        (F.col("id") % 90).alias("actual_distance_miles"), (F.col("id") % 40 / 4).alias("total_revenue"),
        F.lit("unread").alias("note"))
    trucks = spark.range(6400).select(
        (F.col("id") + 1).alias("truck_sk"), F.concat(F.lit("T"), "id").alias("truck_id"),
        F.when(F.col("id") % 25 != 0, (F.col("id") % 25).cast("string")).alias("make"))
    # Drivers up to 69 have a closed version and, but for the first five, a current one.
    day = F.lit("2022-09-01").cast("date")
    closed = spark.range(70).select(
        (F.col("id") + 1).alias("driver_sk"), F.concat(F.lit("D"), "id").alias("driver_id"), F.lit("old").alias("employment_status"),
        F.lit(False).alias("is_current"), F.lit("2000-01-01").cast("date").alias("valid_from"), day.alias("valid_to"))
    current = spark.range(5, 70).select(
        (F.col("id") + 100).alias("driver_sk"), F.concat(F.lit("D"), "id").alias("driver_id"),
        (F.col("id") % 2).cast("string").alias("employment_status"), F.lit(True).alias("is_current"), day.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"))
    return trips, {"dim_truck": trucks, "dim_driver": closed.unionByName(current)}


FINE = ["total_revenue", "total_trips", "average_trip_distance", "active_truck_count", "active_driver_count"]
FINE_CONTEXTS = {
    "make_year": Context(periods={"year": PERIODS["year"]}, attributes={"make": ("dim_truck", "make")}),
    "status_month": Context(periods={"month": PERIODS["month"]}, attributes={"status": ("dim_driver", "employment_status")}),
    "renamed": Context(periods={"y": PERIODS["year"], "again": PERIODS["year"]}, attributes={"brand": ("dim_truck", "make")}),
    "all": Context()}


def test_no_node_of_a_fine_fact_is_as_large_as_the_fact(spark, monkeypatch):
    trips, dims = fine_fact(spark)
    sizes, node = [], lattice._node

    def noted(rows, keys, name):
        made = node(rows, keys, name)
        sizes.append(made.size)
        return made

    monkeypatch.setattr(lattice, "_node", noted)
    found = lattice.evaluate_many(FINE, {measures.TRIPS: trips}, FINE_CONTEXTS, dims)
    # By truck, driver and day: 20,000 rows for the sums and as many for each counted column.
    assert len(sizes) == 4 and max(sizes) < 20_000
    for name, context in FINE_CONTEXTS.items():
        one = measures.evaluate(FINE, {measures.TRIPS: trips}, context, dims)
        assert plain(found[name]) == plain(one.select(*found[name].columns)), name


def test_an_attribute_at_the_event_beside_current_ones(spark):
    trips, dims = fine_fact(spark, 2000)
    contexts = {"then": Context(periods={"year": PERIODS["year"]}, attributes={
        "make": ("dim_truck", "make"), "status": ("dim_driver", "employment_status")}, at_event=frozenset({"status"})),
        "now": FINE_CONTEXTS["status_month"]}
    found = lattice.evaluate_many(FINE, {measures.TRIPS: trips}, contexts, dims)
    for name, context in contexts.items():
        one = measures.evaluate(FINE, {measures.TRIPS: trips}, context, dims)
        assert plain(found[name]) == plain(one.select(*found[name].columns)), name


def test_dimensions_too_large_to_broadcast_shuffle_no_unread_column(spark, tmp_path, monkeypatch):
    trips, dims = fine_fact(spark, 2000)
    trips.write.parquet(f"{tmp_path}/t")
    trips = spark.read.parquet(f"{tmp_path}/t")
    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", 0)
    state = lattice.states(measures.TRIPS, trips, frozenset({lattice.DAY}), FINE, dims)
    assert "note" not in state._jdf.queryExecution().executedPlan().toString()
    # The source of hot ids only picks what is salted: results are the same by any.
    found = lattice.evaluate_many(FINE, {measures.TRIPS: trips}, FINE_CONTEXTS, dims, {measures.TRIPS: trips.limit(50)})
    for name, context in FINE_CONTEXTS.items():
        one = measures.evaluate(FINE, {measures.TRIPS: trips}, context, dims)
        assert plain(found[name]) == plain(one.select(*found[name].columns)), name


def test_an_id_with_several_rows_is_an_error(spark):
    trips, dims = fine_fact(spark, 100)
    dims["dim_truck"] = dims["dim_truck"].unionByName(dims["dim_truck"].limit(3))
    with pytest.raises(Exception, match="dim_truck has several rows of truck_id"):
        lattice.evaluate_many(FINE, {measures.TRIPS: trips}, FINE_CONTEXTS, dims)
