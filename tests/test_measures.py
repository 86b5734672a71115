import datetime

import pytest

from fleetlake.plans import measures, timeintel, dims
from fleetlake.plans.measures import Context, PERIODS

D = datetime.date


def trips(spark, *rows):
    return spark.createDataFrame(
        list(rows), "dispatch_date date, truck_id string, total_revenue double, actual_distance_miles long")


def test_facts_side_by_side_with_missing_groups_and_blanks(spark):
    t = trips(spark, (D(2022, 1, 1), "A", 100.0, 0), (D(2023, 1, 1), None, 50.0, 10))
    fuel = spark.createDataFrame([(D(2023, 5, 1), 20.0), (None, 7.0)], "purchase_date date, total_cost double")
    shop = spark.createDataFrame([], "maintenance_date date, total_cost double")
    names = ["total_revenue", "total_operating_cost", "operating_margin", "cost_per_mile", "active_truck_count"]
    got = measures.evaluate(names, {measures.TRIPS: t, measures.FUEL: fuel, measures.MAINTENANCE: shop},
                            Context(periods={"year": PERIODS["year"]}))
    assert {tuple(r) for r in got.collect()} == {
        (2022, 100.0, 0.0, 100.0, 0.0, 1), (2023, 50.0, 20.0, 30.0, 2.0, 1),
        (None, None, 7.0, -7.0, 0.0, None)}


def test_distinct_count_counts_blank_once(spark):
    t = trips(spark, (D(2022, 1, 1), "A", 1.0, 1), (D(2022, 1, 1), None, 1.0, 1), (D(2022, 1, 1), None, 1.0, 1))
    assert measures.evaluate(["active_truck_count"], {measures.TRIPS: t}).first()[0] == 2


def test_every_folder_measure_exists():
    for names in measures.FOLDERS.values():
        assert measures.base_measures(list(names))
    assert sum(map(len, measures.FOLDERS.values())) == 45


def test_periods_skip_gaps(spark):
    t = trips(spark, (D(2024, 1, 5), "A", 10.0, 1), (D(2024, 3, 5), "A", 30.0, 1), (D(2023, 2, 28), "A", 5.0, 1),
              (D(2024, 2, 29), "A", 0.0, 1))
    cal = dims.calendar(spark, 2023, 2024)
    month = {r.month: r for r in timeintel.previous_month(cal, t).collect()}
    assert month[D(2024, 3, 1)].revenue_previous_month == 0.0
    assert month[D(2024, 4, 1)].revenue is None and month[D(2024, 4, 1)].mom_growth_pct == -1.0
    assert len(month) == 24
    day = {r.full_date: r for r in timeintel.prior_year(cal, t).collect()}
    assert day[D(2024, 2, 29)].revenue_prior_year == 5.0
    ytd = {r.full_date: r.revenue_ytd for r in timeintel.year_to_date(cal, t).collect()}
    assert ytd[D(2024, 12, 31)] == 40.0 and ytd[D(2024, 1, 4)] is None and ytd[D(2023, 12, 31)] == 5.0


def test_a_lookup_key_with_several_rows_is_an_error(spark):
    from fleetlake.plans.measures import Context, evaluate
    trips = spark.createDataFrame([("k1", 1.0)], "truck_id string, total_revenue double")
    trucks = spark.createDataFrame([("k1", "a"), ("k1", "b")], "truck_id string, make string")
    with pytest.raises(Exception, match="several rows"):
        evaluate(["total_revenue"], {"fact_trips": trips}, Context(attributes={"make": ("dim_truck", "make")}),
                 {"dim_truck": trucks}).collect()


def test_measures_that_do_not_add_up_have_no_running_total(spark):
    for name in ("average_trip_distance", "active_truck_count"):
        with pytest.raises(ValueError, match="do not add up"):
            timeintel.year_to_date_in(name, {}, measures.Context())
