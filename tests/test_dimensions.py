import datetime

from pyspark.sql import functions as F

from fleetlake.operators import scd2
from fleetlake.operators.surrogate import dense_key
from fleetlake.plans import dims, facts

D = datetime.date


def test_calendar(spark):
    two = dims.calendar(spark, 2022, 2023)
    assert two.count() == 730 and two.agg(F.min("date_key")).first()[0] == 20220101
    assert dims.calendar(spark).count() == 2557
    row = dims.calendar(spark, 2024, 2024).where("full_date = '2024-03-03'").first()
    assert (row.day_of_week, row.day_name, row.month_name, row.quarter, row.is_weekend) == (
        7, "Sunday", "March", 1, True)


def test_dense_key(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(13)
    got = dense_key(df, ["k"], "sk", start=10).collect()
    assert {(r.k, r.sk) for r in got} == {(i, i + 11) for i in range(5000)}
    assert dense_key(df.limit(0), ["k"], "sk").isEmpty()


SILVER = ("driver_id string, first_name string, last_name string, hire_date date, "
          "termination_date date, employment_status string")


def drivers(spark, *rows):
    return spark.createDataFrame(list(rows), SILVER)


def test_scd2(spark):
    first = drivers(spark, ("D1", "Ann", None, D(2019, 1, 1), None, "Active"),
                    ("D2", None, "Bo", None, None, "Active"), ("D3", "C", "D", D(2018, 1, 1), None, "Active"))
    dim = dims.dim_driver(first)
    start = {r.driver_id: (r.driver_sk, r.full_name, r.valid_from, r.valid_to, r.is_current)
             for r in dim.collect()}
    assert start["D1"] == (1, "Ann ", D(2019, 1, 1), None, True)
    assert start["D2"] == (2, " Bo", D(2020, 1, 1), None, True)

    second = drivers(spark, ("D1", "Ann", "X", D(2019, 1, 1), D(2023, 6, 30), "Terminated"),
                     ("D2", "Z", "Bo", None, None, "Active"), ("D9", "N", "E", None, None, "Active"),
                     ("D8", "O", "L", D(2021, 2, 2), None, "Active"))
    merged = dims.dim_driver(second, dim, D(2023, 7, 1))
    got = sorted((r.driver_sk, r.driver_id, r.last_name, r.valid_from, r.valid_to, r.is_current)
                 for r in merged.collect())
    assert got == [
        (1, "D1", None, D(2019, 1, 1), D(2023, 7, 1), False),
        (2, "D2", "Bo", D(2020, 1, 1), None, True),
        (3, "D3", "D", D(2018, 1, 1), None, True),
        (4, "D1", "X", D(2023, 7, 1), None, True),
        (5, "D8", "L", D(2021, 2, 2), None, True),
        (6, "D9", "E", D(2023, 7, 1), None, True)]

    again = dims.dim_driver(second, merged, D(2023, 8, 1))
    assert sorted((r.driver_sk, r.valid_to) for r in again.collect()) == sorted(
        (r.driver_sk, r.valid_to) for r in merged.collect())

    trips = spark.createDataFrame([("D1", D(2023, 6, 30)), ("D1", D(2023, 7, 1)),
                                   ("D1", D(2018, 1, 1)), (None, D(2023, 1, 1))], "driver_id string, d date")
    for limit in (0, 1 << 40):
        at = scd2.version_at(trips, merged, "driver_id", "d", {"sk": "driver_sk"}, limit=limit)
        assert sorted((r.driver_id or "", r.d, r.sk) for r in at.collect()) == [
            ("", D(2023, 1, 1), None), ("D1", D(2018, 1, 1), None), ("D1", D(2023, 6, 30), 1),
            ("D1", D(2023, 7, 1), 4)]


def history(dim, *extra):
    return sorted((r.driver_id, r.valid_from, r.valid_to or D(9999, 1, 1), r.is_current, *[r[c] for c in extra])
                  for r in dim.collect())


def test_late_batches_split_history(spark):
    status = lambda *rows: drivers(spark, *[(k, "A", "B", D(2020, 1, 1), None, v) for k, v in rows])
    dim = dims.dim_driver(status(("D1", "Active"), ("D2", "Active")))
    dim = dims.dim_driver(status(("D1", "Leave"), ("D2", "Active")), dim, D(2022, 1, 1))
    end = D(9999, 1, 1)
    # Inside a closed version, inside the current one, before the first, on a change day.
    late = dims.dim_driver(status(("D1", "Ill"), ("D2", "Ill")), dim, D(2021, 1, 1))
    assert history(late, "employment_status") == [
        ("D1", D(2020, 1, 1), D(2021, 1, 1), False, "Active"), ("D1", D(2021, 1, 1), D(2022, 1, 1), False, "Ill"),
        ("D1", D(2022, 1, 1), end, True, "Leave"),
        ("D2", D(2020, 1, 1), D(2021, 1, 1), False, "Active"), ("D2", D(2021, 1, 1), end, True, "Ill")]
    front = dims.dim_driver(status(("D1", "New"), ("D2", "Active")), dim, D(2019, 1, 1))
    assert history(front, "employment_status")[:2] == [
        ("D1", D(2019, 1, 1), D(2020, 1, 1), False, "New"), ("D1", D(2020, 1, 1), D(2022, 1, 1), False, "Active")]
    assert front.count() == 4
    same_day = dims.dim_driver(status(("D1", "Gone")), dim, D(2022, 1, 1))
    assert history(same_day, "employment_status")[1:3] == [
        ("D1", D(2022, 1, 1), D(2022, 1, 1), False, "Leave"), ("D1", D(2022, 1, 1), end, True, "Gone")]
    assert sorted(r.driver_sk for r in late.collect()) == [1, 2, 3, 4, 5]


def test_intervals_never_overlap_or_run_backwards(spark):
    import random
    draw = random.Random(5)
    dim, seen = None, {}
    for _ in range(7):
        day = D(2020, 1, 1) + datetime.timedelta(days=draw.randrange(900))
        rows = [(f"D{k}", "A", "B", D(2020, 3, 1), None, draw.choice("XYZ")) for k in range(6) if draw.random() < 0.8]
        dim = dims.dim_driver(drivers(spark, *rows), dim, day)
        per_key = {}
        for key, start, end, current, _ in history(dim, "driver_sk"):
            per_key.setdefault(key, []).append((start, end, current))
        for spans in per_key.values():
            assert all(start <= end for start, end, _ in spans)
            spans = sorted(s for s in spans if s[0] < s[1])
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
            assert [c for _, _, c in spans] == [False] * (len(spans) - 1) + [True]
        if seen:  # what the batch said holds on its day
            now = {r.driver_id: r.employment_status for r in dim.where(
                (F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") > day))).collect()}
            assert all(now.get(r[0], r[5]) == r[5] for r in rows)
        seen[day] = rows


def test_scd2_leaves_a_key_without_current_version_alone(spark):
    dim = dims.dim_driver(drivers(spark, ("D1", "A", "B", None, None, "Active"))).withColumn(
        "is_current", F.lit(False))
    merged = dims.dim_driver(drivers(spark, ("D1", "A", "B", None, None, "On Leave")), dim, D(2024, 1, 1))
    assert merged.count() == 1


def test_repeated_incoming_keys_count_once(spark):
    dim = dims.dim_driver(drivers(spark, ("D1", "A", "B", None, None, "Active")))
    twice = drivers(spark, *[("D1", "A", "B", None, None, "On Leave")] * 3)
    merged = dims.dim_driver(twice, dim, D(2024, 1, 1))
    assert merged.count() == 2 and scd2.current_rows(merged).count() == 1


def test_long_histories_and_hot_keys_meet_range_by_range(spark):
    import random
    draw = random.Random(3)
    start = D(2020, 1, 1)
    spans, dim = {}, []
    for key, n in (("hot", 300), ("b", 5), ("gap", 2), ("z", 1)):
        days = sorted(draw.sample(range(900), n))
        spans[key] = [(start + datetime.timedelta(a), start + datetime.timedelta(b) if b is not None else None, i)
                      for i, (a, b) in enumerate(zip(days, [*days[1:], None]))]
        if key == "gap":
            spans[key][1] = (*spans[key][1][:1], spans[key][1][0] + datetime.timedelta(3), 1)
        dim += [(key, a, b, i) for a, b, i in spans[key]]
    dim.append(("b", spans["b"][1][0], spans["b"][1][0], 99))  # replaced on its own day
    versions = spark.createDataFrame(dim, "k string, valid_from date, valid_to date, v long")
    facts = [(i, draw.choice(["hot"] * 20 + ["b", "gap", "z", "none", None]),
              draw.choice([None] + [start + datetime.timedelta(d) for d in range(-20, 1000)])) for i in range(3000)]
    df = spark.createDataFrame(facts + facts[:5], "id long, k string, d date")

    def truth(k, d):
        return next((i for a, b, i in spans.get(k, []) if d and a <= d and (b is None or d < b)), None)

    found = scd2.version_at(df, versions, "k", "d", {"version": "v"}, limit=0)
    got = found.collect()
    assert found.columns == ["id", "k", "d", "version"] and len(got) == 3005
    assert all(r.version == truth(r.k, r.d) for r in got) and sum(r.version is not None for r in got) > 2000
    assert scd2.version_at(df.limit(0), versions, "k", "d", {"version": "v"}, limit=0).count() == 0
    none = scd2.version_at(df, versions.limit(0), "k", "d", {"version": "v"}, limit=0)
    assert none.where("version is not null").isEmpty() and none.count() == 3005


def test_type1_upsert(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "sk bigint, k string, v string")
    new = spark.createDataFrame([("b", None), ("c", "z")], "k string, v string")
    got = scd2.type1_upsert(old, new, "k", "sk")
    assert sorted((r.sk, r.k, r.v) for r in got.collect()) == [(1, "a", "x"), (2, "b", None), (3, "c", "z")]


def test_fact_trips_revenue(spark):
    trips = spark.createDataFrame([("T1", "L1", D(2022, 1, 2)), ("T2", "L2", D(2022, 1, 3)), ("T3", "L9", D(2022, 1, 3))],
                                  "trip_id string, load_id string, dispatch_date date")
    loads = spark.createDataFrame([("L1", 1500.0, 200.0, 50), ("L2", None, 10.0, None)],
                                  "load_id string, revenue double, fuel_surcharge double, accessorial_charges long")
    for limit in (0, 1 << 40):
        got = facts.fact_trips(trips, loads, "b1", limit=limit).collect()
        assert {(r.trip_id, r.total_revenue, r.freight_revenue, r.accessorial_charges, r.batch_id)
                for r in got} == {("T1", 1750.0, 1500.0, 50, "b1"), ("T2", 10.0, 0.0, 0, "b1")}
