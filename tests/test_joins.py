"""The salted join must equal a plain join, under skew and with null keys."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.joins import hot_keys, is_small, lookup_join


@pytest.fixture(scope="module")
def sides(spark):
    # A third of the rows share one key, a tenth have none.
    left = spark.range(6000).select(
        "id", F.when(F.col("id") < 2000, "hot").when(F.col("id") % 10 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("k"))
    rows = [("hot", 1), (None, 2)] + [(f"k{i}", i) for i in range(0, 700, 2)]
    return left, spark.createDataFrame(rows, "k string, v int")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_equals_brute_force(sides, how, null_safe):
    left, right = sides
    table = {r.k: r.v for r in right.collect()}
    expected = Counter()
    for r in left.collect():
        value = table.get(r.k) if (r.k is not None or null_safe) else None
        if value is not None or how == "left":
            expected[(r.id, r.k, value)] += 1
    for limit in (0, 1 << 40):  # salted, broadcast
        got = lookup_join(left, right, ["k"], how, null_safe, limit=limit)
        assert got.columns == ["id", "k", "v"]
        assert Counter(map(tuple, got.collect())) == expected


def test_hot_keys_are_found_and_bounded(spark, sides):
    left, _ = sides
    found = {r[0] for r in hot_keys(left, ["k"]).collect()}
    hot = spark.sql("select xxhash64('hot') h").first().h
    assert hot in found and len(found) <= 1000


def test_salted_plan_spreads_the_hot_key(sides):
    left, right = sides
    got = lookup_join(left.repartition(8), right, ["k"], limit=0)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_residual_condition(spark):
    left = spark.createDataFrame([(1, 5), (1, 15), (2, 5)], "k int, d int")
    right = spark.createDataFrame([(1, 0, "a"), (1, 10, "b")], "k int, lo int, v string")
    inside = (F.col("d") >= F.col("lo")) & (F.col("d") < F.col("lo") + 10)
    for limit in (0, 1 << 40):
        got = lookup_join(left, right, ["k"], condition=inside, limit=limit)
        assert {(r.k, r.d, r.v) for r in got.collect()} == {(1, 5, "a"), (1, 15, "b"), (2, 5, None)}


def test_size_check(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).write.parquet(path)
    df = spark.read.parquet(path)
    assert is_small(df) and not is_small(df, 1)
