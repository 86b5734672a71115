import pytest
from pyspark.sql import functions as F

from fleetlake import registry
from fleetlake.operators import joins, quality
from fleetlake.registry import Rule

CUSTOMER = dict(customer_id="C1", customer_name="A", customer_type="Spot", credit_terms_days="30",
                primary_freight_type="General", account_status="Active",
                contract_start_date="2021-01-01", annual_revenue_potential="10")


def rows(spark, table, base, *changes):
    names = registry.table(table).column_names
    return spark.createDataFrame([[{**base, **c}.get(n) for n in names] for c in changes],
                                 registry.raw_schema(table))


def outcome(df, table, key):
    return {r[key]: r._rejection_rule for r in quality.annotate_table(df, table).collect()}


def test_split_attributes_the_first_failure(spark):
    df = rows(spark, "customers", CUSTOMER, {}, {"customer_id": "C2", "customer_type": "Leasing",
              "annual_revenue_potential": "-1"}, {"customer_id": " ", "customer_type": "Leasing"})
    valid, rejected = quality.evaluate_table(df, "customers", "b1")
    assert [r.customer_id for r in valid.collect()] == ["C1"]
    assert {(r._record_pk, r._rejection_rule, r._batch_id) for r in rejected.collect()} == {
        ("C2", "cust_type_enum", "b1"), (" ", "cust_pk_not_null", "b1")}


def test_every_member_of_a_duplicate_group_fails_and_null_keys_are_equal(spark):
    df = rows(spark, "customers", CUSTOMER, {}, {}, {"customer_id": None}, {"customer_id": None},
              {"customer_id": "C2"})
    got = quality.annotate_table(df, "customers").groupBy("customer_id").agg(
        F.collect_set("_rejection_rule").alias("r"), F.count("*").alias("n"))
    assert {(r.customer_id, tuple(r.r), r.n) for r in got.collect()} == {
        ("C1", ("pk_uniqueness",), 2), (None, ("pk_uniqueness",), 2), ("C2", (), 1)}


def test_duplicates_of_a_hot_key_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr("fleetlake.operators.joins.BROADCAST_LIMIT_BYTES", 0)
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, -1).when(F.col("id") < 1100, None).otherwise(
            F.col("id") - F.when(F.col("id") % 50 == 1, 1).otherwise(0)).alias("k"), "id")
    counts = {}
    local = df.collect()
    for r in local:
        counts[r.k] = counts.get(r.k, 0) + 1
    got = {r.id: r._duplicate for r in quality.mark_duplicates(df, ["k"]).collect()}
    assert got == {r.id: counts[r.k] > 1 for r in local}


@pytest.mark.parametrize("value, fails", [
    ("5", False), (" 5.0 ", False), ("1e2", False), ("0", True), ("501", True), ("abc", True),
    ("1d", True), ("NaN", False), ("null", False), ("NULL", False), ("", False), (None, False),
    ("Infinity", True), ("500", False)])
def test_range(spark, value, fails):
    rule = Rule("r", "range", "d", "v", min=1, max=500)
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(quality.fails(rule)).first()[0] is fails


@pytest.mark.parametrize("value, fails", [
    ("Dry Van", False), (" dry VAN ", False), ("Flatbed", True), ("NONE", False), (None, False)])
def test_enum(spark, value, fails):
    rule = Rule("r", "enum", "d", "v", allowed=("Dry Van",))
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(quality.fails(rule)).first()[0] is fails


@pytest.mark.parametrize("value, fails", [
    ("x", False), ("", True), (" nan ", True), ("None", True), ("NULL", True), (None, True),
    ("null", False)])
def test_not_null(spark, value, fails):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(quality.fails(Rule("r", "not_null", "d", "v"))).first()[0] is fails


def test_expression_rules_see_typed_values(spark):
    base = {c: "x" for c in registry.table("drivers").column_names}
    base.update(employment_status="Active", years_experience="3", hire_date="2020-05-01")
    df = rows(spark, "drivers", base,
              {"driver_id": "ok", "termination_date": None},
              {"driver_id": "late", "termination_date": "2020-05-01"},
              {"driver_id": "early", "termination_date": "2020-04-30"},
              {"driver_id": "junk", "termination_date": "soon"})
    assert outcome(df, "drivers", "driver_id") == {
        "ok": None, "late": None, "early": "driver_hire_before_term", "junk": None}


def test_missing_columns_warnings_and_empty_input(spark):
    df = rows(spark, "customers", CUSTOMER, {}).drop("account_status", "customer_type")
    assert quality.annotate_table(df, "customers").where("_rejection_rule is null").count() == 1
    warn = Rule("w", "range", "d", "annual_revenue_potential", min=100, severity="WARNING")
    assert quality.annotate(df, [warn], [], ()).where("_rejection_rule is not null").isEmpty()
    assert quality.warning_counts(df, [warn], ()).first().failed_rows == 1
    empty = df.limit(0)
    valid, rejected = quality.evaluate_table(empty, "customers", "b")
    assert valid.isEmpty() and rejected.isEmpty() and "_rejection_rule" in rejected.columns
    m = quality.table_metrics(quality.annotate_table(empty, "customers"), "customers").first()
    assert (m.total_records, m.rejection_rate_pct, m.dq_score_pct) == (0, 0.0, 100.0)


def test_gate_is_strict():
    quality.check_gate("t", 100, 20)
    with pytest.raises(quality.RejectionRateExceeded, match="21.00% of the rows"):
        quality.check_gate("t", 100, 21)
    quality.check_gate("t", 0, 0)


def test_quarantine_can_be_off(spark):
    df = rows(spark, "customers", CUSTOMER, {}, {"customer_id": None})
    valid, rejected = quality.evaluate_table(df, "customers", "b", quarantine=False)
    assert valid.count() == 2 and rejected.isEmpty()


def test_absent_columns_and_key_parts(spark):
    rows = spark.createDataFrame([("E1", None, "2022-01-02"), ("E1", None, "x")],
                                 "event_id string, load_id string, scheduled_datetime string")
    found = quality.annotate_table(rows, "delivery_events")  # its expression rules name columns that are not there
    assert found.where("_rejection_rule = 'pk_uniqueness'").count() == 2
    rejected = quality.quarantined_rows(found, ["event_id", "absent"], "b1").first()
    assert rejected["_record_pk"] == "E1"
    assert quality.quarantined_rows(found, ["absent"], "b1").first()["_record_pk"] is None


def test_duplicate_keys_of_a_large_table_are_written_first(spark, tmp_path, monkeypatch):
    spark.range(3000).select((F.col("id") % 2990).cast("string").alias("customer_id"),
                             F.lit("x").alias("customer_name")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", 2000)
    marked = quality.mark_duplicates(df, ["customer_id"])
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert marked.where("_duplicate").count() == 20
