"""Registered queries: each library operation over whole test tables, with its expected SQL."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from fleetlake import registry
from fleetlake.catalog import oracles as o
from fleetlake.catalog.shapes import base, shape
from fleetlake.functions import casting, text
from fleetlake.operators import profiling, quality, scd2
from fleetlake.plans import control, dims, facts, lattice, measures, timeintel, views
from fleetlake.plans.measures import Context, PERIODS
from fleetlake.session import configure
from fleetlake.sources import batch_sink, raw, store
from fleetlake.sources.scratch import at_rest, materialised, run_folder
from fleetlake.streaming import arrivals

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BATCH = "batch_001"
FIRST_MERGE = datetime.date(1997, 6, 30)
SECOND_MERGE = datetime.date(1999, 6, 30)
DATA_BATCHES = tuple((f"batch_{y}", y) for y in range(1995, 2001))
_STAMPS = ("_created_at", "_gold_published_at", "_silver_processed_at", "_rejected_at",
           "_ingested_at", "_source_file")


class Tables:
    """Shapes and Gold tables of one data folder, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        df = self._build(name)
        setattr(self, name, df)
        return df

    def _build(self, name: str) -> DataFrame:
        if name == "dim_driver":
            return dims.dim_driver(self.drivers)
        if name == "dim_driver_two":
            return dims.dim_driver(self.drivers_next, self.dim_driver, FIRST_MERGE)
        if name == "dim_driver_three":
            return dims.dim_driver(self.drivers_last, self.dim_driver_two, SECOND_MERGE)
        if name == "dim_driver_late":
            return dims.dim_driver(self.drivers_last, self.dim_driver_three, datetime.date(1998, 6, 30))
        if name == "dim_driver_early":
            return dims.dim_driver(self.drivers_next, self.dim_driver_late, datetime.date(1996, 1, 31))
        if name == "dim_driver_forced":
            return dims.dim_driver(self.drivers, self.dim_driver_three, datetime.date(1997, 1, 1))
        if name in dims.SNAPSHOT_DIMS:
            return dims.snapshot_dim(name, getattr(self, dims.SNAPSHOT_DIMS[name][0]))
        if name == "fact_trips":
            return facts.fact_trips(self.trips, self.loads, BATCH)
        if name in facts.SINGLE_SOURCE:
            build, source = facts.SINGLE_SOURCE[name]
            return build(getattr(self, source), BATCH)
        return shape(self.spark, self.sf_dir, name)

    def folder(self, name: str) -> str:
        return run_folder(self.spark, name)


def query(sql: str | None, digits: dict[int, tuple[str, ...]] | None = None,
          tables: dict[str, str] | None = None):
    """Register a query. ``digits`` rounds double columns on both sides before comparison.

    ``tables`` are further named subqueries the SQL mentions.
    """
    digits = digits or {}

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(Tables(spark, sf_dir))
            df = df.drop(*[c for c in _STAMPS if c in df.columns])
            rounding = {c: n for n, cs in digits.items() for c in cs}
            return df.select(*[
                F.round(F.col(f.name), rounding[f.name]).alias(f.name) if f.name in rounding
                else F.col(f.name).cast("timestamp_ntz").alias(f.name)
                if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                for f in df.schema])

        QUERIES[name] = run
        if sql is not None:
            body = sql
            for n, columns in digits.items():
                body = o.rounded(body, n, *columns) if columns else body
            ORACLES[name] = o.with_tables(body, tables)
        return build

    return register


# ============================================================ A scans and sinks
def _raw_columns(table: str) -> list[str]:
    return registry.table(table).column_names


def _write_csv(df: DataFrame, path: str) -> None:
    (df.write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def _csv_nulls(table: str) -> str:
    return ", ".join(f"{o.csv_null(c)} AS {c}" for c in _raw_columns(table))


@query(f"SELECT {_csv_nulls('customers')} FROM raw_customers")
def raw_csv_scan(t):
    path = t.folder("raw-customers")
    _write_csv(t.raw_customers, path)
    return raw.read_raw_csv(t.spark, path)


@query(f"""SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role,
  {o.csv_null('text')} AS text, FALSE AS malformed FROM conversations""")
def csv_multi_line_text(t):
    """Texts with quotes and line breaks to CSV and back, whole."""
    path = t.folder("conversations")
    rows = base(t.spark, t.sf_dir, "conversations")
    _write_csv(rows.select(*[F.col(c).cast("string") for c in rows.columns]), path)
    read = raw.read_raw_csv(t.spark, path, multi_line=True, with_malformed=True)
    return read.withColumn("malformed", F.col(raw.MALFORMED).isNotNull()).drop(raw.MALFORMED)


@query(f"""SELECT {_csv_nulls('loads')}, 'batch_1997' AS _batch_id, 'batch_1997' AS batch_id
FROM raw_loads WHERE load_date >= '1997' AND load_date < '1998'""")
def bronze_batch(t):
    """Split to CSV batches, ingest all of them, read one back by partition."""
    root, bronze = t.folder("batches"), t.folder("bronze")
    raw.write_batches(t.raw_loads, "load_date", root, DATA_BATCHES)
    for batch_id, _ in DATA_BATCHES:
        rows = raw.read_raw_csv(t.spark, f"{root}/batch_id={batch_id}", with_file=True)
        store.write_batch(raw.with_lineage(rows, batch_id), bronze, "loads", batch_id)
    return store.read_batch(t.spark, bronze, "loads", "batch_1997")


@query("""SELECT load_id, load_date, 'batch_' || least(load_date[1:4], '2000') AS batch_id
FROM raw_loads WHERE load_date >= '1995'""")
def batch_split(t):
    return raw.split_batches(t.raw_loads, "load_date", DATA_BATCHES).select(
        "load_id", "load_date", "batch_id")


@query("""SELECT 'loads' AS "table", 'batch_' || least(load_date[1:4], '2000') AS batch_id,
  count(*) AS row_count, TRUE AS hashed, TRUE AS sized FROM raw_loads GROUP BY 1, 2""")
def batch_manifest(t):
    root = t.folder("manifest")
    raw.write_batches(t.raw_loads, "load_date", root, DATA_BATCHES)
    files = raw.table_manifest(t.spark, root, "loads")
    return files.groupBy("table", F.regexp_extract("location", "batch_id=([^/]+)/", 1)
                         .alias("batch_id")).agg(
        F.sum("row_count").alias("row_count"),
        F.bool_and(F.length("sha256") == 64).alias("hashed"),
        F.bool_and(F.col("file_size_bytes") > 0).alias("sized"))


_SPLIT = (("loads", "load_date"), ("trips", "dispatch_date"), ("delivery_events", "scheduled_datetime"))


def _split_sql(table: str, date: str) -> str:
    return f"""SELECT '{table}' AS "table", 'batch_' || least({date}[1:4], '2000') AS batch_id,
  count(*) AS row_count, TRUE AS intact FROM raw_{table} WHERE {date} >= '1995' GROUP BY 1, 2"""


@query(" UNION ALL ".join(_split_sql(*s) for s in _SPLIT) + """ UNION ALL
SELECT 'customers', 'batch_' || y, (SELECT count(*) FROM raw_customers), TRUE FROM range(1995, 2001) r(y)""")
def split_to_manifest(t):
    """Unsplit CSV to batches: rows of the manifest, and whether the files, read again, have its
    sizes and hashes and hold its rows."""
    source, root = t.folder("unsplit"), t.folder("batches")
    tables = [name for name, _ in _SPLIT] + ["customers"]
    for name in tables:
        _write_csv(getattr(t, f"raw_{name}"), f"{source}/{name}.csv")
        batch_sink.split_table(t.spark, f"{source}/{name}.csv", name, root, DATA_BATCHES)
    listed = batch_sink.manifest(t.spark, root)
    again = reduce(DataFrame.unionByName, [
        raw.file_hashes(t.spark, f"{root}/{b}").join(raw.file_row_counts(t.spark, f"{root}/{b}"), "location", "left")
        for b, _ in DATA_BATCHES]).select("file", F.col("sha256").alias("s"), F.col("file_size_bytes").alias("b"),
                                          F.coalesce("row_count", F.lit(0)).alias("n"))
    same = (F.col("sha256").eqNullSafe(F.col("s")) & F.col("file_size_bytes").eqNullSafe(F.col("b"))
            & F.col("row_count").eqNullSafe(F.col("n")))
    return (listed.join(again, "file", "full_outer").groupBy("table", "batch_id")
            .agg(F.sum("row_count").alias("row_count"), F.bool_and(same).alias("intact")).where("row_count > 0"))


_VALID_CUSTOMERS = (f"SELECT * FROM ({o.annotated('raw_customers', 'customers')}) a "
                    "WHERE _rejection_rule IS NULL")
_REJECTED_CUSTOMERS = (f"SELECT * FROM ({o.annotated('raw_customers', 'customers')}) a "
                       "WHERE _rejection_rule IS NOT NULL")


@query(f"SELECT *, '{BATCH}' AS batch_id FROM "
       f"({o.typed(f'({_VALID_CUSTOMERS}) v', 'customers')}) t")
def silver_batch(t):
    root = t.folder("silver")
    valid, _ = quality.evaluate_table(t.raw_customers, "customers", BATCH)
    typed = casting.cast_table(valid, registry.table("customers").columns)
    store.write_batch(typed.withColumn("_silver_processed_at", F.current_timestamp()), root,
                      "customers", BATCH)
    return store.read_batch(t.spark, root, "customers", BATCH)


@query(f"""SELECT *, {o.record_pk(['customer_id'])} AS _record_pk, '{BATCH}' AS _batch_id,
  '{BATCH}' AS batch_id FROM ({_REJECTED_CUSTOMERS}) r""")
def quarantine_batch(t):
    root = t.folder("quarantine")
    _, rejected = quality.evaluate_table(t.raw_customers, "customers", BATCH)
    store.write_batch(rejected, root, "customers", BATCH)
    return store.read_batch(t.spark, root, "customers", BATCH)


def _trips_by_year(t, first: int, last: int) -> DataFrame:
    """Trips of some years with their ``_year``, at rest by it: the join with the loads is worked out
    once, and the publishing of a year reads its files alone."""
    rows = t.fact_trips.withColumn("_year", F.year("dispatch_date")).where(F.col("_year").between(first, last))
    return materialised(rows, "trips-by-year", by="_year")


@query("""SELECT 'batch_' || year(dispatch_date) AS batch_id, count(*) AS trips,
  sum(actual_distance_miles)::BIGINT AS miles FROM fact_trips
WHERE year(dispatch_date) BETWEEN 1995 AND 2001 GROUP BY 1""")
def gold_publish_rerun(t):
    """Publish all years, publish the first again: nothing doubles, nothing is lost."""
    root, trips = t.folder("gold"), _trips_by_year(t, 1995, 2001)
    for year in (*range(1995, 2002), 1995):
        batch = trips.where(F.col("_year") == year).drop("_year")
        store.publish_fact(batch, root, "fact_trips", f"batch_{year}")
    return store.read_table(t.spark, root, "fact_trips").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("actual_distance_miles").alias("miles"))


@query("""SELECT 'batch_' || year(dispatch_date) AS batch_id, count(*) AS trips,
  sum(actual_distance_miles)::BIGINT AS miles FROM fact_trips
WHERE year(dispatch_date) BETWEEN 1995 AND 1998 GROUP BY 1""")
def gold_publish_concurrent(t):
    """Writers of different batches and of the same batch at once: each batch is there once and whole."""
    root, trips = t.folder("gold"), _trips_by_year(t, 1995, 1998)

    def publish(year):
        store.publish_fact(trips.where(F.col("_year") == year).drop("_year"), root, "fact_trips", f"batch_{year}")

    with ThreadPoolExecutor(4) as writers:
        list(writers.map(publish, (1995, 1996, 1997, 1998, 1995, 1996)))
    return store.read_table(t.spark, root, "fact_trips").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("actual_distance_miles").alias("miles"))


_TRUCK_COLUMNS = [c.name for c in registry.GOLD["dim_truck"]
                  if c.name not in ("truck_sk", "_created_at")]
_UPSERT = f"""
SELECT d.truck_sk, {', '.join(f'CASE WHEN n.truck_id IS NULL THEN d.{c} ELSE n.{c} END AS {c}' for c in _TRUCK_COLUMNS)}
FROM dim_truck d LEFT JOIN trucks_next n ON d.truck_id = n.truck_id
UNION ALL
SELECT (SELECT max(truck_sk) FROM dim_truck) + row_number() OVER (ORDER BY truck_id), {', '.join(_TRUCK_COLUMNS)}
FROM trucks_next WHERE NOT EXISTS (SELECT 1 FROM dim_truck d WHERE d.truck_id = trucks_next.truck_id)"""


@query(_UPSERT)
def gold_publish_dimension(t):
    """Publish, merge with what was published, publish over it, read the current version."""
    root = t.folder("gold")
    store.publish_dimension(t.dim_truck, root, "dim_truck")
    published = store.read_dimension(t.spark, root, "dim_truck")
    merged = scd2.type1_upsert(
        published, t.trucks_next.withColumn("_created_at", F.current_timestamp()),
        "truck_id", "truck_sk")
    store.publish_dimension(merged, root, "dim_truck")
    return store.read_dimension(t.spark, root, "dim_truck")


@query("""SELECT purchase_date, truck_id, count(*) AS purchases, sum(gallons) AS gallons
FROM fact_fuel_purchases GROUP BY 1, 2""")
def gold_clustered_layout(t):
    """Write in the declared layout and read it back."""
    root = t.folder("gold")
    store.publish_fact(t.fact_fuel_purchases, root, "fact_fuel_purchases", BATCH)
    return store.read_table(t.spark, root, "fact_fuel_purchases").groupBy(
        "purchase_date", "truck_id").agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("gallons").alias("gallons"))


def _layout_sql(table: str) -> str:
    layout = registry.LAYOUTS[table]
    first = layout.cluster[0]
    return f"""SELECT '{table}' AS table_name, CAST(date_trunc('month', {layout.partition}) AS DATE) AS month,
  count(*) AS n, count(DISTINCT {first}) AS clustered_values, min({first}) AS least, max({first}) AS greatest
FROM {table} WHERE {layout.partition} BETWEEN DATE '1996-02-01' AND DATE '1997-03-31' GROUP BY 2"""


# Tables with a layout that are made by a join or a grouping here, not by a projection of one table.
_COMPUTED = ("fact_trips", "agg_driver_monthly_performance", "agg_truck_utilization_performance")


@query(" UNION ALL ".join(map(_layout_sql, registry.LAYOUTS)))
def gold_layouts(t):
    """Publish every table that has a layout, read a range of dates back through its file index."""
    root, parts = t.folder("gold"), []
    for name, layout in registry.LAYOUTS.items():
        rows = getattr(t, name)
        if name in _COMPUTED:
            with at_rest(rows.withColumn("_year", F.year(layout.partition)), name, by="_year") as lying:
                store.publish_fact(lying, root, name, BATCH, by="_year")
        else:
            store.publish_fact(rows, root, name, BATCH)
        found = store.read_where(t.spark, root, name, **{
            layout.partition: (datetime.date(1996, 2, 1), datetime.date(1997, 3, 31))})
        first = layout.cluster[0]
        parts.append(found.groupBy(F.trunc(layout.partition, "month").alias("month")).agg(
            F.count(F.lit(1)).alias("n"), F.countDistinct(first).alias("clustered_values"),
            F.min(first).alias("least"), F.max(first).alias("greatest"))
            .select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


_CONTRACT_TABLES = ("fact_trips", *facts.SINGLE_SOURCE)
_ALL_CONTRACTS = (*_CONTRACT_TABLES, *dims.SNAPSHOT_DIMS, "dim_driver")


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{c.name}' AS column_name, count(*) FILTER (WHERE {c.name} IS NULL) AS missing FROM {name}"
    for name in _ALL_CONTRACTS for c in registry.GOLD[name] if not c.nullable and c.name not in _STAMPS))
def gold_contract(t):
    """Nulls in the required columns of every fact, mart and stored dimension."""
    parts = []
    for name in _ALL_CONTRACTS:
        required = [c.name for c in registry.GOLD[name] if not c.nullable and c.name not in _STAMPS]
        counts = getattr(t, name).agg(*casting.missing_required(getattr(t, name), name))
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                     F.col(f"null_{c}").alias("missing")) for c in required]))))
    return reduce(DataFrame.unionByName, parts)


# ====================================================================== B casts
@query(f"""SELECT customer_name, {o.whole('credit_terms_days')} AS terms,
  {o.number('annual_revenue_potential')} AS revenue, {o.whole('annual_revenue_potential')} AS whole_revenue
FROM raw_customers""")
def cast_numeric(t):
    return t.raw_customers.select(
        "customer_name", text.to_long(F.col("credit_terms_days")).alias("terms"),
        text.to_number(F.col("annual_revenue_potential")).alias("revenue"),
        text.to_long(F.col("annual_revenue_potential")).alias("whole_revenue"))


@query(f"SELECT event_id, {o.boolean_of('on_time_flag')} AS on_time_flag FROM raw_delivery_events")
def cast_boolean(t):
    return t.raw_delivery_events.select(
        "event_id", casting.to_boolean(F.col("on_time_flag")).alias("on_time_flag"))


@query(f"""SELECT event_id, {o.timestamp_of('scheduled_datetime')} AS scheduled,
  {o.timestamp_of('actual_datetime')} AS actual FROM raw_delivery_events""")
def cast_timestamp(t):
    return t.raw_delivery_events.select(
        "event_id",
        casting.to_timestamp(F.col("scheduled_datetime"), registry.TIMESTAMP_FORMAT).alias("scheduled"),
        casting.to_timestamp(F.col("actual_datetime"), registry.TIMESTAMP_FORMAT).alias("actual"))


@query(f"SELECT customer_name, {o.date_of('contract_start_date')} AS start FROM raw_customers")
def cast_date(t):
    return t.raw_customers.select(
        "customer_name", casting.to_timestamp(
            F.col("contract_start_date"), registry.DATE_FORMAT).cast("date").alias("start"))


@query(f"""SELECT {o.string_of('customer_name', False)} AS name, {o.string_of('customer_type', False)} AS kept,
  {o.string_of('customer_type', True)} AS nulled, {o.string_of('primary_freight_type', True)} AS freight
FROM raw_customers""")
def clean_string(t):
    return t.raw_customers.select(
        text.clean_string(F.col("customer_name"), False).alias("name"),
        text.clean_string(F.col("customer_type"), False).alias("kept"),
        text.clean_string(F.col("customer_type"), True).alias("nulled"),
        text.clean_string(F.col("primary_freight_type"), True).alias("freight"))


@query(f"SELECT * EXCLUDE (account_status) FROM ({o.typed('raw_customers', 'customers')}) t")
def cast_missing_column(t):
    """A table cast without one of its declared columns."""
    return casting.cast_table(t.raw_customers.drop("account_status"),
                              registry.table("customers").columns)


# =============================================================== C data quality
@query("""SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice,
  count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS _duplicate FROM lineitem""")
def dq_pk_uniqueness(t):
    lines = base(t.spark, t.sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice")
    return quality.mark_duplicates(lines, ["l_orderkey", "l_linenumber"])


def _rules_of(table: str, kind: str) -> list[registry.Rule]:
    return [r for r in registry.rules(table) if r.kind == kind]


def _flags_sql(source: str, key: str, rules: list[registry.Rule]) -> str:
    return f"SELECT {key}, " + ", ".join(
        f"coalesce({o.failure(r)}, FALSE) AS {r.id}" for r in rules) + f" FROM {source}"


def _flags(df: DataFrame, table: str, key: str, rules: list[registry.Rule]) -> DataFrame:
    flagged = quality.with_failure_flags(df, rules, registry.table(table).columns)
    return flagged.select(key, *[F.col(f"_fails_{r.id}").alias(r.id) for r in rules])


@query(_flags_sql("raw_loads", "load_id", _rules_of("loads", "not_null")))
def dq_not_null(t):
    return _flags(t.raw_loads, "loads", "load_id", _rules_of("loads", "not_null"))


@query(_flags_sql("raw_customers", "customer_name", _rules_of("customers", "enum")))
def dq_enum(t):
    return _flags(t.raw_customers, "customers", "customer_name", _rules_of("customers", "enum"))


@query(_flags_sql("raw_trips", "trip_id", _rules_of("trips", "range")))
def dq_range(t):
    return _flags(t.raw_trips, "trips", "trip_id", _rules_of("trips", "range"))


@query(_flags_sql("raw_drivers", "driver_id", _rules_of("drivers", "sql_expression")))
def dq_expression_dates(t):
    return _flags(t.raw_drivers, "drivers", "driver_id", _rules_of("drivers", "sql_expression"))


@query(_flags_sql("raw_delivery_events", "event_id", _rules_of("delivery_events", "sql_expression")))
def dq_expression_present(t):
    return _flags(t.raw_delivery_events, "delivery_events", "event_id",
                  _rules_of("delivery_events", "sql_expression"))


@query(f"SELECT * FROM ({o.annotated('raw_trips', 'trips')}) a")
def dq_first_failure(t):
    return quality.annotate_table(t.raw_trips, "trips")


_WARN = registry.Rule("rev_warn", "range", "Revenue is low", "revenue", min=5000,
                      severity="WARNING")


@query(f"SELECT 'rev_warn' AS rule_id, count(*) FILTER (WHERE {o.failure(_WARN)}) AS failed_rows FROM raw_loads")
def dq_warnings(t):
    """A WARNING rule counts rows and takes none out."""
    return quality.warning_counts(t.raw_loads, [*registry.rules("loads"), _WARN],
                                  registry.table("loads").columns)


@query(f"SELECT trip_id, load_id, driver_id FROM ({o.annotated('raw_trips', 'trips')}) a WHERE _rejection_rule IS NULL")
def dq_valid_rows(t):
    return quality.evaluate_table(t.raw_trips, "trips", BATCH)[0].select(
        "trip_id", "load_id", "driver_id")


@query(f"""SELECT load_id, {o.record_pk(['load_id'])} AS _record_pk, _rejection_rule, _rejection_reason,
  '{BATCH}' AS _batch_id FROM ({o.annotated('raw_loads', 'loads')}) a WHERE _rejection_rule IS NOT NULL""")
def dq_quarantine(t):
    return quality.evaluate_table(t.raw_loads, "loads", BATCH)[1].select(
        "load_id", "_record_pk", "_rejection_rule", "_rejection_reason", "_batch_id")


@query(f"""SELECT driver_id, _rejection_rule FROM ({o.annotated(
    '(SELECT * REPLACE (CAST(NULL AS VARCHAR) AS termination_date) FROM raw_drivers)', 'drivers')}) a""")
def dq_absent_column(t):
    """Rules on a column that is not there, plain or in an expression, are skipped."""
    return quality.annotate_table(t.raw_drivers.drop("termination_date"), "drivers").select(
        "driver_id", "_rejection_rule")


def _dq_metrics(t) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        quality.table_metrics(quality.annotate_table(getattr(t, source), table), table)
        for table, source in o.DQ_TABLES.items()])


@query(o.DQ_RATES)
def dq_metrics(t):
    return _dq_metrics(t)


@query(f"SELECT *, 20.0::DOUBLE AS threshold_pct FROM ({o.DQ_RATES}) r WHERE rejection_rate_pct > 20")
def dq_gate_breaches(t):
    return quality.gate_breaches(_dq_metrics(t))


@query(f"""SELECT sum(total_records)::BIGINT AS total_records, sum(valid_records)::BIGINT AS valid_records,
  sum(quarantined_records)::BIGINT AS quarantined_records,
  sum(valid_records) * 100.0::DOUBLE / sum(total_records) AS dq_score_pct FROM ({o.DQ_METRICS}) m""")
def dq_batch_rollup(t):
    return quality.batch_rollup(_dq_metrics(t))


@query(f"""SELECT 'CRITICAL' AS level, 'DATA QUALITY THRESHOLD BREACH: ' || table_name || ' ({BATCH})' AS subject,
  'Table ''' || table_name || ''' in batch ''{BATCH}'' had a rejection rate of ' || printf('%.2f', rejection_rate_pct)
  || '%, exceeding the maximum allowed threshold of 20.00%.' AS message, '{BATCH}' AS batch_id, table_name,
  total_records, quarantined_records, rejection_rate_pct, 20.0::DOUBLE AS threshold_pct,
  'PIPELINE_HALTED_BEFORE_GOLD' AS action FROM ({o.DQ_RATES}) r WHERE rejection_rate_pct > 20""")
def dq_breach_alerts(t):
    breaches = quality.gate_breaches(_dq_metrics(t)).withColumn("batch_id", F.lit(BATCH))
    return control.breach_alerts(breaches)


_TEXT_TABLES = [t for t in registry.TABLES]


@query(" UNION ALL ".join(f"""
SELECT '{n}' AS table_name, coalesce(_rejection_rule, 'valid') AS outcome, count(*) AS records
FROM ({o.annotated(f'({o.as_text(n)}) x', n)}) a GROUP BY 1, 2""" for n in _TEXT_TABLES))
def dq_all_tables(t):
    """Every declared rule of all 14 tables, counted by outcome."""
    parts = []
    for name in _TEXT_TABLES:
        typed = getattr(t, name)
        as_text = typed.select(*[F.col(c).cast("string").alias(c) for c in _raw_columns(name)])
        parts.append(quality.annotate_table(as_text, name).groupBy(
            F.coalesce("_rejection_rule", F.lit("valid")).alias("outcome")).agg(
            F.count(F.lit(1)).alias("records")).select(
            F.lit(name).alias("table_name"), "outcome", "records"))
    return reduce(DataFrame.unionByName, parts)


def _orphans_sql(table: str) -> str:
    parts = []
    for fk in registry.foreign_keys(table):
        null_test = "IS NOT NULL" if fk.nullable else "IS NOT DISTINCT FROM k"
        keep = f"k {null_test} AND " if fk.nullable else ""
        parts.append(f"""
SELECT '{table}' AS table_name, '{fk.column}' AS fk_column, '{fk.parent_table}' AS parent_table,
  count(*) AS orphan_keys, coalesce(sum(n), 0)::BIGINT AS orphan_rows
FROM (SELECT {fk.column} AS k, count(*) AS n FROM {table} GROUP BY 1) c
WHERE {keep}NOT EXISTS (SELECT 1 FROM {fk.parent_table} p WHERE p.{fk.parent_column} = k)""")
    return " UNION ALL ".join(parts)


_FK_TABLES = [t for t in registry.TABLES if registry.foreign_keys(t)]


@query(" UNION ALL ".join(_orphans_sql(t) for t in _FK_TABLES))
def fk_orphans(t):
    tables = {n: getattr(t, n) for n in registry.TABLES}
    return quality.orphan_counts(tables, _FK_TABLES)


# ================================================================= D dimensions
@query("""SELECT CAST(strftime(full_date, '%Y%m%d') AS BIGINT) AS date_key, full_date,
  isodow(full_date)::BIGINT AS day_of_week, strftime(full_date, '%A') AS day_name,
  day(full_date)::BIGINT AS day_of_month, month(full_date)::BIGINT AS month,
  strftime(full_date, '%B') AS month_name, quarter(full_date)::BIGINT AS quarter, year,
  isodow(full_date) >= 6 AS is_weekend, coalesce(trips, 0) AS trips
FROM calendar_days LEFT JOIN (SELECT dispatch_date, count(*) AS trips FROM trips GROUP BY 1) d
  ON dispatch_date = full_date""")
def dim_calendar(t):
    """Calendar over the years of the trips, with the trips of each day."""
    per_day = t.trips.groupBy("dispatch_date").agg(F.count(F.lit(1)).alias("trips"))
    return dims.calendar_spanning(t.trips, "dispatch_date").join(
        per_day, F.col("full_date") == F.col("dispatch_date"), "left").drop(
        "dispatch_date").withColumn("trips", F.coalesce("trips", F.lit(0)))


def _register_dims():
    for name in dims.SNAPSHOT_DIMS:
        def build(t, name=name):
            return getattr(t, name)
        build.__name__ = name
        query(f"SELECT * FROM {name}")(build)


_register_dims()


@query("SELECT * FROM dim_driver")
def scd2_initial(t):
    return t.dim_driver


@query("SELECT * FROM dim_driver_two")
def scd2_merge(t):
    return t.dim_driver_two


@query("SELECT * FROM dim_driver_three")
def scd2_second_merge(t):
    return t.dim_driver_three


@query("SELECT * FROM dim_driver_three WHERE is_current")
def scd2_current_state(t):
    return scd2.current_rows(t.dim_driver_three)


@query("SELECT * FROM dim_driver_late")
def scd2_late_batch(t):
    """A batch dated inside history splits the versions that hold its date."""
    return t.dim_driver_late


@query("SELECT * FROM dim_driver_early")
def scd2_early_batch(t):
    """A batch dated before the first version of many keys, on top of a late one."""
    return t.dim_driver_early


@query("SELECT * FROM dim_driver_forced")
def scd2_forced_first_batch(t):
    """The first batch again after the others: later versions stay in force."""
    return t.dim_driver_forced


@query(_UPSERT)
def type1_upsert(t):
    return scd2.type1_upsert(t.dim_truck.drop("_created_at"), t.trucks_next, "truck_id", "truck_sk")


# ====================================================================== E facts
def _register_facts():
    for name in _CONTRACT_TABLES:
        def build(t, name=name):
            return getattr(t, name)
        build.__name__ = name
        query(f"SELECT * FROM {name}")(build)


_register_facts()


@query("SELECT * FROM fact_trips")
def fact_trips_bucketed(t):
    """Trips and loads at rest in equal buckets of the load: the join shuffles nothing."""
    buckets = store.buckets_for(t.trips, t.loads, least=8)
    trips, loads = (store.write_bucketed(df, t.folder("buckets"), ["load_id"], buckets) for df in (t.trips, t.loads))
    return facts.fact_trips_bucketed(trips, loads, BATCH)


# ========================================================== F control and audit
def _control_log(t) -> DataFrame:
    return t.batch_control


@query("""SELECT 'batch_' || least(load_date[1:4], '2000') AS batch_id, 'loads' AS table_name,
  count(*) AS records_in_file, 'PENDING' AS status FROM raw_loads GROUP BY 1""")
def control_arrivals(t):
    """Register the batches found in a split as PENDING."""
    root = t.folder("arrivals")
    raw.write_batches(t.raw_loads, "load_date", root, DATA_BATCHES)
    rows = []
    for batch_id, year in DATA_BATCHES:
        manifest = raw.batch_manifest(t.spark, batch_id, year,
                                      {"loads": f"{root}/batch_id={batch_id}"})
        rows.append(control.arrival_rows(t.spark, manifest, root))
    return reduce(DataFrame.unionByName, rows).groupBy("batch_id", "table_name").agg(
        F.sum("records_in_file").alias("records_in_file"), F.first("status").alias("status"))


@query("""SELECT batch_id, arg_max(status, (arrival_time, status)) AS status, max(arrival_time) AS status_time
FROM batch_control GROUP BY 1""")
def control_current_status(t):
    return control.current_status(_control_log(t)).drop("error_message")


@query("""SELECT batch_id, arg_max(status, (arrival_time, status)) AS status FROM (
  SELECT batch_id, arrival_time, status FROM batch_control
  UNION ALL SELECT 'batch_1996', TIMESTAMP '2100-01-01', 'FAILED') c GROUP BY 1
UNION ALL SELECT 'reset_' || batch_id, 'COMPLETED' FROM batch_control WHERE status = 'COMPLETED' GROUP BY batch_id""")
def control_log_written(t):
    """A log written, a status appended, all read back; and a log reset to its completed batches."""
    root, at = t.folder("audit"), datetime.datetime(2100, 1, 1, tzinfo=datetime.timezone.utc)
    store.append(_control_log(t), root, "batch_control")
    store.append(control.status_row(t.spark, "batch_1996", "FAILED", "late", at), root, "batch_control")
    log = store.read_log(t.spark, root, "batch_control", control.BATCH_CONTROL_SCHEMA)
    done = [r["batch_id"] for r in control.completed_batches(log).toLocalIterator()]
    fresh = t.folder("audit-reset")
    control.reset_control(t.spark, fresh, done)
    reset = store.read_log(t.spark, fresh, "batch_control", control.BATCH_CONTROL_SCHEMA)
    return control.current_status(log).select("batch_id", "status").union(
        reset.select(F.concat(F.lit("reset_"), "batch_id"), "status"))


@query("""SELECT DISTINCT 'batch_' || year(o_orderdate) AS batch_id FROM orders
WHERE NOT EXISTS (SELECT 1 FROM batch_control c WHERE c.status = 'COMPLETED'
  AND c.batch_id = 'batch_' || year(o_orderdate))""")
def control_pending(t):
    candidates = t.loads.select(
        F.concat(F.lit("batch_"), F.year("load_date")).alias("batch_id")).distinct()
    return control.pending_batches(candidates, _control_log(t))


@query("""SELECT batch_id, stage, table_name, status,
  round_even(coalesce(records_quarantined * 100.0::DOUBLE / NULLIF(records_in, 0), 0), 2) AS rejection_rate_pct,
  round_even(duration_seconds, 2) AS duration_seconds FROM pipeline_audit""")
def audit_step_rates(t):
    return control.with_step_rate(t.pipeline_audit).select(
        "batch_id", "stage", "table_name", "status", "rejection_rate_pct", "duration_seconds")


_LOAD_COLUMNS = _raw_columns("loads")


@query(f"""SELECT '{BATCH}' AS batch_id, 'loads' AS table_name, load_id AS record_pk, _rejection_rule AS rule_id,
  'DATA_QUALITY_RULE' AS rule_type, _rejection_reason AS rejection_reason,
  '{{' || {" || ',' || ".join(f"'\"{c}\":' || coalesce('\"' || {c} || '\"', 'null')" for c in _LOAD_COLUMNS)} || '}}' AS rejected_payload
FROM ({o.annotated('raw_loads', 'loads')}) a WHERE _rejection_rule IS NOT NULL""")
def audit_rejection_log(t):
    """All rejections, payload as JSON."""
    _, rejected = quality.evaluate_table(t.raw_loads, "loads", BATCH)
    return control.rejection_rows(rejected, "loads").drop("rejected_at")


@query(f"""SELECT '{BATCH}' AS batch_id, *, round_even(valid_records * 100.0::DOUBLE / total_records, 2) AS data_quality_score_pct
FROM ({o.DQ_METRICS}) m""")
def audit_dq_metrics(t):
    counts = _dq_metrics(t).drop("rejection_rate_pct", "dq_score_pct")
    return control.dq_metric_rows(counts, BATCH).drop("evaluated_at")


@query("""SELECT table_name, stage, status, records_in, records_out, duration_seconds FROM pipeline_audit
WHERE batch_id = 'batch_1997' AND stage = 'BRONZE' ORDER BY start_time DESC, table_name""")
def audit_latest_steps(t):
    return control.audit_steps(t.pipeline_audit, "batch_1997", "BRONZE")


@query("""SELECT table_name, total_records, valid_records, quarantined_records, data_quality_score_pct
FROM data_quality_metrics WHERE batch_id = 'batch_1997' ORDER BY evaluated_at DESC, table_name LIMIT 14""")
def audit_latest_metrics(t):
    return control.latest_metrics(t.data_quality_metrics, "batch_1997")


@query("""SELECT table_name, record_pk, rule_id, rejection_reason FROM rejection_log
WHERE batch_id = 'batch_1997' ORDER BY table_name, record_pk, rule_id, rejection_reason LIMIT 5""")
def audit_sample_rejections(t):
    return control.sample_rejections(t.rejection_log, "batch_1997")


@query("""SELECT count(*) AS total_trips, round(sum(total_revenue), 2) AS total_revenue,
  round(sum(actual_distance_miles)::DOUBLE, 0) AS total_miles, round(avg(average_mpg), 2) AS fleet_avg_mpg
FROM fact_trips WHERE batch_id = 'batch_001'""")
def audit_key_measures(t):
    return control.key_measures(t.fact_trips, BATCH)


@query("""SELECT 'ERROR' AS level, 'PIPELINE STAGE FAILED: ' || stage || ' (' || batch_id || ')' AS subject,
  'Batch ''' || batch_id || ''' failed during stage ''' || stage || ''' for table ''' || table_name || ''': ' || error_message AS message,
  batch_id, stage, table_name, error_message AS error FROM pipeline_audit WHERE status = 'FAILED'""")
def alerts_failed_steps(t):
    return control.failure_alerts(t.pipeline_audit)


@query("""SELECT 'INFO' AS level, 'BATCH COMPLETED SUCCESSFULLY: ' || batch_id AS subject,
  'Batch ''' || batch_id || ''' processed through Medallion architecture in ' || printf('%.2f', sum(duration_seconds)) || 's.' AS message,
  batch_id, count(*) FILTER (WHERE stage = 'GOLD') AS total_tables,
  sum(records_out) FILTER (WHERE stage = 'GOLD')::BIGINT AS total_rows_published
FROM (SELECT * FROM pipeline_audit QUALIFY row_number() OVER (PARTITION BY batch_id, stage, table_name
        ORDER BY end_time DESC, start_time DESC, status DESC) = 1) last GROUP BY batch_id
HAVING count(*) FILTER (WHERE stage = 'GOLD') > 0
   AND count(*) FILTER (WHERE stage = 'GOLD' AND status <> 'COMPLETED') = 0""")
def alerts_completed_batches(t):
    return control.completion_alerts(t.pipeline_audit)


# ====================================================================== G views
@query(f"""SELECT f.* EXCLUDE (customer_id, driver_id, truck_id, trailer_id, route_id),
  c.customer_id, c.customer_name, c.customer_type, c.primary_freight_type, c.account_status AS customer_account_status,
  d.driver_id, d.full_name AS driver_name, d.home_terminal AS driver_home_terminal,
  d.employment_status AS driver_status, d.years_experience AS driver_years_experience,
  k.truck_id, k.unit_number AS truck_unit_number, k.make AS truck_make, k.model_year AS truck_model_year, k.fuel_type,
  x.trailer_id, x.trailer_type, x.length_feet AS trailer_length_feet,
  r.route_id, r.origin_city, r.origin_state, r.destination_city, r.destination_state,
  r.origin_city || ', ' || r.origin_state || ' -> ' || r.destination_city || ', ' || r.destination_state AS route_lane_name,
  r.typical_distance_miles, r.base_rate_per_mile, r.typical_transit_days,
  {o.ratio('f.total_revenue', 'f.actual_distance_miles')} AS revenue_per_mile,
  {o.ratio('f.fuel_gallons_used', 'f.actual_distance_miles')} AS fuel_gallons_per_mile,
  {o.ratio('f.actual_distance_miles', 'f.actual_duration_hours')} AS average_speed_mph,
  f.actual_distance_miles - r.typical_distance_miles AS route_variance_miles
FROM fact_trips f
LEFT JOIN dim_customer c ON c.customer_id = f.customer_id
LEFT JOIN (SELECT * FROM dim_driver_two WHERE is_current) d ON d.driver_id = f.driver_id
LEFT JOIN dim_truck k ON k.truck_id = f.truck_id
LEFT JOIN dim_trailer x ON x.trailer_id = f.trailer_id
LEFT JOIN dim_route r ON r.route_id = f.route_id""")
def view_trip_details(t):
    return views.trip_details(t.fact_trips, t.dim_customer, t.dim_driver_two, t.dim_truck,
                              t.dim_trailer, t.dim_route)


@query(f"""SELECT *, {o.ratio('estimated_operating_margin', 'total_revenue')} AS operating_margin_pct,
  {o.ratio('total_operating_cost', 'total_miles')} AS cost_per_mile
FROM (SELECT *, total_fuel_cost + total_maintenance_cost AS total_operating_cost,
    total_revenue - (total_fuel_cost + total_maintenance_cost) AS estimated_operating_margin
  FROM (SELECT u.truck_id, u.month, u.trips_completed, u.total_miles, u.total_revenue, u.average_mpg, u.utilization_rate,
      k.unit_number, k.make, k.model_year, k.status AS truck_status, k.home_terminal,
      coalesce(s.events, u.maintenance_events, 0) AS maintenance_event_count,
      coalesce(s.cost, u.maintenance_cost, 0) AS total_maintenance_cost,
      coalesce(s.downtime, u.downtime_hours, 0) AS total_downtime_hours,
      coalesce(s.labor, 0) AS total_labor_cost, coalesce(s.parts, 0) AS total_parts_cost,
      coalesce(g.gallons, 0) AS total_fuel_gallons, coalesce(g.cost, 0) AS total_fuel_cost,
      {o.ratio0('g.cost', 'g.gallons')} AS avg_fuel_price_per_gallon
    FROM agg_truck_utilization_performance u
    LEFT JOIN dim_truck k ON k.truck_id = u.truck_id
    LEFT JOIN (SELECT truck_id, CAST(date_trunc('month', purchase_date) AS DATE) AS m, sum(gallons) AS gallons,
        sum(total_cost) AS cost FROM fact_fuel_purchases GROUP BY 1, 2) g ON g.truck_id = u.truck_id AND g.m = u.month
    LEFT JOIN (SELECT truck_id, CAST(date_trunc('month', maintenance_date) AS DATE) AS m,
        count(DISTINCT maintenance_id) AS events, sum(labor_cost) AS labor, sum(parts_cost) AS parts,
        sum(total_cost) AS cost, sum(downtime_hours) AS downtime FROM fact_maintenance GROUP BY 1, 2) s
      ON s.truck_id = u.truck_id AND s.m = u.month) p) q""")
def view_monthly_fleet_metrics(t):
    return views.monthly_fleet_metrics(t.agg_truck_utilization_performance, t.dim_truck,
                                       t.fact_fuel_purchases, t.fact_maintenance)


@query(f"""SELECT p.* EXCLUDE (batch_id), d.full_name AS driver_name, d.home_terminal, d.cdl_class,
  d.years_experience, d.employment_status, coalesce(s.n, 0) AS total_incidents,
  coalesce(s.prev, 0) AS preventable_incidents, coalesce(s.fault, 0) AS at_fault_incidents,
  coalesce(s.inj, 0) AS injury_incidents, coalesce(s.damage, 0) AS total_damage_cost,
  coalesce(s.claims, 0) AS total_claim_amount,
  {o.ratio('coalesce(s.n, 0) * 100000', 'p.total_miles')} AS incidents_per_100k_miles,
  {o.ratio('p.total_revenue', 'p.trips_completed')} AS avg_revenue_per_trip,
  {o.ratio('p.total_revenue', 'p.total_miles')} AS revenue_per_mile
FROM agg_driver_monthly_performance p
LEFT JOIN (SELECT * FROM dim_driver_two WHERE is_current) d ON d.driver_id = p.driver_id
LEFT JOIN (SELECT driver_id, CAST(date_trunc('month', incident_date) AS DATE) AS m, count(*) AS n,
    count(*) FILTER (WHERE preventable_flag) AS prev, count(*) FILTER (WHERE at_fault_flag) AS fault,
    count(*) FILTER (WHERE injury_flag) AS inj, sum(vehicle_damage_cost + cargo_damage_cost) AS damage,
    sum(claim_amount) AS claims FROM fact_safety_incidents GROUP BY 1, 2) s
  ON s.driver_id = p.driver_id AND s.m = p.month""")
def view_driver_scorecard(t):
    return views.driver_scorecard(t.agg_driver_monthly_performance, t.dim_driver_two,
                                  t.fact_safety_incidents)


def _route_sql(trips: str) -> str:
    return f"""SELECT r.route_id, r.origin_city, r.origin_state, r.destination_city, r.destination_state,
  r.origin_city || ', ' || r.origin_state || ' -> ' || r.destination_city || ', ' || r.destination_state AS route_lane,
  r.typical_distance_miles, r.base_rate_per_mile, r.typical_transit_days, count(t.trip_id) AS total_trips_run,
  sum(t.actual_distance_miles)::BIGINT AS total_miles_driven, sum(t.weight_lbs)::BIGINT AS total_weight_carried_lbs,
  sum(t.freight_revenue) AS total_freight_revenue, sum(t.fuel_surcharge) AS total_fuel_surcharge,
  sum(t.total_revenue) AS total_revenue_generated, avg(t.actual_distance_miles) AS avg_actual_miles,
  avg(t.actual_duration_hours) AS avg_actual_duration_hours, avg(t.average_mpg) AS avg_lane_mpg,
  avg(t.idle_time_hours) AS avg_idle_hours_per_trip,
  {o.ratio('sum(t.total_revenue)', 'sum(t.actual_distance_miles)')} AS lane_revenue_per_mile,
  {o.ratio('sum(t.total_revenue)', 'count(t.trip_id)')} AS avg_revenue_per_trip,
  avg(t.actual_distance_miles) - r.typical_distance_miles AS avg_lane_mileage_variance
FROM dim_route r LEFT JOIN {trips} t ON t.route_id = r.route_id GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9"""


@query(_route_sql("fact_trips"))
def view_route_profitability(t):
    return views.route_profitability(t.dim_route, t.fact_trips)


@query("""SELECT f.facility_id, f.facility_name, f.facility_type, f.city, f.state, f.dock_doors, f.latitude,
  f.longitude, CAST(date_trunc('month', e.event_date) AS DATE) AS month, count(e.event_id) AS total_events,
  count(*) FILTER (WHERE e.event_type = 'Pickup') AS pickup_events,
  count(*) FILTER (WHERE e.event_type = 'Delivery') AS delivery_events,
  count(*) FILTER (WHERE e.on_time_flag) AS on_time_events,
  count(*) FILTER (WHERE NOT e.on_time_flag) AS delayed_events,
  count(*) FILTER (WHERE e.on_time_flag)::DOUBLE / NULLIF(count(e.event_id), 0) * 100 AS on_time_percentage,
  sum(e.detention_minutes)::BIGINT AS total_detention_minutes,
  avg(e.detention_minutes) AS avg_detention_minutes_per_visit,
  count(*) FILTER (WHERE e.detention_minutes > 120) AS severe_detention_count
FROM dim_facility f LEFT JOIN fact_delivery_events e ON e.facility_id = f.facility_id GROUP BY ALL""")
def view_facility_turnaround(t):
    return views.facility_turnaround(t.dim_facility, t.fact_delivery_events)


@query("""SELECT batch_id, stage, status, count(DISTINCT table_name) AS tables_processed_count,
  sum(records_in)::BIGINT AS total_records_in, sum(records_out)::BIGINT AS total_records_out,
  sum(records_quarantined)::BIGINT AS total_records_quarantined,
  sum(records_quarantined)::DOUBLE / NULLIF(sum(records_in), 0) * 100 AS stage_rejection_rate_pct,
  min(start_time) AS stage_start_time, max(end_time) AS stage_end_time,
  round(sum(duration_seconds), 2) AS total_duration_seconds,
  round(sum(duration_seconds) / 60, 2) AS total_duration_minutes FROM pipeline_audit GROUP BY 1, 2, 3""")
def view_pipeline_run_summary(t):
    return views.pipeline_run_summary(t.pipeline_audit)


@query("""SELECT batch_id, table_name, total_records, valid_records, quarantined_records, data_quality_score_pct,
  quarantined_records::DOUBLE / NULLIF(total_records, 0) * 100 AS rejection_rate_pct, evaluated_at,
  CASE WHEN data_quality_score_pct >= 99 THEN 'EXCELLENT' WHEN data_quality_score_pct >= 95 THEN 'GOOD'
    WHEN data_quality_score_pct >= 80 THEN 'ACCEPTABLE' ELSE 'CRITICAL_BREACH' END AS dq_health_category
FROM data_quality_metrics""")
def view_table_dq_history(t):
    return views.table_dq_history(t.data_quality_metrics)


@query("""SELECT batch_id, table_name, rule_id, rule_type, rejection_reason, count(*) AS rejection_count,
  min(rejected_at) AS first_detected_at, max(rejected_at) AS last_detected_at FROM rejection_log GROUP BY ALL""")
def view_quarantine_deep_dive(t):
    return views.quarantine_deep_dive(t.rejection_log)


def _clean(table: str) -> str:
    return o.typed(f"({o.annotated(f'raw_{table}', table)}) a WHERE _rejection_rule IS NULL", table)


@query(_route_sql("clean_trips"), tables={"clean_trips": f"""
SELECT x.trip_id, l.route_id, x.actual_distance_miles, l.weight_lbs, coalesce(l.revenue, 0) AS freight_revenue,
  coalesce(l.fuel_surcharge, 0) AS fuel_surcharge,
  coalesce(l.revenue, 0) + coalesce(l.fuel_surcharge, 0) + coalesce(l.accessorial_charges, 0) AS total_revenue,
  x.actual_duration_hours, x.average_mpg, x.idle_time_hours
FROM ({_clean('trips')}) x JOIN ({_clean('loads')}) l ON x.load_id = l.load_id"""})
def medallion_route_profitability(t):
    """Raw text to quality checks, Silver tables, the trip fact and the lane report.

    Silver is written, as in the pipeline: each check runs once and sizes are known.
    """
    clean = {}
    for name in ("trips", "loads"):
        valid, _ = quality.evaluate_table(getattr(t, f"raw_{name}"), name, BATCH)
        clean[name] = materialised(
            casting.cast_table(valid, registry.table(name).columns), f"silver-{name}")
    fact = facts.fact_trips(clean["trips"], clean["loads"], BATCH)
    return views.route_profitability(t.dim_route, fact)


# =================================================================== H measures
def _facts(t, names: list[str]) -> dict[str, DataFrame]:
    used = {measures.MEASURES[b].fact for b in measures.base_measures(names)}
    return {f: getattr(t, f) for f in used}


_BASE_SQL = {
    measures.TRIPS: ("dispatch_date", {
        "total_revenue": "sum(total_revenue)", "freight_revenue": "sum(freight_revenue)",
        "fuel_surcharge_revenue": "sum(fuel_surcharge)",
        "accessorial_revenue": "sum(accessorial_charges)::BIGINT", "total_trips": "count(*)",
        "total_miles_driven": "sum(actual_distance_miles)::BIGINT",
        "average_trip_distance": "avg(actual_distance_miles)",
        "average_trip_duration": "avg(actual_duration_hours)",
        "trip_hours": "sum(actual_duration_hours)", "trip_gallons": "sum(fuel_gallons_used)",
        "active_truck_count": "count(DISTINCT truck_id) + max((truck_id IS NULL)::BIGINT)",
        "active_driver_count": "count(DISTINCT driver_id) + max((driver_id IS NULL)::BIGINT)"}),
    measures.FUEL: ("purchase_date", {
        "total_fuel_expense": "sum(total_cost)", "total_fuel_gallons": "sum(gallons)"}),
    measures.MAINTENANCE: ("maintenance_date", {
        "total_maintenance_expense": "sum(total_cost)",
        "maintenance_downtime_hours": "sum(downtime_hours)", "maintenance_events": "count(*)"}),
    measures.EVENTS: ("event_date", {
        "total_delivery_events": "count(*)",
        "on_time_deliveries": "count(*) FILTER (WHERE on_time_flag)",
        "delayed_deliveries": "count(*) FILTER (WHERE NOT coalesce(on_time_flag, FALSE))",
        "total_detention_minutes": "sum(detention_minutes)::BIGINT",
        "average_detention_per_stop": "avg(detention_minutes)",
        "severe_detention_incidents": "count(*) FILTER (WHERE detention_minutes > 120)"}),
    measures.SAFETY: ("incident_date", {
        "total_safety_incidents": "count(*)",
        "preventable_incidents": "count(*) FILTER (WHERE preventable_flag)",
        "at_fault_incidents": "count(*) FILTER (WHERE at_fault_flag)",
        "vehicle_damage": "sum(vehicle_damage_cost)", "cargo_damage": "sum(cargo_damage_cost)",
        "claims": "sum(claim_amount)"}),
    measures.UTILIZATION: ("month", {"fleet_utilization_pct": "avg(utilization_rate)"}),
    measures.AUDIT: ("", {
        "records_ingested": "sum(records_in)::BIGINT", "records_validated": "sum(records_out)::BIGINT",
        "records_quarantined": "sum(records_quarantined)::BIGINT",
        "pipeline_seconds": "sum(duration_seconds)"}),
    measures.METRICS: ("", {"overall_dq_score": "avg(data_quality_score_pct)"}),
}
_COST = "(coalesce(total_fuel_expense, 0) + coalesce(total_maintenance_expense, 0))"
_DERIVED_SQL = {
    "total_operating_cost": _COST,
    "operating_margin": f"coalesce(total_revenue, 0) - {_COST}",
    "operating_margin_pct": o.ratio0(f"(coalesce(total_revenue, 0) - {_COST})", "total_revenue"),
    "revenue_per_mile": o.ratio0("total_revenue", "total_miles_driven"),
    "cost_per_mile": o.ratio0(_COST, "total_miles_driven"),
    "net_margin_per_mile": f"{o.ratio0('total_revenue', 'total_miles_driven')} - {o.ratio0(_COST, 'total_miles_driven')}",
    "average_revenue_per_trip": o.ratio0("total_revenue", "total_trips"),
    "average_transit_speed": o.ratio0("total_miles_driven", "trip_hours"),
    "fleet_mpg": o.ratio0("total_miles_driven", "trip_gallons"),
    "average_fuel_price": o.ratio0("total_fuel_expense", "total_fuel_gallons"),
    "on_time_delivery_rate": o.ratio0("on_time_deliveries", "total_delivery_events"),
    "preventable_incident_rate": o.ratio0("preventable_incidents", "total_safety_incidents"),
    "incidents_per_100k_miles": o.ratio0("total_safety_incidents * 100000", "total_miles_driven"),
    "total_damage_and_claim_cost":
        "coalesce(vehicle_damage, 0) + coalesce(cargo_damage, 0) + coalesce(claims, 0)",
    "rejection_rate": o.ratio0("records_quarantined", "records_ingested"),
    "pipeline_duration_minutes": "coalesce(pipeline_seconds / 60, 0)",
}


def _measure_sql(names, key_of: Callable[[str], str], key: str, from_of=lambda fact: fact) -> str:
    """Each fact grouped on its own, then put side by side by a full join on the key."""
    used = dict.fromkeys(measures.MEASURES[b].fact for b in measures.base_measures(list(names)))
    joined, first = "", True
    for i, fact in enumerate(used):
        aggregates = ", ".join(f"{s} AS {n}" for n, s in _BASE_SQL[fact][1].items())
        part = f"(SELECT {key_of(fact)} AS {key}, {aggregates} FROM {from_of(fact)} GROUP BY 1) f{i}"
        joined += part if first else (
            f"\nFULL JOIN {part} ON f{i}.{key} IS NOT DISTINCT FROM "
            + (f"f0.{key}" if i == 1 else f"coalesce({', '.join(f'f{j}.{key}' for j in range(i))})"))
        first = False
    merged = f"coalesce({', '.join(f'f{i}.{key}' for i in range(len(used)))})" if len(used) > 1 else f"f0.{key}"
    columns = ", ".join(f"{_DERIVED_SQL.get(n, n)} AS {n}" for n in names)
    return f"SELECT {merged} AS {key}, {columns} FROM {joined}"


def _measure_digits(names) -> dict[int, tuple[str, ...]]:
    """Averages of rates are not exact sums; everything else compares as is."""
    return {9: tuple(n for n in names if n in ("fleet_utilization_pct", "overall_dq_score"))}


def _register_measures():
    for folder in ("financial", "fleet", "service", "safety"):
        names = list(measures.FOLDERS[folder])
        sql = _measure_sql(names, lambda f: f"year({_BASE_SQL[f][0]})::BIGINT", "year")

        def build(t, names=names):
            return measures.evaluate(names, _facts(t, names), Context(periods={"year": PERIODS["year"]}))
        build.__name__ = f"measures_{folder}_by_year"
        query(sql, _measure_digits(names))(build)


_register_measures()
_GOVERNANCE = list(measures.FOLDERS["governance"])


@query(_measure_sql(_GOVERNANCE, lambda f: "batch_id", "batch_id"), _measure_digits(_GOVERNANCE))
def measures_governance_by_batch(t):
    return measures.evaluate(_GOVERNANCE, _facts(t, _GOVERNANCE), Context(columns=("batch_id",)))


_BY_MAKE = ["total_revenue", "total_fuel_expense", "total_maintenance_expense",
            "total_operating_cost", "operating_margin_pct", "cost_per_mile", "total_trips"]


@query(_measure_sql(_BY_MAKE, lambda f: "make", "make",
                    lambda f: f"{f} LEFT JOIN dim_truck USING (truck_id)"), _measure_digits(_BY_MAKE))
def measures_by_truck_make(t):
    """Measures of three facts sliced by an attribute of a shared dimension."""
    return measures.evaluate(_BY_MAKE, _facts(t, _BY_MAKE),
                             Context(attributes={"make": ("dim_truck", "make")}),
                             {"dim_truck": t.dim_truck})


_BY_CUSTOMER = ["total_revenue", "total_trips", "revenue_per_mile", "active_truck_count"]


@query(f"""SELECT c.customer_type, CAST(date_trunc('month', f.dispatch_date) AS DATE) AS month,
  sum(f.total_revenue) AS total_revenue, count(*) AS total_trips,
  {o.ratio0('sum(f.total_revenue)', 'sum(f.actual_distance_miles)')} AS revenue_per_mile,
  count(DISTINCT f.truck_id) + max((f.truck_id IS NULL)::BIGINT) AS active_truck_count
FROM fact_trips f LEFT JOIN dim_customer c ON c.customer_id = f.customer_id GROUP BY 1, 2""",
       _measure_digits(_BY_CUSTOMER))
def measures_by_customer_type_and_month(t):
    return measures.evaluate(
        _BY_CUSTOMER, _facts(t, _BY_CUSTOMER),
        Context(periods={"month": PERIODS["month"]},
                attributes={"customer_type": ("dim_customer", "customer_type")}),
        {"dim_customer": t.dim_customer})


_BY_STATUS = ["total_revenue", "total_trips", "revenue_per_mile"]
_STATUS_SQL = f"""SELECT d.employment_status AS driver_status, sum(f.total_revenue) AS total_revenue, count(*) AS total_trips,
  {o.ratio0('sum(f.total_revenue)', 'sum(f.actual_distance_miles)')} AS revenue_per_mile
FROM fact_trips f LEFT JOIN {{join}} GROUP BY 1"""


def _by_status(t, at_event):
    return measures.evaluate(_BY_STATUS, _facts(t, _BY_STATUS), Context(
        attributes={"driver_status": ("dim_driver", "employment_status")},
        at_event=frozenset({"driver_status"} if at_event else ())), {"dim_driver": t.dim_driver_three})


@query(_STATUS_SQL.replace("{join}", "(SELECT * FROM dim_driver_three WHERE is_current) d ON d.driver_id = f.driver_id"),
       _measure_digits(_BY_STATUS))
def measures_by_driver_status_current(t):
    """Sliced by a dimension with history, as it is now: each trip counts once."""
    return _by_status(t, False)


@query(_STATUS_SQL.replace("{join}", """dim_driver_three d ON d.driver_id = f.driver_id AND f.dispatch_date >= d.valid_from
  AND (d.valid_to IS NULL OR f.dispatch_date < d.valid_to)"""), _measure_digits(_BY_STATUS))
def measures_by_driver_status_at_event(t):
    """Sliced by the version that was valid on the day of the trip."""
    return _by_status(t, True)


_ACTIVE = ["active_truck_count", "active_driver_count"]
_ACTIVE_SQL = """count(DISTINCT truck_id) + coalesce(max((truck_id IS NULL)::BIGINT), 0) AS active_truck_count,
  count(DISTINCT driver_id) + coalesce(max((driver_id IS NULL)::BIGINT), 0) AS active_driver_count FROM fact_trips"""


@query(" UNION ALL ".join(f"SELECT '{level}' AS level, {period} AS period, {_ACTIVE_SQL} GROUP BY 2" for level, period in (
    ("day", "dispatch_date"), ("month", "CAST(date_trunc('month', dispatch_date) AS DATE)"),
    ("year", "CAST(date_trunc('year', dispatch_date) AS DATE)"), ("total", "CAST(NULL AS DATE)"))))
def measures_distinct_rollup(t):
    """Distinct trucks and drivers by day, month, year and in total from one stored table."""
    return lattice.distinct_rollup(t.fact_trips, {"dim_truck": t.dim_truck, "dim_driver": t.dim_driver_two}, _ACTIVE)


_LATTICE = ["total_revenue", "total_trips", "average_trip_distance", "active_truck_count", "total_fuel_expense",
            "average_fuel_price", "revenue_per_mile"]
_LATTICE_CONTEXTS = {
    "make": Context(attributes={"make": ("dim_truck", "make")}),
    "make_year": Context(periods={"year": PERIODS["year"]}, attributes={"make": ("dim_truck", "make")}),
    "status_month": Context(periods={"month": PERIODS["month"]},
                            attributes={"status": ("dim_driver", "employment_status")}),
    "year": Context(periods={"year": PERIODS["year"]}),
    "all": Context(),
}
_LATTICE_KEYS = {"make": ("make", "NULL", "NULL"), "make_year": ("make", "NULL", "year({d})"),
                 "status_month": ("NULL", "employment_status", "month"), "year": ("NULL", "NULL", "year({d})"),
                 "all": ("NULL", "NULL", "NULL")}


def _lattice_sql(name: str) -> str:
    make, status, when = _LATTICE_KEYS[name]
    day = {"fact_trips": "dispatch_date", "fact_fuel_purchases": "purchase_date"}

    def keys(fact):
        year = when.format(d=day[fact]) if when.startswith("year") else "NULL"
        month = f"date_trunc('month', {day[fact]})" if when == "month" else "NULL"
        return (f"CAST({make} AS VARCHAR) AS make, CAST({status} AS VARCHAR) AS status, CAST({year} AS BIGINT) AS year, "
                f"CAST({month} AS DATE) AS month")

    def source(fact):
        return (f"{fact} LEFT JOIN dim_truck USING (truck_id) LEFT JOIN "
                "(SELECT driver_id, employment_status FROM dim_driver_two WHERE is_current) USING (driver_id)")

    return f"""SELECT '{name}' AS context, make, status, year, month, max(total_revenue) AS total_revenue,
  max(total_trips) AS total_trips, max(average_trip_distance) AS average_trip_distance,
  max(active_truck_count) AS active_truck_count, max(total_fuel_expense) AS total_fuel_expense,
  {o.ratio0('max(total_fuel_expense)', 'max(gallons)')} AS average_fuel_price,
  {o.ratio0('max(total_revenue)', 'max(miles)')} AS revenue_per_mile FROM (
SELECT {keys('fact_trips')}, sum(total_revenue) AS total_revenue, count(*) AS total_trips,
  avg(actual_distance_miles) AS average_trip_distance, sum(actual_distance_miles) AS miles,
  count(DISTINCT truck_id) + max((truck_id IS NULL)::BIGINT) AS active_truck_count,
  NULL AS total_fuel_expense, NULL AS gallons FROM {source('fact_trips')} GROUP BY 1, 2, 3, 4
UNION ALL
SELECT {keys('fact_fuel_purchases')}, NULL, NULL, NULL, NULL, NULL, sum(total_cost), sum(gallons)
FROM {source('fact_fuel_purchases')} GROUP BY 1, 2, 3, 4) GROUP BY 2, 3, 4, 5"""


@query(" UNION ALL ".join(map(_lattice_sql, _LATTICE_CONTEXTS)), _measure_digits(_LATTICE))
def measures_lattice(t):
    """Five groupings of measures of two facts; each fact is scanned once."""
    found = lattice.evaluate_many(
        _LATTICE, _facts(t, _LATTICE), _LATTICE_CONTEXTS,
        {"dim_truck": t.dim_truck, "dim_driver": t.dim_driver_two}, {measures.TRIPS: t.trips})
    empty = {"make": "string", "status": "string", "year": "long", "month": "date"}
    return reduce(DataFrame.unionByName, [
        df.withColumns({k: F.lit(None).cast(kind) for k, kind in empty.items() if k not in df.columns})
        .select(F.lit(name).alias("context"), *empty, *_LATTICE) for name, df in found.items()])


_TOTALS = [n for f in ("financial", "fleet", "service", "safety") for n in measures.FOLDERS[f]]


@query(f"SELECT {', '.join(f'{_DERIVED_SQL.get(n, n)} AS {n}' for n in _TOTALS)} FROM " + ", ".join(
    f"(SELECT {', '.join(f'{s} AS {n}' for n, s in _BASE_SQL[f][1].items())} FROM {f}) m{i}"
    for i, f in enumerate((measures.TRIPS, measures.FUEL, measures.MAINTENANCE, measures.EVENTS,
                           measures.SAFETY, measures.UTILIZATION))), _measure_digits(_TOTALS))
def measures_grand_total(t):
    return measures.evaluate(_TOTALS, _facts(t, _TOTALS))


_DAILY = "(SELECT dispatch_date AS d, sum(total_revenue) AS revenue FROM fact_trips GROUP BY 1)"
_MONTHS = "(SELECT DISTINCT CAST(date_trunc('month', full_date) AS DATE) AS month FROM calendar_days)"
_MONTHLY = ("(SELECT CAST(date_trunc('month', dispatch_date) AS DATE) AS d, sum(total_revenue) AS revenue "
            "FROM fact_trips GROUP BY 1)")


def _growth(before: str, name: str, growth: str) -> str:
    change = f"(coalesce(c.revenue, 0) - coalesce({before}.revenue, 0))"
    return f"{before}.revenue AS {name}, {o.ratio0(change, before + '.revenue')} AS {growth}"


def _trip_calendar(t) -> DataFrame:
    return dims.calendar_spanning(t.fact_trips, "dispatch_date")


@query(f"""SELECT full_date, year, c.revenue,
  sum(c.revenue) OVER (PARTITION BY year ORDER BY full_date ROWS UNBOUNDED PRECEDING) AS revenue_ytd
FROM calendar_days LEFT JOIN {_DAILY} c ON c.d = full_date""")
def revenue_ytd(t):
    return timeintel.year_to_date(_trip_calendar(t), t.fact_trips)


@query(f"""SELECT full_date, c.revenue, {_growth('b', 'revenue_prior_year', 'yoy_growth_pct')}
FROM calendar_days LEFT JOIN {_DAILY} c ON c.d = full_date
LEFT JOIN {_DAILY} b ON b.d = CAST(full_date - INTERVAL 1 YEAR AS DATE)""")
def revenue_prior_year(t):
    return timeintel.prior_year(_trip_calendar(t), t.fact_trips)


@query(f"""SELECT month, c.revenue, {_growth('b', 'revenue_prior_year', 'yoy_growth_pct')}
FROM {_MONTHS} m LEFT JOIN {_MONTHLY} c ON c.d = month
LEFT JOIN {_MONTHLY} b ON b.d = CAST(month - INTERVAL 1 YEAR AS DATE)""")
def revenue_prior_year_monthly(t):
    return timeintel.prior_year_monthly(_trip_calendar(t), t.fact_trips)


@query(f"""SELECT month, c.revenue, {_growth('b', 'revenue_previous_month', 'mom_growth_pct')}
FROM {_MONTHS} m LEFT JOIN {_MONTHLY} c ON c.d = month
LEFT JOIN {_MONTHLY} b ON b.d = CAST(month - INTERVAL 1 MONTH AS DATE)""")
def revenue_previous_month(t):
    return timeintel.previous_month(_trip_calendar(t), t.fact_trips)


_COMPARED = {2: ("total_revenue", "total_revenue_before"), 6: ("total_revenue_growth_pct",)}


def _compared_sql(key: str, join: str, months: int) -> str:
    totals = f"""(SELECT {key} AS k, CAST(date_trunc('month', dispatch_date) AS DATE) AS month, sum(total_revenue) AS v
  FROM fact_trips f {join} GROUP BY 1, 2)"""
    before = f"(SELECT k, CAST(month + INTERVAL {months} MONTH AS DATE) AS month, v FROM {totals} x)"
    change = "(coalesce(c.v, 0) - coalesce(b.v, 0))"
    return f"""SELECT coalesce(c.k, b.k) AS {key.split('.')[-1]}, coalesce(c.month, b.month) AS month, c.v AS total_revenue,
  b.v AS total_revenue_before, {o.ratio0(change, 'b.v')} AS total_revenue_growth_pct
FROM {totals} c FULL JOIN {before} b ON c.k IS NOT DISTINCT FROM b.k AND c.month = b.month"""


@query(_compared_sql("d.make", "LEFT JOIN dim_truck d USING (truck_id)", 12), _COMPARED)
def revenue_prior_year_by_truck_make(t):
    return timeintel.compared("total_revenue", {measures.TRIPS: t.fact_trips}, Context(
        attributes={"make": ("dim_truck", "make")}), {"dim_truck": t.dim_truck}, 12)


@query(_compared_sql("f.driver_id", "", 1), _COMPARED)
def revenue_previous_month_by_driver(t):
    return timeintel.compared("total_revenue", {measures.TRIPS: t.fact_trips}, Context(columns=("driver_id",)))


@query("""SELECT *, sum(total_revenue) OVER (PARTITION BY customer_type, year(date) ORDER BY date) AS total_revenue_ytd
FROM (SELECT c.customer_type, f.dispatch_date AS date, sum(f.total_revenue) AS total_revenue
  FROM fact_trips f LEFT JOIN dim_customer c ON c.customer_id = f.customer_id GROUP BY 1, 2) d""", {2: ("total_revenue", "total_revenue_ytd")})
def revenue_ytd_by_customer_type(t):
    return timeintel.year_to_date_in("total_revenue", {measures.TRIPS: t.fact_trips}, Context(
        attributes={"customer_type": ("dim_customer", "customer_type")}), {"dim_customer": t.dim_customer})


@query(f"""SELECT make, date, {o.ratio0('miles', 'gallons')} AS fleet_mpg,
  {o.ratio0('sum(miles) OVER w', 'sum(gallons) OVER w')} AS fleet_mpg_ytd
FROM (SELECT d.make, f.dispatch_date AS date, sum(f.actual_distance_miles) AS miles, sum(f.fuel_gallons_used) AS gallons
  FROM fact_trips f LEFT JOIN dim_truck d ON d.truck_id = f.truck_id GROUP BY 1, 2) d
WINDOW w AS (PARTITION BY make, year(date) ORDER BY date)""", {6: ("fleet_mpg", "fleet_mpg_ytd")})
def fleet_mpg_ytd_by_truck_make(t):
    """The ratio of running sums, not a sum of ratios."""
    return timeintel.year_to_date_in("fleet_mpg", {measures.TRIPS: t.fact_trips}, Context(
        attributes={"make": ("dim_truck", "make")}), {"dim_truck": t.dim_truck})


@query("""SELECT CAST(date_trunc('month', load_date) AS DATE) AS month, sum(total_revenue) AS total_revenue
FROM fact_trips GROUP BY 1""")
def revenue_by_load_date(t):
    return measures.revenue_by_load_date(t.fact_trips)


@query("""SELECT f.trip_id, f.load_id, f.driver_id, f.dispatch_date, d.full_name AS driver_name,
  d.employment_status AS driver_status, d.driver_sk
FROM fact_trips f LEFT JOIN dim_driver_three d ON d.driver_id = f.driver_id AND f.dispatch_date >= d.valid_from
  AND (d.valid_to IS NULL OR f.dispatch_date < d.valid_to)""")
def driver_at_event(t):
    trips = t.fact_trips.select("trip_id", "load_id", "driver_id", "dispatch_date")
    return scd2.version_at(trips, t.dim_driver_three, "driver_id", "dispatch_date", {
        "driver_name": "full_name", "driver_status": "employment_status", "driver_sk": "driver_sk"})


@query("""SELECT f.trip_id, f.truck_id, f.dispatch_date, v.version, v.odometer FROM fact_trips f ASOF LEFT JOIN (
  SELECT 'TRK-' || CAST(l_partkey % 7 AS VARCHAR) AS truck_id, CAST(l_shipdate AS DATE) AS valid_from,
    count(*) AS version, max(l_orderkey) AS odometer FROM lineitem GROUP BY 1, 2) v
ON 'TRK-' || CAST(CAST(f.truck_id[5:] AS BIGINT) % 7 AS VARCHAR) = v.truck_id AND f.dispatch_date >= v.valid_from""")
def driver_at_event_long_history(t):
    """Seven keys with hundreds of versions each, and every trip on one of them."""
    versions = (base(t.spark, t.sf_dir, "lineitem").groupBy(
        F.concat(F.lit("TRK-"), (F.col("l_partkey") % 7).cast("string")).alias("model"),
        F.col("l_shipdate").cast("date").alias("valid_from"))
        .agg(F.count(F.lit(1)).alias("version"), F.max("l_orderkey").alias("odometer")))
    follows = Window.partitionBy("model").orderBy("valid_from")
    history = versions.withColumn("valid_to", F.lead("valid_from").over(follows))
    trips = t.fact_trips.select("trip_id", "truck_id", "dispatch_date", F.concat(
        F.lit("TRK-"), (F.substring("truck_id", 5, 20).cast("long") % 7).cast("string")).alias("model"))
    return scd2.version_at_ranges(trips, history, "model", "dispatch_date",
                                  {"version": "version", "odometer": "odometer"}).drop("model")


# ================================================================== I profiling
_PROFILED = ("loads", "trips", "delivery_events", "customers", "fuel_purchases")


@query(" UNION ALL ".join(f"""
SELECT '{n}' AS table_name, sum(n)::BIGINT AS row_count, {len(_raw_columns(n))} AS column_count,
  (sum(n) - count(*))::BIGINT AS duplicate_rows,
  round((sum(n) - count(*)) * 100.0::DOUBLE / sum(n), 2) AS duplicate_pct
FROM (SELECT count(*) AS n FROM {n} GROUP BY {', '.join(_raw_columns(n))}) g""" for n in _PROFILED))
def profile_tables(t):
    return reduce(DataFrame.unionByName, [
        profiling.table_profile(getattr(t, n), n) for n in _PROFILED])


@query(" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count,
  round(count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*), 2) AS null_pct,
  count(DISTINCT {c}) AS unique_values, count({c}) - count(DISTINCT {c}) AS duplicate_count,
  round(coalesce((count({c}) - count(DISTINCT {c})) * 100.0::DOUBLE / NULLIF(count({c}), 0), 0), 2) AS duplicate_pct
FROM trips""" for c in _raw_columns("trips")))
def profile_columns(t):
    return profiling.column_profile(t.trips)


@query(None)
def profile_columns_approx(t):
    """Sketched distinct counts; no exact SQL counterpart."""
    return profiling.column_profile_approx(t.trips)


def _type_sql(c: str) -> str:
    return f"""
SELECT '{c}' AS column_name,
  CASE WHEN bool_and(lower({c}) IN ('true', 'false')) THEN 'BOOLEAN'
    WHEN bool_and(regexp_full_match({c}, '[+-]?[0-9]+')) THEN 'INTEGER'
    WHEN bool_and(regexp_full_match(trim({c}), '{o.NUMBER}')) THEN 'FLOAT / DECIMAL'
    WHEN bool_and(regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}')) THEN 'DATE'
    WHEN bool_and(regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}')) THEN 'TIMESTAMP'
    WHEN bool_and(regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}(\\.\\d{{1,6}})?')) THEN 'TIMESTAMP (microsecond)'
    WHEN count(DISTINCT {c}) <= 25 THEN 'VARCHAR (ENUM - ' || count(DISTINCT {c}) || ' values)'
    ELSE 'VARCHAR / STRING' END AS inferred_type,
  CASE WHEN bool_and(regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}')) THEN 'YYYY-MM-DD'
    WHEN bool_and(regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}')) THEN 'YYYY-MM-DD HH:MM:SS'
    WHEN bool_and(regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}(\\.\\d{{1,6}})?')) THEN 'YYYY-MM-DD HH:MM:SS.ffffff'
    ELSE 'N/A' END AS date_format
FROM ({o.as_text('delivery_events')}) x WHERE {c} IS NOT NULL"""


@query(" UNION ALL ".join(_type_sql(c) for c in _raw_columns("delivery_events")))
def profile_types(t):
    return profiling.inferred_types(t.delivery_events)


_SHARES = {"boolean": "lower({c}) IN ('true', 'false')", "integer": "regexp_full_match({c}, '[+-]?[0-9]+')",
           "number": f"regexp_full_match(trim({{c}}), '{o.NUMBER}')",
           "date": "regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}')",
           "timestamp": "regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}(\\.\\d{{1,6}})?')"}


def _share_sql(c: str) -> str:
    tests = {k: t.format(c=c) for k, t in _SHARES.items()}
    pick = lambda value, rest: "CASE " + " ".join(
        f"WHEN count(*) FILTER ({t}) >= count(*) * 0.9 THEN {value(k, t)}" for k, t in tests.items()) + f" ELSE {rest} END"
    return f"""SELECT '{c}' AS column_name, count(*) AS "values", {', '.join(
        f'round(count(*) FILTER ({t}) / count(*)::DOUBLE, 6) AS {k}_share' for k, t in tests.items())},
  {pick(lambda k, t: f"'{k}'", "'text'")} AS dominant_type,
  {pick(lambda k, t: f'count(*) - count(*) FILTER ({t})', '0')}::BIGINT AS outlier_rows,
  {pick(lambda k, t: f'count(DISTINCT {c}) - count(DISTINCT {c}) FILTER ({t})', '0')}::BIGINT AS outlier_values
FROM raw_loads WHERE {c} IS NOT NULL"""


@query(" UNION ALL ".join(map(_share_sql, _raw_columns("loads"))))
def profile_types_share(t):
    """Types of a dirty raw table by the share of values they read."""
    return profiling.type_shares(t.raw_loads)


@query(" UNION ALL ".join(f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
  min(CAST({c} AS VARCHAR)) AS least, max(CAST({c} AS VARCHAR)) AS greatest, TRUE AS distinct_in_error,
  TRUE AS median_in_error FROM loads""" for c in ("load_id", "customer_id", "weight_lbs", "load_status")))
def profile_sketches_merged(t):
    """One profile from the stored states of all batches; estimates against exact values."""
    columns = ["load_id", "customer_id", "weight_lbs", "load_status"]
    rows = t.loads.select(F.year("load_date").alias("year"), *columns)
    states = materialised(profiling.sketched(rows, "year", ["weight_lbs"]), "profile-states")
    found = profiling.merged_profile(states)
    exact = profiling.column_profile(rows.select(*columns)).select("column_name", F.col("unique_values").alias("u"))
    # The share of values below the estimated median, and up to it, encloses one half.
    median = found.where("column_name = 'weight_lbs'").select("q50")
    place = rows.crossJoin(F.broadcast(median)).where("weight_lbs is not null").agg(
        F.avg((F.col("weight_lbs") < F.col("q50")).cast("double")).alias("below"),
        F.avg((F.col("weight_lbs") <= F.col("q50")).cast("double")).alias("upto"))
    near = F.abs(F.col("unique_values") - F.col("u")) <= F.greatest(3 * profiling.HLL_ERROR * F.col("u"), F.lit(1))
    inside = ((F.col("below") <= 0.5 + profiling.KLL_ERROR) & (F.col("upto") >= 0.5 - profiling.KLL_ERROR))
    return found.join(exact, "column_name").crossJoin(F.broadcast(place)).select(
        "column_name", "row_count", "null_count", "least", "greatest", near.alias("distinct_in_error"),
        F.when(F.col("q50").isNull(), True).otherwise(inside).alias("median_in_error"))


@query(" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, CASE WHEN u <= 25 THEN CAST({c} AS VARCHAR) END AS value,
  CASE WHEN u <= 25 THEN count(*) END AS n, u AS distinct_values
FROM loads, (SELECT count(DISTINCT {c}) AS u FROM loads) d WHERE {c} IS NOT NULL GROUP BY 1, 2, u"""
    for c in _raw_columns("loads")))
def profile_enums(t):
    """Value lists of all columns; a column with more than 25 values tells how many."""
    return profiling.enum_values(t.loads)


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(min({c}) AS DATE) AS first_date, CAST(max({c}) AS DATE) AS last_date FROM delivery_events"
    for c in ("scheduled_datetime", "actual_datetime")))
def profile_scope(t):
    return profiling.temporal_scope(t.delivery_events, ["scheduled_datetime", "actual_datetime"])


@query(" UNION ALL ".join(
    f"SELECT '{c.name}' AS column_name, '{c.type}' AS declared_type, "
    f"count(*) FILTER (WHERE NOT {o.missing(c.name)} AND ({o.cast_of(c)}) IS NULL) AS invalid_count FROM raw_delivery_events"
    for c in registry.table("delivery_events").columns))
def profile_invalid(t):
    return profiling.invalid_values(t.raw_delivery_events, registry.table("delivery_events").columns)


@query("""SELECT 'trips' AS table_name, 'trip_id' AS key_columns, count(*) AS distinct_keys,
  coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS duplicate_key_rows
FROM (SELECT count(*) AS n FROM trips GROUP BY trip_id) g""")
def profile_keys(t):
    return profiling.key_uniqueness(t.trips, "trips", ["trip_id"])


# =================================================================== streaming
@query(f"""SELECT {_csv_nulls('loads')}, 'batch_' || least(load_date[1:4], '2000') AS _batch_id,
  'batch_' || least(load_date[1:4], '2000') AS batch_id FROM raw_loads""")
def stream_bronze_arrivals(t):
    """Batch files picked up as a stream, in two runs; the second finds nothing new."""
    landing, root = t.folder("landing"), t.folder("stream")
    raw.write_batches(t.raw_loads, "load_date", landing, DATA_BATCHES)
    for _ in range(2):
        arrivals.ingest_arrivals(t.spark, landing, f"{root}/bronze", f"{root}/checkpoint", "loads",
                                 "batch_id=*", "batch_id=([^/]+)/").awaitTermination()
    return store.read_table(t.spark, f"{root}/bronze", "loads")
