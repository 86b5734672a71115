"""DuckDB SQL that states the expected result of each registered query."""

from __future__ import annotations

import re

from fleetlake import registry
from fleetlake.catalog.shapes import SHAPES, shape_sql
from fleetlake.functions.text import CSV_NULL_TOKENS

NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


# ------------------------------------------------------------------- fragments
def blank(c):
    return f"({c} IS NULL OR trim({c}) IN ('', 'nan', 'None', 'NULL'))"


def missing(c):
    return f"({c} IS NULL OR lower(trim({c})) IN ('', 'nan', 'none', 'null'))"


def number(c):
    return f"CASE WHEN regexp_full_match(trim({c}), '{NUMBER}') THEN TRY_CAST(trim({c}) AS DOUBLE) END"


def whole(c):
    return (f"CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN TRY_CAST(trim({c}) AS BIGINT) "
            f"WHEN ({number(c)}) = floor({number(c)}) THEN TRY_CAST({number(c)} AS BIGINT) END")


def date_of(c):
    return f"CAST(try_strptime(trim({c}), '%Y-%m-%d') AS DATE)"


def timestamp_of(c):
    return f"try_strptime(trim({c}), ['%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%d %H:%M:%S'])"


def boolean_of(c):
    return (f"CASE WHEN lower(trim({c})) IN ('true', '1', 't', 'yes') THEN TRUE "
            f"WHEN lower(trim({c})) IN ('false', '0', 'f', 'no') THEN FALSE END")


def string_of(c, nullable):
    return f"CASE WHEN trim({c}) NOT IN ('nan', 'None', 'NULL', '') THEN trim({c}) END" \
        if nullable else f"trim({c})"


def csv_null(c):
    tokens = ", ".join(f"'{t}'" for t in CSV_NULL_TOKENS)
    return f"CASE WHEN {c} NOT IN ({tokens}) THEN {c} END"


def cast_of(column: registry.Column):
    c = column.name
    return {
        "integer": whole, "long": whole, "double": number, "float": number,
        "boolean": boolean_of, "date": date_of, "timestamp": timestamp_of,
    }.get(column.type, lambda x: string_of(x, column.nullable))(c)


def with_tables(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the shapes and derived tables it mentions, in dependency order."""
    known = {**{n: shape_sql(n) for n in SHAPES}, **GOLD, **(extra or {})}
    order: list[str] = []

    def need(sql):
        for word in dict.fromkeys(re.findall(r"\b[a-z_0-9]+\b", sql)):
            if word in known and word not in order and not _is_alias(word, sql):
                if known[word] is not sql:
                    need(known[word])
                order.append(word)

    need(body)
    ctes = ",\n".join(f"{n} AS (\n{known[n]}\n)" for n in order)
    return f"WITH {ctes}\n{body.strip()}" if order else body.strip()


def _is_alias(word, sql):
    """A known name counts as a table only where it follows FROM or JOIN."""
    return re.search(rf"\b(?:FROM|JOIN)\s+{word}\b", sql) is None


def rounded(body: str, digits: int, *columns: str) -> str:
    replaced = ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM (\n{body.strip()}\n) AS result"


def ratio(a, b):
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def ratio0(a, b):
    return f"coalesce({ratio(a, b)}, 0)"


# ------------------------------------------------------------------ Gold tables
def _dim(source, key, sk, columns):
    return f"SELECT row_number() OVER (ORDER BY {key}) AS {sk}, {columns} FROM {source}"


_DRIVER_COLUMNS = (
    "driver_id, first_name, last_name, full_name, license_number, license_state, date_of_birth, "
    "home_terminal, employment_status, cdl_class, years_experience, hire_date, termination_date")


def _named(source):
    return (f"SELECT *, coalesce(first_name, '') || ' ' || coalesce(last_name, '') AS full_name "
            f"FROM {source}")


def scd2_sql(existing: str, incoming: str, as_of: str) -> str:
    """A merge of one batch, true at a date, into a driver history.

    The version in force at the date is the one with the latest start not after it; where there is
    none, the key's first version stands behind the date.
    """
    fresh = ", ".join(f"i.{c.strip()}" for c in _DRIVER_COLUMNS.split(","))
    return f"""
SELECT e.driver_sk, {', '.join('e.' + c.strip() for c in _DRIVER_COLUMNS.split(','))}, e.valid_from,
  CASE WHEN s.driver_sk IS NOT NULL AND NOT s.early THEN DATE '{as_of}' ELSE e.valid_to END AS valid_to,
  e.is_current AND (s.driver_sk IS NULL OR s.early) AS is_current
FROM {existing} e LEFT JOIN ({_spliced(existing, incoming, as_of)}) s ON s.driver_sk = e.driver_sk
UNION ALL
SELECT (SELECT max(driver_sk) FROM {existing}) + row_number() OVER (ORDER BY i.kind, i.driver_id), {fresh},
  i.valid_from, i.valid_to, i.is_current
FROM (
  SELECT n.*, 1 AS kind, DATE '{as_of}' AS valid_from,
    CASE WHEN s.early THEN s.valid_from ELSE s.valid_to END AS valid_to, s.is_current AND NOT s.early AS is_current
  FROM ({_named(incoming)}) n JOIN ({_spliced(existing, incoming, as_of)}) s ON s.driver_id = n.driver_id
  UNION ALL
  SELECT n.*, 2 AS kind, coalesce(n.hire_date, DATE '{as_of}') AS valid_from, CAST(NULL AS DATE), TRUE
  FROM ({_named(incoming)}) n
  WHERE NOT EXISTS (SELECT 1 FROM {existing} o WHERE o.driver_id = n.driver_id)) i"""


def _spliced(existing: str, incoming: str, as_of: str) -> str:
    """One version per changed key: the one in force, or the first one if the date is before it."""
    return f"""
  SELECT p.*, p.valid_from > DATE '{as_of}' AS early FROM (
    SELECT o.* FROM {existing} o WHERE o.valid_to IS NULL OR o.valid_to > o.valid_from
    QUALIFY row_number() OVER (PARTITION BY o.driver_id ORDER BY o.valid_from > DATE '{as_of}',
      CASE WHEN o.valid_from <= DATE '{as_of}' THEN o.valid_from END DESC, o.valid_from) = 1) p
  JOIN {incoming} n ON n.driver_id = p.driver_id
  WHERE (p.valid_to IS NULL OR p.valid_to > DATE '{as_of}' OR p.valid_from > DATE '{as_of}')
    AND (p.employment_status IS DISTINCT FROM n.employment_status
      OR p.termination_date IS DISTINCT FROM n.termination_date)"""


GOLD = {
    "dim_customer": _dim("customers", "customer_id", "customer_sk",
        "customer_id, customer_name, customer_type, credit_terms_days, primary_freight_type, "
        "account_status, contract_start_date, annual_revenue_potential"),
    "dim_truck": _dim("trucks", "truck_id", "truck_sk",
        "truck_id, unit_number, make, model_year, vin, acquisition_date, acquisition_mileage, "
        "fuel_type, tank_capacity_gallons, status, home_terminal"),
    "dim_trailer": _dim("trailers", "trailer_id", "trailer_sk",
        "trailer_id, trailer_number, trailer_type, length_feet, model_year, vin, acquisition_date, "
        "status, current_location"),
    "dim_facility": _dim("facilities", "facility_id", "facility_sk",
        "facility_id, facility_name, facility_type, city, state, latitude, longitude, dock_doors, "
        "operating_hours"),
    "dim_route": _dim("routes", "route_id", "route_sk",
        "route_id, origin_city, origin_state, destination_city, destination_state, "
        "typical_distance_miles, base_rate_per_mile, fuel_surcharge_rate, typical_transit_days"),
    "dim_driver": f"""
SELECT row_number() OVER (ORDER BY driver_id) AS driver_sk, {_DRIVER_COLUMNS},
  coalesce(hire_date, DATE '2020-01-01') AS valid_from, CAST(NULL AS DATE) AS valid_to, TRUE AS is_current
FROM ({_named('drivers')}) named""",
    "dim_driver_two": scd2_sql("dim_driver", "drivers_next", "1997-06-30"),
    "dim_driver_three": scd2_sql("dim_driver_two", "drivers_last", "1999-06-30"),
    # The third snapshot once more, dated between the first two and before most of the first.
    "dim_driver_late": scd2_sql("dim_driver_three", "drivers_last", "1998-06-30"),
    "dim_driver_early": scd2_sql("dim_driver_late", "drivers_next", "1996-01-31"),
    # The first snapshot forced again after the others.
    "dim_driver_forced": scd2_sql("dim_driver_three", "drivers", "1997-01-01"),
    "fact_trips": """
SELECT t.trip_id, t.load_id, l.customer_id, l.route_id, t.driver_id, t.truck_id, t.trailer_id,
  t.dispatch_date, l.load_date, l.load_type, l.booking_type, l.load_status, t.trip_status,
  l.weight_lbs, l.pieces, t.actual_distance_miles, t.actual_duration_hours, t.fuel_gallons_used,
  t.average_mpg, t.idle_time_hours, coalesce(l.revenue, 0) AS freight_revenue,
  coalesce(l.fuel_surcharge, 0) AS fuel_surcharge, coalesce(l.accessorial_charges, 0) AS accessorial_charges,
  coalesce(l.revenue, 0) + coalesce(l.fuel_surcharge, 0) + coalesce(l.accessorial_charges, 0) AS total_revenue,
  'batch_001' AS batch_id
FROM trips t JOIN loads l ON t.load_id = l.load_id""",
    "fact_delivery_events": """
SELECT event_id, load_id, trip_id, facility_id, event_type, scheduled_datetime, actual_datetime,
  CAST(scheduled_datetime AS DATE) AS event_date, detention_minutes, on_time_flag, location_city,
  location_state, 'batch_001' AS batch_id FROM delivery_events""",
    "fact_fuel_purchases": """
SELECT fuel_purchase_id, trip_id, truck_id, driver_id, purchase_date AS purchase_datetime,
  CAST(purchase_date AS DATE) AS purchase_date, location_city, location_state, gallons,
  price_per_gallon, total_cost, fuel_card_number, 'batch_001' AS batch_id FROM fuel_purchases""",
    "fact_maintenance": """
SELECT maintenance_id, truck_id, maintenance_date, maintenance_type, odometer_reading, labor_hours,
  labor_cost, parts_cost, total_cost, downtime_hours, facility_location, service_description,
  'batch_001' AS batch_id FROM maintenance_records""",
    "fact_safety_incidents": """
SELECT incident_id, trip_id, truck_id, driver_id, incident_date AS incident_datetime,
  CAST(incident_date AS DATE) AS incident_date, incident_type, location_city, location_state,
  at_fault_flag, injury_flag, preventable_flag, vehicle_damage_cost, cargo_damage_cost, claim_amount,
  description, 'batch_001' AS batch_id FROM safety_incidents""",
    "agg_driver_monthly_performance":
        "SELECT *, 'batch_001' AS batch_id FROM driver_monthly_metrics",
    "agg_truck_utilization_performance":
        "SELECT *, 'batch_001' AS batch_id FROM truck_utilization_metrics",
    "calendar_days": """
SELECT CAST(d AS DATE) AS full_date, CAST(year(d) AS BIGINT) AS year FROM (
  SELECT unnest(generate_series(make_date(lo, 1, 1), make_date(hi, 12, 31), INTERVAL 1 DAY)) AS d
  FROM (SELECT min(year(dispatch_date)) AS lo, max(year(dispatch_date)) AS hi FROM trips) span) days""",
}


# ---------------------------------------------------------------- data quality
_SQL_RULES = {
    "driver_hire_before_term":
        f"NOT coalesce({date_of('termination_date')} IS NULL OR "
        f"{date_of('termination_date')} >= {date_of('hire_date')}, TRUE)",
    "event_dates_present":
        f"({timestamp_of('scheduled_datetime')} IS NULL OR {timestamp_of('actual_datetime')} IS NULL)",
}


def failure(rule: registry.Rule) -> str:
    c = rule.column
    if rule.kind == "not_null":
        return blank(c)
    if rule.kind == "enum":
        allowed = ", ".join(f"'{v.lower()}'" for v in rule.allowed)
        return f"(NOT {missing(c)} AND lower(trim({c})) NOT IN ({allowed}))"
    if rule.kind == "range":
        tests = [f"({number(c)}) IS NULL"]
        tests += [f"({number(c)}) < {float(rule.min)}"] if rule.min is not None else []
        tests += [f"({number(c)}) > {float(rule.max)}"] if rule.max is not None else []
        return f"(NOT {missing(c)} AND ({' OR '.join(tests)}))"
    return _SQL_RULES[rule.id]


def annotated(source: str, table: str) -> str:
    """Rows of ``source`` with the first failing rule and its reason."""
    key = registry.primary_key(table)
    checks = [("dup", "pk_uniqueness", f"Duplicate primary key ({', '.join(key)})")]
    checks += [(failure(r), r.id, r.description) for r in registry.rules(table)]
    rule = " ".join(f"WHEN {t} THEN '{i}'" for t, i, _ in checks)
    reason = " ".join(f"WHEN {t} THEN '{w}'" for t, _, w in checks)
    columns = ", ".join(registry.table(table).column_names)
    return f"""
SELECT {columns}, CASE {rule} END AS _rejection_rule, CASE {reason} END AS _rejection_reason
FROM (SELECT *, count(*) OVER (PARTITION BY {', '.join(key)}) > 1 AS dup FROM {source}) marked"""


def typed(source: str, table: str) -> str:
    columns = ", ".join(f"{cast_of(c)} AS {c.name}" for c in registry.table(table).columns)
    return f"SELECT {columns} FROM {source}"


def as_text(table: str) -> str:
    columns = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in registry.table(table).column_names)
    return f"SELECT {columns} FROM {table}"


def record_pk(key: list[str]) -> str:
    return " || '_' || ".join(f"coalesce(CAST({k} AS VARCHAR), 'None')" for k in key)


def metrics(table: str, source: str) -> str:
    return f"""
SELECT '{table}' AS table_name, count(*) AS total_records,
  count(*) FILTER (WHERE _rejection_rule IS NULL) AS valid_records,
  count(*) FILTER (WHERE _rejection_rule IS NOT NULL) AS quarantined_records
FROM ({annotated(source, table)}) a"""


DQ_TABLES = {"customers": "raw_customers", "drivers": "raw_drivers", "loads": "raw_loads",
             "trips": "raw_trips", "delivery_events": "raw_delivery_events"}
DQ_METRICS = " UNION ALL ".join(metrics(t, s) for t, s in DQ_TABLES.items())
DQ_RATES = f"""
SELECT *, coalesce(quarantined_records * 100.0::DOUBLE / NULLIF(total_records, 0), 0) AS rejection_rate_pct,
  100.0::DOUBLE - coalesce(quarantined_records * 100.0::DOUBLE / NULLIF(total_records, 0), 0) AS dq_score_pct
FROM ({DQ_METRICS}) m"""
