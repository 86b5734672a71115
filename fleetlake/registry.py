"""Declared tables, data-quality rules and Gold layouts of the fleet lake.

Everything below the "Fixed values" markers is a contract value: names, types,
keys, bounds and texts have to be exactly these for results to be right.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


# --------------------------------------------------------------------------
# Model
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class Column:
    name: str
    type: str = "string"
    nullable: bool = False
    format: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent_table: str
    parent_column: str
    nullable: bool = False


@dataclass(frozen=True)
class Table:
    name: str
    layer: str
    primary_key: tuple[str, ...]
    columns: tuple[Column, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    batch_date: str | None = None
    description: str = ""

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]


@dataclass(frozen=True)
class Rule:
    """One declared check. ``kind`` is not_null, enum, range or sql_expression."""

    id: str
    kind: str
    description: str
    column: str | None = None
    allowed: tuple[str, ...] = ()
    min: float | None = None
    max: float | None = None
    expression: str | None = None
    severity: str = "ERROR"


@dataclass(frozen=True)
class Layout:
    """Physical layout of a Gold table: range column, sort columns, row key."""

    partition: str
    cluster: tuple[str, ...]
    key: tuple[str, ...]


@dataclass(frozen=True)
class Relationship:
    dim: str
    dim_key: str
    fact: str
    fact_key: str
    active: bool = True


def not_null(id, column, description):
    return Rule(id, "not_null", description, column)


def enum(id, column, allowed, description):
    return Rule(id, "enum", description, column, allowed=tuple(allowed))


def in_range(id, column, description, min=None, max=None):
    return Rule(id, "range", description, column, min=min, max=max)


def expression(id, sql, description):
    return Rule(id, "sql_expression", description, expression=sql)


_SPARK_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}

DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def _columns(spec: str) -> tuple[Column, ...]:
    """``name[:type][?]`` items separated by blanks; ``?`` marks a nullable column."""
    out = []
    for item in spec.split():
        nullable = item.endswith("?")
        name, _, kind = item.rstrip("?").partition(":")
        kind = kind or "string"
        fmt = {"date": DATE_FORMAT, "timestamp": TIMESTAMP_FORMAT}.get(kind)
        out.append(Column(name, kind, nullable, fmt))
    return tuple(out)


# --------------------------------------------------------------------------
# The 14 source tables
# --------------------------------------------------------------------------
_ALL_TABLES = (
    Table("customers", "dimension", ("customer_id",), _columns(
        "customer_id customer_name customer_type credit_terms_days:integer primary_freight_type "
        "account_status contract_start_date:date annual_revenue_potential:integer"),
        description="Customer accounts and contract terms."),
    Table("drivers", "dimension", ("driver_id",), _columns(
        "driver_id first_name last_name hire_date:date termination_date:date? license_number "
        "license_state date_of_birth:date home_terminal employment_status cdl_class "
        "years_experience:integer"),
        description="Driver master data and employment lifecycle."),
    Table("facilities", "dimension", ("facility_id",), _columns(
        "facility_id facility_name facility_type city state latitude:double longitude:double "
        "dock_doors:integer operating_hours"),
        description="Terminals, warehouses and their docks."),
    Table("routes", "dimension", ("route_id",), _columns(
        "route_id origin_city origin_state destination_city destination_state "
        "typical_distance_miles:integer base_rate_per_mile:double fuel_surcharge_rate:double "
        "typical_transit_days:integer"),
        description="Freight lanes with distance and rates."),
    Table("trailers", "dimension", ("trailer_id",), _columns(
        "trailer_id trailer_number:integer trailer_type length_feet:integer model_year:integer vin "
        "acquisition_date:date status current_location"),
        description="Trailer inventory."),
    Table("trucks", "dimension", ("truck_id",), _columns(
        "truck_id unit_number:integer make model_year:integer vin acquisition_date:date "
        "acquisition_mileage:integer fuel_type tank_capacity_gallons:integer status home_terminal"),
        description="Tractor inventory."),
    Table("loads", "fact", ("load_id",), _columns(
        "load_id customer_id route_id load_date:date load_type weight_lbs:integer pieces:integer "
        "revenue:double fuel_surcharge:double accessorial_charges:integer load_status booking_type"),
        (ForeignKey("customer_id", "customers", "customer_id"),
         ForeignKey("route_id", "routes", "route_id")),
        "load_date", "Booked freight with its charges."),
    Table("trips", "fact", ("trip_id",), _columns(
        "trip_id load_id driver_id? truck_id? trailer_id? dispatch_date:date "
        "actual_distance_miles:integer actual_duration_hours:double fuel_gallons_used:double "
        "average_mpg:double idle_time_hours:double trip_status"),
        (ForeignKey("load_id", "loads", "load_id"),
         ForeignKey("driver_id", "drivers", "driver_id", True),
         ForeignKey("truck_id", "trucks", "truck_id", True),
         ForeignKey("trailer_id", "trailers", "trailer_id", True)),
        "dispatch_date", "Dispatches with distance and fuel use."),
    Table("delivery_events", "fact", ("event_id",), _columns(
        "event_id load_id trip_id event_type facility_id scheduled_datetime:timestamp "
        "actual_datetime:timestamp detention_minutes:integer on_time_flag:boolean location_city "
        "location_state"),
        (ForeignKey("load_id", "loads", "load_id"),
         ForeignKey("trip_id", "trips", "trip_id"),
         ForeignKey("facility_id", "facilities", "facility_id")),
        "scheduled_datetime", "Pickup and delivery milestones."),
    Table("fuel_purchases", "fact", ("fuel_purchase_id",), _columns(
        "fuel_purchase_id trip_id truck_id? driver_id? purchase_date:timestamp location_city "
        "location_state gallons:double price_per_gallon:double total_cost:double fuel_card_number"),
        (ForeignKey("trip_id", "trips", "trip_id"),
         ForeignKey("truck_id", "trucks", "truck_id", True),
         ForeignKey("driver_id", "drivers", "driver_id", True)),
        "purchase_date", "Fuel card transactions."),
    Table("maintenance_records", "fact", ("maintenance_id",), _columns(
        "maintenance_id truck_id maintenance_date:date maintenance_type odometer_reading:integer "
        "labor_hours:double labor_cost:double parts_cost:double total_cost:double facility_location "
        "downtime_hours:double service_description"),
        (ForeignKey("truck_id", "trucks", "truck_id"),),
        "maintenance_date", "Truck services, their cost and downtime."),
    Table("safety_incidents", "fact", ("incident_id",), _columns(
        "incident_id trip_id truck_id? driver_id? incident_date:timestamp incident_type "
        "location_city location_state at_fault_flag:boolean injury_flag:boolean "
        "vehicle_damage_cost:double cargo_damage_cost:double claim_amount:double "
        "preventable_flag:boolean description"),
        (ForeignKey("trip_id", "trips", "trip_id"),
         ForeignKey("truck_id", "trucks", "truck_id", True),
         ForeignKey("driver_id", "drivers", "driver_id", True)),
        "incident_date", "Incidents, fault and claims."),
    Table("driver_monthly_metrics", "aggregate", ("driver_id", "month"), _columns(
        "driver_id month:date trips_completed:integer total_miles:integer total_revenue:double "
        "average_mpg:double total_fuel_gallons:double on_time_delivery_rate:double "
        "average_idle_hours:double"),
        (ForeignKey("driver_id", "drivers", "driver_id"),),
        "month", "Monthly performance per driver."),
    Table("truck_utilization_metrics", "aggregate", ("truck_id", "month"), _columns(
        "truck_id month:date trips_completed:integer total_miles:integer total_revenue:double "
        "average_mpg:double maintenance_events:integer maintenance_cost:double "
        "downtime_hours:double utilization_rate:double"),
        (ForeignKey("truck_id", "trucks", "truck_id"),),
        "month", "Monthly utilisation per truck."),
)

TABLES: dict[str, Table] = {t.name: t for t in _ALL_TABLES}

# --------------------------------------------------------------------------
# Data-quality rules, in evaluation order
# --------------------------------------------------------------------------
RULES: dict[str, tuple[Rule, ...]] = {
    "customers": (
        not_null("cust_pk_not_null", "customer_id", "Customer ID must not be null"),
        enum("cust_type_enum", "customer_type", ("Dedicated", "Contract", "Spot"),
             "Customer type must be one of: Dedicated, Contract, Spot"),
        enum("cust_status_enum", "account_status", ("Active", "Inactive"),
             "Account status must be Active or Inactive"),
        in_range("cust_rev_potential_positive", "annual_revenue_potential",
                 "Annual revenue potential cannot be negative", min=0),
    ),
    "drivers": (
        not_null("driver_pk_not_null", "driver_id", "Driver ID must not be null"),
        enum("driver_status_enum", "employment_status", ("Active", "Terminated", "On Leave"),
             "Employment status must be Active, Terminated, or On Leave"),
        in_range("driver_experience_range", "years_experience",
                 "Years of experience must be between 0 and 60", min=0, max=60),
        expression("driver_hire_before_term",
                   "termination_date IS NULL OR termination_date >= hire_date",
                   "Termination date must be on or after hire date"),
    ),
    "facilities": (
        not_null("facility_pk_not_null", "facility_id", "Facility ID must not be null"),
        enum("facility_type_enum", "facility_type",
             ("Cross-Dock", "Distribution Center", "Terminal", "Warehouse"),
             "Facility type must be valid"),
        in_range("facility_dock_doors_positive", "dock_doors",
                 "Dock doors must be between 1 and 500", min=1, max=500),
    ),
    "routes": (
        not_null("route_pk_not_null", "route_id", "Route ID must not be null"),
        in_range("route_distance_positive", "typical_distance_miles",
                 "Route distance must be positive and within 5000 miles", min=1, max=5000),
        in_range("route_base_rate_positive", "base_rate_per_mile",
                 "Base rate per mile must be reasonable positive amount", min=0.1, max=50.0),
    ),
    "trailers": (
        not_null("trailer_pk_not_null", "trailer_id", "Trailer ID must not be null"),
        enum("trailer_type_enum", "trailer_type", ("Refrigerated", "Dry Van"),
             "Trailer type must be Dry Van or Refrigerated"),
        in_range("trailer_model_year_range", "model_year",
                 "Trailer model year must be between 1990 and 2030", min=1990, max=2030),
    ),
    "trucks": (
        not_null("truck_pk_not_null", "truck_id", "Truck ID must not be null"),
        enum("truck_status_enum", "status", ("Active", "Maintenance", "Inactive"),
             "Truck status must be Active, Maintenance, or Inactive"),
        in_range("truck_tank_capacity_range", "tank_capacity_gallons",
                 "Tank capacity must be between 50 and 500 gallons", min=50, max=500),
        in_range("truck_mileage_positive", "acquisition_mileage",
                 "Acquisition mileage cannot be negative", min=0),
    ),
    "loads": (
        not_null("load_pk_not_null", "load_id", "Load ID must not be null"),
        not_null("load_fk_customer_not_null", "customer_id",
                 "Customer ID foreign key must not be null"),
        not_null("load_fk_route_not_null", "route_id", "Route ID foreign key must not be null"),
        enum("load_type_enum", "load_type", ("Dry Van", "Refrigerated"),
             "Load type must be Dry Van or Refrigerated"),
        in_range("load_weight_positive", "weight_lbs",
                 "Weight must be between 1 and 80,000 lbs (legal limit)", min=1, max=80000),
        in_range("load_pieces_positive", "pieces", "Piece count must be at least 1", min=1),
        in_range("load_revenue_positive", "revenue",
                 "Freight revenue must be strictly positive", min=0.01),
    ),
    "trips": (
        not_null("trip_pk_not_null", "trip_id", "Trip ID must not be null"),
        not_null("trip_fk_load_not_null", "load_id", "Load ID foreign key must not be null"),
        in_range("trip_distance_positive", "actual_distance_miles",
                 "Actual distance must be non-negative and under 5000 miles", min=0, max=5000),
        in_range("trip_duration_positive", "actual_duration_hours",
                 "Actual duration hours must be non-negative and realistic", min=0.0, max=200.0),
        in_range("trip_fuel_positive", "fuel_gallons_used",
                 "Fuel gallons used must be non-negative", min=0.0, max=1000.0),
        in_range("trip_mpg_realistic", "average_mpg",
                 "Average MPG for heavy vehicle must be between 1.0 and 25.0", min=1.0, max=25.0),
    ),
    "delivery_events": (
        not_null("event_pk_not_null", "event_id", "Event ID must not be null"),
        enum("event_type_enum", "event_type", ("Pickup", "Delivery"),
             "Event type must be Pickup or Delivery"),
        in_range("event_detention_positive", "detention_minutes",
                 "Detention minutes cannot be negative", min=0),
        expression("event_dates_present",
                   "scheduled_datetime IS NOT NULL AND actual_datetime IS NOT NULL",
                   "Scheduled and actual timestamps must both be populated"),
    ),
    "fuel_purchases": (
        not_null("fuel_pk_not_null", "fuel_purchase_id", "Fuel purchase ID must not be null"),
        not_null("fuel_trip_not_null", "trip_id", "Associated trip ID must not be null"),
        in_range("fuel_gallons_positive", "gallons",
                 "Gallons purchased must be between 0.1 and 400", min=0.1, max=400.0),
        in_range("fuel_price_per_gal_positive", "price_per_gallon",
                 "Price per gallon must be between $0.50 and $15.00", min=0.5, max=15.0),
        in_range("fuel_total_cost_positive", "total_cost",
                 "Total fuel purchase cost must be positive", min=0.01),
    ),
    "maintenance_records": (
        not_null("maint_pk_not_null", "maintenance_id", "Maintenance ID must not be null"),
        not_null("maint_truck_not_null", "truck_id", "Truck ID must not be null"),
        enum("maint_type_enum", "maintenance_type",
             ("Inspection", "Tire", "Preventive", "Repair", "Transmission", "Brake", "Engine"),
             "Maintenance type must be a recognized service category"),
        in_range("maint_cost_positive", "total_cost",
                 "Total maintenance cost cannot be negative", min=0.0),
        in_range("maint_downtime_positive", "downtime_hours",
                 "Downtime hours cannot be negative", min=0.0),
    ),
    "safety_incidents": (
        not_null("incident_pk_not_null", "incident_id", "Incident ID must not be null"),
        enum("incident_type_enum", "incident_type",
             ("Accident", "Moving Violation", "DOT Violation", "Equipment Damage",
              "Customer Complaint"),
             "Incident type must be a recognized safety classification"),
        in_range("incident_claim_positive", "claim_amount",
                 "Claim amount cannot be negative", min=0.0),
    ),
    "driver_monthly_metrics": (
        not_null("driver_metrics_pk_not_null", "driver_id", "Driver ID must not be null"),
        not_null("driver_metrics_month_not_null", "month", "Reporting month must not be null"),
        in_range("driver_otd_rate_range", "on_time_delivery_rate",
                 "On-time delivery rate must be a percentage between 0.0 and 1.0",
                 min=0.0, max=1.0),
    ),
    "truck_utilization_metrics": (
        not_null("truck_metrics_pk_not_null", "truck_id", "Truck ID must not be null"),
        not_null("truck_metrics_month_not_null", "month", "Reporting month must not be null"),
        in_range("truck_util_rate_range", "utilization_rate",
                 "Utilization rate must be a percentage between 0.0 and 1.0", min=0.0, max=1.0),
    ),
}

MAX_REJECTION_RATE_PCT = 20.0

# Batches: the last one also takes every later year.
BATCHES = (("batch_001", 2022), ("batch_002", 2023), ("batch_003", 2024))

# --------------------------------------------------------------------------
# Gold tables
# --------------------------------------------------------------------------
_LINEAGE = " batch_id? _gold_published_at:timestamp?"

GOLD: dict[str, tuple[Column, ...]] = {
    "dim_date": _columns(
        "date_key:long full_date:date day_of_week:long? day_name? day_of_month:long? month:long? "
        "month_name? quarter:long? year:long? is_weekend:boolean?"),
    "dim_customer": _columns(
        "customer_sk:long customer_id customer_name? customer_type? credit_terms_days:long? "
        "primary_freight_type? account_status? contract_start_date:date? "
        "annual_revenue_potential:long? _created_at:timestamp?"),
    "dim_driver": _columns(
        "driver_sk:long driver_id first_name? last_name? full_name? license_number? "
        "license_state? date_of_birth:date? home_terminal? employment_status? cdl_class? "
        "years_experience:long? hire_date:date? termination_date:date? valid_from:date "
        "valid_to:date? is_current:boolean _created_at:timestamp?"),
    "dim_truck": _columns(
        "truck_sk:long truck_id unit_number:long? make? model_year:long? vin? "
        "acquisition_date:date? acquisition_mileage:long? fuel_type? tank_capacity_gallons:long? "
        "status? home_terminal? _created_at:timestamp?"),
    "dim_trailer": _columns(
        "trailer_sk:long trailer_id trailer_number:long? trailer_type? length_feet:long? "
        "model_year:long? vin? acquisition_date:date? status? current_location? "
        "_created_at:timestamp?"),
    "dim_facility": _columns(
        "facility_sk:long facility_id facility_name? facility_type? city? state? latitude:double? "
        "longitude:double? dock_doors:long? operating_hours? _created_at:timestamp?"),
    "dim_route": _columns(
        "route_sk:long route_id origin_city? origin_state? destination_city? destination_state? "
        "typical_distance_miles:long? base_rate_per_mile:double? fuel_surcharge_rate:double? "
        "typical_transit_days:long? _created_at:timestamp?"),
    "fact_trips": _columns(
        "trip_id load_id customer_id? route_id? driver_id? truck_id? trailer_id? "
        "dispatch_date:date load_date:date? load_type? booking_type? load_status? trip_status? "
        "weight_lbs:long? pieces:long? actual_distance_miles:long? actual_duration_hours:double? "
        "fuel_gallons_used:double? average_mpg:double? idle_time_hours:double? "
        "freight_revenue:double? fuel_surcharge:double? accessorial_charges:long? "
        "total_revenue:double?" + _LINEAGE),
    "fact_delivery_events": _columns(
        "event_id load_id trip_id facility_id event_type scheduled_datetime:timestamp "
        "actual_datetime:timestamp event_date:date detention_minutes:long? on_time_flag:boolean? "
        "location_city? location_state?" + _LINEAGE),
    "fact_fuel_purchases": _columns(
        "fuel_purchase_id trip_id truck_id? driver_id? purchase_datetime:timestamp "
        "purchase_date:date location_city? location_state? gallons:double? "
        "price_per_gallon:double? total_cost:double? fuel_card_number?" + _LINEAGE),
    "fact_maintenance": _columns(
        "maintenance_id truck_id maintenance_date:date maintenance_type odometer_reading:long? "
        "labor_hours:double? labor_cost:double? parts_cost:double? total_cost:double? "
        "downtime_hours:double? facility_location? service_description?" + _LINEAGE),
    "fact_safety_incidents": _columns(
        "incident_id trip_id truck_id? driver_id? incident_datetime:timestamp incident_date:date "
        "incident_type location_city? location_state? at_fault_flag:boolean? injury_flag:boolean? "
        "preventable_flag:boolean? vehicle_damage_cost:double? cargo_damage_cost:double? "
        "claim_amount:double? description?" + _LINEAGE),
    "agg_driver_monthly_performance": _columns(
        "driver_id month:date trips_completed:long? total_miles:long? total_revenue:double? "
        "average_mpg:double? total_fuel_gallons:double? on_time_delivery_rate:double? "
        "average_idle_hours:double?" + _LINEAGE),
    "agg_truck_utilization_performance": _columns(
        "truck_id month:date trips_completed:long? total_miles:long? total_revenue:double? "
        "average_mpg:double? maintenance_events:long? maintenance_cost:double? "
        "downtime_hours:double? utilization_rate:double?" + _LINEAGE),
}

LAYOUTS: dict[str, Layout] = {
    "fact_trips": Layout(
        "dispatch_date", ("driver_id", "truck_id", "customer_id", "route_id"), ("trip_id",)),
    "fact_delivery_events": Layout("event_date", ("facility_id", "event_type"), ("event_id",)),
    "fact_fuel_purchases": Layout(
        "purchase_date", ("truck_id", "driver_id", "location_state"), ("fuel_purchase_id",)),
    "fact_maintenance": Layout(
        "maintenance_date", ("truck_id", "maintenance_type"), ("maintenance_id",)),
    "fact_safety_incidents": Layout(
        "incident_date", ("driver_id", "truck_id", "incident_type"), ("incident_id",)),
    "agg_driver_monthly_performance": Layout("month", ("driver_id",), ()),
    "agg_truck_utilization_performance": Layout("month", ("truck_id",), ()),
}

RELATIONSHIPS: tuple[Relationship, ...] = (
    Relationship("dim_date", "full_date", "fact_trips", "dispatch_date"),
    Relationship("dim_date", "full_date", "fact_trips", "load_date", active=False),
    Relationship("dim_customer", "customer_id", "fact_trips", "customer_id"),
    Relationship("dim_driver", "driver_id", "fact_trips", "driver_id"),
    Relationship("dim_truck", "truck_id", "fact_trips", "truck_id"),
    Relationship("dim_trailer", "trailer_id", "fact_trips", "trailer_id"),
    Relationship("dim_route", "route_id", "fact_trips", "route_id"),
    Relationship("dim_date", "full_date", "fact_delivery_events", "event_date"),
    Relationship("dim_date", "full_date", "fact_delivery_events", "actual_datetime", active=False),
    Relationship("dim_facility", "facility_id", "fact_delivery_events", "facility_id"),
    Relationship("dim_date", "full_date", "fact_fuel_purchases", "purchase_date"),
    Relationship("dim_truck", "truck_id", "fact_fuel_purchases", "truck_id"),
    Relationship("dim_driver", "driver_id", "fact_fuel_purchases", "driver_id"),
    Relationship("dim_date", "full_date", "fact_maintenance", "maintenance_date"),
    Relationship("dim_truck", "truck_id", "fact_maintenance", "truck_id"),
    Relationship("dim_date", "full_date", "fact_safety_incidents", "incident_date"),
    Relationship("dim_driver", "driver_id", "fact_safety_incidents", "driver_id"),
    Relationship("dim_truck", "truck_id", "fact_safety_incidents", "truck_id"),
)


# --------------------------------------------------------------------------
# Lookups
# --------------------------------------------------------------------------
def table(name: str) -> Table:
    return TABLES[name]


def rules(name: str) -> tuple[Rule, ...]:
    return RULES.get(name, ())


def primary_key(name: str) -> list[str]:
    return list(TABLES[name].primary_key)


def foreign_keys(name: str) -> tuple[ForeignKey, ...]:
    return TABLES[name].foreign_keys


def spark_type(type_name: str) -> T.DataType:
    """Spark type of a declared type name; an unknown name is a string."""
    return _SPARK_TYPES.get(type_name.lower(), T.StringType())


def typed_schema(name: str) -> T.StructType:
    return T.StructType([
        T.StructField(c.name, spark_type(c.type), c.nullable) for c in TABLES[name].columns])


def raw_schema(name: str) -> T.StructType:
    return T.StructType([
        T.StructField(c.name, T.StringType(), True) for c in TABLES[name].columns])


def relationship(fact: str, dim: str, fact_key: str | None = None) -> Relationship:
    """The declared link of ``fact`` to ``dim``: the active one, or the one on ``fact_key``."""
    for r in RELATIONSHIPS:
        if r.fact == fact and r.dim == dim and (r.active if fact_key is None
                                                else r.fact_key == fact_key):
            return r
    raise KeyError(f"no relationship from {fact} to {dim}")
