"""Named business measures, evaluated under any grouping.

A base measure is one aggregate of one fact. A derived measure is an expression over other
measures, so a ratio is a ratio of sums in every context. Facts are aggregated one by one
to the context keys and only then put side by side: facts are never joined to facts.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from fleetlake import registry
from fleetlake.functions.text import divide_or_zero, month_start
from fleetlake.operators.joins import lookup_join
from fleetlake.operators.scd2 import version_at

TRIPS, FUEL, MAINTENANCE = "fact_trips", "fact_fuel_purchases", "fact_maintenance"
EVENTS, SAFETY = "fact_delivery_events", "fact_safety_incidents"
UTILIZATION = "agg_truck_utilization_performance"
AUDIT, METRICS = "pipeline_audit", "data_quality_metrics"


@dataclass(frozen=True)
class Base:
    """An aggregate over one fact. ``build`` makes the column when a session is there; ``kind``
    says how it merges: by addition (sum), as sum and number (avg), as a set (values). ``column``
    is the one it reads; none if it counts rows."""

    fact: str
    build: Callable[[], Column]
    kind: str = "sum"
    column: str | None = None


@dataclass(frozen=True)
class Derived:
    """An expression over the measures in ``inputs``."""

    inputs: tuple[str, ...]
    build: Callable[..., Column]


def _sum(fact, column):
    return Base(fact, lambda: F.sum(column), column=column)


def _avg(fact, column):
    return Base(fact, lambda: F.avg(column), "avg", column)


def _rows(fact):
    return Base(fact, lambda: F.count(F.lit(1)))


def _rows_where(fact, column, predicate: Callable[[Column], Column]):
    return Base(fact, lambda: F.count_if(predicate(F.col(column))), column=column)


def _values(fact, column):
    """Distinct values, a blank counting as one."""
    return Base(fact, lambda: F.countDistinct(column)
                + F.coalesce(F.max(F.col(column).isNull().cast("bigint")), F.lit(0)), "values", column)


def _ratio(a, b, scale: float = 1.0):
    return Derived((a, b), lambda x, y: divide_or_zero(x * F.lit(scale), y))


def _blank_as_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _total(*inputs):
    return Derived(inputs, lambda *c: reduce(lambda a, b: a + b, map(_blank_as_zero, c)))


def _difference(a, b):
    return Derived((a, b), lambda x, y: _blank_as_zero(x) - _blank_as_zero(y))


MEASURES: dict[str, Base | Derived] = {
    # Financial
    "total_revenue": _sum(TRIPS, "total_revenue"),
    "freight_revenue": _sum(TRIPS, "freight_revenue"),
    "fuel_surcharge_revenue": _sum(TRIPS, "fuel_surcharge"),
    "accessorial_revenue": _sum(TRIPS, "accessorial_charges"),
    "total_fuel_expense": _sum(FUEL, "total_cost"),
    "total_maintenance_expense": _sum(MAINTENANCE, "total_cost"),
    "total_operating_cost": _total("total_fuel_expense", "total_maintenance_expense"),
    "operating_margin": _difference("total_revenue", "total_operating_cost"),
    "operating_margin_pct": _ratio("operating_margin", "total_revenue"),
    "revenue_per_mile": _ratio("total_revenue", "total_miles_driven"),
    "cost_per_mile": _ratio("total_operating_cost", "total_miles_driven"),
    "net_margin_per_mile": _difference("revenue_per_mile", "cost_per_mile"),
    "average_revenue_per_trip": _ratio("total_revenue", "total_trips"),
    # Fleet
    "total_trips": _rows(TRIPS),
    "total_miles_driven": _sum(TRIPS, "actual_distance_miles"),
    "average_trip_distance": _avg(TRIPS, "actual_distance_miles"),
    "average_trip_duration": _avg(TRIPS, "actual_duration_hours"),
    "trip_hours": _sum(TRIPS, "actual_duration_hours"),
    "trip_gallons": _sum(TRIPS, "fuel_gallons_used"),
    "average_transit_speed": _ratio("total_miles_driven", "trip_hours"),
    "fleet_mpg": _ratio("total_miles_driven", "trip_gallons"),
    "total_fuel_gallons": _sum(FUEL, "gallons"),
    "average_fuel_price": _ratio("total_fuel_expense", "total_fuel_gallons"),
    "active_truck_count": _values(TRIPS, "truck_id"),
    "fleet_utilization_pct": _avg(UTILIZATION, "utilization_rate"),
    "maintenance_downtime_hours": _sum(MAINTENANCE, "downtime_hours"),
    "maintenance_events": _rows(MAINTENANCE),
    # Service level
    "total_delivery_events": _rows(EVENTS),
    "on_time_deliveries": _rows_where(EVENTS, "on_time_flag", lambda c: c),
    # A blank flag equals FALSE here.
    "delayed_deliveries": _rows_where(
        EVENTS, "on_time_flag", lambda c: ~F.coalesce(c, F.lit(False))),
    "on_time_delivery_rate": _ratio("on_time_deliveries", "total_delivery_events"),
    "total_detention_minutes": _sum(EVENTS, "detention_minutes"),
    "average_detention_per_stop": _avg(EVENTS, "detention_minutes"),
    "severe_detention_incidents": _rows_where(EVENTS, "detention_minutes", lambda c: c > 120),
    # Safety
    "active_driver_count": _values(TRIPS, "driver_id"),
    "total_safety_incidents": _rows(SAFETY),
    "preventable_incidents": _rows_where(SAFETY, "preventable_flag", lambda c: c),
    "preventable_incident_rate": _ratio("preventable_incidents", "total_safety_incidents"),
    "at_fault_incidents": _rows_where(SAFETY, "at_fault_flag", lambda c: c),
    "incidents_per_100k_miles": _ratio(
        "total_safety_incidents", "total_miles_driven", 100000.0),
    "vehicle_damage": _sum(SAFETY, "vehicle_damage_cost"),
    "cargo_damage": _sum(SAFETY, "cargo_damage_cost"),
    "claims": _sum(SAFETY, "claim_amount"),
    "total_damage_and_claim_cost": _total("vehicle_damage", "cargo_damage", "claims"),
    # Governance
    "records_ingested": _sum(AUDIT, "records_in"),
    "records_validated": _sum(AUDIT, "records_out"),
    "records_quarantined": _sum(AUDIT, "records_quarantined"),
    "rejection_rate": _ratio("records_quarantined", "records_ingested"),
    "overall_dq_score": _avg(METRICS, "data_quality_score_pct"),
    "pipeline_seconds": _sum(AUDIT, "duration_seconds"),
    "pipeline_duration_minutes": Derived(
        ("pipeline_seconds",), lambda s: divide_or_zero(s, F.lit(60.0))),
}

FOLDERS: dict[str, tuple[str, ...]] = {
    "financial": (
        "total_revenue", "freight_revenue", "fuel_surcharge_revenue", "accessorial_revenue",
        "total_fuel_expense", "total_maintenance_expense", "total_operating_cost",
        "operating_margin", "operating_margin_pct", "revenue_per_mile", "cost_per_mile",
        "net_margin_per_mile", "average_revenue_per_trip"),
    "fleet": (
        "total_trips", "total_miles_driven", "average_trip_distance", "average_trip_duration",
        "average_transit_speed", "fleet_mpg", "total_fuel_gallons", "average_fuel_price",
        "active_truck_count", "fleet_utilization_pct", "maintenance_downtime_hours",
        "maintenance_events"),
    "service": (
        "total_delivery_events", "on_time_deliveries", "delayed_deliveries",
        "on_time_delivery_rate", "total_detention_minutes", "average_detention_per_stop",
        "severe_detention_incidents"),
    "safety": (
        "active_driver_count", "total_safety_incidents", "preventable_incidents",
        "preventable_incident_rate", "at_fault_incidents", "incidents_per_100k_miles",
        "total_damage_and_claim_cost"),
    "governance": (
        "records_ingested", "records_validated", "records_quarantined", "rejection_rate",
        "overall_dq_score", "pipeline_duration_minutes"),
}

# Date column a fact is sliced by unless the context names another.
DATE_COLUMN = {
    TRIPS: "dispatch_date", FUEL: "purchase_date", MAINTENANCE: "maintenance_date",
    EVENTS: "event_date", SAFETY: "incident_date", UTILIZATION: "month",
}


@dataclass(frozen=True)
class Context:
    """What to group by.

    ``periods`` maps an output column to a function of the fact's date; ``attributes`` maps
    an output column to (dimension, column); ``columns`` are columns all facts share.
    ``date_columns`` replaces the date of a fact, e.g. load date for trips. An attribute of a
    dimension with history is that of the current version, or, if named in ``at_event``, that of
    the version valid on the fact's date.
    """

    periods: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    attributes: dict[str, tuple[str, str]] = field(default_factory=dict)
    columns: tuple[str, ...] = ()
    date_columns: dict[str, str] = field(default_factory=dict)
    at_event: frozenset[str] = frozenset()

    @property
    def keys(self) -> list[str]:
        return [*self.periods, *self.attributes, *self.columns]


def year_of(day: Column) -> Column:
    return F.year(day).cast("bigint")


PERIODS = {"year": year_of, "month": month_start, "date": F.to_date}


def base_measures(names: list[str]) -> list[str]:
    """Base measures that ``names`` rest on, each once, in first-use order."""
    found: dict[str, None] = {}
    pending = list(reversed(names))
    while pending:
        name = pending.pop()
        measure = MEASURES[name]
        if isinstance(measure, Base):
            found.setdefault(name)
        else:
            pending.extend(reversed(measure.inputs))
    return list(found)


def measure_column(name: str) -> Column:
    """Expression of a measure over the aggregated base columns."""
    measure = MEASURES[name]
    if isinstance(measure, Base):
        return F.col(name)
    return measure.build(*[measure_column(i) for i in measure.inputs])


def one_per_key(dim: DataFrame, table: str, key: str, attributes: dict[str, str]) -> DataFrame:
    """The attributes (name: column) of each key; of a dimension with history, of its current rows. A key
    with several rows would count facts twice, so it is an error when the query runs."""
    current = F.col("is_current") if "is_current" in dim.columns else F.lit(True)
    several = F.concat(F.lit(f"{table} has several rows of {key} "), F.col("_ctx_key").cast("string"))
    return (dim.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_ctx_key"))
            .agg(F.count_if(current).alias("_n"),
                 *[F.max(F.when(current, F.col(column))).alias(name) for name, column in attributes.items()])
            .select("_ctx_key", *[F.when(F.col("_n") > 1, F.raise_error(several)).otherwise(F.col(name)).alias(name)
                                  for name in attributes]))


def in_context(fact_name: str, fact: DataFrame, context: Context,
               dims: dict[str, DataFrame]) -> DataFrame:
    """The fact with the context's key columns, dimension attributes looked up."""
    date_column = context.date_columns.get(fact_name, DATE_COLUMN.get(fact_name))
    base = fact
    for name, (dim, column) in context.attributes.items():
        link = registry.relationship(fact_name, dim)
        fact = fact.withColumn("_ctx_key", F.col(link.fact_key)).drop(
            *([name] if name in fact.columns else []))
        if name in context.at_event:
            versions = dims[dim].withColumn("_ctx_key", F.col(link.dim_key))
            fact = version_at(fact, versions, "_ctx_key", date_column, {name: column}).drop("_ctx_key")
            continue
        fact = lookup_join(fact, one_per_key(dims[dim], dim, link.dim_key, {name: column}), on=["_ctx_key"],
            keys_from=base.select(F.col(link.fact_key).alias("_ctx_key"))).drop("_ctx_key")
    return fact.withColumns({n: f(F.col(date_column)) for n, f in context.periods.items()}) \
        if context.periods else fact


def evaluate(names: list[str], facts: dict[str, DataFrame], context: Context = Context(),
             dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """Evaluate measures per context group; one row when the context is empty."""
    keys = context.keys
    bases = base_measures(names)
    per_fact = []
    for fact_name in dict.fromkeys(MEASURES[b].fact for b in bases):
        fact = in_context(fact_name, facts[fact_name], context, dims or {})
        per_fact.append(fact.groupBy(*keys).agg(*[
            MEASURES[b].build().alias(b) for b in bases if MEASURES[b].fact == fact_name]))
    combined = per_fact[0]
    if len(per_fact) > 1:
        # Each base column is filled by one fact only; max picks it. Null keys group together.
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), per_fact)
        combined = stacked.groupBy(*keys).agg(*[F.max(b).alias(b) for b in bases])
    return combined.select(*keys, *[measure_column(n).alias(n) for n in names])


def revenue_by_load_date(fact_trips: DataFrame, period: str = "month") -> DataFrame:
    """Revenue by load date instead of dispatch date."""
    context = Context(periods={period: PERIODS[period]}, date_columns={TRIPS: "load_date"})
    return evaluate(["total_revenue"], {TRIPS: fact_trips}, context)
