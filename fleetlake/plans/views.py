"""The eight reporting views, as DataFrame functions over Gold and audit tables.

Facts are aggregated before they meet a dimension, so a shuffle carries groups, not rows.
Division by zero gives null here (measures give 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlake.functions.text import month_start, safe_divide
from fleetlake.operators.joins import lookup_join
from fleetlake.operators.scd2 import current_rows

SEVERE_DETENTION_MINUTES = 120


def _picked(dim: DataFrame, key: str, names: dict[str, str]) -> DataFrame:
    """Dimension columns under their view names, with a join copy of the key."""
    return dim.select(F.col(key).alias("_key"), *[F.col(s).alias(n) for n, s in names.items()])


def _with_dim(joined: DataFrame, dim: DataFrame, key: str, names: dict[str, str],
              fact: DataFrame, joined_key: str | None = None) -> DataFrame:
    """Look up ``dim`` for rows of ``joined``; hot keys are found on ``fact``, where it began."""
    keyed = joined.withColumn("_key", F.col(joined_key or key))
    return lookup_join(keyed, _picked(dim, key, names), on=["_key"], how="left",
                       keys_from=fact.select(F.col(key).alias("_key"))).drop("_key")


def _lane() -> Column:
    return F.concat(F.col("origin_city"), F.lit(", "), F.col("origin_state"), F.lit(" -> "),
                    F.col("destination_city"), F.lit(", "), F.col("destination_state"))


# -------------------------------------------------------------------- business
def trip_details(fact_trips: DataFrame, dim_customer: DataFrame, dim_driver: DataFrame,
                 dim_truck: DataFrame, dim_trailer: DataFrame, dim_route: DataFrame) -> DataFrame:
    """One row per trip. Ids come from the dimension side: null where nothing matches."""
    measures = [
        "trip_id", "load_id", "dispatch_date", "load_date", "load_type", "booking_type",
        "load_status", "trip_status", "weight_lbs", "pieces", "actual_distance_miles",
        "actual_duration_hours", "fuel_gallons_used", "average_mpg", "idle_time_hours",
        "freight_revenue", "fuel_surcharge", "accessorial_charges", "total_revenue", "batch_id"]
    keys = ["customer_id", "driver_id", "truck_id", "trailer_id", "route_id"]
    t = fact_trips.select(*measures, *[F.col(k).alias(f"_fk_{k}") for k in keys])
    t = _with_dim(t, dim_customer, "customer_id", {
        "customer_id": "customer_id", "customer_name": "customer_name",
        "customer_type": "customer_type", "primary_freight_type": "primary_freight_type",
        "customer_account_status": "account_status"}, fact_trips, "_fk_customer_id")
    t = _with_dim(t, current_rows(dim_driver), "driver_id", {
        "driver_id": "driver_id", "driver_name": "full_name",
        "driver_home_terminal": "home_terminal", "driver_status": "employment_status",
        "driver_years_experience": "years_experience"}, fact_trips, "_fk_driver_id")
    t = _with_dim(t, dim_truck, "truck_id", {
        "truck_id": "truck_id", "truck_unit_number": "unit_number", "truck_make": "make",
        "truck_model_year": "model_year", "fuel_type": "fuel_type"}, fact_trips, "_fk_truck_id")
    t = _with_dim(t, dim_trailer, "trailer_id", {
        "trailer_id": "trailer_id", "trailer_type": "trailer_type",
        "trailer_length_feet": "length_feet"}, fact_trips, "_fk_trailer_id")
    t = _with_dim(t, dim_route, "route_id", {
        c: c for c in ("route_id", "origin_city", "origin_state", "destination_city",
                       "destination_state", "typical_distance_miles", "base_rate_per_mile",
                       "typical_transit_days")}, fact_trips, "_fk_route_id")
    miles = F.col("actual_distance_miles")
    return t.withColumns({
        "route_lane_name": _lane(),
        "revenue_per_mile": safe_divide(F.col("total_revenue"), miles),
        "fuel_gallons_per_mile": safe_divide(F.col("fuel_gallons_used"), miles),
        "average_speed_mph": safe_divide(miles, F.col("actual_duration_hours")),
        "route_variance_miles": miles - F.col("typical_distance_miles"),
    }).drop(*[f"_fk_{k}" for k in keys])


def monthly_fleet_metrics(utilization: DataFrame, dim_truck: DataFrame, fuel: DataFrame,
                          maintenance: DataFrame) -> DataFrame:
    """One row per truck and month of the utilisation mart, with fuel and service cost."""
    monthly_fuel = fuel.groupBy("truck_id", month_start("purchase_date").alias("month")).agg(
        F.sum("gallons").alias("_fuel_gallons"), F.sum("total_cost").alias("_fuel_cost"))
    monthly_service = maintenance.groupBy(
        "truck_id", month_start("maintenance_date").alias("month")).agg(
        F.countDistinct("maintenance_id").alias("_services"),
        F.sum("labor_cost").alias("_labor"), F.sum("parts_cost").alias("_parts"),
        F.sum("total_cost").alias("_service_cost"), F.sum("downtime_hours").alias("_downtime"))
    u = utilization.select(
        "truck_id", "month", "trips_completed", "total_miles", "total_revenue", "average_mpg",
        "utilization_rate", "maintenance_events", "maintenance_cost", "downtime_hours")
    u = _with_dim(u, dim_truck, "truck_id", {
        "unit_number": "unit_number", "make": "make", "model_year": "model_year",
        "truck_status": "status", "home_terminal": "home_terminal"}, utilization)
    # Truck and month are unique on every side: nothing to salt.
    u = u.join(monthly_fuel, ["truck_id", "month"], "left")
    u = u.join(monthly_service, ["truck_id", "month"], "left")

    zero = F.lit(0.0)
    service_cost = F.coalesce("_service_cost", "maintenance_cost", zero)
    fuel_cost = F.coalesce("_fuel_cost", zero)
    cost = fuel_cost + service_cost
    revenue = F.col("total_revenue")
    return u.select(
        "truck_id", "month", "trips_completed", "total_miles", "total_revenue", "average_mpg",
        "utilization_rate", "unit_number", "make", "model_year", "truck_status", "home_terminal",
        F.coalesce("_services", "maintenance_events", F.lit(0)).alias("maintenance_event_count"),
        service_cost.alias("total_maintenance_cost"),
        F.coalesce("_downtime", "downtime_hours", zero).alias("total_downtime_hours"),
        F.coalesce("_labor", zero).alias("total_labor_cost"),
        F.coalesce("_parts", zero).alias("total_parts_cost"),
        F.coalesce("_fuel_gallons", zero).alias("total_fuel_gallons"),
        fuel_cost.alias("total_fuel_cost"),
        F.coalesce(safe_divide(F.col("_fuel_cost"), F.col("_fuel_gallons")), zero)
        .alias("avg_fuel_price_per_gallon"),
        cost.alias("total_operating_cost"),
        (revenue - cost).alias("estimated_operating_margin"),
        safe_divide(revenue - cost, revenue).alias("operating_margin_pct"),
        safe_divide(cost, F.col("total_miles")).alias("cost_per_mile"))


def driver_scorecard(performance: DataFrame, dim_driver: DataFrame,
                     incidents: DataFrame) -> DataFrame:
    """One row per driver and month of the driver mart, with safety counts."""
    safety = incidents.groupBy("driver_id", month_start("incident_date").alias("month")).agg(
        F.count("incident_id").alias("_incidents"),
        F.count_if("preventable_flag").alias("_preventable"),
        F.count_if("at_fault_flag").alias("_at_fault"),
        F.count_if("injury_flag").alias("_injury"),
        F.sum(F.col("vehicle_damage_cost") + F.col("cargo_damage_cost")).alias("_damage"),
        F.sum("claim_amount").alias("_claims"))
    p = performance.select(
        "driver_id", "month", "trips_completed", "total_miles", "total_revenue", "average_mpg",
        "total_fuel_gallons", "on_time_delivery_rate", "average_idle_hours")
    p = _with_dim(p, current_rows(dim_driver), "driver_id", {
        "driver_name": "full_name", "home_terminal": "home_terminal", "cdl_class": "cdl_class",
        "years_experience": "years_experience", "employment_status": "employment_status"}, performance)
    p = p.join(safety, ["driver_id", "month"], "left")
    incidents_n = F.coalesce("_incidents", F.lit(0))
    return p.withColumns({
        "total_incidents": incidents_n,
        "preventable_incidents": F.coalesce("_preventable", F.lit(0)),
        "at_fault_incidents": F.coalesce("_at_fault", F.lit(0)),
        "injury_incidents": F.coalesce("_injury", F.lit(0)),
        "total_damage_cost": F.coalesce("_damage", F.lit(0.0)),
        "total_claim_amount": F.coalesce("_claims", F.lit(0.0)),
        "incidents_per_100k_miles": safe_divide(incidents_n * 100000.0, F.col("total_miles")),
        "avg_revenue_per_trip": safe_divide(F.col("total_revenue"), F.col("trips_completed")),
        "revenue_per_mile": safe_divide(F.col("total_revenue"), F.col("total_miles")),
    }).drop("_incidents", "_preventable", "_at_fault", "_injury", "_damage", "_claims")


def route_profitability(dim_route: DataFrame, fact_trips: DataFrame) -> DataFrame:
    """One row per lane, lanes without trips included."""
    per_route = fact_trips.groupBy("route_id").agg(
        F.count("trip_id").alias("total_trips_run"),
        F.sum("actual_distance_miles").alias("total_miles_driven"),
        F.sum("weight_lbs").alias("total_weight_carried_lbs"),
        F.sum("freight_revenue").alias("total_freight_revenue"),
        F.sum("fuel_surcharge").alias("total_fuel_surcharge"),
        F.sum("total_revenue").alias("total_revenue_generated"),
        F.avg("actual_distance_miles").alias("avg_actual_miles"),
        F.avg("actual_duration_hours").alias("avg_actual_duration_hours"),
        F.avg("average_mpg").alias("avg_lane_mpg"),
        F.avg("idle_time_hours").alias("avg_idle_hours_per_trip"))
    routes = dim_route.select(
        "route_id", "origin_city", "origin_state", "destination_city", "destination_state",
        _lane().alias("route_lane"), "typical_distance_miles", "base_rate_per_mile",
        "typical_transit_days")
    joined = routes.join(per_route, "route_id", "left")
    trips = F.coalesce("total_trips_run", F.lit(0))
    return joined.withColumns({
        "total_trips_run": trips,
        "lane_revenue_per_mile": safe_divide(
            F.col("total_revenue_generated"), F.col("total_miles_driven")),
        "avg_revenue_per_trip": safe_divide(F.col("total_revenue_generated"), trips),
        "avg_lane_mileage_variance": F.col("avg_actual_miles") - F.col("typical_distance_miles")})


def facility_turnaround(dim_facility: DataFrame, events: DataFrame) -> DataFrame:
    """One row per facility and month; a facility without events has one row, month null."""
    per_month = events.groupBy("facility_id", month_start("event_date").alias("month")).agg(
        F.count("event_id").alias("_events"),
        F.count_if(F.col("event_type") == "Pickup").alias("_pickups"),
        F.count_if(F.col("event_type") == "Delivery").alias("_deliveries"),
        F.count_if("on_time_flag").alias("_on_time"),
        F.count_if(~F.col("on_time_flag")).alias("_delayed"),
        F.sum("detention_minutes").alias("total_detention_minutes"),
        F.avg("detention_minutes").alias("avg_detention_minutes_per_visit"),
        F.count_if(F.col("detention_minutes") > SEVERE_DETENTION_MINUTES).alias("_severe"))
    facilities = dim_facility.select(
        "facility_id", "facility_name", "facility_type", "city", "state", "dock_doors",
        "latitude", "longitude")
    joined = facilities.join(per_month, "facility_id", "left")
    zero = F.lit(0)
    return joined.select(
        *facilities.columns, "month",
        F.coalesce("_events", zero).alias("total_events"),
        F.coalesce("_pickups", zero).alias("pickup_events"),
        F.coalesce("_deliveries", zero).alias("delivery_events"),
        F.coalesce("_on_time", zero).alias("on_time_events"),
        F.coalesce("_delayed", zero).alias("delayed_events"),
        (safe_divide(F.col("_on_time"), F.col("_events")) * 100.0).alias("on_time_percentage"),
        "total_detention_minutes", "avg_detention_minutes_per_visit",
        F.coalesce("_severe", zero).alias("severe_detention_count"))


# ------------------------------------------------------------------ governance
def pipeline_run_summary(pipeline_audit: DataFrame) -> DataFrame:
    """One row per batch, stage and status."""
    return pipeline_audit.groupBy("batch_id", "stage", "status").agg(
        F.countDistinct("table_name").alias("tables_processed_count"),
        F.sum("records_in").alias("total_records_in"),
        F.sum("records_out").alias("total_records_out"),
        F.sum("records_quarantined").alias("total_records_quarantined"),
        (safe_divide(F.sum("records_quarantined"), F.sum("records_in")) * 100.0)
        .alias("stage_rejection_rate_pct"),
        F.min("start_time").alias("stage_start_time"),
        F.max("end_time").alias("stage_end_time"),
        F.round(F.sum("duration_seconds"), 2).alias("total_duration_seconds"),
        F.round(F.sum("duration_seconds") / 60.0, 2).alias("total_duration_minutes"))


def table_dq_history(dq_metrics: DataFrame) -> DataFrame:
    """One row per table and batch with a health label at 99, 95 and 80 percent."""
    score = F.col("data_quality_score_pct")
    return dq_metrics.select(
        "batch_id", "table_name", "total_records", "valid_records", "quarantined_records",
        "data_quality_score_pct",
        (safe_divide(F.col("quarantined_records"), F.col("total_records")) * 100.0)
        .alias("rejection_rate_pct"),
        "evaluated_at",
        F.when(score >= 99.0, "EXCELLENT").when(score >= 95.0, "GOOD")
        .when(score >= 80.0, "ACCEPTABLE").otherwise("CRITICAL_BREACH")
        .alias("dq_health_category"))


def quarantine_deep_dive(rejection_log: DataFrame) -> DataFrame:
    """Rejections by batch, table, rule and reason."""
    return rejection_log.groupBy(
        "batch_id", "table_name", "rule_id", "rule_type", "rejection_reason").agg(
        F.count(F.lit(1)).alias("rejection_count"),
        F.min("rejected_at").alias("first_detected_at"),
        F.max("rejected_at").alias("last_detected_at"))
