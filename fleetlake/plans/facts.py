"""Gold facts and marts built from typed Silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlake.functions.casting import conform
from fleetlake.operators.joins import lookup_join


def _publish(df: DataFrame, table: str, batch_id: str | None) -> DataFrame:
    """Stamp batch and time, then project to the Gold contract.

    ``batch_id=None`` keeps the batch column the rows already have (several batches at once).
    """
    if batch_id is not None:
        df = df.withColumn("batch_id", F.lit(batch_id))
    return conform(df.withColumn("_gold_published_at", F.current_timestamp()), table)


def _amount(df: DataFrame, column: str) -> Column:
    return F.coalesce(F.col(column).try_cast("double"), F.lit(0.0)) if column in df.columns \
        else F.lit(0.0)


def fact_trips(trips: DataFrame, loads: DataFrame, batch_id: str | None,
               limit: int | None = None) -> DataFrame:
    """Trips with the load they carry; revenue is freight + surcharge + accessorials.

    ``load_id`` is unique on the load side. Only trips and loads of one batch meet when
    both inputs are of one batch.
    """
    joined = lookup_join(trips, _of_load(loads), on=["load_id"], how="inner", limit=limit)
    return _priced(joined, batch_id)


def fact_trips_bucketed(trips: DataFrame, loads: DataFrame, batch_id: str | None) -> DataFrame:
    """``fact_trips`` of tables that lie in equal buckets of ``load_id``: the join is planned on that
    layout and merges bucket by bucket."""
    return _priced(trips.hint("merge").join(_of_load(loads).hint("merge"), "load_id"), batch_id)


def _of_load(loads: DataFrame) -> DataFrame:
    return loads.select(*[c for c in (
        "load_id", "customer_id", "route_id", "load_date", "load_type", "booking_type", "load_status", "weight_lbs",
        "pieces", "revenue", "fuel_surcharge", "accessorial_charges") if c in loads.columns])


def _priced(joined: DataFrame, batch_id: str | None) -> DataFrame:
    freight, surcharge, accessorial = (
        _amount(joined, c) for c in ("revenue", "fuel_surcharge", "accessorial_charges"))
    priced = joined.withColumns({
        "freight_revenue": freight, "fuel_surcharge": surcharge,
        "accessorial_charges": accessorial.cast("bigint"),
        "total_revenue": freight + surcharge + accessorial})
    return _publish(priced, "fact_trips", batch_id)


def fact_delivery_events(events: DataFrame, batch_id: str | None) -> DataFrame:
    return _publish(events.withColumn("event_date", F.to_date("scheduled_datetime")),
                    "fact_delivery_events", batch_id)


def fact_fuel_purchases(fuel: DataFrame, batch_id: str | None) -> DataFrame:
    split = fuel.withColumn("purchase_datetime", F.col("purchase_date")).withColumn(
        "purchase_date", F.to_date("purchase_date"))
    return _publish(split, "fact_fuel_purchases", batch_id)


def fact_maintenance(maintenance: DataFrame, batch_id: str | None) -> DataFrame:
    return _publish(maintenance.withColumn("maintenance_date", F.to_date("maintenance_date")),
                    "fact_maintenance", batch_id)


def fact_safety_incidents(incidents: DataFrame, batch_id: str | None) -> DataFrame:
    split = incidents.withColumn("incident_datetime", F.col("incident_date")).withColumn(
        "incident_date", F.to_date("incident_date"))
    return _publish(split, "fact_safety_incidents", batch_id)


def driver_monthly_performance(metrics: DataFrame, batch_id: str | None) -> DataFrame:
    return _publish(metrics.withColumn("month", F.to_date("month")),
                    "agg_driver_monthly_performance", batch_id)


def truck_utilization_performance(metrics: DataFrame, batch_id: str | None) -> DataFrame:
    return _publish(metrics.withColumn("month", F.to_date("month")),
                    "agg_truck_utilization_performance", batch_id)


# Builder and Silver sources of each single-source Gold table.
SINGLE_SOURCE = {
    "fact_delivery_events": (fact_delivery_events, "delivery_events"),
    "fact_fuel_purchases": (fact_fuel_purchases, "fuel_purchases"),
    "fact_maintenance": (fact_maintenance, "maintenance_records"),
    "fact_safety_incidents": (fact_safety_incidents, "safety_incidents"),
    "agg_driver_monthly_performance": (driver_monthly_performance, "driver_monthly_metrics"),
    "agg_truck_utilization_performance": (
        truck_utilization_performance, "truck_utilization_metrics"),
}
