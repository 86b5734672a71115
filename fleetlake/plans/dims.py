"""Gold dimensions built from typed Silver tables."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetlake.functions.casting import conform
from fleetlake.operators.scd2 import scd2_initial, scd2_merge
from fleetlake.operators.surrogate import dense_key

CALENDAR_YEARS = (2020, 2026)
DRIVER_TRACKED = ["employment_status", "termination_date"]

# Silver source, business key and surrogate key of each plain dimension.
SNAPSHOT_DIMS = {
    "dim_customer": ("customers", "customer_id", "customer_sk"),
    "dim_truck": ("trucks", "truck_id", "truck_sk"),
    "dim_trailer": ("trailers", "trailer_id", "trailer_sk"),
    "dim_facility": ("facilities", "facility_id", "facility_sk"),
    "dim_route": ("routes", "route_id", "route_sk"),
}


def calendar_columns(day: Column) -> list[Column]:
    weekday = (F.weekday(day) + 1).cast("bigint")
    return [
        F.date_format(day, "yyyyMMdd").cast("bigint").alias("date_key"),
        day.alias("full_date"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        F.month(day).cast("bigint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.year(day).cast("bigint").alias("year"),
        weekday.isin(6, 7).alias("is_weekend"),
    ]


def calendar(spark: SparkSession, start_year: int = CALENDAR_YEARS[0],
             end_year: int = CALENDAR_YEARS[1]) -> DataFrame:
    """One row per day of the years, Monday = 1."""
    days = spark.range(1).select(F.explode(F.sequence(
        F.lit(datetime.date(start_year, 1, 1)), F.lit(datetime.date(end_year, 12, 31)))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def calendar_spanning(df: DataFrame, date_column: str) -> DataFrame:
    """Calendar of every whole year that ``date_column`` touches."""
    span = df.agg(F.min(F.to_date(date_column)).alias("lo"), F.max(F.to_date(date_column)).alias("hi"))
    days = span.select(F.explode(F.sequence(
        F.trunc("lo", "YYYY"), F.make_date(F.year("hi"), F.lit(12), F.lit(31)))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def snapshot_dim(name: str, silver: DataFrame) -> DataFrame:
    """Plain dimension: the batch's rows numbered 1..n by business key."""
    _, key, sk = SNAPSHOT_DIMS[name]
    return conform(dense_key(silver, [key], sk).withColumn("_created_at", F.current_timestamp()), name)


def dim_driver(silver: DataFrame, existing: DataFrame | None = None,
               as_of: datetime.date | None = None,
               tracked: list[str] | None = None) -> DataFrame:
    """Driver dimension with history. Without ``existing`` it is a first load."""
    as_of = as_of or datetime.datetime.now(datetime.timezone.utc).date()
    incoming = silver.withColumns({
        "full_name": F.concat(F.coalesce("first_name", F.lit("")), F.lit(" "),
                              F.coalesce("last_name", F.lit(""))),
        "_created_at": F.current_timestamp()})
    if existing is None:
        return conform(scd2_initial(incoming, "driver_id", "driver_sk", "hire_date"), "dim_driver")
    merged = scd2_merge(existing, incoming, "driver_id", "driver_sk",
                        tracked or DRIVER_TRACKED, as_of, "hire_date")
    return conform(merged, "dim_driver")
