"""Period comparisons. Rows are aggregated to days or months first."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window, functions as F

from fleetlake.functions.text import divide_or_zero, month_start
from fleetlake.plans.measures import MEASURES, PERIODS, Context, base_measures, evaluate, measure_column


def daily(fact: DataFrame, date_column: str, value: str) -> DataFrame:
    return fact.groupBy(F.to_date(date_column).alias("full_date")).agg(F.sum(value).alias("revenue"))


def monthly(fact: DataFrame, date_column: str, value: str) -> DataFrame:
    return fact.groupBy(month_start(date_column).alias("month")).agg(F.sum(value).alias("revenue"))


def year_to_date(calendar: DataFrame, fact: DataFrame, date_column: str = "dispatch_date",
                 value: str = "total_revenue") -> DataFrame:
    """Running revenue of the year on every calendar day, days without revenue included.

    The window holds one row per day of one year, however many fact rows there are.
    """
    days = calendar.select("full_date", "year").join(
        daily(fact, date_column, value), "full_date", "left")
    running = (Window.partitionBy("year").orderBy("full_date")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return days.select("full_date", "year", "revenue",
                       F.sum("revenue").over(running).alias("revenue_ytd"))


def _compared(periods: DataFrame, totals: DataFrame, key: str, shift_months: int,
              name: str, growth: str) -> DataFrame:
    """Every period with its revenue, that of ``shift_months`` before, and the growth.

    Matching is by date, not by row order: periods without revenue stay in place.
    """
    before = totals.select(F.col(key).alias("_before"), F.col("revenue").alias(name))
    joined = periods.join(totals, key, "left").join(
        before, F.add_months(F.col(key), -shift_months) == F.col("_before"), "left").drop("_before")
    change = F.coalesce(F.col("revenue"), F.lit(0.0)) - F.coalesce(F.col(name), F.lit(0.0))
    return joined.withColumn(growth, divide_or_zero(change, F.col(name)))


def prior_year(calendar: DataFrame, fact: DataFrame, date_column: str = "dispatch_date",
               value: str = "total_revenue") -> DataFrame:
    """Per calendar day: revenue, revenue of the same date last year, growth (0 without a base).

    29 February compares with 28 February.
    """
    return _compared(calendar.select("full_date"), daily(fact, date_column, value), "full_date",
                     12, "revenue_prior_year", "yoy_growth_pct")


def prior_year_monthly(calendar: DataFrame, fact: DataFrame, date_column: str = "dispatch_date",
                       value: str = "total_revenue") -> DataFrame:
    months = calendar.select(month_start("full_date").alias("month")).distinct()
    return _compared(months, monthly(fact, date_column, value), "month",
                     12, "revenue_prior_year", "yoy_growth_pct")


def previous_month(calendar: DataFrame, fact: DataFrame, date_column: str = "dispatch_date",
                   value: str = "total_revenue") -> DataFrame:
    """Per calendar month: revenue, revenue of the month before, growth (0 without a base)."""
    months = calendar.select(month_start("full_date").alias("month")).distinct()
    return _compared(months, monthly(fact, date_column, value), "month",
                     1, "revenue_previous_month", "mom_growth_pct")


def compared(measure: str, facts: dict[str, DataFrame], context: Context, dims: dict[str, DataFrame] | None = None,
             months_before: int = 1) -> DataFrame:
    """Any measure per context group and month, the month ``months_before`` earlier, and the growth.

    Every group and month with a value on either side is a row; no calendar is crossed with the
    groups. The shifted totals are laid beside the totals by one more grouping.
    """
    keys = [*context.keys, "month"]
    totals = evaluate([measure], facts, replace(context, periods={**context.periods, "month": PERIODS["month"]}), dims)
    moved = totals.select(*context.keys, F.add_months("month", months_before).alias("month"),
                          F.col(measure).alias(f"{measure}_before"))
    both = totals.unionByName(moved, allowMissingColumns=True).groupBy(*keys).agg(
        F.max(measure).alias(measure), F.max(f"{measure}_before").alias(f"{measure}_before"))
    change = F.coalesce(F.col(measure), F.lit(0.0)) - F.coalesce(F.col(f"{measure}_before"), F.lit(0.0))
    return both.withColumn(f"{measure}_growth_pct", divide_or_zero(change, F.col(f"{measure}_before")))


def year_to_date_in(measure: str, facts: dict[str, DataFrame], context: Context,
                    dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """A measure and its value over the year up to each day, per context group.

    The sums it rests on run over the days and the measure is taken of the running sums, so a ratio
    is one of sums. Averages and distinct counts do not add up over days: a measure that rests on one
    is refused. A window holds one group's days of one year: 366 rows at most. Days without a value
    keep the row they have.
    """
    bases = base_measures([measure])
    wrong = [b for b in bases if MEASURES[b].kind != "sum"]
    if wrong:
        raise ValueError(f"{measure} rests on {wrong}, which do not add up over days")
    context = replace(context, periods={**context.periods, "date": PERIODS["date"]})
    totals = evaluate(list(dict.fromkeys([measure, *bases])), facts, context, dims)
    running = (Window.partitionBy(*[k for k in context.keys if k != "date"], F.year("date")).orderBy("date")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ran = totals.select(*context.keys, F.col(measure).alias("_day"), *[F.sum(b).over(running).alias(b) for b in bases])
    return ran.select(*context.keys, F.col("_day").alias(measure), measure_column(measure).alias(f"{measure}_ytd"))
