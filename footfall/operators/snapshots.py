"""Snapshot calendars.

A monthly snapshot S (a first of month) covers [S - w months, S - 1 day]; other calendars have snapshots on any day and
windows of any number of days. The calendar states the interval of each snapshot and is the only place that
knows its width. What lies in an interval is found by ``operators.intervals`` and ``operators.sliding``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT = "snapshot_stdr_de"
INTERVAL_START = "interval_start_de"
INTERVAL_END = "interval_end_de"


def _first_month_on_or_after(d: Column) -> Column:
    return F.when(F.dayofmonth(d) == 1, d).otherwise(F.add_months(F.trunc(d, "MM"), 1))


def _calendar_rows(bounds: DataFrame, months: int) -> DataFrame:
    """bounds has columns (_from, _to) dates: month starts S in [_from, _to] with their intervals."""
    s, first = F.col(SNAPSHOT), _first_month_on_or_after(F.col("_from"))
    # a range without a month start has no rows (a sequence would run backwards)
    starts = F.when(first <= F.col("_to"), F.sequence(first, F.col("_to"), F.expr("INTERVAL 1 MONTH")))
    return bounds.select(F.explode(starts).alias(SNAPSHOT)).select(
        s,
        F.add_months(s, -months).alias(INTERVAL_START),
        F.date_sub(s, 1).alias(INTERVAL_END),
    )


def snapshot_calendar(spark: SparkSession, start_de: str, end_de: str, months: int = 12) -> DataFrame:
    """Month starts in [start_de, end_de] (like a month-start date range) with their trailing interval.

    Its size is the number of months between the two parameters, never the data,
    so it is safe to broadcast.
    """
    bounds = spark.range(1).select(F.to_date(F.lit(start_de)).alias("_from"), F.to_date(F.lit(end_de)).alias("_to"))
    return _calendar_rows(bounds, months)


def calendar_from_dates(df: DataFrame, date_col: str, months: int = 12) -> DataFrame:
    """Calendar spanning the data: from the first month with a date to the last snapshot whose window holds one."""
    bounds = df.agg(
        F.trunc(F.min(date_col), "MM").alias("_from"),
        F.add_months(F.trunc(F.max(date_col), "MM"), months).alias("_to"),
    )
    return _calendar_rows(bounds, months)


def day_calendar(spark: SparkSession, first_de: str, last_de: str, step: str = "1 MONTH", width_days: int = 90) -> DataFrame:
    """Snapshots from ``first_de`` on, every ``step``, up to ``last_de``, each covering the ``width_days`` days before it."""
    days = F.sequence(F.to_date(F.lit(first_de)), F.to_date(F.lit(last_de)), F.expr(f"INTERVAL {step}"))
    starts = F.when(F.to_date(F.lit(first_de)) <= F.to_date(F.lit(last_de)), days)
    return spark.range(1).select(F.explode(starts).alias(SNAPSHOT)).select(
        SNAPSHOT, F.date_sub(SNAPSHOT, width_days).alias(INTERVAL_START), F.date_sub(SNAPSHOT, 1).alias(INTERVAL_END))


def attach_calendar(calendar: DataFrame, per_snapshot: DataFrame) -> DataFrame:
    """Left join from the calendar so empty snapshots stay as rows with NULL measures.

    ``per_snapshot`` holds at most one row per calendar snapshot, so it is bounded
    by the calendar parameters and is the side to broadcast.
    """
    return calendar.join(F.broadcast(per_snapshot), SNAPSHOT, "left")


def month_bounds(df: DataFrame, date_col: str) -> DataFrame:
    """(year, month, first_date, last_date) yyyyMMdd for every month of each year present in the data."""
    years = df.select(F.year(date_col).alias("year")).distinct()
    first = F.make_date(F.col("year"), F.col("month"), F.lit(1))
    return (
        years.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
        .select(
            F.col("year").cast("int").alias("year"),
            F.col("month").cast("int").alias("month"),
            F.date_format(first, "yyyyMMdd").alias("first_date"),
            F.date_format(F.last_day(first), "yyyyMMdd").alias("last_date"),
        )
    )
