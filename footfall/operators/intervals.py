"""Interval join by day: points against intervals, without comparing every point with every interval.

The time axis is cut in bins of a few days. A point lies in one bin, an interval is listed once for each bin that it
touches, the join is an equi join on the bin, and the exact test then drops the points beside the interval. Any
intervals will do: overlapping ones, of any width, starting on any day.

A point meets the intervals that touch its bin, so bins about a quarter as wide as the intervals keep both the
copies of intervals and the pairs that the test drops small. Neither side is broadcast here; a bin that holds many points is
one that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_DAYS = 32
_BIN = "_bin"


def day_bin(day: Column, bin_days: int) -> Column:
    return F.floor(F.unix_date(day) / bin_days)


def binned_intervals(intervals: DataFrame, start: str, end: str, bin_days: int = BIN_DAYS) -> DataFrame:
    """Each interval [start, end] once for every bin that it touches; an interval that ends before it starts, or has
    a NULL bound, touches none."""
    bins = F.sequence(day_bin(F.col(start), bin_days), day_bin(F.col(end), bin_days))
    return intervals.withColumn(_BIN, F.explode(F.when(F.col(start) <= F.col(end), bins)))


def interval_join(points: DataFrame, day: str, intervals: DataFrame, start: str, end: str,
                  bin_days: int = BIN_DAYS) -> DataFrame:
    """Every pair of a row of ``points`` and a row of ``intervals`` with start <= day <= end. Column names of the two
    sides must differ. A NULL day is in no interval."""
    binned = points.withColumn(_BIN, day_bin(F.col(day), bin_days))
    return (
        binned.join(binned_intervals(intervals, start, end, bin_days), _BIN)
        .where(F.col(day).between(F.col(start), F.col(end)))
        .drop(_BIN)
    )
