"""Sliding windows by enter and leave events.

A calendar's snapshots are numbered by their intervals. A day is inside the intervals of consecutive snapshots, so
whatever happens on it enters the window at one snapshot and leaves it at another: an aggregate is added at the first
number and taken off at the second, and a running sum per customer gives its value for every snapshot in between.
Each aggregate is two rows, whatever the number of snapshots that cover it; a customer's values are
pieces that hold from one number to the next, and only what asks for a row per snapshot unfolds them.

Aggregates are made per (customer, enter, leave): days that enter and leave together are one group, months for a
calendar of whole months, shorter runs for other calendars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.operators.intervals import interval_join
from footfall.operators.snapshots import INTERVAL_END, INTERVAL_START, SNAPSHOT

ENTER, LEAVE = "_enter", "_leave"
FROM, TO = "_from", "_to"
_DAY, _NO = "_day", "_no"


def numbered(calendar: DataFrame) -> DataFrame:
    """The calendar with a number per snapshot, from 0, in the order of the intervals. A calendar has one row per
    snapshot: its size follows from its parameters, not from the data."""
    return calendar.withColumn(_NO, F.row_number().over(Window.orderBy(INTERVAL_START, INTERVAL_END, SNAPSHOT)) - 1)


def runs_of_days(calendar: DataFrame) -> DataFrame:
    """(day, enter, leave) for each day inside any interval: it is in the snapshots enter .. leave - 1. An error for
    a calendar where these are not consecutive, which is one whose intervals do not end in the order they start."""
    days = calendar.agg(F.min(INTERVAL_START).alias("a"), F.max(INTERVAL_END).alias("b")).select(
        F.explode(F.when(F.col("a") <= F.col("b"), F.sequence("a", "b"))).alias(_DAY))
    inside = interval_join(days, _DAY, numbered(calendar), INTERVAL_START, INTERVAL_END)
    runs = inside.groupBy(_DAY).agg(F.min(_NO).alias(ENTER), (F.max(_NO) + 1).alias(LEAVE), F.count(F.lit(1)).alias("_n"))
    consecutive = F.col("_n") == F.col(LEAVE) - F.col(ENTER)
    broken = F.raise_error(F.lit("the calendar's intervals must end in the order they start")).cast("int")
    return runs.select(_DAY, F.when(consecutive, F.col(ENTER)).otherwise(broken).alias(ENTER), LEAVE)


def with_runs(df: DataFrame, day: str, calendar: DataFrame) -> DataFrame:
    """Rows of ``df`` whose day is inside an interval, with enter and leave. Broadcast: one row per day of the
    calendar, bounded by its parameters."""
    runs = runs_of_days(calendar).withColumnRenamed(_DAY, day)
    return df.join(F.broadcast(runs), day)


def event(at: Column, **measures: Column) -> Column:
    return F.struct(at.alias(_NO), *[c.cast("long").alias(n) for n, c in measures.items()])


def enter_and_leave(measures: list[str]) -> list[Column]:
    """A group's two events: its measures at enter, the same taken off at leave."""
    return [event(F.col(ENTER), **{m: F.col(m) for m in measures}), event(F.col(LEAVE), **{m: -F.col(m) for m in measures})]


def pieces(groups: DataFrame, key: str, events: list[Column], measures: list[str], members: str) -> DataFrame:
    """(key, from, to, measures): what the running sums of the events' measures are for the snapshots from .. to - 1,
    where the sum of ``members`` is not 0. NULL events are left out.

    A key has at most one row per snapshot here, so its window is bounded by the calendar. Groups are dealt by key
    once, before each becomes two events; the events are then added and run over in place. Their partitions are as many as
    the session's shuffles have: adaptive execution could only merge them by the size of the groups, and what follows
    unfolds them to several times that size."""
    spark = groups.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    groups = groups.repartition(n, key)
    changes = groups.select(key, F.explode(F.filter(F.array(*events), lambda e: e.isNotNull())).alias("_e")).select(key, "_e.*")
    per_number = changes.groupBy(key, _NO).agg(*[F.sum(m).alias(m) for m in measures])
    order = Window.partitionBy(key).orderBy(_NO)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_number.select(
        key, F.col(_NO).alias(FROM), F.lead(_NO).over(order).alias(TO), *[F.sum(m).over(so_far).alias(m) for m in measures]
    ).where(F.col(members) != 0)


def unfolded(held: DataFrame, calendar: DataFrame) -> DataFrame:
    """Pieces as one row for each snapshot that they hold for, with the snapshot's date."""
    dates = numbered(calendar).select(_NO, SNAPSHOT)          # bounded by the calendar's parameters
    each = held.withColumn(_NO, F.explode(F.sequence(F.col(FROM), F.col(TO) - 1))).drop(FROM, TO)
    return each.join(F.broadcast(dates), _NO).drop(_NO)


def totals(held: DataFrame, calendar: DataFrame, measures: list[str]) -> DataFrame:
    """Per snapshot the measures' sums over all pieces and their number (``_keys``), again by events: two rows for each
    piece, added before they are shuffled, then a running sum over the snapshots."""
    ones = held.withColumn("_keys", F.lit(1).cast("long")).withColumnsRenamed({FROM: ENTER, TO: LEAVE})
    names = [*measures, "_keys"]
    changes = ones.select(F.explode(F.array(*enter_and_leave(names))).alias("_e")).select("_e.*")
    per_number = changes.groupBy(_NO).agg(*[F.sum(m).alias(m) for m in names])
    every = numbered(calendar).select(_NO, SNAPSHOT).join(F.broadcast(per_number), _NO, "left")      # one row per snapshot at most
    so_far = Window.orderBy(_NO).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return every.select(SNAPSHOT, *[F.coalesce(F.sum(m).over(so_far), F.lit(0)).alias(m) for m in names])
