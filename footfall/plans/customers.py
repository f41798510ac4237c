"""Customer snapshots from an order fact (cust_id, ordr_de, gds_ordr_gramt, ordr_key).

Q1 monthly movement (new / returning / existing / MAU), Q2 median repurchase
cycle over a trailing year, Q3 spend and frequency quartiles over a trailing year.
Each is one plan over all months: no per-snapshot loop, no driver-side pandas.

Skew: every plan first aggregates to (customer, day) or (customer, run of days) with
map-side partial aggregation, so a customer holding a third of all orders
becomes at most one row per day/run before anything is keyed by customer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from footfall.functions.columns import month_number, month_start, row_sum, ym_text
from footfall.operators.quantiles import exact_percentiles
from footfall.operators.intervals import interval_join
from footfall.operators.sliding import ENTER, LEAVE, enter_and_leave, event, pieces, totals, unfolded, with_runs
from footfall.operators.snapshots import INTERVAL_END, INTERVAL_START, SNAPSHOT, attach_calendar
from footfall.scratch import Scope, scope as own_scope

CUST, DAY, AMOUNT, KEY = "cust_id", "ordr_de", "gds_ordr_gramt", "ordr_key"


def orders_in_range(orders: DataFrame, start_de: str, end_de: str) -> DataFrame:
    """Inclusive date range; pushed to the scan as a filter on the date column."""
    return orders.where(F.col(DAY).between(F.to_date(F.lit(start_de)), F.to_date(F.lit(end_de))))


def read_bounds(orders: DataFrame, start_de: str, end_de: str) -> DataFrame:
    """Key bounds and row count in range (for split reads of a keyed source)."""
    return orders_in_range(orders, start_de, end_de).agg(
        F.min(CUST).alias("min_cust_id"), F.max(CUST).alias("max_cust_id"), F.count(F.lit(1)).alias("n_orders")
    )


# ------------------------------------------------------------------ Q1 movement

def _distinct_months(orders: DataFrame, start_de: str, end_de: str) -> DataFrame:
    return orders_in_range(orders, start_de, end_de).select(CUST, month_start(DAY).alias("ordr_ym_01")).distinct()


def user_months(orders: DataFrame, start_de: str, end_de: str) -> DataFrame:
    """Distinct (customer, month) with orders in range."""
    return _distinct_months(orders, start_de, end_de).withColumn("ordr_ym", ym_text("ordr_ym_01"))


def user_month_gaps(orders: DataFrame, start_de: str, end_de: str) -> DataFrame:
    """Per (customer, month): previous month with orders and the month difference (NULL = first).

    The month text is formatted after the window so the customer shuffle carries only (id, date).
    """
    w = Window.partitionBy(CUST).orderBy("ordr_ym_01")
    prior = F.lag("ordr_ym_01").over(w)
    return _distinct_months(orders, start_de, end_de).select(
        CUST,
        "ordr_ym_01",
        ym_text("ordr_ym_01").alias("ordr_ym"),
        prior.alias("prior_ordr_ym"),
        (month_number("ordr_ym_01") - month_number(prior)).cast("long").alias("ordr_month_diff"),
    )


def user_movement(orders: DataFrame, start_de: str = "1970-01-01", end_de: str = "2022-07-31",
                  returning_after: int = 3) -> DataFrame:
    """Q1: per month, users new (first month), returning (gap >= 3) and existing (gap <= 2), and MAU.

    One conditional aggregation replaces three filtered counts and two full outer joins.
    """
    d = F.col("ordr_month_diff")
    return (
        user_month_gaps(orders, start_de, end_de)
        .groupBy("ordr_ym")
        .agg(
            F.count_if(d.isNull()).alias("new_user"),
            F.count_if(d >= returning_after).alias("returning_user"),
            F.count_if(d < returning_after).alias("existing_user"),
        )
        .withColumn("mau", F.col("new_user") + F.col("returning_user") + F.col("existing_user"))
    )


def outer_join_series(counts: DataFrame, on: str, label: str, value: str, names: list[str]) -> DataFrame:
    """One row for each ``on`` with a column for each named series of the long table ``counts``.

    The series are full-outer-joined one by one, so a month that only one of them has stays; what a
    series lacks is 0.
    """
    series = [counts.where(F.col(label) == name).select(on, F.col(value).alias(name)) for name in names]
    return reduce(lambda a, b: a.join(b, on, "full_outer"), series).na.fill(0, names)


MOVES = ["new_user", "returning_user", "existing_user"]


def user_movement_full_outer(orders: DataFrame, start_de: str = "1970-01-01", end_de: str = "2022-07-31",
                             returning_after: int = 3, scope: Scope | None = None) -> DataFrame:
    """Q1 by joining monthly series: one count for each (month, class), then full outer joins of the classes.

    The counts are a few rows a month; they are a table of ``scope`` so that the orders are read once.
    """
    d = F.col("ordr_month_diff")
    move = F.when(d.isNull(), MOVES[0]).when(d >= returning_after, MOVES[1]).otherwise(MOVES[2])
    counts = user_month_gaps(orders, start_de, end_de).groupBy("ordr_ym", move.alias("_move")).count()
    stored = (scope or own_scope(orders.sparkSession)).table(counts, "moves")
    joined = outer_join_series(stored, "ordr_ym", "_move", "count", MOVES)
    return joined.withColumn("mau", row_sum(MOVES))


# ------------------------------------------------------------------ trailing windows

def trailing_members(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per snapshot: orders and distinct customers inside its window (0 when none), by enter and leave events."""
    groups = with_runs(orders.select(CUST, DAY), DAY, calendar).groupBy(CUST, ENTER, LEAVE).agg(F.count(F.lit(1)).alias("n_orders"))
    held = pieces(groups, CUST, enter_and_leave(["n_orders"]), ["n_orders"], "n_orders")
    per_snap = totals(held, calendar, ["n_orders"]).withColumnRenamed("_keys", "n_users")
    return attach_calendar(calendar, per_snap).na.fill(0, ["n_orders", "n_users"])


def interval_members(orders: DataFrame, calendar: DataFrame, bin_days: int) -> DataFrame:
    """The same by an interval join of customer-days with the calendar, which may be any set of intervals."""
    per_day = orders.groupBy(CUST, DAY).agg(F.count(F.lit(1)).alias("_n"))
    met = interval_join(per_day, DAY, calendar, INTERVAL_START, INTERVAL_END, bin_days)
    per_user = met.groupBy(SNAPSHOT, CUST).agg(F.sum("_n").alias("_n"))
    per_snap = per_user.groupBy(SNAPSHOT).agg(F.sum("_n").alias("n_orders"), F.count(F.lit(1)).alias("n_users"))
    return attach_calendar(calendar, per_snap).na.fill(0, ["n_orders", "n_users"])


# ------------------------------------------------------------------ Q2 repurchase cycle

def customer_days(orders: DataFrame, start_de: str, end_de: str) -> DataFrame:
    """Per (customer, day): orders, first order key, and the previous day with orders (lag over days).

    The lag runs over distinct days of a customer, never over raw orders.
    """
    days = (
        orders_in_range(orders, start_de, end_de)
        .groupBy(CUST, DAY)
        .agg(F.count(F.lit(1)).alias("n_orders"), F.min(KEY).alias("first_key"))
    )
    w = Window.partitionBy(CUST).orderBy(DAY)
    return days.withColumn("prior_day", F.lag(DAY).over(w))


def repurchase_gaps(orders: DataFrame, start_de: str, end_de: str) -> DataFrame:
    """Per order: the previous order's date (ordered by date, then key) and the gap in days.

    Orders without a previous one are dropped. Only the first order of a customer's
    day reaches back to the previous day; later orders that day have gap 0.
    """
    days = customer_days(orders, start_de, end_de).select(CUST, DAY, "first_key", "prior_day")
    prior = F.when(F.col(KEY) == F.col("first_key"), F.col("prior_day")).otherwise(F.col(DAY))
    return (
        orders_in_range(orders, start_de, end_de)
        .select(CUST, KEY, DAY)
        .join(days, [CUST, DAY])
        .select(CUST, KEY, DAY, prior.alias("prior_purchase"))
        .where(F.col("prior_purchase").isNotNull())
        .withColumn("repurchase_cycle", F.datediff(F.col(DAY), F.col("prior_purchase")))
    )


def _repurchase_pieces(orders: DataFrame, calendar: DataFrame, start_de: str, end_de: str, distinct_days: bool) -> DataFrame:
    """Per customer, for runs of snapshots: kept rows, sum of their gaps, gap of the window's first row and the day that
    it reaches back to.

    Per (customer, day) with prior day p and n orders: the rows kept are n (n - 1
    when p is NULL), their gaps sum to datediff(day, p) (0 when p is NULL) and the
    first kept row has that gap. These add up per run of days and, by enter and leave events, per snapshot; the mean
    without the window's first row is (sum - first) / (kept - 1). A run's first row is the window's first one from
    when the run before has left (or it has entered itself) until it leaves, so that is a pair of events too.
    """
    days = customer_days(orders, start_de, end_de)
    n = F.lit(1) if distinct_days else F.col("n_orders")
    has_prior = F.col("prior_day").isNotNull()
    gap = F.coalesce(F.datediff(F.col(DAY), F.col("prior_day")), F.lit(0))
    per_day = days.select(
        CUST, DAY,
        (n - F.when(has_prior, 0).otherwise(1)).alias("_k"),
        gap.alias("_g"),
        # the previous order of the day's first kept row (the same day when p is NULL)
        F.unix_date(F.coalesce(F.col("prior_day"), F.col(DAY))).alias("_fp"),
    ).where(F.col("_k") > 0)
    groups = with_runs(per_day, DAY, calendar).groupBy(CUST, ENTER, LEAVE).agg(
        F.sum("_k").alias("_k"), F.sum("_g").alias("_s"),
        F.min_by("_g", DAY).alias("_first"), F.min_by("_fp", DAY).alias("_first_prior"))
    before = F.lag(LEAVE).over(Window.partitionBy(CUST).orderBy(ENTER, LEAVE))
    groups = groups.withColumn("_since", F.greatest(F.col(ENTER), before))          # greatest skips NULL
    k, s, first, prior = (F.col(c) for c in ("_k", "_s", "_first", "_first_prior"))
    none, leads = F.lit(0), F.col("_since") < F.col(LEAVE)
    return pieces(groups, CUST, [
        event(F.col(ENTER), _k=k, _s=s, _first=none, _first_prior=none),
        F.when(leads, event(F.col("_since"), _k=none, _s=none, _first=first, _first_prior=prior)),
        event(F.col(LEAVE), _k=-k, _s=-s, _first=F.when(leads, -first).otherwise(0), _first_prior=F.when(leads, -prior).otherwise(0)),
    ], ["_k", "_s", "_first", "_first_prior"], "_k")


def _repurchase_means(held: DataFrame, calendar: DataFrame, drop_first: bool) -> DataFrame:
    per_user = unfolded(held, calendar)
    if drop_first:
        drop = F.lit(True)
    else:
        per_user = per_user.join(F.broadcast(calendar.select(SNAPSHOT, INTERVAL_START)), SNAPSHOT)
        drop = F.col("_first_prior") < F.unix_date(INTERVAL_START)
    kept = F.col("_k") - F.when(drop, 1).otherwise(0)
    total = F.col("_s") - F.when(drop, F.col("_first")).otherwise(0)
    return per_user.where(kept > 0).select(
        SNAPSHOT, CUST, (total.cast("double") / kept.cast("double")).alias("user_repurchase_cycle_avg"),
    )


def user_repurchase(orders: DataFrame, calendar: DataFrame, start_de: str, end_de: str,
                    distinct_days: bool = False, drop_first: bool = True) -> DataFrame:
    """Per (snapshot, customer): mean gap of the customer's orders in the window, its first one left out.

    ``drop_first=False`` drops the window's first row only when its gap reaches back
    before the window start (a customer whose first order falls inside the window
    keeps all its gaps); ``distinct_days=True`` counts same-day repeats once.
    """
    return _repurchase_means(_repurchase_pieces(orders, calendar, start_de, end_de, distinct_days), calendar, drop_first)


def repurchase_median(orders: DataFrame, calendar: DataFrame, start_de: str, end_de: str,
                      distinct_days: bool = False, drop_first: bool = True,
                      accuracy: int | None = None, scope: Scope | None = None) -> DataFrame:
    """Q2: per snapshot, ceil of the (interpolated) median over customers of their mean repurchase gap.

    ``accuracy`` opts into ``percentile_approx`` (one aggregation, rank error <= n/accuracy,
    no interpolation) for runs where an approximate median is acceptable.
    """
    held = _repurchase_pieces(orders, calendar, start_de, end_de, distinct_days)
    if accuracy:
        med = _repurchase_means(held, calendar, drop_first).groupBy(SNAPSHOT).agg(
            F.percentile_approx("user_repurchase_cycle_avg", 0.5, accuracy).alias("_median"))
    else:
        scope = scope or own_scope(orders.sparkSession)
        means = _repurchase_means(scope.table(held, "repurchase"), calendar, drop_first)
        med = exact_percentiles(means, [SNAPSHOT], "user_repurchase_cycle_avg", [0.5], ["_median"], interpolate=True, scope=scope)
    per_snap = med.select(SNAPSHOT, F.ceil("_median").cast("long").alias("all_repurchase_cycle_median"))
    return attach_calendar(calendar, per_snap).select(
        SNAPSHOT, INTERVAL_START, INTERVAL_END, "all_repurchase_cycle_median"
    )


# ------------------------------------------------------------------ Q3 spend / frequency

def _money_scale(orders: DataFrame) -> int:
    t = orders.schema[AMOUNT].dataType
    if not isinstance(t, DecimalType):
        raise TypeError(f"{AMOUNT} must be a decimal (exact money), got {t.simpleString()}")
    return t.scale


def _spend_pieces(orders: DataFrame, calendar: DataFrame, start_de: str, end_de: str) -> DataFrame:
    """Per customer the spend in the amount's smallest unit (bigint) and the order count, for runs of snapshots.

    Exact: a decimal of scale s times 10^s is a whole number. Long sums keep the
    aggregation buffers fixed-width (a decimal(38,2) sum runs on BigDecimal).
    """
    unit = 10 ** _money_scale(orders)
    in_range = orders_in_range(orders, start_de, end_de).select(CUST, DAY, (F.col(AMOUNT) * unit).cast("long").alias("_units"))
    groups = with_runs(in_range, DAY, calendar).groupBy(CUST, ENTER, LEAVE).agg(
        F.coalesce(F.sum("_units"), F.lit(0)).alias("_units"), F.count("_units").alias("_paid"), F.count(F.lit(1)).alias("user_purchase_cnt"))
    measures = ["_units", "_paid", "user_purchase_cnt"]
    return pieces(groups, CUST, enter_and_leave(measures), measures, "user_purchase_cnt").withColumn(
        "_units", F.when(F.col("_paid") > 0, F.col("_units"))).drop("_paid")          # a sum over NULL amounts only is NULL


def _from_units(units, scale: int):
    return (units.cast("decimal(38,0)") / (10 ** scale)).cast(f"decimal(38,{scale})")


def user_spend(orders: DataFrame, calendar: DataFrame, start_de: str, end_de: str) -> DataFrame:
    """Per (snapshot, customer): spend and number of orders in the trailing year."""
    scale = _money_scale(orders)
    return unfolded(_spend_pieces(orders, calendar, start_de, end_de), calendar).select(
        SNAPSHOT, CUST, _from_units(F.col("_units"), scale).alias("user_gds_ordr_gramt"), "user_purchase_cnt"
    )


QUARTILES = [0.25, 0.5, 0.75]


def spend_quartiles(orders: DataFrame, calendar: DataFrame, start_de: str, end_de: str,
                    accuracy: int | None = None, scope: Scope | None = None) -> DataFrame:
    """Q3: per snapshot, exact quartiles (rank ceil(p*n)) over customers of spend and of order count.

    Exact by default (rank selection, see ``operators.quantiles``); ``accuracy`` opts
    into ``percentile_approx``. Both measures are ranked in the same passes over the customers' pieces, a table of
    ``scope`` that each pass unfolds; spend travels as whole cents in a bigint (exact, fixed width) and is turned back at the end.
    """
    scale = _money_scale(orders)
    held = _spend_pieces(orders, calendar, start_de, end_de)
    measures, names = ["_units", "user_purchase_cnt"], [f"_{m}{i}" for m in "ac" for i in (1, 2, 3)]
    if accuracy:  # opt-in approximate quartiles: one aggregation, rank error <= n / accuracy
        q = unfolded(held, calendar).groupBy(SNAPSHOT).agg(
            *[F.percentile_approx(v, QUARTILES, accuracy).alias(m) for v, m in zip(measures, "ac")]
        ).select(SNAPSHOT, *[F.col(m)[i - 1].alias(f"_{m}{i}") for m in "ac" for i in (1, 2, 3)])
    else:
        scope = scope or own_scope(orders.sparkSession)
        q = exact_percentiles(unfolded(scope.table(held, "spend"), calendar), [SNAPSHOT], measures, QUARTILES, names, scope=scope)
    wide = q.select(
        SNAPSHOT, *[_from_units(F.col(f"_a{i}"), scale).cast("double").alias(f"all_user_gds_ordr_gramt_q{i}") for i in (1, 2, 3)],
        *[F.col(f"_c{i}").cast("long").alias(f"all_user_purchase_cnt_q{i}") for i in (1, 2, 3)])
    return attach_calendar(calendar, wide).select(
        F.col(SNAPSHOT).alias("ordr_de"), INTERVAL_START, INTERVAL_END,
        *[f"all_user_gds_ordr_gramt_q{i}" for i in (1, 2, 3)],
        *[f"all_user_purchase_cnt_q{i}" for i in (1, 2, 3)],
    )


def latest_snapshots(quartiles: DataFrame, n: int = 10) -> DataFrame:
    """The last n snapshots (the notebook's ``tail(10)``): a top-n on the date, not a cap on data."""
    return quartiles.orderBy(F.col("ordr_de").desc()).limit(n)


def last_snapshot(orders: DataFrame, calendar: DataFrame, start_de: str, end_de: str) -> DataFrame:
    """The calendar's last snapshot whose interval holds an order in range, by one scan for the days present."""
    days = orders_in_range(orders, start_de, end_de).select(DAY).distinct()
    last = interval_join(days, DAY, calendar, INTERVAL_START, INTERVAL_END).agg(F.max(SNAPSHOT).alias("_last"))
    return calendar.join(F.broadcast(last), F.col(SNAPSHOT) == F.col("_last"), "left_semi")


def user_spend_stats(spend: DataFrame, snapshot_de: str | None = None) -> DataFrame:
    """count / mean / stddev / min / max of per-customer spend and order count (``describe``), one snapshot.

    Without a date all rows count: pass the spend of one snapshot (``last_snapshot`` restricts the
    calendar before the spend is computed, so only that year's orders are read).
    """
    one = spend if snapshot_de is None else spend.where(F.col(SNAPSHOT) == F.to_date(F.lit(snapshot_de)))
    a, c = F.col("user_gds_ordr_gramt").cast("double"), F.col("user_purchase_cnt").cast("double")
    stats = one.agg(
        F.count(a).cast("double").alias("count_a"), F.mean(a).alias("mean_a"), F.stddev_samp(a).alias("stddev_a"),
        F.min(a).alias("min_a"), F.max(a).alias("max_a"),
        F.count(c).cast("double").alias("count_c"), F.mean(c).alias("mean_c"), F.stddev_samp(c).alias("stddev_c"),
        F.min(c).alias("min_c"), F.max(c).alias("max_c"),
    )
    return stats.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("summary"), F.col(f"{s}_a").alias("user_gds_ordr_gramt"),
                 F.col(f"{s}_c").alias("user_purchase_cnt"))
        for s in ("count", "mean", "stddev", "min", "max")
    ])).alias("_s")).select("_s.*")
