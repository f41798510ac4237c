"""Interval joins, sliding windows by events and bracketed ranks against direct counts."""

import contextlib
import io
import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from footfall.catalog import QUERIES, SNAPSHOT_RANGE, _calendar, _mid_months
from footfall.operators.intervals import interval_join
from footfall.operators.quantiles import exact_percentiles
from footfall.operators.sliding import runs_of_days
from footfall.operators.snapshots import INTERVAL_END, INTERVAL_START, SNAPSHOT, day_calendar
from footfall.plans import customers as cu
from footfall.scratch import named_scope, scope
from footfall.sources import fixtures as fx

DAY0 = date(2020, 1, 1)
ORDERS = "cust_id long, ordr_de date, gds_ordr_gramt decimal(18,2), ordr_key long"


def day(n):
    return None if n is None else DAY0 + timedelta(days=n)


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.mark.parametrize("bin_days", [1, 7, 32, 1000])
def test_interval_join_is_every_pair(spark, bin_days):
    rng = random.Random(bin_days)
    points = [(i, rng.choice([None, *range(-400, 400)])) for i in range(150)] + [(900 + i, 5) for i in range(50)]       # a hot day
    spans = [(i, a, a + rng.choice([-3, 0, 1, 30, 90, 700])) for i, a in enumerate(rng.sample(range(-500, 400), 60))] + [(100, None, 3), (101, 3, None)]
    p = spark.createDataFrame([(i, day(d)) for i, d in points], "p long, d date")
    s = spark.createDataFrame([(i, day(a), day(b)) for i, a, b in spans], "s long, a date, b date")
    joined = interval_join(p, "d", s, "a", "b", bin_days)
    got = sorted((r.p, r.s) for r in joined.collect())
    assert got == sorted((i, j) for i, d in points for j, a, b in spans if None not in (d, a, b) and a <= d <= b)
    assert "Cartesian" not in plan_of(joined) and "NestedLoop" not in plan_of(joined)


def test_no_pairs_without_rows(spark):
    none = spark.createDataFrame([], "s long, a date, b date")
    assert interval_join(spark.createDataFrame([(1, DAY0)], "p long, d date"), "d", none, "a", "b").count() == 0


def test_runs_need_a_calendar_in_order(spark):
    nested = spark.createDataFrame([(day(50), day(0), day(40)), (day(60), day(10), day(20)), (day(70), day(15), day(45))],
                                   f"{SNAPSHOT} date, {INTERVAL_START} date, {INTERVAL_END} date")
    with pytest.raises(Exception, match="must end in the order"):
        runs_of_days(nested).collect()


@pytest.mark.parametrize("first, step, width", [("2020-02-15", "1 MONTH", 90), ("2019-12-20", "9 DAYS", 25), ("2020-01-31", "2 MONTHS", 10)])
def test_windows_equal_direct_sums(spark, first, step, width):
    """Spend, members and repurchase means of any calendar, with a customer that has a third of all orders."""
    rng = random.Random(width)
    rows = [(1 if i % 3 == 0 else rng.randrange(2, 9), rng.randrange(0, 200), Decimal(rng.randrange(1, 9999)) / 100, i) for i in range(300)]
    rows += [(50, 30, None, 900), (51, 31, None, 901), (51, 31, Decimal("2.50"), 902)]
    orders = spark.createDataFrame([(c, day(d), a, k) for c, d, a, k in rows], ORDERS)
    cal = day_calendar(spark, first, "2020-09-30", step, width)
    windows = [(r[0], r[1], r[2]) for r in cal.collect()]
    span = ("2019-01-01", "2021-12-31")

    spend, members = {}, []
    for s, a, b in windows:
        inside = [r for r in rows if a <= day(r[1]) <= b]
        members.append((s, len(inside), len({r[0] for r in inside})))
        for c in {r[0] for r in inside}:
            paid = [r[2] for r in inside if r[0] == c and r[2] is not None]
            spend[s, c] = (sum(paid) if paid else None, sum(r[0] == c for r in inside))
    assert {(r[0], r[1]): (r[2], r[3]) for r in cu.user_spend(orders, cal, *span).collect()} == spend
    for got in (cu.trailing_members(orders, cal), cu.interval_members(orders, cal, 16)):
        assert sorted((r[SNAPSHOT], r.n_orders, r.n_users) for r in got.collect()) == sorted(members)

    for drop_first in (True, False):
        want = {}
        for c in {r[0] for r in rows}:
            mine = sorted((r[1], r[3]) for r in rows if r[0] == c)
            gaps = [(d, before, d - before) for (before, _), (d, _) in zip(mine, mine[1:])]
            for s, a, b in windows:
                kept = [g for g in gaps if a <= day(g[0]) <= b]
                if kept and (drop_first or day(kept[0][1]) < a):
                    kept = kept[1:]
                if kept:
                    want[s, c] = pytest.approx(sum(g[2] for g in kept) / len(kept))
        got = {(r[0], r[1]): r[2] for r in cu.user_repurchase(orders, cal, *span, drop_first=drop_first).collect()}
        assert got == want


def test_an_aggregate_is_two_rows_not_twelve(spark):
    orders = fx.fx_orders(spark, SF_SMALL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        held = cu._spend_pieces(orders, _calendar(spark), *SNAPSHOT_RANGE)
        text = plan_of(held)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("Exchange hashpartitioning(cust_id") == 2            # runs per customer, then by customer
    assert "Cartesian" not in text and "NestedLoop" not in text
    runs = cu.with_runs(cu.orders_in_range(orders, *SNAPSHOT_RANGE), "ordr_de", _calendar(spark)).groupBy("cust_id", "_enter", "_leave").count().count()
    assert held.count() <= 2 * runs
    members = plan_of(cu.interval_members(orders, _mid_months(spark), 22))
    assert "Cartesian" not in members and "NestedLoop" not in members


def test_few_unfoldings(spark):
    from footfall.operators import quantiles
    from footfall.operators.sliding import unfolded
    orders, cal = fx.fx_orders(spark, SF_SMALL), _calendar(spark)
    with scope(spark) as s:
        held = s.table(cu._spend_pieces(orders, cal, *SNAPSHOT_RANGE), "spend")
        text = plan_of(quantiles._picked(s, unfolded(held, cal), [SNAPSHOT], ["_units", "user_purchase_cnt"], [0.25, 0.5, 0.75], False, 1000, 0.004))
        own = [ln for ln in text.splitlines() if "Generate explode(sequence(_from" in ln or "explode(array" in ln or "explode(filter" in ln]
        assert len(own) <= 3                 # and one more for the sketch


def test_ranks_outside_their_brackets_are_looked_for_again(spark):
    rng = random.Random(4)
    rows = [(g, rng.choice([None, rng.randrange(50), rng.randrange(10**6)]), rng.randrange(7)) for g in range(5) for _ in range(400)] + [(9, None, 3), (10, 4, None)]
    df = spark.createDataFrame(rows, "g int, a long, b long")
    probs, names = [0.0, 0.25, 0.5, 0.99, 1.0], [f"{c}{i}" for c in "ab" for i in range(5)]
    with scope(spark) as s:
        wrong = exact_percentiles(df, ["g"], ["a", "b"], probs, names, accuracy=5, reach=-0.05, scope=s)        # brackets beside the ranks
        got = {r.g: [r[n] for n in names] for r in wrong.collect()}
    want = {r.g: [r[n] for n in names] for r in df.groupBy("g").agg(
        *[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {c})").cast("long").alias(f"{c}{i}") for c in "ab" for i, p in enumerate(probs)]).collect()}
    assert got == want
    with pytest.raises(ValueError, match="one type"):
        exact_percentiles(df.withColumn("b", F.col("b").cast("double")), ["g"], ["a", "b"], [0.5], ["x", "y"])


def _folders(spark) -> set[str]:
    import os
    base = spark.conf.get("spark.checkpoint.dir")
    return {os.path.join(d, f) for d, _, fs in os.walk(base) for f in fs if f.endswith(".parquet")}


def test_scratch_does_not_grow_with_runs(spark):
    for name in ("movement_full_outer", "spend_quartiles"):
        QUERIES[name](spark, SF_SMALL).collect()
        once = len(_folders(spark))
        QUERIES[name](spark, SF_SMALL).collect()
        assert len(_folders(spark)) == once


def test_scopes_end(spark):
    before = _folders(spark)
    with scope(spark) as s:
        assert s.table(spark.range(10), "x").count() == 10
        assert len(_folders(spark)) > len(before)
    assert _folders(spark) == before
    a = named_scope(spark, "n", "about")
    a.table(spark.range(3), "x")
    named_scope(spark, "n", "about")
    assert _folders(spark) == before
