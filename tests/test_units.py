"""Literal frames for the semantics that bite."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from footfall.functions.columns import female_counts_sql, female_share_sql, grid_id_text, id_number, lattice_index
from footfall.operators.ids import assign_sequential_ids
from footfall.operators.quantiles import exact_percentiles
from footfall.operators.snapshots import snapshot_calendar
from footfall.plans import customers as cu
from footfall.plans.population import nonzero_population


def test_integer_zero_test(spark):
    rows = [(Decimal("0.4"), Decimal("0"), Decimal("0")), (Decimal("0"), Decimal("1.5"), Decimal("0")),
            (Decimal("0"), Decimal("0"), Decimal("0")), (None, Decimal("2"), Decimal("0")),
            (None, Decimal("0"), Decimal("0"))]
    df = spark.createDataFrame(rows, "h_pop decimal(10,2), w_pop decimal(10,2), v_pop decimal(10,2)")
    kept = nonzero_population(df).collect()
    assert [(r.h_pop, r.w_pop) for r in kept] == [(Decimal("0.00"), Decimal("1.50")), (None, Decimal("2.00"))]
    exact = nonzero_population(df, exact_zero=True).count()
    assert exact == 3  # 0.4 counts as non-zero when compared exactly


def test_string_values_compare_as_integers(spark):
    df = spark.createDataFrame([("0.4", "0", "0"), ("abc", "3", "0")], "h_pop string, w_pop string, v_pop string")
    df = df.select(*[F.col(c).try_cast("double").alias(c) for c in df.columns])
    assert nonzero_population(df).count() == 1


def test_truncation_toward_zero(spark):
    df = spark.createDataFrame([(Decimal("-35"),), (Decimal("145"),)], "x decimal(18,6)")  # -0.7 and 2.9 cells
    got = [r.i for r in df.select(lattice_index(F.col("x"), "0").alias("i")).collect()]
    assert got == [0, 2]


def test_concat_and_concat_ws_with_null(spark):
    df = spark.createDataFrame([(None, 3)], "r int, c int")
    r = df.select(F.concat(F.col("r").cast("string"), F.lit(","), F.col("c").cast("string")).alias("a"),
                  F.concat_ws(",", "r", "c").alias("b")).first()
    assert r.a is None and r.b == "3"


def test_grid_id_width(spark):
    df = spark.createDataFrame([(42,), (1234567,)], "n long")
    got = [r.g for r in df.select(grid_id_text(F.col("n")).alias("g")).collect()]
    assert got == ["GRID000042", "GRID1234567"]
    back = [r.n for r in spark.createDataFrame([(g,) for g in got], "g string").select(id_number(F.col("g")).alias("n")).collect()]
    assert back == [42, 1234567]


def test_zero_guard(spark):
    """Female share of 14 counts: 0 when they are 0, NULL with a NULL count; text counts work like numbers."""
    from footfall.sources.feeds import SEX_AGE_VALUES

    rows = [["0"] * 42, [None] + ["1"] * 41, ["1"] * 42, ["0.345", *["0"] * 41]]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SEX_AGE_VALUES))
    got = [tuple(r) for r in df.selectExpr(*female_counts_sql()).selectExpr(*female_share_sql()).collect()]
    assert got == [(0.0, 0.0, 0.0), (None, 0.5, 0.5), (0.5, 0.5, 0.5), (0.0, 0.0, 0.0)]


def test_values_out_of_range_are_null(spark):
    df = spark.createDataFrame([(Decimal("999999999999.5"),), (None,)], "x decimal(18,6)")
    assert [r.i for r in df.select(lattice_index(F.col("x"), "0", cell=1).alias("i")).collect()] == [None, None]
    wide = spark.createDataFrame([(3e9, 0.0, 0.0), (3e9, 2.0, 0.0), (0.996, 0.0, 0.0)], "h_pop double, w_pop double, v_pop double")
    assert [r.w_pop for r in nonzero_population(wide).collect()] == [2.0]


def test_six_month_windows(spark):
    """The calendar alone states the width: an order of January is outside the half year before September."""
    orders = _orders(spark, [(1, date(2020, 1, 5), Decimal("1"), 1), (2, date(2020, 3, 1), Decimal("2"), 2), (2, date(2020, 8, 31), Decimal("2"), 3)])
    for months, users in ((6, 1), (12, 2)):
        cal = snapshot_calendar(spark, "2020-09-01", "2020-09-01", months)
        row = cu.trailing_members(orders, cal).first()
        assert (row.n_users, row.n_orders) == (users, users + 1)
        assert cu.user_spend(orders, cal, "2019-01-01", "2021-01-01").count() == users
    kept = cu.user_repurchase(orders, snapshot_calendar(spark, "2020-09-01", "2020-09-01", 6), "2019-01-01", "2021-01-01", drop_first=False)
    assert [r.user_repurchase_cycle_avg for r in kept.collect()] == [183.0]


def test_empty_calendar_has_no_rows(spark):
    orders = _orders(spark, [(1, date(2020, 1, 5), Decimal("1"), 1)])
    for start, end in (("2020-01-15", "2020-01-20"), ("2020-03-01", "2020-01-01")):
        cal = snapshot_calendar(spark, start, end)
        assert cal.count() == 0 and cu.trailing_members(orders, cal).count() == 0
    from footfall.operators.snapshots import calendar_from_dates
    assert calendar_from_dates(orders.limit(0), "ordr_de").count() == 0


def test_spend_stats_of_one_snapshot(spark):
    rows = [(1, date(2020, 1, 5), Decimal("10"), 1), (2, date(2020, 2, 5), Decimal("30"), 2)]
    orders, cal = _orders(spark, rows), snapshot_calendar(spark, "2020-02-01", "2022-12-01")
    spend = cu.user_spend(orders, cal, "2019-01-01", "2021-01-01")
    mean = {d: {r.summary: r.user_gds_ordr_gramt for r in cu.user_spend_stats(spend, d).collect()}["mean"] for d in ("2020-02-01", "2020-03-01")}
    assert mean == {"2020-02-01": 10.0, "2020-03-01": 20.0}
    last = cu.last_snapshot(orders, cal, "2019-01-01", "2021-01-01").collect()
    assert [r.snapshot_stdr_de for r in last] == [date(2021, 2, 1)]


def test_outer_join_keeps_months_of_any_series(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "y", 2), ("c", "z", 3), ("c", "x", 4)], "m string, label string, n long")
    got = sorted(tuple(r) for r in cu.outer_join_series(df, "m", "label", "n", ["x", "y", "z"]).collect())
    assert got == [("a", 1, 0, 0), ("b", 0, 2, 0), ("c", 4, 0, 3)]


def test_quartiles_small(spark):
    df = spark.createDataFrame([(1, float(x)) for x in (1, 2, 3, 4, 10, 11)], "g int, x double")
    for accuracy in (10, 1000):
        q = exact_percentiles(df, ["g"], "x", [0.25, 0.5, 0.75], ["q1", "q2", "q3"], accuracy=accuracy).first()
        assert (q.q1, q.q2, q.q3) == (2.0, 3.0, 10.0)
        m = exact_percentiles(df, ["g"], "x", [0.5], ["m"], interpolate=True, accuracy=accuracy).first()
        assert m.m == 3.5


def _orders(spark, rows):
    return spark.createDataFrame(rows, "cust_id long, ordr_de date, gds_ordr_gramt decimal(18,2), ordr_key long")


def test_movement_classes(spark):
    rows = [(1, date(2020, m, 5), Decimal("1.00"), m) for m in (1, 2, 5, 7)]
    got = {r.ordr_ym: (r.new_user, r.existing_user, r.returning_user, r.mau)
           for r in cu.user_movement(_orders(spark, rows)).collect()}
    assert got == {"2020-01": (1, 0, 0, 1), "2020-02": (0, 1, 0, 1), "2020-05": (0, 0, 1, 1), "2020-07": (0, 1, 0, 1)}
    full = {r.ordr_ym: (r.new_user, r.existing_user, r.returning_user, r.mau)
            for r in cu.user_movement_full_outer(_orders(spark, rows)).collect()}
    assert full == got


def test_empty_snapshot_is_a_null_row(spark):
    orders = _orders(spark, [(1, date(2020, 1, 5), Decimal("5.00"), 1), (1, date(2020, 1, 9), Decimal("7.00"), 2)])
    cal = snapshot_calendar(spark, "2019-12-01", "2020-02-29")
    q = {r.ordr_de: r for r in cu.spend_quartiles(orders, cal, "2019-01-01", "2020-12-31").collect()}
    assert q[date(2019, 12, 1)].all_user_gds_ordr_gramt_q1 is None
    assert q[date(2020, 2, 1)].all_user_purchase_cnt_q2 == 2
    m = {r.snapshot_stdr_de: r.all_repurchase_cycle_median
         for r in cu.repurchase_median(orders, cal, "2019-01-01", "2020-12-31").collect()}
    assert m[date(2019, 12, 1)] is None


def test_repeated_day_gap_zero_counted(spark):
    # orders on day 1, twice on day 11, and day 31: gaps (after the first order) 10, 0, 20
    rows = [(1, date(2020, 1, 1), Decimal("1"), 1), (1, date(2020, 1, 11), Decimal("1"), 2),
            (1, date(2020, 1, 11), Decimal("1"), 3), (1, date(2020, 1, 31), Decimal("1"), 4)]
    gaps = {r.ordr_key: r.repurchase_cycle for r in cu.repurchase_gaps(_orders(spark, rows), "2019-01-01", "2021-01-01").collect()}
    assert gaps == {2: 10, 3: 0, 4: 20}
    cal = snapshot_calendar(spark, "2020-02-01", "2020-02-01")
    per_user = cu.user_repurchase(_orders(spark, rows), cal, "2019-01-01", "2021-01-01").first()
    # window rows (gap 10, 0, 20); the first (10) is left out: mean(0, 20) = 10
    assert per_user.user_repurchase_cycle_avg == 10.0
    distinct = cu.user_repurchase(_orders(spark, rows), cal, "2019-01-01", "2021-01-01", distinct_days=True).first()
    assert distinct.user_repurchase_cycle_avg == 20.0


def test_sequential_ids_gap_free(spark):
    cells = spark.createDataFrame([(r, c) for r in range(7) for c in range(r % 3 + 1)], "row_no int, clm_no int")
    got = assign_sequential_ids(cells, "row_no", "clm_no", F.lit(100), "seq").orderBy("row_no", "clm_no").collect()
    assert [r.seq for r in got] == list(range(101, 101 + len(got)))


def test_calendar_intervals(spark):
    cal = snapshot_calendar(spark, "2020-01-15", "2020-03-01").orderBy("snapshot_stdr_de").collect()
    assert [(r.snapshot_stdr_de, r.interval_start_de, r.interval_end_de) for r in cal] == [
        (date(2020, 2, 1), date(2019, 2, 1), date(2020, 1, 31)),
        (date(2020, 3, 1), date(2019, 3, 1), date(2020, 2, 29)),
    ]


def test_drop_first_only_when_reaching_outside(spark):
    # window of snapshot 2020-02-01 is [2019-02-01, 2020-01-31]
    inside = [(1, date(2019, 6, 1), Decimal("1"), 1), (1, date(2019, 6, 11), Decimal("1"), 2),
              (1, date(2019, 7, 1), Decimal("1"), 3)]           # first order inside: gaps 10, 20
    outside = [(2, date(2018, 12, 1), Decimal("1"), 4), (2, date(2019, 3, 1), Decimal("1"), 5),
               (2, date(2019, 3, 5), Decimal("1"), 6)]          # gaps 90 (reaches outside), 4
    cal = snapshot_calendar(spark, "2020-02-01", "2020-02-01")
    orders = _orders(spark, inside + outside)
    literal = {r.cust_id: r.user_repurchase_cycle_avg
               for r in cu.user_repurchase(orders, cal, "2018-01-01", "2021-01-01").collect()}
    assert literal == {1: 20.0, 2: 4.0}
    reach = {r.cust_id: r.user_repurchase_cycle_avg
             for r in cu.user_repurchase(orders, cal, "2018-01-01", "2021-01-01", drop_first=False).collect()}
    assert reach == {1: 15.0, 2: 4.0}


def test_approximate_quartiles_opt_in(spark):
    rows = [(1, date(2020, 1, d), Decimal(str(d)), d) for d in range(1, 21)]
    cal = snapshot_calendar(spark, "2020-02-01", "2020-02-01")
    exact = cu.spend_quartiles(_orders(spark, rows), cal, "2019-01-01", "2021-01-01").first()
    approx = cu.spend_quartiles(_orders(spark, rows), cal, "2019-01-01", "2021-01-01", accuracy=10000).first()
    assert exact.all_user_purchase_cnt_q2 == approx.all_user_purchase_cnt_q2 == 20


def test_month_bounds_leap_year(spark):
    from footfall.operators.snapshots import month_bounds

    df = spark.createDataFrame([(date(2024, 5, 3),), (date(2023, 1, 1),)], "d date")
    rows = {(r.year, r.month): (r.first_date, r.last_date) for r in month_bounds(df, "d").collect()}
    assert len(rows) == 24
    assert rows[(2024, 2)] == ("20240201", "20240229") and rows[(2023, 2)] == ("20230201", "20230228")
    assert rows[(2023, 12)] == ("20231201", "20231231")


def test_calendar_from_data_spans_every_window(spark):
    from footfall.operators.snapshots import calendar_from_dates

    df = spark.createDataFrame([(date(2020, 3, 15),), (date(2020, 5, 2),)], "d date")
    snaps = sorted(r.snapshot_stdr_de for r in calendar_from_dates(df, "d").collect())
    assert snaps[0] == date(2020, 3, 1) and snaps[-1] == date(2021, 5, 1) and len(snaps) == 15


def test_typed_feed_keeps_decimals_and_nulls_only_the_bad_field(spark):
    from footfall.session import scratch_path
    from footfall.sources import feeds

    path = scratch_path(spark, "bad-feed")
    header = "|".join(f.name for f in feeds.TIME_POP_SCHEMA.fields)
    values = ["20240101", "2823751000", "746783.991784", "1883429.147390", "abc", "0.345", "0.996", *["1.50"] * 69, "B"]
    spark.createDataFrame([(header,), ("|".join(values),)], "value string").coalesce(1).write.text(path)
    row = feeds.typed(feeds.read_feed(spark, path, feeds.TIME_POP_SCHEMA), feeds.TIME_VALUES, "double", "decimal(18,6)").first()
    assert (row.h_t_00, row.h_t_01, row.h_t_02) == (None, 0.345, 0.996) and row.x_coord == Decimal("746783.991784")


def test_text_feed_plans_in_seconds(spark):
    """Q5 over feeds whose columns are all casts of text: planning must not grow with their number."""
    import time

    from footfall.catalog import QUERIES
    from conftest import SF_SMALL

    began = time.monotonic()
    assert QUERIES["female_population_csv"](spark, SF_SMALL).count() > 0
    assert time.monotonic() - began < 60


def test_no_scratch_folder_on_a_cluster(monkeypatch):
    import pytest

    from footfall import session

    class Cluster:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Cluster)


def test_results_and_partitioned_appends_read_back(spark, tmp_path):
    from footfall.sinks import append, write_result
    rows = [(1, 'a "quoted", text'), (2, "b")]
    df = spark.createDataFrame(rows, "m int, t string")
    for fmt in ("parquet", "csv"):
        for _ in range(2):                         # a second run overwrites
            write_result(df, f"{tmp_path}/{fmt}", fmt)
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/parquet").collect())) == rows
    csv = spark.read.csv(f"{tmp_path}/csv", header=True, schema="m int, t string", escape='"')
    assert sorted(map(tuple, csv.collect())) == rows
    for _ in range(2):
        append(df, f"{tmp_path}/parts", partition_col="m")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/parts").select("m", "t").collect()) == sorted(rows * 2)
    assert (tmp_path / "parts" / "m=1").is_dir()
