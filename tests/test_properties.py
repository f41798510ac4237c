"""Properties that hold on the test tables."""

import random

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from footfall.catalog import QUERIES
from footfall.functions.geo import to_tm, to_wgs84
from footfall.operators.quantiles import exact_percentiles
from footfall.plans import customers as cu
from footfall.sources import fixtures as fx


def test_movement_adds_up(spark):
    orders = fx.fx_orders(spark, SF_SMALL)
    mv = cu.user_movement(orders).collect()
    assert all(r.mau == r.new_user + r.returning_user + r.existing_user for r in mv)
    users = orders.select("cust_id").distinct().count()
    assert sum(r.new_user for r in mv) == users
    months = cu.user_months(orders, "1970-01-01", "2022-07-31").groupBy("ordr_ym").count().collect()
    assert {r.ordr_ym: r["count"] for r in months} == {r.ordr_ym: r.mau for r in mv}


def test_bracketed_quantiles_match_builtin(spark):
    rng = random.Random(11)
    rows = [(9, None)]
    for g, n in enumerate((1, 2, 3, 7, 300, 4000)):
        hot = rng.random() * 100
        rows += [(g, hot if rng.random() < 0.3 else round(rng.gauss(50, 30), 2)) for _ in range(n)]
    df = spark.createDataFrame(rows, "g int, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    want = {r.g: [r[n] for n in names] for r in df.where("x IS NOT NULL").groupBy("g").agg(*[
        F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY x)").alias(n) for p, n in zip(probs, names)]).collect()}
    between = {r.g: [r[n] for n in names] for r in df.where("x IS NOT NULL").groupBy("g").agg(*[
        F.percentile("x", p).alias(n) for p, n in zip(probs, names)]).collect()}
    for accuracy in (20, 100, 1000):  # wide brackets, narrow ones
        got = {r.g: [r[n] for n in names] for r in exact_percentiles(df, ["g"], "x", probs, names, accuracy=accuracy).collect()}
        assert got == want
        got = {r.g: [r[n] for n in names] for r in exact_percentiles(
            df, ["g"], "x", probs, names, interpolate=True, accuracy=accuracy).collect()}
        assert got == between


def test_unpivot_keeps_totals(spark):
    feed = fx.fx_time_pop(spark, SF_SMALL)
    wide_total = feed.select(sum(F.col(f"{k}_t_{h:02d}") for k in "hwv" for h in range(24)).alias("t")).agg(F.sum("t")).first()[0]
    long_total = QUERIES["melt_hourly"](spark, SF_SMALL).agg(F.sum("value")).first()[0]
    assert abs(float(wide_total) - long_total) < 1e-6


def test_female_not_above_total(spark):
    fem = QUERIES["female_population"](spark, SF_SMALL)
    tot = QUERIES["grid_population"](spark, SF_SMALL)
    bad = fem.join(tot, ["stdr_de", "stdr_tm", "grid_id"]).where(F.col("pcel_tmzn_fml_co") > F.col("fpop_co") + 1e-6)
    assert fem.count() > 0 and bad.count() == 0


def test_registered_ids_unique_gap_free_ordered(spark):
    new = QUERIES["register_cells"](spark, SF_MID).orderBy("row_no", "clm_no").collect()
    grid = fx.fx_pcel_grid(spark, SF_MID)
    last = grid.count()  # fixture ids are 1..n
    nums = [int(r.grid_id[4:]) for r in new]
    assert nums == list(range(last + 1, last + 1 + len(new)))
    assert len({r.mtr_no for r in new}) == len(new)


def test_projection_round_trip(spark):
    pts = spark.createDataFrame([(126.0 + i * 0.37, 33.5 + i * 0.41) for i in range(12)], "lo double, la double")
    back = to_wgs84(to_tm(pts, "lo", "la", "x", "y"), "x", "y", "lo2", "la2")
    worst = back.select(F.max(F.greatest(F.abs(F.col("lo") - F.col("lo2")), F.abs(F.col("la") - F.col("la2"))))).first()[0]
    assert worst < 1e-8
    origin = to_tm(spark.createDataFrame([(127.5, 38.0)], "lo double, la double"), "lo", "la", "x", "y").first()
    assert abs(origin.x - 1_000_000) < 1e-6 and abs(origin.y - 2_000_000) < 1e-6


def test_load_twice_equals_once(spark):
    first = QUERIES["load_month"](spark, SF_SMALL)
    n = first.count()
    assert n == fx.fx_orders(spark, SF_SMALL).count()  # the whole target: months loaded before and now


def test_grid_intake_rerun_is_a_no_op(spark):
    from footfall import jobs
    from footfall.catalog import _bounded_pop, _cctv_counts, _pcel_grid
    from footfall.plans import intake as ik
    from footfall.session import scratch_path

    src = _bounded_pop(spark, SF_SMALL)
    source_path, grid_path, fact_path = (scratch_path(spark, n) for n in ("src", "grid", "facts"))
    src.write.partitionBy(jobs.PARTITION).parquet(source_path)
    ik.full_grid_rows(_pcel_grid(spark, SF_SMALL), _cctv_counts(spark, SF_SMALL)).write.parquet(grid_path)
    first = jobs.run_grid_intake(spark, source_path, src.schema, fact_path, grid_path, _cctv_counts(spark, SF_SMALL))
    facts, cells = spark.read.parquet(fact_path).count(), spark.read.parquet(grid_path).count()
    assert first["months"] == 3 and first["new_cells"] > 0 and facts > 0
    again = jobs.run_grid_intake(spark, source_path, src.schema, fact_path, grid_path, _cctv_counts(spark, SF_SMALL))
    assert again == {"months": 0, "new_cells": 0}
    assert spark.read.parquet(fact_path).count() == facts and spark.read.parquet(grid_path).count() == cells
    ids = [r.grid_id for r in spark.read.parquet(grid_path).select("grid_id").collect()]
    assert len(ids) == len(set(ids))


def test_projection_against_numeric_meridian_arc(spark):
    """Known points: on the central meridian the northing is the scaled arc of the meridian, integrated here."""
    import math

    a, f = 6378137.0, 1 / 298.257222101
    e2 = f * (2 - f)

    def arc(lat0, lat1, n=20000):
        h = (lat1 - lat0) / n
        g = lambda t: a * (1 - e2) / (1 - e2 * math.sin(t) ** 2) ** 1.5
        return h / 3 * sum((1 if i in (0, n) else 4 if i % 2 else 2) * g(lat0 + i * h) for i in range(n + 1))

    lats = [33.0, 35.61, 37.456, 38.0, 39.9]
    pts = spark.createDataFrame([(127.5, x) for x in lats], "lo double, la double")
    for r in to_tm(pts, "lo", "la", "x", "y").collect():
        want = 2_000_000 + 0.9996 * arc(math.radians(38.0), math.radians(r.la))
        assert abs(r.y - want) < 1e-4 and abs(r.x - 1_000_000) < 1e-6


def test_projection_off_the_meridian_against_another_series(spark):
    """Redfearn's series over an integrated arc, in DuckDB, up to 2.5 degrees to either side of the central meridian."""
    import duckdb

    from footfall.functions.geo import stages_sql
    from footfall.oracle import forward_redfearn, inverse_redfearn

    pts = [(127.5 + 0.25 * i, 33.0 + 0.6 * j) for i in range(-10, 11) for j in range(11)]
    df = spark.createDataFrame(pts, "lo double, la double")
    ours = to_wgs84(to_tm(df, "lo", "la", "x", "y"), "x", "y", "lo2", "la2").collect()
    duckdb.sql("CREATE OR REPLACE TABLE tm_points (lo DOUBLE, la DOUBLE, px DOUBLE, py DOUBLE)")
    duckdb.executemany("INSERT INTO tm_points VALUES (?, ?, ?, ?)", [(r.lo, r.la, r.x, r.y) for r in ours])
    sql = stages_sql("SELECT * FROM tm_points", ["lo", "la", "px", "py"], forward_redfearn("lo", "la", "x", "y"))
    sql = stages_sql(sql, ["lo", "la", "px", "py", "x", "y"], inverse_redfearn("px", "py", "lo2", "la2"))
    rows = duckdb.sql(f"SELECT lo, la, px, py, x, y, lo2, la2 FROM ({sql})").fetchall()
    assert len(rows) == len(pts)
    for lo, la, px, py, x, y, lo2, la2 in rows:
        assert abs(px - x) < 1e-5 and abs(py - y) < 1e-5, (lo, la, px - x, py - y)
        assert abs(lo2 - lo) < 1e-10 and abs(la2 - la) < 1e-10, (lo, la, lo2 - lo, la2 - la)


def test_gaps_and_one_month_per_run(spark):
    from footfall import jobs
    from footfall.session import scratch_path

    orders = fx.fx_orders(spark, SF_SMALL).withColumn(jobs.PARTITION, F.date_format("ordr_de", "yyyyMM"))
    orders = orders.where(F.col(jobs.PARTITION).between("200001", "200005"))
    source, target = scratch_path(spark, "gap-src"), scratch_path(spark, "gap-dst")
    orders.write.partitionBy(jobs.PARTITION).parquet(source)
    jobs.reload_months(spark, source, target, orders.schema, ["200001", "200003"])
    months = lambda: sorted(r[0] for r in spark.read.schema(orders.schema).parquet(target).select(jobs.PARTITION).distinct().collect())
    assert jobs.load_new_months(spark, source, target, orders.schema, max_months=1) == 1
    assert months() == ["200001", "200003", "200004"]
    assert jobs.load_new_months(spark, source, target, orders.schema, gaps=True) == 2
    assert months() == ["200001", "200002", "200003", "200004", "200005"]
    assert spark.read.schema(orders.schema).parquet(target).count() == orders.count()
    assert jobs.load_new_months(spark, source, target, orders.schema, gaps=True) == 0


def test_catalog_tables_load_by_their_metadata(spark):
    from footfall import jobs
    from footfall.session import scratch_path

    orders = fx.fx_orders(spark, SF_SMALL).withColumn(jobs.PARTITION, F.date_format("ordr_de", "yyyyMM"))
    orders = orders.where(F.col(jobs.PARTITION).between("200001", "200003"))
    names = ("fx_catalog_source", "fx_catalog_target")
    try:
        orders.write.partitionBy(jobs.PARTITION).option("path", scratch_path(spark, "cat-src")).saveAsTable(names[0])
        orders.where(f"{jobs.PARTITION} = '200001'").write.partitionBy(jobs.PARTITION).option(
            "path", scratch_path(spark, "cat-dst")).saveAsTable(names[1])
        assert jobs.load_new_months_table(spark, *names) == 2
        assert jobs.load_new_months_table(spark, *names) == 0
        assert spark.table(names[1]).exceptAll(spark.table(names[0]).select(*spark.table(names[1]).columns)).count() == 0
        assert spark.table(names[1]).count() == orders.count()
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
