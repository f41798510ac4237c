"""Named queries over a test-data folder: name -> (spark, sf_dir) -> DataFrame.

Each entry reads the given tables (or stand-ins Spark derives from them) and runs
one library function over them whole. ``present`` turns dates into ISO text and
decimals into doubles so results compare across engines.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall import jobs
from footfall.constants import FACT_COLUMNS
from footfall.operators import snapshots as snap
from footfall.plans import customers as cu
from footfall.plans import intake as ik
from footfall.plans import population as po
from footfall.scratch import Scope, named_scope
from footfall.sinks import overwrite_partitions
from footfall.sources import colocated, feeds
from footfall.sources import fixtures as fx
from footfall.streaming.intake_stream import run_intake_stream

Query = Callable[[SparkSession, str], DataFrame]

# Job parameters (the reference fixes its own in code; ours span the test data's 1995-01..2001-08 orders)
MOVEMENT_RANGE = ("1970-01-01", "2022-07-31")
SNAPSHOT_RANGE = ("1995-01-01", "2002-07-31")
FILTER_RANGE = ("1996-06-01", "1999-07-31")


def present(df: DataFrame) -> DataFrame:
    """Dates as 'yyyy-MM-dd' text, decimals as doubles; other columns unchanged."""
    exprs = []
    for f in df.schema.fields:
        c = f"`{f.name}`"
        if isinstance(f.dataType, T.DateType):
            c = f"date_format({c}, 'yyyy-MM-dd')"
        elif isinstance(f.dataType, T.DecimalType):
            c = f"CAST({c} AS DOUBLE)"
        exprs.append(f"{c} AS `{f.name}`")
    return df.selectExpr(*exprs)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.fx_orders(spark, sf_dir)


def _time_pop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.stored(spark, sf_dir, "time_pop", fx.fx_time_pop)


def _sex_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.stored(spark, sf_dir, "sex_age", fx.fx_sex_age)


def _bounded_pop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.stored(spark, sf_dir, "bounded_pop", fx.fx_bounded_pop)


def _pcel_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.stored(spark, sf_dir, "pcel_grid", fx.fx_pcel_grid)


def _calendar(spark: SparkSession) -> DataFrame:
    return snap.snapshot_calendar(spark, *SNAPSHOT_RANGE)


#: Snapshots on the 15th of each month over the 90 days before them: neither month starts nor whole months.
MID_MONTHS, QUARTER_DAYS = ("1995-01-15", "2002-07-31"), 90


def _mid_months(spark: SparkSession) -> DataFrame:
    return snap.day_calendar(spark, *MID_MONTHS, "1 MONTH", QUARTER_DAYS)


# ---------------------------------------------------------------- customers

def q_read_bounds(spark, sf_dir):
    return cu.read_bounds(_orders(spark, sf_dir), *MOVEMENT_RANGE)


def q_orders_in_range(spark, sf_dir):
    return present(cu.orders_in_range(_orders(spark, sf_dir), *FILTER_RANGE))


def q_user_months(spark, sf_dir):
    return present(cu.user_months(_orders(spark, sf_dir), *MOVEMENT_RANGE))


def q_user_month_gap(spark, sf_dir):
    return present(cu.user_month_gaps(_orders(spark, sf_dir), *MOVEMENT_RANGE))


def q_user_movement(spark, sf_dir):
    return cu.user_movement(_orders(spark, sf_dir), *MOVEMENT_RANGE)


def q_movement_full_outer(spark, sf_dir):
    return cu.user_movement_full_outer(
        _orders(spark, sf_dir), *MOVEMENT_RANGE, scope=named_scope(spark, "movement", sf_dir))


def q_snapshot_calendar(spark, sf_dir):
    return present(snap.calendar_from_dates(_orders(spark, sf_dir), cu.DAY))


def q_month_bounds(spark, sf_dir):
    return snap.month_bounds(_orders(spark, sf_dir), cu.DAY)


def q_trailing_members(spark, sf_dir):
    orders = cu.orders_in_range(_orders(spark, sf_dir), *SNAPSHOT_RANGE)
    return present(cu.trailing_members(orders, _calendar(spark)))


def q_interval_members(spark, sf_dir):
    return present(cu.interval_members(_orders(spark, sf_dir), _mid_months(spark), QUARTER_DAYS // 4))


def q_members_mid_month(spark, sf_dir):
    return present(cu.trailing_members(_orders(spark, sf_dir), _mid_months(spark)))


def q_user_spend_mid_month(spark, sf_dir):
    return present(cu.user_spend(_orders(spark, sf_dir), _mid_months(spark), *SNAPSHOT_RANGE))


def q_repurchase_gaps(spark, sf_dir):
    return present(cu.repurchase_gaps(_orders(spark, sf_dir), *SNAPSHOT_RANGE))


def q_user_repurchase(spark, sf_dir):
    df = cu.user_repurchase(_orders(spark, sf_dir), _calendar(spark), *SNAPSHOT_RANGE)
    return present(df.withColumn("user_repurchase_cycle_avg", F.round("user_repurchase_cycle_avg", 6)))


def q_repurchase_median(spark, sf_dir):
    return present(cu.repurchase_median(_orders(spark, sf_dir), _calendar(spark), *SNAPSHOT_RANGE,
                                        scope=named_scope(spark, "repurchase", sf_dir)))


def q_user_spend(spark, sf_dir):
    return present(cu.user_spend(_orders(spark, sf_dir), _calendar(spark), *SNAPSHOT_RANGE))


def q_user_spend_stats(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    last = cu.last_snapshot(orders, _calendar(spark), *SNAPSHOT_RANGE)
    stats = cu.user_spend_stats(cu.user_spend(orders, last, *SNAPSHOT_RANGE))
    return stats.select("summary", F.round("user_gds_ordr_gramt", 4).alias("user_gds_ordr_gramt"),
                        F.round("user_purchase_cnt", 6).alias("user_purchase_cnt"))


def q_spend_quartiles(spark, sf_dir):
    return present(cu.spend_quartiles(_orders(spark, sf_dir), _calendar(spark), *SNAPSHOT_RANGE,
                                      scope=named_scope(spark, "quartiles", sf_dir)))


def q_latest_snapshots(spark, sf_dir):
    q = cu.spend_quartiles(_orders(spark, sf_dir), _calendar(spark), *SNAPSHOT_RANGE,
                           scope=named_scope(spark, "latest", sf_dir))
    return present(cu.latest_snapshots(q, 10))


QUERIES: dict[str, Query] = {
    "read_bounds": q_read_bounds,
    "orders_in_range": q_orders_in_range,
    "user_months": q_user_months,
    "user_month_gap": q_user_month_gap,
    "user_movement": q_user_movement,
    "movement_full_outer": q_movement_full_outer,
    "snapshot_calendar": q_snapshot_calendar,
    "month_bounds": q_month_bounds,
    "trailing_members": q_trailing_members,
    "interval_members": q_interval_members,
    "members_mid_month": q_members_mid_month,
    "user_spend_mid_month": q_user_spend_mid_month,
    "repurchase_gaps": q_repurchase_gaps,
    "user_repurchase": q_user_repurchase,
    "repurchase_median": q_repurchase_median,
    "user_spend": q_user_spend,
    "user_spend_stats": q_user_spend_stats,
    "spend_quartiles": q_spend_quartiles,
    "latest_snapshots": q_latest_snapshots,
}


# ---------------------------------------------------------------- population (Incheon lattice)


POP_YEAR = ("20240101", "20241231")  # the reference loads one year of months; the feed stand-in holds 2024-01


COORD = "decimal(18,6)"  # as in the grid dimension, so that centres compare equal


def _eighths(feed, values):
    """The feed with its counts divided by eight: values of five decimals, some of them below one."""
    eighth = F.lit(Decimal("0.125"))     # exact at five decimals, and far cheaper than dividing decimals
    return feed.select(*[(F.col(c) * eighth).cast("decimal(24,5)").alias(c) if c in values else F.col(c) for c in feed.columns])


def q_csv_feed(spark, sf_dir):
    path = named_scope(spark, "csv-feed", sf_dir).path("time-pop")
    feeds.write_feed(_eighths(_time_pop(spark, sf_dir), feeds.TIME_VALUES), path)
    read = feeds.read_feed(spark, f"{path}/*.csv", feeds.TIME_POP_SCHEMA)
    return present(feeds.typed(read, feeds.TIME_VALUES, "double", COORD))


SHORT_CELL, LONG_CELL = 3, 7      # the cells whose lines are damaged: by their column, modulo 10


def _damaged_feed(spark, sf_dir, path):
    """The hourly feed as text in which some lines lack their last ten fields and some have one too many."""
    feed = _eighths(_time_pop(spark, sf_dir), feeds.TIME_VALUES)
    names = [f.name for f in feeds.TIME_POP_SCHEMA.fields]
    fields = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]
    cell = F.floor(F.col("x_coord") / 50) % 10
    line = (F.when(cell == SHORT_CELL, F.concat_ws("|", *fields[:-10])).when(cell == LONG_CELL, F.concat_ws("|", *fields, F.lit("more")))
            .otherwise(F.concat_ws("|", *fields)))
    feeds.write_lines(feed.select(line.alias("line")), "|".join(names), path)


def q_feed_reconciled(spark, sf_dir):
    run = named_scope(spark, "feed-reconciled", sf_dir)
    path = run.path("damaged")
    _damaged_feed(spark, sf_dir, path)
    read = feeds.reconciled_feed(spark, f"{path}/*.csv", feeds.TIME_POP_SCHEMA, run.path("quarantine"))
    return present(feeds.typed(read, feeds.TIME_VALUES, "double", COORD))


def q_feed_quarantine(spark, sf_dir):
    """Quarantined lines by day and number of fields."""
    run = named_scope(spark, "feed-quarantine", sf_dir)
    path, quarantine = run.path("damaged"), run.path("quarantine")
    _damaged_feed(spark, sf_dir, path)
    feeds.reconciled_feed(spark, f"{path}/*.csv", feeds.TIME_POP_SCHEMA, quarantine)
    bad = spark.read.parquet(quarantine)
    return bad.groupBy(F.substring("line", 1, 8).alias("std_ymd"), "fields").agg(F.count(F.lit(1)).alias("n_lines"))


def q_district_prefix(spark, sf_dir):
    return present(po.district_prefix(_time_pop(spark, sf_dir), spark))


def q_melt_hourly(spark, sf_dir):
    return present(po.melt_hourly(_time_pop(spark, sf_dir)))


def q_unpivot_kinds(spark, sf_dir):
    return present(po.unpivot_kinds(_time_pop(spark, sf_dir)))


def q_nonzero_population(spark, sf_dir):
    return present(po.nonzero_population(po.unpivot_kinds(_time_pop(spark, sf_dir))))


def q_grid_index(spark, sf_dir):
    df = po.ic_index(_time_pop(spark, sf_dir))
    return present(df.select(*po.FEED_KEYS, "row_id", "col_id", "mtr_no"))


def q_cell_lookup(spark, sf_dir):
    return po.cell_lookup(_time_pop(spark, sf_dir), fx.fx_ic_grid(spark, sf_dir))


def q_cell_lookup_xy(spark, sf_dir):
    return present(po.cell_lookup_xy(_time_pop(spark, sf_dir), fx.fx_ic_grid(spark, sf_dir)))


def q_grid_population(spark, sf_dir):
    df = po.grid_population(_time_pop(spark, sf_dir), fx.fx_ic_grid(spark, sf_dir),
                            first_ymd=POP_YEAR[0], last_ymd=POP_YEAR[1])
    return present(df)


def q_sex_age_ratio(spark, sf_dir):
    df = po.sex_age_ratios(_sex_age(spark, sf_dir))
    return present(df.select(*[F.round(c, 6).alias(c) if c.endswith("_r") else F.col(c) for c in df.columns]))


def q_female_population_csv(spark, sf_dir):
    """Q5 as the reference runs it: both feeds read from '|' CSV text with all-string schemas."""
    run = named_scope(spark, "female-csv", sf_dir)
    tpath, spath = run.path("time-pop"), run.path("sex-age")
    feeds.write_feed(_eighths(_time_pop(spark, sf_dir), feeds.TIME_VALUES), tpath)
    feeds.write_feed(_eighths(_sex_age(spark, sf_dir), feeds.SEX_AGE_VALUES), spath)
    tp = feeds.typed(feeds.read_feed(spark, f"{tpath}/*.csv", feeds.TIME_POP_SCHEMA), feeds.TIME_VALUES, "double", COORD)
    sa = feeds.typed(feeds.read_feed(spark, f"{spath}/*.csv", feeds.SEX_AGE_POP_SCHEMA), feeds.SEX_AGE_VALUES, "double", COORD)
    df = po.female_population(tp, sa, fx.fx_ic_grid(spark, sf_dir))
    return df.withColumn("pcel_tmzn_fml_co", F.round("pcel_tmzn_fml_co", 6))


def q_female_population_colocated(spark, sf_dir):
    """Q5 over feeds and grid stored bucketed by cell."""
    run = named_scope(spark, "female-colocated", sf_dir)
    grid = fx.fx_ic_grid(spark, sf_dir).withColumnsRenamed({"cnt_x_crd": "x_coord", "cnt_y_crd": "y_coord"})
    prefix = re.sub(r"\W", "_", run.folder.rpartition("/")[2])       # the run before is replaced
    frames = {"time_pop": _time_pop(spark, sf_dir), "sex_age": _sex_age(spark, sf_dir), "grid": grid}
    got = colocated.stored(spark, frames, run.path("cells"), prefix)
    grid = got["grid"].withColumnsRenamed({"x_coord": "cnt_x_crd", "y_coord": "cnt_y_crd"})
    df = po.female_population(got["time_pop"], got["sex_age"], grid)
    return df.withColumn("pcel_tmzn_fml_co", F.round("pcel_tmzn_fml_co", 6))


def q_female_population(spark, sf_dir):
    df = po.female_population(_time_pop(spark, sf_dir), _sex_age(spark, sf_dir), fx.fx_ic_grid(spark, sf_dir))
    return df.withColumn("pcel_tmzn_fml_co", F.round("pcel_tmzn_fml_co", 6))


# ---------------------------------------------------------------- bounded grid intake

def _cell_days(spark, sf_dir):
    return ik.bounded_cell_days(_bounded_pop(spark, sf_dir), _pcel_grid(spark, sf_dir))


def _round_degrees(df, digits=7):
    return df.select(*[F.round(c, digits).alias(c) if c.endswith(("_lo", "_la")) else F.col(c) for c in df.columns])


def q_grid_bounds(spark, sf_dir):
    return present(ik.grid_bounds(_bounded_pop(spark, sf_dir)))


def q_grid_population_bounded(spark, sf_dir):
    return present(ik.grid_population_bounded(_cell_days(spark, sf_dir)))


def q_unseen_cells(spark, sf_dir):
    return present(ik.unseen_cells(_cell_days(spark, sf_dir)))


def _cctv_counts(spark, sf_dir):
    return ik.cctv_counts_of(fx.fx_cctv_cells(spark, sf_dir))


def q_register_cells(spark, sf_dir):
    new = ik.register_cells(ik.unseen_cells(_cell_days(spark, sf_dir)), _pcel_grid(spark, sf_dir),
                            _cctv_counts(spark, sf_dir), scope=named_scope(spark, "register-cells", sf_dir))
    return present(_round_degrees(new))


def q_points_in_box(spark, sf_dir):
    return ik.points_in_box(fx.fx_cctv_points(spark, sf_dir))


def q_project_points(spark, sf_dir):
    df = ik.project_points(fx.fx_cctv_points(spark, sf_dir))
    return df.select("la", "lo", F.round("x_crd", 3).alias("x_crd"), F.round("y_crd", 3).alias("y_crd"),
                     "row_no", "clm_no", "mtr_no")


def q_cctv_per_cell(spark, sf_dir):
    return ik.cctv_per_cell(fx.fx_cctv_points(spark, sf_dir))


def q_cells_wgs84(spark, sf_dir):
    cells = _pcel_grid(spark, sf_dir).select("grid_id", "cnt_x_crd", "cnt_y_crd")
    df = ik.cells_wgs84(cells).select("grid_id", "cnt_lo", "cnt_la", "min_lo", "min_la", "max_lo", "max_la")
    return _round_degrees(df)


def q_cells_with_cctv(spark, sf_dir):
    return ik.cells_with_cctv(ik.unseen_cells(_cell_days(spark, sf_dir)), _cctv_counts(spark, sf_dir))


def q_new_months(spark, sf_dir):
    source, loaded = fx.fx_partition_lists(spark, sf_dir)
    return ik.new_months(source, loaded)


def q_partition_skew(spark, sf_dir):
    """Rows per partition of the orders dealt by customer number."""
    from footfall.operators.skew import partition_skew
    dealt = _orders(spark, sf_dir).repartitionById(16, F.pmod("cust_id", F.lit(16)).cast("int"))
    return partition_skew(dealt).select(F.col("partition_id").cast("int").alias("partition_id"), "n_rows")


HEAVY_SHARE = 0.02


def q_heavy_keys(spark, sf_dir):
    """Customers that hold a fiftieth or more of the orders of their partition, dealt by customer number."""
    from footfall.operators.skew import heavy_keys
    dealt = _orders(spark, sf_dir).repartitionById(16, F.pmod("cust_id", F.lit(16)).cast("int"))
    return heavy_keys(dealt, "cust_id", HEAVY_SHARE).select(
        F.col("partition_id").cast("int").alias("partition_id"), F.col("key").alias("cust_id"), "n_rows", "partition_rows")


QUERIES.update({
    "csv_feed": q_csv_feed,
    "feed_reconciled": q_feed_reconciled,
    "feed_quarantine": q_feed_quarantine,
    "district_prefix": q_district_prefix,
    "melt_hourly": q_melt_hourly,
    "unpivot_kinds": q_unpivot_kinds,
    "nonzero_population": q_nonzero_population,
    "grid_index": q_grid_index,
    "cell_lookup": q_cell_lookup,
    "cell_lookup_xy": q_cell_lookup_xy,
    "grid_population": q_grid_population,
    "sex_age_ratio": q_sex_age_ratio,
    "female_population": q_female_population,
    "female_population_csv": q_female_population_csv,
    "female_population_colocated": q_female_population_colocated,
    "grid_bounds": q_grid_bounds,
    "grid_population_bounded": q_grid_population_bounded,
    "unseen_cells": q_unseen_cells,
    "register_cells": q_register_cells,
    "points_in_box": q_points_in_box,
    "project_points": q_project_points,
    "cctv_per_cell": q_cctv_per_cell,
    "cells_wgs84": q_cells_wgs84,
    "cells_with_cctv": q_cells_with_cctv,
    "new_months": q_new_months,
    "partition_skew": q_partition_skew,
    "heavy_keys": q_heavy_keys,
})


# ---------------------------------------------------------------- loads (write, then read back)


LOADED_UNTIL = "200006"


def _orders_by_month(spark, sf_dir, run: Scope):
    """Orders as a month-partitioned source table."""
    df = _orders(spark, sf_dir).withColumn(jobs.PARTITION, F.date_format(cu.DAY, "yyyyMM"))
    path = run.path("orders-by-month")
    df.write.partitionBy(jobs.PARTITION).parquet(path)
    return path, df.schema


def _preloaded_target(spark, source_path, schema, run: Scope):
    """A target that already holds the months up to LOADED_UNTIL."""
    target = run.path("orders-loaded")
    old = spark.read.schema(schema).parquet(source_path).where(F.col(jobs.PARTITION) <= LOADED_UNTIL)
    overwrite_partitions(old, target, jobs.PARTITION)
    return target


def q_load_month(spark, sf_dir):
    run = named_scope(spark, "load-month", sf_dir)
    source, schema = _orders_by_month(spark, sf_dir, run)
    target = _preloaded_target(spark, source, schema, run)
    jobs.load_new_months(spark, source, target, schema)
    loaded = jobs.ledger_of(spark, target).entries().where("run != 'found'").select("month").distinct().collect()
    jobs.reload_months(spark, source, target, schema, [r[0] for r in loaded])  # a rerun replaces, never doubles
    return present(spark.read.schema(schema).parquet(target))


def q_load_ledger(spark, sf_dir):
    """The ledger of a target that held the months up to LOADED_UNTIL and then got the others."""
    run = named_scope(spark, "load-ledger", sf_dir)
    source, schema = _orders_by_month(spark, sf_dir, run)
    target = _preloaded_target(spark, source, schema, run)
    jobs.load_new_months(spark, source, target, schema)
    entries = jobs.ledger_of(spark, target).entries()
    return entries.select("month", F.when(F.col("run") == "found", "found").otherwise("loaded").alias("how"), F.col("rows").alias("n_rows"))


def q_intake_stream(spark, sf_dir):
    run = named_scope(spark, "intake-stream", sf_dir)
    source, schema = _orders_by_month(spark, sf_dir, run)
    target = _preloaded_target(spark, source, schema, run)
    run_intake_stream(spark, source, schema, target, run.path("intake-stream-ckpt"), after_month=LOADED_UNTIL)
    return present(spark.read.schema(schema).parquet(target))


def q_grid_intake(spark, sf_dir):
    run = named_scope(spark, "grid-intake", sf_dir)
    src = _bounded_pop(spark, sf_dir)
    source_path = run.path("bounded-source")
    src.write.partitionBy(jobs.PARTITION).parquet(source_path)
    grid_path = run.path("pcel-grid")
    ik.full_grid_rows(_pcel_grid(spark, sf_dir), _cctv_counts(spark, sf_dir)).write.parquet(grid_path)
    fact_path = run.path("pcell-facts")
    jobs.run_grid_intake(spark, source_path, src.schema, fact_path, grid_path, _cctv_counts(spark, sf_dir))
    facts = spark.read.parquet(fact_path).withColumn(jobs.PARTITION, F.col(jobs.PARTITION).cast("string"))
    return present(facts.select(*FACT_COLUMNS))


QUERIES.update({
    "load_month": q_load_month,
    "load_ledger": q_load_ledger,
    "intake_stream": q_intake_stream,
    "grid_intake": q_grid_intake,
})
