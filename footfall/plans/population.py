"""Population per 50 m cell and hour (Incheon lattice).

Q4 floating population per (day, hour, cell, district) and Q5 estimated female
population per (day, hour, cell). The reference loops over 10 districts x 12
months and reads each slice separately; here a district is a column
(``gu_cd = substring(hcode, 1, 5)``), so all districts and months are one plan.

Order of work: everything that does not depend on the hour (sums across rows,
joins to the grid and to the sex/age ratios) runs on the wide rows, and the
24-fold unpivot comes last, so shuffles and joins move 1/24 of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.constants import DISTRICTS, HOURS, IC_MIN_X, IC_MIN_Y, KINDS
from footfall.functions.columns import (
    female_counts_sql, female_ratio_sql, female_share_sql, hour_sum_sql, lattice_index, row_sum, to_int_nonzero,
)
from footfall.operators.reshape import hours_packed, melt, stack_kinds

FEED_KEYS = ["std_ymd", "hcode", "x_coord", "y_coord"]


def districts(spark: SparkSession) -> DataFrame:
    """The ten district (name, code) pairs: a fixed lookup, broadcast wherever it is joined."""
    return spark.createDataFrame(DISTRICTS, "gu_nm string, gu_cd string")


def district_code(hcode: str = "hcode"):
    return F.substring(hcode, 1, 5)


def in_districts(df: DataFrame, codes: list[str] | None = None, hcode: str = "hcode") -> DataFrame:
    """Rows whose area code starts with one of the district codes (LIKE 'code%', pushed as StringStartsWith)."""
    codes = codes if codes is not None else [c for _, c in DISTRICTS]
    cond = None
    for code in codes:
        c = F.col(hcode).startswith(code)
        cond = c if cond is None else (cond | c)
    return df.where(cond)


def in_days(df: DataFrame, first_ymd: str | None, last_ymd: str | None, col: str = "std_ymd") -> DataFrame:
    """Inclusive yyyyMMdd text range (e.g. the first and last day of a month or year)."""
    if first_ymd is None:
        return df
    return df.where(F.col(col).between(first_ymd, last_ymd))


def district_prefix(feed: DataFrame, spark: SparkSession, codes: list[str] | None = None) -> DataFrame:
    """Feed rows of the chosen districts with their district code and name."""
    rows = in_districts(feed, codes).withColumn("gu_cd", district_code())
    return rows.join(F.broadcast(districts(spark)), "gu_cd", "left").select(
        "std_ymd", "hcode", "gu_cd", "gu_nm", "x_coord", "y_coord"
    )


def hour_totals(feed: DataFrame, keep: list[str]) -> DataFrame:
    """keep + one column per hour "00".."23" = h + w + v of that hour (NULL if any part is NULL)."""
    return feed.selectExpr(*[f"`{c}`" for c in keep], *hour_sum_sql())


def ic_index(df: DataFrame, x: str = "x_coord", y: str = "y_coord") -> DataFrame:
    """Incheon lattice: row_id from x, col_id from y (both upward), mtr_no = 'row,col' (concat_ws skips NULL)."""
    row_id = lattice_index(F.col(x), IC_MIN_X)
    col_id = lattice_index(F.col(y), IC_MIN_Y)
    return df.withColumns({"row_id": row_id, "col_id": col_id, "mtr_no": F.concat_ws(",", row_id, col_id)})


def melt_hourly(feed: DataFrame) -> DataFrame:
    """Hour totals per feed row, indexed, then wide -> long: (stdr_de, mtr_no, gu_cd, stdr_tm, value)."""
    wide = hour_totals(ic_index(feed.withColumn("gu_cd", district_code())), ["std_ymd", "mtr_no", "gu_cd"])
    return melt(wide.withColumnRenamed("std_ymd", "stdr_de"), ["stdr_de", "mtr_no", "gu_cd"], HOURS,
                "stdr_tm", "value")


def cell_lookup(feed: DataFrame, grid: DataFrame) -> DataFrame:
    """Feed rows with their cell id by matrix number; unmatched rows keep a NULL grid_id."""
    idx = ic_index(feed).select("std_ymd", "hcode", "mtr_no")
    return idx.join(grid.select("mtr_no", "grid_id"), "mtr_no", "left")


def attach_cell_xy(feed: DataFrame, grid: DataFrame) -> DataFrame:
    """Feed rows (all columns) matched to grid cells on centre coordinates within the same district (inner).

    A left join followed by ``grid_id IS NOT NULL`` is this inner join.
    """
    g = grid.select(
        F.col("cnt_x_crd").alias("x_coord"), F.col("cnt_y_crd").alias("y_coord"), "grid_id",
        district_code("admd_cd").alias("gu_cd"),
    )
    return feed.withColumn("gu_cd", district_code()).join(g, ["x_coord", "y_coord", "gu_cd"], "inner").drop("gu_cd")


def cell_lookup_xy(feed: DataFrame, grid: DataFrame) -> DataFrame:
    """(feed keys, grid_id) for feed rows whose centre is a grid cell of their district."""
    return attach_cell_xy(feed.select(*FEED_KEYS), grid).select(*FEED_KEYS, "grid_id")


def grid_population(feed: DataFrame, grid: DataFrame, codes: list[str] | None = None,
                    first_ymd: str | None = None, last_ymd: str | None = None) -> DataFrame:
    """Q4: (stdr_de, stdr_tm, gu_cd, fpop_co, grid_id): h+w+v summed per (day, hour, cell, district).

    Sum per (day, cell, district) on the wide rows, join the grid once per cell-day,
    then unpivot the 24 hour sums. Same rows as unpivot -> sum -> join.
    """
    rows = in_days(in_districts(feed, codes), first_ymd, last_ymd).withColumn("gu_cd", district_code())
    wide = hour_totals(ic_index(rows), ["std_ymd", "mtr_no", "gu_cd"])
    per_cell = wide.groupBy(F.col("std_ymd").alias("stdr_de"), "mtr_no", "gu_cd").agg(
        *[F.sum(h).alias(h) for h in HOURS]
    )
    joined = per_cell.join(grid.select("mtr_no", "grid_id"), "mtr_no", "left")
    long_rows = melt(joined, ["stdr_de", "gu_cd", "grid_id"], HOURS, "stdr_tm", "fpop_co")
    return long_rows.select("stdr_de", "stdr_tm", "gu_cd", "fpop_co", "grid_id")


def unpivot_kinds(feed: DataFrame) -> DataFrame:
    """One stack: (std_ymd, hcode, x_coord, y_coord, tm, h_pop, w_pop, v_pop)."""
    return stack_kinds(feed, FEED_KEYS)


def nonzero_population(hourly: DataFrame, exact_zero: bool = False) -> DataFrame:
    """Keep hours where any kind is non-zero; by default compared as integers (|x| < 1 counts as 0)."""
    cond = None
    for k in KINDS:
        c = to_int_nonzero(F.col(f"{k}_pop"), exact_zero)
        cond = c if cond is None else (cond | c)
    return hourly.where(cond)


def sex_age_ratios(sex_age: DataFrame) -> DataFrame:
    """Per feed key: 21 ratios {k}_w_{age}_r = female count / all 14 counts of kind k (0 if that total is 0)."""
    return sex_age.selectExpr(*FEED_KEYS, *female_ratio_sql())


def female_shares(sex_age: DataFrame) -> DataFrame:
    """Per feed key and kind: female share = sum of the seven female counts / the 14-count total.

    Each count is read once, into an array per kind: the plan above carries three columns, not 42.
    """
    return sex_age.selectExpr(*FEED_KEYS, *female_counts_sql()).selectExpr(*FEED_KEYS, *female_share_sql())


def female_population(time_feed: DataFrame, sex_age: DataFrame, grid: DataFrame, codes: list[str] | None = None,
                      exact_zero: bool = False) -> DataFrame:
    """Q5: (stdr_de, stdr_tm, grid_id, pcel_tmzn_fml_co, gu_cd).

    Per hour: sum over kinds of population x female share. Rows need a grid cell
    (same district), a sex/age row, an hour that passes the non-zero test, and a
    non-NULL, non-zero result. Joins run on the wide rows before the hour stack, and the grid is joined to the
    narrow shares, so the wide rows are shuffled and sorted for one join, not for two.

    The 72 hour columns become one array of hours, and the 42 counts three shares, right after the scan,
    so whatever the feeds are (parquet, casts of a CSV's text) the plan above carries a handful of
    columns, and planning does not slow down with their number.

    Feed and shares are merged at every size: Spark judges them by their compressed files, and an array as one element,
    so it would broadcast rows many times the size it sees through the driver.
    """
    feed = hours_packed(in_districts(time_feed, codes), FEED_KEYS).hint("merge")
    shares = attach_cell_xy(female_shares(in_districts(sex_age, codes)), grid)
    wide = feed.join(shares, FEED_KEYS, "inner")
    hourly = wide.select(*FEED_KEYS, "grid_id", *[f"{k}_fml_r" for k in KINDS], F.explode("_hours").alias("_hour")).select(
        *FEED_KEYS, "grid_id", *[f"{k}_fml_r" for k in KINDS], "_hour.*")
    hourly = nonzero_population(hourly, exact_zero)
    total = row_sum([F.col(f"{k}_pop").cast("double") * F.col(f"{k}_fml_r") for k in KINDS])
    return (
        hourly.withColumn("pcel_tmzn_fml_co", total)
        .where(F.col("pcel_tmzn_fml_co") != 0)
        .select(
            F.col("std_ymd").alias("stdr_de"), F.col("tm").alias("stdr_tm"), "grid_id", "pcel_tmzn_fml_co",
            district_code().alias("gu_cd"),
        )
    )
