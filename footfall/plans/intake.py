"""Bounded national grid: month intake, unseen-cell registration, CCTV counts.

Q6 facts per (day, hour, cell), Q7 new grid cells with sequential ids and WGS84
corners, Q8 CCTV points per cell, Q9 months still to load. The reference runs
24 hour passes per month and moves new cells through pandas; here one plan per
step, the hour unpivot last, ids from a range partitions and their sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.constants import (
    CCTV_LA_MAX, CCTV_LA_MIN, CCTV_LO_MAX, CCTV_LO_MIN, FACT_COLUMNS, GRID_COLUMNS, HALF_CELL, HOURS, PCELL_MAX_ROW, PCELL_X, PCELL_Y,
)
from footfall.functions.columns import grid_id_text, hour_sum_sql, id_number, lattice_index
from footfall.functions.geo import to_tm, to_wgs84_many
from footfall.operators.ids import assign_sequential_ids
from footfall.operators.reshape import melt
from footfall.scratch import Scope

CELL_KEYS = ["stdr_de", "admd_cd", "cnt_x_crd", "cnt_y_crd"]


def service_rows(source: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """Source months (all, or those in ``months.pt_stdr_ym``) with the fact table's column names."""
    if months is not None:
        source = source.join(F.broadcast(months.select("pt_stdr_ym")), "pt_stdr_ym", "left_semi")
    return source.drop("block_cd").withColumnsRenamed(
        {"std_ymd": "stdr_de", "hcode": "admd_cd", "x_coord": "cnt_x_crd", "y_coord": "cnt_y_crd"}
    )


def bounded_index(df: DataFrame, x: str = "cnt_x_crd", y: str = "cnt_y_crd") -> DataFrame:
    """row_no from x (rightward of PCELL_X), clm_no from y (downward of PCELL_Y), truncated; mtr_no = 'row,clm'.

    ``concat`` (not ``concat_ws``): a NULL index gives a NULL mtr_no.
    """
    row_no = lattice_index(F.col(x), PCELL_X)
    clm_no = lattice_index(F.col(y), PCELL_Y, downward=True)
    return df.withColumns({
        "row_no": row_no,
        "clm_no": clm_no,
        "mtr_no": F.concat(row_no.cast("string"), F.lit(","), clm_no.cast("string")),
    })


def in_bounds(df: DataFrame) -> DataFrame:
    """First index >= 0 and second <= 910 (the bound is one-sided on each axis)."""
    return df.where((F.col("row_no") >= 0) & (F.col("clm_no") <= PCELL_MAX_ROW))


def grid_bounds(source: DataFrame) -> DataFrame:
    """Distinct source cells with their lattice index, kept when inside the bounds."""
    cells = service_rows(source).select("admd_cd", "cnt_x_crd", "cnt_y_crd").distinct()
    return in_bounds(bounded_index(cells)).select("admd_cd", "cnt_x_crd", "cnt_y_crd", "row_no", "clm_no", "mtr_no")


def bounded_cell_days(source: DataFrame, grid: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """Per (day, area, x, y): 24 hour sums of h+w+v, lattice index, bounds, grid id (left join)."""
    rows = service_rows(source, months)
    wide = rows.selectExpr(*CELL_KEYS, *hour_sum_sql())
    per_cell = wide.groupBy(*CELL_KEYS).agg(*[F.sum(h).alias(h) for h in HOURS])
    indexed = in_bounds(bounded_index(per_cell))
    return indexed.join(grid.select("mtr_no", "grid_id"), "mtr_no", "left")


def grid_population_bounded(cell_days: DataFrame) -> DataFrame:
    """Q6: hour facts (stdr_de, stdr_tm, grid_id, admd_cd, gu_cd, fpop_co, pt_stdr_ym); unseen cells have NULL grid_id."""
    long_rows = melt(cell_days, [*CELL_KEYS, "mtr_no", "grid_id"], HOURS, "stdr_tm", "fpop_co")
    return long_rows.select(
        "stdr_de", "stdr_tm", "grid_id", "admd_cd",
        F.substring("admd_cd", 1, 5).alias("gu_cd"), "fpop_co",
        F.substring("stdr_de", 1, 6).alias("pt_stdr_ym"),
    )


def unseen_cells(cell_days: DataFrame) -> DataFrame:
    """Cells without a grid id, one row each; the representative is the smallest (area, x, y)."""
    pick = F.min(F.struct("admd_cd", "cnt_x_crd", "cnt_y_crd", "row_no", "clm_no")).alias("_r")
    return (
        cell_days.where(F.col("grid_id").isNull())
        .groupBy("mtr_no").agg(pick)
        .select("mtr_no", "_r.admd_cd", "_r.cnt_x_crd", "_r.cnt_y_crd", "_r.row_no", "_r.clm_no")
    )


def last_grid_number(grid: DataFrame) -> int:
    """Largest numeric id suffix in the grid dimension (0 when empty): one scalar to the driver."""
    value = grid.agg(F.max(id_number(F.col("grid_id")))).first()[0]
    return int(value or 0)


def cell_corners(cells: DataFrame) -> DataFrame:
    """Cell extent: centre +- 25 m as decimal(18,8)."""
    x, y = F.col("cnt_x_crd"), F.col("cnt_y_crd")
    dec = "decimal(18,8)"
    return cells.withColumns({
        "min_x_crd": (x - HALF_CELL).cast(dec), "max_x_crd": (x + HALF_CELL).cast(dec),
        "min_y_crd": (y - HALF_CELL).cast(dec), "max_y_crd": (y + HALF_CELL).cast(dec),
    })


def cells_wgs84(cells: DataFrame) -> DataFrame:
    """Centre and corners of each cell in degrees (EPSG:5179 -> EPSG:4326)."""
    return to_wgs84_many(cell_corners(cells), [
        ("cnt_x_crd", "cnt_y_crd", "cnt_lo", "cnt_la"),
        ("min_x_crd", "min_y_crd", "min_lo", "min_la"),
        ("max_x_crd", "max_y_crd", "max_lo", "max_la"),
    ])


def register_cells(unseen: DataFrame, grid: DataFrame, cctv_counts: DataFrame, last_number: int | None = None,
                   scope: Scope | None = None) -> DataFrame:
    """Q7: new grid rows (18 columns): ids after the last one in (row_no, clm_no) order, corners, WGS84, CCTV count.

    One writer at a time: two concurrent registrations would hand out the same ids.
    """
    last = last_grid_number(grid) if last_number is None else last_number
    with_ids = assign_sequential_ids(unseen, "row_no", "clm_no", F.lit(last), "_seq", scope)
    return full_grid_rows(with_ids.withColumn("grid_id", grid_id_text(F.col("_seq"))), cctv_counts)


def full_grid_rows(cells_with_ids: DataFrame, cctv_counts: DataFrame) -> DataFrame:
    """Grid rows that already carry ids (grid_id, row_no, clm_no, mtr_no, admd_cd, cnt_x/y) in the 18-column form."""
    rows = cells_wgs84(cells_with_ids).join(cctv_counts.select("mtr_no", "cctv_co"), "mtr_no", "left")
    return rows.withColumn("cctv_co", F.coalesce(F.col("cctv_co"), F.lit(0)).cast("long")).select(*GRID_COLUMNS)


# ------------------------------------------------------------------ CCTV points (Q8)

def points_in_box(points: DataFrame) -> DataFrame:
    """CCTV points inside the longitude/latitude box, rows with any NULL dropped."""
    return points.where(
        F.col("lo").between(float(CCTV_LO_MIN), float(CCTV_LO_MAX))
        & F.col("la").between(float(CCTV_LA_MIN), float(CCTV_LA_MAX))
    ).dropna()


def project_points(points: DataFrame) -> DataFrame:
    """Points in the box projected to EPSG:5179 (x, y) with their bounded-grid cell."""
    projected = to_tm(points_in_box(points), "lo", "la", "x_crd", "y_crd")
    return bounded_index(projected, "x_crd", "y_crd")


def cctv_per_cell(points: DataFrame) -> DataFrame:
    """Q8: (mtr_no, cctv_co) = CCTV points per bounded-grid cell."""
    return project_points(points).groupBy("mtr_no").agg(F.count("lo").alias("cctv_co"))


def cctv_counts_of(cells: DataFrame) -> DataFrame:
    """Counts per cell for already indexed CCTV rows (mtr_no, lo)."""
    return cells.groupBy("mtr_no").agg(F.count("lo").alias("cctv_co"))


def cells_with_cctv(unseen: DataFrame, cctv_counts: DataFrame) -> DataFrame:
    """Unseen cells with their CCTV count, 0 where none."""
    return (
        unseen.select("mtr_no").join(cctv_counts, "mtr_no", "left")
        .select("mtr_no", F.coalesce(F.col("cctv_co"), F.lit(0)).cast("long").alias("cctv_co"))
    )


# ------------------------------------------------------------------ months to load (Q9)

def partition_month(partition: str = "partition"):
    """YYYYMM at the end of a partition spec such as 'pt_stdr_ym=202207', as a number. NULL for a partition without a
    month (the default partition of rows whose month is NULL): it is no month, so it is neither listed nor loaded."""
    return F.regexp_extract(F.col(partition), r"([0-9]{6})$", 1).try_cast("int")


def new_months(source_partitions: DataFrame, loaded_partitions: DataFrame) -> DataFrame:
    """Q9: source months later than the last loaded month (all of them when nothing is loaded yet)."""
    last = loaded_partitions.agg(F.max(partition_month()).alias("m")).first()["m"] or 0
    return (
        source_partitions.select(partition_month().alias("year_month"))
        .where(F.col("year_month") > F.lit(int(last)))
        .distinct()
    )


def missing_months(source_partitions: DataFrame, loaded_partitions: DataFrame) -> DataFrame:
    """Source months that are not loaded, whether later than the last loaded one or a gap before it."""
    source = source_partitions.select(partition_month().alias("year_month")).where("year_month IS NOT NULL").distinct()
    return source.join(loaded_partitions.select(partition_month().alias("year_month")), "year_month", "left_anti")
