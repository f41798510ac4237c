"""Jobs with side effects: month loads and the grid intake. The only module that writes.

Order of the grid intake: months to load (Q9) -> cell-day sums for all of them in
one plan (Q6) -> register unseen cells (Q7) and append them to the grid -> join
the enlarged grid -> replace the months' fact partitions -> note the months in the ledger. Intermediate results
that are used twice are tables of a scope in the shared checkpoint folder, which also
cuts lineage so a lost executor does not replay the whole month; they go when the run ends.
"""

from __future__ import annotations

import logging
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from footfall.constants import FACT_COLUMNS, HOURS
from footfall.plans import intake as ik
from footfall.scratch import scope
from footfall.sinks import append, overwrite_partitions_table, path_exists, swap_partitions

PARTITION = "pt_stdr_ym"
log = logging.getLogger("footfall.jobs")


@contextmanager
def job_step(spark: SparkSession, group: str, description: str):
    """Label the Spark jobs of a step and log its elapsed time. A caller's own job group stays, so that the
    step's jobs can still be cancelled and counted by it; without one the step's group is set. Both labels are as before
    at the end."""
    sc = spark.sparkContext
    names = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")
    before = {n: sc.getLocalProperty(n) for n in names}
    if before[names[0]] is None:
        sc.setJobGroup(group, description, interruptOnCancel=True)
    else:
        sc.setLocalProperty(names[1], f"{group}: {description}")
    start = time.monotonic()
    try:
        yield
    finally:
        log.info("%s: %s took %.1f s", group, description, time.monotonic() - start)
        for name, value in before.items():
            sc.setLocalProperty(name, value)


def read_or_none(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # an unreadable table is an error, not an empty one
            raise
        return None


def table_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Partitions of a catalog table from its metadata; no data file is opened."""
    return spark.sql(f"SHOW PARTITIONS {table}")


def path_partitions(spark: SparkSession, path: str, schema: StructType, partition_col: str = PARTITION) -> DataFrame:
    """Partitions of a path table ('pt_stdr_ym=YYYYMM'), from its folders alone: a table over the path with recovered
    partitions, dropped again afterwards (the files are not its own). A path that is not there has none."""
    found: list = []
    if path_exists(spark, path):
        name = f"months_of_{uuid.uuid4().hex}"
        # one column beside the partition makes it a table; none is read
        beside = next(f for f in schema.fields if f.name != partition_col)
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (beside, schema[partition_col]))
        where = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet PARTITIONED BY (`{partition_col}`) LOCATION '{where}'")
        try:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            found = [(r[0],) for r in table_partitions(spark, name).collect()]     # bounded by the calendar
        finally:
            spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(found, "partition string")


def _as_partitions(spark: SparkSession, months: list[str]) -> DataFrame:
    return spark.createDataFrame([(f"{PARTITION}={m}",) for m in months], "partition string")


def months_to_load(source: DataFrame, loaded: DataFrame, gaps: bool = False, max_months: int | None = None) -> DataFrame:
    """Q9 over two partition lists: (pt_stdr_ym), every source month when nothing is loaded yet.

    ``gaps`` also lists months before the last loaded one that are not loaded; ``max_months`` keeps
    the earliest so many (1: one month per run).
    """
    months = (ik.missing_months if gaps else ik.new_months)(source, loaded)
    if max_months is not None:
        months = months.orderBy("year_month").limit(max_months)
    return months.select(F.col("year_month").cast("string").alias(PARTITION))


# ------------------------------------------------------------------ ledger

class Ledger:
    """What has been loaded into a target: an append-only table (source, month, run, rows).

    A month is noted after its partition has been swapped, so a run that ends in between loads it again, which
    changes nothing, and notes it then. Months without rows are noted too: they have no partition to be seen
    by. A target that was filled before it had a ledger is noted once as found, without a row count. One writer at a time.
    """

    SCHEMA = "source string, month string, run string, rows long"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame | None:
        return read_or_none(self.spark, self.path)

    def note(self, source: str, rows: dict[str, int | None], run: str | None = None) -> None:
        run = run or uuid.uuid4().hex
        made = self.spark.createDataFrame([(source, m, run, n) for m, n in sorted(rows.items())], self.SCHEMA)
        append(made.coalesce(1), self.path)

    def loaded(self, target: DataFrame) -> DataFrame:
        """Partition list of the months noted; ``target``, the target's own list, starts the ledger."""
        if self.entries() is None:
            there = target.select(ik.partition_month().cast("string").alias("m")).where("m IS NOT NULL").distinct()
            self.note("target", {r["m"]: None for r in there.collect()}, "found")
        months = [r[0] for r in self.entries().select("month").distinct().collect()]     # bounded by the calendar
        return _as_partitions(self.spark, months)


def ledger_of(spark: SparkSession, target_path: str) -> Ledger:
    """The ledger beside a path table."""
    return Ledger(spark, f"{target_path.rstrip('/')}-ledger")


# ------------------------------------------------------------------ month loads

def load_new_months(spark: SparkSession, source_path: str, target_path: str, schema: StructType,
                    gaps: bool = False, max_months: int | None = None) -> int:
    """Load source months newer than the last loaded one; swapped partitions make a rerun a no-op.

    Both month lists come from folders and the ledger, so no file is opened to find out that there is nothing to do.
    Returns the number of months loaded (0: the caller stops there). ``gaps`` and ``max_months`` as in ``months_to_load``.
    """
    ledger = ledger_of(spark, target_path)
    with job_step(spark, "month-load", "find months to load"):
        source = path_partitions(spark, source_path, schema)
        loaded = ledger.loaded(path_partitions(spark, target_path, schema))
        found = [r[0] for r in months_to_load(source, loaded, gaps, max_months).collect()]
    if found:
        reload_months(spark, source_path, target_path, schema, found)
    return len(found)


def reload_months(spark: SparkSession, source_path: str, target_path: str, schema: StructType,
                  months: list[str]) -> None:
    """Make the given months of the target what they are in the source, also where they are empty now, and note them."""
    ledger = ledger_of(spark, target_path)
    ledger.loaded(path_partitions(spark, target_path, schema))
    rows = spark.read.schema(schema).parquet(source_path).where(F.col(PARTITION).cast("string").isin(months))
    with job_step(spark, "month-load", "write months"):
        written = swap_partitions(rows.select(*schema.fieldNames()), target_path, months, PARTITION)
    with job_step(spark, "month-load", "note months"):
        ledger.note(source_path, written)


def load_new_months_table(spark: SparkSession, source: str, target: str, gaps: bool = False,
                          max_months: int | None = None, ledger_path: str | None = None) -> int:
    """``load_new_months`` between catalog tables, both partitioned by month: months come from the
    tables' metadata, rows of those months only are read, and the target's partitions are replaced. With
    ``ledger_path`` what is loaded comes from a ledger there, else from the target's partitions."""
    ledger = Ledger(spark, ledger_path) if ledger_path else None
    loaded = table_partitions(spark, target)
    if ledger:
        loaded = ledger.loaded(loaded)
    found = [r[0] for r in months_to_load(table_partitions(spark, source), loaded, gaps, max_months).collect()]
    if found:
        rows = spark.table(source).where(F.col(PARTITION).cast("string").isin(found))
        overwrite_partitions_table(rows.select(*spark.table(target).columns), target, PARTITION)
        counts = dict.fromkeys(found, 0) | {r[0]: r[1] for r in rows.groupBy(F.col(PARTITION).cast("string")).count().collect()}
        for month in (m for m, n in counts.items() if not n):
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION (`{PARTITION}`='{month}')")
        if ledger:
            ledger.note(source, counts)
    return len(found)


def run_grid_intake(spark: SparkSession, source_path: str, source_schema: StructType, fact_path: str,
                    grid_path: str, cctv_counts: DataFrame) -> dict:
    """Load new months into the fact table, registering unseen cells in the grid first."""
    source = spark.read.schema(source_schema).parquet(source_path)
    ledger = ledger_of(spark, fact_path)
    with job_step(spark, "grid-intake", "find months to load"):
        fact_key = StructType([StructField("stdr_de", StringType()), StructField(PARTITION, StringType())])
        loaded = ledger.loaded(path_partitions(spark, fact_path, fact_key))
        found = [r[0] for r in months_to_load(path_partitions(spark, source_path, source_schema), loaded).collect()]
    if not found:
        return {"months": 0, "new_cells": 0}

    with scope(spark) as own:          # what the steps share; gone when the facts are written
        grid = spark.read.parquet(grid_path)
        with job_step(spark, "grid-intake", "cell-day sums of the new months"):
            months = spark.createDataFrame([(m,) for m in found], f"{PARTITION} string")     # bounded by the calendar
            cell_days = own.table(ik.bounded_cell_days(source, grid, months), "cell-days")

        with job_step(spark, "grid-intake", "register unseen cells"):
            new_cells = own.table(ik.register_cells(ik.unseen_cells(cell_days), grid, cctv_counts, scope=own), "new-cells")
            n_new = new_cells.count()
            if n_new:
                append(new_cells, grid_path)

        with job_step(spark, "grid-intake", "write month facts"):
            grid_now = spark.read.parquet(grid_path).select("mtr_no", "grid_id")
            known = cell_days.drop("grid_id").join(grid_now, "mtr_no", "left").where(F.col("grid_id").isNotNull())
            facts = ik.grid_population_bounded(known)
            # the facts are made once, where they are written; each cell-day is one fact an hour
            month = F.substring("stdr_de", 1, 6).alias(PARTITION)
            counts = known.groupBy(month).agg(F.count(F.lit(1)) * len(HOURS))
            written = swap_partitions(facts.select(*FACT_COLUMNS), fact_path, found, PARTITION, counts)
        ledger.note(source_path, written)
    return {"months": len(found), "new_cells": n_new}
