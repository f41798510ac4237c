"""Gap-free sequential ids in (row, col) order without a window over all rows.

Two passes. The rows are dealt by ranges of (row, col), sorted, and written with their place inside their
partition; then the partitions' sizes, one number each, are added up in order, and a row's id is its
partition's start plus its place. Ranges are cut from a sample of the data, so neither a long row nor a high
lattice makes a large partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.scratch import Scope, scope as own_scope

_AT, _PART, _BEFORE = "_at", "_part", "_before"
#: monotonically_increasing_id: the partition above this bit, the place below it.
_PLACE_BITS = 33


def assign_sequential_ids(df: DataFrame, row_col: str, col_col: str, start_after: Column,
                          id_col: str = "seq", scope: Scope | None = None) -> DataFrame:
    """Add ``id_col`` = start_after + 1, 2, ... in (row_col, col_col) order; (row, col) must be unique."""
    spark = df.sparkSession
    ordered = df.repartitionByRange(row_col, col_col).sortWithinPartitions(row_col, col_col)
    # written: places must not be dealt anew between the passes
    placed = (scope or own_scope(spark)).table(ordered.withColumn(_AT, F.monotonically_increasing_id()), "placed")
    part = F.shiftright(_AT, _PLACE_BITS)
    sizes = placed.groupBy(part.alias(_PART)).agg(F.count(F.lit(1)).alias("n")).orderBy(_PART).collect()   # one row per partition
    before, starts = 0, []
    for r in sizes:
        starts.append((r[_PART], before))
        before += r["n"]
    offsets = spark.createDataFrame(starts, f"{_PART} long, {_BEFORE} long")
    place = F.col(_AT).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        placed.withColumn(_PART, part).join(F.broadcast(offsets), _PART)
        .withColumn(id_col, (start_after + F.col(_BEFORE) + place + 1).cast("long"))
        .drop(_AT, _PART, _BEFORE)
    )
