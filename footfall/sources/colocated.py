"""Feeds and grid stored bucketed by cell centre, so that they join where they lie.

At a scale where none of them fits a broadcast, the hourly feed, the sex/age feed and the grid would each be shuffled
for every run of the joins on (x, y). Stored in the same number of buckets of (x, y) they are shuffled once, when they
are written. The joins have further keys (district, day, area), and Spark takes a table bucketed by some of the keys as
it lies only under ``CO_PARTITIONED``; the caller's session decides, and without it the result is the same. Their joins
are merge joins: the size of a table's compressed files says little of what the driver would hold to broadcast it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CELL = ("x_coord", "y_coord")
#: Session setting under which buckets of a part of the join's keys count.
CO_PARTITIONED = ("spark.sql.requireAllClusterKeysForCoPartition", "false")
BUCKET_ROWS = 500_000


def buckets_for(df: DataFrame, bucket_rows: int = BUCKET_ROWS, least: int = 8) -> int:
    """A power of two of buckets with about ``bucket_rows`` rows each: feeds that grow are dealt anew at twice the number."""
    wanted = max(least, -(-df.count() // bucket_rows))
    return 1 << (wanted - 1).bit_length()


def store(df: DataFrame, name: str, path: str, buckets: int, keys: tuple[str, str] = CELL) -> None:
    """``df`` as the external table ``name`` in ``path``, one file a bucket, sorted by cell within it."""
    df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option(
        "path", path).saveAsTable(name)


def stored(spark: SparkSession, frames: dict[str, DataFrame], path: str, prefix: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """The frames (each with the columns of ``CELL``) as tables in the buckets that the largest of them needs, to be merged."""
    buckets = buckets or max(buckets_for(df) for df in frames.values())
    for name, df in frames.items():
        store(df, f"{prefix}_{name}", f"{path}/{name}", buckets)
    return {name: spark.table(f"{prefix}_{name}").hint("merge") for name in frames}
