"""Reading the source tables.

Parquet is the native source: splits, column pruning and predicate pushdown come
from the scan. JDBC is kept for parity with a database-backed deployment; the
factory takes its settings from the caller, never from code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the test set; callers select columns so only those are read."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def jdbc_reader(spark: SparkSession, url: str, user: str | None = None, password: str | None = None,
                driver: str | None = None, **options: str) -> DataFrameReader:
    """A shared JDBC reader with connection options filled in (credentials come from the caller)."""
    reader = spark.read.format("jdbc").option("url", url)
    if user is not None:
        reader = reader.option("user", user)
    if password is not None:
        reader = reader.option("password", password)
    if driver is not None:
        reader = reader.option("driver", driver)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader


def jdbc_split_read(reader: DataFrameReader, dbtable: str, column: str, lower: int, upper: int,
                    partitions: int) -> DataFrame:
    """Split a JDBC read into ranges of a numeric key (one query per range, run in parallel).

    Split on the grouping key so each range holds whole groups; bounds come from
    ``read_bounds`` on the same filter.
    """
    return (
        reader.option("dbtable", dbtable)
        .option("partitionColumn", column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )
