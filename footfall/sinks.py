"""Writing results.

Re-running a load must not double its rows, so month loads replace exactly the
partitions they carry (dynamic partition overwrite) instead of appending. That leaves a partition alone that gets no
rows: ``swap_partitions`` also removes those that a load finds empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _clustered(df: DataFrame, partition_col: str) -> DataFrame:
    """Rows brought together by partition, so a month is a few files, not one for each task; a
    month that is too large for one task is split again by adaptive execution."""
    return df.hint("rebalance", F.col(partition_col))


def overwrite_partitions(df: DataFrame, path: str, partition_col: str = "pt_stdr_ym", fmt: str = "parquet") -> None:
    """Idempotent load: replace only the partitions present in ``df``; others stay."""
    (
        _clustered(df, partition_col).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .format(fmt)
        .save(path)
    )


def overwrite_partitions_table(df: DataFrame, table: str, partition_col: str = "pt_stdr_ym") -> None:
    """Same for an existing partitioned catalog table (``insertInto`` matches columns by position)."""
    spark = df.sparkSession
    previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        _clustered(df, partition_col).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def drop_partition(spark: SparkSession, path: str, partition_col: str, value: str) -> None:
    """Removes one partition folder of a path table, wherever Spark keeps it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition_col}={value}")
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def swap_partitions(df: DataFrame, path: str, values: list[str], partition_col: str = "pt_stdr_ym",
                    counts: DataFrame | None = None) -> dict[str, int]:
    """Makes the partitions ``values`` of ``path`` hold exactly ``df``'s rows of them, also where there are none.
    Returns the rows of each. ``counts`` is (partition, rows) of ``df``, where they can be had without making its rows again."""
    overwrite_partitions(df, path, partition_col)
    spark, name = df.sparkSession, F.col(partition_col).cast("string")
    if counts is None:
        counts = df.groupBy(name).count()
    rows = dict.fromkeys(values, 0) | {r[0]: r[1] for r in counts.collect()}        # one row per partition
    for v in values:
        if not rows[v]:
            drop_partition(spark, path, partition_col, v)
    return rows


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_col: str | None = None) -> None:
    """Plain append (for dimensions that only grow, e.g. newly registered grid cells)."""
    writer = df.write.mode("append").format(fmt)
    if partition_col:
        writer = writer.partitionBy(partition_col)
    writer.save(path)


def write_result(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrites ``path`` with a result, as Parquet or as CSV with a header (the spreadsheet export)."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str, properties: dict[str, str],
               partitions: int | None = None) -> None:
    """JDBC sink; ``partitions`` bounds the number of concurrent connections."""
    out = df.repartition(partitions) if partitions else df
    out.write.jdbc(url=url, table=table, mode=mode, properties=properties)
