"""Skew checks of a read or a shuffle: rows per physical partition, and the keys behind the large ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The sketch of n rows and m tracked items is off by at most SKETCH_ERROR * n / m rows for any key.
SKETCH_ERROR = 3.5
_MOST_TRACKED = 1 << 20


def partition_skew(df: DataFrame) -> DataFrame:
    """(partition_id, n_rows) for every non-empty partition of ``df``'s current plan."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("n_rows"))


def heavy_keys(df: DataFrame, key: str, min_share: float = 0.01) -> DataFrame:
    """The keys that hold at least ``min_share`` of their partition's rows: partition_id, key, n_rows, partition_rows,
    sketch_rows (the sketch's count) and error_rows (how far that can be off).

    One pass with Spark's approximate top-k aggregate, a sketch of bounded size for each partition that is merged
    map-side, names the candidates: with 2 * SKETCH_ERROR / min_share tracked items its error is under half the wanted share, so
    no such key is missed. A second pass counts the candidates exactly. NULL is a key like any other.
    """
    if not 2 * SKETCH_ERROR / _MOST_TRACKED <= min_share <= 1:
        raise ValueError("min_share out of range")
    most = int(1 / min_share)
    tracked = 1 << max(4, int(2 * SKETCH_ERROR / min_share) - 1).bit_length()
    dealt = df.select(F.spark_partition_id().alias("partition_id"), F.col(key).alias("key"))
    sketch = dealt.groupBy("partition_id").agg(
        F.expr(f"approx_top_k(key, {min(most + 1, tracked)}, {tracked})").alias("_top"), F.count(F.lit(1)).alias("partition_rows"),
        F.count_if(F.col("key").isNull()).alias("_nulls"))
    bound = F.ceil(F.lit(SKETCH_ERROR) * F.col("partition_rows") / tracked)
    named = sketch.select("partition_id", "partition_rows", bound.alias("error_rows"), F.explode("_top").alias("_t")).select(
        "partition_id", "partition_rows", "error_rows", F.col("_t.item").alias("key"), F.col("_t.count").alias("sketch_rows"))
    nulls = sketch.where("_nulls > 0").select(
        "partition_id", "partition_rows", F.lit(0).cast("long").alias("error_rows"),
        F.lit(None).cast(df.schema[key].dataType).alias("key"), F.col("_nulls").alias("sketch_rows"))
    candidates = named.where("key IS NOT NULL").unionByName(nulls).where(F.col("sketch_rows") + F.col("error_rows") >= min_share * F.col("partition_rows"))
    exact = dealt.groupBy("partition_id", "key").agg(F.count(F.lit(1)).alias("n_rows"))
    c, e = candidates.alias("c"), exact.alias("e")
    same = (F.col("c.partition_id") == F.col("e.partition_id")) & F.col("c.key").eqNullSafe(F.col("e.key"))
    return c.join(e, same).where(F.col("e.n_rows") >= min_share * F.col("c.partition_rows")).select(
        "c.partition_id", "c.key", "e.n_rows", "c.partition_rows", "c.sketch_rows", "c.error_rows")
