"""The stream intake reloads whole months, so batches that split a month never duplicate or lose rows."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from footfall.session import scratch_path
from footfall.sources import fixtures as fx
from footfall.streaming.intake_stream import run_intake_stream


def test_split_month_over_batches(spark):
    orders = (fx.fx_orders(spark, SF_SMALL).withColumn("pt_stdr_ym", F.date_format("ordr_de", "yyyyMM"))
              .where(F.col("pt_stdr_ym").between("200001", "200003")))  # three months keep the test short
    source = scratch_path(spark, "stream-src")
    # several files per month, one file per micro-batch
    orders.repartition(3).write.partitionBy("pt_stdr_ym").parquet(source)
    target = scratch_path(spark, "stream-dst")
    run_intake_stream(spark, source, orders.schema, target, scratch_path(spark, "stream-ckpt"),
                      max_files_per_trigger=1)
    got = spark.read.schema(orders.schema).parquet(target)
    assert got.count() == orders.count()
    assert got.exceptAll(orders).count() == 0 and orders.exceptAll(got).count() == 0
    # a second run finds nothing new and changes nothing
    run_intake_stream(spark, source, orders.schema, target, scratch_path(spark, "stream-ckpt2"))
    assert spark.read.schema(orders.schema).parquet(target).count() == orders.count()
