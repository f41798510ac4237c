"""Month intake as a stream: pick up new source files, reload whole months.

``readStream`` over the partitioned source folder with ``trigger(availableNow)``
processes what has arrived since the last run and stops (a daily batch that
exits when nothing is new). The micro-batches only note which months changed, in a
table beside the stream's checkpoint. After the stream each noted month is read whole
from the source once, however many batches its files were spread over, and
swapped into the target, also if it is empty by then. A note is settled only after that write, so a run that
fails in between loads the month again on the next run; either way the target ends with
exactly one copy of the month.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.jobs import read_or_none as _read_or_none
from footfall.sinks import swap_partitions


def run_intake_stream(spark: SparkSession, source_path: str, schema: StructType, target_path: str,
                      checkpoint_path: str, after_month: str | None = None,
                      partition_col: str = "pt_stdr_ym", max_files_per_trigger: int | None = None) -> None:
    """Load every source month not yet processed (and later than ``after_month``) into ``target_path``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_path)
    if after_month is not None:
        stream = stream.where(F.col(partition_col) > F.lit(after_month))

    noted, settled = f"{checkpoint_path}-months/noted", f"{checkpoint_path}-months/settled"

    def note(batch: DataFrame, batch_id: int) -> None:
        months = batch.select(F.col(partition_col).cast("string").alias("month")).distinct()
        months.withColumn("run", F.lit(run)).coalesce(1).write.mode("append").parquet(noted)

    run = uuid.uuid4().hex
    query = (
        stream.select(partition_col).writeStream
        .foreachBatch(note)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

    notes = _read_or_none(spark, noted)
    if notes is None:
        return
    done = _read_or_none(spark, settled)
    open_notes = notes if done is None else notes.join(done.select("run"), "run", "left_anti")
    found = [(r["month"], r["run"]) for r in open_notes.distinct().collect()]  # bounded by the calendar
    if not found:
        return
    whole = spark.read.schema(schema).parquet(source_path).where(
        F.col(partition_col).cast("string").isin(sorted({m for m, _ in found})))
    swap_partitions(whole, target_path, sorted({m for m, _ in found}), partition_col)
    spark.createDataFrame([(r,) for r in sorted({r for _, r in found})], "run string").write.mode("append").parquet(settled)
