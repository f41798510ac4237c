"""Scratch tables with an owner: what a run writes for itself goes when the run ends.

A scope is one folder under the shared checkpoint folder. Intermediates that are used twice are tables in it
(written once, so no lineage to replay after a lost executor). Jobs open a scope in a ``with`` statement and leave
nothing behind. A query returns a frame that still reads its tables, so its scope cannot end with it: it is opened by
name, and opening it again removes what the run before has left. A frame of a named scope is valid until then.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from footfall.session import ensure_checkpoint_dir


class Scope:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        """A fresh path in the scope."""
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once and read back."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def close(self) -> None:
        """Removes the scope's folder, wherever Spark keeps it."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(conf).delete(path, True)

    def __enter__(self) -> Scope:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def scope(spark: SparkSession) -> Scope:
    """A scope of its own."""
    return Scope(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/scope-{uuid.uuid4().hex[:12]}")


def named_scope(spark: SparkSession, name: str, about: str = "") -> Scope:
    """The application's scope of this name (and of what it is about, a folder for instance), emptied."""
    mark = hashlib.sha256(about.encode()).hexdigest()[:8]
    found = Scope(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}-{name}-{mark}")
    found.close()
    return found
