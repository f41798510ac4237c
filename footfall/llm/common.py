"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import re
import string

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import scratch_path

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Name of the row number that operators add; long so that it clashes with no input column.
UID = "__footfall_row"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def lower_az(c: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def fold(name: str, n: int) -> Column:
    """crc32(id as text) mod n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % n


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe when executors are lost."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """Adds a row number. It is only stable once the frame has been written."""
    return df.withColumn(UID, F.monotonically_increasing_id())


def _plain_scan(df: DataFrame) -> bool:
    """Whether ``df`` is one scan with nothing but projections and filters above it, by its analysed plan."""
    plan = df._jdf.queryExecution().analyzed().toString().strip().split("\n")
    return all(re.match(r"[\s+-]*(Project|Filter|SubqueryAlias|Relation)\b", line) for line in plan)


def identified(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` with a stable row identity in UID: the file and the row's place in it where ``df`` is a plain scan
    of files, which holds however the files are split; otherwise (rows made by generators, joins, unions
    or aggregates) the frame is numbered and written."""
    if _plain_scan(df):
        try:
            at = df.metadataColumn("_metadata")
            return df.withColumn(UID, F.struct(at["file_path"].alias("file"), at["row_index"].alias("row")))
        except AnalysisException:
            pass                                     # a source without file metadata
    return written(spark, numbered(df), name)
