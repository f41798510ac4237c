"""The '|'-separated CSV feeds: all-string schemas built from the column rule, typed once after reading.

A line with too few or too many fields is never padded or cut: either the read fails on it, or it is kept as it came
in a quarantine table, with the file it came from, and the other lines are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from footfall.constants import AGES, HOURS, KINDS, SEXES

FEED_KEYS = ["std_ymd", "hcode", "x_coord", "y_coord"]
TIME_VALUES = [f"{k}_t_{h}" for k in KINDS for h in HOURS]
SEX_AGE_VALUES = [f"{k}_{s}_{a}" for k in KINDS for s in SEXES for a in AGES]


def _string_schema(values: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in [*FEED_KEYS, *values, "block_cd"]])


TIME_POP_SCHEMA = _string_schema(TIME_VALUES)        # 77 columns
SEX_AGE_POP_SCHEMA = _string_schema(SEX_AGE_VALUES)  # 47 columns


_LINE, _FILE = "_corrupt_line", "_feed_file"


def _feed_reader(spark: SparkSession, schema: StructType):
    # every field is parsed whatever is selected: a pruned parser does not see that a line has others too
    return spark.read.schema(schema).option("sep", "|").option("header", True).option("columnPruning", False)


def read_feed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read one or many months (a folder or glob) in one scan, every field as text; no schema inference. A
    malformed line is an error."""
    return _feed_reader(spark, schema).option("mode", "FAILFAST").csv(path)


def reconciled_feed(spark: SparkSession, path: str, schema: StructType, quarantine: str) -> DataFrame:
    """The well-formed lines of a feed. The malformed ones are appended to the table ``quarantine`` (feed_file, key: its
    first field, line, fields) first, so that none is lost; ``feed_counts`` reconciles the two."""
    marked = _marked_lines(spark, path, schema)
    bad = marked.where(F.col(_LINE).isNotNull()).select(
        F.col(_FILE).alias("feed_file"), F.col(schema.fields[0].name).alias("key"), F.col(_LINE).alias("line"), (F.length(F.regexp_replace(_LINE, r"[^|]", "")) + 1).alias("fields"))
    bad.write.mode("append").parquet(quarantine)
    # Spark refuses a text read of the line alone (a bare count): the test touches the first field as well
    whole = F.concat_ws("", F.col(_LINE), F.substring(schema.fields[0].name, 1, 0)) == ""
    return marked.where(whole).drop(_LINE, _FILE)


def feed_counts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Lines of each file that has any: feed_file, good_lines, bad_lines, and the least and greatest first field."""
    marked = _marked_lines(spark, path, schema)
    return marked.groupBy(F.col(_FILE).alias("feed_file")).agg(
        F.count_if(F.col(_LINE).isNull()).alias("good_lines"), F.count_if(F.col(_LINE).isNotNull()).alias("bad_lines"),
        F.min(schema.fields[0].name).alias("first_key"), F.max(schema.fields[0].name).alias("last_key"))


def _marked_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    marked = StructType([*schema.fields, StructField(_LINE, StringType(), True)])
    lines = _feed_reader(spark, marked).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE).csv(path)
    return lines.withColumn(_FILE, F.col("_metadata.file_name"))


def typed(df: DataFrame, values: list[str], value_type: str, coord_type: str) -> DataFrame:
    """Cast once after reading: malformed numbers become NULL (``try_cast``), never an error.

    The caller states both types. ``double`` keeps whatever decimals the text has; a decimal type
    rounds to its scale. Coordinates take the type of the grid that they are compared with.
    """
    kinds = dict.fromkeys(values, value_type) | dict.fromkeys(("x_coord", "y_coord"), coord_type)
    return df.select(*[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


def write_lines(df: DataFrame, header: str, path: str) -> None:
    """Write whole lines (the only column of ``df``, none empty or null) as they are, under a header a file. Each task
    writes its lines as they come: a feed in parts, neither dealt by month nor sorted."""
    # a CSV of one column that is named like the header, with a separator and a quote that no line has
    plain = {"sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.toDF(header).write.mode("overwrite").options(header=True, **plain).csv(path)


def write_feed(df: DataFrame, path: str) -> None:
    """Write a feed as '|'-separated text with a header (how the feeds arrive)."""
    df.write.mode("overwrite").option("sep", "|").option("header", True).csv(path)
