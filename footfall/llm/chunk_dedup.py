"""Exact dedup by content-defined chunk recipes.

A text is cut where a rolling hash of its last 32 bytes hits a pattern, so the cuts depend
on the bytes alone and equal texts have equal cuts. Each chunk gets a 64-bit identifier.
The identifiers are verified over the whole corpus: distinct chunk bytes are counted per
identifier, and the rare identifier with two different byte strings is told apart by a
rank among them. Two texts are then equal exactly when their ordered identifier lists are,
so from there on only the lists move, never the texts again.

Defined results: a null text counts as the empty text, whose list is empty; repeated rows
are rows of the same group, of which one stays (the largest doc_id, then the last row);
null doc_ids sort lowest; other columns of the input are ignored or carried unchanged.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.llm.common import UID, documents, identified, whole_text, written

#: Chunk sizes in bytes: a cut is looked for after LEAST bytes, comes every 2**CUT_BITS bytes
#: on average after that, and is forced at MOST bytes.
LEAST, CUT_BITS, MOST = 512, 10, 16384
_WINDOW = 32
_SEGMENT = 1 << 20
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=7) for b in range(256)], dtype=np.uint32)


def _candidates(data: np.ndarray, cut_bits: int) -> np.ndarray:
    """Ends (exclusive) at which the rolling hash of the 32 bytes before has its top bits zero."""
    found = []
    for at in range(0, len(data), _SEGMENT):
        lead = min(at, _WINDOW - 1)
        h = _GEAR[data[at - lead:at + _SEGMENT]]
        k = 1
        while k < _WINDOW:
            h[k:] += h[:-k] << np.uint32(k)
            k *= 2
        found.append(np.flatnonzero(h[lead:] >> np.uint32(32 - cut_bits) == 0) + at + 1)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunks(text: bytes, cut_bits: int = CUT_BITS) -> list[bytes]:
    """The content-defined chunks of a text, in order; none for the empty text."""
    ends, last, n = _candidates(np.frombuffer(text, np.uint8), cut_bits), 0, len(text)
    out = []
    while n - last > LEAST:
        i = int(np.searchsorted(ends, last + LEAST))
        end = min(int(ends[i]) if i < len(ends) else n, last + MOST, n)
        out.append(text[last:end])
        last = end
    if last < n:
        out.append(text[last:])
    return out


def _ids(parts: Iterable[bytes], id_bits: int) -> list[int]:
    drop = 64 - id_bits
    return [(xxhash.xxh64_intdigest(p) >> drop) - (1 << (id_bits - 1)) for p in parts]


def _with_recipes(df: DataFrame, body: str, id_bits: int, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``recipe``, the ordered chunk identifiers of the binary column ``body``."""
    schema = df.select(*keep, F.array(F.lit(0).cast("long")).alias("recipe")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            recipes = [_ids(chunks(t.as_py()), id_bits) for t in b.column(body)]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(recipes, pa.list_(pa.int64()))], [*keep, "recipe"])

    return df.mapInArrow(run, schema)


def _chunk_rows(df: DataFrame, id_bits: int, key: str | None = None) -> DataFrame:
    """One row for each chunk: id, chunk, and with ``key`` the row it is from and its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                cut = [chunks(t.as_py()) for t in part.column("body")]
                flat = [c for x in cut for c in x]
                cols = {"id": pa.array(_ids(flat, id_bits), pa.int64()), "chunk": pa.array(flat, pa.binary())}
                if key:
                    rows = part.column(key)
                    cols["row"] = rows.take(pa.array(np.repeat(np.arange(len(cut)), [len(x) for x in cut])))
                    cols["place"] = pa.array([i for x in cut for i in range(len(x))], pa.int64())
                yield pa.RecordBatch.from_pydict(cols)

    row = f", row {df.schema[key].dataType.simpleString()}, place long" if key else ""
    return df.mapInArrow(run, "id long, chunk binary" + row)


def clashing_ids(bodies: DataFrame, id_bits: int = 64) -> DataFrame:
    """Identifiers that stand for two or more different chunks. Map-side aggregation leaves one
    copy of a chunk for each task, so a chunk that a third of all texts share stays cheap."""
    per_id = _chunk_rows(bodies, id_bits).groupBy("id").agg(F.count_distinct("chunk").alias("n"))
    return per_id.where("n > 1").select("id")


def _told_apart(bodies: DataFrame, recipes: DataFrame, clashes: DataFrame, id_bits: int) -> DataFrame:
    """Recipes whose clashing identifiers carry the rank of their chunk among those of the same id."""
    rows = _chunk_rows(bodies, id_bits, UID).join(clashes, "id")
    by_chunk = Window.partitionBy("id").orderBy("chunk")
    ranks = rows.select("id", "chunk").distinct().withColumn("rank", F.rank().over(by_chunk).cast("long"))
    marks = (rows.join(ranks, ["id", "chunk"]).groupBy("row")
             .agg(F.sort_array(F.collect_list(F.struct("place", "rank"))).alias("marks"))
             .withColumnRenamed("row", UID))
    both = recipes.join(marks, UID, "left")
    flat = F.expr("concat(recipe, flatten(transform(coalesce(marks, array()), m -> array(m.place, m.rank))))")
    return both.withColumn("recipe", flat).drop("marks")


def exact_groups(spark: SparkSession, rows: DataFrame, id_bits: int = 64) -> DataFrame:
    """Verified recipes of ``rows`` (UID, doc_id, text): UID, doc_id, recipe,
    text_sha256. Rows of equal recipe have equal texts and the other way round."""
    bodies = rows.select(UID, "doc_id", whole_text().cast("binary").alias("body"))
    hashed = bodies.withColumn("text_sha256", F.sha2("body", 256))
    recipes = written(spark, _with_recipes(hashed, "body", id_bits, [UID, "doc_id", "text_sha256"]), "recipes")
    clashes = written(spark, clashing_ids(bodies, id_bits), "clashes")
    if clashes.isEmpty():
        return recipes
    return written(spark, _told_apart(bodies, recipes, clashes, id_bits), "recipes-told-apart")


def keepers(recipes: DataFrame) -> DataFrame:
    """One row for each recipe: the row that stays (largest doc_id) and the size of its group."""
    return recipes.groupBy("recipe").agg(F.max(F.struct("doc_id", UID)).alias("best"),
                                         F.count("*").alias("group_size"))


def exact_dedup(spark: SparkSession, docs: DataFrame, id_bits: int = 64) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    rows = identified(spark, docs, "dedup-rows").select(UID, "doc_id", "text")
    recipes = exact_groups(spark, rows, id_bits)
    # a table of its own, so that the join reads two plain exchanges and a hot recipe can be split
    best = written(spark, keepers(recipes), "keepers")
    both = recipes.join(best, "recipe")
    return both.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                       (F.col(UID) == F.col(f"best.{UID}")).alias("kept"), "text_sha256")


def drop_exact_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = identified(spark, docs, "dedup-rows")
    stay = keepers(exact_groups(spark, rows)).select(F.col(f"best.{UID}").alias(UID))
    return rows.join(stay, UID, "left_semi").drop(UID)


def op2_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, documents(spark, sf_dir))


ORACLE_OP2 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
