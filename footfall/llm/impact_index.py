"""Exact top-k inner products over an impact-ordered index, processed score-at-a-time.

Vectors are integers. The index holds one posting for each component whose quantised impact (its magnitude in
``LEVELS`` steps) is not zero. The postings lie in segments by descending impact, cut where the squared components
that are still to come halve. Queries walk the segments and add query weight times quantised impact to their
accumulators. After each segment the part of a vector that an accumulator does not hold yet is bounded by two
products of norms: over the dimensions to come, the query's norm there times the vector's; over those that
are held, the query's norm there times that of the impacts' rounding. A row whose bound is below what ``k`` rows
are proven to reach leaves the query's accumulators for good: they are a matrix as long as most rows are possible, and
then a list of the possible (query, row) pairs. A query stops as soon as few rows are left; those
are scored again from the exact integers: in float64 where no sum of a shard can reach ``EXACT``, and
otherwise with the bounds widened by the rounding and in Python integers.

Rows are indexed in shards of about ``SHARD_ROWS`` rows, each shuffled and indexed once; the queries, sorted behind the
rows, pass through a shard's index ``QUERY_ROWS`` at a time. A query is sent once to each shard: n rows with q queries
shuffle n + q * n / SHARD_ROWS rows. Neither side is collected or broadcast, and a shard's best k are merged by a window
that first ranks within shards' results.

Defined results: vectors that are null, empty, or hold a null or non-finite component take no part; a
query does not meet its own row, but meets other rows of the same vec_id; equal scores rank by the
smaller vec_id, and rows that share vec_id and score appear each; vectors of different length have the
inner product of their common components; empty tables give no rows; other columns are ignored. Scaled
components from 2**62 on, and scores among the best that exceed 64 bits, raise an OverflowError.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.llm.common import UID, numbered, written

K, SCALE, EVERY = 10, 1024, 100
SHARD_ROWS, QUERY_ROWS, LEVELS = 16384, 256, 64
#: Sums below this are exact in float64, those of the impacts' rounded values too (less than twice as large).
EXACT = 2**52
#: Accumulators become pairs when this share of them is possible, and pairs are read so many at a time.
SPARSE, PAIRS = 0.25, 65536


def _largest(x: np.ndarray) -> int:
    """The largest magnitude in ``x``, as a Python integer."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if most >= 2**62:
        raise OverflowError("a scaled component does not fit into 62 bits")
    return most


def _paired(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the rows ``i`` of ``a`` with the rows ``j`` of ``b``."""
    parts = [np.einsum("ij,ij->i", a[i[n:n + PAIRS]], b[j[n:n + PAIRS]]) for n in range(0, len(i), PAIRS)]
    return np.concatenate(parts) if parts else np.empty(0)


class ImpactIndex:
    """The impact-ordered segments of one shard: ``x`` (rows x dimensions, integers)."""

    def __init__(self, x: np.ndarray, levels: int = LEVELS) -> None:
        self.most = _largest(x)
        self.whole = x
        self.x = x.astype(np.float64)
        size = np.abs(x)
        step = int(size.max(initial=0)) // levels + 1
        self.impact = (size // step).astype(np.int16)
        row, dim = np.nonzero(self.impact)
        order = np.argsort(-self.impact[row, dim], kind="stable")
        row, dim = row[order], dim[order]
        held = self.impact[row, dim].astype(np.int64)
        # an impact's value is the middle of its step, with the sign of the component
        value = (np.sign(x[row, dim]) * (held * step + step // 2)).astype(np.float64)
        # energy[i]: squared components with an impact below i
        energy = np.concatenate([[0.0], np.cumsum(np.bincount(self.impact.ravel(), (self.x**2).ravel(), levels + 1))])
        self.floors: list[int] = []                  # the least impact in each segment
        goal = energy[-1] / 2
        for i in range(levels, 0, -1):
            if energy[i] <= goal or i == 1:
                self.floors.append(i)
                while energy[i] <= goal and goal > 0:
                    goal /= 2
        ends = np.searchsorted(-held, -np.array(self.floors), side="right")
        starts = np.concatenate([[0], ends[:-1]])
        self.segments = [(row[a:b], dim[a:b], value[a:b]) for a, b in zip(starts, ends)]
        # of each row, before the first segment and after each one: norm of what is to come, norm of the rounding
        rounding = self.x.copy()
        rounding[row, dim] -= value
        self.coming, self.rounded = [np.linalg.norm(self.x, axis=1)], [np.zeros(len(x))]
        for floor in self.floors:
            to_come = self.impact < floor
            self.coming.append(np.linalg.norm(np.where(to_come, self.x, 0.0), axis=1))
            self.rounded.append(np.linalg.norm(np.where(to_come, 0.0, rounding), axis=1))

    def _exact(self, queries: np.ndarray) -> bool:
        return self.most * _largest(queries) * self.x.shape[1] < EXACT

    def survivors(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[list[np.ndarray], list[int]]:
        """Of each query the rows that can be among its ``k`` best, and how many (query, row) pairs were still
        possible after each segment."""
        q = queries.astype(np.float64)
        square, norm = q**2, np.linalg.norm(q, axis=1)
        # rounding of the components, the products and the sums over dimensions and segments
        rounding = 0.0 if self._exact(queries) else (self.x.shape[1] + 16) * (len(self.segments) + 1) * 2.0**-50
        few, n = max(4 * k, 64), len(self.x)
        found: list[np.ndarray] = [np.empty(0, np.int64)] * len(q)
        left: list[int] = []

        def bound(ahead: np.ndarray, whole: np.ndarray, r: np.ndarray | slice, depth: int) -> np.ndarray:
            """``ahead``: the query's square sum over the dimensions to come; ``whole``: its norm."""
            behind = np.sqrt(np.maximum(whole**2 * (1 + 1e-12) - ahead, 0.0))
            sure = np.sqrt(ahead) * self.coming[depth][r] + behind * self.rounded[depth][r]
            return sure * (1 + 1e-9) + whole * self.coming[0][r] * rounding + 1e-6

        acc, alive, dense = np.zeros((len(q), n)), np.arange(len(q)), True
        who = at = np.empty(0, np.int64)
        for depth in range(len(self.segments) + 1):
            part = np.zeros_like(self.x)
            ahead = np.ones_like(self.x)
            if depth:
                row, dim, value = self.segments[depth - 1]
                part[row, dim] = value
                ahead = (self.impact < self.floors[depth - 1]).astype(np.float64)
            if dense:
                acc += q[alive] @ part.T
                off = bound(square[alive] @ ahead.T, norm[alive, None], slice(None), depth)
                low, high = acc - off, acc + off
                mine = np.flatnonzero(own[alive] >= 0)
                low[mine, own[alive][mine]] = high[mine, own[alive][mine]] = -np.inf
                least = -np.partition(-low, min(k, n) - 1, axis=1)[:, min(k, n) - 1]     # k rows reach at least this
                possible = (high >= least[:, None]) & (high > -np.inf)
                count = possible.sum(axis=1)
            else:
                acc += _paired(q, part, who, at)
                off = bound(_paired(square, ahead, who, at), norm[who], at, depth)
                low, high = acc - off, acc + off
                cuts = np.searchsorted(who, alive)
                ends = np.searchsorted(who, alive, side="right")
                least = np.full(len(q), -np.inf)
                for i, a, b in zip(alive, cuts, ends):
                    if b - a >= k:
                        least[i] = -np.partition(-low[a:b], k - 1)[k - 1]
                keep = high >= least[who]
                acc, who, at = acc[keep], who[keep], at[keep]
                count = np.searchsorted(who, alive, side="right") - np.searchsorted(who, alive)
            stop = (count <= few) | (depth == len(self.segments))
            left.append(int(count.sum()) + sum(len(f) for f in found))
            for i in np.flatnonzero(stop):
                found[alive[i]] = np.flatnonzero(possible[i]) if dense else at[who == alive[i]]
            if dense:
                acc, possible = acc[~stop], possible[~stop]
                alive = alive[~stop]
                if possible.sum() < SPARSE * possible.size:
                    dense = False
                    i, at = np.nonzero(possible)
                    acc, who = acc[i, at], alive[i]
            else:
                alive = alive[~stop]
                keep = np.isin(who, alive)
                acc, who, at = acc[keep], who[keep], at[keep]
            if not len(alive):
                break
        return found, left

    def search(self, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """(query, row, score) of each query's k best rows: by score, then by id; ``own`` is the place
        of the query's own row in this shard, or -1."""
        exact, q = self._exact(queries), queries.astype(np.float64)
        who, rows, scores = [], [], []
        for i, rows_i in enumerate(self.survivors(queries, own, k)[0]):
            if exact:
                score = (self.x[rows_i] @ q[i]).astype(np.int64)
                best = np.lexsort((ids[rows_i], -score))[:k]
            else:
                score = self.whole[rows_i].astype(object) @ queries[i].astype(object)
                best = np.array(sorted(range(len(rows_i)), key=lambda j: (-score[j], ids[rows_i[j]]))[:k], np.int64)
                if any(not -2**63 <= s < 2**63 for s in score[best]):
                    raise OverflowError("a score among the best does not fit into 64 bits")
                score = np.where(np.isin(np.arange(len(score)), best), score, 0).astype(np.int64)
            who.append(np.full(len(best), i))
            rows.append(rows_i[best])
            scores.append(score[best])
        join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
        return join(who), join(rows), join(scores)


def _matrix(vectors: pa.ListArray, wide: int | None = None) -> np.ndarray:
    """The vectors as rows, with zeros behind short ones and, for a given width, nothing beyond it."""
    sizes = np.asarray(vectors.value_lengths()).astype(np.int64)
    values = np.asarray(vectors.flatten())
    row = np.repeat(np.arange(len(sizes)), sizes)
    dim = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((len(sizes), int(sizes.max(initial=0)) if wide is None else wide), np.int64)
    fits = dim < out.shape[1]
    out[row[fits], dim[fits]] = values[fits]
    return out


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>): floor(scale * component) of the vectors that take part."""
    wide = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    usable = (F.size("embedding") > 0) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.where(usable).select("vec_id", wide.alias("v"))


class Shard:
    """A shard's rows, indexed when its first queries come."""

    def __init__(self, rows: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(rows).combine_chunks()
        self.index = ImpactIndex(_matrix(table.column("v").combine_chunks()))
        self.uid, self.vec_id = np.asarray(table.column(UID)), table.column("vec_id")
        self.order = np.argsort(self.uid)
        self.ids = np.asarray(self.vec_id.fill_null(np.iinfo(np.int64).max))

    def answers(self, asked: pa.RecordBatch, k: int) -> pa.RecordBatch:
        q, quid = _matrix(asked.column("v"), self.index.x.shape[1]), np.asarray(asked.column(UID))
        at = np.minimum(np.searchsorted(self.uid[self.order], quid), len(self.uid) - 1)
        own = np.where(self.uid[self.order][at] == quid, self.order[at], -1)
        who, row, score = self.index.search(q, own, self.ids, k)
        vec_id = self.vec_id.take(pa.array(row)).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [pa.array(quid[who]), asked.column("vec_id").take(pa.array(who)), vec_id, pa.array(score)],
            ["query", "query_id", "vec_id", "score"])


def top_k(spark: SparkSession, vectors: DataFrame, queries: str, k: int = K) -> DataFrame:
    """The ``k`` best rows of ``vectors`` (vec_id, v) for each row that satisfies ``queries`` (SQL)."""
    rows = written(spark, numbered(vectors.select(F.col("vec_id").cast("long"), "v")), "vectors")
    shards = -(-rows.count() // SHARD_ROWS) or 1
    mine = rows.select(F.pmod(F.xxhash64(UID), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asks"), UID, "vec_id", "v")
    # each query once for each shard
    asked = rows.where(queries).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True), UID, "vec_id", "v")
    both = mine.union(asked).repartition(shards, "shard").sortWithinPartitions("shard", "asks")
    query_rows = QUERY_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, gathered, shard = None, [], None
        for b in batches:
            key = 2 * np.asarray(b.column("shard")).astype(np.int64) + np.asarray(b.column("asks")).astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1), b.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                if key[lo] // 2 != number:
                    number, gathered, shard = key[lo] // 2, [], None
                if not key[lo] % 2:
                    gathered.append(b.slice(lo, hi - lo))
                elif gathered or shard:
                    shard, gathered = shard or Shard(gathered), []
                    for at in range(lo, hi, query_rows):
                        yield shard.answers(b.slice(at, min(query_rows, hi - at)), k)

    found = both.mapInArrow(run, "query long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op5_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return top_k(spark, vectors, f"vec_id % {EVERY} = 0")


ORACLE_OP5 = """
WITH usable AS (
  SELECT row_number() OVER () AS uid, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.uid, q.vec_id AS query_id, r.vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, r.v)]) AS BIGINT) AS score
  FROM usable q JOIN usable r ON q.uid <> r.uid
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
