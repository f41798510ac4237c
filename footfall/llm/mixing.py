"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents, in a hashed order, form one stream of words that is cut in blocks of
``block_words``. The targets say how many words of each stream the mix takes: whole
passes over the stream, and one pass over a drawn subset of its blocks of which the last is cut to the
word, so the taken words of a source equal its rounded target. Counted in blocks, these quotas stand at
the root of a tree over the output shards. A tree node draws the quotas of its left half from the
multivariate hypergeometric distribution and leaves the rest to its right half, so that the
shards' counts add up to the quotas exactly and every shard is a random sample of the mix. A source's block
copies, one more than its whole passes of each block, are permuted by a keyed permutation; a shard gets the next
so many of them, disjoint from every other shard's, and permutes them locally into slots. A copy that no
shard of the tree gets is not in the mix: that is the only thing that decides what is taken.

Everything is computed from a row's place in its source's stream, so the text never moves for the
decision. Those places are running sums in two steps, over buckets of about ``_BUCKET_ROWS``
documents and inside them, so a source with a third of all rows is no single task.

Per-source figures pass through the driver: one row for each source of the mixture, checked
against ``max_sources``. Hypergeometric draws invert the distribution in double precision, at every size by the
same rule, over the counts within ``_SPREADS`` standard deviations of the likeliest (the rest weighs below 1e-30).

Defined results: a null text has size 0 and nothing is taken from it; a null source is a source of its own,
ordered last; a source without words has target 0; repeated rows are separate documents; an empty
table gives an empty mix; other columns are ignored or carried unchanged (``n_chars`` follows the cut text).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.llm.common import UID, WORD, documents, identified, written

WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
BLOCK_WORDS, SHARD_BLOCKS, SEED, MAX_SOURCES = 256, 65536, 42, 100_000
_BUCKET_ROWS = 2048
_RUN_SLOTS = 4096
_SPREADS = 12


def mix_targets(sizes: Sequence[int], weights: Sequence[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Words for each source: ``share`` of all sizes dealt by weight, no source above ``most`` times
    its size, the excess dealt again by weight among the others until none is above."""
    target = [0.0] * len(sizes)
    left, open_ = share * sum(sizes), {i for i, s in enumerate(sizes) if s > 0}
    while open_:
        whole = sum(weights[i] for i in open_)
        deal = {i: left * weights[i] / whole for i in open_}
        above = {i for i in open_ if deal[i] > most * sizes[i]}
        for i in above or open_:
            target[i] = most * sizes[i] if above else deal[i]
        if not above:
            break
        left -= sum(target[i] for i in above)
        open_ -= above
    return target


# ------------------------------------------------------------------ keyed permutations

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def permuted(x: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The place of ``x`` in a permutation of 0..n-1 chosen by ``key`` (elementwise): a four-round
    Feistel network on just enough bits, walked on until the result is below n."""
    n = np.broadcast_to(n, x.shape).astype(np.int64)
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))) + 1).astype(np.int64) // 2).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    out, todo = x.astype(np.int64).copy(), np.arange(len(x))
    key = np.broadcast_to(key, x.shape).astype(np.uint64)
    while len(todo):
        v, h, m, k = out[todo].astype(np.uint64), half[todo], low[todo], key[todo]
        a, b = v >> h, v & m
        for r in range(4):
            a, b = b, a ^ (_mixed(b + _mixed(k + np.uint64(r))) & m)
        out[todo] = ((a << h) | b).astype(np.int64)
        todo = todo[out[todo] >= n[todo]]
    return out


# ------------------------------------------------------------------ the splitting tree

def _marginal(rng: np.random.Generator, good: int, total: int, take: int) -> int:
    """How many of ``take`` items drawn without return from ``total`` are among the ``good`` ones."""
    low, high = max(0, take - (total - good)), min(good, take)
    mode = (take + 1) * (good + 1) // (total + 2)
    share = good / max(1, total)
    reach = int(_SPREADS * math.sqrt(take * share * (1 - share) * (total - take) / max(1, total - 1))) + 2 * _SPREADS
    low, high = max(low, mode - reach), min(high, mode + reach)
    if low == high:
        return low
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log((good - k) * (take - k)) - np.log((k + 1) * (total - good - take + k + 1))
    odds = np.concatenate([[0.0], np.cumsum(steps)])
    below = np.cumsum(np.exp(odds - odds.max()))
    return low + int(np.searchsorted(below, rng.random() * below[-1], side="right"))


def _hypergeometric(rng: np.random.Generator, counts: np.ndarray, take: int) -> np.ndarray:
    """A draw of ``take`` items without return from ``counts`` items of each kind."""
    out, total = np.zeros_like(counts), int(counts.sum())
    for i, c in enumerate(counts.tolist()):
        out[i] = _marginal(rng, c, total, take)
        take, total = take - int(out[i]), total - c
    return out


@dataclass
class SplittingTree:
    """Deals the block quotas of the sources out to ``shards`` output shards."""

    quotas: np.ndarray
    shards: int
    seed: int = SEED
    _left: dict = field(default_factory=dict)

    def left(self, lo: int, hi: int, counts: np.ndarray) -> np.ndarray:
        """Counts that shards lo..mid-1 get of a node over the shards lo..hi-1."""
        if (lo, hi) not in self._left:
            total, mid = int(counts.sum()), (lo + hi) // 2
            rng = np.random.default_rng([self.seed, lo, hi])
            self._left[lo, hi] = _hypergeometric(rng, counts, total * (mid - lo) // (hi - lo))
        return self._left[lo, hi]

    def shard_counts(self) -> np.ndarray:
        """Blocks of each source (column) in each shard (row)."""
        out, stack = np.zeros((self.shards, len(self.quotas)), np.int64), [(0, self.shards, self.quotas)]
        while stack:
            lo, hi, counts = stack.pop()
            if hi - lo == 1:
                out[lo] = counts
                continue
            left = self.left(lo, hi, counts)
            stack += [(lo, (lo + hi) // 2, left), ((lo + hi) // 2, hi, counts - left)]
        return out

    def place(self, source: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shard and the slot in it of each source's ``draw``-th block copy; -1 for copies beyond all shards' counts."""
        shard, slot = np.full(len(draw), -1), np.full(len(draw), -1)
        dealt = np.flatnonzero(draw < self.quotas[source])
        stack = [(0, self.shards, self.quotas, dealt, draw[dealt])]
        while stack:
            lo, hi, counts, who, at = stack.pop()
            if not len(who):
                continue
            if hi - lo == 1:
                before = np.cumsum(counts) - counts
                key = np.full(len(who), (self.seed << 32) + lo, np.uint64)
                shard[who] = lo
                slot[who] = permuted(before[source[who]] + at, counts.sum(), key)
                continue
            left = self.left(lo, hi, counts)
            mine = left[source[who]]
            go = at < mine
            mid = (lo + hi) // 2
            stack += [(lo, mid, left, who[go], at[go]), (mid, hi, counts - left, who[~go], (at - mine)[~go])]
        return shard, slot


# ------------------------------------------------------------------ the mix

@dataclass
class MixPlan:
    """What each task needs to know: per source its words, target words and drawn blocks."""

    words: np.ndarray
    target: np.ndarray
    block_words: int
    shard_blocks: int
    seed: int

    def __post_init__(self) -> None:
        b, size = self.block_words, np.maximum(self.words, 1)
        self.blocks = -(-self.words // b)
        self.passes, rest = self.target // size, self.target % size
        self.keys = np.arange(len(self.words), dtype=np.uint64) * np.uint64(2) + (np.uint64(self.seed) << np.uint64(32))
        short = self.blocks * b - self.words
        last = permuted(np.maximum(self.blocks - 1, 0), np.maximum(self.blocks, 1), self.keys)
        drawn = -(-rest // b)
        with_last = -(-(rest + short) // b)
        self.drawn = np.where(last < drawn, with_last, drawn)
        #: words that the last drawn block gives
        self.cut = rest - (self.drawn - 1) * b + np.where(last < self.drawn - 1, short, 0)
        quotas = self.passes * self.blocks + self.drawn
        self.tree = SplittingTree(quotas, max(1, -(-int(quotas.sum()) // self.shard_blocks)), self.seed)

    def pieces(self, sid: np.ndarray, start: np.ndarray, size: np.ndarray) -> dict[str, np.ndarray]:
        """Pieces taken of documents that cover the words start..start+size-1 of their source's stream:
        row, epoch, begin and end (words of the document), shard, slot."""
        b = self.block_words
        first = start // b
        n = np.where(size > 0, (start + size - 1) // b - first + 1, 0)
        row = np.repeat(np.arange(len(sid)), n)
        block = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        s = sid[row]
        rank = permuted(block, np.maximum(self.blocks[s], 1), self.keys[s])
        lo = np.maximum(block * b, start[row])
        hi = np.minimum((block + 1) * b, (start + size)[row])
        quota, parts = self.tree.quotas, []
        for epoch in range(int(self.passes.max(initial=0)) + 1):
            whole = epoch < self.passes[s]
            end = np.where(~whole & (rank == self.drawn[s] - 1), np.minimum(hi, block * b + self.cut[s]), hi)
            use = np.flatnonzero((epoch <= self.passes[s]) & (end > lo))
            copy = epoch * self.blocks[s] + np.where(whole, block, rank)
            parts.append((row[use], np.full(len(use), epoch), (lo - start[row])[use], (end - start[row])[use], s[use], copy[use]))
        row, epoch, begin, end, s, copy = (np.concatenate(x) for x in zip(*parts))
        draw, within = copy.copy(), np.flatnonzero(copy < quota[s])      # the copies beyond the quota stay behind it
        draw[within] = permuted(copy[within], quota[s[within]], self.keys[s[within]] + np.uint64(1))
        shard, slot = self.tree.place(s, draw)
        got = {"row": row, "epoch": epoch, "begin": begin, "end": end, "shard": shard, "slot": slot}
        return {c: x[shard >= 0] for c, x in got.items()}


def _source_key() -> list:
    """Sources in order: by code point, null last."""
    return [F.col("source").isNull(), F.col("source")]


def mix_plan(spark: SparkSession, docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
             most: float = MOST, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED,
             max_sources: int = MAX_SOURCES) -> DataFrame:
    """One row for each row of ``docs`` (UID, doc_id, text, source): UID, doc_id, size, source_size,
    target, sid (the source's number in order), and ``pieces`` that the mix takes of it (shard, slot, epoch, begin, end in words)."""
    sized = docs.select(UID, "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                        F.xxhash64("doc_id", "text").alias("h"))
    rows = written(spark, sized, "mix-rows")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    found = per_source.limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources; a mixture names its sources, raise max_sources to allow more")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["words"] for r in found]
    targets = mix_targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share, most)
    plan = MixPlan(np.array(sizes, np.int64), np.array([round(t) for t in targets], np.int64), block_words, shard_blocks, seed)
    spec = spark.createDataFrame(
        [(r["source"], i, r["words"], t, -(-r["rows"] // _BUCKET_ROWS)) for i, (r, t) in enumerate(zip(found, targets))],
        "name string, sid int, source_size long, target double, buckets long")
    # one row for each source of the mixture: max_sources bounds what is broadcast
    dealt = rows.join(F.broadcast(spec), F.col("source").eqNullSafe(F.col("name")))
    dealt = dealt.withColumn("bucket", F.expr("pmod(h, buckets)"))
    totals = dealt.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("sid", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("sid", "bucket").orderBy("h", "doc_id", UID).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, ["sid", "bucket"])
    placed = placed.select(UID, "doc_id", "size", "source_size", "target", "sid", (F.col("offset") + F.col("inside")).alias("start"))
    keep = [UID, "doc_id", "size", "source_size", "target", "sid"]
    piece = "struct<shard:bigint,slot:bigint,epoch:bigint,begin:bigint,end:bigint>"
    schema = placed.select(*keep, F.expr(f"CAST(NULL AS array<{piece}>)").alias("pieces")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = plan.pieces(*(np.asarray(b.column(c)).astype(np.int64) for c in ("sid", "start", "size")))
            order = np.lexsort((got["begin"], got["epoch"], got["row"]))
            ends = np.searchsorted(got["row"][order], np.arange(b.num_rows + 1)).astype(np.int32)
            names = ["shard", "slot", "epoch", "begin", "end"]
            flat = pa.StructArray.from_arrays([pa.array(got[c][order].astype(np.int64)) for c in names], names)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.ListArray.from_arrays(ends, flat)], [*keep, "pieces"])

    return placed.mapInArrow(run, schema)


def mix_summary(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken, and
    where the taken words went: n_shards, and first_shard and first_slot of the first of them in the text (null if none)."""
    plan = mix_plan(spark, identified(spark, docs, "mix-docs"), **options)
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["begin"])
    first = F.get("pieces", F.lit(0))                  # pieces lie by epoch and begin
    return plan.select("doc_id", "size", "source_size", "target", taken.alias("taken"),
                       F.size(F.array_distinct("pieces.shard")).cast("long").alias("n_shards"),
                       first["shard"].alias("first_shard"), first["slot"].alias("first_slot"))


def shard_counts(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """(shard, sid, source_size, target, words, blocks) that the mix puts into each shard from each source."""
    plan = mix_plan(spark, identified(spark, docs, "mix-docs"), **options)
    pieces = plan.select("sid", "source_size", "target", F.explode("pieces").alias("p"))
    return pieces.groupBy(F.col("p.shard").alias("shard"), "sid", "source_size", "target").agg(
        F.sum(F.col("p.end") - F.col("p.begin")).alias("words"), F.countDistinct("p.slot").alias("blocks"))


def _sliced(text: str, runs: list[tuple[int, int]], words: list[tuple[int, int]]) -> str:
    """The given runs of words, with the white space inside a run as it was."""
    return "\n".join(text[words[a][0]:words[b - 1][1]] for a, b in runs)


def mixed_texts(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The mix itself: for each block copy the row it is from with ``text`` cut to the taken words,
    and its __shard, __slot and __epoch; a shard's rows in slot order are its shuffled contents. A block
    that lies across documents fills its slot with a row for each of them."""
    rows = identified(spark, docs, "mix-docs")
    plan = mix_plan(spark, rows, **options).where(F.size("pieces") > 0).select(UID, "pieces")
    names = docs.columns
    both = rows.join(plan, UID)
    schema = both.select(*names, *[F.lit(0).cast("long").alias(c) for c in ("__shard", "__slot", "__epoch")]).schema
    word = re.compile(WORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):      # a text is cut here, so its copies never travel with its pieces
                text, pieces = b.column("text")[i].as_py(), b.column("pieces")[i].as_py()
                words = [m.span() for m in word.finditer(text)]
                cut = [_sliced(text, [(p["begin"], p["end"])], words) for p in pieces]
                one = pa.array([i] * len(pieces))
                cols = {c: b.column(c).take(one) for c in names if c != "text"}
                cols["text"] = pa.array(cut, pa.string())
                if "n_chars" in cols and pa.types.is_int64(cols["n_chars"].type):
                    cols["n_chars"] = pa.array([len(t) for t in cut], pa.int64())
                cols |= {f"__{c}": pa.array([p[c] for p in pieces], pa.int64()) for c in ("shard", "slot", "epoch")}
                yield pa.RecordBatch.from_pydict({c: cols[c] for c in schema.names})

    out = both.mapInArrow(run, schema)
    return out.repartition("__shard").sortWithinPartitions("__shard", "__slot")


def mixed_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The mix by document: for each row and each pass that takes words of it one row with the same
    columns. A row that a pass takes whole keeps its text; otherwise the taken runs of words are
    joined by line ends. Rows of which nothing is taken are not in the mix. Rows lie in the order of the shard and
    slot of the block with their first taken words, in runs of ``_RUN_SLOTS`` slots, so that a shard is more than one task. The
    first words of a text are as likely in one slot as in another however long it is; the least of all its slots would put
    the long texts together at the front of the first shard."""
    rows = identified(spark, docs, "mix-docs")
    plan = mix_plan(spark, rows, **options).select(UID, "size", F.explode("pieces").alias("p"))
    runs = plan.groupBy(UID, "p.epoch", "size").agg(F.sort_array(F.collect_list(F.struct("p.begin", "p.end"))).alias("__runs"),
                                                    F.min(F.struct("p.begin", "p.shard", "p.slot")).alias("__place"))
    whole = F.aggregate("__runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["begin"]) == F.col("size")
    runs = runs.select(UID, F.when(~whole, F.col("__runs")).alias("__runs"), "__place")
    cut = _cut_texts(rows.join(runs, UID))
    shard, slot = F.col("__place.shard"), F.col("__place.slot")
    placed = cut.repartition(shard, F.floor(slot / _RUN_SLOTS)).sortWithinPartitions(shard, slot, UID)
    return placed.select(*docs.columns)


def _cut_texts(rows: DataFrame) -> DataFrame:
    """Rows with ``text`` cut to ``__runs`` (null: left whole)."""
    word = re.compile(WORD)

    def cut(text: str, runs: list[dict]) -> str:
        joined: list[list[int]] = []
        for r in runs:
            if joined and joined[-1][1] == r["begin"]:
                joined[-1][1] = r["end"]
            else:
                joined.append([r["begin"], r["end"]])
        return _sliced(text, joined, [m.span() for m in word.finditer(text)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, runs = b.column("text"), b.column("__runs")
            out = [t.as_py() if not r.is_valid else cut(t.as_py(), r.as_py()) for t, r in zip(texts, runs)]
            cols = {c: b.column(c) for c in b.schema.names} | {"text": pa.array(out, pa.string())}
            if "n_chars" in cols and pa.types.is_int64(cols["n_chars"].type):
                sizes = [n if not r.is_valid else len(t) for n, r, t in zip(cols["n_chars"].to_pylist(), runs, out)]
                cols["n_chars"] = pa.array(sizes, pa.int64())
            yield pa.RecordBatch.from_pydict(cols)

    return rows.mapInArrow(run, rows.schema)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_summary(spark, documents(spark, sf_dir))
