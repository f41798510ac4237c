"""Text scores of a bigram model with deleted interpolation.

    P(w | v) = l2[b] c(v w) / c(v) + l1[b] c(w) / N + l0[b] / (V + 1)

c are training counts, N training tokens, V distinct training tokens, and b the bucket of the context's
frequency, floor(log2(c(v) + 1)). The weights of each bucket are learned by expectation-maximisation on
deleted counts (with a prior of ``UNIFORM_PRIOR`` events on the uniform estimate, so no probability is zero): each training token is held out in turn, so its own occurrence is taken off the
counts that predict it. The events are summed in a grid (bucket, log of the bigram estimate, log of the
unigram estimate; a quarter of an octave wide, with the mean estimates of each cell), whose size is
bounded, so EM sees all of them wherever the corpus grows to.

Tokens are the words of the text in lower case (A-Z) and one end token, which is also the context
of a text's first token. Words are known by 64-bit hashes. The corpus is cut in blocks of some
thousand texts. A block is tokenised once and asks for the counts of its distinct words and word
pairs, each once: requests are dealt by key range, added up, and the answer holds only what other blocks
add to the block's own count, which is nothing for the many pairs seen in one block. A pair that a
third of all texts share is one request for each block. Blocks and answers are tables bucketed by
block, in as many buckets as the corpus needs, so learning and scoring read both in place.

Defined results: null and empty texts are one end token; with no training texts every count is 0, both base
and model give the empty vocabulary's one class probability 1, and the scores are 0; a null doc_id counts
as the empty text for the fold; repeated rows are learnt and scored each; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import documents, fold, whole_text, written
from footfall.session import scratch_path

FOLDS = 10
#: Bytes of text in a block, and requested counts in a key range (about).
BLOCK_BYTES, RANGE_KEYS = 6 << 20, 1 << 21
PRIOR = 0.1
STEPS_PER_OCTAVE, EM_ROUNDS, BUCKETS = 4, 60, 48
#: Events that each bucket's uniform estimate has besides the observed ones.
UNIFORM_PRIOR = 1e-3
#: Bytes of text behind one bucket of the block tables: their number grows with the corpus, a task's share does not.
BUCKET_BYTES = 16 << 20
#: The end token's stand-in for hashing: no word holds a line end.
_END = xxhash.xxh64_intdigest(b"\n")
_NEVER = 1 << 12


# ------------------------------------------------------------------ blocks

def packed(x: np.ndarray, rising: bool = False) -> bytes:
    """Numbers as compressed bytes: of a rising row the steps, byte by byte of all numbers, so that equal high bytes lie together."""
    x = np.diff(x, prepend=x.dtype.type(0)) if rising else x
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes(), 1)


def unpacked(data: bytes, kind: type, rising: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    x = np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)
    return np.cumsum(x, dtype=kind) if rising else x


def _tokenised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens of each text, token numbers, hash of each number). Number 0 is the end token."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = lists.flatten()
    real = np.asarray(pc.not_equal(pc.binary_length(words), 0)).astype(bool)
    owner = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(lists)))[real]
    coded = words.filter(pa.array(real)).dictionary_encode()
    n = np.bincount(owner, minlength=len(texts)) + 1
    ends = np.cumsum(n) - 1
    ids = np.zeros(int(n.sum()), np.int32)
    inner = np.ones(len(ids), bool)
    inner[ends] = False
    ids[inner] = np.asarray(coded.indices) + 1
    vocab = np.array([_END] + [xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
    return n, ids, vocab


def token_blocks(docs: DataFrame, learn: Column) -> DataFrame:
    """Blocks of ``docs`` (doc_id, text): block, doc_ids, train, sizes, vocab, tokens (compressed)."""
    rows = docs.select("doc_id", whole_text().alias("text"), learn.alias("train"), F.spark_partition_id().alias("part"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, done = zstandard.ZstdCompressor(level=3), 0
        for b in batches:
            size = np.asarray(pc.binary_length(b.column("text")).cast(pa.int64()))
            cut = np.flatnonzero(np.diff(np.r_[-1, (np.cumsum(size) - size) // BLOCK_BYTES]))
            for lo, hi in zip(cut, np.r_[cut[1:], b.num_rows]):
                part = b.slice(lo, hi - lo)
                n, ids, vocab = _tokenised(part.column("text"))
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([(part.column("part")[0].as_py() << 32) + done]),
                    "doc_ids": pa.ListArray.from_arrays([0, len(n)], part.column("doc_id")),
                    "train": pa.ListArray.from_arrays([0, len(n)], part.column("train")),
                    "sizes": pa.array([n.astype(np.int32)], pa.list_(pa.int32())),
                    "vocab": pa.array([vocab.view(np.int64)], pa.list_(pa.int64())),
                    "tokens": pa.array([pack.compress(ids.tobytes())], pa.binary())})
                done += 1

    return rows.mapInArrow(run, f"block long, doc_ids array<{id_type}>, train array<boolean>, sizes array<int>, "
                                "vocab array<bigint>, tokens binary")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Block:
    """A block's tokens and, for words (0) and word pairs (1), its sorted keys and own training counts."""

    doc_ids: pa.Array
    train: np.ndarray
    sizes: np.ndarray
    keys: list[np.ndarray]
    own: list[np.ndarray]
    word: np.ndarray         # place of each token's word among keys[0]
    pair: np.ndarray         # place of each token's pair among keys[1]

    @classmethod
    def read(cls, rows: pa.Table | pa.RecordBatch, i: int = 0) -> Block:
        sizes = np.asarray(rows.column("sizes")[i].values)
        train = np.asarray(rows.column("train")[i].values).astype(bool)
        vocab = np.asarray(rows.column("vocab")[i].values).view(np.uint64)
        ids = np.frombuffer(zstandard.decompress(rows.column("tokens")[i].as_py()), np.int32)
        order = np.argsort(vocab)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        before = np.r_[np.int32(0), ids[:-1]]          # a text's first token follows an end token
        pairs, pair = np.unique(_mixed(_mixed(vocab[before] + np.uint64(1)) + vocab[ids]), return_inverse=True)
        word, learnt = place[ids], np.repeat(train, sizes)
        own = [np.bincount(at[learnt], minlength=n) for at, n in ((word, len(vocab)), (pair, len(pairs)))]
        return cls(rows.column("doc_ids")[i].values, train, sizes, [vocab[order], pairs], own, word, pair)

    def contexts(self, counts: np.ndarray) -> np.ndarray:
        """``counts`` (by word) of the word before each token."""
        end = int(np.searchsorted(self.keys[0], np.uint64(_END)))
        return counts[np.r_[end, self.word[:-1]]]


# ------------------------------------------------------------------ counts

def count_requests(blocks: DataFrame, bits: int) -> DataFrame:
    """The distinct keys of each block in 2**bits ranges: kind, range, block, first, keys, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
        for b in batches:
            for i in range(b.num_rows):
                block = Block.read(b, i)
                for kind in (0, 1):
                    keys = block.keys[kind]
                    cut = np.r_[np.searchsorted(keys, edges), len(keys)].astype(np.int32)
                    used = np.flatnonzero(np.diff(cut))
                    spans = [slice(cut[u], cut[u + 1]) for u in used]
                    yield pa.RecordBatch.from_pydict({
                        "kind": pa.array(np.full(len(used), kind, np.int32)), "range": pa.array(used.astype(np.int64)),
                        "block": pa.array([b.column("block")[i].as_py()] * len(used), pa.int64()),
                        "first": pa.array(cut[used]),
                        "keys": pa.array([packed(keys[s], rising=True) for s in spans], pa.binary()),
                        "n": pa.array([packed(block.own[kind][s].astype(np.int32)) for s in spans], pa.binary())})

    return blocks.mapInArrow(run, "kind int, range long, block long, first int, keys binary, n binary")


def answers(requests: DataFrame) -> DataFrame:
    """What other blocks add to each request: block, kind, places (in the block's keys), more. A row
    without a block has in ``seen`` the number of the range's distinct training tokens."""

    def run(rows: pa.Table) -> pa.Table:
        parts = [unpacked(k.as_py(), np.uint64, rising=True) for k in rows.column("keys")]
        keys, size = np.concatenate(parts), np.array([len(p) for p in parts])
        n = np.concatenate([unpacked(x.as_py(), np.int32) for x in rows.column("n")]).astype(np.int64)
        offsets = np.r_[0, np.cumsum(size)]
        order = np.argsort(keys, kind="stable")
        start = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
        total = np.add.reduceat(n[order], start)
        more = np.empty_like(n)
        more[order] = np.repeat(total, np.diff(np.r_[start, len(n)]))
        more -= n
        place = np.arange(len(n)) - np.repeat(offsets[:-1] - np.asarray(rows.column("first")), size)
        told = more > 0
        kind, blocks = rows.column("kind")[0].as_py(), rows.column("block").to_pylist()
        out: list[tuple] = []
        for i, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:])):
            some = told[lo:hi]
            if some.any():
                out.append((blocks[i], packed(place[lo:hi][some].astype(np.int32), rising=True), packed(more[lo:hi][some]), None))
        if not kind:
            out.append((None, None, None, int((total > 0).sum())))
        cols = list(zip(*out)) or [()] * 4
        return pa.table({"block": pa.array(cols[0], pa.int64()), "kind": pa.array([kind] * len(out), pa.int32()),
                         "places": pa.array(cols[1], pa.binary()), "more": pa.array(cols[2], pa.binary()), "seen": pa.array(cols[3], pa.int64())})

    return requests.groupBy("kind", "range").applyInArrow(run, "block long, kind int, places binary, more binary, seen long")


def _totals(block: Block, told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Training counts over all blocks of the block's words and pairs."""
    total = [c.copy() for c in block.own]
    kinds = told.column("kind").to_pylist()
    for i, kind in enumerate(kinds):
        places = unpacked(told.column("places")[i].as_py(), np.int32, rising=True)
        total[kind][places] += unpacked(told.column("more")[i].as_py(), np.int64)
    return total[0], total[1]


# ------------------------------------------------------------------ weights

@dataclass
class Estimates:
    n: int                              # training tokens
    v: int                              # distinct training tokens
    weights: np.ndarray | None = None   # BUCKETS x (pair, word, uniform)


def bucket_of(c: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(np.log2(c + 1.0)).astype(np.int64), BUCKETS - 1)


def _ratio(a: np.ndarray, b: np.ndarray | float) -> np.ndarray:
    b = np.broadcast_to(np.asarray(b, np.float64), a.shape)
    return np.divide(a, b, out=np.zeros(a.shape), where=b > 0)


def _grid(p: np.ndarray) -> np.ndarray:
    out = np.full(p.shape, _NEVER - 1, np.int64)
    some = p > 0
    out[some] = np.minimum(np.round(-STEPS_PER_OCTAVE * np.log2(p[some])), _NEVER - 2)
    return out


def deleted_events(block: Block, word: np.ndarray, pair: np.ndarray, e: Estimates) -> dict[str, np.ndarray]:
    """The block's training tokens, each predicted without itself, summed by cell of the grid."""
    learnt = np.repeat(block.train, block.sizes)
    context = block.contexts(word)[learnt] - 1
    p2, p1 = _ratio(pair[block.pair[learnt]] - 1, context), _ratio(word[block.word[learnt]] - 1, e.n - 1)
    cell = (bucket_of(context) * _NEVER + _grid(p2)) * _NEVER + _grid(p1)
    cells, at = np.unique(cell, return_inverse=True)
    size = len(cells)
    sums = [np.bincount(at, p, size).astype(np.float64) for p in (p2, p1)]
    return {"cell": cells, "n": np.bincount(at, minlength=size), "p2": sums[0], "p1": sums[1]}


def learned_weights(cell: np.ndarray, n: np.ndarray, p2: np.ndarray, p1: np.ndarray, v: int) -> np.ndarray:
    """Mixture weights of each bucket by expectation-maximisation over the grid's cells."""
    # a prior of a fraction of an event keeps every uniform share, and so every probability, above zero
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = 0.0, 0.5, 0.5            # a context never seen has no pairs
    if not len(cell):
        return np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    bucket = cell // (_NEVER * _NEVER)
    p = np.stack([p2 / n, p1 / n, np.full(len(n), 1 / (v + 1))], axis=1)
    for _ in range(EM_ROUNDS):
        share = weights[bucket] * p
        share *= (n / share.sum(axis=1))[:, None]
        mass = np.stack([np.bincount(bucket, share[:, i], BUCKETS) for i in range(3)], axis=1)
        seen = mass.sum(axis=1) > 0
        mass[:, 2] += UNIFORM_PRIOR
        weights[seen] = mass[seen] / mass[seen].sum(axis=1, keepdims=True)
    used = np.flatnonzero(np.bincount(bucket, minlength=BUCKETS))
    for b in range(1, BUCKETS):           # a bucket without events borrows from the nearest one with pairs
        near = used[used > 0]
        if b not in used and len(near):
            weights[b] = weights[near[np.argmin(np.abs(near - b))]]
    return weights


def text_scores(block: Block, word: np.ndarray, pair: np.ndarray, e: Estimates) -> dict[str, np.ndarray]:
    starts = np.r_[0, np.cumsum(block.sizes)[:-1]]
    c = word[block.word]
    context = block.contexts(word)
    w = e.weights[bucket_of(context)]
    p = w[:, 0] * _ratio(pair[block.pair], context) + w[:, 1] * _ratio(c, float(e.n)) + w[:, 2] / (e.v + 1)
    base = np.log10((c + PRIOR) / (e.n + PRIOR * (e.v + 1)))
    return {"n_known": np.add.reduceat((c > 0).astype(np.int64), starts),
            "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(np.log10(p), starts)}


# ------------------------------------------------------------------ frames

def _with_answers(blocks: DataFrame, told: DataFrame, work, schema: str) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block.read(left)
        return work(block, *_totals(block, right))

    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, schema)


def interpolated_scores(spark: SparkSession, docs: DataFrame, learn: Column) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score. The model learns from the rows that satisfy ``learn``."""
    tables: list[str] = []
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    try:
        return _scored(spark, docs, learn, buckets, tables)
    finally:
        for table in tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def _scored(spark: SparkSession, docs: DataFrame, learn: Column, buckets: int, tables: list[str]) -> DataFrame:
    """``interpolated_scores`` with the names of the bucketed tables it makes added to ``tables``."""

    def bucketed(df: DataFrame, name: str) -> DataFrame:
        """``df`` as a table bucketed by block: what is grouped by block later is read in place."""
        tables.append(f"lm_{name}_{uuid.uuid4().hex}")
        df.write.bucketBy(buckets, "block").option("path", scratch_path(spark, name)).saveAsTable(tables[-1])
        return spark.table(tables[-1])

    blocks = bucketed(token_blocks(docs, learn), "blocks")
    trained = F.aggregate(F.zip_with("train", "sizes", lambda t, s: F.when(t, s).otherwise(0).cast("long")),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    asked = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    sums = blocks.agg(F.coalesce(F.sum(trained), F.lit(0)).alias("n"), F.coalesce(F.sum(asked), F.lit(0)).alias("all")).first()
    bits = max(0, (2 * sums["all"] // RANGE_KEYS).bit_length())
    told = bucketed(answers(count_requests(blocks, bits)).repartition(buckets, "block"), "answers")
    v = told.where("block IS NULL").agg(F.coalesce(F.sum("seen"), F.lit(0)).alias("v")).first()["v"]
    told = told.where("block IS NOT NULL")
    e = Estimates(sums["n"], v)

    def events(block: Block, word: np.ndarray, pair: np.ndarray) -> pa.Table:
        found = deleted_events(block, word, pair, e)
        return pa.table({"cell": found["cell"], "n": found["n"].astype(np.int64), "p2": found["p2"], "p1": found["p1"]})

    cells = _with_answers(blocks, told, events, "cell long, n long, p2 double, p1 double").groupBy("cell").agg(
        F.sum("n").alias("n"), F.sum("p2").alias("p2"), F.sum("p1").alias("p1")).orderBy("cell").toPandas()
    e.weights = learned_weights(*(cells[c].to_numpy() for c in ("cell", "n", "p2", "p1")), v)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scores(block: Block, word: np.ndarray, pair: np.ndarray) -> pa.Table:
        return pa.table({"doc_id": block.doc_ids, "held_out": ~block.train, "n_tokens": block.sizes.astype(np.int64),
                         **text_scores(block, word, pair, e)})

    done = written(spark, _with_answers(
        blocks, told, scores, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double"), "scores")
    return done.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(e.n).cast("long").alias("train_tokens"), "base_score", "score")


def op3_interp_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return interpolated_scores(spark, docs, fold("doc_id", FOLDS) != 0)
