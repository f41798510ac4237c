"""SimHash near-dedup over a Gray-order hierarchical index.

Every text gets a 64-bit fingerprint from the XXH64 of its word shingles. Distinct fingerprints
are linked at ``max_bits`` or fewer differing bits, and linked fingerprints form groups.

The index has two parts. Its upper nodes are masked bit patterns: the 64 positions are cut in
``max_bits + 1`` parts, and two fingerprints within the distance agree on at least one part, so
they meet under the node (mask of that part, its bits). A node with more than ``node_rows``
fingerprints is refined: the positions it has not fixed yet are cut in ``max_bits + 1`` parts
again, and the same argument holds one level down. Repeating this bounds every node, however
the fingerprints cluster, and loses no link. Below an upper node the fingerprints are sorted by Gray
rank, which places similar codes side by side, and runs of them are factored into a tree whose nodes
keep the bits that all their members share. The node is joined with itself from the top: a pair of
tree nodes is dropped with all its members when the differences on their shared bits exceed the
distance. The links found become a spanning star for each local group; that keeps every
connection between different fingerprints without writing all the pairs of a group.

Defined results: a null, empty or blank text has fingerprint zero and is linked like any other;
texts with fewer words than a shingle are one shingle; equal texts share a fingerprint; null
doc_ids are ignored when the smallest id of a group is taken (a group of nulls has a null
id); repeated rows give repeated result rows; other columns are ignored or carried unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import UID, documents, identified, whole_text, written
from footfall.llm.components import component_roots

SHINGLE, MAX_BITS, SEED = 3, 2, 42
#: An upper node with more fingerprints than this is refined.
NODE_ROWS = 2048
#: Tree nodes joined at a time below one or more upper nodes; bounds a task's memory.
_FAN = 4
_PIECE = 1 << 16


# ------------------------------------------------------------------ fingerprints

def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of a UTF-8 text."""
    words = text.lower().split()          # on bytes both touch ASCII only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _PIECE):
        h = np.array([xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle]), seed)
                      for i in range(at, min(n, at + _PIECE))], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Replaces the binary column ``body`` by ``fp``, the fingerprint as a signed long."""
    keep = [c for c in df.columns if c != "body"]
    schema = df.select(*keep, F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column("body")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(fps)], [*keep, "fp"])

    return df.mapInArrow(run, schema)


# ------------------------------------------------------------------ upper nodes

def _split_masks(mask: int, parts: int) -> list[int]:
    """``mask`` joined with each of ``parts`` runs of the positions that it leaves open."""
    left = [i for i in range(64) if not mask >> i & 1]
    cuts = [len(left) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << i for i in left[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _placed(rows: DataFrame, children: dict[int, list[int]]) -> DataFrame:
    """Puts each fingerprint of ``rows`` (mask, fp) under the children of its node."""
    arms = [f"WHEN {_signed(m)}L THEN array({', '.join(f'{_signed(c)}L' for c in cs)})" for m, cs in children.items()]
    text = f"CASE mask {' '.join(arms)} END".replace("-9223372036854775808L", "(-9223372036854775807L - 1L)")
    return (rows.select(F.explode(F.expr(text)).alias("mask"), "fp")
            .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"), "fp"))


def index_nodes(spark: SparkSession, fps: DataFrame, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """(mask, bits, fp) of every upper node with two or more fingerprints, none of them above
    ``node_rows`` while it has open positions left to cut. ``fps`` has distinct fps."""
    parts = max_bits + 1
    masks = [0]
    rows = fps.select(F.lit(0).cast("long").alias("mask"), "fp")
    done = None
    while True:
        children = {m: _split_masks(m, parts) for m in masks}
        placed = written(spark, _placed(rows, children), "nodes")
        sizes = placed.groupBy("mask", "bits").agg(F.count("*").alias("n")).where("n > 1")
        masks = sorted({c for cs in children.values() for c in cs})
        last = all(bin(m).count("1") > 64 - parts for m in masks)
        fit = sizes if last else sizes.where(F.col("n") <= node_rows)
        small = placed.join(fit.select("mask", "bits"), ["mask", "bits"])
        done = small if done is None else done.union(small)
        if last:
            return done
        large = written(spark, sizes.where(F.col("n") > node_rows).select("mask", "bits"), "large-nodes")
        if large.isEmpty():
            return done
        rows = placed.join(large, ["mask", "bits"]).select("mask", "fp")


# ------------------------------------------------------------------ Gray order below a node

def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of a code in the reflected Gray sequence."""
    r = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def _levels(fp: np.ndarray, node: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Tree levels from the fingerprints up to one root for each upper node. A level holds for its
    tree nodes: mask of shared positions, pattern on them, first child and number of children."""
    full = np.full(len(fp), np.uint64(0xFFFFFFFFFFFFFFFF))
    levels = [(full, fp, np.arange(len(fp)), np.ones(len(fp), np.int64))]
    owner = node
    while len(np.unique(owner)) < len(owner):
        start = np.r_[True, owner[1:] != owner[:-1]]
        nth = np.arange(len(owner)) - np.maximum.accumulate(np.where(start, np.arange(len(owner)), 0))
        first = np.flatnonzero(nth % _FAN == 0)
        mask, bits = levels[-1][:2]
        every, some = np.bitwise_and.reduceat(bits, first), np.bitwise_or.reduceat(bits, first)
        shared = np.bitwise_and.reduceat(mask, first) & ~(every ^ some)
        levels.append((shared, every & shared, first, np.diff(np.r_[first, len(owner)])))
        owner = owner[first]
    return levels


def close_pairs(fp: np.ndarray, node: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places (i < j) in the same node whose codes differ in ``max_bits`` bits at most.
    ``fp`` is sorted by node, then by Gray rank. The join goes down the trees from their roots and
    drops a pair of tree nodes with everything below as soon as their shared bits differ too much."""
    levels = _levels(fp, node)
    a = b = np.arange(len(levels[-1][0]))
    for above, (mask, bits, _, _) in zip(levels[:0:-1], levels[-2::-1]):
        first, size = above[2], above[3]
        reps = size[a] * size[b]
        at = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        wide = np.repeat(size[b], reps)
        a, b = np.repeat(first[a], reps) + at // wide, np.repeat(first[b], reps) + at % wide
        near = (a <= b) & (np.bitwise_count((bits[a] ^ bits[b]) & mask[a] & mask[b]) <= max_bits)
        a, b = a[near], b[near]
    apart = a < b
    return a[apart], b[apart]


def _star(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place that is in a pair the least code of its local group, where it is another one."""
    label = np.arange(len(fp))
    order = np.argsort(fp.view(np.int64), kind="stable")
    rank = np.empty(len(fp), np.int64)
    rank[order] = np.arange(len(fp))
    label = rank.copy()
    while True:
        before = label.copy()
        np.minimum.at(label, a, before[b])
        np.minimum.at(label, b, before[a])
        label = label[order[label]]
        if np.array_equal(before, label):
            break
    moved = np.flatnonzero(label != rank)
    return fp[moved], fp[order[label[moved]]]


def node_links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): a spanning star of the links below each upper node of ``nodes`` (mask, bits, fp)."""
    signed = "bigint"
    ranked = nodes.withColumn("gray", F.col("fp"))
    for s in (1, 2, 4, 8, 16, 32):
        ranked = ranked.withColumn("gray", F.col("gray").bitwiseXOR(F.shiftrightunsigned("gray", s)))
    dealt = (ranked.repartition("mask", "bits").sortWithinPartitions("mask", "bits", "gray")
             .select("mask", "bits", F.col("fp").cast(signed)))

    def links(mask: np.ndarray, bits: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.r_[True, (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])]
        node, starts = np.cumsum(new), np.flatnonzero(new)
        ends = np.r_[starts[1:], len(fp)]
        at = 0
        while at < len(starts):           # as many whole nodes at a time as bound the pairs looked at
            room = np.cumsum((ends[at:] - starts[at:]) ** 2)
            upto = at + max(1, int(np.searchsorted(room, NODE_ROWS ** 2)))
            lo, hi = starts[at], ends[upto - 1]
            codes = fp[lo:hi].view(np.uint64)
            order = np.lexsort((gray_rank(codes), node[lo:hi]))
            codes = codes[order]
            x, y = _star(codes, *close_pairs(codes, node[lo:hi][order], max_bits))
            if len(x):
                yield pa.RecordBatch.from_pydict({"a": pa.array(x.view(np.int64)), "b": pa.array(y.view(np.int64))})
            at = upto

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = [np.asarray(batch.column(i)) for i in range(3)]
            now = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            if not len(now[0]):
                continue
            open_at = int(np.flatnonzero(np.r_[True, (now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1])])[-1])
            if open_at:
                yield from links(*(x[:open_at] for x in now))
            held = [x[open_at:] for x in now]
        if held is not None and len(held[0]):
            yield from links(*held)

    return dealt.mapInArrow(run, "a long, b long")


# ------------------------------------------------------------------ groups

def fingerprint_groups(spark: SparkSession, prints: DataFrame, max_bits: int = MAX_BITS,
                       node_rows: int = NODE_ROWS) -> DataFrame:
    """(fp, root): for every distinct fingerprint of ``prints`` the least one it is linked to."""
    distinct = written(spark, prints.select("fp").distinct(), "fingerprints")
    edges = node_links(index_nodes(spark, distinct, max_bits, node_rows), max_bits)
    roots = component_roots(spark, edges)
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_groups(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                node_rows: int = NODE_ROWS) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hex digits) and
    component_id, the smallest doc_id of its group."""
    bodies = docs.select("doc_id", whole_text().cast("binary").alias("body"))
    prints = written(spark, with_fingerprint(bodies, shingle), "prints")
    groups = fingerprint_groups(spark, prints, max_bits, node_rows)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")).join(groups, "fp")
    ids = least.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    known = written(spark, groups.join(ids, "root").select("fp", "component_id"), "near-groups")
    return prints.join(known, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each near-duplicate group of ``docs``, with all its columns: the one with the
    smallest doc_id (nulls last), of repeated ids the first row."""
    rows = identified(spark, docs, "near-rows")
    prints = written(spark, with_fingerprint(
        rows.select(UID, "doc_id", whole_text().cast("binary").alias("body")), shingle), "prints")
    groups = fingerprint_groups(spark, prints, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", UID))
    best = prints.groupBy("fp").agg(first.alias("best")).join(groups, "fp")
    stay = best.groupBy("root").agg(F.min("best").alias("best")).select(F.col(f"best.{UID}").alias(UID))
    return rows.join(stay, UID, "left_semi").drop(UID)


def op10_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(spark, documents(spark, sf_dir))
