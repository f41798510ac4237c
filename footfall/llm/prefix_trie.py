"""The prefix trie of rebuilt conversations, from fingerprints that are composed and never recomputed.

The turns of a conversation are ordered by turn (null first), then role and text. Each is known by a 64-bit
hash t of its role and text. The fingerprint of a sequence of n turns is (n, sum of t_i B^i) in two
prime fields; (n1, H1) and (n2, H2) compose to (n1 + n2, H1 + B^n1 H2), a monoid with inverses. One
range-partitioned, sorted pass gives every turn the fingerprint of its conversation up to it: partitions scan their
rows from the identity, and a conversation that crosses partitions gets the product of what lies before, one row
for each partition. A conversation is rebuilt from the head of its base conversation and the rest of its own turns
by composing such products:

    prefix = (base up to h') (own up to h)^-1 (own up to the turn)

so no text and no list of turns is copied. Every rebuilt prefix is one row, which refers to the stored turn that it
ends with. Rows of equal depth and fingerprint are a node. Nodes are verified: the turns that its rows
refer to must all have the same t, which makes the prefixes one turn shorter equal too, and so on to the root; and
each t must stand for one role and text, compared in full. Where either fails the hashes have collided and the trie is
built again with other ones.

Sums over subtrees need no walk. A node belongs to its smallest member, so each conversation owns a chain of
nodes that ends where it ends. With ``above`` the code points of a conversation's path above its
chain, the saved tokens of a subtree are the sum of ``above`` over the members, without the owner's, less
(members - 1) times the code points above the node. The leaves of a subtree are the members that own a leaf.

Defined results: null roles and texts count as empty, null turns come first, equal turns are ordered by role, then
text; repeated rows are turns each; rows without a conv_id are in no conversation; the base of conversation c is
c - c % 100 (% with the sign of c); a base that is not there or has fewer turns gives what it has; a
conversation may be rebuilt without turns and is then a member of the root only; other columns are ignored; an
empty table gives no nodes. Groups of equal conversations, common first turns and one long conversation are
spread: counts are added before they are shuffled, joins are ones that adaptive execution splits. The ids
that end at a node are hashed as a stream, in packets of up to ``PACKET`` characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import written

PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
GROUP, HEADS = 100, 6
PACKET = 1 << 16
ATTEMPTS = 8


# ------------------------------------------------------------------ the monoid

def bases(attempt: int) -> tuple[int, ...]:
    """The base of each field; every attempt has others."""
    seeds = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
    return tuple((s * (2 * attempt + 1) >> 20) % (p - 3) + 2 for s, p in zip(seeds, PRIMES))


def powers(base: int, exponent: np.ndarray, p: int) -> np.ndarray:
    """base ** exponent mod p."""
    out, square, e = np.ones(len(exponent), np.int64), base, exponent.astype(np.int64)
    while e.any():
        out = np.where(e & 1, out * square % p, out)
        square, e = square * square % p, e >> 1
    return out


def running_sums(starts: np.ndarray, values: np.ndarray, before: int, p: int | None = None) -> np.ndarray:
    """Sums of ``values`` from the last start on; ``before`` is what the first run has already."""
    total = np.cumsum(values)
    base = np.where(starts, total - values, 0)
    at = np.maximum.accumulate(np.where(starts, np.arange(len(values)), -1))
    out = np.where(at < 0, total + before, total - base[np.maximum(at, 0)])
    return out % p if p else out


def scanned_turns(ordered: DataFrame, attempt: int) -> DataFrame:
    """Sorted partitions of (conv_id, t, chars) scanned from the identity: part, conv_id, t, chars, and, counted from
    the conversation's first turn in the partition, pos, cum (code points), h0, h1 (fingerprint), q0, q1 (the same
    without the turn itself)."""
    base = bases(attempt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pos0, cum0, h0 = None, 0, 0, [0, 0]
        for b in batches:
            if not b.num_rows:
                continue
            conv = np.asarray(b.column("conv_id"))
            starts = np.r_[last is None or conv[0] != last, conv[1:] != conv[:-1]]
            chars, t = np.asarray(b.column("chars")), np.asarray(b.column("t"))
            pos = running_sums(starts, np.ones(len(conv), np.int64), pos0)
            cum = running_sums(starts, chars, cum0)
            term = [t % p * powers(x, pos, p) % p for x, p in zip(base, PRIMES)]
            h = [running_sums(starts, y, s, p) for y, p, s in zip(term, PRIMES, h0)]
            q = [(x - y) % p for x, y, p in zip(h, term, PRIMES)]
            last, pos0, cum0, h0 = conv[-1], int(pos[-1]), int(cum[-1]), [int(x[-1]) for x in h]
            yield pa.RecordBatch.from_arrays(
                [b.column("part"), b.column("conv_id"), b.column("t"), b.column("chars"), *(pa.array(x) for x in (pos, cum, *h, *q))],
                ["part", "conv_id", "t", "chars", "pos", "cum", "h0", "h1", "q0", "q1"])

    return ordered.mapInArrow(run, "part int, conv_id long, t long, chars long, pos long, cum long, h0 long, h1 long, q0 long, q1 long")


def carried(spark: SparkSession, scanned: DataFrame, attempt: int) -> DataFrame:
    """What conversations that cross partitions have before each partition: part, conv_id, b_pos, b_cum,
    b_h0, b_h1, and w0, w1, the powers that move a product behind them. The scan's ends are one row for each partition."""
    end = F.max(F.struct("conv_id", "pos", "cum", "h0", "h1")).alias("end")
    ends = scanned.groupBy("part").agg(F.min("conv_id").alias("first"), end).orderBy("part").collect()
    out, have = [], None
    for r in ends:
        if have is not None and have[0] == r["first"]:
            weight = [int(powers(b, np.array([have[1]]), p)[0]) for b, p in zip(bases(attempt), PRIMES)]
            out.append((r["part"], *have, *weight))
        e = tuple(r["end"])
        if have is not None and have[0] == e[0]:       # the whole partition is one conversation
            e = (e[0], have[1] + e[1], have[2] + e[2], *((a + w * h) % p for a, w, h, p in zip(have[3:], weight, e[3:], PRIMES)))
        have = e
    return spark.createDataFrame(out, "part int, conv_id long, b_pos long, b_cum long, b_h0 long, b_h1 long, w0 long, w1 long")


def _inverse_power(attempt: int, field: int, exponent: Column, most: int) -> Column:
    """The inverse of the field's base to a power of up to ``most``."""
    p, inverse = PRIMES[field], pow(bases(attempt)[field], -1, PRIMES[field])
    return F.element_at(F.array(*[F.lit(pow(inverse, e, p)).cast("long") for e in range(most + 1)]), exponent.cast("int") + 1)


# ------------------------------------------------------------------ turns and rebuilt prefixes

def ordered_turns(spark: SparkSession, conversations: DataFrame, attempt: int) -> DataFrame:
    """Every turn with its place, hash and the fingerprint of its conversation up to it: conv_id, pos (from
    1), t, chars, cum, h0, h1, q0, q1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
        F.monotonically_increasing_id().alias("row"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    turn = sorted_rows.select(
        F.spark_partition_id().alias("part"), "conv_id",
        F.xxhash64(F.lit(attempt), F.length("role"), "role", "text").alias("t"), F.length("text").cast("long").alias("chars"))
    scanned = written(spark, scanned_turns(turn, attempt), "scanned-turns")
    before = carried(spark, scanned, attempt)
    joined = scanned.join(F.broadcast(before), ["part", "conv_id"], "left")       # at most one row for each partition

    def whole(name: str, field: int) -> Column:
        p = F.lit(PRIMES[field])
        moved = F.pmod(F.col(f"b_h{field}") + F.pmod(F.col(f"w{field}") * F.col(name), p), p)
        return F.when(F.col("b_pos").isNotNull(), moved).otherwise(F.col(name)).alias(name)

    return joined.select("conv_id", (F.col("pos") + F.coalesce("b_pos", F.lit(0))).alias("pos"), "t", "chars",
                         (F.col("cum") + F.coalesce("b_cum", F.lit(0))).alias("cum"), *[whole(f"{x}{i}", i) for x in "hq" for i in (0, 1)])


def hashes_collide(conversations: DataFrame, attempt: int) -> bool:
    """Whether a turn hash stands for two different turns; every role and text is compared."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = conversations.where("conv_id IS NOT NULL").select(
        F.xxhash64(F.lit(attempt), F.length(role), role, text).alias("t"), F.concat(F.length(role), F.lit(":"), role, text).alias("turn"))
    return not turn.groupBy("t").agg(F.min("turn").alias("a"), F.max("turn").alias("b")).where("a != b").isEmpty()


def head_sizes(c: Column) -> Column:
    """How many turns of its base a conversation starts with."""
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(HEADS))


def rebuilt_prefixes(spark: SparkSession, turns: DataFrame, attempt: int) -> tuple[DataFrame, DataFrame]:
    """(prefixes, conversations). Prefixes: one row for each rebuilt conversation c and depth d from 1: c, d, f0, f1, p0, p1
    (the prefix one turn shorter), the turn it ends with (src_conv, src_pos, t, chars) and above (code points before it). Conversations: c, len,
    f0, f1 (the whole fingerprint), tot (its code points)."""
    firsts = turns.where(F.col("pos") <= HEADS - 1)
    parts = ("pos", "cum", "h0", "h1", "q0", "q1", "t", "chars")
    starts = firsts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*parts))).alias("starts"))   # HEADS - 1 rows at most
    ends = turns.groupBy("conv_id").agg(F.max(F.struct("pos", "cum", "h0", "h1")).alias("end"))
    convs = written(spark, ends.join(starts, "conv_id").withColumn("h", head_sizes(F.col("conv_id"))).withColumn(
        "base", F.col("conv_id") - F.col("conv_id") % GROUP), "conversations")

    nothing = F.struct(*[F.lit(0).cast("long").alias(n) for n in parts])

    def at(array: str, k: Column) -> Column:
        """The turn at place k of a conversation's first turns, the identity at place 0."""
        return F.when(k == 0, nothing).otherwise(F.try_element_at(F.col(array), k.cast("int")))

    heads = convs.select(F.col("conv_id").alias("base"), F.col("starts").alias("head"))
    joined = convs.join(heads, "base", "left")
    taken = F.least(F.coalesce(F.size("head"), F.lit(0)), F.col("h")).cast("long")
    joined = joined.withColumn("taken", F.greatest(taken, F.lit(0).cast("long")))
    joined = joined.withColumn("top", at("head", F.col("taken"))).withColumn(
        "skip", at("starts", F.least(F.col("h"), F.size("starts")).cast("long")))
    rest = F.greatest(F.col("end.pos") - F.col("h"), F.lit(0).cast("long"))

    def composed(field: int, own: Column) -> Column:
        """The base's head, then the own turns up to the product ``own`` without the first h."""
        p, name = F.lit(PRIMES[field]), f"h{field}"
        suffix = F.pmod(own - F.col(f"skip.{name}"), p)
        back = _inverse_power(attempt, field, F.col("h") - F.col("taken"), HEADS)
        return F.pmod(F.col(f"top.{name}") + F.pmod(suffix * back, p), p)

    rebuilt = written(spark, joined.select(
        F.col("conv_id").alias("c"), "base", "h", "taken", "top", "skip",
        F.slice("head", 1, F.col("taken").cast("int")).alias("head"), (F.col("taken") + rest).alias("len"),
        *[F.when(rest > 0, composed(i, F.col(f"end.h{i}"))).otherwise(F.col(f"top.h{i}")).alias(f"f{i}") for i in (0, 1)],
        (F.col("top.cum") + F.when(rest > 0, F.col("end.cum") - F.col("skip.cum")).otherwise(0)).alias("tot")), "rebuilt")

    own = turns.join(rebuilt.select(F.col("c").alias("conv_id"), "h", "taken", "top", "skip"), "conv_id").where(F.col("pos") > F.col("h"))
    suffix = own.select(
        F.col("conv_id").alias("c"), (F.col("pos") - F.col("h") + F.col("taken")).alias("d"),
        *[composed(i, F.col(f"{x}{i}")).alias(f"{y}{i}") for x, y in ("hf", "qp") for i in (0, 1)], F.col("conv_id").alias("src_conv"), F.col("pos").alias("src_pos"),
        "t", "chars", (F.col("top.cum") + F.col("cum") - F.col("skip.cum") - F.col("chars")).alias("above"))
    head = rebuilt.select("c", "base", F.explode("head").alias("x")).select(
        "c", F.col("x.pos").alias("d"), *[F.col(f"x.{x}{i}").alias(f"{y}{i}") for x, y in ("hf", "qp") for i in (0, 1)],
        F.col("base").alias("src_conv"), F.col("x.pos").alias("src_pos"), F.col("x.t").alias("t"), F.col("x.chars").alias("chars"), (F.col("x.cum") - F.col("x.chars")).alias("above"))
    return written(spark, head.unionByName(suffix), "prefixes"), rebuilt.select("c", "len", "f0", "f1", "tot")


# ------------------------------------------------------------------ nodes

NODE = ["d", "f0", "f1"]


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids (c) that end at each node, rising, joined by commas: d, f0, f1, ends_sha256. Ids are
    joined to packets where they lie sorted, and a node's packets are hashed one after the other."""
    order = [*NODE, "c"]
    schema = "d long, f0 long, f1 long, first long, ids string"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        node, first, ids, size = None, None, [], 0
        for b in batches:
            for *key, c in zip(*(b.column(n).to_pylist() for n in order)):
                if key != node or size > PACKET:
                    if ids:
                        out.append((*node, first, ",".join(ids)))
                    node, first, ids, size = key, c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if len(out) > 1000:
                yield _packets(out)
                out = []
        if ids:
            out.append((*node, first, ",".join(ids)))
        if out:
            yield _packets(out)

    def _packets(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string())],
                                          [*NODE, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            out: list[tuple] = []
            for *key, ids in zip(*(b.column(n).to_pylist() for n in (*NODE, "ids"))):
                if key == node:
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield _digests(out)
        if node is not None:
            yield _digests([(*node, state.hexdigest())])

    def _digests(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], [*NODE, "ends_sha256"])

    packets = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, schema)
    return packets.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digest, "d long, f0 long, f1 long, ends_sha256 string")


def trie_nodes(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of ``conversations`` (conv_id, turn, role, text) rebuilt with their bases' heads:
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and src_conv, src_pos, the
    stored turn that a node ends with."""
    for attempt in range(ATTEMPTS):
        found = None if hashes_collide(conversations, attempt) else _nodes(spark, conversations, attempt)
        if found is not None:
            return found
    raise RuntimeError(f"{ATTEMPTS} hash functions in a row have collided")


def _nodes(spark: SparkSession, conversations: DataFrame, attempt: int) -> DataFrame | None:
    """The nodes, or None if two different prefixes have the same fingerprint."""
    turns = written(spark, ordered_turns(spark, conversations, attempt), "turns")
    prefixes, convs = rebuilt_prefixes(spark, turns, attempt)
    nodes = prefixes.groupBy(*NODE).agg(
        F.min(F.struct("c", "src_conv", "src_pos")).alias("own"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"),
        F.max("above").alias("above"), F.max("p0").alias("p0"), F.max("p1").alias("p1"), F.min("t").alias("t"), F.max("t").alias("other"))

    nodes = written(spark, nodes.select(
        *NODE, F.col("own.c").alias("c"), F.col("own.src_conv").alias("src_conv"), F.col("own.src_pos").alias("src_pos"), "n_convs", "chars",
        "above", "p0", "p1", (F.col("t") != F.col("other")).alias("torn")), "nodes")
    if not nodes.where("torn").isEmpty():
        return None

    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("c").alias("c"), F.count("*").alias("n_convs")).where("n_convs > 0").select(      # all are members
        *[zero.alias(n) for n in NODE], "c", none.alias("src_conv"), none.alias("src_pos"), "n_convs", zero.alias("chars"),
        zero.alias("above"), none.alias("p0"), none.alias("p1"))
    children = nodes.groupBy((F.col("d") - 1).alias("d"), F.col("p0").alias("f0"), F.col("p1").alias("f1")).agg(F.count("*").alias("n_children"))
    nodes = written(spark, nodes.drop("torn").unionByName(root).join(children, NODE, "left").fillna(0, ["n_children"]), "nodes")
    chains = nodes.groupBy("c").agg(F.sum("chars").alias("own"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    per_conv = written(spark, convs.join(chains, "c", "left").select(
        "c", "len", "f0", "f1", (F.col("tot") - F.coalesce("own", F.lit(0))).alias("aside"), F.coalesce("leaf", F.lit(0)).alias("leaf")), "chains")
    sums = [F.sum("leaf").alias("n_leaves"), F.sum("aside").alias("aside"), F.min(F.struct("c", "aside")).alias("first")]
    members = prefixes.select(*NODE, "c").join(per_conv.select("c", "aside", "leaf"), "c").groupBy(*NODE).agg(*sums)
    at_root = per_conv.agg(F.count("*").alias("n"), *sums).where("n > 0").select(
        *[zero.alias(n) for n in NODE], "n_leaves", "aside", "first")
    totals = members.unionByName(at_root)
    digests = ends_digests(per_conv.select(F.col("len").alias("d"), "f0", "f1", "c"))
    nothing = F.lit(hashlib.sha256().hexdigest())
    done = written(spark, nodes.join(totals, NODE).join(digests, NODE, "left").select(
        *NODE, "p0", "p1", F.col("c").alias("conv_id"), F.col("d").alias("depth"), "n_convs", "n_children", "n_leaves",
        (F.col("aside") - F.col("first.aside") - (F.col("n_convs") - 1) * F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"), "src_conv", "src_pos"), "trie")
    parents = done.select((F.col("d") + 1).alias("d"), F.col("f0").alias("p0"), F.col("f1").alias("p1"), F.col("conv_id").alias("parent_conv_id"))
    return done.join(parents, ["d", "p0", "p1"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "src_conv", "src_pos")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return trie_nodes(spark, rows).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


ORACLE_OP12 = r"""
WITH crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) r(i))
), own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 100 AS base, count(*) AS n,
         xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
                         lambda a, b: xor(a >> 8, any_value(t)[1 + (xor(a, b) & 255)])), 4294967295) % 6 AS h
  FROM own, crc GROUP BY c
), rebuilt AS (
  SELECT k.c, o.pos AS d, o.role, o.text FROM convs k JOIN own o ON o.c = k.base AND o.pos <= k.h
  UNION ALL
  SELECT k.c, o.pos - k.h + least(k.h, coalesce(b.n, 0)), o.role, o.text
  FROM convs k JOIN own o ON o.c = k.c AND o.pos > k.h LEFT JOIN convs b ON b.c = k.base
), path AS (
  SELECT c, d, length(text) AS chars,
         list(sha256(length(role) || ':' || role || text)) OVER (PARTITION BY c ORDER BY d) AS p FROM rebuilt
  UNION ALL SELECT c, 0, 0, [] FROM convs
), lens AS (
  SELECT c, max(d) AS d FROM path GROUP BY c
), nodes AS (
  SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM path GROUP BY d, p
), children AS (
  SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), counted AS (
  SELECT u.*, coalesce(k.n, 0) AS n_children FROM nodes u LEFT JOIN children k ON k.p = u.p
), subtree AS (
  SELECT p[1:k] AS p, sum((n_convs - 1) * chars) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM counted) GROUP BY 1
), ends AS (
  SELECT a.p, sha256(string_agg(CAST(a.c AS VARCHAR), ',' ORDER BY a.c)) AS digest FROM path a JOIN lens USING (c, d) GROUP BY a.p
)
SELECT u.conv_id, u.d AS depth, v.conv_id AS parent_conv_id, u.n_convs, u.n_children, s.leaves AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
FROM counted u JOIN subtree s ON s.p = u.p LEFT JOIN nodes v ON u.d > 0 AND v.p = u.p[1:u.d - 1] LEFT JOIN ends e ON e.p = u.p
"""
