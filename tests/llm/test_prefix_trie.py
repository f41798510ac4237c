"""The prefix trie against a brute force that builds every rebuilt conversation, and against SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from footfall.llm import prefix_trie as pt
from footfall.llm.queries import ORACLE, QUERIES

from .conftest import SF_MID, key, rows_of

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def direct(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        full = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(full) + 1):
            members[full[:d]].add(c)
        ends[full].append(c)
    children, saved, leaves = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(members[p]) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += p not in children
    digest = {p: hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest() for p in members}
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p], digest[p])
                   for p, m in members.items()), key=key)


def check(spark, rows, schema=TURNS, parts=3):
    df = spark.createDataFrame(rows, schema).repartition(parts) if rows else spark.createDataFrame([], schema)
    assert rows_of(pt.trie_nodes(spark, df), *COLUMNS) == direct([r[:4] for r in rows])


def test_query_matches_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{SF_MID}/conversations.parquet'")
    got = QUERIES["op12_prefix_trie"](spark, SF_MID)
    want = duckdb.sql(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE['op12_prefix_trie']})").fetchall()
    assert set(got.columns) == set(COLUMNS)
    assert rows_of(got, *COLUMNS) == sorted(want, key=key)


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_turns_and_copies(spark, seed):
    rng = random.Random(seed)
    say = ["", "a", "b", "ab", "ünï 你", None]
    rows = [(c, t, rng.choice(["user", "assistant", "", None]), rng.choice(say))
            for c in list(range(-130, 130, 7)) + list(range(195, 260)) for t in range(rng.randint(1, 9))]
    rows += [(c, t, "user", "same") for c in range(300, 420) for t in range(3)]          # copies
    check(spark, rows)


def test_awkward_rows_and_clashing_columns(spark):
    rows = [(1, None, None, None), (1, None, "user", "x"), (1, 3, "user", "x"), (1, 3, "user", "x"), (1, 3, "a", "x"), (None, 1, "user", "no id"),
            (-100, 0, "", "a" * 300_000), (-101, 0, "", "b"), (9_000_000_000_000_000_123, 5, "ab", "c"), (9_000_000_000_000_000_100, 5, "a", "bc"),
            (200, 1, "user", "hi"), *[(200 + i, t, "user", "hi") for i in range(1, 30) for t in range(i % 4)]]
    check(spark, [(*r, "z", 5, "q") for r in rows], TURNS + ", c string, d int, text_sha256 string")


def test_no_rows(spark):
    check(spark, [])
    check(spark, [(None, 0, "user", "x")])


def test_one_long_conversation_crosses_partitions(spark):
    long = [(100, t, "user", f"{t % 7}") for t in range(900)]
    rows = [(50, 0, "user", "x")] + long + [(c, t, "user", f"{t % 7}" if t < 40 + c % 5 else "other") for c in range(101, 120) for t in range(60)]
    want = direct(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = pt.ordered_turns(spark, spark.createDataFrame(rows, TURNS).repartition(5), 0)
        assert turns.groupBy("conv_id").count().where("conv_id = 100").first()["count"] == 900
        assert turns.where("conv_id = 100").selectExpr("max(pos)", "max(cum)").first()[:] == (900, 900)
        check(spark, rows, parts=5)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(want) > 900


def test_products_compose(spark):
    """Any cut of a sequence gives the same product, and heads can be taken off again."""
    import numpy as np
    rng = np.random.default_rng(0)
    t = rng.integers(-1 << 62, 1 << 62, 300)
    for b, p in zip(pt.bases(1), pt.PRIMES):
        place = np.arange(1, 301)
        want = [sum(int(x) * pow(b, i + 1, p) for i, x in enumerate(t[:k])) % p for k in (1, 7, 300)]
        one = pt.running_sums(np.arange(300) == 0, t % p * pt.powers(b, place, p) % p, 0, p)
        assert [int(one[k - 1]) for k in (1, 7, 300)] == want
        tail = pt.running_sums(np.arange(290) == 0, t[10:] % p * pt.powers(b, place[:290], p) % p, 0, p)
        assert (int(one[9]) + pow(b, 10, p) * int(tail[-1])) % p == want[-1]


def test_collisions_are_seen_and_hashed_anew(spark, monkeypatch):
    rows = [(c, t, "user", f"{c * 31 + t}") for c in range(60) for t in range(4)]
    real = pt.bases
    monkeypatch.setattr(pt, "bases", lambda attempt: (1, 1) if attempt == 0 else real(attempt))       # order does not count: collides
    swapped = [(c, t, "user", "ab"[(c + t) % 2]) for c in (2, 3) for t in range(2)]
    df = spark.createDataFrame(rows + swapped, TURNS)
    tried = []
    inner = pt._nodes
    monkeypatch.setattr(pt, "_nodes", lambda s, d, a: tried.append(a) or inner(s, d, a))
    same_sum = [(1000, 0, "user", "a"), (1000, 1, "user", "b"), (1000, 2, "user", "c"), (1100, 0, "user", "b"), (1100, 1, "user", "a"), (1100, 2, "user", "d")]
    got = rows_of(pt.trie_nodes(spark, df.union(spark.createDataFrame(same_sum, TURNS))), *COLUMNS)
    assert got == direct(rows + swapped + same_sum) and tried == [0, 1]
