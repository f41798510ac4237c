"""Exact dedup by chunk recipes and SimHash near-dedup, against brute force."""

import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.llm import chunk_dedup as cd
from footfall.llm import gray_simhash as gs
from footfall.llm.components import component_roots
from footfall.llm.queries import ORACLE, QUERIES

from .conftest import CLASHES, SF_MID, awkward_rows, rows_of, sentence


def exact_expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[-1], len(ids), n == len(ids) - 1, digest) for n, i in enumerate(ids)]
    return out


COLS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("id_bits", [64, 3])      # 3 bits: most identifiers clash and are told apart
def test_exact_dedup_on_awkward_rows(spark, awkward, id_bits):
    from .conftest import key
    got = rows_of(cd.exact_dedup(spark, awkward, id_bits), *COLS)
    assert got == sorted(exact_expected(awkward_rows()), key=key)


def test_exact_dedup_ignores_other_columns_and_empty_tables(spark, clashing, empty, awkward):
    assert rows_of(cd.exact_dedup(spark, clashing), *COLS) == rows_of(cd.exact_dedup(spark, awkward), *COLS)
    assert cd.exact_dedup(spark, empty).count() == 0
    kept = cd.drop_exact_copies(spark, clashing)
    assert kept.columns == clashing.columns and set(CLASHES) <= set(kept.columns)
    assert kept.count() == len({r[1] or "" for r in awkward_rows()})


def test_exact_dedup_matches_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF_MID}/documents.parquet'")
    want = duckdb.sql(f"SELECT {', '.join(COLS)} FROM ({ORACLE['op2_chunk_dedup']}) ORDER BY doc_id").fetchall()
    assert rows_of(QUERIES["op2_chunk_dedup"](spark, SF_MID), *COLS) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=6000), st.integers(1, 40), st.integers(0, 255))
def test_chunks_rebuild_the_text_and_follow_content(data, times, fill):
    text = data * times + bytes([fill]) * 3000
    parts = cd.chunks(text)
    assert b"".join(parts) == text
    assert all(len(p) <= cd.MOST for p in parts) and all(parts)


def test_long_text_shares_chunks_with_its_copy_after_an_insertion():
    text = " ".join(sentence(i, 50) for i in range(400)).encode() + np.random.default_rng(1).bytes(200_000)
    a, b = set(cd.chunks(text)), set(cd.chunks(b"something new in front " + text))
    assert len(a & b) > 0.8 * len(a)


# ------------------------------------------------------------------ SimHash

def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_groups(prints, max_bits):
    n, root = len(prints), list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_near_groups_on_awkward_rows(spark, awkward, clashing, empty):
    rows = awkward_rows()
    prints = [slow_print(r[1]) for r in rows]
    root = slow_groups(prints, 2)
    least = {}
    for r, g in zip(rows, root):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    from .conftest import key
    want = sorted(((r[0], f"{p:016x}", least.get(g)) for r, p, g in zip(rows, prints, root)), key=key)
    for df in (awkward, clashing):
        assert rows_of(gs.near_groups(spark, df), "doc_id", "fingerprint", "component_id") == want
    assert gs.near_groups(spark, empty).count() == 0
    kept = gs.drop_near_copies(spark, clashing)
    assert kept.columns == clashing.columns and kept.count() == len(set(root))


@pytest.mark.parametrize("node_rows", [4, 64, 2048])
def test_index_loses_no_link(spark, node_rows):
    """Random codes, dense clusters round a few centres, and a hot part that all share."""
    rng = np.random.default_rng(node_rows)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    codes = {int(c) for c in rng.integers(0, 1 << 63, 150, dtype=np.uint64)}
    for c in centres:
        for _ in range(40):
            flips = rng.integers(0, 64, rng.integers(0, 5))
            codes.add(int(c) ^ int(sum(1 << int(f) for f in set(flips.tolist()))))
    codes |= {(0xABCDE << 44) | int(x) for x in rng.integers(0, 1 << 40, 150)}
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "fp long")
    got = {r["fp"]: r["root"] for r in gs.fingerprint_groups(spark, df, 2, node_rows).collect()}
    want = slow_groups(codes, 2)
    groups = defaultdict(set)
    for s, g in zip(signed, want):
        groups[g].add(s)
    assert {s: min(groups[g]) for s, g in zip(signed, want)} == got


def test_no_node_stays_above_the_limit(spark):
    # 4096 codes that share their upper 52 bits: one hot part until the last positions are cut
    df = spark.range(4096).select((F.lit(0x1234567890 << 12) + F.col("id")).alias("fp"))
    nodes = gs.index_nodes(spark, df, 2, 256)
    assert nodes.groupBy("mask", "bits").count().agg(F.max("count")).first()[0] <= 256
    assert gs.fingerprint_groups(spark, df, 2, 256).select("root").distinct().count() == 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), min_size=2, max_size=60, unique=True), st.integers(0, 20))
def test_gray_tree_finds_all_close_pairs(codes, spread):
    codes = np.array(sorted({c % (1 << (spread + 6)) for c in codes}), np.uint64)
    codes = codes[np.argsort(gs.gray_rank(codes))]
    a, b = gs.close_pairs(codes, np.zeros(len(codes), np.int64), 2)
    want = {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes)) if int(codes[i] ^ codes[j]).bit_count() <= 2}
    assert set(zip(a.tolist(), b.tolist())) == want


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, i) for i in range(1001, 1200)]
    roots = {r["node"]: r["root"] for r in component_roots(spark, spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert {roots[i] for i in range(301)} == {0} and {roots[i] for i in range(1000, 1200)} == {1000}
    assert component_roots(spark, spark.createDataFrame([], "a long, b long")).count() == 0
