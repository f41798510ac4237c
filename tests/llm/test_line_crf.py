"""The line field against enumeration and finite differences, and its query on held-out documents."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import line_crf as lc
from footfall.llm.queries import QUERIES

from .conftest import SF_MID, WORDS, rows_of, sentence

TEXTS = ["one two\n\nTHREE!! FOUR!!\nthree three three", "", "x\nx\nx", "你好 ünï\n12 34", "a" * 90, "\n\n", "words $$$ | and %%%\nplain line here"]


def random_field(seed=0):
    rng = np.random.default_rng(seed)
    m = lc.LineField()
    m.trigrams[:-1] = rng.normal(0, 20, (lc.BUCKETS, 3))
    m.bytes[:-1] = rng.normal(0, 5, (256, 3))
    m.dense[:] = rng.normal(0, 1, m.dense.shape)
    m.pairs[:] = rng.normal(0, 1, (2, 2))
    m.bias[:] = 0.3
    return m


def plain_evidence(m, text):
    """Line by line: the line's own weights, those of the line before and those of the line after."""
    lines = text.encode().split(b"\n")
    dense = lc.Lines.of([text.encode()]).dense
    v = []
    for i, line in enumerate(lines):
        grams = [line[k:k + 3] for k in range(len(line) - 2)]
        at = [(((g[0] << 16 | g[1] << 8 | g[2]) * 2654435761) & 0xFFFFFFFF) >> (32 - lc.BUCKETS.bit_length() + 1) for g in grams]
        v.append(sum((m.trigrams[a].astype(float) for a in at), np.zeros(3)) / max(1, len(line) - 2)
                 + sum((m.bytes[b].astype(float) for b in line), np.zeros(3)) / max(1, len(line)) + dense[i].astype(float) @ m.dense)
    return [v[i][0] + (v[i - 1][1] if i else 0) + (v[i + 1][2] if i + 1 < len(v) else 0) + float(m.bias[0]) for i in range(len(v))]


def enumerated(m, evidence):
    """Marginals, and log of the sum over all labellings."""
    total, good = [], []
    for ys in itertools.product((0, 1), repeat=len(evidence)):
        total.append(sum(e * y for e, y in zip(evidence, ys)) + sum(float(m.pairs[a, b]) for a, b in zip(ys, ys[1:])))
        good.append(ys)
    w = np.exp(np.array(total) - max(total))
    return (w[:, None] * np.array(good)).sum(axis=0) / w.sum(), max(total) + np.log(w.sum())


def test_marginals_match_enumeration(monkeypatch):
    m = random_field()
    lines = lc.Lines.of([t.encode() for t in TEXTS])
    evidence, p = m.evidence(lines), m.marginals(lines)
    for i, t in enumerate(TEXTS):
        own = slice(lines.first[i], lines.first[i + 1])
        assert lines.first[i + 1] - lines.first[i] == t.count("\n") + 1
        assert np.allclose(evidence[own], plain_evidence(m, t), atol=1e-4)
        assert np.allclose(p[own], enumerated(m, evidence[own])[0], atol=1e-9)
    raw = m.raw_quality(lines)
    sizes = [len(x) for x in TEXTS[0].encode().split(b"\n")]
    assert raw[0] == pytest.approx(np.average(p[:4], weights=sizes)) and np.isnan(raw[1]) and np.isnan(raw[5])
    monkeypatch.setattr(lc, "SEGMENT", 7)             # sums over parts of the bytes are the same sums
    assert np.allclose(m.evidence(lines), evidence, atol=1e-6)


def test_gradients_match_finite_differences():
    lines = lc.Lines.of([t.encode() for t in TEXTS])
    good = (np.arange(len(lines.start)) % 3 > 0).astype(float)

    def likelihood(m):
        e, out = m.evidence(lines), 0.0
        for i in range(len(TEXTS)):
            own = slice(lines.first[i], lines.first[i + 1])
            y = good[own].astype(int)
            out += e[own] @ y + sum(float(m.pairs[a, b]) for a, b in zip(y, y[1:])) - enumerated(m, e[own])[1]
        return out

    m = random_field(1)
    for name in ("trigrams", "bytes", "dense", "bias", "pairs"):
        setattr(m, name, getattr(m, name).astype(np.float64))
    found, _ = lc.gradients(m, lines, good)
    rng = np.random.default_rng(2)
    for name, g in found.items():
        w = getattr(m, name)
        used = np.argwhere(np.abs(g) > 1e-9)
        for at in used[rng.permutation(len(used))[:6]]:
            at, step = tuple(at), 1e-3
            keep = w[at]
            w[at] = keep + step
            up = likelihood(m)
            w[at] = keep - step
            down = likelihood(m)
            w[at] = keep
            assert (up - down) / (2 * step) == pytest.approx(g[at], rel=1e-3, abs=1e-6)


def test_held_out_quality(spark):
    got = QUERIES["op13_line_crf"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    r = got.join(labels, "doc_id").where("held_out").agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("right"),
        F.avg(F.when(F.col("quality") == 0, (F.col("predicted") == 0).cast("int"))).alias("bad"),
        F.avg(F.when(F.col("quality") == 1, (F.col("predicted") == 1).cast("int"))).alias("good")).first()
    assert r["right"] > 0.98 and r["bad"] > 0.92 and r["good"] > 0.99


def test_every_document_once_in_any_split(spark):
    got = QUERIES["op13_line_crf"](spark, SF_MID)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = rows_of(got, "doc_id", "held_out", "score", "predicted")
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    assert [r[:2] for r in rows] == rows_of(docs.select("doc_id", F.expr("crc32(cast(string(doc_id) as binary)) % 5 = 0").alias("h")), "doc_id", "h")
    assert all(0 <= r[2] <= 1 and r[3] == int(r[2] >= 0.3) for r in rows)
    model = lc.fit_field(*lc.labelled_sample(docs, spark.read.parquet(f"{SF_MID}/labels.parquet"), F.expr("crc32(cast(string(doc_id) as binary)) % 5 != 0")))
    again = lc.with_quality(spark, docs.select("doc_id", "text").repartition(7), model)
    assert rows_of(again, "doc_id", "score") == [(r[0], r[2]) for r in rows]


@pytest.fixture(scope="module")
def small_field():
    good = [sentence(i, 40) + "\n" + sentence(i + 1, 30) for i in range(60)]
    bad = [" | ".join(w.upper() + "!!" for w in sentence(i, 30).split()) + "\n" + sentence(i, 20) for i in range(60)]
    return lc.fit_field([t.encode() for t in good + bad], [1] * 60 + [0] * 60)


def test_awkward_rows(spark, awkward, clashing, empty, small_field):
    got = lc.with_quality(spark, awkward.select("doc_id", "text"), small_field).collect()
    assert len(got) == awkward.count() and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert by_id[100] == by_id[101] == small_field.share
    assert by_id[104] == by_id[105] > 0.5
    more = lc.with_quality(spark, clashing, small_field, "__quality")
    assert set(clashing.columns) - {"text"} < set(more.columns) and more.count() == len(got)
    assert lc.with_quality(spark, empty, small_field).collect() == []
    assert {r["score"] for r in lc.with_quality(spark, awkward, None).collect()} == {0.5}


def test_mixed_documents_lie_between(small_field):
    clean, junk = sentence(3, 60), " | ".join(w.upper() + "!!" for w in sentence(5, 30).split())
    a, b, c = small_field.scores([clean.encode(), f"{clean}\n{junk}".encode(), junk.encode()])
    assert a > b > c


def test_sample_counts_distinct_texts(spark, monkeypatch):
    monkeypatch.setattr(lc, "SAMPLE_PER_CLASS", 30)
    docs = [(i, "the same text") for i in range(500)] + [(1000 + i, sentence(i, 12)) for i in range(50)] + [(3000, None), (None, "no id"), (3001, "BAD!!")]
    labels = [(i, 1, 0) for i in range(500)] + [(1000 + i, i % 2, 0) for i in range(50)] + [(3001, 0, 1), (3001, 0, 1), (3000, 1, 0), (None, 1, 0), (1001, 7, 0), (1002, None, 0)]
    texts, quality = lc.labelled_sample(spark.createDataFrame(docs, "doc_id long, text string"),
                                        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), F.lit(True))
    assert len(texts) == len(set(zip(texts, quality))) and set(quality) == {0, 1}
    found = {t.decode() for t in texts}
    assert "the same text" in found and "BAD!!" in found and len(found) == len({sentence(i, 12) for i in range(50)}) + 2
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert lc.fit_field(*lc.labelled_sample(spark.createDataFrame(docs, "doc_id long, text string"), none, F.lit(True))) is None
    assert lc.fit_field([b"a b", b"c d"], [1, 1]).scores([b"a b"])[0] > 0.5


def test_long_texts_are_read_whole(small_field):
    junk = " | ".join(w.upper() + "!!" for w in WORDS)
    long = "\n".join([sentence(1, 30)] * 20_000)                    # several segments
    low, high = small_field.scores([(long[: len(long) // 4] + "\n" + "\n".join([junk] * 20_000)).encode(), long.encode()])
    assert low < high
