"""Whitening by rank-one updates against plain numpy on the whole fit list."""

import numpy as np
import pytest

from footfall.llm import whitening as wh
from footfall.llm.queries import QUERIES

from .conftest import SF_SMALL

VECTORS = "vec_id long, embedding array<float>"


def direct(rows: list[tuple], k: int = wh.COMPONENTS):
    """Brute force: kept ids and x, exact deviations, eigenvalues, whitened up to sign."""
    kept = [(i, [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(col) for col in zip(*fit)]
    dev = [sum((n * a - s) ** 2 for a, s in zip(x, sums)) for _, x in kept]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    away = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for _, x in kept])
    return kept, n, dev, values, (away @ vectors)[:, :k]


def compare(got, rows):
    kept, n, dev, values, projected = direct(rows)
    k = min(wh.COMPONENTS, len(kept[0][1]))
    real = values[:k] > 1e-12 * values[0]
    by_component = {c: sorted((r for r in got if r["component"] == c), key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0, int(r["deviation_text"]))) for c in range(1, k + 1)}
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, dev[i]))
    assert len(got) == k * len(kept)
    for c in range(1, k + 1):
        mine = by_component[c]
        assert [r["vec_id"] for r in mine] == [kept[i][0] for i in order]
        assert [(r["n"], r["deviation"], r["deviation_text"]) for r in mine] == [(n, dev[i] if dev[i] < 1 << 63 else None, str(dev[i])) for i in order]
        have = np.array([r["whitened"] for r in mine])
        assert mine[0]["explained"] == pytest.approx(values[c - 1] / (values.sum() or 1.0), rel=1e-9, abs=1e-13)
        assert mine[0]["identity_error"] < 1e-8
        if not real[c - 1]:
            assert not have.any() and mine[0]["explained"] == 0
            continue
        want = projected[order, c - 1] / np.sqrt(values[c - 1])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-7


@pytest.mark.parametrize("dims, n, kind", [(64, 400, "normal"), (8, 5, "few"), (16, 300, "repeats"), (10, 300, "steps"),
                                           (5, 60, "plane"), (1, 9, "line"), (64, 200, "uneven")])
def test_rank_one_updates_keep_the_spectrum(dims, n, kind):
    rng = np.random.default_rng(dims + n)
    x = rng.normal(size=(n, dims)) * 8
    x = {"repeats": lambda: np.repeat(x[:n // 25], 25, axis=0), "steps": lambda: np.round(x / 8),
         "plane": lambda: x[:, :2] @ rng.normal(size=(2, dims)), "uneven": lambda: x * 10.0 ** (-np.arange(dims) / 6)}.get(kind, lambda: x)()
    some = [wh.CentredSpectrum.empty(dims) for _ in range(3)]
    for i, row in enumerate(x):
        some[i % 3].take(row)
    total = wh.CentredSpectrum.of_record(*some[0].record())
    total.join(some[1])
    total.join(some[2])
    total.join(wh.CentredSpectrum.empty(dims))
    centred = x - x.mean(axis=0)
    scatter, u = centred.T @ centred, total.scatter.vectors
    assert total.n == n and np.allclose(total.mean, x.mean(axis=0))
    assert np.abs(total.scatter.values - np.linalg.eigvalsh(scatter)).max() < 1e-12 * np.abs(scatter).max()
    assert np.abs(u.T @ u - np.eye(dims)).max() < 1e-12
    assert np.abs(u @ np.diag(total.scatter.values) @ u.T - scatter).max() < 1e-12 * np.abs(scatter).max() * dims


def test_secular_roots_lie_between_the_poles():
    rng = np.random.default_rng(3)
    for k, spread in ((1, 1.0), (2, 1e-9), (7, 1e6), (40, 1.0)):
        d = np.cumsum(rng.random(k) * spread + 1e-12)
        z2 = rng.random(k) ** 8 + 1e-14
        delta = wh.secular_roots(d, z2, 3.0)
        root = d - delta[np.arange(k), np.arange(k)]
        assert (root >= d).all() and (root[:-1] <= d[1:]).all() and root[-1] <= d[-1] + 3 * z2.sum() * (1 + 1e-12)
        terms = z2[:, None] / delta
        assert (np.abs(1 / 3.0 + terms.sum(axis=0)) <= 1e-12 * (1 / 3.0 + np.abs(terms).sum(axis=0))).all()


def test_query_matches_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    compare(QUERIES["op11_whitening"](spark, SF_SMALL).collect(), rows)


def test_many_partitions_and_awkward_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(size=20) * (3 - 0.1 * np.arange(20))]) for i in range(120)]
    hot = rows[7][1]
    rows += [(1000 + i, hot) for i in range(200)] + [(None, hot), (7, hot), (7, hot), (2, [0.0] * 20)]
    rows += [(3000, None), (3001, []), (3002, [None] + [1.0] * 19), (3003, [float("nan")] + [1.0] * 19), (3004, [float("-inf")] * 20)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS + ", x string, n int").repartition(40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        got = wh.whitened_embeddings(spark, df).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    compare(got, rows)


@pytest.mark.parametrize("rows", [
    [(1, [1.0, 2.0, 3.0])],
    [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 2.001])],
    [(i, [float(i), 2.0 * i, 1e9 * (i % 3)]) for i in range(12)],
    [(i, [float(i % 5)]) for i in range(12)]])
def test_few_vectors_and_components_without_variance(spark, rows):
    compare(wh.whitened_embeddings(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), rows)


def test_long_deviations(spark):
    rows = [(i, [1e13 * (i % 7), float(i)]) for i in range(1000)]
    got = wh.whitened_embeddings(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    fit = {(int(64 * a) + 1_000_000, int(64 * b) + 1_000_000) for _, (a, b) in rows}
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    for r in got:
        a, b = 64 * int(1e13 * (r["vec_id"] % 7)) + 1_000_000, 64 * r["vec_id"] + 1_000_000
        want = (n * a - sums[0]) ** 2 + (n * b - sums[1]) ** 2
        assert int(r["deviation_text"]) == want and r["deviation"] == (want if want < 1 << 63 else None)


def test_empty_and_unequal_vectors(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert wh.whitened_embeddings(spark, empty).collect() == []
    assert wh.whitened_embeddings(spark, spark.createDataFrame([(1, None), (2, [])], VECTORS)).collect() == []
    with pytest.raises(ValueError, match="same length"):
        wh.whitened_embeddings(spark, spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], VECTORS))
