"""Decompositions, clusters, reservoirs and evaluations against plain NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from isoweave import api
from isoweave.operators import embed, evaluate, inference


def entries(spark, x, names=None):
    r, c = np.nonzero(x)
    rows = [(names[i] if names else f"c{i:05d}", f"f{j:06d}", float(x[i, j])) for i, j in zip(r, c)]
    return spark.createDataFrame(rows, "cell string, feature string, value double").repartition(3)


def same_up_to_sign(a, b, tol):
    return all(min(np.abs(a[:, k] - b[:, k]).max(), np.abs(a[:, k] + b[:, k]).max()) < tol for k in range(a.shape[1]))


def test_coordinates_of_many_sparse_features(spark):
    r = np.random.default_rng(3)
    n, d = 300, 30_000
    x = np.zeros((n, d))
    x[np.repeat(np.arange(n), 60), r.integers(0, d, n * 60)] = r.exponential(1, n * 60)
    for k in range(8):  # some structure
        x[np.ix_(np.arange(k, n, 8), np.arange(k * 20, k * 20 + 20))] += 3 + k
    x[5] = 0
    used = np.flatnonzero(x.any(0))
    got = embed.svd_embedding(entries(spark, x), spark.createDataFrame([(f"c{i:05d}",) for i in range(n)], "cell string"), 8)
    rows = {q["cell"]: q["x"] for q in got.collect()}
    a = np.array([rows[f"c{i:05d}"] for i in range(n)])
    u, s, vt = np.linalg.svd(x[:, used], full_matrices=False)
    assert same_up_to_sign(a, (u * s)[:, :8], 1e-6 * s[0])
    assert not a[5].any()


@pytest.mark.parametrize("shape", [(1, 5), (5, 1), (6, 6), (40, 7), (7, 40)])
def test_small_and_degenerate(spark, shape):
    r = np.random.default_rng(1)
    x = r.integers(0, 4, shape).astype(float)
    x[:, 0] = 1
    if shape == (40, 7):
        x[:, 3] = x[:, 2] = x[:, 1]  # of lower rank
    rows, _, d = embed.sparse_rows(entries(spark, x))
    values, vectors = embed.right_vectors(rows, d, 5)
    s = np.linalg.svd(x, compute_uv=False)
    want = np.r_[s, np.zeros(9)][: len(values)]
    assert np.allclose(values, want, atol=1e-6 * s[0]) and np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-8)


def test_repeated_values_and_bad_entries(spark):
    x = np.diag([3.0, 3, 3, 2, 2, 1])
    rows, index, d = embed.sparse_rows(entries(spark, x))
    assert [r["j"] for r in index.orderBy("feature").collect()] == list(range(6)) == list(range(d))
    values, _ = embed.right_vectors(rows, d, 4)
    assert np.allclose(values, [3, 3, 3, 2])
    for bad in ([("a", "f", float("nan"))], [("a", "f", float("inf"))], [("a", "f", 1.0), ("a", "f", 2.0)], [("a", "f", None)]):
        with pytest.raises(Exception, match="not finite|twice"):
            embed.sparse_rows(spark.createDataFrame(bad, "cell string, feature string, value double"))
    with pytest.raises(ValueError, match="numbers"):
        embed.right_vectors(rows, 10_000_000, 20)


def plain_kmeans(x, k, seed, rounds=10):
    draw, centres = np.random.RandomState(seed), []
    for i in range(k):
        if i == 0:
            at = draw.randint(len(x))
        else:
            d = np.min([((x - c) ** 2).sum(1) for c in centres], axis=0)
            at = np.searchsorted((d / d.sum()).cumsum(), draw.uniform())
        centres.append(x[at])
    centres = np.array(centres)
    for _ in range(rounds):
        label = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.array([x[label == j].mean(0) if (label == j).any() else centres[j] for j in range(k)])
    return label


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_kmeans_replayed(spark, seed):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"))
    plain = rows.orderBy("id").collect()
    got = {r["id"]: r["cluster"] for r in embed.kmeans(rows.repartition(5), 7, seed).collect()}
    want = plain_kmeans(np.array([r["x"] for r in plain]), 7, seed)
    assert [got[r["id"]] for r in plain] == want.tolist()


def test_kmeans_of_few_points(spark):
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(5)] + [(9, [5.0, 5.0])], "id long, x array<double>")
    assert len({r["cluster"] for r in embed.kmeans(same, 2).collect()}) == 2
    with pytest.raises(ValueError, match="only 2 points differ"):
        embed.kmeans(same, 3)
    with pytest.raises(ValueError, match="from 1 to"):
        embed.kmeans(same, 7)
    assert {r["cluster"] for r in evaluate.kmeans(same, 10).collect()} == {0, 1}


def serial(values, most, seed):
    draw, kept = np.random.default_rng(seed), []
    for t, v in enumerate(values, 1):
        if len(kept) < most:
            kept.append(v)
        elif (j := int(draw.integers(t))) < most:
            kept[j] = v
    return kept


@pytest.mark.parametrize(("n", "most", "seed"), [(0, 5, 0), (5, 5, 0), (6, 5, 0), (9000, 2000, 0), (9000, 2000, 3), (5000, 1, 1)])
def test_reservoir_replayed(spark, n, most, seed):
    values = [(k * 7919) % 10_007 for k in range(n)]
    df = spark.createDataFrame([(v, k // 10, k % 10) for k, v in enumerate(values)], "d int, a int, b int").repartition(4)
    got = {r["slot"]: r["d"] for r in inference.reservoir(df, ["a", "b"], most, seed).collect()}
    assert [got[k] for k in range(len(got))] == serial(values, most, seed)


def test_reservoir_over_many_draws():
    assert inference.reservoir_places(100_000, 50, 4) == serial(range(1, 100_001), 50, 4)


def test_training_by_seed(spark):
    rows = [((("chr1", k % 5, f"g{k % 5}", "t"),), f"c{k:04d}", "u", f"g{k % 5}", k) for k in range(600)]
    t = spark.createDataFrame([(r[0][0], *r[1:]) for r in rows], "catalog struct<chrom:string,a:int,gene_id:string,id:string>, cell string, umi string, gene_id string, d int")
    ordered = [r[4] for r in sorted(rows)]
    assert inference.reservoir_samples(t, 100, 5).first()["samples"] == sorted(map(float, serial(ordered, 100, 5)))
    assert inference.reservoir_samples(t, 100, 6).first()["samples"] != inference.reservoir_samples(t, 100, 5).first()["samples"]
    with pytest.raises(Exception, match="negative"):
        inference.reservoir_samples(t.withColumn("d", F.lit(-1)), 100, 5).collect()
    for bad in ({"bandwidth": 0}, {"bandwidth": float("nan")}, {"training": 0}, {"tau": -1}):
        with pytest.raises(ValueError):
            api.Parameters(**bad)


def blobs(n=60, d=30, seed=0):
    r = np.random.default_rng(seed)
    kind = np.arange(n) % 3
    return r.poisson(1 + 30 * (np.arange(d)[None] % 3 == kind[:, None])).astype(float), kind


def test_evaluate_cells(spark):
    x, kind = blobs()
    x[7] = 0
    names = [f"c{i:05d}" for i in range(len(x))]
    cells = spark.createDataFrame([(n,) for n in names], "cell string")
    labels = spark.createDataFrame([(n, int(k)) for n, k in zip(names, kind)], "cell string, label int")
    got = embed.evaluate_cells(entries(spark, x), cells, 4, labels, 5)
    total = x.sum(1, keepdims=True)
    normal = np.log1p(np.divide(x * 1e4, total, out=np.zeros_like(x), where=total > 0))
    u, s, _ = np.linalg.svd(normal, full_matrices=False)
    a = np.array([r["x"] for r in got.embedding.orderBy("cell").collect()])
    assert same_up_to_sign(a, (u * s)[:, :5], 1e-6 * s[0])
    found = [r["cluster"] for r in got.clusters.orderBy("cell").collect()]
    assert found == plain_kmeans(a, 4, 0).tolist()
    gap = np.sqrt(((a[:, None] - a[None]) ** 2).sum(2))
    f, sil = np.array(found), []
    for i in range(len(a)):
        own = f == f[i]
        if own.sum() == 1:
            sil.append(0.0)
            continue
        w, o = gap[i, own].sum() / (own.sum() - 1), min(gap[i, f == j].mean() for j in set(found) - {found[i]})
        sil.append((o - w) / max(o, w))
    assert np.isclose(got.silhouette, np.mean(sil))
    assert 0.5 < got.adjusted_rand < 1 and 0.5 < got.normalized_mutual_info < 1


def test_evaluations_that_are_refused(spark):
    x, _ = blobs(9, 6)
    e, cells = entries(spark, x), spark.createDataFrame([(f"c{i:05d}",) for i in range(9)], "cell string")
    for bad, what in (
        (lambda: embed.evaluate_cells(e, cells.union(cells.limit(1)), 2), "unique"), (lambda: embed.evaluate_cells(e, cells, 9), "clusters"), (lambda: embed.evaluate_cells(e, cells, 2, n_components=0), "positive"),
        (lambda: embed.evaluate_cells(e, cells.where("cell <> 'c00001'"), 2), "unknown cell"), (lambda: embed.evaluate_cells(e.withColumn("value", -F.col("value")), cells, 2), "negative"), (lambda: embed.evaluate_cells(e.limit(0), cells, 2), "feature"),
        (lambda: embed.evaluate_cells(e, cells, 2, spark.createDataFrame([("c00001", 1)], "cell string, label int")), "missing 8"),
        (lambda: embed.evaluate_cells(entries(spark, np.ones((9, 6))), cells, 3), "distinct embedded rows"), (lambda: embed.compare_cell_matrices(e, cells, e, cells.limit(8), 2), "same barcodes: 1 missing, 0"),
    ):
        with pytest.raises(Exception, match=what):
            bad()
    y = x[:, ::-1].copy()
    assert embed.compare_cell_matrices(e, cells, entries(spark, y), cells, 3)[0] == pytest.approx(1.0)
