"""The vector operators against brute force."""

import numpy as np
from pyspark.sql import functions as F

from isoweave.llm import additive, graph

SCHEMA = "vec_id long, embedding array<float>, score string"


def vectors(spark, n=400, d=16, seed=0):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, d)).astype(np.float32)
    x[50:120] = x[3] + 0.01 * r.standard_normal((70, d)).astype(np.float32)  # near copies
    x[200:215] = x[4]  # copies
    x[300:330] = x[7] * 3 + 0.55 * r.standard_normal((30, d)).astype(np.float32)  # about the threshold
    rows = [(i, [float(v) for v in x[i]], "s") for i in range(n)]
    odd = [(n, None, "s"), (n + 1, [0.0] * d, "s"), (n + 2, [float("nan")] * d, "s"), (n + 3, [None] + [1.0] * (d - 1), "s"), (n + 4, [float("inf")] + [1.0] * (d - 1), "s"), (n + 5, [], "s")]
    return spark.createDataFrame(rows + odd, SCHEMA), x.astype(np.float64)


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def check_graph(spark, shard):
    df, x = vectors(spark)
    u = unit(x)
    s = u @ u.T >= 0.95
    np.fill_diagonal(s, False)
    label = np.arange(len(x))
    a, b = np.nonzero(s)
    while True:
        old = label.copy()
        np.minimum.at(label, a, label[b])
        if (old == label).all():
            break
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in graph.near_duplicates(spark, df, shard=shard).collect()}
    want = {i: (int(s[i].sum()), int(label[i])) for i in range(len(x))} | {i: (0, i) for i in range(len(x), len(x) + 6)}
    wrong = [i for i in want if got[i] != want[i]]
    assert len(got) == len(want)
    return wrong


def test_graph_in_one_shard(spark):
    assert check_graph(spark, 2048) == []


def test_graph_in_many_shards(spark):
    assert check_graph(spark, 128) == []


def test_additive(spark):
    df, x = vectors(spark, seed=1)
    u = unit(x)
    got = {}
    for r in additive.search(spark, df, F.col("vec_id") % 20 == 0, block=128).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 400, 20))
    for q, rows in got.items():
        s = u @ u[q]
        s[q] = -9
        best = np.lexsort((np.arange(len(s)), -s.round(12)))[:5]
        rows.sort()
        assert [r[1] for r in rows] == best.tolist() and np.allclose([r[2] for r in rows], s[best], atol=1e-12)


def test_empty_and_small(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert graph.near_duplicates(spark, none).count() == 0 and additive.search(spark, none, none).count() == additive.search(spark, none, F.lit(True)).count() == 0
    two = spark.createDataFrame([(1, [1.0, 0.0], ""), (2, [1.0, 0.01], ""), (2, [0.0, 1.0], "")], SCHEMA)
    assert sorted((r["vec_id"], r["n_links"]) for r in graph.near_duplicates(spark, two).collect()) == [(1, 1), (2, 0), (2, 1)]
    assert len(additive.search(spark, two, two).collect()) >= 2


def test_beam_search_beats_greedy():
    r = np.random.default_rng(2)
    x = unit(r.standard_normal((500, 8))).astype(np.float32)
    books = additive.fit(x, 4, 16)
    miss = lambda beam: ((x - additive.decode(additive.beam_encode(x, books, beam), books)) ** 2).sum()
    assert miss(8) <= miss(1)


def test_graph_recall_is_assured(spark, monkeypatch):
    """A search that finds nothing: blocks are compared; and a range search goes on through more than 400 nodes in range."""
    from isoweave.llm import graph

    r = np.random.default_rng(3)
    base = r.normal(size=(40, 16))
    x = np.concatenate([base + 0.05 * r.normal(size=base.shape) for _ in range(5)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = {q["vec_id"]: (q["n_links"], q["component_id"]) for q in graph.near_duplicates(spark, df).collect()}
    monkeypatch.setattr(graph, "_pairs", lambda spark, *a: (spark.createDataFrame([], "a long, b long, angle double"), 0.0))
    got = {q["vec_id"]: (q["n_links"], q["component_id"]) for q in graph.near_duplicates(spark, df).collect()}
    u = x / np.sqrt((x * x).sum(1))[:, None]
    links = (u @ u.T >= 0.95).sum(1) - 1
    assert got == want and [got[i][0] for i in range(len(x))] == links.tolist() and links.max() > 0

    line = np.c_[np.cos(np.linspace(0, 0.1, 900)), np.sin(np.linspace(0, 0.1, 900))].astype(np.float32)
    path = [np.array([k for k in (i - 1, i + 1) if 0 <= k < 900]) for i in range(900)]
    a, _ = graph.range_search(line, path, np.full(900, 0.99, np.float32))
    assert len(a) == 900 * 900


def odd_vectors(spark, kind="double"):
    """Repeated ids, a null vector beside a valid one of its id, several dimensions, ties across more than k copies, a clashing column."""
    r = np.random.default_rng(6)
    x = r.standard_normal((60, 3))
    rows = [(i, v.tolist(), i) for i, v in enumerate(x)]
    rows += [(1, (x[1] * 2).tolist(), 0), (1, None, 0), (1, x[2].tolist(), 0), (None, x[1].tolist(), 0)]
    rows += [(100 + i, x[5].tolist(), 0) for i in range(12)] + [(50, [1.0, 0.0], 0), (0, [1.0, 0.1], 0), (70, [0.0, 1.0], 0), (71, [2.0], 0)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, dim int"), rows


def cosine(a, b):
    if a is None or b is None or len(a) != len(b):
        return -9.0
    a, b = np.array(a), np.array(b)
    return float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))


def test_graph_of_odd_rows(spark):
    df, rows = odd_vectors(spark)
    link = [[i != j and a[0] is not None and b[0] is not None and cosine(a[1], b[1]) >= 0.95 for j, b in enumerate(rows)] for i, a in enumerate(rows)]
    low = [a[0] for a in rows]
    for _ in rows:
        low = [min([low[i], *(low[j] for j in range(len(rows)) if link[i][j])]) if low[i] is not None else None for i in range(len(rows))]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in graph.near_duplicates(spark, df).where("vec_id IS NOT NULL").collect())
    assert got == sorted((a[0], sum(link[i]), low[i]) for i, a in enumerate(rows) if a[0] is not None)
    assert [tuple(r) for r in graph.near_duplicates(spark, df).where("vec_id IS NULL").collect()] == [(None, 0, None)]


def test_the_cosine_itself_decides(spark):
    """Two vectors whose cosine is the threshold to the last bit are linked."""
    a, b = [1.0, 0.0], [0.8, 0.6]
    df = spark.createDataFrame([(1, a), (2, b)], "vec_id long, embedding array<double>")
    assert [r["n_links"] for r in graph.near_duplicates(spark, df, cosine=0.8).collect()] == [1, 1]
    assert [r["n_links"] for r in graph.near_duplicates(spark, df, cosine=float(np.nextafter(0.8, 1))).collect()] == [0, 0]


def test_additive_on_odd_rows(spark):
    df, rows = odd_vectors(spark)
    got = sorted(tuple(r) for r in additive.search(spark, df, F.col("vec_id") % 5 == 0, block=16).collect())
    want = []
    for i, q in enumerate(rows):
        if q[0] is not None and q[0] % 5 == 0:
            near = sorted((-round(cosine(q[1], b[1]), 12), b[0]) for j, b in enumerate(rows) if j != i and b[0] is not None and cosine(q[1], b[1]) > -9)[:5]
            want += [(q[0], k + 1, v, -s) for k, (s, v) in enumerate(near)]
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)] and np.allclose([g[3] for g in got], [w[3] for w in sorted(want)], atol=1e-12)
