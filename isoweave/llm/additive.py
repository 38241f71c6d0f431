"""Operator 9: approximate nearest neighbours by additive quantisation.

A vector of length 1 is coded as the sum of one entry from each of M
full-dimensional codebooks, chosen by beam search.  The codebooks start as those
of residual k-means and are then fitted together by least squares, on a bounded
sample (TRAIN).  Beside its codes every vector keeps the norm of its coded form
and of what the code misses.  A query scores a block of coded rows by lookup
tables.  The error norm bounds how far a score can be off, so every row that may
still be among the k nearest of its block is ranked again on original vectors;
the tables decide only which rows need not be looked at.

Rows are coded once and packed into blocks; query blocks meet every row block
(a stated query set against all rows), and a meeting gives k rows a query.

Vectors that are null, zero or hold null or non-finite components, and rows with
a null id, take no part.  Copies of a vector are scored once and rank by id.
Vectors of different dimensions are searched among themselves.  Rows that share an
id are rows of their own: each of them is a candidate for the others, and each has
its k nearest if it is a query.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lean, partitions, written
from .vectors import kmeans, matrix, precision, sample, tagged, unit

#: Codebooks, entries in each, beam, sampled rows for fitting, rows of a block, queries of a block.
BOOKS, ENTRIES, BEAM, TRAIN, BLOCK, QUERIES = 16, 256, 4, 8000, 8192, 1024


def beam_encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Codes (n, M) of rows of x: the best `beam` partial sums are kept from book to book."""
    n, m, k = len(x), *books.shape[:2]
    out = np.zeros((n, m), np.uint8)
    norms = (books * books).sum(2)
    for lo in range(0, n, 1024):
        part = x[lo : lo + 1024]
        p = len(part)
        rest = part[:, None, :]  # what the sums so far miss
        cost = (part * part).sum(1)[:, None]
        codes = np.zeros((p, 1, 0), np.uint8)
        for b in range(m):
            width = rest.shape[1]
            d = cost[:, :, None] - 2 * (rest.reshape(-1, x.shape[1]) @ books[b].T).reshape(p, width, k) + norms[b]
            flat = d.reshape(p, -1)
            take = min(beam, flat.shape[1])
            best = np.argpartition(flat, take - 1, axis=1)[:, :take] if take < flat.shape[1] else np.tile(np.arange(take), (p, 1))
            rows = np.arange(p)[:, None]
            cost, parent, entry = flat[rows, best], best // k, best % k
            rest = rest[rows, parent] - books[b][entry]
            codes = np.concatenate([codes[rows, parent], entry[:, :, None].astype(np.uint8)], axis=2)
        out[lo : lo + 1024] = codes[np.arange(p), cost.argmin(1)]
    return out


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), books.shape[2]), books.dtype)
    for b in range(len(books)):
        out += books[b][codes[:, b]]
    return out


def fit(x: np.ndarray, m: int = BOOKS, k: int = ENTRIES, rounds: int = 2, seed: int = 0) -> np.ndarray:
    """Codebooks (M, K, d): residual k-means, then rounds of beam search and a joint least-squares fit."""
    k = max(1, min(k, len(x)))
    books, rest = [], x.copy()
    for b in range(m):
        c = kmeans(rest, k, seed=seed + b)
        books.append(c)
        rest -= c[((c * c).sum(1) - 2 * rest @ c.T).argmin(1)]
    out = np.stack(books)
    for _ in range(rounds):
        codes = beam_encode(x, out).astype(np.int64) + np.arange(m) * k
        gram, right = np.zeros((m * k, m * k)), np.zeros((m * k, x.shape[1]))
        for a in range(m):
            np.add.at(right, codes[:, a], x)
            for b in range(a, m):
                block = np.bincount(codes[:, a] % k * k + codes[:, b] % k, minlength=k * k).reshape(k, k)
                gram[a * k : (a + 1) * k, b * k : (b + 1) * k] = block
                gram[b * k : (b + 1) * k, a * k : (a + 1) * k] = block.T
        gram[np.diag_indices(m * k)] += 0.1
        # what the fit leaves as it is: the old books, so that entries without rows stay where they are
        old = out.reshape(m * k, -1).astype(np.float64)
        out = np.linalg.solve(gram, right + 0.1 * old).reshape(out.shape).astype(x.dtype)
    return out


def _near(q: np.ndarray, row: dict, k: int, books: np.ndarray, probe: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the k nearest distinct vectors of a block; q: unit rows."""
    tables = np.einsum("qd,mkd->qmk", q.astype(np.float32), books)
    codes, missed, norm, x = row["codes"], row["missed"], row["norm"], row["x"]
    n = len(codes)
    out = []
    for i in range(len(q)):
        score = np.zeros(n, np.float32)
        for b in range(codes.shape[1]):
            score += tables[i, b][codes[:, b]]
        upper = score + missed  # no row's cosine is above: the query has length 1
        first = np.argpartition(-score / norm, min(probe, n) - 1)[: min(probe, n)]  # by the cosine with the coded forms
        exact = (x[first] * q[i]).sum(1)
        least = np.partition(exact, len(exact) - k)[len(exact) - k] if len(exact) >= k else -2.0
        cand = np.flatnonzero(upper >= least - 1e-5)
        exact = (x[cand] * q[i]).sum(1)
        if len(cand) > k:
            least = np.partition(exact, len(cand) - k)[len(cand) - k]
            keep = exact >= least
            cand, exact = cand[keep], exact[keep]
        out.append((np.full(len(cand), i), cand, exact))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def search(spark: SparkSession, vectors: DataFrame, queries: Column | DataFrame, k: int = 5, books: int = BOOKS, train: int = TRAIN, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of `vectors` by cosine for each query.

    queries: a condition on `vectors`, whose rows are then the queries and no candidates of their own; or a table of
    other vectors, for which all of `vectors` are candidates.
    """
    if isinstance(queries, DataFrame):
        rows, dims = tagged(spark, vectors, "additive-rows")
        asked, _ = tagged(spark, queries, "additive-asked")
        asked = asked.withColumn("uid", -1 - F.col("uid"))
    else:
        rows, dims = tagged(spark, vectors, "additive-rows", F.coalesce(queries, F.lit(False)).alias("asked"))
        asked = rows.where("asked")
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    of = lambda df, d: df.where(F.col("dim") == d).select("vec_id", "embedding", "uid")
    kinds = (precision(vectors), precision(asked))
    return reduce(DataFrame.unionByName, (_search(spark, of(rows, d), of(asked, d), d, kinds, k, books, train, block, seed) for d in dims), none)


def _search(spark, rows, asked, dim, kinds, k, books, train, block, seed) -> DataFrame:
    """search() of usable rows of one dimension."""
    n = rows.count()
    learnt = sample(rows.select("vec_id", "embedding"), train, seed, n)
    model = fit(unit(matrix(learnt["embedding"])).astype(np.float32), books, seed=seed)
    n_blocks = max(1, -(-n // block))
    n_query_blocks = max(1, -(-asked.count() // QUERIES))
    kind, asked_kind = kinds

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        """A block of rows in one: distinct vectors, the k + 1 rows of smallest ids of each, codes and norms."""
        pdf = pdf.sort_values(["vec_id", "uid"], ignore_index=True)
        raw = matrix(pdf["embedding"], kind)
        _, first, inverse = np.unique(np.ascontiguousarray(raw).view(f"V{raw.shape[1] * raw.itemsize}").ravel(), return_index=True, return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        rank = np.arange(len(order)) - np.r_[0, np.cumsum(np.bincount(inverse))][inverse[order]]
        few = order[rank <= k]
        x = unit(raw[first])
        codes = beam_encode(x.astype(np.float32), model)
        coded = decode(codes, model)
        norms = np.stack([np.sqrt(((x - coded) ** 2).sum(1)), np.maximum(np.sqrt((coded * coded).sum(1)), 1e-6)]).astype(np.float32)
        cells = [raw[first], codes, norms, pdf["vec_id"].to_numpy(np.int64)[few], inverse[few].astype(np.int64), pdf["uid"].to_numpy(np.int64)[few]]
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], **{f"c{i}": [c.tobytes()] for i, c in enumerate(cells)}})

    base = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "uid"), F.lit(n_blocks)))
    packed = written(spark, base.groupBy("block").applyInPandas(pack, "block long, c0 binary, c1 binary, c2 binary, c3 binary, c4 binary, c5 binary"), "additive-blocks")

    def pack_queries(pdf: pd.DataFrame) -> pd.DataFrame:
        cells = [matrix(pdf["embedding"], asked_kind), pdf["vec_id"].to_numpy(np.int64), pdf["uid"].to_numpy(np.int64)]
        return pd.DataFrame({"qb": [pdf["qb"].iloc[0]], **{c: [x.tobytes()] for c, x in zip(("q", "qid", "quid"), cells, strict=True)}})

    query_blocks = asked.withColumn("qb", F.pmod(F.xxhash64(F.lit(seed + 2), "uid"), F.lit(n_query_blocks))).groupBy("qb").applyInPandas(pack_queries, "qb long, q binary, qid binary, quid binary")
    meetings = packed.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1)).cast("array<long>"))).join(query_blocks, "qb")

    def meet(frames):
        for pdf in frames:
            for r in pdf.itertuples():
                q, qid, quid = unit(np.frombuffer(r.q, asked_kind).reshape(-1, dim)), np.frombuffer(r.qid, np.int64), np.frombuffer(r.quid, np.int64)
                x = unit(np.frombuffer(r.c0, kind).reshape(-1, dim))
                ids, of, uid = (np.frombuffer(c, np.int64) for c in (r.c3, r.c4, r.c5))
                starts = np.searchsorted(of, np.arange(len(x) + 1))
                missed, norm = np.frombuffer(r.c2, np.float32).reshape(2, -1)
                row = {"x": x, "codes": np.frombuffer(r.c1, np.uint8).reshape(len(x), -1), "missed": missed, "norm": norm}
                qi, at, score = _near(q, row, k + 1, model)
                sizes = starts[at + 1] - starts[at]
                pick = np.repeat(starts[at] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
                out = pd.DataFrame({"query": np.repeat(quid[qi], sizes), "query_id": np.repeat(qid[qi], sizes), "vec_id": ids[pick], "uid": uid[pick], "score": np.repeat(score, sizes)})
                out = out[out["query"] != out["uid"]].sort_values(["query", "score", "vec_id", "uid"], ascending=[True, False, True, True])
                yield out.groupby("query").head(k)

    parts = partitions(spark, n_blocks * n_query_blocks, 1)
    found = meetings.repartition(parts, "qb", "block").mapInPandas(lean(meet), "query long, query_id long, vec_id long, uid long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
