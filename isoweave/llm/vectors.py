"""What the vector operators share: reading vectors as matrices, and which of them take part."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written


def dimension() -> Column:
    """The length of a vector that is whole, finite and not zero and has an id; 0 for every other row."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fit = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0)
    return F.when(fit, F.size("embedding")).otherwise(0)


def tagged(spark: SparkSession, df: DataFrame, name: str, *more: Column) -> tuple[DataFrame, list[int]]:
    """(written rows vec_id, embedding, uid, dim, ...; the dimensions, commonest first): uid tells rows of one id apart, dim 0 takes no part."""
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.monotonically_increasing_id().alias("uid"), dimension().alias("dim"), *more)
    rows = written(spark, rows, name)
    found = rows.where("dim > 0").groupBy("dim").count().orderBy(F.desc("count"), "dim").collect()
    return rows, [r["dim"] for r in found]


def precision(df: DataFrame) -> type:
    """What holds the components without loss."""
    return np.float32 if "array<float>" in dict(df.dtypes)["embedding"] else np.float64


def matrix(column: pd.Series, dtype=np.float64) -> np.ndarray:
    """The rows of a column of equally long vectors."""
    return np.stack(column.to_numpy()).astype(dtype, copy=False) if len(column) else np.zeros((0, 0), dtype)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, safe for very large and very small components."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sample(df: DataFrame, most: int, seed: int, n: int | None = None) -> pd.DataFrame:
    """At most `most` rows, chosen by a hash of id and vector: the same whatever the partitioning, unless copies of a row outnumber `most`."""
    n = df.count() if n is None else n
    part = 1.0 if n <= most else 0.9 * most / n
    got = df.where(F.pmod(F.xxhash64(F.lit(seed), "vec_id", "embedding"), F.lit(1 << 30)) < int(part * (1 << 30))).limit(most).toPandas()
    return (got if len(got) else df.limit(most).toPandas()).sort_values("vec_id", ignore_index=True)


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Centroids by Lloyd's rounds from distinct random rows; an empty cluster takes the row that is worst off."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        d = (c * c).sum(1) - 2 * x @ c.T
        at = d.argmin(1)
        counts = np.bincount(at, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        full = counts > 0
        c[full] = total[full] / counts[full, None]
        if (~full).any():
            c[~full] = x[np.argsort(-(d[np.arange(len(x)), at] + (x * x).sum(1)))[: (~full).sum()]]
    return c
