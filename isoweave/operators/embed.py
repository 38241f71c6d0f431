"""Coordinates and clusters of cells: truncated SVD of sparse rows, k-means, and the evaluation that is made of them.

Cells may be many; features are as many as the catalog has transcripts.  What is as long
as the features (a few dozen vectors) is held on the driver, within BOUND; of what is as
long as the cells it holds one block, where that is within BLOCK, and else nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.text import require
from ..storage import numbered, staged
from . import evaluate

#: Numbers that the driver holds for a decomposition, and of one block as long as the cells, at most; vectors asked for besides those wanted; blocks of a basis, at most, before it is cut back; features in a block of a sum.
BOUND, BLOCK, EXTRA, BLOCKS, FEATURES = 150_000_000, 15_000_000, 8, 24, 1024


def sparse_rows(entries: DataFrame, cells: DataFrame | None = None) -> tuple[DataFrame, DataFrame, int]:
    """Rows (cell, idx, val) of entries (cell, feature, value), the index (feature, j), and the number of features.

    Features are numbered in their order; a cell's entries are held in one row (as many as it has features at most).
    Cells without entries have empty rows.  A value that is not finite, or a pair that comes twice, raises.
    """
    entries = require(entries.where("value <> 0 OR value IS NULL OR isnan(value)"), (F.col("value") > float("-inf")) & (F.col("value") < float("inf")), "value is not finite:", "cell", "feature")
    index = staged(numbered(entries.select("feature").distinct(), "j", "feature").select("feature", (F.col("j") - 1).cast("int").alias("j")), "features")
    packed = entries.join(index, "feature").groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("j", F.col("value").cast("double").alias("v")))).alias("e"))
    packed = packed.select("cell", F.col("e.j").alias("idx"), F.col("e.v").alias("val"))
    packed = require(packed, F.size("idx") == F.size(F.array_distinct("idx")), "entry comes twice in cell", "cell")
    if cells is not None:
        packed = cells.select("cell").distinct().join(packed, "cell", "left").select("cell", F.coalesce("idx", F.array().cast("array<int>")).alias("idx"), F.coalesce("val", F.array().cast("array<double>")).alias("val"))
    return staged(packed, "rows"), index, index.count()


def dense_rows(points: DataFrame) -> tuple[DataFrame, int]:
    """Rows (cell, idx, val) of (id, x array<double>), and the length of the longest x."""
    rows = points.select(F.col("id").alias("cell"), F.transform("x", lambda _, k: k).cast("array<int>").alias("idx"), F.col("x").cast("array<double>").alias("val"))
    return rows, rows.agg(F.max(F.size("val"))).first()[0] or 0


def _parts(batch: pa.RecordBatch, most: int = 1 << 18):
    """(first row, rows, row of each entry, idx, val) of an Arrow batch, in pieces of about `most` entries."""
    idx, val = batch.column(batch.schema.get_field_index("idx")), batch.column(batch.schema.get_field_index("val"))
    ends = np.asarray(idx.offsets)
    i, v = idx.flatten().to_numpy(zero_copy_only=False), val.flatten().to_numpy(zero_copy_only=False)
    ends = ends - ends[0]
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + most, "right")) - 1)
        lo, hi = ends[a], ends[b]
        yield a, b - a, np.repeat(np.arange(b - a), np.diff(ends[a : b + 1])), i[lo:hi], v[lo:hi]
        a = b


def _times(row, n, idx, val, q) -> np.ndarray:
    """The rows' products with the columns of q."""
    out = np.zeros((n, q.shape[1]))
    if len(row):
        first = np.flatnonzero(np.diff(row, prepend=-1))
        out[row[first]] = np.add.reduceat(val[:, None] * q[idx], first)
    return out


def _gram_times(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """(transposed rows @ rows) @ q: one pass; a task sums what is as large as q, and q's blocks are summed apart."""
    d, p = q.shape
    shared = rows.sparkSession.sparkContext.broadcast(q)

    def run(batches):
        q, total = shared.value, None
        for batch in batches:
            for _, n, row, idx, val in _parts(batch):
                z = _times(row, n, idx, val, q)
                total = np.zeros((d, p)) if total is None else total
                for c in range(p):
                    total[:, c] += np.bincount(idx, val * z[row, c], d)
        if total is not None:
            for k in range(0, d, FEATURES):
                if total[k : k + FEATURES].any():
                    yield pa.RecordBatch.from_arrays([pa.array([k // FEATURES], pa.int32()), pa.array([total[k : k + FEATURES].tobytes()], pa.binary())], names=["block", "data"])

    def add(key, parts):
        return pd.DataFrame({"block": [key[0]], "data": [sum(np.frombuffer(x) for x in parts["data"]).tobytes()]})

    sums = rows.select("idx", "val").mapInArrow(run, "block int, data binary").groupBy("block").applyInPandas(add, "block int, data binary")
    out = np.zeros((d, p))
    for r in sums.toLocalIterator():  # as large as q
        out[r["block"] * FEATURES : (r["block"] + 1) * FEATURES] = np.frombuffer(bytes(r["data"])).reshape(-1, p)
    shared.destroy()
    return out


def _product(rows: DataFrame, q: np.ndarray, length: int) -> np.ndarray:
    """rows (i, idx, val) @ q: rows meet q where they are, and what is as long as they are comes back."""
    shared = rows.sparkSession.sparkContext.broadcast(q)

    def run(batches):
        for batch in batches:
            i = batch.column(0).to_numpy()
            for a, n, row, idx, val in _parts(batch):
                yield pa.RecordBatch.from_arrays([pa.array([i[a : a + n].tobytes()], pa.binary()), pa.array([_times(row, n, idx, val, shared.value).tobytes()], pa.binary())], names=["i", "z"])

    out = np.zeros((length, q.shape[1]))
    for r in rows.mapInArrow(run, "i binary, z binary").toLocalIterator() if out.size > BLOCK else rows.mapInArrow(run, "i binary, z binary").collect():  # as large as one block
        out[np.frombuffer(bytes(r["i"]), np.int64)] = np.frombuffer(bytes(r["z"])).reshape(-1, q.shape[1])
    shared.destroy()
    return out


def _gram(rows: DataFrame, features: int, p: int):
    """A function that gives (transposed rows @ rows) @ q for blocks q of up to p columns.

    Where a block as long as the rows is within BLOCK and no longer than some blocks of features, entries are held by rows and
    by features, and both products come back as they are: nothing is shuffled in a pass.  Else tasks sum up features.
    """
    n = rows.count()
    if not features or n * p > BLOCK or n > 4 * features:
        return lambda q: _gram_times(rows, q)
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    by_row = staged(numbered(rows.select("cell", "idx", "val"), "i", "cell").select((F.col("i") - 1).alias("i"), "idx", "val").repartition(tasks), "by-row")
    entry = by_row.select("i", F.explode(F.arrays_zip("idx", "val")).alias("e")).groupBy(F.col("e.idx").cast("long").alias("j")).agg(F.array_sort(F.collect_list(F.struct(F.col("i").cast("int").alias("i"), F.col("e.val").alias("v")))).alias("c"))
    by_feature = staged(entry.select(F.col("j").alias("i"), F.col("c.i").alias("idx"), F.col("c.v").alias("val")).repartition(tasks), "by-feature")
    return lambda q: _product(by_feature, _product(by_row, q, n), features)


def right_vectors(rows: DataFrame, features: int, k: int, seed: int = 0, tolerance: float = 1e-10, passes: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The k largest singular values of the rows (cell, idx, val) and their right vectors, as columns.

    Block Krylov iteration with full orthogonalisation: every pass multiplies one block by the Gram matrix, which is never
    made.  It ends when the residual of every wanted vector is below `tolerance` times the largest eigenvalue, or the
    basis is invariant.  Of a vector and its negative the one is taken whose largest entry (the first of them) is positive.
    """
    k = min(k, features)
    p = min(k + EXTRA, features)
    blocks = min(BLOCKS, BOUND // max(features * p, 1) - 3)  # a basis that is cut back earlier takes more passes and less room
    if blocks < 3:
        raise ValueError(f"{features} features and {k} components need more than the {BOUND} numbers that the driver may hold")
    if k < 1:
        return np.zeros(0), np.zeros((features, 0))
    times = _gram(rows, features, p)
    room = min((blocks + 1) * p, features)
    held = np.zeros((features, room), order="F")
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((features, p)))[0]
    held[:, :p] = block
    m, h = p, np.zeros((room, room))  # columns of the basis; its products with its images
    for _ in range(passes):
        basis, new = held[:, :m], block.shape[1]
        rest = times(block)
        for _ in range(2):
            part = basis.T @ rest
            h[:m, m - new : m] += part
            rest -= basis @ part
        h[m - new : m, : m - new] = h[: m - new, m - new : m].T
        value, y = np.linalg.eigh((h[:m, :m] + h[:m, :m].T) / 2)
        value, y = value[::-1][:p], y[:, ::-1][:, :p]
        # what the basis lacks of its images is in the newest block's image alone
        gap = np.linalg.norm(rest @ y[m - new :, :k], axis=0).max()
        if gap <= tolerance * max(value[0], 1e-300):
            break
        u, s, _ = np.linalg.svd(rest, full_matrices=False)
        block = u[:, s > 1e-13 * max(value[0], 1e-300)][:, : features - m]
        if not block.shape[1]:
            break
        if m + block.shape[1] > blocks * p:  # start anew from the best so far and the newest block
            held[:, : y.shape[1]] = basis @ y
            m = y.shape[1]
            h[:] = 0
            h[np.arange(m), np.arange(m)] = value
        block = np.linalg.qr(block - held[:, :m] @ (held[:, :m].T @ block))[0]
        held[:, m : m + block.shape[1]] = block
        m += block.shape[1]
    else:
        raise ArithmeticError(f"the decomposition has not settled in {passes} passes")
    vectors = held[:, :m] @ y[:, :k]
    lead = np.abs(vectors).argmax(0)
    return np.sqrt(np.clip(value[:k], 0, None)), vectors * np.where(vectors[lead, np.arange(k)] < 0, -1.0, 1.0)


def coordinates(rows: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(cell, x): every row's products with the vectors."""
    shared = rows.sparkSession.sparkContext.broadcast(vectors)
    kind = rows.schema["cell"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            x = np.zeros((batch.num_rows, shared.value.shape[1]))
            for a, n, row, idx, val in _parts(batch):
                x[a : a + n] = _times(row, n, idx, val, shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["cell", "x"])

    return rows.select("cell", "idx", "val").mapInArrow(run, f"cell {kind}, x array<double>")


def svd_embedding(entries: DataFrame, cells: DataFrame | None = None, components: int = 20, seed: int = 0) -> DataFrame:
    """(cell, x): coordinates of cells by the truncated SVD of entries (cell, feature, value), uncentred."""
    rows, _, features = sparse_rows(entries, cells)
    n = rows.count()
    _, vectors = right_vectors(rows, features, min(components, max(n - 1, 1), features), seed)
    return coordinates(rows, vectors)


def _gap(x: Column, centre: list[float]) -> Column:
    return F.aggregate(F.zip_with(x, F.array(*[F.lit(float(c)) for c in centre]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)


def kmeans(points: DataFrame, k: int, seed: int = 0, rounds: int = 10) -> DataFrame:
    """(id, cluster) of (id, x): seeded starts drawn by squared distance, then `rounds` rounds of nearest centres and means.

    Points are taken in the order of their ids, so draws don't depend on partitions: the first centre is drawn evenly, each
    later one where the running sum of squared distances to the centres so far passes a random share of their total.
    Of centres equally near the first counts; one that has lost all its points stays where it is.  Clusters are those
    of the last round's centres before it moved them.
    """
    points = staged(numbered(points.select("id", "x"), "place", "id").withColumn("part", F.floor((F.col("place") - 1) / 4096)), "points")
    n = points.count()
    if not 1 <= k <= n:
        raise ValueError(f"k must be from 1 to the {n} points")
    draw = np.random.RandomState(seed)
    centres: list[list[float]] = []
    for i in range(k):
        if i == 0:
            place = int(draw.randint(n)) + 1
        else:
            far = points.withColumn("d", F.array_min(F.array(*[_gap(F.col("x"), c) for c in centres])))
            sums = sorted(far.groupBy("part").agg(F.sum("d").alias("d")).collect())  # one number for 4,096 points
            total = sum(r["d"] for r in sums)
            if total <= 0:
                raise ValueError(f"k is {k}, but only {i} points differ")
            left, part = draw.uniform() * total, sums[-1]["part"]
            for r in sums:
                if left <= r["d"]:
                    part = r["part"]
                    break
                left -= r["d"]
            run = far.where(F.col("part") == part).withColumn("run", F.sum("d").over(Window.partitionBy("part").orderBy("place")))
            hit = run.where((F.col("run") >= left) & (F.col("d") > 0)).agg(F.min("place").alias("place"), F.lit(1)).first()["place"]
            place = hit if hit is not None else run.where("d > 0").agg(F.max("place")).first()[0]
        centres.append(list(points.where(F.col("place") == place).first()["x"]))
    dims = len(centres[0])
    for at in range(rounds):
        nearest = F.array_min(F.array(*[F.struct(_gap(F.col("x"), c).alias("d"), F.lit(j).alias("j")) for j, c in enumerate(centres)])).j
        found = points.withColumn("cluster", nearest)
        if at == rounds - 1:
            return found.select("id", "cluster")
        for r in found.groupBy("cluster").agg(*[F.avg(F.col("x")[j]).alias(f"m{j}") for j in range(dims)]).collect():
            centres[r["cluster"]] = [r[f"m{j}"] for j in range(dims)]
    raise ValueError("rounds must be at least 1")


@dataclass
class CellEvaluation:
    """Frames of an evaluation: embedding (cell, x), clusters (cell, cluster), and its figures (None where there are none)."""

    embedding: DataFrame
    clusters: DataFrame
    silhouette: float | None
    adjusted_rand: float | None
    normalized_mutual_info: float | None


def evaluate_cells(counts: DataFrame, cells: DataFrame, n_clusters: int, labels: DataFrame | None = None, n_components: int = 20, seed: int = 0) -> CellEvaluation:
    """Normalises counts (cell, feature, value), embeds and clusters all cells (cell), and compares with labels (cell, label).

    Cells without counts are rows of zeros.  Raises on repeated or unknown cells, values that are negative or not finite,
    labels that miss a cell, and more clusters than there are different rows.
    """
    twice = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1 OR cell IS NULL").first()
    if twice is not None:
        raise ValueError(f"barcodes must be unique: {twice['cell']}")
    n = cells.count()
    if n < 2 or not 1 <= n_clusters < n:
        raise ValueError("at least two cells are needed, and from 1 to their number - 1 clusters")
    if n_components < 1:
        raise ValueError("n_components must be positive")
    known = require(counts.join(cells.select("cell", F.lit(1).alias("_known")), "cell", "left"), F.col("_known").isNotNull(), "count of an unknown cell:", "cell").drop("_known")
    known = require(known, (F.col("value") >= 0) & (F.col("value") < float("inf")), "value is negative or not finite:", "cell", "feature")
    if known.limit(1).count() == 0:
        raise ValueError("evaluation requires at least one feature")
    normal = evaluate.library_normalise(known.withColumnRenamed("value", "count")).select("cell", "feature", "value")
    x = staged(svd_embedding(normal, cells, n_components, seed), "embedding")
    different = x.select(F.transform("x", lambda v: v + 0.0).alias("x")).distinct().limit(n_clusters).count()
    if n_clusters > different:
        raise ValueError(f"n_clusters={n_clusters} exceeds the {different} distinct embedded rows")
    clusters = staged(kmeans(x.withColumnRenamed("cell", "id"), n_clusters, seed).select(F.col("id").alias("cell"), "cluster"), "clusters")
    used = clusters.select("cluster").distinct().count()
    s = None
    if 1 < used < n:
        s = evaluate.silhouette(x.join(clusters, "cell").select(F.col("cell").alias("id"), "x", F.col("cluster").alias("label"))).agg(F.avg("s")).first()[0]
    ari = nmi = None
    if labels is not None:
        both = clusters.join(labels.select("cell", "label"), "cell", "left")
        missing = both.where("label IS NULL").count()
        if missing:
            raise ValueError(f"reference labels missing {missing} input barcodes")
        ari, nmi = agreement(both.select(F.col("label").cast("string").alias("l"), F.col("cluster").alias("r")))
    return CellEvaluation(x, clusters, s, ari, nmi)


def agreement(pairs: DataFrame) -> tuple[float, float]:
    """Adjusted Rand index and normalised mutual information of rows (l, r)."""
    pairs = staged(pairs, "pairs")
    return evaluate.adjusted_rand(pairs).first()["ari"], evaluate.normalized_mutual_info(pairs).first()["nmi"]


def compare_cell_matrices(counts: DataFrame, cells: DataFrame, other_counts: DataFrame, other_cells: DataFrame, n_clusters: int, n_components: int = 20, seed: int = 0) -> tuple[float, float]:
    """Agreement of the clusters of two runs over the same cells; features may differ, sets of cells may not."""
    from .runs import same_ids

    sets = same_ids(cells.select("cell"), other_cells.select("cell")).first()
    if not sets["equal"]:
        raise ValueError(f"both runs must have the same barcodes: {sets['missing']} missing, {sets['unexpected']} unexpected")
    a, b = (evaluate_cells(c, k, n_clusters, None, n_components, seed).clusters for c, k in ((counts, cells), (other_counts, other_cells)))
    return agreement(a.select("cell", F.col("cluster").alias("l")).join(b.select("cell", F.col("cluster").alias("r")), "cell").select("l", "r"))
