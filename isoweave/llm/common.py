"""What the operators share: the shared folder, written stage tables, components."""

from __future__ import annotations

import ctypes
import gc
import math
import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the one that the session names in spark.checkpoint.dir.  Only where that
    is unset on one machine (tests) a temporary folder is made and set.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="isoweave-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Writes a stage table to the shared folder and reads it again: cuts lineage, survives lost executors."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, df: DataFrame) -> None:
    """Deletes the files of a stage table that no later plan reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files = df.inputFiles()
    if files:
        path = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if path.toString().split("/")[-1].count("-") and shared_dir(spark).split(":")[-1].strip("/") in path.toString():
            path.getFileSystem(conf).delete(path, True)


def partitions(spark: SparkSession, n_items: float, each: float) -> int:
    """Shuffle partitions for n_items with at most about `each` in one, and no fewer than the session's setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "8")), math.ceil(n_items / each))


def free_name(columns: list[str], name: str) -> str:
    """`name`, with as many underscores before it as make it none of the columns, whose case does not count."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def picked(df: DataFrame, *names: str) -> DataFrame:
    """The columns of exactly these names; others may differ from them in case alone, or repeat."""
    plain = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    return plain.select(*[F.col(f"c{df.columns.index(n)}").alias(n) for n in names])


_caches: dict[str, dict] = {}


def own_cache(name: str) -> dict:
    """What a Python worker keeps for one operator between tasks; the caches of other operators go, so that they never add up."""
    for k in [k for k in _caches if k != name]:
        del _caches[k]
    return _caches.setdefault(name, {})


def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another C library: nothing to trim
        return None


def lean(run):
    """A worker's function that hands unused memory back to the system when its task ends.

    Spark keeps workers between tasks and stages, so what operators leave behind would add up.
    """

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            gc.enable()
            pa.default_memory_pool().release_unused()
            if libc := _libc():
                libc.malloc_trim(0)

    return whole


def freed(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def doc_batches(batches, budget: int = 4 << 20):
    """Re-slices Arrow batches so that one holds about `budget` bytes of text at most; a single longer text stays whole."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, int(n * budget / max(batch.nbytes, 1)))
        for k in range(0, n, step):
            yield batch.slice(k, step)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows (null: empty), without a copy where there is no null."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    n = len(column)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def min_label_components(spark: SparkSession, edges: DataFrame, name: str) -> DataFrame:
    """Connected components of `edges` (a, b long; a > b), as rows (id, component = smallest id reachable).

    Alternating large-star and small-star: every round rewrites the edges so that
    nodes point at ever smaller neighbours; log-many rounds whatever the shape.
    Each round's edges are written to the shared folder.  Hubs are no problem: a
    star round takes minima by partial aggregation and joins them back, and never
    gathers a node's neighbours in a row.  Self links are dropped.  A graph
    without edges gives no rows.
    """
    cur = written(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    stats = None
    while True:
        # large star: link every larger neighbour of a node to the smallest of the node's neighbours (itself included)
        both = cur.select("a", "b").unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: link every smaller-or-equal neighbour of a node to the smallest of them
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low2, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        nxt = written(spark, small, name)
        now = nxt.agg(F.count("*"), F.countDistinct("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        dropped(spark, cur)
        cur = nxt
        if now == stats or now[0] == 0:
            break
        stats = now
    return cur.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.col("m").alias("component")).unionByName(
        cur.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the given edges (each node to the smallest of its component), by repeated minima."""
    ids, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a) :]
    lab = np.arange(len(ids))
    while True:
        old = lab.copy()
        m = np.minimum(lab[x], lab[y])
        np.minimum.at(lab, x, m)
        np.minimum.at(lab, y, m)
        lab = lab[lab]
        if (lab == old).all():
            break
    keep = np.flatnonzero(lab != np.arange(len(ids)))
    return ids[keep], ids[lab[keep]]


def carried(frames, keys: list[str]):
    """Frames of whole groups (rows of equal keys) from a stream sorted by them; holds a group at a time, besides a frame."""
    rest: list[pd.DataFrame] = []
    for pdf in frames:
        if not len(pdf):
            continue
        same = np.ones(len(pdf), bool)  # as the frame's last row
        for k in keys:
            same &= (pdf[k] == pdf[k].iloc[-1]).to_numpy()
        first = int(same.argmax())
        goes_on = bool(rest) and all(rest[0][k].iloc[0] == pdf[k].iloc[0] for k in keys)
        if goes_on and first == 0:
            rest.append(pdf)
            continue
        body = pd.concat([*rest, pdf.iloc[:first]], ignore_index=True)
        if len(body):
            yield body
        rest = [pdf.iloc[first:]]
    if rest:
        yield pd.concat(rest, ignore_index=True)
