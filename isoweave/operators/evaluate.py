"""Comparison of labels, abundances and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import numbered, staged


def contingency(pairs: DataFrame) -> DataFrame:
    """(l, r, n) of rows (l, r)."""
    return pairs.groupBy("l", "r").agg(F.count("*").alias("n"))


def _marginals(pairs: DataFrame) -> DataFrame:
    """One row: cells, row sums, column sums as arrays, and the total. As large as the numbers of labels."""
    t = contingency(pairs)
    rows = t.groupBy("l").agg(F.sum("n").alias("n")).agg(F.collect_list("n").alias("rows"))
    columns = t.groupBy("r").agg(F.sum("n").alias("n")).agg(F.collect_list("n").alias("columns"))
    sums = t.withColumn("nl", F.sum("n").over(Window.partitionBy("l"))).withColumn("nr", F.sum("n").over(Window.partitionBy("r")))
    cells = sums.agg(F.collect_list(F.struct("n", "nl", "nr")).alias("cells"), F.sum("n").alias("total"))
    return cells.crossJoin(rows).crossJoin(columns)


def adjusted_rand(pairs: DataFrame) -> DataFrame:
    """One row: ari; 1 where the denominator is 0."""
    two = lambda x: x * (x - 1) / 2
    add = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + two(x))
    m = _marginals(pairs).select(F.aggregate("cells", F.lit(0.0), lambda s, x: s + two(x.n)).alias("o"), add("rows").alias("a"), add("columns").alias("b"), two(F.col("total")).alias("t"))
    m = m.withColumn("e", F.when(F.col("t") > 0, F.col("a") * F.col("b") / F.col("t")).otherwise(0.0)).withColumn("d", (F.col("a") + F.col("b")) / 2 - F.col("e"))
    return m.select(F.when(F.col("d") != 0, (F.col("o") - F.col("e")) / F.col("d")).otherwise(1.0).alias("ari"))


def normalized_mutual_info(pairs: DataFrame) -> DataFrame:
    """One row: nmi with the arithmetic mean of the entropies; 1 where both are 0."""
    m = _marginals(pairs).withColumn("t", F.col("total").cast("double"))
    mutual = F.aggregate("cells", F.lit(0.0), lambda s, x: s + x.n / F.col("t") * F.log(x.n * F.col("t") / (x.nl * x.nr)))
    entropy = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s - x / F.col("t") * F.log(x / F.col("t")))
    mean = (entropy("rows") + entropy("columns")) / 2
    return m.select(F.when(mean != 0, mutual / mean).otherwise(1.0).alias("nmi"))


def average_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Ranks from 1 with ties averaged: places in the sorted order, averaged over equal values; nulls come first and are equal."""
    placed = numbered(df.select(F.col(value).alias("_v")), "_place", "_v")
    ties = placed.groupBy("_v").agg(((F.min("_place") + F.max("_place")) / 2).alias(out))
    return df.join(ties, F.col(value).eqNullSafe(F.col("_v"))).drop("_v")


def abundance_metrics(both: DataFrame) -> DataFrame:
    """One row of metrics of (id, truth, estimate): MAE, RMSE, Pearson, Spearman, Jensen-Shannon distance, total variation.

    A constant vector has no correlation (NaN).
    """
    total = F.broadcast(both.agg(F.sum("truth").alias("t_all"), F.sum("estimate").alias("e_all")))  # one row
    shares = both.crossJoin(total).withColumn("p", F.col("truth") / F.col("t_all")).withColumn("q", F.col("estimate") / F.col("e_all"))
    x = average_rank(average_rank(shares, "truth", "rt"), "estimate", "re").withColumn("m", (F.col("p") + F.col("q")) / 2)
    kl = lambda c: F.sum(F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / F.col("m"))).otherwise(0.0))
    d = F.col("estimate") - F.col("truth")
    return x.agg(
        F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(d * d)).alias("rmse"), F.corr("truth", "estimate").alias("pearson"), F.corr("rt", "re").alias("spearman"),
        F.sqrt(F.greatest((kl("p") + kl("q")) / 2, F.lit(0.0))).alias("js_distance"), (F.sum(F.abs(F.col("p") - F.col("q"))) / 2).alias("total_variation"),
    )


def library_normalise(counts: DataFrame) -> DataFrame:
    """log1p(count * 1e4 / cell total); zero cells stay zero."""
    total = F.sum("count").over(Window.partitionBy("cell"))
    return counts.withColumn("value", F.when(total > 0, F.log1p(F.col("count") * 1e4 / total)).otherwise(0.0))


#: Numbers in a tile of points, at most; sums that a task holds, at most; tiles in a partition, and partitions, or thereabouts.
TILE, HELD, TILES, PARTS = 1 << 19, 1 << 22, 8, 12


def silhouette(points: DataFrame, block: int = 1024) -> DataFrame:
    """(id, label, s) by Euclidean distance of (id, x array<double>, label): exact, so all pairs are measured, tile against tile, and summed per label as they are made.

    Tiles have at least `block` points where these fit TILE.  Partitions of tiles meet without a shuffle of pairs, a pair of
    tiles once for both sides, and a task adds up sums before it passes them on, so what is shuffled and written grows with
    the points and the partitions, of TILES tiles each, not with the pairs.  A label's only point has 0.
    """
    import numpy as np
    import pyarrow as pa

    count, width = points.agg(F.count("*"), F.max(F.size("x"))).first()
    rows = max(1, min(max(block, -(-count // 16)), TILE // max(width or 1, 1)))
    n = max(1, -(-count // rows))
    tagged = points.select("id", "x", F.col("label").cast("string").alias("label"), F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("part"))
    packed = staged(tagged.groupBy("part").agg(F.collect_list(F.struct("id", "x", "label")).alias("rows")), "silhouette").repartitionByRange(min(n, max(PARTS, -(-n // TILES))), "part")
    left, right = (packed.select(F.col("part").alias(f"part_{k}"), F.col("rows").alias(f"rows_{k}")) for k in "ab")
    meet = left.join(right.hint("shuffle_replicate_nl"), F.col("part_a") <= F.col("part_b"))

    class Tile:
        """Points of a tile, and the sums of their distances to each label's points met so far, and how many these were."""

        def __init__(self, rows, names):
            self.ids, x, self.labels = rows.flatten()
            if len(set(np.diff(x.offsets).tolist())) > 1 or x.null_count:
                raise ValueError("points differ in length")
            self.x = np.ascontiguousarray(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1))
            self.xx = (self.x * self.x).sum(1)
            codes = self.labels.dictionary_encode(null_encoding="encode")
            self.own = np.array([names.setdefault(v, len(names)) for v in codes.dictionary.to_pylist()])
            self.sides = (codes.indices.to_numpy()[:, None] == np.arange(len(self.own))).astype(float)
            self.sums, self.met = np.zeros((len(x), 0)), np.zeros(0)

        def add(self, other, sums, some=slice(None)):
            if (more := int(other.own.max()) + 1 - self.sums.shape[1]) > 0:
                self.sums = np.hstack([self.sums, np.zeros((len(self.x), more))])
            self.sums[some, other.own] += sums

        def count(self, other):
            self.met = np.concatenate([self.met, np.zeros(self.sums.shape[1] - len(self.met))])
            self.met[other.own] += other.sides.sum(0)

    def distances(a, b):
        whole = np.zeros((len(b.x), len(a.own)))
        for k in range(0, len(a.x), 64):
            some = slice(k, k + 64)
            # squares by products; where these cancel, and where they are not finite, by differences
            size = a.xx[some, None] + b.xx
            square = a.x[some] @ b.x.T
            square *= -2
            square += size
            size *= 1e-4
            good = square > size
            if not good.all():
                i, j = np.nonzero(~good)
                square[i, j] = ((a.x[k + i] - b.x[j]) ** 2).sum(1)
            np.sqrt(square, out=square)
            yield some, square @ b.sides
            if a is not b:
                whole += square.T @ a.sides[some]
        if a is not b:
            yield None, whole

    def measure(batches):
        names, tiles = {}, {}

        def settled():
            known = pa.array(list(names), pa.string())
            for t in tiles.values():
                seen = np.flatnonzero(t.met)
                each, rows = len(seen), len(t.x)
                of = pa.array(np.repeat(np.arange(rows), each))
                yield pa.RecordBatch.from_arrays([t.ids.take(of), t.labels.take(of), known.take(pa.array(np.tile(seen, rows))), pa.array(t.sums[:, seen].ravel()), pa.array(np.tile(t.met[seen], rows).astype(np.int64))], names=["id", "label", "label2", "d", "n"])
            tiles.clear()

        for batch in batches:
            for r in range(batch.num_rows):
                for s in "ab":
                    if (k := batch.column(f"part_{s}")[r].as_py()) not in tiles:
                        tiles[k] = Tile(batch.column(f"rows_{s}")[r].values, names)
                a, b = (tiles[batch.column(f"part_{s}")[r].as_py()] for s in "ab")
                for some, sums in distances(a, b):
                    a.add(b, sums, some) if some is not None else b.add(a, sums)
                a.count(b)
                if a is not b:
                    b.count(a)
                if sum(t.sums.size for t in tiles.values()) > HELD:
                    yield from settled()
        yield from settled()

    kind = points.schema["id"].dataType.simpleString()
    parts = meet.select("part_a", "rows_a", "part_b", "rows_b").mapInArrow(measure, f"id {kind}, label string, label2 string, d double, n long")
    sums = parts.groupBy("id", "label", "label2").agg(F.sum("d").alias("d"), F.sum("n").alias("n"))
    own = F.max(F.when((F.col("label") == F.col("label2")) & (F.col("n") > 1), F.col("d") / (F.col("n") - 1)))
    rest = F.min(F.when(F.col("label") != F.col("label2"), F.col("d") / F.col("n")))
    s = sums.groupBy("id", "label").agg(own.alias("w"), rest.alias("o"))
    top = F.greatest("w", "o")
    label = F.col("label").cast(points.schema["label"].dataType).alias("label")
    return s.select("id", label, F.when(F.col("w").isNull() | (top == 0), 0.0).otherwise((F.col("o") - F.col("w")) / top).alias("s"))


def truncated_svd(rows: DataFrame, k: int = 20) -> DataFrame:
    """(component, value): singular values of the uncentred matrix of (id, x array<double>)."""
    from . import embed

    packed, features = embed.dense_rows(rows)
    values, _ = embed.right_vectors(packed, features, k)
    return rows.sparkSession.createDataFrame([(i + 1, float(v)) for i, v in enumerate(values)], "component int, value double")


def kmeans(points: DataFrame, k: int = 10, seed: int = 0) -> DataFrame:
    """(id, cluster) by embed.kmeans; k is cut to the number of distinct points."""
    from . import embed

    return embed.kmeans(points, min(k, points.select("x").distinct().limit(k).count()), seed)


def lpt_batches(counts: list[tuple[str, int]], batches: int, most: int) -> list[list[str]]:
    """Longest processing time first onto the least loaded batch with room (ties: fewer cells, then first); a driver's plan over per-cell counts."""
    load, held = [0] * batches, [[] for _ in range(batches)]
    for cell, n in sorted(counts, key=lambda x: (-x[1], x[0])):
        k = min((i for i in range(batches) if len(held[i]) < most), key=lambda i: (load[i], len(held[i]), i))
        held[k].append(cell)
        load[k] += n
    return held
