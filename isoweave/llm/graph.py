"""Operator 4: embedding near-dedup on a robust-pruned flat graph.

1.  Balls.  Vectors whose angle to a common centre is at most half the angle of
    the threshold are all linked to each other, by the triangle inequality.  Every
    batch of rows is cut into such balls, so thousands of copies or near copies
    become one node; a lone vector is a ball of radius 0.
2.  Shards.  Every node goes to its OVERLAP nearest centroids (k-means on a bounded
    sample).  A shard builds a graph by robust pruning of nearest candidates.
3.  The shards' adjacency lists are united; every shard then searches the united
    graph of its nodes from its medoid, greedily, and goes on through all nodes in
    range once it has come into range.
4.  Recall is audited against brute force on a bounded sample of nodes; below
    `recall` the overlap is doubled and steps 2 and 3 run again; after three rounds
    below it, blocks of nodes are compared exactly.
5.  Found pairs of balls are verified in double precision.  Radii tell whether all
    or no members are linked; else members are compared, in blocks, and only
    counts come out.

Vectors that are null, zero or hold null or non-finite components link with
nothing; vectors of different dimensions are compared among themselves.  Repeated
vec_ids are separate vectors that share an id, each with a row of its own; a null
vec_id is linked to nothing.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, min_label_components, partitions, written
from .vectors import kmeans, matrix, sample, tagged, unit

#: Nodes of a shard, shards per node, neighbours per node, sampled rows for centroids, audited nodes.
SHARD, OVERLAP, DEGREE, TRAIN, AUDIT = 2048, 3, 24, 20_000, 128
_SAFE = 1e-6


def balls(x: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ball of every row, centres, radii): each row goes to the first leader within `half`, leaders in order of rows."""
    n = len(x)
    of = np.full(n, -1)
    centres, radii = [], []
    near = math.cos(half)
    for lo in range(0, n, 1024):
        if centres:  # leaders so far
            c = np.array(centres)
            part = x[lo : lo + 1024] @ c.T
            best = part.argmax(1)
            hit = part[np.arange(len(best)), best] >= near
            of[lo : lo + 1024][hit] = best[hit]
        own = np.flatnonzero(of[lo : lo + 1024] < 0) + lo
        if not len(own):
            continue
        close = x[own] @ x[own].T >= near
        free = np.ones(len(own), bool)
        for i in range(len(own)):
            if free[i]:
                mine = close[i] & free
                of[own[mine]] = len(centres)
                free &= ~mine
                centres.append(x[own[i]])
    c = np.array(centres)
    total = np.zeros_like(c)
    np.add.at(total, of, x)
    count = np.bincount(of, minlength=len(c))
    moved = np.where((count > 1)[:, None], total / np.maximum(np.sqrt((total * total).sum(1)), 1e-300)[:, None], c)
    angle = np.arccos(np.clip((x * moved[of]).sum(1), -1, 1))
    wide = np.zeros(len(c))
    np.maximum.at(wide, of, angle)
    stay = wide > half  # the mean may be worse: the leader itself then stays the centre
    moved[stay] = c[stay]
    angle = np.arccos(np.clip((x * moved[of]).sum(1), -1, 1))
    radii = np.zeros(len(c))
    np.maximum.at(radii, of, np.where(count[of] > 1, angle, 0))
    return of, moved, radii


def robust_prune(x: np.ndarray, degree: int = DEGREE, alpha: float = 1.2, pool: int = 64) -> np.ndarray:
    """Adjacency (n, degree; -1 where short): of each node's nearest `pool`, a candidate stays unless a kept one is alpha times nearer to it."""
    n = len(x)
    pool = min(pool, n - 1)
    out = np.full((n, degree), -1)
    if pool < 1:
        return out
    for lo in range(0, n, 512):
        s = x[lo : lo + 512] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -9
        cand = np.argpartition(-s, pool - 1, axis=1)[:, :pool]
        order = np.argsort(-np.take_along_axis(s, cand, 1), axis=1, kind="stable")
        cand = np.take_along_axis(cand, order, 1)
        own = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(s, cand, 1), 0))
        alive = np.ones(cand.shape, bool)
        rows = np.arange(len(cand))
        for k in range(degree):
            first = alive.argmax(1)
            some = alive[rows, first]
            if not some.any():
                break
            pick = cand[rows, first]
            out[lo + rows[some], k] = pick[some]
            apart = np.sqrt(np.maximum(2 - 2 * np.einsum("rpd,rd->rp", x[cand], x[pick]), 0))
            alive &= ~((alpha * apart <= own) & some[:, None])
            alive[rows, first] = False
    return out


def range_search(x: np.ndarray, adjacency: list[np.ndarray], reach: np.ndarray, beam: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) with cosine >= reach[query], queries being the nodes: greedy from the medoid, then on through all nodes in range."""
    n = len(x)
    width = max((len(a) for a in adjacency), default=0)
    table = np.full((n, max(width, 1)), -1)
    for i, a in enumerate(adjacency):
        table[i, : len(a)] = a
    medoid = int((x @ x.mean(0)).argmax())
    us, vs = [], []
    for lo in range(0, n, 256):
        q = x[lo : lo + 256]
        m = len(q)
        score = np.full((m, n), -9.0, np.float32)  # of the nodes met
        opened = np.zeros((m, n), bool)
        score[:, medoid] = q @ x[medoid]
        live = np.arange(m)
        while True:  # every step opens a node of each live query, so this ends
            waiting = np.where(opened[live], -9.0, score[live])
            best = waiting.argmax(1)
            value = waiting[np.arange(len(live)), best]
            # a query ends when its best unopened node is out of range and behind its best `beam` nodes
            met = score[live]
            bar = -np.partition(-met, min(beam, n) - 1, axis=1)[:, min(beam, n) - 1]
            go = (value > -9) & ((value >= reach[lo + live]) | (value >= bar))
            live, best = live[go], best[go]
            if not len(live):
                break
            opened[live, best] = True
            nb = table[best]
            r, c = np.nonzero(nb >= 0)
            rows, cols = live[r], nb[r, c]
            new = score[rows, cols] <= -9
            rows, cols = rows[new], cols[new]
            score[rows, cols] = np.einsum("rd,rd->r", q[rows], x[cols])
        u, v = np.nonzero(score >= reach[lo : lo + m, None])
        us.append(u + lo)
        vs.append(v)
    return np.concatenate(us), np.concatenate(vs)


def _bytes(x: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in np.ascontiguousarray(x, np.float64)]


def _vectors(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def near_duplicates(spark: SparkSession, vectors: DataFrame, cosine: float = 0.95, recall: float = 0.95, shard: int = SHARD, overlap: int = OVERLAP) -> DataFrame:
    """(vec_id, n_links, component_id), one row per row of `vectors`."""
    rows, dims = tagged(spark, vectors, "graph-rows")
    none = rows.where("dim = 0").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return reduce(DataFrame.unionByName, (_linked_rows(spark, rows.where(F.col("dim") == d), cosine, recall, shard, overlap) for d in dims), none)


def _linked_rows(spark: SparkSession, rows: DataFrame, cosine: float, recall: float, shard: int, overlap: int) -> DataFrame:
    """near_duplicates() of usable rows of one dimension."""
    theta = math.acos(cosine)
    half = theta / 2 - _SAFE

    def cut(frames):
        for k, pdf in enumerate(frames):
            if not len(pdf):
                continue
            x = unit(matrix(pdf["embedding"]))
            of, centre, radius = balls(x, half)
            ids = pdf["vec_id"].to_numpy(np.int64)
            low = np.full(len(centre), np.iinfo(np.int64).max)
            np.minimum.at(low, of, ids)
            # a ball is named by its smallest row: id and place, so that repeated ids stay apart
            uid = pdf["uid"].to_numpy(np.int64)
            name = np.full(len(centre), np.iinfo(np.int64).max)
            np.minimum.at(name, of, uid)
            size = np.bincount(of, minlength=len(centre))
            raw = _bytes(x)
            c = _bytes(centre)
            yield pd.DataFrame({"ball": name[of], "uid": uid, "vec_id": ids, "size": size[of], "radius": radius[of], "low": low[of], "centre": [c[b] if u == name[b] else None for b, u in zip(of, uid, strict=True)], "x": [r if size[b] > 1 else None for r, b in zip(raw, of, strict=True)]})

    members = rows.select("vec_id", "embedding", "uid").mapInPandas(lean(cut), "ball long, uid long, vec_id long, size long, radius double, low long, centre binary, x binary")
    members = written(spark, members, "graph-members")
    nodes = members.where("centre IS NOT NULL").select("ball", "size", "radius", "low", "centre")
    n = nodes.count()
    widest = nodes.agg(F.max("radius")).first()[0] or 0.0
    for _ in range(3):
        pairs, found = _pairs(spark, rows, nodes, n, theta, widest, shard, overlap)
        if found >= recall:
            break
        overlap *= 2
    else:
        pairs = _exact(spark, nodes, n, theta)
    return _linked(spark, members, nodes, pairs, cosine)


def _exact(spark, nodes, n, theta, block: int = 2048):
    """(a, b, dot, angle) as of _pairs, of all pairs of nodes: blocks meet blocks."""
    k = max(1, -(-n // block))
    packed = nodes.withColumn("part", F.pmod(F.xxhash64("ball"), F.lit(k))).groupBy("part").agg(F.collect_list(F.struct("ball", "radius", "centre")).alias("rows"))
    packed = written(spark, packed, "graph-blocks")
    left = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).where("part <= other").select("part", "other", F.col("rows").alias("rows_a"))
    meet = left.join(packed.select(F.col("part").alias("other"), F.col("rows").alias("rows_b")), "other")
    meet = meet.repartition(partitions(spark, k * (k + 1) / 2, 4), "part", "other")

    def compare(frames):
        for pdf in frames:
            for r in pdf.itertuples():
                (x, p, a), (y, q, b) = ((np.frombuffer(b"".join(m["centre"] for m in rows), np.float64).reshape(len(rows), -1), np.array([m["radius"] for m in rows]), np.array([m["ball"] for m in rows], np.int64)) for rows in (r.rows_a, r.rows_b))
                for lo in range(0, len(a), 512):
                    dot = x[lo : lo + 512] @ y.T
                    angle = np.arccos(np.clip(dot, -1, 1))
                    i, j = np.nonzero(angle <= theta + p[lo : lo + 512, None] + q[None, :] + _SAFE)
                    u, v = a[lo + i], b[j]
                    keep = u < v if r.part == r.other else u != v
                    yield pd.DataFrame({"a": np.minimum(u, v)[keep], "b": np.maximum(u, v)[keep], "dot": dot[i, j][keep], "angle": angle[i, j][keep]})

    return written(spark, meet.mapInPandas(lean(compare), "a long, b long, dot double, angle double"), "graph-pairs")


def _pairs(spark, rows, nodes, n, theta, widest, shard, overlap):
    """(a, b, dot, angle) of the pairs of balls whose members may be linked, a < b, and the audited recall."""
    k = max(1, -(-n * overlap // shard)) if n > shard else 1
    learnt = sample(rows.select("vec_id", "embedding"), TRAIN, 3)
    centroids = kmeans(unit(matrix(learnt["embedding"])).astype(np.float32), min(k, len(learnt)))
    take = min(overlap, len(centroids))

    def deal(frames):
        for pdf in frames:
            x = _vectors(pdf["centre"]).astype(np.float32)
            d = (centroids * centroids).sum(1) - 2 * x @ centroids.T
            near = np.argpartition(d, take - 1, axis=1)[:, :take]
            at = np.repeat(np.arange(len(pdf)), take)
            yield pd.DataFrame({"shard": near.ravel(), "ball": pdf["ball"].to_numpy()[at], "radius": pdf["radius"].to_numpy()[at], "centre": pdf["centre"].to_numpy()[at]})

    dealt = nodes.select("ball", "radius", "centre").mapInPandas(lean(deal), "shard long, ball long, radius double, centre binary")
    dealt = written(spark, dealt.repartition(partitions(spark, len(centroids), 2), "shard"), "graph-shards")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ball", ignore_index=True)
        names = pdf["ball"].to_numpy()
        adjacent = robust_prune(_vectors(pdf["centre"]).astype(np.float32))
        return pd.DataFrame({"ball": names, "to": [names[a[a >= 0]] for a in adjacent]})

    lists = dealt.groupBy("shard").applyInPandas(build, "ball long, to array<long>")
    # the united adjacency, both ways; a node has at most DEGREE out-edges from each of its shards
    united = lists.groupBy("ball").agg(F.array_distinct(F.flatten(F.collect_list("to"))).alias("to"))
    graph = written(spark, dealt.join(united, "ball"), "graph-united")

    def look(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ball", ignore_index=True)
        names, x = pdf["ball"].to_numpy(), _vectors(pdf["centre"])
        place = {b: i for i, b in enumerate(names.tolist())}
        adjacent: list[set] = [set() for _ in names]
        for i, to in enumerate(pdf["to"]):
            for b in to:
                if (j := place.get(int(b))) is not None:
                    adjacent[i].add(j)
                    adjacent[j].add(i)
        reach = np.cos(np.minimum(theta + pdf["radius"].to_numpy() + min(widest, pdf["radius"].max()) + _SAFE, math.pi))
        u, v = range_search(x.astype(np.float32), [np.array(sorted(a), np.int64) for a in adjacent], (reach - 1e-5).astype(np.float32))
        u, v = np.minimum(u, v), np.maximum(u, v)
        keep = u != v
        u, v = u[keep], v[keep]
        dot = (x[u] * x[v]).sum(1)
        angle = np.arccos(np.clip(dot, -1, 1))
        r = pdf["radius"].to_numpy()
        keep = angle <= theta + r[u] + r[v] + _SAFE
        return pd.DataFrame({"a": names[u[keep]], "b": names[v[keep]], "dot": dot[keep], "angle": angle[keep]})

    pairs = graph.groupBy("shard").applyInPandas(look, "a long, b long, dot double, angle double").dropDuplicates(["a", "b"])
    pairs = written(spark, pairs, "graph-pairs")

    # audit: sampled nodes against all nodes, in blocks; half of them from all nodes, half from those with a pair
    def some(among: DataFrame, of: int) -> DataFrame:
        part = min(1.0, 0.45 * AUDIT / max(of, 1))
        return among.where(F.pmod(F.xxhash64(F.lit(5), "ball"), F.lit(1 << 30)) < int(part * (1 << 30))).select("ball").limit(AUDIT // 2)

    paired = pairs.select(F.col("a").alias("ball")).union(pairs.select("b")).distinct()
    chosen = some(nodes, n).union(some(paired, paired.count())).distinct()
    asked = nodes.join(chosen, "ball", "left_semi").select("ball", "radius", "centre").toPandas()
    if not len(asked):
        return pairs, 1.0
    q, names, radius = _vectors(asked["centre"]), asked["ball"].to_numpy(), asked["radius"].to_numpy()

    def brute(frames):
        for pdf in frames:
            s = np.arccos(np.clip(q @ _vectors(pdf["centre"]).T, -1, 1))
            i, j = np.nonzero(s <= theta + radius[:, None] + pdf["radius"].to_numpy()[None, :])
            a, b = names[i], pdf["ball"].to_numpy()[j]
            keep = a != b
            yield pd.DataFrame({"a": np.minimum(a, b)[keep], "b": np.maximum(a, b)[keep]})

    truth = nodes.select("ball", "radius", "centre").mapInPandas(lean(brute), "a long, b long").distinct()
    got = truth.join(pairs.select("a", "b", F.lit(1).alias("hit")), ["a", "b"], "left").agg(F.count("*"), F.count("hit")).first()
    return pairs, got[1] / got[0] if got[0] else 1.0


def _linked(spark, members, nodes, pairs, cosine, block: int = 2048):
    """Counts and components from verified pairs."""
    theta = math.acos(cosine)
    named = pairs.join(nodes.select(F.col("ball").alias("a"), F.col("size").alias("size_a"), F.col("radius").alias("ra")), "a")
    named = named.join(nodes.select(F.col("ball").alias("b"), F.col("size").alias("size_b"), F.col("radius").alias("rb")), "b")
    whole = F.col("angle") + F.col("ra") + F.col("rb") <= theta - _SAFE
    lone = (F.col("size_a") == 1) & (F.col("size_b") == 1)
    named = named.withColumn("kind", F.when(lone & (F.col("dot") >= cosine), "all").when(~lone & whole, "all").when(lone, "none").otherwise("some"))
    every = named.where("kind = 'all'")
    bulk = every.select(F.col("a").alias("ball"), F.col("size_b").alias("n")).unionByName(every.select(F.col("b").alias("ball"), F.col("size_a").alias("n"))).groupBy("ball").agg(F.sum("n").alias("bulk"))

    # some members of the pair may be linked: members meet in blocks, counts come out
    some = named.where("kind = 'some'").select("a", "b")
    packed = members.withColumn("part", F.floor(F.pmod(F.xxhash64("uid"), F.lit(1 << 20)) * F.ceil(F.col("size") / block) / F.lit(1 << 20)))
    vector = F.coalesce("x", "centre")
    packed = packed.groupBy("ball", "part").agg(F.collect_list(F.struct("uid", vector.alias("x"))).alias("rows"))
    meet = some.join(packed.select(F.col("ball").alias("a"), F.col("rows").alias("rows_a")), "a").join(packed.select(F.col("ball").alias("b"), F.col("rows").alias("rows_b")), "b")

    def count(frames):
        for pdf in frames:
            for r in pdf.itertuples():
                x, y = (np.frombuffer(b"".join(m["x"] for m in rows), np.float64).reshape(len(rows), -1) for rows in (r.rows_a, r.rows_b))
                hit = x @ y.T >= cosine
                if hit.any():
                    ids_a, ids_b = ([m["uid"] for m in rows] for rows in (r.rows_a, r.rows_b))
                    n_a, n_b = hit.sum(1), hit.sum(0)
                    yield pd.DataFrame({"ball": [r.a] * len(ids_a) + [r.b] * len(ids_b), "uid": ids_a + ids_b, "n": np.r_[n_a, n_b], "a": r.a, "b": r.b})

    counted = written(spark, meet.mapInPandas(lean(count), "ball long, uid long, n long, a long, b long").where("n > 0"), "graph-counts")
    edges = every.select("a", "b").unionByName(counted.select("a", "b").distinct())
    comp = min_label_components(spark, edges, "graph-cc")
    roots = nodes.select("ball", "low", "size").join(comp, nodes.ball == comp.id, "left").select("ball", "low", F.coalesce("component", "ball").alias("root"))
    lowest = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    by_ball = roots.join(lowest, "root").join(bulk, "ball", "left").select("ball", "component_id", F.coalesce("bulk", F.lit(0)).alias("bulk"))
    single = counted.groupBy("uid").agg(F.sum("n").alias("single"))
    out = members.select("ball", "uid", "vec_id", "size").join(by_ball, "ball").join(single, "uid", "left")
    return written(spark, out.select("vec_id", (F.col("size") - 1 + F.col("bulk") + F.coalesce("single", F.lit(0))).cast("long").alias("n_links"), "component_id"), "graph-out")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
