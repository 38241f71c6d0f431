"""Registered queries of the seeded reservoir, of coordinates of cells and of their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import embed
from ..operators import inference as inf
from . import fixtures as fx
from .flagship import Run
from .oracles import sql

Q: dict = {}
O: dict = {}  # noqa: E741

#: The reservoir of the query; rows up to which its SQL knows the draws.
MOST, SEED, FAR = 50, 7, 2_000_000


def _hits() -> str:
    """(t, slot) of all draws that hit a slot, as SQL values: the generator's draws depend on t alone."""
    import numpy as np

    draw = np.random.default_rng(SEED).integers(np.arange(MOST + 1, FAR + 1))
    pairs = [(k + 1, k) for k in range(MOST)] + [(int(k) + MOST + 1, int(draw[k])) for k in np.flatnonzero(draw < MOST)]
    return ", ".join(f"({t}, {s})" for t, s in pairs)


def _reservoir(s, d):
    r = Run(s, d)
    return inf.reservoir(inf.training_distances(r.mols, r.tx), ["catalog", "cell", "umi"], MOST, SEED).select("slot", "gene_id", "cell", "umi", "d")


Q["reservoir_sample"] = _reservoir
O["reservoir_sample"] = sql(
    f"""SELECT CAST(slot AS INT) AS slot, gene_id, cell, umi, d FROM (SELECT slot, MAX(t) AS t FROM (VALUES {_hits()}) AS hits(t, slot) WHERE t <= (SELECT COUNT(*) FROM o_train) GROUP BY slot)
    JOIN (SELECT *, ROW_NUMBER() OVER (ORDER BY chrom, a, gene_id, cell, umi) AS t FROM o_train) USING (t)""",
    "o_train",
)


def _svd(s, d):
    """All coordinates of the vectors: lengths and angles are those of the vectors themselves."""
    v = s.read.parquet(f"{d}/embeddings.parquet")
    entries = v.select(F.col("vec_id").alias("cell"), F.posexplode("embedding").alias("feature", "value"))
    width = v.agg(F.max(F.size("embedding"))).first()[0]
    x = embed.svd_embedding(entries, v.select(F.col("vec_id").alias("cell")), width)
    one = x.orderBy("cell").limit(1).select(F.col("x").alias("y"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda t, z: t + z)
    return x.crossJoin(F.broadcast(one)).select(F.col("cell").alias("vec_id"), F.round(dot("x", "x"), 6).alias("length"), F.round(dot("x", "y"), 6).alias("angle"))


Q["svd_embedding"] = _svd
O["svd_embedding"] = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings)
    SELECT vec_id, round(list_dot_product(x, x), 6) AS length, round(list_dot_product(x, (SELECT x FROM v ORDER BY vec_id LIMIT 1)), 6) AS angle FROM v"""


def _evaluated(s, d):
    """Clusters of the cells by their molecules."""
    counts = Run(s, d).mols.groupBy("cell", F.col("gene_id").alias("feature")).agg(F.count("*").cast("double").alias("value"))
    return embed.evaluate_cells(counts, fx.view(s, d, "v_cells").select("cell"), 5, fx.view(s, d, "v_cells").select("cell", F.col("cluster").alias("label"))).clusters


Q["evaluate_cells"] = _evaluated
