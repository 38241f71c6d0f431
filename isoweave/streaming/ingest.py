"""Extension: reads that arrive as a stream (the engine itself is a batch engine)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import genomics as g


def molecule_events(reads: DataFrame, time: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Distinct (cell, umi, gene_id, block) of a stream of eligible reads within the watermark."""
    blocks = reads.withWatermark(time, late).select(time, "cell", "umi", "gene_id", F.explode(g.cigar_shape("pos", "cigar").blocks).alias("block"))
    return blocks.dropDuplicatesWithinWatermark(["cell", "umi", "gene_id", "block"])


def reads_per_window(reads: DataFrame, time: str = "ts", late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Reads and distinct molecules by gene and tumbling window."""
    w = F.window(time, width)
    return reads.withWatermark(time, late).groupBy(w, "gene_id").agg(F.count("*").alias("reads"), F.approx_count_distinct(F.struct("cell", "umi")).alias("molecules"))
