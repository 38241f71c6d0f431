"""Transcript ends from long reads: filters, weights, sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import genomics as g


def conflicts(assignments: DataFrame) -> DataFrame:
    """Source ids that are assigned to more than one model, unselected models included."""
    return assignments.groupBy("source_id").agg(F.countDistinct("model").alias("n")).where("n > 1")


def reasons(reads: DataFrame, assignments: DataFrame, tx: DataFrame, selected: DataFrame | None = None, mapq: int = 20, clip: int = 20, tolerance: int = 10, window: int = 200) -> DataFrame:
    """reads with the model that they are assigned to, the endpoint, the weight and the first reason against it.

    reads: name, flag, chrom, pos, mapq, cigar, weight.
    """
    t = tx.select(F.col("id").alias("t_id"), F.col("chrom").alias("t_chrom"), F.col("strand").alias("t_strand"), "exons")
    r = reads.join(assignments.select(F.col("source_id").alias("name"), "model"), "name", "left")
    if selected is not None:
        r = r.join(selected.select(F.col("model"), F.lit(True).alias("picked")), "model", "left")
    else:
        r = r.withColumn("picked", F.lit(True))
    r = r.join(t, r.model == t.t_id, "left").withColumn("shape", g.cigar_shape("pos", "cigar"))
    end = F.when(F.col("t_strand") == "+", F.col("shape.pos")).otherwise(F.col("pos"))
    reason = (
        F.when(F.col("model").isNull(), "unassigned_alignment")
        .when(F.col("picked").isNull(), "unselected_isoform")
        .when(F.col("t_id").isNull(), "missing_transcript_model")
        .when(g.nonprimary("flag"), "nonprimary")
        .when(F.col("mapq") < mapq, "low_mapq")
        .when(g.three_prime_clip("cigar", "t_strand") > clip, "excess_3prime_clip")
        .when(F.col("chrom") != F.col("t_chrom"), "wrong_locus")
        .when(g.read_strand("flag") != F.col("t_strand"), "wrong_strand")
        .when(F.size("shape.blocks") == 0, "no_aligned_blocks")
        .when(~g.splice_chain_match("shape.junctions", "exons", tolerance), "incompatible_splice_chain")
        .when(~g.terminal_exon_overlap("shape.blocks", "shape.junctions", "t_strand", "exons"), "missing_terminal_exon")
        .when(F.abs(end - g.tes_of("t_strand", "exons")) > window, "tes_outside_window")
        .when(F.col("weight") == 0, "zero_weight")
    )
    return r.withColumn("tes", end).withColumn("reason", reason)


def accepted(found: DataFrame) -> DataFrame:
    """One endpoint per read name; `endpoints` over 1 is a conflict."""
    ok = found.where("reason IS NULL")
    return ok.groupBy("name").agg(F.first("t_id").alias("id"), F.first("tes").alias("tes"), F.first("weight").alias("weight"), F.countDistinct("t_id", "tes", "weight").alias("endpoints"), (F.count("*") - 1).alias("duplicates"))


def weighted(ends: DataFrame) -> DataFrame:
    return ends.groupBy("id", "tes").agg(F.sum("weight").alias("count"))


def summary(ends: DataFrame) -> DataFrame:
    return ends.groupBy("id").agg(F.count("*").alias("observations"), F.sum("weight").alias("total_weight"))
