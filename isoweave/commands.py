"""The commands that end in files: prepare, estimate-tes, evaluate.  Every one refuses to write where something is, and writes its record last."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import api
from .operators import catalog, embed, prepare, runs, sets
from .sources import bam, remote, sinks, text
from .sources.text import require
from .storage import staged


def _free(out: str) -> str:
    out = out.rstrip("/")
    if remote.taken(out):
        raise FileExistsError(f"output already exists: {out}")
    return out


def estimate_tes(reads: DataFrame, assignments: DataFrame, transcripts: DataFrame, out: str, selected: DataFrame | None = None, **limits) -> dict:
    """tes.tsv (transcript_id, tes, count), summary.tsv (one row for every selected transcript, 0 where nothing was seen) and run.json below `out`; returns the record."""
    out, spark = _free(out), reads.sparkSession
    ends, seen, qc = api.estimate_tes(reads, assignments, transcripts, **({"selected": selected} if selected is not None else {}), **limits)
    wanted = transcripts.select("id") if selected is None else selected.select(F.col("model").alias("id"))
    whole = wanted.distinct().join(seen, "id", "left").select(F.col("id").alias("transcript_id"), F.coalesce("observations", F.lit(0)).alias("observations"), F.coalesce("total_weight", F.lit(0.0)).alias("total_weight"))
    sinks.tsv(ends.select(F.col("id").alias("transcript_id"), "tes", "count"), f"{out}/tes.tsv", "transcript_id", "tes")
    sinks.tsv(whole, f"{out}/summary.tsv", "transcript_id")
    back = text.tes(spark, f"{out}/tes.tsv").agg(F.count("*"), F.sum("weight")).first()
    record = {"status": "complete", "endpoints": back[0], "total_weight": back[1] or 0.0, "qc": {r["reason"]: r["n"] for r in qc.collect()}, "limits": limits}
    sinks.manifest(f"{out}/run.json", record)
    return record


def prepare_panel(transcripts: DataFrame, tokens: DataFrame, reads: DataFrame, cells: DataFrame, genome: str, contigs: DataFrame, out: str) -> dict:
    """What a panel of genes needs: their catalog and spliced transcripts, and their reads as sorted BAM and as FASTQ.

    tokens (ix, token) name genes by id or symbol.  genome: FASTA with .fai; contigs (chrom, ix, length): the header's.
    Below `out`: transcripts.gtf, transcripts.fa, reads.bam with its index, reads.fastq, and run.json.
    """
    out, spark = _free(out), reads.sparkSession
    tx = staged(runs.subset_catalog(transcripts, tokens), "panel")
    sinks.text(catalog.gtf_lines(tx), f"{out}/transcripts.gtf")
    spliced = staged(catalog.spliced_from(tx, genome), "spliced")
    spliced.select(F.concat(F.lit(">"), "id", F.lit("\n"), "seq").alias("value")).write.text(f"{out}/transcripts.fa")
    found = staged(prepare.panel_reasons(reads, tx, cells), "events")
    kept = staged(prepare.panel_reads(found).select(*reads.columns), "kept")
    columns = [c for c in bam.WHOLE_COLUMNS if c in kept.columns]
    sinks.bam(kept.select(*columns), f"{out}/reads.bam", contigs, single=True)
    sinks.text(prepare.fastq(kept), f"{out}/reads.fastq")
    bam.register(spark)
    record = {
        "status": "complete", "genes": tx.select("gene_id").distinct().count(), "transcripts": spliced.count(), "reads": spark.read.format("bam").schema("name string").load(f"{out}/reads.bam").count(),
        "qc": {r["reason"]: r["n"] for r in found.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n")).collect()},
    }
    sinks.manifest(f"{out}/run.json", record)
    return record


def evaluate_run(spark: SparkSession, run: str, out: str, n_clusters: int, clusters: str | None = None, original: str | None = None, n_components: int = 20, seed: int = 0) -> dict:
    """Clusters of a finished run's cells: clusters.tsv, embedding.tsv and evaluation.json below `out`; returns the report.

    Cells without counts are left out and counted.  clusters: CSV of labels to compare with, all cells of the run in it.
    original: another finished run, of which the same cells are clustered by its own features; a cell that it lacks raises.
    """
    out, mine = _free(out), runs.load_run(spark, run)
    counts = staged(mine["counts"], "counts")
    active = staged(counts.where("value > 0").select("cell").distinct(), "active")
    n, every = active.count(), mine["barcodes"].count()
    labels = text.clusters(spark, clusters).select("cell", F.col("cluster").alias("label")) if clusters else None
    got = embed.evaluate_cells(counts.where("value > 0"), active, n_clusters, labels, n_components, seed)
    report = {
        "cells_evaluated": n, "zero_count_cells_excluded": every - n, "method": "TruncatedSVD", "silhouette": got.silhouette, "ari_reference": got.adjusted_rand, "nmi_reference": got.normalized_mutual_info,
        "parameters": {"n_clusters": n_clusters, "n_components": n_components, "seed": seed},
    }
    if original:
        other = runs.load_run(spark, original)
        lost = sets.missing(active, other["barcodes"].select(F.col("value").alias("cell"))).count()
        if lost:
            raise ValueError(f"original run lacks {lost} evaluated barcodes")
        theirs = sets.whitelisted(other["counts"], active)
        found = embed.evaluate_cells(theirs, active, n_clusters, None, n_components, seed).clusters
        pairs = sets.aligned(got.clusters.withColumnRenamed("cluster", "l"), found.withColumnRenamed("cluster", "r")).select("l", "r")
        report["original_ari"], report["original_nmi"] = embed.agreement(pairs)
    width = len(got.embedding.first()["x"])
    sinks.tsv(got.clusters.select(F.col("cell").alias("barcode"), "cluster"), f"{out}/clusters.tsv", "barcode")
    sinks.tsv(got.embedding.select(F.col("cell").alias("barcode"), *[F.col("x")[k].alias(f"SVD{k + 1}") for k in range(width)]), f"{out}/embedding.tsv", "barcode")
    sinks.manifest(f"{out}/evaluation.json", report)
    return report


def write_run(counts: DataFrame, cells: DataFrame, transcripts: DataFrame, out: str, **record) -> dict:
    """A finished run's folder: barcodes.tsv, isoforms.tsv, isoform_counts.mtx.gz and run.json; counts (cell, id, count), cells (cell), transcripts (id, gene_id).

    Counts of unknown cells or transcripts raise.  Ids come in their order, which is the matrix's.
    """
    out = _free(out)
    ids, known = transcripts.select("id", "gene_id").distinct(), cells.select("cell").distinct()
    checks = [(known, "cell", "count of an unknown cell:"), (ids, "id", "count of an unknown transcript:")]
    rows = reduce(lambda df, c: require(df.join(c[0].select(c[1], F.lit(1).alias("_k")), c[1], "left"), F.col("_k").isNotNull(), c[2], c[1]).drop("_k"), checks, counts)
    n = sinks.matrix_market(rows.groupBy("cell", "id").agg(F.sum("count").alias("count")), known, ids.select("id"), f"{out}/isoform_counts.mtx.gz")
    sinks.tsv(known.select(F.col("cell").alias("barcode")), f"{out}/barcodes.tsv", "barcode")
    sinks.tsv(ids.select(F.col("id").alias("transcript_id"), "gene_id"), f"{out}/isoforms.tsv", "transcript_id")
    whole = {"status": "complete", "entries": n, "cells": known.count(), "isoforms": ids.count()} | record
    sinks.manifest(f"{out}/run.json", whole)
    return whole
