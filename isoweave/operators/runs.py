"""Catalog subsets, orders, lookups by index, finished runs and their exchange with a comparator."""

from __future__ import annotations

import json
import struct
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import genomics as g
from ..sources import text
from ..sources.sinks import digest
from ..sources.text import require


def subset_catalog(tx: DataFrame, tokens: DataFrame) -> DataFrame:
    """tx of the genes that tokens (ix, token) name, by id or by a symbol that is one gene's alone, with the gene's place `ix`; any other token raises."""
    genes = tx.select("gene_id", "gene_name").distinct()
    by_id = tokens.join(genes.select(F.col("gene_id").alias("token"), F.col("gene_id").alias("by_id")).distinct(), "token", "left")
    symbols = genes.groupBy(F.col("gene_name").alias("token")).agg(F.countDistinct("gene_id").alias("n"), F.min("gene_id").alias("by_name"))
    hit = by_id.join(symbols, "token", "left").withColumn("gene_id", F.coalesce("by_id", F.when(F.col("n") == 1, F.col("by_name"))))
    hit = require(hit, F.col("gene_id").isNotNull(), "gene is missing or ambiguous:", "token")
    return tx.join(hit.groupBy("gene_id").agg(F.min("ix").alias("ix")), "gene_id")


def in_contig_order(rows: DataFrame, contigs: DataFrame, *then: str) -> DataFrame:
    """rows (chrom, ...) in the order of the header's contigs (chrom, ix), then by `then`; rows of other contigs raise."""
    placed = rows.join(contigs.select("chrom", F.col("ix").alias("_ix")), "chrom", "left")
    return require(placed, F.col("_ix").isNotNull(), "contig is not in the header:", "chrom").orderBy("_ix", *then).drop("_ix")


def molecules_sorted(mols: DataFrame) -> DataFrame:
    return mols.orderBy("gene_id", "cell", "umi")


def same_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row (missing, unexpected, equal): how many ids each side lacks."""
    a, b = left.toDF("id").distinct(), right.toDF("id").distinct()
    both = a.withColumn("l", F.lit(1)).join(b.withColumn("r", F.lit(1)), "id", "full_outer")
    counts = both.agg(F.count_if(F.col("r").isNull()).alias("missing"), F.count_if(F.col("l").isNull()).alias("unexpected"))
    return counts.withColumn("equal", (F.col("missing") == 0) & (F.col("unexpected") == 0))


def indexed_reads(index: DataFrame, reads: DataFrame, wanted: DataFrame) -> DataFrame:
    """Reads (name, offset, seq) that an index (hole, offset) leads to and that are wanted by their whole name.

    Holes repeat between movies, so a hole only proposes.  An offset that leads to another hole or nowhere, and a name found twice, raise.
    """
    holes = wanted.select(g.pacbio_hole("name").alias("hole")).where("hole IS NOT NULL").distinct()
    asked = index.join(holes, "hole", "left_semi").select("offset", F.col("hole").alias("indexed"))
    found = asked.join(reads, "offset", "left").withColumn("actual", g.pacbio_hole("name"))
    found = require(found, F.coalesce(F.col("actual") == F.col("indexed"), F.lit(False)), "PBI offset mismatch at", "offset", "indexed")
    found = found.join(wanted.select("name").distinct(), "name", "left_semi").withColumn("n", F.count("*").over(Window.partitionBy("name")))
    return require(found, F.col("n") == 1, "duplicate query name:", "name").select("name", "seq")


def by_sample(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Channels (sample, ...) joined one to one; a sample that repeats within a channel raises."""

    def single(df: DataFrame) -> DataFrame:
        return require(df.withColumn("_n", F.count("*").over(Window.partitionBy("sample"))), F.col("_n") == 1, "sample repeats:", "sample").drop("_n")

    return reduce(lambda a, b: a.join(single(b), "sample"), others, single(first))


def concordance_plan(candidates: DataFrame) -> DataFrame:
    """(batch, local, rerun) of candidates (batch, id; a null id: an empty batch): batches with one candidate run again if there are several in all."""
    total = candidates.where("id IS NOT NULL").agg(F.countDistinct("id").alias("total"))
    local = candidates.groupBy("batch").agg(F.count("id").alias("local"))
    return local.crossJoin(F.broadcast(total)).select("batch", "local", ((F.col("local") == 1) & (F.col("total") > 1)).alias("rerun"))


def export_estimates(estimates: DataFrame, models: DataFrame, aliases: DataFrame, cells: DataFrame) -> dict[str, DataFrame]:
    """Frames of a comparator's results: isoforms, membership, entries (bc, transcript_id, gene_id, value) and a summary.

    estimates: (bc, gene_name, transcript_name, estimated_count); models: (transcript_name, gene_name, collapsed);
    aliases: (alias, id).  Estimates that are negative, not finite, of other cells, transcripts or genes raise.
    """
    named = lambda df, c, out: df.join(aliases.select(F.col("alias").alias(c), F.col("id").alias(out)), c, "left")
    m = named(named(models, "transcript_name", "transcript_id"), "gene_name", "gene_id")
    m = require(m, F.col("transcript_id").isNotNull() & F.col("gene_id").isNotNull(), "unknown alias of", "transcript_name", "gene_name")
    isoforms = m.select("transcript_id", "gene_id").distinct()
    members = m.select("transcript_id", "gene_id", F.explode(F.when(F.col("collapsed") != "none", F.split("collapsed", "_")).otherwise(F.array("transcript_name"))).alias("alias"))
    membership = members.join(aliases, "alias").select(F.col("transcript_id").alias("representative_transcript_id"), "gene_id", F.col("id").alias("member_transcript_id"))
    e = estimates.select("bc", F.col("transcript_name").alias("transcript_id"), F.col("gene_name").alias("gene_id"), F.col("estimated_count").try_cast("double").alias("value"))
    e = require(e, (F.col("value") >= 0) & (F.col("value") < float("inf")), "estimate is negative or not finite:", "bc", "transcript_id")
    known = lambda df, key, ids: df.join(ids.select(key, F.lit(True).alias("_known")).distinct(), key, "left")
    for key, ids, what in (("bc", cells.select(F.col("cell").alias("bc")), "unrequested barcode"), ("transcript_id", isoforms, "unknown transcript"), ("gene_id", isoforms, "unknown gene")):
        e = require(known(e, key, ids), F.col("_known").isNotNull(), f"estimate holds an {what}:", key).drop("_known")
    summary = e.agg(F.sum("value").alias("estimated_count_sum"), F.countDistinct("bc", "gene_id").alias("estimated_cell_gene_groups"), F.count("*").alias("matrix_entries"))
    return {"isoforms": isoforms, "membership": membership, "entries": e.select("bc", "transcript_id", "gene_id", "value"), "summary": summary}


def load_run(spark: SparkSession, folder: str | Path, foreign: bool = False) -> dict:
    """manifest, barcodes and isoforms (ix, value), and counts (cell, feature, value) of a finished run; one that is not finished raises.

    A run of the engine has run.json with status complete; a comparator's has summary.json and matrix_summary.json.
    """
    folder = Path(folder)
    manifest = folder / ("summary.json" if foreign else "run.json")
    record = json.loads(manifest.read_text()) if manifest.is_file() else None
    if record is None or foreign and not (folder / "matrix_summary.json").is_file() or not foreign and record.get("status") != "complete":
        raise ValueError(f"{folder} is not a finished run")
    cells, features = text.column(spark, str(folder / "barcodes.tsv"), "barcode"), text.column(spark, str(folder / "isoforms.tsv"), "transcript_id")
    return {"manifest": record, "barcodes": cells, "isoforms": features, "counts": text.matrix_market(spark, str(folder / "isoform_counts.mtx.gz"), cells, features)}


#: Fixed values of a shared-read certificate: the rules by which reads were selected (the whitelist's own rule comes besides), and how reads are named.
SELECTION = frozenset({"mapped", "primary", "not supplementary", "not QC-fail", "nonempty UB"})
READ_ID = "query_name before first /"


def shared_reads(folder: str | Path, bam: str | Path, barcodes: str | Path, contigs: list[str], schema: str, whitelist_rule: str, consumer: str | Path | None = None) -> dict[str, Path]:
    """BED file of every contig of a certified bundle; raises where the certificate, a hash or a contig does not hold."""
    folder = Path(folder)
    record = json.loads((folder / "certificate.json").read_text())

    def same(path, about) -> bool:
        return digest(path) == (about.get("bytes"), about.get("sha256"))

    checks = {
        "incomplete or of an unknown schema": record.get("schema") == schema and bool(record.get("completed")),
        "read ids under several cells": record.get("cross_cb_read_ids") == 0,
        "selection rules": set(record.get("selection_rules", [])) == SELECTION | {whitelist_rule},
        "read ids": record.get("read_id_rule") == READ_ID,
        "no projected alignments": int(record.get("projection_records", 0)) >= 1,
    }
    for what, held in checks.items():
        if not held:
            raise ValueError(f"certificate: {what}")
    for path, key in ((bam, "bam"), (barcodes, "canonical_sorted_barcodes"), *([(consumer, "consumer_source")] if consumer else [])):
        if not same(path, record[key]):
            raise ValueError(f"certificate: {key} has changed")
    out = {}
    for contig in sorted(contigs):
        name = contig.replace("/", "_") + ".bed"
        if name not in record.get("bed_files", {}) or not same(folder / "bed" / name, record["bed_files"][name]):
            raise ValueError(f"certificate: {contig} is missing or has changed")
        out[contig] = folder / "bed" / name
    return out


def check_index(path: str | Path) -> None:
    """Raises on a minimap2 index that long reads cannot be aligned with: w 5, k 15, plain minimizers, sequences kept."""
    if Path(path).suffix != ".mmi":
        return
    with open(path, "rb") as f:
        head = f.read(24)
    if len(head) < 24 or head[:4] != b"MMI\x02":
        raise ValueError(f"{path} is no minimap2 index")
    w, k, _, flags = struct.unpack("<4i", head[4:20])
    if flags & 3 or (w, k) != (5, 15):
        raise ValueError(f"{path}: w={w}, k={k}, flags={flags}; w=5, k=15 without homopolymer compression and with sequences is needed")


def isoseq_files(root: str | Path) -> dict[str, Path]:
    """group, read_stat and mapped_bam below a folder, as far as they are there; several files for one of them raise, unless one BAM alone lies in 04_align."""
    root = Path(root)
    if not root.is_dir():
        raise ValueError(f"{root} is no folder")

    def one(*patterns: str) -> Path | None:
        for p in patterns:
            found = sorted(x for x in root.rglob(p) if x.is_file())
            if len(found) > 1:
                raise ValueError(f"several files match {p}")
            if found:
                return found[0]
        return None

    aligned = [x for x in root.rglob("*mapped.bam") if x.is_file() and "04_align" in x.parts]
    out = {
        "group": one("*collapsed.group.txt", "*collapse.group.txt"),
        "read_stat": one("*collapsed.read_stat.txt", "*collapse.read_stat.txt"),
        "mapped_bam": aligned[0] if len(aligned) == 1 else one("*mapped.bam", "*.bam"),
    }
    return {k: v for k, v in out.items() if v}
