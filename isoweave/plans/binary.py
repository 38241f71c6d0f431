"""Registered queries of BAM and indexed FASTA: written from the driver's tables, read back whole or by loci."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import catalog as cat
from ..operators import prepare as pre
from ..sources import bam, fasta, sinks
from ..storage import numbered
from . import fixtures as fx
from .files import _place
from .oracles import sql

Q: dict = {}
O: dict = {}  # noqa: E741


def _add(name, query, statement, *needs):
    Q[name] = query
    O[name] = sql(statement, *needs)


#: Loci of the query by locus: overlapping ones, one within an intron, one on a contig without reads.
LOCI = (("chr1", 1000, 9000), ("chr1", 5000, 24000), ("chr3", 2300, 2900), ("chr4", 0, 1500), ("chr9", 0, 10))


def _contigs(s) -> DataFrame:
    """Five contigs, last one first, and one without reads."""
    return s.range(5).select(F.concat(F.lit("chr"), "id").alias("chrom"), (4 - F.col("id")).alias("ix"), F.lit(1 << 28).alias("length")).unionByName(s.sql("SELECT 'chr9' AS chrom, 5L AS ix, 10 AS length"))


def _alignments(s, d) -> DataFrame:
    """The reads as alignments: bases by the read's number, tags, some reads without qualities, some without a place."""
    r = fx.view(s, d, "v_reads")
    lost = F.col("l_orderkey") % 37 == 0
    tags = F.map_filter(F.create_map(F.lit("CB"), "cell", F.lit("UB"), "umi", F.lit("GX"), "gx"), lambda _, v: v.isNotNull())
    return r.select(
        "name", F.when(lost, F.col("flag").bitwiseOR(4)).otherwise(F.col("flag")).alias("flag"), F.when(~lost, F.col("chrom")).alias("chrom"), F.when(lost, -1).otherwise(F.col("pos")).alias("pos"), "mapq", F.when(~lost, F.col("cigar")).alias("cigar"),
        F.repeat(F.translate((F.col("l_orderkey") % 10000 + 10000).cast("string"), "0123456789", "ACGTNACGTN"), 8).alias("seq"), F.when(F.col("n") > 2, F.repeat(F.lit("I"), 40)).alias("qual"), tags.alias("tags"),
    )


def _written(s, d, single: bool) -> str:
    path = _place(s, "reads") + ".bam"
    sinks.bam(_alignments(s, d), path, _contigs(s), single)
    return path


def _scan(s, d):
    bam.register(s)
    back = s.read.format("bam").option("splitBytes", 1 << 20).load(_written(s, d, True))
    return back.select("name", "flag", "chrom", "pos", "mapq", "cigar", "seq", "qual", F.col("tags")["CB"].alias("cell"), F.col("tags")["GX"].alias("gx"))


_row = """SELECT *, l_orderkey % 37 = 0 AS lost, repeat(translate(CAST(l_orderkey % 10000 + 10000 AS VARCHAR), '0123456789', 'ACGTNACGTN'), 8) AS seq FROM v_reads"""
_add("scan_bam", _scan, f"""SELECT name, CASE WHEN lost THEN flag | 4 ELSE flag END AS flag, CASE WHEN NOT lost THEN chrom END AS chrom, CASE WHEN lost THEN -1 ELSE pos END AS pos, mapq, CASE WHEN NOT lost THEN cigar END AS cigar,
    seq, CASE WHEN n > 2 THEN repeat('I', 40) END AS qual, cell, gx FROM ({_row})""", "v_reads")  # fmt: skip


def _locus(s, d):
    bam.register(s)
    read = s.read.format("bam").schema("name string, chrom string, pos bigint, `end` bigint").option("splitBytes", 1 << 18)
    return read.option("loci", ";".join(f"{c}:{a}-{b}" for c, a, b in LOCI)).load(_written(s, d, False))


_add("scan_bam_locus", _locus, "SELECT name, chrom, pos, e AS \"end\" FROM (SELECT *, pos + CASE WHEN n <= 4 THEN 40 WHEN n = 5 THEN 1740 ELSE 3740 END AS e FROM v_reads WHERE l_orderkey % 37 <> 0) WHERE "
     + " OR ".join(f"chrom = '{c}' AND pos < {b} AND e > {a}" for c, a, b in LOCI), "v_reads")


def _order(s, d):
    """Places of the records in the written file, whose parts are in order and sorted."""
    bam.register(s)
    back = s.read.format("bam").schema("name string, chrom string, pos bigint").option("splitBytes", 1 << 20).load(_written(s, d, True))
    return numbered(back.withColumn("o", F.monotonically_increasing_id()), "place", "o").select("name", "chrom", "pos", "place")


_add("write_bam_sorted", _order, "SELECT name, CASE WHEN NOT lost THEN chrom END AS chrom, CASE WHEN lost THEN -1 ELSE pos END AS pos, ROW_NUMBER() OVER (ORDER BY lost, CASE WHEN NOT lost THEN chrom END DESC, CASE WHEN lost THEN -1 ELSE pos END, name, CASE WHEN lost THEN flag | 4 ELSE flag END) AS place FROM (SELECT *, l_orderkey % 37 = 0 AS lost FROM v_reads)", "v_reads")


def _panel(s, d):
    """Panel reads written as sorted BAM with an index, and read back by name."""
    bam.register(s)
    reads = _alignments(s, d).where("chrom IS NOT NULL").withColumn("cell", F.col("tags")["CB"]).withColumn("umi", F.col("tags")["UB"]).withColumn("gx", F.col("tags")["GX"])
    kept = pre.panel_reads(pre.panel_reasons(reads, fx.transcripts(s, d), fx.view(s, d, "v_cells")))
    path = _place(s, "panel") + ".bam"
    sinks.bam(kept.select("name", "flag", "chrom", "pos", "mapq", "cigar", "seq", "qual", "tags"), path, _contigs(s), True)
    return s.read.format("bam").option("splitBytes", 4 << 20).load(path).select("name", "chrom", "pos", "flag", "cigar", F.col("tags")["GX"].alias("gx"))


_add("write_panel_bam", _panel, """SELECT DISTINCT name, r.chrom, pos, flag, cigar, gx FROM v_reads r JOIN x_bounds w ON r.chrom = w.chrom AND r.pos < w.hi AND r.pos + CASE WHEN n <= 4 THEN 40 WHEN n = 5 THEN 1740 ELSE 3740 END > w.lo
    JOIN (SELECT DISTINCT cell AS called FROM v_cells) c ON c.called = r.cell WHERE l_orderkey % 37 <> 0 AND flag & 2820 = 0 AND umi <> '' AND gx IS NOT NULL AND NOT contains(gx, ';') AND regexp_replace(gx, '\\.[0-9]+$', '') = gene_id
    AND (flag & 16 <> 0) = (strand = '-')""", "v_reads", "x_bounds", "v_cells")  # fmt: skip

_seq = "concat(repeat('ACGTN', CAST(1 + p_size AS INT)), substr('ACGT', 1, CAST(p_partkey % 4 AS INT)))"


def _fetched(s, d):
    fasta.register(s)
    p, path = s.read.parquet(f"{d}/part.parquet"), _place(s, "sequences")
    p.select(F.concat(F.lit("c"), "p_partkey").alias("chrom"), F.expr(_seq).alias("seq")).write.format("fasta").option("width", 7).mode("append").save(path)
    asked = p.select(F.concat(F.lit("c"), "p_partkey").alias("chrom"), (F.col("p_partkey") % 5).alias("start"), (F.col("p_partkey") % 5 + F.col("p_size") % 60 % (4 * F.col("p_size"))).alias("end"))
    return fasta.fetch(asked.withColumn("end", F.least("end", F.lit(5) + 5 * F.floor((F.col("end") - 1) / 5))), path)


_add("fasta_fetch_intervals", _fetched, f"""SELECT chrom, start, e AS "end", substr(seq, CAST(start + 1 AS INT), CAST(e - start AS INT)) AS seq FROM (SELECT *, least(b, 5 + 5 * CAST(FLOOR((b - 1) / 5) AS BIGINT)) AS e FROM (
    SELECT concat('c', p_partkey) AS chrom, p_partkey % 5 AS start, p_partkey % 5 + p_size % 60 % (4 * p_size) AS b, {_seq} AS seq FROM part))""")


#: Repeats in a stretch of a contig, and stretches that a task writes, or thereabouts.
STRETCH, EACH = 200_000, 32


def _transcriptome(s, d):
    """Spliced transcripts from contigs of repeated ACGGT that are written, in stretches, and fetched."""
    fasta.register(s)
    path = _place(s, "contigs")
    n = fx.view(s, d, "v_exon").agg((F.floor(F.max("b") / 5) + 1).alias("n")).first()["n"] or 0  # one number
    first = s.range(5).select(F.concat(F.lit("chr"), "id").alias("chrom"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n).cast("long"), F.lit(STRETCH).cast("long"))).alias("k"))
    # places are dealt, bases are made where they are written
    dealt = first.repartitionByRange(max(5, 5 * n // STRETCH // EACH), "chrom", "k").sortWithinPartitions("chrom", "k")
    dealt.select("chrom", (5 * F.col("k")).alias("start"), F.repeat(F.lit("ACGGT"), F.least(F.lit(STRETCH), n - F.col("k")).cast("int")).alias("seq")).write.format("fasta").mode("append").save(path)
    return cat.spliced_from(fx.transcripts(s, d), path)


_add("export_transcriptome_indexed", _transcriptome, """SELECT id, CASE WHEN strand = '+' THEN seq ELSE reverse(translate(seq, 'ACGT', 'TGCA')) END AS seq FROM (SELECT id, ANY_VALUE(strand) AS strand,
    string_agg(substr(repeat('ACGGT', CAST(2 + (b - a) / 5 AS INT)), CAST(a % 5 + 1 AS INT), CAST(b - a AS INT)), '' ORDER BY a) AS seq FROM v_exon GROUP BY id)""", "v_exon")  # fmt: skip
