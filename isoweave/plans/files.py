"""Registered queries of the file readers, and of subsets, orders, lookups and runs.

A reader's query writes the file that it reads, from the driver's tables, to the
shared folder; the SQL looks at the tables alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import genomics as g
from ..operators import catalog as cat
from ..operators import runs
from ..sources import sinks, text
from ..storage import numbered, shared_dir
from . import fixtures as fx
from .flagship import Run, _line
from .oracles import sql

Q: dict = {}
O: dict = {}  # noqa: E741


def _add(name, query, statement, *needs):
    Q[name] = query
    O[name] = sql(statement, *needs)


def _place(s, name: str) -> str:
    return f"{shared_dir(s)}/{name}-{uuid.uuid4().hex}"


def _lines(df: DataFrame, name: str) -> str:
    """Path of a text file of df's one column."""
    path = _place(df.sparkSession, name)
    df.write.text(path)
    return path


def _table(df: DataFrame, name: str, sep: str = "\t") -> str:
    path = _place(df.sparkSession, name)
    df.write.csv(path, sep=sep, header=True, quote="", nullValue="", emptyValue="")
    return path


def _meta(s, d):
    return fx.view(s, d, "v_meta")


def _read(s, d, reader, columns, name, sep="\t"):
    return reader(s, _table(columns(s, d), name, sep))


_add("scan_text_gz", lambda s, d: text.lines(s, _gz(_meta(s, d).select(F.concat_ws("|", "id", "seq").alias("value")))), "SELECT concat(id, '|', seq) AS value FROM v_meta", "v_meta")


def _gz(df: DataFrame) -> str:
    path = _place(df.sparkSession, "lines")
    df.write.option("compression", "gzip").text(path)
    return path


_add("load_salmon_quant", lambda s, d: text.quant(s, _table(_meta(s, d).select(F.col("id").alias("Name"), F.lit("1").alias("Length"), F.lit("1").alias("EffectiveLength"), F.col("tpm").alias("TPM"), F.col("seq").alias("NumReads")), "quant")), "SELECT id AS name, tpm AS value FROM v_meta", "v_meta")
_add("load_salmon_numreads", lambda s, d: text.quant(s, _table(_meta(s, d).select(F.col("id").alias("Name"), F.col("seq").alias("NumReads")), "quant")), "SELECT id AS name, CAST(seq AS DOUBLE) AS value FROM v_meta", "v_meta")
_add("load_tes_tsv", lambda s, d: text.tes(s, _table(fx.view(s, d, "v_tes").select(F.col("id").alias("transcript_id"), "tes", F.when(F.col("weight") > 2, F.col("weight").cast("string")).alias("count")), "tes")), "SELECT id, tes, CASE WHEN weight > 2 THEN weight ELSE 1.0 END AS weight FROM v_tes", "v_tes")
_add("load_barcodes", lambda s, d: text.barcodes(s, _lines(fx.view(s, d, "v_reads").select(F.when(F.col("n") == 7, F.lit(" ")).otherwise(F.concat("cell", F.lit("\tx"))).alias("value")), "barcodes")), "SELECT DISTINCT cell FROM v_reads WHERE n <> 7", "v_reads")
_add("read_clusters_csv", lambda s, d: text.clusters(s, _table(fx.view(s, d, "v_cells").select(F.col("cell").alias("Barcode"), F.concat(F.lit(" k"), "cluster").alias("Cluster")), "clusters", ",")), "SELECT cell, concat('k', cluster) AS cluster FROM v_cells", "v_cells")
_add("load_raw_assignments", lambda s, d: text.raw_assignments(s, _table(_meta(s, d).select(F.concat(F.lit("q"), "id").alias("ID"), (F.col("seq") + 1).alias("Length"), F.col("gene_id").alias("PBid")), "stat")), "SELECT concat('q', id) AS source_id, CAST(seq + 1 AS INT) AS length, gene_id AS model FROM v_meta", "v_meta")
_add("load_consensus_assignments", lambda s, d: text.consensus_assignments(s, _lines(_meta(s, d).groupBy("gene_id").agg(F.array_join(F.collect_list("id"), ", ").alias("ids")).select(F.concat_ws("\t", "gene_id", "ids").alias("value")).unionByName(s.createDataFrame([("# note",), ("pbid\tids",)], "value string")), "group")), "SELECT id AS source_id, gene_id AS model FROM v_meta", "v_meta")
_add("read_column", lambda s, d: (lambda c: c.join(_meta(s, d).select(F.col("id").alias("value"), "seq"), "value").select("ix", "value"))(text.column(s, _table(_meta(s, d).orderBy("seq").select("seq", "id"), "column"), "id")), "SELECT CAST(ROW_NUMBER() OVER (ORDER BY seq) - 1 AS INT) AS ix, id AS value FROM v_meta", "v_meta")


def _matrix(s, d):
    """Molecule counts by cell and gene through a coordinate file in parts, which many tasks read (a single gzip file is one task's)."""
    n = Run(s, d).mols.groupBy("cell", "gene_id").agg(F.count("*").alias("n"))
    ids = lambda df, c: numbered(df.select(F.col(c).alias("value")).distinct(), "ix", "value").withColumn("ix", F.col("ix") - 1)
    cells, genes = ids(fx.view(s, d, "v_cells"), "cell"), ids(_meta(s, d), "gene_id")
    path = _place(s, "matrix")
    sinks.matrix_market(n.select("cell", F.col("gene_id").alias("id"), F.col("n").cast("double").alias("count")), cells.select(F.col("value").alias("cell")), genes.select(F.col("value").alias("id")), path, False)
    return text.matrix_market(s, path, cells, genes).select("cell", F.col("feature").alias("gene_id"), "value")


_add("load_matrix_market", _matrix, "SELECT cell, gene_id, CAST(COUNT(*) AS DOUBLE) AS value FROM o_mol GROUP BY ALL", "o_mol")


def _json(s, d):
    tx = fx.transcripts(s, d)
    model = F.struct("id", F.transform("exons", lambda x: F.array(x.a, x.b)).alias("exons"), F.col("lr_count").alias("fl"))
    genes = tx.groupBy("gene_id").agg(
        F.first("chrom").alias("chrom"), F.first("strand").alias("strand"), F.concat(F.lit("name of "), F.first("gene_id")).alias("gene_name"),
        F.collect_list(F.when(F.col("source") == "reference", model)).alias("ref"), F.collect_list(F.when(F.col("source") != "reference", model)).alias("lr"),
    )
    whole = genes.agg(F.map_from_entries(F.collect_list(F.struct("gene_id", F.struct("gene_id", "gene_name", "chrom", "strand", "ref", "lr")))).alias("genes"))
    got = text.catalog_json(s, _lines(whole.select(F.to_json(F.struct("genes")).alias("value")), "catalog"))
    return got.select("id", "gene_id", "gene_name", "chrom", "strand", _line("exons").alias("exons"), "lr_count", "source")


_add("load_catalog_json", _json, """SELECT id, gene_id, concat('name of ', gene_id) AS gene_name, chrom, strand, exons, CASE WHEN source = 'reference' THEN 0.0 ELSE lr_count END AS lr_count, source
    FROM v_meta JOIN (SELECT id, string_agg(concat(a, '-', b), ';' ORDER BY a) AS exons FROM v_exon GROUP BY id) USING (id)""", "v_meta", "v_exon")  # fmt: skip
_add("scan_bed_shard", lambda s, d: text.bed(s, _lines(fx.view(s, d, "v_reads").select(F.concat_ws("\t", "chrom", "pos", (F.col("pos") + 40).cast("string"), F.lit("+"), F.concat("name", F.lit("/1")), F.concat(F.lit("CB:Z:"), "cell", F.lit("::UB:Z:"), "umi")).alias("value")), "bed")).select("chrom", "start", "end", g.upstream_read_id("read").alias("read"), g.fragment_cell("molecule").alias("cell")), 'SELECT chrom, pos AS start, pos + 40 AS "end", name AS read, cell FROM v_reads', "v_reads")
_seq = "concat(repeat('ACGTN', CAST(1 + p_size AS INT)), substr('ACGT', 1, CAST(p_partkey % 4 AS INT)))"
_add("fasta_fetch", lambda s, d: text.fasta(s, _lines(s.read.parquet(f"{d}/part.parquet").select(F.concat(F.lit(">c"), "p_partkey", F.lit(" about it\n"), F.regexp_replace(F.expr(_seq), "(.{7})", "$1\n")).alias("value")), "fasta")), f"SELECT concat('c', p_partkey) AS chrom, {_seq} AS seq FROM part")

# subsets, orders, lookups, runs
_named = lambda s, d: fx.transcripts(s, d).withColumn("gene_name", F.concat(F.lit("N"), F.substring("gene_id", 5, 9)))
_add("subset_catalog", lambda s, d: runs.subset_catalog(_named(s, d), _meta(s, d).select(F.col("seq").alias("ix"), F.when(F.col("seq") % 2 == 0, F.col("gene_id")).otherwise(F.concat(F.lit("N"), F.substring("gene_id", 5, 9))).alias("token")).where("ix % 15 IN (0, 6)")).select("id", "gene_id", "ix"),
     "SELECT id, gene_id, ix FROM v_meta JOIN (SELECT gene_id, MIN(seq) AS ix FROM v_meta WHERE seq % 15 IN (0, 6) GROUP BY gene_id) USING (gene_id)", "v_meta")
_contigs = lambda s: s.range(5).select(F.concat(F.lit("chr"), "id").alias("chrom"), (4 - F.col("id")).alias("ix"))


def _placed(df):
    """Rows with their places in the order that they have, counted by ranges."""
    return numbered(df.withColumn("_o", F.monotonically_increasing_id()), "place", "_o").drop("_o")


_add("contig_order_concat", lambda s, d: _placed(runs.in_contig_order(fx.view(s, d, "v_cells").select(F.concat(F.lit("chr"), F.col("cluster").cast("string")).alias("chrom"), "cell"), _contigs(s), "cell")), "SELECT concat('chr', cluster) AS chrom, cell, ROW_NUMBER() OVER (ORDER BY cluster DESC, cell) AS place FROM v_cells", "v_cells")
_add("bam_coordinate_sort", lambda s, d: _placed(runs.in_contig_order(_meta(s, d).join(fx.view(s, d, "v_exon").groupBy("id").agg(F.min("a").alias("pos")), "id").select("chrom", "pos", "id"), _contigs(s), "pos", "id")), "SELECT chrom, pos, id, ROW_NUMBER() OVER (ORDER BY chrom DESC, pos, id) AS place FROM v_meta JOIN (SELECT id, MIN(a) AS pos FROM v_exon GROUP BY id) USING (id)", "v_meta", "v_exon")
_add("molecule_sort", lambda s, d: _placed(runs.molecules_sorted(Run(s, d).mols.select("gene_id", "cell", "umi"))), "SELECT gene_id, cell, umi, ROW_NUMBER() OVER (ORDER BY gene_id, cell, umi) AS place FROM o_mol", "o_mol")
_add("set_equality", lambda s, d: runs.same_ids(fx.view(s, d, "v_cells").select("cell"), fx.view(s, d, "v_reads").where("n < 7").select("cell")), "SELECT missing, unexpected, missing + unexpected = 0 AS equal FROM (SELECT COUNT(*) AS missing FROM (SELECT cell FROM v_cells EXCEPT SELECT cell FROM v_reads WHERE n < 7)), (SELECT COUNT(*) AS unexpected FROM (SELECT cell FROM v_reads WHERE n < 7 EXCEPT SELECT cell FROM v_cells))", "v_cells", "v_reads")
_movie = lambda c: F.concat(F.lit("m"), F.col(c) % 3, F.lit("/"), F.floor(F.col(c) / 3), F.lit("/ccs"))


def _pbi(s, d):
    p = s.read.parquet(f"{d}/part.parquet")
    reads = p.select((F.col("p_partkey") * 7).alias("offset"), _movie("p_partkey").alias("name"), F.expr(_seq).alias("seq"))
    return runs.indexed_reads(reads.select(g.pacbio_hole("name").alias("hole"), "offset"), reads, p.where("p_size > 30").select(_movie("p_partkey").alias("name"))).select("name", "seq")


_add("pbi_candidate_lookup", _pbi, f"SELECT concat('m', p_partkey % 3, '/', CAST(FLOOR(p_partkey / 3) AS BIGINT), '/ccs') AS name, {_seq} AS seq FROM part WHERE p_size > 30")
_add("nextflow_sample_join", lambda s, d: runs.by_sample(_meta(s, d).select(F.col("id").alias("sample"), "tpm"), _meta(s, d).where("seq % 2 = 0").select(F.col("id").alias("sample"), "lr_count"), _meta(s, d).where("seq % 3 = 0").select(F.col("id").alias("sample"), "source")), "SELECT id AS sample, tpm, lr_count, source FROM v_meta WHERE seq % 6 = 0", "v_meta")
_add("concordance_bug_plan", lambda s, d: runs.concordance_plan(fx.view(s, d, "v_reads").select(F.concat("gx", F.lit("/"), "umi").alias("batch"), F.when(F.col("mapq") > 20, F.col("name")).alias("id")).where("batch IS NOT NULL")), "SELECT batch, COUNT(id) AS local, COUNT(id) = 1 AND (SELECT COUNT(DISTINCT name) FROM v_reads WHERE gx IS NOT NULL AND mapq > 20) > 1 AS rerun FROM (SELECT concat(gx, '/', umi) AS batch, CASE WHEN mapq > 20 THEN name END AS id FROM v_reads WHERE gx IS NOT NULL) GROUP BY batch", "v_reads")


def _export(s, d):
    m = _meta(s, d)
    e = Run(s, d).mols.groupBy("cell", "gene_id").agg(F.count("*").alias("n")).select(F.col("cell").alias("bc"), F.col("gene_id").alias("gene_name"), F.concat(F.lit("T"), F.substring("gene_id", 5, 9).cast("long") * 5 + F.when(F.col("gene_id") == "ENSG0", 1).otherwise(0)).alias("transcript_name"), (F.col("n") / 4).alias("estimated_count"))
    aliases = m.select(F.col("id").alias("alias"), "id").union(m.select("gene_id", "gene_id").distinct())
    models = m.select(F.col("id").alias("transcript_name"), F.col("gene_id").alias("gene_name"), F.lit("none").alias("collapsed"))
    return runs.export_estimates(e, models, aliases, fx.view(s, d, "v_cells"))


_est = "SELECT cell AS bc, concat('T', CAST(substr(gene_id, 5) AS BIGINT) * 5 + CASE WHEN gene_id = 'ENSG0' THEN 1 ELSE 0 END) AS transcript_id, gene_id, COUNT(*) / 4.0 AS value FROM o_mol GROUP BY cell, gene_id"
_add("stream_matrix_export", lambda s, d: _export(s, d)["entries"], _est, "o_mol")
_add("export_summary", lambda s, d: _export(s, d)["summary"].withColumn("estimated_count_sum", F.round("estimated_count_sum", 4)), f"SELECT round(SUM(value), 4) AS estimated_count_sum, COUNT(*) AS estimated_cell_gene_groups, COUNT(*) AS matrix_entries FROM ({_est})", "o_mol")
