"""Registered queries of functions, catalog, joins, transcript ends, evaluation and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import genomics as g
from ..operators import catalog as cat
from ..operators import evaluate as ev
from ..operators import inference as inf
from ..operators import prepare as pre
from ..operators import sets as st
from ..operators import tes as te
from ..sources import sinks
from ..storage import numbered, staged
from . import fixtures as fx
from .flagship import Run, _line
from .oracles import sql

Q: dict = {}
O: dict = {}  # noqa: E741


def _add(name, query, text=None, *needs):
    Q[name] = query
    if text:
        O[name] = sql(text, *needs)


def _split(text):
    out, depth, cur = [], 0, ""
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth and not cur.rstrip().endswith("THEN"):
            out.append(cur)
            cur = ""
        else:
            cur += c
    return [*out, cur]


def _reads(s, d):
    return fx.view(s, d, "v_reads")


def _part(s, d):
    return s.read.parquet(f"{d}/part.parquet")


BL = "CASE WHEN n <= 4 THEN concat(pos, '-', pos + 40) WHEN n = 5 THEN concat(pos, '-', pos + 20, ';', pos + 1720, '-', pos + 1740) ELSE concat(pos, '-', pos + 20, ';', pos + 3720, '-', pos + 3740) END"
# functions over reads and transcripts
_add("normalize_gene_id", lambda s, d: _reads(s, d).select("name", g.normalize_gene_id("gx").alias("gene")), "SELECT name, regexp_replace(trim(gx), '^(ENS[A-Z]*G[0-9]+)\\.[0-9]+(_PAR_Y)?$', '\\1\\2') AS gene FROM v_reads", "v_reads")
_add("cigar_shape", lambda s, d: _reads(s, d).select("name", _line(g.cigar_shape("pos", "cigar").blocks).alias("blocks"), _line(g.cigar_shape("pos", "cigar").junctions).alias("junctions")),
     f"SELECT name, {BL} AS blocks, CASE WHEN n <= 4 THEN '' ELSE concat(pos + 20, '-', pos + 20 + CASE WHEN n = 5 THEN 1700 ELSE 3700 END) END AS junctions FROM v_reads", "v_reads")
_add("read_end", lambda s, d: _reads(s, d).select("name", g.read_end("pos", "cigar").alias("e")), "SELECT name, pos + CASE WHEN n <= 4 THEN 40 WHEN n = 5 THEN 1740 ELSE 3740 END AS e FROM v_reads", "v_reads")
_clip = lambda: F.concat((F.col("l_orderkey") % 30 + 1).cast("string"), F.lit("S"), "cigar", (F.col("l_orderkey") % 25 + 1).cast("string"), F.lit("S3H"))
_add("three_prime_clip", lambda s, d: _reads(s, d).select("name", g.three_prime_clip(_clip(), g.read_strand("flag")).alias("clip")), "SELECT name, CASE WHEN flag & 16 = 0 THEN l_orderkey % 25 + 4 ELSE l_orderkey % 30 + 1 END AS clip FROM v_reads", "v_reads")
_add("bed_blocks", lambda s, d: _reads(s, d).select("name", _line(g.bed_blocks("pos", F.lit("10M5D10M100N20M"))).alias("blocks")), "SELECT name, concat(pos, '-', pos + 25, ';', pos + 125, '-', pos + 145) AS blocks FROM v_reads", "v_reads")
_add("flag_bits", lambda s, d: _reads(s, d).select("name", g.nonprimary("flag").alias("nonprimary"), g.read_strand("flag").alias("strand")), "SELECT name, flag & 256 <> 0 AS nonprimary, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand FROM v_reads", "v_reads")
_seq = lambda c: F.translate((F.col(c) * 7919 + 12345).cast("string"), "0123456789", "ACGTNRYKMB")
_dseq = "translate(CAST(p_partkey * 7919 + 12345 AS VARCHAR), '0123456789', 'ACGTNRYKMB')"
_rev = "reverse(translate({}, 'ACGTRYKMBVDHSWN', 'TGCAYRMKVBHDSWN'))"
_add("reverse_complement", lambda s, d: _part(s, d).select("p_partkey", g.reverse_complement(_seq("p_partkey")).alias("seq")), f"SELECT p_partkey, {_rev.format(_dseq)} AS seq FROM part")
_add("forward_sequence", lambda s, d: _part(s, d).select("p_partkey", g.forward_sequence(_seq("p_partkey"), F.when(F.col("p_size") % 2 == 0, 16).otherwise(0)).alias("seq")), f"SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN {_rev.format(_dseq)} ELSE {_dseq} END AS seq FROM part")
_hole = "CASE p_size % 4 WHEN 0 THEN concat('m1/', p_partkey, '/ccs') WHEN 1 THEN concat('m1/', p_partkey, '/0_4') WHEN 2 THEN concat('m1/', p_partkey, '/ccs/0_4') ELSE concat('m1/', p_partkey) END"
_add("parse_pacbio_hole", lambda s, d: _part(s, d).select("p_partkey", g.pacbio_hole(F.expr(_hole)).alias("hole")), "SELECT p_partkey, CASE WHEN p_size % 4 < 3 THEN CAST(p_partkey AS INT) END AS hole FROM part")
_many = "concat('m', p_partkey % 7, '/', p_partkey, CASE WHEN p_size % 2 = 0 THEN '/3' ELSE '' END)"
_add("upstream_read_id", lambda s, d: _part(s, d).select("p_partkey", g.upstream_read_id(F.expr(_many)).alias("up")), "SELECT p_partkey, concat('m', p_partkey % 7) AS up FROM part")
_add("fragment_cell", lambda s, d: _reads(s, d).select("name", g.fragment_cell(F.concat(F.lit("CB:Z:"), "cell", F.lit("::UB:Z:"), "umi")).alias("c")), "SELECT name, cell AS c FROM v_reads", "v_reads")
_add("exponential_fallback", lambda s, d: _part(s, d).select("p_partkey", F.round(g.kde_logpdf("p_size", F.array().cast("array<double>")), 9).alias("f")), "SELECT p_partkey, round(-p_size / 300.0 - ln(300.0), 9) AS f FROM part")
_add("sha256", lambda s, d: _part(s, d).select("p_partkey", F.sha2("p_name", 256).alias("h")), "SELECT p_partkey, sha256(p_name) AS h FROM part")
_add("tes_of", lambda s, d: fx.transcripts(s, d).select("id", g.tes_of("strand", "exons").alias("tes")), "SELECT id, CASE WHEN ANY_VALUE(strand) = '+' THEN MAX(b) ELSE MIN(a) END AS tes FROM v_exon GROUP BY id", "v_exon")
_add("introns_of", lambda s, d: fx.transcripts(s, d).select("id", _line(g.introns_of("exons")).alias("introns")), "SELECT id, COALESCE(string_agg(concat(a, '-', b), ';' ORDER BY a) FILTER (b IS NOT NULL), '') AS introns FROM o_introns GROUP BY id", "o_introns")
_add("spliced_distance", lambda s, d: (lambda r: inf.hits(inf.shapes(r.mols), r.tx).where("fits").withColumn("d", g.spliced_distance("blocks", "strand", "exons")).select("gene_id", _line("blocks").alias("blocks"), _line("junctions").alias("junctions"), "id", "d"))(Run(s, d)), "SELECT gene_id, blocks, junctions, id, d FROM o_dist", "o_dist")
_add("interval_union", lambda s, d: Run(s, d).mols.select("cell", "umi", "gene_id", F.explode("blocks").alias("x")).select("cell", "umi", "gene_id", "x.a", "x.b"), "SELECT cell, umi, gene_id, a, b FROM o_mblocks", "o_mblocks")
_add("gtf_attributes", lambda s, d: fx.view(s, d, "v_exon").repartition(64, "id", "j").select("id", "j", g.gtf_attributes(F.format_string('gene_id "%s"; transcript_id "%s"; Parent=transcript:%s;k=%d', "gene_id", "id", "id", "j")).alias("m")).withColumn("m", F.explode(F.array("m"))).select("id", "j", F.col("m")["gene_id"].alias("g"), F.col("m")["Parent"].alias("p"), F.col("m")["k"].alias("k")), "SELECT id, j, gene_id AS g, concat('transcript:', id) AS p, CAST(j AS VARCHAR) AS k FROM v_exon", "v_exon")
# catalog
_add("scan_gtf_exons", lambda s, d: cat.gtf_exons(cat.gtf_lines(fx.transcripts(s, d)).select("value")).select("id", "gene_id", "chrom", "strand", "a", "b"), "SELECT id, gene_id, chrom, strand, a, b FROM v_exon", "v_exon")
_add("scan_gtf_exons_closed", lambda s, d: cat.gtf_exons(cat.gtf_lines(fx.transcripts(s, d)).select("value"), 0).select("id", "a", "b"), "SELECT id, a + 1 AS a, b FROM v_exon", "v_exon")
_add("export_union_gtf", lambda s, d: cat.gtf_lines(fx.transcripts(s, d)).select("value"), "SELECT concat(e.chrom, chr(9), source, chr(9), 'exon', chr(9), a + 1, chr(9), b, chr(9), '.', chr(9), e.strand, chr(9), '.', chr(9), 'gene_id \"', e.gene_id, '\"; transcript_id \"', id, '\";') AS value FROM v_exon e JOIN v_meta m USING (id)", "v_exon", "v_meta")
_add("exon_chain", lambda s, d: cat.exon_chains(fx.view(s, d, "v_exon")).select("id", _line("exons").alias("exons")), "SELECT id, string_agg(concat(a, '-', b), ';' ORDER BY a) AS exons FROM v_exon GROUP BY id", "v_exon")
_add("dedup_structures", lambda s, d: cat.deduplicated(fx.transcripts(s, d)).select("id", "gene_id", "lr_count", "source", F.array_join("aliases", ",").alias("aliases"), "removed"),
     """SELECT MIN_BY(id, (CASE WHEN source = 'reference' THEN 0 ELSE 1 END, seq)) AS id, gene_id, SUM(CASE WHEN source <> 'reference' THEN lr_count ELSE 0 END) AS lr_count,
     string_agg(DISTINCT source, '+' ORDER BY source) AS source, string_agg(id, ',' ORDER BY id) AS aliases, COUNT(*) - 1 AS removed
     FROM v_meta JOIN (SELECT id, string_agg(concat(a, '-', b), ';' ORDER BY a) AS ex FROM v_exon GROUP BY id) USING (id) GROUP BY gene_id, chrom, strand, ex""", "v_meta", "v_exon")  # fmt: skip
_add("catalog_union", lambda s, d: (lambda t: t.where("source = 'reference'").select("id", "gene_id", "source", "lr_count", "exons").unionByName(cat.exon_chains(fx.view(s, d, "v_exon").where("gene_id LIKE '%1'").withColumn("id", F.concat(F.lit("PB."), "id")), "gene_id").withColumn("source", F.lit("pigeon")).withColumn("lr_count", F.lit(2.0))).select("id", "gene_id", "source", "lr_count", F.size("exons").alias("n")))(fx.transcripts(s, d)),
     """SELECT id, gene_id, source, lr_count, n FROM v_meta JOIN (SELECT id, CAST(COUNT(*) AS INT) AS n FROM v_exon GROUP BY id) USING (id) WHERE source = 'reference'
     UNION ALL SELECT concat('PB.', id), gene_id, 'pigeon', 2.0, CAST(COUNT(*) AS INT) FROM v_exon WHERE gene_id LIKE '%1' GROUP BY id, gene_id""", "v_meta", "v_exon")  # fmt: skip
_add("catalog_sort", lambda s, d: fx.transcripts(s, d).select("id", "chrom", F.element_at("exons", 1).a.alias("a"), "gene_id").orderBy("chrom", "a", "gene_id", "id"), "SELECT id, chrom, MIN(a) AS a, gene_id FROM v_exon GROUP BY id, chrom, gene_id", "v_exon")


def _spoiled(s, d):
    """Transcripts of which some break each rule."""
    t, k = fx.transcripts(s, d), F.col("seq") % 11
    first = F.col("exons")[0]
    exons = F.when(k == 1, F.array().cast(g.INTERVALS)).when(k == 2, F.array(F.struct(first.b.alias("a"), first.a.alias("b")))).when(k == 3, F.array(first, F.struct((first.b - 1).alias("a"), (first.b + 9).alias("b")))).when(k == 4, F.array(F.struct((-first.a).alias("a"), first.b.alias("b")))).otherwise(F.col("exons"))
    t = t.withColumn("exons", exons).withColumn("strand", F.when(k == 0, ".").otherwise(F.col("strand")))
    return t.withColumn("lr_count", F.when(k == 5, -1.0).when(k == 6, float("nan")).when(k == 7, float("inf")).otherwise(F.col("lr_count")))


_add("validate_transcripts", lambda s, d: cat.violations(_spoiled(s, d)), "SELECT id, CASE seq % 11 WHEN 0 THEN 'strand' WHEN 1 THEN 'no_exons' WHEN 2 THEN 'exon_bounds' WHEN 3 THEN 'exon_overlap' WHEN 4 THEN 'exon_bounds' ELSE 'count' END AS reason FROM v_meta WHERE seq % 11 <= 7", "v_meta")
_add("sr_only_projection", lambda s, d: inf.hybrid_prior(fx.transcripts(s, d).withColumn("lr_count", F.lit(0.0)), fx.abundance(s, d)).select("id", F.round("prior", 9).alias("prior")), "SELECT id, round(CASE WHEN SUM(tpm) OVER (PARTITION BY gene_id) > 0 THEN tpm / SUM(tpm) OVER (PARTITION BY gene_id) ELSE 1.0 / COUNT(*) OVER (PARTITION BY gene_id) END, 9) AS prior FROM v_meta", "v_meta")
_class = "concat('P', p_partkey) AS isoform, CASE p_size % 9 WHEN 0 THEN 'fusion' WHEN 1 THEN 'novel_in_catalog' ELSE 'full-splice_match' END AS structural_category, CASE WHEN p_size % 5 = 0 THEN 'true' ELSE 'FALSE' END AS RTS_stage, CASE p_size % 7 WHEN 0 THEN 'non_canonical' WHEN 1 THEN 'NA' ELSE 'canonical' END AS all_canonical"
_add("pigeon_filter", lambda s, d: _part(s, d).selectExpr(*[x.strip() for x in _split(_class)]).select(F.coalesce(cat.filter_reason(), F.lit("accepted")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n")),
     "SELECT CASE WHEN p_size % 9 = 0 THEN 'unsupported_category' WHEN p_size % 5 = 0 THEN 'rts' WHEN p_size % 7 = 0 THEN 'noncanonical' ELSE 'accepted' END AS reason, COUNT(*) AS n FROM part GROUP BY 1")


def _classified(s, d):
    """The union of a reference GTF and a long-read GFF with its classification: what becomes of every record, and the transcript of the catalog that it stands under."""
    tx = fx.transcripts(s, d)
    named, k = F.concat(F.lit("N"), F.substring("gene_id", 5, 2)), F.col("seq") % 3
    ref = cat.gtf_lines(tx.where("source = 'reference'").withColumn("gene_name", named)).withColumn("seq", F.substring("id", 2, 20).cast("bigint"))
    # a model in conflict has its first exon elsewhere
    e = tx.select("id", "seq", "chrom", "strand", F.posexplode("exons").alias("n", "e"))
    gff = e.select(F.concat_ws("\t", F.when((F.col("seq") % 17 == 0) & (F.col("n") == 0), "chrX").otherwise(F.col("chrom")), F.lit("PacBio"), F.lit("exon"), (F.col("e.a") + 1).cast("string"), F.col("e.b").cast("string"), F.lit("."), "strand", F.lit("."), F.format_string('transcript_id "%s";', "id")).alias("value"))
    c = tx.select(F.col("id").alias("isoform"), F.lit("genic").alias("structural_category"), F.lit("").alias("RTS_stage"), F.lit("NA").alias("all_canonical"),
                  F.when(k == 0, F.concat("gene_id", F.lit(".7"))).when(k == 1, named).otherwise("").alias("associated_gene"),
                  F.when(F.col("seq") % 13 == 0, "chrX").otherwise("").alias("chrom"), F.lit("").alias("strand"), F.col("lr_count").cast("string").alias("fl_assoc"), "seq")
    catalog, aliases, outcomes = cat.load_union(cat.gtf_exons(ref.select("value", "seq")), cat.gtf_exons(gff), c)
    whole = aliases.join(catalog.select("id", "lr_count", "source", _line("exons").alias("exons")), "id").withColumnRenamed("source", "sources")
    met = outcomes.join(whole, (F.col("isoform") == F.col("alias")) & F.col("reason").isNull(), "left")
    reason = F.coalesce("reason", F.when(F.col("source") == "reference", "reference").otherwise("accepted"))
    return met.select("isoform", reason.alias("reason"), F.when(F.col("reason").isNull(), F.col("gene_id")).alias("gene_id"), "id", "lr_count", "sources", "exons")


_add("load_catalog_union", _classified,
     """SELECT isoform, reason, r.gene_id, t.id, t.lr_count, t.sources, t.exons FROM (
       WITH x AS (SELECT substr(gene_id, 5, 2) AS nn, chrom, strand, COUNT(DISTINCT gene_id) AS k, MIN(gene_id) AS one FROM v_meta WHERE source = 'reference' GROUP BY ALL),
       c AS (SELECT m.*, CASE WHEN seq % 17 = 0 THEN 'missing_or_conflicting_structure' WHEN seq % 13 = 0 THEN 'classification_locus_conflict' WHEN seq % 3 = 1 AND k > 1 THEN 'ambiguous_gene_mapping' WHEN seq % 3 = 2 THEN 'missing_gene_mapping' ELSE 'accepted' END AS reason,
         CASE WHEN seq % 3 = 0 THEN gene_id ELSE COALESCE(one, concat('N', substr(gene_id, 5, 2))) END AS mapped FROM v_meta m LEFT JOIN x ON x.nn = substr(m.gene_id, 5, 2) AND x.chrom = m.chrom AND x.strand = m.strand)
       SELECT id AS isoform, reason, CASE WHEN reason = 'accepted' THEN mapped END AS gene_id, chrom, strand FROM c UNION ALL SELECT id, 'reference', gene_id, chrom, strand FROM v_meta WHERE source = 'reference') r
     LEFT JOIN (WITH x AS (SELECT substr(gene_id, 5, 2) AS nn, chrom, strand, COUNT(DISTINCT gene_id) AS k, MIN(gene_id) AS one FROM v_meta WHERE source = 'reference' GROUP BY ALL),
       s AS (SELECT id, string_agg(concat(a, '-', b), ';' ORDER BY a) AS exons FROM v_exon GROUP BY id),
       u AS (SELECT id, gene_id, chrom, strand, 0.0::DOUBLE AS n, 'reference' AS source, seq FROM v_meta WHERE source = 'reference'
         UNION ALL SELECT id, CASE WHEN seq % 3 = 0 THEN gene_id ELSE COALESCE(one, concat('N', substr(gene_id, 5, 2))) END, m.chrom, m.strand, lr_count, 'pigeon', seq FROM v_meta m LEFT JOIN x ON x.nn = substr(m.gene_id, 5, 2) AND x.chrom = m.chrom AND x.strand = m.strand
           WHERE seq % 17 <> 0 AND seq % 13 <> 0 AND seq % 3 < 2 AND NOT (seq % 3 = 1 AND COALESCE(k, 0) > 1)),
       t AS (SELECT MIN_BY(id, (CASE WHEN source = 'reference' THEN 0 ELSE 1 END, seq)) AS id, gene_id, chrom, strand, exons, SUM(n) AS lr_count, string_agg(DISTINCT source, '+' ORDER BY source) AS sources, list(DISTINCT id) AS aliases FROM u JOIN s USING (id) GROUP BY gene_id, chrom, strand, exons)
       SELECT id, lr_count, sources, exons, unnest(aliases) AS alias FROM t) t ON t.alias = r.isoform AND r.gene_id IS NOT NULL""", "v_meta", "v_exon")  # fmt: skip
_add("alias_abundance_sum", lambda s, d: cat.alias_sum(fx.view(s, d, "v_meta").select(F.col("id").alias("name"), F.col("tpm").alias("value")), fx.view(s, d, "v_meta").select(F.col("id").alias("alias"), F.concat(F.lit("T"), (F.floor(F.col("seq") / 2) * 2).cast("string")).alias("id")), fx.view(s, d, "v_meta").where("seq % 2 = 0")), "SELECT concat('T', CAST(FLOOR(seq / 2) * 2 AS BIGINT)) AS id, SUM(tpm) AS value FROM v_meta GROUP BY 1", "v_meta")
_tokens = "CASE seq % 5 WHEN 0 THEN gene_id WHEN 1 THEN concat(gene_id, '.9') WHEN 2 THEN concat('N', substr(gene_id, 5, 2)) WHEN 3 THEN concat('S', substr(gene_id, 5)) ELSE 'nope' END"
_add("gene_selection", lambda s, d: cat.selected_genes(fx.view(s, d, "v_meta").select(F.expr(_tokens).alias("token")).distinct(), cat.gene_aliases(fx.transcripts(s, d).withColumn("gene_name", F.concat(F.lit("N"), F.substring("gene_id", 5, 2)))).unionByName(fx.transcripts(s, d).select(F.concat(F.lit("S"), F.substring("gene_id", 5, 9)).alias("alias"), "chrom", "strand", "gene_id").distinct())),
     f"""SELECT DISTINCT token, CASE k WHEN 0 THEN gene_id WHEN 3 THEN gene_id WHEN 2 THEN CASE WHEN alone = 1 THEN gene_id END END AS gene_id FROM (SELECT {_tokens} AS token, seq % 5 AS k, gene_id, substr(gene_id, 5, 2) AS nn FROM v_meta)
     JOIN (SELECT substr(gene_id, 5, 2) AS nn, COUNT(DISTINCT gene_id) AS alone FROM v_meta GROUP BY 1) USING (nn)""", "v_meta")  # fmt: skip
_add("likelihood_budget_guard", lambda s, d: cat.over_budget(Run(s, d).mols, fx.transcripts(s, d), 300), "SELECT gene_id, m * t AS entries FROM (SELECT gene_id, COUNT(*) AS m FROM o_mol GROUP BY 1) JOIN (SELECT gene_id, COUNT(*) AS t FROM v_meta GROUP BY 1) USING (gene_id) WHERE m * t > 300", "o_mol", "v_meta")
_add("tpm_fraction", lambda s, d: cat.tpm_fraction(fx.view(s, d, "v_meta")).select("id", F.round("fraction", 9).alias("fraction")), "SELECT id, round((tpm + 1) / SUM(tpm + 1) OVER (PARTITION BY gene_id), 9) AS fraction FROM v_meta", "v_meta")
_add("feature_index", lambda s, d: numbered(fx.view(s, d, "v_meta").select("gene_id", "id"), "ix", "gene_id", "id").select("id", (F.col("ix") - 1).alias("ix")), "SELECT id, ROW_NUMBER() OVER (ORDER BY gene_id, id) - 1 AS ix FROM v_meta", "v_meta")
# joins and sets
_add("interval_overlap_join", lambda s, d: inf.overlap_join(_reads(s, d).withColumn("start", F.col("pos")).withColumn("end", g.read_end("pos", "cigar")), inf.gene_windows(fx.transcripts(s, d))).groupBy("gene_id").agg(F.count("*").alias("n")), "SELECT gene_id, COUNT(*) AS n FROM o_events GROUP BY gene_id", "o_events")
_add("whitelist_semi_join", lambda s, d: st.whitelisted(_reads(s, d), fx.view(s, d, "v_cells")).groupBy("cell").agg(F.count("*").alias("n")), "SELECT cell, COUNT(*) AS n FROM v_reads SEMI JOIN v_cells USING (cell) GROUP BY cell", "v_reads", "v_cells")
_add("missing_anti_join", lambda s, d: st.missing(_reads(s, d), fx.view(s, d, "v_cells")), "SELECT DISTINCT cell FROM v_reads ANTI JOIN v_cells USING (cell)", "v_reads", "v_cells")
_add("unexpected_full_outer", lambda s, d: st.unexpected(fx.view(s, d, "v_cells"), _reads(s, d)), "SELECT COALESCE(cell, c) AS id, CASE WHEN c IS NULL THEN 'missing' ELSE 'unexpected' END AS side FROM v_cells FULL JOIN (SELECT DISTINCT cell AS c FROM v_reads) ON cell = c WHERE cell IS NULL OR c IS NULL", "v_cells", "v_reads")
_add("gx_gene_match", lambda s, d: _reads(s, d).select("gx").distinct().join(inf.gene_matches(fx.transcripts(s, d)).withColumnRenamed("gx", "k"), g.normalize_gene_id("gx") == F.col("k")).select("gx", "gene_id"), "SELECT DISTINCT gx, regexp_replace(gx, '\\.[0-9]+$', '') AS gene_id FROM v_reads SEMI JOIN v_meta ON regexp_replace(gx, '\\.[0-9]+$', '') = v_meta.gene_id WHERE NOT contains(gx, ';')", "v_reads", "v_meta")
_add("active_intersection", lambda s, d: st.in_all("cell", _reads(s, d).where("n <= 4"), _reads(s, d).where("n > 4")), "SELECT cell FROM v_reads WHERE n <= 4 INTERSECT SELECT cell FROM v_reads WHERE n > 4", "v_reads")
_add("id_difference", lambda s, d: st.missing(fx.view(s, d, "v_cells"), _reads(s, d).where("n = 7 AND mapq = 0")), "SELECT cell FROM v_cells EXCEPT SELECT cell FROM v_reads WHERE n = 7 AND mapq = 0", "v_cells", "v_reads")
_add("gene_universe", lambda s, d: st.in_any("gene_id", Run(s, d).mols, fx.transcripts(s, d)), "SELECT gene_id FROM o_mol UNION SELECT gene_id FROM v_meta", "o_mol", "v_meta")
_add("read_overlap_guard", lambda s, d: st.shared(_reads(s, d).where("n = 1"), _reads(s, d).where("n = 2")), "SELECT COUNT(*) AS shared FROM (SELECT name FROM v_reads WHERE n = 1 INTERSECT SELECT name FROM v_reads WHERE n = 2)", "v_reads")
_add("distinct_union_sort", lambda s, d: _reads(s, d).select("cell", "umi").union(fx.view(s, d, "v_cells").select("cell", F.lit("U0"))).distinct().orderBy("cell", "umi"), "SELECT cell, umi FROM v_reads UNION SELECT cell, 'U0' FROM v_cells", "v_reads", "v_cells")


_OPS = "concat(1 + p_size % 3, 'S', 10 + p_size, 'M', CASE p_partkey % 4 WHEN 0 THEN '3I' WHEN 1 THEN '4D' WHEN 2 THEN '50N' ELSE '2P' END, 7, '=', 1, 'X', 5, 'M2H')"
_gap = "CASE p_partkey % 4 WHEN 1 THEN 4 WHEN 2 THEN 50 ELSE 0 END"
_start, _mid = "p_partkey", "p_partkey + 10 + p_size"
_cut = "p_partkey % 4 = 2"  # an intron; a deletion of 4 parts blocks as well, but is no junction
_add("cigar_shape_ops", lambda s, d: _part(s, d).select("p_partkey", F.expr(_OPS).alias("c")).select("p_partkey", g.cigar_shape("p_partkey", "c").alias("x")).select("p_partkey", _line(F.col("x.junctions")).alias("junctions"), F.col("x.pos").alias("e"), F.aggregate("x.blocks", F.lit(0).cast("bigint"), lambda t, b: t + b.b - b.a).alias("bases")),
     f"SELECT p_partkey, CASE WHEN {_cut} THEN concat({_mid}, '-', {_mid} + 50) ELSE '' END AS junctions, {_mid} + {_gap} + 13 AS e, 10 + p_size + 13 AS bases FROM part")


# transcript ends
def _long_reads(s, d):
    t = fx.transcripts(s, d)
    n = F.col("seq")
    cigar = F.array_join(F.concat(F.transform(F.zip_with("exons", g.introns_of("exons"), lambda e, i: F.concat((e.b - e.a).cast("string"), F.lit("M"), F.coalesce(F.concat((i.b - i.a).cast("string"), F.lit("N")), F.lit("")))), lambda x: x)), "")
    reads = t.select(F.concat(F.lit("q"), "id").alias("name"), "id", F.when((F.col("strand") == "-") != (n % 10 == 3), 16).otherwise(0).alias("flag"), F.when(n % 19 == 4, "chrX").otherwise(F.col("chrom")).alias("chrom"), F.element_at("exons", 1).a.alias("pos"), (n % 60).cast("int").alias("mapq"), cigar.alias("cigar"), (n % 6).cast("double").alias("weight"))
    return reads, t.select(F.concat(F.lit("q"), "id").alias("source_id"), F.col("id").alias("model")).where("model <> 'T7'"), t


_tes_reason = """SELECT concat('q', id) AS name, CASE WHEN id = 'T7' THEN 'unassigned_alignment' WHEN seq % 60 < 20 THEN 'low_mapq' WHEN seq % 19 = 4 THEN 'wrong_locus' WHEN seq % 10 = 3 THEN 'wrong_strand' WHEN seq % 6 = 0 THEN 'zero_weight' END AS reason,
    id, CASE WHEN m.strand = '+' THEN hi ELSE lo END AS tes, CAST(seq % 6 AS DOUBLE) AS weight FROM v_meta m JOIN (SELECT id, MIN(a) AS lo, MAX(b) AS hi FROM v_exon GROUP BY id) USING (id)"""
_tes = lambda s, d: (lambda r, a, t: te.reasons(r.drop("id"), a, t))(*_long_reads(s, d))
_add("tes_filter_cascade", lambda s, d: _tes(s, d).select("name", F.coalesce("reason", F.lit("accepted")).alias("reason")), f"SELECT name, COALESCE(reason, 'accepted') AS reason FROM ({_tes_reason})", "v_meta", "v_exon")
_add("tes_weight_aggregation", lambda s, d: te.weighted(te.accepted(_tes(s, d))), f"SELECT id, tes, SUM(weight) AS \"count\" FROM ({_tes_reason}) WHERE reason IS NULL GROUP BY id, tes", "v_meta", "v_exon")
_add("tes_read_dedup", lambda s, d: te.accepted(_tes(s, d)).select("name", "id", "tes", "endpoints", "duplicates"), f"SELECT name, id, tes, 1 AS endpoints, 0 AS duplicates FROM ({_tes_reason}) WHERE reason IS NULL", "v_meta", "v_exon")
_more = "SELECT *, 1 AS copy FROM ({}) UNION ALL SELECT *, 2 FROM ({}) WHERE CAST(substr(name, 3) AS BIGINT) % 3 = 0".format(_tes_reason, _tes_reason)


def _again(s, d):
    """Every third read comes twice."""
    r, a, t = _long_reads(s, d)
    r = r.drop("id")
    return te.reasons(r.unionByName(r.where("CAST(substr(name, 3) AS BIGINT) % 3 = 0")), a, t)


_add("tes_read_dedup_repeats", lambda s, d: te.accepted(_again(s, d)).select("name", "id", "tes", "endpoints", "duplicates"), f"SELECT name, id, tes, CAST(COUNT(DISTINCT (id, tes, weight)) AS BIGINT) AS endpoints, COUNT(*) - 1 AS duplicates FROM ({_more}) WHERE reason IS NULL GROUP BY name, id, tes", "v_meta", "v_exon")
_add("tes_summary", lambda s, d: te.summary(te.accepted(_tes(s, d))), f"SELECT id, COUNT(*) AS observations, SUM(weight) AS total_weight FROM ({_tes_reason}) WHERE reason IS NULL GROUP BY id", "v_meta", "v_exon")
_add("assignment_conflicts", lambda s, d: te.conflicts(_reads(s, d).select(F.col("umi").alias("source_id"), F.col("cell").alias("model"))), "SELECT umi AS source_id, COUNT(DISTINCT cell) AS n FROM v_reads GROUP BY umi HAVING COUNT(DISTINCT cell) > 1", "v_reads")
_add("tes_observation_join", lambda s, d: fx.transcripts(s, d).join(fx.view(s, d, "v_tes").groupBy("id").agg(F.count("*").alias("n")), "id", "left").select("id", F.coalesce("n", F.lit(1)).alias("ends")), "SELECT id, COALESCE(n, 1) AS ends FROM v_meta LEFT JOIN (SELECT id, COUNT(*) AS n FROM v_tes GROUP BY id) USING (id)", "v_meta", "v_tes")


# evaluation
def _pairs(s, d):
    return s.read.parquet(f"{d}/customer.parquet").select(F.col("c_mktsegment").alias("l"), (F.col("c_nationkey") % 4).alias("r"))


_P = "(SELECT c_mktsegment AS l, c_nationkey % 4 AS r FROM customer)"
_add("contingency_table", lambda s, d: ev.contingency(_pairs(s, d)), f"SELECT l, r, COUNT(*) AS n FROM {_P} GROUP BY l, r")
_add("adjusted_rand", lambda s, d: ev.adjusted_rand(_pairs(s, d)).select(F.round("ari", 9).alias("ari")), f"""SELECT round((o - a * b / t) / ((a + b) / 2 - a * b / t), 9) AS ari FROM (SELECT SUM(n * (n - 1) / 2) AS o FROM (SELECT COUNT(*) AS n FROM {_P} GROUP BY l, r)), (SELECT SUM(n * (n - 1) / 2) AS a FROM (SELECT COUNT(*) AS n FROM {_P} GROUP BY l)), (SELECT SUM(n * (n - 1) / 2) AS b FROM (SELECT COUNT(*) AS n FROM {_P} GROUP BY r)), (SELECT COUNT(*) * (COUNT(*) - 1) / 2 AS t FROM {_P})""")
_add("normalized_mutual_info", lambda s, d: ev.normalized_mutual_info(_pairs(s, d)).select(F.round("nmi", 9).alias("nmi")), f"""WITH t AS (SELECT l, r, COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER () AS p FROM {_P} GROUP BY l, r), x AS (SELECT l, SUM(p) AS p FROM t GROUP BY l), y AS (SELECT r, SUM(p) AS p FROM t GROUP BY r)
    SELECT round(mi / ((h1 + h2) / 2), 9) AS nmi FROM (SELECT SUM(t.p * ln(t.p / (x.p * y.p))) AS mi FROM t JOIN x USING (l) JOIN y USING (r)), (SELECT -SUM(p * ln(p)) AS h1 FROM x), (SELECT -SUM(p * ln(p)) AS h2 FROM y)""")
_add("abundance_metrics", lambda s, d: (lambda m: m.select(*[F.round(c, 8).alias(c) for c in m.columns]))(ev.abundance_metrics(fx.view(s, d, "v_meta").select("id", F.col("tpm").alias("truth"), (F.col("lr_count") + 1).alias("estimate")))),
     """SELECT round(AVG(abs(e - t)), 8) AS mae, round(sqrt(AVG((e - t) ** 2)), 8) AS rmse, round(corr(t, e), 8) AS pearson, round(corr(rt, re), 8) AS spearman, round(sqrt(greatest(0, (SUM(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END) + SUM(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END)) / 2)), 8) AS js_distance, round(SUM(abs(p - q)) / 2, 8) AS total_variation
     FROM (SELECT t, e, t / SUM(t) OVER () AS p, e / SUM(e) OVER () AS q, RANK() OVER (ORDER BY t) + (COUNT(*) OVER (PARTITION BY t) - 1) / 2 AS rt, RANK() OVER (ORDER BY e) + (COUNT(*) OVER (PARTITION BY e) - 1) / 2 AS re FROM (SELECT tpm AS t, lr_count + 1 AS e FROM v_meta))""", "v_meta")  # fmt: skip
_add("average_rank", lambda s, d: ev.average_rank(fx.view(s, d, "v_meta"), "tpm", "r").select("id", "r"), "SELECT id, RANK() OVER (ORDER BY tpm) + (COUNT(*) OVER (PARTITION BY tpm) - 1) / 2 AS r FROM v_meta", "v_meta")
_add("library_normalise_log1p", lambda s, d: ev.library_normalise(Run(s, d).mols.groupBy("cell", "gene_id").agg(F.count("*").alias("count"))).select("cell", "gene_id", F.round("value", 9).alias("value")), "SELECT cell, gene_id, round(ln(1 + c * 1e4 / SUM(c) OVER (PARTITION BY cell)), 9) AS value FROM (SELECT cell, gene_id, COUNT(*) AS c FROM o_mol GROUP BY ALL)", "o_mol")
_add("cell_totals", lambda s, d: st.cell_totals(fx.view(s, d, "v_cells"), Run(s, d).mols), "SELECT cell, COALESCE(n, 0) AS total FROM v_cells LEFT JOIN (SELECT cell, COUNT(*) AS n FROM o_mol GROUP BY cell) USING (cell)", "v_cells", "o_mol")
_add("gene_totals", lambda s, d: st.gene_totals(Run(s, d).mols), "SELECT cell, gene_id, COUNT(*) AS total FROM o_mol GROUP BY ALL", "o_mol")
_add("exclude_zero_cells", lambda s, d: st.zero_cells(fx.view(s, d, "v_cells"), Run(s, d).mols).agg(F.count("*").alias("zero_cells")), "SELECT COUNT(*) AS zero_cells FROM v_cells ANTI JOIN o_mol USING (cell)", "v_cells", "o_mol")
_add("shared_active_cells", lambda s, d: st.active_cells(Run(s, d).mols), "SELECT cell FROM o_mol GROUP BY cell HAVING COUNT(DISTINCT gene_id) >= 2", "o_mol")
_points = lambda s, d: s.read.parquet(f"{d}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"), "label")
_add("silhouette", lambda s, d: ev.silhouette(_points(s, d)).select("id", F.round("s", 6).alias("s")), """WITH sums AS (SELECT a.vec_id AS id, a.label AS l, b.label AS r, SUM(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS d, COUNT(*) AS n FROM embeddings a, embeddings b GROUP BY ALL)
    SELECT id, round(CASE WHEN w IS NULL OR greatest(w, o) = 0 THEN 0 ELSE (o - w) / greatest(w, o) END, 6) AS s FROM (SELECT id, MAX(CASE WHEN l = r AND n > 1 THEN d / (n - 1) END) AS w, MIN(CASE WHEN l <> r THEN d / n END) AS o FROM sums GROUP BY id)""")
_add("truncated_svd", lambda s, d: ev.truncated_svd(_points(s, d)))
_add("kmeans", lambda s, d: ev.kmeans(_points(s, d)))
# comparator semantics
_kept = "CAST(substr(id, 2) AS INT) % 5 < 1 + 3 * (CAST(substr(gene_id, 5) AS INT) % 2)"
_add("single_model_genes", lambda s, d: (lambda r: st.single_model_genes(inf.hits(inf.shapes(r.mols), r.tx.where(_kept)).where("fits")))(Run(s, d)), f"SELECT gene_id FROM o_fit WHERE {_kept} GROUP BY gene_id HAVING COUNT(DISTINCT id) = 1", "o_fit")
_add("read_id_cell_uniqueness", lambda s, d: st.ids_under_several_cells(_reads(s, d).withColumn("name", F.concat("umi", F.lit("/"), "n"))), "SELECT umi AS up, COUNT(DISTINCT cell) AS cells FROM v_reads GROUP BY umi HAVING COUNT(DISTINCT cell) > 1", "v_reads")
_add("molecule_support", lambda s, d: st.molecule_support(_reads(s, d).withColumnRenamed("g", "gene_id"), "mapq").withColumnRenamed("gene_id", "g"), "SELECT cell, g, COUNT(DISTINCT umi) AS candidates, COUNT(DISTINCT CASE WHEN mapq > 0 THEN umi END) AS positive FROM v_reads GROUP BY cell, g", "v_reads")
_add("resource_rollup", lambda s, d: st.resources(s.read.parquet(f"{d}/events.parquet").select("event_type", F.col("value").alias("seconds"), F.col("value").alias("rss")), "event_type").withColumn("seconds", F.round("seconds", 4)), "SELECT event_type, round(SUM(value), 4) AS seconds, MAX(value) AS peak FROM events GROUP BY event_type")
_add("external_scale", lambda s, d: (lambda n: st.external_scale(n.join(fx.view(s, d, "v_meta"), "gene_id").select("cell", "gene_id", "id", (F.col("tpm") / 97).alias("share")), n.withColumnRenamed("total", "positive")))(staged(st.gene_totals(Run(s, d).mols), "totals")).withColumn("count", F.round("count", 6)),
     "SELECT cell, gene_id, id, round(round(tpm / 97, 3) * n, 6) AS \"count\" FROM (SELECT cell, gene_id, COUNT(*) AS n FROM o_mol GROUP BY ALL) JOIN v_meta USING (gene_id)", "o_mol", "v_meta")
_add("lineage_chain", lambda s, d: s.sql("WITH RECURSIVE c(root, id, depth) AS (SELECT p_partkey, p_partkey, 0 FROM {p} UNION ALL SELECT root, CAST(FLOOR(id / 2) AS BIGINT), depth + 1 FROM c WHERE id > 0 AND depth < 16) SELECT root, MAX(depth) AS hops FROM (SELECT * FROM c LIMIT ALL) GROUP BY root", p=_part(s, d)), "WITH RECURSIVE c(root, id, depth) AS (SELECT p_partkey, p_partkey, 0 FROM part UNION ALL SELECT root, CAST(FLOOR(id / 2) AS BIGINT), depth + 1 FROM c WHERE id > 0 AND depth < 16) SELECT root, MAX(depth) AS hops FROM c GROUP BY root")


def _certificates(s, d):
    """Every part is a certificate whose source is the part of half its number, as its hash and size were."""
    c = _part(s, d).select(F.col("p_partkey").alias("id"), F.sha2("p_name", 256).alias("sha256"), F.col("p_size").alias("size"), F.when(F.col("p_partkey") > 0, F.floor(F.col("p_partkey") / 2)).alias("source"))
    up = c.select(F.col("id").alias("source"), F.col("sha256").alias("source_sha256"), F.col("size").alias("source_size"))
    return c.join(up, "source", "left").select("id", "sha256", "size", "source", "source_sha256", "source_size")


_add("lineage_verified", lambda s, d: st.lineage(_certificates(s, d), _part(s, d).select(F.col("p_partkey").alias("id")), 64).groupBy("root").agg(F.max("hop").alias("hops"), F.sum("size").alias("sizes")),
     "WITH RECURSIVE c(root, id, hop) AS (SELECT p_partkey, p_partkey, 0 FROM part UNION ALL SELECT root, CAST(FLOOR(id / 2) AS BIGINT), hop + 1 FROM c WHERE id > 0) SELECT root, MAX(hop) AS hops, CAST(SUM(p_size) AS BIGINT) AS sizes FROM c JOIN part ON p_partkey = id GROUP BY root")
_add("lpt_cell_batches", lambda s, d: st.dealt(st.cell_totals(fx.view(s, d, "v_cells"), Run(s, d).mols), "total", 7).groupBy("batch").agg(F.count("*").alias("cells")),
     "SELECT CAST(least((r - 1) % 14, 13 - (r - 1) % 14) AS INT) AS batch, COUNT(*) AS cells FROM (SELECT ROW_NUMBER() OVER () AS r FROM v_cells) GROUP BY 1", "v_cells")


# preparation, samples, sinks
_calls = "LEFT JOIN (SELECT DISTINCT cell AS called FROM v_cells) c ON c.called = r.cell"
def _based(s, d):
    """Reads with bases and qualities, some of them without, and every 40th record twice."""
    r = _reads(s, d).withColumn("seq", F.when(F.col("l_orderkey") % 23 != 0, "ACGT")).withColumn("qual", F.when(F.col("l_orderkey") % 29 != 0, "IIII"))
    return r.unionByName(r.where("l_orderkey % 40 = 0"))


_twice = "(SELECT *, 1 AS copy FROM v_reads UNION ALL SELECT *, 2 FROM v_reads WHERE l_orderkey % 40 = 0)"
_add("panel_filter_cascade", lambda s, d: pre.panel_reasons(_based(s, d), fx.transcripts(s, d), fx.view(s, d, "v_cells")).groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n")),
     f"""SELECT reason, COUNT(*) AS n FROM (SELECT CASE WHEN early IS NOT NULL THEN early WHEN ROW_NUMBER() OVER (PARTITION BY name, flag, chrom, pos, cigar, early IS NULL) > 1 THEN 'repeated_fetch' WHEN l_orderkey % 23 = 0 THEN 'missing_sequence' ELSE 'accepted' END AS reason FROM (
     SELECT r.*, CASE WHEN flag & 2820 <> 0 THEN 'nonprimary_or_qcfail' WHEN called IS NULL THEN 'barcode_excluded' WHEN umi = '' THEN 'missing_umi' WHEN gx IS NULL OR contains(gx, ';') OR regexp_replace(gx, '\\.[0-9]+$', '') <> gene_id THEN 'gene_assignment_excluded'
     WHEN (flag & 16 <> 0) <> (strand = '-') THEN 'antisense' END AS early FROM {_twice} r JOIN x_bounds w ON r.chrom = w.chrom AND r.pos < w.hi AND r.pos + CASE WHEN n <= 4 THEN 40 WHEN n = 5 THEN 1740 ELSE 3740 END > w.lo {_calls})) GROUP BY reason""", "v_reads", "x_bounds", "v_cells")  # fmt: skip
_add("contig_filter_cascade", lambda s, d: pre.contig_reasons(_based(s, d), fx.transcripts(s, d), fx.view(s, d, "v_cells")).groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n")),
     f"""SELECT CASE WHEN flag & 2820 <> 0 THEN 'nonprimary_or_qcfail' WHEN contains(gx, ';') THEN 'multi_gene_assignment' WHEN gx IS NULL THEN 'missing_gene_assignment' WHEN gene_id IS NULL THEN 'unselected_gene'
     WHEN r.chrom <> w.chrom OR r.pos >= w.hi OR r.pos + CASE WHEN n <= 4 THEN 40 WHEN n = 5 THEN 1740 ELSE 3740 END <= w.lo THEN 'outside_gene_locus' WHEN called IS NULL THEN 'barcode_excluded' WHEN umi = '' THEN 'missing_umi'
     WHEN (flag & 16 <> 0) <> (strand = '-') THEN 'antisense' WHEN l_orderkey % 23 = 0 THEN 'missing_sequence' ELSE 'accepted' END AS reason, COUNT(*) AS n FROM {_twice} r LEFT JOIN x_bounds w ON regexp_replace(gx, '\\.[0-9]+$', '') = w.gene_id {_calls} GROUP BY 1""", "v_reads", "x_bounds", "v_cells")  # fmt: skip
_add("pseudobulk_filter", lambda s, d: pre.pseudobulk_reasons(_based(s, d), fx.view(s, d, "v_cells")).groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n")),
     f"SELECT CASE WHEN flag & 2820 <> 0 THEN 'nonprimary_or_unmapped' WHEN called IS NULL THEN 'barcode_excluded' WHEN umi = '' THEN 'missing_umi' WHEN l_orderkey % 23 = 0 OR l_orderkey % 29 = 0 THEN 'missing_sequence_or_quality' ELSE 'accepted' END AS reason, COUNT(*) AS n FROM {_twice} r {_calls} GROUP BY 1", "v_reads", "v_cells")
_add("write_pseudobulk_fastq", lambda s, d: pre.fastq(_part(s, d).select(F.concat(F.lit("r"), "p_partkey").alias("name"), _seq("p_partkey").alias("seq"), F.lit(None).cast("string").alias("qual"), F.when(F.col("p_size") % 2 == 0, 16).otherwise(0).alias("flag"))),
     f"SELECT concat('@r', p_partkey, chr(10), CASE WHEN p_size % 2 = 0 THEN {_rev.format(_dseq)} ELSE {_dseq} END, chr(10), '+', chr(10), repeat('I', length({_dseq}))) AS value FROM part")


def _chunks(s, d):
    """Five contigs of repeated ACGGT, as long as the catalog needs, in chunks."""
    n = fx.view(s, d, "v_exon").agg((F.floor(F.max("b") / 20_000) + 1).alias("n"))
    return s.range(5).crossJoin(n).select(F.concat(F.lit("chr"), "id").alias("chrom"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("chunk"), F.repeat(F.lit("ACGGT"), 4000).alias("seq"))


_add("export_transcriptome", lambda s, d: cat.spliced(fx.transcripts(s, d), _chunks(s, d)).select("id", "seq"),
     """SELECT id, CASE WHEN strand = '+' THEN seq ELSE reverse(translate(seq, 'ACGT', 'TGCA')) END AS seq FROM (SELECT id, ANY_VALUE(strand) AS strand,
     string_agg(substr(repeat('ACGGT', CAST(2 + (b - a) / 5 AS INT)), CAST(a % 5 + 1 AS INT), CAST(b - a AS INT)), '' ORDER BY a) AS seq FROM v_exon GROUP BY id)""", "v_exon")  # fmt: skip
_add("write_matrix_market", lambda s, d: sinks.matrix_lines(Run(s, d).mols.groupBy("cell", F.col("gene_id").alias("id")).agg(F.count("*").cast("double").alias("count")), fx.view(s, d, "v_cells"), fx.transcripts(s, d).select(F.col("gene_id").alias("id"))),
     """SELECT r, c, CAST(n AS DOUBLE) AS value FROM (SELECT cell, gene_id, COUNT(*) AS n FROM o_mol GROUP BY ALL) JOIN (SELECT cell, CAST(ROW_NUMBER() OVER (ORDER BY cell) AS INT) AS r FROM (SELECT DISTINCT cell FROM v_cells)) USING (cell)
     JOIN (SELECT gene_id, CAST(ROW_NUMBER() OVER (ORDER BY gene_id) AS INT) AS c FROM (SELECT DISTINCT gene_id FROM v_meta)) USING (gene_id)""", "o_mol", "v_cells", "v_meta")  # fmt: skip
_add("write_flnc_fasta", lambda s, d: pre.fasta(_part(s, d).select(F.concat(F.lit("r"), "p_partkey").alias("name"), _seq("p_partkey").alias("seq")), _part(s, d).where("p_size > 25").select(F.concat(F.lit("r"), "p_partkey").alias("name"))), f"SELECT concat('>r', p_partkey, chr(10), {_dseq}) AS value FROM part WHERE p_size > 25")
_add("validate_samples", lambda s, d: pre.sheet_reasons(_part(s, d).select(F.concat(F.when(F.col("p_size") % 5 == 0, "_").otherwise("s"), F.col("p_partkey").cast("string")).alias("sample"), F.lit("x.bam;y.bam").alias("pacbio_bams"), F.when(F.col("p_size") % 3 == 0, "hifi").otherwise("flnc").alias("pacbio_stage"), F.lit("").alias("primers"), F.lit("f").alias("fastq_dir"), F.when(F.col("p_size") % 7 == 0, "a;a").otherwise("a;b").alias("fastq_sample"), F.lit("SC3Pv3").alias("chemistry"))).select("sample", F.coalesce("reason", F.lit("ok")).alias("reason")),
     "SELECT concat(CASE WHEN p_size % 5 = 0 THEN '_' ELSE 's' END, p_partkey) AS sample, CASE WHEN p_size % 5 = 0 THEN 'invalid sample identifier' WHEN p_size % 7 = 0 THEN 'duplicate fastq_sample prefix' WHEN p_size % 3 = 0 THEN 'hifi requires primers' ELSE 'ok' END AS reason FROM part")
_add("barcode_align", lambda s, d: (lambda n: st.aligned(n, staged(st.whitelisted(_reads(s, d), n).groupBy("cell").agg(F.count_if(F.col("mapq") > 30).alias("other")), "others")))(staged(Run(s, d).mols.groupBy("cell").agg(F.count("*").alias("total")), "totals")), "SELECT cell, total, other FROM (SELECT cell, COUNT(*) AS total FROM o_mol GROUP BY cell) JOIN (SELECT cell, COUNT(*) FILTER (mapq > 30) AS other FROM v_reads GROUP BY cell) USING (cell)", "o_mol", "v_reads")
_add("even_subsample", lambda s, d: inf.even_subsample(_part(s, d).select(F.col("p_partkey").alias("v")), 50).select("v"), "SELECT v FROM (SELECT p_partkey AS v, ROW_NUMBER() OVER (ORDER BY p_partkey) - 1 AS r, COUNT(*) OVER () AS n FROM part) WHERE r IN (SELECT CAST(FLOOR(i * (n - 1) / 49) AS BIGINT) FROM range(50) t(i))")
