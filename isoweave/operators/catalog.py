"""Transcript catalogs: reading rows, filters, gene mapping, deduplication, priors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import genomics as g
from ..sources.text import require
from ..storage import staged

#: Structural categories that are accepted.
CATEGORIES = ("full-splice_match", "incomplete-splice_match", "novel_in_catalog", "novel_not_in_catalog", "intergenic", "genic", "genic_intron")


def gtf_exons(lines: DataFrame, shift: int = 1) -> DataFrame:
    """(id, gene_id, gene_name, chrom, strand, a, b) of the exon rows of GTF or GFF3 lines (column value).

    shift 1 gives zero-based half-open intervals, 0 leaves them one-based and closed.  A line's place (seq) is kept if it has one.
    A row that has not nine columns, no transcript or a bad locus raises.
    """
    f, seq = F.split("value", "\t"), [c for c in lines.columns if c == "seq"]
    rows = lines.where((F.trim("value") != "") & ~F.col("value").startswith("#")).select(f.alias("f"), *seq)
    rows = rows.where(F.when(F.size("f") == 9, True).otherwise(F.raise_error(F.lit("expected nine columns")).cast("boolean"))).where(F.lower(F.get("f", F.lit(2))) == "exon")
    attrs = g.gtf_attributes(F.get("f", F.lit(8)))
    name = lambda k: F.try_element_at("attrs", F.lit(k))
    rows = rows.withColumn("attrs", attrs)
    tid = F.regexp_replace(F.coalesce(F.nullif(name("transcript_id"), F.lit("")), name("Parent")), "^transcript:", "")
    out = rows.select(tid.alias("id"), name("gene_id").alias("gene_id"), name("gene_name").alias("gene_name"), F.get("f", F.lit(0)).alias("chrom"), F.get("f", F.lit(6)).alias("strand"), (F.get("f", F.lit(3)).cast("bigint") - shift).alias("a"), F.get("f", F.lit(4)).cast("bigint").alias("b"), *seq)
    good = F.col("id").isNotNull() & (F.col("a") >= 0) & (F.col("b") > F.col("a") - (1 - shift)) & F.col("strand").isin("+", "-")
    return out.where(F.when(F.coalesce(good, F.lit(False)), True).otherwise(F.raise_error(F.concat_ws(" ", F.lit("invalid exon"), "id")).cast("boolean")))


def exon_chains(exons: DataFrame, *keys: str) -> DataFrame:
    return exons.groupBy("id", *keys).agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("exons"))


def violations(tx: DataFrame) -> DataFrame:
    """(id, reason) of transcripts that break a rule."""
    e = F.col("exons")
    pairs = F.zip_with(F.slice(e, 1, F.greatest(F.size(e) - 1, F.lit(0))), F.slice(e, 2, F.greatest(F.size(e) - 1, F.lit(0))), lambda x, y: x.b > y.a)
    reason = (
        F.when(~F.col("strand").isin("+", "-"), "strand")
        .when(F.size(e) < 1, "no_exons")
        .when(F.exists(e, lambda x: (x.a < 0) | (x.b <= x.a)), "exon_bounds")
        .when(F.exists(pairs, lambda x: x), "exon_overlap")
        .when((F.col("lr_count") < 0) | F.isnan("lr_count") | (F.col("lr_count") == float("inf")), "count")
    )
    return tx.select("id", reason.alias("reason")).where("reason IS NOT NULL")


def gene_aliases(reference: DataFrame) -> DataFrame:
    """(alias, chrom, strand, gene_id): ids, normalised ids and names of reference genes."""
    names = F.array_distinct(F.array("gene_id", g.normalize_gene_id("gene_id"), F.coalesce("gene_name", "gene_id")))
    return reference.select(F.explode(names).alias("alias"), "chrom", "strand", "gene_id").distinct()


def filter_reason(rts: str = "RTS_stage", canonical: str = "all_canonical") -> Column:
    """The first reason that bars a classification row, before its structure is looked at."""
    return (
        F.when(~F.coalesce(F.col("structural_category").isin(*CATEGORIES), F.lit(False)), "unsupported_category")
        .when(F.upper(F.coalesce(F.col(rts), F.lit(""))) == "TRUE", "rts")
        .when(~F.coalesce(F.col(canonical), F.lit("")).isin("", "canonical", "NA"), "noncanonical")
    )


def classified(classification: DataFrame, structures: DataFrame, aliases: DataFrame) -> DataFrame:
    """classification with `reason` (null: accepted), exons and gene_id; structures: (id, chrom, strand, exons, conflict)."""
    c = classification.withColumnRenamed("chrom", "c_chrom").withColumnRenamed("strand", "c_strand")
    c = c.join(structures.withColumnRenamed("id", "isoform"), "isoform", "left")
    wanted = F.trim(F.coalesce("associated_gene", F.lit("")))
    c = c.withColumn("plain", g.normalize_gene_id(wanted)).withColumn("asked", F.array_distinct(F.array(wanted, g.normalize_gene_id(wanted))))
    # a name may be many genes': its first and last gene tell whether it is one gene's alone
    names = aliases.groupBy("alias", "chrom", "strand").agg(F.min("gene_id").alias("lo"), F.max("gene_id").alias("hi"))
    one = c.select("isoform", "chrom", "strand", F.explode("asked").alias("alias")).join(names, ["alias", "chrom", "strand"]).groupBy("isoform").agg(F.array_distinct(F.array(F.min("lo"), F.max("hi"))).alias("hits"))
    c = c.join(one, "isoform", "left").withColumn("hits", F.coalesce("hits", F.array().cast("array<string>")))
    locus = (F.coalesce(F.nullif("c_chrom", F.lit("")), "chrom") != F.col("chrom")) | (F.coalesce(F.nullif("c_strand", F.lit("")), "strand") != F.col("strand"))
    gene = F.coalesce(F.try_element_at("hits", F.lit(1)), F.col("plain"))
    reason = F.coalesce(
        filter_reason(),
        F.when(F.col("exons").isNull() | F.coalesce("conflict", F.lit(False)), "missing_or_conflicting_structure").when(locus, "classification_locus_conflict").when(F.size("hits") > 1, "ambiguous_gene_mapping").when(gene == "", "missing_gene_mapping"),
    )
    return c.withColumn("reason", reason).withColumn("gene_id", gene)


def deduplicated(rows: DataFrame) -> DataFrame:
    """One row per (gene_id, chrom, strand, exons): id of the first reference row or else of the first, counts of the others summed, sources joined, aliases and number removed."""
    first = F.min_by("id", F.struct((F.col("source") != "reference").alias("o"), "seq"))
    return rows.groupBy("gene_id", "chrom", "strand", "exons").agg(
        first.alias("id"),
        F.sum(F.when(F.col("source") != "reference", F.col("lr_count")).otherwise(0.0)).alias("lr_count"),
        F.array_join(F.array_sort(F.collect_set("source")), "+").alias("source"),
        F.array_sort(F.collect_list("id")).alias("aliases"),
        (F.count("*") - 1).alias("removed"),
    )


def load_union(reference: DataFrame, pigeon: DataFrame, classification: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The union of a reference and classified long-read models: (catalog, aliases, outcomes).

    reference and pigeon are exon rows as gtf_exons gives them, those of the reference with their places (seq); classification
    has strings by the names of its file, of which all but isoform and structural_category may be missing, and seq.
    catalog is deduplicated, with chrom, strand and exons; aliases are (alias, id), each id that a catalog's transcript stands
    for; outcomes are (isoform, source, reason, gene_id), a row for each reference transcript and each classification row, the
    reason null where it is in the catalog.  A reference transcript without a gene or on several loci, an isoform that is
    classified twice, an invalid or negative fl_assoc, and an id with several genes, loci or structures raise.
    """
    chain, at = F.array_sort(F.collect_set(F.struct("a", "b"))).alias("exons"), F.struct("chrom", "strand")
    known = require(reference, F.col("gene_id").isNotNull(), "reference transcript lacks gene_id:", "id").withColumn("gene_id", F.trim("gene_id"))
    models = known.groupBy("id", "gene_id").agg(F.min(at).alias("at"), F.max(at).alias("to"), chain, F.min("seq").alias("seq"))
    models = require(models, F.col("at") == F.col("to"), "transcript spans loci:", "id").select("id", "gene_id", "at.chrom", "at.strand", "exons", F.lit(0.0).alias("lr_count"), F.lit("reference").alias("source"), "seq")
    structures = pigeon.groupBy("id").agg(F.min(at).alias("at"), F.max(at).alias("to"), chain).select("id", "at.chrom", "at.strand", "exons", (F.col("at") != F.col("to")).alias("conflict"))
    for name in ("RTS_stage", "all_canonical", "associated_gene", "chrom", "strand", "fl_assoc"):
        if name not in classification.columns:
            classification = classification.withColumn(name, F.lit(""))
    fields = [c for c in classification.columns if c != "isoform"]
    once = classification.groupBy("isoform").agg(F.min(F.struct(*fields)).alias("r"), F.count("*").alias("n"))
    once = require(once, F.col("n") == 1, "duplicate Pigeon classification row:", "isoform").select("isoform", "r.*")
    c = classified(once, structures, gene_aliases(known.select("gene_id", "gene_name", "chrom", "strand").distinct()))
    c = c.withColumn("lr_count", F.coalesce(F.nullif(F.trim("fl_assoc"), F.lit("")), F.lit("0")).try_cast("double"))
    c = require(c, F.col("reason").isNotNull() | (F.col("lr_count") >= 0), "invalid or negative fl_assoc:", "isoform")
    c = staged(c.select(F.col("isoform").alias("id"), "gene_id", "chrom", "strand", "exons", "lr_count", F.lit("pigeon").alias("source"), "seq", "reason"), "classified")
    rows = models.unionByName(c.where("reason IS NULL").drop("reason"))
    identity, w = F.struct("gene_id", "chrom", "strand", "exons"), Window.partitionBy("id")
    rows = rows.withColumn("lo", F.min(identity).over(w)).withColumn("hi", F.max(identity).over(w))
    rows = require(rows, F.col("lo") == F.col("hi"), "transcript ID has conflicting gene, locus, or structure:", "id").drop("lo", "hi")
    catalog = staged(deduplicated(rows), "catalog")
    aliases = catalog.select(F.explode(F.array_distinct("aliases")).alias("alias"), "id")
    outcome = lambda df, reason: df.select(F.col("id").alias("isoform"), "source", reason.alias("reason"), "gene_id")
    return catalog, aliases, outcome(models, F.lit(None).cast("string")).unionByName(outcome(c, F.col("reason")))


def identity_conflicts(rows: DataFrame) -> DataFrame:
    """Ids that stand for more than one gene, locus or structure."""
    return rows.select("id", "gene_id", "chrom", "strand", "exons").distinct().groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def alias_sum(quant: DataFrame, aliases: DataFrame, tx: DataFrame) -> DataFrame:
    """(id, value): abundances summed over aliases; every transcript has a row."""
    named = quant.join(aliases, quant.name == aliases["alias"], "left").select(F.coalesce("id", "name").alias("id"), "value")
    return tx.select("id").join(named.groupBy("id").agg(F.sum("value").alias("value")), "id", "left").na.fill(0.0, ["value"])


def over_budget(mols: DataFrame, tx: DataFrame, most: int = 10_000_000) -> DataFrame:
    """(gene_id, entries) of the genes whose likelihood matrix would exceed the budget; 0 sets none."""
    n = mols.groupBy("gene_id").agg(F.count("*").alias("m")).join(tx.groupBy("gene_id").agg(F.count("*").alias("t")), "gene_id")
    out = n.select("gene_id", (F.col("m") * F.col("t")).alias("entries"))
    return out.where(F.col("entries") > most) if most else out.limit(0)


def selected_genes(tokens: DataFrame, aliases: DataFrame) -> DataFrame:
    """(token, gene_id) through names that are one gene's alone; gene_id null where a token is unknown."""
    alone = aliases.groupBy("alias").agg(F.countDistinct("gene_id").alias("n"), F.min("gene_id").alias("gene_id")).where("n = 1").drop("n")
    return tokens.join(alone, tokens.token == alone["alias"], "left").select("token", "gene_id")


def tpm_fraction(quant: DataFrame) -> DataFrame:
    """(TPM + 1) over the gene's sum of (TPM + 1)."""
    w = Window.partitionBy("gene_id")
    return quant.withColumn("fraction", (F.col("tpm") + 1) / F.sum(F.col("tpm") + 1).over(w))


def gtf_lines(tx: DataFrame) -> DataFrame:
    """Exon rows of a catalog as GTF lines, one-based and closed, with keys to order them by."""
    named = [c for c in tx.columns if c == "gene_name"]
    e = tx.select("id", "gene_id", "chrom", "strand", "source", *named, F.posexplode("exons").alias("n", "e"))
    attrs = F.format_string('gene_id "%s"; transcript_id "%s";' + ' gene_name "%s";' * len(named), "gene_id", "id", *named)
    return e.select("id", "n", F.concat_ws("\t", "chrom", "source", F.lit("exon"), (F.col("e.a") + 1).cast("string"), F.col("e.b").cast("string"), F.lit("."), "strand", F.lit("."), attrs).alias("value"))


def chunked(contigs: DataFrame, width: int = 20_000) -> DataFrame:
    """(chrom, chunk, seq): contigs in pieces of `width` bases, so that exons fetch short strings, whatever the contig's length."""
    n = F.ceil(F.length("seq") / width)
    c = contigs.where(F.length("seq") > 0).select("chrom", "seq", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)).alias("chunk"))
    return c.select("chrom", "chunk", F.substring(F.col("seq"), (F.col("chunk") * width + 1).cast("int"), F.lit(width)).alias("seq"))


def spliced(tx: DataFrame, chunks: DataFrame, width: int = 20_000) -> DataFrame:
    """(id, seq): exon bases in transcript orientation from chunked contigs; an exon beyond its contig raises."""
    e = tx.select("id", "chrom", "strand", F.posexplode("exons").alias("n", "e"))
    e = e.select("id", "chrom", "strand", "n", "e.a", "e.b", F.explode(F.sequence(F.floor(F.col("e.a") / width), F.floor((F.col("e.b") - 1) / width))).alias("chunk"))
    first = F.greatest(F.col("a") - F.col("chunk") * width, F.lit(0))
    last = F.least(F.col("b") - F.col("chunk") * width, F.lit(width))
    # chunks are a genome: their size is not seen before they are made, and no driver holds them
    p = e.join(chunks.select("chrom", "chunk", "seq").hint("merge"), ["chrom", "chunk"], "left").withColumn("part", F.coalesce(F.substring(F.col("seq"), (first + 1).cast("int"), (last - first).cast("int")), F.lit("")))
    whole = p.groupBy("id", "strand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "chunk", "part"))), lambda x: x.part), "").alias("seq"), F.sum(last - first).alias("bases"))
    good = F.when(F.length("seq") == F.col("bases"), F.col("seq")).otherwise(F.raise_error(F.concat_ws(" ", "id", F.lit("leaves its contig"))).cast("string"))
    return whole.select("id", F.when(F.col("strand") == "+", good).otherwise(g.reverse_complement(good)).alias("seq"))


def spliced_from(tx: DataFrame, path: str) -> DataFrame:
    """(id, seq): exon bases in transcript orientation, fetched from an indexed FASTA; an exon beyond its contig raises."""
    from ..sources import fasta

    e = tx.select("id", "chrom", "strand", F.posexplode("exons").alias("n", "e")).select("id", "chrom", "strand", "n", F.col("e.a").alias("start"), F.col("e.b").alias("end"))
    whole = fasta.fetch(e, path).groupBy("id", "strand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "seq"))), lambda x: x.seq), "").alias("seq"))
    return whole.select("id", F.when(F.col("strand") == "+", F.col("seq")).otherwise(g.reverse_complement("seq")).alias("seq"))
