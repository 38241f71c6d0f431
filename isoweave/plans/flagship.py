"""Registered queries of the quantification core."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import genomics as g
from ..operators import inference as inf
from ..storage import staged
from . import fixtures as fx
from .oracles import sql, variants_sql


def _line(c):
    return F.array_join(F.transform(c, lambda x: F.concat_ws("-", x.a, x.b)), ";")


class Run:
    """The steps of one run, each made once per query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.tx = staged(fx.transcripts(spark, sf_dir), "catalog")
        self.reads = fx.view(spark, sf_dir, "v_reads")
        self.cells = fx.view(spark, sf_dir, "v_cells")
        self.sr = fx.abundance(spark, sf_dir)

    @cached_property
    def reasons(self) -> DataFrame:
        return inf.read_reasons(self.reads, self.tx, self.cells)

    @cached_property
    def mols(self) -> DataFrame:
        return staged(inf.assembled(self.reads, self.tx, self.cells), "molecules")

    @cached_property
    def samples(self) -> DataFrame:
        return staged(inf.capture_samples(inf.training_distances(self.mols, self.tx)), "samples")

    def all(self) -> dict[str, DataFrame]:
        return inf.quantify(self.mols, self.tx, self.sr, self.samples)

    def unfitted(self) -> dict[str, DataFrame]:
        """What comes before the fits."""
        return inf.likelihood_tables(self.mols, self.tx, self.sr, self.samples)


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: expected molecules per cell and isoform."""
    out = Run(spark, sf_dir).all()["counts"]
    return out.select("cell", "gene_id", F.col("id").alias("transcript_id"), F.round("count", 5).alias("expected"))


def _prior(s, d):
    return inf.hybrid_prior(fx.transcripts(s, d), fx.abundance(s, d)).select("gene_id", "id", F.round("prior", 9).alias("prior"))


def _like(s, d):
    r = Run(s, d)
    return inf.likelihoods(inf.shapes(r.mols), r.tx, r.samples).select("gene_id", _line("blocks").alias("blocks"), _line("junctions").alias("junctions"), "id", F.round("lik", 8).alias("likelihood"))


def _groups(s, d):
    return Run(s, d).unfitted()["groups"].select("gene_id", "id", F.concat("gene_id", F.lit(":group"), "grp").alias("group_id"), F.round("weight", 9).alias("weight"))


def _group_like(s, d):
    r = Run(s, d).unfitted()["group_rows"]
    return r.select("gene_id", _line("blocks").alias("blocks"), _line("junctions").alias("junctions"), F.posexplode("row").alias("i", "gl")).select("gene_id", "blocks", "junctions", (F.col("i") + 1).cast("bigint").alias("grp"), F.round("gl", 8).alias("gl"))


def _em(s, d):
    f = Run(s, d).all()["fits"]
    return f.select("gene_id", "cell", F.posexplode("fit.counts").alias("i", "c"), F.col("fit.converged").alias("converged")).select("gene_id", "cell", (F.col("i") + 1).cast("bigint").alias("grp"), F.round("c", 5).alias("group_count"), "converged")


def _gene_qc(s, d):
    r = Run(s, d)
    a = r.all()
    known = a["rows"].select(*inf.SHAPE, (F.col("total") > 0).alias("ok"))
    m = inf.marked(r.mols).select(*inf.SHAPE).join(known, inf.SHAPE).groupBy("gene_id").agg(F.count_if("ok").alias("assigned"), F.count_if(~F.col("ok")).alias("incompatible"))
    f = a["fits"].groupBy("gene_id").agg(F.count_if(~F.col("fit.converged")).alias("nonconverged"))
    return r.tx.select("gene_id").distinct().join(m, "gene_id", "left").join(f, "gene_id", "left").na.fill(0)


def _conservation(s, d):
    a = Run(s, d).all()
    one = a["fits"].select("gene_id", F.aggregate("fit.counts", F.lit(0.0), lambda t, x: t + x).alias("n")).groupBy("gene_id").agg(F.sum("n").alias("n"))
    two = a["counts"].groupBy("gene_id").agg(F.sum("count").alias("m"))
    return one.join(two, "gene_id").select("gene_id", F.round("n", 4).alias("group_total"), F.round("m", 4).alias("isoform_total"), (F.abs(F.col("n") - F.col("m")) <= 1e-6 * F.greatest(F.lit(1.0), "n")).alias("conserved"))


def _variants(s, d):
    """annotation_tes, empirical_tes and sr_only; a gene without observed ends has the annotation fit as its empirical one."""
    r = Run(s, d)
    tes = fx.view(s, d, "v_tes")
    parts, shared = [], inf.Shared(r.mols, r.tx, r.samples)
    for name, tx, ends in (("annotation_tes", r.tx, None), ("empirical_tes", r.tx, tes), ("sr_only", r.tx.withColumn("lr_count", F.lit(0.0)), None)):
        c = inf.quantify(r.mols, tx, r.sr, r.samples, tes=ends, shared=shared)["counts"]
        parts.append(c.groupBy("gene_id", F.col("id").alias("transcript_id")).agg(F.round(F.sum("count"), 3).alias("total")).withColumn("variant", F.lit(name)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _training(s, d):
    r = Run(s, d)
    return inf.training_distances(r.mols, r.tx).select("gene_id", "cell", "umi", "d")


def _density(s, d):
    r = Run(s, d)
    grid = s.range(0, 2000, 40).select(F.col("id").alias("d"))
    return grid.crossJoin(r.samples).select("d", F.round(g.kde_logpdf("d", "samples"), 8).alias("logpdf"), F.round(F.exp(g.kde_logpdf("d", "samples")), 8).alias("pdf"))


QUERIES = {
    "hybrid_prior": _prior,
    "read_filter_cascade": lambda s, d: Run(s, d).reasons.select("name", "gene_id", F.coalesce("reason", F.lit("eligible_reads")).alias("reason")),
    "qc_counters": lambda s, d: inf.qc_counts(Run(s, d).reasons),
    "molecule_assembly": lambda s, d: Run(s, d).mols.select("cell", "umi", "gene_id", _line("blocks").alias("blocks"), _line("junctions").alias("junctions")),
    "containment_join": lambda s, d: (lambda r: inf.hits(inf.shapes(r.mols), r.tx).where("fits").select("gene_id", _line("blocks").alias("blocks"), _line("junctions").alias("junctions"), "id"))(Run(s, d)),
    "unique_hits": _training,
    "reservoir_first2000": lambda s, d: Run(s, d).samples.select(F.explode("samples").alias("d")).groupBy(F.col("d").cast("bigint").alias("d")).agg(F.count("*").alias("n")),
    "kde_logpdf": _density,
    "likelihoods": _like,
    "structural_groups": lambda s, d: inf.structural_groups(fx.transcripts(s, d)).select("id", _line("terminal").alias("terminal")),
    "refine_groups": _groups,
    "group_likelihood": _group_like,
    "em": _em,
    "quantify_gene": counts,
    "gene_qc": _gene_qc,
    "conservation_check": _conservation,
    "three_variants": _variants,
}

ORACLE_SQL = {
    "hybrid_prior": sql("SELECT gene_id, id, round(prior, 9) AS prior FROM o_prior", "o_prior"),
    "read_filter_cascade": sql("SELECT name, gene_id, COALESCE(reason, 'eligible_reads') AS reason FROM o_events", "o_events"),
    "qc_counters": sql("SELECT COALESCE(reason, 'eligible_reads') AS reason, COUNT(*) AS n FROM o_events GROUP BY 1", "o_events"),
    "molecule_assembly": sql("SELECT cell, umi, gene_id, blocks, junctions FROM o_mol", "o_mol"),
    "containment_join": sql("SELECT gene_id, blocks, junctions, id FROM o_fit", "o_fit"),
    "unique_hits": sql("SELECT gene_id, cell, umi, d FROM o_train", "o_train"),
    "reservoir_first2000": sql("SELECT d, COUNT(*) AS n FROM o_samples GROUP BY d", "o_samples"),
    "kde_logpdf": sql(
        """SELECT d, round(f, 8) AS logpdf, round(exp(f), 8) AS pdf FROM (SELECT d, MAX(x) + ln(SUM(exp(x - top))) - ln(COUNT(*) / 2.0 * 30.0 * sqrt(2 * pi())) AS f FROM (
        SELECT *, MAX(x) OVER (PARTITION BY d) AS top FROM (SELECT q.d, -0.5 * pow((q.d + sgn.v * s.d) / 30.0, 2) AS x FROM (SELECT range AS d FROM range(0, 2000, 40)) q, o_samples s, (VALUES (1), (-1)) sgn(v))) GROUP BY d)""",
        "o_samples",
    ),
    "likelihoods": sql('SELECT gene_id, blocks, junctions, id, round("like", 8) AS likelihood FROM o_like', "o_like"),
    "structural_groups": sql("SELECT id, terminal FROM o_terminal", "o_terminal"),
    "refine_groups": sql("SELECT gene_id, id, concat(gene_id, ':group', grp) AS group_id, round(weight, 9) AS weight FROM o_group", "o_group"),
    "group_likelihood": sql("SELECT gene_id, blocks, junctions, grp, round(gl, 8) AS gl FROM o_grouplike", "o_grouplike"),
    "em": sql("SELECT gene_id, cell, UNNEST(range(1, len(counts) + 1)) AS grp, round(UNNEST(counts), 5) AS group_count, converged FROM o_em", "o_em"),
    "quantify_gene": sql('SELECT cell, gene_id, id AS transcript_id, round("count", 5) AS expected FROM o_counts', "o_counts"),
    "gene_qc": sql(
        """SELECT t.gene_id, COALESCE(assigned, 0) AS assigned, COALESCE(incompatible, 0) AS incompatible, COALESCE(bad, 0) AS nonconverged FROM (SELECT DISTINCT gene_id FROM v_meta) t
        LEFT JOIN (SELECT m.gene_id, COUNT(*) FILTER (total > 0) AS assigned, COUNT(*) FILTER (total <= 0) AS incompatible FROM o_mol m JOIN (SELECT gene_id, blocks, junctions, SUM(gl) AS total FROM o_grouplike GROUP BY ALL) l USING (gene_id, blocks, junctions) GROUP BY m.gene_id) a USING (gene_id)
        LEFT JOIN (SELECT gene_id, COUNT(*) FILTER (NOT converged) AS bad FROM o_em GROUP BY gene_id) b USING (gene_id)""",
        "v_meta", "o_mol", "o_grouplike", "o_em",
    ),
    "three_variants": variants_sql(),
    "conservation_check": sql(
        """SELECT gene_id, round(n, 4) AS group_total, round(m, 4) AS isoform_total, abs(n - m) <= 1e-6 * greatest(1.0, n) AS conserved FROM (SELECT gene_id, SUM(list_sum(counts)) AS n FROM o_em GROUP BY gene_id)
        JOIN (SELECT gene_id, SUM("count") AS m FROM o_counts GROUP BY gene_id) USING (gene_id)""",
        "o_em", "o_counts",
    ),
}
