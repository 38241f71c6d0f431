"""Sets of cells, genes and ids; supports and totals; lineage of shared inputs; work dealt by cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import genomics as g
from ..sources.text import require
from ..storage import staged


def whitelisted(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """rows of the cells (cell)."""
    return rows.join(cells.select("cell"), "cell", "left_semi")


def missing(wanted: DataFrame, found: DataFrame, key: str = "cell") -> DataFrame:
    """Distinct keys of `wanted` that `found` lacks."""
    return wanted.select(key).distinct().join(found.select(key), key, "left_anti")


def unexpected(expected: DataFrame, found: DataFrame, key: str = "cell") -> DataFrame:
    """(id, side): keys that only one side has, `missing` from found or `unexpected` in it."""
    a = expected.select(F.col(key).alias("id")).distinct().withColumn("_a", F.lit(1))
    b = found.select(F.col(key).alias("id")).distinct().withColumn("_b", F.lit(1))
    return a.join(b, "id", "full_outer").where("_a IS NULL OR _b IS NULL").select("id", F.when(F.col("_b").isNull(), "missing").otherwise("unexpected").alias("side"))


def in_all(key: str, *frames: DataFrame) -> DataFrame:
    """Distinct keys that every frame has."""
    out = frames[0].select(key).distinct()
    for f in frames[1:]:
        out = out.join(f.select(key), key, "left_semi")
    return out


def in_any(key: str, *frames: DataFrame) -> DataFrame:
    """Distinct keys that any frame has."""
    out = frames[0].select(key)
    for f in frames[1:]:
        out = out.unionByName(f.select(key))
    return out.distinct()


def shared(left: DataFrame, right: DataFrame, key: str = "name") -> DataFrame:
    """One row (shared): how many distinct keys both sides have."""
    return in_all(key, left, right).agg(F.count("*").alias("shared"))


def require_disjoint(left: DataFrame, right: DataFrame, key: str = "name") -> None:
    """Raises if a key stands on both sides (reads that trained a model must not test it)."""
    n = shared(left, right, key).first()["shared"]
    if n:
        raise ValueError(f"{n} values of {key} are on both sides")


def aligned(left: DataFrame, right: DataFrame, key: str = "cell") -> DataFrame:
    """The columns of both sides by key; keys that repeat, and sets of keys that differ, raise."""
    for side, name in ((left, "left"), (right, "right")):
        twice = side.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1).first()
        if twice is not None:
            raise ValueError(f"{key} {twice[key]} repeats on the {name} side")
    odd = unexpected(left, right, key).groupBy().agg(F.count_if(F.col("side") == "missing").alias("m"), F.count_if(F.col("side") == "unexpected").alias("u")).first()
    if odd["m"] or odd["u"]:
        raise ValueError(f"both sides must have the same {key}s: {odd['m']} missing, {odd['u']} unexpected")
    return left.join(right, key)


def cell_totals(cells: DataFrame, mols: DataFrame) -> DataFrame:
    """(cell, total): molecules of every cell, 0 included."""
    n = mols.groupBy("cell").agg(F.count("*").alias("n"))
    return cells.select("cell").join(n, "cell", "left").select("cell", F.coalesce("n", F.lit(0)).alias("total"))


def gene_totals(mols: DataFrame) -> DataFrame:
    """(cell, gene_id, total)."""
    return mols.groupBy("cell", "gene_id").agg(F.count("*").alias("total"))


def zero_cells(cells: DataFrame, mols: DataFrame) -> DataFrame:
    """Cells without a molecule."""
    return cells.join(mols.select("cell"), "cell", "left_anti")


def active_cells(mols: DataFrame, least: int = 2) -> DataFrame:
    """Cells with molecules of at least `least` genes."""
    return mols.groupBy("cell").agg(F.countDistinct("gene_id").alias("genes")).where(F.col("genes") >= least).select("cell")


def single_model_genes(fits: DataFrame) -> DataFrame:
    """Genes of which molecules fit one transcript only; fits: (gene_id, id) of compatible pairs."""
    return fits.groupBy("gene_id").agg(F.countDistinct("id").alias("n")).where("n = 1").select("gene_id")


def ids_under_several_cells(reads: DataFrame, name: str = "name") -> DataFrame:
    """(up, cells): upstream read ids (the name before its first /) that come under more than one cell."""
    return reads.groupBy(g.upstream_read_id(F.col(name)).alias("up")).agg(F.countDistinct("cell").alias("cells")).where("cells > 1")


def require_one_cell(reads: DataFrame, name: str = "name") -> None:
    bad = ids_under_several_cells(reads, name).first()
    if bad is not None:
        raise ValueError(f"read id {bad['up']} is under {bad['cells']} cells")


def molecule_support(records: DataFrame, probability: str = "probability") -> DataFrame:
    """(cell, gene_id, candidates, positive): distinct UMIs, and those with a positive probability."""
    return records.groupBy("cell", "gene_id").agg(F.countDistinct("umi").alias("candidates"), F.countDistinct(F.when(F.col(probability) > 0, F.col("umi"))).alias("positive"))


def resources(records: DataFrame, stage: str = "stage") -> DataFrame:
    """(stage, seconds, peak) of records (stage, seconds, rss): time summed, memory at its highest."""
    return records.groupBy(stage).agg(F.sum("seconds").alias("seconds"), F.max("rss").alias("peak"))


def external_scale(estimates: DataFrame, support: DataFrame, digits: int = 3) -> DataFrame:
    """(cell, gene_id, id, count): an external EM's shares, rounded to `digits`, times the molecules with support of the cell and gene.

    Shares outside 0 to 1 raise; a cell and gene without support raises.
    """
    e = require(estimates, F.col("share").between(0, 1), "share is not within 0 and 1:", "cell", "id")
    both = e.join(support.select("cell", "gene_id", "positive"), ["cell", "gene_id"], "left")
    both = require(both, F.col("positive").isNotNull(), "no support for", "cell", "gene_id")
    return both.select("cell", "gene_id", "id", (F.round("share", digits) * F.col("positive")).alias("count"))


def lineage(certificates: DataFrame, roots: DataFrame, most: int = 16) -> DataFrame:
    """(root, hop, id, sha256, size) of every certificate that the roots (id) descend from, hop by hop, roots at hop 0.

    certificates: (id, sha256, size, source, source_sha256, source_size); a null source ends a chain.  One join a hop for
    all chains together.  A source that is not there, one whose hash or size is not what its descendant has declared, a
    chain that comes back to where it was, and one of more than `most` hops raise.
    """
    certificates = staged(certificates, "certificates")
    twice = certificates.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").first()
    if twice is not None:
        raise ValueError(f"certificate {twice['id']} is there twice")
    here = roots.select(F.col("id").alias("root")).distinct().join(certificates, F.col("root") == F.col("id"), "left")
    here = require(here, F.col("id").isNotNull(), "no certificate of", "root").withColumn("seen", F.array("id"))
    here = staged(here, "lineage")
    found, hop = [here.withColumn("hop", F.lit(0))], 0
    # merged, not broadcast at every hop through the driver
    above = certificates.select(*[F.col(c).alias(f"up_{c}") for c in certificates.columns]).hint("merge")
    while here.where("source IS NOT NULL").limit(1).count():
        hop += 1
        if hop > most:
            bad = here.where("source IS NOT NULL").first()
            raise ValueError(f"lineage of {bad['root']} exceeds {most} hops")
        up = here.where("source IS NOT NULL").join(above, F.col("source") == F.col("up_id"), "left")
        up = require(up, F.col("up_id").isNotNull(), "source is missing:", "root", "source")
        up = require(up, F.col("source_sha256").eqNullSafe(F.col("up_sha256")) & F.col("source_size").eqNullSafe(F.col("up_size")), "source has changed:", "root", "source")
        up = require(up, ~F.array_contains("seen", F.col("up_id")), "lineage contains a cycle:", "root", "source")
        here = staged(up.select("root", *[F.col(f"up_{c}").alias(c) for c in certificates.columns], F.concat("seen", F.array("up_id")).alias("seen")), "lineage")
        found.append(here.withColumn("hop", F.lit(hop)))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.select("root", "hop", "id", "sha256", "size")


def descends_from(certificates: DataFrame, roots: DataFrame, wanted: DataFrame, most: int = 16) -> DataFrame:
    """(root, reached): whether a fully verified lineage holds a wanted (id, sha256, size), the root itself not counting."""
    chain = lineage(certificates, roots, most).where("hop > 0")
    hits = chain.join(wanted.select("id", "sha256", "size"), ["id", "sha256", "size"], "left_semi").select("root").distinct().withColumn("reached", F.lit(True))
    return roots.select(F.col("id").alias("root")).distinct().join(hits, "root", "left").select("root", F.coalesce("reached", F.lit(False)).alias("reached"))


def dealt(rows: DataFrame, cost: str, batches: int) -> DataFrame:
    """rows with `batch`, so that batches cost about the same: by falling cost, forth and back over the batches.

    Places come from ranges, so no task sees all rows.  No two batches differ by more than the largest cost.
    """
    from ..storage import numbered

    if batches < 1:
        raise ValueError("at least one batch is needed")
    placed = numbered(rows.withColumn("_c", F.coalesce(F.col(cost), F.lit(0))), "_place", F.desc("_c"))
    k = (F.col("_place") - 1) % (2 * batches)
    return placed.withColumn("batch", F.when(k < batches, k).otherwise(2 * batches - 1 - k).cast("int")).drop("_place", "_c")
