"""What keeps a query's work in step with its input: plans, and results that must not change by it."""

import numpy as np
from pyspark.sql import functions as F

from isoweave.functions import genomics as g
from isoweave.operators import catalog, evaluate, inference
from isoweave.plans import fixtures as fx

DATA = "/root/testdata/sf0.001"


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_attributes_are_searched_once(spark):
    df = spark.createDataFrame([('gene_id "a"; gene_id "b"; k=1;k=2;gene_id=c; x = y ',)], "t string").select(g.gtf_attributes("t").alias("m"))
    assert plan(df).count("regexp_extract_all") == 2
    assert df.first()["m"] == {"gene_id": "b", "k": "1", "x ": " y"}


def test_molecules_without_reasons(spark):
    reads, tx, cells = fx.view(spark, DATA, "v_reads"), fx.transcripts(spark, DATA), fx.view(spark, DATA, "v_cells")
    short, whole = (df.select("cell", "umi", "gene_id", F.to_json("blocks"), F.to_json("junctions")).collect() for df in (inference.assembled(reads, tx, cells), inference.molecules(inference.read_reasons(reads, tx, cells))))
    assert len(short) > 1000 and sorted(short) == sorted(whole)


def test_likelihoods_stay_in_the_rows_of_their_shapes(spark):
    tx, tes = fx.transcripts(spark, DATA), fx.view(spark, DATA, "v_tes")
    mols = inference.assembled(fx.view(spark, DATA, "v_reads"), tx, fx.view(spark, DATA, "v_cells"))
    samples = spark.createDataFrame([([10.0, 200.0],)], "samples array<double>")
    rows = inference.shape_likelihoods(inference.marked(inference.shapes(mols)), tx, samples, tes)
    assert "Window" not in plan(rows)
    top = rows.groupBy(*inference.SHAPE).agg(F.max("lik").alias("m"), F.count("*").alias("n")).agg(F.min("n"), F.max("n"), F.count_if((F.col("m") != 0) & (F.col("m") != 1))).first()
    assert tuple(top) == (5, 5, 0)


def test_names_of_many_genes_are_not_gathered(spark):
    aliases = spark.createDataFrame([("N", "c", "+", f"g{k}") for k in range(50)] + [("M", "c", "+", "g7")], "alias string, chrom string, strand string, gene_id string")
    c = spark.createDataFrame([("p", "genic", "", "", "N", "", ""), ("q", "genic", "", "", "M", "", "")], "isoform string, structural_category string, RTS_stage string, all_canonical string, associated_gene string, chrom string, strand string")
    s = spark.createDataFrame([("p", "c", "+", [(1, 2)], False), ("q", "c", "+", [(1, 2)], False)], "id string, chrom string, strand string, exons array<struct<a:bigint,b:bigint>>, conflict boolean")
    got = catalog.classified(c, s, aliases)
    assert "collect_set" not in plan(got)
    assert {r["isoform"]: (r["reason"], r["gene_id"]) for r in got.collect() if r["isoform"] == "q"} == {"q": (None, "g7")}
    assert got.where("isoform = 'p'").first()["reason"] == "ambiguous_gene_mapping"


def test_genome_is_not_broadcast(spark):
    tx = spark.createDataFrame([("t", "c", "+", [(1, 5)])], "id string, chrom string, strand string, exons array<struct<a:bigint,b:bigint>>")
    chunks = spark.range(1).select(F.lit("c").alias("chrom"), F.lit(0).cast("bigint").alias("chunk"), F.repeat(F.lit("ACGGT"), 4000).alias("seq"))
    got = catalog.spliced(tx, chunks)
    assert "BroadcastHashJoin" not in plan(got, "executedPlan") and got.first()["seq"] == "CGGT"


def test_silhouette_of_near_copies(spark):
    r = np.random.default_rng(3)
    x = np.repeat(r.standard_normal((30, 8)) * 1000, 3, 0) + r.standard_normal((90, 8)) * 1e-6
    label = np.arange(90) % 4
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    sums = np.stack([gap[:, label == k].sum(1) for k in range(4)], 1)
    n = np.bincount(label)
    own = sums[np.arange(90), label] / (n[label] - 1)
    rest = np.where(np.arange(4) == label[:, None], np.inf, sums / n).min(1)
    want = (rest - own) / np.maximum(own, rest)
    df = spark.createDataFrame([(k, x[k].tolist(), int(label[k])) for k in range(90)], "id long, x array<double>, label long")
    got = {row["id"]: row["s"] for row in evaluate.silhouette(df, 32).collect()}
    assert np.allclose([got[k] for k in range(90)], want, atol=1e-9)


def test_basis_is_cut_back_to_fit_the_driver(spark, monkeypatch):
    """Vectors that don't fit BLOCKS times over are found with fewer blocks, the same ones; before, they were refused."""
    from isoweave.operators import embed

    x = np.random.default_rng(2).standard_normal((60, 40)) * np.geomspace(1, 1e-2, 40)
    rows, features = embed.dense_rows(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id long, x array<double>"))
    monkeypatch.setattr(embed, "BOUND", 40 * 10 * 2 * 4)
    values, vectors = embed.right_vectors(rows, features, 2)
    assert np.allclose(values, np.linalg.svd(x)[1][:2]) and np.allclose(x @ vectors @ vectors.T @ vectors, x @ vectors)


def test_calls_are_resolved_in_the_read_itself(spark):
    """Names meet genes without a pass over all reads for their distinct texts; ids with versions, shared plain names and lists keep their rules."""
    tx = spark.createDataFrame([(f"t{k}", gene, "c", "+", [(0, 100)]) for k, gene in enumerate(("ENSG1", "ENSG2.3", "ENSG4.1", "ENSG4.2", "ENSG5", "ENSG5.1", "odd.1"))], "id string, gene_id string, chrom string, strand string, exons array<struct<a:bigint,b:bigint>>")
    names = ["ENSG1", "ENSG1.9", " ENSG1", "ENSG2", "ENSG2.3", "ENSG2.7", "ENSG4", "ENSG4.1", "ENSG4.9", "ENSG5", "ENSG5.1", "ENSG5.2", "odd.1", "odd", ";ENSG1.2;", "ENSG1;ENSG2", ";", " ", None]
    reads = spark.createDataFrame([(str(k), "C", f"U{k}", gx, 0, "c", 5, "10M" if k % 2 else "2S3M4N5M1H") for k, gx in enumerate(names)], "name string, cell string, umi string, gx string, flag int, chrom string, pos long, cigar string")
    cells = spark.createDataFrame([("C",)], "cell string")
    short, whole = inference.assembled(reads, tx, cells), inference.molecules(inference.read_reasons(reads, tx, cells))
    flat = [sorted(df.select("umi", "gene_id", F.to_json("blocks"), F.to_json("junctions")).collect()) for df in (short, whole)]
    assert flat[0] == flat[1] and len(flat[0]) > 8
    assert plan(short).count("LogicalRDD") + plan(short).count("LocalRelation") < plan(whole).count("LogicalRDD") + plan(whole).count("LocalRelation")


def test_simple_shapes_are_those_of_the_walk(spark):
    rows = [(p, c) for p in (0, 7) for c in ("40M", "20M1700N20M", "5S20=", "3H5S20=30N9X4S2H", "0M", "5M0N5M", "5M3N0M", "", "*", None, "10M5I10M", "10M5N", "7S", "5M3N2M4N1M")]
    df = spark.createDataFrame(rows, "pos long, cigar string")
    assert all(r["a"] == r["b"] for r in df.select(g.cigar_shape("pos", "cigar").alias("a"), g._walk("pos", "cigar", ("M", "=", "X"), ("D",)).alias("b")).collect())


def test_groups_are_told_apart_without_the_fits(spark, monkeypatch):
    from isoweave.plans import flagship

    monkeypatch.setattr(inference, "fit_cells", lambda *_, **__: 1 / 0)
    got = flagship.QUERIES["refine_groups"](spark, DATA)
    assert got.count() > 100 and "decimal(38" not in plan(got)


def test_fits_and_counts_travel_once(spark):
    mols = spark.createDataFrame([("C", "G", 1, 2), ("D", "G", 1, 2)], "cell string, gene_id string, s1 long, s2 long")
    rows = spark.createDataFrame([("G", 1, 2, [0.5, 1.0], 1.5)], "gene_id string, s1 long, s2 long, row array<double>, total double")
    groups = spark.createDataFrame([("G", "a", 0.5, 1, 1.0), ("G", "b", 0.25, 2, 0.5), ("G", "c", 0.25, 2, 0.5)], "gene_id string, id string, prior double, grp int, weight double")
    fits = inference.fit_cells(mols, rows, groups)
    counts = inference.isoform_counts(fits, groups)
    assert plan(fits).count("Join") == 2 and plan(counts).count("Join") == 3
    assert abs(counts.agg(F.sum("count")).first()[0] - 2) < 1e-9 and counts.count() == 6


def test_reservoir_sorts_what_meets_a_chosen_row(spark, monkeypatch):
    seen, real = [], inference.numbered
    monkeypatch.setattr(inference, "numbered", lambda df, *a: seen.append(df.count()) or real(df, *a))
    values = spark.range(10_000).select((F.col("id") % 500).alias("lead"), F.xxhash64("id").alias("v"), "id")
    got = {r["slot"]: r["id"] for r in inference.reservoir(values, ["lead", "v"], 20, 3).collect()}
    ordered = [r["id"] for r in values.orderBy("lead", "v").collect()]
    assert got == {k: ordered[p - 1] for k, p in enumerate(inference.reservoir_places(10_000, 20, 3))}
    assert seen[0] <= 20 * 20


def test_silhouette_ships_no_pairs(spark, monkeypatch):
    """Tiles meet without a shuffle of their pairs; results don't depend on tiles, nor on when a task passes its sums on."""
    x = np.random.default_rng(4).standard_normal((300, 5))
    label = np.arange(300) ** 2 % 7  # 0, 1, 2, 4
    label[299] = 3  # a label of one point
    df = spark.createDataFrame([(f"p{k}", x[k].tolist(), int(label[k])) for k in range(300)], "id string, x array<double>, label int")
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    means = lambda k, own: np.array([gap[k, (label == c) & (np.arange(300) != k)].mean() for c in sorted(set(label)) if (c == label[k]) == own])
    want = [0.0 if label[k] == 3 else ((o := means(k, False).min()) - (w := means(k, True)[0])) / max(o, w) for k in range(300)]
    meet = plan(evaluate.silhouette(df, 20), "executedPlan")
    assert "CartesianProduct" in meet and "Exchange" not in meet[meet.index("MapInArrow"):meet.index("CartesianProduct")]
    for held, block in ((1 << 22, 20), (100, 30), (1 << 22, 1024)):
        monkeypatch.setattr(evaluate, "HELD", held)
        got = {r["id"]: r["s"] for r in evaluate.silhouette(df, block).collect()}
        assert np.allclose([got[f"p{k}"] for k in range(300)], want, atol=1e-9)
    assert evaluate.silhouette(df.limit(0)).count() == 0


def test_passes_over_wide_rows_shuffle_nothing(spark, monkeypatch):
    """Rows that are fewer than features meet a block by row and by feature; where a block as long as they are is too much, sums are shuffled. Both give the same."""
    from isoweave.operators import embed

    r = np.random.default_rng(6)
    x = np.where(r.random((40, 90)) < 0.2, r.random((40, 90)), 0)
    x[7] = 0
    rows = spark.createDataFrame([(f"c{k}", np.flatnonzero(v).tolist(), v[v != 0].tolist()) for k, v in enumerate(x)], "cell string, idx array<int>, val array<double>")
    monkeypatch.setattr(embed, "BLOCKS", 3)  # starts anew now and then
    real, used = embed._gram_times, []
    monkeypatch.setattr(embed, "_gram_times", lambda *a: used.append(1) or real(*a))
    one = embed.right_vectors(rows, 90, 3)
    assert not used
    monkeypatch.setattr(embed, "BLOCK", 0)
    two = embed.right_vectors(rows, 90, 3)
    assert used and np.allclose(one[0], np.linalg.svd(x)[1][:3]) and np.allclose(one[0], two[0]) and np.allclose(one[1], two[1], atol=1e-7)


def test_variants_share_what_priors_do_not_touch(spark, monkeypatch):
    """Shapes are told apart once, and likelihoods of annotated ends worked out once, for all variants."""
    from isoweave.plans import flagship

    seen, real = [], inference.packed_likelihoods
    monkeypatch.setattr(inference, "packed_likelihoods", lambda shapes, tx, samples, tes=None, *a: seen.append((shapes, tes is None)) or real(shapes, tx, samples, tes, *a))
    got = flagship.QUERIES["three_variants"](spark, DATA)
    assert sorted(plain for _, plain in seen) == [False, True] and len({id(s) for s, _ in seen}) == 1
    assert {r["variant"] for r in got.select("variant").distinct().collect()} == {"annotation_tes", "empirical_tes", "sr_only"}


def test_ends_that_cross_the_terminal_exon(spark):
    """Ends beyond the inner edge, or before the molecule's boundary, have no part, but keep their share of the weight."""
    tx = spark.createDataFrame([("G", "p", "+", [(0, 100), (200, 300)]), ("G", "m", "-", [(0, 100), (200, 300)])], "gene_id string, id string, strand string, exons array<struct<a:bigint,b:bigint>>")
    tes = spark.createDataFrame([("p", 290, 1.0), ("p", 150, 2.0), ("p", 230, 1.0), ("m", 20, 1.0), ("m", 120, 3.0)], "id string, tes long, weight double")
    shapes = inference.marked(spark.createDataFrame([("G", [(210, 250)], []), ("G", [(30, 60)], [])], "gene_id string, blocks array<struct<a:bigint,b:bigint>>, junctions array<struct<a:bigint,b:bigint>>"))
    samples = spark.createDataFrame([([10.0, 40.0],)], "samples array<double>")
    density = {r["d"]: r["f"] for r in spark.range(300).select(F.col("id").alias("d")).crossJoin(samples).select("d", g.kde_logpdf("d", "samples").alias("f")).collect()}
    got = {(r["blocks"][0]["a"], r["id"]): r["lik"] for r in inference.shape_likelihoods(shapes, tx, samples, tes).join(shapes, inference.SHAPE).collect()}
    ends = {"p": [(290, 1), (150, 2), (230, 1)], "m": [(20, 1), (120, 3)]}
    for a, b in ((210, 250), (30, 60)):
        mix = {}
        for name, e in ends.items():
            last = b if name == "p" else a
            base = sum(max(0, y - max(x, last)) for x, y in ((0, 100), (200, 300))) if name == "p" else sum(max(0, min(y, last) - x) for x, y in ((0, 100), (200, 300)))
            ds = [(-1 if (t < 200 if name == "p" else t > 100) else base + (t - 300 if name == "p" else -t), w) for t, w in e]
            mix[name] = sum(w / sum(w for _, w in e) * np.exp(density[d]) for d, w in ds if d >= 0)
        assert all(np.isclose(got[a, n], mix[n] / max(mix.values())) for n in mix)


def test_rows_of_fits_are_counted_without_a_sort(spark):
    mols = spark.createDataFrame([("C", "G", 1, 2), ("C", "G", 1, 2), ("C", "G", 3, 4), ("D", "G", 3, 4)], "cell string, gene_id string, s1 long, s2 long")
    rows = spark.createDataFrame([("G", 1, 2, [0.5, 1.0], 1.5), ("G", 3, 4, [1.0, 2.0], 3.0), ("G", 5, 6, [1.0, 0.0], 1.0)], "gene_id string, s1 long, s2 long, row array<double>, total double")
    groups = spark.createDataFrame([("G", "a", 0.5, 1, 1.0), ("G", "b", 0.5, 2, 1.0)], "gene_id string, id string, prior double, grp int, weight double")
    fits = inference.fit_cells(mols, rows, groups)
    assert "SortAggregate" not in plan(fits, "executedPlan")
    assert {r["cell"]: round(sum(r["fit"]["counts"]), 9) for r in fits.collect()} == {"C": 3.0, "D": 1.0}


def test_reasons_carry_no_arrays_to_their_joins(spark):
    reads, tx, cells = fx.view(spark, DATA, "v_reads"), fx.transcripts(spark, DATA), fx.view(spark, DATA, "v_cells")
    counted = plan(inference.qc_counts(inference.read_reasons(reads, tx, cells)))
    assert "size(shape" not in counted[:counted.index("Join")] and "_bare" in counted
