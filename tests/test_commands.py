"""Commands that end in files, and sets, lineage and batches."""

import gzip
import json
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from isoweave import commands
from isoweave.operators import evaluate, runs, sets
from isoweave.sources import bam, fasta, sinks, text

TX = "id string, gene_id string, gene_name string, chrom string, strand string, exons array<struct<a:bigint,b:bigint>>"


def cells_of(spark, names):
    return spark.createDataFrame([(n,) for n in names], "cell string")


def a_run(spark, out, seed=0, n=40, d=12, zero=2):
    r = np.random.default_rng(seed)
    x = r.poisson(1 + 20 * (np.arange(d)[None] % 3 == np.arange(n)[:, None] % 3)).astype(float) / 7
    x[:zero] = 0
    rows = [(f"C{i:03d}", f"T{j:02d}", float(x[i, j])) for i in range(n) for j in range(d) if x[i, j]]
    tx = spark.createDataFrame([(f"T{j:02d}", f"G{j // 2}") for j in range(d)], "id string, gene_id string")
    return commands.write_run(spark.createDataFrame(rows, "cell string, id string, count double").repartition(3), cells_of(spark, [f"C{i:03d}" for i in range(n)]), tx, out, note="x"), x


def test_run_and_evaluation(spark, tmp_path):
    out = str(tmp_path / "run")
    record, x = a_run(spark, out)
    assert record["entries"] == np.count_nonzero(x) and json.loads(Path(f"{out}/run.json").read_text())["status"] == "complete"
    lines = gzip.open(f"{out}/isoform_counts.mtx.gz", "rt").read().splitlines()
    assert lines[:3] == ["%%MatrixMarket matrix coordinate real general", "%", f"40 12 {record['entries']}"]
    order = [tuple(map(int, line.split()[:2])) for line in lines[3:]]
    assert order == sorted(order) and all(float(line.split()[2]) == x[r - 1, c - 1] for line, (r, c) in zip(lines[3:], order))
    back = runs.load_run(spark, out)
    assert {(r["cell"], r["feature"]): r["value"] for r in back["counts"].collect()} == {(f"C{i:03d}", f"T{j:02d}"): x[i, j] for i, j in np.argwhere(x)}
    with pytest.raises(FileExistsError):
        a_run(spark, out)
    (tmp_path / "labels.csv").write_text("Barcode,Cluster\n" + "".join(f"C{i:03d},k{i % 3}\n" for i in range(40)))
    report = commands.evaluate_run(spark, out, str(tmp_path / "ev"), 3, str(tmp_path / "labels.csv"), out)
    assert report["cells_evaluated"] == 38 and report["zero_count_cells_excluded"] == 2 and report["original_ari"] == pytest.approx(1.0) and 0 < report["ari_reference"] <= 1
    assert json.loads((tmp_path / "ev" / "evaluation.json").read_text())["nmi_reference"] == report["nmi_reference"]
    e = text.table(spark, str(tmp_path / "ev" / "embedding.tsv"))
    assert e.columns == ["barcode"] + [f"SVD{k + 1}" for k in range(12)] and e.count() == 38
    with pytest.raises(FileExistsError):
        commands.evaluate_run(spark, out, str(tmp_path / "ev"), 3)
    few = str(tmp_path / "few")
    a_run(spark, few, n=30)
    with pytest.raises(ValueError, match="lacks 10"):
        commands.evaluate_run(spark, out, str(tmp_path / "ev2"), 3, None, few)
    (tmp_path / "labels.csv").write_text("Barcode,Cluster\nC010,k\n")
    with pytest.raises(ValueError, match="missing 37"):
        commands.evaluate_run(spark, out, str(tmp_path / "ev3"), 3, str(tmp_path / "labels.csv"))
    with pytest.raises(Exception, match="unknown transcript"):
        commands.write_run(spark.createDataFrame([("C", "T", 1.0)], "cell string, id string, count double"), cells_of(spark, ["C"]), spark.createDataFrame([("U", "G")], "id string, gene_id string"), str(tmp_path / "r3"))


def test_matrix_as_parts_and_values(spark, tmp_path):
    values = [1.0, 0.1, 1 / 3, 1e-9, 123456789.0, 1e20, 2.5]
    counts = spark.createDataFrame([(f"c{k}", "t", v) for k, v in enumerate(values)], "cell string, id string, count double")
    for single in (True, False):
        path = str(tmp_path / f"m{single}.mtx.gz")
        for _ in range(2):  # written again over what is there
            assert sinks.matrix_market(counts, cells_of(spark, [f"c{k}" for k in range(9)]), spark.createDataFrame([("t",), ("u",)], "id string"), path, single) == 7
        ids = lambda names: spark.createDataFrame(list(enumerate(names)), "ix int, value string")
        got = text.matrix_market(spark, path, ids([f"c{k}" for k in range(9)]), ids(["t", "u"]))
        assert sorted((r["cell"], r["value"]) for r in got.collect()) == [(f"c{k}", v) for k, v in enumerate(values)]
    assert not list(tmp_path.glob("*.mtx.gz.*"))


def test_estimated_ends(spark, tmp_path):
    tx = spark.createDataFrame([("a", "g", "n", "chr1", "+", [(100, 200)]), ("b", "g", "n", "chr1", "+", [(100, 300)])], TX)
    reads = spark.createDataFrame([(f"q{k}", 0, "chr1", 150, 60, f"{48 + k % 2}M", 1.0 + k) for k in range(4)] + [("z", 4, "chr1", 150, 60, "9M", 1.0)], "name string, flag int, chrom string, pos bigint, mapq int, cigar string, weight double")
    given = spark.createDataFrame([(f"q{k}", "a") for k in range(4)], "source_id string, model string")
    record = commands.estimate_tes(reads, given, tx, str(tmp_path / "tes"))
    assert record["endpoints"] == 2 and record["total_weight"] == 10.0 and record["qc"] == {"accepted_alignments": 4, "unassigned_alignment": 1}
    rows = {(r["transcript_id"], r["tes"]): r["count"] for r in text.table(spark, str(tmp_path / "tes" / "tes.tsv")).collect()}
    assert rows == {("a", "198"): "4.0", ("a", "199"): "6.0"}
    assert [tuple(r) for r in text.table(spark, str(tmp_path / "tes" / "summary.tsv")).orderBy("transcript_id").collect()] == [("a", "4", "10.0"), ("b", "0", "0.0")]
    with pytest.raises(FileExistsError):
        commands.estimate_tes(reads, given, tx, str(tmp_path / "tes"))
    with pytest.raises(ValueError, match="several models"):
        commands.estimate_tes(reads, given.unionByName(given.limit(1).withColumn("model", F.lit("b"))), tx, str(tmp_path / "t2"))
    assert not (tmp_path / "t2").exists()


def test_panel(spark, tmp_path):
    fasta.register(spark)
    bam.register(spark)
    seq = "".join(random.Random(1).choice("ACGT") for _ in range(3000))
    spark.createDataFrame([("chr1", seq), ("chr2", seq[::-1])], "chrom string, seq string").write.format("fasta").mode("append").save(str(tmp_path / "g"))
    tx = spark.createDataFrame([("t1", "ENSG1", "A", "chr1", "+", [(100, 200), (300, 400)]), ("t2", "ENSG2", "B", "chr2", "-", [(500, 700)]), ("t3", "ENSG3", "C", "chr2", "+", [(900, 990)])], TX)
    tx = tx.withColumn("source", F.lit("reference"))
    reads = spark.createDataFrame(
        [(f"r{k}", 16 if k % 2 else 0, c, p, 60, "10M", "ACGTACGTAC", "IIIIIIIIII", "c1", "u", g) for k, (c, p, g) in enumerate([("chr2", 600, "ENSG2"), ("chr2", 610, "ENSG2"), ("chr1", 120, "ENSG1.4"), ("chr1", 121, "ENSG1"), ("chr2", 910, "ENSG3"), ("chr1", 110, "ENSG1")])],
        "name string, flag int, chrom string, pos bigint, mapq int, cigar string, seq string, qual string, cell string, umi string, gx string",
    )
    contigs = spark.createDataFrame([("chr1", 1, 3000), ("chr2", 0, 3000)], "chrom string, ix int, length int")
    tokens = spark.createDataFrame([(0, "B"), (1, "ENSG1")], "ix int, token string")
    record = commands.prepare_panel(tx, tokens, reads, cells_of(spark, ["c1"]), str(tmp_path / "g"), contigs, str(tmp_path / "p"))
    assert record["genes"] == 2 and record["reads"] == 2 and record["qc"]["accepted"] == 2 and record["qc"]["antisense"] == 3
    got = spark.read.format("bam").load(str(tmp_path / "p" / "reads.bam")).collect()
    assert [(r["name"], r["chrom"], r["pos"]) for r in got] == [("r1", "chr2", 610), ("r2", "chr1", 120)] and (tmp_path / "p" / "reads.bam.bai").exists()
    minus = seq[::-1][500:700][::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert {r[0]: r[1] for r in text.fasta(spark, str(tmp_path / "p" / "transcripts.fa")).collect()} == {"t1": seq[100:200] + seq[300:400], "t2": minus}
    with pytest.raises(FileExistsError):
        commands.prepare_panel(tx, tokens, reads, cells_of(spark, ["c1"]), str(tmp_path / "g"), contigs, str(tmp_path / "p"))


def test_sets(spark):
    a, b = cells_of(spark, ["x", "y", "y"]), cells_of(spark, ["y", "z"])
    of = lambda df: sorted(r[0] for r in df.collect())
    assert of(sets.missing(a, b)) == ["x"] and of(sets.in_all("cell", a, b)) == ["y"] and of(sets.in_any("cell", a, b)) == ["x", "y", "z"]
    assert sorted(map(tuple, sets.unexpected(a, b).collect())) == [("x", "missing"), ("z", "unexpected")]
    with pytest.raises(ValueError, match="1 values of cell"):
        sets.require_disjoint(a, b, "cell")
    sets.require_disjoint(a, cells_of(spark, ["q"]), "cell")
    with pytest.raises(ValueError, match="y repeats on the left"):
        sets.aligned(a, b)
    with pytest.raises(ValueError, match="1 missing, 1 unexpected"):
        sets.aligned(a.distinct(), b)
    assert sets.aligned(b.withColumn("l", F.lit(1)), b.withColumn("r", F.lit(2))).columns == ["cell", "l", "r"]
    reads = spark.createDataFrame([("m/1", "c"), ("m/2", "d"), ("n", "c")], "name string, cell string")
    with pytest.raises(ValueError, match="m is under 2"):
        sets.require_one_cell(reads)
    sets.require_one_cell(reads.where("cell = 'c'"))
    e = spark.createDataFrame([("c", "g", "t", 0.12345)], "cell string, gene_id string, id string, share double")
    s = spark.createDataFrame([("c", "g", 10)], "cell string, gene_id string, positive int")
    assert sets.external_scale(e, s).first()["count"] == pytest.approx(1.23)
    for bad, what in ((lambda: sets.external_scale(e.withColumn("share", F.lit(1.5)), s), "share"), (lambda: sets.external_scale(e, s.limit(0)), "support")):
        with pytest.raises(Exception, match=what):
            bad().collect()


def chain(spark, rows):
    """Certificates (id, sha, size, source) that declare their sources as these are, but for given exceptions."""
    by = {i: (h, n) for i, h, n, *_ in rows}
    full = [(i, h, n, s, *(r[0] if r else by.get(s, (None, None)))) for i, h, n, s, *r in rows]
    return spark.createDataFrame(full, "id string, sha256 string, size long, source string, source_sha256 string, source_size long")


def test_lineage(spark):
    good = [(f"n{k}", f"h{k}", k, f"n{k + 1}" if k < 16 else None) for k in range(17)]
    roots = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    got = sets.lineage(chain(spark, good), roots("n0", "n14")).orderBy("root", "hop").collect()
    assert [tuple(r) for r in got] == [("n0", k, f"n{k}", f"h{k}", k) for k in range(17)] + [("n14", k, f"n{14 + k}", f"h{14 + k}", 14 + k) for k in range(3)]
    long = [(f"n{k}", f"h{k}", k, f"n{k + 1}" if k < 17 else None) for k in range(18)]
    for rows, what in (
        (long, "exceeds 16"), ([("a", "h", 1, "b"), ("b", "h", 1, "c"), ("c", "h", 1, "a")], "cycle"), ([("a", "h", 1, "a")], "cycle"), ([("a", "h", 1, "b", ("other", 1)), ("b", "h", 1, None)], "changed"),
        ([("a", "h", 1, "b", ("h", 2)), ("b", "h", 1, None)], "changed"), ([("a", "h", 1, "gone")], "missing"), ([("a", "h", 1, None), ("a", "h", 1, None)], "twice"), ([("q", "h", 1, None)], "no certificate"),
    ):
        with pytest.raises(Exception, match=what):
            sets.lineage(chain(spark, rows), roots(rows[0][0] if what != "no certificate" else "a")).collect()
    wanted = spark.createDataFrame([("n3", "h3", 3), ("n9", "other", 9), ("n14", "h14", 14)], "id string, sha256 string, size long")
    assert {r["root"]: r["reached"] for r in sets.descends_from(chain(spark, good), roots("n2", "n4", "n14"), wanted).collect()} == {"n2": True, "n4": True, "n14": False}


def test_batches_of_equal_cost(spark):
    r = random.Random(5)
    costs = [int(r.paretovariate(1.2) * 10) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(costs)), "id int, cost int").repartition(5)
    loads = {b["batch"]: (b["s"], b["n"]) for b in sets.dealt(df, "cost", 16).groupBy("batch").agg(F.sum("cost").alias("s"), F.count("*").alias("n")).collect()}
    assert len(loads) == 16 and sum(n for _, n in loads.values()) == 3000 and max(n for _, n in loads.values()) - min(n for _, n in loads.values()) <= 1
    assert max(s for s, _ in loads.values()) - min(s for s, _ in loads.values()) <= max(costs)
    plan = evaluate.lpt_batches([(str(i), c) for i, c in enumerate(costs)], 16, 300)
    assert sorted(x for p in plan for x in p) == sorted(map(str, range(3000)))
    with pytest.raises(ValueError):
        sets.dealt(df, "cost", 0)
