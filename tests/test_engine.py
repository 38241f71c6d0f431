"""The quantification engine: expected values of small cases, files and oracles."""

import math
import random
import struct
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from isoweave.functions import genomics as g
from isoweave.operators import catalog, evaluate, inference, prepare, tes
from isoweave.sources import bam, sinks, text

IV = g.INTERVALS
TX = "id string, gene_id string, chrom string, strand string, exons array<struct<a:bigint,b:bigint>>, lr_count double, source string, seq int"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def iv(*pairs):
    return F.array(*[F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b")) for a, b in pairs]).cast(IV)


def tx(spark, *rows):
    return spark.createDataFrame([(r[0], r[1], "chr1", r[2], r[3], float(r[4]), "reference", i) for i, r in enumerate(rows)], TX)


@pytest.mark.parametrize(("lr", "sr", "tau", "want"), [((9, 1), (1, 9), 10, (0.5, 0.5)), ((0, 0), (1, 3), 10, (0.25, 0.75)), ((0, 0), (0, 0), 0, (0.5, 0.5))])
def test_prior(spark, lr, sr, tau, want):
    t = tx(spark, ("a", "g", "+", [(0, 9)], lr[0]), ("b", "g", "+", [(0, 8)], lr[1]))
    q = spark.createDataFrame([("a", float(sr[0])), ("b", float(sr[1]))], "id string, value double")
    got = {r["id"]: r["prior"] for r in inference.hybrid_prior(t, q, tau).collect()}
    assert (got["a"], got["b"]) == pytest.approx(want)


def test_distance_and_compatibility(spark):
    exons = iv((100, 200), (300, 400))
    blocks, junctions = iv((180, 200), (300, 320)), iv((200, 300))
    assert one(spark, g.spliced_distance(blocks, F.lit("+"), exons)) == 80 == one(spark, g.spliced_distance(blocks, F.lit("-"), exons))
    assert one(spark, g.compatible(blocks, junctions, exons)) is True
    assert one(spark, g.compatible(blocks, junctions, iv((100, 210), (300, 400)))) is False
    assert one(spark, g.spliced_distance(blocks, F.lit("+"), exons, F.lit(250))) == -1
    assert one(spark, g.spliced_distance(blocks, F.lit("+"), exons, F.lit(410))) == 90


def test_cigar(spark):
    s = one(spark, g.cigar_shape(F.lit(100), F.lit("5S10M2I3D10M10N4=1X3H")))
    assert [tuple(x) for x in s["blocks"]] == [(100, 110), (113, 123), (133, 137), (137, 138)] and [tuple(x) for x in s["junctions"]] == [(123, 133)] and s["pos"] == 138
    assert [tuple(x) for x in one(spark, g.bed_blocks(F.lit(0), F.lit("10M5D10M100N20M")))] == [(0, 25), (125, 145)]
    assert one(spark, g.cigar_shape(F.lit(1), F.lit(None).cast("string")))["blocks"] == []
    with pytest.raises(Exception, match="unsupported CIGAR"):
        one(spark, g.cigar_shape(F.lit(1), F.lit("10M5B")))


def test_union_and_windows(spark):
    assert [tuple(x) for x in one(spark, g.interval_union(iv((120, 130), (100, 110), (105, 115), (135, 140))))] == [(100, 115), (120, 130), (135, 140)]
    assert [tuple(x) for x in one(spark, g.interval_union(iv((1, 2), (2, 3))))] == [(1, 3)]
    assert [tuple(x) for x in one(spark, g.terminal_window(iv((100, 200), (300, 400)), F.lit("+"), 150))] == [(300, 400), (150, 200)]
    assert [tuple(x) for x in one(spark, g.terminal_window(iv((100, 200), (300, 400)), F.lit("-"), 80))] == [(100, 180)]


def test_density(spark):
    s = F.array(F.lit(10.0), F.lit(20.0), F.lit(30.0))
    want = sum(math.exp(-(((40 - v) / 10) ** 2) / 2) + math.exp(-(((40 + v) / 10) ** 2) / 2) for v in (10, 20, 30)) / (30 * math.sqrt(2 * math.pi))
    assert one(spark, F.exp(g.kde_logpdf(F.lit(40), s, 10.0))) == pytest.approx(want, rel=1e-12)
    assert one(spark, g.kde_logpdf(F.lit(-1), s)) == -math.inf
    assert one(spark, g.kde_logpdf(F.lit(600), F.array().cast("array<double>"))) == pytest.approx(-2 - math.log(300))


def test_names(spark):
    f = lambda x: one(spark, g.normalize_gene_id(F.lit(x)))
    assert [f(x) for x in ("ENSG001.4", "ENSG001.4_PAR_Y", "AC0.1", " ENSMUSG1.2 ")] == ["ENSG001", "ENSG001_PAR_Y", "AC0.1", "ENSMUSG1"]
    assert one(spark, g.reverse_complement(F.lit("AACGN"))) == "NCGTT"
    h = lambda x: one(spark, g.pacbio_hole(F.lit(x)))
    assert [h(x) for x in ("m/10/ccs", "m/11/ccs/0_4", "m/12/0_4", "m/x/ccs", "m")] == [10, 11, 12, None, None]


def fit(spark, rows, prior, strength):
    r = F.array(*[F.struct(F.array(*map(F.lit, map(float, row))).alias("row"), F.lit(float(n)).alias("n")) for row, n in rows])
    return one(spark, inference.em(r, F.array(*map(F.lit, map(float, prior))), strength))


def test_em_recovers_from_a_zero_prior(spark):
    got = fit(spark, [((1, 2), 20)], (1, 0), 0.0)
    assert got["counts"][1] > 19.99 and got["converged"] and got["iterations"] > 1


def test_mixtures_in_batches(spark):
    """fitted against em, the same mixture as one expression."""
    r = random.Random(8)
    problems = []
    for k in range(400):
        width, most = r.choice((1, 2, 3, 5)), r.choice((1, 2, 3, 9))
        rows = []
        for _ in range(r.randint(1, most)):
            row = [r.choice((0.0, 1.0, r.random())) for _ in range(width)]
            row[r.randrange(width)] = 1.0
            rows.append((row, float(r.randint(1, 9))))
        prior = [r.random() for _ in range(width)]
        problems.append((k, rows, prior))
    df = spark.createDataFrame(problems, "k int, rows array<struct<row:array<double>,n:double>>, group_prior array<double>").repartition(3)
    for strength, tolerance, steps in ((1.0, 1e-7, 500), (0.0, 1e-3, 40), (5.0, 1e-9, 7), (1.0, 1e-7, 0)):
        both = inference.fitted(df, strength, tolerance, steps).withColumn("one", inference.em(F.col("rows"), F.col("group_prior"), strength, tolerance, steps)).collect()
        assert len(both) == 400
        for q in both:
            assert q["fit"]["converged"] == q["one"]["converged"] and q["fit"]["iterations"] == q["one"]["iterations"]
            assert all(abs(a - b) < 1e-9 for a, b in zip(q["fit"]["counts"], q["one"]["counts"], strict=True))
    assert inference.fitted(df.limit(0)).count() == 0


def test_em_conserves(spark):
    got = fit(spark, [((1, 0.5), 3), ((0, 1), 2), ((1, 0), 1)], (0.4, 0.6), 1.0)
    assert sum(got["counts"]) == pytest.approx(6)


def test_group_split(spark):
    t = tx(spark, ("a", "g", "+", [(100, 200), (300, 400)], 6), ("b", "g", "+", [(50, 80), (300, 400)], 3))
    mols = spark.createDataFrame([("c", f"u{i}", "g", [(350, 370)], []) for i in range(10)], f"cell string, umi string, gene_id string, blocks {IV}, junctions {IV}")
    sr = spark.createDataFrame([], "id string, value double")
    samples = spark.createDataFrame([([10.0, 20.0, 30.0],)], "samples array<double>")
    out = inference.quantify(mols, t, sr, samples, tau=0.0, window=80)
    got = {r["id"]: r["count"] for r in out["counts"].collect()}
    assert got == pytest.approx({"a": 20 / 3, "b": 10 / 3}) and out["groups"].select("grp").distinct().count() == 1
    far = spark.createDataFrame([("c", "u", "g", [(500, 520)], [])], mols.schema)
    assert inference.group_likelihoods(inference.likelihoods(inference.shapes(far), t, samples), out["groups"]).first()["total"] == 0


def test_molecules(spark):
    t = tx(spark, ("a", "g", "+", [(100, 200)], 0))
    reads = spark.createDataFrame(
        [("r1", "A-1", "U", "chr1", 100, "10M10N10M", 0, "g"), ("r2", "A-1", "U", "chr1", 105, "10M20N5M", 0, "g"), ("r3", "A-1", "U", "chr1", 110, "10M", 0, None), ("r4", "A-1", "U", "chr1", 110, "10M", 0, "g;h"), ("r5", "A-1", "U", "chr1", 110, "10M", 16, "g"), ("r6", "B", "U", "chr1", 110, "10M", 0, "g")],
        "name string, cell string, umi string, chrom string, pos bigint, cigar string, flag int, gx string",
    )
    why = inference.read_reasons(reads, t, spark.createDataFrame([("A-1",)], "cell string"))
    m = inference.molecules(why).first()
    assert [tuple(x) for x in m["blocks"]] == [(100, 115), (120, 130), (135, 140)] and [tuple(x) for x in m["junctions"]] == [(110, 120), (115, 135)]
    assert {r["reason"]: r["n"] for r in inference.qc_counts(why).collect()} == {"eligible_reads": 2, "missing_gx": 1, "multigene_gx": 1, "wrong_strand": 1, "unfiltered_barcode": 1}


@pytest.mark.parametrize(("cigar", "strand", "ok"), [("100=1I20=", "+", True), ("100=100D10=", "+", True), ("10=", "+", False)])
def test_terminal_exon(spark, cigar, strand, ok):
    s = g.cigar_shape(F.lit(95), F.lit(cigar))
    assert one(spark, g.terminal_exon_overlap(s.blocks, s.junctions, F.lit(strand), iv((105, 400)))) is ok


def test_tes_conflict(spark):
    a = spark.createDataFrame([("x", "PB.1"), ("x", "PB.2"), ("y", "PB.1")], "source_id string, model string")
    assert [r["source_id"] for r in tes.conflicts(a).collect()] == ["x"]


def test_spliced_sequence(spark):
    t = tx(spark, ("p", "g", "+", [(0, 4), (8, 12)], 0), ("m", "g", "-", [(0, 4), (8, 12)], 0))
    c = spark.createDataFrame([("chr1", "AAAACCCCGGGGTTTT")], "chrom string, seq string")
    assert {r["id"]: r["seq"] for r in catalog.spliced(t, catalog.chunked(c, 5), 5).collect()} == {"p": "AAAAGGGG", "m": "CCCCTTTT"}


def test_fastq_orientation(spark):
    r = spark.createDataFrame([("n", "AACG", "ABCD", 16)], "name string, seq string, qual string, flag int")
    assert prepare.fastq(r).first()["value"] == "@n\nCGTT\n+\nDCBA"


def test_label_metrics(spark):
    same = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("b", 2)], "l string, r int")
    assert evaluate.adjusted_rand(same).first()["ari"] == 1 and evaluate.normalized_mutual_info(same).first()["nmi"] == pytest.approx(1)
    flat = spark.createDataFrame([("a", 1), ("a", 1)], "l string, r int")
    assert evaluate.adjusted_rand(flat).first()["ari"] == 1 and evaluate.normalized_mutual_info(flat).first()["nmi"] == 1
    m = evaluate.abundance_metrics(spark.createDataFrame([("a", 1.0, 1.0), ("b", 3.0, 3.0), ("c", 2.0, 2.0)], "id string, truth double, estimate double")).first()
    assert (m["mae"], m["rmse"], m["total_variation"]) == (0, 0, 0) and m["pearson"] == pytest.approx(1) and m["spearman"] == pytest.approx(1)


def test_batches():
    out = evaluate.lpt_batches([("A", 10), ("B", 7), ("C", 2), ("D", 1)], 2, 2)
    assert out == [["A", "D"], ["B", "C"]]


def test_text_sources(spark, tmp_path):
    def put(name, body):
        p = tmp_path / name
        p.write_text(body)
        return str(p)

    assert {r["cell"] for r in text.barcodes(spark, put("b.tsv", "A-1\tx\n\nB-1\nA-1\n")).collect()} == {"A-1", "B-1"}
    assert text.quant(spark, put("q.sf", "Name\tTPM\nR1\t2\nPB1\t3\n")).agg(F.sum("value")).first()[0] == 5
    assert text.quant(spark, put("q2.sf", "Name\tNumReads\nR1\t7\n")).first()["value"] == 7
    for body, why in (("R1\t2\nR1\t3\n", "duplicate"), ("R1\t-1\n", "invalid TPM"), ("R1\tinf\n", "invalid TPM")):
        with pytest.raises(Exception, match=why):
            text.quant(spark, put("bad.sf", "Name\tTPM\n" + body)).collect()
    assert [tuple(r) for r in text.tes(spark, put("t.tsv", "transcript_id\ttes\tcount\na\t10\t\na\t12\t2\n")).orderBy("tes").collect()] == [("a", 10, 1.0), ("a", 12, 2.0)]
    for body, why in (("a\t42.5\t1\n", "integer"), ("a\t4\tinf\n", "finite"), ("a\t4\t0\n", "positive total")):
        with pytest.raises(Exception, match=why):
            text.tes(spark, put("tb.tsv", "transcript_id\ttes\tcount\n" + body)).collect()
    assert {tuple(r) for r in text.consensus_assignments(spark, put("g.txt", "pbid\tids\n#x\nPB.1\ta,b\nPB.2\tc\n")).collect()} == {("a", "PB.1"), ("b", "PB.1"), ("c", "PB.2")}
    assert text.raw_assignments(spark, put("r.txt", "ID\tLength\tPBID\nx\t10\tPB.1\n")).first()["model"] == "PB.1"
    assert text.clusters(spark, put("c.csv", "Barcode,Cluster\nA,1\nB,2\n")).count() == 2
    assert {r["chrom"]: r["seq"] for r in text.fasta(spark, put("f.fa", ">chr1 x\nAAAA\nCC\n>chr2\nGG\n")).collect()} == {"chr1": "AAAACC", "chr2": "GG"}
    assert [r["value"] for r in text.column(spark, put("col.tsv", "a\tb\n1\tx\n2\ty\n"), "b").orderBy("ix").collect()] == ["x", "y"]
    cells, features = text.column(spark, put("bc.tsv", "barcode\nA\nB\n"), "barcode"), text.column(spark, put("ft.tsv", "f\nt1\nt2\nt3\n"), "f")
    m = text.matrix_market(spark, put("m.mtx", "%%MatrixMarket matrix coordinate real general\n%\n2 3 2\n1 1 2.5\n2 3 1\n"), cells, features)
    assert {tuple(r) for r in m.collect()} == {("A", "t1", 2.5), ("B", "t3", 1.0)}
    j = text.catalog_json(spark, put("cat.json", '{"genes": {"G": {"gene_id": "G1", "gene_name": "N", "chrom": "chr1", "strand": "+", "ref": [{"id": "a", "exons": [[5, 9], [1, 3]]}], "lr": [{"id": "b", "exons": [[1, 3]], "fl": 4}]}}}'))
    assert {(r["id"], r["lr_count"], r["source"], r["exons"][0]["a"]) for r in j.collect()} == {("a", 0.0, "reference", 1), ("b", 4.0, "pigeon", 1)}
    with pytest.raises(Exception, match="nine columns"):
        catalog.gtf_exons(spark.createDataFrame([("chr1\tx\texon",)], "value string")).collect()


def test_matrix_round_trip(spark, tmp_path):
    counts = spark.createDataFrame([("B", "t2", 1.5), ("A", "t1", 2.0)], "cell string, id string, count double")
    cells, features = spark.createDataFrame([("A",), ("B",), ("C",)], "cell string"), spark.createDataFrame([("t1",), ("t2",)], "id string")
    path = str(tmp_path / "m.mtx.gz")
    assert sinks.matrix_market(counts, cells, features, path) == 2
    ids = lambda values: spark.createDataFrame(list(enumerate(values)), "ix int, value string")
    assert {tuple(r) for r in text.matrix_market(spark, path, ids("ABC"), ids(["t1", "t2"])).collect()} == {("B", "t2", 1.5), ("A", "t1", 2.0)}


def test_manifest_and_resume(spark, tmp_path):
    sinks.manifest(tmp_path / "run.json", {"status": "complete", "x": float("nan")})
    assert '"x": null' in (tmp_path / "run.json").read_text() and "sha256" in sinks.fingerprint(tmp_path / "run.json")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "gene string, n int")
    assert sinks.resumable(df.where("gene = 'a'"), str(tmp_path / "fits"), "gene", "x").count() == 1
    assert sinks.resumable(df, str(tmp_path / "fits"), "gene", "x").count() == 2


def _bgzf(raw, size=200):
    out = b""
    for k in range(0, len(raw), size):
        part = raw[k : k + size]
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(part) + c.flush()
        out += struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out + bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def test_bam_and_pbi(spark, tmp_path):
    bam.register(spark)
    records = b""
    for i in range(50):
        name, seq = f"read{i}".encode() + b"\0", "ACGTN"
        packed = bytes("=ACMGRSVTWYHKDBN".index(a) << 4 | "=ACMGRSVTWYHKDBN".index(b) for a, b in ("AC", "GT", "N="))
        tags = b"CBZA-1\0" + b"isi" + struct.pack("<i", i) + b"XfAc"
        body = struct.pack("<iiBBHHHiiii", 0, 100 + i, len(name), 30, 0, 2, 16, len(seq), -1, -1, 0) + name + struct.pack("<2I", 3 << 4, 2 << 4 | 4) + packed + bytes([10] * 5) + tags
        records += struct.pack("<i", len(body)) + body
    raw = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000) + records
    path = Path(tmp_path / "x.bam")
    path.write_bytes(_bgzf(raw))
    for size in (64 << 20, 300):
        rows = spark.read.format("bam").option("splitBytes", size).load(str(path)).orderBy("pos").collect()
        assert len(rows) == 50 and rows[7]["name"] == "read7" and rows[7]["cigar"] == "3M2S" and rows[7]["seq"] == "ACGTN" and rows[7]["qual"] == "+++++"
        assert rows[7]["tags"] == {"CB": "A-1", "is": "7", "Xf": "c"} and rows[7]["chrom"] == "chr1" and rows[7]["flag"] == 16
    import gzip

    n = 3
    with gzip.open(tmp_path / "x.pbi", "wb") as f:
        f.write(struct.pack("<4sIHI18s", b"PBI\1", 0x030001, 0, n, b"") + bytes(12 * n) + struct.pack("<3i", 5, 6, 7) + bytes(5 * n) + struct.pack("<3q", 50, 60, 70))
    assert [tuple(r) for r in spark.read.format("pbi").load(str(tmp_path / "x.pbi")).orderBy("hole").collect()] == [(5, 50), (6, 60), (7, 70)]


def test_sample_files(tmp_path):
    for p in ("a.bam", "f/s_S1_L001_R1_001.fastq.gz", "f/s_S1_L001_R2_001.fastq.gz"):
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_text("")
    row = {"sample": "x", "pacbio_bams": "a.bam", "primers": "", "fastq_dir": "f", "fastq_sample": "s"}
    assert prepare.check_files(row, tmp_path)["pacbio_bams"] == [str(tmp_path / "a.bam")]
    (tmp_path / "f/s_S1_L002_R1_001.fastq.gz").write_text("")
    with pytest.raises(ValueError, match="paired"):
        prepare.check_files(row, tmp_path)


def test_streaming(spark, tmp_path):
    from isoweave.streaming import ingest

    rows = spark.createDataFrame([(0, "c", "u", "g", 100, "10M"), (1, "c", "u", "g", 100, "10M")], "t int, cell string, umi string, gene_id string, pos bigint, cigar string").withColumn("ts", F.timestamp_seconds("t")).drop("t")
    rows.write.parquet(str(tmp_path / "in"))
    stream = ingest.molecule_events(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("events_out").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("events_out").count() == 1


def test_registry_names_match():
    from isoweave.plans import registry

    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES) and len(registry.QUERIES) > 90


def test_lineage_chain_follows_every_part(spark, tmp_path):
    from isoweave.plans import registry

    spark.range(1, 80_001).select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    got = {r["root"]: r["hops"] for r in registry.QUERIES["lineage_chain"](spark, str(tmp_path)).collect()}
    assert got == {i: min(i.bit_length(), 16) for i in range(1, 80_001)}


def small_run(spark):
    """Two transcripts of one gene and molecules that tell them apart in part."""
    tx = spark.createDataFrame([("a", "g", "chr1", "+", [(100, 400)], 6.0, "reference", 1), ("b", "g", "chr1", "+", [(200, 420)], 3.0, "reference", 2)], "id string, gene_id string, chrom string, strand string, exons array<struct<a:bigint,b:bigint>>, lr_count double, source string, seq int")
    reads = spark.createDataFrame([(f"r{i}", f"c{i % 2}", f"u{i}", "chr1", 110 + 13 * i if i < 4 else 340 + i, "20M", 0, "g", 60) for i in range(12)], "name string, cell string, umi string, chrom string, pos bigint, cigar string, flag int, gx string, mapq int")
    cells = spark.createDataFrame([("c0",), ("c1",)], "cell string")
    sr = spark.createDataFrame([("a", 1.0), ("b", 5.0)], "id string, value double")
    return tx, reads, cells, sr


def test_controls_of_a_run_are_honoured(spark):
    from isoweave import api

    tx, reads, cells, sr = small_run(spark)
    total = lambda **p: {(r["cell"], r["id"]): round(r["count"], 9) for r in api.quantify(tx, reads, cells, sr, p=api.Parameters(window=10, **p))["counts"].collect()}
    usual = total()
    assert abs(sum(usual.values()) - 12) < 1e-6 and len(usual) == 4
    for change in ({"tau": 0.5}, {"bandwidth": 5.0}, {"em_strength": 9.0}, {"max_iter": 1}, {"tolerance": 0.5}):
        assert total(**change) != usual, change
    mols = api.quantify(tx, reads, cells, sr, p=api.Parameters(window=10))["molecules"]
    samples = api.train_capture_model(mols, tx)
    ends = spark.createDataFrame([("a", 398, 1.0), ("b", 420, 2.0)], "id string, tes long, weight double")
    of = lambda p: {(r["variant"], r["cell"], r["id"]): round(r["count"], 9) for r in api.quantify_variants(tx, mols, sr, samples, ends, p).collect()}
    assert of(api.Parameters(window=10)) != of(api.Parameters(window=10, em_strength=9.0))
    with pytest.raises(ValueError, match="spans loci"):
        api.quantify(tx.withColumn("chrom", F.when(F.col("id") == "a", "chr2").otherwise("chr1")), reads, cells, sr)


def test_runs_and_certificates(spark, tmp_path):
    import gzip
    import hashlib
    import json
    import struct

    from isoweave.operators import runs

    run = tmp_path / "run"
    run.mkdir()
    (run / "barcodes.tsv").write_text("barcode\nc1\nc2\n")
    (run / "isoforms.tsv").write_text("transcript_id\tgene_id\nt1\tg\nt2\tg\n")
    with gzip.open(run / "isoform_counts.mtx.gz", "wt") as f:
        f.write("%%MatrixMarket matrix coordinate real general\n%\n2 2 2\n1 2 3.5\n2 1 1\n")
    with pytest.raises(ValueError, match="not a finished run"):
        runs.load_run(spark, run)
    (run / "run.json").write_text('{"status": "complete"}')
    got = runs.load_run(spark, run)
    assert sorted(tuple(r) for r in got["counts"].collect()) == [("c1", "t2", 3.5), ("c2", "t1", 1.0)]
    with pytest.raises(ValueError, match="not a finished run"):
        runs.load_run(spark, run, foreign=True)

    (tmp_path / "bed").mkdir()
    about = {}
    for name, path in (("bam", "x.bam"), ("canonical_sorted_barcodes", "b.txt"), ("chr1.bed", "bed/chr1.bed")):
        (tmp_path / path).write_bytes(name.encode())
        about[name] = {"bytes": len(name), "sha256": hashlib.sha256(name.encode()).hexdigest()}
    good = {"schema": "s.v1", "completed": True, "cross_cb_read_ids": 0, "selection_rules": [*runs.SELECTION, "CB listed"], "read_id_rule": runs.READ_ID, "projection_records": 3, "bed_files": {"chr1.bed": about.pop("chr1.bed")}, **about}
    check = lambda **change: ((tmp_path / "certificate.json").write_text(json.dumps(good | change)), runs.shared_reads(tmp_path, tmp_path / "x.bam", tmp_path / "b.txt", ["chr1"], "s.v1", "CB listed"))[1]
    assert check() == {"chr1": tmp_path / "bed" / "chr1.bed"}
    for change in ({"completed": False}, {"schema": "s.v2"}, {"cross_cb_read_ids": 1}, {"selection_rules": []}, {"read_id_rule": ""}, {"projection_records": 0}, {"bam": {"bytes": 1}}, {"bed_files": {}}):
        with pytest.raises(ValueError, match="certificate"):
            check(**change)

    mmi = tmp_path / "x.mmi"
    for w, k, flags, ok in ((5, 15, 0, True), (10, 15, 0, False), (5, 15, 1, False), (5, 15, 2, False)):
        mmi.write_bytes(b"MMI\x02" + struct.pack("<5i", w, k, 14, 3, flags)[: 12] + struct.pack("<2i", flags, 0))
        if ok:
            runs.check_index(mmi)
        else:
            with pytest.raises(ValueError, match="is needed"):
                runs.check_index(mmi)
    (tmp_path / "a" / "04_align").mkdir(parents=True)
    (tmp_path / "a" / "04_align" / "s.mapped.bam").touch()
    (tmp_path / "a" / "other.mapped.bam").touch()
    (tmp_path / "a" / "s.collapsed.group.txt").touch()
    assert runs.isoseq_files(tmp_path / "a") == {"group": tmp_path / "a" / "s.collapsed.group.txt", "mapped_bam": tmp_path / "a" / "04_align" / "s.mapped.bam"}
    (tmp_path / "a" / "t.collapsed.group.txt").touch()
    with pytest.raises(ValueError, match="several files"):
        runs.isoseq_files(tmp_path / "a")


def test_lookups_and_subsets_refuse_what_is_ambiguous(spark):
    from isoweave.operators import runs

    tx = spark.createDataFrame([("t1", "g1", "A"), ("t2", "g2", "B"), ("t3", "g3", "B")], "id string, gene_id string, gene_name string")
    tokens = lambda *t: spark.createDataFrame(list(enumerate(t)), "ix int, token string")
    assert sorted((r["id"], r["ix"]) for r in runs.subset_catalog(tx, tokens("g3", "A", "g1")).collect()) == [("t1", 1), ("t3", 0)]
    for bad in ("B", "nope"):
        with pytest.raises(Exception, match="missing or ambiguous"):
            runs.subset_catalog(tx, tokens(bad)).collect()
    reads = spark.createDataFrame([(0, "m1/10/ccs", "A"), (9, "m2/10/ccs", "C"), (20, "m1/11/ccs/0_4", "G")], "offset long, name string, seq string")
    index = spark.createDataFrame([(10, 0), (10, 9), (11, 20)], "hole int, offset long")
    wanted = spark.createDataFrame([("m1/10/ccs",), ("m1/11/ccs/0_4",)], "name string")
    assert sorted(tuple(r) for r in runs.indexed_reads(index, reads, wanted).collect()) == [("m1/10/ccs", "A"), ("m1/11/ccs/0_4", "G")]
    with pytest.raises(Exception, match="offset mismatch"):
        runs.indexed_reads(spark.createDataFrame([(11, 0)], "hole int, offset long"), reads, wanted).collect()
    with pytest.raises(Exception, match="sample repeats"):
        runs.by_sample(spark.createDataFrame([("s", 1), ("s", 2)], "sample string, x int")).collect()
