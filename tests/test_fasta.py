"""Sequences fetched by intervals."""

import random

import pytest

from isoweave.operators import catalog
from isoweave.sources import fasta, remote

R = random.Random(4)
SEQS = {f"c{k}": "".join(R.choice("ACGTN") for _ in range(n)) for k, n in enumerate((1, 7, 60, 61, 5000, 200_000, 0))}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    fasta.register(spark)
    path = str(tmp_path_factory.mktemp("fa") / "genome")
    spark.createDataFrame(list(SEQS.items()), "chrom string, seq string").repartition(3).write.format("fasta").option("width", 7).mode("append").save(path)
    return path


def one_file(tmp_path, end="\n"):
    path, index, at = tmp_path / "g.fa", [], 0
    with open(path, "wb") as f:
        for chrom, seq in SEQS.items():
            head = f">{chrom} words about it{end}".encode()
            body = "".join(seq[k : k + 60] + end for k in range(0, len(seq), 60)).encode()
            f.write(head + body)
            index.append(f"{chrom}\t{len(seq)}\t{at + len(head)}\t60\t{60 + len(end)}\n")
            at += len(head) + len(body)
    (tmp_path / "g.fa.fai").write_text("".join(index))
    return str(path)


def some(n=400):
    out = []
    for k in range(n):
        c = R.choice(list(SEQS))
        a = R.randint(0, len(SEQS[c]))
        out.append((k, c, a, R.choice((a, len(SEQS[c]), min(len(SEQS[c]), a + R.randint(0, 200))))))
    return out


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_intervals(spark, folder, tmp_path, end):
    rows = some()
    df = spark.createDataFrame(rows, "k int, chrom string, start long, end long").repartition(4)
    for path in (folder, one_file(tmp_path, end)):
        got = {r["k"]: r["seq"] for r in fasta.fetch(df, path).collect()}
        assert got == {k: SEQS[c][a:b] for k, c, a, b in rows}
    assert fasta.fetch(df.limit(0), folder).columns == ["k", "chrom", "start", "end", "seq"] and fasta.fetch(df.limit(0), folder).count() == 0


def test_no_more_is_read_than_asked_for(spark, tmp_path, monkeypatch):
    path, asked = one_file(tmp_path), []

    class Counted:
        def __init__(self, f):
            self.f = f

        def seek(self, k):
            self.f.seek(k)

        def read(self, n):
            asked.append(n)
            return self.f.read(n)

        def close(self):
            self.f.close()

    real = remote.opened
    monkeypatch.setattr(remote, "opened", lambda p: Counted(real(p)))
    df = spark.createDataFrame([("c5", k * 20_000, k * 20_000 + 100) for k in range(9)] + [("c5", 120, 180)], "chrom string, start long, end long")
    plan = []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: plan.append((run, self)) or self)
    fasta.fetch(df, path)
    run, placed = plan[0]
    rows = [b for t in [placed.coalesce(1).sortWithinPartitions("_file", "_from").toArrow()] for b in t.to_batches()]
    assert sum(b.num_rows for b in run(iter(rows))) == 10
    assert sum(asked) < 9 * 110 + 100 and len(asked) == 9  # one read serves two neighbours


def test_errors(spark, folder, tmp_path):
    at = lambda *x: spark.createDataFrame([x], "chrom string, start long, end long")
    for bad in (("cX", 0, 1), ("c0", 0, 2), ("c0", -1, 1), ("c4", 9, 8)):
        with pytest.raises(Exception, match="no such contig|not on its contig"):
            fasta.fetch(at(*bad), folder).collect()
    (tmp_path / "plain.fa").write_text(">a\nACGT\n")
    with pytest.raises(ValueError, match="no .fai"):
        fasta.fetch(at("a", 0, 1), str(tmp_path / "plain.fa"))
    fasta.register(spark)
    put = lambda rows, name: spark.createDataFrame(rows, "chrom string, seq string").write.format("fasta").mode("append").save(str(tmp_path / name))
    for rows in ([("a b", "ACGT")], [("a", "AC GT")], [("", "A")]):
        with pytest.raises(Exception, match="no name or sequence"):
            put(rows, "bad")
    put([("a", "ACGT"), ("b", "AA"), ("a", "C")], "twice")
    with pytest.raises(ValueError, match="a has 2"):
        fasta.fetch(at("a", 0, 1), str(tmp_path / "twice"))
    with pytest.raises(Exception, match="there already"):
        put([("a", "ACGT")], "twice")


def test_transcripts_from_fetched_exons(spark, folder):
    tx = spark.createDataFrame([("t1", "c4", "+", [(10, 20), (100, 333)]), ("t2", "c5", "-", [(0, 5), (199_990, 200_000)])], "id string, chrom string, strand string, exons array<struct<a:bigint,b:bigint>>")
    got = {r["id"]: r["seq"] for r in catalog.spliced_from(tx, folder).collect()}
    plus = SEQS["c4"][10:20] + SEQS["c4"][100:333]
    minus = (SEQS["c5"][0:5] + SEQS["c5"][199_990:])[::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert got == {"t1": plus, "t2": minus}


def test_contig_written_in_stretches(spark, tmp_path):
    """No row and no task holds a whole contig; before, a contig was one row."""
    fasta.register(spark)
    path = str(tmp_path / "stretches")
    rows = [(c, k, s[k : k + 64]) for c, s in SEQS.items() for k in range(0, max(len(s), 1), 64) if len(s) <= 5000]
    put = lambda rows, path: spark.createDataFrame(rows, "chrom string, start long, seq string").repartitionByRange(5, "chrom", "start").sortWithinPartitions("chrom", "start").write.format("fasta").option("width", 7).mode("append").save(path)
    put(rows, path)
    assert 6 < fasta.index(spark, path).count() < 12
    asked = [(k, c, a, b) for k, c, a, b in some() if c != "c5"] + [(-1, "c4", 0, 5000)]
    got = {r["k"]: r["seq"] for r in fasta.fetch(spark.createDataFrame(asked, "k int, chrom string, start long, end long"), path).collect()}
    assert got == {k: SEQS[c][a:b] for k, c, a, b in asked}
    put([("a", 0, "ACGT"), ("a", 5, "C")], str(tmp_path / "gap"))
    with pytest.raises(ValueError, match="overlap or leave a gap"):
        fasta.index(spark, str(tmp_path / "gap"))


def test_query_writes_contigs_in_stretches(spark, monkeypatch):
    from isoweave.plans import binary

    seen = []
    monkeypatch.setattr(binary, "STRETCH", 400)
    monkeypatch.setattr(binary.cat, "spliced_from", lambda tx, path: seen.append(fasta.index(spark, path).collect()) or fasta.fetch(spark.sql("SELECT 'chr0' AS chrom, 3L AS start, 9999L AS end"), path))
    assert binary._transcriptome(spark, "/root/testdata/sf0.001").first()["seq"] == ("ACGGT" * 2000)[3:9999]
    assert max(r["length"] for r in seen[0]) <= 400 * 5 * binary.EACH * 2
