"""BAM written and read: splits, loci, pushed filters, what is raised."""

import json
import random

import pytest
from pyspark.sql import functions as F

from isoweave.sources import bai, bam, bgzf, remote, sinks

CONTIGS = [("chr2", 2_000_000), ("chr1", 900_000), ("chrE", 10)]


def made(n, seed=1, far=1_900_000):
    """Records in the header's order: short, long, spliced, without bases or place."""
    r, out = random.Random(seed), []
    for k in range(n):
        c, size = r.choice(CONTIGS[:2])
        long = r.random() < 0.01
        seq = "".join(r.choice("ACGTN") for _ in range(r.randint(30_000, 90_000) if long else r.randint(1, 120)))
        m = len(seq)
        cigar = f"{m}M" if r.random() < 0.6 or m < 10 else f"3S{m - 8}M{r.randint(1, 200_000)}N5M"
        row = {
            "name": f"r{k}/{'x' * r.randint(0, 30)}", "flag": r.choice((0, 16, 256)), "chrom": c, "pos": r.randint(0, min(size, far) - 300_000), "mapq": r.randint(0, 60), "cigar": cigar, "seq": seq,
            "qual": None if r.random() < 0.2 else "".join(chr(33 + r.randint(0, 60)) for _ in range(m)), "tags": {"CB": "Z:ACGT-1", "NH": f"i:{r.choice((1, 300, -5, 70_000))}", "ML": "BC:1,2,255", "xf": "f:0.5", "tp": "A:P"},
            "mate_chrom": r.choice((None, "chr1")), "mate_pos": r.choice((-1, 77)), "tlen": r.choice((0, -200)),
        }
        if r.random() < 0.02:
            row |= {"chrom": None, "pos": -1, "cigar": None}
        if r.random() < 0.02:
            row |= {"seq": None, "qual": None, "tags": {}}
        out.append(row)
    names = [n for n, _ in CONTIGS]
    return sorted(out, key=lambda x: (names.index(x["chrom"]) if x["chrom"] else 9, x["pos"]))


def write(rows, path, single=True, per=None):
    """As the tasks and the commit of a write do it, without Spark."""
    w = bam.BamWriter({"path": str(path), "contigs": json.dumps(CONTIGS), "single": str(single).lower(), "typedTags": "true"}, list(rows[0]) if rows else ["name"], False)
    messages = []
    for k in range(0, max(len(rows), 1), per or max(len(rows), 1)):
        messages.append(part(w, k, rows[k : k + (per or len(rows))]))
    w.commit(messages)


def part(w, k, rows):
    from unittest.mock import patch

    from pyspark import TaskContext

    class T:
        partitionId = staticmethod(lambda: k)  # noqa: N815
        taskAttemptId = staticmethod(lambda: k)  # noqa: N815

    class R(dict):
        asDict = dict.copy  # noqa: N815

    with patch.object(TaskContext, "get", lambda: T):
        return w.write(iter([R(x) for x in rows]))


def read(path, **options):
    columns = ["name", "flag", "chrom", "pos", "mapq", "cigar", "seq", "qual", "tags", "mate_chrom", "mate_pos", "tlen"]
    r = bam.BamReader({"path": str(path), "typedTags": "true"} | options, columns)
    splits, out = r.partitions(), []
    for s in splits:
        for b in r.read(s):
            out += [x | {"tags": dict(x["tags"])} for x in b.to_pylist()]
    return out, splits, getattr(r, "inflated", 0)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    at, rows = tmp_path_factory.mktemp("bam"), made(4000)
    write(rows, at / "one.bam", per=700)
    write(rows, at / "parts", single=False, per=900)
    return at, rows


@pytest.mark.parametrize("size", [2_000, 30_000, 300_000, 1 << 26])
def test_every_record_once_in_any_split(files, size):
    at, rows = files
    got, splits, _ = read(at / "one.bam", splitBytes=size)
    assert got == rows
    assert len(splits) == -(-remote.size(str(at / "one.bam")) // size)
    got, _, _ = read(at / "parts", splitBytes=size)
    assert got == rows


def ends(x):
    import re

    return max(x["pos"] + sum(int(n) for n, o in re.findall(r"(\d+)([MDN=X])", x["cigar"] or "")), x["pos"] + 1)


@pytest.mark.parametrize("size", [20_000, 1 << 26])
def test_loci_by_index(files, size):
    at, rows = files
    r, whole = random.Random(5), read(at / "one.bam")[2]
    for k in range(30):
        c, a = r.choice(("chr1", "chr2", "chrE", "chrX")), r.randint(0, 1_700_000)
        b = a + r.choice((1, 500, 20_000, 400_000))
        wanted = [x for x in rows if x["chrom"] == c and x["pos"] < b and ends(x) > a]
        for path in ("one.bam", "parts"):
            got, _, inflated = read(at / path, loci=f"{c}:{a}-{b}", splitBytes=size)
            assert sorted(got, key=str) == sorted(wanted, key=str)
            if b - a <= 500 and path == "one.bam":
                assert inflated < whole / 3
    many = "chr2:0-50000;chr2:40000-600000;chr1;chr2:590000-600001"
    got, _, _ = read(at / "one.bam", loci=many, splitBytes=size)
    assert sorted(got, key=str) == sorted([x for x in rows if x["chrom"] == "chr1" or x["chrom"] == "chr2" and x["pos"] < 600_001], key=str)


def test_loci_without_index_and_bad_loci(files, tmp_path):
    at, rows = files
    (tmp_path / "x.bam").write_bytes((at / "one.bam").read_bytes())
    assert read(tmp_path / "x.bam", loci="chr1", splitBytes=50_000)[0] == [x for x in rows if x["chrom"] == "chr1"]
    with pytest.raises(ValueError, match="empty"):
        read(at / "one.bam", loci="chr1:5-5")
    assert bam.parsed_loci("HLA:1*01:3-9; chr1") == [("HLA:1*01", 3, 9), ("chr1", 0, 1 << 29)]


def test_bins_and_index():
    r = random.Random(3)
    for _ in range(2000):
        a = r.randint(0, (1 << 29) - 2)
        b = min(a + r.randint(1, 1 << r.randint(1, 28)), 1 << 29)
        x = r.randint(max(0, a - 1000), b)
        y = min(x + r.randint(1, 2000), 1 << 29)
        if x < b and y > a:
            assert bai.bin_of(x, y) in bai.bins_over(a, b)
    c = bai.Contig()
    for k in range(50):
        c.add(k * 5000, k * 5000 + 90, k * 1000 << 16, (k + 1) * 1000 << 16)
    raw = bai.packed([c, bai.Contig()], 7)
    assert bai.unpacked(raw)[0] == c and bai.unpacked(raw, {1})[0] == bai.Contig()
    cuts = c.cuts(0, 50_000 << 16, 10_000)
    assert cuts[0][0] == 0 and cuts[-1][1] == 50_000 << 16 and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:])) and len(cuts) > 3


def test_blocks_are_not_taken_for_what_looks_like_them(tmp_path):
    fake = bgzf.deflated(b"not a block of this file")
    data = [random.Random(k).randbytes(40_000) + fake * 3 for k in range(6)]
    path, places = tmp_path / "b", []
    with open(path, "wb") as f:
        for d in data:
            places.append(f.tell())
            f.write(bgzf.deflated(d, 0))
        f.write(bgzf.END)
    end = path.stat().st_size
    with open(path, "rb") as f:
        for start in range(0, end, 7001):
            got = bgzf.first_block(f, start, end, end)
            assert got == next((p for p in [*places, end - len(bgzf.END)] if p >= start), None) or bgzf.block_size(path.read_bytes(), got) == len(fake)
        assert [b[1] for b in bgzf.directory(f, end)] == [sum(map(len, data[:k])) for k in range(7)] + [sum(map(len, data))]


def test_nothing_and_errors(tmp_path):
    write([], tmp_path / "empty.bam")
    assert read(tmp_path / "empty.bam")[0] == []
    rows = made(50)
    with pytest.raises(ValueError, match="order"):
        write(rows[::-1], tmp_path / "x.bam")
    with pytest.raises(ValueError, match="partitions"):
        w = bam.BamWriter({"path": str(tmp_path / "y.bam"), "contigs": json.dumps(CONTIGS), "typedTags": "true"}, list(rows[0]), False)
        w.commit([part(w, 0, rows[25:]), part(w, 1, rows[:25])])
    assert not (tmp_path / "y.bam").exists() and not list(tmp_path.glob("y.bam.*"))
    with pytest.raises(ValueError, match="there already"):
        bam.BamWriter({"path": str(tmp_path / "empty.bam"), "contigs": "[]"}, ["name"], False)
    for bad, what in (({"chrom": "chrQ"}, "header"), ({"cigar": "5Q"}, "CIGAR"), ({"qual": "I"}, "qualities"), ({"name": ""}, "name"), ({"tags": {"XX": "untyped"}}, "no type")):
        with pytest.raises(ValueError, match=what):
            write([made(1)[0] | bad], tmp_path / "z.bam")
    cut = (tmp_path / "cut.bam")
    write(made(300), tmp_path / "full.bam")
    cut.write_bytes((tmp_path / "full.bam").read_bytes()[:-5000])
    with pytest.raises(ValueError):
        read(cut)


def test_spark_writes_sorts_and_reads(spark, tmp_path):
    bam.register(spark)
    rows = [x for x in made(600, 9) if len(x["seq"] or "") < 200]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, bam.BAM_SCHEMA + ", mate_chrom string, mate_pos bigint, tlen int").repartition(5)
    contigs = spark.createDataFrame([(n, k, size) for k, (n, size) in enumerate(CONTIGS)], "chrom string, ix int, length int")
    for single in (False, True):
        path = str(tmp_path / f"s{single}.bam")
        sinks.bam(df, path, contigs, single, typedTags="true")
        back = spark.read.format("bam").schema(bam.WHOLE_SCHEMA.replace(", `end` bigint", "")).option("typedTags", "true").option("splitBytes", 4000).load(path)
        plain = lambda d: sorted(str(r.asDict() | {"tags": sorted(r["tags"].items())}) for r in d.collect())
        assert plain(back) == plain(df.select(*back.columns))
        some = spark.read.format("bam").schema("name string, `end` bigint").option("loci", "chr1:0-300000").load(path)
        assert {(r["name"], r["end"]) for r in some.collect()} == {(x["name"], ends(x)) for x in rows if x["chrom"] == "chr1" and x["pos"] < 300_000}
        with pytest.raises(Exception, match="there already"):
            sinks.bam(df, path, contigs, single, typedTags="true")
    sinks.bam(df.limit(3), path, contigs, True, "overwrite", typedTags="true")
    assert spark.read.format("bam").load(path).count() == 3
    with pytest.raises(Exception, match="not in the header"):
        sinks.bam(df, str(tmp_path / "n.bam"), contigs.where("ix > 0"))


def test_pushed_filters(spark, files):
    at, rows = files
    bam.register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = spark.read.format("bam").option("pushdown", "true").load(str(at / "one.bam")).select("name", "chrom", "pos")
        for where, held in (
            ("chrom = 'chr1' AND pos >= 100000 AND pos < 200000", lambda x: x["chrom"] == "chr1" and 100_000 <= x["pos"] < 200_000),
            ("chrom IN ('chr1', 'chrE') AND pos <= 5000", lambda x: x["chrom"] == "chr1" and x["pos"] <= 5000),
            ("chrom = 'chr2' AND pos > 10 AND pos < 5", lambda _: False),
            ("chrom IS NULL", lambda x: x["chrom"] is None),
            ("pos < 1000", lambda x: x["pos"] < 1000),
            ("NOT chrom = 'chr1'", lambda x: x["chrom"] == "chr2"),
        ):
            assert sorted(r["name"] for r in df.where(where).collect()) == sorted(x["name"] for x in rows if held(x))
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    r = bam.PushedBamReader({"path": str(at / "one.bam")}, ["name"])
    r.pushFilters([bam.EqualTo(("chrom",), "chr1"), bam.LessThan(("pos",), 50)])
    assert r.loci == [("chr1", -1, 50)] and all(isinstance(p, bam.Chunk) for p in r.partitions())


def test_pbi_splits(spark, tmp_path):
    import struct

    n, r = 5000, random.Random(1)
    holes, offsets = [r.randint(0, 900) for _ in range(n)], [r.randint(0, 1 << 50) for _ in range(n)]
    raw = struct.pack("<4sIHI18s", b"PBI\1", 0x030001, 0, n, b"") + r.randbytes(12 * n) + struct.pack(f"<{n}i", *holes) + r.randbytes(5 * n) + struct.pack(f"<{n}q", *offsets) + r.randbytes(100)
    path = tmp_path / "x.pbi"
    with open(path, "wb") as f:
        w = bgzf.Writer(f)
        w.write(raw)
        w.flush()
        f.write(bgzf.END)
    bam.register(spark)
    got = spark.read.format("pbi").option("splitRecords", 700).load(str(path))
    assert got.rdd.getNumPartitions() == 8
    assert sorted(map(tuple, got.collect())) == sorted(zip(holes, offsets))
    some = spark.read.format("pbi").option("holes", "5,77").schema("offset bigint").load(str(path))
    assert sorted(x[0] for x in some.collect()) == sorted(o for h, o in zip(holes, offsets) if h in (5, 77))
    path.write_bytes(path.read_bytes()[:-400])
    with pytest.raises(Exception):
        spark.read.format("pbi").load(str(path)).agg(F.sum("offset")).collect()


@pytest.mark.parametrize("single", [True, False])
def test_places_beyond_the_header_and_the_bins(tmp_path, single):
    """Records behind a contig's stated length, and behind what the bins of an index reach, are read by every split and found by loci."""
    r = random.Random(5)
    rows = sorted(({"name": f"q{k}", "flag": 0, "chrom": "chr1", "pos": r.randint(0, 1_900_000_000), "mapq": 1, "cigar": "40M", "seq": "ACGTN" * 8, "qual": None, "tags": {}} for k in range(9000)), key=lambda x: x["pos"])
    write(rows, tmp_path / "far.bam", single=single, per=2000)
    for size in (5_000, 20_000):
        got, splits, _ = read(tmp_path / "far.bam", splitBytes=size)
        assert len(splits) > 3 and [x["name"] for x in got] == [x["name"] for x in rows]
    for a, b in ((0, 10_000_000), (536_000_000, 537_500_000), (1_000_000_000, 1_100_000_000), (1_899_000_000, 2_000_000_000)):
        got, _, _ = read(tmp_path / "far.bam", loci=f"chr1:{a}-{b}")
        assert [x["name"] for x in got] == [x["name"] for x in rows if x["pos"] < b and x["pos"] + 40 > a]
    assert len(read(tmp_path / "far.bam", loci="chr1")[0]) == len(rows)


def test_places_beyond_32_bits(spark, tmp_path):
    """A place that 32 bits don't hold is written, read and found by loci under its own contig, whatever the header said of its length; before, it raised."""
    bam.register(spark)
    r, far = random.Random(8), bam.STRETCH
    rows = [(f"q{k}", 0, c, p, 1, "20M3700N20M" if k % 3 else "40M", "ACGTN" * 8, None, {"CB": "x"}, c, max(p - 1, 0), 0) for k, (c, p) in enumerate([("a", r.randint(0, 6 * far)) for _ in range(2000)] + [("b", r.randint(0, 3000)) for _ in range(200)] + [("a", j * far + d) for j in range(1, 6) for d in (-3720, -30, -1, 0, 1)])]
    df = spark.createDataFrame(rows, bam.BAM_SCHEMA + ", mate_chrom string, mate_pos bigint, tlen int").repartition(3)
    contigs = spark.createDataFrame([("b", 0, 5000), ("a", 1, 10), (f"a_at_{far}", 2, 10)], "chrom string, ix int, length long")
    ends = {x[0]: x[3] + (3740 if x[5] != "40M" else 40) for x in rows}
    for single in (True, False):
        path = str(tmp_path / f"far{single}.bam")
        sinks.bam(df, path, contigs, single)
        back = spark.read.format("bam").schema(bam.WHOLE_SCHEMA).option("splitBytes", 20_000).load(path)
        got = back.select("name", "chrom", "pos", "end", "mate_chrom", "mate_pos").collect()
        assert sorted(map(tuple, got)) == sorted((x[0], x[2], x[3], ends[x[0]], x[9], x[10]) for x in rows)
        for a, b in ((0, far), (far - 10, far + 1), (far + 3000, far + 3600), (2 * far - 1, 2 * far), (5 * far, 6 * far + 9)):
            some = spark.read.format("bam").schema("name string").option("loci", f"a:{a}-{b};b:10-20").load(path)
            assert sorted(x["name"] for x in some.collect()) == sorted(x[0] for x in rows if (x[2] == "a" and x[3] < b and ends[x[0]] > a) or (x[2] == "b" and x[3] < 20 and ends[x[0]] > 10))
    with open(tmp_path / "farTrue.bam", "rb") as f:
        assert all(0 < size <= bam.LONGEST for _, size in bam.header(f).contigs) and len({n for n, _ in bam.header(f).contigs}) == len(bam.header(f).contigs)


def test_batches_give_the_same_records_as_rows(tmp_path):
    """A writer takes Arrow batches, gaps and all; before, it took rows only."""
    import pyarrow as pa

    rows = made(300)
    rows[5] |= {"mapq": None, "tags": None, "mate_pos": None, "tlen": None, "flag": None}
    w = bam.BamWriter({"path": str(tmp_path / "x.bam"), "contigs": json.dumps(CONTIGS), "typedTags": "true"}, list(rows[0]), False)
    flat = [x | {"tags": None if x["tags"] is None else list(x["tags"].items())} for x in rows]
    whole = pa.RecordBatch.from_pylist(flat, pa.schema([(c, bam._TYPES[c]) for c in rows[0]]))
    assert list(w._packed([whole.slice(0, 7), whole.slice(7)])) == [bam.packed_record(x, w.refs, True) for x in rows]
    less = whole.select(["name", "chrom", "pos"])
    assert list(w._packed([less])) == [bam.packed_record({k: x[k] for k in ("name", "chrom", "pos")}, w.refs, True) for x in rows]
