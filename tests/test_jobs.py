"""The runnable jobs: growing input, runs that stop half-way, the command line."""

import hashlib
import json
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import pytest

from isoweave import api
from isoweave.plans import fixtures
from isoweave.sources import sinks
from isoweave.storage import staged
from jobs import ledger, quantify

TEXTS = "doc_id long, text string, source string"
LINE = "a line that is long enough to be counted as one"


def brute(docs, least=40):
    rows = defaultdict(int)
    for i, t, s in docs:
        rows[s, i, t or ""] += 1
    out = set()
    for (s, i, t), n in rows.items():
        same = [j for (p, j, u) in rows if p == s and u == t and j is not None]
        long = {x for x in t.split("\n") if len(x) >= least}
        late = sum(any(p == s and j is not None and i is not None and j < i and x in u.split("\n") for (p, j, u) in rows) for x in long)
        out.add((s, i, hashlib.sha256(t.encode()).hexdigest(), len(t.encode()), t.count("\n") + 1, n, min(same, default=None), late))
    return out


def rows_of(df):
    return {tuple(r)[:8] for r in df.collect()}


def test_ledger_over_growing_input(spark, tmp_path, monkeypatch, caplog):
    where = {k: str(tmp_path / k) for k in ("texts", "out", "checkpoint")}
    add = lambda docs: spark.createDataFrame(docs, TEXTS).coalesce(2).write.mode("append").parquet(where["texts"])
    run = lambda **c: ledger.run(spark, where["texts"], where["out"], where["checkpoint"], {"buckets": 4} | c)
    first = [(5, f"x\n{LINE}\ny", "a"), (3, f"{LINE}\n{LINE} 2", "a"), (4, f"{LINE}", "b"), (None, LINE, "a"), (6, None, None), (7, "", None), (7, "", None), (8, "é" * 40, "")]
    add(first)
    assert rows_of(run()) == brute(first)
    upto = {r["part"]: r["upto"] for r in run().collect()}
    # new texts under smaller ids, a known id with another text, a copy; parts None and '' get nothing new
    second = [(1, f"{LINE} 2\n{LINE}", "a"), (5, "changed", "a"), (2, LINE, "b"), (9, LINE, "c"), (3, f"{LINE}\n{LINE} 2", "a")]
    add(second)

    def stopped(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(ledger, "assembled", stopped)
        with pytest.raises(RuntimeError):
            run()
    with caplog.at_level("INFO", "jobs.ledger"):
        got = run()
    assert "read 0 new texts" in caplog.text  # the stopped run has taken them; the ledger catches up all the same
    assert rows_of(got) == brute(first + second)
    now = {r["part"]: r["upto"] for r in got.collect()}
    assert now["a"] > upto["a"]
    bucket = {r["part"]: r["bucket"] for r in got.collect()}
    for p in (None, ""):
        if bucket[p] not in {bucket["a"], bucket["b"], bucket["c"]}:
            assert now[p] == upto[p]
    before = {p: p.stat().st_mtime_ns for p in Path(where["out"]).rglob("*.parquet")}
    assert rows_of(run()) == brute(first + second)
    assert before == {p: p.stat().st_mtime_ns for p in Path(where["out"]).rglob("*.parquet")}  # nothing new: nothing is written


def test_ledger_of_one_file_and_bad_config(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source").collect()
    got = ledger.run(spark, "/root/testdata/sf0.001/documents.parquet", str(tmp_path / "o"), str(tmp_path / "c"))
    assert rows_of(got) == brute([tuple(d) for d in docs])
    with pytest.raises(ValueError):
        ledger.run(spark, "/root/testdata/sf0.001/documents.parquet", str(tmp_path / "o"), str(tmp_path / "c"), {"buckets": 0})
    spark.createDataFrame([], TEXTS).write.parquet(str(tmp_path / "none"))
    assert ledger.run(spark, str(tmp_path / "none"), str(tmp_path / "o2"), str(tmp_path / "c2")).collect() == []


def test_ledger_command(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"long_line": 10, "buckets": 2}))
    command = [sys.executable, "-m", "jobs.ledger", "--texts", "/root/testdata/sf0.001/documents.parquet", "--out", str(tmp_path / "o"), "--checkpoint", str(tmp_path / "k"), "--config", str(tmp_path / "c.json")]
    done = subprocess.run(command, cwd=Path(__file__).parents[1], capture_output=True, text=True, timeout=300, check=True)
    assert "read 200 new texts" in done.stderr and len({p.parent.name for p in (tmp_path / "o" / "ledger").rglob("*.parquet")}) == 2


def test_committed_keys(spark, tmp_path):
    path, df = str(tmp_path / "w"), spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "gene string, n int")
    keys = spark.createDataFrame([("a",), ("b",), ("none",)], "gene string")
    assert sinks.commit(df.where("gene = 'a'"), path, "gene", "x") == 2
    # a write that was stopped half-way through b: rows, but no mark
    spark.createDataFrame([("b", 99)], "gene string, n int").write.parquet(f"{path}/identity=x/data/attempt=0000")
    assert {r["gene"] for r in sinks.pending(keys, path, "gene", "x").collect()} == {"b", "none"}
    assert sorted(map(tuple, sinks.resumable(df, path, "gene", "x").select("gene", "n").collect())) == [("a", 1), ("a", 2), ("b", 3)]
    # a key without rows is committed as well; another writer's rows for a key that is committed don't count
    sinks.commit(df.limit(0), path, "gene", "x", keys.where("gene = 'none'"))
    assert sinks.pending(keys, path, "gene", "x").count() == 0
    sinks.commit(spark.createDataFrame([("b", 4)], "gene string, n int"), path, "gene", "x")
    assert sorted(map(tuple, sinks.read_committed(spark, path, "gene", "x").select("gene", "n").collect())) == [("a", 1), ("a", 2), ("b", 3)]
    assert sinks.pending(keys, path, "gene", "y").count() == 3 and sinks.read_committed(spark, path, "gene", "y", df.schema).count() == 0
    for p in Path(path).glob("identity=x/data/attempt=*/*.parquet"):
        if "attempt=0000" not in str(p) and spark.read.parquet(str(p)).where("n = 3").count():
            p.unlink()
            (p.parent / f".{p.name}.crc").unlink()
    with pytest.raises(ValueError, match="b: 0 of 1"):
        sinks.read_committed(spark, path, "gene", "x")


def test_quantify_stops_and_goes_on(spark, tmp_path, monkeypatch):
    tables, out = "/root/testdata/sf0.001", str(tmp_path / "run")
    config = {"variants": ["annotation_tes", "sr_only"], "max_iter": 50}
    real, seen = sinks.commit, []

    def commit(df, path, *a):
        if path.endswith("sr_only") and not seen:
            seen.append(path)
            df.limit(5).write.parquet(f"{path}/identity={a[1]}/data/attempt=0")
            raise RuntimeError("stopped")
        seen.append(path)
        return real(df, path, *a)

    monkeypatch.setattr(sinks, "commit", lambda df, path, *a: commit(df, path, *a) if "sr_only" in path else real(df, path, *a))
    with pytest.raises(RuntimeError):
        quantify.run(spark, tables, out, config)
    assert quantify._status(spark, out)["status"] == "running"
    work = {p for p in Path(out).rglob("work/annotation_tes/**/*.parquet")}
    got = quantify.run(spark, tables, out, config)
    assert {p for p in Path(out).rglob("work/annotation_tes/**/*.parquet")} == work  # not done again
    status = quantify._status(spark, out)
    assert status["status"] == "complete" and set(status["counts"]) == {"annotation_tes", "sr_only"}
    # the same as the command in one piece
    tx = staged(fixtures.transcripts(spark, tables), "tx")
    whole = api.quantify(tx, fixtures.view(spark, tables, "v_reads"), fixtures.view(spark, tables, "v_cells"), fixtures.abundance(spark, tables), p=api.Parameters(max_iter=50))["counts"]
    a = {(r["cell"], r["transcript_id"]): r["expected"] for r in got.where("variant = 'annotation_tes'").collect()}
    b = {(r["cell"], r["id"]): r["count"] for r in whole.collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
    # again: nothing is written; other parameters: another identity
    files = {p: p.stat().st_mtime_ns for p in Path(out).rglob("*") if p.is_file()}
    assert quantify.run(spark, tables, out, config).count() == got.count()
    assert files == {p: p.stat().st_mtime_ns for p in Path(out).rglob("*") if p.is_file()}
    quantify.run(spark, tables, out, {"variants": ["annotation_tes"], "max_iter": 2})
    assert quantify._status(spark, out)["identity"] != status["identity"]
    assert {r["variant"] for r in spark.read.parquet(f"{out}/counts").select("variant").distinct().collect()} == {"annotation_tes"}
    with pytest.raises(ValueError, match="variants"):
        quantify.run(spark, tables, out, {"variants": ["other"]})


def test_lost_mass_is_told(spark):
    fits = spark.createDataFrame([("g", "c", {"counts": [1.0, 2.0]})], "gene_id string, cell string, fit struct<counts array<double>>")
    quantify.check_conserved(fits, spark.createDataFrame([("g", 3.0)], "gene_id string, expected double"))
    for counts in ([("g", 2.9)], [], [("g", 3.0), ("h", 1.0)]):
        with pytest.raises(ValueError):
            quantify.check_conserved(fits, spark.createDataFrame(counts, "gene_id string, expected double"))


def test_quantify_command(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"variants": ["annotation_tes"], "max_iter": 5}))
    command = [sys.executable, "-m", "jobs.quantify", "--tables", "/root/testdata/sf0.001", "--out", str(tmp_path / "o"), "--config", str(tmp_path / "c.json")]
    for said in ("wrote to", "nothing to do"):
        done = subprocess.run(command, cwd=Path(__file__).parents[1], capture_output=True, text=True, timeout=300, check=True)
        assert said in done.stderr
    assert len(list((tmp_path / "o" / "counts" / "variant=annotation_tes").glob("chrom=*"))) == 5
