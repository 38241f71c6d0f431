"""Sequences with an index (`.fai`): written in parts by Spark's tasks, fetched by intervals with ranged reads.

    df.write.format("fasta").option("width", 60).save(path)       rows (chrom, seq), or stretches (chrom, start, seq)
    fetch(intervals, path)                                         intervals (chrom, start, end, ...)

A path is a file with `.fai` beside it, or a folder of .fa files with theirs.  Stretches of a contig that follow
each other in a task make one record; a record that starts within its contig has that place as a sixth column of
the index, so many tasks write one contig and none holds more than a row of it.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from . import remote
from .text import require

#: Gap between two intervals up to which one read serves both; intervals that one read may serve; bytes in a batch.
GAP, READ, BATCH = 4096, 8 << 20, 16 << 20


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    chroms: int


class FastaWriter(DataSourceWriter):
    def __init__(self, options, columns, overwrite):
        self.path, self.width, self.overwrite = options["path"].rstrip("/"), int(options.get("width", 60)), overwrite
        self.attempt, self.at = f"{self.path}.{uuid.uuid4().hex}", [columns.index(c) for c in ("chrom", "seq")]
        self.start = columns.index("start") if "start" in columns else None
        if self.width < 1:
            raise ValueError("width must be at least 1")
        if not overwrite and remote.taken(self.path):
            raise ValueError(f"{self.path} is there already")

    def write(self, rows):
        from pyspark import TaskContext

        t = TaskContext.get()
        name, index, at = f"part-{t.partitionId():05d}-{t.taskAttemptId()}.fa", [], 0
        f, now, first, n, offset, line = None, None, 0, 0, 0, ""

        def ended():
            nonlocal at
            if now is not None:
                if line:
                    f.write(line.encode() + b"\n")
                    at += len(line) + 1
                index.append(f"{now}\t{n}\t{offset}\t{self.width}\t{self.width + 1}" + (f"\t{first}\n" if first else "\n"))

        for row in rows:
            chrom, seq, start = row[self.at[0]], row[self.at[1]] or "", 0 if self.start is None else row[self.start]
            if not re.fullmatch(r"[!-~]+", chrom or "") or chrom[0] in "*=>" or not re.fullmatch(r"[A-Za-z*-]*", seq) or start is None or start < 0:
                raise ValueError(f"no name or sequence of FASTA: {chrom}")
            f = f or remote.created(f"{self.attempt}/{name}")
            if chrom != now or start != first + n or not start:
                ended()
                head = (f">{chrom} from {start}\n" if start else f">{chrom}\n").encode()
                f.write(head)
                at += len(head)
                now, first, n, offset, line = chrom, start, 0, at, ""
            n += len(seq)
            line += seq
            full = len(line) - len(line) % self.width
            body = "".join([line[k : k + self.width] + "\n" for k in range(0, full, self.width)]).encode()
            f.write(body)
            at, line = at + len(body), line[full:]
        ended()
        if f is None:
            return Written(None, 0)
        f.close()
        with remote.created(f"{self.attempt}/{name}.fai") as f:
            f.write("".join(index).encode())
        return Written(name, len(index))

    def commit(self, messages):
        wanted = {m.name for m in messages if m is not None and m.name}
        if not wanted:
            self.abort(messages)
            raise ValueError("there are no sequences to write")
        if self.overwrite:
            remote.removed(self.path)
        for p in remote.parts(self.attempt, ""):
            if p.rsplit("/", 1)[-1].removesuffix(".fai") not in wanted:
                remote.removed(p)
        remote.moved(self.attempt, self.path)

    def abort(self, _):
        remote.removed(self.attempt)


class FastaDataSource(DataSource):
    """Writer only; text.fasta reads whole sequences, fetch reads stretches."""

    @classmethod
    def name(cls):
        return "fasta"

    def schema(self):
        return "chrom string, seq string"

    def writer(self, schema, overwrite):
        return FastaWriter(self.options, schema.names, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FastaDataSource)


def index(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, length, offset, bases, bytes, start, file) from the .fai of a file or of a folder's files, a row for each record; records of a contig that overlap or leave a gap raise."""
    files = [f"{path}.fai"] if remote.size(path) is not None else remote.parts(path, ".fai")
    if not files or remote.size(files[0]) is None:
        raise ValueError(f"{path} has no .fai")
    at = lambda k: F.col("x")[k].cast("long")
    lines = require(spark.read.text(files).withColumn("x", F.split("value", "\t")), F.size("x").isin(5, 6), "no line of an index:", "value")
    rows = lines.select(F.col("x")[0].alias("chrom"), at(1).alias("length"), at(2).alias("offset"), at(3).alias("bases"), at(4).alias("bytes"), F.coalesce(F.get("x", F.lit(5)).cast("long"), F.lit(0)).alias("start"), F.substring_index(F.col("_metadata.file_path"), "/", -1).alias("file"))
    of = rows.groupBy("chrom").agg(F.count_if(F.col("start") == 0).alias("n"), F.array_sort(F.collect_list(F.struct("start", "length"))).alias("r"))
    untiled = of.withColumn("end", F.aggregate("r", F.lit(0).cast("long"), lambda e, r: F.when(e == r.start, r.start + r.length).otherwise(-1))).where("n > 1 OR end < 0").first()
    if untiled is not None:
        raise ValueError(f"{untiled['chrom']} has {untiled['n']} sequences" if untiled["n"] > 1 else f"stretches of {untiled['chrom']} overlap or leave a gap")
    return rows


def fetch(intervals: DataFrame, path: str) -> DataFrame:
    """intervals (chrom, start, end, ...) with `seq`, their bases: zero-based, half-open; unknown contigs and places beyond them raise.

    Intervals are dealt by place in the files, so that a hot contig spreads and one read serves neighbours; a task reads
    the bytes of its intervals and little else.
    """
    spark, columns = intervals.sparkSession, intervals.columns
    records = F.array_sort(F.collect_list(F.struct("start", "length", "offset", "bases", "bytes", "file")))
    known = index(spark, path).groupBy("chrom").agg(F.sum("length").alias("_length"), records.alias("_records"))
    placed = require(intervals.join(known, "chrom", "left"), F.col("_length").isNotNull(), "no such contig:", "chrom")
    placed = require(placed, (F.col("start") >= 0) & (F.col("start") <= F.col("end")) & (F.col("end") <= F.col("_length")), "interval is not on its contig:", "chrom", "start", "end")

    def bytes_of(r):
        byte = lambda x: r.offset + F.floor(x / r.bases) * r.bytes + x % r.bases
        # bases behind the last one of a line belong to the line's end, not to the next line
        last = F.least(F.col("end") - r.start, r.length) - 1
        return F.struct(r.file.alias("file"), byte(F.greatest(F.col("start") - r.start, F.lit(0))).alias("from"), (byte(last) + 1).alias("to"))

    held = F.filter("_records", lambda r: (r.start < F.col("end")) & (r.start + r.length > F.col("start")))
    none = F.struct(F.col("_records")[0].file.alias("file"), F.col("_records")[0].offset.alias("from"), F.col("_records")[0].offset.alias("to"))
    at = F.when(F.col("end") > F.col("start"), F.transform(held, bytes_of)).otherwise(F.array(none))
    placed = placed.select(*columns, at.alias("_at")).select(*columns, F.col("_at")[0].file.alias("_file"), F.col("_at")[0]["from"].alias("_from"), F.col("_at")[0].to.alias("_to"), F.slice("_at", 2, 1 << 30).alias("_more"))
    placed = placed.repartitionByRange("_file", "_from").sortWithinPartitions("_file", "_from")
    single = remote.size(path) is not None
    folder = path.rstrip("/")

    def run(batches):
        name, f = None, None

        def located(name):
            return remote.opened(folder if single else f"{folder}/{name.removesuffix('.fai')}")

        def rest(more):
            """Bases of an interval in the records behind its first."""
            for r in more:
                with located(r["file"]) as g:
                    g.seek(r["from"])
                    held = g.read(r["to"] - r["from"])
                if len(held) < r["to"] - r["from"]:
                    raise ValueError(f"{r['file']} ends before its index does")
                yield held.translate(None, b"\r\n").decode()

        for batch in batches:
            files, starts, stops, more = (batch.column(c).to_pylist() for c in ("_file", "_from", "_to", "_more"))
            seqs, k = [], 0
            while k < len(files):
                if files[k] != name:
                    if f is not None:
                        f.close()
                    name = files[k]
                    f = located(name)
                stop, j = stops[k], k + 1
                while j < len(files) and files[j] == name and starts[j] <= stop + GAP and max(stop, stops[j]) - starts[k] <= READ:
                    stop, j = max(stop, stops[j]), j + 1
                f.seek(starts[k])
                held = f.read(stop - starts[k])
                if len(held) < stop - starts[k]:
                    raise ValueError(f"{name} ends before its index does")
                seqs += [held[starts[i] - starts[k] : stops[i] - starts[k]].translate(None, b"\r\n").decode() + "".join(rest(more[i])) for i in range(k, j)]
                k = j
            at, size = 0, 0  # long sequences: no batch of more than BATCH bytes but for one of a single row
            for k, s in enumerate(seqs):
                if size and size + len(s) > BATCH:
                    yield _with(batch.slice(at, k - at), columns, seqs[at:k])
                    at, size = k, 0
                size += len(s)
            yield _with(batch.slice(at), columns, seqs[at:])
        if f is not None:
            f.close()

    return placed.mapInArrow(run, intervals.withColumn("seq", F.lit("")).schema)


def _with(batch: pa.RecordBatch, columns: list[str], seqs: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(len(columns))], pa.array(seqs, pa.string())], names=[*columns, "seq"])
