"""Writers: ordered text, Matrix Market, manifests that come last."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import numbered, staged
from . import remote
from .text import require


def tsv(df: DataFrame, path: str, *order: str) -> None:
    """One header, LF line ends, rows in the given order; written in parallel as part files that sort by name."""
    rows = df.orderBy(*order) if order else df
    rows.write.csv(path, sep="\t", header=True, lineSep="\n", nullValue="", quote="")


def matrix_lines(counts: DataFrame, cells: DataFrame, features: DataFrame) -> DataFrame:
    """(r, c, value) triples from 1, by the ranks of all cells and features, empty ones included."""
    ranked = lambda df, k, out: numbered(df.select(k).distinct(), out, k).withColumn(out, F.col(out).cast("int"))
    return counts.where("count > 0").join(ranked(cells, "cell", "r"), "cell").join(ranked(features, "id", "c"), "id").select("r", "c", F.col("count").alias("value"))


def matrix_market(counts: DataFrame, cells: DataFrame, features: DataFrame, path: str, single: bool = True) -> int:
    """A gzipped coordinate file in row order, with the number of entries in its header; returns that number.

    Entries are sorted by ranges and every range is packed by its own task; the header is a part of its own before them.
    Members of a gzip file may follow each other, so `single` joins the packed parts as they are; without it, path is a
    folder of parts that sort by name.  Neither brings a row to the driver.
    """
    t = staged(matrix_lines(counts, cells, features), "matrix")
    n, spark = t.count(), counts.sparkSession
    size = f"{cells.select('cell').distinct().count()} {features.select('id').distinct().count()} {n}"
    # what %.17g gives is what a double reads back from; the shortest such text does too
    number = F.when((F.col("value") == F.floor("value")) & (F.abs("value") < 1e15), F.col("value").cast("decimal(38,0)").cast("string")).otherwise(F.col("value").cast("string")) if t.schema["value"].dataType.typeName() == "double" else F.col("value").cast("string")
    body = t.select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), F.concat_ws(" ", "r", "c", number).alias("value"))
    head = spark.createDataFrame([(k - 3, 0, x) for k, x in enumerate(("%%MatrixMarket matrix coordinate real general", "%", size))], "r long, c long, value string")
    parts = f"{path}.{uuid.uuid4().hex}"
    head.unionByName(body).orderBy("r", "c").select("value").write.option("compression", "gzip").text(parts)
    if single:
        with remote.created(f"{parts}/_joined") as out:
            for p in remote.parts(parts, ".gz"):
                with remote.opened(p) as f:
                    while piece := f.read(8 << 20):
                        out.write(piece)
        remote.removed(path)
        remote.moved(f"{parts}/_joined", path)
        remote.removed(parts)
    else:
        remote.removed(path)
        remote.moved(parts, path)
    return n


def bam(reads: DataFrame, path: str, contigs: DataFrame, single: bool = False, mode: str = "error", **options: str) -> None:
    """Reads as BAM in the order of the header's contigs (chrom, ix, length), each part with its index; reads without a contig come last.

    A folder of parts, or one file if `single`; the latter copies the packed parts through the driver when they are committed.
    A read on a contig that the header lacks raises.  Places that 32 bits don't hold make their contig as long as they need.
    """
    from . import bam as source

    source.register(reads.sparkSession)
    names = contigs.select("chrom", "length").orderBy("ix").collect()  # a header's lines
    placed = reads.join(contigs.select("chrom", F.col("ix").alias("_ix")), "chrom", "left")
    placed = require(placed, F.col("chrom").isNull() | F.col("_ix").isNotNull(), "contig is not in the header:", "chrom")
    # a sort by ranges looks at its input twice
    rows = staged(placed.select(*reads.columns, "_ix"), "reads")
    places = rows.select("chrom", "pos")
    if {"mate_chrom", "mate_pos"} <= set(rows.columns):
        places = places.unionByName(rows.select(F.col("mate_chrom").alias("chrom"), F.col("mate_pos").alias("pos")))
    far = {r["chrom"]: r["far"] + 1 for r in places.where(F.col("pos") > source.LONGEST).groupBy("chrom").agg(F.max("pos").alias("far")).collect()}  # a row a contig
    lengths = [[r["chrom"], max(r["length"], far.get(r["chrom"], 0))] for r in names]
    ordered = rows.orderBy(F.asc_nulls_last("_ix"), "pos", "name", "flag").select(*reads.columns)
    ordered.write.format("bam").mode("append" if mode == "error" else mode).options(contigs=json.dumps(lengths), single=str(single).lower(), **options).save(path)


def text(lines: DataFrame, path: str) -> None:
    lines.select("value").write.text(path)


def digest(path: str | Path) -> tuple[int, str]:
    """Bytes and SHA-256 of a file, read some megabytes at a time."""
    h, n = hashlib.sha256(), 0
    with remote.opened(str(path)) as f:
        while piece := f.read(8 << 20):
            h.update(piece)
            n += len(piece)
    return n, h.hexdigest()


def fingerprint(path: str | Path) -> dict:
    """Size and time of a file, and its SHA-256 up to 64 MiB."""
    p = Path(path)
    s = p.stat()
    out = {"path": str(p), "size": s.st_size, "mtime_ns": s.st_mtime_ns}
    if s.st_size <= 64 << 20:
        out["sha256"] = digest(p)[1]
    return out


def manifest(path: str | Path, record: dict) -> None:
    """JSON that appears whole or not at all; NaN becomes null.  Written after every other output."""
    clean = json.loads(json.dumps(record), parse_constant=lambda _: None)
    temporary = f"{path}.{uuid.uuid4().hex}"
    with remote.created(temporary) as f:
        f.write((json.dumps(clean, indent=2, sort_keys=True) + "\n").encode())
    remote.moved(temporary, str(path))


def _there(spark, path: str) -> DataFrame | None:
    """What a folder holds, or None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def identity(parameters: dict, inputs: DataFrame | None = None) -> str:
    """A hash of parameters, and of names, sizes and times of input files (name, size, time), whatever their order."""
    text = json.dumps(parameters, sort_keys=True, default=str)
    if inputs is not None:
        r = inputs.agg(F.count("*"), F.sum(F.xxhash64("name", "size", "time").cast("decimal(38,0)"))).first()
        text += f"|{r[0]}|{r[1]}"
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def input_files(spark, *paths: str) -> DataFrame:
    """(name, size, time) of the files below paths; their contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return found.select(F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("size"), F.unix_micros("modificationTime").alias("time"))


def committed(spark, path: str, key: str, identity: str) -> DataFrame | None:
    """(key, attempt, rows) of every key that a write has committed under an identity: of several attempts the first by name."""
    marks = _there(spark, f"{path}/identity={identity}/keys")
    return None if marks is None else marks.groupBy(key).agg(F.min_by("rows", "attempt").alias("rows"), F.min("attempt").alias("attempt")).select(key, "attempt", "rows")


def pending(keys: DataFrame, path: str, key: str, identity: str) -> DataFrame:
    """keys (one column) that no write has committed yet."""
    done = committed(keys.sparkSession, path, key, identity)
    return keys.distinct() if done is None else keys.distinct().join(done.select(key), key, "left_anti")


def read_committed(spark, path: str, key: str, identity: str, schema=None) -> DataFrame:
    """Rows of committed keys; what an unfinished write has left, and a key's rows of later attempts, are passed over.

    A key of which fewer or more rows are there than its write has counted raises.
    """
    done = committed(spark, path, key, identity)
    rows = _there(spark, f"{path}/identity={identity}/data")
    if done is None or rows is None:
        if schema is None:
            raise ValueError(f"nothing is committed under {path}/identity={identity}")
        return spark.createDataFrame([], schema)
    found = rows.groupBy(key, "attempt").agg(F.count("*").alias("n"))
    wrong = done.join(found, [key, "attempt"], "left").where(F.coalesce("n", F.lit(0)) != F.col("rows")).first()
    if wrong is not None:
        raise ValueError(f"{wrong[key]}: {wrong['n'] or 0} of {wrong['rows']} committed rows are there")
    return rows.join(done.select(key, "attempt"), [key, "attempt"]).drop("attempt")


def commit(df: DataFrame, path: str, key: str, identity: str, keys: DataFrame | None = None) -> int:
    """Writes df's rows, then marks its keys (and those of `keys` that have no rows) as committed; returns the rows written.

    Rows go to a folder of their own attempt, marks come last, so a write that stops half-way commits nothing.
    Two writers at a time do no harm: each key counts by one attempt.
    """
    spark, attempt = df.sparkSession, f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{path}/identity={identity}/data/attempt={attempt}")
    rows = spark.read.schema(df.schema).parquet(f"{path}/identity={identity}/data/attempt={attempt}")
    marks = rows.groupBy(key).agg(F.count("*").alias("rows"))
    if keys is not None:
        marks = marks.unionByName(keys.select(key).distinct().join(marks, key, "left_anti").withColumn("rows", F.lit(0).cast("long")))
    marks.write.parquet(f"{path}/identity={identity}/keys/attempt={attempt}")
    return rows.count()


def resumable(df: DataFrame, path: str, key: str, identity: str) -> DataFrame:
    """Commits df's rows key by key under an identity, leaving out keys that an earlier run has committed; returns all committed rows."""
    spark = df.sparkSession
    todo = pending(df.select(key), path, key, identity)
    commit(df.join(todo, key, "left_semi"), path, key, identity)
    return read_committed(spark, path, key, identity, df.schema)
