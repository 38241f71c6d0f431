"""Job: a ledger of input texts, kept up to date as files arrive.

A run that is resumed, and a bundle of inputs that several runs share, must know what
the inputs were: sizes and hashes of each, and which of them repeat others.  The ledger
has one row for every text of a part (by id and hash), with

* its bytes and lines and how many times it arrived,
* the smallest id of the part that has the same text,
* how many of its distinct long lines stand under a smaller id of the part as well.

Texts are read once, as files arrive (a file stream with a checkpoint).  A batch leaves
entries, which hold hashes only, in folders of the batch's own number, so a batch that
is repeated replaces itself.  Then the buckets of parts that have entries newer than
their ledger are written anew from their entries; the others are not touched.

    python -m jobs.ledger --texts PATH --out PATH --checkpoint PATH [--config jobs/ledger.json]

--out gets `entries` (by bucket and batch) and `ledger` (by bucket).  Nulls: a null text
counts as empty, a null part or id is a value of its own; texts without an id follow none.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("jobs.ledger")

DEFAULTS = {"id": "doc_id", "text": "text", "part": "source", "long_line": 40, "buckets": 16, "files_per_batch": 1000}
LEDGER = "part string, id long, sha256 string, bytes long, lines long, arrivals long, first_id long, repeated_lines long, upto long, bucket int"


def entries(texts: DataFrame, c: dict) -> DataFrame:
    """What the ledger keeps of each text: no words, but hashes of it and of its distinct long lines."""
    text = F.coalesce(F.col(c["text"]), F.lit(""))
    rows = F.split(text, "\n")
    long = F.array_distinct(F.transform(F.filter(rows, lambda x: F.length(x) >= c["long_line"]), lambda x: F.unhex(F.md5(x))))
    return texts.select(
        F.col(c["part"]).cast("string").alias("part"), F.col(c["id"]).cast("long").alias("id"), F.sha2(text, 256).alias("sha256"), F.octet_length(text).cast("long").alias("bytes"),
        F.size(rows).cast("long").alias("lines"), long.alias("marks"), F.pmod(F.xxhash64(F.col(c["part"]).cast("string")), F.lit(c["buckets"])).cast("int").alias("bucket"),
    )


def assembled(found: DataFrame) -> DataFrame:
    """Rows of the ledger from entries; keys are compared with nulls equal."""
    texts = found.groupBy("bucket", "part", "id", "sha256").agg(F.max("bytes").alias("bytes"), F.max("lines").alias("lines"), F.count("*").alias("arrivals"), F.first("marks").alias("marks"), F.max("batch").alias("upto"))
    same = texts.groupBy(F.col("part").alias("p"), F.col("sha256").alias("s")).agg(F.min("id").alias("first_id"))
    with_first = texts.join(same, F.col("part").eqNullSafe(F.col("p")) & (F.col("sha256") == F.col("s"))).drop("p", "s")
    lines = texts.where("id IS NOT NULL").select("part", "id", F.explode("marks").alias("mark")).distinct()
    firsts = lines.groupBy(F.col("part").alias("p"), F.col("mark").alias("m")).agg(F.min("id").alias("lowest"), F.max("id").alias("highest")).where("lowest < highest").drop("highest")
    late = texts.where("id IS NOT NULL").select("part", "id", "sha256", F.explode("marks").alias("mark")).join(firsts, F.col("part").eqNullSafe(F.col("p")) & (F.col("mark") == F.col("m"))).where("id > lowest")
    repeated = late.groupBy(F.col("part").alias("p"), F.col("id").alias("i"), F.col("sha256").alias("s")).agg(F.count("*").alias("repeated_lines"))
    out = with_first.join(repeated, F.col("part").eqNullSafe(F.col("p")) & (F.col("id") == F.col("i")) & (F.col("sha256") == F.col("s")), "left")
    return out.select("part", "id", "sha256", "bytes", "lines", "arrivals", "first_id", F.coalesce("repeated_lines", F.lit(0)).cast("long").alias("repeated_lines"), "upto", "bucket")


def _there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _put(rows: DataFrame, path: str, *by: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def run(spark: SparkSession, texts: str, out: str, checkpoint: str, config: dict | None = None) -> DataFrame:
    """Takes the files that are new below `texts` (a folder of Parquet files, or one file), brings the ledger up to date and returns it."""
    c = DEFAULTS | (config or {})
    if c["buckets"] < 1 or c["long_line"] < 1:
        raise ValueError("buckets and long_line must be at least 1")
    known = spark.read.parquet(texts)
    stream = spark.readStream.schema(known.schema).option("maxFilesPerTrigger", c["files_per_batch"])
    name = texts.rstrip("/").rsplit("/", 1)[-1]
    if [f.rsplit("/", 1)[-1] for f in known.inputFiles()] == [name]:  # one file: its folder is watched for this name
        stream, texts = stream.option("pathGlobFilter", name), texts.rstrip("/").rsplit("/", 1)[0]

    def batch(rows: DataFrame, number: int) -> None:
        _put(entries(rows, c).withColumn("batch", F.lit(number).cast("long")), f"{out}/entries", "bucket", "batch")
        log.info("batch %d: entries written to %s/entries", number, out)

    query = stream.parquet(texts).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(batch).start()
    query.awaitTermination()
    log.info("read %d new texts from %s", sum(p["numInputRows"] for p in query.recentProgress), texts)

    schema = "part string, id long, sha256 string, bytes long, lines long, marks array<binary>, bucket int, batch long"
    found = _there(spark, f"{out}/entries", schema)
    ledger = _there(spark, f"{out}/ledger", LEDGER)
    ahead = found.groupBy("bucket").agg(F.max("batch").alias("newest")).join(ledger.groupBy("bucket").agg(F.max("upto").alias("built")), "bucket", "left")
    stale = [r["bucket"] for r in ahead.where("built IS NULL OR newest > built").select("bucket").collect()]  # no more than there are buckets
    if stale:
        _put(assembled(found.where(F.col("bucket").isin(stale))), f"{out}/ledger", "bucket")
    result = _there(spark, f"{out}/ledger", LEDGER)
    log.info("wrote %d of %d buckets; the ledger in %s/ledger has %d rows", len(stale), c["buckets"], out, result.count())
    return result


def main(argv: list[str] | None = None) -> None:
    a = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("--texts", "--out", "--checkpoint"):
        a.add_argument(name, required=True)
    a.add_argument("--config", help="JSON file with any of " + ", ".join(DEFAULTS))
    o = a.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("ledger").getOrCreate()
    try:
        config = json.loads("\n".join(r["value"] for r in spark.read.text(o.config).collect())) if o.config else None
        run(spark, o.texts, o.out, o.checkpoint, config)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
