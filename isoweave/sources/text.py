"""Readers of tabular text; gzip is told by the file's suffix.  Rows that break a rule raise when they are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import numbered


#: What orders lines of files that are read in several parts.
_PLACE = ("_metadata.file_path AS file", "_metadata.file_block_start AS block", "monotonically_increasing_id() AS o")


def require(df: DataFrame, good: Column, message: str, *about: str) -> DataFrame:
    """df, raising on the first row that is not `good`."""
    text = F.concat_ws(" ", F.lit(message), *[F.col(c).cast("string") for c in about])
    return df.where(F.when(F.coalesce(good, F.lit(False)), F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))


def lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def table(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A table with a header, every column as string."""
    return spark.read.csv(path, sep=sep, header=True, inferSchema=False, mode="FAILFAST")


def barcodes(spark: SparkSession, path: str) -> DataFrame:
    """(cell): the distinct first fields of lines that are not blank."""
    return lines(spark, path).where(F.trim("value") != "").select(F.split(F.trim("value"), "\t")[0].alias("cell")).distinct()


def quant(spark: SparkSession, path: str) -> DataFrame:
    """(name, value): TPM, or NumReads only where the file has no TPM column; duplicates, negative and non-finite values raise."""
    t = table(spark, path)
    if "Name" not in t.columns or not {"TPM", "NumReads"} & set(t.columns):
        raise ValueError("quant.sf requires Name and TPM or NumReads")
    measure = "TPM" if "TPM" in t.columns else "NumReads"
    v = t.select(F.col("Name").alias("name"), F.col(measure).try_cast("double").alias("value"))
    v = require(v, (F.col("value") >= 0) & (F.col("value") < float("inf")), f"invalid {measure} for", "name")
    counted = v.withColumn("n", F.count("*").over(Window.partitionBy("name")))
    return require(counted, F.col("n") == 1, "duplicate transcript row:", "name").drop("n")


def tes(spark: SparkSession, path: str) -> DataFrame:
    """(id, tes, weight): integer ends; a blank or missing count is 1; every transcript's total must be positive."""
    t = table(spark, path)
    if not {"transcript_id", "tes"} <= set(t.columns):
        raise ValueError("TES TSV requires transcript_id and tes")
    weight = F.when(F.coalesce("count", F.lit("")) == "", 1.0).otherwise(F.col("count").try_cast("double")) if "count" in t.columns else F.lit(1.0)
    v = t.select(F.col("transcript_id").alias("id"), F.col("tes").try_cast("double").alias("x"), weight.alias("weight"))
    v = require(v, (F.col("x") == F.floor("x")) & (F.col("x") >= 0) & (F.col("x") < float("inf")), "TES position must be an integer boundary:", "id")
    v = require(v, (F.col("weight") >= 0) & (F.col("weight") < float("inf")), "TES weights must be finite and not negative:", "id")
    total = v.withColumn("total", F.sum("weight").over(Window.partitionBy("id")))
    return require(total, F.col("total") > 0, "TES weights must have positive total:", "id").select("id", F.col("x").cast("bigint").alias("tes"), "weight")


def consensus_assignments(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, model) of lines `model <tab> id,id,...`; comments and a header are skipped."""
    f = F.split("value", "\t")
    rows = lines(spark, path).where((F.trim("value") != "") & ~F.col("value").startswith("#")).select(F.trim(f[0]).alias("model"), f[1].alias("ids"))
    rows = rows.where(~F.lower("model").isin("pbid", "id", "isoform"))
    return rows.select(F.explode(F.filter(F.transform(F.split("ids", ","), lambda x: F.trim(x)), lambda x: x != "")).alias("source_id"), "model")


def raw_assignments(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, length, model) of a table with columns id, length and pbid, whatever their case; lengths are positive whole numbers."""
    t = table(spark, path)
    names = {c.strip().lower(): c for c in t.columns}
    model = next((names[c] for c in ("pbid", "pb_id", "isoform") if c in names), None)
    if "id" not in names or "length" not in names or model is None:
        raise ValueError("read_stat requires id, length and pbid")
    v = t.select(F.col(names["id"]).alias("source_id"), F.col(names["length"]).try_cast("int").alias("length"), F.col(model).alias("model"))
    return require(v, F.col("length") > 0, "length must be a positive whole number:", "source_id")


def clusters(spark: SparkSession, path: str) -> DataFrame:
    """(cell, cluster) of a CSV with Barcode and Cluster; barcodes are unique and not empty."""
    t = table(spark, path, ",")
    if not {"Barcode", "Cluster"} <= set(t.columns):
        raise ValueError("clusters require Barcode and Cluster")
    v = t.select(F.trim("Barcode").alias("cell"), F.trim("Cluster").alias("cluster"))
    v = v.withColumn("n", F.count("*").over(Window.partitionBy("cell")))
    return require(v, (F.col("cell") != "") & (F.col("cluster") != "") & (F.col("n") == 1), "bad cluster row:", "cell").drop("n")


def column(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(ix, value): one named TSV column in file order."""
    t = table(spark, path).selectExpr(f"`{name}` AS value", *_PLACE)
    return numbered(t, "ix", "file", "block", "o").select("value", (F.col("ix") - 1).cast("int").alias("ix"))


def matrix_market(spark: SparkSession, path: str, cells: DataFrame, features: DataFrame) -> DataFrame:
    """(cell, feature, value) of a coordinate file with the ids of rows and columns, (ix, value) from 0; shape, repeats and bad values raise."""
    body = lines(spark, path).where(~F.col("value").startswith("%") & (F.trim("value") != "")).selectExpr("value", *_PLACE)
    f = F.split(F.trim("value"), r"\s+")
    size = body.orderBy("file", "block", "o").limit(1).select(f[0].cast("int").alias("r"), f[1].cast("int").alias("c"), f[2].cast("long").alias("n"), "o").first()
    if size is None or (size["r"], size["c"]) != (cells.count(), features.count()):
        raise ValueError("matrix shape does not match its ids")
    t = body.where(F.col("o") != size["o"]).select(f[0].try_cast("int").alias("r"), f[1].try_cast("int").alias("c"), f[2].try_cast("double").alias("value"))
    good = (F.col("value") >= 0) & (F.col("value") < float("inf")) & F.col("r").between(1, size["r"]) & F.col("c").between(1, size["c"])
    t = require(t, good, "bad matrix entry", "r", "c").withColumn("k", F.count("*").over(Window.partitionBy("r", "c")))
    t = require(t, F.col("k") == 1, "repeated matrix entry", "r", "c")
    t = t.join(cells.select((F.col("ix") + 1).alias("r"), F.col("value").alias("cell")), "r").join(features.select((F.col("ix") + 1).alias("c"), F.col("value").alias("feature")), "c")
    return t.select("cell", "feature", "value")


def catalog_json(spark: SparkSession, path: str) -> DataFrame:
    """(id, gene_id, gene_name, chrom, strand, exons, lr_count, source, seq) of a JSON catalog; `fl` of long-read models is their support."""
    model = "array<struct<id:string,exons:array<array<bigint>>,fl:double>>"
    schema = f"genes map<string,struct<gene_id:string,gene_name:string,chrom:string,strand:string,ref:{model},lr:{model}>>"
    g = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("genes").alias("key", "g"))
    models = lambda c, source: F.transform(F.coalesce(c, F.array().cast(model)), lambda m: F.struct(m.id.alias("id"), m.exons.alias("e"), (F.coalesce(m.fl, F.lit(0.0)) if source == "pigeon" else F.lit(0.0)).alias("lr_count"), F.lit(source).alias("source")))
    rows = g.select("key", "g", F.posexplode(F.concat(models(F.col("g.ref"), "reference"), models(F.col("g.lr"), "pigeon"))).alias("seq", "m"))
    exons = F.array_sort(F.transform("m.e", lambda x: F.struct(x[0].alias("a"), x[1].alias("b"))))
    gid = F.coalesce("g.gene_id", "key")
    return rows.select("m.id", gid.alias("gene_id"), F.coalesce("g.gene_name", gid).alias("gene_name"), "g.chrom", "g.strand", exons.alias("exons"), "m.lr_count", "m.source", "seq")


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, seq) of a FASTA file: one row per record, split by the header sign, so that files are read in parallel."""
    rec = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "")
    return rec.select(F.regexp_extract("value", r"^(\S+)", 1).alias("chrom"), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", "").alias("seq"))


def bed(spark: SparkSession, path: str) -> DataFrame:
    """Six-column BED rows; a malformed row raises."""
    t = spark.read.csv(path, sep="\t", schema="chrom string, start bigint, end bigint, strand string, read string, molecule string", mode="FAILFAST", enforceSchema=True)
    return require(t, (F.col("start") >= 0) & (F.col("end") > F.col("start")) & F.col("strand").isin("+", "-") & F.col("molecule").isNotNull(), "malformed BED row", "chrom", "start")
