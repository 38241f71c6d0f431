"""Genomics views over the driver's tables.

The SQL below reads alike in Spark and DuckDB: integer arithmetic, no dialect.
Spark queries get the views as DataFrames; SQL texts get them as CTEs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SQL = {
    "x_part": """SELECT p_partkey, CAST(FLOOR(p_partkey / 5) AS BIGINT) AS g, p_partkey % 5 AS k, p_size, p_retailprice,
        CASE WHEN CAST(FLOOR(p_partkey / 5) AS BIGINT) % 2 = 0 THEN '+' ELSE '-' END AS strand,
        CAST(FLOOR(CAST(FLOOR(p_partkey / 5) AS BIGINT) / 5) AS BIGINT) * 20000 + 1000 AS s FROM part""",
    "v_exon": """SELECT concat('T', p_partkey) AS id, concat('ENSG', g) AS gene_id, concat('chr', g % 5) AS chrom, strand, CAST(j AS BIGINT) AS j,
        CAST(s + 2000 * j - (CASE WHEN k = 3 AND strand = '-' AND j = 0 THEN 100 * (p_size % 3) ELSE 0 END)
            + (CASE WHEN k = 4 AND p_size % 7 <> 0 AND strand = '+' AND j = 0 THEN 50 ELSE 0 END) AS BIGINT) AS a,
        CAST(s + 2000 * j + 300 + (CASE WHEN k = 3 AND strand = '+' AND j = 3 THEN 100 * (p_size % 3) ELSE 0 END)
            - (CASE WHEN k = 4 AND p_size % 7 <> 0 AND strand = '-' AND j = 3 THEN 50 ELSE 0 END) AS BIGINT) AS b
        FROM x_part CROSS JOIN (VALUES (0), (1), (2), (3)) AS slots(j) WHERE NOT (k = 1 AND j = 1) AND NOT (k = 2 AND j = 2)""",
    "v_meta": """SELECT concat('T', p_partkey) AS id, concat('ENSG', g) AS gene_id, concat('chr', g % 5) AS chrom, strand, p_partkey AS seq,
        CASE WHEN k = 0 THEN 'reference' ELSE 'pigeon' END AS source, CAST(CASE WHEN k = 0 THEN 0 ELSE p_size % 10 END AS DOUBLE) AS lr_count,
        CAST(CAST(FLOOR(p_retailprice) AS BIGINT) % 97 AS DOUBLE) AS tpm FROM x_part""",
    "v_cells": "SELECT concat('C', s_suppkey, '-1') AS cell, s_nationkey % 5 AS cluster FROM supplier WHERE s_acctbal > 0",
    "x_line": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber AS n, CAST(FLOOR(l_partkey / 5) AS BIGINT) AS g,
        CAST(FLOOR(CAST(FLOOR(l_partkey / 5) AS BIGINT) / 5) AS BIGINT) * 20000 + 1000 AS s, l_returnflag, l_linestatus, l_quantity,
        CAST(ROUND(100 * l_discount) AS INT) AS disc, CAST(ROUND(100 * l_tax) AS INT) AS tax FROM lineitem""",
    "v_reads": """SELECT concat('r', l_orderkey, '_', n, '_', l_partkey) AS name, concat('C', l_suppkey, '-1') AS cell, concat('U', l_orderkey % 8) AS umi, concat('chr', g % 5) AS chrom,
        CAST(CASE WHEN n <= 4 THEN s + 2000 * (n - 1) + (l_orderkey * 13 + 29 * n) % 260 + (CASE WHEN disc = 1 THEN 1000 ELSE 0 END)
            WHEN n = 5 THEN s + 2000 * (l_orderkey % 3) + 280 WHEN n = 6 THEN s + 2280 ELSE s + 280 END AS BIGINT) AS pos,
        CASE WHEN n <= 4 THEN '40M' WHEN n = 5 THEN '20M1700N20M' ELSE '20M3700N20M' END AS cigar,
        CAST((CASE WHEN (g % 2 = 1) <> (tax = 8) THEN 16 ELSE 0 END) + (CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN 256 ELSE 0 END) AS INT) AS flag,
        CASE WHEN disc = 0 THEN NULL WHEN disc = 10 THEN concat('ENSG', g, ';ENSG', g + 1) WHEN g % 2 = 0 THEN concat('ENSG', g, '.1') ELSE concat('ENSG', g) END AS gx,
        g, n, CAST(l_orderkey % 61 AS INT) AS mapq, l_orderkey FROM x_line""",
    "v_tes": """SELECT t.id, CAST(CASE WHEN t.strand = '+' THEN t.b - CAST(l.l_quantity AS BIGINT) % 40 ELSE t.a + CAST(l.l_quantity AS BIGINT) % 40 END AS BIGINT) AS tes, CAST(l.n AS DOUBLE) AS weight
        FROM x_line l JOIN (SELECT id, strand, MIN(a) AS a, MAX(b) AS b FROM v_exon GROUP BY id, strand) t ON t.id = concat('T', l.l_partkey) WHERE l.l_linestatus = 'F'""",
    "x_bounds": "SELECT gene_id, chrom, strand, MIN(a) AS lo, MAX(b) AS hi FROM v_exon GROUP BY gene_id, chrom, strand",
}
NEEDS = {"v_exon": ["x_part"], "v_meta": ["x_part"], "v_reads": ["x_line"], "v_tes": ["x_line", "v_exon"], "x_bounds": ["v_exon"]}
TABLES = {"x_part": "part", "v_cells": "supplier", "x_line": "lineitem"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views as a DataFrame."""
    text = SQL[name]
    frames = {}
    if name in TABLES:
        frames[TABLES[name]] = spark.read.parquet(f"{sf_dir}/{TABLES[name]}.parquet")
    for need in NEEDS.get(name, []):
        frames[need] = view(spark, sf_dir, need)
    for k in frames:
        text = _named(text, k)
    return spark.sql(text, **frames)


def _named(text: str, name: str) -> str:
    import re

    return re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, gene_id, chrom, strand, exons, lr_count, source, tpm, seq), exons in order."""
    exons = view(spark, sf_dir, "v_exon").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("exons"))
    return view(spark, sf_dir, "v_meta").join(exons, "id")


def abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_meta").select("id", F.col("tpm").alias("value"))


def ctes(*names: str) -> list[tuple[str, str]]:
    """(name, SQL) of the views, needs first."""
    out: dict[str, str] = {}

    def add(n):
        for need in NEEDS.get(n, []):
            add(need)
        out.setdefault(n, SQL[n])

    for n in names:
        add(n)
    return list(out.items())
