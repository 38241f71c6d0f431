"""The jobs as registered queries: each runs twice into one new folder and returns what it has written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoweave.plans.oracles import variants_sql
from isoweave.storage import shared_dir

from . import ledger, quantify


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def job1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents; the second run finds nothing new."""
    at = _folder(spark, "job1")
    for _ in range(2):
        got = ledger.run(spark, f"{sf_dir}/documents.parquet", at, f"{at}/checkpoint")
    return got.select(F.col("part").alias("source"), F.col("id").alias("doc_id"), "sha256", "bytes", "lines", "arrivals", "first_id", "repeated_lines")


def job2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected counts of all variants; the second run finds every gene committed.  SQL has no seeded reservoir, so the capture model takes the first molecules."""
    at = _folder(spark, "job2")
    for _ in range(2):
        got = quantify.run(spark, sf_dir, at, {"seed": None})
    return got.select("variant", "chrom", "cell", "gene_id", "transcript_id", F.round("expected", 4).alias("expected"))


QUERIES = {"job1_ledger": job1, "job2_quantify": job2}

_LEDGER = r"""
WITH texts AS (
    SELECT source, doc_id, coalesce(text, '') AS t FROM documents
), rows AS (
    SELECT source, doc_id, t, sha256(t) AS sha256, count(*) AS arrivals FROM texts GROUP BY ALL
), firsts AS (
    SELECT source, sha256, min(doc_id) AS first_id FROM rows GROUP BY ALL
), lines AS (
    SELECT DISTINCT source, doc_id, sha256, unnest(string_split(t, chr(10))) AS line FROM rows WHERE doc_id IS NOT NULL
), lowest AS (
    SELECT source, line, min(doc_id) AS low FROM lines WHERE length(line) >= 40 GROUP BY ALL
), late AS (
    SELECT l.source, doc_id, sha256, count(*) AS n FROM lines l JOIN lowest w ON l.line = w.line AND l.source IS NOT DISTINCT FROM w.source WHERE doc_id > low GROUP BY ALL
)
SELECT r.source, r.doc_id, r.sha256, strlen(t)::BIGINT AS bytes, len(string_split(t, chr(10)))::BIGINT AS lines, arrivals::BIGINT AS arrivals, first_id, coalesce(n, 0)::BIGINT AS repeated_lines
FROM rows r JOIN firsts f ON f.sha256 = r.sha256 AND f.source IS NOT DISTINCT FROM r.source
LEFT JOIN late x ON x.sha256 = r.sha256 AND x.doc_id = r.doc_id AND x.source IS NOT DISTINCT FROM r.source
"""

ORACLE_SQL = {"job1_ledger": _LEDGER, "job2_quantify": variants_sql("SELECT '{v}' AS variant, m.chrom, c.cell, c.gene_id, c.id AS transcript_id, round(c.\"count\", 4) AS expected FROM {t} c JOIN v_meta m USING (id)")}
