"""The union of a reference and classified long-read models."""

import pytest
from pyspark.sql import functions as F

from isoweave.operators import catalog

GTF = ["# reference"] + [f'chr1\tr\texon\t{a}\t{b}\t.\t+\t.\tgene_id "ENSG1.4"; gene_name "A"; transcript_id "{t}";' for t in ("R2", "R1") for a, b in ((31, 40), (11, 20))]
GFF = ['chr1\tp\texon\t11\t20\t.\t+\t.\ttranscript_id "PB.1";', 'chr1\tp\texon\t31\t40\t.\t+\t.\ttranscript_id "PB.1";', "chr2\tp\texon\t101\t130\t.\t-\t.\tParent=PB.2", "chr2\tp\texon\t101\t130\t.\t-\t.\tParent=PB.3", "chr2\tp\texon\t101\t130\t.\t-\t.\tParent=PB.4", "chr3\tp\texon\t7\t9\t.\t-\t.\tParent=PB.4"]
ROWS = [("PB.1", "chr1", "+", "ENSG1.9", "full-splice_match", "7"), ("PB.3", "", "", "NOVELG", "novel_not_in_catalog", ""), ("PB.2", "chr2", "-", "NOVELG", "genic", "3"), ("PB.4", "", "", "NOVELG", "genic", "5"), ("PB.5", "", "", "A", "fusion", "x")]


def loaded(spark, gtf=GTF, gff=GFF, rows=ROWS):
    lines = lambda x: spark.createDataFrame([(v, k) for k, v in enumerate(x)], "value string, seq long")
    c = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "isoform string, chrom string, strand string, associated_gene string, structural_category string, fl_assoc string, seq long")
    return catalog.load_union(catalog.gtf_exons(lines(gtf)), catalog.gtf_exons(lines(gff).drop("seq")), c)


def test_union_merges_equal_structures_and_keeps_novel_genes(spark):
    tx, aliases, outcomes = loaded(spark)
    got = {r["id"]: r for r in tx.withColumn("exons", F.col("exons").cast("string")).collect()}
    # a first reference row stands for all; among long-read models the one that is classified first
    assert {k: (r["gene_id"], r["exons"], r["lr_count"], r["source"], r["removed"]) for k, r in got.items()} == {
        "R2": ("ENSG1.4", "[{10, 20}, {30, 40}]", 7.0, "pigeon+reference", 2),
        "PB.3": ("NOVELG", "[{100, 130}]", 3.0, "pigeon", 1),
    }
    assert sorted(map(tuple, aliases.collect())) == [("PB.1", "R2"), ("PB.2", "PB.3"), ("PB.3", "PB.3"), ("R1", "R2"), ("R2", "R2")]
    assert {r["isoform"]: r["reason"] for r in outcomes.collect() if r["reason"]} == {"PB.4": "missing_or_conflicting_structure", "PB.5": "unsupported_category"}


@pytest.mark.parametrize(("change", "message"), [
    ({"gtf": [*GTF, GTF[1].replace("chr1", "chr7")]}, "spans loci"),
    ({"gtf": [GTF[1].replace("gene_id", "gene")]}, "lacks gene_id"),
    ({"rows": [*ROWS, ROWS[1]]}, "duplicate Pigeon"),
    ({"rows": [(*ROWS[0][:5], "-1")]}, "fl_assoc"),
    ({"rows": [(*ROWS[0][:5], "many")]}, "fl_assoc"),
    ({"gff": [x.replace("PB.2", "R1") for x in GFF], "rows": [("R1", "", "", "B", "genic", "1")]}, "conflicting gene"),
])
def test_union_raises(spark, change, message):
    with pytest.raises(Exception, match=message):
        loaded(spark, **change)[2].collect()
