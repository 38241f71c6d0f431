"""Operator 12: how five filters interact, by the multilinear extension of what they remove.

Every document gets a mask of the filters that it fails.  The counts of the 32 masks
are all that a part (a value of `source`) needs.  They give its removal polynomial: the
multilinear function of x_A .. x_E whose value at a corner (each x 0 or 1) is the number
of documents that the filters with x = 1 remove together.  The Shapley value of a filter
is the integral over t from 0 to 1 of the partial derivative at (t, t, t, t, t), worked
out in exact rationals and scaled by the 120 orders.  What stays and goes after each
step of an order are values at corners.

Filter E asks for the smallest doc_id of every text.  Texts travel as SHA-256; rows are
counted by (doc_id, text, part) first and by (text, part) next, so that neither a text
nor an id that many rows share reaches one task row by row.

Nulls: a null text counts as empty, a null source as the part ''.  A null doc_id is no
smaller doc_id than any other, and none is smaller than it; such rows have no labels.
Rows that share a doc_id count one by one and are no copies of each other; a document is
good (toxic) if any row of the labels with its id says so.  An empty table gives no rows.
Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import combinations, permutations
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import picked, written

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Every set of filters as a mask; the filter at place k has the bit 1 << k.
SETS = range(1 << len(FILTERS))
#: What bounds words.
BLANKS = " \t\n\x0b\x0c\r"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SCHEMA = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failures(text: Column) -> Column:
    """Mask of the filters A to D that a text fails (E needs the other texts)."""
    inner = F.trim(text, F.lit(BLANKS))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "[ \\t-\\r]+"))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    points = F.length(text)
    capitals = points - F.length(F.translate(text, _CAPITALS, ""))
    tests = (n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * points, text.rlike("[#$%&*|]"))
    return sum((F.when(t, 1 << k).otherwise(0) for k, t in enumerate(tests)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters that they fail, of 32 masks at most a part."""
    text = F.coalesce("text", F.lit(""))
    rows = picked(docs, "doc_id", "text", "source").select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("sha"), failures(text).alias("mask"))
    # the texts are read once; what follows looks at these short rows several times
    rows = written(docs.sparkSession, rows.groupBy("doc_id", "sha", "part", "mask").agg(F.count("*").alias("n")), "audit")
    said = picked(labels, "doc_id", "quality", "toxic").where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    told = rows.where("doc_id IS NOT NULL").join(said, "doc_id", "left")
    told = told.unionByName(rows.where("doc_id IS NULL"), allowMissingColumns=True)
    told = told.select("doc_id", "sha", "part", "mask", "n", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # a text, part and labels at a time: how many rows, how many with the smallest id among them, how many without an id
    groups = told.groupBy("sha", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("n_null")
    )
    firsts = groups.groupBy("sha").agg(F.min("first").alias("lowest"))
    both = groups.join(firsts, "sha")
    alone = F.col("n_null") + F.when(F.col("first") == F.col("lowest"), F.col("n_first")).otherwise(0)
    cases = F.array(F.struct("mask", alone.alias("n")), F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - alone).alias("n")))
    each = both.select("part", "good", "toxic", F.explode(cases).alias("c")).where("c.n > 0")
    counted = lambda flag: F.sum(F.when(F.col(flag), F.col("c.n")).otherwise(0))
    return each.groupBy("part", F.col("c.mask").alias("mask")).agg(F.sum("c.n").alias("n"), counted("good").alias("good"), counted("toxic").alias("toxic"))


def removal_polynomial(counts: dict[int, int]) -> dict[int, int]:
    """Coefficients by monomial (a set of filters as a mask) of the documents removed, from how many fail exactly which filters.

    A document that fails the set m goes unless all of m are off: 1 - prod over m of (1 - x), which is
    the sum over the non-empty subsets s of m of (-1) ** (|s| + 1) * prod over s of x.
    """
    return {s: (-1) ** (s.bit_count() + 1) * sum(n for m, n in counts.items() if m & s == s) for s in SETS if s}


def at_corner(polynomial: dict[int, int], on: int) -> int:
    """Value where the filters of `on` have x = 1 and the others 0."""
    return sum(a for s, a in polynomial.items() if s & on == s)


def shapley(polynomial: dict[int, int], filter_: int) -> Fraction:
    """Integral over t of the partial derivative by a filter's x, all x = t: a monomial s that holds it gives a * t ** (|s| - 1)."""
    return sum((Fraction(a, s.bit_count()) for s, a in polynomial.items() if s >> filter_ & 1), Fraction(0))


def audit(counts: dict[int, tuple[int, int, int]]) -> list[tuple]:
    """Rows of SCHEMA without the part: every order and step, from (all, good, toxic) documents by mask."""
    of = [{m: c[k] for m, c in counts.items()} for k in range(3)]
    polynomials = [removal_polynomial(c) for c in of]
    corners = [[at_corner(p, s) for s in SETS] for p in polynomials]
    total = sum(of[0].values())
    fails = [corners[0][1 << k] for k in range(len(FILTERS))]
    alone = [of[0].get(1 << k, 0) for k in range(len(FILTERS))]
    value = [shapley(polynomials[0], k) * factorial(len(FILTERS)) for k in range(len(FILTERS))]
    if any(v.denominator != 1 for v in value):
        raise ArithmeticError("a sum over all orders is no whole number")
    out = []
    for order in ORDERS:
        on = 0
        for step, letter in enumerate(order, 1):
            k = FILTERS.index(letter)
            now = on | 1 << k
            gone, good, toxic = (c[now] - c[on] for c in corners)
            out.append((order, step, total - corners[0][now], gone, fails[k] - gone, alone[k], good, toxic, int(value[k])))
            on = now
    return out


def interactions(counts: DataFrame) -> DataFrame:
    """Rows of SCHEMA of every part of mask_counts; a task holds the counts of one part at a time, of which there are 32."""
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    columns = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(frames):
        for pdf in frames:
            for part, found in zip(pdf["part"], pdf["counts"], strict=True):
                rows = audit({int(c["mask"]): (int(c["n"]), int(c["good"]), int(c["toxic"])) for c in found})
                yield pd.DataFrame([(part, *r) for r in rows], columns=columns)

    return parts.mapInPandas(run, SCHEMA)


def pairs_at(counts: DataFrame) -> DataFrame:
    """(part, first, second, both, either): how many documents two filters remove together, from the mask counts alone."""
    bits = {f: 1 << k for k, f in enumerate(FILTERS)}
    has = lambda f: F.col("mask").bitwiseAND(bits[f]) != 0
    sums = [s for a, b in combinations(FILTERS, 2) for s in (F.sum(F.when(has(a) & has(b), F.col("n")).otherwise(0)).alias(f"{a}{b}_both"), F.sum(F.when(has(a) | has(b), F.col("n")).otherwise(0)).alias(f"{a}{b}_either"))]
    wide = counts.groupBy("part").agg(*sums)
    each = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"{a}{b}_both").alias("both"), F.col(f"{a}{b}_either").alias("either")) for a, b in combinations(FILTERS, 2)])
    return wide.select("part", F.explode(each).alias("p")).select("part", "p.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(mask_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")))
