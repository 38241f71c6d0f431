"""Column builders: everything here stays in Catalyst expressions.

Intervals are struct<a bigint, b bigint>, zero-based and half-open.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

INTERVALS = "array<struct<a:bigint,b:bigint>>"
OPS = "array<struct<n:bigint,op:string>>"
#: SAM flag bits.
UNMAPPED, REVERSE, SECONDARY, QCFAIL, SUPPLEMENTARY = 4, 16, 256, 512, 2048
#: CIGARs of one block, or of two around a junction.
SIMPLE = r"^(?:[0-9]{1,9}[SH])*([0-9]{1,9})[M=X](?:([0-9]{1,9})N([0-9]{1,9})[M=X])?(?:[0-9]{1,9}[SH])*\z"
#: IUPAC bases and their complements.
BASES, COMPLEMENTS = "ACGTRYKMBVDHSWNacgtrykmbvdhswn", "TGCAYRMKVBHDSWNtgcayrmkvbhdswn"


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def has_flag(flag, bits: int) -> Column:
    return col(flag).bitwiseAND(F.lit(bits)) != 0


def nonprimary(flag) -> Column:
    return has_flag(flag, UNMAPPED | SECONDARY | SUPPLEMENTARY | QCFAIL)


def read_strand(flag) -> Column:
    return F.when(has_flag(flag, REVERSE), "-").otherwise("+")


def normalize_gene_id(c) -> Column:
    """Strips a numeric Ensembl version, keeps _PAR_Y, leaves all other dotted names alone."""
    return F.regexp_replace(F.trim(col(c)), r"^(ENS[A-Z]*G\d+)\.\d+(_PAR_Y)?$", "$1$2")


def reverse_complement(seq) -> Column:
    return F.reverse(F.translate(col(seq), BASES, COMPLEMENTS))


def forward_sequence(seq, flag) -> Column:
    return F.when(has_flag(flag, REVERSE), reverse_complement(seq)).otherwise(col(seq))


def cigar_ops(cigar) -> Column:
    """The operations of a CIGAR string; an operation outside MIDNSHP=X raises."""
    c = F.coalesce(col(cigar), F.lit(""))
    parts = F.regexp_extract_all(c, F.lit(r"(\d+[MIDNSHP=X])"), 1)
    known = F.regexp_replace(c, r"\d+[MIDNSHP=X]", "") == ""
    ops = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, r"^\d+", 0).cast("bigint").alias("n"), F.substring(p, -1, 1).alias("op")))
    return F.when(known | c.isin("", "*"), ops).otherwise(F.raise_error(F.concat(F.lit("unsupported CIGAR operation in "), c)).cast(OPS))


def _walk(start, cigar, block_ops: tuple, skip_ops: tuple) -> Column:
    zero = F.struct(col(start).cast("bigint").alias("pos"), F.array().cast(INTERVALS).alias("blocks"), F.array().cast(INTERVALS).alias("junctions"))

    def step(s, o):
        end = s.pos + o.n
        here = F.array(F.struct(s.pos.alias("a"), end.alias("b")))
        return F.struct(
            F.when(o.op.isin(*block_ops, *skip_ops, "N"), end).otherwise(s.pos).alias("pos"),
            F.when(o.op.isin(*block_ops), F.concat(s.blocks, here)).otherwise(s.blocks).alias("blocks"),
            F.when(o.op == "N", F.concat(s.junctions, here)).otherwise(s.junctions).alias("junctions"),
        )

    return F.aggregate(cigar_ops(cigar), zero, step)


def cigar_shape(start, cigar) -> Column:
    """struct<pos, blocks, junctions>: M, = and X align, D advances, N is a junction; pos is the end on the reference.

    One block, or two around a junction, clipped or not, is read off the text without a walk.
    """
    c, p = col(cigar), col(start).cast("bigint")
    n = lambda k: F.regexp_extract(c, SIMPLE, k)
    a = p + n(1).cast("bigint")
    b = a + n(2).cast("bigint")
    e = b + n(3).cast("bigint")
    span = lambda x, y: F.struct(x.alias("a"), y.alias("b"))
    shape = lambda end, blocks, junctions: F.struct(end.alias("pos"), blocks.cast(INTERVALS).alias("blocks"), junctions.cast(INTERVALS).alias("junctions"))
    one, two = shape(a, F.array(span(p, a)), F.array()), shape(e, F.array(span(p, a), span(b, e)), F.array(span(a, b)))
    return F.when(~F.coalesce(F.rlike(c, F.lit(SIMPLE)), F.lit(False)), _walk(start, cigar, ("M", "=", "X"), ("D",))).when(n(2) == "", one).otherwise(two)


def bed_blocks(start, cigar) -> Column:
    """Blocks that only N parts: deletions stay inside, neighbours are joined."""
    return interval_union(_walk(start, cigar, ("M", "=", "X", "D"), ()).getField("blocks"))


def read_end(start, cigar) -> Column:
    return cigar_shape(start, cigar).getField("pos")


def three_prime_clip(cigar, strand) -> Column:
    """Bases that S and H clip at the transcript's 3' end."""
    ops = F.when(col(strand) == "+", F.reverse(cigar_ops(cigar))).otherwise(cigar_ops(cigar))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("going"))
    return F.aggregate(ops, zero, lambda s, o: F.struct((s.n + F.when(s.going & o.op.isin("S", "H"), o.n).otherwise(0)).alias("n"), (s.going & o.op.isin("S", "H")).alias("going")), lambda s: s.n)


def interval_union(intervals) -> Column:
    """Overlapping or adjacent intervals merged, in order."""

    def step(done, x):
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last.a.alias("a"), F.greatest(last.b, x.b).alias("b"))))
        return F.when((F.size(done) > 0) & (x.a <= F.try_element_at(done, F.lit(-1)).b), joined).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(F.array_distinct(col(intervals))), F.array().cast(INTERVALS), step)


def tes_of(strand, exons) -> Column:
    """The transcription end: last exon's end, or first exon's start on the minus strand."""
    return F.when(col(strand) == "+", F.element_at(col(exons), -1).b).otherwise(F.element_at(col(exons), 1).a)


def introns_of(exons) -> Column:
    e = col(exons)
    n = F.greatest(F.size(e) - 1, F.lit(0))
    return F.zip_with(F.slice(e, 1, n), F.slice(e, 2, n), lambda x, y: F.struct(x.b.alias("a"), y.a.alias("b")))


def compatible(blocks, junctions, exons) -> Column:
    """At least one block, every block inside some exon, every junction an intron."""
    inside = F.forall(col(blocks), lambda x: F.exists(col(exons), lambda e: (e.a <= x.a) & (x.b <= e.b)))
    return (F.size(col(blocks)) > 0) & inside & ((F.size(col(junctions)) == 0) | (F.size(F.array_except(col(junctions), introns_of(exons))) == 0))


def spliced_distance(blocks, strand, exons, tes=None) -> Column:
    """Exonic bases from the 3'-most aligned boundary to the transcription end; -1 where `tes` lies beyond the terminal exon's inner edge."""
    e, plus = col(exons), col(strand) == "+"
    ends = F.when(plus, F.array_max(F.transform(col(blocks), lambda x: x.b))).otherwise(F.array_min(F.transform(col(blocks), lambda x: x.a)))
    zero = F.lit(0).cast("bigint")
    base = F.when(plus, F.aggregate(e, zero, lambda s, x: s + F.greatest(zero, x.b - F.greatest(x.a, ends)))).otherwise(F.aggregate(e, zero, lambda s, x: s + F.greatest(zero, F.least(x.b, ends) - x.a)))
    if tes is None:
        return base
    t, own = col(tes), tes_of(strand, exons)
    return F.when(crosses(strand, exons, tes), F.lit(-1).cast("bigint")).otherwise(base + F.when(plus, t - own).otherwise(own - t))


def crosses(strand, exons, tes) -> Column:
    """`tes` lies beyond the terminal exon's inner edge."""
    e, t = col(exons), col(tes)
    return F.when(col(strand) == "+", t < F.element_at(e, -1).a).otherwise(t > F.element_at(e, 1).b)


def splice_chain_match(junctions, exons, tolerance: int = 10) -> Column:
    j, i = col(junctions), introns_of(exons)
    return (F.size(j) == F.size(i)) & F.forall(F.zip_with(j, i, lambda x, y: (F.abs(x.a - y.a) <= tolerance) & (F.abs(x.b - y.b) <= tolerance)), lambda x: x)


def terminal_exon_overlap(blocks, junctions, strand, exons) -> Column:
    """A block beyond the last junction (before the first on the minus strand) overlaps the terminal exon."""
    plus, j = col(strand) == "+", col(junctions)
    exon = F.when(plus, F.element_at(col(exons), -1)).otherwise(F.element_at(col(exons), 1))
    beyond = lambda x: F.when(F.size(j) == 0, True).when(plus, x.a >= F.try_element_at(j, F.lit(-1)).b).otherwise(x.b <= F.try_element_at(j, F.lit(1)).a)
    return F.exists(col(blocks), lambda x: beyond(x) & (x.b > exon.a) & (x.a < exon.b))


def terminal_window(exons, strand, window: int = 600) -> Column:
    """The last `window` exonic bases from the 3' end as intervals, nearest first."""
    plus = col(strand) == "+"
    ordered = F.when(plus, F.reverse(col(exons))).otherwise(col(exons))
    zero = F.struct(F.lit(window).cast("bigint").alias("left"), F.array().cast(INTERVALS).alias("got"))

    def step(s, x):
        n = F.least(s.left, x.b - x.a)
        piece = F.struct(F.when(plus, x.b - n).otherwise(x.a).alias("a"), F.when(plus, x.b).otherwise(x.a + n).alias("b"))
        return F.struct((s.left - n).alias("left"), F.when(s.left > 0, F.concat(s.got, F.array(piece))).otherwise(s.got).alias("got"))

    return F.aggregate(ordered, zero, step, lambda s: s.got)


def kde_logpdf(d, samples, bandwidth: float = 30.0, scale: float = 300.0) -> Column:
    """Log density of the reflected Gaussian kernel estimate; exponential where there are no samples; -Infinity below 0 or non-finite."""
    x, s = col(d).cast("double"), col(samples)
    terms = F.flatten(F.transform(s, lambda v: F.array(-F.pow((x - v) / bandwidth, 2) / 2, -F.pow((x + v) / bandwidth, 2) / 2)))
    # one-element arrays bind the terms and their maximum, so that each is worked out once
    summed = lambda t: F.transform(F.array(F.array_max(t)), lambda m: m + F.log(F.aggregate(t, F.lit(0.0), lambda acc, y: acc + F.exp(y - m))))[0]
    fitted = F.transform(F.array(terms), summed)[0] - F.log(F.size(s) * F.lit(bandwidth * math.sqrt(2 * math.pi)))
    outside = x.isNull() | F.isnan(x) | (x < 0) | (F.abs(x) == float("inf"))
    return F.when(outside, F.lit(float("-inf"))).when(F.size(s) == 0, -x / scale - math.log(scale)).otherwise(fitted)


def gtf_attributes(text) -> Column:
    """map<string,string>: quoted attributes first, then key=value pairs that no quoted one has."""
    t = col(text)
    pair = r'([^\s;=]+)\s+"([^"]*)"'
    quoted = F.arrays_zip(F.regexp_extract_all(t, F.lit(pair), 1).alias("key"), F.regexp_extract_all(t, F.lit(pair), 2).alias("value"))
    items = F.filter(F.split(F.regexp_replace(F.trim(t), ";+$", ""), ";"), lambda x: F.contains(x, F.lit("=")))
    plain = F.transform(F.transform(items, lambda x: F.trim(x)), lambda x: F.struct(F.substring_index(x, "=", 1).alias("key"), F.regexp_replace(x, "^[^=]*=", "").alias("value")))

    def made(q, both, names):
        first = F.filter(both, lambda x, i: F.array_position(names, x.key) == i + 1)
        # a key that is quoted twice keeps its last value, as a mapping does
        return F.map_from_entries(F.transform(first, lambda x: F.struct(x.key.alias("key"), F.coalesce(F.try_element_at(F.filter(q, lambda y: y.key == x.key), F.lit(-1)).value, x.value).alias("value"))))

    # one-element arrays bind what is used more than once, so that a text is searched once
    found = F.transform(F.array(F.struct(quoted.alias("q"), plain.alias("p"))), lambda s: F.struct(s.q.alias("q"), F.concat(s.q, s.p).alias("both")))
    return F.transform(F.transform(found, lambda s: F.struct(s.q.alias("q"), s.both.alias("both"), s.both.key.alias("names"))), lambda s: made(s.q, s.both, s.names))[0]


def pacbio_hole(name) -> Column:
    """The hole number of movie/hole/ccs, movie/hole/s_e or movie/hole/ccs/s_e; null otherwise."""
    return F.regexp_extract(col(name), r"^[^/]+/(\d+)/(?:ccs(?:/\d+_\d+)?|\d+_\d+)$", 1).try_cast("int")


def upstream_read_id(c) -> Column:
    return F.substring_index(col(c), "/", 1)


def fragment_cell(c) -> Column:
    """The cell of CB:Z:cell::UB:Z:umi."""
    return F.nullif(F.regexp_extract(col(c), r"^CB:Z:(.*?)::UB:Z:", 1), F.lit(""))
