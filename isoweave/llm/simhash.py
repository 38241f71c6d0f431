"""Operator 2: SimHash near-dedup by covering locality-sensitive hashing.

fingerprints(): one 64-bit SimHash a document.  links(): pairs within a Hamming
radius, found with structured bit masks.  Each bit position i carries a vector
m(i) of radius+1 bits; table v (any non-zero vector) keeps the bits with
<m(i), v> = 1.  For at most `radius` differing positions some v is orthogonal to
all their vectors, so that table's mask holds none of them and the pair collides
there: no pair within the radius is missed.

Equal fingerprints are collapsed before any table is built, so copies, however
many, make one row.  A bucket that is still too large is split by masks over the
bits that its members do not share yet, again covering, so nothing is capped.
Inside a bucket only a spanning forest of the links is emitted, never all pairs.

Nulls: a null text counts as empty; a document without words has fingerprint 0
and links like any other.  Repeated doc_ids give repeated rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import carried, doc_batches, dropped, freed, lean, min_label_components, own_cache, partitions, spanning, written

#: Members that one bucket compares in one task.
BUCKET = 4096


def word_shingles(text: bytes, width: int, words=bytes.split) -> list[bytes]:
    """The space-joined runs of `width` words, repeats included; a shorter text's only run is all its words."""
    w = words(text)
    if not w:
        return []
    if len(w) <= width:
        return [b" ".join(w)]
    if width == 1:
        return w
    return list(map(b" ".join, zip(*(w[k:] for k in range(width)))))


def simhash(shingles: list[bytes], seed: int) -> int:
    """Bit i is 1 if it is set in over half of the shingles' XXH64."""
    if not shingles:
        return 0
    h = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), "<u8", len(shingles))
    n, count = len(h), np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        count += np.unpackbits(h[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(count * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp long) of every document: words between ASCII white space, A-Z lower-cased."""

    def run(batches):
        for b in doc_batches(batches):
            fps = [simhash(word_shingles(t.encode().lower(), width), seed) if t else 0 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, fp long")


def covering_masks(free: list[int], radius: int) -> list[int]:
    """2**(radius+1) - 1 masks over the bit positions in `free`; position vectors take all non-zero values in turn."""
    n = 2 ** (radius + 1) - 1
    vector = {bit: 1 + (7 * k) % n for k, bit in enumerate(free)}
    return [sum(1 << bit for bit, m in vector.items() if (m & v).bit_count() % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucket_edges(x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the links among distinct fingerprints."""
    us, vs = [], []
    for k in range(0, len(x), 256):
        near = np.bitwise_count(x[k : k + 256, None] ^ x[None, :]) <= radius
        i, j = np.nonzero(near)
        keep = i + k > j
        us.append(x[i[keep] + k])
        vs.append(x[j[keep]])
    u, v = np.concatenate(us), np.concatenate(vs)
    if len(u) > len(x):
        u, v = spanning(u, v)
    return u, v


def links(spark: SparkSession, fps: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that join the distinct values of fps.fp just as all pairs at Hamming distance <= radius would."""
    masks = covering_masks(list(range(64)), radius)
    rows = fps.select(F.explode(F.array(*[F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for m in masks])).alias("k"), "fp").select("k.mask", "k.key", "fp")
    n = fps.count() * len(masks)
    found: list[DataFrame] = []
    for level in count():  # a split leaves fewer bits that members do not share, so this ends
        parts = partitions(spark, n, 2_000_000)

        def run(frames, radius=radius, bucket=bucket):
            for pdf in carried(frames, ["mask", "key"]):
                fp = pdf["fp"].to_numpy(np.int64)
                k1, k2 = pdf["mask"].to_numpy(), pdf["key"].to_numpy()
                starts = np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
                sizes = np.diff(np.r_[starts, len(fp)])
                two = starts[sizes == 2]
                a, b = fp[two], fp[two + 1]
                ok = (np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= radius) & (a != b)
                out = [(a[ok], b[ok])]
                for s, n in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
                    x = np.unique(fp[s : s + n])
                    if len(x) > bucket and (~int(k1[s]) & (2**64 - 1)).bit_count() > 12:
                        yield pd.DataFrame({"a": x, "b": x, "mask": k1[s]})
                    else:
                        u, v = _bucket_edges(x.view(np.uint64), radius)
                        out.append((u.view(np.int64), v.view(np.int64)))
                yield pd.DataFrame({"a": np.concatenate([x for x, _ in out]), "b": np.concatenate([y for _, y in out]), "mask": np.int64(0)})

        got = written(spark, rows.repartition(parts, "mask", "key").sortWithinPartitions("mask", "key").mapInPandas(lean(run), "a long, b long, mask long"), f"simhash-links{level}")
        found.append(got.where("mask = 0").select("a", "b"))
        large = got.where("mask <> 0")
        n = large.count() * len(masks)
        if not n:
            break

        def split(frames, radius=radius):
            for pdf in frames:
                for mask, part in pdf.groupby("mask"):
                    free = [i for i in range(64) if not int(mask) >> i & 1]
                    for m in covering_masks(free, radius):
                        whole = np.int64(_signed((int(mask) & (2**64 - 1)) | m))
                        yield pd.DataFrame({"mask": whole, "key": part["a"].to_numpy() & whole, "fp": part["a"]})

        rows = large.mapInPandas(lean(split), "mask long, key long, fp long")
    return reduce(DataFrame.unionByName, found)


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = 3, seed: int = 42, radius: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): documents linked at Hamming distance <= radius, component named by its smallest doc_id."""
    fps = written(spark, fingerprints(docs, width, seed), "simhash-fp")
    reps = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    edges = links(spark, reps.select("fp"), radius)
    comp = min_label_components(spark, edges, "simhash-cc")
    named = reps.join(comp, reps.fp == comp.id, "left").select("fp", "rep", F.coalesce("component", "fp").alias("root"))
    named = written(spark, named, "simhash-named")
    roots = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_fp = named.join(roots, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def _words(text: bytes) -> list[bytes]:
    """Lower-cased words without the stops around them."""
    return [w for w in (x.strip(b".,;:!?*&%$#|()\"'") for x in text.lower().split()) if w]


#: Buckets up to this size propose all their pairs at once; sampled texts and most shingles for the order of shingles; pairs worked out at once.
SMALL, ORDER_TEXTS, ORDER_MOST, BLOCK = 8, 4000, 100_000, 1 << 20
#: Shingles that a sketch samples at most, or thereabouts; texts of no more have sketches of them all.
SAMPLED = 256


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `width` words; a shorter text's only run is all its words."""
    words = _words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(width, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = (out ^ h[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def prefix(shingles: np.ndarray, order: np.ndarray, rank: np.ndarray, least: float) -> np.ndarray:
    """The shingles of which two sets of Jaccard similarity >= `least` share at least one: all but the last ceil(least * n) - 1 in the common order.

    That order is: shingles outside `order` (sorted) by value, then those in it by `rank`.
    """
    n = len(shingles)
    take = n - int(np.ceil(least * n - 1e-6)) + 1
    if not len(order):
        return shingles[:take]
    at = np.minimum(np.searchsorted(order, shingles), len(order) - 1)
    common = order[at] == shingles
    rare = shingles[~common][:take]
    if len(rare) == take:
        return rare
    later = shingles[common][np.argsort(rank[at[common]], kind="stable")]
    return np.concatenate([rare, later[: take - len(rare)]])


def _may_reach(n_a, n_b, at_a, at_b, least: float):
    """Whether sets of these sizes can be similar if the shingles at these places are the first that they share."""
    most = 1 + np.minimum(n_a - at_a, n_b - at_b) - 1
    return (np.minimum(n_a, n_b) >= least * np.maximum(n_a, n_b) - 1e-6) & (most * (1 + least) >= least * (n_a + n_b) - 1e-6)


class _Pairs:
    """Distinct pairs of keys, larger one first; pressed together whenever many have come."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.n = self.least = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            pairs = np.empty(len(a), [("a", np.int64), ("b", np.int64)])
            pairs["a"], pairs["b"] = np.maximum(a, b), np.minimum(a, b)
            self.parts.append(np.unique(pairs))
            self.n += len(self.parts[-1])

    def full(self) -> bool:
        """Whether so many distinct pairs have come that they should be handed on."""
        if self.n < max(BLOCK, 2 * self.least):
            return False
        self.parts = [np.unique(np.concatenate(self.parts))]
        self.n = self.least = len(self.parts[0])
        return self.n >= BLOCK

    def frame(self) -> pd.DataFrame:
        pairs = np.unique(np.concatenate(self.parts)) if self.parts else np.empty(0, [("a", np.int64), ("b", np.int64)])
        self.parts, self.n, self.least = [], 0, 0
        return pd.DataFrame({"a": pairs["a"], "b": pairs["b"]})


def _ordering(texts: DataFrame, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, ranks): the shingles that several sampled texts share, rarest first. Any order gives the same groups; this one keeps buckets small."""

    def run(batches):
        for b in doc_batches(batches):
            sets = [shingle_set((t or "").encode(), width) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["token"])

    some = texts.where(F.pmod(F.xxhash64(F.lit(7), "key"), F.lit(1 << 30)) < int(min(1.0, ORDER_TEXTS / max(n, 1)) * (1 << 30))).select("text")
    top = some.mapInArrow(lean(run), "token long").groupBy("token").count().where("count > 2").orderBy(F.desc("count"), "token").limit(ORDER_MOST).toPandas()
    top = top.sort_values(["count", "token"], ignore_index=True)
    order = top["token"].to_numpy(np.int64).view(np.uint64)
    rank = np.argsort(order, kind="stable")
    return order[rank], rank


def _buckets(texts: DataFrame, width: int, least: float, order: np.ndarray, rank: np.ndarray) -> DataFrame:
    """(token, key, n, at): the prefix of every text's set of n shingles, and the place of each in it; a task gives equal texts once."""

    def run(batches):
        own_cache("simhash")  # lets go of what other operators kept
        met: set[int] = set()
        for b in doc_batches(batches):
            tokens, sizes, keys, ns = [], [], [], []
            for key, t in zip(b.column("key").to_pylist(), b.column("text").to_pylist(), strict=True):
                if not t or key in met:
                    continue
                met.add(key)
                shingles = shingle_set(t.encode(), width)
                if len(shingles):
                    tokens.append(prefix(shingles, order, rank, least))
                    sizes.append(len(tokens[-1]))
                    keys.append(key)
                    ns.append(len(shingles))
            if tokens:
                at = np.concatenate([np.arange(k, dtype=np.int32) for k in sizes])
                columns = [np.concatenate(tokens).view(np.int64), np.repeat(np.array(keys, np.int64), sizes), np.repeat(np.array(ns, np.int32), sizes), at]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "key", "n", "at"])

    return texts.select("key", "text").mapInArrow(lean(run), "token long, key long, n int, at int")


def _first_pairs(buckets: DataFrame, least: float, small: int = SMALL) -> DataFrame:
    """Rows (a, b) of the pairs of small buckets, and the rows of large ones (a = b = key) with their token.

    Pairs whose sizes or places rule the similarity out are left out: the bucket of the first shingle that two similar texts share never does.
    """

    def run(frames):
        found = _Pairs()
        for pdf in carried(frames, ["token"]):
            token, key, n, at = (pdf[c].to_numpy() for c in ("token", "key", "n", "at"))
            many = np.r_[False, token[1:] == token[:-1]] | np.r_[token[1:] == token[:-1], False]
            token, key, n, at = token[many], key[many], n[many].astype(np.int64), at[many].astype(np.int64)
            o = np.lexsort((key, token))
            o = o[np.r_[True, (token[o][1:] != token[o][:-1]) | (key[o][1:] != key[o][:-1])]] if len(o) else o
            token, key, n, at = token[o], key[o], n[o], at[o]
            starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.zeros(0, np.int64)
            sizes = np.diff(np.r_[starts, len(token)])
            size = np.repeat(sizes, sizes)
            for lag in range(1, min(small, int(sizes.max(initial=1)))):
                i = np.flatnonzero((token[lag:] == token[:-lag]) & (size[lag:] <= small))
                j = i + lag
                ok = _may_reach(n[i], n[j], at[i], at[j], least)
                found.add(key[i[ok]], key[j[ok]])
            large = size > small
            if large.any():
                yield pd.DataFrame({"a": key[large], "b": key[large], "token": token[large], "n": n[large], "at": at[large]})
            if found.full():
                yield found.frame().assign(token=np.int64(0), n=np.int32(-1), at=np.int32(0))
        yield found.frame().assign(token=np.int64(0), n=np.int32(-1), at=np.int32(0))

    return buckets.sortWithinPartitions("token").mapInPandas(lean(run), "a long, b long, token long, n int, at int")


def sketch(shingles: np.ndarray) -> bytes:
    """Two parity sketches of a set, of samples of about SAMPLED shingles and of half as many, with the samples' sizes.

    A sample holds the shingles whose hash begins with `level` zero bits (level 0: all).  Each shingle flips one of
    512 bits, so two sketches differ in at most as many bits as their samples differ in shingles.
    """
    level = max(0, int(np.ceil(np.log2(max(len(shingles), 1) / SAMPLED))))
    out, sizes = [], []
    for k in (level, level + 1):
        part = shingles if not k else shingles[: np.searchsorted(shingles, np.uint64(1 << (64 - k)))]
        out.append(np.packbits((np.bincount((part & np.uint64(511)).astype(np.int64), minlength=512) & 1).astype(bool)).tobytes())
        sizes.append(len(part))
    return b"".join(out) + np.array([level | sizes[0] << 8 | sizes[1] << 32], "<u8").tobytes()


class Sketches:
    """Sketches side by side: words (n, 2, 8), sizes (n, 2), level (n)."""

    def __init__(self, cells):
        raw = np.frombuffer(b"".join(cells), "<u8").reshape(-1, 17)
        last = raw[:, 16].astype(np.int64)
        self.words, self.level, self.sizes = raw[:, :16].reshape(-1, 2, 8), last & 255, np.stack([last >> 8 & 0xFFFFFF, last >> 32], 1)


def _most_apart(total: np.ndarray, least: float, sampled: np.ndarray) -> np.ndarray:
    """In how many shingles samples of `total` shingles together can differ if the sets' similarity is `least` or more.

    Exact where all shingles are in the sample; else six standard deviations above the expected number.
    """
    f = 1 - least
    c = 6 * np.sqrt(f * (1 - f))
    union = ((c + np.sqrt(c * c + 4 * (2 - f) * total)) / (2 * (2 - f))) ** 2
    return np.where(sampled, 2 * union - total, total * f / (2 - f) + 1e-6)


def alike(x: Sketches, i: np.ndarray, y: Sketches, j: np.ndarray, least: float) -> np.ndarray:
    """Whether the sets of x[i[k]] and y[j[k]] may have a similarity of `least`, by their sketches."""
    level = np.maximum(x.level[i], y.level[j])
    p, q = level - x.level[i], level - y.level[j]
    ok = (p < 2) & (q < 2)
    p, q = np.minimum(p, 1), np.minimum(q, 1)
    apart = np.bitwise_count(x.words[i, p] ^ y.words[j, q]).sum(1, dtype=np.int64)
    return ok & (apart <= _most_apart(x.sizes[i, p] + y.sizes[j, q], least, level > 0))


def alike_matrix(x: Sketches, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """alike() of all of i against all of j."""
    out = np.zeros((len(i), len(j)), bool)
    for level in np.unique(np.r_[x.level[i], x.level[j]]).tolist():
        r, c = (np.flatnonzero((x.level[k] == level) | (x.level[k] == level - 1)) for k in (i, j))
        if not len(r) or not len(c):
            continue
        p, q = level - x.level[i[r]], level - x.level[j[c]]
        a, b = x.words[i[r], p], x.words[j[c], q]
        apart = np.zeros((len(r), len(c)), np.uint16)
        for w in range(8):
            apart += np.bitwise_count(a[:, None, w] ^ b[None, :, w])
        total = x.sizes[i[r], p][:, None] + x.sizes[j[c], q][None, :]
        hit = (apart <= _most_apart(total, least, np.bool_(level > 0))) & ((p == 0)[:, None] | (q == 0)[None, :])
        out[np.ix_(r, c)] |= hit
    return out


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Whole buckets in order.  `rows` must be a written table: above a join on the token Spark would leave this shuffle
    out and, once the join is made by broadcast, read the rows in the parts that they had before.
    """
    return rows.repartition(parts, "token").sortWithinPartitions("token")


def _each_bucket(frames, least: float):
    """Buckets one after the other: (rows, keys, a function that tells which of some rows may be similar to which others)."""
    for pdf in carried(frames, ["token"]):
        token = pdf["token"].to_numpy()
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(token)], strict=True):
            part = pdf.iloc[s:e]
            n, at, marks = part["n"].to_numpy(np.int64), part["at"].to_numpy(np.int64), Sketches(part["sketch"])

            def close(i, j, n=n, at=at, marks=marks):
                return _may_reach(n[i][:, None], n[j][None, :], at[i][:, None], at[j][None, :], least) & alike_matrix(marks, i, j, least)

            yield part, part["key"].to_numpy(np.int64), close


def _leader_pairs(rows: DataFrame, parts: int, least: float) -> DataFrame:
    """For every large bucket a pair for each text that looks like an earlier leader; one that looks like none leads.  At most one pair a row."""

    def run(frames):
        found = _Pairs()
        for _, key, close in _each_bucket(frames, least):
            leaders = np.zeros(0, np.int64)
            lo = 0
            while lo < len(key):
                own = np.arange(lo, min(lo + max(1, min(256, BLOCK // max(1, len(leaders)))), len(key)))
                lo += len(own)
                if len(leaders):
                    hit = close(own, leaders)
                    some = hit.any(1)
                    found.add(key[own[some]], key[leaders[hit[some].argmax(1)]])
                    own = own[~some]
                near, free, new = close(own, own), np.ones(len(own), bool), []
                for r in range(len(own)):
                    if free[r]:
                        free[r] = False
                        new.append(own[r])
                        mine = near[r] & free
                        found.add(key[own[mine]], np.full(int(mine.sum()), key[own[r]]))
                        free &= ~mine
                leaders = np.r_[leaders, np.array(new, np.int64)]
                if found.full():
                    yield found.frame()
        yield found.frame()

    return _dealt(rows, parts).mapInPandas(lean(run), "a long, b long").where("a <> b").distinct()


def _rest_pairs(spark: SparkSession, rows: DataFrame, labels: DataFrame, parts: int, least: float, one: bool) -> DataFrame:
    """All pairs of large buckets that may be similar and that the links so far have not joined (labels: id, component), so that every bucket is settled.

    one: only one pair for each text outside the largest component, so that most components meet before all their pairs come up.
    """
    named = rows.join(labels, F.col("key") == F.col("id"), "left").select("token", "key", "n", "at", "sketch", F.coalesce("component", "key").alias("label"))
    open_ = named.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token")

    def run(frames):
        found = _Pairs()
        for part, key, close in _each_bucket(frames, least):
            label, every = part["label"].to_numpy(np.int64), np.arange(len(key))
            of = np.unique(label, return_inverse=True)[1]
            few = np.flatnonzero(of != np.bincount(of).argmax())  # any two of different labels hold one outside the largest label
            step = max(1, BLOCK // len(key))
            for lo in range(0, len(few), step):
                own = few[lo : lo + step]
                hit = close(own, every) & (label[own][:, None] != label[None, :])
                i, j = (x := np.flatnonzero(hit.any(1)), hit[x].argmax(1)) if one else np.nonzero(hit)
                found.add(key[own[i]], key[j])
                if found.full():
                    yield found.frame()
        yield found.frame()

    return _dealt(written(spark, named.join(open_, "token", "left_semi"), "similar-open"), parts).mapInPandas(lean(run), "a long, b long").distinct()


def _likely(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs that their sketches do not rule out; where sets have labels, those of different ones."""
    of = ["label"] if "label" in sets.columns else []
    x, y = (sets.select(F.col("key").alias(c), F.col("sketch").alias(m), *[F.col(k).alias(f"{m}_{k}") for k in of]) for c, m in (("a", "x"), ("b", "y")))
    both = pairs.join(x, "a").join(y, "b")
    if of:
        both = both.where("x_label <> y_label").select("a", "b", "x", "y")

    def run(batches):
        for b in batches:
            if b.num_rows:
                x, y = (Sketches(b.column(c).to_pylist()) for c in ("x", "y"))
                at = np.arange(b.num_rows)
                yield b.select(["a", "b"]).filter(pa.array(alike(x, at, y, at, least)))

    return both.mapInArrow(lean(run), "a long, b long")


def _pressed(shingles: np.ndarray) -> bytes:
    """The upper 40 bits of each hash: random bits are all that a set costs, and two of a pair's shingles fall together in fewer than one of a million usual pairs."""
    return np.unique(shingles >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpressed(raw) -> np.ndarray:
    whole = np.zeros((len(raw) // 5, 8), np.uint8)
    whole[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return whole.view("<u8").ravel()


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs of a Jaccard similarity of at least `least`."""
    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")

    def verify(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                x, y = _unpressed(x.as_buffer()), _unpressed(y.as_buffer())
                shared = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(shared > 0 and shared >= least * (len(x) + len(y) - shared))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(lean(verify), "a long, b long")


def _near_pairs(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """(a, b), larger key first: a spanning forest of the texts that SimHash links, by keys: texts of one fingerprint with its smallest key, and those of linked fingerprints."""
    fps = written(spark, fingerprints(texts.select(F.col("key").alias("doc_id"), "text")).where("fp <> 0").select(F.col("doc_id").alias("key"), "fp").distinct(), "similar-fp")
    reps = written(spark, fps.groupBy("fp").agg(F.min("key").alias("rep")), "similar-reps")
    edges = links(spark, reps.select("fp"))
    of = lambda c, name: reps.select(F.col("fp").alias(c), F.col("rep").alias(name))
    met = edges.join(of("a", "x"), "a").join(of("b", "y"), "b").select("x", "y").unionByName(fps.join(reps, "fp").where("key <> rep").select(F.col("key").alias("x"), F.col("rep").alias("y")))
    return written(spark, met.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "similar-near")


def similar(spark: SparkSession, docs: DataFrame, width: int = 5, least: float = 0.8, small: int = SMALL) -> DataFrame:
    """(doc_id, sha, component_id, first) of the documents that are in a group: equal texts, or a Jaccard similarity of at least `least` on word shingles.

    A document is a doc_id with a text (sha names it); `first` tells the one of the
    smallest doc_id and sha of its group.  SimHash proposes pairs first, by its covering
    masks.  Similar texts may lie further apart than its radius; prefixes of the shingles
    in a common order propose what it has not joined: no two similar texts have prefixes
    without a common shingle, so none is missed.  Exact similarity decides on both.  Null
    doc_ids are in no group.
    """
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", "text", sha.alias("sha")).withColumn("key", F.xxhash64("sha"))
    names = written(spark, texts.select("doc_id", "sha", "key", F.length("text").alias("chars")), "similar-names")
    n, chars, different = names.agg(F.count("*"), F.sum("chars"), F.countDistinct("doc_id", "key")).first()
    firsts = written(spark, names.groupBy("key", "sha").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")), "similar-firsts")
    parts = partitions(spark, (chars or 0) / 30, 2_000_000)
    near = _near_pairs(spark, texts)
    freed(spark)
    buckets = _buckets(texts, width, least, *_ordering(texts, n, width)).repartition(parts, "token")
    got = written(spark, _first_pairs(buckets, least, small), "similar-buckets")
    freed(spark)
    pairs = written(spark, got.where("n < 0").select("a", "b").distinct(), "similar-pairs")
    large = got.where("n >= 0").select("token", F.col("a").alias("key"), "n", "at")
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).union(large.select("key")).union(near.select("a")).union(near.select("b")).distinct()

    def shingled(batches):
        for b in doc_batches(batches):
            sets = [shingle_set((t or "").encode(), width) for t in b.column("text").to_pylist()]
            columns = [b.column("key"), pa.array(map(_pressed, sets), pa.binary()), pa.array(map(sketch, sets), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "shingles", "sketch"])

    lead = firsts.join(wanted, "key", "left_semi").select("doc_id", "key")
    sets = texts.join(lead, ["doc_id", "key"], "left_semi").select("key", "text").mapInArrow(lean(shingled), "key long, shingles binary, sketch binary")
    if n != different:  # rows that repeat both
        sets = sets.dropDuplicates(["key"])
    sets = written(spark, sets, "similar-sets")
    freed(spark)
    rows = written(spark, large.join(sets.select("key", "sketch"), "key"), "similar-rows")
    links = written(spark, _verified(_likely(near, sets, least), sets, least), "similar-first")
    labels = written(spark, min_label_components(spark, links, "similar-cc"), "similar-labels")
    marks = sets.select("key", "sketch").join(labels, F.col("key") == F.col("id"), "left").select("key", "sketch", F.coalesce("component", "key").alias("label"))
    likely = written(spark, _likely(pairs, marks, least).unionByName(_leader_pairs(rows, parts, least)).distinct().join(near, ["a", "b"], "left_anti"), "similar-likely")
    links = links.unionByName(written(spark, _verified(likely, sets, least), "similar-links"))
    freed(spark)
    labels = written(spark, min_label_components(spark, links, "similar-cc"), "similar-labels")
    tried = [likely, near]
    for one in (True, False):
        rest = _rest_pairs(spark, rows, labels, parts, least, one).join(reduce(DataFrame.unionByName, tried), ["a", "b"], "left_anti")
        tried.append(rest := written(spark, rest, "similar-rest"))
        if not rest.isEmpty():
            links = links.unionByName(written(spark, _verified(rest, sets, least), "similar-more"))
            labels = written(spark, min_label_components(spark, links, "similar-cc"), "similar-labels")
    dropped(spark, sets)
    freed(spark)
    roots = firsts.join(labels, F.col("key") == F.col("id"), "left").select("key", "doc_id", "sha", "n", F.coalesce("component", "key").alias("root"))
    roots = written(spark, roots, "similar-roots")
    groups = roots.groupBy("root").agg(F.min(F.struct("doc_id", "sha")).alias("low"), F.sum("n").alias("n")).where("n > 1").select("root", "low")
    out = names.join(roots.select("key", "root"), "key").join(groups, "root")
    out = written(spark, out.select("doc_id", "sha", F.col("low.doc_id").alias("component_id"), (F.struct("doc_id", "sha") == F.col("low")).alias("first")), "similar-out")
    for table in (names, firsts, got, pairs, rows, *tried, roots):
        dropped(spark, table)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = near_duplicates(spark, docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
