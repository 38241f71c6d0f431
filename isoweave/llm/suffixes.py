"""Operator 3: removal of bytes covered by repeated strings, by sorted suffix buckets.

A byte goes if a string of `length` bytes that covers it also starts earlier
(smaller doc_id, or earlier in the same document).  So for every suffix, cut at
`length` bytes, it must be known whether an equal one starts earlier.

1.  Documents with equal texts are found by SHA-256; only the first of them goes on.
2.  Cover sample: every string of `length` bytes holds a sampled position, the
    leftmost smallest hash of its GRAM-byte strings, at an offset that its content
    alone decides.  Equal strings thus share a sample at the same offset.  A sample
    whose GRAM bytes stand nowhere else rules out all suffixes that it covers.
3.  The suffixes of a repeated sample form a bucket.  A sampled place ships its
    suffixes as one stretch of text; equal stretches of a task ship once.
    Buckets come sorted, one after another, and in them equal stretches side by
    side, of which the first alone goes on.  The suffixes of a bucket are sorted by
    bytes; of equal ones all but the first are removed.  Memory holds one bucket,
    in parts: a bucket of more than BUCKET distinct stretches goes on by 128-bit
    BLAKE2 digests of its single suffixes, which spread over all tasks.
4.  Removed suffixes come back to their documents as runs of starts.

The positional difference cover of the named method samples 9 of 64 positions
whatever the text; the sample used here takes about 2 in 70 and serves the same
end, since both strings of a match hold it at one offset.  See the README.

Nulls: a null text counts as empty; a null doc_id is ordered before all others.
Rows that repeat both id and text are one document and give one row; rows that
share an id but not the text are documents of their own, ordered by the SHA-256 of
their texts.  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (as pa.compute)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import doc_batches, dropped, freed, lean, own_cache, partitions, utf8, written

LENGTH, GRAM, BUCKET = 100, 32, 20_000
#: Bytes of text that a task hashes at a time, and stretches that it sorts at a time (a bucket apart).
STEP, SORTED = 1 << 20, 2000
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a place beside its hash; the smallest hashes are sought in parts of so many places.
PLACE = 20
#: Places of a document's second, third... text begin at multiples of this.
NEXT = 1 << 33


def _tables(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    powers = own_cache("suffixes")
    have = powers.get(seed)
    if have is None or len(have[0]) < n:
        base = (0x9E3779B97F4A7C15 * (2 * seed + 1)) % 2**64 | 1
        size = max(n, 5 << 18)
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        have = powers[seed] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return have


def gram_hashes(raw: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of the k bytes from every position that has as many."""
    n = len(raw)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = _tables(n, seed)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64, out=total[1:])
    h = (total[k:] - total[:-k]) * down[: n - k + 1]
    h ^= h >> np.uint64(32)
    h *= _ODD
    h ^= h >> np.uint64(29)
    return h


def sampled(raw: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Samples of all texts of a batch: (place, first and last start that it covers, hash, text number)."""
    n, w = len(raw), length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, np.zeros(0, np.uint64), none
    h = gram_hashes(raw, gram)
    bits, places = np.uint64(PLACE), []
    for lo in range(0, len(h) - w + 1, (1 << PLACE) - w):
        part = h[lo : lo + (1 << PLACE) - 1]
        # of equal hashes the leftmost is the smallest; the bits that stand for it are as many whatever the batch
        key = (part >> bits << bits) | np.arange(len(part), dtype=np.uint64)
        size = 1
        while size * 2 <= w:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if size < w:
            key = np.minimum(key[: len(key) - (w - size)], key[w - size :])
        places.append((key & np.uint64((1 << PLACE) - 1)).astype(np.int64) + lo)
    place = np.concatenate(places)
    valid = np.zeros(n + 1, np.int8)
    long = np.diff(off) >= length
    np.add.at(valid, off[:-1][long], 1)
    np.add.at(valid, off[1:][long] - length + 1, -1)
    inside = np.cumsum(valid)[: len(place)].astype(bool)
    change = np.ones(len(place), bool)
    change[1:] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1])
    lo = np.flatnonzero(change)
    hi = np.r_[lo[1:], len(place)] - 1
    keep = inside[lo]
    lo, hi = lo[keep], hi[keep]
    text = np.searchsorted(off, lo, "right") - 1
    # two runs side by side in different texts never share a place, since a run's place lies in its text
    return place[lo], lo, hi, h[place[lo]], text


def _rows(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names)


def _named(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a batch's texts, and where their places begin."""
    return b.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64), b.column("tie").to_numpy(zero_copy_only=False).astype(np.int64) * NEXT


def _samples(length: int, gram: int):
    """Maps texts to rows of samples: one per distinct hash of a batch with its place; a hash met twice also gives all its places."""

    def run(batches):
        for b in doc_batches(batches, STEP):
            raw, off = utf8(b.column("text"))
            place, _, _, h, text = sampled(raw, off, length, gram)
            ids, base = _named(b)
            order = np.argsort(h, kind="stable")
            h, doc, at = h[order], ids[text[order]], (place - off[text] + base[text])[order]
            first = np.ones(len(h), bool)
            first[1:] = h[1:] != h[:-1]
            several = ~first
            several[:-1] |= ~first[1:]
            # known: repeated already; they pass through wherever they go
            yield _rows(
                [
                    pa.array(np.concatenate([h[first].view(np.int64), doc[several] * 7919 + at[several]])),
                    pa.array(np.concatenate([doc[first], doc[several]])),
                    pa.array(np.concatenate([at[first], at[several]])),
                    pa.array(np.concatenate([np.zeros(int(first.sum()), bool), np.ones(int(several.sum()), bool)])),
                ],
                ["h", "doc_id", "at", "known"],
            )

    return run


def _stretches(length: int, gram: int):
    """Maps texts with the places of their repeated samples to stretches (one for each) or, for all but the first of equal stretches, to runs."""

    def run(batches):
        seen: set[bytes] = set()  # the texts come in the order of their ids
        for b in doc_batches(batches, STEP):
            raw, off = utf8(b.column("text"))
            place, lo, hi, h, text = sampled(raw, off, length, gram)
            ids, base = _named(b)
            places = b.column("places")
            which = np.repeat(np.arange(b.num_rows), np.diff(places.offsets.to_numpy()))
            at = places.flatten().to_numpy(zero_copy_only=False).astype(np.int64) - base[which]
            own = (at >= 0) & (at < NEXT)  # the others are places of another text of the same id
            wanted = np.unique(at[own] + off[:-1][which[own]])
            keep = np.isin(place, wanted)
            place, lo, hi, h, text = place[keep], lo[keep], hi[keep], h[keep], text[keep]
            if not len(lo):
                continue
            doc, start, n = ids[text], lo - off[text] + base[text], hi - lo + length
            order = np.lexsort((start, doc))
            lo, hi, h, doc, start, n = (x[order] for x in (lo, hi, h, doc, start, n))
            whole = raw.tobytes()
            fresh = np.zeros(len(lo), bool)
            text_of = []
            for i, (a, e, g) in enumerate(zip(lo.tolist(), (lo + n).tolist(), h.tolist(), strict=True)):
                s = whole[a:e]
                key = hashlib.blake2b(s, digest_size=16, salt=g.to_bytes(8, "little")).digest()
                if key not in seen:
                    seen.add(key)
                    fresh[i] = True
                    text_of.append(s)
                else:
                    text_of.append(b"")
            key = np.where(fresh, h.view(np.int64), doc * 7919 + start)
            yield _rows([pa.array(key), pa.array(doc), pa.array(start), pa.array(hi - lo + 1), pa.array(text_of, pa.binary())], ["h", "doc_id", "start", "n", "stretch"])

    return run


def _later(table: pa.Table, length: int):
    """(doc_id, first, last): runs of starts whose string starts earlier in the same table of stretches."""
    doc, start, n = (table.column(c).to_numpy() for c in ("doc_id", "start", "n"))
    chunk = table.column("stretch").combine_chunks()
    chunk = chunk.chunk(0) if isinstance(chunk, pa.ChunkedArray) else chunk
    off = np.frombuffer(chunk.buffers()[1], np.int32, len(chunk) + 1, chunk.offset * 4).astype(np.int64)
    raw = np.frombuffer(chunk.buffers()[2], np.uint8)
    which = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    at, d, s = off[which] + step, doc[which], start[which] + step
    suffix = np.lib.stride_tricks.sliding_window_view(raw, length)[at].view(f"S{length}").ravel()
    early = np.lexsort((s, d))  # of equal suffixes the one that starts first stays first
    order = early[np.argsort(suffix[early], kind="stable")]
    x = suffix[order]
    same = np.zeros(len(x), bool)
    same[1:] = x[1:] == x[:-1]
    gone = np.zeros(len(x), bool)
    gone[order] = same
    return _runs(gone, which, d, s)


def _runs(gone: np.ndarray, which: np.ndarray, d: np.ndarray, s: np.ndarray):
    edge = np.diff(gone.astype(np.int8), prepend=0, append=0)
    edge[1:-1][(which[1:] != which[:-1]) & gone[1:] & gone[:-1]] = 2  # a run ends and another starts
    begins = np.flatnonzero((edge == 1) | (edge == 2))
    ends = np.flatnonzero((edge == -1) | (edge == 2)) - 1
    return d[begins], s[begins], s[ends]


def _buckets(length: int, bucket: int):
    """Streams stretches sorted by sample: whole buckets are sorted here, large ones give hashes of their suffixes."""
    names = ["h", "doc_id", "first", "last", "h2"]

    def out(d, first, last, h=None, h2=None):
        zero = np.zeros(len(d), np.int64)
        return _rows([pa.array(zero if h is None else h), pa.array(d), pa.array(first), pa.array(last), pa.array(zero if h2 is None else h2)], names)

    def hashed(t: pa.Table):
        for b in t.combine_chunks().to_batches(max_chunksize=SORTED):
            n, doc, start = (b.column(c).to_numpy() for c in ("n", "doc_id", "start"))
            which = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            names = b"".join(hashlib.blake2b(x[k : k + length], digest_size=16).digest() for x, m in zip(b.column("stretch").to_pylist(), n.tolist(), strict=True) for k in range(m))
            a, c = np.frombuffer(names, np.int64).reshape(-1, 2).T
            yield out(doc[which], start[which] + step, start[which] + step, np.where(a == 0, 1, a), c)

    def distinct(batches):
        """The first of equal stretches, and the runs of all others; they come side by side, the first one first."""
        last = None
        for b in (x.slice(k, SORTED) for x in batches for k in range(0, x.num_rows, SORTED)):
            h, stretch = b.column("h").to_pylist(), b.column("stretch").to_pylist()
            again = np.zeros(len(h), bool)
            for i, now in enumerate(zip(h, stretch, strict=True)):
                again[i] = now == last and len(now[1]) > 0
                last = now
            if again.any():
                gone = b.filter(pa.array(again))
                d, s, n = (gone.column(c).to_numpy() for c in ("doc_id", "start", "n"))
                yield out(d, s, s + n - 1), None
                b = b.filter(pa.array(~again))
            yield None, b

    def run(batches):
        held, size, large = [], 0, None
        for done, b in distinct(batches):
            if done is not None:
                yield done
                continue
            if not b.num_rows:
                continue
            plain = b.column("stretch")
            empty = pa.compute.equal(pa.compute.binary_length(plain), 0)
            done = b.filter(empty)
            if done.num_rows:
                d, s, n = (done.column(c).to_numpy() for c in ("doc_id", "start", "n"))
                yield out(d, s, s + n - 1)
            b = b.filter(pa.compute.invert(empty))
            if not b.num_rows:
                continue
            h = b.column("h").to_numpy()
            cut = int((h == h[-1]).argmax())  # from here the last sample's rows
            if large is not None:  # the bucket under way is large
                goes = int((h != large).argmax()) if h[-1] != large else len(h)
                if goes:
                    yield from hashed(pa.Table.from_batches([b.slice(0, goes)]))
                if goes == len(h):
                    continue
                large, b, h, cut = None, b.slice(goes), h[goes:], cut - goes
            if cut:
                held.append(b.slice(0, cut))
                size += cut
                yield from settle(held)
                held, size = [], 0
            held.append(b.slice(cut))
            size += b.num_rows - cut
            if size > bucket:
                yield from hashed(pa.Table.from_batches(held))
                held, size, large = [], 0, h[-1]
        if held:
            yield from settle(held)

    def settle(held):
        t = pa.Table.from_batches(held)
        if t.num_rows > 1:
            yield out(*_later(t, length))

    return run


def _marked(text: bytes, runs: list[tuple[int, int]], length: int) -> tuple[bytes, int]:
    """What is left of a text, and the number of maximal removed runs."""
    kept, at, spans, end = [], 0, 0, -1
    for first, last in sorted(runs):
        stop = last + length
        if first > end:
            spans += 1
            kept.append(text[at:first])
        end = max(end, stop)
        at = end
    kept.append(text[at:])
    return b"".join(kept), spans


def repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET):
    """(firsts, copies, done): the first document of every text with its removed runs, array<struct<first, last>> of starts; the other rows; and what writes a result and cleans up.

    firsts: doc_id, sha, text, rest, runs; copies: doc_id, sha, n_bytes, rest; rest holds the other columns.
    """
    text = F.coalesce("text", F.lit(""))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.lit(None).cast("string")
    lowest = F.lit(-(1 << 63))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), lowest).alias("doc_id"), F.sha2(text, 256).alias("sha"), text.alias("text"), rest.alias("rest"))
    marks = written(spark, rows.select("doc_id", "sha", F.octet_length("text").alias("n_bytes"), "rest"), "suffixes-marks")
    first = written(spark, marks.groupBy("sha").agg(F.min("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes")), "suffixes-first")
    total = first.agg(F.sum("n_bytes")).first()[0] or 0
    copies = marks.join(first.select("sha", F.col("doc_id").alias("first_id")), "sha").where("doc_id <> first_id").drop("first_id")

    # the texts are dealt out by document once; all later joins find them in place
    n = partitions(spark, total, 32 << 20)
    name = f"isoweave_suffixes_{uuid.uuid4().hex}"
    several = Window.partitionBy("doc_id").orderBy("sha")
    chosen = first.select("doc_id", F.col("sha").alias("own"), (F.row_number().over(several) - 1).alias("tie")).hint("shuffle_hash")
    # equality in a form that does not become a join key: the rows must stay dealt out by doc_id alone, as the buckets are
    dealt = rows.repartition(n, "doc_id").join(chosen, "doc_id").where(F.array_contains(F.array("own"), F.col("sha"))).drop("own")
    if not marks.groupBy("doc_id", "sha").count().where("count > 1").isEmpty():
        dealt = dealt.dropDuplicates(["doc_id", "sha"])
    dealt.write.bucketBy(n, "doc_id").saveAsTable(name)
    texts = spark.table(name)
    del dealt
    freed(spark)

    samples = texts.mapInArrow(lean(_samples(length, gram)), "h long, doc_id long, at long, known boolean")
    places = _repeated(spark, samples, total)
    by_doc = places.groupBy("doc_id").agg(F.collect_set("at").alias("places"))
    placed = texts.join(by_doc.hint("shuffle_hash"), "doc_id").select("doc_id", "tie", "text", "places").sortWithinPartitions("doc_id", "tie")
    stretched = placed.mapInArrow(lean(_stretches(length, gram)), "h long, doc_id long, start long, n long, stretch binary")
    parts = partitions(spark, total, 8 << 20)
    ordered = stretched.repartition(parts, "h").sortWithinPartitions("h", "stretch", "doc_id", "start")
    found = written(spark, ordered.mapInArrow(lean(_buckets(length, bucket)), "h long, doc_id long, first long, last long, h2 long"), "suffixes-found")
    least = found.where("h <> 0").groupBy("h", "h2").agg(F.min(F.struct("doc_id", "first")).alias("least"))
    spread = found.where("h <> 0").join(least, ["h", "h2"]).where("doc_id <> least.doc_id OR first <> least.first").select("doc_id", "first", "last")
    gone = found.where("h = 0").select("doc_id", "first", "last").unionByName(spread)
    by_doc = gone.groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    begin = F.col("tie") * F.lit(NEXT)
    own = F.transform(F.filter("runs", lambda r: (r["first"] >= begin) & (r["first"] < begin + NEXT)), lambda r: F.struct((r["first"] - begin).alias("first"), (r["last"] - begin).alias("last")))
    firsts = texts.join(by_doc.hint("shuffle_hash"), "doc_id", "left").withColumn("runs", own)

    def done(out: DataFrame) -> DataFrame:
        """Writes what comes of the texts, and deletes the work tables."""
        out = written(spark, out, "suffixes-out")
        spark.sql(f"DROP TABLE {name}")
        for table in (marks, first, found):
            dropped(spark, table)
        return out

    return firsts, copies, done


def _repeated(spark: SparkSession, samples: DataFrame, total: int) -> DataFrame:
    """(doc_id, at) of the samples whose hash stands elsewhere too."""

    def run(batches):
        held, last = [], None
        for b in batches:
            h, known = b.column("h").to_numpy(), b.column("known").to_numpy(zero_copy_only=False)
            yield b.filter(b.column("known")).select(["doc_id", "at"])
            b, h = b.filter(pa.array(~known)), h[~known]
            if not len(h):
                continue
            goes_on = held and h[0] == last
            same = np.zeros(len(h), bool)
            same[1:] = h[1:] == h[:-1]
            keep = same.copy()
            keep[:-1] |= same[1:]
            if goes_on:
                keep[0] = True
                yield held[0]
            yield b.filter(pa.array(keep)).select(["doc_id", "at"])
            # the last row's twin may come with the next batch
            held, last = ([b.slice(len(h) - 1).select(["doc_id", "at"])], h[-1])
            if keep[-1]:
                held = [held[0].slice(0, 0)]

    return samples.repartition(partitions(spark, total, 64 << 20), "h").sortWithinPartitions("h").mapInArrow(lean(run), "doc_id long, at long")


def digest(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per document."""
    length = how.get("length", LENGTH)
    firsts, copies, done = repeats(spark, docs, **how)

    def run(batches):
        for b in batches:
            rows = []
            for doc, sha, text, runs in zip(*(b.column(c).to_pylist() for c in ("doc_id", "sha", "text", "runs")), strict=True):
                raw = text.encode()
                if runs:
                    left, spans = _marked(raw, [(r["first"], r["last"]) for r in runs], length)
                    rows.append((doc, len(raw), len(raw) - len(left), spans, hashlib.sha256(left).hexdigest(), sha))
                else:
                    rows.append((doc, len(raw), 0, 0, sha, sha))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            if rows:
                yield _rows([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "sha"])

    cut = firsts.select("doc_id", "sha", "text", "runs").mapInArrow(lean(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, sha string")
    gone = F.col("n_bytes") >= length
    rest = copies.select(
        "doc_id", F.col("n_bytes").cast("long"), F.when(gone, F.col("n_bytes")).otherwise(0).cast("long").alias("n_removed"), gone.cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
    )
    return done(cut.drop("sha").unionByName(rest)).withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))


def without_repeats(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """`docs` with the repeated strings cut out of their texts; a character that is cut in part goes whole.

    A document that is a copy of an earlier one keeps its row with what is left of its text.  Null texts become empty.
    """
    length = how.get("length", LENGTH)
    firsts, copies, done = repeats(spark, docs, **how)
    columns, schema = docs.columns, docs.schema

    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            for i, runs in enumerate(b.column("runs").to_pylist()):
                if runs:
                    texts[i] = _marked(texts[i].encode(), [(r["first"], r["last"]) for r in runs], length)[0].decode("utf-8", "ignore")
            yield _rows([b.column("doc_id"), pa.array(texts, pa.string()), b.column("rest")], ["doc_id", "text", "rest"])

    cut = firsts.select("doc_id", "text", "rest", "runs").mapInArrow(lean(run), f"doc_id long, text string, rest {firsts.schema['rest'].dataType.simpleString()}")
    short = copies.where(F.col("n_bytes") < length).join(firsts.select("sha", "text"), "sha").select("doc_id", "text", "rest")
    gone = copies.where(F.col("n_bytes") >= length).select("doc_id", F.lit("").alias("text"), "rest")
    out = done(cut.unionByName(short).unionByName(gone)).withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))
    kept = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in columns:
        kept["n_chars"] = F.length("text")
    return out.select(*[kept.get(c, F.col(f"rest.`{c}`")).cast(schema[c].dataType).alias(c) for c in columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(spark, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
