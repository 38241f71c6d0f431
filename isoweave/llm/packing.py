"""Operator 7: sequence packing, first-fit decreasing on a tournament tree.

Documents become token ids (each document ends with one end id), are cut into
whole sequences of `size` ids and a rest, and the rests are packed first-fit
decreasing.  Packing runs by itself in randomised groups of documents (a hash of
the document id), each of about `group` documents whatever the input, so no task
ever holds more than a group, and a group holds numbers only, no text.

Nulls: a null text counts as empty and gives its end id alone.  A null doc_id is
packed like any other; repeated rows are packed as often as they stand.
"""

from __future__ import annotations

import gc
import os
import zlib
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_batches, lean, own_cache, partitions, written

SIZE, END, GROUP = 4096, 2, 4096
#: Signs that the tokenizer parts from letters before them, singly or in a row.
SIGNS = ".,!|?%$#&*:;"
#: Bytes of the cache of encoded words, and what an entry takes besides its word and ids.
CACHE, ENTRY = 64 << 20, 180


def encoder(path: str) -> "Words":
    """A worker's encoder, kept between its tasks."""
    kept = own_cache("packing")
    if path not in kept:
        kept[path] = Words(path)
    return kept[path]


#: Texts by which it is seen whether a tokenizer has the properties that Words builds on.
PROBES = ("Hello, World! It's 12 a.b?? c--d", "\u00c9COLE \u00dcber na\u00efve Stra\u00dfe \u0130x \u4e2d\u6587 \U0001f600", "x|y %%% $#&*:; A.B.C.", " two  blanks\tand\nlines\r\n ", "NLP nlp Nlp, nlp. I'll", "")


class Words:
    """Ids of texts, by whole texts or, for a tokenizer whose tokens never span white space, by runs between blanks that are encoded once and kept.

    The second way also takes it that small letters have the ids of large ones and that SIGNS part from letters before
    them.  A tokenizer that encodes any of PROBES in another way is used on whole texts.
    """

    def __init__(self, path: str):
        # a task has one core; threads of its own would each keep memory
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.bytes = Tokenizer.from_file(path), {}, 0
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.whole = False
        self.whole = any(a != b for a, b in zip(self.ids(list(PROBES)), self.encoded(list(PROBES)), strict=True))

    def encoded(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, new: set[str]) -> list:
        """Puts the ids of words into the cache; returns those made of others."""
        known, parted, letters, rest = self.known, [], set(), []
        for w in new:
            b = w.rstrip(SIGNS)
            if b.isalpha() and (b.isascii() or max(b) < "\u0100"):
                # a word of letters with signs after it has the ids of the word in small letters, then those of the signs
                low = b.lower()
                if low not in known:
                    letters.add(low)
                if low != w:
                    parted.append((w, low, w[len(b) :]))
            else:
                rest.append(w)
        rest += {x for _, _, x in parted} - known.keys()
        # words of letters go side by side in one text, and come apart where a token ends a word
        words = list(letters)
        lines = [words[k : k + 256] for k in range(0, len(words), 256)]
        for line, e in zip(lines, self.tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(cuts) != len(line):
                rest += line
                continue
            raw, at = ids.tobytes(), 0
            for w, cut in zip(line, cuts, strict=True):
                known[w] = raw[at:cut]
                at = cut
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            known[w] = np.array(e.ids, "<u4").tobytes()
        for w, low, signs in parted:
            known[w] = known[low] + known[signs] if signs else known[low]
        return parted

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, as little-endian unsigned 32-bit numbers."""
        if self.whole:
            return self.encoded(texts)
        known, get, out = self.known, self.known.__getitem__, []
        for t in texts:
            words = t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            try:
                out.append(b"".join(map(get, words)))
            except KeyError:
                out.append(words)
        new = {w for w in set().union(*(x for x in out if type(x) is list)) if w not in known}
        if not new:
            return out
        size = len(known)
        parted = self.learn(new)
        out = [b"".join(map(get, x)) if type(x) is list else x for x in out]
        # frequent words came early and stay; words made of others get half of the room at most
        if self.bytes > CACHE // 2:
            for w, _, _ in parted:
                del known[w]
        self.bytes += sum(ENTRY + len(w) + len(ids) for w, ids in islice(reversed(known.items()), len(known) - size))
        while self.bytes > CACHE and len(known) > size:
            w, ids = known.popitem()
            self.bytes -= ENTRY + len(w) + len(ids)
        return out


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, longest first (ties: as given), each into the first bin that has room.

    The tournament tree keeps in every node the largest room below it, so the
    first bin with room is found by one walk from the root.
    """
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    tree = [size] * (2 * leaves)
    where, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[k]), 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        where[k], offset[k] = node - leaves, size - tree[node]
        tree[node] -= need
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return where, offset


def pieces(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END) -> DataFrame:
    """Pieces of every document: (row, doc_id, start, length, ids_crc32, doc_tokens); row tells repeated documents apart."""

    def run(batches):
        words, end = encoder(tokenizer_path), end_id.to_bytes(4, "little")
        gc.disable()  # millions of short-lived words, no cycles
        for b in doc_batches(batches, 2 << 20):
            rows, ids = b.column("row").to_pylist(), b.column("doc_id").cast(pa.int64()).to_pylist()
            out = []
            for row, doc, x in zip(rows, ids, words.ids([t or "" for t in b.column("text").to_pylist()]), strict=True):
                x += end
                n = len(x) // 4
                out += [(row, doc, k, min(size, n - k), zlib.crc32(x[4 * k : 4 * (k + size)]), n) for k in range(0, n, size)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

    names = ["row", "doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    rows = docs.select(F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("row"), "doc_id", "text")
    return rows.mapInArrow(lean(run), ", ".join(f"{n} long" for n in names))


def pack(spark: SparkSession, cut: DataFrame, size: int = SIZE, group: int = GROUP, seed: int = 7) -> DataFrame:
    """Adds sequence_id and offset to pieces, each group of documents by itself."""
    n_groups = max(1, round(cut.where("start = 0").count() / group))
    grouped = cut.withColumn("grp", F.pmod(F.xxhash64(F.lit(seed), F.coalesce("doc_id", F.lit(-1)), "row"), F.lit(n_groups)))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "row", "start"], ignore_index=True)
        where, offset = first_fit_decreasing(pdf["length"].to_numpy(), size)
        return pdf.assign(sequence_id=pdf["grp"] * (1 << 32) + where, offset=offset)

    parts = partitions(spark, n_groups, 64)
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return grouped.select("grp", "row", *cols).repartition(parts, "grp").groupBy("grp").applyInPandas(
        fit, "grp long, row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    ).select(*cols, "sequence_id", "offset")


def packed(spark: SparkSession, docs: DataFrame, tokenizer_path: str | None = None, size: int = SIZE, end_id: int = END, group: int = GROUP) -> DataFrame:
    """One row per piece; the pieces are written first, since text is encoded once and read by two jobs."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    return pack(spark, written(spark, pieces(docs, tokenizer_path, size, end_id), "packing-pieces"), size, group)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
