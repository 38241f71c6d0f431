"""Operator 1: SentencePiece encoding and decoding with N-best segmentation.

Pieces and scores come from a SentencePiece model file; a text's segmentations
are the paths through the lattice of its pieces, and a path scores the sum of its
pieces.  Forward Viterbi gives the best score of every prefix; a backward A-star
search from the end uses these scores as exact heuristics, so paths come out in
order of score and nothing is expanded in vain.

The lattice falls apart wherever no piece spans two neighbouring characters (a
blank never stands inside a piece after another sign, stops mostly part from
letters), so the search runs once for each distinct such run, and the N best of
runs side by side are combined exactly, best sum first.  A character without a
piece becomes its UTF-8 byte pieces.

Nulls: a null text counts as empty: no pieces, one segmentation of score 0.
"""

from __future__ import annotations

import gc
import zlib
from heapq import heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import doc_batches, lean, own_cache

#: Segmentations per text; entries of a worker's cache of runs; what a character without a piece costs beyond the worst piece.
NBEST, CACHE, PENALTY = 4, 800_000, 10.0
BLANK = "▁"


def segments(text: str) -> list[str]:
    """A text as runs of blanks with the signs after them; one blank is put before the text."""
    if not text:
        return []
    words = text.replace(BLANK, " ").split(" ")
    if "" not in words:
        return [BLANK + w for w in words]
    out, pending = [], BLANK
    for w in words[:-1]:
        if w:
            out.append(pending + w)
            pending = BLANK
        else:
            pending += BLANK
    return [*out, pending + words[-1]]


class Lattice:
    """The pieces of one model, and the N best segmentations of texts."""

    def __init__(self, path: str, nbest: int = NBEST):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.nbest = nbest
        self.text_of: list[bytes] = []
        self.piece: dict[str, tuple[int, float]] = {}
        self.byte_id = [0] * 256
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.text_of.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.text_of.append(b"")
            else:
                self.piece[p] = (i, sp.get_score(i))
                self.text_of.append(p.replace(BLANK, " ").encode())
        self.trie: dict[str, tuple | bool] = {p[:k]: False for p in self.piece for k in range(1, len(p))}
        self.trie |= {p: (s, i.to_bytes(4, "little")) for p, (i, s) in self.piece.items()}
        self.joined = {p[k : k + 2] for p in self.piece for k in range(len(p) - 1)}
        self.unknown = min((s for _, s in self.piece.values() if s > -1e8), default=0.0) - PENALTY
        self.runs: dict[str, list] = {}
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.best: list[bytes] = []
        self.scores, self.gaps, self.sizes = [], [], []
        self.runs: dict[str, tuple[float, float, bytes]] = {}

    def forward(self, run: str) -> tuple[float, float, bytes]:
        """Forward Viterbi with the two best scores of every prefix: the best path's score, its lead over the second, its ids."""
        n, trie = len(run), self.trie
        first, second = [0.0] + [-np.inf] * n, [-np.inf] * (n + 1)
        back: list = [None] * (n + 1)
        for i in range(n):
            b, c, j = first[i], second[i], i
            while j < n:
                j += 1
                p = trie.get(run[i:j])
                if p:
                    s, ids = p
                elif j == i + 1:  # a character that is no piece by itself: its bytes
                    s, ids = self.unknown, self._bytes(run[i])
                elif p is None:
                    break
                else:
                    continue
                t, u = b + s, c + s
                if t > first[j]:
                    second[j] = first[j] if first[j] > u else u
                    first[j] = t
                    back[j] = (i, ids)
                elif t > second[j]:
                    second[j] = t
                if p is None:
                    break
        ids, at = [], n
        while at:
            at, one = back[at]
            ids.append(one)
        ids.reverse()
        return first[n], first[n] - second[n], b"".join(ids)

    def _bytes(self, character: str) -> bytes:
        return b"".join(self.byte_id[x].to_bytes(4, "little") for x in character.encode("utf-8", "surrogatepass"))

    def arcs(self, run: str) -> tuple[list[float], list[list[tuple[int, float, bytes]]]]:
        """Forward Viterbi: the best score of every prefix, and for every end the pieces that end there as (start, score, ids)."""
        n, trie = len(run), self.trie
        best, ending = [0.0] + [-np.inf] * n, [[] for _ in range(n + 1)]
        for i in range(n):
            b, single = best[i], False
            for j in range(i + 1, n + 1):
                p = trie.get(run[i:j])
                if p is None:
                    break
                if p:
                    s, ids = p
                    ending[j].append((i, s, ids))
                    if b + s > best[j]:
                        best[j] = b + s
                    if j == i + 1:
                        single = True
            if not single:
                ending[i + 1].append((i, self.unknown, self._bytes(run[i])))
                best[i + 1] = max(best[i + 1], b + self.unknown)
        return best, ending

    def search(self, run: str) -> list[tuple[float, bytes]]:
        """The N best paths through the lattice of a run, best first: (score, ids as bytes).

        An agenda entry stands for all paths that end as it does; its key is the
        exact score of the best of them.  Entries hold disjoint sets of paths, so
        one that is worse than the N best entries so far can't be needed.
        """
        best, ending = self.arcs(run)
        n, nbest = len(run), self.nbest
        agenda, tie, out, tops = [(-best[n], 0, n, 0.0, None)], 0, [], [best[n]]
        while agenda and len(out) < nbest:
            key, _, at, behind, chain = heappop(agenda)
            if at == 0:
                ids = []
                while chain:
                    ids.append(chain[0])
                    chain = chain[1]
                out.append((behind, b"".join(ids)))
                continue
            heir = False
            for i, s, ids in ending[at]:
                score = best[i] + s + behind
                if not heir and score == -key:
                    heir = True  # takes its parent's place among the tops
                elif len(tops) < nbest:
                    heappush(tops, score)
                elif score > tops[0]:
                    heapreplace(tops, score)
                else:
                    continue
                tie += 1
                heappush(agenda, (-score, tie, i, behind + s, (ids, chain)))
        return out

    def combined(self, parts: list[list[tuple[float, bytes]]]) -> list[tuple[float, bytes]]:
        """The N best choices, one of each part, best sum first."""
        if len(parts) == 1:
            return parts[0]
        done = parts[0]
        for part in parts[1:]:
            sums = sorted(((-(a[0] + b[0]), i, j) for i, a in enumerate(done) for j, b in enumerate(part) if (i + 1) * (j + 1) <= self.nbest))[: self.nbest]
            done = [(-s, done[i][1] + part[j][1]) for s, i, j in sums]
        return done

    def parts(self, segment: str) -> list[str]:
        """A segment cut wherever no piece spans two neighbouring characters."""
        joined, out, start = self.joined, [], 0
        for k in range(1, len(segment)):
            if segment[k - 1 : k + 1] not in joined:
                out.append(segment[start:k])
                start = k
        out.append(segment[start:])
        return out

    def segment(self, segment: str) -> list[tuple[float, bytes]]:
        """The N best of a run of blanks with the signs after it."""
        return self.combined([self.search(run) for run in self.parts(segment)])

    def learn(self, segments: set[str]) -> None:
        """Puts the segments' best into the cache, with its lead over the second."""
        runs = self.runs
        for s in segments:
            if s in self.known:
                continue
            got = []
            for run in self.parts(s):
                one = runs.get(run)
                if one is None:
                    one = runs[run] = self.forward(run)
                got.append(one)
            score, gap, ids = got[0] if len(got) == 1 else (sum(g[0] for g in got), min(g[1] for g in got), b"".join(g[2] for g in got))
            self.known[s] = len(self.best)
            self.best.append(ids)
            self.scores.append(score)
            self.gaps.append(gap)
            self.sizes.append(len(ids) // 4)

    def forget(self, segments: int, runs: int) -> None:
        """Cuts full caches back to so many entries: what is frequent came early and stays."""
        while len(self.known) > CACHE and len(self.known) > segments:
            self.known.popitem()
            for x in (self.best, self.scores, self.gaps, self.sizes):
                x.pop()
        while len(self.runs) > CACHE and len(self.runs) > runs:
            self.runs.popitem()

    def encode_all(self, texts: list[str]):
        """For every text its N best segmentations, best first: (score, ids)."""
        cut = [segments(t) for t in texts]
        held = len(self.known), len(self.runs)
        self.learn(set().union(*cut))
        scores, gaps, sizes = np.array(self.scores), np.array(self.gaps), np.array(self.sizes, np.int64)
        known, best = self.known.__getitem__, self.best.__getitem__
        for words in cut:
            if not words:
                yield [(0.0, np.zeros(0, "<u4"))]
                continue
            places = list(map(known, words))
            at = np.array(places, np.int64)
            base = float(scores[at].sum())
            ids = np.frombuffer(b"".join(map(best, places)), "<u4")
            out = [(base, ids)]
            if self.nbest > 1:
                own = gaps[at]
                few = min(self.nbest - 1, len(own))
                near = np.sort(np.argpartition(own, few - 1)[:few]) if few < len(own) else np.arange(few)
                # all but the segments of smallest gaps keep their best: changing another costs at least as much as each of those
                ways: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
                others = {}
                for k in near.tolist():
                    other = others[k] = self.segment(words[k])
                    ways = sorted((cost + other[0][0] - other[j][0], (*picks, j)) for cost, picks in ways for j in range(len(other)))[: self.nbest]
                ends = np.cumsum(sizes[at])
                for cost, picks in ways[1:]:
                    parts, done = [], 0
                    for k, j in zip(near.tolist(), picks, strict=True):
                        if j:
                            parts += [ids[done : ends[k] - sizes[at[k]]], np.frombuffer(others[k][j][1], "<u4")]
                            done = ends[k]
                    out.append((base - cost, np.concatenate([*parts, ids[done:]])))
            yield out
        self.forget(*held)

    def encode(self, text: str) -> list[tuple[float, np.ndarray]]:
        return list(self.encode_all([text]))[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces and bytes side by side, without the blank put before the text."""
        raw = b"".join(map(self.text_of.__getitem__, ids.tolist()))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


def lattice(path: str, nbest: int) -> Lattice:
    """A worker's lattice, kept between its tasks."""
    kept = own_cache("pieces")
    if (path, nbest) not in kept:
        kept[path, nbest] = Lattice(path, nbest)
    return kept[path, nbest]


def _path(path: str | None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return path


def encoded(docs: DataFrame, model_path: str | None = None, nbest: int = NBEST, digest: bool = False) -> DataFrame:
    """(doc_id, rank, score, ids) of the N best segmentations of every text; with `digest`, n_pieces, the ids' CRC32 and whether they decode to the text in place of ids."""
    model_path = _path(model_path)
    last = "n_pieces long, ids_crc32 long, round_trip boolean" if digest else "ids array<int>"

    def run(batches):
        gc.disable()  # the cache holds many tuples and no cycles
        model = lattice(model_path, nbest)
        for b in doc_batches(batches, 8 << 20):
            rows, texts = [], [t or "" for t in b.column("text").to_pylist()]
            for doc, text, ways in zip(b.column("doc_id").cast(pa.int64()).to_pylist(), texts, model.encode_all(texts), strict=True):
                for rank, (score, ids) in enumerate(ways, 1):
                    if digest:
                        rows.append((doc, rank, score, len(ids), zlib.crc32(ids), model.decode(ids) == text.replace(BLANK, " ") if rank == 1 else None))
                    else:
                        rows.append((doc, rank, score, ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    names = ["doc_id", "rank", "score"] + (["n_pieces", "ids_crc32", "round_trip"] if digest else ["ids"])
    kinds = [pa.int64(), pa.int32(), pa.float64()] + ([pa.int64(), pa.int64(), pa.bool_()] if digest else [pa.list_(pa.int32())])
    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id long, rank int, score double, {last}")


def decoded(encodings: DataFrame, model_path: str | None = None) -> DataFrame:
    """`encodings` (with a column ids) with their text; null ids give null."""
    model_path = _path(model_path)
    names = [c for c in encodings.columns if c not in ("ids", "text")]
    kept = encodings.select(*names, "ids")

    def run(batches):
        model = lattice(model_path, NBEST)
        for b in batches:
            texts = [None if x is None else model.decode(np.array(x, np.int64)) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(lean(run), f"{fields}, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)
