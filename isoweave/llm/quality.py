"""Operator 8: quality classifier from weak labels.

Ten heuristic labellers vote good (1), bad (-1) or abstain (0) on every whole
text.  Expectation-maximisation estimates each labeller's vote distribution under
either hidden class from the counts of vote patterns over all documents (at most
3**10 patterns, whatever the input), starting from the majority.  The posterior
labels of a bounded sample of documents (TRAIN, chosen by a hash of id and text)
train a logistic scorer on hashed word features, which scores every document.

Nulls: a null or empty text gets abstentions and the scorer's bias; it is kept.
Repeated and null doc_ids are scored row by row.  An empty table gives no rows.
Columns of the documents that are named like those of the result give way to them.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_batches, lean, own_cache, utf8, written

#: Documents that the scorer is trained on, at most; hashed features; entries of a worker's word cache.
TRAIN, DIMS, CACHE = 8000, 1 << 16, 200_000
LABELLERS = ("symbols", "capitals", "repeats", "variety", "exclaims", "pipes", "sentences", "function_words", "repeated_lines", "word_length")
#: Frequent words of the four languages of the corpus.
FUNCTION_WORDS = frozenset(
    b"the of and to in a is that it for on with as was be by this are or at from not have an which de la le et les des en un une du que dans est pour pas qui sur au par "
    b"der die das und ist den von mit zu dem ein eine im nicht auf sich des el los las y por con para una su no lo como se al".split()
)

_LOWER, _UPPER, _PLAIN = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_LOWER[97:123] = True
_UPPER[65:91] = True
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), *b" \n\r\t.,;:'\"!?()-"]] = True


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
    return total[off[1:]] - total[off[:-1]]


def votes(column: pa.Array) -> np.ndarray:
    """One row of votes per text, in LABELLERS' order."""
    raw, off = utf8(column)
    n_bytes = np.diff(off)
    counts = {k: _sums(t[raw], off) for k, t in (("lower", _LOWER), ("upper", _UPPER), ("plain", _PLAIN))}
    signs = {c: _sums(raw == ord(c), off) for c in "!|.?\n"}
    out = np.zeros((len(column), len(LABELLERS)), np.int8)
    whole = raw.tobytes()
    for i in range(len(column)):
        text = whole[off[i] : off[i + 1]]
        words = text.lower().split()
        n = len(words)
        if not n:
            continue
        v, size, letters = out[i], int(n_bytes[i]), int(counts["lower"][i] + counts["upper"][i])

        def vote(k, x, bad, good, v=v):
            """Bad above `bad`, good below `good`."""
            v[k] = -1 if x > bad else 1 if x < good else 0

        vote(0, 1 - counts["plain"][i] / size, 0.04, 0.02)
        vote(1, counts["upper"][i] / max(letters, 1), 0.5, 0.2)
        if n >= 8:
            vote(2, sum(map(eq, words, words[1:])) / n, 0.2, 0.05)
            vote(3, 1 - len(set(words)) / min(n, 400), 0.7, 0.5)
        vote(4, signs["!"][i] / n, 0.2, 0.05)
        vote(5, signs["|"][i] / n, 0.2, 0.02)
        if n >= 30:
            ends = (signs["."][i] + signs["?"][i] + signs["!"][i]) / n
            v[6] = 1 if 1 / 60 <= ends <= 1 / 3 else -1
            share = sum(map(FUNCTION_WORDS.__contains__, words)) / n
            vote(7, -share, -0.02, -0.1)
        if signs["\n"][i] >= 4:
            lines = [x for x in text.split(b"\n") if x.strip()]
            vote(8, 1 - len(set(lines)) / max(len(lines), 1), 0.3, 0.1)
        length = (size - n) / n
        v[9] = 1 if 2 <= length <= 11 else -1 if length > 25 else 0
    return out


def weak_labels(docs: DataFrame) -> DataFrame:
    """(doc_id, pattern): the votes as one number in base 3, least significant digit first (0 bad, 1 abstains, 2 good)."""
    powers = 3 ** np.arange(len(LABELLERS))

    def run(batches):
        own_cache("quality")  # lets go of what other operators kept
        for b in doc_batches(batches, 1 << 20):
            pattern = (votes(b.column("text")) + 1) @ powers
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(pattern, pa.int64())], ["doc_id", "pattern"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, pattern long")


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, tol: float = 1e-9) -> dict:
    """EM over vote patterns: P(bad or good vote | class, no abstention) of every labeller, P(good), and P(good | pattern)."""
    m = len(LABELLERS)
    digit = patterns[:, None] // 3 ** np.arange(m) % 3
    net = (digit - 1).sum(1)
    bad_votes = (digit == 0).sum(1)
    good = np.where(bad_votes >= 2, 0.1, np.where(net > 0, 0.95, 0.5))
    hot = (digit[:, :, None] == np.array([0, 2])).astype(float)  # an abstention says nothing: short texts leave many
    total = counts.sum()
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])
        table = np.einsum("cp,pmv->cmv", weight, hot) + 1.0
        table /= table.sum(2, keepdims=True)
        prior = (weight.sum(1) + 1) / (total + 2)
        log = np.log(prior)[:, None] + np.einsum("pmv,cmv->cp", hot, np.log(table))
        log -= log.max(0)
        new = np.exp(log[1]) / np.exp(log).sum(0)
        done = np.abs(new - good).max(initial=0) < tol
        good = new
        if done:
            break
    return {"vote_given_class": table, "good": float(prior[1]), "posterior": dict(zip(patterns.tolist(), good.tolist(), strict=True))}


def _shape(word: bytes) -> bytes:
    """Runs of one kind of character as one letter; signs stand for themselves."""
    out, last = bytearray(), 0
    for c in word:
        k = 97 if 97 <= c < 123 or c >= 128 else 65 if 65 <= c < 91 else 48 if 48 <= c < 58 else c
        if k != last:
            out.append(k)
            last = k
    return bytes(out)


def _features(word: bytes, dims: int) -> tuple[int, int, int]:
    """Hashed places of a word: itself, its shape and its last letters."""
    import xxhash

    low = word.lower()
    return tuple(xxhash.xxh32_intdigest(x) % dims for x in (b"w" + low, b"s" + _shape(word), b"e" + low[-3:]))


def _doc_features(text: bytes, dims: int, known: dict) -> tuple[np.ndarray, np.ndarray]:
    words = text.split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    at = []
    for w in words:
        f = known.get(w)
        if f is None:
            f = known[w] = _features(w, dims)
        at += f
    repeats = sum(map(eq, words, words[1:]))
    idx, n = np.unique(np.array(at, np.int32), return_counts=True)
    return np.r_[idx, dims].astype(np.int32), np.r_[n / len(words), repeats / len(words)].astype(np.float32)


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, dims: int = DIMS, rounds: int = 300, decay: float = 1e-5) -> np.ndarray:
    """Weights (dims hashed, one for repeats, bias last) of a logistic scorer, by Adam on all rows."""
    w = np.zeros(dims + 2)
    if not len(rows):
        return w
    idx = np.concatenate([r[0] for r in rows]).astype(np.int64)
    val = np.concatenate([r[1] for r in rows]).astype(float)
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    # both classes weigh the same
    p = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    weight = target / (2 * p) + (1 - target) / (2 * (1 - p))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.bincount(row, val * w[idx], len(rows)) + w[-1]
        err = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / len(rows)
        g = np.bincount(idx, val * err[row], dims + 2).astype(float)
        g[-1] = err.sum()
        g += decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def score_texts(texts: list[bytes], w: np.ndarray, known: dict) -> np.ndarray:
    """P(good); `known` keeps the weight of every word met."""
    dims = len(w) - 2
    z = np.full(len(texts), float(w[-1]))
    held = len(known)
    for i, t in enumerate(texts):
        words = t.split()
        if words:
            try:
                total = sum(map(known.__getitem__, words))
            except KeyError:
                for x in {x for x in words if x not in known}:
                    known[x] = float(sum(w[k] for k in _features(x, dims)))
                total = sum(map(known.__getitem__, words))
            z[i] += (total + w[dims] * sum(map(eq, words, words[1:]))) / len(words)
    for _ in range(len(known) - max(held, CACHE)):  # what is frequent came early and stays
        known.popitem()
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


class Model:
    """Scorer and labeller estimates; as large as DIMS, whatever the corpus."""

    def __init__(self, weights: np.ndarray, labellers: dict):
        self.weights, self.labellers = weights, labellers


def fit(spark: SparkSession, docs: DataFrame, train: int = TRAIN, dims: int = DIMS) -> Model:
    """Estimates the labellers from all documents, then the scorer from the sample."""
    weak = written(spark, weak_labels(docs), "quality-votes")
    table = weak.groupBy("pattern").count().toPandas()
    labellers = fit_labellers(table["pattern"].to_numpy(np.int64), table["count"].to_numpy(float))
    n = int(table["count"].sum())
    # the expected sample is 0.9 * train, so that the limit hardly ever cuts; the hash orders documents at random
    cut = 1.0 if n <= train else 0.9 * train / n
    mark = F.pmod(F.xxhash64(F.lit(8), "doc_id", "text"), F.lit(1 << 30))
    chosen = docs.select("doc_id", "text").where(mark < int(cut * (1 << 30)))
    powers = 3 ** np.arange(len(LABELLERS))
    posterior = labellers["posterior"]

    def run(batches):
        known: dict = {}
        for b in doc_batches(batches, 1 << 20):
            patterns = (votes(b.column("text")) + 1) @ powers
            rows = [_doc_features((t or "").encode("utf-8", "surrogatepass"), dims, known) for t in b.column("text").to_pylist()]
            known.clear()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0].tobytes() for r in rows], pa.binary()),
                    pa.array([r[1].tobytes() for r in rows], pa.binary()),
                    pa.array([posterior.get(p, 0.5) for p in patterns.tolist()], pa.float64()),
                ],
                ["idx", "val", "good"],
            )

    kinds = "idx binary, val binary, good double"
    got = chosen.mapInArrow(lean(run), kinds).limit(train).toPandas()
    if n and got.empty:  # a few rows over and over: their hashes may all lie beyond the cut
        got = docs.select("doc_id", "text").orderBy(mark).limit(min(train, 100)).mapInArrow(lean(run), kinds).toPandas()
    rows = [(np.frombuffer(a, np.int32), np.frombuffer(b, np.float32)) for a, b in zip(got["idx"], got["val"], strict=True)]
    return Model(fit_scorer(rows, got["good"].to_numpy(float), dims), labellers)


def score(docs: DataFrame, model: Model, name: str = "quality_score") -> DataFrame:
    """`docs` with a column `name`, P(good) by the scorer."""
    docs = docs.drop(name)
    weights, tag = model.weights.astype(np.float32), hash(model.weights.tobytes())

    def run(batches):
        known = own_cache("quality").setdefault(tag, {})
        for b in doc_batches(batches, 1 << 20):
            s = score_texts([(t or "").encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()], weights, known)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], [*b.schema.names, name])

    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lean(run), f"{kinds}, `{name}` double")


def classify(spark: SparkSession, docs: DataFrame, threshold: float = 0.2, names: tuple[str, str] = ("quality_score", "keep"), **fitting) -> DataFrame:
    """Every document with its score and whether to keep it (score at or above the threshold: a document goes only on clear evidence), in columns of these names."""
    return score(docs, fit(spark, docs, **fitting), names[0]).withColumn(names[1], F.col(names[0]) >= threshold)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return classify(spark, docs).select("doc_id", F.round("quality_score", 6).alias("quality_score"), "keep")
