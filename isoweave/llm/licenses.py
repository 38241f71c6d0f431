"""Operator 10: license scans by ordered signature rules.

A text becomes lower-cased words.  A document is looked at only if a gate word of
some rule is among its words (every match of a rule holds one of its gates), and
then only by the rules whose gates it has.  Of overlapping detections, be one inside
the other or only in part, the one of higher priority stays; of equal priority, the
one of more words, then the earlier one.  The base phrases are counted at every
place, whatever the rules say.

Nulls: a null text counts as empty: no words, no labels, score 0.  Repeated rows
give repeated rows; an empty table gives none.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import defaultdict
from functools import lru_cache
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import doc_batches, lean
from .license_rules import Rule, rules

#: Phrases whose every place counts, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: What bounds words becomes a blank; A-Z become small.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@lru_cache(maxsize=1)
def by_gate() -> dict[bytes, list[tuple[int, Rule]]]:
    out = defaultdict(list)
    for k, rule in enumerate(rules()):
        for gate in rule.gate:
            out[gate.encode()].append((k, rule))
    return dict(out)


def words_of(text: str) -> list[bytes]:
    """Runs of digits, letters a-z and characters beyond ASCII, A-Z lower-cased first."""
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def phrase_places(joined: bytes) -> list[tuple[int, bytes]]:
    """(first word's number, phrase) of every place; `joined` has a blank on either side of every word.

    Blanks are counted from one place to the next, so a text full of phrases takes no longer than another.
    """
    out = []
    for phrase in PHRASES:
        p, at, word, known = b" %s " % phrase.encode(), -1, 0, 0
        while (at := joined.find(p, at + 1)) >= 0:
            word, known = word + joined.count(b" ", known, at), at
            out.append((word, phrase.encode()))
    return sorted(out)


def suppressed(found: list[tuple[int, int, int, int, Rule]]) -> list[tuple[int, int, int, int, Rule]]:
    """Detections (start, end, -priority, rule number, rule) without those that a stronger one overlaps, by place; places count words."""
    kept: list = []  # no two of them overlap, so they stand in one order by start and by end
    for d in sorted(found, key=lambda d: (d[2], d[0] - d[1], d[0], d[3])):
        at = bisect(kept, d[0], key=itemgetter(0))
        if (at == 0 or kept[at - 1][1] <= d[0]) and (at == len(kept) or d[1] <= kept[at][0]) and not (at < len(kept) and kept[at][0] == d[0]):
            kept.insert(at, d)
    return kept


def detect(words: list[bytes], gates: set[bytes]) -> list[tuple[int, int, int, int, Rule]]:
    text = b" ".join(words).decode("utf-8", "replace")
    blanks = [m.start() for m in re.finditer(" ", text)]
    todo = {k: rule for g in gates for k, rule in by_gate()[g]}
    found = [(bisect(blanks, m.start()), bisect(blanks, m.end() - 1) + 1, -rule.priority, k, rule) for k, rule in sorted(todo.items()) for m in rule.pattern.finditer(text)]
    return suppressed(found)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts and places of the base phrases, labels, a score and the detections kept.

    score: 1 minus the product of (1 - confidence) over the distinct labels found, a base phrase counting 0.9.
    detections: rule, label, first word and the word behind the last one.
    """

    def run(batches):
        gates = by_gate()
        one = pa.struct([("rule", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(one)]
        for b in doc_batches(batches):
            rows = []
            for doc, text in zip(b.column("doc_id").cast(pa.int64()).to_pylist(), b.column("text").to_pylist(), strict=True):
                words = words_of(text or "")
                mine = gates.keys() & set(words)
                if not mine:
                    rows.append((doc, len(words), 0, None, None, "", "", 0.0, []))
                    continue
                places = phrase_places(b" " + b" ".join(words) + b" ")
                base = {PHRASES[p.decode()] for _, p in places}
                found = detect(words, mine)
                sure = dict.fromkeys(base, 0.9)
                for *_, rule in found:
                    sure[rule.label] = max(sure.get(rule.label, 0.0), rule.confidence)
                miss = 1.0
                for label in sorted(sure):
                    miss *= 1 - sure[label]
                rows.append(
                    (doc, len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted(base)), ",".join(sorted(sure)), 1 - miss)
                    + ([{"rule": r.name, "label": r.label, "start": s, "end": e} for s, e, _, _, r in found],)
                )
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
    return docs.select("doc_id", "text").mapInArrow(
        lean(run),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "detections array<struct<rule string, label string, start long, end long>>",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("detections")
