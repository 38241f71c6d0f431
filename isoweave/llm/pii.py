"""Operator 11: personal data by a semi-Markov conditional random field.

Base spans are what four plain forms match (email, ip, card, phone).  The field
(pii_model) scores candidate segments by features of the whole span, disguised forms
included ("name (at) host (dot) com", 10[.]0[.]0[.]1, a card with dots, a phone without
its +), and one pass over the candidates picks boundaries and types together.  What it
picks is added where it overlaps no base span; base spans stay whatever it says.

Its weights are fitted on EXAMPLES made-up lines, not on the table, so every table and
every size is scanned alike.  Every pattern runs over whole texts in linear time.

Nulls: a null text counts as empty: no spans.  Repeated rows and doc_ids give a row
each; an empty table gives none.  Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import re
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_batches, lean, picked
from .pii_model import KINDS, Field, candidates, clusters, luhn, trained

_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: A run of digits is tried at its start only: from within it the same would follow.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, -1
    while (at := text.find("@", at + 1)) >= 0:
        k = at
        while k > done and text[k - 1] in _NAME:
            k -= 1
        if k < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((k, m.end()))
            done = m.end()
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _digits(text: str, a: int, b: int, least: int, most: int) -> str | None:
    d = "".join(c for c in text[a:b] if c.isdigit())
    return d if least <= len(d) <= most else None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the plain forms that pass their checks, kind by kind, each leftmost and not overlapping."""
    out = [(a, b, "email") for a, b in _emails(text)]
    out += [(*m.span(), "ip") for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    out += [(*m.span(), "card") for m in _CARD.finditer(text) if (d := _digits(text, *m.span(), 13, 19)) and luhn(d)]
    out += [(*m.span(), "phone") for m in _PHONE.finditer(text) if _digits(text, *m.span(), 9, 15)]
    return out


def named(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (KINDS.index(s[2]), s[0], s[1])))


def scan_text(text: str, field: Field) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and the spans that the field adds, in order of their kinds and places."""
    base = base_spans(text)
    strict = set(base)
    found = [(s.start, s.end, s.kind) for c in clusters(candidates(text)) for s in field.best(c, strict)]
    added, k = [], 0
    taken = sorted((a, b) for a, b, _ in base)
    reach = []  # largest end of the base spans up to each
    for _, b in taken:
        reach.append(max(b, reach[-1] if reach else 0))
    for a, b, kind in sorted(found):
        while k < len(taken) and taken[k][0] < b:
            k += 1
        if not k or reach[k - 1] <= a:
            added.append((a, b, kind))
    return base, added


ENTITY = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, entities array<struct<kind string, start long, end long, base boolean>>"


def scan(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """One row per document: counts and a digest of the base spans, all spans, and these as entities (code points, end exclusive)."""
    weights = trained() if weights is None else weights
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.list_(ENTITY)]
    names = [c.split()[0] for c in SCHEMA.split(", ", 7)]

    def run(batches):
        field = Field(weights)
        for b in doc_batches(batches):
            rows = []
            for doc, text in zip(b.column("doc_id").cast(pa.int64()).to_pylist(), b.column("text").to_pylist(), strict=True):
                base, added = scan_text(text or "", field)
                entities = [{"kind": k, "start": a, "end": e, "base": known} for spans, known in ((base, True), (added, False)) for a, e, k in spans]
                rows.append((doc, *(sum(k == kind for _, _, k in base) for kind in KINDS), sha256(named(base).encode()).hexdigest(), named(base + added), entities))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return picked(docs, "doc_id", "text").mapInArrow(lean(run), SCHEMA)


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with [KIND] in place of every span; of overlapping ones the first by place stands for all."""
    out, done = [], 0
    for a, b, k in sorted(spans):
        if a >= done:
            out += [text[done:a], f"[{k.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redacted(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """docs with every span of its texts masked; all columns stay, null texts stay null."""
    weights = trained() if weights is None else weights
    schema, place = docs.schema, docs.columns.index("text")
    plain = docs.toDF(*[f"c{k}" for k in range(len(schema))])

    def run(batches):
        field = Field(weights)
        for b in doc_batches(batches):
            texts = [None if t is None else masked(t, sum(scan_text(t, field), [])) for t in b.column(place).to_pylist()]
            yield b.set_column(place, b.schema.field(place), pa.array(texts, b.schema.field(place).type))

    return plain.mapInArrow(lean(run), plain.schema).toDF(*docs.columns)


def totals(found: DataFrame) -> DataFrame:
    """(kind, base, documents, spans) over the rows of scan."""
    each = found.select("doc_id", F.explode("entities").alias("e")).groupBy("doc_id", "e.kind", "e.base").agg(F.count("*").alias("n"))
    return each.groupBy("kind", "base").agg(F.count("*").alias("documents"), F.sum("n").alias("spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("entities")
