"""Operator 11: base forms against the patterns as given, the field against all segmentations, held-out lines."""

import hashlib
import math
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from isoweave.llm import pii
from isoweave.llm import pii_model as pm

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            held = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False, "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if held:
                out.append((*m.span(), kind))
    return out


def row(doc, text):
    b = brute(text or "")
    digest = hashlib.sha256(",".join(f"{k}:{a}:{e}" for a, e, k in b).encode()).hexdigest()
    return (doc, *(sum(x[2] == k for x in b) for k in PATTERNS), digest)


@given(st.lists(st.sampled_from(["a", "@", ".", "-", "1", "12", "255", "256", "4111 1111", "1111 1111", "+", "(", ")", " ", "é", "\n", "%", "b.c", "00", "１"]), max_size=40).map("".join))
@settings(max_examples=1500, deadline=None)
def test_base_forms(text):
    assert pii.base_spans(text) == brute(text)


def ways(cluster):
    """All sets of segments that don't overlap."""
    out = [[]]
    for s in cluster:
        out += [w + [s] for w in out if not w or w[-1].end <= s.start]
    return out


def total(field, way, strict):
    return sum(field.score(s, (s.start, s.end, s.kind) in strict) for s in way) + sum(field.touch(a.kind, b.kind) for a, b in zip(way, way[1:]) if a.end == b.start)


@pytest.mark.parametrize("seed", range(25))
def test_all_segmentations(seed):
    r = random.Random(seed)
    n = r.randint(1, 9)
    cluster = []
    for k in range(n):
        a = r.randint(0, 8)
        cluster.append(pm.Segment(a, a + r.randint(1, 5), r.choice(pm.KINDS), ("x", k)))
    cluster = sorted(set(cluster))
    field = pm.Field({f"{a}>{b}": r.uniform(-1, 1) for a in pm.KINDS for b in pm.KINDS})
    field.known = {(s.kind, s.key, False): r.uniform(-1, 1.5) for s in cluster}
    sums = {tuple(w): total(field, w, set()) for w in ways(sorted(cluster, key=lambda s: (s.end, s.start)))}
    for part in pm.clusters(cluster):
        inner = {w: v for w, v in sums.items() if all(s in part for s in w)}
        assert math.isclose(total(field, field.best(part, set()), set()), max(inner.values()), abs_tol=1e-9)
        log_sum, prob, touches = field.marginals(part, set())
        z = sum(math.exp(v) for v in inner.values())
        assert math.isclose(log_sum, math.log(z), abs_tol=1e-9)
        for k, s in enumerate(part):
            assert math.isclose(prob[k], sum(math.exp(v) for w, v in inner.items() if s in w) / z, abs_tol=1e-9)
        for pair in {(a, b) for a in pm.KINDS for b in pm.KINDS}:
            want = sum(math.exp(v) * sum((a.kind, b.kind) == pair and a.end == b.start for a, b in zip(w, w[1:])) for w, v in inner.items()) / z
            assert math.isclose(touches.get(pair, 0.0), want, abs_tol=1e-9)


def test_held_out_lines():
    field, r = pm.Field(pm.trained()), random.Random(2024)
    right = missed = wrong = 0
    for _ in range(1500):
        text, gold = pm.example(r)
        strict = set(pii.base_spans(text))
        found = {(s.start, s.end, s.kind) for c in pm.clusters(pm.candidates(text)) for s in field.best(c, strict)}
        right += len(found & set(gold))
        missed += len(set(gold) - found)
        wrong += len(found - set(gold))
    assert right / (right + missed) > 0.98 and right / (right + wrong) > 0.98


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("write to jane.doe (at) example (dot) org now", "email:9:40"),
        ("at 10[.]0[.]12[.]255, then", "ip:3:20"),
        ("card 4111.1111.1111.1111 ok", "card:5:24"),
        ("call (415) 555-0132.", "phone:5:19"),
        ("x +1 (826) 555-4081 190.137.223.204 y", "ip:20:35,phone:2:19"),
        ("two 4111111111111111 4111111111111111", "card:4:20,card:21:37"),
        ("meet at example.com, 2024-05-17, 1990-2000, 4111 1111 1111 1112", ""),
        ("token 71495086c919698889f59b72ab7bb6 and v1.2.3, 978-3-16-148410-0", ""),
    ],
)
def test_examples(text, found):
    base, added = pii.scan_text(text, pm.Field(pm.trained()))
    assert pii.named(base + added) == found


def test_rows(spark):
    line = "a@b.cd 1.2.3.4 4111 1111 1111 1111 +49 30 123456 (at) x"
    texts = [line, None, "", "  ", line, "é" * 50 + line, "+1 (826) 555-4081 190.137.223.204", line * 300]
    docs = [(k % 6 if k != 3 else None, t) for k, t in enumerate(texts)]
    got = pii.scan(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS Text", "2 AS spans", "3 AS n_email")).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((row(*d) for d in docs), key=str)
    for r in got:
        base = {f"{e['kind']}:{e['start']}:{e['end']}" for e in r["entities"] if e["base"]}
        assert base <= set(r["spans"].split(",")) and len(r["entities"]) == len([x for x in r["spans"].split(",") if x])
    assert pii.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    sums = {(r["kind"], r["base"]): r["spans"] for r in pii.totals(spark.createDataFrame(got)).collect()}
    assert sums["email", True] == sum(r["n_email"] for r in got)


def test_masks(spark):
    docs = spark.createDataFrame([(1, "to a@b.cd, +49 30 1234567!", "k"), (2, None, "k"), (3, "clean 2024", "k")], "doc_id long, text string, Text string")
    with_case = spark.conf.get("spark.sql.caseSensitive")
    rows = {r[0]: tuple(r) for r in pii.redacted(docs).collect()}
    assert rows == {1: (1, "to [EMAIL], [PHONE]!", "k"), 2: (2, None, "k"), 3: (3, "clean 2024", "k")}
    assert spark.conf.get("spark.sql.caseSensitive") == with_case


@pytest.mark.parametrize("unit", ["(at) ", "1 ", "+1", "a@", "a", "1", "1.2.3.", "a.b at c dot d ", "((", "4111-1111-", "%", "."])
def test_long_texts(unit):
    field, began = pm.Field(pm.trained()), time.time()
    pii.scan_text(unit * (500_000 // len(unit)) + "@b.c", field)
    assert time.time() - began < 10


def test_query(spark):
    got = pii.query(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert sorted(tuple(r)[:6] for r in got.collect()) == sorted(row(*d) for d in docs)
