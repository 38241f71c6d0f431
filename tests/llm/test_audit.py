"""Operator 12 against plain loops over documents and orders."""

from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations
from math import factorial

from hypothesis import given, settings
from hypothesis import strategies as st

from isoweave.llm import audit

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def fails(docs):
    """Letters that each (doc_id, text, source) fails, by looking at all others."""
    out = []
    for i, text, _ in docs:
        t = text or ""
        words = [w for w in t.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
        f = ""
        if len(words) < 50:
            f += "A"
        if 100 * len(set(words)) < 65 * len(words):
            f += "B"
        if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t):
            f += "C"
        if any(c in "#$%&*|" for c in t):
            f += "D"
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs):
            f += "E"
        out.append(f)
    return out


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    failed, rows = fails(docs), {}
    parts = defaultdict(list)
    for (i, _, s), f in zip(docs, failed, strict=True):
        parts[s or ""].append((i, f))
    for part, mine in parts.items():
        total = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if letter in f]
                stay = [(i, f) for i, f in left if letter not in f]
                total[letter] += len(gone)
                rows[part, "".join(order), step] = (
                    len(stay), len(gone), sum(letter in f for _, f in mine) - len(gone), sum(f == letter for _, f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), letter)
                left = stay
        for k in [k for k in rows if k[0] == part]:
            rows[k] = (*rows[k][:-1], total[rows[k][-1]])
    return rows


def run(spark, docs, labels):
    counts = audit.mask_counts(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in audit.interactions(counts).collect()}


WORDS = " ".join(f"w{k}" for k in range(60))


def test_all_orders(spark):
    docs = [
        (1, WORDS, "a"), (2, WORDS, "a"), (3, WORDS, "b"), (3, WORDS, "b"), (None, WORDS, "a"), (None, WORDS, None),  # copies, repeated rows, no id
        (4, None, "a"), (5, "", "a"), (6, " \n\t", ""), (7, "x", None),  # empty
        (8, "A" * 3 + " b" * 57, "a"), (9, "A" * 3 + "b" * 57, "b"), (10, "Ä" * 50, "b"),  # 5 % is not over 5 %
        (11, WORDS + " |", "a"), (12, WORDS.replace(" ", "\x0b"), "b"), (13, WORDS.replace(" ", "\xa0"), "b"), (14, "the " * 70, "b"), (15, "the " * 70, "a"),
        (16, " ".join(f"w{k}" for k in range(49)), "a"), (17, " ".join(f"w{k % 65}" for k in range(100)), "a"), (18, " ".join(f"w{k % 64}" for k in range(100)), "a"),
        (19, "word " * 200_000, "long"), (0, "The$ " * 60, "a"), (20, "The$ " * 60, "a"),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (None, 1, 1), (14, 0, 1), (15, 1, None), (99, 1, 1), (20, 1, 1)]
    got = run(spark, docs, labels)
    assert got == brute(docs, labels)
    assert {p for p, _, _ in got} == {"a", "b", "", "long"} and len(got) == 4 * 600


def test_hot_text_and_id(spark):
    docs = [(k % 300, "the same", f"s{k % 3}") for k in range(900)] + [(7, f"text {k}", "s0") for k in range(300)]
    assert run(spark, docs, [(7, 1, 1)]) == brute(docs, [(7, 1, 1)])


def test_empty_and_clashing_columns(spark):
    assert run(spark, [], []) == {}
    docs = spark.createDataFrame([(1, "a b", "s", 3, 4)], DOCS + ", mask int, n int").selectExpr("*", "'x' AS Text", "0 AS good", "0 AS first", "0 AS sha")
    got = audit.interactions(audit.mask_counts(docs, spark.createDataFrame([], LABELS))).collect()
    assert len(got) == 600 and {r["removed"] for r in got if r["filter_order"][r["step"] - 1] == "A"} == {1}


@given(st.dictionaries(st.integers(0, 31), st.integers(1, 1 << 70)))
@settings(max_examples=60, deadline=None)
def test_polynomial(counts):
    p = audit.removal_polynomial(counts)
    for s in range(32):
        assert audit.at_corner(p, s) == sum(n for m, n in counts.items() if m & s)
    for k in range(5):
        assert audit.shapley(p, k) == sum((Fraction(n, m.bit_count()) for m, n in counts.items() if m >> k & 1), Fraction(0))
        assert (audit.shapley(p, k) * factorial(5)).denominator == 1


def test_pairs(spark):
    docs = [(1, "A$", "s"), (2, "A$", "s"), (3, WORDS, "s")]
    got = {(r["first"], r["second"]): (r["both"], r["either"]) for r in audit.pairs_at(audit.mask_counts(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS))).collect()}
    assert got["A", "C"] == (2, 2) and got["A", "E"] == (1, 2) and got["B", "E"] == (0, 1) and len(got) == 10
