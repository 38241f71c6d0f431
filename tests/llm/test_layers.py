"""Secrets in every kind of layer, texts that no scan may hang on, and a training sample that is never empty."""

import base64
import bz2
import gzip
import lzma
import random
import textwrap
import time
import zlib

import pytest

from isoweave.llm import html_text, licenses, quality, secrets

SECRET = "password = hunter2hunter2"
G = gzip.compress(SECRET.encode())
R = random.Random(1)
LONG = "".join(R.choice("abcdefgh \n") for _ in range(900)) + SECRET


def percent(raw):
    return "".join(f"%{b:02X}" for b in raw)


@pytest.mark.parametrize(
    "run",
    [
        percent(G), percent(zlib.compress(SECRET.encode())), percent(bz2.compress(SECRET.encode())), percent(lzma.compress(SECRET.encode())), "".join(f"\\x{b:02x}" for b in G), "".join(f"\\u00{b:02x}" for b in G),
        "\n".join(textwrap.wrap(base64.b64encode(gzip.compress(LONG.encode())).decode(), 76)), "\r\n  ".join(textwrap.wrap(base64.b64encode(LONG.encode()).decode(), 64)),
        "".join(f"\\u{{{ord(c):x}}}" for c in "token") + "=abcdefgh12345678", "\\U00000074oken=abcdefgh12345678", "token+%3D+abcdefgh12345678",
        base64.b64encode(SECRET.encode("utf-16-le")).decode(), base64.b64encode(SECRET.encode("utf-16-be")).decode(), base64.b64encode(percent(G).encode()).decode(), percent(base64.b64encode(G)),
    ],
)
def test_found_with_a_span_in_the_run(run):
    text = f"plain words {run} and more"
    base, spans = secrets.scan_text(text)
    assert base == [] and spans
    assert all(12 <= a < z <= 12 + len(run) for a, _, z in spans)


@pytest.mark.parametrize("unit", ["H4sI/", "KLUv/Q", "QlpoOTFBWSZTWQ/", "eJz/", "a/", "%41", "%1F%8B%08", "\\x1f\\x8b\\x08", "H4sICAAA/", "+", "\\u{41}"])
def test_long_runs(unit):
    began = time.time()
    secrets.scan_text(unit * (1_000_000 // len(unit)))
    assert time.time() - began < 15


def test_clean_texts_stay_clean():
    text = "\n".join("".join(R.choice("abcdefghijklmnop") for _ in range(60)) for _ in range(50)) + " BZh9 is no archive; x^2 + 100% of C:\\users\\new\\x41"
    assert secrets.scan_text(text) == ([], [])


def test_license_lines_in_great_number():
    began = time.time()
    words = licenses.words_of("cc by " * 200_000)
    places = licenses.phrase_places(b" " + b" ".join(words) + b" ")
    assert [p[0] for p in places] == list(range(0, 400_000, 2))
    licenses.detect(words, licenses.by_gate().keys() & set(words))
    assert time.time() - began < 15


@pytest.mark.parametrize("doc", [5, None])
def test_documents_of_one_id_train_the_scorer(spark, doc):
    rows = [(doc, " ".join(R.choice(("the river runs by the old town and its mill", "a fine day for the people of the place", "buy now!!! $$$ *** %%%")) for _ in range(R.randint(5, 40))) + f" {k}.") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.fit(spark, docs, train=50)
    assert model.weights.any()
    for text in ("one text", None, "buy now!!!", "an old mill by the river"):  # one row over and over
        same = spark.createDataFrame([(doc, text)] * 200, "doc_id long, text string")
        assert len({r["quality_score"] for r in quality.classify(spark, same, train=2).collect()}) == 1


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 20_000 + "x", "<p><button>" + "<div>" * 20_000 + "x", "<b><div>" * 10_000 + "</b>" * 10_000 + "x", "<table><tr><td>" * 5_000 + "x",
        "<style>" + "".join(f".a .b .c{k}{{display:none}}" for k in range(50)) + "</style>" + '<div class="a b">' * 20_000 + "x", "<style>.a > .a > .c .d{display:none}</style>" + "<div class=a>" * 20_000 + "x",
    ],
)
def test_deep_pages(page):
    began = time.time()
    assert html_text.render(page).strip().endswith("x")
    assert time.time() - began < 5


def test_selectors_of_nested_elements():
    style = "<style>.a > .b .c{display:none} div.x#y{display:none} .c.d{display:inline}</style>"
    assert html_text.render(style + "<div class=a><div class=b><p><i class=c>no</i></p></div></div><p class=a><i class=q><b class=b><i class=c>yes</i></b></i>").split() == ["yes"]
    assert html_text.render(style + "<div class='x z' id=y>no</div><div class=x>one</div><div id=y>two</div>").split() == ["one", "two"]


def test_pages_with_names_that_differ_in_case(spark):
    pages = spark.createDataFrame([(1, "<p>a", "k", "old")], "page_id long, html string, Text string, HTML string")
    got = html_text.extract(pages)
    assert got.columns == ["page_id", "Text", "HTML", "text"] and tuple(got.collect()[0]) == (1, "k", "old", "a")
