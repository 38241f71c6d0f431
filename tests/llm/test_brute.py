"""Whole queries against brute force on the driver's smallest tables, and the pipeline on a fixture of odd rows."""

import hashlib
import random
import re
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest

from isoweave.llm import html_text, license_rules, licenses, quality, secrets, simhash

from .test_texts import brute_repeats, components

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    """(id, text) of whole documents in a shuffled order, some odd ones among them."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "ends in word"), (10**6 + 3, "0f" * 16), (10**6 + 3, "0f" * 16), (None, "token: abcdefghi all rights reserved"), (10**6 + 4, "AKIA" + "A" * 20)]
    random.Random(3).shuffle(rows)
    return rows


def naive_base(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?a:([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 32]
    return sorted(out)


def test_secrets_of_all_documents(spark, documents):
    df = spark.createDataFrame(documents, "doc_id long, text string")
    want = sorted(((i is None, i or 0), [(secrets.KINDS[k], s, e) for s, k, e in naive_base(t or "")]) for i, t in documents)
    rows = secrets.scan(df).collect()
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), [tuple(x) for x in r["base"]]) for r in rows) == want
    assert all({tuple(x) for x in r["base"]} <= {tuple(x) for x in r["spans"]} for r in rows)
    # no prefilter: every text scanned in full gives the same
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), [(secrets.KINDS.index(x["kind"]), x["start"], x["end"]) for x in r["spans"]]) for r in rows) == sorted(
        ((i is None, i or 0), [(k, s, e) for s, k, e in secrets.scan_text(t or "")[1]]) for i, t in documents
    )
    for r in secrets.redacted(df).collect():
        assert secrets.scan_text(r["text"] or "")[1] == []


def test_licenses_of_all_documents(spark, documents):
    df = spark.createDataFrame(documents, "doc_id long, text string")
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), *tuple(r)[1:7]) for r in licenses.scan(df).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels").collect())
    want = []
    for i, t in documents:
        words = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        places, base = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
            places += at
            base |= {label} if at else set()
        want.append(((i is None, i or 0), len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base))))
    key = lambda r: (r[0], r[1])
    assert [g[:6] for g in sorted(got, key=key)] == sorted(want, key=key)
    assert all(set(g[5].split(",")) - {""} <= set(g[6].split(",")) for g in got)


def test_gates_lose_no_rule(documents):
    """All rules without gates and a quadratic resolution of overlaps find what the scan finds."""
    looked = 0
    made = licenses.rules()
    anchors = re.compile("licen|cc by|rights|domain|copyright|warrant|propriet|gpl|mit |spdx")
    for _, t in documents:
        words = licenses.words_of(t or "")
        text = b" ".join(words).decode()
        if not anchors.search(text) or len(text) > 20_000:
            continue
        looked += 1
        found = [(text.count(" ", 0, m.start()), text.count(" ", 0, m.end()) + 1, -rule.priority, k, rule) for k, rule in enumerate(made) for m in rule.pattern.finditer(text)]
        kept = []
        for d in sorted(found, key=lambda d: (d[2], d[0] - d[1], d[0], d[3])):
            if all(d[1] <= k[0] or k[1] <= d[0] for k in kept):
                kept.append(d)
        mine = licenses.by_gate().keys() & set(words)
        assert [d[:4] for d in licenses.detect(words, mine)] == [d[:4] for d in sorted(kept, key=lambda d: d[:4])]
        if looked == 40:
            break
    assert looked > 5


def test_the_higher_priority_wins_a_partial_overlap():
    words = licenses.words_of("licensed under the public domain")
    assert [d[4].label for d in licenses.detect(words, licenses.by_gate().keys() & set(words))] == ["public-domain"]
    assert license_rules.written() == 369


def test_em_against_a_plain_loop():
    """Estimates and posteriors from a loop over documents, labellers and classes."""
    r = np.random.default_rng(5)
    m = len(quality.LABELLERS)
    truth = r.random(400) < 0.7
    votes = np.where(r.random((400, m)) < 0.3, 0, np.where(r.random((400, m)) < np.linspace(0.6, 0.95, m), np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None]))
    patterns, counts = np.unique((votes + 1) @ 3 ** np.arange(m), return_counts=True)
    got = quality.fit_labellers(patterns, counts.astype(float))
    docs = [[int(p) // 3**k % 3 - 1 for k in range(m)] for p, c in zip(patterns, counts, strict=True) for _ in range(c)]
    good = [0.1 if v.count(-1) >= 2 else 0.95 if sum(v) > 0 else 0.5 for v in docs]
    for _ in range(200):
        table = [[[1.0, 1.0] for _ in range(m)] for _ in range(2)]
        for v, g in zip(docs, good, strict=True):
            for k in range(m):
                if v[k]:
                    table[0][k][v[k] > 0] += 1 - g
                    table[1][k][v[k] > 0] += g
        table = [[[x / sum(pair) for x in pair] for pair in cls] for cls in table]
        prior = [(sum(1 - g for g in good) + 1) / (len(docs) + 2), (sum(good) + 1) / (len(docs) + 2)]
        new = []
        for v in docs:
            like = [prior[c] * float(np.prod([table[c][k][v[k] > 0] for k in range(m) if v[k]])) for c in range(2)]
            new.append(like[1] / sum(like))
        done = max(abs(a - b) for a, b in zip(new, good, strict=True)) < 1e-9
        good = new
        if done:
            break
    assert np.allclose(got["vote_given_class"], np.array(table), atol=1e-6)
    flat = {int(p): good[k] for p, k in zip(patterns, np.r_[0, np.cumsum(counts)[:-1]], strict=True)}
    assert all(abs(got["posterior"][p] - g) < 1e-6 for p, g in flat.items())


def test_scores_and_held_out_labels(spark):
    """Every score is the scorer's on the words themselves, and the labelled documents are told apart."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").withColumnRenamed("text", "text")
    clash = docs.selectExpr("doc_id", "text", "'x' AS quality_score", "1 AS Keep")
    model = quality.fit(spark, clash)
    w = model.weights.astype(np.float32)
    scored = {r["doc_id"]: (r["text"], r["quality_score"]) for r in quality.score(clash, model).collect()}
    for text, s in list(scored.values())[:300]:
        words = (text or "").encode().split()
        z = float(w[-1])
        if words:
            z += (sum(float(sum(w[k] for k in quality._features(x, len(w) - 2))) for x in words) + w[-2] * sum(a == b for a, b in zip(words, words[1:]))) / len(words)
        assert abs(s - 1 / (1 + np.exp(-np.clip(z, -60, 60)))) < 1e-4
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    hit = [(scored[r["doc_id"]][1] >= 0.2) == bool(r["quality"]) for r in labels if r["doc_id"] in scored and r["quality"] is not None]
    assert len(hit) > 50 and np.mean(hit) > 0.9


class Plain(HTMLParser):
    """The words of a page in order, whatever their layout."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.words, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title", "template", "noscript")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title", "template", "noscript") and self.skip > 0

    def handle_data(self, data):
        if not self.skip:
            self.words += data.split()


def test_pages_keep_their_words(spark):
    """Pages without anything that hides text give all words of a plain parser (tables: in whatever order their layout has), and only words of the page."""
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    plain = 0
    for page in pages:
        parser = Plain()
        parser.feed(page)
        parser.close()
        flat = lambda x: sorted(re.findall(r"\w+", x))
        got, all_words = flat(html_text.render(page)), flat(" ".join(parser.words))
        if re.search(r"hidden|display|visibility|<details|<dialog|<select|<ol|<svg|<math|<object|<iframe|<video|<audio|<canvas|<textarea|<input", page):
            continue
        plain += 1
        assert got == all_words
    assert plain > 5


def test_html_rules_of_nesting_and_spans():
    r = html_text.render
    assert r("<style>div p{display:none}</style><div><section><p>no</p></section></div><p>yes") == "yes"
    assert r("<style>div > p{display:none}</style><div><section><p>one</p></section><p>no</div><p>two") == "one\n\ntwo"
    assert r("<style>p.a.b#c{display:none} p:hover{display:none}</style><p class='b a' id=c>no<p class=a>yes") == "yes"
    assert r('<div style="visibility:hidden">no<span style="visibility:visible">yes</span> no</div>') == "yes"
    assert r("<table><tr><td rowspan=2>A<td>B<tr><td>C<td>D<tr><td>E<td>F</table>") == "A  B\n   C  D\nE  F"
    assert r("<table><tr><td colspan=2>wide cell<td>z<tr><td>a<td>b<td>c</table>") == "wide cell  z\na  b  c"
    assert r("<ol><li>a<li value=9>b<li>c</ol>") == "1. a\n9. b\n10. c"
    assert r("<b><p>one</b> two</p> three") == "one two\n\nthree" and r("<div><span>x<div>y</span>z</div></div>w") == "x\nyz\nw"


def test_extract_on_odd_tables(spark):
    schema = "page_id long, html string, text string"
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0
    out = html_text.extract(spark.createDataFrame([(1, "<p>a", "x"), (1, "<p>a", "x"), (None, None, "y"), (2, "", None)], schema))
    assert sorted((r["page_id"] or 0, r["text"]) for r in out.collect()) == [(0, ""), (1, "a"), (1, "a"), (2, "")]


def test_pipeline_against_brute_force(spark, tmp_path):
    """Every stage on what the one before it kept: null ids and texts, rows that repeat, ids that repeat, clashing columns."""
    import corpus_pipeline as p
    import public_tokenizers
    from tokenizers import Tokenizer

    r = random.Random(11)
    words = ["the", "of", "and", "to", "in"] + ["".join(r.choices("aeioubcdlmnrst", k=r.randint(3, 8))) for _ in range(300)]
    sentence = lambda: " ".join(r.choices(words[:5], k=3) + r.choices(words, k=9)).capitalize() + ". "
    passage = "".join(sentence() for _ in range(8))
    clean = [(i, "".join(sentence() for _ in range(r.randint(3, 12)))) for i in range(40)]
    clean = [(i, (t + passage if i % 4 == 0 else t).strip()) for i, t in clean]
    clean += [(100 + i, t + " Changed at the end of it.") for i, t in clean[::5]] + [(200 + i, t) for i, t in clean[::7]]
    docs = clean + [(300, "%%% |||| " * 60), (301, ""), (302, None), (303, "x"), (None, "a text of a null id " * 9), (None, None), clean[3], (5, "Another text of the id five, and unlike the first one. " + sentence()), (77, sentence() + "token: hunter2hunter2 and " * 3)]
    rows = [(i, t, "en", "s", len(t or ""), "q", 1) for i, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, quality_score string, sha int")
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["text"] is None)
    kept = {}
    cur = df
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, cur, str(tmp_path))
        assert out.columns == df.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        kept[name] = sorted(out.collect(), key=key)
        cur = spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")
        assert all(r["quality_score"] == "q" and r["sha"] == 1 for r in kept[name])
    assert 50 < len(kept["quality"]) < len(docs)  # what is clean stays, signs alone go
    # near-duplicates: one document of each group, by all pairs; null ids and texts that are unlike stay
    before = {(r["doc_id"], r["text"] or "") for r in kept["quality"] if r["doc_id"] is not None}
    names = {d: (d[0], hashlib.sha256(d[1].encode()).hexdigest()) for d in before}
    sets = {d: set(simhash.word_shingles(d[1].encode(), 5, simhash._words)) for d in before}
    order = sorted(before, key=names.get)
    alike = lambda a, b: order[a][1] == order[b][1] or len(sets[order[a]] & sets[order[b]]) >= 0.8 * max(1, len(sets[order[a]] | sets[order[b]]))
    comp = components(range(len(order)), alike)
    want = sorted((order[k][0], order[k][1]) for k in comp if comp[k] == k)
    assert sorted((r["doc_id"], r["text"] or "") for r in kept["near_duplicates"] if r["doc_id"] is not None) == want
    assert sum(r["doc_id"] is None for r in kept["near_duplicates"]) == sum(r["doc_id"] is None for r in kept["quality"])
    # repeats, secrets
    ids = [r["doc_id"] for r in kept["near_duplicates"] if r["doc_id"] is not None]
    single = [(r["doc_id"], r["text"]) for r in kept["near_duplicates"] if r["doc_id"] is not None and ids.count(r["doc_id"]) == 1]
    left = brute_repeats(single)
    for r in kept["repeats"]:
        if ids.count(r["doc_id"]) == 1:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == left[r["doc_id"]][3]
    masked = {key(r) for r in kept["secrets"]}
    for r in kept["repeats"]:
        out, at = "", 0
        for s, _, e in secrets.scan_text(r["text"] or "")[1]:
            if s >= at:
                out += (r["text"] or "")[at:s] + "[SECRET]"
            at = max(at, e)
        assert (r["doc_id"] is None, r["doc_id"] or 0, out + (r["text"] or "")[at:], False) in masked
    # packing: every id once, no sequence overfull
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = p.STAGES[-1][1](spark, cur, str(tmp_path)).collect()
    crc = sorted((r["doc_id"] or -1, r["start"], r["length"], r["ids_crc32"]) for r in pieces)
    ids_of = [(r["doc_id"] or -1, np.array([*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")) for r in kept["secrets"]]
    assert crc == sorted((i, k, min(4096, len(x) - k), zlib.crc32(x[k : k + 4096].tobytes())) for i, x in ids_of for k in range(0, len(x), 4096))
    room = {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == room.get(r["sequence_id"], 0)
        room[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(room.values()) <= 4096
    empty = spark.createDataFrame([], df.schema)
    for _, stage in p.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_sentences_of_licenses():
    """A document that holds a sentence of TEXTS has its label, whatever the signs and blanks between the words."""
    for label, pattern in license_rules._texts():
        plain = re.sub(r"\(([^()|]*)[^()]*\)\??", r"\1", re.sub(r"\(\[\^ \]\+ \)\{1,8\}", "some one ", re.sub(r"\((publication)[^()]*\)", r"\1", pattern))).replace(" ?", " ").replace("s?", "s")
        if not re.fullmatch(r"[a-z0-9 ]+", plain):
            continue
        words = licenses.words_of("Notice. " + ", ".join(plain.upper().split(" ")) + "!")
        assert label in {d[4].label for d in licenses.detect(words, licenses.by_gate().keys() & set(words))}, (label, plain)


def test_similar_texts_are_proposed_by_simhash(spark, monkeypatch):
    """Near copies meet by their fingerprints, without any shingle prefix; exact similarity still decides; what the radius misses comes by prefixes."""
    from isoweave.llm import simhash

    words = [f"w{k}" for k in range(400)]
    long, other = " ".join(words), " ".join(f"v{k}" for k in range(400))
    short = "a b c d e f g h i j k l m n o p q r s t"
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, other), (4, short), (5, short + " u"), (6, ""), (7, None), (8, "!")], "doc_id long, text string")
    groups = lambda: {r["doc_id"]: r["component_id"] for r in simhash.similar(spark, docs).collect()}
    whole = groups()
    assert whole[1] == whole[2] == 1 and whole[4] == whole[5] == 4 and 3 not in whole
    monkeypatch.setattr(simhash, "_first_pairs", lambda *_: spark.createDataFrame([], "a long, b long, token long, n int, at int"))
    assert groups().get(2) == 1 and 3 not in groups()
