"""The semi-Markov conditional random field of operator 11: candidates, features, sums over segmentations, training.

A segmentation of a text is a set of candidate segments that don't overlap; what lies
between them is outside, with score 0.  Its score is the sum of its segments' scores
(weights of features of the whole span, for its type) and of a weight for each two
segments that touch.  A segment has bounded length, so best segmentation, sum over
all segmentations and marginals take one pass over the candidates in order.
Candidates that neither overlap nor touch are independent: they fall into clusters.
"""

from __future__ import annotations

import math
import random
import re
from functools import lru_cache
from typing import NamedTuple

KINDS = ("email", "ip", "card", "phone")
#: Bounds of a segment: digit groups, digits, characters between two groups, characters of a name before the at sign.
GROUPS, DIGITS, GAP, LOCAL = 8, 19, 3, 64

#: Words that announce a kind, and frequent top-level domains.
CUES = {
    "phone": frozenset("tel phone call fax mobile cell whatsapp telefon téléphone teléfono handy sms dial".split()),
    "card": frozenset("card visa mastercard amex credit carte karte tarjeta kreditkarte".split()),
    "ip": frozenset("ip ipv4 server host addr gateway dns".split()),
    "email": frozenset("mail email e-mail contact write correo courriel reach".split()),
    "number": frozenset("isbn order invoice version id no nr number ref date serial ticket".split()),
}
TLDS = frozenset("com org net edu gov io de fr es uk eu info co us ca ch at it nl dev app biz me".split())


class Segment(NamedTuple):
    start: int
    end: int
    kind: str
    key: tuple  # what its features are made of


def luhn(digits: str) -> bool:
    double = digits[-2::-2].translate(str.maketrans("0123456789", "0246813579"))
    return (sum(map(int, digits[-1::-2])) + sum(map(int, double))) % 10 == 0


def _side(c: str) -> str:
    if not c:
        return "edge"
    if c.isspace():
        return "blank"
    return "digit" if c.isdigit() else "letter" if c.isalpha() else c if c in "+-./@_=#$,:" else "mark"


_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")


def _cue(text: str, start: int) -> str:
    """The kind that one of the last three words within 28 characters announces."""
    for w in reversed(_WORD.findall(text, max(0, start - 28), start)[-3:]):
        for kind, words in CUES.items():
            if w.lower() in words:
                return kind
    return ""


_CLUSTER = re.compile(r"[0-9][0-9 ()\[\].\-/_\xa0+]*[0-9]")
_GROUP = re.compile("[0-9]+")
_DOTTED, _CHAIN = re.compile(r"\.[0-9]"), re.compile(r"[0-9]\.[0-9]")


def numeric(text: str) -> list[Segment]:
    """Candidates for ip, card and phone: runs of digit groups, with a + or ( before them.

    A segment has GROUPS groups and DIGITS digits at most, GAP characters between two of them, and behind its first group
    two groups of less than three digits at most, or four pairs behind a pair.  An ip is four groups with a dot in every
    gap, no part of a longer dotted chain.
    """
    out = []
    for m in _CLUSTER.finditer(text):
        if m.end() - m.start() < 7:
            continue
        groups = [g.span() for g in _GROUP.finditer(text, m.start(), m.end())]
        for i, (first, _) in enumerate(groups):
            lead, start = "", first
            while start > 0 and text[start - 1] in "+(" and first - start < 2:
                start -= 1
                lead = text[start] + lead
            lengths, seps, digits, short, pairs, dotted = [], [], "", 0, True, True
            cue = None
            for j in range(i, min(i + GROUPS, len(groups))):
                a, b = groups[j]
                n = b - a
                if j > i:
                    if a - groups[j - 1][1] > GAP:
                        break
                    seps.append(text[groups[j - 1][1] : a])
                    short += n < 3
                    dotted = dotted and "." in seps[-1]
                pairs = pairs and n == 2 and j - i < 5
                dotted = dotted and n <= 3 and j - i < 4 and int(text[a:b]) <= 255
                if len(digits) + n > DIGITS or short > 2 and not pairs and not dotted:
                    break
                digits += text[a:b]
                lengths.append(n)
                is_ip = dotted and j - i == 3 and not _DOTTED.match(text, b) and not _CHAIN.match(text, max(first - 2, 0))
                plain = len(digits) >= 7 and (short <= 2 or pairs and j - i == 4)
                if not is_ip and not plain:
                    continue
                if cue is None:
                    cue = _cue(text, start)
                at = start if "(" not in lead or any(")" in s for s in seps) else first
                key = (lead if at == start else "", tuple(lengths), tuple(seps), digits[0] if digits[0] in "01" else "2", 13 <= len(digits) and luhn(digits), _side(text[at - 1 : at]), _side(text[b : b + 1]), cue)
                if is_ip:
                    out.append(Segment(at, b, "ip", key))
                if plain and len(digits) >= 13:
                    out.append(Segment(at, b, "card", key))
                if plain and len(digits) <= 15:
                    out.append(Segment(at, b, "phone", key))
    return out


_AT = re.compile("@|(?<![A-Za-z0-9])[aA][tT](?![A-Za-z0-9])")
_DOT = r"(?:\.|[ \t]?[\[({<][ \t]?(?:\.|[dD][oO][tT])[ \t]?[\])}>][ \t]?|[ \t][dD][oO][tT][ \t])"
_RIGHT = re.compile(rf"([ \t]?[\])}}>]?[ \t]?)([A-Za-z0-9-]{{1,63}}+)((?:{_DOT}[A-Za-z0-9-]{{1,63}}+){{1,5}})(?![A-Za-z0-9-])")
_LABEL = re.compile(rf"({_DOT})([A-Za-z0-9-]{{1,63}}+)")
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def addresses(text: str) -> list[Segment]:
    """Candidates for email: a name, an at sign or the word in one of its disguises, and labels with dots or their disguises."""
    out = []
    for m in _AT.finditer(text):
        right = _RIGHT.match(text, m.end())
        if not right:
            continue
        k = m.start()
        before = ""
        while k and len(before) < 3 and text[k - 1] in " \t[({<":
            k -= 1
            before = text[k] + before
        name_end = k
        while k and name_end - k < LOCAL and text[k - 1] in _NAME:
            k -= 1
        if k == name_end:
            continue
        opened, closed = bool(before.strip()), bool(right[1].strip())
        if opened != closed:
            continue
        at = "bracket" if opened else ("spaced" if before or right[1] else "plain") if m[0] == "@" else "word"
        if at == "word" and not (before and right[1]):
            continue
        starts = [k] + [p + 1 for p in range(k, name_end - 1) if text[p] in ".%+"][:3]
        forms, labels = set(), 1
        cue = None
        for lab in _LABEL.finditer(text, right.end(2), right.end()):
            labels += 1
            forms.add("plain" if lab[1] == "." else "word" if lab[1].strip().lower() == "dot" else "bracket")
            tld = lab[2].lower()
            tld = "known" if tld in TLDS else "alpha" if tld.isalpha() and len(tld) <= 4 else "other"
            last = lab.end() == right.end()
            for s in starts:
                if cue is None:
                    cue = _cue(text, s)
                out.append(Segment(s, lab.end(), "email", (at, "+".join(sorted(forms)), min(labels, 4), tld, s == k, last, _side(text[s - 1 : s]) if s else "edge", cue)))
    return out


def candidates(text: str) -> list[Segment]:
    return sorted(set(numeric(text)) | set(addresses(text)))


def features(kind: str, key: tuple, strict: bool) -> list[str]:
    """Names of the features of a whole span, for its kind; strict: the span has the kind's plain form and passes its checks."""
    if kind == "email":
        at, dots, labels, tld, whole_name, whole_domain, left, cue = key
        own = [f"at={at}", f"dots={dots}", f"at={at},dots={dots}", f"labels={labels}", f"tld={tld}", f"name={whole_name}", f"domain={whole_domain}", f"left={left}", f"cue={cue == kind}"]
    else:
        lead, lengths, seps, first, checked, left, right, cue = key
        n = sum(lengths)
        marks = "".join(sorted(set("".join(seps)))).replace("\xa0", " ")
        even = len(set(seps)) <= 1
        shape = "-".join(map(str, lengths))
        own = [f"n={n}", f"groups={len(lengths)}", f"shape={shape}", f"marks={marks}", f"even={even}", f"lead={lead}", f"check={checked}", f"left={left}", f"right={right}", f"cue={cue}", f"first={first}"]
        own += [f"shape={shape},marks={marks}", f"lead={lead},cue={cue == kind}", f"n={n},check={checked}", f"lead={lead},marks={marks}"]
    return [f"{kind}:{f}" for f in (["bias", f"strict={strict}", *own])]


def clusters(segments: list[Segment]) -> list[list[Segment]]:
    """Segments in order, parted where one neither overlaps nor touches those before it."""
    out, reach = [], -1
    for s in segments:
        if s.start > reach:
            out.append([])
        out[-1].append(s)
        reach = max(reach, s.end)
    return out


class Field:
    """Weights by feature name, and what is worked out from them."""

    def __init__(self, weights: dict[str, float]):
        self.weights, self.known = weights, {}

    def score(self, s: Segment, strict: bool) -> float:
        k = (s.kind, s.key, strict)
        if k not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            self.known[k] = math.fsum(self.weights.get(f, 0.0) for f in features(*k))
        return self.known[k]

    def touch(self, a: str, b: str) -> float:
        return self.weights.get(f"{a}>{b}", 0.0)

    def best(self, cluster: list[Segment], strict: set) -> list[Segment]:
        """The segmentation of highest score; of equal ones the one with less inside, then the one with earlier segments."""
        places = sorted({p for s in cluster for p in (s.start, s.end)})
        ending: dict[int, list[Segment]] = {}
        for s in cluster:
            ending.setdefault(s.end, []).append(s)
        state: dict[int, dict[str, tuple]] = {places[0]: {"": (0.0, None)}}  # by place and kind of the segment that ends there: score, (segment, kind before it)
        for before, p in zip(places, places[1:], strict=False):
            kind, (value, _) = max(state[before].items(), key=lambda x: (x[1][0], x[0] == ""))
            now = {"": (value, (None, kind, before))}
            for s in ending.get(p, ()):
                own = self.score(s, (s.start, s.end, s.kind) in strict)
                for y, (v, _) in state[s.start].items():
                    total = v + own + (self.touch(y, s.kind) if y else 0.0)
                    if s.kind not in now or total > now[s.kind][0]:
                        now[s.kind] = (total, (s, y, s.start))
            state[p] = now
        p, out = places[-1], []
        kind = max(state[p].items(), key=lambda x: (x[1][0], x[0] == ""))[0]
        while state[p][kind][1] is not None:
            s, kind, p = state[p][kind][1]
            if s is not None:
                out.append(s)
        return out[::-1]

    def marginals(self, cluster: list[Segment], strict: set) -> tuple[float, list[float], dict[tuple[str, str], float]]:
        """Log of the sum over all segmentations, each segment's probability, and expected touches by pair of kinds."""
        places = sorted({p for s in cluster for p in (s.start, s.end)})
        by_end: dict[int, list[int]] = {}
        for k, s in enumerate(cluster):
            by_end.setdefault(s.end, []).append(k)
        scores = [self.score(s, (s.start, s.end, s.kind) in strict) for s in cluster]
        into = [0.0] * len(cluster)  # log sum of all that lies before a segment, its touch included
        alpha: dict[int, dict[str, float]] = {places[0]: {"": 0.0}}
        for before, p in zip(places, places[1:], strict=False):
            sums: dict[str, list[float]] = {"": list(alpha[before].values())}
            for k in by_end.get(p, ()):
                s = cluster[k]
                into[k] = _logsum([v + (self.touch(y, s.kind) if y else 0.0) for y, v in alpha[s.start].items()])
                sums.setdefault(s.kind, []).append(into[k] + scores[k])
            alpha[p] = {y: _logsum(v) for y, v in sums.items()}
        total = _logsum(list(alpha[places[-1]].values()))
        beta: dict[int, dict[str, float]] = {places[-1]: {y: 0.0 for y in alpha[places[-1]]}}
        by_start: dict[int, list[int]] = {}
        for k, s in enumerate(cluster):
            by_start.setdefault(s.start, []).append(k)
        touches: dict[tuple[str, str], float] = {}
        prob = [0.0] * len(cluster)
        for p, after in zip(places[-2::-1], places[:0:-1], strict=True):
            beta[p] = {}
            for y in alpha[p]:
                ways = [beta[after][""]]
                for k in by_start.get(p, ()):
                    s = cluster[k]
                    way = scores[k] + beta[s.end][s.kind] + (self.touch(y, s.kind) if y else 0.0)
                    ways.append(way)
                    share = math.exp(alpha[p][y] + way - total)
                    prob[k] += share
                    if y:
                        touches[y, s.kind] = touches.get((y, s.kind), 0.0) + share
                beta[p][y] = _logsum(ways)
        return total, prob, touches


def _logsum(x: list[float]) -> float:
    top = max(x)
    return top + math.log(math.fsum(math.exp(v - top) for v in x))


#: Labelled examples that the weights are fitted on, passes over them, step, penalty.
EXAMPLES, PASSES, STEP, PENALTY = 2500, 4, 0.5, 1e-4


def _number(r: random.Random, n: int, valid: bool | None = None) -> str:
    while True:
        d = str(r.randint(1, 9)) + "".join(str(r.randint(0, 9)) for _ in range(n - 1))
        if valid is None or luhn(d) == valid:
            return d


def _cut(d: str, *lengths: int) -> list[str]:
    out = []
    for n in lengths:
        out.append(d[:n])
        d = d[n:]
    return out


def _pseudo(r: random.Random) -> str:
    return "".join(r.choice(("ba", "len", "tor", "mi", "ne", "as", "ver", "qu", "io", "sch", "ta", "on", "re")) for _ in range(r.randint(1, 3)))


def example(r: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    """A made-up line with its personal data: plain and disguised forms, and forms that only look alike."""
    pick = r.choice
    word = lambda: _pseudo(r)
    two = lambda a, b: str(r.randint(a, b)).zfill(2)

    def email():
        name = pick((word(), f"{word()}.{word()}", f"{word()}{r.randint(1, 99)}", f"{word()}_{word()}"))
        labels = [word() + pick(("", str(r.randint(1, 9)))) for _ in range(r.randint(1, 2))] + [pick(sorted(TLDS))]
        at, dot = pick((("@", "."), ("@", "."), (" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "), (" AT ", " DOT "), ("@", "[.]"), (" (at) ", "."), ("[at]", "."), ("(at)", "(dot)"), ("{at}", "{dot}"), (" [@] ", "[.]")))
        return pick(("", "", "mail ", "contact ")), name + at + dot.join(labels)

    def ip():
        dot = pick((".", ".", ".", "[.]", "(.)", " . "))
        return pick(("", "", "ip ", "server ")), dot.join(str(r.randint(0, 255)) for _ in range(4))

    def card():
        n = pick((16, 16, 16, 15, 13, 19))
        d, sep = _number(r, n, True), pick(("", "", "-", " ", ".", "/", "_", "\xa0", "  "))
        parts = {16: (4, 4, 4, 4), 15: (4, 6, 5), 13: (4, 4, 5), 19: (4, 4, 4, 4, 3)}[n]
        return pick(("", "", "", "visa ", "card: ")), sep.join(_cut(d, *parts))

    def phone():
        a, b, c = str(r.randint(2, 9)) + _number(r, 2), _number(r, 3), _number(r, 4)
        form = r.randint(0, 9)
        if form <= 2:
            return pick(("", "", "tel ")), pick((f"+{r.randint(1, 99)} ({_number(r, 3)}) {b}-{c}", f"+{r.randint(1, 99)} {a} {b} {c}", f"+{r.randint(1, 99)}-{a}-{b}-{c}", f"+{r.randint(1, 99)} (0{_number(r, 2)}) {b}-{c}", f"+{_number(r, 11)}"))
        if form <= 5:
            return pick(("", "", "call ", "phone: ")), pick((f"({a}) {b}-{c}", f"({a}) {b} {c}", f"{a}-{b}-{c}", f"({a}){b}-{c}"))
        if form <= 6:
            return pick(("", "dial ", "tel. ")), pick((f"1-{a}-{b}-{c}", f"1 ({a}) {b}-{c}", f"00{r.randint(1, 99)} {a} {b}{c}", f"00{r.randint(10, 99)}-{a}-{b}{c}"))
        if form == 7:
            return pick(("", "tel ", "call ")), pick((" ", ".", "-")).join(_cut("0" + _number(r, 9), 2, 2, 2, 2, 2))
        return pick(("tel: ", "phone ", "call ", "fax ", "mobile ", "telefon ")), pick((f"{a} {b} {c}", f"{a}.{b}.{c}", f"0{a}{b}{c}", f"{a}{b}{c}", f"0{a}/{b}{c}", f"{a}-{c}"))

    def none():
        return pick(("", "", "order ", "id ", "version ", "isbn ")), pick(
            (
                lambda: f"{r.randint(1900, 2030)}-{two(1, 12)}-{two(1, 28)}", lambda: f"{two(1, 28)}.{two(1, 12)}.{r.randint(1900, 2030)}", lambda: f"{r.randint(1900, 2030)}-{r.randint(1900, 2030)}",
                lambda: f"{r.randint(1900, 2030)}-{two(1, 12)}-{two(1, 28)} {two(0, 23)}", lambda: f"{r.randint(1900, 2030)}/{two(1, 12)}/{two(1, 28)} {two(0, 23)}",
                lambda: f"{r.randint(0, 9)}.{_number(r, r.randint(6, 12))}", lambda: _number(r, pick((16, 16, 13, 14, 15, 17, 18, 19)), False), lambda: _number(r, r.randint(7, 12)),
                lambda: pick((" ", "-", ".")).join(_cut(_number(r, 16, False), 4, 4, 4, 4)), lambda: f"978-{r.randint(0, 9)}-{_number(r, 2)}-{_number(r, 6)}-{r.randint(0, 9)}", lambda: f"978-{_number(r, 10)}",
                lambda: f"{_number(r, 3)}-{_number(r, 2)}-{_number(r, 4)}", lambda: " ".join(_number(r, r.randint(1, 4)) for _ in range(r.randint(3, 7))), lambda: f"{r.randint(256, 999)}.{r.randint(0, 999)}.{r.randint(0, 99)}.{r.randint(0, 9)}",
                lambda: ".".join(str(r.randint(0, 30)) for _ in range(3)) + f".{r.randint(256, 9999)}", lambda: f"{word()} at {word()}.{pick(sorted(TLDS))}", lambda: f"{word()} at {word()}. {word()}", lambda: f"{word()} at {word()}.{word()}",
                lambda: f"{word()} at dot {word()}", lambda: "".join(pick("0123456789abcdef") for _ in range(40)), lambda: pick("abcdef") + _number(r, r.randint(8, 11)) + pick("abcdef"), lambda: f"{_number(r, 3)}.{_number(r, 3)}.{_number(r, 3)}", lambda: f"{_number(r, 6)}-{_number(r, 6)}",
                lambda: f"{_number(r, 4)}/{_number(r, 4)}", lambda: f"${_number(r, 4)}.{_number(r, 2)} {_number(r, 5)}", lambda: " ".join(_number(r, 3) for _ in range(4)), lambda: "-".join(_number(r, 5) for _ in range(3)), lambda: f"{_number(r, 3)} {_number(r, 3)} {_number(r, 4)}",
            )
        )()

    text, gold = " ".join(word() for _ in range(r.randint(0, 3))), []
    for _ in range(r.randint(1, 2)):
        kind = pick(("email", "ip", "card", "phone", "", "", ""))
        before, thing = {"email": email, "ip": ip, "card": card, "phone": phone, "": none}[kind]()
        text += pick((" ", " ", "\n", ", ")) if text else ""
        text += before
        if kind:
            gold.append((len(text), len(text) + len(thing), kind))
        text += thing
        text += pick(("", "", ".", ",", "!!", " " + word(), " " + word()))
    return text, gold


@lru_cache(maxsize=2)
def trained(seed: int = 11, examples: int = EXAMPLES) -> dict[str, float]:
    """Weights of highest likelihood on made-up lines, by passes of adaptive gradient steps; the same for every table."""
    from .pii import base_spans

    r, data = random.Random(seed), []
    for _ in range(examples):
        text, gold = example(r)
        strict = set(base_spans(text))
        for c in clusters(candidates(text)):
            marks = [k for k, s in enumerate(c) if (s.start, s.end, s.kind) in gold]
            inside = [g for g in gold if g[0] < max(s.end for s in c) and g[1] > c[0].start]
            if len(marks) == len(inside):  # else no candidate has a gold span
                data.append((c, strict, marks))
    weights: dict[str, float] = {}
    size: dict[str, float] = {}
    for _ in range(PASSES):
        r.shuffle(data)
        for c, strict, marks in data:
            field = Field(weights)
            _, prob, touches = field.marginals(c, strict)
            step: dict[str, float] = {}
            for k, s in enumerate(c):
                if abs(d := (k in marks) - prob[k]) > 1e-6:
                    for f in features(s.kind, s.key, (s.start, s.end, s.kind) in strict):
                        step[f] = step.get(f, 0.0) + d
            for pair, p in touches.items():
                step[">".join(pair)] = step.get(">".join(pair), 0.0) - p
            for a, b in zip(marks, marks[1:], strict=False):
                if c[a].end == c[b].start:
                    name = f"{c[a].kind}>{c[b].kind}"
                    step[name] = step.get(name, 0.0) + 1
            for f, d in step.items():
                d -= PENALTY * weights.get(f, 0.0)
                size[f] = size.get(f, 1e-8) + d * d
                weights[f] = weights.get(f, 0.0) + STEP * d / math.sqrt(size[f])
    return weights
