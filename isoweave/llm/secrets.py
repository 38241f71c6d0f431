"""Operator 6: secret scans with a recursive decoding worklist.

A text is layer 0.  Every layer is scanned for secrets, and every encoded run in
it (percent escapes, Unicode and byte escapes, base64, compressed bytes inside
base64) is unwrapped into a new layer, until nothing new comes.  A layer whose
content was seen before at the same place is not unwrapped again, so cycles end.
Bytes that are no UTF-8 become U+FFFD one by one.  Bytes of any layer may be compressed;
base64 may be wrapped over lines and hold UTF-16; in forms a + may be a blank.  A base64 run is read in every step
that a sign among + / - _ in it may begin; what is compressed goes through in
overlapping windows, however much it is.
Each layer carries, for every character, the code points of the document it came
from, so a finding in any depth has a span in the document.

A cheap vectorised look at the bytes tells which documents can hold anything; it
tests conditions that every match and every layer needs, so it drops none.

Nulls: a null text counts as empty and gives a row without findings.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_batches, lean, own_cache, utf8

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
PERCENT = re.compile(r"""(?<![^\s%"'<>])[^\s%"'<>]*(?:%[0-9A-Fa-f]{2}[^\s%"'<>]*)+""")
_ESCAPE = r"\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}"
ESCAPES = re.compile(rf"""(?<![^\s\\"'<>])[^\s\\"'<>]*(?:(?:{_ESCAPE})[^\s\\"'<>]*)+""")
ESCAPE = re.compile(_ESCAPE)
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
#: Base64 that is wrapped: lines of one run and what may stand before the next.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{40,128}\r?\n[ \t]*)+[A-Za-z0-9+/_-]+={0,2}")
#: Where compressed bytes may begin.
PACKED = re.compile(rb"\x1f\x8b\x08|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda]")
#: Shortest base64 run that is unwrapped; bytes of a window on decompressed bytes, and how far windows overlap.
BASE64_LEAST, WINDOW, OVERLAP = 16, 8 << 20, 1 << 20
BORDER = re.compile(r"[+/_-]+")
LONE = re.compile("[\udc80-\udcff]")
#: What every finding and every further layer needs.
SIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)|%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\u\{|\\U[0-9A-Fa-f]{8}|[A-Za-z0-9+/_-]{16}""")

_TABLE = np.zeros(256, np.uint8)
_TABLE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds, leftmost and non-overlapping per kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Layer:
    """A decoded text; char i came from code points lo[i] to hi[i] of the document (None: i to i + 1)."""

    def __init__(self, text: str, lo: np.ndarray | None = None, hi: np.ndarray | None = None):
        self.text, self.lo, self.hi = text, lo, hi

    def span(self, start: int, end: int) -> tuple[int, int]:
        return (start, end) if self.lo is None else (int(self.lo[start:end].min()), int(self.hi[start:end].max()))

    def spread(self, text: str, start: int, end: int) -> "Layer":
        """A text of which every character came from all of start to end."""
        lo, hi = self.span(start, end)
        return Layer(text, np.broadcast_to(np.int64(lo), len(text)), np.broadcast_to(np.int64(hi), len(text)))

    def derived(self, text: str, starts: np.ndarray, ends: np.ndarray) -> "Layer":
        if self.lo is None:
            return Layer(text, starts, ends)
        return Layer(text, self.lo[starts], self.hi[ends - 1])


def _chars(raw: bytes, starts: np.ndarray, ends: np.ndarray):
    """Bytes with their places as characters with theirs, a byte that is no UTF-8 as U+FFFD; None if they can hold nothing."""
    if not SIGN.search(raw):
        return None
    try:
        text = raw.decode()
        first = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    except UnicodeDecodeError:
        text = raw.decode("utf-8", "surrogateescape")
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        lone = (code >= 0xDC80) & (code <= 0xDCFF)
        width = np.where(lone, 1, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))
        first = np.cumsum(width) - width
        text = LONE.sub("\ufffd", text)
    return text, starts[first], ends[np.r_[first[1:], len(raw)] - 1]


def _opened(layer: Layer, raw: bytes, starts: np.ndarray, ends: np.ndarray, at: int, window: int):
    """Layers of what compressed bytes hold that begin at raw[at]; all of the rest stands for each character."""
    if _begins(raw, at):
        for part in _windows(raw[at:], window):
            here = np.zeros(len(part), np.int8)
            if got := _chars(part, here, here):
                yield layer.spread(got[0], int(starts[at]), int(ends[-1]))


def _percent(layer: Layer, window: int):
    for m in PERCENT.finditer(layer.text):
        raw, starts, ends = bytearray(), [], []
        k, run = 0, m[0]
        while k < len(run):
            if run[k] == "%" and re.match(r"[0-9A-Fa-f]{2}", run[k + 1 : k + 3]):
                raw.append(int(run[k + 1 : k + 3], 16))
                starts.append(k)
                ends.append(k + 3)
                k += 3
            else:
                b = run[k].encode("utf-8", "replace")
                raw += b
                starts += [k] * len(b)
                ends += [k + 1] * len(b)
                k += 1
        raw, places = bytes(raw), (np.array(starts) + m.start(), np.array(ends) + m.start())
        if got := _chars(raw, *places):
            yield layer.derived(*got)
        if "+" in run:  # forms write blanks as +
            signs = np.array([run[k] == "+" for k in starts])
            if got := _chars(np.where(signs, 32, np.frombuffer(raw, np.uint8)).astype(np.uint8).tobytes(), *places):
                yield layer.derived(*got)
        for p in PACKED.finditer(raw):
            yield from _opened(layer, raw, *places, p.start(), window)


def _escapes(layer: Layer, window: int):
    for m in ESCAPES.finditer(layer.text):
        out, starts, ends, at = [], [], [], 0
        for e in [*ESCAPE.finditer(m[0]), None]:
            until = e.start() if e else len(m[0])
            out += m[0][at:until]
            starts += range(at, until)
            ends += range(at + 1, until + 1)
            if e:
                code = int(e[0][2:].strip("{}"), 16)
                out.append(chr(code) if code < 0x110000 else "\ufffd")
                starts.append(e.start())
                ends.append(e.end())
                at = e.end()
        text = "".join(out).encode("utf-16", "surrogatepass").decode("utf-16", "replace")
        if len(text) == len(out):
            yield layer.derived(text, np.array(starts) + m.start(), np.array(ends) + m.start())
        elif text:  # surrogate pairs joined: the whole run stands for every character
            n = len(text)
            yield layer.derived(text, np.full(n, m.start()), np.full(n, m.end()))
        raw = "".join(out).encode("latin-1", "replace")  # one byte a character
        places = np.array(starts) + m.start(), np.array(ends) + m.start()
        for p in PACKED.finditer(raw):
            yield from _opened(layer, raw, *places, p.start(), window)


def _packed(raw: bytes) -> bool:
    """Whether bytes begin as compressed ones do."""
    return raw[:2] == b"\x1f\x8b" or raw[:1] == b"\x78" and len(raw) > 6 and int.from_bytes(raw[:2], "big") % 31 == 0 or raw[:3] == b"BZh" or raw[:6] == b"\xfd7zXZ\x00" or raw[:4] == b"\x28\xb5\x2f\xfd"


def _begins(raw: bytes, at: int) -> bool:
    """Whether a decoder makes anything of the bytes from `at` on; it looks no further than their first block."""
    view = memoryview(raw)[at : at + (1 << 20)]
    try:
        if view[:3] == b"BZh":
            return bool(PACKED.match(raw, at)) and bool(bz2.BZ2Decompressor().decompress(view, 64))
        if view[:6] == b"\xfd7zXZ\x00":
            return bool(lzma.LZMADecompressor().decompress(view[: 1 << 16], 64))
        if view[:4] == b"\x28\xb5\x2f\xfd":
            return bool(next(_inflated(_Source([bytes(view[: 1 << 18])])), b""))
        for n in (1 << 10, 1 << 16):
            if zlib.decompressobj(47).decompress(view[:n], 64):
                return True
            if len(view) <= n:
                break
    except (zlib.error, OSError, lzma.LZMAError, ValueError, EOFError):
        pass
    return False


class _Source:
    """Bytes that come in pieces, to be read."""

    def __init__(self, pieces):
        self.pieces, self.rest = iter(pieces), b""

    def read(self, n: int = -1) -> bytes:
        while (n < 0 or len(self.rest) < n) and (more := next(self.pieces, None)) is not None:
            self.rest += more
        n = len(self.rest) if n < 0 else n
        out, self.rest = self.rest[:n], self.rest[n:]
        return out


def _inflated(source: _Source, piece: int = 1 << 20):
    """Pieces of what compressed bytes hold, all their parts one after the other, as far as they can be read."""
    data = source.read(8)
    while _packed(data):
        if data[:4] == b"\x28\xb5\x2f\xfd":
            import zstandard

            source.rest = data + source.rest
            reader = zstandard.ZstdDecompressor(max_window_size=1 << 31).stream_reader(source, read_across_frames=True)
            try:
                while got := reader.read(piece):
                    yield got
            except zstandard.ZstdError:
                pass
            return
        plain = data[:3] != b"BZh" and data[:1] != b"\xfd"
        d = zlib.decompressobj(47) if plain else bz2.BZ2Decompressor() if data[:3] == b"BZh" else lzma.LZMADecompressor()
        try:
            while not d.eof:
                if got := d.decompress(data, piece):
                    yield got
                data = d.unconsumed_tail if plain else b""
                if not d.eof and not data and (plain or d.needs_input):
                    data = source.read(piece)
                    if not data:
                        break
        except (zlib.error, OSError, lzma.LZMAError, ValueError, EOFError):
            return
        if not d.eof:
            if plain and (got := d.flush()):
                yield got
            return
        source.rest = d.unused_data + source.rest
        data = source.read(8)


def _windows(raw: bytes, window: int):
    """Overlapping windows on what compressed bytes hold at last, however often they were compressed."""
    met = {hashlib.blake2b(raw).digest()}
    while True:  # what fits a window is opened as often as it goes
        source = _Source(_inflated(_Source([raw])))
        held = source.read(window)
        whole = len(held) < window or not (more := source.read(1))
        if not held:
            yield raw
            return
        if not whole:
            source.rest = held + more + source.rest
            break
        raw = held
        if not _packed(raw) or (name := hashlib.blake2b(raw).digest()) in met:
            yield raw
            return
        met.add(name)
    while _packed(source.rest[:8]) and (name := hashlib.blake2b(source.rest[:window]).digest()) not in met and next(_inflated(_Source([source.rest])), b""):
        met.add(name)
        inner = _Source(_inflated(source))
        inner.rest = inner.read(window)
        source = inner
    tail = b""
    overlap = min(OVERLAP, window // 2)
    while got := source.read(window):
        yield tail + got
        tail = (tail + got)[-overlap:]


def _runs(text: str):
    """(characters, their places) of base64 runs, on one line and wrapped over several."""
    for m in BASE64.finditer(text):
        yield m[0].rstrip("="), np.arange(m.start(), m.start() + len(m[0].rstrip("=")))
    if "\n" in text:
        for m in WRAPPED.finditer(text):
            places = np.array([k for k, c in enumerate(m[0], m.start()) if c not in " \t\r\n="])
            yield "".join(m[0].split()).rstrip("="), places


def _wide(raw: bytes):
    """(text, first and last byte of each character) where bytes are UTF-16, which gives most plain characters a zero."""
    for code, zeros in (("utf-16-le", raw[1::2]), ("utf-16-be", raw[::2])):
        if len(raw) >= 16 and zeros.count(0) * 2 > len(zeros):
            text = raw[: len(raw) // 2 * 2].decode(code, "replace")
            if len(text) == len(raw) // 2:
                k = np.arange(len(text)) * 2
                yield text, k, k + 1


def _base64(layer: Layer, window: int):
    for run, places in _runs(layer.text):
        signs = run.translate({45: 43, 95: 47})
        begins: dict[int, list[int]] = {0: [0]}  # by their step
        for b in BORDER.finditer(run):
            for at in range(b.start() + 1, b.end() + 1):
                if len(run) - at >= BASE64_LEAST:
                    begins.setdefault(at % 4, []).append(at)
        for step, ats in begins.items():
            part = signs[step:]
            part = part[: len(part) - (len(part) % 4 == 1)]
            raw = base64.b64decode(part + "=" * (-len(part) % 4))
            k = np.arange(len(raw))
            first = step + 4 * (k // 3) + k % 3
            starts, ends = places[first], places[np.minimum(first + 1, len(run) - 1)] + 1
            for at in ats:
                if _packed(raw[(k0 := (at - step) // 4 * 3) : k0 + 8]):
                    yield from _opened(layer, raw, starts, ends, k0, window)
            if got := _chars(raw, starts, ends):
                yield layer.derived(*got)
            for text, a, z in _wide(raw):
                if SIGN.search(text.encode("utf-8", "replace")):
                    yield layer.derived(text, starts[a], ends[z])


def scan_text(text: str, window: int = WINDOW) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans) as sorted (start, kind number, end); the second holds the first."""

    def unwrapped(layer: Layer):
        if "%" in layer.text:
            yield from _percent(layer, window)
        if "\\" in layer.text:
            yield from _escapes(layer, window)
        yield from _base64(layer, window)

    base = base_spans(text)
    found, seen, work = set(base), set(), [unwrapped(Layer(text))]
    while work:  # depth first: only the layers around the current one are held
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        t = layer.text
        key = (hashlib.blake2b(t.encode("utf-8", "replace"), digest_size=16).digest(), layer.span(0, len(t)))
        if t == text or key in seen:
            continue
        seen.add(key)
        for s, k, e in base_spans(t):
            a, b = layer.span(s, e)
            found.add((a, k, b))
        work.append(unwrapped(layer))
    return base, sorted(found)


def _candidates(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which rows hold a sign of an assignment or escape, or a run that is long enough for a key, a hex string or base64."""
    n = len(off) - 1
    if not len(raw):
        return np.zeros(n, bool)
    flag = np.zeros(256, bool)
    flag[list(b":=%\\")] = True
    at = np.flatnonzero(flag[raw])
    inside = _TABLE[raw]
    first = inside.copy()
    first[1:] &= 1 - inside[:-1]
    borders = off[:-1][off[:-1] < len(raw)]  # a run ends with its row
    first[borders] = inside[borders]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= 1 - inside[1:]
    borders = off[1:][off[1:] > 0] - 1
    last[borders] = inside[borders]
    at = np.concatenate([at, starts[np.flatnonzero(last) + 1 - starts >= 16]])
    out = np.zeros(n, bool)
    out[np.searchsorted(off, at, "right") - 1] = True
    return out


def _line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans): arrays of (kind, start, end), one row per document, unfindable documents included."""

    def run(batches):
        own_cache("secrets")  # lets go of what other operators kept
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in doc_batches(batches):
            maybe = _candidates(*utf8(b.column("text")))
            texts = b.column("text")
            base, spans = [[]] * b.num_rows, [[]] * b.num_rows
            for i in np.flatnonzero(maybe).tolist():
                got = scan_text(texts[i].as_py() or "")
                base[i], spans[i] = ([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x] for x in got)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(base, kind), pa.array(spans, kind)], ["doc_id", "base", "spans"])

    kind = "array<struct<kind string, start long, end long>>"
    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id long, base {kind}, spans {kind}")


def redacted(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The documents with every span of a secret replaced by `mask`; texts without one, and null texts, stay as they are."""
    schema = docs.schema

    def run(batches):
        own_cache("secrets")
        for b in doc_batches(batches):
            maybe = _candidates(*utf8(b.column("text")))
            texts = b.column("text").to_pylist()
            for i in np.flatnonzero(maybe).tolist():
                spans = scan_text(texts[i] or "")[1]
                if spans:
                    out, at = [], 0
                    for s, _, e in spans:
                        if e > at:
                            if s >= at:
                                out += [texts[i][at:s], mask]
                            at = e
                    texts[i] = "".join(out) + texts[i][at:]
            k = b.schema.get_field_index("text")
            yield b.set_column(k, b.schema.field(k).name, pa.array(texts, b.schema.field(k).type))

    out = docs.mapInArrow(lean(run), schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    return found.select("doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"), F.sha2(line("base"), 256).alias("base_sha256"), line("spans").alias("spans"))
