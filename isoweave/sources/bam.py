"""Spark data sources for binary alignments (`bam`, read and written) and PacBio indexes (`pbi`), in pure Python.

Reading.  A file is cut into byte ranges; nobody walks it.  A range's task looks for the
first BGZF block in it and, unless the file starts there, for the first place where a
chain of records begins; the records that begin in its blocks are its own.  With loci and
an index (`.bai`) only the chunks over the loci are read, cut where the index knows that
records begin.  Rows come as Arrow batches, and only what the schema asks for is decoded.

    spark.read.format("bam").option("loci", "chr1:1000-2000;chr2").load(path)

Loci are zero-based and half-open; a record comes once if it overlaps any of them.
Without an index all is read and filtered.  A path is a file, or a folder of .bam files.

Writing.  Every task packs the rows of its partition into a file of its own with header,
end block and index, so that rows that are range-partitioned in the header's order make a
folder of sorted files.  `single` joins them on commit into one file and one index.

A place is 32 bits in a BAM.  A contig that is longer is written in stretches, contigs of
the header that say (`of`, `at`) which contig they are part of and where they begin in it;
records are in the stretch that they begin in, and come back with their contig and place.
"""

from __future__ import annotations

import functools
import gzip
import json
import re
import struct
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from . import bai, bgzf, remote

BAM_SCHEMA = "name string, flag int, chrom string, pos bigint, mapq int, cigar string, seq string, qual string, tags map<string,string>"
#: All that a record holds besides, by name; a reader's schema may ask for any of these and leave out any.
WHOLE_SCHEMA = BAM_SCHEMA + ", `end` bigint, mate_chrom string, mate_pos bigint, tlen int"
WHOLE_COLUMNS = ("name", "flag", "chrom", "pos", "mapq", "cigar", "seq", "qual", "tags", "mate_chrom", "mate_pos", "tlen")
_BASES, _OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
_SIZES = {"c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_CODES = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
#: Two bases are a byte, so a base is a hexadecimal digit; N stands for any other letter.
_DIGITS = bytes(b"0123456789abcdef"[max(_BASES.find(chr(c).upper()), -1)] for c in range(256))
_LETTERS = bytes(ord(_BASES[int(chr(c), 16)]) if chr(c) in "0123456789abcdef" else c for c in range(256))
_QUAL_UP, _QUAL_DOWN = bytes((x + 33) % 256 for x in range(256)), bytes((x - 33) % 256 for x in range(256))
_TYPES = {
    "name": pa.string(), "flag": pa.int32(), "chrom": pa.string(), "pos": pa.int64(), "mapq": pa.int32(), "cigar": pa.string(), "seq": pa.string(), "qual": pa.string(),
    "tags": pa.map_(pa.string(), pa.string()), "end": pa.int64(), "mate_chrom": pa.string(), "mate_pos": pa.int64(), "tlen": pa.int32(),
}
#: The longest contig that a header can name; bases in a stretch of a longer one.
LONGEST, STRETCH = (1 << 31) - 1, 1 << 30
#: Records in a batch; records that must follow each other before a place counts as the start of one.
BATCH, CHAIN = 4096, 12


class _Stream:
    """Unpacked bytes from a virtual place on."""

    def __init__(self, f, place: int):
        self.blocks, self.data, self.k, self.block = bgzf.Blocks(f, place >> 16), b"", 0, place >> 16
        self._next()
        self.k = place & 0xFFFF

    def _next(self) -> bool:
        while (got := self.blocks.next()) is not None:
            self.block, self.data = got
            self.k = 0
            if self.data:
                return True
        self.block, self.data, self.k = self.blocks.at, b"", 0
        return False

    def place(self) -> int:
        if self.k >= len(self.data):
            self._next()
        return self.block << 16 | self.k

    def read(self, n: int) -> bytes:
        if self.k + n <= len(self.data):
            self.k += n
            return self.data[self.k - n : self.k]
        out = bytearray()
        while len(out) < n:
            if self.k >= len(self.data) and not self._next():
                break
            part = self.data[self.k : self.k + n - len(out)]
            out += part
            self.k += len(part)
        return bytes(out)


@dataclass
class Header:
    text: str
    contigs: list[tuple[str, int]]
    place: int = 0  # virtual place of the first record

    @functools.cached_property
    def origins(self) -> list[tuple[str, int]]:
        """Of every contig of the file its name and first base; of a stretch those in the contig that it is part of."""
        told = {}
        for line in self.text.split("\n") if "\tat:" in self.text else ():
            tags = dict(x.split(":", 1) for x in line.split("\t")[1:] if ":" in x)
            if line.startswith("@SQ\t") and "of" in tags and tags.get("at", "").isdigit():
                told[tags.get("SN")] = (tags["of"], int(tags["at"]))
        return [told.get(n, (n, 0)) for n, _ in self.contigs]

    def spans(self, loci: list[Locus]) -> dict[int, list[tuple[int, int]]]:
        """Loci by the numbers of the file's contigs, in their places; a record of one stretch may reach into the next."""
        out: dict[int, list[tuple[int, int]]] = {}
        for ref, (name, at) in enumerate(self.origins):
            if mine := [(a - at, b - at) for chrom, a, b in loci if chrom == name and b > at]:
                out[ref] = mine
        return out

    def packed(self) -> bytes:
        text = self.text.encode()
        names = b"".join(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in self.contigs)
        return b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(self.contigs)) + names


def stretched(text: str, contigs: list[tuple[str, int]]) -> tuple[Header, dict[str, tuple[int, int]]]:
    """A header in which contigs too long for one are stretches, and of every contig the number of its first one and how many there are."""
    lines, out, refs, taken = text.split("\n"), [], {}, {n for n, _ in contigs}
    for name, size in contigs:
        refs[name] = (len(out), 1)
        if size <= LONGEST:
            out.append((name, size))
            continue
        said = next((k for k, x in enumerate(lines) if x.startswith("@SQ\t") and f"SN:{name}" in x.split("\t")), None)
        new = []
        for at in range(0, size, STRETCH):
            own = name if not at else f"{name}_at_{at}"
            while at and own in taken:
                own += "_"
            taken.add(own)
            out.append((own, min(STRETCH, size - at)))
            new.append(f"@SQ\tSN:{own}\tLN:{out[-1][1]}\tof:{name}\tat:{at}")
        refs[name] = (refs[name][0], len(new))
        if said is None:
            lines[-1:-1] = new  # the text ends its last line
        else:
            lines[said : said + 1] = new
    return Header("\n".join(lines), out), refs


def header(f) -> Header:
    s = _Stream(f, 0)
    if s.read(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    text = s.read(struct.unpack("<i", s.read(4))[0]).rstrip(b"\0").decode()
    contigs = []
    for _ in range(struct.unpack("<i", s.read(4))[0]):
        n = struct.unpack("<i", s.read(4))[0]
        contigs.append((s.read(n)[:-1].decode(), struct.unpack("<i", s.read(4))[0]))
    return Header(text, contigs, s.place())


def _plausible(data: bytes, k: int, contigs: list[tuple[str, int]]) -> int | None:
    """Where the next record begins if one may begin at k; None if not, or if the fixed part and the name are cut off."""
    if len(data) - k < 36:
        return None
    size, ref, pos, n_name, _, _, n_cigar, _, n_seq, mate, mate_pos = struct.unpack_from("<iiiBBHHHiii", data, k)
    if n_name < 1 or n_seq < 0 or size < 32 + n_name + 4 * n_cigar + (n_seq + 1) // 2 + n_seq:
        return None
    for r, p in ((ref, pos), (mate, mate_pos)):
        if not (-1 <= r < len(contigs)) or p < -1:  # a place beyond the header's length is read all the same
            return None
    name = data[k + 36 : k + 36 + n_name]
    if len(name) < n_name or name[-1] or any(c < 33 or c > 126 for c in name[:-1]):
        return None
    ops = data[k + 36 + n_name : k + 36 + n_name + 4 * n_cigar : 4]
    return None if any(c & 15 > 8 for c in ops) else k + 4 + size


def record_start(s: _Stream, contigs: list[tuple[str, int]], stop: int) -> int | None:
    """Virtual place of the first record that begins in s's block or a later one before the file place `stop`.

    A place counts if CHAIN records, or as many as there are before the file ends, follow each other from it on.
    """
    held, marks, done = b"", [], False  # blocks from s's on; (first byte in held, file place) of each

    def more() -> bool:
        nonlocal held, done
        if s.data:
            marks.append((len(held), s.block))
            held += s.data
        done = not s.data or not s._next()
        return not done

    def chained(k: int) -> bool:
        for _ in range(CHAIN):
            while len(held) - k < 36 + 256 and not done:
                more()
            if k == len(held) and done:
                return True
            after = _plausible(held, k, contigs)
            if after is None:
                return False
            while len(held) < after and not done:
                more()
            if len(held) < after:
                return False
            k = after
        return True

    more()
    k = 0
    while True:
        while k >= len(held):
            if done or s.block >= stop:
                return None
            more()
        at = next(m for m in reversed(marks) if m[0] <= k)
        if at[1] >= stop:
            return None
        if _plausible(held, k, contigs) is not None or len(held) - k < 300 and not done:
            if chained(k):
                return at[1] << 16 | k - at[0]
        k += 1


def _tags(raw: bytes, typed: bool) -> list[tuple[str, str]]:
    out, k = [], 0
    while k < len(raw):
        key, kind = raw[k : k + 2].decode(), chr(raw[k + 2])
        k += 3
        if kind == "A":
            value, k = chr(raw[k]), k + 1
        elif kind in _SIZES:
            value, k = str(struct.unpack_from("<" + _CODES[kind], raw, k)[0]), k + _SIZES[kind]
            kind = "f" if kind == "f" else "i"
        elif kind in "ZH":
            end = raw.index(0, k)
            value, k = raw[k:end].decode(), end + 1
        elif kind == "B":
            sub, n = chr(raw[k]), struct.unpack_from("<i", raw, k + 1)[0]
            value = ",".join(str(x) for x in struct.unpack_from(f"<{n}{_CODES[sub]}", raw, k + 5))
            k += 5 + n * _SIZES[sub]
            kind = f"B{sub}"
        else:
            raise ValueError(f"unknown tag type {kind}")
        out.append((key, f"{kind}:{value}" if typed else value))
    return out


def _span(ops) -> int:
    return sum(x >> 4 for x in ops if x & 15 in (0, 2, 3, 7, 8))


def _decoded(raw: bytes, origins: list[tuple[str, int]], columns: list[str], typed: bool) -> list:
    ref, pos, n_name, mapq, _, n_cigar, flag, n_seq, mate, mate_pos, tlen = struct.unpack_from("<iiBBHHHiiii", raw)
    at = 32 + n_name
    ops = struct.unpack_from(f"<{n_cigar}I", raw, at)
    bases = at + 4 * n_cigar
    quals = bases + (n_seq + 1) // 2
    out = []
    for c in columns:
        match c:
            case "name":
                v = raw[32 : at - 1].decode()
            case "flag":
                v = flag
            case "chrom":
                v = origins[ref][0] if ref >= 0 else None
            case "pos":
                v = pos + (origins[ref][1] if ref >= 0 else 0)
            case "mapq":
                v = mapq
            case "cigar":
                v = "".join(f"{x >> 4}{_OPS[x & 15]}" for x in ops) or None
            case "seq":
                v = raw[bases:quals].hex().encode().translate(_LETTERS)[:n_seq].decode() or None
            case "qual":
                q = raw[quals : quals + n_seq]
                v = None if not n_seq or q[:1] == b"\xff" else q.translate(_QUAL_UP).decode("latin-1")
            case "tags":
                v = _tags(raw[quals + n_seq :], typed)
            case "end":
                v = pos + _span(ops) + (origins[ref][1] if ref >= 0 else 0)
            case "mate_chrom":
                v = origins[mate][0] if mate >= 0 else None
            case "mate_pos":
                v = mate_pos + (origins[mate][1] if mate >= 0 else 0)
            case "tlen":
                v = tlen
        out.append(v)
    return out


#: A stretch of a contig: name, first base, base behind the last one.
Locus = tuple[str, int, int]
_FAR = 1 << 29
#: Behind the last place that a record can have.
_END = 1 << 62


def parsed_loci(text: str, far: int = _FAR) -> list[Locus]:
    """`chrom` (up to `far`) or `chrom:start-end`, by semicolons; zero-based, half-open."""
    out = []
    for part in filter(None, (p.strip() for p in text.split(";"))):
        m = re.fullmatch(r"(.+):([0-9]+)-([0-9]+)", part)
        chrom, a, b = (m[1], int(m[2]), int(m[3])) if m else (part, 0, far)
        if a >= b:
            raise ValueError(f"empty locus {part}")
        out.append((chrom, a, b))
    return out


@dataclass
class Range(InputPartition):
    """File places [start, stop): its records are those that begin in its blocks."""

    path: str
    start: int
    stop: int


@dataclass
class Chunk(InputPartition):
    """Virtual places [begin, stop), both where records begin."""

    path: str
    begin: int
    stop: int


class BamReader(DataSourceReader):
    def __init__(self, options, columns):
        self.path, self.columns = options["path"], columns
        self.size, self.typed = int(options.get("splitBytes", 64 << 20)), options.get("typedTags", "false").lower() == "true"
        self.loci = parsed_loci(options["loci"], _END) if options.get("loci") else None
        if unknown := set(columns) - _TYPES.keys():
            raise ValueError(f"no such columns of a BAM: {', '.join(sorted(unknown))}")
        if self.size < 1:
            raise ValueError("splitBytes must be at least 1")

    def partitions(self):
        out = []
        for path in remote.parts(self.path, ".bam"):
            index = next((p for p in (f"{path}.bai", f"{path.removesuffix('.bam')}.bai") if remote.size(p)), None) if self.loci is not None else None
            out += self._indexed(path, index) if index else self._ranges(path)
        return out or [Range("", 0, 0)]

    def _ranges(self, path):
        end = remote.size(path)
        return [Range(path, k, min(k + self.size, end)) for k in range(0, end, self.size)]

    def _indexed(self, path, index):
        with remote.opened(path) as f:
            spans = header(f).spans(self.loci)
        with remote.opened(index) as f:
            contigs = bai.unpacked(f.read(), set(spans))
        out = []
        for ref, wanted in sorted(spans.items()):
            c, reach = contigs[ref], 0
            for begin, stop in sorted(x for a, b in wanted for x in c.chunks(max(a, 0), b) if b > 0):
                begin = max(begin, reach)  # loci may share chunks
                if begin < stop:
                    out += [Chunk(path, *x) for x in c.cuts(begin, stop, self.size)]
                    reach = stop
        return out

    def _raw(self, split):
        """(record, header) of a split."""
        with remote.opened(split.path) as f:
            head = header(f)
            if isinstance(split, Chunk):
                s, stop = _Stream(f, split.begin), split.stop
            else:
                block = bgzf.first_block(f, split.start, split.stop, remote.size(split.path)) if split.start else 0
                if block is None:
                    return
                first = head.place
                if block > head.place >> 16:
                    first = record_start(_Stream(f, block << 16), head.contigs, split.stop)
                if first is None:
                    return
                s, stop = _Stream(f, first), split.stop << 16
            while s.place() < stop:
                size = s.read(4)
                if not size:
                    break
                n = struct.unpack("<i", size)[0]
                raw = s.read(n)
                if len(raw) < n:
                    raise ValueError(f"{split.path} ends within a record")
                yield raw, head
            self.inflated = getattr(self, "inflated", 0) + s.blocks.count

    def read(self, split):
        if not split.path:
            return
        rows, spans = [], None
        for raw, head in self._raw(split):
            if self.loci is not None:
                spans = head.spans(self.loci) if spans is None else spans
                ref, pos = struct.unpack_from("<ii", raw)
                if ref not in spans:
                    continue
                if isinstance(split, Chunk) and pos >= max(b for _, b in spans[ref]):
                    break  # an indexed file is in order
                n_name, n_cigar = raw[8], struct.unpack_from("<H", raw, 12)[0]
                end = max(pos + _span(struct.unpack_from(f"<{n_cigar}I", raw, 32 + n_name)), pos + 1)
                if not any(pos < b and end > a for a, b in spans[ref]):
                    continue
            rows.append(_decoded(raw, head.origins, self.columns, self.typed))
            if len(rows) == BATCH:
                yield self._batch(rows)
                rows = []
        if rows:
            yield self._batch(rows)

    def _batch(self, rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], _TYPES[c]) for k, c in enumerate(self.columns)], names=self.columns)


class PushedBamReader(BamReader):
    """Takes loci from filters on chrom and pos; Spark applies all filters once more."""

    def pushFilters(self, filters):
        chroms, low, high = None, -1, _END
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("chrom",) and isinstance(f, (EqualTo, EqualNullSafe, In)):
                asked = set(f.value) if isinstance(f, In) else {f.value}
                if isinstance(f, EqualNullSafe) and None in asked:
                    continue
                chroms = asked - {None} if chroms is None else chroms & asked
            elif column == ("pos",) and getattr(f, "value", None) is not None:
                if isinstance(f, (EqualTo, EqualNullSafe, GreaterThan, GreaterThanOrEqual)):
                    low = max(low, f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, EqualNullSafe, LessThan, LessThanOrEqual)):
                    high = min(high, f.value + (not isinstance(f, LessThan)))
        if chroms is not None and self.loci is None:
            self.loci = [(c, low, high) for c in sorted(chroms)] if low < high else []
        return filters


_CIGAR = re.compile(rf"([0-9]+)([{_OPS}])")
_TYPED = re.compile(r"([AifZH]|B[cCsSiIf]):(.*)", re.S)


def _int_tag(value: int) -> bytes:
    for kind, low, high in (("C", 0, 255), ("c", -128, -1), ("S", 0, 65535), ("s", -32768, -1), ("i", -(1 << 31), (1 << 31) - 1), ("I", 0, (1 << 32) - 1)):
        if low <= value <= high:
            return kind.encode() + struct.pack("<" + _CODES[kind], value)
    raise ValueError(f"{value} is too large for a tag")


def _packed_tag(key: str, value: str, typed: bool) -> bytes:
    m = _TYPED.fullmatch(value) if typed else None
    if typed and not m:
        raise ValueError(f"tag {key} has no type: {value}")
    kind, text = (m[1], m[2]) if m else ("Z", value)
    if kind == "i":
        body = _int_tag(int(text))
    elif kind == "f":
        body = b"f" + struct.pack("<f", float(text))
    elif kind == "A":
        body = b"A" + text.encode("ascii")
    elif kind in "ZH":
        body = kind.encode() + text.encode() + b"\0"
    else:
        sub, items = kind[1], [x for x in text.split(",") if x]
        body = b"B" + sub.encode() + struct.pack(f"<i{len(items)}{_CODES[sub]}", len(items), *[float(x) if sub == "f" else int(x) for x in items])
    return key.encode("ascii") + body


@functools.lru_cache(1 << 14)
def _operations(cigar: str) -> tuple[int, bytes, int] | None:
    """How many operations a CIGAR has, these packed, and the bases that it spans; None if it is none."""
    ops = tuple(int(n) << 4 | _OPS.index(o) for n, o in _CIGAR.findall(cigar))
    return (len(ops), struct.pack(f"<{len(ops)}I", *ops), _span(ops)) if "".join(f"{x >> 4}{_OPS[x & 15]}" for x in ops) == cigar else None


def _phred(name: str, qual: str) -> bytes:
    raw = qual.encode("latin-1")
    if raw and min(raw) < 33:
        raise ValueError(f"{name}: no qualities: {qual!r}")
    return raw.translate(_QUAL_DOWN)


def _placed(name: str, chrom: str | None, pos: int | None, refs: dict[str, tuple[int, int]]) -> tuple[int, int]:
    """A contig's number in the file (-1: none) and the place in it."""
    pos = -1 if pos is None else pos
    first, n = (-1, 1) if chrom is None else refs.get(chrom, (-2, 1))
    if first == -2:
        raise ValueError(f"{name}: contig is not in the header")
    k = min(max(pos, 0) // STRETCH, n - 1)
    if not -1 <= pos - k * STRETCH <= LONGEST:
        raise ValueError(f"{name}: {pos} is no place of a contig as long as the header says")
    return first + k, pos - k * STRETCH


_FIXED = struct.Struct("<iiiBBHHHiiii")


def packed(name: str, flag: int, chrom: str | None, pos: int, mapq: int, cigar: str | None, seq: str | None, qual: str | None, tags, mate_chrom: str | None, mate_pos: int, tlen: int, refs: dict[str, tuple[int, int]], typed: bool) -> tuple[bytes, int, int, int]:
    """A record's bytes with its contig's number (-1: none), first place and the place behind the last, as they are in the file."""
    ref, pos = _placed(name, chrom, pos, refs)
    mate, mate_pos = (-1, mate_pos) if mate_chrom is None and mate_pos == -1 else _placed(name, mate_chrom, mate_pos, refs)
    ops = _operations(cigar or "")
    if ops is None:
        raise ValueError(f"{name}: no CIGAR: {cigar}")
    seq = seq or ""
    n = len(seq)
    if qual is not None and len(qual) != n:
        raise ValueError(f"{name}: {n} bases, {len(qual)} qualities")
    codes = seq.encode("ascii", "replace").translate(_DIGITS) + b"0" * (n % 2)
    text = name.encode()
    if not 0 < len(text) < 255:
        raise ValueError(f"a name has 1 to 254 bytes: {name}")
    end = max(pos + ops[2], pos + 1)
    rest = b"".join((
        text, b"\0", ops[1], bytes.fromhex(codes.decode()), b"\xff" * n if qual is None else _phred(name, qual),
        *(_packed_tag(k, v, True) if typed else b"%bZ%b\0" % (k.encode("ascii"), v.encode()) for k, v in sorted(tags or ())),
    ))
    head = _FIXED.pack(32 + len(rest), ref, pos, len(text) + 1, mapq, bai.bin_of(max(pos, 0), max(end, 1)), ops[0], flag, n, mate, mate_pos, tlen)
    return head + rest, ref, pos, end


#: What stands for numbers that are missing.
_MISSING = {"flag": 0, "pos": -1, "mapq": 0, "mate_pos": -1, "tlen": 0}


def packed_record(row: dict, refs: dict[str, tuple[int, int]], typed: bool) -> tuple[bytes, int, int, int]:
    """packed of a row by the names of its columns, of which it may lack any but the name."""
    whole = {c: row.get(c) for c in WHOLE_COLUMNS} | {"tags": (row.get("tags") or {}).items()}
    return packed(*(_MISSING[c] if c in _MISSING and v is None else v for c, v in whole.items()), refs, typed)


def _values(column: pa.Array | None, name: str, n: int) -> list:
    """A batch's column for packed: numbers without gaps, texts or None, tags as pairs."""
    if column is None:
        return [_MISSING.get(name)] * n
    if name == "tags":
        keys, items = (x.to_numpy(zero_copy_only=False).tolist() for x in (column.keys, column.items))
        at = column.offsets.to_numpy().tolist()
        return [list(zip(keys[a:b], items[a:b], strict=True)) for a, b in zip(at, at[1:])]
    return (column.fill_null(_MISSING[name]) if name in _MISSING else column).to_numpy(zero_copy_only=False).tolist()


@dataclass
class Written(WriterCommitMessage):
    name: str  # of the part below the attempt's folder
    rows: int
    first: tuple | None  # keys of the first and last record
    last: tuple | None


class BamWriter(DataSourceArrowWriter):
    """Files in an attempt's folder; on commit they move into place, joined or not.  Rows come in Arrow batches, or one by one."""

    def __init__(self, options, columns, overwrite):
        self.path, self.columns, self.overwrite = options["path"].rstrip("/"), columns, overwrite
        contigs = [(str(n), int(size)) for n, size in json.loads(options["contigs"])]
        self.single, self.typed = (options.get(k, "false").lower() == "true" for k in ("single", "typedTags"))
        text = options.get("header") or "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{size}\n" for n, size in contigs)
        self.head, self.refs = stretched(text, contigs)
        self.contigs, self.attempt = self.head.contigs, f"{self.path}.{uuid.uuid4().hex}"
        if unknown := set(columns) - _TYPES.keys():
            raise ValueError(f"no such columns of a BAM: {', '.join(sorted(unknown))}")
        if not overwrite and remote.taken(self.path):
            raise ValueError(f"{self.path} is there already")

    def write(self, rows):
        from pyspark import TaskContext

        t = TaskContext.get()
        name = f"part-{t.partitionId():05d}-{t.taskAttemptId()}.bam"
        index, unplaced, n, first, last = [bai.Contig() for _ in self.contigs], 0, 0, None, None
        with remote.created(f"{self.attempt}/{name}") as f:
            w = bgzf.Writer(f)
            w.write(self.head.packed())
            w.flush()
            for raw, ref, pos, end in self._packed(rows):
                key = (ref if ref >= 0 else len(index), pos)
                if last is not None and key < last:
                    raise ValueError(f"rows are not in the order of the header's contigs: {raw[36 : raw.index(0, 36)].decode()}")
                first, last, n = first or key, key, n + 1
                begin = w.place()
                w.write(raw)
                if ref < 0:
                    unplaced += 1
                else:
                    index[ref].add(max(pos, 0), max(end, 1), begin, w.place())
            w.flush()
            f.write(bgzf.END)
        with remote.created(f"{self.attempt}/{name}.bai") as f:
            f.write(bai.packed(index, unplaced))
        return Written(name, n, first, last)

    def _packed(self, rows):
        """Records of rows or of batches of them, as packed gives them."""
        for item in rows:
            if not isinstance(item, pa.RecordBatch):
                yield packed_record(item.asDict(), self.refs, self.typed)
                continue
            columns = dict(zip(item.schema.names, item.columns, strict=True))
            found = [_values(columns.get(c), c, item.num_rows) for c in WHOLE_COLUMNS]
            for values in zip(*found, strict=True):
                yield packed(*values, self.refs, self.typed)

    def commit(self, messages):
        parts = [m for m in messages if m is not None]
        full = [m for m in parts if m.rows]
        for a, b in zip(full, full[1:], strict=False):
            if b.first < a.last:
                self.abort(messages)
                raise ValueError("partitions are not in the order of the header's contigs: sort by range first")
        parts = full or parts[:1]
        if self.overwrite:
            for p in (self.path, f"{self.path}.bai"):
                remote.removed(p)
        if self.single:
            self._join(parts)
            remote.removed(self.attempt)
            return
        wanted = {m.name for m in parts}
        for p in remote.parts(self.attempt, ""):
            name = p.rsplit("/", 1)[-1]
            if name.removesuffix(".bai") not in wanted:
                remote.removed(p)  # of attempts that lost, and of empty partitions
        if not parts:
            remote.removed(self.attempt)
        else:
            remote.moved(self.attempt, self.path)

    def _join(self, parts):
        """One file: the first part's header, all parts' blocks, one end; copied as they are, some megabytes at a time."""
        index, unplaced = [bai.Contig() for _ in self.contigs], 0
        with remote.created(f"{self.attempt}/joined") as out:
            at = 0
            for k, m in enumerate(parts):
                path = f"{self.attempt}/{m.name}"
                with remote.opened(path) as f:
                    skip = 0 if k == 0 else header(f).place >> 16
                    f.seek(skip)
                    left = remote.size(path) - skip - len(bgzf.END)
                    by, at = at - skip, at + left
                    while left:
                        piece = f.read(min(left, 8 << 20))
                        out.write(piece)
                        left -= len(piece)
                with remote.opened(f"{path}.bai") as f:
                    raw = f.read()
                index = [a.joined(b.moved(by)) for a, b in zip(index, bai.unpacked(raw), strict=True)]
                unplaced += struct.unpack("<Q", raw[-8:])[0]
            if not parts:
                w = bgzf.Writer(out)
                w.write(self.head.packed())
                w.flush()
            out.write(bgzf.END)
        with remote.created(f"{self.attempt}/joined.bai") as out:
            out.write(bai.packed(index, unplaced))
        remote.moved(f"{self.attempt}/joined", self.path)
        remote.moved(f"{self.attempt}/joined.bai", f"{self.path}.bai")

    def abort(self, _):
        remote.removed(self.attempt)


class BamDataSource(DataSource):
    """Options for reading: loci, splitBytes, typedTags, pushdown; for writing: contigs (JSON of [name, length]), header, single, typedTags.

    pushdown needs spark.sql.python.filterPushdown.enabled.  typedTags keeps the types of tags ("i:7", "Bc:1,2"), so that they can be written again.
    """

    @classmethod
    def name(cls):
        return "bam"

    def schema(self):
        return BAM_SCHEMA

    def reader(self, schema):
        kind = PushedBamReader if self.options.get("pushdown", "false").lower() == "true" else BamReader
        return kind(self.options, schema.names)

    def writer(self, schema, overwrite):
        return BamWriter(self.options, schema.names, overwrite)


@dataclass
class Records(InputPartition):
    start: int
    stop: int


class PbiReader(DataSourceReader):
    """Hole and offset of every record; the sections before, between and after them are not unpacked."""

    def __init__(self, options, columns):
        self.path, self.columns, self.per = options["path"], columns, int(options.get("splitRecords", 1 << 22))
        self.holes = {int(h) for h in options["holes"].split(",")} if options.get("holes") else None
        if set(columns) - {"hole", "offset"} or self.per < 1:
            raise ValueError("a PacBio index has the columns hole and offset; splitRecords is at least 1")

    def _blocks(self, f):
        """The file's blocks; None if it is one gzip member, which can only be read from its start."""
        f.seek(0)
        return bgzf.directory(f, remote.size(self.path)) if bgzf.block_size(f.read(512)) else None

    def _count(self, head: bytes) -> int:
        magic, version, _, n, _ = struct.unpack("<4sIHI18s", head)
        if magic != b"PBI\1" or version >> 16 not in (3, 4):
            raise ValueError("not a PacBio index of version 3 or 4")
        return n

    def partitions(self):
        with remote.opened(self.path) as f:
            blocks = self._blocks(f)
            n = self._count(_slice(f, blocks, 0, 32))
        if blocks is None:
            return [Records(0, n)]
        return [Records(k, min(k + self.per, n)) for k in range(0, n, self.per)] or [Records(0, 0)]

    def read(self, part):
        with remote.opened(self.path) as f:
            blocks = self._blocks(f)
            n = self._count(_slice(f, blocks, 0, 32))
            m = part.stop - part.start
            # int32 read group, start, end; int32 hole; float32 quality, uint8 context; int64 offset
            holes = pa.Array.from_buffers(pa.int32(), m, [None, pa.py_buffer(_slice(f, blocks, 32 + 12 * n + 4 * part.start, 4 * m))])
            offsets = pa.Array.from_buffers(pa.int64(), m, [None, pa.py_buffer(_slice(f, blocks, 32 + 21 * n + 8 * part.start, 8 * m))])
        batch = pa.RecordBatch.from_arrays([{"hole": holes, "offset": offsets}[c] for c in self.columns], names=self.columns)
        if self.holes is not None:
            import pyarrow.compute as pc

            batch = batch.filter(pc.is_in(holes, pa.array(sorted(self.holes), pa.int32())))
        yield batch


def _slice(f, blocks, start: int, n: int) -> bytes:
    """Bytes [start, start + n) of the unpacked data."""
    if blocks is None:
        f.seek(0)
        with gzip.GzipFile(fileobj=f) as g:
            g.seek(start)
            out = g.read(n)
    else:
        from bisect import bisect_right

        k = max(bisect_right(blocks, start, key=lambda b: b[1]) - 1, 0)
        s = bgzf.Blocks(f, blocks[k][0])
        out = bytearray()
        while len(out) < start - blocks[k][1] + n and (got := s.next()) is not None:
            out += got[1]
        out = bytes(out[start - blocks[k][1] :][:n])
    if len(out) < n:
        raise ValueError("the PacBio index is cut off")
    return out


class PbiDataSource(DataSource):
    """spark.read.format("pbi").load(path): (hole, offset).  Options: holes (by commas), splitRecords."""

    @classmethod
    def name(cls):
        return "pbi"

    def schema(self):
        return "hole int, offset bigint"

    def reader(self, schema):
        return PbiReader(self.options, schema.names)


def register(spark) -> None:
    spark.dataSource.register(BamDataSource)
    spark.dataSource.register(PbiDataSource)
