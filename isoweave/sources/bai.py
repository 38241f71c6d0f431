"""The index of a BAM in order of coordinates: bins with chunks of virtual places, and the first place of every 16 kb window."""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

#: Fixed by the format: windows of 2 ** 14 bases, six levels of bins, and a bin with counts in place of chunks.
WINDOW, LEVELS, COUNTS = 14, ((29, 0), (26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)), 37450


#: Bases that the bins reach; windows go on behind them.
TOP = 1 << 29


def bin_of(start: int, end: int) -> int:
    """The smallest bin that holds [start, end); what reaches beyond the bins is in the first one, which every query looks at."""
    if end > TOP:
        return 0
    for shift, first in reversed(LEVELS):
        if start >> shift == (end - 1) >> shift:
            return first + (start >> shift)
    return 0


def bins_over(start: int, end: int) -> list[int]:
    return [b for shift, first in LEVELS for b in range(first + (start >> shift), first + ((end - 1) >> shift) + 1)]


@dataclass
class Contig:
    bins: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    windows: list[int] = field(default_factory=list)

    def add(self, start: int, end: int, begin: int, stop: int) -> None:
        """A record over [start, end) at the virtual places [begin, stop); records come in order."""
        chunks = self.bins.setdefault(bin_of(start, end), [])
        if chunks and chunks[-1][1] >> 16 == begin >> 16:
            chunks[-1] = (chunks[-1][0], stop)
        else:
            chunks.append((begin, stop))
        last = (end - 1) >> WINDOW
        self.windows += [0] * (last + 1 - len(self.windows))
        for w in range(start >> WINDOW, last + 1):
            self.windows[w] = self.windows[w] or begin

    def chunks(self, start: int, end: int) -> list[tuple[int, int]]:
        """Virtual places that hold all records over [start, end), in order, parted; none lies before the window's first."""
        w = start >> WINDOW
        least = next((x for x in self.windows[w:] if x), None) if w < len(self.windows) else None
        if least is None:
            return []
        over = bins_over(min(start, TOP - 1), min(end, TOP))
        found = sorted(c for b in (over if len(over) < len(self.bins) else self.bins.keys() & set(over)) for c in self.bins.get(b, ()) if c[1] > least)
        out: list[tuple[int, int]] = []
        for a, b in found:
            a = max(a, least)
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    def cuts(self, begin: int, stop: int, size: int) -> list[tuple[int, int]]:
        """A chunk in parts of about `size` file bytes, cut where windows begin: records begin there."""
        out = []
        for w in sorted({x for x in self.windows if begin < x < stop}):
            if (w >> 16) - (begin >> 16) >= size:
                out.append((begin, w))
                begin = w
        return [*out, (begin, stop)]

    def moved(self, by: int) -> Contig:
        """The same for records that stand `by` file bytes further on."""
        shift = by << 16
        return Contig({b: [(x + shift, y + shift) for x, y in c] for b, c in self.bins.items()}, [x and x + shift for x in self.windows])

    def joined(self, later: Contig) -> Contig:
        """With the records of a later part."""
        bins = {b: [*self.bins.get(b, ()), *later.bins.get(b, ())] for b in self.bins.keys() | later.bins.keys()}
        n = max(len(self.windows), len(later.windows))
        a, b = (x + [0] * (n - len(x)) for x in (self.windows, later.windows))
        return Contig(bins, [x or y for x, y in zip(a, b, strict=True)])


def packed(contigs: list[Contig], unplaced: int) -> bytes:
    out = [b"BAI\1", struct.pack("<i", len(contigs))]
    for c in contigs:
        out.append(struct.pack("<i", len(c.bins)))
        for b in sorted(c.bins):
            out.append(struct.pack("<Ii", b, len(c.bins[b])))
            out += [struct.pack("<QQ", *x) for x in c.bins[b]]
        out.append(struct.pack(f"<i{len(c.windows)}Q", len(c.windows), *c.windows))
    return b"".join([*out, struct.pack("<Q", unplaced)])


def unpacked(raw: bytes, wanted: set[int] | None = None) -> list[Contig]:
    """The contigs of an index; those that are not wanted stay empty."""
    if raw[:4] != b"BAI\1":
        raise ValueError("not a BAI index")
    k, out = 8, []
    for ref in range(struct.unpack_from("<i", raw, 4)[0]):
        c, keep = Contig(), wanted is None or ref in wanted
        (n,) = struct.unpack_from("<i", raw, k)
        k += 4
        for _ in range(n):
            b, m = struct.unpack_from("<Ii", raw, k)
            if keep and b != COUNTS:
                flat = struct.unpack_from(f"<{2 * m}Q", raw, k + 8)
                c.bins[b] = list(zip(flat[::2], flat[1::2], strict=True))
            k += 8 + 16 * m
        (n,) = struct.unpack_from("<i", raw, k)
        if keep:
            c.windows = list(struct.unpack_from(f"<{n}Q", raw, k + 4))
        k += 4 + 8 * n
        out.append(c)
    return out
