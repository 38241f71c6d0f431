"""BGZF: gzip members of up to 64 KB that say how long they are, so that a file can be entered at any of them."""

from __future__ import annotations

import struct
import zlib

#: The empty block that ends a file (fixed by the format).
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
_MAGIC = b"\x1f\x8b\x08\x04"
#: Text in one block when writing; bytes asked for at once when reading.
PAYLOAD, WINDOW = 0xFF00, 1 << 20


def block_size(head: bytes, at: int = 0) -> int | None:
    """Bytes of the block whose header stands in `head`; None if it is none, or its header is cut off."""
    if len(head) - at < 18 or head[at : at + 4] != _MAGIC:
        return None
    extra = struct.unpack_from("<H", head, at + 10)[0]
    k, stop = at + 12, at + 12 + extra
    while k + 4 <= min(stop, len(head)):
        n = struct.unpack_from("<H", head, k + 2)[0]
        if head[k : k + 2] == b"BC" and n == 2 and k + 6 <= len(head):
            return struct.unpack_from("<H", head, k + 4)[0] + 1
        k += 4 + n
    return None


def inflated(block: bytes) -> bytes:
    extra = struct.unpack_from("<H", block, 10)[0]
    data = zlib.decompress(block[12 + extra : -8], -15)
    if struct.unpack("<II", block[-8:]) != (zlib.crc32(data), len(data)):
        raise ValueError("a BGZF block does not have the contents that it says")
    return data


def deflated(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return _MAGIC + bytes((0, 0, 0, 0, 0, 255, 6, 0)) + b"BC" + struct.pack("<HH", 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


class Blocks:
    """Blocks from a place on, read in windows; `count` says how many have been inflated."""

    def __init__(self, f, at: int):
        self.f, self.at, self.held, self.base, self.count = f, at, b"", at, 0

    def _need(self, n: int) -> bytes:
        """At least n bytes from `at` on, where the file has them."""
        k = self.at - self.base
        if k + n > len(self.held):
            self.f.seek(self.at)
            self.held, self.base, k = self.f.read(max(n, WINDOW)), self.at, 0
        return self.held[k : k + n]

    def next(self) -> tuple[int, bytes] | None:
        """(place, data) of the next block; None at the end of the file."""
        head = self._need(512)
        if not head:
            return None
        size = block_size(head)
        if size is None:
            raise ValueError(f"no BGZF block at {self.at}")
        block, place = self._need(size), self.at
        if len(block) < size:
            raise ValueError(f"the BGZF block at {self.at} is cut off")
        self.at += size
        self.count += 1
        return place, inflated(block)


def first_block(f, start: int, stop: int, end: int) -> int | None:
    """Place of the first block that begins in [start, stop) of a file of `end` bytes.

    Compressed bytes may look like a header, so a block must lead to another one (or the file's end) and hold what it says.
    """
    at = start
    while at < stop:
        f.seek(at)
        held = f.read(min(WINDOW, end - at))
        k = held.find(_MAGIC)
        while k >= 0 and at + k < stop:
            if len(held) - k < 1 << 17 and at + len(held) < end:
                break  # the block and its successor's header may reach beyond what is held
            size = block_size(held, k)
            if size and (at + k + size == end or block_size(held, k + size)):
                try:
                    inflated(held[k : k + size])
                    return at + k
                except (ValueError, zlib.error):
                    pass
            k = held.find(_MAGIC, k + 1)
        if k < 0:
            at += max(len(held) - 3, 1)
        elif at + k >= stop:
            return None
        else:
            at += k  # read again from here: WINDOW holds the longest block and what follows it
    return None


def directory(f, end: int) -> list[tuple[int, int]]:
    """(place, first byte of the unpacked data) of every block, from headers and trailers alone; raises if it is no BGZF file."""
    out, at, total = [], 0, 0
    while at < end:
        f.seek(at)
        held = f.read(min(WINDOW, end - at))
        k = 0
        while True:
            size = block_size(held, k)
            if size is None or k + size > len(held):
                break
            out.append((at + k, total))
            total += struct.unpack_from("<I", held, k + size - 4)[0]
            k += size
        if not k:
            raise ValueError(f"no BGZF block at {at}")
        at += k
    return [*out, (end, total)]


class Writer:
    """Packs what it is given into blocks; `place()` is the virtual place (block << 16 | byte) of what comes next."""

    def __init__(self, f, at: int = 0):
        self.f, self.at, self.rest = f, at, bytearray()

    def place(self) -> int:
        if len(self.rest) >= PAYLOAD:
            self.flush()
        return self.at << 16 | len(self.rest)

    def write(self, data: bytes) -> None:
        k = 0
        while k < len(data):
            room = PAYLOAD - len(self.rest)
            self.rest += data[k : k + room]
            k += room
            if len(self.rest) == PAYLOAD:
                self.flush()

    def flush(self) -> None:
        if self.rest:
            block = deflated(bytes(self.rest))
            self.f.write(block)
            self.at += len(block)
            self.rest.clear()
