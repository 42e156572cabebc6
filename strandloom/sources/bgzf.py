"""Blocked gzip files that are read from the middle, and the index of alignment files by position.

A virtual place is a block's place in the file, shifted by 16 bits, with a place in the block's data. A reader that
starts anywhere looks for the next block, and a reader of records for the next place from which records follow one
another; so a file is read by many tasks without an index. An index lists, for bins of a contig's positions, the runs of
virtual places (chunks) that hold their records, and for each window of positions the first place that matters.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

#: Fixed values of the formats: a block's first bytes; positions of the smallest bin, and of the contig; first number of each level of bins; a bin that holds counts.
MAGIC = b"\x1f\x8b\x08\x04"
SMALLEST, POSITIONS = 14, 29
LEVELS = ((0, 29), (1, 26), (9, 23), (73, 20), (585, 17), (4681, 14))
COUNTS_BIN = 37450
_MOST = 1 << 16


def block_at(f: BinaryIO, at: int) -> tuple[int, bytes] | None:
    """(size in the file, data) of the block at a place; None at the file's end or if there is no block."""
    f.seek(at)
    head = f.read(12)
    if len(head) < 12 or head[:4] != MAGIC:
        return None
    extra = f.read(struct.unpack("<H", head[10:])[0])
    size, i = 0, 0
    while i + 4 <= len(extra):
        n = struct.unpack("<H", extra[i + 2 : i + 4])[0]
        if extra[i : i + 2] == b"BC":
            size = struct.unpack("<H", extra[i + 4 : i + 6])[0] + 1
        i += 4 + n
    if size < len(extra) + 20:
        return None
    body = f.read(size - len(extra) - 12)
    if len(body) < 8:
        return None
    try:
        data = zlib.decompress(body[:-8], -15)
    except zlib.error:
        return None
    check, n = struct.unpack("<II", body[-8:])
    return (size, data) if n == len(data) and zlib.crc32(data) == check else None


def next_block(f: BinaryIO, at: int) -> int | None:
    """Place of the first whole block at or behind a place. Its check sum tells a block from data that look like one."""
    while True:
        f.seek(at)
        window = f.read(2 * _MOST)
        i = -1
        while (i := window.find(MAGIC, i + 1)) >= 0:
            if block_at(f, at + i):
                return at + i
        if len(window) < 2 * _MOST:
            return None
        at += len(window) - 3


class Stream:
    """Data from a virtual place on; tell() is the virtual place of the next byte."""

    def __init__(self, f: BinaryIO, virtual: int):
        self.f, self.next, self.within = f, virtual >> 16, virtual & 0xFFFF
        self.held: list[tuple[int, bytes]] = []  # blocks that are not used up
        self._more()

    def _more(self) -> bool:
        block = block_at(self.f, self.next)
        if block is None:
            return False
        if block[1]:
            self.held.append((self.next, block[1]))
        self.next += block[0]
        return True

    def tell(self) -> int:
        while self.held and self.within >= len(self.held[0][1]):
            self.within -= len(self.held.pop(0)[1])
        while not self.held:
            if not self._more():
                return self.next << 16
        return self.held[0][0] << 16 | self.within

    def peek(self, n: int) -> bytes:
        """Up to n bytes ahead."""
        self.tell()
        while sum(len(d) for _, d in self.held) - self.within < n and self._more():
            pass
        data = self.held[0][1] if len(self.held) == 1 else b"".join(d for _, d in self.held)
        return data[self.within : self.within + n] if self.held else b""

    def take(self, n: int) -> bytes:
        out = self.peek(n)
        self.within += len(out)
        return out


def first_record(f: BinaryIO, at: int, end: int, plausible: Callable[[bytes], bool], follow: int = 8) -> int | None:
    """Virtual place of the first record that begins in a block from at on and before end; None if there is none.

    A place counts if a plausible record stands there and plausible ones follow it, follow of them or up to the end.
    """
    block = next_block(f, at)
    while block is not None and block < end:
        found = block_at(f, block)
        if found is None:
            return None
        ahead = _Ahead(f, block)
        for i in range(len(found[1])):
            if _chain(ahead, i, plausible, follow):
                return block << 16 | i
        block += found[0]
    return None


class _Ahead:
    """Data from a block on, read further when it is needed."""

    def __init__(self, f: BinaryIO, block: int):
        self.stream, self.data, self.ended = Stream(f, block << 16), b"", False

    def upto(self, n: int) -> bool:
        if n > len(self.data) and not self.ended:
            size = max(n, 2 * len(self.data), 4 * _MOST)
            self.data = self.stream.peek(size)
            self.ended = len(self.data) < size
        return n <= len(self.data)


def _chain(ahead: _Ahead, at: int, plausible: Callable[[bytes], bool], follow: int) -> bool:
    for seen in range(follow):
        if not ahead.upto(at + 36):
            return seen > 0 and at == len(ahead.data)
        n = struct.unpack_from("<i", ahead.data, at)[0]
        if not 32 <= n < 1 << 28 or not _reasonable(ahead.data[at + 4 : at + 36], n) or not ahead.upto(at + 4 + n) or not plausible(ahead.data[at + 4 : at + 4 + n]):
            return False
        at += 4 + n
    return True


def _reasonable(fixed: bytes, size: int) -> bool:
    """A first look at a record's fixed part, before the rest is read."""
    ref, pos, n_name, _, _, n_ops, _, n_seq, other, other_pos, _ = struct.unpack("<iiBBHHHiiii", fixed)
    return ref >= -1 and pos >= -1 and n_name > 1 and n_seq >= 0 and other >= -1 and other_pos >= -1 and 32 + n_name + 4 * n_ops + (n_seq + 1) // 2 + n_seq <= size


def bins_over(start: int, end: int) -> Iterator[int]:
    """Bins that may hold records over [start, end)."""
    last = max(start, end - 1)
    for first, shift in LEVELS:
        yield from range(first + (start >> shift), first + (last >> shift) + 1)


def bin_of(start: int, end: int) -> int:
    """The smallest bin that holds [start, end)."""
    last = max(start, end - 1)
    for first, shift in reversed(LEVELS):
        if start >> shift == last >> shift:
            return first + (start >> shift)
    return 0


class Index:
    """bins[contig number][bin] = chunks (from, to); windows[contig number] = first virtual places."""

    def __init__(self, contigs: int):
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in range(contigs)]
        self.windows: list[list[int]] = [[] for _ in range(contigs)]

    def add(self, contig: int, start: int, end: int, at: int, to: int) -> None:
        """A record in the order of the file; it lies at [at, to) of virtual places."""
        chunks = self.bins[contig].setdefault(bin_of(start, end), [])
        if chunks and chunks[-1][1] >= at:
            chunks[-1][1] = to
        else:
            chunks.append([at, to])
        windows = self.windows[contig]
        for w in range(start >> SMALLEST, (max(start, end - 1) >> SMALLEST) + 1):
            windows += [0] * (w + 1 - len(windows))
            windows[w] = windows[w] or at

    def chunks(self, contig: int, start: int, end: int) -> list[tuple[int, int]]:
        """Merged runs of virtual places that hold all records over [start, end), and others."""
        windows, w = self.windows[contig], max(0, start) >> SMALLEST
        # A window without a record says nothing; the last one before it bounds what lies behind.
        least = next((v for v in reversed(windows[: w + 1]) if v), 0)
        of = self.bins[contig]
        found = sorted((a, b) for n in bins_over(max(0, start), min(end, 1 << POSITIONS)) for a, b in of.get(n, ()) if b > least)
        out: list[tuple[int, int]] = []
        for a, b in found:
            if out and a >> 16 <= out[-1][1] >> 16:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    def write(self, f: BinaryIO) -> None:
        f.write(b"BAI\1" + struct.pack("<i", len(self.bins)))
        for bins, windows in zip(self.bins, self.windows, strict=True):
            f.write(struct.pack("<i", len(bins)))
            for n, chunks in sorted(bins.items()):
                f.write(struct.pack("<Ii", n, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks))
            f.write(struct.pack("<i", len(windows)) + struct.pack(f"<{len(windows)}Q", *windows))

    @classmethod
    def read(cls, f: BinaryIO) -> Index:
        data = f.read()
        if data[:4] != b"BAI\1":
            raise ValueError("no index of alignments")
        at = 4

        def take(form: str) -> tuple:
            nonlocal at
            at += struct.calcsize(form)
            return struct.unpack_from(form, data, at - struct.calcsize(form))

        out = cls(take("<i")[0])
        for bins, windows in zip(out.bins, out.windows, strict=True):
            for _ in range(take("<i")[0]):
                n, count = take("<Ii")
                chunks = [list(take("<QQ")) for _ in range(count)]
                if n != COUNTS_BIN:
                    bins[n] = chunks
            windows += take(f"<{take('<i')[0]}Q")
        return out
