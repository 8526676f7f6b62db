"""A wavelet matrix of 16-bit token ids in one compressed block of bytes.

Level l holds bit 15-l of every id; ids are stably dealt into those with a 0 and those
with a 1 before the next level. Ranks inside a plane come from a directory of one count
per 512 bits plus the population count of the bits in between.

Block: magic, counts, then the tables and planes, each compressed on its own, so that a
question that needs one plane unpacks no other.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import zstandard

MAGIC = b"FWWM1\0\0\0"
BITS = 16
WORD = 512  # bits per entry of the rank directory
DEALT = 1 << 15  # ids dealt at once, so that their places stay in the cache
_HEAD = struct.Struct("<8sQQ")


def _dealt(ones: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Slices of a level, and the places of its zeros and of its ones inside each."""
    for start in range(0, len(ones), DEALT):
        part = ones[start : start + DEALT]
        yield slice(start, start + len(part)), np.flatnonzero(~part), np.flatnonzero(part)


def build(ids: np.ndarray, lengths: np.ndarray, level: int = 1) -> bytes:
    """Block of the ids of consecutive documents with the given numbers of ids."""
    if len(ids) and int(ids.max()) >> BITS:
        raise ValueError("ids of more than 16 bits")
    rest = ids.astype(np.uint16)
    press = zstandard.ZstdCompressor(level=level).compress
    sections = [press(np.asarray(lengths, "<u4").tobytes())]
    for bit in range(BITS - 1, -1, -1):
        ones = (rest & np.uint16(1 << bit)).astype(bool)
        sections.append(press(np.packbits(ones, bitorder="little").tobytes()))
        halves = [(rest[here].take(zeros), rest[here].take(ones_)) for here, zeros, ones_ in _dealt(ones)]
        rest = np.concatenate([rest[:0], *(z for z, _ in halves), *(o for _, o in halves)])
    sizes = np.array([len(s) for s in sections], "<u8").tobytes()
    return b"".join([_HEAD.pack(MAGIC, len(ids), len(lengths)), sizes, *sections])


class _Plane:
    def __init__(self, packed: np.ndarray, n: int):
        padded = np.zeros(-(-max(n, 1) // WORD) * WORD // 8, np.uint8)
        padded[: len(packed)] = packed
        self.bytes = padded
        counts = np.bitwise_count(padded.reshape(-1, WORD // 8)).sum(1, dtype=np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.zeros = n - int(self.before[-1])
        self.n = n

    def bit(self, i: int) -> int:
        return int(self.bytes[i >> 3] >> (i & 7)) & 1

    def rank1(self, i: int) -> int:
        """Ones in front of position i."""
        block, inside = divmod(i, WORD)
        total = int(self.before[block])
        if inside:
            at = block * WORD // 8
            whole, bits = divmod(inside, 8)
            total += int(np.bitwise_count(self.bytes[at : at + whole]).sum())
            if bits:
                total += int(self.bytes[at + whole] & ((1 << bits) - 1)).bit_count()
        return total

    def _within(self, k: int, one: bool) -> int:
        """Position of the k-th one (or zero), k from 0."""
        before = self.before if one else np.arange(len(self.before)) * WORD - self.before
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.bytes[block * WORD // 8 : (block + 1) * WORD // 8], bitorder="little")
        return block * WORD + int(np.flatnonzero(bits == one)[k - int(before[block])])

    def select1(self, k: int) -> int:
        return self._within(k, True)

    def select0(self, k: int) -> int:
        return self._within(k, False)

    def ones(self) -> np.ndarray:
        return np.unpackbits(self.bytes, count=self.n, bitorder="little").astype(bool)


class WaveletMatrix:
    """Reads a block: single tokens, counts, positions of occurrences, or all ids."""

    def __init__(self, block: bytes):
        magic, self.n, self.n_docs = _HEAD.unpack_from(block)
        if magic != MAGIC:
            raise ValueError("not a wavelet block")
        sizes = np.frombuffer(block, "<u8", BITS + 1, _HEAD.size).astype(np.int64)
        ends = _HEAD.size + 8 * (BITS + 1) + np.cumsum(sizes)
        self._sections = [block[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist())]
        self._planes: dict[int, _Plane] = {}

    @cached_property
    def lengths(self) -> np.ndarray:
        raw = zstandard.decompress(self._sections[0])
        return np.frombuffer(raw, "<u4").astype(np.int64)

    def plane(self, level: int) -> _Plane:
        if level not in self._planes:
            raw = zstandard.decompress(self._sections[level + 1])
            self._planes[level] = _Plane(np.frombuffer(raw, np.uint8), self.n)
        return self._planes[level]

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(BITS):
            plane = self.plane(level)
            bit, ones = plane.bit(i), plane.rank1(i)
            value = value << 1 | bit
            i = plane.zeros + ones if bit else i - ones
        return value

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        for level in range(BITS):
            plane = self.plane(level)
            a, b = plane.rank1(start), plane.rank1(end)
            if token >> (BITS - 1 - level) & 1:
                start, end = plane.zeros + a, plane.zeros + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token in [start, end)."""
        low, high = self._range(token, start, self.n if end is None else end)
        return high - low

    def find(self, token: int, k: int) -> int:
        """Position of the k-th occurrence of a token, k from 0."""
        low, high = self._range(token, 0, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        i = low + k
        for level in range(BITS - 1, -1, -1):
            plane = self.plane(level)
            if token >> (BITS - 1 - level) & 1:
                i = plane.select1(i - plane.zeros)
            else:
                i = plane.select0(i)
        return i

    def ids(self) -> np.ndarray:
        """All ids, from the last level up: each level's bits say which half an id came from."""
        values = np.zeros(self.n, np.uint16)
        for level in range(BITS - 1, -1, -1):
            plane = self.plane(level)
            values[plane.zeros :] |= np.uint16(1 << (BITS - 1 - level))
            merged = np.empty(self.n, np.uint16)
            low, high = 0, plane.zeros
            for here, zeros, ones in _dealt(plane.ones()):
                part = merged[here]
                part[zeros] = values[low : low + len(zeros)]
                part[ones] = values[high : high + len(ones)]
                low, high = low + len(zeros), high + len(ones)
            values = merged
        return values
