"""Sorted integers in Elias-Fano form, in files that are mapped into memory and searched by numpy in bulk.

The low bits of each value lie packed one after the other; the high bits are a unary bit vector in which
the bucket of a high part ends with a zero. A count of zeros before each 64-bit word leads to
a bucket; in it the low bits are bisected.
"""

from __future__ import annotations

import mmap

import numpy as np
from pyarrow import fs

from .storage import create, opened

MAGIC = 0x454C4641
HEAD = 8


def low_width(count: int, universe: int) -> int:
    return max(0, (max(1, universe) // max(1, count)).bit_length() - 1)


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    """Bits of all values in one stream, least significant first, with a word to spare."""
    words = np.zeros(-(-len(values) * bits // 64) + 1, np.uint64)
    if not bits:
        return words
    at = np.arange(len(values), dtype=np.int64) * bits
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    np.bitwise_or.at(words, word, values << shift)
    over = shift.astype(np.int64) + bits > 64
    np.bitwise_or.at(words, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return words


def write_sorted(uri: str, values: np.ndarray, payload: np.ndarray) -> None:
    """``values``: strictly ascending unsigned 64-bit; ``payload``: an array of as many numbers."""
    values = values.astype(np.uint64)
    count, base = len(values), int(values[0]) if len(values) else 0
    shifted = values - np.uint64(base)
    bits = low_width(count, int(shifted[-1]) + 1 if count else 1)
    low = _packed(shifted & np.uint64((1 << bits) - 1), bits)
    high = (shifted >> np.uint64(bits)).astype(np.int64)
    ones = high + np.arange(count)
    marks = np.zeros((int(high[-1]) + 1 + count if count else 0) // 64 + 1, np.uint64)
    np.bitwise_or.at(marks, ones >> 6, np.uint64(1) << (ones & 63).astype(np.uint64))
    zeros = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(marks).astype(np.int64))[:-1]]).astype(np.uint64)
    head = np.array([MAGIC, count, base, bits, len(low), len(marks), payload.dtype.itemsize, ord(payload.dtype.kind)], np.uint64)
    with create(uri) as out:
        for part in (head, low, marks, zeros, payload):
            out.write(np.ascontiguousarray(part).tobytes())


def mapped(uri: str) -> np.ndarray:
    """The file's bytes; mapped where the store is a file system of this machine, read whole elsewhere (a file is one task's output)."""
    system, path = opened(uri)
    if isinstance(system, fs.LocalFileSystem):
        with open(path, "rb") as source:
            return np.frombuffer(mmap.mmap(source.fileno(), 0, access=mmap.ACCESS_READ), np.uint8)
    with system.open_input_file(path) as source:
        return np.frombuffer(source.read(), np.uint8)


class Sorted:
    """Search in one file."""

    def __init__(self, uri: str):
        data = mapped(uri)
        magic, self.count, base, self.bits, n_low, n_marks, size, kind = data[: 8 * HEAD].view(np.uint64).tolist()
        if magic != MAGIC:
            raise ValueError(f"{uri} holds no sorted integers")
        self.base = np.uint64(base)
        at = 8 * HEAD
        self.low, at = data[at : at + 8 * n_low].view(np.uint64), at + 8 * n_low
        self.marks, at = data[at : at + 8 * n_marks].view(np.uint64), at + 8 * n_marks
        self.zeros, at = data[at : at + 8 * n_marks].view(np.uint64), at + 8 * n_marks
        self.payload = data[at : at + size * self.count].view(np.dtype(f"{chr(kind)}{size}"))
        self.buckets = n_marks * 64 - self.count

    def _lows(self, index: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(index), np.uint64)
        at = index * self.bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.low[word] >> shift
        over = shift + np.uint64(self.bits) > 64
        value[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return value & np.uint64((1 << self.bits) - 1)

    def _bucket_end(self, high: np.ndarray) -> np.ndarray:
        """Values whose high part is ``high`` or less: the place of that zero, less the zeros before it."""
        word = np.searchsorted(self.zeros, high.astype(np.uint64), "right") - 1
        rank = high - self.zeros[word].astype(np.int64)
        bits, place = ~self.marks[word], np.zeros(len(high), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            below = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            up = rank >= below
            rank = rank - below * up
            place += width * up
            bits = np.where(up, bits >> np.uint64(width), bits)
        return word * 64 + place - high

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key in the sequence, or -1."""
        out = np.full(len(keys), -1, np.int64)
        keys = keys.astype(np.uint64)
        inside = np.nonzero(keys >= self.base)[0] if self.count else np.zeros(0, np.int64)
        shifted = keys[inside] - self.base
        high = shifted >> np.uint64(self.bits)
        fits = high < np.uint64(self.buckets)
        inside, shifted, high = inside[fits], shifted[fits], high[fits].astype(np.int64)
        if not len(inside):
            return out
        stop = np.minimum(self._bucket_end(high), self.count)
        start = np.where(high > 0, self._bucket_end(np.maximum(high - 1, 0)), 0)
        want = shifted & np.uint64((1 << self.bits) - 1)
        low, top = np.minimum(start, self.count), stop.copy()
        # The successor of the wanted low part within its bucket.
        active = np.nonzero(low < top)[0]
        while len(active):
            middle = (low[active] + top[active]) >> 1
            less = self._lows(middle) < want[active]
            low[active] = np.where(less, middle + 1, low[active])
            top[active] = np.where(less, top[active], middle)
            active = active[low[active] < top[active]]
        there = np.nonzero(low < stop)[0]
        there = there[self._lows(low[there]) == want[there]]
        out[inside[there]] = low[there]
        return out
