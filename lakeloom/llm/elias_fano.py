"""Monotone sequences in Elias-Fano form, over plain numpy arrays that can be memory-mapped."""

from __future__ import annotations

import json

import numpy as np

from .files import create, locate

ONE = np.uint64(1)
# Values are packed so many at a time: a task's memory holds little besides them.
CHUNK = 1 << 16
# One in each byte, and the highest bit of each byte.
BYTES, TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
# Place of the j-th one of byte b at ``8 * b + j``.
PLACES = np.argsort(
    np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little") ^ 1, axis=1, kind="stable"
).astype(np.uint8).ravel()


def select(words: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Place of the ``left``-th one of each word, which has that many: its byte by sums of counts, then a table."""
    left = left.astype(np.uint64)
    upto = np.bitwise_count(words.view(np.uint8)).view(np.uint64) * BYTES
    byte = np.bitwise_count(((left * BYTES | TOPS) - upto) & TOPS).astype(np.uint64) << np.uint64(3)
    inner = left - (((upto << np.uint64(8)) >> byte) & np.uint64(255))
    return byte.astype(np.int64) + PLACES[((words >> byte) & np.uint64(255)) << np.uint64(3) | inner]


def pack_fixed(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bits of each value, one after the other, in 64-bit words and one spare."""
    words = np.zeros((len(values) * width + 63) // 64 + 2, np.uint64)
    for done in range(0, len(values) if width else 0, CHUNK):
        some = values[done : done + CHUNK] & ((ONE << np.uint64(width)) - ONE)
        at = np.arange(done, done + len(some), dtype=np.uint64) * np.uint64(width)
        word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        np.bitwise_or.at(words, word, some << off)
        spill = off + np.uint64(width) > np.uint64(64)
        np.bitwise_or.at(words, word[spill] + 1, some[spill] >> (np.uint64(64) - off[spill]))
    return words


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays for a sorted sequence below ``universe``: low bits packed, high bits in unary."""
    n = len(values)
    width = max((universe // max(n, 1)).bit_length() - 1, 0)
    bits = np.zeros((n + (universe >> width) + 64) // 64 * 64 + 64, np.uint8)
    for done in range(0, n, CHUNK):
        high = (values[done : done + CHUNK] >> np.uint64(width)).astype(np.int64)
        bits[high + np.arange(done, done + len(high))] = 1
    upper = np.packbits(bits, bitorder="little").view(np.uint64)
    zeros = 64 - np.bitwise_count(upper).astype(np.int64)
    return {
        "low": pack_fixed(values, width),
        "high": upper,
        "zeros": np.concatenate(([0], np.cumsum(zeros))),
        "shape": np.array([n, width], np.int64),
    }


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray], prefix: str = ""):
        self.low, self.high, self.zeros = (arrays[prefix + k] for k in ("low", "high", "zeros"))
        self.n, self.width = (int(x) for x in arrays[prefix + "shape"])
        self.ones: np.ndarray | None = None

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the ``k``-th zero of the unary part."""
        word = np.searchsorted(self.zeros, k, "right") - 1
        return word * 64 + select(~self.high[word], k - self.zeros[word])

    def _one(self, i: np.ndarray) -> np.ndarray:
        """Place of the ``i``-th one of the unary part."""
        if self.ones is None:
            self.ones = np.arange(len(self.zeros)) * 64 - self.zeros
        word = np.searchsorted(self.ones, i, "right") - 1
        return word * 64 + select(self.high[word], i - self.ones[word])

    def _after(self, place: np.ndarray, k: np.ndarray, zero: bool) -> np.ndarray:
        """Place of the ``k``-th zero or one, where that before it, or -1, is known: mostly in the same word."""
        place = place + 1
        word = self.high[place >> 6]
        rest = (~word if zero else word) >> (place & 63).astype(np.uint64)
        out = place + np.bitwise_count(~rest & (rest - ONE))
        far = np.flatnonzero(rest == 0)
        out[far] = (self._zero if zero else self._one)(k[far])
        return out

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.width)
        word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        above = (self.low[word + 1] << ONE) << (np.uint64(63) - off)
        return ((self.low[word] >> off) | above) & ((ONE << np.uint64(self.width)) - ONE)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each value the place of the first that is not smaller, and whether it is equal."""
        high = (x >> np.uint64(self.width)).astype(np.int64)
        low = x & ((ONE << np.uint64(self.width)) - ONE)
        before = np.where(high > 0, self._zero(np.maximum(high - 1, 0)), -1)
        start, end = before - high + 1, self._after(before, high, True) - high
        equal = np.zeros(len(x), bool)
        todo = np.flatnonzero(start < end)
        lo, hi, low, same = start[todo], end[todo], low[todo], equal[todo]
        while len(todo):
            middle = (lo + hi) >> 1
            there = self._low(middle)
            smaller = there < low
            lo, hi = np.where(smaller, middle + 1, lo), np.where(smaller, hi, middle)
            # What lies at the upper end, once that is inside.
            same = np.where(smaller, same, there == low)
            left = np.flatnonzero(lo < hi)
            if len(left) < len(todo):
                start[todo], equal[todo] = lo, same
                todo, lo, hi, low, same = todo[left], lo[left], hi[left], low[left], same[left]
        return start, equal

    def at(self, i: np.ndarray) -> np.ndarray:
        """The ``i``-th entries: high part by the ``i``-th one, low part as it lies."""
        return ((self._one(i) - i) << self.width) + self._low(i).astype(np.int64)

    def gaps(self, i: np.ndarray) -> np.ndarray:
        """By how much the ``i``-th entries are above those before them, the first above 0."""
        inner = i > 0
        last = np.where(inner, i - 1, 0)
        before = np.where(inner, self._one(last), -1)
        above = self._after(before, i, False) - before - 1
        return (above << self.width) + self._low(i).astype(np.int64) - np.where(inner, self._low(last).astype(np.int64), 0)


def save(uri: str, arrays: dict[str, np.ndarray]) -> None:
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = [at, a.dtype.str, len(a)]
        at += -(-a.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    with create(uri) as out:
        out.write(np.array([len(text)], "<i8").tobytes() + text)
        for a in arrays.values():
            out.write(np.ascontiguousarray(a).tobytes() + b"\0" * (-a.nbytes % 8))


def load(uri: str) -> dict[str, np.ndarray]:
    """Views into the file: mapped where the file system allows it, else read."""
    system, path = locate(uri)
    if system.type_name == "local":
        raw = np.asarray(np.memmap(path, np.uint8, "r"))
    else:
        with system.open_input_file(path) as file:
            raw = np.frombuffer(file.read(), np.uint8)
    size = int(raw[:8].view("<i8")[0])
    head = json.loads(bytes(raw[8 : 8 + size]))
    base = 8 + size
    return {
        name: raw[base + at : base + at + n * np.dtype(kind).itemsize].view(kind)
        for name, (at, kind, n) in head.items()
    }
