"""Counting quotient filters of packed n-grams, lossless and mergeable.

An n-gram of word ids, ``width`` bits each, is permuted invertibly, so that its first number is spread evenly. The top bits
of that number are the quotient, everything else the remainder, which is kept in full: nothing is lost and nothing collides. A filter is
sorted; packed, it holds the number of entries of each quotient, the remainders in as few bytes as they need, and small counters.
"""

from __future__ import annotations

import struct

import numpy as np

from .words import mix

#: Rounds of the permutation.
_ROUNDS = 2
_HEADER = "<QIIBBBB"
_MANY = 255


def _turn(previous: np.ndarray, step: int) -> np.ndarray:
    return mix(previous * np.uint64(0x9E3779B97F4A7C15) + np.uint64(step + 1))


def permute(grams: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The numbers of n-grams of two words or more, each mixed with the one before it in turn."""
    mask, out, n = np.uint64((1 << width) - 1), list(grams), len(grams)
    for step in range(_ROUNDS * n):
        out[step % n] = (out[step % n] + _turn(out[(step - 1) % n], step)) & mask
    return out


def restore(numbers: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The n-grams that ``permute`` turned into these numbers."""
    mask, out, n = np.uint64((1 << width) - 1), list(numbers), len(numbers)
    for step in reversed(range(_ROUNDS * n)):
        out[step % n] = (out[step % n] - _turn(out[(step - 1) % n], step)) & mask
    return out


def _bytes_of(values: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _values_of(data: memoryview, count: int, size: int) -> np.ndarray:
    out = np.zeros((count, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8, count * size).reshape(count, size)
    return out.view("<u8").ravel().astype(np.uint64)


class Filter:
    """Permuted n-grams in order, each once, with its count."""

    def __init__(self, numbers: list[np.ndarray], counts: np.ndarray, width: int):
        self.numbers, self.counts, self.width = numbers, counts, width

    def __len__(self) -> int:
        return len(self.counts)

    @staticmethod
    def of(numbers: list[np.ndarray], counts: np.ndarray, width: int) -> Filter:
        """A filter of permuted n-grams in any order, also repeated ones."""
        if not len(counts):
            return Filter(numbers, counts, width)
        order = np.argsort(numbers[0])
        first = numbers[0][order]
        same = first[1:] == first[:-1]
        if any((same & (x[order][1:] != x[order][:-1])).any() for x in numbers[1:]):
            order = np.lexsort(numbers[::-1])
        numbers = [x[order] for x in numbers]
        opens = np.ones(len(counts), bool)
        opens[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in numbers])
        return Filter([x[opens] for x in numbers], np.add.reduceat(counts[order], np.flatnonzero(opens)), width)

    @staticmethod
    def merged(filters: list[Filter]) -> Filter:
        if len(filters) == 1:
            return filters[0]
        numbers = [np.concatenate(x) for x in zip(*(f.numbers for f in filters))]
        return Filter.of(numbers, np.concatenate([f.counts for f in filters]), filters[0].width)

    def grams(self) -> list[np.ndarray]:
        return restore(self.numbers, self.width)

    def pack(self, part_bits: int):
        """(part, bytes) for every part that has entries; the part is the top ``part_bits`` of the first number."""
        shift = np.uint64(self.width - part_bits)
        parts = (self.numbers[0] >> shift).astype(np.int64)
        found, starts = np.unique(parts, return_index=True)
        for part, a, b in zip(found.tolist(), starts, [*starts[1:], len(self)]):
            yield part, self._packed(part, part_bits, a, b)

    def _packed(self, part: int, part_bits: int, a: int, b: int) -> bytes:
        entries, k = b - a, len(self.numbers)
        slot_bits = min(self.width - part_bits, max(0, int(entries).bit_length() - 1))
        rest = self.width - part_bits - slot_bits
        inside = self.numbers[0][a:b] & np.uint64((1 << (self.width - part_bits)) - 1)
        runs = np.bincount((inside >> np.uint64(rest)).astype(np.int64), minlength=1 << slot_bits)
        wide = int(runs.max() > 255)
        counts = self.counts[a:b]
        many = np.flatnonzero(counts >= _MANY)
        return b"".join([
            struct.pack(_HEADER, part, entries, len(many), self.width, part_bits, slot_bits, k + 64 * wide),
            runs.astype("<u4" if wide else np.uint8).tobytes(),
            _bytes_of(inside & np.uint64((1 << rest) - 1), (rest + 7) // 8),
            *(_bytes_of(x[a:b], (self.width + 7) // 8) for x in self.numbers[1:]),
            np.minimum(counts, _MANY).astype(np.uint8).tobytes(), many.astype("<u4").tobytes(), counts[many].astype("<i8").tobytes(),
        ])

    @staticmethod
    def unpack(packed: bytes) -> Filter:
        part, entries, n_many, width, part_bits, slot_bits, form = struct.unpack_from(_HEADER, packed)
        data, at = memoryview(packed), struct.calcsize(_HEADER)
        k, rest = form % 64, width - part_bits - slot_bits

        def take(dtype, count):
            nonlocal at
            out = np.frombuffer(data, dtype, count, at)
            at += out.nbytes
            return out

        runs = take("<u4" if form >= 64 else np.uint8, 1 << slot_bits)
        numbers = []
        for size in [(rest + 7) // 8, *[(width + 7) // 8] * (k - 1)]:
            numbers.append(_values_of(data[at:], entries, size))
            at += entries * size
        counts = take(np.uint8, entries).astype(np.int64)
        many = take("<u4", n_many)
        counts[many] = take("<i8", n_many)
        quotients = np.repeat(np.arange(1 << slot_bits, dtype=np.uint64), runs)
        high = (part << (width - part_bits)) & ((1 << 64) - 1)
        numbers[0] |= (quotients << np.uint64(rest)) | np.uint64(high) if rest < 64 else np.uint64(0)
        return Filter(numbers, counts, width)
