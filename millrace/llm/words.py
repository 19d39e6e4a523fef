"""Words and word shingles of many texts at once, as 64-bit hashes from the raw UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed together, a longer text alone.
CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def chunks(texts: pa.Array, size: int = CHUNK_BYTES):
    """(first row, last row + 1, bytes, offsets) of runs of texts; NULL counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    _, offset_buffer, data = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


class Words:
    """Words of a run of texts. ``letters`` maps each byte to what is hashed, 0 where it is no part of a word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, letters: np.ndarray):
        n = len(data)
        value = letters[data]
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = value != 0
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        opens = inside[1:] & (~inside[:-1] | edge)
        closes = inside[:-1] & (~inside[1:] | edge)
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(value.astype(np.uint64) * _powers(_BASE, n), out=total[1:])
        spread = (total[self.ends] - total[self.starts]) * _powers(_INVERSE, n + 1)[self.starts]
        self.hashes = mix(spread + (self.ends - self.starts).astype(np.uint64))
        #: words of text i are hashes[bounds[i]:bounds[i + 1]]
        self.bounds = np.searchsorted(self.starts, offsets)


def _plain_letters() -> np.ndarray:
    letters = np.arange(1, 257, dtype=np.uint16)
    letters[[0x20, *range(0x09, 0x0E)]] = 0
    letters[ord("A") : ord("Z") + 1] = letters[ord("a") : ord("z") + 1]
    return letters


#: Everything but ASCII white space belongs to words, A-Z lower-cased.
SPACED = _plain_letters()


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and the bounds of each text's among them.

    A text of fewer words, but at least one, has its whole sequence as its only shingle.
    """
    counts = np.diff(words.bounds)
    taken = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    bounds = np.concatenate(([0], np.cumsum(taken)))
    text = np.repeat(np.arange(len(counts)), taken)
    first = words.bounds[text] + np.arange(len(text)) - bounds[text]
    length = np.minimum(counts[text], size)
    out = length.astype(np.uint64)
    padded = np.concatenate((words.hashes, np.zeros(size, np.uint64)))
    for j in range(size):
        step = out * np.uint64(_BASE) + padded[first + j]
        out = np.where(j < length, step, out) if (length < size).any() else step
    return mix(out), bounds
