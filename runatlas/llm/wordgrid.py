"""Words and shingles of a whole Arrow batch at a time, as 64-bit hashes in NumPy arrays.

A word is hashed as a polynomial over its bytes modulo 2**64 (taken from running
sums, so no word is handled on its own) and then mixed. Texts are handled in
slices of a megabyte; a longer text is a slice of its own, and its bytes are
hashed in blocks, so memory stays near the size of the text plus eight bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # arrays over a slice take some thirty times that
HASH_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse modulo 2**64

_seeded = np.random.default_rng(20240229)
BYTE_VALUES = _seeded.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACES = _seeded.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of SplitMix64)."""
    h = values.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def sorted_unique(values: np.ndarray) -> np.ndarray:
    """Distinct values in order: sorting beats the hashing of ``numpy.unique`` here."""
    out = np.sort(values)
    if len(out) < 2:
        return out
    kept = np.empty(len(out), dtype=bool)
    kept[0] = True
    np.not_equal(out[1:], out[:-1], out=kept[1:])
    return out[kept]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_FORWARD = _powers(BASE, HASH_BYTES)
_BACKWARD = _powers(pow(BASE, -1, 2**64), HASH_BYTES)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each span of bytes. Spans are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        upto = max(at + 1, int(np.searchsorted(ends, first + HASH_BYTES, "right")))
        block = data[first : int(ends[upto - 1])]
        forward, backward = _FORWARD, _BACKWARD
        if len(block) > HASH_BYTES:  # one very long word
            forward, backward = _powers(BASE, len(block)), _powers(pow(BASE, -1, 2**64), len(block))
        sums = np.zeros(len(block) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[block] * forward[: len(block)], out=sums[1:])
        s, e = starts[at:upto] - first, ends[at:upto] - first
        length = (e - s).astype(np.uint64)
        out[at:upto] = mix((sums[e] - sums[s]) * backward[s] + length * np.uint64(BASE))
        at = upto
    return out


def byte_table(word_bytes: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(word_bytes)] = True
    return table


#: Everything but the six ASCII white-space characters.
NOT_SPACE = byte_table(bytes(b for b in range(256) if b not in b"\x20\x09\x0a\x0b\x0c\x0d"))
#: ASCII letters and digits, and every byte of a longer UTF-8 character.
ALNUM = byte_table(bytes(b for b in range(256) if chr(b).isalnum() and b < 128 or b >= 128))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


@dataclass
class Words:
    """Words of several texts: word ``i`` is ``data[starts[i]:ends[i]]``; text ``d`` has words ``first[d]:first[d + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends)


def find_words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> Words:
    """Maximal runs of word bytes inside each text; a text's end always ends a word."""
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = word_bytes[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[offsets[:-1]] |= inside[offsets[:-1]]
    begins[-1] = False
    starts = np.flatnonzero(begins)
    stops = inside[:-1].copy()
    stops &= ~inside[1:]
    cut = offsets[1:]
    cut = cut[cut > 0] - 1
    stops[cut] |= inside[cut]
    ends = np.flatnonzero(stops) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of slices of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, upto, data[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at]
        at = upto


def shingle_hashes(words: Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and where each text's begin.

    A text with fewer words, but at least one, has its whole sequence as one shingle.
    """
    counts = np.diff(words.first)
    n = len(hashes)
    runs = np.zeros(n, dtype=np.uint64)
    if n >= width:
        for k in range(width):
            runs[: n - width + 1] += hashes[k : n - width + 1 + k] * PLACES[k]
    text = np.repeat(np.arange(len(counts)), counts)
    full = (np.arange(n) + width) <= words.first[1:][text]
    short = np.flatnonzero((counts > 0) & (counts < width))
    for d in short:
        a, b = words.first[d], words.first[d + 1]
        with np.errstate(over="ignore"):
            runs[a] = (hashes[a:b] * PLACES[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a) * PLACES[15]
        full[a] = True
    kept = np.flatnonzero(full)
    return mix(runs[kept]), np.searchsorted(kept, words.first)
