"""Words and their 64-bit hashes for whole Arrow columns of text, in numpy.

A word is a maximal run of bytes other than space and \\x09-\\x0D; A-Z count as a-z.
Texts are worked on in slices of a few MB, so memory doesn't follow the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values; different values stay different."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64))[LOWER]
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        _powers = tuple(np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base)])) for base in (_BASE, _INVERSE))
    return _powers[0][:n], _powers[1][:n]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and where each begins (one more than texts); NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes, one text at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = last


class Words(NamedTuple):
    hashes: np.ndarray  #: of each word
    begin: np.ndarray  #: its first byte, and the byte after it
    end: np.ndarray
    offsets: np.ndarray  #: of each text's first word, one more than texts


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of texts given by text_bytes; a word never crosses texts."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64))
    solid = ~SPACE[data]
    opens, closes = np.empty(n, bool), np.empty(n, bool)
    opens[0], closes[-1] = True, True
    opens[1:], closes[:-1] = ~solid[:-1], ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    opens[inner], closes[inner - 1] = True, True
    begin, end = np.flatnonzero(solid & opens), np.flatnonzero(solid & closes) + 1
    power, inverse = powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * power, out=total[1:])
    hashes = mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    return Words(hashes, begin, end, np.searchsorted(begin, offsets))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words of each text and the text of each; a text of fewer words gives its whole sequence as one, one without words none."""
    n = np.diff(words.offsets)
    text = np.repeat(np.arange(len(n)), n)
    left = words.offsets[1:][text] - np.arange(len(text))  # words from here to the text's end
    starts = np.flatnonzero(left >= size)
    out = run_hash(words.hashes, starts, size)
    short = np.flatnonzero((n > 0) & (n < size))
    if not len(short):
        return out, text[starts]
    rest = np.zeros(len(short), np.uint64)
    for i in range(size - 1):
        on = n[short] > i
        rest[on] = mix(rest[on] * _BASE + words.hashes[words.offsets[:-1][short[on]] + i])
    return np.concatenate([out, mix(rest + n[short].astype(np.uint64))]), np.concatenate([text[starts], short])


def run_hash(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    for i in range(size):
        out = mix(out * _BASE + hashes[starts + i])
    return out


def as_long(x: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's signed longs."""
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))
