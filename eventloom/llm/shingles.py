"""Words and word shingles of whole texts as 64-bit hashes, many texts at a time in numpy."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are taken together up to so many bytes; a longer one comes alone.
BLOCK = 1 << 20

_random = np.random.Generator(np.random.PCG64(20240229))
_PLACE = _random.integers(1, 1 << 63, 1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
#: White space between words: space and the control characters 9 to 13.
SPACES = np.ones(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = False
#: ASCII letters and digits.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
#: Scripts written without spaces: each of their letters is a word of its own.
UNSPACED = [
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9D), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),
]
SEPARATOR, LETTER, MARK, ALONE = range(4)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each bit over all 64 (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes and row limits of consecutive texts of some megabytes; null texts are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, at, data = texts.buffers()
    limits = np.frombuffer(at, np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(limits, limits[row] + BLOCK, side="right")) - 1)
        yield row, end, data[limits[row] : limits[end]], limits[row : end + 1] - limits[row]
        row = end


_points: list[np.ndarray] = []


def _point_kinds() -> np.ndarray:
    """What each code point is: a separator, a letter or digit, a mark on a letter, or a word of its own."""
    if not _points:
        first = [unicodedata.category(chr(i))[0] for i in range(0x110000)]
        kinds = np.array([{"L": LETTER, "N": LETTER, "M": MARK}.get(c, SEPARATOR) for c in first], np.uint8)
        for low, high in UNSPACED:
            part = kinds[low : high + 1]
            part[np.array([c == "L" for c in first[low : high + 1]])] = ALONE
        kinds[0x3007] = ALONE
        _points.append(kinds)
    return _points[0]


def letter_words(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like hash_words, with words of Unicode letters, their marks and digits in UTF-8; every other character separates."""
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return hash_words(data, limits, LETTERS)
    size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0).astype(np.int64)
    point = data[lead].astype(np.int64) & (0xFF >> (size + 1))
    for k in range(1, 4):
        more = size > k
        point[more] = point[more] << 6 | (data[lead[more] + k] & 0x3F)
    kind = LETTERS[data].astype(np.uint8)
    found = _point_kinds()[np.minimum(point, 0x10FFFF)]
    for k in range(4):
        more = size > k
        kind[lead[more] + k] = found[more]
    inside = kind != SEPARATOR
    begins = inside & ((data < 0x80) | (data >= 0xC0))
    begins[1:] &= ~inside[:-1] | (kind[1:] == ALONE) | ((kind[:-1] == ALONE) & (kind[1:] != MARK))
    return _hashed(data, limits, inside, begins)


def hash_words(data: np.ndarray, limits: np.ndarray, kinds: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word of some texts, A to Z as a to z. `kinds`: the bytes that words are made of."""
    inside = kinds[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    return _hashed(data, limits, inside, begins, kinds)


def _hashed(data: np.ndarray, limits: np.ndarray, inside: np.ndarray, begins: np.ndarray, kinds: np.ndarray | None = None):
    first = limits[:-1][np.diff(limits) > 0]  # a text's first byte may start a word though the last text ended in one
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    place = np.arange(len(data), dtype=np.int32)
    place[starts[0] :] -= np.repeat(starts.astype(np.int32), np.diff(starts, append=len(data)))
    value = _BYTE[data] * inside if kinds is None else np.where(kinds, _BYTE, np.uint64(0))[data]
    value *= _PLACE[place & 4095]
    return mix(np.add.reduceat(value, starts)), np.searchsorted(limits, starts, side="right") - 1


def shingle(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n consecutive words within a row, with the place of the first in `words`."""
    if len(words) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    last = len(words) - n + 1
    total = np.zeros(last, np.uint64)
    for k in range(n):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + last] + np.uint64(k + 1))
    at = np.flatnonzero(rows[:last] == rows[n - 1 :])
    return total[at], at


def shingle_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For some rows at a time: the first row, sorted distinct shingles end to end, and their limits by row.

    A text with fewer than n words has them all as its one shingle, a text without words none.
    """
    for row, end, data, limits in blocks(texts):
        words, rows = hash_words(data, limits)
        value, at = shingle(words, rows, n)
        counts = np.bincount(rows, minlength=end - row)
        begins = np.cumsum(counts) - counts
        have = np.maximum(counts - n + 1, 0)
        ends, sets = np.cumsum(have), []
        for r, (a, b) in enumerate(zip((ends - have).tolist(), ends.tolist())):
            if a < b:
                own = np.sort(value[a:b])
                sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
            else:
                sets.append(_whole(words[begins[r] : begins[r] + counts[r]]))
        yield row, np.concatenate(sets), np.cumsum([0, *map(len, sets)])


def _whole(words: np.ndarray) -> np.ndarray:
    total = np.array([len(words) + 0x5EED], np.uint64)
    for k in range(len(words)):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + 1])
    return total[: len(words)]
