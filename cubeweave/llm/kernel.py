"""Words and word shingles of whole Arrow text columns, as 64-bit numbers.

A word is a run of bytes other than space and U+0009 to U+000D; ASCII letters
may be folded. A word's number is a polynomial over random numbers of its
bytes, taken from running sums, so that a batch of texts costs a few passes of
numpy over its bytes and no Python step for each word. Memory is a small
multiple of ``BLOCK`` bytes, or of the longest text if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BREAK = np.ones(256, dtype=bool)
_BREAK[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_PLACE = mix((np.arange(64, dtype=np.uint64) + np.uint64(1000)) * _STEP) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, BLOCK + 1)
        for at, factor in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, np.uint64(factor))
            steps[0] = 1
            _powers[at] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and each text's place in them; nulls are empty."""
    if pa.types.is_dictionary(texts.type):
        texts = texts.dictionary_decode()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if n == 0:
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, places, data = texts.buffers()
    at = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, dtype=np.uint8)
    return raw, at - at[0]


def blocks(at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BLOCK bytes."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + BLOCK, side="right")) - 1)
        yield lo, hi
        lo = hi


def words(raw: np.ndarray, at: np.ndarray, fold: bool = True, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number, first byte and end byte of each word, and where each text's words begin. ``space``: the bytes between words."""
    n = len(raw)
    inside = ~space[raw]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = at[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    first, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _power(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_FOLDED if fold else _BYTES)[raw] * up[:n], out=sums[1:])
    number = mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64))
    return number, first, end, np.searchsorted(first, at, side="left")


def plain_words(texts: pa.Array) -> Iterator[tuple[int, *tuple[np.ndarray, ...]]]:
    """Words of letters, digits and non-ASCII characters, in lower case, in blocks of texts.

    Yields the block's first text, its bytes in lower case and where its texts
    begin in them, and the words' numbers, first and end bytes and places.
    Lower case keeps the number of code points.
    """
    raw, at = text_bytes(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")))
    for lo, hi in blocks(at):
        part, begin = raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        yield lo, part, begin, *words(part, begin, space=_BREAK)


def grams(number: np.ndarray, size: int) -> np.ndarray:
    """A number in 0 .. 2**63-1 for each run of ``size`` words (texts' borders are not looked at)."""
    n = len(number) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        total += number[i : i + n] * _PLACE[i]
    return (mix(total + np.uint64(size)) >> np.uint64(1)).astype(np.int64)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Each text's set of shingles, sorted; a text of fewer words is one shingle, without words none."""
    raw, at = text_bytes(texts)
    for lo, hi in blocks(at):
        number, _, _, begin = words(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
        run = grams(number, size)
        for i in range(hi - lo):
            a, b = begin[i], begin[i + 1]
            if b - a >= size:
                yield np.unique(run[a : b - size + 1])
            else:
                yield grams(number[a:b], int(b - a)) if b > a else run[:0]
