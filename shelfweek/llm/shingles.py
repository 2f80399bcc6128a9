"""Hashed word shingles of whole texts, computed on the bytes of an Arrow column.

Words are runs of bytes other than space and \\x09-\\x0D, with A-Z lowered. A
word's hash is a polynomial over a random 64-bit number per byte value, taken
from running sums, so that no Python object is made per word.
"""

import numpy as np
import pyarrow as pa

# Bytes hashed at a time; a longer word is hashed whole.
CHUNK = 1 << 18

_random = np.random.default_rng(5)
_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SHIFT = _random.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_SEPARATES = np.zeros(256, bool)
_SEPARATES[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        steps = np.full(max(n, CHUNK + 64), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.multiply.accumulate(steps)
    return _POWERS[base][:n]


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of each word of a run of bytes in which texts begin at ``starts``."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SEPARATES[data]
    begins = inside[1:-1] & ~inside[:-2]
    first = starts[starts < len(data)]
    begins[first] = inside[1:-1][first]
    ends = inside[1:-1] & ~inside[2:]
    last = first[first > 0] - 1
    ends[last] = inside[1:-1][last]
    a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _powers(_BASE, len(data)), out=sums[1:])
    hashes = (sums[b] - sums[a]) * _powers(_INVERSE, len(data) + 1)[a]
    return mix(hashes + (b - a).astype(np.uint64)), a


def _text_words(data: np.ndarray) -> np.ndarray:
    """Word hashes of one text of any length, a chunk of whole words at a time."""
    parts, at = [], 0
    while at < len(data):
        to = min(len(data), at + CHUNK)
        while to < len(data):
            gap = np.flatnonzero(_SEPARATES[data[to : to + CHUNK]])
            to += int(gap[0]) if len(gap) else min(CHUNK, len(data) - to)
            if len(gap):
                break
        parts.append(word_hashes(data[at:to], np.zeros(1, np.int64))[0])
        at = to
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _sets(words: np.ndarray, bounds: np.ndarray, width: int):
    whole = max(0, len(words) - width + 1)
    grams = np.full(whole, width, np.uint64)
    for k in range(width):
        grams += words[k : k + whole] * _SHIFT[k]
    grams = mix(grams)
    for a, b in zip(bounds[:-1], bounds[1:]):
        n = b - a
        if n >= width:
            found = np.sort(grams[a : b - width + 1])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif n:
            yield mix(np.sum(words[a:b] * _SHIFT[:n], keepdims=True) + np.uint64(n))
        else:
            yield np.empty(0, np.uint64)


def shingle_sets(column: pa.Array, width: int):
    """Per text, the sorted distinct hashes of its shingles of ``width`` words.

    A text with fewer words is one shingle of all its words; a null text or one
    without words has none.
    """
    for words, bounds in word_lists(column):
        yield from _sets(words, bounds, width)


def word_lists(column: pa.Array):
    """Word hashes of some texts after the other, and where each text's words begin and end."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        part = data[offsets[at] : offsets[to]]
        if to == at + 1:
            words = _text_words(part)
            yield words, np.array([0, len(words)])
        else:
            starts = offsets[at:to] - offsets[at]
            words, places = word_hashes(part, starts)
            yield words, np.append(np.searchsorted(places, starts), len(words))
        at = to


def pair_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of every word with the next one."""
    return mix(words[:-1] * _SHIFT[0] + words[1:] * _SHIFT[1])
