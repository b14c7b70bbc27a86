"""Vectorised words, hashes and shingles over the texts of an Arrow batch.

All functions work on the UTF-8 bytes of many texts at once: one byte array and the offsets of
the texts in it. Hashes are 64-bit, depend on content only, and are the same on every machine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def weights(count: int, seed: int) -> np.ndarray:
    """Odd pseudo-random multipliers."""
    steps = (np.arange(count, dtype=_U) + _U(seed + 1)) * _U(0x9E3779B97F4A7C15)
    return mix(steps) | _U(1)


_BYTE_WEIGHTS = weights(1 << 12, 1)


def _byte_weights(count: int) -> np.ndarray:
    global _BYTE_WEIGHTS
    if count > len(_BYTE_WEIGHTS):
        _BYTE_WEIGHTS = weights(2 * count, 1)
    return _BYTE_WEIGHTS


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    if len(column) == 0 or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = (
        np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
        if buffers[2] is not None
        else np.zeros(0, np.uint8)
    )
    return data, offsets - offsets[0]


#: Separators: ASCII white space.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
#: Separators: every ASCII character but letters and digits.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: A-Z to a-z, all else as it is.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def words(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the text that holds it."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~separators[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    begins[first] = inside[first]
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, _U)
    lengths = ends - starts
    table = _byte_weights(int(lengths.max()))
    begin = np.repeat(starts, lengths)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = (data[begin + place].astype(_U) + _U(1)) * table[place]
    return mix(np.add.reduceat(values, first) + lengths.astype(_U) * _U(0xD6E8FEB86659FD93))


def shingles(
    hashes: np.ndarray, owner: np.ndarray, count: int, size: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, and the offsets of the ``count`` texts.

    A text with fewer words than ``size`` has its whole sequence as one shingle; a text
    without a word has none.
    """
    factors = weights(size, 101)
    n = len(hashes)
    found, of = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    if n >= size:
        whole = owner[: n - size + 1] == owner[size - 1 :]
        total = np.zeros(n - size + 1, _U)
        for k in range(size):
            total += hashes[k : n - size + 1 + k] * factors[k]
        found.append(mix(total[whole]))
        of.append(owner[: n - size + 1][whole])
    per_text = np.bincount(owner, minlength=count)
    first = np.cumsum(per_text) - per_text
    for text in np.flatnonzero((per_text > 0) & (per_text < size)).tolist():
        k = int(per_text[text])
        part = hashes[first[text] : first[text] + k]
        length = np.array([k], _U) * _U(0xA0761D6478BD642F)
        found.append(mix(length + (part * factors[:k]).sum(dtype=_U)))
        of.append(np.array([text]))
    values, texts = np.concatenate(found), np.concatenate(of)
    order = np.lexsort((values, texts))
    values, texts = values[order], texts[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])
    values, texts = values[fresh], texts[fresh]
    return values, np.concatenate([[0], np.cumsum(np.bincount(texts, minlength=count))])


def batch_shingles(column: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles of each text of an Arrow column; A-Z are lower-cased."""
    data, offsets = text_buffer(column)
    data = LOWER[data]
    starts, ends, owner = words(data, offsets)
    return shingles(word_hashes(data, starts, ends), owner, len(column), size)
