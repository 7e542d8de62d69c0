"""Words, their hash values and word shingles of Arrow batches of texts, in numpy.

Words are runs of bytes other than ASCII white space, with A-Z in lower case.  Equal words have equal
64-bit values on every machine.  Null and empty texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
#: Bytes of text that are worked on at once; a longer text is taken alone.
SLICE_BYTES = 4 << 20

_U = np.uint64


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of splitmix64)."""
    x = x + _U((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = np.arange(256, dtype=np.uint8)
_SPACE = np.isin(_BYTES, np.frombuffer(b" \t\n\v\f\r", np.uint8))
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint64)
_VALUE = np.where(_SPACE, _U(0), mixed(_LOWER, 11))
_BASE = _U(0xD6E8FEB86659FD93)
_powers = np.ones(1, np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([[_U(1)], np.full(max(n, 4096) - 1, _BASE)]).astype(np.uint64))
    return _powers


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, offsets, bytes) of runs of texts of about SLICE_BYTES."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, "right")) - 1
        end = min(max(end, start + 1), len(texts))
        yield start, end, offsets[start : end + 1] - offsets[start], data[offsets[start] : offsets[end]]
        start = end


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of each text's first word, with the total last; value of each word)."""
    if not len(data):
        return np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64)
    reach = np.diff(starts, append=len(data))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, reach)
    value = _VALUE[data[starts[0] :]] * _power_table(int(reach.max()) + 1)[place]
    return np.searchsorted(starts, offsets), mixed(np.add.reduceat(value, starts - starts[0]))


def shingle_sets(ends: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """The sorted set of each text's 5-word shingles; of a shorter text, its whole word sequence."""
    n = len(values)
    whole = np.zeros(max(n - SHINGLE + 1, 0), np.uint64)
    for k in range(SHINGLE):
        whole = whole * _BASE + values[k : k + len(whole)]
    whole = mixed(whole, 1)
    sets = []
    for a, b in zip(ends[:-1], ends[1:]):
        if b - a >= SHINGLE:
            sets.append(np.unique(whole[a : b - SHINGLE + 1]))
        else:
            short = np.full(min(b - a, 1), b - a, np.uint64)
            for k in range(a, b):
                short = short * _BASE + values[k]
            sets.append(mixed(short, 2))
    return sets
