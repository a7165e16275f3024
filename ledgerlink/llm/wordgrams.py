"""Hashes of words and of runs of words, for whole Arrow batches at a time (numpy inside Spark tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text handled at once inside a task; a longer text is handled alone, whole.
CHUNK_BYTES = 1 << 18

_RANDOM = np.random.default_rng(20240613)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _GRAM = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of words: all but white space (a byte above 127 is part of a character above 127).
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words: digits, a-z, and every character above 127.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int, name: str) -> np.ndarray:
    """base ** 0 .. n-1, modulo 2 ** 64."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 4 * CHUNK_BYTES:
            _powers[name] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 64-bit integers that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the bounds of its rows; null counts as empty."""
    a = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = a.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[a.offset:a.offset + len(a) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of runs of whole rows of about CHUNK_BYTES."""
    data, bounds = text_buffer(column)
    row = 0
    while row < len(bounds) - 1:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + CHUNK_BYTES, "right")) - 1)
        yield row, end, data[bounds[row]:bounds[end]], bounds[row:end + 1] - bounds[row]
        row = end


def word_hashes(data: np.ndarray, bounds: np.ndarray, of_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, A-Z lower-cased; first word of each row, and the number of words at the end)."""
    low = _LOWER[data]
    inside = of_word[low]
    before, after = np.roll(inside, 1), np.roll(inside, -1)
    edges = bounds[:-1][np.diff(bounds) > 0]
    before[edges] = False
    after[edges - 1] = False  # the byte before a row's first byte is the last of the row before
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(low) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[low] * _power(_BASE, len(low), "base"), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(low), "inverse")[starts] if len(starts) else np.empty(0, np.uint64))
    return hashes, np.searchsorted(starts, bounds)


def gram_hashes(words: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the k words from each place, True where they all lie in one row), by place."""
    n = max(0, len(words) - k + 1)
    out = np.full(n, np.uint64(k), dtype=np.uint64)
    for j in range(k):
        out = out * _GRAM + words[j:j + n]
    row_end = np.repeat(rows[1:], np.diff(rows))[:n]
    return mix(out), np.arange(n) + k <= row_end
