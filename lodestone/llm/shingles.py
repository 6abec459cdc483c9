"""Sets of hashed five-word shingles, a batch of texts at a time, in numpy.

A word's hash is a polynomial of its bytes modulo 2^64, a shingle's one of its words' mixed hashes; both come
from running sums over the whole batch, so nothing is done word by word in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SIZE = 5
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text taken at a time; a longer text is taken alone, cut between words into pieces of about this size.
BLOCK = 1 << 20

_blank = np.zeros(256, bool)
_blank[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[0x41:0x5B] += 0x20
_random = np.random.default_rng(20240101).integers(1, 1 << 63, 256, np.uint64, endpoint=False) * np.uint64(2) + np.uint64(1)
_byte_value = _random[_lower]
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept for pieces of usual size only."""
    global _powers, _inverses
    if len(_powers) >= n:
        return _powers[:n], _inverses[:n]
    size = max(n, BLOCK + 1)
    step = np.full(size, _BASE, np.uint64)
    step[0] = 1
    powers = np.cumprod(step, dtype=np.uint64)
    step[1:] = _INVERSE
    inverses = np.cumprod(step, dtype=np.uint64)
    if size == BLOCK + 1:
        _powers, _inverses = powers, inverses
    return powers[:n], inverses[:n]


def word_hashes(data: np.ndarray, between: np.ndarray = _blank) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, start)`` of every word of ``data``, bytes in which those marked in ``between`` part words."""
    if len(data) <= BLOCK:
        return _piece(data, between)
    parts, at = [], 0
    while at < len(data):
        end = at + BLOCK
        while end < len(data) and not len(blank := np.flatnonzero(between[data[end:end + BLOCK]])):
            end += BLOCK  # a word of that length stays whole
        end = min(len(data), end + int(blank[0])) if end < len(data) else len(data)
        hashes, start = _piece(data[at:end], between)
        parts.append((hashes, start + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _piece(data: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inner = ~between[data]
    edge = np.diff(np.concatenate([[0], inner.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_value[data] * power[:-1], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64)), start


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; null texts and those without a word have none."""
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in texts], np.int64)
    at = 0
    while at < len(texts):
        end = at + 1
        total = sizes[at]
        while end < len(texts) and total + sizes[end] <= BLOCK:
            total += sizes[end]
            end += 1
        yield from _block([x.as_buffer() if x.is_valid else b"" for x in texts[at:end]])
        at = end


def _block(buffers: list) -> Iterator[np.ndarray]:
    data = np.frombuffer(b" ".join([bytes(b) for b in buffers]), np.uint8)
    if not len(data):
        for _ in buffers:
            yield np.zeros(0, np.uint64)
        return
    bounds = np.cumsum([len(b) + 1 for b in buffers])
    words, start = word_hashes(data)
    stop = np.searchsorted(start, bounds)
    n = max(0, len(words) - SIZE + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(SIZE):
        rolled = rolled * np.uint64(_BASE) + words[k:k + n]
    rolled = mix(rolled)
    first = 0
    for last in stop.tolist():
        if last - first >= SIZE:
            yield np.unique(rolled[first:last - SIZE + 1])
        elif last > first:  # the whole sequence as one
            value = np.zeros(1, np.uint64)
            for w in words[first:last]:
                value = value * np.uint64(_BASE) + w
            yield mix(value + np.uint64(last - first))
        else:
            yield np.zeros(0, np.uint64)
        first = last
