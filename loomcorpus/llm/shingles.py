"""Vectorised word and shingle hashing over Arrow string columns.

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D`` after A-Z were lower-cased, so
the non-ASCII bytes of UTF-8 always belong to words. Everything is computed with numpy over
chunks of concatenated texts; no Python statement runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK_BYTES = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int, name: str) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < n:
        steps = np.full(max(n, 2 * _CHUNK_BYTES), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[name] = np.multiply.accumulate(steps)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (two multiply-xorshift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start offset of every word of one lower-cased byte buffer."""
    space = _SPACE[buffer]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    n = len(buffer)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n, "up"), out=sums[1:])
    values = (sums[ends] - sums[starts]) * _power(_INVERSE, n, "down")[starts]
    return mix(values + (ends - starts).astype(np.uint64)), starts


def chunks(texts: pa.Array, lower: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split a string column into row ranges of some MB: ``(first, last, bytes, row starts)``.

    Rows are set apart by a newline, so no word crosses rows. Nulls count as empty.
    """
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _CHUNK_BYTES, "right")) - 1)
        last = min(last, len(texts))
        low, lengths = offsets[first], np.diff(offsets[first : last + 1])
        size = int(offsets[last] - low)
        buffer = np.full(size + (last - first), 0x0A, dtype=np.uint8)
        rows = np.repeat(np.arange(last - first), lengths)
        part = data[low : low + size]
        buffer[np.arange(size) + rows] = _LOWER[part] if lower else part
        yield first, last, buffer, (offsets[first:last] - low) + np.arange(last - first)
        first = last


def shingle_sets(texts: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct ``width``-word shingle hashes of each text (uint64).

    A text of fewer words gives its whole word sequence as one shingle; one without words, or
    null, gives an empty array.
    """
    for first, last, buffer, row_starts in chunks(texts):
        words, at = word_hashes(buffer)
        bounds = np.append(np.searchsorted(at, row_starts), len(words))
        weights = _power(_BASE, width + 1, "up")
        full = max(0, len(words) - width + 1)
        grams = np.zeros(full, dtype=np.uint64)
        for i in range(width if full else 0):
            grams += words[i : i + full] * weights[i + 1]
        grams = mix(grams + np.uint64(width))
        for row in range(last - first):
            low, high = bounds[row], bounds[row + 1]
            if high - low >= width:
                yield np.unique(grams[low : high - width + 1])
            elif high > low:
                short = words[low:high]
                value = (short * weights[1 : len(short) + 1]).sum(dtype=np.uint64) + np.uint64(len(short))
                yield mix(np.array([value], dtype=np.uint64))
            else:
                yield np.empty(0, np.uint64)
