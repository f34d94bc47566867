"""Words and hashes of whole Arrow batches with numpy: no Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at once, unless one text is longer.
SLICE_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """splitmix64's finalizer over a uint64 array."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int, kept: dict = {}) -> np.ndarray:  # noqa: B006
    """base^0 ... base^n modulo 2^64; kept between calls."""
    if base not in kept or len(kept[base]) <= n:
        # Short texts, such as those at the driver, need no table for a whole slice.
        steps = np.full(1 << 16 if n < 1 << 16 else max(n, SLICE_BYTES) + 1, base, np.uint64)
        steps[0] = 1
        kept[base] = np.cumprod(steps)
    return kept[base]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about ``most`` bytes; null texts are empty. Copies nothing."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    if texts.null_count:
        texts = texts.fill_null("")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), len(texts), row + 65536)
        yield row, data[offsets[row] : offsets[end]], (offsets[row : end + 1] - offsets[row])
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row, start and end of each word; A-Z count as a-z, words are runs of bytes other than space, tab to carriage return."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    solid = np.ones(256, bool)
    solid[[32, *range(9, 14)]] = False
    inside = solid[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | first[1:])) + 1
    letters = mixed(np.arange(256, dtype=np.uint64), 7)[lower]  # a random number for each byte
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(letters[data] * _powers(n, _BASE)[:n], out=sums[1:])
    hashes = (sums[end] - sums[start]) * _powers(n, _INVERSE)[start]
    hashes = mixed(hashes + (end - start).astype(np.uint64))
    rows = np.searchsorted(offsets, start, "right") - 1
    return hashes, rows, start, end


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k words in a row, across rows too; k - 1 fewer than words."""
    n = len(hashes) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        for j in range(k):
            out = (out * np.uint64(_BASE)) + hashes[j : j + n]
        out = mixed(out, k)
    return out
