"""Vectorised word splitting and hashing of whole texts, shared by the operators of this package.

Work goes over slices of an Arrow column, so memory is bounded by the slice (or by the
one longest text, which is never cut).
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# Byte classes. Every byte of a multi-byte UTF-8 character is 0x80 or more.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[32, *range(9, 14)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

PIECE = 1 << 18  # values hashed at a time


@functools.lru_cache(1)
def _small_powers() -> tuple[np.ndarray, np.ndarray]:
    return _made_powers(2 * PIECE)


def _made_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    made = []
    for base in (MULTIPLIER, INVERSE):
        table = np.full(n, base, np.uint64)
        table[0] = 1
        np.cumprod(table, out=table)
        made.append(table)
    return made[0], made[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """MULTIPLIER**i and INVERSE**i for i < n, modulo 2**64; only a small table stays in the worker."""
    if n <= 2 * PIECE:
        forward, back = _small_powers()
        return forward[:n], back[:n]
    return _made_powers(n)


def mix(h: np.ndarray) -> np.ndarray:
    """Final scrambling of 64-bit values, so that every bit can be used."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of about ``limit`` bytes; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    start = 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(n, max(stop, start + 1))
        yield start, stop, data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def split_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Starts and ends (bytes) of the runs of word bytes; a run ends with its text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    before, after = inside[:-2].copy(), inside[2:].copy()
    full = offsets[:-1] < offsets[1:]
    before[offsets[:-1][full]] = False
    after[offsets[1:][full] - 1] = False
    inside = inside[1:-1]
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``values[start:end]``; equal spans get equal hashes wherever they stand.

    Starts ascend. Spans are hashed in pieces of about ``PIECE`` values, or of one longer span.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        to = int(np.searchsorted(starts, low + PIECE, "left"))
        high = int(ends[at:to].max())
        power, inverse = powers(high - low + 1)
        prefix = np.zeros(high - low + 1, np.uint64)
        np.cumsum((values[low:high].astype(np.uint64) + np.uint64(1)) * power[:-1], out=prefix[1:])
        out[at:to] = mix((prefix[ends[at:to] - low] - prefix[starts[at:to] - low]) * inverse[starts[at:to] - low])
        at = to
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Hashes of lower-cased words, their byte starts and ends, and the first word of each text.

    The last result has one entry more than there are texts.
    """
    low = LOWER[data]
    starts, ends = split_words(low, offsets, is_word)
    return span_hashes(low, starts, ends), starts, ends, np.searchsorted(starts, offsets)


def release() -> None:
    """Give memory back that Python, Arrow and the C library hold for later use."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def frugal(run, *caches):
    """``run`` over batches; a worker that has ended its partition holds no more than before, as many workers may wait.

    ``caches`` are emptied at the end too.
    """

    def bounded(batches):
        try:
            yield from run(batches)
        finally:
            for cache in caches:
                cache.cache_clear()
            release()

    return bounded


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ``range(start, start + length)`` of every pair."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.cumsum(lengths) - lengths
    return np.repeat(starts - shift, lengths) + np.arange(total)


def with_columns(batch: pa.RecordBatch, keep: list[str], columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The named columns of ``batch`` followed by new ones."""
    return pa.RecordBatch.from_arrays(
        [batch.column(batch.schema.get_field_index(c)) for c in keep] + list(columns.values()),
        names=[*keep, *columns],
    )
