"""Small array helpers for work inside tasks: batches, ragged gathers, rolling hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TASK_BYTES = 16 << 20
#: Values that the rolling functions take at a time, so that what they write in between stays in a core's cache.
CHUNK = 1 << 14


def text_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = TASK_BYTES) -> Iterator[pa.Table]:
    """The rows of ``batches`` in tables of about ``most`` bytes of ``column`` (one row at least)."""
    held, size = [], 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        lengths = pc.fill_null(pc.binary_length(table[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths)
        start = 0
        while start < table.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most - size, side="right")))
            if held and size + ends[min(stop, len(ends)) - 1] - before > most:
                yield pa.concat_tables(held)
                held, size = [], 0
                continue
            held.append(table.slice(start, stop - start))
            size += int(ends[stop - 1] - before)
            start = stop
            if size >= most:
                yield pa.concat_tables(held)
                held, size = [], 0
    if held:
        yield pa.concat_tables(held)


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Offsets with a leading 0: ``starts_of([2, 3]) == [0, 2, 5]``."""
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))


def gather(flat: np.ndarray, starts: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``flat[starts[i]:starts[i + 1]]`` for each i of ``index``, joined, and their lengths."""
    lengths = (starts[1:] - starts[:-1])[index]
    begin = starts_of(lengths)
    kind = np.int32 if max(len(flat), begin[-1]) < 2**31 else np.int64
    places = np.repeat((starts[:-1][index] - begin[:-1]).astype(kind), lengths)
    places += np.arange(begin[-1], dtype=kind)
    return flat[places], lengths


def segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments of ``values``; an empty segment sums to 0."""
    total = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def binary_column(flat: np.ndarray, starts: np.ndarray) -> pa.Array:
    """A column of binary values that are consecutive pieces of the bytes of ``flat``."""
    width = flat.dtype.itemsize
    offsets = np.asarray(starts, dtype=np.int64) * width
    if offsets[-1] >= 2**31:
        return pa.array([flat[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])], pa.large_binary())
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))]
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, buffers)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    result = np.array(values, np.uint64, order="C")
    flat = result.reshape(-1)
    for k in range(0, len(flat), CHUNK):
        own = flat[k : k + CHUNK]
        own ^= own >> np.uint64(33)
        own *= np.uint64(0xFF51AFD7ED558CCD)
        own ^= own >> np.uint64(33)
        own *= np.uint64(0xC4CEB9FE1A85EC53)
        own ^= own >> np.uint64(33)
    return result


BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache(maxsize=8)
def powers(base: int, count: int) -> np.ndarray:
    """``base ** k`` for each k below ``count`` (64-bit, wrapping)."""
    factors = np.full(count, base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def window_hashes(values: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """Polynomial hash of each run of ``width`` values (64-bit, wrapping); ``base`` is odd.

    Value j of a run counts ``base ** (width - 1 - j)``. An odd base has an inverse, so running
    sums of ``values[k] * base ** -k`` give every run as a difference times a power. Gives
    ``len(values) - width + 1`` hashes.
    """
    if len(values) < width:
        return np.zeros(0, np.uint64)
    result = np.empty(len(values) - width + 1, np.uint64)
    size = CHUNK * (2 + width // CHUNK)
    up, down = powers(base, size), powers(pow(base, -1, 2**64), size)
    sums = np.zeros(CHUNK + width, np.uint64)
    for k in range(0, len(result), CHUNK):
        own = values[k : k + CHUNK + width - 1].astype(np.uint64)
        own *= down[: len(own)]
        np.cumsum(own, out=sums[1 : len(own) + 1])
        count = len(own) - width + 1
        np.subtract(sums[width : len(own) + 1], sums[:count], out=result[k : k + count])
        result[k : k + count] *= up[width - 1 : width - 1 + count]
    return result


def window_minima(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """Minimum (or maximum) of each run of ``width`` values, by doubling."""
    size, block = 1, values
    while size * 2 <= width:
        block = pick(block[:-size], block[size:])
        size *= 2
    if size < width:
        rest = width - size
        block = pick(block[: len(block) - rest], block[rest:])
    return block


def anchors(hashes: np.ndarray, valid: np.ndarray, width: int) -> np.ndarray:
    """Places whose hash is the least of some valid window of ``width`` consecutive hashes.

    Equal windows have equal anchors, which is what makes them meet. ``valid`` says which
    windows count. Ties are all anchors.
    """
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    windows, found = len(hashes) - width + 1, []
    for start in range(0, len(hashes), CHUNK):
        own = hashes[start : start + CHUNK]
        # windows that hold one of these places; before the first and behind the last there are none
        low, high = max(0, start - width + 1), min(windows, start + len(own))
        lowest = np.zeros(len(own) + width - 1, hashes.dtype)
        lowest[low - start + width - 1 : high - start + width - 1] = np.where(
            valid[low:high], window_minima(hashes[low : high + width - 1], width), 0
        )
        reach = window_minima(lowest, width, np.maximum)
        found.append(np.flatnonzero((reach == own) & (reach > 0)) + start)
    return np.concatenate(found)
