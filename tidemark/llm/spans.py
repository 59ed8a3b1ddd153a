"""Text columns as flat byte arrays: words, spans and their hashes without a Python step per word.

A block is some whole documents of one Arrow batch: their bytes in one array and the offsets where they start.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLOCK_BYTES = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
LONG_SPAN = 96

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` per block of about ``limit`` bytes; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, "right")) - 1)
        yield row, data[ends[row] : ends[last]], ends[row : last + 1] - ends[row]
        row = last


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of other bytes than separators, none across documents."""
    inside = ~separator[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def mixed(value: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit, in place."""
    value ^= value >> np.uint64(33)
    value *= np.uint64(0xFF51AFD7ED558CCD)
    value ^= value >> np.uint64(33)
    value *= np.uint64(0xC4CEB9FE1A85EC53)
    value ^= value >> np.uint64(33)
    return value


@lru_cache(4)
def _powers(base: int, bits: int) -> np.ndarray:
    steps = np.full(1 << bits, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def powers(base: int, count: int) -> np.ndarray:
    return _powers(base, max(16, (count - 1).bit_length()))[:count]


@lru_cache(1)
def byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running sums of value times power; the difference of two gives the hash of the span between them."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(MULTIPLIER, len(values)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes that depend on the bytes of each span, not on its place."""
    return mixed((sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts])


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` values, in order."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(values)
    return mixed((sums[width:] - sums[:-width]) * powers(INVERSE, len(sums) - width))


PRIME = [np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261,
)]  # fixed values of the XXH64 format


def _turn(value: np.ndarray, bits: int) -> np.ndarray:
    return (value << np.uint64(bits)) | (value >> np.uint64(64 - bits))


def _lane(value: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(value + lane * PRIME[1], 31) * PRIME[0]


def _same_length(data: np.ndarray, starts: np.ndarray, length: int, seed: int) -> np.ndarray:
    """XXH64 of spans of one length, lane by lane over all spans."""
    def read(at: int, kind: str) -> np.ndarray:
        size = np.dtype(kind).itemsize
        view = np.ndarray((len(data) - size + 1,), kind, data.data, strides=(1,))
        return view[starts + at].astype(np.uint64)

    seed_value = np.uint64(seed)
    at = 0
    if length >= 32:
        sums = [np.full(len(starts), start, np.uint64) for start in (
            seed_value + PRIME[0] + PRIME[1], seed_value + PRIME[1], seed_value, seed_value - PRIME[0]
        )]
        while at + 32 <= length:
            sums = [_lane(value, read(at + 8 * i, "<u8")) for i, value in enumerate(sums)]
            at += 32
        value = _turn(sums[0], 1) + _turn(sums[1], 7) + _turn(sums[2], 12) + _turn(sums[3], 18)
        for one in sums:
            value = (value ^ _lane(np.zeros_like(one), one)) * PRIME[0] + PRIME[3]
    else:
        value = np.full(len(starts), seed_value + PRIME[4], np.uint64)
    value = value + np.uint64(length)
    while at + 8 <= length:
        value = _turn(value ^ _lane(np.zeros_like(value), read(at, "<u8")), 27) * PRIME[0] + PRIME[3]
        at += 8
    if at + 4 <= length:
        value = _turn(value ^ (read(at, "<u4") * PRIME[0]), 23) * PRIME[1] + PRIME[2]
        at += 4
    while at < length:
        value = _turn(value ^ (read(at, "u1") * PRIME[4]), 11) * PRIME[0]
        at += 1
    value ^= value >> np.uint64(33)
    value *= PRIME[1]
    value ^= value >> np.uint64(29)
    value *= PRIME[2]
    value ^= value >> np.uint64(32)
    return value


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of every span; spans of one length are hashed together."""
    data = np.ascontiguousarray(data)
    lengths = ends - starts
    result = np.zeros(len(starts), np.uint64)
    order = np.argsort(np.minimum(lengths, LONG_SPAN).astype(np.uint8), kind="stable")
    ordered = lengths[order]
    bounds = np.searchsorted(ordered, np.arange(LONG_SPAN + 1))
    with np.errstate(over="ignore"):
        for length in range(LONG_SPAN):
            group = order[bounds[length] : bounds[length + 1]]
            if len(group):
                result[group] = _same_length(data, starts[group], length, seed)
    for i in order[bounds[LONG_SPAN] :].tolist():
        result[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return result
