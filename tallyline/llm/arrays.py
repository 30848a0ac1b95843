"""Words and hashes of many texts at once, as NumPy arrays inside tasks.

Texts come as Arrow string arrays. They are worked on in pieces of about a quarter of a
megabyte, so that the memory of a task does not depend on how many texts a batch holds. A
word is a maximal run of bytes other than the six ASCII white-space characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 18
SHINGLE = 5

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def numbers(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit numbers; a longer call begins with the shorter one's."""
    start = np.uint64(seed * 0xD1B54A32D192ED03 % 2**64)
    return mixed((np.arange(1, n + 1, dtype=np.uint64) * _GOLDEN) + start) | np.uint64(1)


_BYTE = numbers(256, 1)
_PLACE = numbers(64, 2)
_WITHIN = numbers(SHINGLE, 3)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_IN_WORD = np.where(_SPACE, np.uint64(0), _BYTE)


class Words(NamedTuple):
    """Words of a piece: texts are rows ``first .. first + len(bounds) - 2`` of the batch.

    ``bounds[k] : bounds[k + 1]`` are the words of text k, ``start`` and ``end`` their
    byte ranges in ``data``, and ``edges`` the byte ranges of the texts.
    """

    first: int
    data: np.ndarray
    edges: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray


def strings(column: pa.Array) -> pa.Array:
    """The column as large strings with nulls as empty texts."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        return pc.fill_null(column.cast(pa.large_binary()), b"")
    return pc.fill_null(column.cast(pa.large_string()), "")


def pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, edges of its texts) for runs of texts of about PIECE_BYTES."""
    column = strings(column)
    if not len(column):
        return
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(edges, edges[at] + PIECE_BYTES, side="left"))
        to = min(max(to, at + 1), len(column))
        yield at, whole[edges[at] : edges[to]], edges[at : to + 1] - edges[at]
        at = to


def words(column: pa.Array, lower: bool = False, between: np.ndarray = _SPACE) -> Iterator[Words]:
    """Words of the texts; ``between`` flags the bytes that are not part of words."""
    for first, data, edges in pieces(column):
        if lower:
            data = _LOWER[data]
        inside = ~between[data]
        before = np.zeros(len(data) + 1, dtype=bool)
        before[1:] = inside
        begins = edges[:-1][edges[:-1] < len(data)]
        starts = inside & ~before[:-1]
        starts[begins] = inside[begins]
        ends = np.zeros(len(data) + 1, dtype=bool)
        ends[1:-1] = inside[:-1] & (~inside[1:] | starts[1:])
        if len(data):
            ends[-1] = inside[-1]
        start = np.flatnonzero(starts)
        end = np.flatnonzero(ends)
        yield Words(first, data, edges, start, end, np.searchsorted(start, edges))


def word_hashes(found: Words, between: np.ndarray = _SPACE) -> np.ndarray:
    """A 64-bit hash of each word: random numbers for its bytes, weighted by place."""
    values = _BYTE_IN_WORD if between is _SPACE else np.where(between, np.uint64(0), _BYTE)
    return run_hashes(values[found.data], found.start, found.end)


def run_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``values[start:end]``.

    Runs are disjoint, ascending and not empty; values between runs are zero.
    """
    global _PLACE
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    length = end - start
    reach = np.diff(start, append=len(values))
    if (most := int(reach.max())) > len(_PLACE):
        _PLACE = numbers(2 * most, 2)
    place = np.arange(start[0], len(values), dtype=np.int32)
    place -= np.repeat(start.astype(np.int32), reach)
    weight = _PLACE[place]
    weight *= values[start[0] :]
    sums = np.add.reduceat(weight, start - start[0])
    return mixed(sums + length.astype(np.uint64) * _GOLDEN)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` neighbours; shorter by size - 1 than the input."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    places = _WITHIN if size <= SHINGLE else numbers(size, 3)
    sums = hashes[:n] * places[0]
    for k in range(1, size):
        sums += hashes[k : k + n] * places[k]
    return mixed(sums)


def whole(hashes: np.ndarray) -> np.ndarray:
    """One hash of a sequence shorter than a shingle, as an array of one; none of none."""
    if not len(hashes):
        return np.zeros(0, dtype=np.uint64)
    sums = (hashes * numbers(len(hashes), 4)).sum(dtype=np.uint64)
    return mixed(np.array([sums + np.uint64(len(hashes))], dtype=np.uint64))


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text, words in lower-case A-Z.

    A text of fewer than SHINGLE words has its whole sequence as its one shingle, and a
    text without words has none.
    """
    for found in words(column, lower=True):
        hashes = word_hashes(found)
        runs = windows(hashes, SHINGLE)
        for k in range(len(found.edges) - 1):
            a, b = int(found.bounds[k]), int(found.bounds[k + 1])
            if b - a < SHINGLE:
                yield found.first + k, whole(hashes[a:b])
            else:
                yield found.first + k, np.unique(runs[a : b - SHINGLE + 1])


def lists(parts: list[np.ndarray]) -> pa.Array:
    """A list column of the bits of 64-bit numbers."""
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(flat)))


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's longs."""
    return np.ascontiguousarray(x, dtype=np.uint64).view(np.int64)
