"""Terms of many texts at once: exact codes for words, in bounded memory.

A term is a maximal run of bytes that a table allows, with A-Z in lower case. Texts of an
Arrow batch are worked on in slices of about ``arrays.PIECE_BYTES``. A longer text goes on over
several slices, cut between two terms, so that memory depends on the longest term and on the
distinct terms of a text, not on its length. Arrow's dictionary encoding gives equal terms,
and only those, one code.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyline.llm import arrays


def bytes_between(*kept: tuple[int, int]) -> np.ndarray:
    """A flag per byte that stands between terms; ``kept`` are ranges of ASCII bytes inside terms.

    Bytes from 0x80 on are parts of other characters and always inside.
    """
    between = np.zeros(256, dtype=bool)
    between[:0x80] = True
    for low, high in kept:
        between[low : high + 1] = False
    return between


DIGITS, UPPER, LOWER = (0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)


class Slice(NamedTuple):
    """Terms of rows ``first`` on: ``row`` and ``code`` of each term, in order, and the term of each code.

    ``goes_on`` says that the last row's text continues in the next slice.
    """

    first: int
    rows: int
    row: np.ndarray
    code: np.ndarray
    terms: pa.Array
    goes_on: bool


def cut(column: pa.Array, between: np.ndarray) -> Iterator[tuple[int, pa.Array, bool]]:
    """(first row, texts, whether the last one goes on) in slices; only a text alone in its slice goes on."""
    column = arrays.strings(column).cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(edges, edges[at] + arrays.PIECE_BYTES, side="right")) - 1
        if to > at:
            yield at, column[at:to], False
            at = to
            continue
        start, end = int(edges[at]), int(edges[at + 1])
        while start < end:
            stop = _place_between(whole, between, start + arrays.PIECE_BYTES, end)
            piece = pa.py_buffer(whole[start:stop])
            ends = pa.py_buffer(np.array([0, stop - start], dtype=np.int64))
            yield at, pa.Array.from_buffers(pa.large_binary(), 1, [None, ends, piece]), stop < end
            start = stop
        at += 1


def _place_between(whole: np.ndarray, between: np.ndarray, place: int, end: int) -> int:
    """The first place from ``place`` on that is not inside a term, or ``end``."""
    while place < end:
        found = np.flatnonzero(between[whole[place : min(place + 4096, end)]])
        if len(found):
            return place + int(found[0])
        place += 4096
    return end


def slices(column: pa.Array, between: np.ndarray) -> Iterator[Slice]:
    """The terms of all texts of a column; null texts have none."""
    for first, texts, goes_on in cut(column, between):
        _, offsets, data = texts.buffers()
        edges = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        low = int(edges[0])
        data = arrays._LOWER[np.frombuffer(data, dtype=np.uint8)[low : int(edges[-1])]] if data else np.zeros(0, np.uint8)
        edges = edges - low
        inside = ~between[data]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        begins = edges[:-1][edges[:-1] < len(data)]
        starts[begins] = inside[begins]
        start = np.flatnonzero(starts)
        letters = np.cumsum(inside, dtype=np.int64)
        ends = np.append(letters[start] - 1, letters[-1] if len(letters) else 0)
        found = pa.Array.from_buffers(
            pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])]
        ).dictionary_encode()
        row = np.searchsorted(edges, start, side="right") - 1
        yield Slice(first, len(texts), row, found.indices.to_numpy(), found.dictionary, goes_on)


def per_text(column: pa.Array, between: np.ndarray) -> Iterator[tuple[int, np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """(first row, row, term, occurrences, terms of each row with repeats), each term of a text once.

    ``row`` counts from the first row and ascends. A text of several slices is gathered
    before it is returned alone.
    """
    parts: list[Slice] = []
    for part in slices(column, between):
        if parts or part.goes_on:
            parts.append(part)
            if not part.goes_on:
                yield _gathered(parts)
                parts = []
            continue
        n = len(part.terms)
        keys, counts = np.unique(part.row * max(n, 1) + part.code, return_counts=True)
        row, code = np.divmod(keys, max(n, 1))
        yield part.first, row, part.terms.take(pa.array(code)), counts, np.bincount(part.row, minlength=part.rows)


def _gathered(parts: list[Slice]) -> tuple[int, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    counted = pa.concat_tables(
        pa.table({"term": p.terms, "n": np.bincount(p.code, minlength=len(p.terms))}) for p in parts
    )
    counted = counted.group_by("term").aggregate([("n", "sum")])
    total = np.array([sum(len(p.code) for p in parts)])
    terms = pc.cast(counted["term"].combine_chunks(), pa.large_binary())
    return parts[0].first, np.zeros(len(terms), np.int64), terms, counted["n_sum"].to_numpy(), total
