"""Numbers of many texts dealt out in blocks, and links between passages aligned at a seed.

Tables of 64-bit numbers go through a shuffle as blocks: a row holds the numbers of one kind
that a task found for one partition. What a task does with its partition is NumPy. A block holds
equal numbers once, so that copies do not pile up where they are dealt to.

Aligned passages have one seed at one place. They are compared with the first of their group,
the ones that are not like it with the first of these, and so on; of groups that
still hold several families, those pairs of different families are compared whose sketches allow
a link, in large groups those that also share one of their rarest shingles, without which there is none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyline.llm import arrays

BLOCK = "part int, kind int, block binary"
# Numbers that a task gathers before it hands blocks on.
GATHERED = 1 << 21

ROUNDS = 64
# Rows of a group beyond which only those that share a rare shingle are paired, and pairs at a time.
LARGE = 64
PAIRS = 1 << 14

Reduce = Callable[[np.ndarray], np.ndarray]


def _sorted(table: np.ndarray) -> np.ndarray:
    """By the first number, which mostly tells, and then by the others."""
    table = table[np.argsort(table[:, 0])]
    equal = table[1:, 0] == table[:-1, 0]
    tied = np.flatnonzero(np.append(False, equal) | np.append(equal, False)) if len(table) else equal
    table[tied] = table[tied[np.lexsort(table[tied].T[::-1])]]
    return table


def _changes(table: np.ndarray) -> np.ndarray:
    """Flags of the rows that differ from the one before."""
    new = np.ones(len(table), dtype=bool)
    new[1:] = (table[1:] != table[:-1]).any(axis=1)
    return new


def distinct(table: np.ndarray) -> np.ndarray:
    """The different rows, sorted."""
    table = _sorted(table)
    return table[_changes(table)]


def ends(table: np.ndarray) -> np.ndarray:
    """Sorted; of rows that differ in the last number only, the first and the last one."""
    table = distinct(table)
    new = _changes(table[:, :-1])
    return table[new | np.append(new[1:], True)]


def blocks(found: Iterator[dict[int, np.ndarray]], parts: int, reduced: dict[int, Reduce]) -> Iterator[pa.RecordBatch]:
    """Blocks of tables by kind; a row goes to the partition of its first number."""
    gathered, n = {kind: [] for kind in reduced}, 0

    def handed_on() -> pa.RecordBatch:
        part, kinds, out = [], [], []
        for kind, tables in gathered.items():
            if not tables:
                continue
            table = reduced[kind](np.concatenate(tables))
            to = (arrays.mixed(table[:, 0]) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            table, bounds = table[order], np.searchsorted(to[order], np.arange(parts + 1))
            for k in np.flatnonzero(np.diff(bounds)):
                part.append(k)
                kinds.append(kind)
                out.append(np.ascontiguousarray(table[bounds[k] : bounds[k + 1]]).tobytes())
            tables.clear()
        columns = [pa.array(part, pa.int32()), pa.array(kinds, pa.int32()), pa.array(out, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["part", "kind", "block"])

    for tables in found:
        for kind, table in tables.items():
            if len(table):
                gathered[kind].append(table)
                n += table.size
        if n >= GATHERED:
            yield handed_on()
            n = 0
    if n:
        yield handed_on()


def dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Blocks by their partition."""
    return rows.repartitionById(parts, "part").select("kind", "block")


def tables(batches: Iterator[pa.RecordBatch], widths: dict[int, int]) -> dict[int, np.ndarray]:
    """The tables by kind of all blocks of a partition."""
    found = {kind: [] for kind in widths}
    for batch in batches:
        for kind, block in zip(batch.column(0).to_pylist(), batch.column(1)):
            found[kind].append(np.frombuffer(block.as_buffer(), dtype=np.uint64).reshape(-1, widths[kind]))
    return {k: np.concatenate(v) if v else np.zeros((0, widths[k]), np.uint64) for k, v in found.items()}


class Passages:
    """Distinct shingles of passages, a row each; a repeated shingle gives way to a number of its own."""

    def __init__(self, shingles: np.ndarray, words: int = 4):
        order = np.argsort(shingles, axis=1, kind="stable")
        ordered = np.take_along_axis(shingles, order, axis=1)
        row, at = np.nonzero(ordered[:, 1:] == ordered[:, :-1])
        self.repeats = np.zeros(shingles.shape, dtype=bool)
        self.repeats[row, order[row, at + 1]] = True
        self.sets = shingles.copy()
        self.sets[self.repeats] = arrays.mixed(np.flatnonzero(self.repeats).astype(np.uint64) | np.uint64(1 << 60))
        self.n = shingles.shape[1] - self.repeats.sum(axis=1)
        self.sketches = np.concatenate([self._sketches(at, words) for at in range(0, len(shingles), PAIRS)])

    def _sketches(self, at: int, words: int) -> np.ndarray:
        """Parities of hashed bits of the shingles of some rows."""
        values, repeats = self.sets[at : at + PAIRS], self.repeats[at : at + PAIRS]
        bit = np.where(repeats, np.uint64(0), np.uint64(1) << (values & np.uint64(63)))
        word = (values >> np.uint64(6)) % np.uint64(words)
        parts = [np.bitwise_xor.reduce(np.where(word == k, bit, np.uint64(0)), axis=1) for k in range(words)]
        return np.stack(parts, axis=1)

    def linked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Flags of the pairs at a Jaccard similarity of 0.75 or more."""
        return np.concatenate([self._linked(a[k : k + PAIRS], b[k : k + PAIRS]) for k in range(0, max(1, len(a)), PAIRS)])

    def _linked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = self.n[a] + self.n[b]
        bits = np.bitwise_count(self.sketches[a] ^ self.sketches[b]).sum(axis=1, dtype=np.int64)
        out = 7 * bits <= total
        near = np.flatnonzero(out)
        a, b, least = a[near], b[near], 3 * total[near]
        # shingles equal at the same places are common ones, often enough of them
        good = 7 * (self.sets[a] == self.sets[b]).sum(axis=1) >= least
        rest = np.flatnonzero(~good)
        both = np.sort(np.concatenate([self.sets[a[rest]], self.sets[b[rest]]], axis=1), axis=1)
        good[rest] = 7 * (both[:, 1:] == both[:, :-1]).sum(axis=1) >= least[rest]
        out[near] = good
        return out


def _families(group: np.ndarray, passages: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first of each row's family, and links (a, b) with it; groups are sorted."""
    star, rest = np.arange(len(group)), np.arange(len(group))
    a, b = [rest[:0]], [rest[:0]]
    for _ in range(ROUNDS):
        if not len(rest):
            break
        new = np.append(True, group[rest][1:] != group[rest][:-1])
        center = rest[new][np.cumsum(new) - 1]
        rest, center = rest[~new], center[~new]
        good = passages.linked(rest, center)
        star[rest[good]] = center[good]
        a.append(rest[good])
        b.append(center[good])
        rest = rest[~good]
    return star, np.concatenate(a), np.concatenate(b)


def _pairs(bucket: np.ndarray, star: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (a, b) of rows of one bucket and different families; sorted by both."""
    if not len(bucket):
        return
    n = np.arange(len(bucket))
    new = np.append(True, bucket[1:] != bucket[:-1])
    end = np.append(n[new], len(n))[np.cumsum(new)]
    new[1:] |= star[1:] != star[:-1]
    other = np.append(n[new], len(n))[np.cumsum(new)]
    while len(n := n[other[n] < end[n]]):
        yield n, other[n]
        other[n] += 1


def _by_rare_shingles(group: np.ndarray, rows: np.ndarray, passages: Passages) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row): of each row its rarest shingles in the group, so many that a link has one of them in common."""
    n = passages.n[rows]
    prefix = n - -(-3 * n // 4) + 1
    keys = arrays.mixed(passages.sets[rows] ^ arrays.mixed(group[rows])[:, None])
    _, of, count = np.unique(keys, return_inverse=True, return_counts=True)
    # by number of rows, then by one order of all shingles; numbers of repeats come last
    rank = np.empty(len(count), dtype=np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    rank = rank[of.reshape(keys.shape)]
    rank[passages.repeats[rows]] += len(count)
    rarest = np.sort(rank, axis=1)
    return rarest[np.arange(rank.shape[1]) < prefix[:, None]], np.repeat(rows, prefix)


class Joined:
    """Families that links have joined."""

    def __init__(self, star: np.ndarray):
        self.name = np.arange(len(star))[star]

    def add(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Flags of the links (a, b) that join two families, one after the other."""
        to: dict[int, int] = {}

        def named(x: int) -> int:
            while x in to:
                x = to[x]
            return x

        new = np.zeros(len(a), dtype=bool)
        for k, (x, y) in enumerate(zip(self.name[a].tolist(), self.name[b].tolist())):
            x, y = named(x), named(y)
            if x != y:
                to[max(x, y)], new[k] = min(x, y), True
        if to:
            names = np.arange(len(self.name))
            names[list(to)] = [named(x) for x in to]
            self.name = names[self.name]
        return new


def links(group: np.ndarray, uid: np.ndarray, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Uids (a, b) of links that join what belongs together in each group of aligned passages."""
    if not len(group):
        return uid, uid
    order = np.lexsort((uid, group))
    group, uid, passages = group[order], uid[order], Passages(shingles[order])
    star, a, b = _families(group, passages)
    new = np.append(True, group[1:] != group[:-1])
    number, first = np.cumsum(new) - 1, np.flatnonzero(new)
    several = np.maximum.reduceat(star, first) != np.minimum.reduceat(star, first)
    rows = np.flatnonzero(several[number])
    large = np.bincount(number)[number[rows]] > LARGE
    buckets = [(number[rows[~large]], rows[~large])]
    if large.any():
        buckets.append(_by_rare_shingles(group, rows[large], passages))
    joined, a, b = Joined(star), [a], [b]
    for bucket, of in buckets:
        order = np.lexsort((star[of], bucket))
        bucket, of = bucket[order], of[order]
        for x, y in _pairs(bucket, star[of]):
            x, y = of[x], of[y]
            apart = joined.name[x] != joined.name[y]
            x, y = x[apart], y[apart]
            good = passages.linked(x, y)
            x, y = x[good], y[good]
            if len(x):
                new = joined.add(x, y)
                a.append(x[new])
                b.append(y[new])
    a, b = np.concatenate(a), np.concatenate(b)
    return uid[a], uid[b]
