"""Repeated paragraphs and passages of documents, with one occurrence of each to stay.

Paragraphs are compared in two shapes. A natural paragraph is a line, or a block of several
lines between blank ones, of at least a shingle's words: MinHash bands, tuned for recall at
the similarity that counts, bring near-equal ones together, exact Jaccard similarity verifies
them, and components of the links are the clusters. A passage inside a line has no borders of its own; so windows of
``LEAST_WORDS`` words are taken as paragraphs as well, beginning where the hash of a shingle
is the least of REACH neighbours. Equal passages choose equal beginnings, and every passage
of LEAST_WORDS + REACH - 1 = 50 words holds at least one whole window, wherever it stands.

Passages that repeat with changes are compared at seeds: shingles with the least hash of
SEED_REACH neighbours, which two texts share where SEED_REACH + SHINGLE - 1 = 20 words are
unchanged. Around a seed that another text has too, passages of PASSAGE_WORDS words are laid
with the seed at each of PLACES, so that one of them lies inside any repeated passage of 65
words around the seed. Those with the same seed at the same place are aligned, and are joined
and verified as lines are. A seed whose surroundings are the same wherever it stands has no
passages, as all of them are equal.

The texts are gone through six times, and what is found is told from the rest as early as can
be. First, 64-bit numbers alone are dealt out in blocks: of paragraphs and their rows, of bands
and their lines, of seeds and their surroundings. That tells which of them are shared. Then
sketches are worked out of the lines that share a band, shingles of those whose
sketches allow a link, and of one of each of the surroundings of a seed that has several, whose passages are compared in the task that gets the
seed. The last pass gives the places of those that have a cluster. Tables are deleted when they
have been read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import aligned, arrays
from tallyline.llm.clusters import components_by_some_rounds, linked_by_stars
from tallyline.llm.filters import Picker
from tallyline.llm.storing import free, stored

LEAST_WORDS = 25
REACH = 26
SIMILARITY = 0.75
RECALL = 1 - 1e-6
ROWS = 2

# Words of the bit sketch of a line's shingles, which bounds its difference from others.
SKETCH_WORDS = 4

# Words of a passage that may have changes, where its seed stands in it, and the reach of a seed.
PASSAGE_WORDS = 50
PLACES = (0, 15, 30, 45)
SEED_REACH = 16

LINE, WINDOW, BLOCK, PASSAGE = 0, 1, 2, 3
KINDS = {LINE: "line", WINDOW: "window", BLOCK: "block", PASSAGE: "passage"}

# Kinds of blocks, the numbers of their rows, and what stays of equal ones.
LINES, WINDOWS, BANDS, SEEDS = range(4)
WIDTHS = {LINES: 2, WINDOWS: 2, BANDS: 2, SEEDS: 3}
REDUCED = {LINES: aligned.ends, WINDOWS: aligned.ends, BANDS: aligned.distinct, SEEDS: aligned.ends}

# Words on either side of a seed's first that its passages reach, and their shingles.
BEFORE = max(PLACES)
AROUND = BEFORE + PASSAGE_WORDS - arrays.SHINGLE + 1
# A row has the seed, a hash of the surroundings, the uids of the passages (0: none), and the shingles.
STRETCH = 2 + len(PLACES) + AROUND

SHARED = "kind int, a long, b long"
TRAITS_ROW = "uid long, n_shingles int, sketch array<long>"
SET_ROW = "uid long, shingles array<long>"
PLACE_ROW = "row long, doc_id long, kind int, start long, n_words long, uid long, part long"


@cache
def tuned_bands(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> int:
    """The least number of bands of ``rows`` hashes that agree in one with probability ``recall``."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))


@cache
def _functions() -> np.ndarray:
    return arrays.numbers(ROWS * tuned_bands(), 11)


def _by_line(values: np.ndarray, line: np.ndarray, lines: int) -> tuple[np.ndarray, np.ndarray]:
    """Both sorted by line, then by value: by one number made of the line and the value's first bits if these tell."""
    bits = max(1, (lines - 1).bit_length())
    joint = line.astype(np.uint64) << np.uint64(64 - bits) | values >> np.uint64(bits)
    order = np.argsort(joint)
    joint, ordered = joint[order], values[order]
    if np.any((joint[1:] == joint[:-1]) & (ordered[1:] != ordered[:-1])):
        order = np.lexsort((values, line))
    return values[order], line[order]


class Sets:
    """The distinct shingles of the lines of a piece: ``values[bounds[k] : bounds[k + 1]]`` of line k, sorted."""

    def __init__(self, runs: np.ndarray, first: np.ndarray, end: np.ndarray):
        length = end - first - arrays.SHINGLE + 1
        line = np.repeat(np.arange(len(first)), length)
        place = np.arange(len(line)) - np.repeat(np.cumsum(length) - length, length)
        values = runs[first[line] + place]
        values, line = _by_line(values, line, len(first))
        new = np.ones(len(values), dtype=bool)
        new[1:] = (values[1:] != values[:-1]) | (line[1:] != line[:-1])
        self.values, self.line = values[new], line[new]
        self.bounds = np.searchsorted(self.line, np.arange(len(first) + 1))

    def band_keys(self) -> np.ndarray:
        """A row of band keys for each line: least hashes, ROWS of them to a band."""
        n = len(self.bounds) - 1
        if not n:
            return np.zeros((0, tuned_bands()), dtype=np.uint64)
        least = np.stack(
            [np.minimum.reduceat(self.values * f, self.bounds[:-1]) for f in _functions()], axis=1
        ).reshape(n, -1, ROWS)
        salt = arrays.numbers(least.shape[1], 12)
        return arrays.mixed((least * arrays.numbers(ROWS, 13)).sum(axis=2, dtype=np.uint64) ^ salt)

    def sketches(self) -> np.ndarray:
        """A row of SKETCH_WORDS words for each line: parities of hashed bits."""
        n, bits = len(self.bounds) - 1, 64 * SKETCH_WORDS
        place = arrays.mixed(self.values ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(bits - 1)
        parity = np.bincount(self.line * bits + place.astype(np.int64), minlength=n * bits).astype(np.uint8) & 1
        return np.packbits(parity, bitorder="little").view(np.uint64).reshape(n, SKETCH_WORDS)


def natural_ranges(found: arrays.Words) -> np.ndarray:
    """(text, first word, end, kind) of the lines, and of the blocks of several lines, with a shingle or more."""
    breaks = np.searchsorted(found.start, np.flatnonzero(found.data == 0x0A))
    # two line breaks without a word between them
    blank = breaks[1:][breaks[1:] == breaks[:-1]]
    lines = np.unique(np.concatenate([breaks, found.bounds]))
    blocks = np.unique(np.concatenate([blank, found.bounds]))
    several = np.diff(np.searchsorted(lines, blocks)) > 1
    first = np.concatenate([lines[:-1], blocks[:-1][several]])
    end = np.concatenate([lines[1:], blocks[1:][several]])
    kind = np.repeat([LINE, BLOCK], [len(lines) - 1, int(several.sum())])
    text = np.searchsorted(found.bounds, first, side="right") - 1
    return np.stack([text, first, end, kind], axis=1)[end - first >= arrays.SHINGLE]


def window_starts(shingles: np.ndarray) -> np.ndarray:
    """Places of a text, given its shingles, where windows of LEAST_WORDS words begin."""
    places = len(shingles) - (LEAST_WORDS - arrays.SHINGLE)
    if places <= 0:
        return np.zeros(0, dtype=np.int64)
    return _minima(shingles[:places], REACH)


def _minima(values: np.ndarray, reach: int) -> np.ndarray:
    """Places that hold the least value of some ``reach`` neighbours."""
    if len(values) <= reach:
        return np.array([int(values.argmin())])
    least = np.lib.stride_tricks.sliding_window_view(values, reach).argmin(axis=1)
    return np.unique(least + np.arange(len(least)))


def _sliding(values: np.ndarray, reach: int, least) -> np.ndarray:
    """The least (or greatest) of each ``reach`` neighbours."""
    size = 1
    while size < reach:
        step = min(size, reach - size)
        values, size = least(values[:-step], values[step:]), size + step
    return values


def minima(values: np.ndarray, first: np.ndarray, end: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and place of the least values of some ``reach`` neighbours in each text, of equal ones the first."""
    one_by_one = (first < end) & (end - first < reach)
    texts, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    whole = np.flatnonzero(end - first >= reach)
    if len(whole):
        least = _sliding(values, reach, np.minimum)
        inside = np.zeros(len(least) + 1, dtype=np.int64)
        inside[first[whole]] += 1
        inside[end[whole] - reach + 1] -= 1
        least[np.cumsum(inside[:-1]) == 0] = 0
        none = np.zeros(reach - 1, dtype=np.uint64)
        place = np.flatnonzero(_sliding(np.concatenate([none, least, none]), reach, np.maximum) == values)
        text = np.searchsorted(first, place, side="right") - 1
        equal = (values[place[1:]] == values[place[:-1]]) & (np.diff(place) < reach) & (text[1:] == text[:-1])
        one_by_one[text[1:][equal]] = True
        kept = ~one_by_one[text]
        texts.append(text[kept])
        places.append(place[kept])
    for k in np.flatnonzero(one_by_one):
        places.append(first[k] + _minima(values[first[k] : end[k]], reach))
        texts.append(np.full(len(places[-1]), k))
    return np.concatenate(texts), np.concatenate(places)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    base = int(arrays.numbers(1, 41)[0])
    steps = np.full((2, n), base, dtype=np.uint64)
    steps[1] = pow(base, -1, 1 << 64)
    steps[:, 0] = 1
    return tuple(np.multiply.accumulate(steps, axis=1))


class Runs:
    """Hashes of runs of words, from sums over all words before."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes) + 1
        self.powers, self.inverse = (p[:n] for p in _powers(1 << max(16, n.bit_length())))
        self.total = np.zeros(n, dtype=np.uint64)
        np.cumsum(arrays.mixed(hashes) * self.powers[:-1], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.total[end] - self.total[start]) * self.inverse[start]

    def uids(self, start: np.ndarray, end: np.ndarray, kind: int) -> np.ndarray:
        """A hash of each run that stands for it; the same run is another one for another kind."""
        return arrays.mixed(self.of(start, end) + (end - start).astype(np.uint64) ^ arrays.numbers(kind + 1, 61)[kind])

    def around(self, found: arrays.Words, text: np.ndarray, place: np.ndarray) -> np.ndarray:
        """A hash of the words that passages around a seed can hold, and of its place among them."""
        start = np.maximum(place - BEFORE, found.bounds[text])
        end = np.minimum(place + PASSAGE_WORDS, found.bounds[text + 1])
        return arrays.mixed(self.of(start, end) + ((place - start) * 128 + (end - place)).astype(np.uint64))


class Piece:
    """Texts of a piece with the hashes of their words and shingles."""

    def __init__(self, found: arrays.Words, rows: np.ndarray):
        self.found, self.rows = found, rows[found.first : found.first + len(found.edges) - 1].view(np.uint64)
        hashes = arrays.word_hashes(found)
        self.shingles, self.runs = arrays.windows(hashes, arrays.SHINGLE), Runs(hashes)
        self.hashes = hashes

    def lines(self) -> tuple[np.ndarray, ...]:
        """Text, first word, end, kind and uid of natural paragraphs."""
        text, first, end, kind = natural_ranges(self.found).T
        return text, first, end, kind, self.runs.uids(first, end, LINE)

    def windows(self) -> tuple[np.ndarray, ...]:
        """Text, first word, end and uid of windows."""
        bounds = self.found.bounds
        text, start = minima(self.shingles, bounds[:-1], np.maximum(bounds[:-1], bounds[1:] - LEAST_WORDS + 1), REACH)
        return text, start, start + LEAST_WORDS, self.runs.uids(start, start + LEAST_WORDS, WINDOW)

    def seeds(self) -> tuple[np.ndarray, ...]:
        """Text, place and shingle of the seeds of texts that can hold a passage."""
        first, end = self.found.bounds[:-1], self.found.bounds[1:]
        end = np.where(end - first < PASSAGE_WORDS, first, end - arrays.SHINGLE + 1)
        text, place = minima(self.shingles, first, end, SEED_REACH)
        return text, place, self.shingles[place]

    def passages(self, text: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each seed first word and uid of the passages around it, and whether they are inside the text."""
        start = place[:, None] - np.array(PLACES)
        inside = (start >= self.found.bounds[text][:, None]) & (start + PASSAGE_WORDS <= self.found.bounds[text + 1][:, None])
        at = np.where(inside, start, 0)
        return start, self.runs.uids(at, at + PASSAGE_WORDS * inside, PASSAGE), inside


def _pieces(batches: Iterator[pa.RecordBatch], text: int = 1) -> Iterator[tuple[pa.RecordBatch, Piece]]:
    for batch in batches:
        rows = batch.column(0).to_numpy()
        for found in arrays.words(batch.column(text), lower=True):
            yield batch, Piece(found, rows)


def _numbers(parts: int):
    """Blocks of the numbers by which it is told what several texts share."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, np.ndarray]]:
        for _, piece in _pieces(batches):
            text, first, end, _, line = piece.lines()
            one, at = np.unique(line, return_index=True)
            keys = Sets(piece.shingles, first[at], end[at]).band_keys()
            own, _, _, window = piece.windows()
            holder, place, seed = piece.seeds()
            around = piece.runs.around(piece.found, holder, place)
            yield {
                LINES: np.stack([line, piece.rows[text]], axis=1),
                WINDOWS: np.stack([window, piece.rows[own]], axis=1),
                BANDS: np.stack([keys.reshape(-1), np.repeat(one, keys.shape[1])], axis=1),
                SEEDS: np.stack([seed, around, piece.rows[holder]], axis=1),
            }

    return lambda batches: aligned.blocks(found(batches), parts, REDUCED)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of lines and windows that several texts hold the uid, of bands with several lines key and uid,
    of seeds with several surroundings in several texts the seed and one occurrence of each of these."""
    found = aligned.tables(batches, WIDTHS)
    for kind, table in found.items():
        if not len(table):
            continue
        table = REDUCED[kind](table)
        first = np.flatnonzero(np.append(True, table[1:, 0] != table[:-1, 0]))
        sizes = np.diff(np.append(first, len(table)))
        low, high = (f.reduceat(table[:, -1], first) for f in (np.minimum, np.maximum))
        several = low != high
        if kind == SEEDS:
            several &= table[first, 1] != table[first + sizes - 1, 1]
        if kind in (LINES, WINDOWS):
            a = b = table[first[several], 0]
        else:
            table = table[np.repeat(several, sizes)]
            if kind == SEEDS and len(table):
                table = table[np.append(True, (table[1:, :2] != table[:-1, :2]).any(axis=1))]
            a, b = table[:, 0], occurrences(*table.T) if kind == SEEDS else table[:, 1]
        columns = [pa.array(np.full(len(a), kind, np.int32)), pa.array(arrays.signed(a)), pa.array(arrays.signed(b))]
        yield pa.RecordBatch.from_arrays(columns, names=["kind", "a", "b"])


def occurrences(seed: np.ndarray, around: np.ndarray, row: np.ndarray) -> np.ndarray:
    """A hash of a seed's surroundings in a text."""
    return arrays.mixed(arrays.mixed(arrays.mixed(seed) ^ around) ^ row)


def _wanted(picker: Picker, values: np.ndarray) -> np.ndarray:
    values = arrays.signed(values)
    return picker.may_want(values, long_hashes(values))


def _line_sets(picker: Picker) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.Array, Sets]]]:
    """The wanted lines with their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Sets]]:
        for _, piece in _pieces(batches):
            _, first, end, _, line = piece.lines()
            line, at = np.unique(line, return_index=True)
            kept = _wanted(picker, line)
            yield pa.array(arrays.signed(line[kept])), Sets(piece.shingles, first[at[kept]], end[at[kept]])

    return run


def _traits(picker: Picker):
    """Sizes and sketches of the wanted lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uid, sets in _line_sets(picker)(batches):
            columns = [uid, pa.array(np.diff(sets.bounds).astype(np.int32)), _fixed(sets.sketches())]
            yield pa.RecordBatch.from_arrays(columns, names=["uid", "n_shingles", "sketch"])

    return run


def _shingles(picker: Picker):
    """The shingles of the wanted lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uid, sets in _line_sets(picker)(batches):
            lists = pa.ListArray.from_arrays(pa.array(sets.bounds.astype(np.int32)), pa.array(arrays.signed(sets.values)))
            yield pa.RecordBatch.from_arrays([uid, lists], names=["uid", "shingles"])

    return run


def _stretches(picker: Picker, parts: int):
    """Blocks of the words around the wanted occurrences of seeds."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, np.ndarray]]:
        for _, piece in _pieces(batches):
            text, place, seed = piece.seeds()
            around = piece.runs.around(piece.found, text, place)
            kept = _wanted(picker, occurrences(seed, around, piece.rows[text]))
            text, place, seed, around = text[kept], place[kept], seed[kept], around[kept]
            _, uid, inside = piece.passages(text, place)
            at = np.clip(place[:, None] + np.arange(-BEFORE, AROUND - BEFORE), 0, max(0, len(piece.shingles) - 1))
            yield {0: np.column_stack([seed, around, np.where(inside, uid, np.uint64(0)), piece.shingles[at]])}

    return lambda batches: aligned.blocks(found(batches), parts, {0: _one_of_each})


def _one_of_each(stretches: np.ndarray) -> np.ndarray:
    order = np.lexsort((stretches[:, 1], stretches[:, 0]))
    seed, around = stretches[order, 0], stretches[order, 1]
    return stretches[order[np.append(True, (seed[1:] != seed[:-1]) | (around[1:] != around[:-1]))]]


def _passage_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of passages with one seed at one place."""
    stretches = aligned.tables(batches, {0: STRETCH})[0]
    if not len(stretches):
        return
    stretches = _one_of_each(stretches)
    for k, place in enumerate(PLACES):
        own = np.flatnonzero(stretches[:, 2 + k])
        own = own[np.lexsort((stretches[own, 2 + k], stretches[own, 0]))]
        seed, uid = stretches[own, 0], stretches[own, 2 + k]
        if not len(own):
            continue
        new = np.append(True, (seed[1:] != seed[:-1]) | (uid[1:] != uid[:-1]))
        own, seed, uid = own[new], seed[new], uid[new]
        # of one passage there is nothing to compare
        alone = np.append(True, seed[1:] != seed[:-1])
        several = np.flatnonzero(~(alone & np.append(alone[1:], True)))
        start = 2 + len(PLACES) + BEFORE - place
        sets = stretches[own[several], start : start + PASSAGE_WORDS - arrays.SHINGLE + 1]
        a, b = aligned.links(seed[several], uid[several], sets)
        yield pa.RecordBatch.from_arrays([pa.array(arrays.signed(a)), pa.array(arrays.signed(b))], names=["a", "b"])


def _places(seeds: Picker, named: Picker):
    """Places of the paragraphs, windows and passages that may have a cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, piece in _pieces(batches, 2):
            own, start, stop, window = piece.windows()
            holder, place, seed = piece.seeds()
            kept = _wanted(seeds, seed)
            holder = holder[kept]
            begin, passage, inside = piece.passages(holder, place[kept])
            holder = np.repeat(holder, inside.sum(axis=1))
            begin, at = np.unique(begin[inside], return_index=True)
            passage, holder = passage[inside][at], holder[at]
            text, first, end, kind, uid = (
                np.concatenate(x)
                for x in zip(
                    piece.lines(),
                    (own, start, stop, np.full(len(own), WINDOW), window),
                    (holder, begin, begin + PASSAGE_WORDS, np.full(len(holder), PASSAGE), passage),
                )
            )
            kept = _wanted(named, uid)
            text, first, end, kind, uid = text[kept], first[kept], end[kept], kind[kept], uid[kept]
            # windows are equal by a second hash, too
            part = np.zeros(len(uid), dtype=np.uint64)
            windows = kind == WINDOW
            part[windows] = _second(piece.hashes, first[windows])
            rows = pa.array(piece.found.first + text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(kind.astype(np.int32)),
                    pa.array((first - piece.found.bounds[text]).astype(np.int64)),
                    pa.array((end - first).astype(np.int64)),
                    pa.array(arrays.signed(uid)),
                    pa.array(arrays.signed(part)),
                ],
                names=["row", "doc_id", "kind", "start", "n_words", "uid", "part"],
            )

    return run


def _second(hashes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Another hash of windows."""
    words = arrays.mixed(hashes ^ arrays.numbers(1, 21)[0])
    sums = np.zeros(len(start), dtype=np.uint64)
    for k, weight in enumerate(arrays.numbers(LEAST_WORDS, 23)):
        sums += words[start + k] * weight
    return arrays.mixed(sums)


def long_hashes(values: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of longs."""
    p1, p2, p3, p4, p5 = (
        np.uint64(x)
        for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
    )

    def turned(x: np.ndarray, n: int) -> np.ndarray:
        return x << np.uint64(n) | x >> np.uint64(64 - n)

    x = turned(values.view(np.uint64) * p2, 31) * p1 ^ (p5 + np.uint64(42 + 8))
    x = turned(x, 27) * p1 + p4
    for shift, factor in ((33, p2), (29, p3)):
        x = (x ^ x >> np.uint64(shift)) * factor
    return arrays.signed(x ^ x >> np.uint64(32))


def _fixed(table: np.ndarray) -> pa.Array:
    """A list column of the rows of a table."""
    ends = np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(arrays.signed(table.reshape(-1))))


def _near(x: str, y: str):
    """Sizes that a link can have, and a difference that it cannot exceed."""
    n = F.col(f"{x}n"), F.col(f"{y}n")
    bits = sum((F.bit_count(F.col(f"{x}s{k}").bitwiseXOR(F.col(f"{y}s{k}"))) for k in range(SKETCH_WORDS)), F.lit(0))
    return (3 * F.greatest(*n) <= 4 * F.least(*n)) & (7 * bits <= n[0] + n[1])


def repeated_paragraphs(docs: DataFrame) -> DataFrame:
    """A row for each paragraph that another document holds as well, or nearly so.

    Returned are doc_id, kind (``line``, ``block``, ``window`` or
    ``passage``), start and n_words (in words of the
    document), component_id (the smallest doc_id of the cluster) and removed. Of each cluster
    the occurrence with the smallest doc_id and start stays, all others are to be removed;
    a line goes before a block of its document, and blocks and passages that overlap what
    stays in its document are kept.
    Lines and blocks belong together at a Jaccard similarity of 0.75 or more of five-word
    shingles, directly or through others; windows when equal; passages of 50 words around a
    shared seed as lines do, and only if not all of them are equal. Words are runs of other than ASCII white
    space, A-Z in lower case.

    Null and empty texts and lines of fewer than five words have no paragraphs; a paragraph repeated in its own document
    only is no row. Rows with one doc_id count as documents of their own unless their texts
    are equal too; null doc_ids come last. Other columns are ignored; an empty table gives an
    empty result.
    """
    source = docs.select(F.xxhash64("doc_id", "text").alias("row"), F.col("doc_id").cast("long"), "text")
    texts, spark = source.select("row", "text"), docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbers = aligned.dealt(texts.mapInArrow(_numbers(parts), aligned.BLOCK), parts)
    numbers = stored(numbers.mapInArrow(_shared, SHARED), "shared", "kind")
    several = lambda kind, a="a", b="b": numbers.where(F.col("kind") == kind).select(F.col("a").alias(a), F.col("b").alias(b))

    members = several(BANDS, "key", "uid")
    traits = texts.mapInArrow(_traits(Picker(members.select("uid").distinct())), TRAITS_ROW)
    traits = traits.groupBy("uid").agg(F.first(F.struct("n_shingles", "sketch")).alias("own"))
    words = [F.col("own.sketch")[k].alias(f"s{k}") for k in range(SKETCH_WORDS)]
    traits = stored(traits.select("uid", F.col("own.n_shingles").alias("n"), *words), "line-traits")

    def confirm(pairs: DataFrame) -> DataFrame:
        uids = pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
        sets = texts.mapInArrow(_shingles(Picker(uids)), SET_ROW).groupBy("uid").agg(F.first("shingles").alias("shingles"))
        sets = stored(sets, "sets")
        for x in "ab":
            pairs = pairs.join(sets.select(F.col("uid").alias(x), F.col("shingles").alias(f"s_{x}")), x)
        common = F.size(F.array_intersect("s_a", "s_b"))
        either = F.size("s_a") + F.size("s_b") - common
        confirmed = stored(pairs.where(common >= SIMILARITY * either).select("a", "b"), "confirmed")
        free(sets)
        return confirmed

    of_line = linked_by_stars(members, members, traits, _near, confirm)
    equal = several(LINES, "uid").select("uid")
    of_line = stored(of_line.join(equal, "uid", "full").select("uid", F.coalesce("component", "uid").alias("cluster")), "named")
    free(traits)

    occurring = Picker(several(SEEDS).select("b"))
    stretches = aligned.dealt(texts.mapInArrow(_stretches(occurring, parts), aligned.BLOCK), parts)
    links = stored(stretches.mapInArrow(_passage_links, "a long, b long"), "passage-links")
    of_passage = components_by_some_rounds(links)

    windows = several(WINDOWS, "uid", "cluster")
    named = stored(of_line.union(of_passage).unionByName(windows), "clusters")
    places = source.mapInArrow(_places(Picker(several(SEEDS).select("a").distinct()), Picker(named.select("uid"))), PLACE_ROW)
    found = stored(places.join(named, "uid").drop("uid"), "passages")
    free(numbers, of_line, of_passage, named, links)
    found = found.withColumn("shape", F.when(F.col("kind") == BLOCK, LINE).otherwise(F.col("kind")))
    doc_id = F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc_id")
    place = F.struct(doc_id, "kind", "row", "start", "n_words")
    least, last = F.min("row").alias("least"), F.max("row").alias("last")
    firsts = found.groupBy("shape", "cluster", "part").agg(F.min(place).alias("first"), least, last).where("least <> last")
    kinds = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    smallest = F.nullif(F.col("first.doc_id"), F.lit((1 << 63) - 1))
    meets = (F.col("start") < F.col("first.start") + F.col("first.n_words")) & (
        F.col("first.start") < F.col("start") + F.col("n_words")
    )
    holds_first = F.col("kind").isin(BLOCK, PASSAGE) & (F.col("row") == F.col("first.row")) & meets
    return found.join(firsts, ["shape", "cluster", "part"]).select(
        "doc_id",
        kinds[F.col("kind")].alias("kind"),
        "start",
        "n_words",
        smallest.alias("component_id"),
        ((place != F.col("first")) & ~holds_first).alias("removed"),
    )
