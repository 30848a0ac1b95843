"""Documents that hold passages of test questions and answers.

The texts of the items are normalised to words, and every run of WINDOW words is a passage
to find. One Aho-Corasick automaton holds the items cut into pieces of PIECE words: a run of
WINDOW words holds a whole piece, wherever it begins. A document is normalised the same way
and read once; around each piece that the automaton meets, the runs of WINDOW words are looked
up among those of the items. Words keep their places in the original text, so that the result
says which characters to cut. The automaton has a node for each character of the items rather
than for each character of all their windows.

Items are a stated set, worked through in blocks of bounded size, each with an automaton of
its own; most sets are one block. Long texts are read in slices that overlap by a window less
one word, so memory does not depend on their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import arrays, terms
from tallyline.llm.storing import stored

BETWEEN = terms.bytes_between(terms.DIGITS, terms.UPPER, terms.LOWER)
WINDOW = 10
PIECE = 5
# Bytes of item texts of a block: an automaton takes some 150 bytes of memory for each.
BLOCK_BYTES = 2 << 20

HIT = "array<struct<first: bigint, last: bigint, start: bigint, end: bigint>>"
SCANNED = f"row long, doc_id long, n_words long, hits {HIT}, items array<string>"
NONE = np.zeros((0, 4), dtype=np.int64)


class Words:
    """Words of a text or a part of one: ``line`` is `` w1 w2 … `` with a character per byte.

    ``start`` and ``end`` are the places of the words in the line, ``char`` and ``char_end``
    those in the original text, in characters; ``before`` counts the words of earlier parts.
    """

    def __init__(self, line: str, start, end, char, char_end, before: int = 0):
        self.line, self.start, self.end, self.char, self.char_end = line, start, end, char, char_end
        self.before = before

    def after(self, earlier: Words) -> Words:
        """These words with the last ones of the part before them, which a window can reach back to."""
        n = min(WINDOW - 1, len(earlier.start))
        if not n:
            self.before = earlier.before + len(earlier.start)
            return self
        at = int(earlier.start[-n])
        kept = earlier.line[at:]
        return Words(
            " " + kept + self.line[1:],
            np.concatenate([earlier.start[-n:] - at + 1, self.start + len(kept)]),
            np.concatenate([earlier.end[-n:] - at + 1, self.end + len(kept)]),
            np.concatenate([earlier.char[-n:], self.char]),
            np.concatenate([earlier.char_end[-n:], self.char_end]),
            earlier.before + len(earlier.start) - n,
        )


def words_of(column: pa.Array) -> Iterator[tuple[int, Words, bool]]:
    """(row, its words, whether its text goes on) for each text or part of one; null texts have none."""
    chars = 0
    earlier = None
    for first, texts, goes_on in terms.cut(column, BETWEEN):
        _, offsets, data = texts.buffers()
        edges = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        low = int(edges[0])
        data = arrays._LOWER[np.frombuffer(data, dtype=np.uint8)[low : int(edges[-1])]] if data else np.zeros(0, np.uint8)
        edges = edges - low
        inside = ~BETWEEN[data]
        begins = edges[:-1][edges[:-1] < len(data)]
        starts, kept = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        kept[1:] |= inside[:-1]
        starts[begins] = kept[begins] = inside[begins]
        place = np.append(0, np.cumsum(kept))
        char = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        line = np.where(inside, data, 0x20).astype(np.uint8)[kept].tobytes().decode("latin-1")
        start = np.flatnonzero(starts)
        stops = ~np.append(inside, False)[1:]
        stops[begins[begins > 0] - 1] = True
        end = np.flatnonzero(inside & stops) + 1
        bounds = np.searchsorted(start, edges)
        for k in range(len(edges) - 1):
            a, b = int(bounds[k]), int(bounds[k + 1])
            at, to = int(place[edges[k]]), int(place[edges[k + 1]])
            own = line[at:to]
            found = Words(
                " " + own + ("" if own.endswith(" ") or not own else " "),
                place[start[a:b]] - at + 1,
                place[end[a:b] - 1] + 1 - at + 1,
                char[start[a:b]] - char[edges[k]] + chars,
                char[end[a:b]] - char[edges[k]] + chars,
            )
            if earlier is not None:
                found = found.after(earlier)
            yield first + k, found, goes_on
            earlier = found if goes_on else None
            chars = chars + int(char[edges[k + 1]] - char[edges[k]]) if goes_on else 0


class Passages:
    """The windows of some texts, and an automaton of the pieces that they hold."""

    def __init__(self, texts: tuple[str, ...]):
        self.items: dict[str, list[int]] = {}
        pieces: dict[str, int] = {}
        for item, words in enumerate(_lists(texts)):
            for k in range(max(len(words) - WINDOW + 1, min(len(words), 1))):
                found = self.items.setdefault(" ".join(words[k : k + WINDOW]), [])
                if not found or found[-1] != item:
                    found.append(item)
            size = PIECE if len(words) >= WINDOW else max(len(words), 1)
            for k in range(0, len(words) - size + 1, size):
                pieces[" ".join(words[k : k + size])] = size
        self.automaton = ahocorasick.Automaton()
        for piece, size in pieces.items():
            self.automaton.add_word(f" {piece} ", size)
        self.automaton.make_automaton()
        self.sizes = sorted({len(w.split(" ")) for w in self.items})

    def hits(self, words: Words) -> tuple[np.ndarray, set[int]]:
        """(first word, last word, first character, end) of each window found, and the items they belong to."""
        found: dict[tuple[int, int], list[int]] = {}
        if len(words.start) and len(self.automaton):
            tried: set[tuple[int, int]] = set()
            for at, size in self.automaton.iter(words.line):
                last = int(np.searchsorted(words.end, at))
                for n in self.sizes:
                    for first in range(max(last - n + 1, 0), min(last - size + 1, len(words.start) - n) + 1):
                        if (first, n) not in tried:
                            tried.add((first, n))
                            items = self.items.get(words.line[words.start[first] : words.end[first + n - 1]])
                            if items:
                                found[first, first + n - 1] = items
        if not found:
            return NONE, set()
        first, last = np.array(sorted(found), dtype=np.int64).T
        rows = np.stack([first + words.before, last + words.before, words.char[first], words.char_end[last]], axis=1)
        return rows, {item for items in found.values() for item in items}


def _lists(texts: tuple[str, ...]) -> list[list[str]]:
    """The words of each text, a character per byte."""
    lists: list[list[str]] = [[] for _ in texts]
    for row, words, _ in words_of(pa.array(texts, pa.large_string())):
        kept = WINDOW - 1 if lists[row] else 0
        lists[row] += words.line.split()[min(kept, len(lists[row])) :]
    return lists


@lru_cache(maxsize=1)
def _passages(texts: tuple[str, ...]) -> Passages:
    """One for all tasks that a Python worker runs."""
    return Passages(texts)


def merged(hits: np.ndarray) -> np.ndarray:
    """Hits as maximal runs of words; (first, last, start, end) rows in any order."""
    if len(hits) < 2:
        return hits
    hits = hits[np.argsort(hits[:, 0], kind="stable")]
    reach = np.maximum.accumulate(hits[:, 1])
    new = np.flatnonzero(np.append(True, hits[1:, 0] > reach[:-1] + 1))
    last = np.maximum.reduceat(hits[:, 1], new)
    return np.stack([hits[new, 0], last, hits[new, 2], np.maximum.reduceat(hits[:, 3], new)], axis=1)


def _hit_lists(hits: list[np.ndarray]) -> pa.Array:
    ends = pa.array(np.cumsum([0, *map(len, hits)]).astype(np.int32))
    flat = np.concatenate([NONE, *hits])
    names = ["first", "last", "start", "end"]
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(4)], names))


def _scanned(texts: tuple[str, ...], ids: tuple[str | None, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = _passages(texts)
        for batch in batches:
            hits = [NONE] * batch.num_rows
            items: list[set[int]] = [set() for _ in hits]
            n_words = np.zeros(len(hits), dtype=np.int64)
            for row, words, _ in words_of(batch.column(2)):
                found, named = passages.hits(words)
                n_words[row] = words.before + len(words.start)
                if len(found):
                    hits[row] = merged(np.concatenate([hits[row], found]))
                    items[row] |= named
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n_words),
                    _hit_lists(hits),
                    pa.array([[ids[k] for k in sorted(x)] for x in items], pa.list_(pa.string())),
                ],
                names=["row", "doc_id", "n_words", "hits", "items"],
            )

    return run


def _merged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("hits"))
        rows = [
            np.array([(x["first"], x["last"], x["start"], x["end"]) for x in hits], np.int64).reshape(-1, 4)
            for hits in column.to_pylist()
        ]
        at = batch.schema.get_field_index("hits")
        yield batch.set_column(at, "hits", _hit_lists([merged(x) for x in rows]))


def scan(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, hits, items) of every document.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in
    lower case. A window is ten words in a row of an item, or all its words if there are
    fewer. ``hits`` are the maximal runs of words inside occurrences of windows: first and last
    word, counted from 0, and start and end in characters of the original text, the end not
    included. ``items`` are the distinct item_ids, as text in ascending order, whose windows
    occur; an item without an item_id hits words but is not named.

    Null and empty texts have no words: such documents have no hits, such items no windows.
    Rows with one doc_id are documents of their own, and of items that share an item_id any
    window counts. Other columns are ignored. No items leave all documents without hits; no
    documents give an empty result.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    asked = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text <> ''")
    blocks = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // block_bytes + 1
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items", "block")
    if blocks > 1:
        source = stored(source, "numbered")  # the same numbers in every scan
    parts = []
    for block in range(blocks):
        rows = asked.where(F.col("block") == block).orderBy("item_id", "text").collect()
        texts, ids = (tuple(r[c] for r in rows) for c in ("text", "item_id"))
        part = source.mapInArrow(_scanned(texts, ids), SCANNED)
        parts.append(part if blocks == 1 else stored(part, "scanned"))
    if blocks == 1:
        found = parts[0]
    else:
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        found = every.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("hits")).alias("hits"),
            F.flatten(F.collect_list("items")).alias("items"),
        )
        found = found.mapInArrow(_merged_rows, found.schema)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"] + 1)
    named = F.array_sort(F.array_distinct(F.filter("items", lambda x: x.isNotNull())))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "hits", named.alias("items"))


def without_passages(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a window of an item; documents without a doc_id stay.

    Rows that share a doc_id go together when one of them holds a window.
    """
    named = scan(docs, items).where(F.size("hits") > 0).select("doc_id")
    return docs.join(stored(named.distinct(), "contaminated"), "doc_id", "left_anti").select(*docs.columns)
