"""Token counts of documents without making token ids of documents.

A byte-level BPE tokenizer splits text into pre-tokens and merges bytes inside each one, so
the count of a text is the sum over its pre-tokens. Pre-tokens repeat: each distinct one of
the corpus is tokenized once, and its count is joined to the frequencies per document.

Pre-tokens are found for many texts at once by character classes, and are known by a 64-bit
hash; the text of a pre-token is shuffled once per task that meets it. Counts of the most
frequent pre-tokens, HEAD at most, are broadcast and added up inside the scan. The rest is
a join on the hash. Two of a billion distinct pre-tokens share a hash with a probability
of 3 %, which would change the count of the rarer one's documents.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import arrays
from tallyline.llm.storing import stored

# Pre-tokens whose counts are broadcast, at twelve bytes each.
HEAD = 1 << 19
# Distinct pre-tokens that a task holds before it hands them on.
HELD = 1 << 20

OTHER, SPACE, LETTER, NUMBER = range(4)
# Letters after an apostrophe that make a pre-token with it.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@cache
def character_classes() -> np.ndarray:
    """The class of every code point."""
    import regex

    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    classes = np.zeros(0x110000, dtype=np.uint8)
    for pattern, kind in ((r"\s+", SPACE), (r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for found in regex.finditer(pattern, points):
            a, b = ord(points[found.start()]), ord(points[found.end() - 1])
            classes[a : b + 1] = kind
    classes[0xD800:0xE000] = OTHER
    return classes


@cache
def special_strings(path: str) -> tuple[str, ...]:
    """Strings that the tokenizer takes out of a text before it splits the rest."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    splitter = described["pre_tokenizer"] or {}
    if splitter.get("type") != "ByteLevel" or splitter["add_prefix_space"] or not splitter["use_regex"]:
        raise ValueError("only byte-level tokenizers that split by the usual pattern are supported")
    if described["normalizer"] is not None:
        raise ValueError("tokenizers that normalize text are not supported")
    added = described["added_tokens"]
    if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in added):
        raise ValueError("added tokens that take white space or whole words only are not supported")
    return tuple(x["content"] for x in added)


def pre_token_starts(chars: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Flags of the characters at which a pre-token starts; ``edges`` bound independent texts."""
    n = len(chars)
    kind = character_classes()[chars]
    first = np.zeros(n + 1, dtype=bool)
    first[edges] = True
    last = first[1:]  # the character ends its text
    first = first[:-1]
    space, blank = kind == SPACE, chars == 0x20
    before_word = np.zeros(n, dtype=bool)  # white space whose next character is none
    before_word[:-1] = space[:-1] & ~space[1:] & ~last[:-1]
    led = np.zeros(n, dtype=bool)  # its leading blank belongs to it
    led[1:] = before_word[:-1] & blank[:-1]
    change = first.copy()
    change[1:] |= kind[1:] != kind[:-1]
    starts = (change & ~led) | before_word
    at = np.flatnonzero((chars == 0x27) & starts & ~space)
    for i in at[at + 1 < n]:
        if last[i]:
            continue
        tail = chars[i + 1 : i + 3]
        for letters in CONTRACTIONS:
            to = i + 1 + len(letters)
            if len(tail) >= len(letters) and all(tail[k] == ord(x) for k, x in enumerate(letters)):
                if not last[i + 1 : to - 1].any():
                    starts[i + 1 : to] = False
                    if to < n and not space[to]:
                        starts[to] = True
                    break
    return starts


class PreTokens:
    """Pre-tokens of a run of texts: hashes, character ranges, and the range of each text."""

    def __init__(self, first: int, data: np.ndarray, edges: np.ndarray, special: tuple[str, ...]):
        self.first, self.bytes = first, np.diff(edges)
        self.text = data.tobytes().decode("utf-8")
        chars = np.frombuffer(self.text.encode("utf-32-le"), dtype=np.uint32)
        lead = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
        edges = lead[edges]
        inner, cuts = [], []
        for string in special:
            at = self.text.find(string)
            while at >= 0:
                to = at + len(string)
                if np.searchsorted(edges, at, "right") == np.searchsorted(edges, to, "left"):
                    inner.append((at, to))
                    cuts += [at, to]
                    at = self.text.find(string, to)
                else:
                    at = self.text.find(string, at + 1)
        starts = pre_token_starts(chars, np.concatenate([edges, np.array(cuts, dtype=np.int64)]))
        for at, to in inner:
            starts[at + 1 : to] = False
        self.start = np.flatnonzero(starts)
        self.end = np.append(self.start[1:], len(chars))[: len(self.start)]
        self.hashes = arrays.run_hashes(arrays.mixed(chars + np.uint64(1)), self.start, self.end)
        self.bounds = np.searchsorted(self.start, edges)


def pre_tokens(column: pa.Array, special: tuple[str, ...]) -> Iterator[PreTokens]:
    for first, data, edges in arrays.pieces(column):
        yield PreTokens(first, data, edges, special)


def _distinct(path: str):
    """Each distinct pre-token that a task meets, with its occurrences."""

    def flush(hashes, counts, texts):
        if len(hashes):
            yield pa.RecordBatch.from_arrays(
                [pa.array(arrays.signed(hashes)), pa.array(texts, pa.string()), pa.array(counts)],
                names=["hash", "piece", "occurrences"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = special_strings(path)
        hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        texts = np.zeros(0, dtype=object)
        for batch in batches:
            for found in pre_tokens(batch.column(0), special):
                own, at, times = np.unique(found.hashes, return_index=True, return_counts=True)
                place = np.searchsorted(hashes, own)
                known = np.zeros(len(own), dtype=bool)
                inside = place < len(hashes)
                known[inside] = hashes[place[inside]] == own[inside]
                counts[place[known]] += times[known]
                new = ~known
                ranges = zip(found.start[at[new]].tolist(), found.end[at[new]].tolist(), strict=True)
                strings = np.empty(int(new.sum()), dtype=object)
                strings[:] = [found.text[a:b] for a, b in ranges]
                order = np.argsort(np.concatenate([hashes, own[new]]), kind="stable")
                hashes = np.concatenate([hashes, own[new]])[order]
                counts = np.concatenate([counts, times[new]])[order]
                texts = np.concatenate([texts, strings])[order]
                if len(hashes) > HELD:
                    yield from flush(hashes, counts, texts)
                    hashes, counts, texts = hashes[:0], counts[:0], texts[:0]
        yield from flush(hashes, counts, texts)

    return run


def _tokens_of_pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                encoded = tokenizer.encode_batch(part.column(1).to_pylist(), add_special_tokens=False)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in encoded], pa.int64()), part.column(2)],
                    names=["hash", "pieces", "occurrences"],
                )

    return run


def _counted(path: str, head):
    """Per document the tokens of its frequent pre-tokens, and its other pre-tokens with their frequency."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = special_strings(path)
        known, pieces = head.value
        for batch in batches:
            for found in pre_tokens(batch.column(1), special):
                rows = len(found.bytes)
                place = np.searchsorted(known, found.hashes)
                place[place == len(known)] = 0
                frequent = known[place] == found.hashes if len(known) else np.zeros(len(place), bool)
                total = np.zeros(len(place) + 1, dtype=np.int64)
                if len(known):
                    np.cumsum(np.where(frequent, pieces[place], 0), out=total[1:])
                owner = np.repeat(np.arange(rows), np.diff(found.bounds))[~frequent]
                rare = found.hashes[~frequent]
                order = np.lexsort((rare, owner))
                owner, rare = owner[order], rare[order]
                new = np.ones(len(rare), dtype=bool)
                new[1:] = (owner[1:] != owner[:-1]) | (rare[1:] != rare[:-1])
                at = np.flatnonzero(new)
                ends = pa.array(np.searchsorted(owner[at], np.arange(rows + 1)).astype(np.int32))
                times = np.diff(at, append=len(rare)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(found.first, rows),
                        pa.array(found.bytes.astype(np.int64)),
                        pa.array(total[found.bounds[1:]] - total[found.bounds[:-1]]),
                        pa.ListArray.from_arrays(ends, pa.array(arrays.signed(rare[at]))),
                        pa.ListArray.from_arrays(ends, pa.array(times)),
                    ],
                    names=["doc_id", "n_bytes", "frequent_tokens", "rare", "times"],
                )

    return run


def count_tokens(docs: DataFrame, path: str, head: int = HEAD) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every row of ``docs`` (doc_id, text).

    ``path`` is the file of a byte-level BPE tokenizer, found there on every executor. No
    token is added at the ends; the tokenizer's special strings inside a text count as one
    token each, as is its default. A null or empty text has no bytes and no tokens. Rows
    with one doc_id, or a null one, are counted each for itself; other columns are ignored;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    distinct = docs.select("text").mapInArrow(_distinct(path), "hash long, piece string, occurrences long")
    once = distinct.groupBy("hash").agg(
        F.min("piece").alias("piece"), F.sum("occurrences").alias("occurrences")
    )
    pieces = stored(
        once.mapInArrow(_tokens_of_pieces(path), "hash long, pieces long, occurrences long"), "pieces"
    )
    limit = _least_frequent(pieces, head)
    table = pieces.where(F.col("occurrences") >= limit).select("hash", "pieces").toArrow()
    hashes = table["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    frequent = spark.sparkContext.broadcast(
        (hashes[order], table["pieces"].to_numpy()[order].astype(np.int32))
    )
    counted = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(
            _counted(path, frequent),
            "doc_id long, n_bytes long, frequent_tokens long, rare array<long>, times array<int>",
        )
        .withColumn("uid", F.monotonically_increasing_id())
    )
    counted = stored(counted, "counted")
    rare = counted.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "uid", F.col("x.rare").alias("hash"), F.col("x.times").alias("times")
    )
    rest = (
        rare.join(pieces.where(F.col("occurrences") < limit), "hash")
        .groupBy("uid")
        .agg(F.sum(F.col("times") * F.col("pieces")).alias("rare_tokens"))
    )
    total = F.col("frequent_tokens") + F.coalesce("rare_tokens", F.lit(0))
    return counted.join(rest, "uid", "left").select("doc_id", "n_bytes", total.alias("n_tokens"))


def _least_frequent(pieces: DataFrame, head: int) -> int:
    """The smallest power of 2 so that no more than ``head`` pre-tokens occur as often."""
    power = F.floor(F.log2("occurrences")).cast("int")
    rows = pieces.groupBy(power.alias("power")).count().orderBy(F.desc("power")).collect()  # 63 at most
    total, limit = 0, 1 << 62
    for row in rows:
        total += row["count"]
        if total > head:
            break
        limit = 1 << row["power"]
    return limit
