"""Ranked lexical search: the best documents of each item, by exact integer scores.

A score is the product of two matrices: weights of an item's terms, and impacts of these
terms on a document. Items are taken in tiles of ITEMS with a compact vocabulary, the
documents of a task in tiles of DOCS, and each pair of tiles is one dense multiplication in
float64. All numbers are whole, and a sum is split over the vocabulary so that no part of it
can pass 2^53; so the result is exact in whatever order BLAS adds. Of each tile the documents
that reach the item's present k-th score stay, ties included, and are ordered by doc_id.

Items are a stated set of queries and are worked through in blocks of bounded size; only a
block's terms, their weights and the items' lists of terms are sent to the tasks. Documents
are read once per block; their counts of the block's terms are written to the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm import arrays, terms
from tallyline.llm.storing import stored

BETWEEN = terms.bytes_between(terms.DIGITS, terms.UPPER, terms.LOWER)
TOP = 50
# Bytes of item texts, and items, of a block, which bound what is sent to the tasks and held there.
BLOCK_BYTES, BLOCK_ITEMS = 4 << 20, 4096
# Items and documents of a tile.
ITEMS, DOCS = 64, 512
EXACT = 1 << 53
# Impacts are below 1,000,000,000 * tf / (1000 * tf).
MOST_IMPACT = 1_000_000
# Lists that the best of all tasks are merged in before the last one.
MERGES = 32

COUNTED = "doc_id long, n long, term array<int>, tf array<int>"
SCORED = "item int, doc_id long, score long"


def weight(n_docs: int, df: int) -> int:
    """The weight of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _terms_of(texts: list[str | None]) -> list[list[bytes]]:
    found: list[list[bytes]] = [[] for _ in texts]
    for first, row, term, _, _ in terms.per_text(pa.array(texts, pa.large_string()), BETWEEN):
        for r, t in zip(row.tolist(), term.to_pylist(), strict=True):
            found[first + r].append(t)
    return found


def _counted(vocabulary: pa.Array):
    """Per document with a term: the number of its terms, and its counts of the vocabulary's terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, row, term, count, n in terms.per_text(batch.column(1), BETWEEN):
                place = pc.index_in(term, value_set=vocabulary)
                known = place.is_valid().to_numpy(zero_copy_only=False)
                row, count = row[known], count[known]
                some = np.flatnonzero(n)
                ends = pa.array(np.searchsorted(row, np.append(some, len(n))).astype(np.int32))
                lists = [
                    pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32)))
                    for x in (place.drop_null().to_numpy(), count)
                ]
                ids = batch.column(0).take(pa.array(first + some))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n[some].astype(np.int64)), *lists], names=["doc_id", "n", "term", "tf"]
                )

    return run


class Tile:
    """Items with their compact vocabulary: ``weights`` has a row per item and a column per term."""

    def __init__(self, items: list[int], of_item: list[np.ndarray], weights: np.ndarray):
        self.items = np.array(items)
        self.terms = np.unique(np.concatenate([of_item[i] for i in items])) if items else np.zeros(0, np.int64)
        self.weights = np.zeros((len(items), len(self.terms)))
        for k, i in enumerate(items):
            places = np.searchsorted(self.terms, of_item[i])
            self.weights[k, places] = weights[of_item[i]]
        # columns that one product may take: no sum of their products reaches EXACT
        self.width = max(1, (EXACT - 1) // (MOST_IMPACT * max(1, int(weights.max(initial=0)))))

    def scores(self, place: np.ndarray, column: np.ndarray, impact: np.ndarray, n: int) -> np.ndarray:
        """Whole scores of n documents; impacts are given by term, document and value."""
        impacts = np.zeros((len(self.terms), n))
        impacts[place, column] = impact
        total = np.zeros((len(self.items), n), dtype=np.int64)
        for a in range(0, len(self.terms), self.width):
            part = slice(a, a + self.width)
            total += (self.weights[:, part] @ impacts[part]).astype(np.int64)
        return total


def best(item: np.ndarray, doc: np.ndarray, score: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` rows of each item by falling score, then doc_id; null is the largest one."""
    order = np.lexsort((doc, -score, item))
    first = np.searchsorted(item[order], item[order])
    return order[np.arange(len(order)) - first < top]


NULL_ID = np.iinfo(np.int64).max


def _scored(of_item: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = [
            Tile(list(range(a, min(a + ITEMS, len(of_item)))), of_item, weights)
            for a in range(0, len(of_item), ITEMS)
        ]
        held = [np.zeros((3, 0), dtype=np.int64) for _ in tiles]
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                docs = batch.slice(at, DOCS)
                ids = docs.column(0).fill_null(NULL_ID).to_numpy()
                n, lists, tfs = docs.column(1).to_numpy(), docs.column(2), docs.column(3)
                column = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
                term, tf = lists.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
                # in Python's integers, as the product can pass 2^63
                m = np.array([100 - 50 + 50 * x * n_docs // n_terms for x in n.tolist()], dtype=np.int64)
                impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[column])
                for k, tile in enumerate(tiles):
                    place = np.minimum(np.searchsorted(tile.terms, term), max(len(tile.terms) - 1, 0))
                    used = tile.terms[place] == term if len(tile.terms) else np.zeros(len(term), dtype=bool)
                    scores = tile.scores(place[used], column[used], impact[used], len(ids))
                    held[k] = _merged(held[k], tile, scores, ids, top)
        item, doc, score = np.concatenate([np.zeros((3, 0), dtype=np.int64), *held], axis=1)
        for a in range(0, len(item), 1 << 16):
            part = slice(a, a + (1 << 16))
            ids = pa.array(doc[part], mask=doc[part] == NULL_ID)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item[part].astype(np.int32)), ids, pa.array(score[part])], names=["item", "doc_id", "score"]
            )

    return run


def _merged(held: np.ndarray, tile: Tile, scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """``held`` (item, doc_id, score) after a tile; rows below an item's present last score do not enter."""
    n_held = np.bincount(held[0] - tile.items[0], minlength=len(tile.items))
    least = np.ones(len(tile.items), dtype=np.int64)
    last = np.cumsum(n_held)[n_held == top] - 1
    least[n_held == top] = held[2][last]
    row, column = np.nonzero(scores >= least[:, None])
    if not len(row):
        return held
    fresh = np.stack([tile.items[row], ids[column], scores[row, column]])
    every = np.concatenate([held, fresh], axis=1)
    return every[:, best(*every, top)]


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored. Terms
    are runs of ASCII letters, digits and all characters beyond ASCII, A-Z in lower case. A
    document's term counts by its occurrences, less in long documents; a term weighs more the
    fewer documents hold it; an item's terms count once each. Equal scores go by doc_id; rows
    with one doc_id are documents of their own and rank apart, in any order where their
    scores are equal too; a null doc_id comes last. Null and empty texts have no terms: such
    items have no rows, such documents none and no part in any count. Items that share an
    item_id are ranked each by themselves and give rows of the same name. An empty table on
    either side gives an empty result.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = items.select("item_id", "text")
    size, n = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    blocks = max(size // BLOCK_BYTES, n // BLOCK_ITEMS) + 1
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items", "block")
    found = None
    for block in range(blocks):
        rows = asked.where(F.col("block") == block).collect()
        ranked = _search_block(spark, source, asked, rows, top)
        found = ranked if found is None else found.unionByName(ranked)
    return found


def _search_block(spark, source: DataFrame, asked: DataFrame, rows: list, top: int) -> DataFrame:
    of_item = _terms_of([r["text"] for r in rows])
    vocabulary = sorted({t for found in of_item for t in found})
    place = {t: k for k, t in enumerate(vocabulary)}
    of_item = [np.array(sorted(place[t] for t in found), dtype=np.int64) for found in of_item]
    counted = source.mapInArrow(_counted(pa.array(vocabulary, pa.large_binary())), COUNTED)
    counted = stored(counted, "term-counts")
    n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    for term, df in counted.select(F.explode("term").alias("term")).groupBy("term").count().toLocalIterator():
        weights[term] = weight(n_docs, df)
    best_of_tasks = counted.where(F.size("term") > 0).mapInArrow(
        _scored(of_item, weights, n_docs, max(n_terms, 1), top), SCORED
    )
    names = spark.createDataFrame(
        [(k, r["item_id"]) for k, r in enumerate(rows)], f"item int, item_id {asked.schema['item_id'].dataType.simpleString()}"
    )
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    lists = Window.partitionBy("item", "list").orderBy(*order)
    merged = best_of_tasks.withColumn("list", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGES)))
    merged = merged.withColumn("place", F.row_number().over(lists)).where(F.col("place") <= top)
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
