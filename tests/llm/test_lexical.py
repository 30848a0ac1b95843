import math
import random
import re

import pytest

from tallyline.llm import lexical
from tests.llm.helpers import COLUMNS, documents, lower

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text):
    return TERM.findall(lower(text))


def plain(docs, items, top):
    """Scores one by one, from documents (doc_id, text) and items (item_id, text)."""
    split = [(i, words_of(t)) for i, t in docs]
    split = [(i, w) for i, w in split if w]
    n_docs, length = len(split), sum(len(w) for _, w in split)
    rows = []
    for item, text in items:
        scored = []
        for i, w in split:
            m = 100 - 50 + 50 * len(w) * n_docs // length
            score = 0
            for t in set(words_of(text)):
                df = sum(t in v for _, v in split)
                tf = w.count(t)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, math.inf if i is None else i, i))
        for rank, (score, _, i) in enumerate(sorted(scored, key=lambda x: x[:2])[:top], 1):
            rows.append((item, rank, i, -score))
    return sorted(rows, key=str)


def texts(n, rng, words):
    marks = [" ", ", ", "\n", "_", "@", "[", " - "]
    return ["".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.choice([0, 1, 4, 30, 90]))) for _ in range(n)]


def benchmark(spark, rows):
    df = spark.createDataFrame(rows, "item_id long, text string")
    return df.selectExpr("*", "item_id as doc_id", "1 as rank", "2 as score", "'x' as item")


def found(result):
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in result.collect()), key=str)


@pytest.fixture
def case(spark):
    rng = random.Random(5)
    words = ["Straße", "CAFÉ", "café", "a1", "A1", "b", "ночь", "x" * 40, *[f"w{k}" for k in range(60)]]
    docs = [None, "", " ._ ", *texts(120, rng, words)]
    docs += docs[5:25]  # ties
    items = [(k, t) for k, t in enumerate([None, "", "!!", "nowhere", *texts(90, rng, words)])]
    return documents(spark, docs), list(enumerate(docs)), items


@pytest.mark.parametrize("top", [5, 50])
def test_ranks_agree_with_plain_scores(spark, case, top):
    df, docs, items = case
    expected = plain(docs, items, top)
    assert found(lexical.search(df, benchmark(spark, items), top)) == expected
    assert found(lexical.search(df.repartition(5), benchmark(spark, items), top)) == expected


def test_small_tiles_blocks_and_parts(spark, case, monkeypatch):
    """Sums split over the vocabulary, several blocks of items, texts cut into slices."""
    df, docs, items = case
    expected = plain(docs, items, 7)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(lexical, "MERGES", 3)
    assert found(lexical.search(df, benchmark(spark, items), 7)) == expected


def test_products_stay_below_the_exact_bound():
    import numpy as np

    of_item = [np.arange(300), np.arange(100, 400)]
    weights = np.full(400, 2**31, dtype=np.int64)
    tile = lexical.Tile([0, 1], of_item, weights)
    assert tile.width * lexical.MOST_IMPACT * 2**31 < lexical.EXACT and tile.width < 300
    place, column = np.arange(400), np.zeros(400, dtype=np.int64)
    scores = tile.scores(place, column, np.full(400, lexical.MOST_IMPACT - 1), 1)
    assert scores.tolist() == [[300 * 2**31 * (lexical.MOST_IMPACT - 1)]] * 2


def test_repeated_rows_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b")] * 3 + [(None, "a b"), (None, None), (2, "c")], "doc_id long, text string")
    rows = found(lexical.search(df, benchmark(spark, [(9, "a"), (9, "c c C"), (None, "b")])))
    assert [(i, r, d) for i, r, d, _ in rows if i != 9] == [(None, 1, 1), (None, 2, 1), (None, 3, 1), (None, 4, None)]
    assert [(r, d) for i, r, d, _ in rows if i == 9] == [(1, 1), (1, 2), (2, 1), (3, 1), (4, None)]
    none = spark.createDataFrame([], COLUMNS)
    assert lexical.search(none, benchmark(spark, [(1, "a")])).collect() == []
    assert lexical.search(df, benchmark(spark, []).limit(0)).collect() == []


def test_a_long_text_counts_as_one(spark):
    text = "a b c " * 200_000 + "z"
    docs = [(0, text), (1, "z a"), (2, "b")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = [(0, "z"), (1, "c a")]
    assert found(lexical.search(df, benchmark(spark, items))) == plain(docs, items, 50)
