import random

import numpy as np
import pytest

from tallyline.llm import clusters, ngram_join
from tests.llm.helpers import COLUMNS, component_of, documents, shingles


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


def corpus(seed=5):
    """Originals of all sizes with copies near the limit on either side, and a crowd that shares a passage."""
    rng = random.Random(seed)
    texts = [None, "", " \n\t ", "one two", "one  TWO", "one two three four", "ONE two three four", "é È"]
    for size in [5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 45, 60, 90, 140, 200, 400]:
        for _ in range(3):
            words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            texts.append(" ".join(words))
            for changes in {0, 1, max(1, size // 40), max(1, size // 25), max(1, size // 18)}:
                texts.append("  ".join(edited(rng, words, changes)).upper())
            texts.append(" ".join(words[: max(1, size * 4 // 5)]))
            texts.append(" ".join([*words, *words[: size // 3]]))
    passage = [f"p{k}" for k in range(40)]
    for _ in range(150):
        texts.append(" ".join([*passage, *(f"q{rng.randrange(10**6)}" for _ in range(40))]))
    return texts


def expected(texts):
    sets = [shingles(t) for t in texts]
    links = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in component_of(range(len(sets)), links).items()}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_agrees_with_all_pairs(spark):
    texts = corpus()
    assert found(ngram_join.similar_documents(documents(spark, texts))) == expected(texts)


def test_copies_that_differ_from_each_other_about_as_much_as_may_be(spark):
    rng = random.Random(6)
    texts = []
    for size in (30, 80, 150):
        words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts += [" ".join(edited(rng, words, rng.randint(1, max(2, size // 22)))) for _ in range(80)]
    assert found(ngram_join.similar_documents(documents(spark, texts))) == expected(texts)


def test_one_row_of_each_component_stays(spark):
    texts = [*corpus(7)[:120], "a b c d e f g"]
    docs = documents(spark, texts)
    kept = ngram_join.representatives(docs.union(docs.where("doc_id > 110")))
    parts = {c for n, c in expected(texts).values() if n}
    empty = [i for i, t in enumerate(texts) if not shingles(t)]
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*parts, *empty])
    assert kept.columns == docs.columns


def test_null_ids_repeated_rows_and_long_texts(spark):
    long = " ".join(f"w{k}" for k in range(300_000))
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (4, "other words here"), (9, long), (8, long + " end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    result = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in ngram_join.similar_documents(df).collect())
    assert result == [(-1, 2, 4), (-1, 2, 4), (4, 1, 4), (4, 2, 4), (8, 299_997, 8), (9, 299_996, 8)]


def test_empty_table(spark):
    assert ngram_join.similar_documents(spark.createDataFrame([], COLUMNS)).collect() == []


@pytest.mark.parametrize("n", [3, 4, 7, 20, 100, 1000])
def test_sketch_words_exceed_the_largest_difference(n):
    for m in range(n, n * 4 // 3 + 1):
        common = set(ngram_join.bands(n)) & set(ngram_join.bands(m))
        assert any(ngram_join.sketch_words(b) > (n + m) // 7 for b in common)


def test_bit_sketches_bound_the_difference():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    b = np.unique(np.concatenate([a[:250], rng.integers(0, 2**63, 40).astype(np.uint64)]))
    x, y = ngram_join.bit_sketch(a), ngram_join.bit_sketch(b)
    assert len(x) == len(y)
    assert int(np.bitwise_count(x ^ y).sum()) <= len(np.setxor1d(a, b))


def test_components_of_a_path_a_star_and_a_ring(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(6, 60)] + [(200, 201), (201, 202), (202, 200), (9, 9)]
    df = spark.createDataFrame(links, "a long, b long")
    result = {r.uid: r.component for r in clusters.components(df).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert result == component_of(nodes, links)
    assert clusters.components(df.where("a < 0")).collect() == []
