import random

import pytest
from pyspark.sql import functions as F

from tallyline.llm import mixing
from tests.llm.helpers import COLUMNS, WORD, documents


def filled(sizes, weights, share, epochs):
    """Targets by clamping one source after the other."""
    total, clamped = share * sum(sizes.values()), set()
    while True:
        free = sum(weights[s] for s in sizes if s not in clamped)
        left = total - sum(epochs * sizes[s] for s in clamped)
        over = {s for s in sizes if s not in clamped and left * weights[s] / free > epochs * sizes[s]} if free else set()
        if not over:
            return {s: epochs * sizes[s] if s in clamped else left * weights[s] / free for s in sizes}
        clamped |= over


def texts(n=300, seed=4):
    rng = random.Random(seed)
    out = [" \n ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([0, 1, 3, 10, 40]))) for _ in range(n)]
    return [None, "", " \t", *out]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_words_taken(spark, seed):
    rng = random.Random(seed)
    docs = texts(seed=seed)
    sources = [rng.choice(["b", "b", "b", "b", "Z", "é", "zz", None]) for _ in docs]
    rows = mixing.mix(documents(spark, docs, sources)).collect()
    assert len(rows) == len(docs)
    sizes, taken, target = {}, {}, {}
    for r in rows:
        assert r["size"] == len(WORD.findall(docs[r.doc_id] or ""))
        assert 0 <= r.taken <= 2 * r["size"]
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    plain = filled(sizes, weights, 1.5, 2)
    for s in sizes:
        assert target[s] == pytest.approx(plain[s])
        assert abs(taken[s] - target[s]) <= 0.5
    again = mixing.mix(documents(spark, docs, sources).repartition(7)).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in rows}


def test_repetitions_of_documents(spark):
    docs = documents(spark, texts())
    mixture = mixing.mix(docs)
    copies = mixing.mixed_documents(mixture)
    assert "text" in copies.columns and "taken" not in copies.columns
    counted = copies.groupBy("doc_id").agg(F.sum(mixing.word_count("text")).alias("n")).collect()
    expected = {r.doc_id: r.taken for r in mixture.collect() if r.taken}
    assert {r.doc_id: r.n for r in counted} == expected
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert all(whole[r.doc_id].startswith(r.text) for r in copies.collect())


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c", "x")] * 6 + [(None, "d e", None)] * 4, "doc_id long, text string, source string")
    rows = mixing.mix(df).collect()
    assert sum(r.taken for r in rows if r.source == "x") == 29
    assert len(rows) == 10 and all(r.taken <= 2 * r["size"] for r in rows)
    assert mixing.mix(spark.createDataFrame([], COLUMNS)).collect() == []
    assert mixing.mix(documents(spark, [None, ""])).agg(F.sum("taken")).first()[0] == 0
    empty = documents(spark, ["a b c", "", None, "d"], ["x", "y", "y", "x"])
    rows = mixing.mix(empty).collect()
    assert {(r.source, r.source_size, r.target) for r in rows} == {("x", 4, 6.0), ("y", 0, 0.0)}
    assert sum(r.taken for r in rows) == 6
    same = spark.createDataFrame([(1, "a b c", "x")] * 500, "doc_id long, text string, source string")
    assert mixing.mix(same).agg(F.sum("taken")).first()[0] == 2250
