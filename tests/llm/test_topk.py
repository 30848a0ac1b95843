import numpy as np
import pytest

from tallyline.llm import topk


def plain(vectors, every, k):
    """Scores of all pairs."""
    whole = {}
    for i, v in vectors:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole[i] = [int(np.floor(1024.0 * x)) for x in v]
    out = []
    for q, x in whole.items():
        if q % every:
            continue
        scores = [(-sum(a * b for a, b in zip(x, y, strict=False)), i) for i, y in whole.items() if i != q]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def made(n, width, seed, flat=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, width)) * np.geomspace(1, 0.05, width)
    data = centres[rng.integers(0, 5, n)] + 0.2 * rng.normal(size=(n, width)) * np.geomspace(1, 0.05, width)
    data *= 1 if flat else rng.lognormal(0, 1, (n, 1))
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(data)]


@pytest.mark.parametrize("flat", [False, True])
def test_agrees_with_all_pairs(spark, monkeypatch, flat):
    monkeypatch.setattr(topk, "RANGE_ROWS", 150)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 16)
    monkeypatch.setattr(topk, "FIRST", 40)
    monkeypatch.setattr(topk, "BLOCK", 32)
    vectors = made(900, 12, 3, flat)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").selectExpr("*", "vec_id as uid", "1 as v", "2 as range")
    assert rows_of(topk.top_k(df, every=20, k=7)) == plain(vectors, 20, 7)


def test_ties_odd_rows_and_few_candidates(spark):
    one = [0.5, -0.25, 0.125]
    vectors = [(i, one) for i in range(0, 40)] + [(100, [0.0, 0.0, 0.0]), (101, None), (None, one), (102, [1.0, None, 0.0])]
    vectors += [(103, [float("nan"), 0.0, 0.0]), (104, [float("inf"), 0.0, 0.0]), (105, [0.5]), (200, [])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    assert rows_of(topk.top_k(df, every=100, k=10)) == plain(vectors, 100, 10)
    few = df.where("vec_id < 4")
    assert rows_of(topk.top_k(few, every=2, k=10)) == plain(vectors[:4], 2, 10)


def test_repeated_rows_are_queries_and_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (5, [0.5, 0.0])], "vec_id long, embedding array<float>")
    expected = sorted([(0, 1, 0, 1024 * 1024), (0, 2, 5, 1024 * 512)] * 2)
    assert rows_of(topk.top_k(df, every=100, k=10)) == expected


def test_large_numbers_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [3e4, 1.0]), (1, [2e4, -1.0])], "vec_id long, embedding array<double>")
    assert rows_of(topk.top_k(df)) == [(0, 1, 1, 1024 * 30_000 * 1024 * 20_000 - 1024 * 1024)]
    assert topk.top_k(df.where("vec_id < 0")).collect() == []


def test_copies_fall_where_bounds_prune(spark):
    """Groups of queries that need long vectors do not meet the ranges of short ones."""
    ordered = spark.createDataFrame([(r, f"v{r}{k}") for r in range(5) for k in range(10)], "range int, name string")
    longest = spark.createDataFrame([(r, 100.0 / 10**r) for r in range(5)], "range int, longest double")
    needs = [(0, 1.0, 50.0), (0, 2.0, 150.0), (1, 1.0, 0.5), (2, 1.0, float("-inf")), (3, 0.0, 5.0)]
    queries = spark.createDataFrame(needs, "part int, length double, least double")
    met = topk.meetings(queries, longest, 4)
    assert sorted((r["part"], r["range"]) for r in met.collect()) == [(0, 0), *[(1, r) for r in range(3)], *[(2, r) for r in range(5)]]
    assert topk.copied(ordered, met).count() == 90 < 5 * 10 * 4


def test_components_beyond_64_bits_raise(spark):
    df = spark.createDataFrame([(0, [1e17, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        topk.top_k(df).collect()
