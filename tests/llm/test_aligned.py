import numpy as np
import pytest

from tallyline.llm import aligned, clusters, paragraphs
from tests.llm.helpers import component_of


def near_copies(rng, families, copies, size=46):
    """Families of shingles, copies of each with some changed; numbers may be there twice."""
    rows = []
    for _ in range(families):
        base = rng.integers(1, 2**62, size)
        base[rng.integers(0, size, 3)] = base[0]
        for _ in range(copies):
            row = base.copy()
            row[rng.integers(0, size, rng.integers(0, 8))] = rng.integers(1, 2**62)
            rows.append(row)
    return np.array(rows, dtype=np.uint64)


@pytest.mark.parametrize(("families", "copies"), [(1, 40), (3, 12), (90, 2), (40, 6)])
def test_links_join_what_all_pairs_join(families, copies):
    rng = np.random.default_rng(families)
    shingles = near_copies(rng, families, copies)
    group = rng.integers(0, 2, len(shingles)).astype(np.uint64)
    uid = rng.permutation(len(shingles)).astype(np.uint64)
    sets = [set(row) for row in shingles.tolist()]
    right = [
        (int(uid[i]), int(uid[j]))
        for i in range(len(sets))
        for j in range(i)
        if group[i] == group[j] and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j])
    ]
    a, b = aligned.links(group, uid, shingles)
    found = list(zip(a.tolist(), b.tolist()))
    assert {frozenset(x) for x in found} <= {frozenset(x) for x in right}
    assert component_of(range(len(sets)), found) == component_of(range(len(sets)), right)
    assert len(found) < len(sets)


def test_passages_of_few_words_are_not_all_compared(monkeypatch):
    rng = np.random.default_rng(8)
    shingles = np.full((1500, 46), 7, dtype=np.uint64)
    shingles[:, 20:25] = rng.integers(1, 2**62, (1500, 5))
    asked = []
    linked = aligned.Passages.linked
    monkeypatch.setattr(aligned.Passages, "linked", lambda self, a, b: asked.append(len(a)) or linked(self, a, b))
    a, _ = aligned.links(np.zeros(1500, np.uint64), np.arange(1500, dtype=np.uint64), shingles)
    assert not len(a) and sum(asked) <= (aligned.ROUNDS + 1) * 1500


def test_blocks_hold_equal_numbers_once_and_keep_their_partition():
    rng = np.random.default_rng(4)
    table = rng.integers(0, 50, (4000, 2)).astype(np.uint64)
    out = list(aligned.blocks(iter([{0: table[:2500], 1: table[:0]}, {0: table[2500:]}]), 5, {0: aligned.distinct, 1: aligned.ends}))
    rows = [(r["part"], x) for b in out for r in b.to_pylist() for x in np.frombuffer(r["block"], np.uint64).reshape(-1, 2).tolist()]
    assert sorted(x for _, x in rows) == np.unique(table, axis=0).tolist()
    assert len({(p, a) for p, (a, _) in rows}) == len({a for _, (a, _) in rows})
    ends = aligned.ends(np.array([[1, 5], [1, 3], [1, 9], [2, 4], [1, 5]], dtype=np.uint64))
    assert ends.tolist() == [[1, 3], [1, 9], [2, 4]]


def test_minima_of_a_piece_are_those_of_its_texts():
    rng = np.random.default_rng(1)
    for turn in range(200):
        sizes = rng.integers(0, 60, rng.integers(1, 6))
        values = rng.integers(1, [4, 50, 2**62][turn % 3], sizes.sum() + 2).astype(np.uint64)
        first = np.cumsum(sizes) - sizes
        end, reach = np.maximum(first, first + sizes - rng.integers(0, 5)), int(rng.choice([2, 16, 26]))
        expected = set()
        for k, (a, b) in enumerate(zip(first.tolist(), end.tolist())):
            starts = range(a, max(a + 1, b - reach + 1)) if a < b else ()
            expected |= {(k, min(range(s, min(b, s + reach)), key=lambda i: (values[i], i))) for s in starts}
        text, place = paragraphs.minima(values, first, end, reach)
        assert sorted(zip(text.tolist(), place.tolist())) == sorted(expected)


def test_components_after_some_rounds_are_those_of_all_links(spark):
    rng = np.random.default_rng(6)
    order = rng.permutation(300).tolist()
    links = list(zip(order[:99], order[1:100])) + rng.integers(100, 250, (90, 2)).tolist() + [[order[200], order[201]]] * 2
    found = clusters.components_by_some_rounds(spark.createDataFrame(links, "a long, b long")).collect()
    links = [(a, b) for a, b in links if a != b]
    nodes = {x for link in links for x in link}
    expected = component_of(nodes, links)
    assert sorted(r.uid for r in found) == sorted(nodes)
    assert len({(r.component, expected[r.uid]) for r in found}) == len({r.component for r in found}) == len(set(expected.values()))
