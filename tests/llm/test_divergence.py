import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyline.llm import divergence
from tests.llm.helpers import COLUMNS, lower

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, least, top):
    """All ranks from rows (lang, source, text), by listing every term of every group."""
    groups, in_lang, held = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        lang, source, words = lang or "", source or "", TERM.findall(lower(text))
        groups[lang, source].update(words)
        in_lang[lang].update(words)
        held[lang].update(set(words))
    kept = {lang: [t for t, n in held[lang].items() if n >= least] for lang in held}

    def shares(counts, lang):
        total, v = sum(counts[t] for t in kept[lang]), len(kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * v) for t in kept[lang]}

    p = {g: shares(counts, g[0]) for g, counts in groups.items()}
    q = {lang: shares(counts, lang) for lang, counts in in_lang.items()}
    rows = []
    for lang, source in groups:
        mine = p[lang, source]
        pairs = [(h, sum(abs(mine[t] - p[lang, h][t]) for t in mine)) for g, h in groups if g == lang and h != source]
        own = [(t, mine[t] - q[lang][t]) for t in mine if groups[lang, source][t] and mine[t] > q[lang][t]]
        for part, found, most in (("pair", pairs, None), ("term", own, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            rows += [(lang, source, part, t, v, k) for k, (t, v) in enumerate(found[:most], 1)]
    return sorted(rows)


def made(seed):
    rng = random.Random(seed)
    words = ["Été", "été", "ß", "ночь", "zz9zz", "a_b", *[f"w{chr(97 + k // 8)}{chr(97 + k % 8)}" for k in range(60)]]
    docs = []
    for _ in range(400):
        lang, source = rng.choice(["en", "en", "fr", None, ""]), rng.choice(["s1", "s1", "s2", "é", None])
        liked = rng.sample(words, 12) if source != "s1" else words[:12]
        n = rng.choice([0, 1, 8, 25])
        docs.append((lang, source, " ".join(rng.choice(liked + words) for _ in range(n))))
    return [*docs, ("xx", "alone", "few words"), ("yy", "a", None), ("yy", "b", ""), *[("en", "s1", "wde wde")] * 30]


def frame(spark, docs):
    df = spark.createDataFrame(docs, "lang string, source string, text string")
    return df.selectExpr("1 as doc_id", "*", "2 as n", "'q' as term", "3 as place", "4 as rank")


def found(result):
    assert result.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in result.collect())


@pytest.mark.parametrize(("seed", "top"), [(1, 50), (2, 4)])
def test_audit_agrees_with_all_shares(spark, seed, top):
    docs = made(seed)
    expected = plain(docs, 12, top)
    assert {r[2] for r in expected} == {"pair", "term"}
    assert found(divergence.audit(frame(spark, docs), 12, top)) == expected
    assert found(divergence.audit(frame(spark, docs).repartition(9), 12, top)) == expected


def test_terms_of_a_batch_are_added_up_in_parts(monkeypatch):
    docs = [("en", f"s{k % 2}", f"every text {chr(97 + k)}") for k in range(20)]
    batch = divergence.pa.RecordBatch.from_arrays([*map(divergence.pa.array, zip(*docs, strict=True))], ["lang", "source", "text"])
    monkeypatch.setattr(divergence, "GATHERED", 8)
    monkeypatch.setattr(divergence.terms.arrays, "PIECE_BYTES", 24)
    parts = [part.to_pylist() for part in divergence._counted(iter([batch]))]
    assert len(parts) == 5 and max(map(len, parts)) <= 12
    total = Counter()
    for row in sum(parts, []):
        total[row["source"], row["term"]] += row["n"]
        assert row["n"] == row["docs"]
    assert total["s0", "every"] == total["s1", "text"] == 10 and sum(total.values()) == 60


def test_small_buffers_and_blocks(spark, monkeypatch):
    docs = made(3)
    expected = plain(docs, 5, 6)
    assert found(divergence.audit(frame(spark, docs), 5, 6)) == expected
    terms = [t for r in docs for t in TERM.findall(lower(r[2] or ""))]
    rng = np.random.default_rng(1)
    rows = divergence.pa.table(
        {
            "lang": ["l"] * len(terms),
            "source": ["s"] * len(terms),
            "term": [f"{t}{k}" for k, t in enumerate(terms)],
            "n": rng.integers(1, 30, len(terms)),
            "in_lang": rng.integers(30, 60, len(terms)),
        }
    )
    monkeypatch.setattr(divergence, "BUFFER", 100)
    kept = divergence.pa.Table.from_batches(list(divergence._skybands(6)(iter(rows.to_batches(70)))))
    points = list(zip(rows["n"].to_pylist(), rows["in_lang"].to_pylist(), (t.encode() for t in rows["term"].to_pylist())))
    alive = sorted(
        b[2] for b in points if sum(a[0] >= b[0] and a[1] <= b[1] and a[2] < b[2] for a in points) < 6
    )
    assert sorted(t.encode() for t in kept["term"].to_pylist()) == alive
    assert len(alive) < len(points)


def test_sums_of_pairs_in_parts(monkeypatch):
    """More cells than a task holds: sums come in parts that add up."""
    pa = divergence.pa
    monkeypatch.setattr(divergence, "CELLS", 10)
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(["a", "b", "a"]),
            pa.array([[0, 2], [1], [1]], pa.list_(pa.int32())),
            pa.array([[7, 9], [5], [4]], pa.list_(pa.int64())),
            pa.array([[1, 2, 3], [1, 1], [1, 2, 3]], pa.list_(pa.int64())),
        ],
        names=["lang", "place", "p", "absent"],
    )
    total = Counter()
    for part in divergence._pair_sums(iter([batch, batch])):
        for r in part.to_pylist():
            total[r["lang"], r["a"], r["b"]] += r["value"]
    assert total["a", 0, 1] == 2 * (5 + 3) and total["a", 2, 0] == 2 * (2 + 2) and total["b", 0, 1] == 2 * 4


def test_repeated_rows_and_empty_tables(spark):
    docs = [("en", "s", "word")] * 30 + [("en", "t", None)]
    assert found(divergence.audit(frame(spark, docs))) == plain(docs, 30, 50)
    assert divergence.audit(spark.createDataFrame([], COLUMNS)).collect() == []


def test_a_long_text_is_one_document(spark):
    docs = [("en", "s", "alpha beta " * 60_000)] + [("en", "t", "alpha gamma")] * 29
    assert found(divergence.audit(frame(spark, docs))) == plain(docs, 30, 50)
