import random
import re

import pytest

from tallyline.llm import arrays, contamination
from tests.llm.helpers import COLUMNS, documents, lower

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text, items):
    """(n_words, places of hit words, item_ids) by comparing every run of words."""
    words = WORD.findall(lower(text))
    hit, named = set(), set()
    for item, asked in items:
        asked = WORD.findall(lower(asked))
        n = min(10, len(asked))
        windows = {tuple(asked[k : k + n]) for k in range(len(asked) - n + 1)} if n else set()
        for k in range(len(words) - n + 1 if n else 0):
            if tuple(words[k : k + n]) in windows:
                hit.update(range(k, k + n))
                named.add(item)
    return len(words), hit, sorted(str(x) for x in named if x is not None)


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 as hits", "2 as row", "3 as block")


def check(df, texts, items, asked, **options):
    rows = contamination.scan(df, asked, **options).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        n_words, hit, named = plain(text, items)
        assert (r.n_words, r.n_hit, r["items"]) == (n_words, len(hit), named)
        assert {k for h in r.hits for k in range(h.first, h.last + 1)} == hit
        places = [(m.start(), m.end()) for m in WORD.finditer(lower(text))]
        assert [(h.start, h.end) for h in r.hits] == [(places[h.first][0], places[h.last][1]) for h in r.hits]
    return rows


def made(seed, n_docs=80):
    rng = random.Random(seed)
    words = ["é", "ÜBER", "ночь", "x1", *"abcdefgh"]
    marks = [" ", " ", ", ", "\n", "[", "…!"]

    def text(n):
        return "".join(rng.choice(words) + rng.choice(marks) for _ in range(n))

    items = [(k, text(rng.choice([9, 10, 11, 24, 60]))) for k in range(30)]
    items += [(100, None), (101, " .. "), (102, "x1 x1 x1"), (103, "é ночь é ночь é"), (104, "Über x1 a b c d e"), (7, text(20))]
    docs = [None, "", "?!", "x1"]
    for _ in range(n_docs):
        parts = [text(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            asked = re.split(r"(?<= )", rng.choice(items)[1] or "")
            a = rng.randint(0, len(asked) // 2)
            parts += ["".join(asked[a : a + rng.randint(7, 30)]).upper(), rng.choice(marks), text(rng.randint(0, 5))]
        docs.append("".join(parts))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_hits_agree_with_every_run_of_words(spark, seed):
    texts, items = made(seed)
    df, asked = documents(spark, texts), benchmark(spark, items)
    rows = check(df, texts, items, asked)
    assert sum(r.n_hit > 0 for r in rows) > 10
    check(df.repartition(3), texts, items, asked, block_bytes=600)


def test_long_texts_in_slices(spark, monkeypatch):
    """Windows that cross the slices of a text, and a word longer than a slice."""
    monkeypatch.setattr(arrays, "PIECE_BYTES", 64)
    texts, items = made(3, 20)
    texts += [" ".join(t or "" for t in texts), "é" * 500 + " " + texts[-1]]
    column = contamination.pa.array(texts)
    passages = contamination.Passages(tuple(t or "" for _, t in items))
    found = {k: [set(), 0, set()] for k in range(len(texts))}
    for row, words, _ in contamination.words_of(column):
        hits, named = passages.hits(words)
        found[row][0] |= {(first, last, a, b) for first, last, a, b in hits.tolist()}
        found[row][1] = words.before + len(words.start)
        found[row][2] |= {items[k][0] for k in named}
    for k, text in enumerate(texts):
        n_words, hit, named = plain(text, items)
        places = [(m.start(), m.end()) for m in WORD.finditer(lower(text))]
        assert {x for a, b, _, _ in found[k][0] for x in range(a, b + 1)} == hit
        assert all((places[a][0], places[b][1]) == (c, d) for a, b, c, d in found[k][0])
        assert (found[k][1], sorted(map(str, found[k][2]))) == (n_words, named)


def test_clean_documents_stay(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    texts = [f"before {passage} after", "one two three four five six seven eight nine, ten", "one two three four five", None]
    df, asked = documents(spark, texts), benchmark(spark, [(1, passage.title())])
    kept = contamination.without_passages(df, asked)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {2, 3}


def test_repeated_rows_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b")] * 3 + [(None, "c"), (2, None)], "doc_id long, text string")
    asked = benchmark(spark, [(5, "A, b!"), (5, "b"), (None, "c")])
    for size in (1 << 20, 1):
        rows = sorted((r.doc_id or 0, r.n_words, r.n_hit, r["items"]) for r in contamination.scan(df, asked, size).collect())
        assert rows == [(0, 1, 1, []), (1, 2, 2, ["5"]), (1, 2, 2, ["5"]), (1, 2, 2, ["5"]), (2, 0, 0, [])]
    assert contamination.scan(spark.createDataFrame([], COLUMNS), asked).collect() == []
    assert [r.n_hit for r in contamination.scan(df, asked.limit(0)).collect()] == [0] * 5
