import random
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import clusters, paragraphs, storing
from tests.llm.helpers import COLUMNS, WORD, component_of, documents, lower, shingles


def fresh(rng, n):
    return [f"w{rng.randrange(10**7)}" for _ in range(n)]


def line_words(text):
    """(first word, words) of the lines with enough words."""
    at, out = 0, []
    for line in (text or "").split("\n"):
        own = WORD.findall(lower(line))
        if len(own) >= paragraphs.LEAST_WORDS:
            out.append((at, own))
        at += len(own)
    return out


def plain_lines(texts):
    """Rows of near-equal lines of different documents, by comparing all pairs."""
    lines = [(i, s, w, shingles(" ".join(w))) for i, t in enumerate(texts) for s, w in line_words(t)]
    links = [
        (a, b)
        for a in range(len(lines))
        for b in range(a)
        if len(lines[a][3] & lines[b][3]) >= 0.75 * len(lines[a][3] | lines[b][3])
    ]
    groups = {}
    for n, c in component_of(range(len(lines)), links).items():
        groups.setdefault(c, []).append(lines[n][:3])
    out = set()
    for rows in groups.values():
        if len({i for i, _, _ in rows}) > 1:
            first = min((i, s) for i, s, _ in rows)
            out |= {(i, s, len(w), first[0], (i, s) != first) for i, s, w in rows}
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    originals = [fresh(rng, rng.choice([30, 60, 120])) for _ in range(12)]
    passages = [fresh(rng, 51) for _ in range(6)]
    texts = [None, "", "short line", "x " * 40]
    planted = set()
    for k in range(120):
        lines = [fresh(rng, rng.choice([5, 20, 26, 70])) for _ in range(rng.randrange(1, 5))]
        if k % 3 == 0:
            copy = list(rng.choice(originals))
            for _ in range(rng.choice([0, 0, 1, 2])):
                copy[rng.randrange(len(copy))] = "changed"
            lines.insert(rng.randrange(len(lines) + 1), copy)
        if k % 4 == 0:
            line = rng.choice(lines)
            at = rng.randrange(len(line) + 1)
            line[at:at] = rng.choice(passages)
            planted.add(len(texts))
        texts.append("\n".join(" ".join(x) for x in lines).upper())
    return texts, planted, passages


@pytest.fixture(scope="module")
def found(spark):
    texts, planted, passages = corpus()
    rows = paragraphs.repeated_paragraphs(documents(spark, texts)).collect()
    return texts, planted, passages, rows


def test_lines_agree_with_all_pairs(found):
    texts, _, _, rows = found
    lines = {(r.doc_id, r.start, r.n_words, r.component_id, r.removed) for r in rows if r.kind == "line"}
    expected = plain_lines(texts)
    assert lines <= expected
    # bands miss a link at the limit with a probability of a hundredth
    assert len(lines) >= 0.98 * len(expected)


def test_every_passage_of_fifty_words_is_found(found):
    texts, planted, passages, rows = found
    holders = {i for i in planted if sum(any(" ".join(p).upper() in (texts[j] or "") for p in passages if " ".join(p).upper() in texts[i]) for j in planted) > 1}
    windows = {r.doc_id for r in rows if r.kind == "window"}
    assert holders <= windows


def test_windows_are_equal_runs_of_different_documents(found):
    texts, _, _, rows = found
    runs = {}
    for r in rows:
        if r.kind == "window":
            run = tuple(WORD.findall(lower(texts[r.doc_id]))[r.start : r.start + r.n_words])
            assert len(run) == paragraphs.LEAST_WORDS
            runs.setdefault(run, []).append(r)
    for same in runs.values():
        assert len({r.doc_id for r in same}) > 1
        assert {r.component_id for r in same} == {min(r.doc_id for r in same)}
        assert sum(not r.removed for r in same) == 1


def test_clean_documents_have_no_rows(spark):
    rng = random.Random(9)
    texts = ["\n".join(" ".join(fresh(rng, 60)) for _ in range(4)) for _ in range(50)]
    texts = [t + "\nAll rights reserved." for t in texts] + ["again and again " * 40]
    assert paragraphs.repeated_paragraphs(documents(spark, texts)).collect() == []


def test_window_starts_of_equal_passages_agree():
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 2**62, 46).astype(np.uint64)
    for _ in range(200):
        head, tail = (rng.integers(0, 2**62, n).astype(np.uint64) for n in rng.integers(0, 90, 2))
        starts = paragraphs.window_starts(np.concatenate([head, passage, tail])) - len(head)
        inside = [s for s in starts if 0 <= s <= 50 - paragraphs.LEAST_WORDS]
        assert inside


def test_bands_are_tuned_for_recall():
    bands = paragraphs.tuned_bands()
    assert 1 - (1 - 0.75**paragraphs.ROWS) ** bands >= paragraphs.RECALL > 1 - (1 - 0.75**paragraphs.ROWS) ** (bands - 1)


def test_null_ids_repeated_rows_and_empty_tables(spark):
    line = " ".join(f"w{k}" for k in range(60))
    df = spark.createDataFrame([(None, line), (7, line), (7, line), (8, "y\n" + line)], "doc_id long, text string").selectExpr("*", "1 as kind", "2 as start", "3 as first")
    rows = paragraphs.repeated_paragraphs(df).collect()
    lines = sorted(((r.doc_id or -1, r.start, r.component_id, r.removed) for r in rows if r.kind == "line"))
    assert lines == [(-1, 0, 7, True), (7, 0, 7, False), (7, 0, 7, False), (8, 1, 7, True)]
    assert paragraphs.repeated_paragraphs(spark.createDataFrame([], COLUMNS)).collect() == []


def result_rows(spark, texts):
    rows = paragraphs.repeated_paragraphs(documents(spark, texts)).collect()
    return {(r.doc_id, r.kind, r.start, r.n_words, r.component_id, r.removed) for r in rows}


def test_short_lines_and_wrapped_blocks_are_paragraphs(spark):
    rng = random.Random(21)
    short, long, five = fresh(rng, 24), fresh(rng, 60), fresh(rng, 5)
    wrapped = "\n".join(" ".join(long[k : k + 4]) for k in range(0, 60, 4))
    texts = [
        " ".join(fresh(rng, 30)) + "\n" + " ".join(short),
        " ".join(short[:-1]) + " other\n" + " ".join(fresh(rng, 40)),
        " ".join(long),
        " ".join(fresh(rng, 9)) + "\n \n" + wrapped.replace(long[30], "other") + "\n\n" + " ".join(fresh(rng, 9)),
        " ".join(five) + "\n" + " ".join(fresh(rng, 90)),
        " ".join(fresh(rng, 90)) + "\n" + " ".join(five),
    ]
    found = {x for x in result_rows(spark, texts) if x[1] in ("line", "block")}
    assert found == {
        (0, "line", 30, 24, 0, False),
        (1, "line", 0, 24, 0, True),
        (2, "line", 0, 60, 2, False),
        (3, "block", 9, 60, 2, True),
        (4, "line", 0, 5, 4, False),
        (5, "line", 90, 5, 4, True),
    }


def test_a_link_at_the_limit_is_missed_once_in_a_million():
    assert (1 - paragraphs.SIMILARITY**paragraphs.ROWS) ** paragraphs.tuned_bands() <= 1e-6


def test_passages_with_changed_words_are_found(spark):
    rng = random.Random(33)
    texts = []
    for _ in range(6):
        passage = fresh(rng, 140)
        for every in (None, 35):
            copy = [f"new{rng.random()}" if every and k % every == every // 2 else w for k, w in enumerate(passage)]
            texts.append(" ".join(fresh(rng, rng.randrange(150, 250)) + copy + fresh(rng, rng.randrange(150, 250))))
    found = [x for x in result_rows(spark, texts) if x[1] == "passage"]
    assert {x[0] for x in found} == set(range(12))
    assert {x[4] for x in found} == set(range(0, 12, 2))
    assert all(x[3] == paragraphs.PASSAGE_WORDS and x[5] == (x[0] % 2 == 1) for x in found)


def test_long_hashes_are_those_of_spark(spark):
    values = [0, 1, -1, 2**63 - 1, -(2**63), 123456789012345]
    rows = spark.createDataFrame([(v,) for v in values], "v long").selectExpr("xxhash64(v) h").collect()
    assert paragraphs.long_hashes(np.array(values, dtype=np.int64)).tolist() == [r.h for r in rows]


def plain_components(links):
    least = {x: x for link in links for x in link}
    while any(least[a] != least[b] for a, b in links):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return least


def test_links_of_stars_and_of_the_rest_give_all_components(spark):
    rng = random.Random(5)
    keys = [(k, u) for u in range(120) for k in rng.sample(range(12), 2)]
    right = {(a, b) for a in range(120) for b in range(a + 1, 120) if rng.random() < 0.1}
    shared = {(a, b) for k, a in keys for m, b in keys if k == m and a < b}
    asked = []

    def confirm(pairs):
        asked.append(pairs.count())
        return pairs.join(spark.createDataFrame(sorted(right), "a long, b long"), ["a", "b"])

    near = lambda x, y: (F.col(f"{x}n") - F.col(f"{y}n")) % 7 != 0
    links = {(a, b) for a, b in shared & right if (a - b) % 7}
    members = spark.createDataFrame(keys, "key long, uid long")
    stars = spark.createDataFrame([(100 * k + u % 3, u) for k, u in keys], "key long, uid long")
    traits = spark.range(120).selectExpr("id as uid", "id as n")
    found = clusters.linked_by_stars(stars, members, traits, near, confirm).collect()
    expected = plain_components(links)
    assert {r.uid: r.component for r in found} == expected and len(found) == len(expected)
    assert sum(asked) <= sum((a - b) % 7 != 0 for a, b in shared)


def test_work_tables_and_shuffles_end_once_read(spark, tmp_path, monkeypatch):
    local = [Path(str(d)) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffled = lambda: {f for d in local for f in d.rglob("shuffle_*.data")}
    before = shuffled()
    storing.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(50):
        if not (left := shuffled() - before):
            break
        time.sleep(0.1)
    assert not left
    rng = random.Random(34)
    passage = fresh(rng, 140)
    texts = [" ".join(fresh(rng, 160) + ["new" if k == 60 * n else w for k, w in enumerate(passage)]) for n in range(3)]
    monkeypatch.setattr(storing, "new_path", lambda _, name: str(tmp_path / f"{name}-{len(list(tmp_path.iterdir()))}-{rng.random()}"))
    assert {x[0] for x in result_rows(spark, texts) if x[1] == "passage"} == {0, 1, 2}
    names = Counter(d.name.split("-0.")[0].rsplit("-", 1)[0] for d in tmp_path.iterdir())
    assert not names.keys() & {"paragraphs", "sets", "star-pairs", "near-pairs", "apart", "rest-pairs"}
    assert names["edges"] <= 1 and names["passages"] == 1
