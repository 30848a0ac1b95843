import random

import numpy as np
import pytest

from tallyline.llm import arrays, licenses
from tests.llm.helpers import COLUMNS, documents


def words(text):
    data = (text or "").encode()
    out, run = [], bytearray()
    for byte in data + b" ":
        if licenses.BETWEEN[byte]:
            if run:
                out.append(bytes(run).decode("utf-8", errors="replace").lower())
            run = bytearray()
        else:
            run.append(byte)
    return out


def plain(text, templates):
    """Best containment of each template over all windows at its step."""
    own, out = words(text), {}
    for name, template in templates.items():
        wanted = words(template)
        if not wanted:
            continue
        size, step, width = licenses.shape(len(wanted))
        grams = lambda w: {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}  # noqa: B023, E731
        shares = {s: len(grams(own[s : s + width]) & grams(wanted)) / len(grams(wanted)) for s in range(0, len(own), step)}
        good = {s: x for s, x in shares.items() if x >= licenses.LEAST}
        if good:
            out[name] = (max(good.values()), min(good), len(good))
    return out


def texts(n=120, seed=3):
    rng = random.Random(seed)
    notices = list(licenses.NOTICES.values())
    out = []
    for _ in range(n):
        own = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            notice = rng.choice(notices).split(" ")
            for _ in range(rng.randrange(3)):
                notice[rng.randrange(len(notice))] = rng.choice(["changed", "license", "THE", "###"])
            at = rng.randrange(len(own) + 1)
            own[at:at] = notice
        out.append(rng.choice([" ", "\n", " ### "]).join(own))
    return [None, "", "###", "All rights reserved", "ALL Rights---reserved!", "x " * 200_000 + notices[0], *out]


def test_agrees_with_all_windows(spark):
    docs = texts()
    rows = licenses.scan(documents(spark, docs), licenses.notices(spark)).collect()
    found = {(r.doc_id, r.license): (pytest.approx(r.containment), r.word_start, r.windows) for r in rows}
    expected = {(i, name): x for i, t in enumerate(docs) if i != 5 for name, x in plain(t, licenses.NOTICES).items()}
    assert found.pop((5, "Apache-2.0")) == (1.0, 199_999, 3)
    assert found == expected and len(rows) == len(found) + 1


def test_bands_find_what_is_contained_enough():
    rng = np.random.default_rng(4)
    missed = 0
    for _ in range(2000):
        n = int(rng.integers(12, 60))
        size, _, width = licenses.shape(n)
        template = rng.integers(0, 2**62, n - size + 1).astype(np.uint64)
        left = template[: -(-len(template) * 3 // 4)]
        window = np.concatenate([left, rng.integers(0, 2**62, width - size + 1 - len(left)).astype(np.uint64)])
        missed += not set(licenses.band_keys(template, n).tolist()) & set(licenses.band_keys(window, n).tolist())
    assert missed == 0


def test_own_templates_repeated_rows_and_empty_tables(spark):
    templates = spark.createDataFrame([("none", "### !"), ("null", None), ("one", "Copyleft"), ("x", "a b c d e f g h")], "license string, text string")
    df = spark.createDataFrame([(None, "so copyleft it is"), (2, "a b c d e f g z"), (2, "a b c d e f g z"), (3, None)], "doc_id long, text string")
    rows = sorted(((r.doc_id, r.license, r.containment) for r in licenses.scan(df, templates).collect()), key=str)
    assert rows == [(2, "x", 0.75)] * 2 + [(None, "one", 1.0)]
    assert licenses.scan(spark.createDataFrame([], COLUMNS), templates).collect() == []
    assert licenses.scan(df, templates.filter("false")).collect() == []


def test_words_are_what_the_scan_sees():
    import pyarrow as pa

    for found in arrays.words(pa.array(["CC BY-NC 4.0.", "é-ß"]), lower=True, between=licenses.BETWEEN):
        got = [bytes(found.data[a:b]).decode() for a, b in zip(found.start, found.end, strict=True)]
        assert got == ["cc", "by", "nc", "4", "0", "é", "ß"]


def test_whole_and_cut_texts_and_changed_short_notices(spark):
    texts = licenses.texts()
    gpl = words(texts["GPL-2.0-whole"])
    docs = [
        "so " + texts["BSD-3-Clause-whole"],
        " ".join(gpl[1000:1400]),
        "Licensed under the MIT License",
        "Released under the BSD License",
        " ".join(f"w{k}" for k in range(300)),
    ]
    rows = licenses.scan(documents(spark, docs), licenses.all_templates(spark)).collect()
    found = {(r.doc_id, r.license) for r in rows}
    assert (0, "BSD-3-Clause-whole") in found
    assert {(1, f"GPL-2.0-part-{k}") for k in (11, 12, 13, 14)} <= found and (1, "GPL-2.0-whole") not in found
    assert {x for x in found if x[0] > 1} == {(2, "MIT")}
    assert len(rows) == len(found)


def test_matches_resolve_to_licences(spark):
    texts = licenses.texts()
    gpl = words(texts["GPL-2.0-whole"])
    docs = [
        texts["LGPL-2.1-whole"],
        "so " + texts["ISC-whole"],
        " ".join(gpl[1000:1400]),
        "one two. " + licenses.NOTICES["MIT"] + " three. " + licenses.NOTICES["GPL-3.0-or-later"],
        " ".join(f"w{k}" for k in range(300)),
        None,
        texts["MIT-whole"] + " and then " + texts["BSD-3-Clause-whole"],
    ]
    df = documents(spark, docs)
    rows = licenses.resolve(df, licenses.all_templates(spark)).collect()
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, {})[r.license] = r
    assert len(rows) == sum(map(len, found.values()))
    assert {k: set(v) for k, v in found.items() if k != 2} == {
        0: {"LGPL-2.1"}, 1: {"ISC"}, 3: {"MIT", "GPL-3.0-or-later"}, 6: {"MIT", "BSD-3-Clause", "All-rights-reserved"},
    }
    lgpl = found[0]["LGPL-2.1"]
    assert (lgpl.kind, lgpl.share, lgpl.first_word) == ("text", 1.0, 0) and lgpl.last_word > 4000
    assert found[1]["ISC"].share == 1.0 and found[3]["MIT"].kind == "notice"
    assert "GPL-2.0" in found[2] and 0.1 < found[2]["GPL-2.0"].share < 0.3
    best = max(r.share for r in found[2].values())
    assert found[2]["GPL-2.0"].share >= 0.9 * best
    # the scan itself names every template
    assert licenses.scan(df, licenses.all_templates(spark)).where("doc_id = 0").count() > 50
