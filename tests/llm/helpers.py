"""Small documents and plain versions of what the operators compute."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=None):
    """A table of documents with ids from 0, and columns whose names the operators use as well."""
    rows = [
        (i, t, "en", sources[i] if sources else f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    for name in ("row", "uid", "key", "size", "kept", "ids", "n_words", "component_id", "_range"):
        df = df.selectExpr("*", f"doc_id + 7 as {name}")
    return df


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text):
    words = WORD.findall(lower(text))
    if not words:
        return set()
    if len(words) < 5:
        return {tuple(words)}
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def component_of(nodes, links):
    """The smallest node that links reach, for each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
