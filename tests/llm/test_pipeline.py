import hashlib
import re

import public_tokenizers
import pytest

import __spark_entry__ as registered
import corpus_pipeline
from tallyline.llm import bpe, queries
from tests.compare import spark_rows, sql_engine, sql_rows
from tests.llm.helpers import COLUMNS, WORD, component_of, shingles
from tests.llm.test_mixing import filled
from tests.llm.test_quality import plain as plain_quality

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_sql(spark, name):
    names, rows = spark_rows(queries.QUERIES[name](spark, FOLDER))
    expected_names, expected = sql_rows(sql_engine(FOLDER), queries.SQL[name])
    assert names == expected_names and rows == expected and rows


def test_all_queries_are_registered():
    assert queries.QUERIES.keys() <= registered.queries().keys()
    assert queries.SQL.items() <= registered.oracle_sql().items()
    assert [n for k in range(1, 11) for n in queries.QUERIES if n.startswith(f"op{k}_")] and "pipeline" in queries.QUERIES


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and returned."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = []
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, FOLDER)
        out.append((docs.collect(), result.collect()))
        docs = spark.createDataFrame(out[-1][1], result.schema)
    return out


def test_columns_of_documents(stages, spark):
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    for _, after in stages[:-1]:
        assert list(after[0].asDict()) == columns
        assert all(r.n_chars == len(r.text) for r in after)


def test_quality_rules(stages):
    before, after = stages[0]
    expected = {}
    for r in before:
        counts, lines = plain_quality(r.text)
        if counts[-1]:
            expected[r.doc_id] = "\n".join(lines) if counts[5] else r.text
    assert {r.doc_id: r.text for r in after} == expected


def test_near_duplicates(stages):
    before, after = stages[1]
    sets = {r.doc_id: shingles(r.text) for r in before}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if b < a and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert sorted(r.doc_id for r in after) == sorted(set(component_of(ids, links).values()))


def test_personal_data(stages):
    before, after = ({r.doc_id: r.text for r in rows} for rows in stages[2])
    private = re.compile(r"[\w.]+@[\w.]+|\+\d \(\d{3}\) \d{3}-\d{4}|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b[0-9a-f]{40}\b")
    assert before.keys() == after.keys()
    for i, text in before.items():
        found = private.findall(text)
        assert not [x for x in found if x in after[i]]
        if not re.search(r"\d", text):
            assert after[i] == text
    assert any(before[i] != after[i] for i in before)


def test_mixture(stages):
    before, after = stages[3]
    size = {r.doc_id: len(WORD.findall(r.text)) for r in before}
    by_source, taken = {}, {}
    for r in before:
        by_source[r.source] = by_source.get(r.source, 0) + size[r.doc_id]
    for r in after:
        taken[r.source] = taken.get(r.source, 0) + len(WORD.findall(r.text))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(by_source))}
    for s, target in filled(by_source, weights, 1.5, 2).items():
        assert abs(taken.get(s, 0) - target) <= 0.5


def test_token_ids(stages):
    before, after = stages[4]
    plain = bpe.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    expected = []
    for r in before:
        ids = plain.encode_ordinary(r.text)
        expected.append((r.doc_id, len(ids), hashlib.sha256(r.text.encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in after) == sorted(expected)


def test_odd_rows_and_an_empty_table(spark, tmp_path):
    prose = "\n".join(" ".join(f"w{k * n}" for n in range(1, 12)) + "." for k in range(10, 30))
    rows = [(None, prose, None, None, None), (1, prose, "en", "a", 5), (1, prose, "en", "a", 5), (2, None, "en", "a", 0), (3, "", None, "b", 0)]
    for name, data in (("odd", rows), ("none", [])):
        path = str(tmp_path / name)
        spark.createDataFrame(data, COLUMNS).write.parquet(f"{path}/documents.parquet")
        result = corpus_pipeline.run(spark, path).collect()
        assert {r.doc_id for r in result} == ({1} if data else set())
