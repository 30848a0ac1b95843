import hashlib
import random

import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from tokenizers import Tokenizer

from tallyline.llm import bpe, token_counts
from tests.llm.helpers import COLUMNS, documents

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PARTS = list("ab'strevmld 1² \n\t\r\x0b\x1c\x85\xa0 　é中’!?.") + ["<|endoftext|>", "'ll", "'re", " '", "😀", "the", " of"]


def odd_texts(n=400, seed=2):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(30))) for _ in range(n)]
    return [None, "", " ", "<|endoftext|>", *texts, "long " * 60_000, "x" * 30_000, " " * 30_000 + "y"]


def test_pre_tokens_are_the_matches_of_the_pattern():
    texts = odd_texts(3000)
    for found in token_counts.pre_tokens(pa.array(texts), ("<|endoftext|>",)):
        for k in range(len(found.bytes)):
            own = slice(found.bounds[k], found.bounds[k + 1])
            mine = [found.text[a:b] for a, b in zip(found.start[own], found.end[own], strict=True)]
            plain = []
            for j, part in enumerate((texts[found.first + k] or "").split("<|endoftext|>")):
                plain += ["<|endoftext|>"] * (j > 0) + regex.findall(public_tokenizers.PATTERN, part)
            assert mine == plain


def counts(texts):
    encoded = Tokenizer.from_file(JSON).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return {i: (len((t or "").encode()), len(e.ids)) for i, (t, e) in enumerate(zip(texts, encoded, strict=True))}


def found(df):
    return {r.doc_id: (r.n_bytes, r.n_tokens) for r in df.collect()}


def test_counts_agree_with_the_library(spark):
    texts = odd_texts()
    assert found(token_counts.count_tokens(documents(spark, texts), JSON)) == counts(texts)


def test_rare_pre_tokens_are_joined(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "HELD", 50)
    texts = odd_texts(200, seed=3)
    for head in (0, 5, 40):
        assert found(token_counts.count_tokens(documents(spark, texts), JSON, head=head)) == counts(texts)


def test_repeated_and_null_ids_are_counted_one_by_one(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (1, None)], "doc_id long, text string")
    result = sorted(token_counts.count_tokens(df, JSON).collect(), key=str)
    assert [(r.doc_id, r.n_bytes, r.n_tokens) for r in result] == [(1, 0, 0), (1, 3, 2), (1, 3, 2), (None, 3, 2)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert token_counts.count_tokens(none, JSON).collect() == []
    assert bpe.round_trip(none, RANKS, public_tokenizers.PATTERN).collect() == []


def test_ids_are_the_librarys_and_decode_to_the_text(spark, monkeypatch):
    monkeypatch.setattr(bpe, "RUN_CHARS", 100)
    texts = odd_texts()
    plain = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    assert isinstance(plain, tiktoken.Encoding)
    docs = documents(spark, texts)
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert encoded.columns == [*(c for c in docs.columns if c != "ids"), "ids"]
    rows = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.ids == plain.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()
    assert len(rows) == len(texts)
    for r in bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect():
        text = texts[r.doc_id] or ""
        ids = plain.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_long_texts_are_cut_where_no_match_reaches_across():
    plain = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    text = "".join(t or "" for t in odd_texts(2000, seed=9))
    pieces = list(bpe.cut(text, 200))
    assert len(pieces) > 20
    assert [x for p in pieces for x in plain.encode_ordinary(p)] == plain.encode_ordinary(text)


def test_a_run_of_texts_is_small():
    """Ids are handed on for about a million characters at a time, however many texts a batch holds."""
    texts = pa.RecordBatch.from_pydict({"text": ["ab " * 200_000] * 6})
    found = list(bpe._encode(RANKS, public_tokenizers.PATTERN, 0)(iter([texts])))
    assert [b.num_rows for b in found] == [2, 2, 2]
    assert len({tuple(x) for b in found for x in b.column(1).to_pylist()}) == 1
