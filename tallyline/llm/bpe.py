"""Byte-level BPE token ids of documents, and the bytes of token ids.

Ranks come from a local file. Long texts are encoded piece by piece, cut where no match of
the split pattern can reach across: between a word character and white space, as no match
holds white space after anything else. Ids decode to raw bytes, which need not be valid
UTF-8 before they are put together.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters after which a text is cut at the next safe place.
CUT_AT = 1 << 16
# Texts are handed back to Spark in runs of about this many characters.
RUN_CHARS = 1 << 20


@cache
def encoding(path: str, pattern: str):
    """The encoding of a rank file: lines of base64 bytes and a rank; no special tokens."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@cache
def _safe_cut():
    import regex

    return regex.compile(r"(?<=\w)(?=[ \n])")


def cut(text: str, size: int = CUT_AT) -> Iterator[str]:
    """The text in pieces of at least ``size`` characters that can be encoded one by one."""
    at = 0
    while len(text) - at > size:
        found = _safe_cut().search(text, at + size)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def _ids(encoder, text: str | None) -> list[int]:
    out: list[int] = []
    for piece in cut(text or ""):
        out += encoder.encode_ordinary(piece)
    return out


def _runs(lengths, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` units."""
    at, held = 0, 0
    for k, n in enumerate(lengths):
        held += n or 0
        if held >= most:
            yield at, k + 1
            at, held = k + 1, 0
    if at < len(lengths):
        yield at, len(lengths)


def _encode(path: str, pattern: str, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        encoder = encoding(path, pattern)
        for batch in batches:
            lengths = pc.utf8_length(batch.column(at)).to_pylist()
            for a, b in _runs(lengths, RUN_CHARS):
                part = batch.slice(a, b - a)
                ids = pa.array((_ids(encoder, x.as_py()) for x in part.column(at)), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, ids], names=[*part.schema.names, "ids"]
                )

    return run


def _decode(path: str, pattern: str, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(path, pattern)
        for batch in batches:
            lengths = [len(x) if x.is_valid else 0 for x in batch.column(at)]
            for a, b in _runs(lengths, RUN_CHARS):
                part = batch.slice(a, b - a)
                decoded = [encoder.decode_bytes(x) if x is not None else None for x in _lists(part.column(at))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(decoded, pa.binary())], names=[*part.schema.names, "decoded"]
                )

    return run


def _lists(column: pa.Array) -> Iterator[list[int] | None]:
    for x in column:
        yield x.values.to_numpy().tolist() if x.is_valid else None


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the token ids of the whole text; an earlier column ``ids`` is replaced.

    Each match of ``pattern`` is encoded separately; special strings are ordinary text. A
    null or empty text has no ids. Every row is encoded for itself, so repeated rows and
    null keys need no rule; an empty table gives an empty result. ``path`` is the rank
    file, found there on every executor.
    """
    docs = docs.drop("ids")
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(_encode(path, pattern, docs.columns.index(text)), schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ``ids``; null ids have null bytes."""
    encoded = encoded.drop("decoded")
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    return encoded.mapInArrow(_decode(path, pattern, encoded.columns.index("ids")), schema)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids and of the bytes they decode to.

    Both ways run in one Python worker, batch by batch, so that ids go through Spark once.
    """
    there, back = _encode(path, pattern, 1), _decode(path, pattern, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in back(there(batches)):
            yield batch.select(["doc_id", "ids", "decoded"])

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    found = texts.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
