"""Documents whose sets of word n-grams overlap, found by parity sketches.

Method. Every n-gram XORs its hash into one word of a sketch of k words. For two sets
with Jaccard similarity of 0.75 or more the symmetric difference is at most a seventh of
the sum of sizes; each of its n-grams changes one word at most, so that k is taken one
above that bound for a band of sizes and at least one word agrees (pigeonhole). A word
together with its band and place is a bucket key. Candidates are then tested with a
second sketch of single bits, whose Hamming distance cannot exceed the symmetric
difference, and last with the exact sets.

Words without n-grams agree too, so such empty words give no key. Small sets, which may
have nothing but an empty word in common, therefore get several sketches with different
hashes, and large sets use the first PROBES of their words: at the limit of similarity a
word agrees with a probability of 0.36 to 0.5, and a pair is missed with one below 1e-6.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import arrays
from tallyline.llm.clusters import linked, shared
from tallyline.llm.filters import Picker
from tallyline.llm.storing import stored

PROBES = 32
# Low bits of a bucket key that hold the band.
_BAND = np.uint64(127)
# Words of the short bit sketch that the bucket join tests.
SHORT = 8
# Sets smaller than this link with equal sets only: 2 of 3 are less than 0.75.
SMALLEST = 3

FEATURES = "doc_id long, row long, n_shingles long, d1 long, d2 long, keys array<long>, sketch array<long>, short array<long>"


def band_edges(most: int) -> list[int]:
    """Lower ends of the size bands, by a factor of 4/3, up to the first beyond ``most``."""
    edges = [SMALLEST]
    while edges[-1] <= most:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * 4 // 3)))
    return edges


_EDGES = band_edges(1 << 40)


def sketch_words(band: int) -> int:
    """k of a band: one more than the largest symmetric difference of a pair whose smaller set is in it."""
    smaller = _EDGES[band + 1] - 1
    return (smaller + smaller * 4 // 3) // 7 + 1


def bands(n: int) -> range:
    """Bands in which a set of n can be the smaller or the larger of a pair."""
    if n < SMALLEST:
        return range(0)
    return range(max(bisect_right(_EDGES, -(-n * 3 // 4)) - 1, 0), bisect_right(_EDGES, n))


@cache
def _tables(band: int) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a sketch and how many are used; seed and first word of each sketch; salt of each word."""
    k = sketch_words(band)
    used, sketches = min(k, PROBES), -(-PROBES // k)
    seeds = arrays.numbers(sketches, 100 + band)[:, None]
    return k, used, seeds, np.arange(sketches)[:, None] * used, arrays.numbers(sketches * used, 1000 + band)


def bucket_keys(shingles: np.ndarray) -> np.ndarray:
    """Keys of the sketch words of a set, for every band it takes part in."""
    content = arrays.mixed(shingles + np.uint64(0x5851F42D4C957F2D))
    out = []
    for band in bands(len(shingles)):
        k, used, seeds, first, salt = _tables(band)
        place = arrays.mixed(shingles ^ seeds) % np.uint64(k)
        words = np.zeros(len(salt), dtype=np.uint64)
        if used < k:
            chosen = place[0] < used
            np.bitwise_xor.at(words, place[0, chosen].astype(np.int64), content[chosen])
        else:
            at = (place.astype(np.int64) + first).ravel()
            np.bitwise_xor.at(words, at, np.tile(content, len(seeds)))
        full = words != 0
        out.append(arrays.mixed(words[full] ^ salt[full]) & ~_BAND | np.uint64(band))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, dtype=np.uint64)


def bit_sketch(shingles: np.ndarray, words: int | None = None) -> np.ndarray:
    """Parities of hashed bits, at least two for each n-gram, or folded to ``words`` words of 64.

    The XOR of its halves is the sketch of half the bits, and bounds the difference as well.
    """
    bits = max(64 * SHORT, 1 << int(2 * len(shingles) - 1).bit_length()) if words is None else 64 * words
    place = arrays.mixed(shingles ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(bits - 1)
    parity = np.bincount(place.astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(parity, bitorder="little").view(np.uint64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, rows = batch.column(0), batch.column(1)
        n, d1, d2, keys, sketches, shorts = [], [], [], [], [], []
        for _, found in arrays.shingle_sets(batch.column(2)):
            n.append(len(found))
            d1.append(arrays.mixed(found).sum(dtype=np.uint64))
            d2.append(arrays.mixed(found ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64))
            keys.append(bucket_keys(found))
            sketches.append(bit_sketch(found) if len(found) else np.zeros(0, np.uint64))
            shorts.append(np.bitwise_xor.reduce(sketches[-1].reshape(-1, SHORT), axis=0))
        yield pa.RecordBatch.from_arrays(
            [
                ids,
                rows,
                pa.array(np.array(n, dtype=np.int64)),
                pa.array(arrays.signed(np.array(d1, dtype=np.uint64))),
                pa.array(arrays.signed(np.array(d2, dtype=np.uint64))),
                arrays.lists(keys),
                arrays.lists(sketches),
                arrays.lists(shorts),
            ],
            names=["doc_id", "row", "n_shingles", "d1", "d2", "keys", "sketch", "short"],
        )


def _sets(picker: Picker):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            kept = np.flatnonzero(picker.may_want(first, second))
            if not len(kept):
                continue
            for at in range(0, len(kept), 500):
                part = pa.array(kept[at : at + 500])
                found = [s for _, s in arrays.shingle_sets(batch.column(2).take(part))]
                sums = np.array([arrays.mixed(s).sum(dtype=np.uint64) for s in found], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(part), pa.array(arrays.signed(sums)), arrays.lists(found)],
                    names=["row", "d1", "shingles"],
                )

    return run


def _distance(a: str, b: str):
    """Hamming distance of two bit sketches; the longer is folded to the shorter's length first."""
    fold = "zip_with(slice({0}, 1, size({0}) div 2), slice({0}, size({0}) div 2 + 1, size({0}) div 2), (x, y) -> x ^ y)"
    a, b = (
        f"if(size({x}) > size({y}), {fold.format(x)}, {x})" for x, y in ((a, b), (b, a))
    )
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)")


def _band(n):
    """The band of a size: the last whose lower end is not above it."""
    edges = F.array(*[F.lit(x) for x in _EDGES])
    return F.size(F.filter(edges, lambda x: x <= n)) - 1


def _near(x: str, y: str):
    """What every link of a bucket fulfils: sizes, the band of the smaller set, and short sketches."""
    n = F.col(f"{x}n"), F.col(f"{y}n")
    sizes = 3 * F.greatest(*n) <= 4 * F.least(*n)
    band = F.least(f"{x}band", f"{y}band") == F.col("key").bitwiseAND(F.lit(int(_BAND)))
    bits = sum((F.bit_count(F.col(f"{x}s{k}").bitwiseXOR(F.col(f"{y}s{k}"))) for k in range(SHORT)), F.lit(0))
    return sizes & band & (7 * bits <= n[0] + n[1])


def similar_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    Two rows link when 100 * intersection >= 75 * union of their sets of five-word
    shingles, words being in lower-case A-Z. ``component_id`` is the smallest doc_id that
    links reach. Null and empty texts, and texts without words, have no shingles, link
    with nothing and keep their own doc_id. Texts with fewer than five words link when
    their whole sequences are equal. Rows with one doc_id stay rows of their own; a null
    doc_id counts only where no other is reached. Other columns are ignored; an empty
    table gives an empty result.

    Equal sets are one class from the start: only the first row of a class has buckets
    and is compared, so copies cost one row each.
    """
    features, of_class = _classed(docs)
    return (
        features.select("doc_id", "n_shingles", "d1", "d2")
        .join(of_class, ["d1", "d2"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )


def representatives(docs: DataFrame) -> DataFrame:
    """Of each component of ``similar_documents`` the row of ``docs`` with the smallest doc_id.

    A null doc_id comes last; of rows with that doc_id and different texts the one with the
    smallest hash stays, and one of equal rows. Rows without shingles all stay. All columns
    are returned.
    """
    features, of_class = _classed(docs)
    place = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc_id"), "row")
    chosen = (
        features.where("n_shingles > 0")
        .join(of_class, ["d1", "d2"])
        .groupBy("component")
        .agg(F.min(place).alias("first"))
        .select(F.col("first.row").alias("row"))
    )
    # the row as one column, so that no name of it meets a name used here
    rows = docs.select(F.struct(*docs.columns).alias("doc"), _row().alias("row"))
    full = rows.join(chosen, "row", "left_semi").dropDuplicates(["row"])
    none = rows.where(~F.coalesce(F.col("doc.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return full.unionByName(none).select("doc.*")


def _row():
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))


def _classed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features of every row, and component and component_id of every set."""
    source = docs.select(F.col("doc_id").cast("long"), _row().alias("row"), "text")
    features = source.mapInArrow(_features, FEATURES).withColumn("uid", F.monotonically_increasing_id())
    features = stored(features, "features")
    classes = stored(
        features.where("n_shingles > 0")
        .groupBy("d1", "d2")
        .agg(F.min("uid").alias("uid"), F.min("doc_id").alias("first_id")),
        "classes",
    )
    one = stored(
        features.join(classes.select("uid"), "uid", "left_semi").drop("doc_id", "d2"), "one-each"
    )
    members = stored(shared(one.select("uid", F.explode("keys").alias("key"))), "members")
    wanted = one.join(members.select("uid").distinct(), "uid", "left_semi").select("row", "d1", "uid")
    wanted = stored(wanted, "wanted")
    picker = Picker(wanted.select("row"))
    sets = source.select("row", F.xxhash64("row"), "text").mapInArrow(
        _sets(picker), "row long, d1 long, shingles array<long>"
    )
    sets = sets.join(wanted, ["row", "d1"]).groupBy("uid").agg(F.first("shingles").alias("shingles"))
    sets = stored(sets, "sets")

    def confirm(pairs: DataFrame) -> DataFrame:
        for x in "ab":
            sketches = one.select(
                F.col("uid").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")
            )
            pairs = pairs.join(sketches, x)
        near = pairs.where("3 * greatest(n_a, n_b) <= 4 * least(n_a, n_b)").where(
            7 * _distance("s_a", "s_b") <= F.col("n_a") + F.col("n_b")
        )
        near = stored(near.drop("s_a", "s_b"), "near")
        for x in "ab":
            near = near.join(sets.select(F.col("uid").alias(x), F.col("shingles").alias(f"s_{x}")), x)
        near = near.withColumn("common", F.size(F.array_intersect("s_a", "s_b")))
        return near.where("100 * common >= 75 * (n_a + n_b - common)").select("a", "b")

    shorts = [F.col("short")[k].alias(f"s{k}") for k in range(SHORT)]
    traits = one.select("uid", F.col("n_shingles").alias("n"), _band(F.col("n_shingles")).alias("band"), *shorts)
    labels = linked(members, traits, _near, confirm)
    named = classes.join(labels, "uid", "left").withColumn("component", F.coalesce("component", "uid"))
    named = stored(named, "named-classes")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return features, stored(named.join(least, "component").select("d1", "d2", "component", "component_id"), "components")
