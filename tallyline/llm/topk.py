"""Exact top-k search by inner product, with vectors in order of length.

Vectors are rotated into the basis of their singular vectors, so that the first
coordinates hold most of an inner product, and kept in ranges of descending length.
A query compares itself with a range block by block. By Cauchy-Schwarz a score is at most
the product of lengths, and at most the partial sum over the first coordinates plus the
product of the lengths of the rest; what stays below the k-th best score so far is left
out. Scores of the others are computed exactly from the integer components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.storing import stored

SCALE = 1024
# Vectors of a range, queries of a group, and vectors of a block within a range.
RANGE_ROWS = 8192
GROUP_QUERIES = 1024
BLOCK = 1024
# Ranges of the length that queries need of a vector, by which they are grouped.
NEEDS = 64
# Longest vectors that give each query its first limit.
FIRST = 2048
# Shares of the coordinates after which partial sums are tested.
STEPS = (0.25, 0.5)
# Bound of rounding errors of partial sums, as a share of the product of lengths.
SLACK = 1e-9


def whole_numbers(vectors: DataFrame, column: str, scale: int = SCALE) -> DataFrame:
    """vec_id and ``v``, the components times ``scale`` rounded down; rows that take part only."""
    message = F.lit("a component is too large to be a whole number of 64 bits")

    def whole(x):
        y = F.floor(F.lit(float(scale)) * x.cast("double"))
        return F.when(F.abs(F.lit(float(scale)) * x.cast("double")) < 2.0**63, y).otherwise(F.raise_error(message))

    scaled = F.transform(column, whole)
    finite = ~F.exists(
        column, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    )
    return vectors.where(F.col("vec_id").isNotNull() & F.col(column).isNotNull() & finite).select(
        F.col("vec_id").cast("long"), scaled.alias("v")
    )


def _matrix(lists, width: int) -> np.ndarray:
    """Rows of whole numbers, filled with zeros to one width."""
    out = np.zeros((len(lists), width), dtype=np.int64)
    for k, x in enumerate(lists):
        out[k, : len(x)] = x
    return out


def _products(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch.column(0).to_pylist(), width).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"]
        )

    return run


def _added_up(rows: pa.Table) -> pa.Table:
    """The sum of the rows of one column's products."""
    flat = rows["sums"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
    return pa.table({"i": rows["i"].slice(0, 1), "sums": pa.array([flat.sum(axis=0)], pa.list_(pa.float64()))})


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all rows by falling singular value.

    The products of columns are added up by task and then row by row of the table of sums, of
    which only the ``width`` rows reach the driver, as arrays.
    """
    if not width:
        return np.zeros((0, 0))
    sums = (
        vectors.select("v")
        .mapInArrow(_products(width), "i long, sums array<double>")
        .groupBy("i")
        .applyInArrow(_added_up, "i long, sums array<double>")
        .toArrow()
    )
    gram = np.zeros((width, width))
    for i, row in zip(sums["i"].to_pylist(), sums["sums"], strict=True):
        gram[i] = row.values.to_numpy()
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()


def exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products row by row; whole numbers beyond 63 bits raise an error."""
    if not len(q):
        return np.zeros(0, dtype=np.int64)
    if float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] < 2.0**62:
        return (q * v).sum(axis=1)
    return np.array([sum(a * b for a, b in zip(x.tolist(), y.tolist(), strict=True)) for x, y in zip(q, v, strict=True)], dtype=np.int64)


class Best:
    """The k best of each query so far, higher scores first and then smaller ids."""

    def __init__(self, queries: int, k: int, limit: np.ndarray | None = None):
        self.k, self.rows = k, [np.zeros((0, 2), dtype=np.int64)] * queries
        self.limit = np.full(queries, -np.inf) if limit is None else limit.copy()

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        rows = np.concatenate([self.rows[query], np.stack([scores, ids], axis=1)])
        rows = rows[np.lexsort((rows[:, 1], -rows[:, 0]))][: self.k]
        self.rows[query] = rows
        if len(rows) == self.k:
            self.limit[query] = max(self.limit[query], rows[-1, 0])


def search(
    best: Best, q: np.ndarray, q_uid: np.ndarray, v: np.ndarray, v_uid: np.ndarray, v_id: np.ndarray, turn: np.ndarray
) -> None:
    """Compare every query with all vectors ``v``, which come in order of falling length."""
    qr, vr = q @ turn, v @ turn
    stops = [max(1, int(round(x * q.shape[1]))) for x in STEPS] if q.shape[1] else []
    q_len, v_len = np.linalg.norm(qr, axis=1), np.linalg.norm(vr, axis=1)
    for at in range(0, len(v), BLOCK):
        part = slice(at, at + BLOCK)
        bound = np.outer(q_len, v_len[part])
        slack = SLACK * bound + 1e-6
        open_ = bound + slack >= best.limit[:, None]
        if not open_.any():
            if (q_len * v_len[part].min(initial=np.inf) < best.limit).all():
                break
            continue
        for stop in stops:
            rest = np.outer(np.linalg.norm(qr[:, stop:], axis=1), np.linalg.norm(vr[part, stop:], axis=1))
            open_ &= qr[:, :stop] @ vr[part, :stop].T + rest + slack >= best.limit[:, None]
        open_ &= q_uid[:, None] != v_uid[None, part]
        query, vector = np.nonzero(open_)
        for a in range(0, len(query), 1 << 16):
            i, j = query[a : a + (1 << 16)], vector[a : a + (1 << 16)] + at
            scores = exact(q[i], v[j])
            for x in np.unique(i):
                own = i == x
                best.add(int(x), scores[own], v_id[j[own]])


def _first_limits(longest, turn, width: int, k: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uid, ids, v = longest.value
        for frame in frames:
            for at in range(0, len(frame), GROUP_QUERIES):
                part = frame.iloc[at : at + GROUP_QUERIES]
                q = _matrix(part["v"], width)
                best = Best(len(q), k)
                search(best, q, part["uid"].to_numpy(), v, uid, ids, turn.value)
                yield part.assign(least=best.limit)

    return run


def _compare(queries: pd.DataFrame, vectors: pd.DataFrame, turn, width: int, k: int) -> pd.DataFrame:
    vectors = vectors.sort_values(["length", "vec_id"], ascending=[False, True])
    q, v = _matrix(queries["v"], width), _matrix(vectors["v"], width)
    best = Best(len(q), k, queries["least"].to_numpy())
    search(best, q, queries["uid"].to_numpy(), v, vectors["uid"].to_numpy(), vectors["vec_id"].to_numpy(), turn.value)
    found = [len(x) for x in best.rows]
    rows = np.concatenate([*best.rows, np.zeros((0, 2), dtype=np.int64)])
    return pd.DataFrame(
        {
            "query_uid": np.repeat(queries["uid"].to_numpy(), found),
            "query_id": np.repeat(queries["vec_id"].to_numpy(), found),
            "vec_id": rows[:, 1],
            "score": rows[:, 0],
        }
    )


def meetings(queries: DataFrame, longest_of: DataFrame, last: int) -> DataFrame:
    """(part, range, longest) of the groups of queries and ranges of vectors that have something to compare.

    By lengths alone: in some query of the group the range's longest vector could reach the
    query's limit. A group is represented by its largest ratio of length and limit.
    """
    reach = F.when(F.col("least") > 0, F.col("length") / F.col("least")).otherwise(F.lit(float("inf")))
    groups = queries.groupBy("part").agg(F.max(reach).alias("reach"))
    pairs = groups.withColumn("range", F.explode(F.sequence(F.lit(0), F.lit(last)))).join(longest_of, "range")
    within = F.col("reach") * F.col("longest") * (1 + 2 * SLACK) >= 1
    return stored(pairs.where(within | F.col("reach").isNull()).select("part", "range", "longest"), "meetings")


def copied(ordered: DataFrame, meeting: DataFrame) -> DataFrame:
    """Vectors once for each group of queries that their range meets, and not at all where it meets none."""
    parts = meeting.groupBy("range").agg(F.collect_list("part").alias("parts"))
    return ordered.join(parts, "range").withColumn("part", F.explode("parts")).drop("parts")


def top_k(vectors: DataFrame, column: str = "embedding", every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score: the k highest scores of each query against all other rows.

    Queries are the rows whose vec_id is divisible by ``every``. A score is the inner product
    of components times 1024 rounded down; ties go to the smaller vec_id. Rows whose vec_id or
    vector is null, or whose vector holds null or non-finite components, take no part. Shorter
    vectors count as filled with zeros. Rows with one vec_id are rows of their own: each is a
    query, and a candidate for all but itself. A score beyond 63 bits raises an error. Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, column).withColumn("uid", F.monotonically_increasing_id())
    rows = rows.withColumn(
        "length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    )
    rows = stored(rows, "vectors")
    asked = F.col("vec_id") % every == 0
    n, n_queries, width = rows.agg(F.count("*"), F.count(F.when(asked, 1)), F.max(F.size("v"))).first()
    width, ranges = width or 0, max(1, -(-n // RANGE_ROWS))
    turn = spark.sparkContext.broadcast(rotation(rows, width))
    top = rows.orderBy(F.desc("length"), "vec_id", "uid").limit(FIRST).toPandas()
    longest = spark.sparkContext.broadcast((top["uid"].to_numpy(), top["vec_id"].to_numpy(), _matrix(top["v"], width)))
    queries = rows.where(asked).select("uid", "vec_id", "v")
    queries = queries.mapInPandas(
        _first_limits(longest, turn, width, k), "uid long, vec_id long, v array<long>, least double"
    )
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    # queries that need vectors of like length share a group, so that groups can do without short ones
    groups = max(1, -(-n_queries // GROUP_QUERIES))
    need = F.coalesce(F.try_divide("least", "length"), F.lit(float("inf")))
    queries = stored(queries.withColumn("length", length).withColumn("need", need), "asked")
    bands = min(groups, NEEDS)
    bounds = []
    if bands > 1:
        shares = F.array(*[F.lit(x / bands) for x in range(1, bands)])
        bounds = queries.agg(F.percentile_approx("need", shares, F.lit(10_000))).first()[0] or []
    band = sum((F.when(F.col("need") >= F.lit(b), 1).otherwise(0) for b in bounds), F.lit(0))
    each = -(-groups // bands)
    queries = queries.withColumn("part", (band * each + F.pmod(F.xxhash64("uid"), F.lit(each))).cast("int")).drop("need")
    ordered = rows.repartitionByRange(ranges, F.desc("length"), "vec_id", "uid")
    ordered = stored(ordered.withColumn("range", F.spark_partition_id()), "ranges")
    longest_of = ordered.groupBy("range").agg(F.max("length").alias("longest"))
    last = ordered.agg(F.max("range")).first()[0] or 0
    meeting = meetings(queries, longest_of, last)
    queries = queries.join(meeting, "part").select("range", "uid", "vec_id", "v", "least", "length", "part", "longest")
    queries = queries.where(F.col("length") * F.col("longest") * (1 + SLACK) >= F.col("least")).drop("longest", "length")
    copies = copied(ordered, meeting)
    found = (
        queries.groupBy("range", "part")
        .cogroup(copies.groupBy("range", "part"))
        .applyInPandas(
            partial(_compare, turn=turn, width=width, k=k),
            "query_uid long, query_id long, vec_id long, score long",
        )
    )
    rank = F.row_number().over(Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id"))
    return (
        found.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
