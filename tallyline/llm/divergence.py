"""How the sources of a language differ in their terms, exactly.

Occurrences are counted once per language, source and term; terms that enough documents of
a language hold are kept. Each group, a source of a language, and each language as a whole
give every kept term a smoothed share of their occurrences, a whole number of billionths.

Sources are compared over all kept terms: for a bundle of terms the shares of all sources
form a dense block, whose differences are summed pair by pair; sums of bundles are added up.

The terms that set a group apart are those with the largest excess of share over the
language. The excess of a term cannot be less than that of another one which the group holds
at most as often and the language at least as often; with UTF-8 order for ties the first
dominates the second. So a task keeps of each group the terms that fewer than ``top`` others
dominate, its skyband; skybands of parts are merged to the skyband of all, which holds the
``top`` terms by any such measure, and only these are ranked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm import terms
from tallyline.llm.storing import stored

BETWEEN = terms.bytes_between(terms.UPPER, terms.LOWER)
LEAST_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP = 50
# Terms of texts that a task gathers before it adds them up; Spark adds up what it hands on.
GATHERED = 1 << 19
# Rows of one group that a task gathers before it cuts them down to their skyband.
BUFFER = 1 << 14
# Parts of a group's terms whose skybands are merged before the last ranking.
PARTS = 16
# Cells of a block of shares, and of the sums that a task holds.
CELLS = 1 << 20

COUNTED = "lang string, source string, term string, n long, docs long"
BAND = "lang string, source string, term string, n long, in_lang long"
SUMS = "lang string, a int, b int, value long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences, and documents, of each term in the groups of a batch, in parts of about GATHERED terms of texts."""
    for batch in batches:
        groups = pa.table({"lang": batch.column(0), "source": batch.column(1)})
        groups = groups.append_column("row", pa.array(np.arange(batch.num_rows)))
        heads = groups.group_by(["lang", "source"]).aggregate([("row", "list")])
        group = np.zeros(batch.num_rows, dtype=np.int64)
        lists = heads["row_list"].combine_chunks()
        group[lists.flatten().to_numpy()] = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        parts, gathered = [], 0
        for first, row, term, count, _ in terms.per_text(batch.column(2), BETWEEN):
            parts.append(
                pa.table({"g": group[first + row], "term": term, "n": count, "docs": np.ones(len(count), np.int64)})
            )
            gathered += len(count)
            if gathered >= GATHERED:
                yield from _added(parts, heads)
                parts, gathered = [], 0
        if parts:
            yield from _added(parts, heads)


def _added(parts: list[pa.Table], heads: pa.Table) -> Iterator[pa.RecordBatch]:
    # one thread: each further one would hold terms of its own
    total = pa.concat_tables(parts).group_by(["g", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    for at in range(0, len(total), 1 << 16):
        part = total.slice(at, 1 << 16)
        yield from pa.table(
            {
                "lang": heads["lang"].take(part["g"]),
                "source": heads["source"].take(part["g"]),
                "term": pc.cast(pc.cast(part["term"], pa.binary()), pa.string()),
                "n": part["n_sum"],
                "docs": part["docs_sum"],
            }
        ).to_batches()


def group_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term of a group, and documents that hold it.

    Terms are runs of ASCII letters and of all characters beyond ASCII, A-Z in lower case;
    nulls in any column count as empty text.
    """
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    counted = docs.select(*blank).mapInArrow(_counted, COUNTED)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n, total, terms_kept):
    """1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * terms)), in whole numbers of 38 digits."""
    top = (n + F.lit(SMOOTHING)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (total + F.lit(SMOOTHING) * terms_kept).cast("decimal(20,0)")
    # DIV is exact and cuts towards zero; both sides are positive wherever a term is kept
    return F.lit(1) + F.call_function("div", top, below)


def skyband(n: np.ndarray, in_lang: np.ndarray, place: np.ndarray, top: int) -> np.ndarray:
    """Places of the rows that fewer than ``top`` others dominate.

    A row dominates another when its n is not lower, its in_lang not higher and its place in
    UTF-8 order earlier. It is enough to count the kept rows: whatever dominates a dropped row
    dominates what that row dominates.
    """
    order = np.lexsort((place, in_lang, -n))
    kept = np.zeros(len(order), dtype=np.int64)
    lang, at = in_lang[order], place[order]
    size = 0
    kept_lang, kept_at = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    for k in range(len(order)):
        if size < top or np.count_nonzero((kept_lang[:size] <= lang[k]) & (kept_at[:size] < at[k])) < top:
            kept_lang[size], kept_at[size], kept[size] = lang[k], at[k], order[k]
            size += 1
    return kept[:size]


def _cut(rows: pa.Table, top: int) -> pa.Table:
    binary = pc.cast(rows["term"].combine_chunks(), pa.large_binary())
    place = np.empty(len(rows), dtype=np.int64)
    place[pc.sort_indices(binary).to_numpy()] = np.arange(len(rows))
    kept = skyband(rows["n"].to_numpy(), rows["in_lang"].to_numpy(), place, top)
    return rows.take(pa.array(np.sort(kept)))


def _skybands(top: int):
    """The skyband of each group among the rows of a task, in batches as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], pa.Table] = {}
        fresh: dict[tuple[str, str], list[pa.Table]] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            numbered = table.append_column("row", pa.array(np.arange(len(table))))
            heads = numbered.group_by(["lang", "source"]).aggregate([("row", "list")]).to_pylist()
            for head in heads:
                key = head["lang"], head["source"]
                parts = fresh.setdefault(key, [])
                parts.append(table.take(pa.array(head["row_list"])))
                if sum(map(len, parts)) >= BUFFER:
                    held[key] = _cut(pa.concat_tables([*parts, *([held[key]] if key in held else [])]), top)
                    fresh[key] = []
        for key, parts in fresh.items():
            rows = [*parts, *([held[key]] if key in held else [])]
            if rows:
                yield from _cut(pa.concat_tables(rows), top).to_batches(1 << 16)

    return run


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over terms of the differences of shares, for all pairs of sources of a language.

    A row has a term's sources, as places in the language's list, their shares, and the
    shares that all sources give a term they do not hold.
    """
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lang in dict.fromkeys(langs):
            rows = batch.filter(pa.array([x == lang for x in langs]))
            absent = rows.column(3)[0].values.to_numpy()
            size, lists = len(absent), rows.column(1)
            if lang not in sums:
                if sum(x.size for x in sums.values()) + size * size > CELLS:
                    yield from _sum_rows(sums)
                    sums = {}
                sums[lang] = np.zeros((size, size), dtype=np.int64)
            step = max(1, CELLS // size)
            for a in range(0, len(rows), step):
                part = lists.slice(a, step)
                block = np.tile(absent, (len(part), 1))
                term = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy())
                block[term, part.flatten().to_numpy()] = rows.column(2).slice(a, step).flatten().to_numpy()
                for k in range(size):
                    sums[lang][k] += np.abs(block - block[:, k : k + 1]).sum(axis=0)
    yield from _sum_rows(sums)


def _sum_rows(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for lang, table in sums.items():
        step = max(1, (1 << 16) // len(table))
        for k in range(0, len(table), step):
            part = table[k : k + step]
            a, b = np.divmod(np.arange(part.size), part.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * part.size, pa.string()),
                    pa.array((a + k).astype(np.int32)),
                    pa.array(b.astype(np.int32)),
                    pa.array(part.reshape(-1)),
                ],
                names=["lang", "a", "b", "value"],
            )


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source differs from others and from its language.

    Part ``pair`` has a row for each other source of the group's language, with the sum over all
    kept terms of the differences of their shares, all of them ranked. Part ``term`` has the
    ``top`` kept terms whose share in the group exceeds that in the language most, by this excess. Ranks
    begin at 1 and go by falling value, then by the item's UTF-8 bytes.

    Null lang, source and text count as empty ones, and an empty lang or source is a name like
    others. A group without terms has pairs and no terms; where a language keeps no term, its
    pairs have value 0; a source that is alone in its language has no pairs. Repeated rows count
    as documents of their own. Other columns are ignored; an empty table gives an empty result.
    The pairs are the square of a language's sources, and a list of these is held as one row.
    """
    counts = stored(group_counts(docs), "group-terms")
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    by_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
    kept = stored(by_lang.where(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("in_lang").alias("all_lang"))
    used = stored(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("all_group"))
    groups = docs.select(*named).distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.na.fill(0, ["all_group", "v", "all_lang"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = stored(groups.withColumn("place", place), "groups")
    pairs = _pairs(groups, used)
    distinct_terms = _terms(groups, used, top)
    return pairs.unionByName(distinct_terms)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).select("lang", "source", "part", "item", "value", "rank")


def _pairs(groups: DataFrame, used: DataFrame) -> DataFrame:
    filled = groups.where("v > 0").withColumn("absent", share(F.lit(0), F.col("all_group"), F.col("v")))
    listed = F.array_sort(F.collect_list(F.struct("place", "absent")))
    absent = filled.groupBy("lang").agg(F.transform(listed, lambda x: x["absent"]).alias("absent"))
    held = used.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("all_group"), F.col("v")))
    held = held.groupBy("lang", "term").agg(F.collect_list(F.struct("place", "p")).alias("held"))
    held = held.select("lang", F.col("held.place").alias("place"), F.col("held.p").alias("p"))
    sums = held.join(absent, "lang").mapInArrow(_pair_sums, SUMS)
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = [groups.select("lang", F.col("place").alias(x), F.col("source").alias(name)) for x, name in (("a", "source"), ("b", "item"))]
    pairs = sides[0].join(sides[1], "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    return _ranked(pairs)


def _terms(groups: DataFrame, used: DataFrame, top: int) -> DataFrame:
    rows = used.select("lang", "source", "term", "n", "in_lang")
    bands = rows.mapInArrow(_skybands(top), BAND)
    part = F.pmod(F.xxhash64("term"), F.lit(PARTS))
    merged = bands.repartition("lang", "source", part).mapInArrow(_skybands(top), BAND)
    shares = merged.join(groups, ["lang", "source"])
    p = share(F.col("n"), F.col("all_group"), F.col("v"))
    q = share(F.col("in_lang"), F.col("all_lang"), F.col("v"))
    excess = shares.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).alias("value"))
    return _ranked(excess.where("value > 0")).where(F.col("rank") <= top)
