"""Connected components, and links between rows that share a bucket.

A bucket is a set of rows with one key. Its pairs are never all listed: each row is first
compared with the most central row of its bucket, the one whose buckets hold most rows, and
rows that these links already put into one component need no further comparison. Of rows
of different components that still share a bucket, only those pairs leave the join that pass
a test on small sketches, and these are compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.storing import free, stored

Near = Callable[[str, str], Column]

# Rounds by which rows are named before they are compared further.
SOME_ROUNDS = 2


def components(links: DataFrame) -> DataFrame:
    """(uid, component) of every node of ``links`` (a, b); a component is named by its smallest node."""
    return named_by_least(contracted(links))


def named_by_least(edges: DataFrame) -> DataFrame:
    """(uid, component) of every node of ``contracted`` links."""
    ends = edges.select(F.col("b").alias("uid"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("uid"), F.col("b").alias("component")).union(ends)


def components_by_some_rounds(links: DataFrame) -> DataFrame:
    """(uid, component) of every node; a component is named by one of its nodes.

    Of many components most are settled after some rounds. Each node then goes to its smallest neighbour, and
    what is left to join are those neighbours, where a node has several of them or is one itself.
    """
    edges = contracted(links, SOME_ROUNDS)
    known = stored(edges.groupBy("a").agg(F.min("b").alias("b"), F.max("b").alias("other")), "known")
    several = known.where("b <> other").select("a", F.col("b").alias("m"))
    open_ = edges.join(several, "a").select(F.col("m").alias("a"), "b")
    passed = known.select("a", "b").join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
    rest = contracted(open_.union(passed))
    joined = named_by_least(rest).select(F.col("uid").alias("b"), "component")
    ends = edges.select("b").distinct().select(F.col("b").alias("uid"), "b")
    nodes = known.select(F.col("a").alias("uid"), "b").union(ends)
    named = nodes.join(joined, "b", "left").select("uid", F.coalesce("component", "b").alias("component")).distinct()
    named = stored(named, "components")
    free(edges, known, rest)
    return named


def contracted(links: DataFrame, most: int | None = None) -> DataFrame:
    """Links (a, b) that join the same nodes, from each node to the smallest one of its component.

    Each round hands the larger neighbours of a node to its smallest one and then joins
    the smaller ones there (large-star and small-star), which takes few rounds whatever the
    shape. Rounds are written to the shared folder; only a count and a sum reach the driver.
    No links give no rows, and links of a node with itself are ignored. After ``most`` rounds
    links that do not lead to the smallest node yet are returned as they are.
    """
    edges = stored(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    state, rounds = _state(edges), 0
    while state[0] and rounds != most:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(edges.join(least, "a").select("a", F.col("m").alias("b")))
        large = stored(large.where("a <> b").distinct(), "edges")
        free(edges)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.union(least).distinct(), "edges")
        free(large)
        before, state, rounds = state, _state(edges), rounds + 1
        if state == before:
            break
    return edges


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def shared(buckets: DataFrame, once: bool = False) -> DataFrame:
    """The rows (key, uid) of buckets with more than one uid, and the number of their rows.

    ``once`` says that no row is there twice, so that counting tells buckets of more than one.
    """
    if once:
        several = buckets.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
        return buckets.join(several, "key")
    several = (
        buckets.groupBy("key")
        .agg(F.min("uid").alias("low"), F.max("uid").alias("high"), F.count("*").alias("rows"))
        .where("low <> high")
        .drop("low", "high")
    )
    return buckets.join(several, "key")


def with_centers(members: DataFrame) -> DataFrame:
    """``members`` of ``shared`` with the most central row of each bucket."""
    weights = members.groupBy("uid").agg(F.sum("rows").alias("weight"))
    most = members.join(weights, "uid").groupBy("key").agg(F.max(F.struct("weight", "uid")).alias("most"))
    return members.join(most.select("key", F.col("most.uid").alias("center")), "key")


def linked(
    members: DataFrame,
    traits: DataFrame,
    near: Near,
    confirm: Callable[[DataFrame], DataFrame],
    rounds: int = 1,
) -> DataFrame:
    """(uid, component) by the confirmed links between rows of a bucket.

    ``members`` are the rows of ``shared``. ``traits`` has a row for each uid, and
    ``near(x, y)`` is a condition on ``key`` and on two of its rows, their columns under the
    prefixes x and y, that every link fulfils. ``confirm`` keeps of pairs (a, b) those that link.
    Each round beyond the first compares the rows of a bucket with another row of it, any
    one, which joins most of a family whose central row is not like all others.
    """
    tested = stored(_with_center(with_centers(members)).distinct(), "star-pairs")
    links = stored(confirm(tested), "star-links")
    rest = _apart(members.select("key", "uid"), links)
    for turn in range(1, rounds):
        any_one = F.max(F.struct(F.xxhash64("uid", F.lit(turn)), "uid", "component")).alias("any_one")
        chosen = rest.groupBy("key").agg(any_one)
        chosen = chosen.select("key", F.col("any_one.uid").alias("center"), F.col("any_one.component").alias("own"))
        pairs = _with_center(rest.join(chosen, "key").where("component <> own")).distinct()
        pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "star-pairs")
        links = stored(links.union(confirm(pairs)), "star-links")
        tested = tested.union(pairs)
        rest = _apart(rest.select("key", "uid"), links)
    pairs = _across(rest.join(traits, "uid"), near).distinct().join(tested, ["a", "b"], "left_anti")
    return components(stored(links.union(confirm(stored(pairs, "rest-pairs"))), "links"))


def linked_by_stars(
    stars: DataFrame, members: DataFrame, traits: DataFrame, near: Near, confirm: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """(uid, component) as ``linked`` gives them, where buckets hold many families of many rows.

    ``stars`` are buckets (key, uid) finer than those of ``members``, mostly of one family each;
    the rows of each are compared with the smallest one. ``near`` does not look at the key, and all
    pairs are put to it before ``confirm`` is. Components are worked out of those found before.
    """
    several = stars.groupBy("key").agg(F.min("uid").alias("center"), F.count("*").alias("rows")).where("rows > 1")
    pairs = stored(_with_center(stars.join(several, "key")).distinct(), "star-pairs")
    sides = [traits.select(*[F.col(c).alias(f"{x}{c}") for c in traits.columns]) for x in "xy"]
    tested = pairs.join(sides[0], F.col("a") == F.col("xuid")).join(sides[1], F.col("b") == F.col("yuid"))
    tested = stored(tested.where(near("x", "y")).select("a", "b"), "near-pairs")
    free(pairs)
    # not to the end, as what these rounds leave apart costs only further comparisons
    edges = contracted(confirm(tested), SOME_ROUNDS)
    known = stored(named_by_least(edges).groupBy("uid").agg(F.min("component").alias("component")), "known")
    named = members.select("key", "uid").join(known, "uid", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "uid")), "named")
    rest = stored(_mixed(named), "apart")
    free(named)
    pairs = _across(rest.join(traits, "uid"), near).distinct().join(tested, ["a", "b"], "left_anti")
    pairs = stored(pairs, "rest-pairs")
    free(rest, tested)
    links = edges.union(confirm(pairs))
    for x in "ab":
        links = links.join(known.select(F.col("uid").alias(x), F.col("component").alias(f"{x}_known")), x, "left")
    links = links.select(F.coalesce("a_known", "a").alias("a"), F.coalesce("b_known", "b").alias("b"))
    joined = components(links)
    free(pairs, edges)
    known = known.union(joined.select("uid", F.col("uid").alias("component")))
    known = known.groupBy("uid").agg(F.min("component").alias("known"))
    joined = joined.select(F.col("uid").alias("known"), "component")
    return known.join(joined, "known", "left").select("uid", F.coalesce("component", "known").alias("component"))


def _with_center(rows: DataFrame) -> DataFrame:
    pairs = rows.where("uid <> center")
    return pairs.select(F.least("center", "uid").alias("a"), F.greatest("center", "uid").alias("b"))


def _apart(members: DataFrame, links: DataFrame) -> DataFrame:
    """(key, uid, component) of the buckets that hold more than one component."""
    named = members.join(components(links), "uid", "left")
    named = named.withColumn("component", F.coalesce("component", "uid")).select("key", "uid", "component")
    return stored(_mixed(stored(named, "named")), "apart")


def _mixed(named: DataFrame) -> DataFrame:
    """Rows of buckets that hold more than one component."""
    several = (
        named.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("key")
    )
    return named.join(several, "key")


def _across(rest: DataFrame, near: Near) -> DataFrame:
    """Pairs of one bucket whose components differ and that are near."""
    sides = [rest.select("key", *[F.col(c).alias(f"{x}{c}") for c in rest.columns if c != "key"]) for x in "xy"]
    apart = (F.col("xuid") < F.col("yuid")) & (F.col("xcomponent") != F.col("ycomponent"))
    found = sides[0].join(sides[1], "key").where(apart & near("x", "y"))
    return found.select(F.col("xuid").alias("a"), F.col("yuid").alias("b"))
