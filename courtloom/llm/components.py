"""Distributed union-find and the search for links inside buckets, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtloom.session import durable

#: Comparisons per bucket row up to which all open pairs of all buckets are compared at once.
PAIRS_PER_ROW = 20
#: How many times as many hubs a bucket gets in a round as in the round before.
MORE_HUBS = 8


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of undirected edges (a, b); the component is its smallest id.

    Large-star and small-star steps alternate until the edges are stars around the smallest ids.  Each step is two
    shuffles of edges, keeps at most as many edges as there were, and is written before the next one reads it.
    """
    edges = durable(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = lambda: tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    mark = state()
    if not mark[0]:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        edges = durable(small.where("a <> b").distinct(), "edges")
        before, mark = mark, state()
        if mark == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())


def link_buckets(
    buckets: DataFrame,
    verify: Callable[[DataFrame, DataFrame], DataFrame],
    prepare: Callable[[DataFrame], DataFrame] = lambda ids: ids,
    refine: Callable[[DataFrame], DataFrame] | None = None,
    fits: str = "true",
) -> DataFrame:
    """Components of all verified pairs among members of common buckets.

    `buckets` has key and id; `prepare` gets the ids that share a bucket, once, and
    `verify` takes distinct pairs (a, b) and what was prepared and returns the pairs that are links.  A bucket is not
    expanded into all its pairs: hubs are compared with the other members and leave the bucket, and pairs that are
    in one component by then are settled.  A bucket has one hub at first and `MORE_HUBS` times as many in each
    further round, so rounds grow with the logarithm of its size even where no member is linked with another.  Once
    few enough pairs are open they are compared all at once, so the components are those of the full comparison,
    however large a bucket is.

    Where too many pairs are open after the first round, `refine` may give the open ids new buckets (key, id, place,
    size) in which all their links meet; pairs for which the condition `fits` on both sides' place and size (pa, sa,
    pb, sb) fails are no links, and the rest is compared at once.
    """
    multi = buckets.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last").select("key", "hub")
    members = durable(buckets.join(multi, "key").distinct(), "members")
    known = prepare(members.select("id").distinct())
    pairs = durable(members.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    found = components(durable(verify(pairs, known), "links"))
    tried = pairs
    members = members.where("id <> hub").select("key", "id")
    hubs_each, refined = 1, False
    while True:
        labelled = members.join(found, "id", "left").select(*members.columns, F.coalesce("component", "id").alias("c"))
        sizes = labelled.groupBy("key", "c").agg(F.count("*").alias("n"))
        main = sizes.groupBy("key").agg(F.max(F.struct("n", "c"))["c"].alias("main"), F.count("*").alias("groups"), F.sum("n").alias("rows")).where("groups > 1")
        labelled = durable(labelled.join(main, "key"), "open")
        cost = labelled.agg(F.sum(F.when(F.col("c") != F.col("main"), F.col("rows"))), F.count("*")).first()
        if not cost[1]:
            return found
        few = cost[0] <= PAIRS_PER_ROW * cost[1]
        if refine and not refined and not few:
            members, refined = durable(refine(labelled.select("id").distinct()), "refined"), True
            continue
        others = labelled.where("c <> main")
        if refined:
            right = labelled.select("key", F.col("id").alias("b"), F.col("c").alias("d"), "main", F.col("place").alias("pb"), F.col("size").alias("sb"))
            left = others.select("key", F.col("id").alias("a"), "c", F.col("place").alias("pa"), F.col("size").alias("sa"))
            open_ = left.join(right, "key").where(f"c <> d AND (d = main OR a < b) AND {fits}")
            last = True
        elif few:
            right = labelled.select("key", F.col("id").alias("b"), F.col("c").alias("d"), "main")
            left = others.select("key", F.col("id").alias("a"), "c")
            open_ = left.join(right, "key").where("c <> d AND (d = main OR a < b)")
            last = True
        else:
            hubs_each *= MORE_HUBS
            dealt = others.groupBy("key", F.pmod(F.xxhash64("id"), F.lit(hubs_each)).alias("part"))
            hubs = dealt.agg(F.min("id").alias("a"), F.min_by("c", "id").alias("h")).drop("part")
            open_ = labelled.join(hubs, "key").where("c <> h").withColumnRenamed("id", "b")
            labelled = labelled.join(hubs.select("key", F.col("a").alias("id")), ["key", "id"], "left_anti")
            last = False
        fresh = open_.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
        fresh = durable(fresh, "pairs")
        links = durable(verify(fresh, known), "links")
        if links.head(1):
            found = components(found.toDF("a", "b").union(links))
        if last:
            return found
        tried, members = tried.union(fresh), labelled.select("key", "id")
