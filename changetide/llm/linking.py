"""Linking what is near: candidates from shared buckets, a check of each, and classes of what is linked."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from changetide.llm.common import stored
from changetide.session import drop_scratch

Near = Callable[[Column, Column], Column]


def classes(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): item, root (one item of its class); one row per linked item.

    Each round every item joins the neighbour, or itself, with the lowest hash of that round, twice in a
    row; links between the joined items go on, so that at least about two thirds of the items leave
    in a round. Only pairs move; a hub's links are combined before the shuffle, and a skewed join
    is split by the planner. Every round is written, so a lost executor costs one round at most.
    """
    spark = links.sparkSession
    folders, members, number = [], None, 0
    pairs = links.where(F.col("a") != F.col("b")).select("a", "b")
    edges, folder = stored(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    while not edges.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.lit(number), c).alias("h"), c.alias("i"))  # noqa: B023, E731
        lowest = edges.groupBy("a").agg(F.min(rank(F.col("b"))).alias("low"))
        first = lowest.select(F.col("a").alias("item"), F.least(rank(F.col("a")), F.col("low"))["i"].alias("up"))
        second = first.select(F.col("item").alias("up"), F.col("up").alias("root"))
        joined, joined_folder = stored(first.join(second, "up").select("item", "root"), "joined")
        if members is None:
            members_next = joined
        else:
            over = joined.select(F.col("item").alias("root"), F.col("root").alias("next"))
            members_next = members.join(over, "root", "left").select("item", F.coalesce("next", "root").alias("root"))
        members_next, members_folder = stored(members_next, "members")
        left = joined.select(F.col("item").alias("a"), F.col("root").alias("x"))
        right = joined.select(F.col("item").alias("b"), F.col("root").alias("y"))
        rest = (
            edges.join(left, "a").join(right, "b").where(F.col("x") != F.col("y"))
            .select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        )
        edges, next_folder = stored(rest, "edges")
        for done in (folder, joined_folder, *folders):
            drop_scratch(spark, done)
        members, folders, folder, number = members_next, [members_folder], next_folder, number + 1
    if members is None:
        return edges.select(F.col("a").alias("item"), F.col("b").alias("root"))
    return members


def linked_classes(keyed: DataFrame, near: Near) -> DataFrame:
    """Classes of distinct items that are near and share a bucket: item, root; for linked items only.

    `keyed` has bucket, item and side: 1 or 2 (a pair counts if it has both), or 3 for both sides. No
    link is lost, yet a bucket of n alike items does not make n² pairs: each item is first held
    against the bucket's lowest item and the one before it; those links give preliminary classes,
    and only items of different classes are paired then. Items alone in their bucket leave early.
    """
    spark = keyed.sparkSession
    order = Window.partitionBy("bucket").orderBy("item")
    met = keyed.select(
        "bucket",
        "item",
        "side",
        F.lag("item").over(order).alias("before"),
        F.first("item").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("lowest"),
        F.count(F.lit(1)).over(Window.partitionBy("bucket")).alias("size"),
    ).where(F.col("size") > 1)
    met, met_folder = stored(met, "met")
    held = F.filter(F.array_distinct(F.array("lowest", "before")), lambda other: near(F.col("item"), other))
    linked = met.where(F.col("before").isNotNull()).select(F.col("item").alias("a"), F.explode(held).alias("b"))
    links, links_folder = stored(linked.distinct(), "links")
    early, early_folder = stored(classes(links), "early")
    # Of up to three items every pair has been checked by now.
    open_ = met.where(F.col("size") > 3).select("bucket", "item", "side")
    placed = open_.join(early, "item", "left").withColumn("root", F.coalesce("root", "item"))
    mixed = Window.partitionBy("bucket")
    placed, placed_folder = stored(
        placed.withColumns({"lo": F.min("root").over(mixed), "hi": F.max("root").over(mixed)})
        .where(F.col("lo") < F.col("hi"))
        .select("bucket", "item", "side", "root"),
        "placed",
    )
    one = placed.where(F.col("side") != 2).select("bucket", F.col("item").alias("a"), F.col("root").alias("x"))
    two = placed.where(F.col("side") != 1).select(F.col("bucket").alias("same"), F.col("item").alias("b"), F.col("root").alias("y"))
    late = (
        one.join(
            two,
            (F.col("bucket") == F.col("same"))
            & (F.col("x") != F.col("y"))
            & (F.col("a") < F.col("b"))
            & near(F.col("a"), F.col("b")),
        )
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
        .distinct()
    )
    over = classes(late).select(F.col("item").alias("root"), F.col("root").alias("next"))
    # A class of one item that is linked late is not among the early ones yet.
    alone = over.join(early.select("root").distinct(), "root", "left_anti").select(F.col("root").alias("item"), "root")
    result, _ = stored(
        early.unionByName(alone).join(over, "root", "left").select("item", F.coalesce("next", "root").alias("root")),
        "classes",
    )
    for folder in (met_folder, links_folder, early_folder, placed_folder):
        drop_scratch(spark, folder)
    return result
