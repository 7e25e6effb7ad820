"""Connected components by contraction, and links from band buckets without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchgrain.llm.shared import discard, materialise


def components(links: DataFrame) -> DataFrame:
    """node, label of all nodes in ``links`` (a, b); two nodes share a label if links connect them.

    In each round every node moves to that one among its neighbours and itself whose hash is least,
    the hash being another in each round, and links between what became one node vanish. The nodes
    left fall by a constant factor, stars vanish in two rounds, and chains do too, in the logarithm of
    their length. Tables are written between rounds; neither nodes nor links come to the driver.
    """
    edges = materialise(links.select("a", "b").where("a <> b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = materialise(nodes.select("node", F.col("node").alias("label")), "labels")
    turn = 0
    while not edges.isEmpty():
        turn += 1
        both = edges.union(edges.select("b", "a"))
        near = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", F.lit(turn)).alias("h"), F.col("b").alias("to"))).alias("best"))
        own = F.struct(F.xxhash64("a", F.lit(turn)).alias("h"), F.col("a").alias("to"))
        steps = materialise(near.select(F.col("a").alias("from"), F.least("best", own)["to"].alias("to")), "steps")
        # Hashes fall along moves, so they form trees; two doublings take a node four steps up at once.
        moves = steps
        for _ in range(2):
            moves = moves.join(moves.toDF("to", "beyond"), "to").select("from", F.col("beyond").alias("to"))
        moves = materialise(moves, "moves")
        moved = edges.join(moves.toDF("a", "a2"), "a").join(moves.toDF("b", "b2"), "b")
        pairs = moved.where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
        fewer = materialise(pairs.distinct(), "edges")
        follow = labels.join(moves, F.col("label") == F.col("from"), "left")
        further = materialise(follow.select("node", F.coalesce("to", "label").alias("label")), "labels")
        discard(edges, labels, steps, moves)
        edges, labels = fewer, further
    discard(edges)
    return labels


def linked(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    percent: int,
    refine: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """node, label of all nodes that links connect with others.

    ``members`` (key, node, size) are the buckets: nodes that share a key may be linked. ``verify``
    returns those of given pairs (a, b) that are. First each bucket's nodes are paired with its hub, the
    node whose buckets are largest, as the original among its copies is; a bucket of many copies of one
    text costs a pair a node. Buckets that are in one component then are done.

    A bucket left in several components mostly holds texts that only share a passage. ``refine`` gives
    the nodes of all such buckets finer ones (key, node, size, at), in which linked nodes meet again as
    surely as before. There ``at`` counts the node's elements ahead of the key, none of which the other
    node has where the two meet first, so what lies behind must suffice for the link. That bounds the
    node itself by the smallest node of its bucket, and each pair: texts around one passage meet only if
    their own parts are too small to keep them apart. Hubs are tried once more, then what is left outside a bucket's largest component is
    paired with the rest of it under that bound. Without ``refine`` this is done at once. No pair that the sizes and
    the bound allow is left out.
    """

    def enough(rest, sizes):  # of elements that may be shared, for two sets of so many
        return (100 + percent) * rest >= percent * sizes

    def possible(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for old in tested:
            pairs = pairs.join(old, ["a", "b"], "left_anti")
        return materialise(pairs, "pairs")

    def learn(pairs: DataFrame) -> DataFrame:
        tested.append(pairs)
        links.append(materialise(verify(pairs), "links"))
        return components(reduce(DataFrame.union, links))

    def side(nodes: DataFrame, name: str, *more: str) -> DataFrame:
        return nodes.select("key", F.col("node").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("size", "at", *more)))

    fits = enough(F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b")), F.col("size_a") + F.col("size_b"))
    tested: list[DataFrame] = []
    links: list[DataFrame] = []
    while True:
        if "at" not in members.columns:
            members = members.withColumn("at", F.lit(0).cast("long"))
        counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("smallest")).where("n > 1")
        able = enough(F.col("size") - F.col("at"), F.col("size") + F.greatest("smallest", F.ceil(F.col("size") * percent / 100)))
        shared = materialise(members.join(counts, "key").where(able), "shared")
        weights = shared.groupBy("node").agg(F.sum("n").alias("weight"))
        weighed = materialise(shared.join(weights, "node"), "weighed")
        hub = F.min(F.struct("at", -F.col("weight"), "node", "size")).alias("hub")
        hubs = weighed.groupBy("key").agg(hub).select("key", F.col("hub.node").alias("a"), F.col("hub.size").alias("size_a"), F.col("hub.at").alias("at_a"))
        stars = side(shared, "b").join(materialise(hubs, "hubs"), "key").where("a <> b").where(fits)
        labels = learn(possible(stars))
        discard(weighed)

        placed = shared.select("key", "node", "size", "at").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        placed = materialise(placed, "placed")
        if refine:
            split = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
            crowded = materialise(placed.join(split, "key", "left_semi").select("node").distinct(), "crowded")
            discard(shared, placed)
            if crowded.isEmpty():
                return labels
            members, refine = materialise(refine(crowded), "finer"), None
            continue
        parts = placed.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
        core = parts.groupBy("key").agg(F.max(F.struct("n", "label")).alias("core"), F.count(F.lit(1)).alias("parts"))
        split = core.where("parts > 1").select("key", F.col("core.label").alias("core"))
        open_ = materialise(placed.join(split, "key"), "open")
        left, right = side(open_.where("label <> core"), "a", "label"), side(open_, "b", "label")
        rest = possible(left.join(right, "key").where(F.col("label_a") != F.col("label_b")).where(fits))
        discard(shared, placed, open_)
        return labels if rest.isEmpty() else learn(rest)
