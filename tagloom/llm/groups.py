"""Consolidating pairwise matches into groups: connected components over a link table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.tables import Scratch

#: A frontier or label table of at most so many rows is broadcast; its size is counted first.
BROADCAST_ROWS = 20_000


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


#: Times a round follows each label to its own label.
JUMPS = 2


def minimum_labels(links: DataFrame, scratch: Scratch, rounds: int) -> DataFrame:
    """``node, component`` for links that are held in both directions: the smallest node of each component.

    Each round gives a node the smallest of itself and its neighbours, follows
    the labels a few steps, and puts labels in the place of nodes: what is left
    is the graph of the labels, a fraction of the last one, also along chains.
    At the end the rounds' labels are composed, the smallest table first.
    """
    tables = []
    for _ in range(rounds):
        labels = links.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        for _ in range(JUMPS):
            labels = scratch.put(labels)
            next_to = labels.select(F.col("node").alias("to"), F.col("to").alias("further"))
            labels = labels.join(next_to, "to").select("node", F.col("further").alias("to"))
        labels = scratch.put(labels)
        tables.append(labels)
        ends = links.join(labels.toDF("a", "_a"), "a").join(labels.toDF("b", "_b"), "b")
        rest = scratch.put(ends.where("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct())
        scratch.drop(links)
        links = rest
        if not links.limit(1).count():
            break
    else:
        raise RuntimeError(f"labels still change after {rounds} rounds")
    found = tables[-1].toDF("node", "component")
    for labels in reversed(tables[:-1]):
        found = labels.join(found.toDF("to", "last"), "to", "left").select("node", F.coalesce("last", "to").alias("component"))
        found = scratch.put(found)
    return found


def components(links: DataFrame, rounds: int = 200) -> DataFrame:
    """``node, component``: every node of ``links`` (``a, b``, longs) with the smallest node it is linked to.

    The giant component goes first: breadth-first search from the node of
    highest degree, one join a step of the frontier with the links, while the
    layers grow. The nodes reached leave the link table and stand as one node
    in it, for what still hangs on them. The rest is labelled by propagating
    the minimum over the links; after each round labels stand for their nodes,
    so a chain of n links takes about log n rounds. Both ends of a
    link are held, so either may be hot: a step keeps the minimum a node, which
    is aggregated before it is shuffled, and a frontier of few rows is broadcast
    after a count. Every table between rounds is written to the shared folder.
    Null ends and links of a node to itself add nothing beyond the node itself;
    repeated links count once.
    """
    spark = links.sparkSession
    scratch = Scratch(spark)
    ends = links.where("a is not null and b is not null").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    both = ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = scratch.put(both.where("a <> b"))
    alone = both.where("a = b").select(F.col("a").alias("node"))
    nodes = edges.select(F.col("a").alias("node")).unionByName(alone).distinct()

    hub = edges.groupBy("a").agg(F.count("*").alias("n")).agg(F.max_by("a", F.struct("n", (-F.col("a")).alias("i"))).alias("a")).first()["a"]
    if hub is None:
        return nodes.select("node", F.col("node").alias("component"))
    # Peel: search breadth-first as long as layers grow; what hangs on the last ones is left to the propagation.
    frontier, n_frontier = spark.createDataFrame([(hub,)], "node long"), 1
    layers = [frontier]
    for k in range(rounds):
        near = edges.join(_small(frontier.select(F.col("node").alias("a")), n_frontier), "a", "left_semi") if k else edges.where(F.col("a") == hub)
        reached = near.select(F.col("b").alias("node")).distinct()
        # a neighbour is in the layer before, in this one or in the next
        fresh = reached.join(layers[-1].unionByName(layers[-2]), "node", "left_anti") if k else reached  # the hub has no link to itself
        frontier = scratch.put(fresh)
        before, n_frontier = n_frontier, frontier.count()
        layers.append(frontier)
        if n_frontier <= before:
            break
    giant = scratch.put(reduce(DataFrame.unionByName, layers))
    low = giant.agg(F.min("node")).first()[0]

    # The peeled nodes stand as one from here on: links within them are gone, links out of them start at that one.
    inside = giant.select(F.col("node").alias("a"), F.lit(low).alias("_a"))
    outer = edges.join(inside, "a", "left").where("_a is null").select("a", "b").join(inside.toDF("b", "_b"), "b", "left").select("a", F.coalesce("_b", "b").alias("b"))
    outer = scratch.put(outer.distinct())
    hung = outer.where(F.col("b") == low).select(F.col("b").alias("a"), F.col("a").alias("b"))
    small = scratch.put(outer.unionByName(hung))
    scratch.drop(edges, outer, *layers)
    labels = minimum_labels(small, scratch, rounds)
    found = labels.where(F.col("node") == low).agg(F.min("component")).first()[0]
    giant_labels = giant.select("node", F.lit(low if found is None else found).alias("component"))
    labelled = giant_labels.unionByName(labels.where(F.col("node") != low).select("node", "component"))
    lone = alone.join(labelled, "node", "left_anti").distinct()
    return labelled.unionByName(lone.select("node", F.col("node").alias("component")))


def tag_groups(tags: DataFrame, status: DataFrame, aliases: DataFrame) -> DataFrame:
    """``tag_id, group_id``: tags records in groups of two or more, with the group's smallest tag_id.

    A name is a node of its own. Where tags records carry it, it stands on the
    smallest of their ids and the others link to that one, so a name shared by a
    third of all records is a star and never a set of pairs; other names get
    numbers below zero, written once so that they hold if a task runs again.
    Names compare byte by byte; null names link nothing.
    """
    scratch = Scratch(tags.sparkSession)
    named = tags.select("tag_id", F.col("source_tag").alias("name")).where("tag_id is not null")
    pairs = aliases.select(F.col("alias").alias("x"), F.col("tag").alias("y")).where("x is not null and y is not null").distinct()
    names = pairs.select(F.col("x").alias("name")).unionByName(pairs.select(F.col("y").alias("name"))).distinct()
    held = named.where("name is not null").join(names, "name", "left_semi").groupBy("name").agg(F.min("tag_id").alias("node"))
    numbered = names.join(held, "name", "left").select("name", F.coalesce("node", -1 - F.monotonically_increasing_id()).alias("node"))
    numbered = scratch.put(numbered)
    name_links = (
        pairs.join(numbered.select(F.col("name").alias("x"), F.col("node").alias("a")), "x").join(numbered.select(F.col("name").alias("y"), F.col("node").alias("b")), "y").select("a", "b")
    )
    carried = named.join(numbered.where("node >= 0").select("name", F.col("node").alias("b")), "name").select(F.col("tag_id").alias("a"), "b")
    ids = named.select("tag_id").distinct()
    status_links = (
        status.where("alias = 1").select(F.col("tag_id").alias("a"), F.col("preferred_tag_id").alias("b")).where("a <> b").distinct()
        .join(ids.select(F.col("tag_id").alias("a")), "a", "left_semi")
        .join(ids.select(F.col("tag_id").alias("b")), "b", "left_semi")
    )
    found = scratch.put(components(name_links.unionByName(carried).unionByName(status_links)))
    real = found.where("node >= 0")
    groups = real.groupBy("component").agg(F.min("node").alias("group_id"), F.count("*").alias("n")).where("n > 1")
    return real.join(groups, "component").select(F.col("node").alias("tag_id"), "group_id")
