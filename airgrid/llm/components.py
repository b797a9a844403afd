"""Connected components of a graph given as rows of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.session import Workspace


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """`links`: a, b. One row per node that is in a link: node, component (the smallest node of its component).

    Randomised contraction: in every round each node joins its neighbour that comes first in a random order of that
    round (or stays, if none comes before it), and links are drawn anew between what they joined. The expected number
    of links falls by a constant factor a round whatever the graph's shape, long chains and large stars alike. Every
    round's table is written, so nothing is gathered in the driver and a lost executor costs one round at most.
    """
    links = work.keep(links.select("a", "b").where("a <> b").distinct(), "links")
    joined, k = [], 0
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = F.xxhash64(F.col("b"), F.lit(k))
        first = both.groupBy("a").agg(F.min(F.struct(order.alias("turn"), "b")).alias("first"))
        stays = F.xxhash64(F.col("a"), F.lit(k)) < F.col("first.turn")
        to = work.keep(first.select(F.col("a").alias("node"), F.when(stays, F.col("a")).otherwise(F.col("first.b")).alias("to")), "joined")
        joined.append(to)
        left = to.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = to.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = links.join(left, "a").join(right, "b").where("x <> y")
        before, links = links, work.keep(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        work.drop(before)
        k += 1
    if not joined:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = joined.pop()
    while joined:
        later, earlier = labels, joined.pop()
        ends = later.select(F.col("node").alias("to"), F.col("to").alias("end"))
        labels = work.keep(earlier.join(ends, "to", "left").select("node", F.coalesce("end", "to").alias("to")), "labels")
        work.drop(later, earlier)
    smallest = labels.groupBy("to").agg(F.min("node").alias("component"))
    found = work.keep(labels.join(smallest, "to").select("node", "component"), "components")
    work.drop(links, labels)
    return found
