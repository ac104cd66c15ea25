"""Connected components of a link table by alternating stars, one written table per step."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.store import stored


def _star(pairs: DataFrame, keep) -> DataFrame:
    """Neighbours that ``keep`` selects, linked to the smallest of each node's neighbourhood."""
    # The smallest neighbour is aggregated map-side first and written, so that the join below sees
    # two plain inputs and a node with very many neighbours can be split.
    least = stored(
        pairs.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("n"), F.least("u", "m").alias("m")
        ),
        "star-least",
    )
    return pairs.join(least, pairs["u"] == least["n"]).where(keep).select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )


def _is_star(links: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none itself."""
    twice = links.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
    roots = links.select(F.col("v").alias("u")).distinct()
    chained = roots.join(links.select("u").distinct(), "u", "left_semi")
    return twice.unionByName(chained).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b): the smallest node it is linked to.

    Nodes are longs. Loops, repeated and two-way links do no harm; an empty table gives no rows.
    Links move in two kinds of steps, to the smallest neighbour of a node from its larger and from
    its smaller neighbours, until every node hangs on a root; the number of steps grows with the
    logarithm of the number of nodes. Only counts reach the driver.
    """
    now = stored(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    while not _is_star(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_star(both, F.col("v") > F.col("u")).distinct(), "star-large")
        # From the larger end: each smaller neighbour and the node itself go to the smallest one.
        small = _star(large, F.col("v") != F.col("m")).unionByName(
            large.groupBy("u").agg(F.min("v").alias("v"))
        )
        now = stored(small.distinct(), "star-small")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def local_roots(one: np.ndarray, two: np.ndarray, count: int) -> np.ndarray:
    """Smallest member of the component of each of ``count`` places linked by the given pairs."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[one], label[two])
        new = label.copy()
        np.minimum.at(new, label[one], low)
        np.minimum.at(new, label[two], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
