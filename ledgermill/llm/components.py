"""Connected components of a link table, as rounds of joins and groupings.

Alternating large-star and small-star steps: each round replaces the links by links to smaller
neighbours, so long chains shrink in a logarithmic number of rounds. A node with very many links is
never gathered: every step is a minimum per node (combined before the shuffle) and a join back.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import HOT_SHARE, join_hot, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def spanning(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which links (positions ``a``, ``b``) join different labels, without cycles, and the labels after.

    ``label[i]`` names the part that position i belongs to so far. Each round takes one link for each
    larger label and hooks it to the smaller one.
    """
    index, chosen = np.arange(len(a)), []
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            break
        a, b, index, low, high = a[apart], b[apart], index[apart], low[apart], high[apart]
        hooks, first = np.unique(high, return_index=True)
        chosen.append(index[first])
        to = np.arange(len(label))
        to[hooks] = low[first]
        while True:
            nearer = to[to]
            if np.array_equal(nearer, to):
                break
            to = nearer
        label = to[label]
    return (np.sort(np.concatenate(chosen)) if chosen else np.zeros(0, np.int64)), label


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step over links (a, b). Large: connect the larger neighbours of a node to its smallest
    neighbour (itself included); small: connect the smaller ones (and itself)."""
    both = links.union(links.select("b", "a")) if large else links.select(F.greatest("a", "b"), F.least("a", "b"))
    both = both.toDF("node", "near")
    least = both.groupBy("node").agg(F.min("near").alias("_m"), F.count(F.lit(1)).alias("_n"))
    least = stage(least.select("node", F.least("node", "_m").alias("_m"), "_n"), "least")
    total = links.count() * (2 if large else 1)
    found = join_hot(both, least, "node", F.col("_n") > max(1000, total * HOT_SHARE))
    if large:
        out = found.where(F.col("near") > F.col("node")).select(F.col("near").alias("a"), F.col("_m").alias("b"))
    else:
        out = found.select(F.col("near").alias("a"), F.col("_m").alias("b")).union(least.select(F.col("node").alias("a"), F.col("_m").alias("b")))
    return stage(out.where("a <> b").distinct(), "links")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has a link; ids are longs.

    An empty link table gives an empty result; self links and repeated links change nothing.
    """
    links = stage(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(), "links")
    before = None
    while True:
        shape = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if shape == before or not shape[0]:
            break
        before = shape
        links = _star(_star(links, large=True), large=False)
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
