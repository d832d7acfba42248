"""Connected components of links, by alternating stars, with nothing gathered on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import freeze
from .common import PART_ROWS, gathered

ROUNDS = 60  # more than the logarithm squared of any number of nodes that fits


def connected(links: DataFrame, amount: int | None = None) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked with over any path; roots themselves are left out.

    ``links``: columns ``a`` and ``b``, whole numbers; order, repeats and links to itself do not matter.
    ``amount``: how many rows, where that is known.
    Each round hangs the larger neighbours of every node on its smallest neighbour (large star), then
    the smaller ones (small star); joins are on nodes and split by adaptive execution where a hub is
    large. Each round is a table in the shared folder.
    """
    links = _pairs(links)
    links = freeze(links if amount is None else gathered(links, amount, PART_ROWS), "links")
    mark = None
    for _ in range(ROUNDS):
        state = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == mark or not state[0]:
            break
        mark = state
        links = freeze(gathered(_small_star(_large_star(links)), state[0], PART_ROWS), "links")
    else:
        raise RuntimeError("the components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _pairs(links: DataFrame) -> DataFrame:
    """Each link once, from the larger node ``a`` to the smaller ``b``."""
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    joined = links.join(least, F.col("b") == F.col("c"))
    return _pairs(joined.select("a", F.col("m").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), "m")
    joined = links.join(least, F.col("a") == F.col("c"))
    return _pairs(joined.select("b", "m").toDF("a", "b").unionByName(least.toDF("a", "b")))


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links with the same components: every node but the smallest with the smallest of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[i], root[j]
        apart = x != y
        if not apart.any():
            break
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root != root[root]).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]
