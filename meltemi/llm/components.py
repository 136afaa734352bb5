"""Connected components by alternating stars (Kiveris et al., SoCC 2014), as joins and grouped minima."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meltemi.llm.common import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SALTS = 16


class Forest:
    """Components of items 0 to n - 1 in one task; edges come in blocks and those that join something come out."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def unite(self, a: np.ndarray, b: np.ndarray) -> Iterator[np.ndarray]:
        """Which of the given edges join something: in all, one less than the items of each component."""
        while True:
            x, y = self.root[a], self.root[b]
            apart = np.flatnonzero(x != y)
            if not len(apart):
                return
            high, low = np.maximum(x, y)[apart], np.minimum(x, y)[apart]
            order = np.lexsort((low, high))
            first = order[np.flatnonzero(np.diff(high[order], prepend=-1))]
            high, low = high[first], low[first]
            yield apart[first]
            jump = np.arange(len(self.root))
            jump[high] = low
            while (jump[jump] != jump).any():
                jump = jump[jump]
            self.root = jump[self.root]


def _send_minimum(edges: DataFrame, least: DataFrame) -> DataFrame:
    """(u, v) joined with (u, m); a hub's edges are dealt over SALTS tasks, and AQE may split further."""
    salt = F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")
    copies = least.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return edges.withColumn("salt", salt).join(copies, ["u", "salt"]).select("u", "v", "m")


def connected_components(edges: DataFrame, a: str, b: str, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of the component.

    Self edges and repeated edges are allowed, null ends are ignored. A round sends each larger
    neighbour to the smallest one, then joins smaller neighbours likewise; edges never grow in
    number and rounds follow the logarithm of the longest path. Each round is a written table.
    """
    stars = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    stars = scratch.write(stars.filter(F.col(a) != F.col(b)).distinct(), "stars")
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _send_minimum(both.filter("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.write(large.filter("u > v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _send_minimum(large, least).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.filter("u > v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        done = scratch.write(small, "stars")
        scratch.drop(stars, large)
        stars = done
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = stars.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
