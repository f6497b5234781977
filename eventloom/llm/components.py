"""Connected components: inside a task over index pairs, and over tables of edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def min_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node of its component, given edges (a, b)."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def spanning_stars(edges: DataFrame) -> DataFrame:
    """``code, root`` for every node of ``edges (a, b)``, roots included.

    Alternating large-star and small-star rounds: each links nodes to the smallest neighbour; the number of rounds grows as
    the logarithm of the size. Minima are pre-aggregated, and no neighbourhood is collected. Every round is stored.
    """
    edges = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, state = None, edges.agg(F.count("*")).head()
    while state != before and state[0]:
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .filter("a <> b")
            .distinct()
        )
        edges = materialize(small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("code"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("code"), F.col("b").alias("root"))
    )
