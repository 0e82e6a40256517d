"""Connected components of links between numbered nodes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replat.llm.common import staged


#: Nodes that a task holds at a time, about.
HELD = 300_000


def _forest(parts: Iterator[pd.DataFrame], held: int = HELD) -> Iterator[pd.DataFrame]:
    """Links of one partition as (node, smallest node it is tied to here); where it has many nodes, one
    forest after another."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent.setdefault(parent[x], parent[x])
        return x

    def forest() -> pd.DataFrame:
        found = np.array([(x, r) for x in parent if (r := root(x)) != x], np.int64).reshape(-1, 2)
        return pd.DataFrame({"u": found[:, 0], "v": found[:, 1]})

    for part in parts:
        for a, b in zip(part["a"].tolist(), part["b"].tolist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > held:
            yield forest()
            parent.clear()
    yield forest()


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of every node with a link to another: the smallest node it can reach.

    ``links`` has ``a, b`` (long). Each partition first reduces its links to a forest; then nodes hand their
    smallest neighbour to the larger ones (large star) and to the smaller ones (small star) until nothing
    changes. Minima are taken before the shuffle, and the joins on a node with many links are ones that
    Spark can split.
    """
    edges = staged(links.select("a", "b").mapInPandas(_forest, "u long, v long"))

    def state(df: DataFrame) -> tuple[int, int]:
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    before = None
    while (now := state(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(lowest.select("u", F.col("m").alias("v"))).distinct())
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
