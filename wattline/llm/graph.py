"""Connected groups of links, without bringing a group together."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import written


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The links of one partition as stars: every id with the smallest id it reaches there."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        top = node
        while (above := parent.setdefault(top, top)) != top:
            top = above
        while parent[node] != top:
            parent[node], node = top, parent[node]
        return top

    for frame in frames:
        for a, b in zip(frame["u"].tolist(), frame["v"].tolist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [node for node in parent if root(node) != node]
    yield pd.DataFrame({"u": nodes, "v": [parent[node] for node in nodes]}, dtype="int64")


def stars(links: DataFrame, a: str = "a", b: str = "b", native: bool = False) -> DataFrame:
    """Columns ``id``, ``root``: every linked id but the smallest of its group, with that smallest id.

    Alternating large and small stars: every id tells its larger neighbours the smallest one it knows,
    then its smaller ones, until nothing changes; the number of rounds grows with the logarithm of the
    group sizes. Minima are formed before the shuffle, and each round is written to the shared
    folder. Unless ``native``, the links of each partition are contracted first, which
    saves rounds and changes no result. Null ids are no links.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))
    )
    edges = written(edges.distinct() if native else edges.mapInPandas(_forest, "u long, v long").distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = written(small.unionByName(low.withColumnRenamed("low", "v")).distinct(), "links")
        before, state = state, _state(edges)
        if before == state:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    """Two sums that tell one set of edges from another."""
    wide = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(wide)).first())
