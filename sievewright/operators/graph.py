"""Connected components of a graph of any size, without collecting links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import joined_to_groups
from .workspace import Workspace


def components(edges: DataFrame, work: Workspace, name: str = "components") -> DataFrame:
    """(id, component) of every id on an edge (a, b) of two longs; component is the least id that it reaches.

    Alternating large and small stars: each round links every id to the least of its neighbours, and the rounds end when
    the links stay as they are. Rounds are written to the shared folder, which ends their lineage. The links of a hub
    stay where they are and meet its least neighbour by a broadcast of the hubs, whose number is bounded
    (`joined_to_groups`). Null ids and loops are dropped; no edges give no rows.
    """

    def least_of(rows: DataFrame, step: str) -> DataFrame:
        """(u, v, m) of rows (u, v): m is the least neighbour of u."""
        facts = work.save(rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("many")), f"{name}-{step}-least")
        return joined_to_groups(rows, facts, "u").drop("many")

    now = work.save(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    mark, k = None, 0
    while True:
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == mark or not seen[0]:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        mark, k = seen, k + 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = least_of(both, f"{k}-large").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = work.save(large, f"{name}-{k}-large")
        # an id's least neighbour is linked to the id, all its other neighbours to that
        small = least_of(large, f"{k}-small")
        small = small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        now = work.save(small, f"{name}-{k}")
        work.drop(f"{name}-{k - 1}", *(f"{name}-{k}-{x}" for x in ("large", "large-least", "small-least")))
