"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.sources.staging import scratch, stage


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node of ``edges`` (a, b) reaches: node, component.

    In each round every node joins its smallest neighbour if that is smaller, and the edges
    between joined nodes go on; every node that isn't smallest among its neighbours is gone
    after a round, so the rounds are few and shrink. A hub's edges meet in a map-side
    minimum, never in one group.
    """
    with scratch(edges.sparkSession) as keep:
        edges = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).where("false")
        first = True
        while not edges.isEmpty():
            both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            parents = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")).select(F.col("a").alias("n"), "p"), "parents")
            if first:
                labels, first = parents.select(F.col("n").alias("node"), F.col("p").alias("component")), False
            else:
                labels = stage(labels.join(parents, F.col("component") == F.col("n"), "left").select("node", F.coalesce("p", "component").alias("component")), "labels")
            pa, pb = parents.select(F.col("n").alias("a"), F.col("p").alias("pa")), parents.select(F.col("n").alias("b"), F.col("p").alias("pb"))
            joined = edges.join(pa, "a").join(pb, "b").where("pa <> pb")
            edges = stage(joined.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        return keep(labels, "components")
