"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letrado.session import materialize


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or the smaller) neighbours of every node to its least neighbour or itself."""
    if large:
        around = edges.union(edges.select("v", "u")).toDF("u", "v")
        low = around.groupBy("u").agg(F.min("v").alias("low"))
        out = around.join(low, "u").where(F.col("v") > F.col("u"))
    else:
        low = edges.groupBy("u").agg(F.min("v").alias("low"))     # u > v in every edge
        out = edges.join(low, "u")
    new = out.select(F.col("v").alias("u"), F.least("u", "low").alias("v"))
    if not large:
        new = new.union(low.select("u", F.col("low").alias("v")))
    return new.where(F.col("u") != F.col("v")).distinct()


def connected_roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not the least of its component.

    Large-star and small-star steps alternate until the edges stay the same;
    each round is written under the checkpoint folder, so lineage stays short
    and a lost executor costs one round at most.  The driver sees one row of
    counts a round.
    """
    edges = (links.where(F.col("a") != F.col("b"))
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    edges = materialize(edges, "components")
    before = _summary(edges)
    while before[0]:
        edges = materialize(_star(_star(edges, True).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")),
                                  False), "components")
        after = _summary(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
