"""Connected components of a link table, by joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """One row per linked id: ``id`` and ``component``, the smallest id reachable.

    ``links`` has columns a and b. Each round hangs every neighbour of an id on the
    smallest id around it, then every id's smaller neighbours on the smallest of
    them, until nothing moves; chains shrink by half or more each round. Ids with
    many neighbours are joined, not gathered. Every round is a written table.
    """
    edges = stored(
        links.where("a <> b")
        .select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
        .distinct(),
        "links",
    )
    while True:
        both = edges.select("high", "low").union(edges.select("low", "high")).toDF("id", "near")
        roots = both.groupBy("id").agg(F.least(F.min("near"), F.col("id")).alias("root"))
        larger = (
            both.where("near > id").join(roots, "id").select(F.col("near").alias("id"), "root")
        )
        large = stored(larger.where("id <> root").distinct(), "large_star")
        roots = large.groupBy("id").agg(F.min("root").alias("least"))
        hung = large.join(roots, "id").select(
            F.explode(
                F.array(
                    F.struct(F.col("id").alias("high"), F.col("least").alias("low")),
                    F.struct(F.col("root").alias("high"), F.col("least").alias("low")),
                )
            ).alias("e")
        )
        after = stored(hung.select("e.low", "e.high").where("low <> high").distinct(), "small_star")
        # A star is done: every id hangs on one root, and no root hangs on anything.
        both = F.array(
            F.struct(F.col("high").alias("id"), F.lit(1).alias("hangs")),
            F.struct(F.col("low").alias("id"), F.lit(0).alias("hangs")),
        )
        ends = after.select(F.inline(both)).groupBy("id")
        open_ = ends.agg(F.sum("hangs").alias("n"), F.min("hangs").alias("least"))
        open_ = open_.where("n > 1 OR (n = 1 AND least = 0)")
        edges = after
        if open_.isEmpty():
            break
    found = edges.select(F.col("high").alias("id"), F.col("low").alias("component"))
    return found.unionByName(
        edges.select(F.col("low").alias("id"), F.col("low").alias("component")).distinct()
    )
