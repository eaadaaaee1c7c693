"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.scratch import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in ``links`` (a, b): root is the smallest id reachable.

    Stars are contracted in turns: each node's larger neighbours move to its smallest
    one, then its smaller ones do, until every edge ends at a root. A node of any
    degree is a minimum and a join, which split; no list of neighbours is built. Every
    turn is a written table.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = materialise(edges.distinct(), "edges")
    before, now = None, _state(edges)
    while now != before:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        edges = materialise(
            small.where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .distinct(),
            "edges",
        )
        before, now = now, _state(edges)
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("id"), F.col("b").alias("root"))
    )
