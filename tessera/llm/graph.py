"""Connected components without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import through_table


def components(links: DataFrame) -> DataFrame:
    """(v, root): the smallest vertex reachable from each vertex of links (a, b).

    Large-star and small-star rounds; each ends in a written table, so that lineage
    stays short. A vertex's smallest neighbour is found by partial aggregation; the
    join that hands it out has small rows, and adaptive execution splits its hot keys.
    An empty table gives no row; loops and repeated links do no harm.
    """
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = through_table(pairs, "links"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("v"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("v"), F.col("b").alias("root")).distinct())
        before = state
        both = now.union(now.select("b", "a"))
        large = _star(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = _star(large.filter("a <> b").distinct())
        rest = small.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(small.filter("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b")))
        now = through_table(rest.distinct(), "links")


def _star(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the smallest of u and its neighbours."""
    edges = edges.toDF("u", "v")
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")
