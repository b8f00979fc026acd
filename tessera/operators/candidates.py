"""The nodes that a condition may mean, with what is needed to choose between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import fold
from tessera.operators import hierarchy
from tessera.operators.fulltext import Index
from tessera.scratch import written

#: Candidates of a condition, levels below them that count, characters of the synonyms that are shown.
MOST, HOPS, SHOWN = 12, 3, 160


def under(links: DataFrame, roots: DataFrame, hops: int) -> DataFrame:
    """The links (child, parent) on ways of at most so many hops down to the roots (key)."""
    links = links.select("child", "parent").distinct()
    at, out = roots.select(F.col("key").alias("parent")), None
    for _ in range(hops):
        step = links.join(at, "parent", "left_semi")
        out = step if out is None else out.union(step)
        at = step.select(F.col("child").alias("parent")).distinct()
    return out.distinct()


def candidates(index: Index, nodes: DataFrame, links: DataFrame, studies: DataFrame, condition: str, most: int = MOST, hops: int = HOPS) -> DataFrame:
    """(key, name, score, direct, below, children, synonyms) of the best matches of a condition, most studied first.

    index: of the nodes' names and synonyms, by ``id``; nodes: (id, key, name, synonyms); links:
    (child, parent); studies: (fact, key). direct: the distinct studies of a node itself;
    below: of it and what lies at most ``hops`` levels under it, each once; children: how many nodes
    lie there. Many children say that the condition is a category. A condition without a word
    has no candidate.
    """
    tokens = [w for w in index.spark.range(1).select(F.explode(F.split(fold(F.lit(condition)), " "))).toPandas().iloc[:, 0] if w]
    columns = ["key", "name", "score", "direct", "below", "children", "synonyms"]
    if not tokens:
        return nodes.limit(0).select("key", "name", *[F.lit(0).alias(c) for c in columns[2:6]], "synonyms")
    # As many rows as candidates.
    found = written(F.broadcast(index.best(tokens, most)).join(nodes, "id").select("key", "name", "score", F.left(F.coalesce("synonyms", F.lit("")), F.lit(SHOWN)).alias("synonyms")), "candidates")
    part = written(under(links, found, hops), "under")
    keys = part.select(F.col("child").alias("key")).union(found.select("key")).distinct()
    counted = hierarchy.distinct_up(studies.join(keys, "key", "left_semi"), part, hops)
    kids = hierarchy.distinct_up(keys.select(F.col("key").alias("fact"), "key"), part, hops).select("key", (F.col("below") - 1).alias("children"))
    out = found.join(counted, "key", "left").join(kids, "key", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("key", "name", "score", zero("direct"), zero("below"), zero("children"), "synonyms").orderBy(F.desc("direct"), F.desc("score"), "key")
