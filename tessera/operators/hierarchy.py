"""Hierarchies: parents, closure, and refusal of links that would close a cycle."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.scratch import numbered, written


def tree_parents(owners: DataFrame, number: str = "number", key: str = "key", separator: str = ".") -> DataFrame:
    """(child, parent) of owners of tree numbers: the parent owns the number less its last part."""
    up = F.regexp_replace(F.col(number), r"[" + separator + r"][^" + separator + r"]*$", "")
    child = owners.filter(F.col(number).contains(separator)).select(F.col(key).alias("child"), up.alias("up"))
    return child.join(owners.select(F.col(number).alias("up"), F.col(key).alias("parent")), "up").filter("child <> parent").select("child", "parent").distinct()


#: Levels of a hierarchy at most: beyond it, ``closure`` takes the links for a cycle and raises.
MOST_LEVELS = 64


def closure(links: DataFrame, child: str = "child", parent: str = "parent", depth: int | None = None) -> DataFrame:
    """(child, ancestor, depth): shortest ways up, all or those up to a depth. The links must be free of cycles.

    Each round joins what the last one found, and only what is new goes on.
    """
    base = links.select(F.col(child).alias("child"), F.col(parent).alias("ancestor")).distinct()
    step = every = base.withColumn("depth", F.lit(1))
    up = base.select(F.col("child").alias("mid"), F.col("ancestor").alias("next"))
    for d in range(2, (depth or MOST_LEVELS) + 1):
        step = step.join(up, F.col("ancestor") == F.col("mid")).select("child", F.col("next").alias("ancestor"), F.lit(d).alias("depth")).distinct()
        if depth is None and step.isEmpty():
            break
        every = every.unionAll(step)
    else:
        if depth is None:
            raise ValueError("more levels than a hierarchy can have: the links hold a cycle")
    return every.groupBy("child", "ancestor").agg(F.min("depth").alias("depth"))


def tangles(links: DataFrame) -> DataFrame:
    """(v, part): the vertices on cycles of links (child, parent), with the greatest vertex of their strongly connected part.

    What has nothing above or nothing below lies on no cycle and is trimmed first. Then
    every vertex takes the greatest vertex that reaches it as its colour, and what reaches
    a colour's own vertex inside the colour is a part; both go in rounds of joins that only
    carry what changed. Found parts are taken out, and the rest starts anew. Rounds are as
    many as the longest way through what trimming left; a hierarchy has few levels.
    """
    rest = written(links.select("child", "parent").filter("child <> parent").distinct(), "links")
    found: DataFrame | None = None
    while True:
        n = rest.count()
        while n:
            above, below = rest.select(F.col("parent").alias("child")).distinct(), rest.select(F.col("child").alias("parent")).distinct()
            rest = written(rest.join(above, "child", "left_semi").join(below, "parent", "left_semi"), "trimmed")
            n, before = rest.count(), n
            if n == before:
                break
        if not n:
            return found if found is not None else rest.select(F.col("child").alias("v"), F.col("parent").alias("part"))
        colour = rest.select(F.explode(F.array("child", "parent")).alias("v")).distinct().withColumn("c", F.col("v"))
        changed = colour = written(colour, "colour")
        while not changed.isEmpty():
            met = rest.join(changed.withColumnRenamed("v", "child"), "child").groupBy(F.col("parent").alias("v")).agg(F.max("c").alias("new"))
            colour = written(colour.join(met, "v", "left").select("v", F.greatest("c", "new").alias("c"), (F.col("new") > F.col("c")).alias("up")), "colour")
            changed = colour.filter("up").select("v", "c")
            colour = colour.select("v", "c")
        inside = rest.join(colour.toDF("child", "c"), "child").join(colour.toDF("parent", "d"), "parent").filter("c = d").select("child", "parent", "c")
        inside = written(inside, "inside")
        fresh = part = colour.filter("v = c").select("v", F.col("c").alias("part"))
        while not fresh.isEmpty():
            fresh = inside.join(fresh.select(F.col("v").alias("parent")), "parent", "left_semi").select(F.col("child").alias("v"), F.col("c").alias("part")).distinct()
            fresh = written(fresh.join(part, ["v", "part"], "left_anti"), "fresh")
            part = written(part.union(fresh), "part")
        out = part.select("v").distinct()
        many = part.join(part.groupBy("part").count().filter("count > 1"), "part").select("v", "part")
        found = many if found is None else found.union(many)
        rest = written(rest.join(out.toDF("child"), "child", "left_anti").join(out.toDF("parent"), "parent", "left_anti"), "rest")


def in_order(candidates: list[tuple[str, str]]) -> list[bool]:
    """Which candidates (child, parent) stay, taken in order, if one that would close a cycle goes.

    A topological order is kept up to date (Pearce and Kelly): a link that agrees with it costs
    nothing, another one looks only at vertices between its ends.
    """
    place: dict[str, int] = {}
    up: dict[str, set[str]] = {}
    down: dict[str, set[str]] = {}
    stay = []
    for child, parent in candidates:
        for v in (child, parent):
            place.setdefault(v, len(place))
        lo, hi = place[parent], place[child]
        ok = child != parent
        # Children stand before their parents; otherwise those in between move.
        if ok and lo < hi:
            ahead, todo = {parent}, [parent]
            while todo and ok:
                for x in up.get(todo.pop(), ()):
                    if x == child:
                        ok = False
                        break
                    if place[x] < hi and x not in ahead:
                        ahead.add(x)
                        todo.append(x)
            if ok:
                behind, todo = {child}, [child]
                while todo:
                    for x in down.get(todo.pop(), ()):
                        if place[x] > lo and x not in behind:
                            behind.add(x)
                            todo.append(x)
                moved = sorted(behind, key=place.__getitem__) + sorted(ahead, key=place.__getitem__)
                for v, p in zip(moved, sorted(place[v] for v in moved)):
                    place[v] = p
        if ok:
            up.setdefault(child, set()).add(parent)
            down.setdefault(parent, set()).add(child)
        stay.append(ok)
    return stay


def accept(candidates: DataFrame) -> DataFrame:
    """(child, parent) accepted of candidates (child, parent, ord): in order, what would close a cycle goes.

    Ties of ord go by child and parent; a repeated link counts once, at its first place; loops
    and links with a null end go. A link between different strongly connected parts of
    all candidates lies on no cycle, whatever stays, and stays itself. Only the links inside a
    part are walked in order, each part in a task of its own: a choice in order can't be split
    further, so a part's links must fit in a task.
    """
    first = candidates.filter("child <> parent").groupBy("child", "parent").agg(F.min("ord").alias("ord"))
    first = written(first, "candidates")
    part = tangles(first)
    both = first.join(part.select(F.col("v").alias("child"), "part"), "child", "left").join(part.select(F.col("v").alias("parent"), F.col("part").alias("upper")), "parent", "left")
    both = written(both.select("child", "parent", "ord", F.when(F.col("part") == F.col("upper"), F.col("part")).alias("part")), "parts")

    def walk(links: pd.DataFrame) -> pd.DataFrame:
        links = links.sort_values(["ord", "child", "parent"], kind="stable")
        return links.loc[in_order(list(zip(links["child"], links["parent"]))), ["child", "parent"]]

    kind = first.schema["child"].dataType.simpleString()
    walked = both.filter("part is not null").groupBy("part").applyInPandas(walk, f"child {kind}, parent {kind}")
    return both.filter("part is null").select("child", "parent").unionByName(walked)


def _upper(links: DataFrame, hops: int | None) -> tuple[DataFrame, DataFrame]:
    """((v, code) of all parents, (key, ups): codes of the parents at each key or above it, up to so many hops)."""
    links = written(links.select("child", "parent").filter("child is not null").distinct(), "links")
    inner = written(numbered(links.select(F.col("parent").alias("v")).distinct(), "v", name="code"), "inner")
    links = written(links.join(inner, F.col("parent").eqNullSafe(F.col("v"))).select("child", F.col("code").alias("up")), "coded")
    # Only what has something below it goes up level by level; all other keys take what their parents found.
    step = written(links.join(inner.toDF("child", "mid"), "child").select("mid", F.col("up").alias("next")), "step")
    new = every = inner.select(F.col("code").alias("low"), F.col("code").alias("up"))
    level = 1
    while hops is None or level < hops:
        new = new.join(step, F.col("up") == F.col("mid")).select("low", F.col("next").alias("up")).distinct()
        new = written(new.join(every, ["low", "up"], "left_anti"), "above")
        if new.isEmpty():
            break
        if level > MOST_LEVELS:
            raise ValueError("more levels than a hierarchy can have: the links hold a cycle")
        every, level = every.unionByName(new), level + 1
    above = every.groupBy("low").agg(F.collect_list("up").alias("ups"))
    lower = links.join(above, F.col("up") == F.col("low")).select(F.col("child").alias("key"), "ups")
    own = inner.filter("v is not null").select(F.col("v").alias("key"), F.array("code").alias("ups"))
    return inner, lower.unionByName(own).groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("ups"))).alias("ups"))


def distinct_up(facts: DataFrame, links: DataFrame, hops: int | None = None, fact: str = "fact", key: str = "key") -> DataFrame:
    """(key, direct, below): distinct facts at each key, and at it or what lies under it up to so many hops.

    facts: (fact, key); links: (child, parent), free of cycles. A fact under two children counts
    once. A key without children counts its own facts, where those of a key meet. For the others,
    each fact takes along the codes of the keys at it or above it, and facts meet once more, by
    themselves: what each has above it is made distinct there, and only counts go on. So facts are
    shuffled twice, whatever the number of levels, and a root of all facts is one count a task.
    """
    pairs = facts.select(F.col(key).alias("key"), F.col(fact).alias("fact")).filter("fact is not null and key is not null").repartition("key").distinct()
    at = F.lit(None).cast("array<bigint>")
    if hops is None or hops:
        inner, upper = _upper(links, hops)
        pairs, at = pairs.join(upper, "key", "left"), F.col("ups")
    # Rows of a key are next to each other in the table, so they are counted where they lie.
    pairs = written(pairs.select("key", "fact", at.alias("ups")), "facts")
    counts = pairs.select("key", F.lit(1).alias("one"), F.lit(None).cast("long").alias("below"))
    if hops is None or hops:
        above = pairs.filter("ups is not null").select("fact", "ups").repartition("fact").select("fact", F.explode("ups").alias("code")).distinct()
        met = above.groupBy("code").agg(F.count("*").alias("below")).join(inner, "code").select(F.col("v").alias("key"), F.lit(0).alias("one"), "below")
        counts = counts.unionByName(met)
    return counts.groupBy("key").agg(F.sum("one").alias("direct"), F.coalesce(F.max("below"), F.sum("one")).alias("below"))


def roll_up(facts: DataFrame, key: str, ancestors: DataFrame, measures: list) -> DataFrame:
    """Facts counted at their keys and all ancestors (child, ancestor)."""
    up = facts.select(key).distinct().select(F.col(key).alias("child"), F.col(key).alias("ancestor")).unionByName(ancestors.select("child", "ancestor")).distinct()
    return facts.join(up, facts[key] == up["child"]).groupBy("ancestor").agg(*measures)
