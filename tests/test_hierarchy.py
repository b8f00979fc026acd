"""One hierarchy over several vocabularies, and distinct counts up a tree, against brute force."""

import collections
import random

from pyspark.sql import functions as F

from tessera.operators import candidates, fulltext, hierarchy


def brute_accept(candidates):
    above, kept = collections.defaultdict(set), []
    for _, child, parent in sorted(candidates, key=lambda x: (x[0], x[1], x[2])):
        seen, todo = set(), [parent]
        while todo:
            at = todo.pop()
            if at not in seen:
                seen.add(at)
                todo += above[at]
        if child not in seen and (child, parent) not in kept:
            above[child].add(parent)
            kept.append((child, parent))
    return sorted(kept)


def test_order_is_kept_up_to_date():
    rnd = random.Random(1)
    for n in (3, 6, 15):
        for _ in range(60):
            links = [(i, rnd.randrange(n), rnd.randrange(n)) for i in range(4 * n)]
            stay = hierarchy.in_order([x[1:] for x in links])
            assert sorted({x[1:] for x, s in zip(links, stay) if s}) == brute_accept(links)


def test_accepted_links_equal_a_walk(spark):
    """Several tangles, one inside a long chain, repeated and null links, ties of the order."""
    rnd = random.Random(2)
    links = [(rnd.randrange(9), f"v{rnd.randrange(12)}", f"v{rnd.randrange(12)}") for _ in range(60)]
    links += [(rnd.randrange(99), f"w{a}", f"w{b}") for a, b in ((rnd.randrange(40), rnd.randrange(40)) for _ in range(70))]
    links += [(0, f"c{i}", f"c{i + 1}") for i in range(15)] + [(1, "c9", "c5"), (2, "c15", "v1"), (0, "v2", "w3"), (3, "x", "x")]
    frame = spark.createDataFrame([*links, *links[:20], (0, None, "v1"), (0, "v1", None)], "ord int, child string, parent string").withColumn("part", F.lit(1))
    assert sorted(tuple(r) for r in hierarchy.accept(frame).collect()) == brute_accept(links)
    assert not hierarchy.accept(frame.limit(0)).count() and not hierarchy.tangles(frame.limit(0)).count()


def test_tangles_are_strong_parts(spark):
    links = [("a", "b"), ("b", "a"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "c"), ("f", "a"), ("e", "g"), ("g", "h"), ("z", "z")]
    found = {(r.v, r.part) for r in hierarchy.tangles(spark.createDataFrame(links, "child string, parent string")).collect()}
    assert found == {("a", "b"), ("b", "b"), ("c", "e"), ("d", "e"), ("e", "e")}


def test_a_million_links(spark):
    """A tree of a million links with loops thrown in: the loops' last links go, all others stay."""
    n = 1_000_000
    tree = spark.range(1, n).select(F.col("id").alias("child"), F.floor(F.col("id") / 8).cast("long").alias("parent"), F.lit(0).alias("ord"))
    back = spark.range(1000, n, 9973).select(F.floor(F.col("id") / 64).cast("long").alias("child"), F.col("id").alias("parent"), F.lit(1).alias("ord"))
    kept = hierarchy.accept(tree.union(back))
    assert kept.count() == n - 1
    assert not kept.join(back, ["child", "parent"], "left_semi").count()


def brute_up(facts, links, hops):
    kids = collections.defaultdict(set)
    for c, p in links:
        kids[p].add(c)
    own = collections.defaultdict(set)
    for f, k in facts:
        own[k].add(f)
    out = []
    for v in {x for e in links for x in e} | set(own):
        level, under = {v}, {v}
        for _ in range(99 if hops is None else hops):
            level = {c for x in level for c in kids[x]}
            under |= level
        every = set().union(*(own[x] for x in under))
        if every:
            out.append((v, len(own[v]), len(every)))
    return sorted(out)


def test_distinct_counts_up_a_tree(spark):
    rnd = random.Random(3)
    links = [(f"n{i}", f"n{rnd.randrange(i)}") for i in range(1, 60)] + [(f"n{i}", f"n{rnd.randrange(i)}") for i in range(20, 60)]
    facts = [(f"t{rnd.randrange(150)}", f"n{rnd.randrange(70)}") for _ in range(400)] + [("t1", "n0"), ("t1", "n0")]
    f, e = spark.createDataFrame([*facts, (None, "n1"), ("t1", None)], "fact string, key string"), spark.createDataFrame(links, "child string, parent string")
    for hops in (0, 1, 3, None):
        assert sorted(tuple(r) for r in hierarchy.distinct_up(f, e, hops).collect()) == brute_up(facts, links, hops)
    assert not hierarchy.distinct_up(f.limit(0), e, 3).count()
    # More facts than a bitmap has bits.
    many = spark.range(100_000).select(F.col("id").alias("fact"), F.when(F.col("id") % 2 == 0, "n1").otherwise("n2").alias("key"))
    assert {("n0", 0, 100_000)} <= {tuple(r) for r in hierarchy.distinct_up(many, e, None).collect()}


def test_distinct_counts_hold_no_more_than_facts(spark, monkeypatch):
    """Keys with few facts each, which other keys have too: what is written grows with facts and links, not with keys times all facts."""
    tables, written = [], hierarchy.written
    monkeypatch.setattr(hierarchy, "written", lambda df, name: tables.append(written(df, name)) or tables[-1])
    rnd = random.Random(5)
    facts = [(rnd.randrange(70_000), f"n{k}") for k in range(2_000) for _ in range(40)]
    links = [(f"n{k}", f"g{k % 7}") for k in range(2_000)] + [(f"n{k}", f"h{k % 11}") for k in range(2_000)] + [(f"g{k}", "top") for k in range(7)] + [(f"h{k}", None) for k in range(3)]
    got = {r.key: (r.direct, r.below) for r in hierarchy.distinct_up(spark.createDataFrame(facts, "fact int, key string"), spark.createDataFrame(links, "child string, parent string")).collect()}
    sets = collections.defaultdict(set)
    for f, k in facts:
        i = int(k[1:])
        for up in {k, f"g{i % 7}", f"h{i % 11}", "top"} | ({None} if i % 11 < 3 else set()):
            sets[up].add(f)
    assert got == {k: (len(v) if k and k[0] == "n" else 0, len(v)) for k, v in sets.items()}
    cells = lambda df: [F.octet_length(f.name) if f.dataType.simpleString() in ("string", "binary") else 8 * F.size(f.name) if f.dataType.simpleString().startswith("array") else F.lit(8) for f in df.schema]
    held = sum(df.select(sum((F.coalesce(c, F.lit(0)) for c in cells(df)), F.lit(0)).cast("long").alias("n")).agg(F.sum("n")).first()[0] or 0 for df in tables)
    assert held < 100 * (len(facts) + len(links))


def test_candidates_of_many_children_hold_no_bitmaps(spark, monkeypatch, tmp_path):
    """A category of thousands of nodes with a few studies each: no table has a row of bits for each node."""
    tables, written = [], hierarchy.written
    monkeypatch.setattr(hierarchy, "written", lambda df, name: tables.append(written(df, name)) or tables[-1])
    nodes = spark.createDataFrame([(k, f"n{k}", "ache" if k else "red ache", "") for k in range(3_000)], "id bigint, key string, name string, synonyms string")
    links = spark.range(1, 3_000).select(F.format_string("n%d", "id").alias("child"), F.lit("n0").alias("parent"))
    studies = spark.range(9_000).select((F.col("id") * 7919 % 200_000).alias("fact"), F.format_string("n%d", F.col("id") % 3_000).alias("key"))
    index = fulltext.Index(spark, f"{tmp_path}/index").add(nodes, "id", "name")
    got = candidates.candidates(index, nodes, links, studies, "red", most=1).collect()
    assert [(r.key, r.direct, r.below, r.children) for r in got] == [("n0", 3, 9_000, 2_999)]
    assert tables and not any(f.dataType.simpleString() == "binary" for t in tables for f in t.schema)
