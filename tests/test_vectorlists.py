"""Inverted lists against all pairs: exact mode, probes and recall, ties, vectors without length."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import vectorlists


def brute(x, asked, k):
    norm = lambda v: v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
    ids = np.array(sorted(x))
    score = norm(np.array([asked[q] for q in sorted(asked)], np.float64)) @ norm(np.array([x[i] for i in ids], np.float64)).T
    out = {}
    for q, s in zip(sorted(asked), score):
        out[q] = [(int(ids[j]), round(float(s[j]), 9)) for j in np.lexsort((ids, -np.round(s, 12)))[:k]]
    return out


def frames(spark, x, asked):
    items = spark.createDataFrame([(int(i), list(map(float, v))) for i, v in x.items()], "id bigint, embedding array<double>").repartition(4).withColumn("list", F.lit(1))
    queries = spark.createDataFrame([(int(i), list(map(float, v))) for i, v in asked.items()], "query_id bigint, query array<double>")
    return items, queries


def got(rows):
    out = {}
    for r in sorted(rows.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.id, round(r.cosine, 9)))
    return out


@pytest.mark.parametrize("kind", ["clustered", "uniform"])
def test_exact_mode(spark, monkeypatch, kind):
    monkeypatch.setattr(vectorlists, "BLOCK", 16)
    monkeypatch.setattr(vectorlists, "PACK", 8)
    rng = np.random.default_rng(1)
    heart = rng.normal(size=(12, 8)) * (4 if kind == "clustered" else 0)
    x = {i: heart[rng.integers(12)] + rng.normal(size=8) * (0.3 if kind == "clustered" else 1) for i in range(900)}
    asked = {i: x[i] + 0.01 for i in range(0, 900, 20)}
    items, queries = frames(spark, x, asked)
    index = vectorlists.Lists.build(items, 20)
    assert index.blocks.agg(F.sum(F.octet_length("ids") / 8)).first()[0] == 900
    assert got(index.nearest(queries, 5)) == brute(x, asked, 5)
    read, every = index.read_share(queries, 5)
    assert every == 45 * 900 and (read < every / 4 if kind == "clustered" else read <= every)
    few, some = (vectorlists.recall(index.nearest(queries, 5, p), index.nearest(queries, 5)) for p in (3, 20))
    assert some == 1.0 and few <= some and (kind == "uniform" or few > 0.9)


def test_ties_and_vectors_without_length(spark):
    x = {1: [0, 0, 0], 2: [1, 0, 0], 3: [2, 0, 0], 4: [-1, 0, 0], 5: [0, 1, 0], -6: [1, 0, 0]}
    asked = {7: [3, 0, 0], 8: [0, 0, 0]}
    items, queries = frames(spark, x, asked)
    index = vectorlists.Lists.build(items, 2)
    assert got(index.nearest(queries, 4)) == brute(x, asked, 4)
    assert len(got(index.nearest(queries, 50))[7]) == 6
    assert not index.nearest(queries.limit(0), 3).count()
    assert not vectorlists.Lists.build(items.limit(0), 4).nearest(queries, 3).count()
