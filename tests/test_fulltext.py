"""The written full-text index against brute force: upserts, removals, merging, pruning, long texts."""

import collections
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from tessera.operators import fulltext
from tessera.scratch import shared_dir

WORDS = ["alpha", "beta", "gamma", "delta", "the", "of", "rare"]


class Brute:
    def __init__(self, texts):
        self.docs = {i: (t or "").split() for i, t in texts.items()}

    def scores(self, tokens):
        full = [w for w in self.docs.values() if w]
        n, mean = len(full), sum(map(len, full)) / max(len(full), 1)
        out = collections.defaultdict(float)
        for t in dict.fromkeys(tokens):
            df = sum(t in w for w in full)
            for i, w in self.docs.items():
                if t in w:
                    tf = w.count(t)
                    out[i] += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
        return out

    def phrase(self, words):
        found = {i: sum(w[k : k + len(words)] == words for k in range(len(w))) for i, w in self.docs.items()}
        return {i: n for i, n in found.items() if n}


def texts(rnd, ids, longest=40):
    return {i: " ".join(rnd.choices(WORDS, [5, 4, 3, 2, 9, 7, 0.2], k=rnd.randrange(longest))) for i in ids}


def frame(spark, docs):
    return spark.createDataFrame(list(docs.items()), "id bigint, text string").repartition(3)


def check(index, brute):
    for tokens in (["the"], ["rare", "the"], ["alpha", "beta", "nothing"], ["of", "of", "gamma", "rare"]):
        wanted = brute.scores(tokens)
        got = {r.id: r.score for r in index.scores(tokens).collect()}
        assert got.keys() == wanted.keys() and all(abs(got[i] - wanted[i]) < 1e-9 for i in got)
        best = [(r.id, round(r.score, 9)) for r in index.best(tokens, 7).collect()]
        assert [round(s, 6) for _, s in best] == [round(s, 6) for s in sorted(wanted.values(), reverse=True)[:7]]
    for words in (["of", "the"], ["the", "the"], ["alpha", "beta", "the"], ["rare"]):
        assert {r.id: r.n for r in index.phrase(words).collect()} == brute.phrase(words)
        any_ = sum(any(x in w for x in words) for w in brute.docs.values())
        assert tuple(index.phrase_against_words(words).first()) == (len(brute.phrase(words)), any_)
    tokens = {x for w in brute.docs.values() for x in w}
    assert {r.token for r in index.similar("beda", 1).collect()} == tokens & {"beta"}
    assert {r.token for r in index.similar("rate", 1).collect()} == tokens & {"rare"}


def test_index_through_its_life(spark, monkeypatch):
    monkeypatch.setattr(fulltext, "BLOCK", 4)
    rnd = random.Random(5)
    docs = texts(rnd, range(-5, 90)) | {200: None, 201: "", 202: "..", 203: "the"}
    docs[202] = ""
    index = fulltext.Index(spark, shared_dir(spark, "index"), 3).add(frame(spark, docs).withColumn("token", F.lit(1)))
    check(index, Brute(docs))
    docs |= texts(rnd, [3, 4, 203, 300, 301], 9) | {5: None}
    index.add(frame(spark, {i: docs[i] for i in (3, 4, 5, 203, 300, 301)}))
    for i in (10, 11, 301):
        del docs[i]
    index.remove(spark.createDataFrame([(10,), (11,), (301,), (999,)], "id bigint"))
    check(index, Brute(docs))
    merged = index.merge(shared_dir(spark, "index"))
    check(merged, Brute(docs))
    docs[10] = "rare beta the"
    check(merged.add(frame(spark, {10: docs[10]})), Brute(docs))


def test_blocks_that_cannot_win_are_not_read(spark):
    """A common word and a rare one: of the common word's blocks only those with good documents are scored."""
    rnd = random.Random(6)
    docs = {i: "the " + "x " * rnd.randrange(200, 300) for i in range(4000)} | {i: "the the rare" for i in range(100, 110)}
    index = fulltext.Index(spark, shared_dir(spark, "index")).add(frame(spark, docs))
    read, every = index.blocks_read(["the", "rare"], 10)
    assert every == 33 and read <= 3
    assert sorted(r.id for r in index.best(["the", "rare"], 10).collect()) == list(range(100, 110))


def test_files_of_other_buckets_stay_shut(spark):
    index = fulltext.Index(spark, shared_dir(spark, "index"), 8).add(frame(spark, texts(random.Random(7), range(50))))
    plan = index.blocks(["rare"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket#", "bucket#") or "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(token,rare)" in plan


def test_long_text(spark):
    index = fulltext.Index(spark, shared_dir(spark, "index")).add(frame(spark, {1: "of the " * 10_000, 2: "of " * 20_000}))
    index.phrase(["the", "of"]).collect()
    began = time.time()
    assert [tuple(r) for r in index.phrase(["of", "the"]).collect()] == [(1, 10_000)]
    assert time.time() - began < 5


def test_no_documents(spark):
    index = fulltext.Index(spark, shared_dir(spark, "index")).add(spark.createDataFrame([], "id bigint, text string"))
    assert not index.scores(["the"]).count() and not index.best(["the"], 3).count() and not index.phrase(["of", "the"]).count() and not index.similar("the").count()


@pytest.mark.parametrize("length", [[], [2, 0, 3]])
def test_running_sums(length):
    import numpy as np

    length = np.array(length, np.int64)
    steps = np.arange(1, length.sum() + 1)
    wanted = np.concatenate([np.cumsum(x) for x in np.split(steps, np.cumsum(length)[:-1])]) if len(length) else []
    assert fulltext._running(steps, length).tolist() == list(wanted)
