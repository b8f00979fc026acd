"""Reasons of links against the links that the funnel makes."""

from pyspark.sql import functions as F

from tessera.functions import conditions, terms
from tessera.operators import coverage


def test_reasons_agree_with_the_funnel(spark):
    cells = ["Breast Neoplasms", "Metastatic breast cancer", "Mammary thing", "Asthma and Fever", "acute syndrome", "zzqx", "", None, "12345", "C50.9- zzqx", "C50- Breast Neoplasms", "Asthma; zzqx", "Fever, zzqx", "Syndrome", " | ", "severe asthma (asthma)", "J99: zzqx;C501- y y y", "zzqx & severe asthma"]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "id int, conditions string")
    own = spark.createDataFrame([("breast neoplasms", "D1"), ("asthma", "D2"), ("fever", "D3"), ("syndrome", "D4")], "probe string, key string")
    alias = spark.createDataFrame([("mammary thing", "D1"), ("asthma", "D9")], "probe string, key string")
    codes = spark.createDataFrame([("C50", "I1")], "code string, key string")
    found = coverage.reasons(rows, [own, alias], codes)
    got = {r.id: coverage.REASONS[r.reason] for r in found.collect()}
    assert len(got) == len(cells)
    assert [got[i] for i in range(len(cells))] == ["name", "rewritten", "alias", "rewritten", "unmatched", "unmatched", "no text", "no text", "no terms", "code", "name", "name", "unmatched", "name", "no terms", "rewritten", "code", "part"]
    asked = rows.select("id", F.explode(terms.condition_names(F.col("conditions"))).alias("term"))
    single = asked.select("id", F.explode(conditions.parts(F.col("term"))).alias("term"))
    linked = {r.id for r in conditions.link(asked, [own, alias]).union(conditions.link(single, [own, alias])).collect()}
    assert linked == {i for i, r in got.items() if r in ("name", "alias", "rewritten", "part")}
    counts = {r.name: r.n for r in coverage.shares(found).collect()}
    assert sum(counts.values()) == len(cells) and counts["code"] == 2
    assert [tuple(r) for r in coverage.misses(rows, found).collect()] == [("Fever, zzqx", 1), ("acute syndrome", 1), ("zzqx", 1)]
    assert not coverage.reasons(rows.limit(0), [own]).count()
