"""The bound on the keys of a wide table."""

import pytest

from tessera.operators import transforms


def test_wide_raises_beyond_its_keys(spark):
    pairs = lambda n: spark.range(n).selectExpr("1 AS r", "concat('k', lpad(id, 5, '0')) AS k", "'v' AS v")
    with pytest.raises(ValueError):
        transforms.wide(pairs(10_001), "r", "k", "v", [])


def test_wide_keeps_all_keys_up_to_its_bound(spark, monkeypatch):
    monkeypatch.setattr(transforms, "MOST_KEYS", 3)
    pairs = spark.range(3).selectExpr("1 AS r", "concat('k', id) AS k", "'v' AS v")
    assert transforms.wide(pairs, "r", "k", "v", ["k2"]).columns == ["r", "k2", "k0", "k1"]
