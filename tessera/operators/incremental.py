"""What changed, and keyed replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changes(listed: DataFrame, known: DataFrame, key: str, tag: str) -> DataFrame:
    """(key, change): added, changed (tag differs or is empty), same, removed."""
    both = listed.select(key, F.col(tag).alias("new"), F.lit(True).alias("there")).join(known.select(key, F.col(tag).alias("old"), F.lit(True).alias("held")), key, "full_outer")
    change = F.when(F.col("held").isNull(), "added").when(F.col("there").isNull(), "removed").when((F.coalesce("new", F.lit("")) == "") | ~F.col("new").eqNullSafe(F.col("old")), "changed").otherwise("same")
    return both.select(key, change.alias("change"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The old rows less those of new keys, and the new rows."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def delete(old: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return old.join(gone.select(*keys).distinct(), keys, "left_anti")


def verify(expected: DataFrame, actual: DataFrame, key: str, size: str) -> DataFrame:
    """(key, problem): missing or of another size."""
    both = expected.select(key, F.col(size).alias("want")).join(actual.select(key, F.col(size).alias("have"), F.lit(True).alias("there")), key, "left")
    return both.select(key, F.when(F.col("there").isNull(), "missing").when(~F.col("want").eqNullSafe(F.col("have")), "size").alias("problem")).filter("problem is not null")


def complete_enough(staged: DataFrame, live: DataFrame, size: str, ratio: float = 0.5) -> bool:
    """Whether a staged run may replace the live one: not under half its bytes, nor under half its files and smaller."""
    s, v = (x.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first() for x in (staged, live))
    return not (s[1] < ratio * v[1] or s[0] < ratio * v[0] and s[1] < v[1])


def keep_latest(runs: DataFrame, by: str, order: str, n: int = 1) -> DataFrame:
    """The last n rows of each group."""
    from pyspark.sql import Window

    return runs.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(F.desc(order)))).filter(F.col("_r") <= n).drop("_r")
