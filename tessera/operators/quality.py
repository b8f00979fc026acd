"""Checks and audits of the linked data and of any table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import PLACEHOLDERS, fold


def dangling(edges: DataFrame, nodes: DataFrame, ends: tuple[str, ...] = ("src", "dst"), key: str = "key") -> DataFrame:
    """(end, namespace, n): endpoints that no node has, by the prefix of their keys."""
    out = None
    for end in ends:
        lost = edges.join(nodes.select(F.col(key).alias(end)), end, "left_anti").groupBy(F.lit(end).alias("end"), F.substring_index(end, ":", 1).alias("namespace")).agg(F.count("*").alias("n"))
        out = lost if out is None else out.unionAll(lost)
    return out


def shared_keys(tables: dict[str, DataFrame], key: str = "key") -> DataFrame:
    """(key, labels): keys that stand in two tables or more."""
    every = None
    for label, t in tables.items():
        one = t.select(F.col(key), F.lit(label).alias("label")).distinct()
        every = one if every is None else every.unionAll(one)
    return every.groupBy(key).agg(F.array_sort(F.collect_set("label")).alias("labels")).filter(F.size("labels") > 1)


def duplicate_pairs(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(n_pairs, worst): pairs that stand twice or more, and the highest count."""
    return edges.groupBy(src, dst).count().filter("count > 1").agg(F.count("*").alias("n_pairs"), F.coalesce(F.max("count"), F.lit(0)).alias("worst"))


def same_names(nodes: DataFrame, name: str, key: str, top: int = 5) -> DataFrame:
    """(folded, n, sample): names that several keys have, with three keys each."""
    named = nodes.groupBy(F.lower(F.trim(F.col(name))).alias("folded")).agg(F.countDistinct(key).alias("n"), F.slice(F.array_sort(F.collect_set(key)), 1, 3).alias("sample"))
    return named.filter("n > 1").orderBy(F.desc("n"), "folded").limit(top)


def spelling_variants(rows: DataFrame, value: str) -> DataFrame:
    """(form, spellings): values that differ in writing alone."""
    return rows.select(fold(F.col(value)).alias("form"), F.col(value).alias("v")).distinct().groupBy("form").agg(F.array_sort(F.collect_set("v")).alias("spellings")).filter(F.size("spellings") > 1)


def shares(rows: DataFrame, by: str) -> DataFrame:
    """(value, n, percent) of a column."""
    counted = rows.groupBy(by).agg(F.count("*").alias("n"))
    return counted.join(F.broadcast(counted.agg(F.sum("n").alias("total")))).select(by, "n", F.round(100.0 * F.col("n") / F.col("total"), 4).alias("percent"))


def fan_out(edges: DataFrame, src: str, top: int = 6) -> DataFrame:
    """(src, n): the sources with most edges."""
    return edges.groupBy(src).agg(F.count("*").alias("n")).orderBy(F.desc("n"), src).limit(top)


def isolated(nodes: DataFrame, key: str, *ends: DataFrame) -> DataFrame:
    """Nodes whose key is at no edge's end; each of ``ends`` has one column."""
    for e in ends:
        nodes = nodes.join(e.toDF(key), key, "left_anti")
    return nodes


def profile(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, filled, distinct_values, placeholders, padded, numeric) in one pass."""
    long = rows.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    text = F.coalesce("value", F.lit(""))
    count = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    return long.groupBy("column").agg(F.count("*").alias("n"), count(text != "").alias("filled"), F.countDistinct("value").alias("distinct_values"), count(F.lower(F.trim(text)).isin(PLACEHOLDERS)).alias("placeholders"), count(text != F.trim(text)).alias("padded"), count(F.trim(text).try_cast("double").isNotNull()).alias("numeric"))


def findings(profiled: DataFrame) -> DataFrame:
    """(column, finding): what a profile shows to be wrong."""
    rules = [("EMPTY", "filled = 0"), ("SPARSE", "filled > 0 and filled < 0.05 * n"), ("PLACEHOLDER", "placeholders > 0"), ("WHITESPACE", "padded > 0"), ("NUMERIC", "filled > 0 and numeric = filled")]
    return profiled.select("column", F.explode(F.filter(F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in rules]), lambda x: x.isNotNull())).alias("finding"))


def bad_keys(nodes: DataFrame, key: str = "key", form: str = r"^[A-Z][A-Z0-9_-]*:\S.*$") -> DataFrame:
    return nodes.filter(~F.col(key).rlike(form))


def loops(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    return edges.filter(F.col(src) == F.col(dst))


def missing(expected: DataFrame, actual: DataFrame, on: list[str]) -> DataFrame:
    """Expected rows that are not there: fixtures, declared sources, manifests."""
    return expected.join(actual, on, "left_anti")


class Refused(Exception):
    """A check failed, so nothing may be published."""


def gate(checks: dict[str, DataFrame]) -> None:
    """Raises if any check has a row."""
    failed = [name for name, rows in checks.items() if not rows.isEmpty()]
    if failed:
        raise Refused(", ".join(failed))
