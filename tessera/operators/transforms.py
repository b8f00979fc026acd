"""Tabular transforms of acquired files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cases(rows: DataFrame, case: str, key: str, parts: str, flags: dict[str, Column], least: int = 3) -> DataFrame:
    """(key, part, n, flag sums): pairs inside a case, each counted once, from a floor up."""
    once = rows.groupBy(case, key, parts).agg(*[F.max(c.cast("int")).alias(n) for n, c in flags.items()])
    return once.groupBy(key, parts).agg(F.count("*").alias("n"), *[F.sum(n).alias(n) for n in flags]).filter(F.col("n") >= least)


def suspects(drugs: Column, roles: Column, wanted: str = "1", separator: str = ";") -> Column:
    """The parts of a packed list whose role, in a parallel list, is the wanted one; all if the lists do not match."""
    d, r = F.split(drugs, separator), F.split(roles, separator)
    picked = F.transform(F.filter(F.arrays_zip(d.alias("d"), r.alias("r")), lambda z: F.trim(z["r"]) == wanted), lambda z: F.trim(z["d"]))
    return F.filter(F.when(F.size(d) == F.size(r), picked).otherwise(F.transform(d, lambda x: F.trim(x))), lambda x: x != "")


def cross_inside(rows: DataFrame, left: str, right: str) -> DataFrame:
    """One row for each pair of a row's two lists."""
    return rows.withColumn(left, F.explode(left)).withColumn(right, F.explode(right))


def pivot_last(rows: DataFrame, by: str, name: str, value: str, order: str, names: list[str]) -> DataFrame:
    """A column for each name, with its last value; empty if it has none."""
    return rows.groupBy(by).pivot(name, names).agg(F.max_by(value, order)).na.fill("", names)


def with_list(rows: DataFrame, detail: DataFrame, on: list[str], value: str, name: str, separator: str = "; ") -> DataFrame:
    """Rows with how many details they have, and their values in one cell."""
    packed = detail.groupBy(*on).agg(F.count("*").alias(f"n_{name}"), F.array_join(F.array_sort(F.collect_set(value)), separator).alias(name))
    return rows.join(packed, on, "left").withColumn(f"n_{name}", F.coalesce(f"n_{name}", F.lit(0))).withColumn(name, F.coalesce(name, F.lit("")))


def facets(rows: DataFrame, columns: list[str], top: int = 1000) -> DataFrame:
    """(facet, value, n): counts of several columns."""
    out = None
    for c in columns:
        one = rows.groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(top).select(F.lit(c).alias("facet"), "value", "n")
        out = one if out is None else out.unionAll(one)
    return out


def from_inverted_index(index: Column) -> Column:
    """Text from a map of words to their positions."""
    placed = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.array_join(F.transform(F.array_sort(placed), lambda x: x["w"]), " ")


def flatten(rows: DataFrame, separator: str = " | ", prefix: str = "") -> DataFrame:
    """Nested rows as flat text columns: structs by their path, lists packed in a cell."""
    out = []

    def walk(c: Column, kind, name: str) -> None:
        if kind.typeName() == "struct":
            for f in kind.fields:
                walk(c[f.name], f.dataType, f"{name}_{f.name}" if name else f.name)
        elif kind.typeName() == "array":
            inner = kind.elementType.typeName()
            out.append(F.array_join(F.transform(c, lambda x: F.to_json(x) if inner in ("struct", "array", "map") else x.cast("string")), separator).alias(name))
        else:
            out.append(c.cast("string").alias(name))

    for f in rows.schema.fields:
        walk(F.col(f"`{f.name}`"), f.dataType, prefix + f.name)
    return rows.select(*out)


#: Keys at most of a wide table; beyond it, ``wide`` raises.
MOST_KEYS = 10_000


def wide(pairs: DataFrame, by: str, name: str, value: str, first: list[str]) -> DataFrame:
    """Key-value rows as a wide table of all keys, the named columns first, others in order."""
    names = [r[0] for r in pairs.select(name).distinct().orderBy(name).limit(MOST_KEYS + 1).collect()]
    if len(names) > MOST_KEYS:
        raise ValueError("too many keys for a wide table")
    order = [c for c in first if c in names] + [c for c in names if c not in first]
    return pairs.groupBy(by).pivot(name, order).agg(F.first(value)).na.fill("", order)


def strict_boolean(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low.isin("y", "yes", "true", "1"), F.lit(True)).when(low.isin("n", "no", "false", "0"), F.lit(False))


def none_to_empty(c: Column) -> Column:
    return F.when(F.lower(F.trim(F.coalesce(c, F.lit("")))).isin("none", "nan", "null", ""), "").otherwise(F.trim(c))


def linked_documents(rows: DataFrame, columns: list[str], origin: str) -> DataFrame:
    """(url, origin, column): links to documents in any column, the first place of each."""
    long = rows.select(F.col(origin).alias("origin"), *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(["origin"], columns, "column", "value")
    urls = long.select("origin", "column", F.explode(F.regexp_extract_all(F.coalesce("value", F.lit("")), F.lit(r"(https?://[^\s\"'<>]+)"), 1)).alias("url"))
    return urls.filter(F.lower("url").rlike(r"\.(pdf|docx?|pptx?|xlsx?)([?#].*)?$")).groupBy("url").agg(F.min(F.struct("origin", "column")).alias("w")).select("url", "w.origin", "w.column")
