"""Entity resolution by tiers: exact, salt, stereo, alias, provisional.

The dictionary is one long table (tier, probe, id, method), unique on (tier, probe);
a name makes at most four probes, joined at once; the lowest tier wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text

TIERS = ("exact", "salt", "stereo", "alias")


def dictionary(names: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(tier, probe, id, method) from names (name, id, ord) and aliases (name, id, method, ord).

    The first in order wins. A stereo form is withdrawn if two ids reduce to it, or if a
    looser strip of a name meets the exact name of another id. Aliases never shadow an
    exact name.
    """
    usable = names.filter(text.usable_name(F.col("name")) & (F.coalesce(F.col("id"), F.lit("")) != ""))
    usable = usable.select("id", "ord", text.fold(F.col("name")).alias("e"), text.strip_salts(F.col("name")).alias("s"), text.strip_stereo(F.col("name")).alias("t"), text.strip_stereo_joined(F.col("name")).alias("j"))
    first = lambda probe: usable.groupBy(F.col(probe).alias("probe")).agg(F.min_by("id", F.struct("ord", "id")).alias("id"))
    exact = first("e")
    reduced = usable.filter("t <> e").groupBy(F.col("t").alias("probe")).agg(F.min("id").alias("id"), F.max("id").alias("other")).filter("id = other").select("probe", "id")
    owners = exact.select("probe", F.col("id").alias("owner"))
    joined = usable.filter("j <> e").join(owners, F.col("j") == F.col("probe")).filter("id <> owner").select("probe").distinct()
    taken = reduced.join(owners, "probe", "left").filter("owner is null or owner = id").select("probe", "id")
    stereo = taken.join(joined, "probe", "left_anti")
    tiers = exact.select(F.lit(0).alias("tier"), "probe", "id", F.lit("unii").alias("method"))
    tiers = tiers.unionAll(first("s").select(F.lit(1), "probe", "id", F.lit("salt"))).unionAll(stereo.select(F.lit(2), "probe", "id", F.lit("stereo")))
    if aliases is not None:
        own = aliases.filter(text.usable_name(F.col("name"))).select(text.fold(F.col("name")).alias("probe"), "id", "method", "ord").join(exact.select("probe"), "probe", "left_anti")
        won = own.groupBy("probe").agg(F.min_by(F.struct("id", "method"), F.struct("ord", "id", "method")).alias("w"))
        tiers = tiers.unionAll(won.select(F.lit(3), "probe", "w.id", "w.method"))
    return tiers


def collisions(names: DataFrame) -> DataFrame:
    """(probe, id): ids that came to an exact name too late."""
    folded = names.filter(text.usable_name(F.col("name"))).select("id", "ord", text.fold(F.col("name")).alias("probe"))
    won = folded.groupBy("probe").agg(F.min_by("id", F.struct("ord", "id")).alias("winner"))
    return folded.join(won, "probe").filter("id <> winner").select("probe", "id").distinct()


def resolve(queries: DataFrame, entries: DataFrame, name: str = "name", key: str = "key", method: str = "method") -> DataFrame:
    """The queries with a key and the method that found it; an unknown name is its own provisional key, an empty one has none."""
    q = F.col(name)
    probes = F.array(*[F.struct(F.lit(i).alias("tier"), p.alias("probe")) for i, p in enumerate((text.fold(q), text.strip_salts(q), text.strip_stereo(q), text.fold(q)))])
    distinct = queries.select(name).distinct()
    probed = distinct.select(name, F.explode(probes).alias("p")).select(name, "p.*").filter("probe <> ''")
    won = probed.join(entries, ["tier", "probe"]).groupBy(name).agg(F.min_by(F.struct("id", "method"), F.col("tier")).alias("w"))
    folded = text.fold(q)
    found = distinct.join(won, name, "left").select(name, F.when(folded == "", "").otherwise(F.coalesce("w.id", F.concat(F.lit("NAME:"), folded))).alias(key), F.coalesce("w.method", F.lit("provisional")).alias(method))
    return queries.join(found, queries[name].eqNullSafe(found[name])).drop(found[name])


def bridge(concepts: DataFrame, entries: DataFrame, veto: DataFrame | None = None, least: int = 0) -> DataFrame:
    """Aliases (name, id) of concepts (concept, pos, name): if any name is known, the others are too.

    The first known name in order decides; vetoed names, and those of under ``least`` characters, make no alias.
    """
    folded = concepts.select("concept", "pos", text.fold(F.col("name")).alias("probe")).filter("probe <> ''")
    hit = folded.join(entries.select("probe", "id").groupBy("probe").agg(F.min("id").alias("id")), "probe").groupBy("concept").agg(F.min_by("id", F.struct("pos", "id")).alias("id"))
    out = folded.filter(F.length("probe") >= least).join(hit, "concept").join(entries.select("probe").distinct(), "probe", "left_anti")
    if veto is not None:
        out = out.join(veto.select("probe").distinct(), "probe", "left_anti")
    return out.groupBy("probe").agg(F.min_by("id", F.struct("concept", "pos")).alias("id")).withColumnRenamed("probe", "name")


def stand_ins(names: DataFrame, entries: DataFrame) -> DataFrame:
    """Aliases (name, id, method) of names (method, name, pos, target) that the dictionary lacks.

    A name stands for the first of its targets that is known; a name that is known
    itself makes none, and neither does one without a known target.
    """
    known = resolve(names, entries, "target", "id", "how").filter("how <> 'provisional' and id <> ''")
    lacks = resolve(names.select("name").distinct(), entries, "name", "own", "how").filter("how = 'provisional'").select("name")
    first = known.groupBy("method", "name").agg(F.min_by("id", F.struct("pos", "id")).alias("id"))
    return first.join(lacks, "name", "left_semi").select("name", "id", "method")


def poisoned(squashed: DataFrame) -> DataFrame:
    """(k, id) with the ids of keys (k, id, ord) that mean two things left empty."""
    return squashed.groupBy("k").agg(F.when(F.min("id") != F.max("id"), F.lit("")).otherwise(F.min("id")).alias("id"))


def with_parent(rows: DataFrame, key: str, parents: DataFrame) -> DataFrame:
    """Rows of each key and, one hop up, of its parent (child, parent)."""
    up = rows.join(parents.withColumnRenamed("child", key), key, "left")
    return up.withColumn(key, F.explode(F.array_compact(F.array(F.col(key), F.col("parent"))))).drop("parent").distinct()
