"""Why rows are linked or not: the tier that linked each, or the first reason against it, as a small code that goes along."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import conditions, terms
from tessera.functions.conditions import TOO_GENERAL
from tessera.functions.text import fold

#: Codes in order: a row has the least of its terms' codes. From ``GENERAL`` on it isn't linked.
REASONS = {
    1: "name", 2: "alias", 3: "rewritten", 4: "part", 5: "code",
    6: "general",  # a rewriting met a heading that is too general to count
    7: "unmatched",  # no dictionary knows any form of its terms
    8: "no terms",  # there is text, but no term in it
    9: "no text",
}
GENERAL = 6


def reasons(rows: DataFrame, dictionaries: list[DataFrame], codes: DataFrame | None = None) -> DataFrame:
    """(id, reason) of rows (id, conditions): one row an id, with its code in ``REASONS``.

    dictionaries: (probe, key), the first one being the vocabulary itself; codes: (code, key) of a classification.
    Each distinct term is rewritten and looked up once, and its code is joined back; nothing is run again to ask why.
    """
    asked = rows.select("id", "conditions", F.explode_outer(terms.condition_names(F.col("conditions"))).alias("term"))
    distinct = asked.filter("term is not null").select("term").distinct()
    whole = distinct.select("term", F.lit(False).alias("part"), F.posexplode(conditions.variants(F.col("term"))).alias("v", "form"))
    single = distinct.select("term", F.explode(conditions.parts(F.col("term"))).alias("one")).select("term", F.lit(True), F.posexplode(conditions.variants(F.col("one"))).alias("v", "form"))
    forms = whole.union(single).withColumn("probe", fold(F.col("form")))
    known = reduce(DataFrame.unionByName, [d.select("probe", F.lit(i > 0).alias("alias")) for i, d in enumerate(dictionaries)])
    met = forms.join(known.groupBy("probe").agg(F.min("alias").alias("alias")), "probe")
    # As the funnel does: the first form that is known decides, and a general heading counts only as the term itself.
    first = met.groupBy("term", "part").agg(F.min_by(F.struct("v", "alias", "probe"), "v").alias("w")).select("term", "part", "w.*")
    code = F.when((F.col("v") > 0) & F.col("probe").isin(TOO_GENERAL), GENERAL).when(F.col("part"), 4).when(F.col("alias"), 2).when(F.col("v") == 0, 1).otherwise(3)
    told = first.groupBy("term").agg(F.min(code).alias("code"))
    own = F.when(F.trim(F.coalesce("conditions", F.lit(""))) == "", 9).when(F.col("term").isNull(), 8).otherwise(F.coalesce("code", F.lit(7)))
    out = asked.join(told, "term", "left").groupBy("id").agg(F.min(own).alias("reason"), F.first("conditions").alias("conditions"))
    if codes is None:
        return out.select("id", "reason")
    tries = out.filter(F.col("reason") >= GENERAL).select("id", F.explode(terms.condition_codes(F.col("conditions"))).alias("code")).select("id", F.explode(F.array_distinct(F.array("code", F.left("code", F.lit(3))))).alias("code"))
    by_code = tries.join(codes.select("code").distinct(), "code", "left_semi").select("id").distinct().withColumn("coded", F.lit(5))
    return out.join(by_code, "id", "left").select("id", F.coalesce("coded", "reason").alias("reason"))


def shares(found: DataFrame) -> DataFrame:
    """(reason, name, n, share): counts by reason, which add up to the rows."""
    name = F.element_at(F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair]), F.col("reason"))
    counted = found.groupBy("reason").agg(F.count("*").alias("n"))
    # One row a reason.
    total = F.broadcast(counted.agg(F.sum("n").alias("total")))
    return counted.crossJoin(total).select("reason", name.alias("name"), "n", (F.col("n") / F.col("total")).alias("share"))


def misses(rows: DataFrame, found: DataFrame, most: int = 12) -> DataFrame:
    """(term, n): the commonest terms of the rows that no dictionary knows."""
    lost = rows.join(found.filter(F.col("reason") == 7), "id", "left_semi")
    return lost.select(F.explode(terms.condition_names(F.col("conditions"))).alias("term")).groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(most)
