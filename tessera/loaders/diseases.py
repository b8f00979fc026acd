"""Diseases, their hierarchies and crosswalks, indications and associations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.functions.conditions import TOO_GENERAL
from tessera.loaders.build import Build
from tessera.operators import hierarchy


#: Chapters of the ICD that hold no conditions.
NO_CONDITIONS = ["X", "V"]


def mesh(b: Build) -> None:
    """Descriptors of the disease trees; each tree number's parent is the number less its last part.

    The names of all descriptors are kept as a veto for aliases, and the keys of headings that
    are a bare category word, which nothing may be linked to loosely.
    """
    every = b.rows("mesh", "descriptor_ui", "name", "tree_numbers", "synonyms").filter("descriptor_ui <> '' and name <> ''")
    b.keep("mesh_any", every.select(text.fold(F.col("name")).alias("probe")).distinct())
    trees = text.parts(F.col("tree_numbers"), ";")
    r = every.withColumn("trees", trees).filter(F.exists("trees", lambda t: t.startswith("C") | t.startswith("F03"))).withColumn("key", F.concat(F.lit("MESH:"), "descriptor_ui"))
    names = F.filter(text.parts(F.col("synonyms"), ";"), lambda x: F.length(x) >= 2)
    b.add("Disease", r, "mesh", key="key", name="name", synonyms=F.array_join(F.slice(names, 1, 30), "|"), vocabulary=F.lit("MeSH"), tree_numbers="tree_numbers")
    b.identify(r, "mesh", "key", "MESH", "descriptor_ui")
    b.propose(hierarchy.tree_parents(r.select("key", F.explode("trees").alias("number"))), "mesh")
    b.keep("mesh_general", r.filter(text.fold(F.col("name")).isin(TOO_GENERAL)).select("key"))
    probes = r.select("key", F.lit(0).alias("o"), text.fold(F.col("name")).alias("probe")).union(r.select("key", F.lit(1), F.explode(F.filter(F.transform(names, text.fold), lambda x: F.length(x) >= 4))))
    b.keep("mesh", probes.filter("probe <> ''").groupBy("probe").agg(F.min_by("key", F.struct("o", "key")).alias("key")))


def _joined_mesh(b: Build, rows: DataFrame, own: Column) -> DataFrame:
    """Rows with ``key``: the MeSH disease of their title, where it has that very name, else their own."""
    known = b.dictionaries["mesh"].select("probe", F.col("key").alias("mesh_key"))
    return rows.withColumn("own", own).withColumn("probe", text.fold(F.col("title"))).join(known, "probe", "left").withColumn("key", F.coalesce("mesh_key", "own"))


def _foreign(b: Build, rows: DataFrame) -> None:
    """Titles of what MeSH doesn't name: links across vocabularies are looked for later."""
    b.foreign.append(rows.filter("mesh_key is null").select("key", "title"))


def icd10(b: Build) -> None:
    """Chapters, blocks and codes. A code lies below its parent code, else its block; one that MeSH names is the MeSH disease."""
    parts = []
    if b.has("icd10_chapters"):
        c = b.rows("icd10_chapters", "chapter_id", "title").filter("chapter_id <> '' and title <> ''").filter(~F.upper("chapter_id").isin(NO_CONDITIONS))
        parts.append(c.select("title", F.concat(F.lit("ICD10:"), "chapter_id").alias("key"), F.lit("").alias("up")))
    if b.has("icd10_blocks"):
        c = b.rows("icd10_blocks", "block_id", "title", "chapter_id").filter("block_id <> '' and title <> ''").filter(~F.upper("chapter_id").isin(NO_CONDITIONS))
        parts.append(c.select("title", F.concat(F.lit("ICD10:"), "block_id").alias("key"), F.when(F.col("chapter_id") != "", F.concat(F.lit("ICD10:"), "chapter_id")).otherwise("").alias("up")))
    for rows in parts:
        b.add("Disease", rows, "icd10", key="key", name="title", vocabulary=F.lit("ICD-10"))
    r = b.rows("icd10_codes", "code", "title", "parent_code", "block_id").filter("code <> '' and title <> ''").filter(~F.upper(F.left("code", F.lit(1))).isin(NO_CONDITIONS))
    r = _joined_mesh(b, r, F.concat(F.lit("ICD10:"), "code"))
    own = r.filter("mesh_key is null")
    b.add("Disease", own, "icd10", key="key", name="title", vocabulary=F.lit("ICD-10"))
    b.identify(r, "icd10", "key", "ICD10", "code")
    _foreign(b, r)
    # A parent is what its code became, or a block or chapter that is there.
    levels = [rows.select(F.col("key").alias("up"), F.col("key").alias("parent")) for rows in parts]
    above = r.select(F.concat(F.lit("ICD10:"), "code").alias("up"), F.col("key").alias("parent"))
    for rows in levels:
        above = above.unionByName(rows)
    child = r.select(F.col("key").alias("child"), F.concat(F.lit("ICD10:"), text.first_filled(F.col("parent_code"), F.col("block_id"))).alias("up"))
    for rows in parts:
        child = child.unionByName(rows.select(F.col("key").alias("child"), "up"))
    b.propose(child.join(above.dropDuplicates(["up"]), "up").select("child", "parent"), "icd10")
    b.keep("icd", r.select("code", "key").dropDuplicates(["code"]))
    b.keep("disease_alias", own.filter(text.names_condition(F.col("title"))).select("probe", "key").filter("probe <> ''").groupBy("probe").agg(F.min("key").alias("key")))


def icd11(b: Build) -> None:
    """Entities by their code, blocks and chapters by their number; the parent is what its address became."""
    r = b.rows("icd11", "foundation_uri", "title", "code", "parent", "class_kind", "block_id", "chapter_no").filter("title <> ''")
    r = r.filter(~F.upper("chapter_no").isin(NO_CONDITIONS) & ~F.upper(F.left("code", F.lit(1))).isin(NO_CONDITIONS)).withColumn("title", F.regexp_replace("title", r"^[- ]+", ""))
    kind = F.lower("class_kind")
    own = F.when(F.col("code") != "", F.col("code")).when((kind == "block") & (F.col("block_id") != ""), F.col("block_id")).when((kind == "chapter") & (F.col("chapter_no") != ""), F.concat(F.lit("CH"), F.upper("chapter_no")))
    r = _joined_mesh(b, r, F.concat(F.lit("ICD11:"), own)).filter("own is not null")
    b.add("Disease", r.filter("mesh_key is null"), "icd11", key="key", name="title", vocabulary=F.lit("ICD-11"))
    b.identify(r.filter("code <> ''"), "icd11", "key", "ICD11", "code")
    _foreign(b, r)
    above = r.filter("foundation_uri <> ''").groupBy(F.col("foundation_uri").alias("parent")).agg(F.min("key").alias("up"))
    b.propose(r.join(above, "parent").select(F.col("key").alias("child"), F.col("up").alias("parent")), "icd11")


def indications(b: Build) -> None:
    """A disease by its MeSH id, else by its name, else as its own; with the highest phase."""
    r = b.rows("indications", "molregno", "efo_id", "efo_term", "mesh_id", "mesh_heading", "max_phase_for_ind").join(b.dictionaries["molregno"], "molregno")
    known = b.dictionaries["mesh"].select(F.col("probe"), F.col("key").alias("by_name"))
    own = text.vocabulary_key(F.col("efo_id"))
    r = r.withColumn("probe", text.fold(F.col("efo_term"))).join(known, "probe", "left")
    mesh_key = F.when(F.col("mesh_id") != "", F.concat(F.lit("MESH:"), "mesh_id"))
    r = r.withColumn("disease", F.coalesce(mesh_key, "by_name", F.nullif(own, F.lit(""))))
    tier = F.when(mesh_key.isNotNull(), "crosswalk").when(F.col("by_name").isNotNull(), "name").otherwise("own")
    r = r.filter("disease is not null").withColumn("match_method", tier)
    # The only rows where ids of two vocabularies stand side by side.
    b.keep("efo_mesh", r.filter((own != "") & mesh_key.isNotNull()).groupBy(own.alias("efo")).agg(F.min(mesh_key).alias("key")))
    b.add("Disease", r, "chembl", key="disease", name=text.first_filled(F.col("mesh_heading"), F.col("efo_term")), vocabulary=F.substring_index("disease", ":", 1))
    best = r.groupBy("substance", "disease").agg(F.max(F.struct(F.col("max_phase_for_ind").try_cast("double").alias("p"), F.col("max_phase_for_ind").alias("max_phase"), "match_method")).alias("w"))
    b.add("INDICATED_FOR", best.select("substance", "disease", "w.max_phase", "w.match_method"), "chembl", src="substance", dst="disease", match_method="match_method", max_phase="max_phase")


def associations(b: Build) -> None:
    """The best score of each target and disease, with a total order on ties."""
    genes = b.rows("hgnc", "symbol", "ensembl_gene_id").join(b.dictionaries["symbol"], "symbol").select(F.col("ensembl_gene_id").alias("target_id"), "target").dropDuplicates(["target_id"])
    r = b.rows("ot_assoc", "target_id", "disease_id", "disease_name", "overall_score").join(genes, "target_id").withColumn("efo", text.vocabulary_key(F.col("disease_id")))
    # The crosswalk of the indications decides where it knows the id.
    r = (r.join(b.dictionaries["efo_mesh"], "efo", "left") if "efo_mesh" in b.dictionaries else r.withColumn("key", F.lit(None).cast("string"))).withColumn("disease", F.coalesce("key", "efo")).withColumn("score", F.col("overall_score").try_cast("double"))
    best = r.filter("score is not null").groupBy("target", "disease").agg(F.max(F.struct("score", "disease_name")).alias("w")).select("target", "disease", "w.score", "w.disease_name")
    b.add("Disease", best, "opentargets", key="disease", name="disease_name", vocabulary=F.substring_index("disease", ":", 1))
    b.add("ASSOCIATED_WITH", best, "opentargets", src="target", dst="disease", match_method=F.lit("structured"), score=F.format_string("%.4f", "score"))


LOADERS = [mesh, icd11, icd10, indications]
