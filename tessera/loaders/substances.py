"""Substances, targets, mechanisms, classes and their identifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import shorthand, text
from tessera.loaders.build import Build, folded_key
from tessera.operators import resolve
from tessera.scratch import written


def atc(b: Build) -> None:
    """Classes and their parents."""
    r = b.rows("atc_classes", "name", "level", "atc_code", "parent_code").filter("atc_code <> ''").withColumn("key", F.concat(F.lit("ATC:"), "atc_code"))
    b.add("DrugClass", r, "atc", key="key", atc_code="atc_code", name="name", level="level", vocabulary=F.lit("ATC"))
    b.add("IN_CLASS", r.filter("parent_code <> ''"), "atc", src="key", dst=F.concat(F.lit("ATC:"), "parent_code"), match_method=F.lit("structured"))


def gsrs(b: Build) -> None:
    """The spine: all preferred names before any synonym."""
    r = b.rows("gsrs", "unii", "preferred_name", "synonyms", "substance_class", "status", "cas_number").filter("unii <> '' and preferred_name <> ''").withColumn("key", F.concat(F.lit("UNII:"), "unii"))
    names = text.split_synonyms(F.col("synonyms"))
    b.add("Substance", r, "gsrs", key="key", name="preferred_name", norm_name=text.fold(F.col("preferred_name")), synonyms=F.array_join(F.slice(names, 1, 30), "|"), substance_class="substance_class", status="status", resolved_by=F.lit("unii"))
    b.identify(r, "gsrs", "key", "UNII", "unii")
    b.identify(r, "gsrs", "key", "CAS", "cas_number")
    b.names += [r.select(F.col("preferred_name").alias("name"), F.col("key").alias("id")), r.select(F.explode(names).alias("name"), F.col("key").alias("id"))]


def molecules(b: Build) -> None:
    """Molecules join a substance by name where a real tier says so; else they are their own."""
    r = b.rows("molecules", "molregno", "chembl_id", "pref_name", "max_phase", "molecule_type").filter("chembl_id <> ''")
    found = b.resolve(r.filter("pref_name <> ''"), "pref_name").select("chembl_id", "substance", "match_method")
    own = F.concat(F.lit("CHEMBL:"), "chembl_id")
    r = r.join(found, "chembl_id", "left").withColumn("key", F.coalesce("substance", own)).withColumn("max_phase", F.when(F.col("max_phase").startswith("-1"), "").otherwise(F.col("max_phase")))
    b.add("Substance", r, "chembl", key="key", name="pref_name", norm_name=text.fold(F.col("pref_name")), substance_class="molecule_type", max_phase="max_phase", resolved_by=F.coalesce("match_method", F.lit("chembl")))
    b.identify(r, "chembl", "key", "CHEMBL_ID", "chembl_id")
    kinds = r.filter("molecule_type <> ''").filter(~text.is_placeholder(F.col("molecule_type")))
    b.add("Modality", kinds, "chembl", key=folded_key("MODALITY:", "molecule_type"), name="molecule_type")
    b.add("HAS_MODALITY", kinds, "chembl", src="key", dst=folded_key("MODALITY:", "molecule_type"), match_method=F.lit("structured"))
    b.keep("molregno", r.select("molregno", F.col("key").alias("substance")).dropDuplicates(["molregno"]))
    b.keep("chembl", r.select(F.col("chembl_id").alias("drug_id"), F.col("key").alias("substance")).dropDuplicates(["drug_id"]))


def molecule_synonyms(b: Build) -> None:
    r = b.rows("synonyms", "molregno", "synonyms").join(b.dictionaries["molregno"], "molregno")
    b.aliases.append(r.select(F.col("synonyms").alias("name"), F.col("substance").alias("id"), F.lit("chembl_synonym").alias("method")))


def structures(b: Build) -> None:
    r = b.rows("structures", "molregno", "standard_inchi_key").join(b.dictionaries["molregno"], "molregno")
    b.identify(r, "chembl", "substance", "INCHIKEY", "standard_inchi_key")


def salts(b: Build) -> None:
    """One hop from a salt to its parent; never chained."""
    h = b.rows("hierarchy", "molregno", "parent_molregno")
    m = b.dictionaries["molregno"]
    pairs = h.join(m.withColumnRenamed("substance", "child"), "molregno").join(m.toDF("parent_molregno", "parent"), "parent_molregno").filter("child <> parent").select("child", "parent").distinct()
    b.add("IS_SALT_OF", pairs, "chembl", src="child", dst="parent", match_method=F.lit("structured"))
    b.keep("salt_parent", pairs)


def atc_substances(b: Build) -> None:
    r = b.resolve(b.rows("atc_subs", "atc_code", "name", "parent_code").filter("atc_code <> ''"), "name")
    b.add("IN_CLASS", r.filter("parent_code <> ''"), "atc", src="substance", dst=F.concat(F.lit("ATC:"), "parent_code"), match_method="match_method")
    b.identify(r, "atc", "substance", "ATC", "atc_code")


def rxnorm(b: Build) -> None:
    r = b.rows("rxnorm", "ingredient_rxcui", "rxcui", "ingredient_name", "name")
    r = r.select(text.first_filled(F.col("ingredient_rxcui"), F.col("rxcui")).alias("rxcui"), text.first_filled(F.col("ingredient_name"), F.col("name")).alias("name"))
    b.identify(b.resolve(r, "name"), "rxnorm", "substance", "RXCUI", "rxcui")


def dailymed(b: Build) -> None:
    r = b.rows("dailymed", "setid", "rxstring").withColumn("name", F.regexp_replace("rxstring", r"\s+\d.*", ""))
    b.identify(b.resolve(r, "name"), "dailymed", "substance", "SPL_SETID", "setid")


def targets(b: Build) -> None:
    """Targets by accession where one is mapped; the first mapping wins."""
    u = b.rows("uniprot_map", "chembl_target_id", "uniprot_accession").filter("uniprot_accession <> ''").groupBy("chembl_target_id").agg(F.min("uniprot_accession").alias("accession"))
    genes = None
    if b.has("hgnc"):
        genes = b.rows("hgnc", "symbol", "uniprot_ids").select("symbol", F.explode(text.parts(F.regexp_replace("uniprot_ids", '"', ""), r"\|")).alias("accession")).groupBy("accession").agg(F.min("symbol").alias("symbol"))
    t = b.rows("targets", "tid", "chembl_id", "pref_name", "organism", "target_type").filter("chembl_id <> ''").join(u, F.col("chembl_id") == F.col("chembl_target_id"), "left")
    t = t.join(genes, "accession", "left") if genes is not None else t.withColumn("symbol", F.lit(""))
    t = t.withColumn("key", F.coalesce(F.concat(F.lit("UNIPROT:"), "accession"), F.concat(F.lit("CHEMBL_TARGET:"), "chembl_id")))
    b.add("Target", t, "chembl", key="key", symbol="symbol", name="pref_name", organism="organism", target_type="target_type")
    b.identify(t.filter("accession is not null"), "chembl", "key", "UNIPROT", "accession")
    b.keep("tid", t.select("tid", F.col("key").alias("target")).dropDuplicates(["tid"]))
    b.keep("symbol", t.filter("coalesce(symbol, '') <> ''").groupBy("symbol").agg(F.min("key").alias("target")))


def mechanisms(b: Build) -> None:
    m = b.rows("mechanisms", "molregno", "tid", "mechanism_of_action", "action_type").join(b.dictionaries["molregno"], "molregno")
    named = m.filter("mechanism_of_action <> ''").withColumn("key", folded_key("MECH:", "mechanism_of_action"))
    b.add("Mechanism", named, "chembl", key="key", name="mechanism_of_action", action_type="action_type")
    b.add("HAS_MECHANISM", named, "chembl", src="substance", dst="key", match_method=F.lit("structured"))
    b.add("TARGETS", m.join(b.dictionaries["tid"], "tid"), "chembl", src="substance", dst="target", match_method=F.lit("structured"))


def mesh_actions(b: Build) -> None:
    r = b.rows("mesh_actions", "action_descriptor_ui", "action_name", "substance_name").filter("action_descriptor_ui <> ''").withColumn("key", F.concat(F.lit("MESHPA:"), "action_descriptor_ui"))
    b.add("DrugClass", r, "mesh", key="key", name="action_name", vocabulary=F.lit("MeSH"))
    b.add("IN_CLASS", b.resolve(r, "substance_name"), "mesh", src="substance", dst="key", match_method="match_method")


def stand_ins(b: Build) -> None:
    """Spellings of two committees, abbreviations and regimens as names of what the dictionary holds."""
    entries = b.substances()
    b.aliases.append(written(resolve.stand_ins(shorthand.table(entries.sparkSession), entries), "stand_ins"))


def variants(b: Build) -> None:
    """Significant variants in known targets, and the diseases that they name."""
    v = b.rows("clinvar", "VariationID", "Type", "Name", "GeneSymbol", "ClinicalSignificance", "PhenotypeIDS", "PhenotypeList").join(b.dictionaries["symbol"], F.col("GeneSymbol") == F.col("symbol"))
    v = v.filter(F.lower("ClinicalSignificance").rlike("pathogenic|drug response|risk factor") & ~F.lower("ClinicalSignificance").contains("conflicting")).withColumn("key", F.concat(F.lit("CLINVAR:"), "VariationID"))
    b.add("Variant", v, "clinvar", key="key", name="Name", variant_type="Type", gene_symbol="GeneSymbol", clinical_significance="ClinicalSignificance", catalogue=F.lit("ClinVar"))
    b.add("VARIANT_IN", v, "clinvar", src="key", dst="target", match_method=F.lit("structured"))
    if "efo_mesh" not in b.dictionaries:
        return
    # By the crosswalk of the indications alone: another id has no disease to point at.
    ids = v.select("key", "ClinicalSignificance", F.explode(F.regexp_extract_all("PhenotypeIDS", F.lit(r"(MONDO[:_]\d+)"), 1)).alias("id")).withColumn("efo", text.vocabulary_key(F.col("id")))
    ids = ids.join(b.dictionaries["efo_mesh"].select("efo", F.col("key").alias("disease")), "efo")
    b.add("IMPLICATED_IN", ids, "clinvar", src="key", dst="disease", match_method=F.lit("structured"), significance="ClinicalSignificance")


LOADERS = [atc, gsrs, molecules, molecule_synonyms, structures, atc_substances, salts, rxnorm, dailymed, targets, mechanisms, mesh_actions]
