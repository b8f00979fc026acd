"""Ids of other vocabularies for nodes that are there, and the spelling of dosage forms that submissions use."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.loaders.build import Build


def concept_ids(b: Build) -> None:
    """Concept codes of targets by their accession; then gene and metathesaurus ids by those codes, or by the gene.

    Nothing is created: a code that names no target here is left out.
    """
    targets = b.dictionaries["tid"].select(F.col("target").alias("key")).distinct().filter(F.col("key").startswith("UNIPROT:"))
    own = b.rows("ncit_swissprot", "ncit_code", "swissprot_id").filter("ncit_code <> ''").withColumn("key", F.concat(F.lit("UNIPROT:"), "swissprot_id")).join(targets, "key")
    b.identify(own, "ncit", "key", "NCIT", "ncit_code")
    b.keep("ncit", own.groupBy("ncit_code").agg(F.min("key").alias("key")))
    by_code = b.dictionaries["ncit"]
    if b.has("ncit_hgnc"):
        g = b.rows("ncit_hgnc", "ncit_code", "hgnc_id").filter("hgnc_id <> ''").join(by_code, "ncit_code", "left")
        if b.has("hgnc") and "symbol" in b.dictionaries:
            genes = b.rows("hgnc", "hgnc_id", "symbol").join(b.dictionaries["symbol"], "symbol").groupBy("hgnc_id").agg(F.min("target").alias("gene"))
            g = g.join(genes, "hgnc_id", "left").withColumn("key", F.coalesce("key", "gene"))
        b.identify(g.filter("key is not null"), "ncit", "key", "HGNC", "hgnc_id")
    if b.has("ncit_cui"):
        c = b.rows("ncit_cui", "code", "cui").filter("cui <> ''").withColumnRenamed("code", "ncit_code").join(by_code, "ncit_code")
        b.identify(c, "ncit", "key", "UMLS_CUI", "cui")


def dosage_forms(b: Build) -> None:
    """The codelist's own spelling by every name of a form; forms that merged before still merge."""
    r = b.rows("cdisc_sdtm", "Codelist Name", "CDISC Submission Value", "CDISC Synonym(s)").filter("`Codelist Name` = 'Dosage Form'").select(F.col("CDISC Submission Value").alias("value"), F.col("CDISC Synonym(s)").alias("names")).filter("value not in ('', 'FRM')")
    every = r.select("value", F.posexplode(F.concat(F.array("value"), text.parts(F.col("names"), ";"))).alias("pos", "name"))
    b.keep("forms", every.select("value", "pos", text.form_key(F.col("name")).alias("form_key")).filter("form_key <> ''").groupBy("form_key").agg(F.min_by("value", F.struct("pos", "value")).alias("standard")))
