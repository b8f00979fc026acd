"""Biologics: products by licence, what protects them, and what they resemble; a country's history of status."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.loaders.build import Build
from tessera.loaders.events import product

#: Columns of dates, with the code and the definition of the exclusivity that they end.
EXCLUSIVITIES = [
    ("exclusivity_expiration_date", "EXCLUSIVITY", "BIOLOGIC EXCLUSIVITY"),
    ("ref_product_exclusivity_exp_date", "REFERENCE_PRODUCT", "REFERENCE PRODUCT EXCLUSIVITY"),
    ("orphan_exclusivity_exp_date", "ORPHAN", "ORPHAN DRUG EXCLUSIVITY"),
]
#: Fixed value: the kind of licence of an originator.
ORIGINATOR = "351(a)"


def purplebook(b: Build) -> None:
    """Products by BLA number. A biosimilar's originator is the one that the source resolved, else the originator of its reference's brand name."""
    columns = ["bla_number", "proper_name", "proprietary_name", "license_type", "approval_date", "strength", "dosage_form", "route_of_administration", "marketing_status", "applicant", "patent_numbers", "resolved_reference_bla", "ref_product_proprietary_name"]
    r = b.rows("pb", *columns, *[c for c, _, _ in EXCLUSIVITIES]).filter("bla_number <> ''").withColumn("key", F.concat(F.lit("FDA:BLA"), "bla_number"))
    # A licence without a trade name has a placeholder there; the proper name stands in.
    name = F.when((F.col("proprietary_name") != "") & ~text.is_placeholder(F.col("proprietary_name")), F.col("proprietary_name")).otherwise(F.col("proper_name"))
    product(b, r.select("key", name.alias("name"), F.col("proper_name").alias("ingredients"), F.col("applicant").alias("company"), F.col("marketing_status").alias("status"), F.col("dosage_form").alias("form"), "strength", F.col("route_of_administration").alias("route"), F.col("approval_date").alias("date")), "purplebook", "FDA")
    for column, code, definition in EXCLUSIVITIES:
        x = r.filter(f"{column} <> ''").withColumn("x", F.concat(F.lit("EXCL:BLA"), "bla_number", F.lit(f":{code}")))
        b.add("Exclusivity", x, "purplebook", key="x", code=F.lit(code), date=column, definition=F.lit(definition))
        b.add("HAS_EXCLUSIVITY", x, "purplebook", src="key", dst="x", match_method=F.lit("structured"))
    p = r.select("key", F.explode(text.parts(F.col("patent_numbers"), ",")).alias("no")).withColumn("p", F.concat(F.lit("PATENT:US:"), "no"))
    b.add("Patent", p, "purplebook", key="p", patent_no="no")
    b.add("PROTECTED_BY", p, "purplebook", src="key", dst="p", match_method=F.lit("structured"))
    b.keep("bla", r.select("bla_number", "key", "license_type", "proprietary_name", "resolved_reference_bla", "ref_product_proprietary_name").dropDuplicates(["bla_number", "resolved_reference_bla", "ref_product_proprietary_name"]))
    held = b.dictionaries["bla"]
    brands = held.filter((F.col("license_type") == ORIGINATOR) & (text.fold(F.col("proprietary_name")) != "")).groupBy(text.fold(F.col("proprietary_name")).alias("probe")).agg(F.min("bla_number").alias("by_name"))
    found = held.withColumn("probe", text.fold(F.col("ref_product_proprietary_name"))).join(brands, "probe", "left")
    ref = F.when(F.col("license_type") == ORIGINATOR, F.col("bla_number")).otherwise(F.coalesce(F.nullif("resolved_reference_bla", F.lit("")), "by_name"))
    how = F.when(F.col("resolved_reference_bla") != "", "structured").otherwise("name")
    found = found.select("key", "bla_number", ref.alias("ref"), how.alias("how"))
    known = held.select(F.col("bla_number").alias("ref"), F.col("key").alias("original")).distinct()
    b.add("BIOSIMILAR_OF", found.filter("ref <> bla_number").join(known, "ref"), "purplebook", src="key", dst="original", match_method="how")


def biologic_patents(b: Build) -> None:
    """Patents that are listed for a licence, of products that are there."""
    p = b.rows("pb_patents", "Reference Product BLA Number", "Patent Number", "Patent Expiration Date").select(F.col("Reference Product BLA Number").alias("bla_number"), F.replace("Patent Number", F.lit(","), F.lit("")).alias("no"), F.col("Patent Expiration Date").alias("date")).filter("no <> ''")
    p = p.join(b.dictionaries["bla"].select("bla_number", "key").distinct(), "bla_number").withColumn("p", F.concat(F.lit("PATENT:US:"), "no"))
    b.add("Patent", p, "purplebook_patents", key="p", patent_no="no", expire_date="date")
    b.add("PROTECTED_BY", p, "purplebook_patents", src="key", dst="p", match_method=F.lit("structured"))


def canada_status(b: Build) -> None:
    """Every change of a product's status, as an approval of its own: a history, not a last state."""
    products = b.rows("ca_drug", "DRUG_CODE").filter("DRUG_CODE <> ''").distinct()
    s = b.rows("ca_status", "DRUG_CODE", "STATUS_EN", "HISTORY_DATE").filter("STATUS_EN <> ''").join(products, "DRUG_CODE")
    s = s.withColumn("a", F.concat_ws(":", F.lit("APPROVAL:CA"), "DRUG_CODE", text.fold(F.col("STATUS_EN")), text.fold(F.col("HISTORY_DATE"))))
    b.add("Approval", s, "canada_status", key="a", date="HISTORY_DATE", type=F.lit("status_change"), status="STATUS_EN", agency=F.lit("HC"))
    b.add("HAS_APPROVAL", s, "canada_status", src=F.concat(F.lit("CA:"), "DRUG_CODE"), dst="a", match_method=F.lit("structured"))
