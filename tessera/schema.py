"""Declared node and edge tables of the linked data, and their typed forms."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

#: Columns that every row carries.
PROVENANCE = ["source", "run_id"]
#: Columns of node tables by label.
NODES = {
    "Substance": "key name norm_name synonyms substance_class status max_phase resolved_by",
    "Product": "key name agency status status_raw form strength",
    "Identifier": "key scheme value",
    "Target": "key symbol name organism target_type",
    "Disease": "key name synonyms vocabulary tree_numbers",
    "Mechanism": "key name action_type",
    "DrugClass": "key atc_code name level vocabulary",
    "Modality": "key name",
    "Route": "key name",
    "Region": "key name",
    "Country": "key iso2 name",
    "RegulatoryAgency": "key code name country region",
    "Company": "key name raw_names",
    "Approval": "key date type status agency",
    "ClinicalTrial": "key registry title status phase study_type study_type_raw enrollment start_date",
    "Patent": "key patent_no expire_date use_code use_definition drug_substance_flag drug_product_flag",
    "Exclusivity": "key code date definition",
    "RegulatoryEvent": "key type name status reason start_date end_date url",
    "AdverseEvent": "key term",
    "Publication": "key title year journal doi pmid source_db preprint",
    "Variant": "key name variant_type gene_symbol clinical_significance catalogue consequence",
    "OrganClass": "key name",
}
#: Edge types, the labels that they join, and their own properties.
EDGES = {
    "HAS_IDENTIFIER": ("*", "Identifier", ""),
    "CONTAINS": ("Product", "Substance", ""),
    "DEVELOPS": ("Company", "Product", ""),
    "APPROVED_BY": ("Product", "RegulatoryAgency", ""),
    "APPROVED_IN": ("Product", "Region", ""),
    "HAS_APPROVAL": ("Product", "Approval", ""),
    "ISSUED_BY": ("Approval|RegulatoryEvent", "RegulatoryAgency|Company", ""),
    "PROTECTED_BY": ("Product", "Patent", ""),
    "HAS_EXCLUSIVITY": ("Product", "Exclusivity", ""),
    "BIOSIMILAR_OF": ("Product", "Product", ""),
    "HAS_ROUTE": ("Product", "Route", ""),
    "IN_CLASS": ("Substance|Product|DrugClass", "DrugClass", ""),
    "HAS_MODALITY": ("Substance", "Modality", ""),
    "IS_SALT_OF": ("Substance", "Substance", ""),
    "TARGETS": ("Substance", "Target", ""),
    "HAS_MECHANISM": ("Substance", "Mechanism", ""),
    "SPONSORED_BY": ("ClinicalTrial", "Company", ""),
    "STUDIES": ("ClinicalTrial", "Disease", ""),
    "TESTED_IN": ("Substance", "ClinicalTrial", ""),
    "CONDUCTED_IN": ("ClinicalTrial", "Country", ""),
    "SAME_STUDY_AS": ("ClinicalTrial", "ClinicalTrial", ""),
    "SUBJECT_OF": ("Substance", "RegulatoryEvent", ""),
    "HAS_ADVERSE_EVENT": ("Substance", "AdverseEvent", "report_count serious_count death_count"),
    "IN_ORGAN_CLASS": ("AdverseEvent", "OrganClass", ""),
    "VARIANT_IN": ("Variant", "Target", ""),
    "IMPLICATED_IN": ("Variant", "Disease", "significance"),
    "ABOUT": ("Publication", "Disease", ""),
    "MENTIONS": ("Publication", "Substance", ""),
    "IN_REGION": ("Country", "Region", ""),
    "SUBTYPE_OF": ("Disease", "Disease", ""),
    "INDICATED_FOR": ("Substance", "Disease", "max_phase"),
    "ASSOCIATED_WITH": ("Target", "Disease", "score"),
}
#: Columns that are not text once typed.
TYPED = {"report_count": IntegerType(), "serious_count": IntegerType(), "death_count": IntegerType(), "enrollment": IntegerType(), "level": IntegerType(), "year": IntegerType(), "score": DoubleType(), "max_phase": DoubleType(), "preprint": BooleanType()}


def columns(kind: str) -> list[str]:
    """Columns of a node label or edge type, with provenance; an unknown name raises KeyError."""
    own = NODES[kind].split() if kind in NODES else ["src", "dst", "match_method", *EDGES[kind][2].split()]
    if set(own) & set(PROVENANCE):
        raise ValueError(f"{kind} declares a provenance column")
    return own + PROVENANCE


def struct(kind: str, typed: bool = False) -> StructType:
    return StructType([StructField(c, TYPED.get(c, StringType()) if typed else StringType()) for c in columns(kind)])


def endpoints(edge: str) -> tuple[set[str], set[str]]:
    """Labels allowed at the source and destination; ``*`` allows any."""
    src, dst, _ = EDGES[edge]
    return tuple(set(NODES) if side == "*" else set(side.split("|")) for side in (src, dst))
