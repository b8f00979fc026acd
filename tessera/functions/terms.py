"""Terms of registry cells that dictionaries can be asked about, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import is_placeholder

#: Separators, labels of registries and arms, doses, codes, formulations, and what is no drug.
SEPARATOR = r"(?i)\s*(?:[;|]|<\s*br\s*/?\s*>)\s*"
KIND = r"(?i)^(?:drug|biological|device|procedure|behavioral|dietary\s+supplement|radiation|genetic|diagnostic\s+test|other|combination\s+product)\s*:\s*"
DOSE = r"(?i)\b\d+(?:\.\d+)?\s*(?:mg|mcg|ug|g|ml|iu|%|mg/kg|mg/ml)\b.*$"
ARM = r"^(?:[A-Za-z][A-Za-z0-9 /()-]{0,38}?\s*:\s*(?=\S)){1,3}"
CONDITION_LABEL = r"(?i)^\s*health\s+condition\s*\d*\s*:\s*"
CODE = r"^\s*([A-Z]\d{2,3}(?:\.\d+)?)\s*[-:]\s*"
CODE_IN_JSON = r"(?i)ICD-?10\s*Condition:\s*([A-Z]\d{2,3}(?:\.\d+)?)"
COMBINATION = r"(?i)\s*[+]\s*|\s+and\s+|\s*/\s*"
FORMULATION = r"(?i)^(?:nab[ -]?|pegylated[ -]|peg[ -]|liposomal[ -]|lipo[ -]|micronized[ -]|micronised[ -]|nano[ -]?|recombinant[ -]|human[ -]recombinant[ -]|inhaled[ -]|oral[ -]|topical[ -])"
NO_DRUGS = "blood sample|blood samples|saline solution|water|normal diet|diet|exercise|surgery|radiotherapy|placebo|placebos|control|controls|no intervention|standard care|standard of care|usual care|routine care|normal saline|saline|sham|sham procedure|blank|vehicle|best supportive care|observation|no treatment|conventional".split("|")
NO_DRUG_PARTS = "placebo|chemotherapy|sham |vehicle control|standard of care|best supportive care"
#: Characters of a term, and terms of one cell: beyond that a trial is a basket of many.
LEAST, MOST, TERMS = 3, 120, 12


def _cells(c: Column) -> Column:
    return F.transform(F.split(F.coalesce(c, F.lit("")), SEPARATOR), lambda x: F.regexp_replace(F.regexp_replace(x, KIND, ""), DOSE, ""))


def _bare(c: Column) -> Column:
    return F.regexp_replace(c, r"^[ \t-]+|[ \t-]+$", "")


def _sized(terms: Column) -> Column:
    return F.filter(terms, lambda x: F.length(x).between(LEAST, MOST))


def condition_names(c: Column, most: int = TERMS) -> Column:
    """Conditions without the registry's label and code; bare code numbers are left out."""
    names = F.transform(_cells(c), lambda x: _bare(F.regexp_replace(F.regexp_replace(x, CONDITION_LABEL, ""), CODE, "")))
    return F.slice(_sized(F.filter(names, lambda x: ~x.rlike(r"^\d{4,}$"))), 1, most)


def condition_codes(c: Column, most: int = TERMS) -> Column:
    """ICD-10 codes before the names, or inside a registry's JSON."""
    ahead = F.transform(_cells(c), lambda x: F.regexp_extract(F.regexp_replace(x, CONDITION_LABEL, ""), CODE, 1))
    inside = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(CODE_IN_JSON), 1)
    return F.slice(F.array_distinct(F.transform(F.filter(F.concat(ahead, inside), lambda x: x != ""), F.upper)), 1, most)


def _is_drug(c: Column) -> Column:
    low = F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    return (low != "") & ~is_placeholder(c) & ~low.isin(NO_DRUGS) & ~low.rlike(NO_DRUG_PARTS)


def drug_names(c: Column, most: int = TERMS) -> Column:
    """Drugs of an intervention cell: labels and doses off, combinations apart, a formulation's drug after it."""
    whole = F.filter(F.transform(_cells(c), lambda x: F.regexp_replace(x, ARM, "")), _is_drug)
    single = _sized(F.filter(F.flatten(F.transform(whole, lambda x: F.transform(F.split(x, COMBINATION), _bare))), _is_drug))
    bare = lambda x: F.trim(F.regexp_replace(x, FORMULATION, ""))
    both = F.flatten(F.transform(single, lambda x: F.when((bare(x) != x) & (F.length(bare(x)) > LEAST), F.array(x, bare(x))).otherwise(F.array(x))))
    return F.slice(both, 1, most)
